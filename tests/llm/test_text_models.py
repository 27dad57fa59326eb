"""Language ID, token counts, packed matrices and packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from contactweave.llm import language, packing, token_counts, token_matrix
from contactweave.llm.common import table
from contactweave.llm.tokens import document_ids

ODD = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "wörd " * 3000), (7, "日本語 \U0001f600\n\n  x"), (8, "1 2 3 !?"), (9, "a <|endoftext|> b")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in language.op4_subword_language(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) and 0 <= got[d.doc_id].score <= 1 for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.97


def test_language_cases(spark, odd):
    rng = np.random.default_rng(0)
    rows = [(k, " ".join(rng.choice(["the", "with", "and"] if k % 2 else ["der", "mit", "und"], 20)), "en" if k % 2 else "de") for k in range(60)] + [(98, None, "en"), (99, "the and", None)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 20)
    assert model.langs == ["de", "en"]
    out = language.identify(odd.withColumn("score", F.lit("own")), model).collect()
    assert [r.lang_pred for r in out if r.doc_id in (1, 2, 8)] == ["und"] * 3 and all(r.lang_pred in ("de", "en") for r in out if r.doc_id in (3, 7, 9))
    alone = language.identify(spark.createDataFrame([("with the and",), ("und der mit",)], "text string"), model).collect()
    assert [r.lang_pred for r in alone] == ["en", "de"]
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}
    assert language.identify(odd.limit(0), model).count() == 0
    assert language.fit(spark.createDataFrame([], "doc_id long, text string, lang string")) is None


def naive_buckets(text):
    """Buckets of all three- and four-byte subwords, from the definition."""
    folded = [32, *(b + 32 if 65 <= b <= 90 else b if b >= 97 and b <= 122 or b >= 128 else 32 for b in text), 32]
    out = []
    for n in (3, 4):
        for i in range(len(folded) - n + 1):
            h = folded[i]
            for b in folded[i + 1 : i + n]:
                h = h * 0x01000193 % 2**32 ^ b
            out.append((h * 0x9E3779B1 % 2**32) >> 16)
    return out


@pytest.mark.parametrize(("size", "stretch"), [(language.SLICE, language.STRETCH), (50, 7), (6, 200)])
def test_prediction_by_definition(texts, monkeypatch, size, stretch):
    """Average of subword values, softmax at the temperature, whatever the slices."""
    monkeypatch.setattr(language, "SLICE", size)
    monkeypatch.setattr(language, "STRETCH", stretch)
    some = [t.encode()[:700] for t in list(texts.values())[:40]] + [b"a", "é日".encode()]
    model = language.train([language.bag(t) for t in some], ["a", "b", "c"] * 14, epochs=2)
    assert model.temperature != 1
    for t in [*some, b""]:
        own = naive_buckets(t)
        assert sorted(own) == sorted(k for part in language.subwords(t) for k in part.tolist())
        bucket, share = language.bag(t)
        assert dict(zip(bucket.tolist(), share.tolist(), strict=True)) == pytest.approx({k: n / max(1, len(own)) for k, n in Counter(own).items()})
        z = [sum(float(model.table[k, c]) for k in own) / max(1, len(own)) + model.bias[c] for c in range(3)]
        e = [np.exp((x - max(z)) / model.temperature) for x in z]
        lang, score = model.predict(t)
        assert np.allclose(model.logits(t), z, atol=1e-6) and lang == model.langs[int(np.argmax(e))] and abs(score - max(e) / sum(e)) < 1e-6


def test_calibration_by_definition():
    rng = np.random.default_rng(9)
    truth = rng.integers(0, 3, 200)
    z = rng.normal(0, 1, (200, 3)) + 2.5 * np.eye(3)[truth]
    heat, least = language.calibrate(z, truth, 0.05)
    loss = lambda t: -sum(x[k] / t - np.log(np.exp(x / t).sum()) for x, k in zip(z, truth, strict=True))
    assert all(loss(heat) <= loss(t) + 1e-9 for t in np.geomspace(0.05, 20, 121))
    p = np.array([np.exp(x / heat) / np.exp(x / heat).sum() for x in z])
    score, right = p.max(axis=1), p.argmax(axis=1) == truth
    assert 0 < least < 1 and np.mean(~right[score >= least - 1e-9]) <= 0.05
    assert all(np.mean(~right[score >= s - 1e-9]) > 0.05 for s in score if s < least - 1e-9)
    assert language.calibrate(z, z.argmax(axis=1), 0.05)[1] == 0 and language.calibrate(z, (z.argmax(axis=1) + 1) % 3, 0.05)[1] == 1


def test_rejection(spark):
    model = language.train([language.bag(t) for t in (b"with the and", b"mit der und")] * 2, ["en", "de"] * 2)
    texts = ["the with", "der und", "xq zzt"]
    model.reject_below = sorted(model.predict(t.encode())[1] for t in texts)[1]
    out = {r.text: r for r in language.identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()}
    assert all(out[t].rejected == (model.predict(t.encode())[1] < model.reject_below) and out[t].lang_pred == model.predict(t.encode())[0] for t in texts)
    assert out["xq zzt"].rejected


def test_languages_are_not_dropped(spark):
    rows = [(k, f"word{k}", f"l{k % 5}") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit(df, max_langs=5).langs == [f"l{k}" for k in range(5)]
    with pytest.raises(ValueError):
        language.fit(df, max_langs=4)
    with pytest.raises(ValueError, match="lower per_lang"):
        language.fit(df, max_langs=5, max_entries=3)


def test_counts_equal_the_tokenizer(texts, monkeypatch):
    from tokenizers import models

    model = models.Unigram(token_counts.vocabulary(token_counts.MODEL), 0, True)
    counter = token_counts.Counter(token_counts.MODEL)
    more = ["a  b\n\n c", "   ", "\n", " a", "a ", "<s> <0x0A>", "aaaaaaaaaaaaaaaaaaaaa", "\t\tx", "日本語テキスト \U0001f600é"]
    for text in [*texts.values(), *more]:
        assert counter.text(text)[0] == len(model.tokenize(token_counts.normal(text)))
    monkeypatch.setattr(token_counts, "LONG", 5)
    for text in more:
        assert counter.text(text)[0] == len(model.tokenize(token_counts.normal(text)))


def test_count_cases(spark, odd):
    out = token_counts.count_tokens(odd.withColumn("n_tokens", F.lit("own"))).collect()
    assert [r.n_tokens for r in out if r.doc_id in (1, 2)] == [0, 0] and all(r.n_tokens > 0 for r in out if r.doc_id in (3, None, 7))
    assert token_counts.count_tokens(odd.limit(0)).count() == 0


def test_ids_equal_the_tokenizer(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    more = ["a<|endoftext|>", "<|endoftext|>" * 3, " <|endoftext|>\n<|endof", "<|endoftext|", "x" * 300_000, "7" * 300_000, "é\u0300" * 50_000]
    for text in [*list(texts.values()), *[x or "" for _, x in ODD], *more]:
        assert document_ids(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("pool", [1 << 21, 5000])
def test_matrices(spark, sf, odd, texts, pool):
    for df, want in ((spark.read.parquet(f"{sf}/documents.parquet"), list(texts.items())), (odd, ODD), (odd.limit(0), [])):
        rows = token_matrix.matrices(df, pool_tokens=pool).collect()
        parts = defaultdict(list)
        for r in rows:
            ids, at = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
            assert len(ids) == len(at) == 1024 and r.cu_lengths[-1] == r.n_tokens <= 1024 and not ids[r.n_tokens :].any()
            for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_lengths, r.cu_lengths[1:], strict=False):
                parts[d].append((s, ids[a:b].tolist()))
                assert at[a:b].tolist() == list(range(b - a))
        expect = defaultdict(list)
        for d, t in want:
            ids = document_ids(t).tolist()
            expect[d] += [(k, ids[k : k + 1024]) for k in range(0, len(ids), 1024)]
        assert {d: sorted(p) for d, p in parts.items()} == {d: sorted(p) for d, p in expect.items()}


def test_matrix_query_and_files(spark, sf, texts, tmp_path):
    """The registered query's rows are those of the written matrices, and these give every document's ids back."""
    got = sorted(token_matrix.op7_best_fit_matrices(spark, sf).collect(), key=lambda r: (r.bucket, r.number))
    token_matrix.write_matrices(token_matrix.matrices(table(spark, sf, "documents")), str(tmp_path / "m"))
    rows = sorted(spark.read.parquet(str(tmp_path / "m")).collect(), key=lambda r: (r.bucket, r.number))
    assert [(r.bucket, r.number, r.doc_ids, r.starts, r.cu_lengths, r.n_tokens, zlib.crc32(r.ids), zlib.crc32(r.positions)) for r in rows] == [tuple(r) for r in got]
    parts = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_lengths, r.cu_lengths[1:], strict=False):
            parts[d][s] = ids[a:b].tolist()
    assert {d: [x for s in sorted(p) for x in p[s]] for d, p in parts.items()} == {d: document_ids(t).tolist() for d, t in texts.items()}
    assert sum(r.n_tokens for r in rows) / 1024 / len(rows) > 0.6


def test_count_query(spark, sf, texts):
    from tokenizers import models

    model = models.Unigram(token_counts.vocabulary(token_counts.MODEL), 0, True)
    score = dict(token_counts.vocabulary(token_counts.MODEL))
    got = {r.doc_id: r for r in token_counts.op6_viterbi_counts(spark, sf).collect()}
    assert set(got) == set(texts)
    for d, t in texts.items():
        pieces = [p.value for p in model.tokenize(token_counts.normal(t or ""))]
        assert got[d].n_tokens == len(pieces)
        if all(p in score for p in pieces) and not any(p.startswith("<0x") for p in pieces):
            assert got[d].score == sum(score[p] for p in pieces)


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(150):
        sizes = rng.integers(1, 65, int(rng.integers(0, 60))).tolist()
        rooms = []
        for s in sorted(sizes, reverse=True):
            fit = [r for r in rooms if r >= s]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - s)
            else:
                rooms.append(64 - s)
        got = token_matrix.best_fit(sizes, 64)
        assert sorted(k for row in got for k in row) == list(range(len(sizes)))
        assert sorted(64 - sum(sizes[k] for k in row) for row in got) == sorted(rooms)


def check_packing(rows, docs):
    expect = Counter()
    for d, t in docs:
        ids = document_ids(t)
        for k in range(0, len(ids), 1024):
            expect[d, k, len(ids[k : k + 1024]), zlib.crc32(ids[k : k + 1024].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expect
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(by) == list(range(len(by)))
    return 1 - sum(r.length for r in rows) / (1024 * max(1, len(by)))


def test_packing(spark, sf, odd, texts):
    assert check_packing(packing.op8_nnls_packing(spark, sf).collect(), list(texts.items())) < 0.03
    check_packing(packing.pack_documents(odd).collect(), ODD)
    assert packing.pack_documents(odd.limit(0)).count() == 0
    ids = packing.cut_pieces(odd, with_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in ids)


@pytest.mark.parametrize("histogram", [{}, {128: 3}, {64: 5}, {1: 1000}, {100: 40, 28: 7, 20: 90}, {c: c % 7 for c in range(1, 129)}, {c: 1 << 40 for c in range(1, 128)}])
def test_plan_uses_every_piece(histogram):
    got = Counter()
    for combo, times in packing.plan(dict(histogram), 128):
        assert sum(combo) <= 128 and times > 0
        for c in combo:
            got[c] += times
    assert got == Counter({c: n for c, n in histogram.items() if n})


def test_nnls():
    rng = np.random.default_rng(3)
    a = rng.random((12, 30))
    truth = np.where(rng.random(30) < 0.2, rng.random(30) * 9, 0)
    x = packing.nnls(a, a @ truth)
    assert (x >= 0).all() and np.abs(a @ x - a @ truth).max() < 1e-3


def test_long_white_space():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    long = 1_200_000
    for text in (" " * 3_000_000, "\n" * 3_000_000, "one" + " " * long + "two", "one" + "\n" * long, " \n" * long + "\t#", "a" + "\u3000" * 10_000 + "b" + " " * 9_999 + "c" + "\x1c" * 12_000 + " " * 10_001 + "\n7"):
        assert document_ids(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]


def test_white_space_before_added_tokens(monkeypatch):
    """20,000 random texts whose runs of four and more are split off, and two with runs as long as in production."""
    from tokenizers import Tokenizer

    from contactweave.llm import tokens

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    for text in ("x" + "\n" * 10_000 + end, "\n" * 20_000 + end, "\n" * 10_001 + end[:-1], " " * 10_000 + end + "\t" * 10_000):
        assert document_ids(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]
    monkeypatch.setattr(tokens, "LONG_RUN", tokens.long_run(4))
    rng = random.Random(16)
    pieces = [end, end[:-1], "|>", "a", " b", "é", "'s", "7", "#", " ", "\n", "\t", "　", " " * 4, "\n" * 5, " \n" * 4, "\n" * 3 + " "]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(1, 14))) for _ in range(20_000)]
    for text, want in zip(texts, t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert document_ids(text).tolist() == [*want.ids, 0], repr(text)


def test_matrices_do_not_depend_on_files(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = []
    for n in (1, 7, 40):
        docs.repartition(n).write.parquet(str(tmp_path / str(n)))
        found = token_matrix.matrices(spark.read.parquet(str(tmp_path / str(n))), per_bucket=64)
        rows.append(sorted(map(tuple, found.collect())))
    assert rows[0] == rows[1] == rows[2] and len({r[0] for r in rows[0]}) > 2
