"""Language identification by averaged hashed subword embeddings.

A text, ASCII letters in lower case and all other ASCII as blanks, is the average of
the embeddings of its subwords of three and four bytes, hashed into a fixed number of
rows; a linear softmax over the average gives the language. Both are trained by
stochastic gradient descent in numpy on at most ``per_lang`` labelled documents a
language, those of the smallest hash. Tasks turn these into bags of subwords, at most
BUCKETS entries however long the text, and only the bags go to the driver. A fifth of
them is kept from training to fit the temperature of the softmax and the score below
which a prediction is rejected. As everything up to the softmax is linear, prediction
looks up class sums directly.

Bounds, as parameters: ``per_lang`` documents a language, ``max_langs`` languages, and
``max_entries`` distinct subwords of all these documents together; more than that raises an
error, nothing is left out silently.

Defined cases: null text, or one without a letter: ``und`` with score 0, not learned
from; a null label is not learned from; without labelled documents all is ``und``;
very long texts are summed up slice by slice; equal scores go to the first language;
repeated rows get equal rows; an empty table gives an empty table; columns ``lang_pred``,
``score`` and ``rejected`` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contactweave.llm.common import stored, table

BUCKETS, WIDTH = 1 << 16, 16
PARTS = 256
#: Bytes of a text whose subwords are held at once, and looked-up values for all languages.
STRETCH, SLICE = 1 << 20, 1 << 21
SIZES = (3, 4)
#: Bytes as the subwords see them.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 97 and b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint32)


def subwords(text: bytes) -> Iterator[np.ndarray]:
    """The buckets of all the subwords of the text with a blank on both sides, a bounded stretch at a time."""
    padded = b" " + text + b" "
    for at in range(0, len(padded), STRETCH):
        key = folded = FOLD[np.frombuffer(padded[at : at + STRETCH + max(SIZES) - 1], dtype=np.uint8)]
        for n in range(2, max(SIZES) + 1):
            key = key[:-1] * np.uint32(0x01000193) ^ folded[n - 1 :]
            if n in SIZES:
                yield (key[:STRETCH] * np.uint32(0x9E3779B1)) >> np.uint32(16)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the text's subwords, and the share of each."""
    n = sum(np.bincount(key, minlength=BUCKETS) for key in subwords(text))
    bucket = np.flatnonzero(n)
    return bucket.astype(np.int32), (n[bucket] / max(1, n.sum())).astype(np.float32)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages): what a subword adds
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, text: bytes) -> np.ndarray:
        """Class scores; a bounded slice of the text's subwords is looked up at a time."""
        total, count, step = np.zeros(len(self.langs)), 0, max(1, SLICE // len(self.langs))
        for key in subwords(text):
            for at in range(0, len(key), step):
                total += self.table[key[at : at + step]].sum(axis=0, dtype=np.float64)
            count += len(key)
        return total / max(count, 1) + self.bias

    def predict(self, text: bytes) -> tuple[str, float]:
        p = softmax(self.logits(text) / self.temperature)
        at = int(p.argmax())
        return self.langs[at], float(p[at])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def calibrate(z: np.ndarray, truth: np.ndarray, max_error: float) -> tuple[float, float]:
    """The temperature of least log loss, and the least score down to which at most ``max_error`` of the predictions are wrong."""
    at = np.arange(len(z))
    heats = np.geomspace(0.05, 20, 121)
    loss = [-np.log(np.maximum(softmax(z / t)[at, truth], 1e-12)).mean() for t in heats]
    heat = float(heats[int(np.argmin(loss))])
    p = softmax(z / heat)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != truth
    order = np.argsort(-score, kind="stable")
    fine = np.flatnonzero(np.cumsum(wrong[order]) <= max_error * np.arange(1, len(z) + 1))
    if not len(fine):
        return heat, 1.0
    return heat, float(score[order[fine[-1]]]) if fine[-1] + 1 < len(z) else 0.0


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], epochs: int = 12, rate: float = 20.0, seed: int = 7, max_error: float = 0.01) -> Model:
    """Fit the model to bags of subwords; a pure function of its arguments."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    y = np.searchsorted(langs, labels)
    held = np.arange(len(bags)) % 5 == 4 if len(bags) >= 25 else np.zeros(len(bags), dtype=bool)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = rng.normal(0, 0.1, (len(langs), WIDTH)).astype(np.float32), np.zeros(len(langs), dtype=np.float32)
    fit = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(fit):
            bucket, share = bags[k]
            x = share @ embed[bucket]
            error = softmax(weight @ x + bias)
            error[y[k]] -= 1
            back = weight.T @ error
            weight -= np.float32(0.05 * step / 20) * np.outer(error, x)
            bias -= np.float32(0.01 * step / 20) * error
            embed[bucket] -= np.float32(step) * np.outer(share, back)
    model = Model(langs, embed @ weight.T, bias.astype(float), 1.0, 0.0)
    at = np.flatnonzero(held)
    if len(at):
        z = np.array([bags[k][1].astype(float) @ model.table[bags[k][0]] + model.bias for k in at])
        model.temperature, model.reject_below = calibrate(z, y[at], max_error)
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def labelled_sample(df: DataFrame, per_lang: int, max_langs: int = 1000) -> DataFrame:
    """At most ``per_lang`` (text, lang) rows a language, those of the smallest hash; the cut is found on hashes alone."""
    keyed = df.filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn("_cw_h", F.xxhash64("doc_id", "text"))
    # Twice: in each of many parts of a language first, so that no task ranks what all scan tasks keep of one.
    least = keyed.select("lang", "_cw_h", F.pmod(F.xxhash64("_cw_h"), F.lit(PARTS)).alias("part"))
    for by in (["lang", "part"], ["lang"]):
        least = least.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("_cw_h"))).filter(F.col("n") <= per_lang)
    cut = least.groupBy("lang").agg(F.max("_cw_h").alias("_cw_cut")).limit(max_langs + 1).collect()
    if len(cut) > max_langs:
        raise ValueError(f"more than {max_langs} languages in the labels: raise max_langs, or name the languages wanted")
    below = df.sparkSession.createDataFrame(cut, "lang string, _cw_cut long")  # at most max_langs rows
    return keyed.join(F.broadcast(below), "lang").filter(F.col("_cw_h") <= F.col("_cw_cut")).dropDuplicates(["lang", "_cw_h"]).select("text", "lang", "_cw_h")


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [bag(t.as_py().encode()) for t in batch.column("text")]
        columns = [batch.column("lang"), batch.column("_cw_h"), pa.array([b for b, _ in made], pa.list_(pa.int32())), pa.array([s for _, s in made], pa.list_(pa.float32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "_cw_h", "bucket", "share"])


def fit(df: DataFrame, per_lang: int = 600, max_langs: int = 1000, max_entries: int = 1 << 25) -> Model | None:
    """The model of (doc_id, text, lang); the driver gets at most ``per_lang * max_langs`` bags, and ``max_entries`` subwords of 8 bytes in them."""
    bags = stored(labelled_sample(df, per_lang, max_langs).mapInArrow(_bags, "lang string, _cw_h long, bucket array<int>, share array<float>"), "bags")
    entries = bags.agg(F.sum(F.size("bucket"))).first()[0] or 0
    if entries > max_entries:
        raise ValueError(f"the sample has {entries} subwords, more than {max_entries}: lower per_lang, or raise max_entries with the driver's memory")
    rows = bags.toArrow().sort_by([("_cw_h", "ascending"), ("lang", "ascending")])
    bags = [(b.values.to_numpy(), s.values.to_numpy()) for b, s in zip(rows["bucket"], rows["share"], strict=True)]
    return train(bags, rows["lang"].to_pylist()) if bags else None


def identify(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``rejected``."""
    if model is None:
        return df.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)})

    @F.arrow_udf("struct<lang: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        said = [model.predict((t.as_py() or "").encode()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([s[k] for s in said], kind) for k, kind in ((0, pa.string()), (1, pa.float64()))], names=["lang", "score"])

    known = has_letter(F.col(text))
    out = df.withColumn("_cw_said", of(F.col(text)))
    return out.withColumns({
        "lang_pred": F.when(known, F.col("_cw_said.lang")).otherwise("und"), "score": F.when(known, F.col("_cw_said.score")).otherwise(0.0),
        "rejected": ~known | (F.col("_cw_said.score") < model.reject_below),
    }).drop("_cw_said")


def op4_subword_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    said = identify(docs.select("doc_id", "text"), model)
    return said.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
