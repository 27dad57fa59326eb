"""Token counts of a unigram tokenizer, without its tokens.

The pieces and scores of a vocabulary file, taken as a unigram model, are put into an
Aho-Corasick automaton. It lists the pieces that end at each character; dynamic
programming keeps, for each end, the best sum of scores and how many pieces it has.
Ties go to the piece that starts first, as the tokenizer decides; a character that no
piece covers alone scores the least score minus 10 and counts its UTF-8 bytes.

No piece runs from a word into the next blank, so a text falls into stretches (blanks
and the word behind them) that are solved alone, and each distinct stretch only once
a worker: the scores are whole numbers, and their sums exact in any grouping.

Defined cases: a null or empty text has no tokens and score 0; repeated rows get equal
counts; an empty table gives an empty table; columns ``n_tokens`` and ``score`` of the
input are replaced.
"""

from __future__ import annotations

import re
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactweave.llm.common import table

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
PENALTY = 10.0
#: Stretches remembered a worker, and the longest that is.
KEPT, LONGEST = 1 << 19, 48
LONG = 1 << 20
STRETCH = re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+")


def vocabulary(model: str) -> list[tuple[str, float]]:
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    return [(pieces.id_to_piece(i), pieces.get_score(i)) for i in range(pieces.get_piece_size())]


def normal(text: str) -> str:
    """Blanks made visible, one put in front."""
    return BLANK + text.replace(" ", BLANK) if text else ""


class Counter:
    def __init__(self, model: str):
        import ahocorasick

        pieces = vocabulary(model)
        if any(re.search(f"[^{BLANK}]{BLANK}|.\n|\n.", p) for p, _ in pieces) or any(s != int(s) for _, s in pieces):
            raise ValueError("a piece runs over a blank, or a score is no whole number: texts can't be taken apart")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - PENALTY
        self.seen: dict[str, tuple[int, float]] = {}

    def solve(self, stretch: str) -> tuple[int, float]:
        best, count = [0.0], [0]
        found = self.automaton.iter(stretch)
        at, match = next(found, (len(stretch), None))
        for end, char in enumerate(stretch):
            top, n = None, 0
            while at == end:  # the longest, that is the first to start, comes first
                size, score = match
                total = best[end + 1 - size] + score
                if top is None or total > top:
                    top, n = total, count[end + 1 - size] + 1
                at, match = next(found, (len(stretch), None))
            if char not in self.single:
                total = best[end] + self.unknown
                if top is None or total > top:
                    top, n = total, count[end] + len(char.encode())
            best.append(top)
            count.append(n)
        return count[-1], best[-1]

    def text(self, text: str | None) -> tuple[int, float]:
        n, score = 0, 0.0
        seen = self.seen
        whole = normal(text or "")
        # A very long text's stretches are not listed all at once.
        for stretch in STRETCH.findall(whole) if len(whole) < LONG else (m.group() for m in STRETCH.finditer(whole)):
            got = seen.get(stretch)
            if got is None:
                got = self.solve(stretch)
                if len(stretch) <= LONGEST:
                    if len(seen) >= KEPT:
                        seen.clear()
                    seen[stretch] = got
            n += got[0]
            score += got[1]
        return n, score


@lru_cache(maxsize=2)
def counter(model: str) -> Counter:
    return Counter(model)


def count_tokens(df: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """``df`` with ``n_tokens`` and the best segmentation's ``score``."""

    @F.arrow_udf("struct<n: long, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        count = counter(model).text
        got = [count(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())], names=["n", "score"])

    return df.withColumn("_cw_said", of(F.col(text))).withColumns({"n_tokens": F.col("_cw_said.n"), "score": F.col("_cw_said.score")}).drop("_cw_said")


def op6_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "score")
