"""Byte-level BPE ids of whole texts.

Ids equal those of the ``tokenizers`` file with its default flags: its added tokens
are matched in a text before anything else and become their own id (the tests compare
every id). The vocabulary and the added tokens are read from the files named, where the
task runs, once a worker. Ordinary stretches go through the rank file of the same
vocabulary, as its encoder takes under a quarter of the CPU time.

Very long texts: that encoder's pattern matcher overflows its stack on white-space runs
of a million characters, so runs of ``LONG`` and more are split off by the pattern's own
rule: all of a run but the character before a word is one piece, and all of it where the
text ends or an added token starts. Added tokens hold no white space, so no run cuts one.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
END = 0
#: Characters of a white-space run that is split off.
LONG = 10_000


def long_run(least: int) -> re.Pattern:
    """White space as the pattern's matcher has it, ``least`` characters and more."""
    return re.compile(f"[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{{{least},}}")


LONG_RUN = long_run(LONG)


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str):
    import tiktoken
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path(vocabulary)).get_added_tokens_decoder()
    added = {t.content: i for i, t in tokens.items()}
    if any(re.search(r"\s", t.content) or t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens.values()):
        raise ValueError("an added token holds white space, or isn't matched as it stands")
    with open(public_tokenizers.path(ranks), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=added)


def document_ids(text: str | None, vocabulary: str = VOCABULARY, ranks: str = RANKS) -> np.ndarray:
    """Ids of the whole text, then the end id; a null text counts as empty."""
    text, coder, at = text or "", encoder(vocabulary, ranks), 0
    parts, added = [], coder.special_tokens_set
    starts = tuple(added)
    for run in LONG_RUN.finditer(text):
        end = run.end() - (run.end() < len(text) and not text.startswith(starts, run.end()))
        parts.append(coder.encode_to_numpy(text[at : run.start()], allowed_special=added))
        parts.append(coder._encode_single_piece(text[run.start() : end]))
        at = end
    parts += [coder.encode_to_numpy(text[at:], allowed_special=added), [END]]
    return np.concatenate(parts).astype("<u4")
