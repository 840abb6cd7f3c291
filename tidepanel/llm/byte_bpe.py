"""Byte-level BPE: texts to ids and back to bytes, with the tiktoken library and a local rank file.

The rank file's path must lead to the same file on every executor.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField

from tidepanel.llm.common import with_arrow_columns

#: characters after which a long text is cut at the next safe boundary
STRETCH = 1 << 16

#: No match of a pattern in the GPT-2 style has a letter or digit followed by white space inside it,
#: and none looks back, so a text may be cut there: both sides split as the whole text does.
SAFE = re.compile(r"(?<=[^\W_])(?=[ \n])")

#: White space of so many characters or more is encoded by itself: the pattern takes all but the last character of a
#: run as one match (all of it at the end of a text), and matching a run of a million would exhaust the library's stack.
RUN = 1 << 12
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, least: int = STRETCH) -> Iterator[str]:
    """The text in parts of at least ``least`` characters, cut at safe boundaries only. A run without
    such a boundary stays whole."""
    start = 0
    while len(text) - start > least and (cut := SAFE.search(text, start + least)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(codec: tiktoken.Encoding, text: str | None) -> list[int]:
    if not text:
        return []
    if len(text) <= STRETCH:
        return codec.encode_ordinary(text)
    ids, at = [], 0
    for run in SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += chain.from_iterable(codec.encode_ordinary(s) for s in stretches(text[at : run.start()]))
        ids += codec._encode_single_piece(text[run.start() : end])
        at = end
    return [*ids, *chain.from_iterable(codec.encode_ordinary(s) for s in stretches(text[at:]))]


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each text. NULL and empty texts have none; strings of special
    tokens are ordinary text; rows may repeat; a column named ``ids`` is replaced."""

    def make():
        codec = encoding(rank_file, pattern)

        def compute(texts: list) -> list[pa.Array]:
            parts = [np.asarray(encode_text(codec, t), dtype=np.int32) for t in texts]
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
            return [pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int32), *parts]))]

        return compute

    return with_arrow_columns(df, text, [StructField(ids, ArrayType(IntegerType()))], make)


def decode(df: DataFrame, rank_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the raw bytes of each id list. The bytes need not be valid UTF-8 (a list may
    end inside a character). NULL lists give no bytes; NULL ids are an error."""

    def make():
        codec = encoding(rank_file, pattern)
        return lambda lists: [pa.array([codec.decode_bytes(x) if x else b"" for x in lists], pa.binary())]

    return with_arrow_columns(df, ids, [StructField(out, BinaryType())], make)
