"""Newline-aligned chunking of text.

Rule (per piece, counting code points): if the rest of the text fits in
``max_chars`` it is the last piece. Otherwise look at the window of the next
``max_chars`` characters; if its last newline sits at 0-based offset > 200 the
piece ends just after that newline, else the piece is the full window. A text
no longer than ``max_chars`` (including ``""``) is a single piece.

Texts that need cutting go through an Arrow-batched Python function that searches
each window once from its end; all others never leave the JVM. (A Java regex for the
same rule recurses at every change between narrow and surrogate-pair characters and
overflows the thread's stack on long windows.)
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_CHARS = 12_000
# A newline must sit past this 0-based offset within the window to be a cut point.
MIN_NEWLINE_OFFSET = 200


def cut_points(text: str, max_chars: int) -> list[int]:
    """End offsets of the pieces of ``text``."""
    ends, at, n = [], 0, len(text)
    while n - at > max_chars:
        newline = text.rfind("\n", at + MIN_NEWLINE_OFFSET + 1, at + max_chars)
        at = newline + 1 if newline >= 0 else at + max_chars
        ends.append(at)
    if n > at or not ends:
        ends.append(n)
    return ends


def _checked(max_chars: int) -> int:
    from quire.session import ship_package

    if max_chars <= 0:
        raise ValueError(f"max_chars must be positive, got {max_chars}")
    ship_package()
    return int(max_chars)


def chunk_text(text: Column, max_chars: int = DEFAULT_MAX_CHARS) -> Column:
    """``array<string>`` of pieces whose concatenation is ``text``; null stays null."""
    m = _checked(max_chars)

    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            if t is None:
                out.append(None)
                continue
            ends = cut_points(t, m)
            out.append([t[a:z] for a, z in zip([0, *ends], ends)])
        return pd.Series(out, dtype="object")

    long = F.when(F.length(text) > m, text)
    return F.when(F.length(text) <= m, F.array(text)).otherwise(F.pandas_udf(cut, T.ArrayType(T.StringType()))(long))


def chunk_count(text: Column, max_chars: int = DEFAULT_MAX_CHARS) -> Column:
    """Number of pieces, counted without building them."""
    m = _checked(max_chars)

    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([0 if t is None else len(cut_points(t, m)) for t in texts], dtype="int32")

    long = F.when(F.length(text) > m, text)
    return F.when(F.length(text) <= m, F.lit(1)).when(F.length(text) > m, F.pandas_udf(count, T.IntegerType())(long))


def chunk_label(idx: Column, cnt: Column) -> Column:
    """``""`` for a single piece, else ``" (chunk i/n)"``."""
    return F.when(cnt == 1, F.lit("")).otherwise(F.format_string(" (chunk %d/%d)", idx, cnt))
