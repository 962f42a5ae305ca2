"""Token counts from an exact histogram of encoded lengths.

Each text is encoded with a byte-level vocabulary; documents are counted by length. Everything
else comes from the histogram: for every context limit the documents and tokens at or below
it, the documents cut by it, the tokens left after truncation, and quantiles of length. The
histogram has a row per length that occurs; its suffix sums run in two levels (within blocks of
``BLOCK`` lengths, and over the blocks' totals), so no task sees more than a block.

Null and empty texts have no token. An empty table has an empty histogram. Rows that repeat
an id are documents each.
"""

from __future__ import annotations

import base64

import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import col, ready

#: Splits a text before its merges; a property of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 200_000
BLOCK = 1024


class Counter(dict):
    """Tokens of a split part, kept for a bounded number of parts."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        super().__init__()
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("quire", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.parts = regex.compile(pattern).findall

    def __missing__(self, part: str) -> int:
        n = len(self.encoding.encode_ordinary(part))
        if len(part) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[part] = n
        return n

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.parts(text))) if text else 0


_COUNTERS: dict[int, Counter] = {}


def _counter(ranks: bytes) -> Counter:
    key = hash(ranks)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(ranks)
    return _COUNTERS[key]


def with_tokens(docs: DataFrame, ranks: bytes, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text. ``ranks``: the vocabulary file's bytes."""
    ready(docs)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        c = _counter(ranks)
        return pd.Series([c.count(t) for t in texts], dtype="int64")

    return docs.withColumn(out, count(col(text)))


def histogram(docs: DataFrame, ranks: bytes, text: str = "text") -> DataFrame:
    """Rows ``length, docs``: how many texts have each encoded length."""
    return with_tokens(docs.select(col(text).alias("text")), ranks).groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("docs"))


def _running(hist: DataFrame, columns: list[str], block: int) -> DataFrame:
    """``hist`` with ``upto_<c>``: sums of each column over this and all smaller lengths."""
    h = hist.withColumn("block", F.floor(F.col("length") / block))
    totals = h.groupBy("block").agg(*(F.sum(c).alias(c) for c in columns))
    # blocks are numbered by length: even lengths of 10^9 tokens make a million small rows
    before = totals.select("block", *((F.sum(c).over(Window.orderBy("block")) - F.col(c)).alias(f"before_{c}") for c in columns))
    w = Window.partitionBy("block").orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    h = h.select("*", *(F.sum(c).over(w).alias(f"in_{c}") for c in columns)).join(before, "block")
    return h.select(*hist.columns, *((F.col(f"in_{c}") + F.col(f"before_{c}")).alias(f"upto_{c}") for c in columns))


def limits(hist: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every context limit that occurs as a length: rows ``length, docs, docs_within, tokens_within, docs_cut,
    tokens_left, share_within``. ``tokens_left`` is the total when every text is truncated to ``length``."""
    h = hist.where("docs > 0").select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"))
    all_ = h.agg(F.sum("docs").alias("all_docs"))
    r = _running(h, ["docs", "tokens"], block).crossJoin(F.broadcast(all_))  # one row
    return r.select(
        "length", "docs", F.col("upto_docs").alias("docs_within"), F.col("upto_tokens").alias("tokens_within"),
        (F.col("all_docs") - F.col("upto_docs")).alias("docs_cut"),
        (F.col("upto_tokens") + F.col("length") * (F.col("all_docs") - F.col("upto_docs"))).alias("tokens_left"),
        (F.col("upto_docs") / F.col("all_docs")).alias("share_within"))


def truncated_totals(hist: DataFrame, contexts: list[int], block: int = BLOCK) -> DataFrame:
    """The same totals for any given context limits, whether or not a text has that length."""
    spark = hist.sparkSession
    want = spark.createDataFrame([(int(c),) for c in contexts], "context long")
    t = limits(hist, block)
    # the greatest length up to each limit answers for it; the list of limits is the caller's, and short
    near = F.broadcast(want).join(t, F.col("length") <= F.col("context"), "left").groupBy("context").agg(F.max_by(
        F.struct("docs_within", "tokens_within"), "length").alias("x"))
    n = hist.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n"))
    r = near.crossJoin(F.broadcast(n)).select("context", "n", F.coalesce("x.docs_within", F.lit(0)).alias("docs_within"),
                                              F.coalesce("x.tokens_within", F.lit(0)).alias("tokens_within"))
    return r.select("context", "docs_within", "tokens_within", (F.col("n") - F.col("docs_within")).alias("docs_cut"),
                    (F.col("tokens_within") + F.col("context") * (F.col("n") - F.col("docs_within"))).alias("tokens_left"))


def quantiles(hist: DataFrame, shares: list[float], block: int = BLOCK) -> DataFrame:
    """The least length that at least each share of the documents does not exceed: rows ``share, length``."""
    if any(not 0 <= q <= 1 for q in shares):
        raise ValueError("shares lie between 0 and 1")
    t = limits(hist, block)
    return t.agg(*(F.min(F.when(F.col("share_within") >= q, F.col("length"))).alias(str(i)) for i, q in enumerate(shares))).select(
        F.explode(F.array(*(F.struct(F.lit(float(q)).alias("share"), F.col(f"`{i}`").alias("length")) for i, q in enumerate(shares)))).alias("r")
    ).select("r.*")
