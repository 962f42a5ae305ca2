"""Mixing sources to target weights.

Each source's words are one stream, packed into blocks of a fixed number of words. Output
shards draw how many of their slots each source fills; a slot's ordinal within its source
goes through a pseudorandom permutation of the source's block indexes, and blocks join by
(source, index). A source drawn more often than it has blocks starts a new permutation.

The shards' draws are multinomial conditioned on the sources' totals (that is, multivariate
hypergeometric), so every source meets its target to within a block while each shard's
composition still varies as drawn. A shard finds its counts alone, by splitting the totals
down a binary tree of seeded draws: no shard waits for another and a rerun draws the same.

Null text and empty text have no words; a null source is a source of its own, last in
order; rows that repeat an id are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import by_bytes, map_arrow, pick, ready, saved

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
BUCKET_ROWS = 512
MAX_BUCKETS = 65_536
MAX_SOURCES = 100_000
SEED = 20_24
SLICE = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], cap: float = CAP) -> list[float]:
    """Words wanted of each source: shares of all sizes by weight, none above ``cap`` times its source."""
    out = [0.0] * len(sizes)
    left, free = float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = cap * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in set(over)]
    return out


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1 at the given places: a Feistel network, walked until it lands below n."""
    x = index.astype(np.uint64)
    if n <= 1:
        return x
    half = np.uint64((max(2, (n - 1).bit_length()) + 1) // 2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        hi, lo = x[todo] >> half, x[todo] & mask
        for r in range(4):
            salt = np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
            hi, lo = lo, hi ^ (_mix64(lo + salt) & mask)
        x[todo] = (hi << half) | lo
        todo = todo[x[todo] >= np.uint64(n)]
    return x


def _drawn(rng: np.random.Generator, counts: list[int], n: int) -> list[int]:
    """``n`` of the items of ``counts`` without replacement, by source."""
    out, rest = [], sum(counts)
    for c in counts:
        rest -= c
        if n <= 0 or c == 0:
            k = 0
        elif rest == 0:
            k = n
        elif c + rest < 10**9:
            k = int(rng.hypergeometric(c, rest, n))
        else:  # the generator's exact draw ends at 1e9 items; there the normal form is exact to far below a slot's share
            t = c + rest
            sd = math.sqrt(max(0.0, n * (c / t) * (rest / t) * (t - n) / (t - 1)))
            k = min(max(round(rng.normal(n * c / t, sd)), n - rest, 0), c, n)
        out.append(k)
        n -= k
    return out


def shard_draw(totals: list[int], shard: int, shards: int, shard_slots: int, seed: int) -> tuple[list[int], list[int]]:
    """Slots each source fills in ``shard``, and its slots in the shards before."""
    lo, hi, counts, before = 0, shards, list(totals), [0] * len(totals)
    slots = sum(totals)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = _drawn(rng, counts, min(mid * shard_slots, slots) - lo * shard_slots)
        if shard < mid:
            hi, counts = mid, left
        else:
            lo = mid
            before = [b + x for b, x in zip(before, left)]
            counts = [c - x for c, x in zip(counts, left)]
    return counts, before


class Mix:
    """A planned mix of ``docs``; see the module's text.

    ``sources``: one dict per source (name, size, target, blocks, draws), in source order.
    The source table lives on the driver: at most ``MAX_SOURCES`` rows, else an error.
    """

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                 weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, block_words: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, seed: int = SEED):
        if block_words < 1 or shard_slots < 1 or not weights or min(weights) <= 0:
            raise ValueError("block_words and shard_slots must be positive, and so must the weights")
        self.spark, self.block_words, self.shard_slots, self.seed = docs.sparkSession, block_words, shard_slots, seed
        d = ready(pick(docs, doc_id=doc_id, text=text, source=source))
        self.rows = saved(
            d.select("doc_id", F.col("source").alias("name"), F.xxhash64("text").alias("th"),
                     F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                     F.monotonically_increasing_id().alias("row")),
            "mix-sizes",
        )
        per = self.rows.groupBy("name").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
        if len(per) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        per.sort(key=lambda r: (r["name"] is None, r["name"] or ""))
        w = [float(weights[i % len(weights)]) for i in range(len(per))]
        t = targets([r["size"] for r in per], w, cap)
        self.n_rows = sum(r["n"] for r in per)
        self.sources = []
        for i, r in enumerate(per):
            blocks = -(-r["size"] // block_words)
            draws = min(round(t[i] * blocks / r["size"]), math.ceil(cap * blocks)) if r["size"] else 0
            self.sources.append({"src": i, "name": r["name"], "size": r["size"], "target": t[i], "blocks": blocks, "draws": draws})

    def source_table(self) -> DataFrame:
        """The sources as rows ``src, name, source_size, target``."""
        rows = [(s["src"], s["name"], int(s["size"]), float(s["target"])) for s in self.sources]
        return self.spark.createDataFrame(rows, "src int, name string, source_size long, target double")

    def placed(self) -> DataFrame:
        """Every row with its source and the offset of its first word in the source's stream.

        Offsets are prefix sums in two levels: within hash buckets of about ``BUCKET_ROWS`` rows
        (so a hot source is many groups), and over the buckets' totals, at most ``MAX_BUCKETS`` a source.
        """
        buckets = min(MAX_BUCKETS, 1 << max(0, (self.n_rows // BUCKET_ROWS).bit_length()))
        src = F.broadcast(self.source_table())  # at most MAX_SOURCES rows
        r = self.rows.join(src, self.rows["name"].eqNullSafe(src["name"])).select(
            "src", "doc_id", "th", "size", "row", "source_size", "target",
            F.pmod(F.xxhash64("doc_id", "th"), F.lit(buckets)).alias("bucket"))  # many rows may share an id, or have none
        total = r.groupBy("src", "bucket").agg(F.sum("size").alias("z"))
        at = total.select("src", "bucket", (F.sum("z").over(Window.partitionBy("src").orderBy("bucket")) - F.col("z")).alias("at"))
        w = Window.partitionBy("src", "bucket").orderBy("doc_id", "size", "th", "row").rowsBetween(Window.unboundedPreceding, 0)
        within = r.withColumn("upto", F.sum("size").over(w))
        return within.join(at, ["src", "bucket"]).withColumn("start", F.col("at") + F.col("upto") - F.col("size")).drop("at", "upto", "bucket")

    def pieces(self, placed: DataFrame) -> DataFrame:
        """The packed blocks: rows ``src, block, row, doc_id, from_word, words``, a row per document part of a block."""
        b = F.lit(self.block_words)
        first, last = F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b)
        p = placed.where("size > 0").select("src", "doc_id", "th", "row", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        a = F.greatest(F.col("block") * b, F.col("start"))
        z = F.least((F.col("block") + 1) * b, F.col("start") + F.col("size"))
        return p.select("src", "block", "row", "doc_id", "th", (a - F.col("start")).alias("from_word"), (z - a).alias("words"))

    def slots(self) -> DataFrame:
        """The output order: rows ``shard, slot, src, epoch, block``; ``epoch`` counts the passes over a source."""
        totals, blocks = [s["draws"] for s in self.sources], [s["blocks"] for s in self.sources]
        n, seed, size = sum(totals), self.seed, self.shard_slots
        shards = -(-n // size)

        def fill(batches):
            for batch in batches:
                for shard in batch["id"]:
                    counts, before = shard_draw(totals, int(shard), shards, size, seed)
                    src = np.repeat(np.arange(len(counts)), counts)
                    epoch, block = np.empty(len(src), np.int64), np.empty(len(src), np.int64)
                    at = 0
                    for i, c in enumerate(counts):
                        k = np.arange(before[i], before[i] + c, dtype=np.int64)
                        e = k // max(1, blocks[i])
                        for one in np.unique(e):
                            here = np.flatnonzero(e == one)
                            epoch[at + here] = one
                            block[at + here] = permuted(k[here] % blocks[i], blocks[i], (seed << 40) + (i << 20) + int(one)).astype(np.int64)
                        at += c
                    order = np.random.default_rng([seed, 1, int(shard)]).permutation(len(src))
                    yield pd.DataFrame({"shard": int(shard), "slot": np.arange(len(src)), "src": src[order].astype(np.int32),
                                        "epoch": epoch[order], "block": block[order]})

        ids = self.spark.range(0, shards, 1, max(1, min(shards, 2000)))
        return ids.mapInPandas(fill, "shard long, slot long, src int, epoch long, block long")

    def mixture(self) -> DataFrame:
        """The mix itself: a row per slot and document part, ``shard, slot, src, epoch, block, doc_id, row, from_word, words``."""
        return self.slots().hint("merge").join(self.pieces(self.placed()).hint("merge"), ["src", "block"])

    def taken(self) -> DataFrame:
        """Rows ``row, doc_id, src, size, source_size, target, taken``: the words of each row that the mix takes, repeats counted."""
        placed = self.placed()
        # generated from a handful of shard numbers, the slots look small to the planner: no broadcast
        draws = self.slots().groupBy("src", "block").agg(F.count("*").alias("draws")).hint("merge")
        got = self.pieces(placed).join(draws, ["src", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("draws")).alias("taken"))
        return placed.join(got, "row", "left").select(
            "row", "doc_id", "src", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def documents(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
        """``docs`` as the mix takes them, with its own columns: each row's text is its taken words, pass after pass,
        white space kept; rows of which nothing is taken go. Rows equal in id and text are interchangeable."""
        parts = self.mixture().groupBy("row", "doc_id", "th").agg(
            F.sort_array(F.collect_list(F.struct("epoch", "from_word", "words"))).alias("parts"))  # a document's own blocks, at most cap times
        same = Window.partitionBy("id", "th").orderBy("row")
        p = parts.withColumnsRenamed({"doc_id": "id"}).withColumn("k", F.row_number().over(same)).select(
            F.col("id").alias("pid"), F.col("th").alias("pth"), F.col("k").alias("pk"), "parts")
        names = [f"c{k}" for k in range(len(docs.columns))]  # the caller's names stay out of the join
        i, t = (names[docs.columns.index(c)] for c in (doc_id, text))
        d = docs.toDF(*names).withColumn("th", F.xxhash64(t))
        d = d.withColumn("k", F.row_number().over(Window.partitionBy(i, "th").orderBy(F.lit(0))))
        j = d.join(p, F.col(i).eqNullSafe(F.col("pid")) & (F.col("th") == F.col("pth")) & (F.col("k") == F.col("pk"))).select(*names, "parts")
        at, count = docs.columns.index(text), docs.columns.index(n_chars) if n_chars in docs.columns else None
        out = docs.columns

        def cut(batches):
            for batch in batches:
                for part in by_bytes(batch, names[at], SLICE):
                    columns = [part.column(c) for c in names]
                    texts = [cut_words(x or "", [(y["epoch"], y["from_word"], y["words"]) for y in ps])
                             for x, ps in zip(columns[at].to_pylist(), part.column("parts").to_pylist())]
                    columns[at] = pa.array(texts, columns[at].type)
                    if count is not None:
                        columns[count] = pa.array([len(x) for x in texts], columns[count].type)
                    yield pa.RecordBatch.from_arrays(columns, names=out)

        return map_arrow(j, cut, docs.schema)


_WORD = re.compile(WORD)


def cut_words(text: str, parts: list) -> str:
    """The words ``[from, from + n)`` of each part, joined; a word carries the white space after it."""
    starts = [m.start() for m in _WORD.finditer(text)]
    if not starts:
        return ""
    starts[0] = 0
    starts.append(len(text))
    out, end = [], None
    for epoch, a, n in parts:
        if out and end != (epoch, a) and not out[-1][-1:].isspace():
            out.append("\n")  # a seam between places that do not follow each other
        out.append(text[starts[a]:starts[a + n]])
        end = (epoch, a + n)
    return "".join(out)
