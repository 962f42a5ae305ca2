"""Ranked lexical search: best-first over document intervals that range-maximum tables of the posting lists bound.

Documents are counted once for the terms of the items (queries): term frequencies and lengths, from
which the corpus figures (documents, terms, document frequencies) follow. Every posting then has an
integer impact, its part of a document's score. Each task searches the documents it reads, in
blocks of about ``BLOCK`` postings, in order of their ids:

* A block's posting lists lie end to end, with one sparse table over them: for each place and power
  of two the place of the greatest impact from there on. So the greatest impact of a list within an
  interval of documents is two look-ups, and the sum over an item's lists bounds the scores in it.
* The intervals of greatest bounds are split at the document of their greatest single impact, into
  what is before it, itself, whose bound is its score, and what is after it.
* An interval is given up once its bound is below the score of the k-th document found so far (or
  equals it, and its first id comes later). That mark is kept from block to block, so results are
  those of scoring every document. Intervals of all items are split together, as arrays.

What the tasks find is merged to the first ``k`` of each item. Nothing is shuffled but those rows.
Items come in blocks of at most ``ITEMS`` items and ``TERMS`` terms (whole items), each of which
reads the documents anew; only a block's terms are shipped to the tasks.

Terms are runs of ASCII letters and digits and of anything beyond ASCII, A to Z in lower case. An
item is the set of terms of all rows of its id; items without an id or a term have no result.
Documents without an id rank after equals; rows that repeat an id are documents of their own.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import by_bytes, map_arrow, pick, saved

K = 50
BLOCK = 400_000
ITEMS = 4096
TERMS = 200_000
#: Of an item's intervals, so many are split in one step; and so many (interval, list) pairs are looked up at once.
STEP = 32
PAIRS = 1 << 18
_GAP = rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_TERM = re.compile(_GAP.replace(b"[", b"[^", 1) + b"+")
_END = re.compile(_GAP)
_PIECE = 1 << 20
_LAST = np.iinfo(np.int64).max


def term_counts(text: str | None) -> Counter:
    """How often each term (as UTF-8 bytes) occurs; long texts are taken in pieces."""
    raw, at, out = (text or "").encode().lower(), 0, Counter()  # bytes.lower() changes A to Z alone
    while at < len(raw):
        cut = _END.search(raw, at + _PIECE)
        z = cut.end() if cut else len(raw)
        out.update(_TERM.findall(raw[at:z]))
        at = z
    return out


class Postings:
    """The posting lists of one block, end to end, and their sparse table."""

    def __init__(self, docs: int, term: np.ndarray, rank: np.ndarray, impact: np.ndarray):
        """``term``, ``rank`` (a document's place in the block) and ``impact`` of each posting."""
        order = np.lexsort((rank, term))
        self.docs, self.rank, self.impact = docs, rank[order], impact[order]
        self.key = term[order].astype(np.int64) * docs + self.rank
        size = len(order)
        longest = int(np.unique(term, return_counts=True)[1].max()) if size else 0
        table = [np.arange(size, dtype=np.int32)]
        while 2 << len(table) - 1 <= longest:  # the next level covers two of the last one
            half, last = 1 << len(table) - 1, table[-1]
            nxt = last.copy()
            a, b = last[:-half], last[half:]
            nxt[:-half] = np.where(self.impact[a] >= self.impact[b], a, b)
            table.append(nxt)
        self.table = np.concatenate(table)
        self.size = size

    def most(self, of: np.ndarray, a: np.ndarray, b: np.ndarray, total: np.ndarray, split: np.ndarray) -> None:
        """Sets bound and split document of intervals, given the ranges ``[a, b)`` of their lists; ``of`` names the interval of each range, in order."""
        some = b > a
        of, a, b = of[some], a[some], b[some]
        if not len(of):
            return
        level = np.frexp(b - a)[1].astype(np.int64) - 1
        x, y = self.table[level * self.size + a], self.table[level * self.size + b - (1 << level)]
        best = np.where(self.impact[x] >= self.impact[y], x, y)
        v = self.impact[best]
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        total[of[first]] = np.add.reduceat(v, first)
        top = np.repeat(np.maximum.reduceat(v, first), np.diff(first, append=len(of)))
        greatest = np.flatnonzero(v == top)[::-1]
        split[of[greatest]] = self.rank[best[greatest]]  # of equal impacts the first list's

    def whole(self, term: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Bound and split document of all documents, for ``n`` items whose lists the pairs ``(of, term)`` name."""
        total, split = np.zeros(n, np.int64), np.zeros(n, np.int64)
        base = term * self.docs
        self.most(of, np.searchsorted(self.key, base), np.searchsorted(self.key, base + self.docs), total, split)
        return total, split

    def halves(self, term: np.ndarray, of: np.ndarray, lo: np.ndarray, d: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of intervals ``[lo, hi)`` the scores of their documents ``d``, and bounds and split documents before and after them."""
        score, *parts = (np.zeros(len(d), np.int64) for _ in range(5))
        base = term * self.docs
        a, b = np.searchsorted(self.key, base + lo[of]), np.searchsorted(self.key, base + hi[of])
        some = b > a
        a, b, of, at = a[some], b[some], of[some], (base + d[of])[some]
        p = np.searchsorted(self.key, at)
        hit = p < b
        hit[hit] = self.key[p[hit]] == at[hit]
        np.add.at(score, of[hit], self.impact[p[hit]])
        self.most(of, a, p, *parts[:2])
        self.most(of, p + hit, b, *parts[2:])
        return score, *parts


class Best:
    """The first ``k`` documents of each item so far: highest scores, of equals the least ids."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))
        self.mark, self.last = np.zeros(items, np.int64), np.full(items, _LAST)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        place = np.arange(len(item)) - np.repeat(first, np.diff(first, append=len(item)))
        keep = place < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        kth = place == self.k - 1
        self.mark[item[kth]], self.last[item[kth]] = score[kth], doc[kth]

    def open(self, item: np.ndarray, bound: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether documents from ``doc`` on with at most this score can still be among the first ``k``."""
        return (bound > self.mark[item]) | (bound == self.mark[item]) & (bound > 0) & (doc <= self.last[item])


def search_block(ids: np.ndarray, postings: Postings, lists: list[np.ndarray], best: Best) -> int:
    """Adds a block's documents (``ids``, ascending) to ``best``, given each item's terms; returns how many documents it scored."""
    size = np.array([len(x) for x in lists], np.int64)
    start, flat = np.cumsum(size) - size, np.concatenate([*lists, np.empty(0, np.int64)])

    def lists_of(item):
        """Pairs (place in ``item``, term) of all lists of the items, in order."""
        n = size[item]
        of = np.repeat(np.arange(len(item)), n)
        return flat[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[item], n)], of

    item = np.flatnonzero(size > 0)
    lo, hi = np.zeros(len(item), np.int64), np.full(len(item), len(ids), np.int64)
    bound, split = postings.whole(*lists_of(item), len(item))
    scored = 0
    while True:
        keep = best.open(item, bound, ids[lo])
        item, lo, hi, bound, split = (x[keep] for x in (item, lo, hi, bound, split))
        if not len(item):
            return scored
        order = np.lexsort((-bound, item))
        turn = item[order]
        first = np.flatnonzero(np.concatenate(([True], turn[1:] != turn[:-1])))
        now = np.zeros(len(item), bool)
        now[order] = np.arange(len(turn)) - np.repeat(first, np.diff(first, append=len(turn))) < STEP
        rest = ~now
        left = [[x[rest] for x in (item, lo, hi, bound, split)]]
        item, lo, hi, split = (x[now] for x in (item, lo, hi, split))
        cuts = np.searchsorted(np.cumsum(size[item]), np.arange(PAIRS, int(size[item].sum()), PAIRS), "right")
        for k in np.split(np.arange(len(item)), np.unique(cuts)):
            i, a, z, d = item[k], lo[k], hi[k], split[k]
            score, bl, sl, br, sr = postings.halves(*lists_of(i), a, d, z)
            best.add(i, score, ids[d])
            left += [[i, a, d, bl, sl], [i, d + 1, z, br, sr]]
        scored += len(item)
        item, lo, hi, bound, split = (np.concatenate(x) for x in zip(*left))
        some = lo < hi
        item, lo, hi, bound, split = (x[some] for x in (item, lo, hi, bound, split))


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """A posting's part of its document's score, in 64-bit integers."""
    m = 50 + 50 * n * documents // length
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def counted(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``doc, n, terms, tfs``: each document's terms in all, and those of the vocabulary (their numbers) with their counts."""
    def count(batches):
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                n, terms, tfs = [], [], []
                for t in batch.column("text").to_pylist():
                    c = term_counts(t)
                    here = sorted((vocabulary[w], c[w]) for w in (vocabulary if len(vocabulary) < len(c) else c) if w in vocabulary and w in c)
                    n.append(c.total())
                    terms.append([x for x, _ in here])
                    tfs.append([x for _, x in here])
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                                                 names=["doc", "n", "terms", "tfs"])

    d = pick(docs, doc=doc_id, text=text).select(F.col("doc").cast("long").alias("doc"), "text")
    return map_arrow(d, count, "doc long, n long, terms array<int>, tfs array<long>")


def _blocks(batches, block: int):
    """Counted documents -> ids, lengths, posting counts, terms and frequencies of about ``block`` postings, in order of ids."""
    held, size = [], 0
    for b in batches:
        for part in (b.slice(a, 1000) for a in range(0, b.num_rows, 1000)):
            held.append(part)
            size += len(part.column("terms").flatten()) + part.num_rows
            if size >= block:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(held):
    t = pa.Table.from_batches(held).combine_chunks()
    doc = t.column("doc").combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)
    t, doc = t.take(pa.array(np.argsort(doc, kind="stable"))), np.sort(doc)
    lists = t.column("terms").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    return doc, t.column("n").to_numpy(), size, lists.flatten().to_numpy(), t.column("tfs").combine_chunks().flatten().to_numpy()


def _searched(lists: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int, block: int):
    def run(batches):
        best = Best(len(lists), k)
        useful = [x[weights[x] > 0] for x in lists]
        for doc, n, size, term, tf in _blocks(batches, block):
            rank = np.repeat(np.arange(len(doc)), size)
            some = weights[term] > 0
            rank, term, tf = rank[some], term[some].astype(np.int64), tf[some]
            search_block(doc, Postings(len(doc), term, rank, impacts(weights[term], tf, n[rank], documents, length)), useful, best)
        for a in range(0, len(best.item), 10_000):
            i, s, d = (x[a:a + 10_000] for x in (best.item, best.score, best.doc))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(s), pa.array(d, mask=d == _LAST)], names=["item", "score", "doc"])
    return run


def item_blocks(items: DataFrame, item_id: str, text: str, most_items: int, most_terms: int):
    """The items with their terms, in id order, in blocks of bounded size."""
    kind = items.schema[item_id].dataType
    q = map_arrow(pick(items, item=item_id, text=text).where("item is not null and text is not null"), lambda bs: (
        pa.RecordBatch.from_arrays([b.column("item"), pa.array([sorted(term_counts(t)) for t in b.column("text").to_pylist()], pa.list_(pa.binary()))], names=["item", "terms"])
        for b in bs), f"item {kind.simpleString()}, terms array<binary>")
    q = q.groupBy("item").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).where(F.size("terms") > 0).orderBy("item")
    held, seen = [], set()
    for r in q.toLocalIterator():
        ts = [bytes(t) for t in r["terms"]]
        if held and (len(held) >= most_items or len(seen.union(ts)) > most_terms):
            yield held
            held, seen = [], set()
        held.append((r["item"], ts))
        seen.update(ts)
    if held:
        yield held


def ranked(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = K,
           block: int = BLOCK, most_items: int = ITEMS, most_terms: int = TERMS) -> DataFrame:
    """Rows ``item, rank, doc, score``: each item's ``k`` documents of highest scores above 0, equal scores by ascending id."""
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item {kind}, rank int, doc long, score long")
    for part in item_blocks(items, item_id, item_text, most_items, most_terms):
        vocabulary = {t: j for j, t in enumerate(sorted({t for _, ts in part for t in ts}))}
        c = saved(counted(docs, vocabulary, doc_id, text), "search-counts")
        documents, length = c.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            return out
        weights = np.full(len(vocabulary), weight(documents, 0), np.int64)
        for r in c.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[r["t"]] = weight(documents, r["count"])
        lists = [np.array(sorted(vocabulary[t] for t in ts), np.int64) for _, ts in part]
        found = map_arrow(c.where(F.size("terms") > 0), _searched(lists, weights, documents, length, k, block), "item long, score long, doc long")
        order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
        # first among salted parts of an item, so that no task holds what all tasks found for it
        near = found.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(32)))
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(part)], f"j long, name {kind}")
        rows = near.join(names, near["item"] == names["j"]).select(F.col("name").alias("item"), F.col("rank").cast("int").alias("rank"), "doc", "score")
        out = out.unionByName(rows)
    return out
