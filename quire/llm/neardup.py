"""Near-duplicate documents: MinHash signatures by dart throwing, banded into links.

A document is the set of its five-word shingles, each of weight 1 however often it occurs, so
that signatures estimate the Jaccard index that is checked. Every unit of an element's weight is a region with its own hashed stream of darts: a dart has a
rank (the streams' arrival times), a place within the unit of weight, and one of ``COORDS``
coordinates. Darts beyond a shingle's weight miss. The signature keeps each coordinate's
earliest dart, so a text of n shingles throws about k ln k + 2k darts in all instead of n k.

Exact copies are one text from the start. Bands of signature rows give buckets. Pairs whose
signatures agree enough (a byte of each coordinate's dart tells) are checked on their whole
shingle sets (Jaccard at least ``SIMILARITY``), and linked texts become one class:

1. For up to ``ROUNDS`` rounds each text meets texts that its bucket picks, the leaders: one in
   the first round, of least hash over all its buckets, so that buckets of the same texts pick
   the same; later ``LEADERS``, from the largest classes there, which only texts of classes no
   larger meet. So a bucket of thousands of near copies becomes one class at few rows, and what
   has joined it meets nobody any more.
2. In buckets that still hold several classes, every pair of texts of different classes is
   compared. Members are dealt into blocks of ``BLOCK``, the bucket's first class apart from the
   rest, as its texts need not meet each other; a task compares two blocks. A pair counts in its
   first common bucket only. Blocks first tell which members have a partner by signature; only
   those meet again with their shingle sets, and only links that join classes leave the task.

So all pairs that share a bucket are compared, or in one class already.

Null and blank texts hold no shingle and are alone, unless equal; texts of fewer than five
words are one shingle. Rows that repeat an id are one document: all texts of an id are in its
class. Words are runs between white space, case kept.

Workers take texts in slices of bounded bytes, long texts piece by piece and their darts
``STREAMS`` shingles at a time.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import by_bytes, components, dropped, map_arrow, pick, saved

SHINGLE = 5
SIMILARITY = 0.8
COORDS = 120
BAND_ROWS = 5
LEADERS = 4
ROUNDS = 3  # of leaders; what they leave is compared in full
STREAMS = 1 << 17
SLICE = 1 << 20
PIECE = 1 << 20
BLOCK = 1024
SLACK = 0.16  # below the threshold, over four standard errors of an estimate from COORDS coordinates
CACHE = 100_000
_M = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(r"\s")


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words, kept for a bounded number of them."""

    def __missing__(self, w: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


def shingles(text: str | None, words: dict) -> np.ndarray:
    """Hashes of the five-word shingles of a text, in order, repeats kept."""
    text, hs, at = text or "", [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE) if len(text) - at > PIECE else None
        z = cut.start() if cut else len(text)
        hs.append(np.array([words[w] for w in text[at:z].split()], np.uint64))
        at = z
    h = np.concatenate(hs) if hs else np.empty(0, np.uint64)
    if not len(h):
        return h
    n = max(1, len(h) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(SHINGLE, len(h))):
            out = _mix(out * _M + h[i:i + n] + np.uint64(i + 1))
    return out


def _darts(element: np.ndarray, cell: np.ndarray, room: np.ndarray, owner: np.ndarray, limit: np.ndarray, coords: int):
    """The darts of these units of weight up to their documents' limits: coordinate (of the owner), rank and id."""
    with np.errstate(over="ignore"):
        state = _mix(element + np.uint64(0xA0761D6478BD642F) * (cell.astype(np.uint64) + np.uint64(1)))
        time = np.zeros(len(state))
        found = []
        while len(state):
            state = _mix(state + _M)
            time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            live = time <= limit[owner]
            state, time, owner, room = state[live], time[live], owner[live], room[live]
            spot = _mix(state ^ np.uint64(0xD1B54A32D192ED03))
            hit = ((spot >> np.uint64(11)).astype(np.float64) * 2.0**-53) < room
            c = (_mix(spot) % np.uint64(coords)).astype(np.int64)
            found.append(((owner * coords + c)[hit], time[hit], (state[hit] >> np.uint64(32)).astype(np.uint32)))
    return found


def signatures(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, docs: int, coords: int = COORDS) -> np.ndarray:
    """Weighted MinHash of ``docs`` sets given flat: a 32-bit dart id per coordinate, row by row."""
    sig = np.zeros((docs, coords), np.uint32)
    if not len(element):
        return sig
    total = np.bincount(doc, weights=weight, minlength=docs)
    limit = (math.log(coords) + 2.0) * coords / np.maximum(total, 1e-9)
    todo = total > 0
    while todo.any():
        # darts of all units of weight of the documents that are not settled yet, up to their limits
        mine = np.flatnonzero(todo[doc] & (weight > 0))
        ends = np.cumsum(np.ceil(weight[mine]).astype(np.int64))
        found = []
        for a in range(0, int(ends[-1]), STREAMS):
            unit = np.arange(a, min(a + STREAMS, int(ends[-1])))
            of = np.searchsorted(ends, unit, "right")
            cell = unit - np.where(of > 0, ends[of - 1], 0)
            of = mine[of]
            found += _darts(element[of], cell, np.minimum(1.0, weight[of] - cell), doc[of], limit, coords)
        at, rank, ident = map(np.concatenate, zip(*found))
        order = np.lexsort((ident, rank, at))
        at, rank, ident = at[order], rank[order], ident[order]
        first = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.empty(0, bool)
        sig.reshape(-1)[at[first]] = ident[first]
        # a document is settled when each coordinate has a dart within the limit, which all streams have passed
        todo &= np.bincount(at[first] // coords, minlength=docs) < coords
        limit = np.where(todo, limit * 1.5, limit)
    return sig


def bands_of(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit hash of each band of ``rows`` coordinates, the band's number in it."""
    n = sig.shape[1] // rows
    h = np.zeros((len(sig), n), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            h = _mix(h * _M + sig[:, r * n:(r + 1) * n])
        return _mix(h + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _sketch(coords: int, rows: int):
    """Texts -> a byte of each signature coordinate, and the band hashes; none for texts without a shingle."""
    def sketch(batches):
        words = _Words()
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE):
                es = [np.unique(shingles(t, words)) for t in part.column("text").to_pylist()]
                size = np.array([len(e) for e in es])
                flat = np.concatenate(es)
                sig = signatures(flat, np.ones(len(flat)), np.repeat(np.arange(len(es)), size), len(es), coords)
                bands = bands_of(sig, rows)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "h1", "h2")),
                     pa.array([s.astype(np.uint8).tobytes() if n else b"" for s, n in zip(sig, size)], pa.binary()),
                     pa.array([b if n else b[:0] for b, n in zip(bands, size)], pa.list_(pa.int64()))],
                    names=["id", "h1", "h2", "sig", "bands"])
    return sketch


def _groups(batches, columns: list[str]):
    """Rows sorted by ``key`` -> the columns of one key after the other, as lists."""
    last, held = None, [[] for _ in columns]
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        values = [batch.column(c).to_pylist() for c in columns]
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for x, z in zip(cuts, cuts[1:]):
            if held[0] and keys[x] != last:
                yield last, held
                held = [[] for _ in columns]
            last = keys[x]
            for h, v in zip(held, values):
                h += v[x:z]
    if held[0]:
        yield last, held


def _partners(no: int, side: list, cls: list, sig: list, bands: list, least: float):
    """Of the texts of one pair of blocks, each with its partners: later in order, of another class, near by signature, first met in band ``no``.

    Sides are 0 and 1 for two blocks, whose texts meet across only, and 2 for a block with itself.
    """
    n = len(cls)
    side, cls = np.array(side), np.array(cls)
    s = np.frombuffer(b"".join(sig), np.uint8).reshape(n, -1)
    b = np.array(bands, np.int64).reshape(n, -1)
    need = math.ceil(least * s.shape[1] - 1e-9)
    for i in range(n):
        if side[i] == 1:
            continue
        others = np.flatnonzero((cls != cls[i]) & (side == 1)) if side[i] == 0 else i + 1 + np.flatnonzero(cls[i + 1:] != cls[i])
        others = others[(s[others] == s[i]).sum(1) >= need]
        others = others[~(b[others, :no] == b[i, :no]).any(1)]
        if len(others):
            yield i, others


def _near_members(least: float):
    """Pairs of blocks -> their members that have a partner by signature."""
    names = ["no", "side", "rep", "class", "sig", "bands"]

    def near(batches):
        for key, (no, side, rep, cls, sig, bands) in _groups(batches, names):
            hit = np.zeros(len(rep), bool)
            for i, others in _partners(no[0], side, cls, sig, bands, least):
                hit[i] = True
                hit[others] = True
            at = np.flatnonzero(hit).tolist()
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(at), pa.int64()), pa.array([no[k] for k in at], pa.int32()), pa.array([side[k] for k in at], pa.int32()),
                     pa.array([rep[k] for k in at], pa.int64()), pa.array([cls[k] for k in at], pa.int64()),
                     pa.array([sig[k] for k in at], pa.binary()), pa.array([bands[k] for k in at], pa.list_(pa.int64()))],
                    names=["key", *names])
    return near


def _block_links(similarity: float, least: float):
    """Near members of pairs of blocks, with their shingle sets -> links; of links between the same classes enough to join them."""
    def links(batches):
        for _, (no, side, rep, cls, sig, bands, sets) in _groups(batches, ["no", "side", "rep", "class", "sig", "bands", "s"]):
            sets = [np.frombuffer(x, np.uint64) for x in sets]
            size = np.array([len(x) for x in sets])
            words, flat = np.unique(np.concatenate(sets), return_inverse=True)
            start = np.cumsum(size) - size
            root = {c: c for c in cls}

            def find(c):
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            mark = np.zeros(len(words), bool)
            out = []
            for i, others in _partners(no[0], side, cls, sig, bands, least):
                mine = flat[start[i]:start[i] + size[i]]
                mark[mine] = True
                for k in others.tolist():
                    u, v = find(cls[i]), find(cls[k])
                    if u == v:
                        continue
                    both = int(np.count_nonzero(mark[flat[start[k]:start[k] + size[k]]]))
                    if both / max(1, size[i] + size[k] - both) >= similarity:
                        root[u] = v
                        out.append((rep[i], rep[k]))
                mark[mine] = False
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([min(x) for x in out], pa.int64()), pa.array([max(x) for x in out], pa.int64())], names=["a", "b"])
    return links


def _rest_links(m: DataFrame, sig: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """Links between different classes in the mixed buckets ``m`` (band, rep, class): all pairs there are compared."""
    # the bucket's first class is the one of most members
    size = m.groupBy("band", "class").agg(F.count("*").alias("n"))
    main = size.groupBy("band").agg(F.max(F.struct("n", "class")).alias("x"), F.sum("n").alias("all")).select(
        "band", F.col("x.class").alias("main"), F.ceil(F.col("x.n") / block).cast("int").alias("mb"),
        F.ceil((F.col("all") - F.col("x.n")) / block).cast("int").alias("rb"))
    x = m.join(main, "band").withColumn("first", F.col("class") == F.col("main")).withColumn(
        "at", F.pmod(F.xxhash64(F.lit(11), "rep"), F.when(F.col("first"), F.col("mb")).otherwise(F.col("rb"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    task = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))
    at = F.col("at")
    across = F.transform(upto(F.col("rb")), lambda i: task(0, i, at, F.lit(1)))
    rest = F.transform(upto(F.col("rb")), lambda j: task(
        1, F.least(at, j), F.greatest(at, j), F.when(at == j, 2).when(at < j, 0).otherwise(1)))
    to_main = F.transform(upto(F.col("mb")), lambda j: task(0, at, j, F.lit(0)))
    x = x.select("band", "rep", "class", F.explode(F.when(F.col("first"), across).otherwise(F.concat(rest, to_main))).alias("t"))
    x = x.select(F.xxhash64("band", "t.kind", "t.i", "t.j").alias("key"), "band", "t.side", "rep", "class")
    x = x.join(sig, "rep").select("key", (F.array_position("bands", F.col("band")) - 1).cast("int").alias("no"), "side", "rep", "class", "sig", "bands")
    kind = "key long, no int, side int, rep long, class long, sig binary, bands array<long>"
    near = saved(x.repartition("key").sortWithinPartitions("key").mapInArrow(_near_members(similarity - SLACK), kind), "dup-near")
    return near.join(sets, "rep").select("key", "no", "side", "rep", "class", "sig", "bands", "s").repartition("key").sortWithinPartitions("key").mapInArrow(
        _block_links(similarity, similarity - SLACK), "a long, b long")


@F.pandas_udf(T.DoubleType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([float((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).mean()) for x, y in zip(a, b)])


def _shingle_sets(batches):
    """Texts -> their sorted 64-bit shingle hashes."""
    words = _Words()
    for batch in batches:
        for part in by_bytes(batch, "text", SLICE):
            sets = [np.unique(shingles(t, words)).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())], names=["rep", "s"])


@F.pandas_udf(T.DoubleType())
def _jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(both / max(1, len(x) + len(y) - both))
    return pd.Series(out)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
            coords: int = COORDS, band_rows: int = BAND_ROWS, leaders: int = LEADERS, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """Rows ``id, class``, one per input row: every id with the least id of its near-duplicate class.

    Ids must be integers; rows without an id are left out.
    """
    d = pick(docs, id=doc_id, text=text).where("id is not null").select(
        F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), "text")
    # all texts are sketched where they are read; copies meet as sketches, never as texts
    every = saved(map_arrow(d, _sketch(coords, band_rows), "id long, h1 long, h2 long, sig binary, bands array<long>"), "dup-sketches")
    # a number for each different text, fixed as it is written
    texts = saved(every.groupBy("h1", "h2").agg(F.min("id").alias("least")).withColumn("rep", F.monotonically_increasing_id()), "dup-texts")
    row = saved(every.select("id", "h1", "h2").join(texts, ["h1", "h2"]).select("id", "rep"), "dup-rows")
    first = texts.select("rep", "h1", "h2", F.col("least").alias("id"))
    sig = saved(every.where(F.octet_length("sig") > 0).join(first, ["h1", "h2", "id"]).select("rep", "sig", "bands").dropDuplicates(["rep"]), "dup-sigs")
    dropped(every)
    bands = sig.select("rep", F.explode("bands").alias("band"))
    crowded = bands.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("band")
    member = saved(bands.join(crowded, "band", "left_semi"), "dup-bands")
    wanted = first.join(member.select("rep").distinct(), "rep", "left_semi")
    sets = saved(map_arrow(d.join(wanted, ["h1", "h2", "id"]).select("rep", "text").dropDuplicates(["rep"]), _shingle_sets, "rep long, s binary"), "dup-sets")
    # texts of one id are in one class
    several = row.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("id", "lo")
    links = saved(row.join(several, "id").where(F.col("rep") != F.col("lo")).select(F.col("lo").alias("a"), F.col("rep").alias("b")).distinct(), "dup-links")
    of = None if links.isEmpty() else _sized(links)
    m = member.select("band", "rep", F.col("rep").alias("class"), F.lit(1).cast("long").alias("n"))
    for turn in range(rounds + 1):
        if of is not None:
            m = member.join(of, "rep", "left").select("band", "rep", F.coalesce("class", "rep").alias("class"), F.coalesce("n", F.lit(1)).alias("n"))
            mixed = m.groupBy("band").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("band")
            m = saved(m.join(mixed, "band", "left_semi"), "dup-mixed")
        if turn == rounds:
            break
        # each of so many slots of a bucket picks the text of greatest hash in its largest class
        h = F.xxhash64(F.lit(turn), "rep")
        slot = F.pmod(F.shiftright(h, 20), F.lit(leaders if turn else 1))
        lead = m.groupBy("band", slot.alias("slot")).agg(F.max(F.struct("n", h.alias("h"), F.col("rep").alias("leader"), F.col("class").alias("lclass"))).alias("x"))
        pairs = m.join(lead.select("band", "x.leader", "x.lclass", F.col("x.n").alias("ln")), "band").where(
            (F.col("class") != F.col("lclass")) & (F.col("n") <= F.col("ln"))).select(
            F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
        near = pairs.join(sig.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a").join(
            sig.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").where(_agreement("sa", "sb") >= similarity - SLACK).select("a", "b")
        found = saved(near.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("xa")), "a").join(
            sets.select(F.col("rep").alias("b"), F.col("s").alias("xb")), "b").where(_jaccard("xa", "xb") >= similarity).select("a", "b"), "dup-links")
        if found.isEmpty():
            break
        if of is not None:
            dropped(m)
        links = links.unionByName(found)
        of = _sized(links)
    found = saved(_rest_links(m, sig, sets, similarity, block), "dup-links")
    dropped(member, sig, sets, *([] if of is None else [m]))
    if not found.isEmpty():
        of = _sized(links.unionByName(found))
    if of is None:
        return row.join(texts.select("rep", "least"), "rep").select("id", F.col("least").alias("class"))
    # a class is named by the least id of its texts
    named = texts.select("rep", "least").join(of.select("rep", "class"), "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    least = named.groupBy("class").agg(F.min("least").alias("name"))
    return row.join(named.select("rep", "class"), "rep").join(least, "class").select("id", F.col("name").alias("class"))


def _sized(links: DataFrame) -> DataFrame:
    """Rows ``rep, class, n``: the components of the links, with the texts in each."""
    return saved(components(links, "dup-cc").toDF("rep", "class", "n"), "dup-classes")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row per class: the row of the least id (of rows that repeat that id, one whose text hashes
    highest); rows without an id stay."""
    keep = classes(docs, doc_id, text, similarity).where(F.col("id") == F.col("class")).select("id").distinct()
    names = [f"c{k}" for k in range(len(docs.columns))]  # the caller's names, dotted or clashing, stay out of the join
    plain = docs.toDF(*names)
    i, t = (names[docs.columns.index(c)] for c in (doc_id, text))
    kept = plain.join(keep, F.col(i).cast("long") == keep["id"], "left_semi")
    kept = kept.groupBy(F.col(i).alias("key")).agg(F.max_by(F.struct(*names), F.xxhash64(t)).alias("row")).select("row.*")
    return kept.unionByName(plain.where(F.col(i).isNull())).toDF(*docs.columns)
