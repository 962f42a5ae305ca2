"""Near-duplicate embeddings: an exact range join in a metric space.

Cosine at least ``c`` is Euclidean distance at most sqrt(2 - 2c) between unit vectors. Within
each label a few vectors serve as pivots; a vector lives in the cell of its nearest pivot, and
is replicated to every other cell whose bisecting plane lies within that distance of it: by the
triangle inequality no partner of a vector of that cell can lie farther. A pair is found in the
home cell of one of the two (that of the lesser vector, if the other is also there), so each
cell is joined alone and every pair is found once.

Vectors are scaled by a power of two (exactly) so that no square overflows or vanishes; those that
are equal then are one vector with a count. Pivots are a table that meets the vectors of its label
in groups of ``GROUP``, so nothing of the labels passes the driver, however many are large. A cell's vectors are cut into
blocks of at most ``BLOCK``, and pairs of blocks are tasks of their own, so a cell that holds a
third of all rows is many small tasks. A task returns sums: links per vector, and the edges of a
spanning forest of its links instead of all pairs.

Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do
vectors without a label. Vectors of different lengths never link. Rows without an id are left
out; of rows that repeat an id each is a vector, and the id's links count all other rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import components, pick, ready, saved

COSINE = 0.93
CELL = 4000
MAX_PIVOTS = 256
BLOCK = 4096
GROUP = 512  # vectors that meet their label's pivots in one task's group


def _unit(raw: list) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """The vector times the power of two that brings its largest component to between 1/2 and 1; no negative zeros."""
    return np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) + 0.0


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, in double precision."""
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def _cells(reach: float):
    """A group of vectors of a label and its pivots -> a row per cell that needs the vector; ``home`` marks its own cell."""
    def cells(g: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        columns = ["label", "size", "cell", "home", "node", "v", "n"]
        if not len(g):
            return pd.DataFrame([], columns=columns)
        p, x = _unit(list(pivots.sort_values("k")["v"])), _unit(list(g["v"]))
        near = x @ p.T
        own = near.argmax(1)
        gap = near[np.arange(len(x)), own][:, None] - near  # half the difference of squared distances
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * (p @ p.T)))[own]
        far = np.divide(gap, apart, out=np.zeros_like(gap), where=apart > 0)  # distance to the bisecting plane
        row, cell = np.nonzero(far <= reach + 1e-9)
        out = g.iloc[row][["label", "size", "node", "v", "n"]].reset_index(drop=True)
        return out.assign(cell=cell, home=own[row] == cell)[columns]
    return cells


def _join_blocks(cosine: float):
    """One pair of blocks of a cell: links per vector, and a spanning forest of the links."""
    def join(key, pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[-2]), int(key[-1])
        cols = ["a", "b", "links"]
        sides = [pdf[pdf["block"] == k] for k in (i, j)]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame([], columns=cols)
        raw = [np.frombuffer(b"".join(p["v"]), np.float64).reshape(len(p), -1) for p in sides]
        unit = [_unit(list(p["v"])) for p in sides]
        node, home, count = ([p[c].to_numpy() for p in sides] for c in ("node", "home", "n"))
        links: dict[int, int] = {}
        root: dict[int, int] = {}
        edges = []

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        # a pair belongs to the home cell of its lesser vector; its other vector is there too, being within reach
        for s, o in ((0, 1),) if i == j else ((0, 1), (1, 0)):
            own = np.flatnonzero(home[s])
            for at in range(0, len(own), 512):
                part = own[at:at + 512]
                g = unit[s][part] @ unit[o].T
                x, y = np.nonzero(g >= cosine - 1e-9)
                g = g[x, y]
                x = part[x]
                keep = node[s][x] < node[o][y]
                x, y, g = x[keep], y[keep], g[keep]
                near = np.abs(g - cosine) <= 1e-9
                if near.any():
                    ok = ~near
                    ok[near] = exact_cosine(raw[s][x[near]], raw[o][y[near]]) >= cosine
                    x, y = x[ok], y[ok]
                for ids, n in ((node[s][x], count[o][y]), (node[o][y], count[s][x])):
                    u, inv = np.unique(ids, return_inverse=True)
                    for k, t in zip(u.tolist(), np.bincount(inv, weights=n, minlength=len(u)).tolist()):
                        links[k] = links.get(k, 0) + int(t)
                for p, q in zip(node[s][x].tolist(), node[o][y].tolist()):
                    rp, rq = find(p), find(q)
                    if rp != rq:
                        root[max(rp, rq)] = min(rp, rq)
                        edges.append((p, q, 0))
        return pd.DataFrame([(k, k, n) for k, n in links.items()] + edges, columns=cols)
    return join


def range_join(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
               cosine: float = COSINE, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """Rows ``vec_id, n_links, component_id, kept`` for every vector with an id."""
    if not 0 < cosine <= 1:
        raise ValueError("cosine lies above 0 and up to 1")
    v = ready(pick(vectors, id=vec_id, e=embedding, label=label)).where("id is not null").select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), F.col("e").cast("array<double>").alias("e"))
    bad = F.coalesce(F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True)) | (
        F.size("e") <= 0) | F.forall("e", lambda x: x == 0.0)
    usable = ~F.coalesce(bad, F.lit(True)) & F.col("label").isNotNull()

    @F.pandas_udf("binary")
    def packed(column: pd.Series) -> pd.Series:
        return column.map(lambda x: scaled(np.asarray(x, np.float64)).tobytes())

    # equal vectors are one node: the least id of label and components
    full = saved(v.where(usable).withColumn("v", packed("e")).select("id", "label", "v"), "vec-packed")
    alike = ["label", "v"]
    node = saved(full.groupBy(*alike).agg(F.min("id").alias("node"), F.count("*").alias("n")).withColumn(
        "size", F.octet_length("v")), "vec-nodes")
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    big = node.groupBy("label", "size").agg(F.count("*").alias("c")).where(F.col("c") > cell)
    at = ["label", "size"]
    mine = saved(node.join(big, at), "vec-large")
    first = F.row_number().over(Window.partitionBy(*at).orderBy(F.xxhash64("v"), "node"))
    pivots = mine.withColumn("k", first).where((F.col("k") <= MAX_PIVOTS) & (F.col("k") <= F.ceil(F.col("c") / cell)))
    groups = F.ceil(F.col("c") / GROUP)
    dealt = mine.withColumn("group", F.pmod(F.xxhash64(F.lit(3), "node"), groups)).select(*at, "group", "node", "v", "n").alias("d")
    met = pivots.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), groups - 1))).select(*at, "group", "k", "v").alias("m")
    kind = "label string, size int, cell int, home boolean, node long, v binary, n long"
    spread = dealt.groupBy(*(F.col(f"d.{c}") for c in (*at, "group"))).cogroup(met.groupBy(*(F.col(f"m.{c}") for c in (*at, "group")))).applyInPandas(_cells(reach), kind)
    whole = node.join(big.select(*at), at, "left_anti").select(*at, F.lit(0).alias("cell"), F.lit(True).alias("home"), "node", "v", "n")
    placed = saved(whole.unionByName(spread), "vec-cells")
    crowd = placed.groupBy("label", "size", "cell").agg(F.count("*").alias("c")).withColumn("blocks", F.ceil(F.col("c") / block).cast("int"))
    # a block meets every block of its cell; how many there are is known from the counts, so pairs are dealt by arithmetic
    p = placed.join(crowd, ["label", "size", "cell"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    p = p.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "size", "cell", "home", "node", "v", "n", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    joined = saved(p.groupBy("label", "size", "cell", "i", "j").applyInPandas(_join_blocks(cosine), "a long, b long, links long"), "vec-links")
    direct = joined.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    cc = components(joined.where("a != b").select("a", "b"), "vec-cc").select("id", "component")
    mine = node.join(direct, "node", "left").join(cc, node["node"] == cc["id"], "left").select(
        *alike, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    linked = full.join(mine, alike).select("id", "n_links", "component_id")
    alone = v.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
