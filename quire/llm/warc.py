"""WARC records, and a Merkle audit of a replica's fixity.

Pages are serialised as WARC/1.0 response records and packed into archive files of
``FANOUT ** FILE_LEVELS`` records in input order. A leaf hashes a record's bytes; a node hashes
the lengths and hashes of its ``FANOUT`` children in order, so it stands for one range of record
numbers and of offsets; some level's nodes are the files, the levels above are the collection.
Two replicas are compared root first, and only the children of nodes that differ are compared
next, so an audit of intact replicas reads two rows and a damaged record costs one path.

Records are found by number: a lost record leaves a gap (``missing``), a record that the first
replica has not is ``extra``. Null urls and bodies count as empty; a null id is written as
empty; repeated rows are records each; an empty table has no tree and no findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import pick, saved

FANOUT = 32
FILE_LEVELS = 2
_CRLF = "\r\n"


def record(page_id: Column, url: Column, body: Column) -> Column:
    """The bytes of a WARC response record."""
    payload = F.coalesce(body.cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit("WARC/1.0" + _CRLF + "WARC-Type: response" + _CRLF + "WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">" + _CRLF + "WARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit(_CRLF + "Content-Type: text/html" + _CRLF + "Content-Length: "), F.octet_length(payload).cast("string"), F.lit(_CRLF * 2))
    return F.concat(head.cast("binary"), payload, F.lit((_CRLF * 2).encode()))


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """The archive as a written table: rows ``number, page_id, record``, numbered from 0 in input order."""
    p = pick(pages, page_id=page_id, url=url, body=body)
    s = saved(p.select(F.monotonically_increasing_id().alias("at"), "page_id", record(F.col("page_id"), F.col("url"), F.col("body")).alias("record")), "warc")
    part = F.shiftright("at", 33)
    counts = s.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # a row per input partition
    at, offsets = 0, []
    for r in sorted(counts, key=lambda r: r["part"]):
        offsets.append((r["part"], at))
        at += r["n"]
    table = F.broadcast(s.sparkSession.createDataFrame(offsets, "part long, first long"))
    return s.join(table, part == F.col("part")).select(
        (F.col("first") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"), "page_id", "record")


def leaves(records: DataFrame) -> DataFrame:
    """Rows ``number, size, hash`` of a replica's records."""
    return records.select("number", F.octet_length("record").cast("long").alias("size"), F.sha2("record", 256).alias("hash"))


def tree(leaf: DataFrame, levels: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the tree, leaves first, each a written table ``number, size, hash``."""
    out = [saved(leaf, "merkle")]
    for _ in range(levels):
        child = F.sort_array(F.collect_list(F.struct("number", "size", "hash")))  # at most ``fanout`` children
        up = out[-1].groupBy(F.floor(F.col("number") / fanout).alias("up")).agg(F.sum("size").alias("size"), child.alias("c"))
        text = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["number"].cast("string"), x["size"].cast("string"), x["hash"])), "|")
        out.append(saved(up.select(F.col("up").alias("number"), "size", F.sha2(text, 256).alias("hash")), "merkle"))
    return out


def height(n: int, fanout: int = FANOUT) -> int:
    """Levels above the leaves until one node is left."""
    h = 0
    while n > 1:
        n = -(-n // fanout)
        h += 1
    return h


def audit(a: list[DataFrame], b: list[DataFrame], fanout: int = FANOUT) -> tuple[DataFrame, list[int]]:
    """The leaves that differ, as rows ``number, size_a, hash_a, size_b, hash_b`` (null where a side has none),
    and how many nodes each level compared, root first."""
    bad, compared = None, []
    for x, y in zip(reversed(a), reversed(b)):
        left = x.select("number", F.col("size").alias("size_a"), F.col("hash").alias("hash_a"))
        right = y.select("number", F.col("size").alias("size_b"), F.col("hash").alias("hash_b"))
        if bad is not None:
            up = bad.select(F.col("number").alias("up"))
            left = left.join(up, F.floor(F.col("number") / fanout) == F.col("up"), "left_semi")
            right = right.join(up, F.floor(F.col("number") / fanout) == F.col("up"), "left_semi")
        pairs = saved(left.join(right, "number", "full_outer"), "merkle-pairs")
        compared.append(pairs.count())
        bad = pairs.where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        if bad.isEmpty():
            break
    if len(compared) < len(a):
        bad = pairs.where("false")
    return bad, compared


def findings(first: DataFrame, replica: DataFrame, fanout: int = FANOUT, file_levels: int = FILE_LEVELS) -> DataFrame:
    """What is wrong with ``replica``: rows ``page_id, number, file, file_offset, size, replica_size, kind``.

    ``file`` and ``file_offset`` locate the record in the first replica's files; ``kind`` is
    ``altered``, ``resized``, ``missing`` or ``extra``.
    """
    la, lb = leaves(first), leaves(replica)
    n = max(la.agg(F.max("number")).first()[0] or 0, lb.agg(F.max("number")).first()[0] or 0) + 1
    h = height(n, fanout)
    a, b = tree(la, h, fanout), tree(lb, h, fanout)
    bad, _ = audit(a, b, fanout)
    per = fanout**file_levels
    w = Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # a file has ``per`` records
    damaged = bad.select(F.floor(F.col("number") / per).alias("file")).distinct()
    place = a[0].withColumn("file", F.floor(F.col("number") / per)).join(damaged, "file", "left_semi").select(
        "number", "file", F.coalesce(F.sum("size").over(w), F.lit(0)).alias("file_offset"))
    ids = first.select("number", "page_id")
    kind = F.when(F.col("hash_b").isNull(), "missing").when(F.col("hash_a").isNull(), "extra").when(
        F.col("size_a") != F.col("size_b"), "resized").otherwise("altered")
    return bad.join(place, "number", "left").join(ids, "number", "left").select(
        "page_id", "number", "file", "file_offset", F.col("size_a").alias("size"), F.col("size_b").alias("replica_size"), kind.alias("kind"))
