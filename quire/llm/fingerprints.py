"""Document fingerprints: threshold-scaled sketches of five-word shingles, in DataFrame functions alone.

A fingerprint keeps every shingle hash below a fixed fraction ``1 / SCALE`` of the hash space,
whatever the text's length, so sketches of very unequal texts compare and sketches of parts
merge by union. Texts with fewer than ``LEAST`` hashes below the threshold keep their ``LEAST``
smallest instead (all, if they have no more), so short texts compare too: a sketch is complete
up to its own bound, and two sketches are compared below the lesser of their bounds.

A fingerprint is the sorted hashes, 16 hexadecimal digits each, end to end. Words are runs
between white space; a text of fewer than five words is one shingle of all of them, and null,
empty and blank texts have the empty fingerprint. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import pick, saved

SHINGLE = 5
SCALE = 8
LEAST = 16
TOP = 1 << 62  # hashes are 62-bit numbers


def _hashes(words: Column) -> Column:
    """Hashes of the shingles of an array of word hashes."""
    n = F.size(words)
    mask = F.lit(TOP - 1)
    whole = F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda i: F.xxhash64(
        *(F.element_at(words, i + k) for k in range(SHINGLE))).bitwiseAND(mask))
    return F.when(n >= SHINGLE, whole).when(n > 0, F.array(F.xxhash64(words).bitwiseAND(mask))).otherwise(F.array().cast("array<long>"))


def sketch(df: DataFrame, text: str, out: str, scale: int = SCALE, least: int = LEAST) -> DataFrame:
    """``df`` with ``out``: the sorted array of retained hashes of the text column."""
    w, h, low = out + "_w", out + "_h", out + "_l"
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^\s+|\s+$", "")
    df = df.withColumn(w, F.when(t == "", F.array().cast("array<long>")).otherwise(
        F.transform(F.split(t, r"\s+"), lambda x: F.xxhash64(x))))
    df = df.withColumn(h, _hashes(F.col(w))).drop(w)
    df = df.withColumn(low, F.sort_array(F.array_distinct(F.filter(F.col(h), lambda x: x < TOP // scale))))
    return df.withColumn(out, F.when(F.size(low) >= least, F.col(low)).otherwise(
        F.slice(F.sort_array(F.array_distinct(F.col(h))), 1, least))).drop(h, low)


def _bound(a: Column, scale: int, least: int) -> Column:
    """A sketch holds every hash of its text below this."""
    return F.when(F.size(a) < least, F.lit(TOP)).when(F.element_at(a, -1) < TOP // scale, F.lit(TOP // scale)).otherwise(F.element_at(a, -1) + 1)


def _below(a: Column, b: Column, scale: int, least: int) -> tuple[Column, Column]:
    top = F.least(_bound(a, scale, least), _bound(b, scale, least))
    return F.filter(a, lambda x: x < top), F.filter(b, lambda x: x < top)


def likeness(a: Column, b: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """Estimated Jaccard similarity of two texts from their sketches; two empty ones are alike."""
    x, y = _below(a, b, scale, least)
    both = F.size(F.array_intersect(x, y))
    any_ = F.size(x) + F.size(y) - both
    return F.when(any_ == 0, F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(0.0)).otherwise(both / any_).cast("double")


def containment(a: Column, b: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """Estimated share of the first text's shingles that the second one holds; 1 for an empty first text."""
    x, y = _below(a, b, scale, least)
    return F.when(F.size(a) == 0, 1.0).when(F.size(x) == 0, 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(x)).cast("double")


def merged(a: Column, b: Column, scale: int = SCALE, least: int = LEAST) -> Column:
    """The sketch of two texts' shingles together."""
    x, y = _below(a, b, scale, least)
    return F.sort_array(F.array_union(x, y))


def encoded(a: Column) -> Column:
    """A sketch as text."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def in_order(df: DataFrame, key: str) -> DataFrame:
    """``df`` (small columns) with ``place``: 0, 1, 2, ... by descending ``key``, without one task that sees all rows.

    A range sort numbers rows within its partitions; the written table fixes them, and the
    partitions' counts (a row each) give the offsets.
    """
    s = saved(df.orderBy(F.desc(key)).withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    n = s.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # a row per partition
    at, offsets = 0, {}
    for r in sorted(n, key=lambda r: r["part"]):
        offsets[r["part"]] = at
        at += r["n"]
    if not offsets:
        return s.withColumn("place", F.col("at")).drop("at")
    table = s.sparkSession.createDataFrame(list(offsets.items()), "part long, offset long")
    return s.withColumn("part", part).join(F.broadcast(table), "part").withColumn(
        "place", F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "offset", "at")


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return pick(docs, doc_id=doc_id, text=text).where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _edits(d: DataFrame, beside: str | None = None) -> DataFrame:
    """``edited`` for rows ``doc_id, text`` of no nulls. With ``beside``, an array column of ``d``, also that column
    and, as ``next_`` and its name, the next document's (of rows that repeat its id, the one of least hash)."""
    keep = [beside] if beside else []
    ids = saved(d.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.length("text").cast("long").alias("n"))).alias("m"))
                .select("doc_id", F.col("m.h").alias("h"), F.col("m.n").alias("n")), "edit-ids")
    o = saved(in_order(ids, "doc_id"), "edit-order")
    total = o.count()
    prior = o.select(F.pmod(F.col("place") + 1, F.lit(max(1, total))).alias("place"), F.col("doc_id").alias("before"), F.floor(F.col("n") / 3).alias("cut"))
    heads = o.select("place", F.col("doc_id").alias("of"), "h").join(prior, "place").select("of", "h", "before", "cut")
    head = d.join(heads, d["doc_id"] == heads["of"]).select(
        "before", F.col("doc_id").alias("next_id"),
        F.when(F.xxhash64("text") == F.col("h"), F.expr("left(text, cast(cut as int))")).alias("head"), *keep)
    head = head.groupBy("before").agg(F.first("next_id").alias("next_id"), F.first("head", ignorenulls=True).alias("head"),
                                      *(F.min_by(c, F.xxhash64(c)).alias("next_" + c) for c in keep))
    j = d.join(head, d["doc_id"] == head["before"], "left")
    return j.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), F.concat(
        F.expr("left(text, cast(length(text) - length(text) div 3 as int))"),
        F.expr("left(head, cast(length(text) div 3 as int))")).alias("edited"), "next_id", *keep, *("next_" + c for c in keep))


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document beside its edited text: rows ``doc_id, text, n_chars, edited, next_id``.

    The edited text is the text with its last floor(n/3) code points replaced by the first as
    many (or all) of the next document's, by descending id, the first after the last. Rows without
    an id have no place in the order and are left out; of rows that repeat an id with other texts,
    one (of least hash) stands in the order, and each is edited by what follows that one.

    The texts are dealt by id once, for both the heads cut off and the texts they are put to.
    """
    return _edits(_texts(docs, doc_id, text))


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: int = SCALE, least: int = LEAST) -> DataFrame:
    """Fingerprints of all texts and their edited texts: rows ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    A text's sketch is dealt with it, and the next document's comes with its head, so nothing but ids is
    written to the shared folder and no sketch is dealt a second time for the comparison.
    """
    e = sketch(_edits(sketch(_texts(docs, doc_id, text), "text", "a", scale, least), "a"), "edited", "b", scale, least)
    return e.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), encoded(F.col("a")).alias("fingerprint"), encoded(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b"), scale, least).alias("near_edited"), likeness(F.col("a"), F.col("next_a"), scale, least).alias("near_next"))
