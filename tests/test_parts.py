"""Reports from stored parts equal one run over everything; merged sketches keep their error."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.operators import parts as PT
from quire.operators.select import corpus_parts, corpus_report, report_of

FILES = "repo string, path string, size long, text string"


def files(spark, rows):
    return spark.createDataFrame([(r, p, len(t) if t is not None else 7, t) for r, p, t in rows], FILES)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_the_report_after_arrivals_equals_one_run(spark):
    r, table = random.Random(3), os.path.join(tempfile.mkdtemp(prefix="quire-parts-"), "t")
    names = [f"{d}f{i}{e}" for i in range(30) for d in ("", ".git/", "src/") for e in (".py", ".md", ".txt")]
    now = {}
    for arrival in range(5):
        changed = {("r1" if r.random() < 0.7 else "r2", p): r.choice(["", "line\n" * r.randrange(1, 400), None]) for p in r.sample(names, 60)}
        gone = r.sample(sorted(now), min(len(now), 8)) if arrival > 1 else []
        gone = [k for k in gone if k not in changed]
        now.update(changed)
        for k in gone:
            now.pop(k)
        came = corpus_parts(files(spark, [(*k, t) for k, t in changed.items()]), max_chars=100)
        left = PT.gone_parts(spark.createDataFrame(gone, "repo string, path string"))
        PT.add_parts(came.unionByName(left), table, arrival)
        if arrival == 3:
            PT.add_parts(came.unionByName(left), table, arrival)  # a run again replaces its own parts
        got = rows_of(report_of(PT.merged_parts(spark, table)))
        assert got == rows_of(corpus_report(files(spark, [(*k, t) for k, t in now.items()]), max_chars=100))
    assert sum(x[7] for x in got) > 0  # skipped_unreadable
    PT.compact_parts(spark, table, table + "-small", 4)
    assert rows_of(report_of(PT.merged_parts(spark, table + "-small"))) == got
    assert spark.read.parquet(table + "-small").count() == len(now) < spark.read.parquet(table).count()
    with pytest.raises(ValueError):
        PT.add_parts(came, table, -1)


def test_unreadable_files_are_a_reason(spark):
    rows = [("r", "a.py", "x\n"), ("r", "b.py", None), ("r", ".git/c.py", None), ("r", "d.txt", None), ("r", "e.py", "")]
    got = corpus_report(files(spark, rows)).first()
    assert (got.files_in, got.files_kept, got.skipped_unreadable, got.skipped_vcs, got.skipped_extension, got.skipped_empty) == (5, 1, 1, 1, 1, 1)
    assert (got.chunks, got.characters) == (1, 2)


def test_merged_sketches_keep_the_stated_error(spark):
    n = 60_000
    df = spark.range(n).select((F.col("id") % 7).alias("g"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("k")).select(
        F.when(F.col("g") < 3, 0).otherwise(F.col("g")).alias("g"), F.repeat(F.lit("abcd"), F.col("k").cast("int")).alias("text"))
    src = os.path.join(tempfile.mkdtemp(prefix="quire-kll-"), "s")
    PT.length_sketches(df, ["g"]).write.parquet(src)
    stored = spark.read.parquet(src)
    assert stored.agg(F.max(F.octet_length("lengths"))).first()[0] < 64_000  # bounded, whatever the group's size
    exact = sorted(r.n for r in df.select((F.length("text") / 4).cast("long").alias("n")).collect())
    quantiles = (0.01, 0.25, 0.5, 0.9, 0.99)
    for got in (PT.length_quantiles(stored, quantiles), PT.length_quantiles(PT.length_sketches(df, []), quantiles),
                PT.length_quantiles(stored.where("g < 4").unionByName(stored.where("g >= 4")), quantiles)):
        row = got.first()
        assert (row.samples, row.max_tokens) == (n, exact[-1])
        for q in quantiles:
            v = row[f"p{q * 100:g}"]
            below, upto = sum(x < v for x in exact) / n, sum(x <= v for x in exact) / n
            assert below - PT.RANK_ERROR <= q <= upto + PT.RANK_ERROR
    by = {r.g: r.samples for r in PT.length_quantiles(stored, by=["g"]).collect()}
    assert by == {r["g"]: r["count"] for r in df.groupBy("g").count().collect()}
    assert PT.length_quantiles(stored.limit(0)).first().samples is None
