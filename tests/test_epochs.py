"""The order addressed by step: a permutation of every size, the same from any step on."""

import hashlib
import os
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.operators import epochs as EP


def permuted(x, n, seed, epoch):
    """The rounds in Python integers."""
    digest = lambda s: hashlib.md5(s.encode()).hexdigest()
    for r in range(EP.ROUNDS):
        y = (int(digest(f"{seed}:{epoch}:{r}")[:15], 16) - x) % n
        if int(digest(f"{seed}:{epoch}:{r}:{max(x, y)}")[0], 16) % 2:
            x = y
    return x


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_every_epoch_is_a_permutation_with_an_inverse(spark, n):
    df = spark.range(3 * n).select((F.col("id") % n).alias("slot"), F.floor(F.col("id") / n).cast("long").alias("epoch"))
    rows = df.withColumn("row", EP.row_of(F.col("slot"), F.lit(n).cast("long"), 7, F.col("epoch")))
    got = rows.withColumn("back", EP.slot_of(F.col("row"), F.lit(n).cast("long"), 7, F.col("epoch"))).collect()
    for e in range(3):
        mine = {r["slot"]: r["row"] for r in got if r["epoch"] == e}
        assert sorted(mine.values()) == list(range(n))
        assert mine == {s: permuted(s, n, 7, e) for s in range(n)}
    assert all(r["slot"] == r["back"] for r in got)
    if n == 1000:
        orders = [[r["row"] for r in sorted(got, key=lambda r: r["slot"]) if r["epoch"] == e] for e in range(3)]
        assert orders[0] != orders[1] != orders[2]
        # slots of the first half draw from the whole table
        low = sum(x < 500 for x in orders[0][:500])
        assert 200 < low < 300


def test_large_tables_need_no_table(spark):
    n = 10**15 + 37
    got = EP.rows_of_steps(spark, n, 10**12, 10**12 + 3, batch_size=2, grad_accum=3, seed=1).collect()
    assert len(got) == 24 and all(0 <= r["row"] < n for r in got)
    assert all(r["row"] == permuted(r["position"] % n, n, 1, r["position"] // n) for r in got)


def test_steps_alone_equal_the_slice_of_the_whole_order(spark):
    whole = [tuple(r) for r in EP.rows_of_steps(spark, 25, 1, 40, batch_size=2, grad_accum=3).orderBy("position").collect()]
    assert len(whole) == 240 and [(r[0], r[1], r[2], r[3]) for r in whole] == [(p, p // 25, p // 6 + 1, p // 2 % 3 + 1) for p in range(240)]
    for a, b in ((1, 1), (5, 9), (40, 40), (13, 30)):
        part = EP.rows_of_steps(spark, 25, a, b, batch_size=2, grad_accum=3).orderBy("position").collect()
        assert [tuple(r) for r in part] == whole[(a - 1) * 6:b * 6]
    for bad in ((0, 3), (3, 2)):
        with pytest.raises(ValueError):
            EP.rows_of_steps(spark, 25, *bad)


def test_a_table_of_several_files_is_covered_once_an_epoch(spark):
    src = os.path.join(tempfile.mkdtemp(prefix="quire-epochs-"), "t")
    spark.range(500).select(F.col("id").alias("k"), F.concat(F.lit("text "), "id").alias("a.b")).repartition(7).write.parquet(src)
    table = spark.read.parquet(src)
    assert sorted(r["row"] for r in EP.dense_rows(table).collect()) == list(range(500))
    got = EP.steps_of(table, 1, 250, batch_size=2, grad_accum=2).collect()  # two epochs
    assert Counter((r["epoch"], r["k"]) for r in got) == {(e, k): 1 for e in (0, 1) for k in range(500)}
    assert all(r["a.b"] == f"text {r['k']}" for r in got)
    resumed = EP.steps_of(table, 101, 250, batch_size=2, grad_accum=2).collect()
    key = lambda r: (r["position"], r["k"])
    assert sorted(map(key, resumed)) == sorted(key(r) for r in got if r["step"] > 100)


def test_a_prepared_table_resumes_at_a_step(spark):
    from quire.plans import jobs
    from quire.sources.tables import write_prepared

    at = tempfile.mkdtemp(prefix="quire-epochs-")
    out = os.path.join(at, "ds")
    rows = [(i, f"text {i}", "train" if i % 3 else "test") for i in range(60)]
    write_prepared(spark.createDataFrame(rows, "conv_id long, text string, split string").repartition(5), out)
    assert jobs.plan_training(spark, out, os.path.join(at, "whole"), max_steps=20, from_step=1) == 80
    assert jobs.plan_training(spark, out, os.path.join(at, "rest"), max_steps=20, from_step=13) == 32
    key = lambda r: (r.step, r.micro, r.sample_id, r.epoch, r.text)
    whole, rest = (sorted(map(key, spark.read.parquet(os.path.join(at, n)).collect())) for n in ("whole", "rest"))
    assert rest == [k for k in whole if k[0] >= 13]
    assert Counter(Counter(k[2] for k in whole).values()) == {2: 40}  # two epochs of the train split


def test_sample_ids_tell_keys_apart(spark):
    from quire.operators.shaping import training_batches
    from quire.plans.train import sample_id

    keys = [("a:b", "c"), ("a", "b:c"), ("a", "b\\:c"), ("a", "b\\"), (None, "x"), ("\\N", "x"), ("a", None), ("a", "\\N"), ("r", "p/q.py")]
    df = spark.createDataFrame([(r, p, 1) for r, p in keys], "repo string, path string, chunk_idx int")
    ids = {(r.repo, r.path): r.sample_id for r in sample_id(df).collect()}
    assert len(set(ids.values())) == len(keys) and ids["r", "p/q.py"] == "r:p/q.py:1" and ids["a:b", "c"] == "a:b:c:1"
    with pytest.raises(Exception, match="a sample has no id"):
        training_batches(spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "id long, text string"), "id", max_steps=3).collect()
