"""Caps keep exactly what they say: null keys, large ids, equal keys, tables without a key; and nothing is lost on the way."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.operators import messages as MS
from quire.operators import select as SL
from quire.operators import shaping as SH
from quire.operators import template as TP
from quire.plans import jobs, prepare, train
from quire.sources import tables as TB
from quire.sources.tree import list_tree

from test_tree import make_tree

TURNS = "conv_id long, turn long, role string, text string"
NESTED = "messages array<struct<role:string,content:string>>"


def _new_dir():
    return tempfile.mkdtemp(prefix="quire-caps-")


@pytest.mark.parametrize("kind,make", [("bigint", lambda i: 2**60 + i), ("string", lambda i: f"k{i:03d}")])
def test_first_groups_for_every_key_type(spark, kind, make):
    rows = [(make(i), t) for i in range(40) for t in range(3)] + [(None, t) for t in range(50)]
    df = spark.createDataFrame(rows, f"k {kind}, t int").repartition(5)
    got = SL.first_groups(df, "k", 7).collect()
    assert sorted((r.k, r.t) for r in got) == sorted((make(i), t) for i in range(7) for t in range(3))
    assert SL.first_groups(df, "k", 1000).count() == 120 and SL.first_groups(df, "k", None).count() == 170


def test_exact_first_rows_with_equal_and_null_keys(spark):
    rows = [(1, i) for i in range(20)] + [(None, 99)] * 3
    src = os.path.join(_new_dir(), "t")
    spark.createDataFrame(rows, "id long, n int").coalesce(1).write.parquet(src)
    stored = spark.read.parquet(src)
    assert [r.n for r in SL.first_rows_exact(stored, ["id"], 5).orderBy("n").collect()] == [0, 1, 2, 3, 4]
    assert SL.first_rows_exact(stored, [], 21).count() == 21 and SL.first_rows_exact(stored, ["id"], 100).count() == 23
    derived = spark.createDataFrame(rows, "id long, n int").repartition(4)  # no stored position: written once
    assert SL.first_rows_exact(derived, ["id"], 5).count() == 5


def test_first_rows_per_group_with_a_hot_group(spark):
    rows = [("hot", i) for i in range(5000)] + [(f"g{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, n int").repartition(6)
    got = SL.first_rows_per_group(df, "g", ["n"], 3)
    assert sorted((r.g, r.n) for r in got.collect() if r.g == "hot") == [("hot", 0), ("hot", 1), ("hot", 2)]
    assert got.count() == 53 and got.columns == ["g", "n"]


def test_same_path_in_two_repositories(spark):
    rows = [("r2", "a.py", 4, "two\n"), ("r1", "a.py", 4, "one\n")]
    for order in (rows, rows[::-1]):
        files = spark.createDataFrame(order, "repo string, path string, size long, text string").repartition(3)
        got = prepare.file_samples(files, max_samples=1, cap_per_repo=False).collect()
        assert [r.repo for r in got] == ["r1"]


def test_file_with_a_size_and_no_body_fails_the_cap(spark):
    files = spark.createDataFrame([("r", "a.py", 4, None)], "repo string, path string, size long, text string")
    with pytest.raises(Exception, match="has no body"):
        prepare.file_samples(files, max_samples=1).collect()


def test_null_role_and_null_conversation_fail(spark):
    df = spark.createDataFrame([([("user", "hi"), (None, "lost")],)], NESTED)
    with pytest.raises(Exception, match="no role"):
        TP.render_messages(df).collect()
    turns = spark.createDataFrame([(None, 0, "user", "x")], TURNS)
    with pytest.raises(Exception, match="no conv_id"):
        MS.turns_to_messages(turns).collect()


def _shapes(spark):
    talk = [("user", "q"), ("assistant", "a")]
    yield "messages", spark.createDataFrame([(talk,)] * 20, NESTED), 20
    yield "language", spark.createDataFrame([("en" if i % 2 else "de", talk) for i in range(20)], "reasoning_language string, " + NESTED), 20
    yield "sharegpt", spark.createDataFrame([(i // 2, [("human", "q"), ("gpt", "a")]) for i in range(20)], "id long, conversations array<struct<from:string,value:string>>"), 20
    yield "flat", spark.createDataFrame([(i, t, r, "x") for i in range(20) for t, r in enumerate(("user", "assistant"))], TURNS), 20


def test_prepare_then_plan_for_every_shape(spark):
    for name, df, n in _shapes(spark):
        src, out = os.path.join(_new_dir(), name), os.path.join(_new_dir(), "out")
        df.write.parquet(src)
        assert jobs.prepare_dataset(spark, src, out, max_samples=3)[0] == 3
        rows, first = jobs.prepare_dataset(spark, src, out)
        assert rows == n and first.startswith("<|start|>") and jobs.prepared_overview(spark, out)[0] == n
        plan = os.path.join(_new_dir(), "plan")
        assert jobs.plan_training(spark, out, plan) == 120
        ids = spark.read.parquet(plan).groupBy("epoch").agg(F.countDistinct("sample_id").alias("n")).collect()
        assert {r.n for r in ids} == {n}


def test_json_folders_and_kinds(spark):
    for name, df, n in _shapes(spark):
        src = os.path.join(_new_dir(), name)
        df.write.json(src)
        assert jobs.prepare_dataset(spark, src, os.path.join(_new_dir(), "out"), max_samples=3)[0] == 3


def test_missing_root_fails_and_keeps_the_target(spark):
    root, out = make_tree({"a.py": b"x\n"}), os.path.join(_new_dir(), "out")
    assert jobs.prepare_dataset(spark, "repo:o/n", out, tree=root)[0] == 1
    with pytest.raises(Exception, match="cannot list"):
        jobs.prepare_dataset(spark, "repo:o/n", out, tree=root + "-typo")
    empty = make_tree({"a.txt": b"x\n"})
    with pytest.raises(ValueError, match="left as it was"):
        jobs.prepare_dataset(spark, "repo:o/n", out, tree=empty)
    assert spark.read.parquet(out).count() == 1 and os.listdir(os.path.dirname(out)) == ["out"]
    fresh = os.path.join(_new_dir(), "fresh")
    assert jobs.prepare_dataset(spark, "repo:o/n", fresh, tree=empty) == (0, None)
    assert TB.load_prepared(spark, fresh).count() == 0


def test_a_failed_write_keeps_the_target(spark):
    out = os.path.join(_new_dir(), "out")
    TB.write_prepared(spark.range(3).withColumn("split", F.lit("train")), out)
    bad = spark.range(5).withColumn("split", F.lit("train")).withColumn("x", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        TB.write_prepared(bad, out)
    assert spark.read.parquet(out).count() == 3 and os.listdir(os.path.dirname(out)) == ["out"]


def test_what_cannot_be_listed_or_read_is_counted(spark):
    root = make_tree({"a.py": b"x\n", "d/b.py": b"y\n", "gone.py": b"z\n"})
    os.symlink(os.path.join(root, "nowhere"), os.path.join(root, "broken.py"))
    skipped = prepare.SkipCounts()
    listed = list_tree(spark, root, "r").collect()
    assert {r.path for r in listed} == {"a.py", "d/b.py", "gone.py"}
    got = prepare.tree_samples(spark, root, "r", skipped=skipped)
    os.unlink(os.path.join(root, "gone.py"))  # after the listing
    assert sorted(r.path for r in got.collect()) == ["a.py", "d/b.py"]
    assert (skipped.unlisted, skipped.unread) == (0, 1)


def test_batches_of_a_budget_far_above_the_table(spark):
    df = spark.createDataFrame([(f"s{i}", f"text {i}") for i in range(50)], "sample_id string, text string").repartition(7)
    got = SH.training_batches(df, "sample_id", max_steps=400, batch_size=2, grad_accum=2).collect()
    assert len(got) == 1600
    by_epoch = {}
    for r in got:
        by_epoch.setdefault(r.epoch, []).append((r.step, r.micro, SH and r.sample_id, r.text))
    assert sorted(by_epoch) == list(range(32)) and all(len({x[2] for x in v}) == 50 for v in by_epoch.values())
    import hashlib

    order = sorted((e, hashlib.md5(f"{SH.DEFAULT_SEED + e}:s{i}".encode()).hexdigest(), f"s{i}") for e in range(32) for i in range(50))[:1600]
    want = {(e, s): (k // 4 + 1, k // 2 % 2 + 1) for k, (e, _, s) in enumerate(order)}
    assert {(r.epoch, r.sample_id): (r.step, r.micro) for r in got} == want and all(r.text == "text " + r.sample_id[1:] for r in got)


def test_training_order_is_chosen_without_texts(spark):
    df = spark.createDataFrame([(f"s{i}", "t") for i in range(9)], "sample_id string, text string")
    src = os.path.join(_new_dir(), "t")
    df.write.parquet(src)
    plan = SH.training_batches(spark.read.parquet(src), "sample_id")._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Window")[1:]:
        assert "text#" not in part.split("SortMergeJoin")[0].split("Join")[0]
    assert plan.count("ReadSchema: struct<sample_id:string,text:string>") == 1 and "SinglePartition" not in plan.split("Subquery")[0]


def test_sample_ids(spark):
    assert train.sample_id(spark.createDataFrame([(7, "t")], "id long, text string")).first().sample_id == "7"
    with pytest.raises(ValueError):
        train.sample_id(spark.createDataFrame([("t",)], "text string"))
