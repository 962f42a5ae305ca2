"""Prepared-table sink and reload with split choice."""

import os
import tempfile

import pytest

from quire.sources.tables import from_rows, load_prepared, write_prepared


def test_write_reload_pick_split(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "ds")
    df = spark.createDataFrame([("a", "train"), ("b", "test"), ("c", "train")], "text string, split string")
    write_prepared(df, out)
    assert sorted(r.text for r in load_prepared(spark, out).collect()) == ["a", "c"]
    with pytest.raises(Exception):
        write_prepared(df, out, overwrite=False)
    df2 = spark.createDataFrame([("x", "validation"), ("y", "test")], "text string, split string")
    write_prepared(df2, out, overwrite=True)
    assert [r.text for r in load_prepared(spark, out).collect()] == ["y"]


def test_missing_dir(spark):
    with pytest.raises(FileNotFoundError):
        load_prepared(spark, "/tmp/quire-definitely-missing-dir")


def test_counted_write_and_rows(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "ds")
    df = from_rows(spark, [{"messages": [{"role": "user", "content": "hi"}]}] * 3)
    assert write_prepared(df, out) == 3
    assert spark.read.parquet(out).count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_split_prunes_partitions(spark):
    from quire.sources.tables import scan_conversations

    out = os.path.join(tempfile.mkdtemp(prefix="quire-scan-"), "conv")
    df = spark.createDataFrame(
        [(1, 0, "user", "a", "train"), (1, 1, "assistant", "b", "train"), (2, 0, "user", "c", "test")],
        "conv_id long, turn long, role string, text string, split string",
    )
    df.write.partitionBy("split").parquet(out)
    got = scan_conversations(spark, out, split="test")
    assert [r.text for r in got.collect()] == ["c"]
    assert "PartitionFilters: [isnotnull(split" in got._jdf.queryExecution().executedPlan().toString() or \
        "split#" in str(got._jdf.queryExecution().optimizedPlan().toString())


def test_load_prepared_prunes_partitions(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quire-dpp-"), "ds")
    df = spark.createDataFrame([(str(i), s) for i in range(20) for s in ("train", "test", "zz")], "text string, split string")
    write_prepared(df, out)
    loaded = load_prepared(spark, out)
    assert loaded.count() == 20
    plan = _plan(loaded)
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan and "= train)" in plan


def test_decode_udf_on_binary_and_file_samples(spark):
    from pyspark.sql import functions as F

    from quire.functions.decode import decode_utf8_lenient
    from quire.plans.prepare import file_samples

    rows = [("r", "a.py", 7, bytes.fromhex("78FF79EFBFBD7A")), ("r", "b.md", 1, b"\xff"), ("r", "c.py", 8, b"a\r\nb\rc\n")]
    df = spark.createDataFrame(rows, "repo string, path string, size long, content binary")
    got = dict(df.select("path", decode_utf8_lenient(F.col("content"))).collect())
    assert got == {"a.py": "xy�z", "b.md": "", "c.py": "a\nb\nc\n"}
    samples = {r.path: [(m.role, m.content) for m in r.messages] for r in file_samples(df).collect()}
    assert samples["b.md"][1] == ("assistant", "")  # a file of only bad bytes is still one (empty) sample
    assert samples["c.py"][1] == ("assistant", "a\nb\nc\n")


def test_checkpoint_dir_is_read_from_the_session(spark):
    from quire.session import CHECKPOINT_CONF, checkpoint_dir, stream_checkpoint

    d = checkpoint_dir(spark)
    assert d == spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    assert stream_checkpoint(spark, "x").startswith(d)


class Killed(BaseException):
    pass


def _rows(spark, out):
    return sorted(r.text for r in load_prepared(spark, out).collect())


def test_a_kill_at_every_step_leaves_the_old_or_the_new_table(spark, monkeypatch):
    """A driver that dies runs no clean-up, so the step before which it dies raises what nothing catches."""
    from quire.sources import tables
    from quire.sources.tables import read_published

    table = lambda *texts: spark.createDataFrame([(t, "train") for t in texts] + [("-", "test")], "text string, split string")
    out = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "ds")
    write_prepared(table("a", "b"), out)
    write_prepared(table("c"), out)
    want, steps, k = ["c"], [], 0
    while True:
        seen = []

        def step(name):
            seen.append(name)
            if len(seen) > k:
                raise Killed

        new = [f"n{k}", f"m{k}"]
        try:
            write_prepared(table(*new), out, step=step)
        except Killed:
            steps.append(seen[-1].split(" ")[0])
            got = _rows(spark, out)
            assert got in (want, sorted(new)) and (got == sorted(new)) == (seen[-1].startswith("drop"))
            assert read_published(spark, out).count() == len(got) + 1
            want, k = got, k + 1
        else:
            break
    assert steps[:2] == ["write", "mark"] and steps.count("drop") >= 2
    assert _rows(spark, out) == sorted(new)
    left = [n for n in os.listdir(out) if n.startswith("published=")]
    assert len(left) == 2  # the current one, and that of the run which was killed before its mark
    monkeypatch.setattr(tables, "UNUSED_MS", -1000)
    write_prepared(table("last"), out)
    assert _rows(spark, out) == ["last"] and sum(not n.startswith(".") for n in os.listdir(out)) == 2
    assert spark.read.parquet(out).count() == 2


def test_a_plain_table_is_taken_over(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "ds")
    spark.createDataFrame([("old", "train"), ("t", "test")], "text string, split string").write.partitionBy("split").parquet(out)
    assert _rows(spark, out) == ["old"]
    with pytest.raises(FileExistsError):
        write_prepared(spark.createDataFrame([("x", "train")], "text string, split string"), out, overwrite=False)
    write_prepared(spark.createDataFrame([("new", "train")], "text string, split string"), out)
    assert _rows(spark, out) == ["new"] and spark.read.parquet(out).count() == 1


def test_publications_at_once_leave_a_whole_table(spark):
    from concurrent.futures import ThreadPoolExecutor

    out = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "ds")
    tables = [spark.createDataFrame([(f"{k}-{i}", "train") for i in range(20)], "text string, split string") for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda t: _try(lambda: write_prepared(t, out)), tables))
    assert done == [20] * 4
    got = _rows(spark, out)
    assert len(got) == 20 and len({t.split("-")[0] for t in got}) == 1


def _try(f):
    try:
        return f()
    except Exception as e:
        return e


def test_unmarked_versions_are_no_table(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="quire-sink-"), "ds")
    df = spark.createDataFrame([("x", "train")], "text string, split string")

    def step(name):
        if name == "mark":
            raise Killed

    with pytest.raises(Killed):
        write_prepared(df, out, step=step)
    assert write_prepared(df, out, overwrite=False) == 1 and _rows(spark, out) == ["x"]
