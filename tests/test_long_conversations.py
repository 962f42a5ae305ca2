"""A conversation above the bound fails by name or is left out and named; all others are assembled."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.operators import messages as MS
from quire.plans import jobs, prepare
from quire.sources.tables import load_prepared

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def turns(spark):
    small = spark.createDataFrame([(i, t, r, f"c{i} t{t}") for i in range(40) for t, r in enumerate(("user", "assistant", "user"))], TURNS)
    # two conversations hold most rows; made in Spark, in many tasks
    long = spark.range(0, 60_000, 1, 16).select(
        (F.lit(1000) + F.col("id") % 2).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.repeat(F.lit("x"), 200).alias("text"))
    return small.unionByName(long).unionByName(spark.createDataFrame([(2000, 0, "user", None), (2000, 1, "assistant", "a")], TURNS))


def test_oversized_are_named_and_not_gathered(turns):
    big = {r.conv_id: (r.turns, r.bytes) for r in MS.oversized(turns, max_bytes=100_000).collect()}
    assert big == {c: (30_000, 30_000 * (200 + MS.TURN_BYTES)) for c in (1000, 1001)}
    got = MS.turns_to_messages(turns, max_bytes=100_000, on_oversize="skip").collect()
    assert {r.conv_id for r in got} == {*range(40), 2000}
    assert all([m.content for m in r.messages] == [f"c{r.conv_id} t{t}" for t in range(3)] for r in got if r.conv_id < 40)


@pytest.mark.parametrize("columns", [["conv_id"], ["messages"], []])
def test_an_oversized_conversation_fails_by_name(turns, columns):
    df = MS.turns_to_messages(turns, max_bytes=100_000)
    with pytest.raises(Exception, match=r"conv_id 100[01] has 7920000 bytes in 30000 turns; a conversation holds 100000 at most"):
        df.select(*columns).collect() if columns else df.count()
    assert MS.turns_to_messages(turns).count() == 43 == MS.turns_to_messages(turns, max_bytes=None).count()
    with pytest.raises(ValueError):
        MS.turns_to_messages(turns, on_oversize="cut")


def test_the_plan_gathers_only_what_is_kept(turns):
    plan = MS.turns_to_messages(turns, max_bytes=100_000, on_oversize="skip")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("LeftAnti")  # the join stands below the aggregate that gathers


def test_the_job_writes_what_it_leaves_out(spark, turns):
    at = tempfile.mkdtemp(prefix="quire-long-")
    src, out, left = (os.path.join(at, n) for n in ("in", "out", "left"))
    turns.write.parquet(src)
    with pytest.raises(Exception, match="a conversation holds"):
        jobs.prepare_dataset(spark, src, out, max_conversation_bytes=100_000)
    assert not os.path.exists(out)
    n, first = jobs.prepare_dataset(spark, src, out, max_conversation_bytes=100_000, skipped_conversations=left)
    assert n == 41 == load_prepared(spark, out).count() and first
    assert {r.conv_id for r in spark.read.parquet(left).collect()} == {1000, 1001}
    assert prepare.conversation_training_text(turns, max_samples=3, max_bytes=100_000).count() == 3  # a cap is taken first
