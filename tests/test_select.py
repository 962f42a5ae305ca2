"""Selection, shaping, messages and templates."""

import pytest
from pyspark.sql import functions as F

from quire.operators import messages as MS
from quire.operators import select as SL
from quire.operators import shaping as SH
from quire.operators import template as TP


def test_first_rows_rejects_nonpositive(spark):
    df = spark.range(5)
    with pytest.raises(ValueError):
        SL.first_rows(df, ["id"], 0)
    assert SL.first_rows(df, ["id"], None).count() == 5
    assert [r.id for r in SL.first_rows(df, ["id"], 2).collect()] == [0, 1]


def test_first_groups(spark):
    df = spark.createDataFrame([(k, t) for k in (5, 3, 9, 1) for t in range(3)], "conv_id long, turn long").repartition(3)
    got = sorted({r.conv_id for r in SL.first_groups(df, "conv_id", 2).collect()})
    assert got == [1, 3]
    assert SL.first_groups(df, "conv_id", 2).count() == 6


def test_pick_split(spark):
    df = spark.createDataFrame([(1, "test"), (2, "train"), (3, None)], "id long, split string")
    assert [r.id for r in SL.pick_split(df).collect()] == [2]
    df2 = spark.createDataFrame([(1, "validation"), (2, "test"), (3, None)], "id long, split string")
    assert [r.id for r in SL.pick_split(df2).collect()] == [2]


def test_training_batches_epochs(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("sid"))
    out = SH.training_batches(df, "sid").collect()
    assert len(out) == 120
    assert {r.epoch for r in out} == {0, 1, 2}
    assert [r.step for r in out][:8] == [1, 1, 1, 1, 2, 2, 2, 2]
    assert [r.micro for r in out][:5] == [1, 2, 3, 4, 1]
    big = spark.range(1000).select(F.col("id").cast("string").alias("sid"))
    b = SH.training_batches(big, "sid").collect()
    assert {r.epoch for r in b} == {0} and len({r.sid for r in b}) == 120
    assert sorted(r.sid for r in b) == sorted(r.sid for r in SH.training_budget(big, "sid").collect())


def test_standardize_roles_unknown_raises(spark):
    df = spark.createDataFrame([(1, [("human", "hi"), ("gpt", "yo")])], "id long, conversations array<struct<from:string,value:string>>")
    msgs = MS.standardize_roles(df).collect()[0].messages
    assert [(m.role, m.content) for m in msgs] == [("user", "hi"), ("assistant", "yo")]
    bad = spark.createDataFrame([(1, [("robot", "x")])], "id long, conversations array<struct<from:string,value:string>>")
    with pytest.raises(Exception):
        MS.standardize_roles(bad).collect()


def test_render_requires_messages(spark):
    with pytest.raises(ValueError):
        TP.render_messages(spark.range(1))


def test_render_template(spark):
    df = spark.createDataFrame(
        [(1, [("system", "s"), ("user", "u"), ("assistant", "a1"), ("user", "u2"), ("assistant", "a2")])],
        "id long, messages array<struct<role:string,content:string>>",
    )
    text = TP.render_messages(df).collect()[0].text
    assert text == (
        "<|start|>system<|message|>s<|end|><|start|>user<|message|>u<|end|>"
        "<|start|>assistant<|channel|>final<|message|>a1<|end|><|start|>user<|message|>u2<|end|>"
        "<|start|>assistant<|channel|>final<|message|>a2<|return|>"
    )
    th = spark.createDataFrame([(1, [("user", "q", None), ("assistant", "a", "t")])],
                               "id long, messages array<struct<role:string,content:string,thinking:string>>")
    assert TP.render_messages(th).collect()[0].text.endswith(
        "<|start|>assistant<|channel|>analysis<|message|>t<|end|><|start|>assistant<|channel|>final<|message|>a<|return|>")


def test_prompt_messages(spark):
    df = spark.createDataFrame([(1, "  dev ", " hi "), (2, " 　", "q"), (3, None, "z")], "id long, developer string, user_text string")
    got = {r.id: [(m.role, m.content) for m in r.messages] for r in MS.prompt_messages(df).collect()}
    assert got == {1: [("developer", "dev"), ("user", "hi")], 2: [("user", "q")], 3: [("user", "z")]}
    p = TP.render_prompts(MS.prompt_messages(df).where("id = 3"), effort_col=None).collect()[0].prompt
    assert p == "<|start|>user<|message|>z<|end|><|start|>assistant"


def test_request_params(spark):
    df = spark.range(1)
    r = TP.request_params(df, do_sample=False).collect()[0]
    assert (r.max_new_tokens, r.do_sample, r.temperature, r.top_p) == (512, False, None, None)
    r = TP.request_params(df).collect()[0]
    assert (r.do_sample, r.temperature, r.top_p) == (True, 0.7, 0.9)


def test_single_effort_requests(spark):
    from quire.plans.chat import generation_requests

    df = spark.createDataFrame([(1, None, "hi"), (2, "dev", "  ")], "id long, developer string, user_text string")
    r = generation_requests(df, efforts=False, effort="high", max_new_tokens=64).collect()
    assert len(r) == 1 and r[0].effort == "high" and r[0].max_new_tokens == 64
    assert r[0].prompt == "<|start|>system<|message|>Reasoning: high<|end|><|start|>user<|message|>hi<|end|><|start|>assistant"
    r = generation_requests(df, efforts=False).collect()[0]
    assert r.effort is None and r.prompt == "<|start|>user<|message|>hi<|end|><|start|>assistant" and r.max_new_tokens == 512
    with pytest.raises(ValueError):
        generation_requests(df, efforts=False, effort="extreme")
