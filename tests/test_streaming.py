"""Streaming segmentation equals batch segmentation; streaming preparation equals batch."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from quire.operators.segments import completion_segments
from quire.sources import tables as TB
from quire.streaming.completions import segment_stream
from quire.streaming.prepare import SHAREGPT_SCHEMA, start_prepare_stream
from quire.plans.prepare import sharegpt_training_text

from conftest import SF_SMALL


def test_stream_segments_equal_batch(spark):
    conv = TB.read_table(spark, SF_SMALL, "conversations")
    comps = TB.completions(conv)
    pieces = TB.completion_chunks(comps)
    rows = pieces.collect()
    random.Random(0).shuffle(rows)  # out of order within and across micro-batches
    src = tempfile.mkdtemp(prefix="quire-stream-src-")
    for k in range(3):
        part = rows[k::3]
        spark.createDataFrame(part, pieces.schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(pieces.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (
        segment_stream(stream).writeStream.format("memory").queryName("segs_out")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="quire-ckpt-seg-"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("segs_out").collect())
    want = sorted(
        tuple(r) for r in completion_segments(comps).select(
            "completion_id", F.col("pos").cast("int"), "channel", "content", "closed").collect()
    )
    assert got == want


def test_prepare_stream_equals_batch(spark):
    conv = TB.read_table(spark, SF_SMALL, "conversations")
    sg = TB.sharegpt_conversations(conv)
    src = tempfile.mkdtemp(prefix="quire-prep-src-")
    sg.repartition(3).write.mode("overwrite").parquet(src)
    out = tempfile.mkdtemp(prefix="quire-prep-out-")
    q = start_prepare_stream(spark, src, os.path.join(out, "t"), name=f"prep-{random.randint(0, 10**9)}")
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "t")).select("id", "text").collect())
    want = sorted(tuple(r) for r in sharegpt_training_text(spark.read.schema(SHAREGPT_SCHEMA).parquet(src)).collect())
    assert got == want and len(got) == conv.select("conv_id").distinct().count()


def test_timeout_flushes_abandoned_and_ignores_replays(spark):
    """With a processing-time timeout: a completion whose last piece never comes is
    flushed (open segment stripped); a replayed piece of a finished one is ignored.
    Timers keep no-data batches running, so the test polls instead of waiting for
    the stream to go idle."""
    import time

    schema = "completion_id long, seq int, chunk string, is_last boolean"
    src = tempfile.mkdtemp(prefix="quire-timeout-src-")
    first = [(1, 0, "<|channel|>analysis<|message|>abc", False), (2, 0, "hello", True)]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (
        segment_stream(stream, idle_timeout_ms=500, retain_finished_ms=600_000).writeStream.format("memory").queryName("segs_timeout")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="quire-ckpt-to-"))
        .outputMode("append").trigger(processingTime="200 milliseconds").start()
    )

    def poll(cond, limit=150):
        deadline = time.time() + limit
        while time.time() < deadline:
            assert q.exception() is None, q.exception()
            rows = sorted(tuple(r) for r in spark.table("segs_timeout").collect())
            if cond(rows):
                return rows
            time.sleep(0.5)
        return sorted(tuple(r) for r in spark.table("segs_timeout").collect())

    try:
        rows = poll(lambda rs: any(r[0] == 1 for r in rs))
        assert (1, 0, "analysis", "abc", False) in rows
        seen = sum(p["numInputRows"] for p in q.recentProgress)
        spark.createDataFrame([(2, 0, "hello", True)], schema).coalesce(1).write.mode("append").parquet(src)
        deadline = time.time() + 150
        while time.time() < deadline and sum(p["numInputRows"] for p in q.recentProgress) <= seen:
            time.sleep(0.5)
        time.sleep(1)
        rows = sorted(tuple(r) for r in spark.table("segs_timeout").collect())
    finally:
        q.stop()
    assert [r for r in rows if r[0] == 2] == [(2, 0, "raw", "hello", True)]


def test_prepare_stream_with_messages_rows(spark):
    from quire.operators.template import render_messages
    from quire.streaming.prepare import MESSAGES_SCHEMA

    rows = [(i, [("user", f"q{i}", None), ("assistant", f"a{i}", f"t{i}")]) for i in range(5)]
    df = spark.createDataFrame(rows, MESSAGES_SCHEMA)
    src = tempfile.mkdtemp(prefix="quire-prep-msg-")
    df.write.mode("overwrite").parquet(src)
    out = tempfile.mkdtemp(prefix="quire-prep-msg-out-")
    q = start_prepare_stream(spark, src, os.path.join(out, "t"), schema=MESSAGES_SCHEMA,
                             name=f"prep-msg-{random.randint(0, 10**9)}")
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "t")).collect())
    assert got == sorted(tuple(r) for r in render_messages(df, keep=["id"]).collect())


def test_second_output_of_one_source_starts_from_the_beginning(spark):
    src = tempfile.mkdtemp(prefix="quire-two-src-")
    rows = [(i, [("human", f"q{i}"), ("gpt", f"a{i}")]) for i in range(5)]
    spark.createDataFrame(rows, SHAREGPT_SCHEMA).write.mode("overwrite").parquet(src)
    outs = [os.path.join(tempfile.mkdtemp(prefix="quire-two-out-"), "t") for _ in range(2)]
    for out in [*outs, outs[0]]:  # the third run finds nothing new
        start_prepare_stream(spark, src, out).awaitTermination(300)
    assert [spark.read.parquet(o).count() for o in outs] == [5, 5]


def test_replays_of_finished_completions_are_ignored_by_default(spark):
    schema = "completion_id long, seq int, chunk string, is_last boolean"
    src, ckpt = tempfile.mkdtemp(prefix="quire-replay-src-"), tempfile.mkdtemp(prefix="quire-replay-ckpt-")
    whole = [(1, 0, "he", False), (1, 1, "llo", True)]
    out = os.path.join(tempfile.mkdtemp(prefix="quire-replay-out-"), "t")
    for rows in (whole, whole, whole[1:]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        q = segment_stream(spark.readStream.schema(schema).parquet(src)).writeStream.format("parquet").option(
            "checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start(out)
        assert q.awaitTermination(300) and q.exception() is None
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, 0, "raw", "hello", True)]


def test_many_small_pieces_scan_only_new_text(monkeypatch):
    from quire.streaming import segmenter as S

    scanned = []

    class Counting:
        def finditer(self, text, at=0):
            scanned.append(len(text) - at)
            return S_RE.finditer(text, at)

    S_RE = S._SEGMENT_RE
    monkeypatch.setattr(S, "_SEGMENT_RE", Counting())
    text = "<|channel|>analysis<|message|>" + "x" * 20_000 + "<|end|>" + "raw " * 3000
    buf, known, open_at, rows = "", 0, -1, []
    for i in range(0, len(text), 10):
        buf += text[i:i + 10]
        out, buf, open_at = S.advance(buf, False, known, open_at)
        rows += out
        known = len(buf)
    rows += S.advance(buf, True, known, open_at)[0]
    assert rows == [("analysis", "x" * 20_000, True), ("raw", "raw " * 3000, True)]
    assert sum(scanned) < 20 * len(text)
