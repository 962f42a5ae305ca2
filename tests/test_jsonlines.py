"""JSON lines in stored order, whatever the split size; malformed lines told apart."""

import gzip
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from quire.operators.select import first_rows_exact, with_position
from quire.plans import jobs
from quire.sources import jsonlines as JL
from quire.sources.tables import Rejected, load_prepared, open_table


def talk(text):
    return {"messages": [{"role": "user", "content": text}, {"role": "assistant", "content": "a"}]}


def put(folder, name, rows):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    body = "".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows).encode()
    with (gzip.open if name.endswith(".gz") else open)(path, "wb") as f:
        f.write(body)
    return path


def first_text(df, n, order=()):
    return [r["t"] for r in first_rows_exact(df, list(order), n).orderBy("src_file", "src_row").select(F.col("messages")[0]["content"].alias("t")).collect()]


def test_every_line_is_in_one_range():
    r = random.Random(4)
    for _ in range(60):
        body = b"".join(bytes(r.choice(b"ab \r") for _ in range(r.randrange(0, 12))) + b"\n" for _ in range(r.randrange(0, 20)))
        body = body[:-1] if r.random() < 0.5 else body
        want, at = [], 0
        for line in body.split(b"\n"):
            want.append((at, line))
            at += len(line) + 1
        if want[-1][1] == b"":
            want.pop()
        for split in (1, 2, 5, 13, 1000):
            got = []
            for start in range(0, max(1, len(body)), split):
                for offsets, lines in JL.line_blocks(io.BytesIO(body), start, min(len(body), start + split), chunk=r.choice([1, 3, 8, 100])):
                    got += zip(offsets, lines)
            assert [x for x in got if x[1]] == [x for x in want if x[1]]
    with pytest.raises(ValueError, match="offset 2"):
        list(JL.line_blocks(io.BytesIO(b"a\n" + b"x" * 50), 0, 60, chunk=4, limit=20))


@pytest.mark.parametrize("split", [700, 9000, 1 << 20])
def test_first_rows_follow_files_of_unequal_size(spark, tmp_path, split):
    put(tmp_path, "a.jsonl", [talk(f"a{i}") for i in range(3)])
    put(tmp_path, "b.jsonl", [talk(f"b{i}" + "x" * (40 * i)) for i in range(50)])
    put(tmp_path, "c/d.jsonl.gz", [talk(f"d{i}") for i in range(5)])
    put(tmp_path, "_hidden.jsonl", [talk("no")])
    df = open_table(spark, str(tmp_path), position=True, split_bytes=split)
    assert first_text(df, 3) == ["a0", "a1", "a2"] and first_text(df, 5)[3:] == ["b0", "b1x".ljust(42, "x")]
    all_ = first_text(df, 100)
    assert len(all_) == 58 and [t.split("x")[0] for t in all_] == [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(50)] + [f"d{i}" for i in range(5)]
    assert open_table(spark, str(tmp_path), split_bytes=split).columns == ["messages"]


def test_positions_of_tables_that_sparks_own_readers_read(spark, tmp_path):
    put(tmp_path, "a.jsonl", [talk(f"a{i}") for i in range(3)])
    put(tmp_path, "b.jsonl", [talk(f"b{i}") for i in range(200)])
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = with_position(spark.read.json(str(tmp_path)))
        assert first_text(df, 203) == [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(200)]
        assert df.select("src_file", "src_row").distinct().count() == 203
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_stores_that_only_spark_opens(spark, tmp_path, monkeypatch):
    put(tmp_path, "a.jsonl", [talk(f"a{i}") for i in range(3)] + [""])
    put(tmp_path, "b.jsonl", [talk(f"b{i}") for i in range(30)])

    def closed(path):
        raise ValueError("unknown scheme")

    monkeypatch.setattr(JL, "_store", closed)
    assert first_text(open_table(spark, f"file://{tmp_path}", "json", position=True), 4) == ["a0", "a1", "a2", "b0"]


BROKEN = ['{"messages": [{"role": "user"', "[1, 2]", '"text"', '{"messages": "no list"}', "\x00"]


@pytest.mark.parametrize("bad", BROKEN)
def test_a_broken_line_is_no_row(spark, tmp_path, bad):
    path = put(tmp_path, "rows.jsonl", [talk("one"), bad, "  ", talk("two")])
    with pytest.raises(ValueError, match="1 of 3 lines are malformed, the first at byte"):
        open_table(spark, path)
    found = Rejected()
    df = open_table(spark, path, max_bad_share=0.4, rejected=found)
    assert sorted(r["t"] for r in df.select(F.col("messages")[0]["content"].alias("t")).collect()) == ["one", "two"]
    assert (found.lines, found.rejected) == (3, 1)
    (row,) = found.rows.collect()
    assert row["line"] == bad and row["src_file"] == "rows.jsonl" and open(path, "rb").read()[row["src_row"]:].startswith(bad.encode())


def test_bytes_that_are_no_text(spark, tmp_path):
    path = os.path.join(str(tmp_path), "rows.jsonl")
    with open(path, "wb") as f:
        f.write(b"\xef\xbb\xbf" + json.dumps(talk("é")).encode() + b"\r\n" + b'{"id": "\xff"}\n' + json.dumps(talk("z")).encode())
    found = Rejected()
    df = open_table(spark, path, max_bad_share=0.5, rejected=found)
    assert df.count() == 2 and found.rejected == 1
    with pytest.raises(FileNotFoundError):
        open_table(spark, os.path.join(str(tmp_path), "none.jsonl"))


def test_the_job_counts_and_keeps_rejected_lines(spark, tmp_path, capsys):
    put(tmp_path / "in", "a.jsonl", [talk(f"a{i}") for i in range(9)] + BROKEN[:1])
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    with pytest.raises(ValueError, match="malformed"):
        jobs.prepare_dataset(spark, str(tmp_path / "in"), out)
    assert not os.path.exists(out)
    jobs.main(["prepare", "--dataset", str(tmp_path / "in"), "--out", out, "--max-bad-share", "0.1", "--bad-rows", bad])
    assert "wrote 9 samples" in (said := capsys.readouterr().out) and "rejected 1 of 10 lines" in said
    assert [r["line"] for r in spark.read.parquet(bad).collect()] == BROKEN[:1]
    assert load_prepared(spark, out).count() == 9 and load_prepared(spark, out).where("text is null").count() == 0
