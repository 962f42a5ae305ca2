import hashlib

from pyspark.sql import functions as F

from quire.llm import warc as W


def pages(spark, n=300):
    rows = [(i if i % 50 else None, f"http://h/{i}" if i % 7 else None, "é" * (i % 90) if i % 11 else None, "clash") for i in range(n)]
    rows += rows[:3]
    return spark.createDataFrame(rows, "page_id long, url string, html string, number string").repartition(3)


def test_records_are_warc(spark):
    df = spark.createDataFrame([(5, "http://x/", "é")], "i long, u string, b string")
    raw = bytes(df.select(W.record(F.col("i"), F.col("u"), F.col("b")).alias("r")).first()["r"])
    head, body = raw.split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.0\r\n") and b"WARC-Target-URI: http://x/" in head and b"Content-Length: 2" in head
    assert body == "é".encode() + b"\r\n\r\n"


def test_tree_hashes_ranges_of_records(spark):
    a = W.archived(pages(spark))
    raw = {r["number"]: bytes(r["record"]) for r in a.collect()}
    assert sorted(raw) == list(range(303))
    levels = W.tree(W.leaves(a), W.height(303, 4), 4)
    want = {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in raw.items()}
    for level in levels:
        assert {r["number"]: (r["size"], r["hash"]) for r in level.collect()} == want
        up = {}
        for k in sorted(want):
            up.setdefault(k // 4, []).append(f"{k}:{want[k][0]}:{want[k][1]}")
        size = {p: sum(want[k][0] for k in want if k // 4 == p) for p in up}
        want = {p: (size[p], hashlib.sha256("|".join(c).encode()).hexdigest()) for p, c in up.items()}
    assert len(levels) == 6 and levels[-1].count() == 1


def test_only_damaged_paths_are_compared(spark):
    a = W.archived(pages(spark))
    h = W.height(303, 4)
    x = W.tree(W.leaves(a), h, 4)
    bad, compared = W.audit(x, x, 4)
    assert bad.isEmpty() and compared == [1]
    y = W.tree(W.leaves(a.withColumn("record", F.when(F.col("number") == 77, F.lit(b"?")).otherwise(F.col("record")))), h, 4)
    bad, compared = W.audit(x, y, 4)
    assert [r["number"] for r in bad.collect()] == [77] and sum(compared) <= 1 + 4 * h


def test_findings_equal_brute_force(spark):
    a = W.archived(pages(spark))
    k = F.pmod("number", F.lit(13))
    b = a.where((k != 3) & (F.col("number") != 302)).withColumn("record", F.when(k == 5, F.reverse(F.hex("record")).cast("binary")).when(
        k == 7, F.expr("concat(substring(record, 1, length(record) - 1), cast('!' as binary))")).otherwise(F.col("record")))
    b = b.unionByName(a.where("number < 2").withColumn("number", F.col("number") + 400))
    got = {r["number"]: r for r in W.findings(a, b, fanout=4, file_levels=2).collect()}
    left, right = ({r["number"]: bytes(r["record"]) for r in t.collect()} for t in (a, b))
    want = {}
    for n in left.keys() | right.keys():
        p, q = left.get(n), right.get(n)
        if p != q:
            want[n] = "missing" if q is None else "extra" if p is None else "resized" if len(p) != len(q) else "altered"
    assert {n: r["kind"] for n, r in got.items()} == want and set(want.values()) == {"missing", "extra", "resized", "altered"}
    for n, r in got.items():
        if n in left:
            assert (r["file"], r["file_offset"]) == (n // 16, sum(len(left[m]) for m in range(n // 16 * 16, n)))


def test_empty_tables(spark):
    a = W.archived(pages(spark).limit(0))
    assert a.count() == 0 and W.findings(a, a).count() == 0
    one = W.archived(pages(spark, 1).limit(1))
    assert W.findings(one, one).count() == 0 and [r["kind"] for r in W.findings(one, one.where("false")).collect()] == ["missing"]
