import hashlib
import random
import re

import numpy as np
import pytest
from helpers import awkward, sentence
from pyspark.sql import functions as F

from quire.llm import fim


def test_skip_list_reaches_every_rank():
    r = random.Random(4)
    for n in (0, 1, 2, 15, 16, 17, 300, 5000):
        widths = np.array([r.randrange(0, 9) for _ in range(n)], np.int64)
        units, sums = fim.SkipList(widths), np.concatenate(([0], np.cumsum(widths)))
        ranks = range(n + 1) if n < 400 else [0, n, *(r.randrange(n) for _ in range(300))]
        assert [units.code_points(k) for k in ranks] == [sums[k] for k in ranks]
        with pytest.raises(IndexError):
            units.code_points(n + 1)


def test_lanes_beyond_the_kept_heights_and_their_widths():
    n = fim._CACHED + 70_000
    units = fim.SkipList(np.full(n, 3, np.uint8))
    assert len(units.lanes) >= 4 and all(int(c.sum()) == 3 * n for _, c, _ in units.lanes)
    assert all(int(w.sum()) == n for w, _, _ in units.lanes[1:])
    assert abs(len(units.lanes[1][1]) - n / fim.RISE) < 0.05 * n / fim.RISE
    at = [0, 1, fim._CACHED - 1, fim._CACHED, fim._CACHED + 1, n - 1, n]
    assert [units.code_points(k) for k in at] == [3 * k for k in at]
    whole = np.concatenate([x for x in fim.risen(0, n)[:1]])
    assert np.array_equal(whole, fim._lanes(n)[0])


def expected(i, text):
    """The contract, cut by slices."""
    h = [int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, "<S>" + text[b:] + "<P>" + text[:a] + "<M>" + text[a:b]
    return n, "psm", a, b - a, "<P>" + text[:a] + "<S>" + text[b:] + "<M>" + text[a:b]


def test_against_slices_and_exact_round_trip(spark):
    r = random.Random(8)
    bits = ["<", ">", "P", "S", "M", "<P", "S>", "é", "日", "\U0001f600", " ", "\n", "abc", "́"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randrange(0, 60)))) for i in range(-50, 500)]
    rows += [(1000, "x<P>y"), (1001, "a<M>"), (1002, "<S>"), (1003, "z" * 300_000), (1004, "ab\x00c")]
    got = fim.transformed(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = got.withColumn("back", fim.restored(F.col("fim_output"), F.col("fim_form"))).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x["fim_n"], x["fim_form"], x["fim_prefix_chars"], x["fim_middle_chars"], x["fim_output"]) == expected(x["doc_id"], x["text"])
        assert x["back"] == x["text"]
    assert {x["fim_form"] for x in got} == {"plain", "psm", "spm"}


def test_units_of_a_pattern(spark):
    text = "  one two\nthree  日本 four "
    widths = fim.unit_widths(text, re.compile(r"\S+\s*"))
    assert widths.tolist() == [6, 4, 7, 3, 5] and widths.sum() == len(text)
    assert fim.unit_widths("   ", re.compile(r"\S+")).tolist() == [3] and fim.unit_widths("", re.compile("x")).tolist() == []
    docs = spark.createDataFrame([(i, sentence(i, i)) for i in range(60)], "doc_id long, text string")
    for x in fim.transformed(docs, pattern=r"\S+\s*").collect():
        assert x["fim_n"] == x["doc_id"]
        if x["fim_form"] != "plain":
            cut = x["fim_prefix_chars"]
            assert cut in (0, len(x["text"])) or x["text"][cut - 1] == " "


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = fim.transformed(docs).collect()
    assert len(got) == docs.count() and got[0].asDict().keys() == {*docs.columns, "fim_n", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_output"}
    by = {}
    for x in got:
        assert (x["fim_n"], x["fim_form"], x["fim_prefix_chars"], x["fim_middle_chars"], x["fim_output"]) == expected(x["doc_id"], x["text"] or "")
        by.setdefault(x["doc_id"], set()).add(x["fim_output"])
    assert all(len(v) == 1 for v in by.values())
    assert fim.transformed(docs.limit(0)).count() == 0
    odd = docs.withColumnsRenamed({"doc_id": "my id", "text": "a.b"})
    assert fim.transformed(odd, "my id", "a.b").count() == docs.count()
    with pytest.raises(ValueError):
        fim.transformed(docs.withColumn("FIM_n", F.lit(1)))
