import hashlib
import os
import random

import pytest
from helpers import awkward, sentence
from pyspark.sql import functions as F

from quire.llm import fingerprints as G
from quire.session import checkpoint_dir


def shingle_set(t):
    w = t.split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def expected_edits(rows):
    """By descending id: the last third of a text replaced by the head of the next one."""
    rows = sorted(rows, reverse=True)
    out = {}
    for k, (i, t) in enumerate(rows):
        cut, after = len(t) // 3, rows[(k + 1) % len(rows)][1]
        out[i] = t[:len(t) - cut] + after[:cut]
    return out


def test_edits_and_estimates(spark):
    r = random.Random(6)
    rows = [(i * 7 - 300, sentence(i, r.randrange(0, 900))) for i in range(120)]
    rows += [(10**12 + i, "é日\U0001f600 " * i) for i in range(6)] + [(-10**15, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {x["doc_id"]: x for x in G.compared(docs).collect()}
    edits, order = expected_edits(rows), sorted(rows, reverse=True)
    error = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edits[i].encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and got[i]["near_next"] == pytest.approx(jaccard(t, after), abs=0.5)
        error.append(got[i]["near_edited"] - jaccard(t, edits[i]))
    assert (sum(e * e for e in error) / len(error)) ** 0.5 < 0.12


def test_sketch_keeps_all_hashes_below_the_threshold(spark):
    df = spark.createDataFrame([(1, sentence(1, 2000)), (2, sentence(1, 30)), (3, "a b")], "id long, t string")
    rows = {r["id"]: r for r in G.sketch(df, "t", "s").withColumn("n", F.size("s")).collect()}
    assert all(x < G.TOP // G.SCALE for x in rows[1]["s"]) and 180 < rows[1]["n"] < 320
    assert rows[2]["n"] == G.LEAST and rows[3]["n"] == 1 and rows[1]["s"] == sorted(rows[1]["s"])


def test_containment_of_unequal_texts_and_merging(spark):
    whole, part, other = sentence(1, 4000), " ".join(sentence(1, 4000).split()[500:1500]), sentence(2, 900)
    df = spark.createDataFrame([(whole, part, other)], "w string, p string, o string")
    for c in "wpo":
        df = G.sketch(df, c, c + "s")
    one = df.select(G.containment(F.col("ps"), F.col("ws")).alias("in"), G.containment(F.col("ws"), F.col("ps")).alias("out"),
                    G.containment(F.col("os"), F.col("ws")).alias("far"),
                    G.containment(F.col("os"), G.merged(F.col("ws"), F.col("os"))).alias("both")).first()
    assert one["in"] == 1 and one["out"] == pytest.approx(0.25, abs=0.08) and one["far"] < 0.05 and one["both"] == 1


def test_order_is_the_whole_order(spark):
    df = spark.createDataFrame([(i * i % 1009,) for i in range(500)], "k long").distinct().repartition(9)
    rows = sorted(G.in_order(df, "k").collect(), key=lambda r: r["place"])
    assert [r["place"] for r in rows] == list(range(len(rows))) and [r["k"] for r in rows] == sorted((r["k"] for r in rows), reverse=True)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = G.compared(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10]
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] == by[3]["fingerprint"] == "" and by[5]["fingerprint"] == by[6]["fingerprint"] != ""
    assert by[7]["near_next"] < 0.1 and by[8]["near_next"] == 1 and by[2]["near_next"] == 1 and by[1]["n_chars"] == 0
    assert G.compared(docs.limit(0)).count() == 0
    alone = G.compared(docs.where("doc_id = 7")).first()
    assert alone["near_next"] == 1


def test_the_shared_folder_gets_ids_alone(spark):
    docs = spark.createDataFrame([(i, sentence(i, 300)) for i in range(40)], "doc_id long, text string")
    folder = checkpoint_dir(spark)
    there = set(os.listdir(folder))
    assert len(G.compared(docs).collect()) == 40
    written = [n for n in set(os.listdir(folder)) - there if n.startswith("quire-")]
    assert written and all(t == "bigint" for n in written for _, t in spark.read.parquet(f"{folder}/{n}").dtypes)


def test_repeated_ids_compare_with_one_text_of_the_next_id(spark):
    rows = [(3, sentence(1, 200)), (2, sentence(1, 150) + " " + sentence(2, 60)), (2, sentence(3, 90)), (2, sentence(3, 90)), (2, ""), (1, sentence(4, 40)), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    s = G.sketch(docs.where("doc_id = 2"), "text", "c")
    stands = s.orderBy(F.xxhash64("text")).first()["text"]
    c = s.select(F.min_by("c", F.xxhash64("c")).alias("c"))
    likely = G.sketch(docs.where("doc_id = 3"), "text", "a").crossJoin(c).select(G.likeness(F.col("a"), F.col("c"))).first()[0]
    got = G.compared(docs).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 2, 2, 2, 3]
    three, text = next(r for r in got if r["doc_id"] == 3), rows[0][1]
    cut = len(text) // 3
    assert three["near_next"] == likely
    assert three["edited_sha256"] == hashlib.sha256((text[:len(text) - cut] + stands[:cut]).encode()).hexdigest()
    e = G.edited(docs)
    assert e.columns == ["doc_id", "text", "n_chars", "edited", "next_id"] and {(r["doc_id"], r["next_id"]) for r in e.collect()} == {(3, 2), (2, 1), (1, 3)}
