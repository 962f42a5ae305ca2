import numpy as np
import pytest
from helpers import awkward, sentence
from pyspark.sql import functions as F

from quire.llm import mixing as M


def test_targets_share_by_weight_and_stop_at_the_cap():
    assert M.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    t = M.targets([10, 1000, 1000], [5, 2, 1])
    assert t[0] == 30 and sum(t) == pytest.approx(2010) and t[1] == pytest.approx(2 * t[2])
    assert M.targets([], []) == [] and M.targets([0, 5], [5, 1]) == [0, 5]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 1000, 4097])
def test_permutation_is_one(n):
    p = M.permuted(np.arange(n), n, 12345)
    assert sorted(p.tolist()) == list(range(n))
    assert n < 10 or p.tolist() != M.permuted(np.arange(n), n, 54321).tolist()


def test_shards_draw_all_slots_once():
    totals, slots = [1000, 37, 0, 463], 64
    shards = -(-sum(totals) // slots)
    got = [M.shard_draw(totals, s, shards, slots, 7) for s in range(shards)]
    assert np.array([c for c, _ in got]).sum(0).tolist() == totals
    assert all(sum(c) == slots for c, _ in got[:-1])
    run = np.zeros(4, int)
    for c, before in got:
        assert run.tolist() == before
        run += c
    assert got == [M.shard_draw(totals, s, shards, slots, 7) for s in range(shards)]


def test_taken_meets_targets_and_never_exceeds_three_times(spark):
    rows = [(i, sentence(i, 5 + i % 90), f"s{i % 4 if i % 3 else 0}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    a = M.Mix(docs, block_words=16, shard_slots=100).taken().toPandas()
    assert (a["taken"] <= 3 * a["size"]).all() and len(a) == 600
    got = a.groupby("src").agg(t=("target", "first"), k=("taken", "sum"), s=("size", "sum"), z=("source_size", "first"))
    assert (got["s"] == got["z"]).all() and ((got["k"] - got["t"]).abs() <= 32).all()
    b = M.Mix(docs.repartition(3), block_words=16, shard_slots=100).taken().toPandas()
    key = ["doc_id", "taken"]
    assert a[key].sort_values(key).values.tolist() == b[key].sort_values(key).values.tolist()


def test_mixture_rows_are_what_taken_counts(spark):
    docs = spark.createDataFrame([(i, sentence(i, 40), f"s{i % 2}") for i in range(30)], "doc_id long, text string, source string")
    mix = M.Mix(docs, block_words=16, shard_slots=32)
    rows = mix.mixture().groupBy("doc_id").agg(F.sum("words").alias("w")).toPandas().set_index("doc_id")["w"].to_dict()
    assert rows == {r["doc_id"]: r["taken"] for r in mix.taken().collect() if r["taken"]}
    assert mix.slots().select("shard", "slot").distinct().count() == mix.slots().count()


def test_taken_equals_a_walk_over_the_drawn_slots(spark):
    rows = [(i if i % 9 else None, sentence(i, (i * 37) % 60), f"s{i % 4}" if i % 5 else None) for i in range(150)]
    mix = M.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), block_words=8, shard_slots=40)
    words = {}  # of each source, the row that each of its words is from
    for p in mix.placed().orderBy("src", "start", "size").collect():
        mine = words.setdefault(p["src"], [])
        assert p["start"] == len(mine)
        mine += [p["row"]] * p["size"]
    want, drawn = {}, {}
    for s in mix.slots().collect():
        drawn.setdefault((s["src"], s["epoch"]), []).append(s["block"])
        for row in words[s["src"]][8 * s["block"]:8 * s["block"] + 8]:
            want[row] = want.get(row, 0) + 1
    got = {t["row"]: t["taken"] for t in mix.taken().collect()}
    assert {r: n for r, n in got.items() if n} == want and len(got) == 150
    for (src, epoch), blocks in drawn.items():  # no block twice in one pass over its source
        assert len(set(blocks)) == len(blocks) and max(blocks) < -(-len(words[src]) // 8)


def test_documents_hold_the_words_taken(spark):
    docs = awkward(spark)
    mix = M.Mix(docs, block_words=16)
    out = mix.documents(docs)
    assert out.columns == docs.columns
    words = out.select(F.sum(F.regexp_count("text", F.lit(M.WORD)))).first()[0]
    assert words == sum(r["taken"] for r in mix.taken().collect())
    assert out.where("n_chars != length(text)").isEmpty()


def test_cut_words_keeps_white_space():
    text = " a  b\tc\nd"
    assert M.cut_words(text, [(0, 0, 4)]) == text
    assert M.cut_words(text, [(0, 0, 2), (0, 2, 2)]) == text
    assert M.cut_words(text, [(0, 1, 1), (1, 3, 1)]) == "b\td"
    assert M.cut_words("x", [(0, 0, 1), (1, 0, 1)]) == "x\nx"


def test_awkward_rows_and_empty_table(spark):
    got = M.Mix(awkward(spark)).taken()
    rows = {(r["doc_id"], r["size"]) for r in got.collect()}
    assert (1, 0) in rows and (2, 0) in rows and (3, 0) in rows and (5, 6000) in rows and got.count() == 12
    assert M.Mix(awkward(spark).limit(0)).taken().count() == 0
    with pytest.raises(ValueError):
        M.Mix(awkward(spark), block_words=0)
