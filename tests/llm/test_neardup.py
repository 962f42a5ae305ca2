import random

import numpy as np
import pytest
from helpers import awkward, sentence

from quire.llm import common
from quire.llm import neardup as N
from quire.llm.common import components


def shingle_set(t):
    w = t.split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    s = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(s)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if s[a] == s[b] and dict(rows)[a] == dict(rows)[b] or s[a] and s[b] and len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in s}


def corpus():
    r, rows = random.Random(3), []
    for i in range(80):
        rows.append((i, sentence(i, r.randrange(1, 200))))
    for i in range(80, 160):
        w = rows[r.randrange(8)][1].split()
        for _ in range(r.randrange(0, 4)):
            w[r.randrange(len(w))] = "new" + str(r.randrange(9))
        rows.append((i, " ".join(w)))
    return rows


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["id"]: r["class"] for r in N.classes(docs).collect()}
    assert got == brute(rows)


def crowd():
    """Texts of one template, which share buckets but lie below the threshold, and ten pairs of near copies among them."""
    base, rows = sentence(900, 150), []
    for k in range(150):
        own = [base + f" c{k} d{k} " + " ".join(f"p{i}w{j}" for j in range(17)) for i in (2 * k, 2 * k + 1)]
        rows += [(2 * k, own[0]), (2 * k + 1, own[1])][:2 if k % 15 == 7 else 1]
    return rows


@pytest.mark.parametrize("how", [{}, {"rounds": 0}, {"rounds": 1, "block": 16}])
def test_crowded_buckets_are_compared_in_full(spark, how):
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["id"]: r["class"] for r in N.classes(docs, **how).collect()}
    assert got == brute(rows) == {i: i - i % 2 for i, _ in rows}
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert {r["id"]: r["class"] for r in N.classes(docs, **how).collect()} == brute(rows)


def test_repeats_within_a_text_do_not_part_equal_sets(spark):
    rows = []
    for i in range(12):
        a, menu = sentence(i, 120), sentence(50 + i, 40)
        rows += [(10 * i, a), (10 * i + 1, f"{a} {a}"), (10 * i + 2, f"{menu} {menu}"), (10 * i + 3, " ".join([menu] * 16))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["id"]: r["class"] for r in N.classes(docs).collect()} == brute(rows) == {i: i - i % 2 for i, _ in rows}


def test_agreement_estimates_weighted_jaccard():
    r = np.random.default_rng(1)
    e = r.integers(0, 2**62, 400).astype(np.uint64)
    wa, wb = r.uniform(0.2, 5, 400), r.uniform(0.2, 5, 400)
    wa[300:], wb[:100] = 0, 0
    ia, ib = wa > 0, wb > 0
    sig = N.signatures(np.concatenate([e[ia], e[ib]]), np.concatenate([wa[ia], wb[ib]]),
                       np.concatenate([np.zeros(ia.sum(), int), np.ones(ib.sum(), int)]), 2, 4000)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.035)


def test_signature_does_not_depend_on_the_batch():
    e = [np.arange(1, n + 1).astype(np.uint64) * np.uint64(7919) for n in (1, 30, 500)]
    flat = N.signatures(np.concatenate(e), np.ones(531), np.repeat([0, 1, 2], [1, 30, 500]), 3)
    for k, x in enumerate(e):
        assert (N.signatures(x, np.ones(len(x)), np.zeros(len(x), int), 1)[0] == flat[k]).all()


def test_a_round_of_components_is_one_job_and_leaves_no_table(spark, monkeypatch):
    written, asked = [], []
    monkeypatch.setattr(common, "saved", lambda df, name, save=common.saved: written.append(save(df, name)) or written[-1])
    edges = spark.createDataFrame([(k, k + 1) for k in range(400)] + [(1000, 1000 + k) for k in range(5)] + [(5, 4), (None, 3)], "a long, b long")
    for action in ("isEmpty", "count", "collect", "take"):
        monkeypatch.setattr(type(edges), action, lambda df, *a, run=getattr(type(edges), action), **b: asked.append(df) or run(df, *a, **b))
    cc = components(edges)
    assert not asked and len(written) > 4  # nothing is run between the rounds' writes
    there = [spark._jvm.java.io.File(t._saved_at.removeprefix("file:")).exists() for t in written]
    assert there == [False] * (len(written) - 1) + [True]
    rows = [tuple(r) for r in cc.collect()]
    assert sorted(rows) == [(k, 0, 401) for k in range(401)] + [(1000 + k, 1000, 5) for k in range(5)]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(159, 200), (7, 7), (3, 4), (None, 5)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = sorted((r["id"], r["class"]) for r in N.classes(docs).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 5), (6, 5), (7, 7), (8, 7), (9, 9), (10, 10)]
    kept = N.one_of_each(docs)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 7, 9, 10] and kept.columns == docs.columns
    assert N.classes(docs.limit(0)).count() == 0


def test_texts_of_one_id_are_one_document(spark):
    a, b = sentence(1, 60), sentence(2, 60)
    x, y = " ".join(a.split()[:-1]), " ".join(b.split()[:-1])
    rows = [(1, a), (1, b), (2, x), (3, y), (9, sentence(3, 60)), (5, a)]
    for k in range(3):
        docs = spark.createDataFrame(rows[k:] + rows[:k], "doc_id long, text string").repartition(3)
        assert sorted((r["id"], r["class"]) for r in N.classes(docs).collect()) == [(1, 1), (1, 1), (2, 1), (3, 1), (5, 1), (9, 9)]
        kept = N.one_of_each(docs).collect()
        assert [r["doc_id"] for r in sorted(kept)] == [1, 9] and len({r["text"] for r in kept}) == 2


def test_long_texts_are_sketched_in_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    words = [f"w{i}" for i in range(50_000)]
    r = random.Random(5)
    rows = [" ".join(r.choices(words, k=170_000)) for _ in range(16)]  # of about 1 MB each
    batch = pa.RecordBatch.from_pydict({"id": list(range(16)), "h1": [0] * 16, "h2": [0] * 16, "text": rows})
    sketch = N._sketch(N.COORDS, N.BAND_ROWS)
    tracemalloc.start()
    got = [x for out in sketch([batch]) for x in out.column("sig").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(set(got)) == 16 and peak < 100 << 20


def test_a_signature_does_not_depend_on_how_its_shingles_are_taken(monkeypatch):
    t, words = sentence(8, 5000) + "  x", N._Words()
    e = np.unique(N.shingles(t, words))
    whole = N.signatures(e, np.ones(len(e)), np.zeros(len(e), int), 1)
    monkeypatch.setattr(N, "STREAMS", 100)
    monkeypatch.setattr(N, "PIECE", 57)
    assert (np.unique(N.shingles(t, words)) == e).all()
    assert (N.signatures(e, np.ones(len(e)), np.zeros(len(e), int), 1) == whole).all()


def test_awkward_names(spark):
    docs = awkward(spark).withColumnsRenamed({"doc_id": "my id", "text": "a.b"}).selectExpr("*", "1 as nd_text", "2 as rep", "3 as `class`", "4 as c0")
    assert sorted(r["my id"] or 0 for r in N.one_of_each(docs, "my id", "a.b").collect()) == [0, 1, 3, 4, 5, 7, 9, 10]
    assert N.one_of_each(docs, "my id", "a.b").columns == docs.columns
