import numpy as np
import pytest

from quire.llm import embeddings as E


def brute(rows, cosine):
    ok = []
    for i, v, label in rows:
        good = v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, float) if good else None)
    ids = [r[0] for r in rows]
    root = {i: i for i in ids}
    links = {i: 0 for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            x, y = ok[a], ok[b]
            if x is None or y is None or rows[a][2] != rows[b][2] or len(x) != len(y):
                continue
            if (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= cosine:
                links[ids[a]] += 1
                links[ids[b]] += 1
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return sorted((i, links[i], find(i), i == find(i)) for i in ids)


def corpus(n=260, d=8):
    r = np.random.default_rng(2)
    rows = []
    for i in range(n):
        if i % 3 == 0 or i < 12:
            v = r.normal(size=d)
        elif i % 3 == 1:
            v = np.array(rows[r.integers(0, 12)][1]) + r.normal(size=d) * 0.15
        else:
            v = np.array(rows[5][1]) * (2.0 if i % 2 else 1.0)
        rows.append((i + 50, [float(x) for x in v], i % 2))
    rows += [(1, None, 0), (2, [0.0] * d, 0), (3, [1.0, None] + [0.0] * (d - 2), 0), (4, [float("nan")] * d, 1), (5, [float("inf")] * d, 1),
             (6, rows[5][1], None), (7, rows[5][1][:4], 1), (8, [], 0), (9, [-0.0] * (d - 1) + [1.0], 1), (10, [0.0] * (d - 1) + [1.0], 1)]
    return rows


@pytest.mark.parametrize("cell,block", [(10_000, 4096), (20, 4096), (15, 8), (10_000, 16)])
def test_links_and_components_equal_brute_force(spark, cell, block):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, label int, node string, v double").repartition(4)
    got = sorted(tuple(r) for r in E.range_join(df, cosine=0.93, cell=cell, block=block).collect())
    assert got == brute(rows, 0.93)


def test_threshold_is_exact(spark):
    c = 0.93
    rows = [(1, [1.0, 0.0], 0), (2, [c, float(np.sqrt(1 - c * c))], 0), (3, [c - 1e-12, float(np.sqrt(1 - c * c))], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in E.range_join(df).collect()) == brute(rows, c)


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0], 0)], "vec_id long, embedding array<float>, label int")
    assert E.range_join(df).count() == 0 and E.range_join(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        E.range_join(df, cosine=0.0)


def test_very_large_and_very_small_components(spark):
    rows = [(1, [1e200, 0.0], 0), (2, [1.1e200, 0.0], 0), (3, [1e-200, 0.0], 0), (4, [1.0, 0.0], 0), (5, [5e-324, 0.0], 0), (6, [0.0, 1e308], 0),
            (7, [1.7e308, 1.7e308], 1), (8, [2.0, 2.0], 1), (9, [3.0, -3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.range_join(df).collect()}
    assert got == {**{i: (4, 1) for i in range(1, 6)}, 6: (0, 6), 7: (1, 7), 8: (1, 7), 9: (0, 9)}


def test_many_labels_beyond_a_cell_take_few_jobs(spark):
    r = np.random.default_rng(7)
    rows = [(i, [float(x) for x in r.normal(size=3)], i % 150) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    counts = []
    for labels in (6, 150):
        sc.setJobGroup(f"vec-{labels}", "count jobs")
        got = sorted(tuple(x) for x in E.range_join(df.where(f"label < {labels}"), cell=3).collect())
        counts.append(len(tracker.getJobIdsForGroup(f"vec-{labels}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    few = [x for x in rows if x[2] < 20]
    ids = {x[0] for x in few}
    assert [x for x in got if x[0] in ids] == brute(few, 0.93)
    assert counts[1] < counts[0] + 100  # rounds of the components may differ, 144 more labels do not count
