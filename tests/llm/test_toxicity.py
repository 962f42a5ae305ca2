import itertools
import random

import numpy as np
import pytest
from helpers import awkward, sentence

from quire.llm import toxicity as X


def brute(crf, words):
    """Marginals by the sum over all labellings."""
    s = [crf.state[0] + (crf.weight(w) or 0.0) for w in words]
    p, z = np.zeros(len(words)), 0.0
    for y in itertools.product((0, 1), repeat=len(words)):
        v = sum(si for si, yi in zip(s, y) if yi) + sum(crf.trans[a, b] for a, b in zip(y, y[1:])) + (crf.start if y[0] else 0.0)
        z += np.exp(v)
        p += np.exp(v) * np.array(y)
    return p / z


def test_marginals_equal_the_sum_over_labellings():
    r = np.random.default_rng(3)
    for n in range(1, 11):
        crf = X.Crf(words={"=bad": 1, "^ugl": 2}, state=np.array([-1.5, 3.0, 1.1]), trans=r.normal(size=(2, 2)), start=0.3, heads=frozenset(["bad", "ugl"]))
        words = [random.Random(n).choice(["bad", "ugly", "a", "b"]) for _ in range(n - 1)] + ["bad"]
        hits = [i for i, w in enumerate(words) if crf.weight(w) is not None]
        got = crf.marginals(hits, [crf.weight(words[i]) for i in hits], n, {})
        assert got == pytest.approx(brute(crf, words)[hits], rel=1e-9)


def test_spans_are_offsets_of_the_text():
    crf = X.Crf(words={"=scum": 1}, state=np.array([-6.0, 12.0]), heads=frozenset(["scu"]))
    text = "É fine. Scum scum, fine"
    assert [text[a:b] for a, b in crf.read(text, {})[1]] == ["Scum scum"]
    assert crf.read("", {}) == (0.0, []) and crf.read(None, {}) == (0.0, [])


@pytest.fixture(scope="module")
def corpus(spark):
    rows, r = [], random.Random(5)
    for i in range(600):
        w, toxic = sentence(i, 60).split(), int(i % 5 == 0)
        for _ in range(3 if toxic else 0):
            w.insert(r.randrange(60), "grzk" + r.choice(["", "en", "ov", "ua"]))
        rows.append((i, " ".join(w), toxic))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_documents_are_told_apart(spark, corpus):
    crf = X.trained(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    p = X.score(corpus, crf, prefix="t_").where(X.held_out()).toPandas()
    assert 100 < len(p) < 200
    assert (p[p.toxic == 1].t_score >= 0.3).mean() > 0.95 and (p[p.toxic == 0].t_score < 0.3).all()
    hit = p[p.toxic == 1].iloc[0]
    assert all(hit.text[s["start"]:s["end"]].startswith("grzk") for s in hit.t_spans)


def test_learning_ignores_held_out_labels(spark, corpus):
    from pyspark.sql import functions as F

    flipped = corpus.select("doc_id", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    a = X.trained(corpus, corpus.select("doc_id", "toxic"))
    b = X.trained(corpus, flipped)
    assert a.words == b.words and np.array_equal(a.state, b.state) and a.knots == b.knots


def test_awkward_rows_and_nothing_to_learn(spark, corpus):
    crf = X.trained(corpus, corpus.select("doc_id", "toxic"))
    rows = X.score(awkward(spark), crf).collect()
    assert len(rows) == 12 and all(0 <= r["tox_score"] <= 1 for r in rows)
    assert len({r["tox_score"] for r in rows if not (r["text"] or "").strip()}) == 1
    none = X.trained(corpus.limit(0), corpus.select("doc_id", "toxic"))
    assert none.words == {} and len({r["tox_score"] for r in X.score(corpus, none).collect()}) == 1
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert X.trained(corpus, labels).words == {}
