import math
import random
import re
from collections import Counter

import numpy as np
from helpers import awkward, sentence
from pyspark.sql import functions as F

from quire.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in TERM.findall(t or "")]


def brute(docs, items, k):
    """Every document scored for every item, in Python integers."""
    tf = [(i, Counter(words(t))) for i, t in docs]
    n = [c.total() for _, c in tf]
    N, L = sum(x > 0 for x in n), sum(n)
    df = Counter(w for _, c in tf for w in c)
    out = set()
    for item in {i for i, _ in items if i is not None}:
        terms = {w for i, t in items if i == item for w in words(t)}
        scores = []
        for (i, c), x in zip(tf, n):
            m = 100 - 50 + (50 * x * N) // L if L else 0
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 20 * m)) for w in terms if c[w])
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        out |= {(item, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def rows(df):
    return {(x["item"], x["rank"], x["doc"], x["score"]) for x in df.collect()}


def corpus(seed, n):
    r = random.Random(seed)
    base = [sentence(k, r.randrange(1, 120)) for k in range(n)]
    docs = [(i * 3 - 50, t) for i, t in enumerate(base)]
    docs += [(5000 + i, base[7]) for i in range(90)]  # more equal scores than places
    docs += [(7000 + i, base[9] + f" x{i}É-Ünder_score 9") for i in range(10)]
    items = [(i, " ".join(r.choice(base).split()[:r.randrange(1, 40)])) for i in range(25)] + [(90, base[7]), (91, "nowhere at all"), (92, "É 9 x3É"), (92, base[3])]
    return docs, items


def test_against_brute_force_over_blocks_and_partitions(spark):
    docs, items = corpus(2, 400)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(items, "item_id int, text string")
    want = brute(docs, items, 20)
    assert rows(search.ranked(d.repartition(3), q, k=20)) == want
    assert rows(search.ranked(d.repartition(2), q, k=20, block=700)) == want
    got = search.ranked(d.repartition(5), q, k=20, most_items=9, most_terms=60)
    assert rows(got) == want and len({(x["item"], x["rank"]) for x in got.collect()}) == got.count()


def test_fewer_documents_are_scored_than_there_are():
    docs, items = corpus(4, 3000)
    docs.sort()
    tf, lists = [search.term_counts(t) for _, t in docs], [search.term_counts(t) for _, t in items]
    v = {w: k for k, w in enumerate(sorted({w for x in lists for w in x}))}
    n = np.array([x.total() for x in tf])
    term, rank, f = (np.array(x, np.int64) for x in zip(*((v[w], k, c) for k, x in enumerate(tf) for w, c in x.items() if w in v)))
    w = np.array([search.weight(len(docs), int(k)) for k in np.bincount(term, minlength=len(v))])
    best = search.Best(len(lists), 10)
    p = search.Postings(len(docs), term, rank, search.impacts(w[term], f, n[rank], len(docs), int(n.sum())))
    scored = search.search_block(np.array([i for i, _ in docs]), p, [np.array([v[x] for x in y], np.int64) for y in lists], best)
    assert scored < 0.6 * len(docs) * len(lists)
    assert {(items[i][0], -s, d) for i, s, d in zip(best.item, -best.score, best.doc) if i < 25} == {(i, s, d) for i, _, d, s in brute(docs, items, 10) if i < 25}


def test_terms_in_pieces(monkeypatch):
    t = "Aé_b " + " ".join(f"W{i % 50}" for i in range(3000)) + "\x7fZz日本"
    whole = search.term_counts(t)
    monkeypatch.setattr(search, "_PIECE", 41)
    assert search.term_counts(t) == whole == Counter(w.encode() for w in words(t))


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, "kapa lode misa", 7), (2, None, 7), (3, "", 7), (None, "kapa", 7), (4, "a" * 3000, 7), (5, "É é ONE", 7)], "item_id int, text string, score int")
    want = brute([(x["doc_id"], x["text"]) for x in docs.collect()], [(x["item_id"], x["text"]) for x in items.collect()], 50)
    assert rows(search.ranked(docs, items)) == want and {x[0] for x in want} >= {1, 4, 5}
    assert search.ranked(docs.limit(0), items).count() == 0 and search.ranked(docs, items.limit(0)).count() == 0
    assert search.ranked(docs.where("doc_id in (1, 2, 3)"), items).count() == 0
    odd, also = docs.withColumnsRenamed({"doc_id": "my id", "text": "a.b"}), items.withColumnsRenamed({"item_id": "the item", "text": "a.b"})
    assert rows(search.ranked(odd, also, "my id", "a.b", "the item", "a.b")) == want
    assert rows(search.ranked(docs, items.withColumn("item_id", F.col("item_id").cast("string")))) == {(str(a), b, c, d) for a, b, c, d in want}
