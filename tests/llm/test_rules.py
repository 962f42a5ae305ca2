import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward
from pyspark.sql import functions as F

from quire.llm import rules

LANGS = {"aa": "the of and to in is it".split(), "bb": "der die und zu ist von mit".split()}


def prose(lang, seed, n):
    r = random.Random(seed)
    rare = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 9))) for _ in range(n)]
    return " ".join(r.choice(LANGS[lang]) if r.random() < 0.4 else w for w in rare)


def test_counts_against_loops():
    r = random.Random(3)
    texts = ["", " \n\x0b", "a", "a a a a", "a b c a b c", "x y z\nx y z\n\n \nx y z", "# *$ %& |<> é\U0001f600", "a b c\x1fd"]
    texts += ["".join(r.choice(["ab ", "c ", "d\n", "\n", "#", "é ", "\t"]) for _ in range(r.randrange(200))) for _ in range(60)]
    for t in texts:
        words, w = [], ""
        for ch in t + " ":
            if ch in " \t\n\x0b\x0c\r":
                words += [w] * bool(w)
                w = ""
            else:
                w += ch
        grams = Counter(zip(words, words[1:], words[2:]))
        covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        dup = sum(x in lines[:k] for k, x in enumerate(lines))
        got = rules.base_counts(t)[0]
        assert got == [len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in t), dup, len(covered)], t


def test_pieces_cut_no_word(monkeypatch):
    t = " ".join(f"w{i}" for i in range(2000)) + "x" * 500
    whole = rules.base_counts(t)
    monkeypatch.setattr(rules, "_PIECE", 97)
    assert "".join(rules.pieces(t)) == t
    parts = rules.base_counts(t)
    assert whole[0] == parts[0] and np.array_equal(whole[1], parts[1]) and np.array_equal(whole[3], parts[3])


def test_distance_is_jensen_shannon():
    r = np.random.default_rng(1)
    p, q = r.integers(0, 9, (20, 6)), r.random(6)
    q /= q.sum()
    for row, d in zip(p, rules.distances(p.astype(float), q)):
        x = row / row.sum()
        m = (x + q) / 2
        kl = lambda a: sum(u * math.log2(u / v) for u, v in zip(a, m) if u > 0)
        assert d == pytest.approx(math.sqrt((kl(x) + kl(q)) / 2))
    assert rules.distances(np.zeros((1, 6)), q)[0] == 1


def test_keeps_prose_and_drops_what_differs(spark):
    r = random.Random(5)
    rows = [(i, prose(la, i, 300), la) for i in range(40) for la in LANGS]
    junk = [(100, " ".join(w + "***" for w in prose("aa", 7, 300).split()), "aa"), (101, prose("bb", 8, 300).upper() + "!!", "bb"),
            (102, prose("aa", 9, 49), "aa"), (103, "one two three " * 60, "aa"),
            (104, " ".join("".join(r.choice("klmnopq") for _ in range(6)) for _ in range(200)), "aa")]
    fine = [(200, prose("bb", 10, 200), "aa"), (201, prose("aa", 11, 200), None), (202, prose("aa", 12, 200), "zz")]
    docs = spark.createDataFrame(rows + junk + fine, "doc_id long, text string, lang string").repartition(6)
    got = {(x["doc_id"], x["q_kept"]): x for x in rules.judged(docs).collect()}
    assert {i for i, k in got if not k} == {100, 101, 102, 103, 104}
    assert got[102, False]["q_base_failed"] and got[103, False]["q_base_failed"] and not got[104, False]["q_base_failed"]


def test_long_documents_and_junk_below_half_do_not_shift_references(spark):
    clean = [(i, prose("aa", i, 200), "aa") for i in range(60)]
    junk = [(100 + i, " ".join(w + "$$$" for w in prose("aa", i, 200 if i else 30_000).split()), "aa") for i in range(40)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    kept = {x["doc_id"] for x in rules.judged(docs).where("q_kept").collect()}
    assert kept == {i for i, _, _ in clean}


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = rules.judged(docs)
    assert set(got.columns) >= set(docs.columns) - {"text"} and got.count() == docs.count()
    rows = got.collect()
    assert all(x["q_n_words"] == 0 and not x["q_kept"] for x in rows if x["doc_id"] in (1, 2, 3))
    assert all(x["q_char_distance"] is None for x in rows)  # no language has enough documents
    assert rules.judged(docs.limit(0)).count() == 0
    odd = docs.withColumnsRenamed({"lang": "my lang", "text": "a.b"})
    assert rules.judged(odd, "a.b", "my lang").count() == docs.count()
    assert rules.judged(docs.select("text"), lang=None).count() == docs.count()
    with pytest.raises(ValueError):
        rules.judged(docs.withColumn("q_kept", F.lit(1)))
