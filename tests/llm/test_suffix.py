import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import passages as P
from quire.llm import suffix as S


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.integers(1, 300))
def test_suffix_array_and_common_prefixes(body, scale):
    s = np.array([x * scale for x in body] + [0])
    sa, want = S.suffix_array(s), sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert sa.tolist() == want
    lcp = S.common_prefixes(s, sa, 9)
    for a, b in zip(want, want[1:]):
        k = 0
        while k < 9 and max(a, b) + k < len(s) and s[a + k] == s[b + k]:
            k += 1
        assert lcp[b] == k


def test_wide_alphabets_fall_to_doubling():
    r = random.Random(2)
    s = np.array([r.randrange(1, 9000) for _ in range(500)] * 2 + [0])
    assert S.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=30).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.integers(1, 7))
def test_repeated_starts_of_parts(parts, length):
    c = Counter(p[i:i + length] for p in parts for i in range(len(p) - length + 1))
    for p, got in zip(parts, S.repeated_starts(parts, length)):
        assert got.tolist() == [i for i in range(len(p) - length + 1) if c[p[i:i + length]] > 1]


def test_equal_windows_share_their_anchor():
    r = random.Random(4)
    b = bytes(r.choice(b"abcd") for _ in range(900))
    text = np.frombuffer(b[:500] + b"#" + b[100:400] + b[:450], np.uint8)
    lo, hi, key = P.runs(text, np.array([0, 501, len(text)]), 60, P.gram_size(60))
    of = {s: k for a, z, k in zip(lo, hi, key) for s in range(a, z + 1)}
    raw, seen = text.tobytes(), {}
    assert set(of) == set(range(0, 501 - 59)) | set(range(501, len(raw) - 59))
    for s, k in of.items():
        assert seen.setdefault(raw[s:s + 60], k) == k


def brute(rows, length):
    c = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if c[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(docs, length, hot):
    got = P.without_repeats(docs, length=length, hot=hot, prefix="p_").collect()
    return sorted(((r["doc_id"], r["p_n_bytes"], len(r["p_spans"]), hashlib.sha256(r["p_kept"]).hexdigest()) for r in got), key=str)


@pytest.mark.parametrize("hot", [0, 3, 4096])
def test_removal_equals_brute_force(spark, hot):
    r, rows = random.Random(8), []
    shared = [sentence(900 + k, 30) for k in range(4)]
    for i in range(60):
        t = sentence(i, r.randrange(0, 60))
        for _ in range(r.randrange(3)):
            at = r.randrange(len(t) + 1)
            t = t[:at] + r.choice(shared)[:r.randrange(20, 200)] + t[at:]
        rows.append((i, t))
    rows += [(60, rows[3][1]), (61, "ab" * 200), (62, "é日" * 60), (63, shared[0]), (64, "x" + shared[0] + "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert run(docs, 48, hot) == brute([(i, t.encode()) for i, t in rows], 48)


def test_long_texts_are_cut_into_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 1000)
    t = sentence(5, 1500)
    data = np.frombuffer((t + t[2000:2300]).encode(), np.uint8)
    seen = []
    for i, j, a, z in P._pieces(np.array([0, len(data)]), 100):
        lo, hi, _ = P.runs(data[a:z], np.array([0, z - a]), 100, P.gram_size(100))
        seen += [s + a for x, y in zip(lo, hi) for s in range(x, y + 1)]
    assert sorted(seen) == list(range(len(data) - 99))


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    assert run(docs, 400, 4096) == brute(rows, 400)
    assert P.without_repeats(docs.limit(0)).count() == 0
    out = P.cut_documents(docs, length=400)
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == docs.columns and 5 not in kept and 6 not in kept and kept[4] == "one" and kept[1] is None and kept[2] == ""
    with pytest.raises(ValueError):
        P.repeated_ranges(docs, length=3)


def brute_words(rows, size):
    """Word places covered by strings of ``size`` words that are there again."""
    c = Counter(tuple(t.split()[i:i + size]) for _, t in rows for i in range(len(t.split()) - size + 1))
    out = {}
    for i, t in rows:
        w = t.split()
        hit = [False] * len(w)
        for k in range(len(w) - size + 1):
            if c[tuple(w[k:k + size])] > 1:
                hit[k:k + size] = [True] * size
        out[i] = [x for x, g in zip(w, hit) if g]
    return out


@pytest.mark.parametrize("chunk", [300, 1 << 18])
def test_repeated_words_against_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", chunk)
    r, rows = random.Random(9), []
    shared = [sentence(700 + k, 30).split() for k in range(5)]
    for i in range(70):
        w = sentence(i, r.randrange(0, 900 if i % 9 == 0 else 50)).split()
        for _ in range(r.randrange(3)):
            at = r.randrange(len(w) + 1)
            w[at:at] = r.choice(shared)[:r.randrange(3, 30)] + ["é日"]
        rows.append((i, r.choice([" ", "\n", "  "]).join(w) + " " * r.randrange(2)))
    rows += [(70, rows[3][1]), (71, "a " * 90), (72, "x y z " * 30), (73, ""), (74, " ".join(shared[0]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_words(rows, 8)
    got = P.without_repeats(docs, length=4000, prefix="p_", passages=7).collect()
    assert len(got) == len(rows) and any(want.values())
    for x in got:
        raw = x["text"].encode()
        words = [w for s in x["p_passages"] for w in raw[s["start"]:s["end"]].decode().split()]
        assert words == want[x["doc_id"]], x["doc_id"]


def test_periodic_text_is_few_rows():
    import pyarrow as pa

    data = ["a" * 100_000, "abc" * 30_000, "x" + "0123456789" * 9_000]
    b = pa.RecordBatch.from_pydict({"doc": [1, 2, 3], "th": [1, 2, 3], "text": data})
    rows = [out for out in P._scan(400, P.gram_size(400))([b])]
    assert sum(x.num_rows for x in rows) < 2_000
    assert sum(int(v) + 1 for x in rows for v in x.column("reach").to_pylist()) == sum(len(t) - 399 for t in data)


def test_short_word_windows_in_pieces(monkeypatch):
    t = "  " + " ".join(random.Random(3).choice(["a", "bb", "é", "日本", "word"]) for _ in range(400)) + " \n end"
    whole = P.word_windows(t, 6, 30)
    raw = t.encode()
    assert all(len(raw[a:z].decode().split()) == 6 and z - a < 30 for a, z in whole) and len(whole) > 100
    for n in (1, 7, 64):
        monkeypatch.setattr(P, "CHUNK", n)
        assert P.word_windows(t, 6, 30) == whole


def test_awkward_names(spark):
    docs = awkward(spark).withColumnsRenamed({"doc_id": "my id", "text": "a.b"}).selectExpr("*", "1 as psg_x", "2 as r", "3 as c0")
    assert P.without_repeats(docs, "my id", "a.b").count() == docs.count()
    assert P.cut_documents(docs, "my id", "a.b").columns == docs.columns
    with pytest.raises(ValueError):
        P.without_repeats(docs.selectExpr("*", "1 as psg_kept"), "my id", "a.b")


def test_the_query_against_brute_force(spark):
    """The contract's four values over a whole small table, and the passages of over 50 words of the same texts."""
    from quire.llm import queries

    d = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = queries.op8_suffix_array(spark, d).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_spans"], r["kept_sha256"]) for r in got), key=str) == brute([(i, t.encode()) for i, t in texts], 400)
    want, of = brute_words(texts, 51), {i: t.encode() for i, t in texts}
    for r in got:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert [w for s in r["passages"] for w in of[r["doc_id"]][s["start"]:s["end"]].decode().split()] == want[r["doc_id"]]
    assert any(r["passages"] and not r["spans"] for r in got)
