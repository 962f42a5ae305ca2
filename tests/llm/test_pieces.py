import os
import random
import struct

import numpy as np
import pytest
from helpers import awkward, sentence

from quire.llm import pieces as P

MODEL = os.path.join(os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers"), "piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    r = random.Random(3)
    odd = ["", " ", "  a  b\n\tc é \U0001d11e x", "a" * 300, " " * 77 + "x" + " " * 35, "▁a ▁▁ b", "\n\n\n   \n", "def f(x):\n        return x  ",
           "日本語テキスト", "\U0001f600\U0001f600 a", "\x00\x01", "abc" * 50, "z" * 5000]
    odd += ["".join(r.choice("ab  é日\n▁xthe") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    return odd + [sentence(k, 60) for k in range(200)]


def test_paths_equal_the_library(library):
    p = P.compiled(P.model_bytes(MODEL))
    for t in texts():
        ids = np.frombuffer(p.encode(t), np.int32).tolist()
        assert ids == library.encode(t)
        assert p.decode(ids) == t.replace("▁", " ") == library.decode(ids)


def model(pieces, kind, dummy=0):
    """The bytes of a small model: (text, score, type) rows."""
    def field(n, w, b):
        return bytes([n << 3 | w]) + b

    def block(n, b):
        size, out = len(b), b""
        while True:
            out += bytes([size & 127 | (128 if size > 127 else 0)])
            size >>= 7
            if not size:
                return field(n, 2, out + b)

    out = b"".join(block(1, block(1, t.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for t, s, k in pieces)
    return out + block(2, field(3, 0, bytes([kind]))) + block(3, field(3, 0, bytes([dummy])) + field(4, 0, b"\0"))


def brute_unigram(p, s):
    best = {0: (0.0, [])}
    for n in range(1, len(s) + 1):
        found = [(best[k][0] - p.scores[p.id[s[k:n]]], best[k][1] + [p.id[s[k:n]]]) for k in range(n) if s[k:n] in p.id]
        if s[n - 1] not in p.id:
            found.append((best[n - 1][0] + p.penalty, best[n - 1][1] + [p.unknown]))
        best[n] = min(found)
    return best[len(s)][0]


def test_unigram_paths_are_the_lightest():
    r = random.Random(1)
    rows = [("<unk>", 0.0, P.UNKNOWN)] + [(c, -r.uniform(3, 5), P.NORMAL) for c in "abc"] + [
        (w, -r.uniform(1, 9), P.NORMAL) for w in ("ab", "bc", "abc", "ca", "cab", "bb", "aab")]
    p = P.Pieces(model(rows, P.UNIGRAM))
    for _ in range(300):
        s = "".join(r.choice("abcx") for _ in range(r.randint(0, 12)))
        ids = p._best_path(s)
        weight = sum(p.penalty if i == p.unknown else -p.scores[i] for i in ids) + p.penalty * (s.count("x") - ids.count(p.unknown))
        assert weight == pytest.approx(brute_unigram(p, s))


def test_merges_equal_greedy_merging():
    r = random.Random(5)
    words = ["ab", "bc", "abc", "aa", "aaa", "ca", "bca", "abca"]
    rows = [("<unk>", 0.0, P.UNKNOWN)] + [(w, -float(k), P.NORMAL) for k, w in enumerate(words)] + [(c, -100.0, P.NORMAL) for c in "abc"]
    p = P.Pieces(model(rows, P.BPE))

    def greedy(s):
        parts = list(s)
        while True:
            found = [(-p.scores[p.id[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in p.id]
            if not found:
                return parts
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    for _ in range(500):
        s = "".join(r.choice("abc") for _ in range(r.randint(0, 14)))
        assert [p.texts[i] for i in p._greedy_path(s)] == greedy(s)


class Counted(str):
    """A text that counts how often its symbols are read."""

    read = 0

    def __getitem__(self, k):
        Counted.read += 1
        return str.__getitem__(self, k)

    def __iter__(self):
        for ch in str.__iter__(self):
            Counted.read += 1
            yield ch


def test_greedy_paths_read_a_symbol_a_bounded_number_of_times():
    rows = [("<unk>", 0.0, P.UNKNOWN)] + [("a" * 2**k, -float(k), P.NORMAL) for k in range(7)]
    p, n = P.Pieces(model(rows, P.BPE)), 640
    Counted.read = 0
    assert [p.texts[i] for i in p._greedy_path(Counted("a" * n))] == ["a" * 64] * 10
    assert Counted.read <= 3 * n


@pytest.mark.parametrize("limit", [0, 3, 10**6])
def test_full_tables_change_no_path(limit, monkeypatch):
    r = random.Random(8)
    words = ["ab", "bc", "abc", "cab", "abcab", "aa", "aaaa", "ca", "bca", "bb", "cc"]
    rows = [("<unk>", 0.0, P.UNKNOWN)] + [(w, -float(k), P.NORMAL) for k, w in enumerate(words)] + [(c, -100.0, P.NORMAL) for c in "abc"]
    whole = P.Pieces(model(rows, P.BPE))
    strings = ["".join(r.choice("abcx") for _ in range(r.randint(0, 14))) for _ in range(300)]
    expected = [whole._greedy_path(s) for s in strings]
    monkeypatch.setattr(P, "STEPS", limit)
    monkeypatch.setattr(P, "PAIRS", limit)
    p = P.Pieces(model(rows, P.BPE))
    assert [p._greedy_path(s) for s in strings] == expected


@pytest.mark.parametrize("dummy", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
def test_the_normaliser_is_the_plain_function(dummy, squeeze):
    r = random.Random(7)
    p = P.Pieces.__new__(P.Pieces)
    p.dummy, p.squeeze = dummy, squeeze
    t = P.normaliser(dummy, squeeze)
    for _ in range(600):
        s = "".join(r.choice("ab  ▁é\n") for _ in range(r.randint(0, 14)))
        out, state, weight = t.compose(s, P.START)
        assert "".join(out) == p.normalised(s).replace(" ", P.SPACE) and weight == 0
        k = r.randint(0, len(s))  # read in two parts
        a, mid, _ = t.compose(s[:k], P.START)
        b, end, _ = t.compose(s[k:], mid)
        assert a + b == out and end == state


def test_fallback_edges_carry_bytes_and_one_penalty():
    t = P.fallback(list(range(1000, 1256)), 7.0)
    for ch in "aé日\U0001f600":
        assert t.compose(ch.encode(), 0) == ([1000 + b for b in ch.encode()], 0, 7.0)
    rows = [("<unk>", 0.0, P.UNKNOWN)] + [(f"<0x{b:02X}>", 0.0, P.BYTE) for b in range(256)] + [("a", -1.0, P.NORMAL), ("b", -2.0, P.NORMAL), ("ab", -1.5, P.NORMAL)]
    for kind in (P.UNIGRAM, P.BPE):
        p = P.Pieces(model(rows, kind))
        assert np.frombuffer(p.encode("ab日b"), np.int32).tolist() == [259, *(1 + b for b in "日".encode()), 258]
        assert p.decode(np.frombuffer(p.encode("ab日b"), np.int32).tolist()) == "ab日b"


@pytest.mark.parametrize("dummy", [0, 1])
def test_units_are_the_whole_path(dummy):
    r = random.Random(2)
    rows = [("<unk>", 0.0, P.UNKNOWN)] + [(w, -float(k), P.NORMAL) for k, w in enumerate(["▁a", "ab", "▁ab", "ba", "▁", "a", "b"])]
    raw = model(rows, P.BPE, dummy)
    p, whole = P.Pieces(raw), P.Pieces(raw)
    assert p.space_led
    whole.space_led = False
    for _ in range(400):
        s = "".join(r.choice("ab ▁x") for _ in range(r.randint(0, 12)))
        assert p.encode(s) == whole.encode(s)


def test_unsupported_models():
    with pytest.raises(ValueError):
        P.Pieces(model([("a", 0.0, 1)], 4))


def test_frames(spark, library):
    docs = awkward(spark)
    out = P.encode(docs, P.model_bytes(MODEL), out="pieces", check="same")
    rows = {(r["doc_id"], r["source"]): r for r in out.collect()}
    assert out.columns == [c for c in docs.columns if c != "text"] + ["pieces", "same"] and out.count() == 12
    assert rows[(1, None)]["pieces"] is None and rows[(1, None)]["same"] is None and rows[(2, "s1")]["pieces"] == []
    for r in docs.where("text is not null and doc_id is not null").collect():
        assert rows[(r["doc_id"], r["source"])]["pieces"] == library.encode(r["text"]) and rows[(r["doc_id"], r["source"])]["same"]
    back = P.decode(out.where("pieces is not null"), P.model_bytes(MODEL), ids="pieces").select("doc_id", "text")
    assert {tuple(r) for r in back.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] is not None}
    assert P.encode(docs.limit(0), P.model_bytes(MODEL)).count() == 0
    with pytest.raises(ValueError):
        P.encode(docs, b"", out="id")
