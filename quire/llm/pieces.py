"""SentencePiece encoding and decoding by a weighted finite-state transducer of the pieces.

A model file is compiled to transducers that are composed with the text on the fly:

* the normaliser: states for the text's start, inside and after a space, whose arcs put out the
  escape symbol, the dummy prefix and single spaces (``normaliser``);
* the pieces: a trie over symbols whose word ends emit a piece, weight minus its score for
  unigram models;
* byte fallback: arcs from UTF-8 bytes to byte pieces (``fallback``), whose composition with a symbol
  in no piece of its own is an edge of the lattice with its pieces and a penalty below every
  piece; without byte pieces the edge emits the unknown piece;
* for BPE models, whose greedy merges no sum of scores ranks, the adjacency acceptor: a state
  per last piece, weight 0 to a next piece if merging the two pieces' symbols leaves exactly
  these two, else infinity. A segmentation is the BPE one if and only if all its neighbours
  pass, so the path of finite weight is unique. The trie has failure arcs there, so that a text
  is read once and a position meets only the pieces that end at it.

Encoding is the shortest path of the composition in the tropical semiring (least sum of
weights). Where no piece joins a symbol to a space after it, paths split at spaces: the
path of each space-led unit is found alone and kept in a bounded cache.

Null texts encode to null, empty texts to no piece. Decoding an encoded text gives the
normalised text back; bytes that are no UTF-8 decode to U+FFFD. Models with a precompiled
character map are refused (none of their rules would be applied), as are unknown types.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import col, free_names, map_arrow, ready

SPACE = "▁"
CACHE = 150_000
PAIRS = 300_000
STEPS = 300_000
LONG_UNIT = 64
EDGES = 20_000
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(raw: bytes):
    """(number, value) of a protocol buffer message; fixed32 as float."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, raw[at:at + n]
            at += n
        elif kind == 5:
            yield tag >> 3, struct.unpack("<f", raw[at:at + 4])[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, struct.unpack("<d", raw[at:at + 8])[0]
            at += 8
        else:
            raise ValueError("not a SentencePiece model")


class Transducer:
    """Arcs by state and symbol: next state, output, weight. The symbol None stands for every other one, which passes itself after the output."""

    def __init__(self, arcs: dict[int, dict]):
        self.arcs = arcs
        # a state that only leads to itself maps symbols one by one: its arcs as a table of the whole alphabet
        self.table = {q: {ord(a): "".join(o) for a, (_, o, _) in row.items() if a is not None}
                      for q, row in arcs.items() if None in row and row[None][1] == () and all(t == q and not w for t, _, w in row.values())}

    def compose(self, symbols, state: int) -> tuple[list, int, float]:
        """The output, the last state and the weight of the path that reads ``symbols`` from ``state``."""
        out: list = []
        weight = 0.0
        for k, a in enumerate(symbols):
            if state in self.table:
                out += (symbols[k:] if k else symbols).translate(self.table[state])
                break
            row = self.arcs[state]
            arc = row.get(a)
            state, put, w = row[None] if arc is None else arc
            out.extend(put)
            if arc is None:
                out.append(a)
            weight += w
        return out, state, weight


START, INSIDE, GAP = 0, 1, 2


def normaliser(dummy: bool, squeeze: bool) -> Transducer:
    """Spaces to escape symbols; with ``squeeze`` one between words and none around the text, with ``dummy`` one before it."""
    lead = (SPACE,) if dummy else ()
    if squeeze:
        gap = {a: (GAP, (), 0.0) for a in (" ", SPACE)}
        return Transducer({START: {**{a: (START, (), 0.0) for a in (" ", SPACE)}, None: (INSIDE, lead, 0.0)},
                           INSIDE: {**gap, None: (INSIDE, (), 0.0)}, GAP: {**gap, None: (INSIDE, (SPACE,), 0.0)}})
    inside = {**{a: (INSIDE, (SPACE,), 0.0) for a in (" ", SPACE)}, None: (INSIDE, (), 0.0)}
    return Transducer({START: {**{a: (INSIDE, (*lead, SPACE), 0.0) for a in (" ", SPACE)}, None: (INSIDE, lead, 0.0)}, INSIDE: inside})


def fallback(byte: list[int], penalty: float) -> Transducer:
    """UTF-8 bytes to byte pieces; a symbol's first byte has the penalty, the others follow free."""
    return Transducer({0: {b: (0, (i,), 0.0 if 0x80 <= b < 0xC0 else penalty) for b, i in enumerate(byte)}})


class Pieces:
    """A compiled model: ``encode`` and ``decode`` of single texts."""

    def __init__(self, raw: bytes):
        self.texts, self.scores, self.types = [], [], []
        self.kind, self.dummy, self.squeeze = UNIGRAM, True, True
        for number, value in _fields(raw):
            if number == 1:
                f = dict(_fields(value))
                self.texts.append(f.get(1, b"").decode())
                self.scores.append(f.get(2, 0.0))
                self.types.append(f.get(3, NORMAL))
            elif number == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                f = dict(_fields(value))
                if f.get(2):
                    raise ValueError("models with a precompiled character map are not supported")
                self.dummy, self.squeeze = bool(f.get(3, 1)), bool(f.get(4, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model type {self.kind} is not supported")
        self.id = {}
        self.trie: dict = {}
        self.byte = [-1] * 256
        self.unknown = next((i for i, t in enumerate(self.types) if t == UNKNOWN), 0)
        self.surface: list[bytes] = []
        self.space_led = True
        for i, (text, kind) in enumerate(zip(self.texts, self.types)):
            self.surface.append(b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else text.replace(SPACE, " ").encode())
            if kind == BYTE:
                self.byte[int(text[3:5], 16)] = i
                self.surface[i] = bytes([int(text[3:5], 16)])
            elif kind in (NORMAL, USER):
                self.id[text] = i
                node = self.trie
                for ch in text:
                    node = node.setdefault(ch, {})
                node[""] = i
                self.space_led &= SPACE not in text.lstrip(SPACE)
        self.size = list(map(len, self.texts))
        self.symbols = {t for t in self.id if len(t) == 1}
        self.has_bytes = min(self.byte) >= 0
        self.penalty = 10.0 - min((s for s, t in zip(self.scores, self.types) if t == NORMAL), default=0.0)
        self.normal = normaliser(self.dummy, self.squeeze)
        self.start = START if self.dummy or self.squeeze else INSIDE
        self.bytes = fallback(self.byte, self.penalty)
        self._automaton: tuple | None = None
        self._edges: dict[str, tuple[list[int], float]] = {}
        self._before: list[dict[int, bool]] = [{} for _ in self.texts]
        self._pairs = self._steps = 0
        self._merges: dict[int, list | None] = {}
        self._unit: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    # the adjacency acceptor of BPE models

    def _history(self, b: int) -> list[tuple[float, str, str]] | None:
        """How piece ``b`` merges from its symbols, by score, the leftmost of equals first: before each merge, and
        at the end, the merge's score and the outer symbols. None if its symbols do not merge to it."""
        if b not in self._merges:
            known, scores = self.id, self.scores
            symbols, out = list(self.texts[b]), []
            while True:
                best, at = _NONE, -1
                for i in range(len(symbols) - 1):
                    j = known.get(symbols[i] + symbols[i + 1])
                    if j is not None and scores[j] > best:
                        best, at = scores[j], i
                out.append((best, symbols[0], symbols[-1]))
                if at < 0:
                    break
                symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            self._merges[b] = out if len(symbols) == 1 else None
        return self._merges[b]

    def _follows(self, a: int, b: int) -> bool:
        """Whether piece ``b`` may follow piece ``a``; -1 stands for the start and for symbols outside the pieces.

        Both pieces merge on their own, whichever has the better merge first; they stay apart if at no time
        the merge across their border is the best one.
        """
        got = self._before[b].get(a)
        if got is None:
            if self._pairs >= PAIRS:
                for before in self._before:
                    before.clear()
                self._pairs = 0
            self._pairs += 1
            right = self._history(b)
            left = self._history(a) if a >= 0 else None
            got = right is not None
            if got and left is not None:
                known, scores, i, j = self.id, self.scores, 0, 0
                while True:
                    (x, _, end), (y, begin, _) = left[i], right[j]
                    k = known.get(end + begin)
                    if k is not None and scores[k] > x and scores[k] >= y:
                        got = False
                        break
                    if x == _NONE and y == _NONE:
                        break
                    if x >= y:
                        i += 1
                    else:
                        j += 1
            self._before[b][a] = got
        return got

    # shortest paths

    def _path(self, s: str) -> list[int]:
        return self._greedy_path(s) if self.kind == BPE else self._best_path(s)

    def _edge(self, ch: str) -> tuple[list[int], float]:
        """The edge over a symbol in no piece: what it emits, and its weight."""
        got = self._edges.get(ch)
        if got is None:
            if len(self._edges) >= EDGES:
                self._edges.clear()
            if self.has_bytes:
                ids, _, weight = self.bytes.compose(ch.encode(), 0)
                got = ids, weight
            else:
                got = [self.unknown], self.penalty
            self._edges[ch] = got
        return got

    def _suffixes(self) -> tuple[list[dict], list[int], list[int], list[int]]:
        """The trie with failure arcs: per state its arcs, the state of its longest proper suffix and the longest
        piece that ends there (-1: none); per piece the longest other piece that ends it."""
        if self._automaton is None:
            arcs, fail, ends, shorter = [{}], [0], [-1], [-1] * len(self.texts)
            todo = [(self.trie, 0)]
            for node, q in todo:  # by length of the states' strings, so that suffixes come first
                for ch, child in node.items():
                    if ch == "":
                        continue
                    t = arcs[q][ch] = len(arcs)
                    f = fail[q]
                    while f and ch not in arcs[f]:
                        f = fail[f]
                    f = arcs[f].get(ch, 0) if q else 0
                    arcs.append({})
                    fail.append(f)
                    b = child.get("", -1)
                    if b >= 0:
                        shorter[b] = ends[f]
                    ends.append(b if b >= 0 else ends[f])
                    todo.append((child, t))
            self._automaton = arcs, fail, ends, shorter
        return self._automaton

    def _greedy_path(self, s: str) -> list[int]:
        """Every position is reached by one piece at finite weight: the last piece of the merged prefix. The pieces
        that end there are met longest first, by the trie's failure arcs."""
        arcs, fail, ends, shorter = self._suffixes()
        before, follows, known, size = self._before, self._follows, self.id, self.size
        outside = not self.symbols.issuperset(s)
        last, over, q = [-1], {}, 0
        for j, ch in enumerate(s, 1):
            t = arcs[q].get(ch)
            if t is None:
                f = q
                while t is None and f:
                    f = fail[f]
                    t = arcs[f].get(ch)
                t = t or 0
                if self._steps < STEPS:  # the next time it is one step
                    self._steps += 1
                    arcs[q][ch] = t
            q = t
            if outside and ch not in known:  # no piece ends here: the fallback's edge is the only one of finite weight
                over[j] = self._edge(ch)[0]
                last.append(-1)
                continue
            b = ends[q]
            while b >= 0:
                a = last[j - size[b]]
                ok = before[b].get(a)
                if ok or (ok is None and follows(a, b)):
                    break
                b = shorter[b]
            else:
                b = -2
            last.append(b)
        out: list[int] = []
        j = len(s)
        while j:
            b = last[j]
            if b >= 0:
                out.append(b)
                j -= size[b]
            else:
                out += reversed(over[j])
                j -= 1
        out.reverse()
        return out

    def _best_path(self, s: str) -> list[int]:
        n = len(s)
        cost, start, by, over = [0.0] + [float("inf")] * n, [0] * (n + 1), [-1] * (n + 1), {}
        for i in range(n):
            node, j = self.trie, i
            while j < n:
                node = node.get(s[j])
                if node is None:
                    break
                j += 1
                b = node.get("")
                if b is not None and cost[i] - self.scores[b] < cost[j]:
                    cost[j], start[j], by[j] = cost[i] - self.scores[b], i, b
            if s[i] not in self.id:
                ids, weight = self._edge(s[i])
                if cost[i] + weight < cost[i + 1]:
                    cost[i + 1], start[i + 1], by[i + 1], over[i + 1] = cost[i] + weight, i, -1, ids
        out: list[list[int]] = []
        i = n
        while i:
            out.append([by[i]] if by[i] >= 0 else over[i])
            i = start[i]
        path = [x for part in reversed(out) for x in part]
        if not self.has_bytes:  # neighbouring unknown symbols are one unknown piece
            path = [x for k, x in enumerate(path) if x != self.unknown or not k or path[k - 1] != self.unknown]
        return path

    # texts

    def normalised(self, text: str) -> str:
        """The normal form as a plain function: what decoding is held against."""
        s = text.replace(SPACE, " ")
        if self.squeeze:
            s = re.sub(" +", " ", s).strip(" ")
        return " " + s if self.dummy and s else s

    def encode(self, text: str) -> bytes:
        """The piece ids as 32-bit integers."""
        if not self.space_led:
            return array("i", self._path("".join(self.normal.compose(text, self.start)[0]))).tobytes()
        # units are keyed without the space before them; the first one has none, or starts in another state
        alone = INSIDE in self.normal.table  # the state leads to itself: symbols but spaces stand for themselves
        if text[:1] == " " or "  " in text or SPACE in text:
            first, *rest = (_ANY_UNIT if SPACE in text else _UNIT).findall(text)
            rest = [u[1:] for u in rest]
        else:  # each space is alone and begins a unit
            first, *rest = text.split(" ")
        out = [array("i", self._path("".join(self.normal.compose(first, self.start)[0]))).tobytes()]
        out += map(self._unit.get, rest)
        if None in out:
            unit, old = self._unit, self._old  # two generations: what is in use outlives a full cache
            for k, u in enumerate(rest, 1):
                if out[k] is not None:
                    continue
                got = unit.get(u)
                if got is None:
                    got = old.get(u)
                    if got is None:
                        s = SPACE + u if alone and u[:1] not in _SPACES else "".join(self.normal.compose(" " + u, INSIDE)[0])
                        got = array("i", self._path(s)).tobytes()
                    if len(u) < LONG_UNIT:
                        if len(unit) >= CACHE:
                            self._old = old = unit
                            self._unit = unit = {}
                        unit[u] = got
                out[k] = got
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.surface.__getitem__, ids))
        return (raw[1:] if self.dummy and raw[:1] == b" " else raw).decode(errors="replace")


_NONE = float("-inf")
_SPACES = frozenset((" ", SPACE))
# Units end inside a word, but for the text's last one; texts without the escape symbol take the faster pattern.
_UNIT = re.compile(" +[^ ]*|[^ ]+")
_ANY_UNIT = re.compile(f"[ {SPACE}]+[^ {SPACE}]*|[^ {SPACE}]+")
_MODELS: dict[bytes, Pieces] = {}


def compiled(raw: bytes) -> Pieces:
    """The compiled model, kept once per worker."""
    key = hashlib.sha256(raw).digest()
    if key not in _MODELS:
        _MODELS[key] = Pieces(raw)
    return _MODELS[key]


def model_bytes(path: str) -> bytes:
    """A model file, read on the driver and shipped with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, text: str = "text", out: str = "ids", check: str | None = None) -> DataFrame:
    """``docs`` without ``text`` and with ``out``, the piece ids; ``check`` names a column that says
    whether decoding them gives the normalised text back."""
    free_names(docs.drop(text), out, *([check] if check else []))
    keep = [c for c in docs.columns if c != text]
    schema = _with_ids(docs, keep, out, check)

    def run(batches):
        p = compiled(model)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                coded, good = [], []
                for t in batch.column(text).to_pylist():
                    ids = None if t is None else p.encode(t)
                    coded.append(ids)
                    if check:
                        s = None if t is None else p.normalised(t)
                        good.append(None if t is None else p.decode(np.frombuffer(ids, np.int32).tolist()) == (s[1:] if p.dummy and s else s))
                size = np.array([0 if c is None else len(c) // 4 for c in coded], np.int32)
                flat = pa.array(np.frombuffer(b"".join(c for c in coded if c), np.int32))
                ends = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32),
                                mask=np.array([c is None for c in coded] + [False]))
                lists = pa.ListArray.from_arrays(ends, flat)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists, *([pa.array(good, pa.bool_())] if check else [])],
                                                 names=[*keep, out, *([check] if check else [])])

    return map_arrow(docs, run, schema)


def _with_ids(docs: DataFrame, keep: list[str], out: str, check: str | None):
    from pyspark.sql import types as T

    fields = [docs.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.IntegerType()))]
    return T.StructType(fields + ([T.StructField(check, T.BooleanType())] if check else []))


def decode(df: DataFrame, model: bytes, ids: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with ``out``, the text that the ids stand for."""
    ready(df)

    @F.pandas_udf("string")
    def run(column):
        p = compiled(model)
        return column.map(lambda x: None if x is None else p.decode(list(x)))

    return df.withColumn(out, run(col(ids)))
