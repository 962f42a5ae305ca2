"""Toxic spans by a linear-chain conditional random field.

Labels mark whole documents, so tokens are labelled first: in a toxic document the tokens
whose words speak most for toxicity (log-odds of document frequencies, within ``MARGIN`` of
the document's strongest) are toxic, all other tokens are clean. A two-state chain (clean,
toxic) with weights for words and word beginnings, a bias and transition weights is then fitted to
windows of tokens by the gradient of its likelihood (forward-backward). Whole documents are
scored by forward-backward marginals: tokens outside the lexicon share one potential, so a
run of k of them is the k-th power of one 2x2 matrix and every step is exact at any length.
A document's score is a rising function of its expected number of toxic tokens (the sum
of its marginals), fitted to the same sample by pooling neighbours that are out of order.

Fitted on a bounded sample: per class at most ``PER_CLASS`` labelled rows (those with the
least hash of their id), equal texts once. The lexicon, windows and weights come from it
and live on the driver; scoring is a narrow pass over all whole texts.

Null and empty texts, and texts without a lexicon word, have the least score and no spans. Rows that
repeat an id are scored each. Conflicting labels of an id or text count as toxic. Without a
toxic or without a clean training row nothing is learned and every score is the same least one.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import by_bytes, col, free_names, map_arrow, pick, saved

PER_CLASS = 12_000
CANDIDATES = 100_000
LEXICON = 4_000
MIN_DOCS = 3
MIN_ODDS = 1.5
MIN_GAIN = 8.0
MARGIN = 1.0
KEEP = 0.15
WINDOW = 24
THRESHOLD = 0.3
SPAN_AT = 0.5
FLOOR = 1e-3
TAIL = 0.02
_TOKEN = re.compile(r"\w+")
_FLUSH = 200_000
SLICE = 1 << 20


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def parts(word: str) -> list[str]:
    """The features of a token: its word, and its beginnings of 3 to 8 letters (a stem under any ending)."""
    return ["=" + word, *("^" + word[:k] for k in range(3, min(8, len(word)) + 1))]


@dataclass
class Crf:
    """Two states per token, 0 clean and 1 toxic; the clean state's potentials are the zero point."""

    words: dict[str, int] = field(default_factory=dict)  # feature -> number, 1..V; 0 pads
    state: np.ndarray = field(default_factory=lambda: np.zeros(1))  # weight of state 1 by feature; at 0 its bias
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0  # of state 1
    heads: frozenset = frozenset()  # first three letters of the features
    knots: tuple = ((0.0, 1.0), (0.0, 1.0))  # log of expected toxic tokens, share of toxic documents there

    def scored(self, expected: float) -> float:
        x = float(np.log(expected + FLOOR))
        tail = 1.0 / (1.0 + np.exp(-x))  # a small strictly rising part, so that scores rank documents between the knots too
        return float((1 - TAIL) * np.interp(x, *self.knots) + TAIL * tail)

    def calibrate(self, expected: np.ndarray, y: np.ndarray) -> "Crf":
        """The rising step function nearest to the labels (pooled neighbours), joined at its steps' centres."""
        x = np.log(expected + FLOOR)
        order = np.argsort(x, kind="stable")
        steps: list[list[float]] = []  # weight, sum of x, sum of y
        for at in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
            steps.append([float(len(at)), float(x[at].sum()), float(y[at].sum())])
            while len(steps) > 1 and steps[-2][2] * steps[-1][0] >= steps[-1][2] * steps[-2][0]:
                last = steps.pop()
                steps[-1] = [a + b for a, b in zip(steps[-1], last)]
        self.knots = (tuple(s[1] / s[0] for s in steps), tuple((s[2] + 0.05) / (s[0] + 1.0) for s in steps))
        self.knots = (self.knots[0], tuple(np.maximum.accumulate(self.knots[1])))
        return self

    def fit(self, x: np.ndarray, y: np.ndarray, size: np.ndarray, count: np.ndarray, steps: int = 120, l2: float = 0.002) -> "Crf":
        """Gradient ascent (Adam) on the log-likelihood of windows ``x`` (features of each token), ``y`` (states), of ``size`` tokens,
        each there ``count`` times."""
        n, width, deep = x.shape
        all_ = float(count.sum())
        times = count.astype(float)
        v = len(self.words) + 1
        theta = np.zeros(v + 5)
        theta[0] = -4.0
        m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
        live = np.arange(width)[None, :] < size[:, None]
        pair = live[:, 1:]

        def gathered(p: np.ndarray, at: np.ndarray) -> np.ndarray:
            g = np.bincount(at.ravel(), weights=np.repeat(p, deep), minlength=v)
            g[0] = p.sum()
            return g

        seen = np.zeros_like(theta)
        of_token = np.broadcast_to(times[:, None], live.shape)[live]
        seen[:v] = gathered(y[live] * of_token, x[live])
        for a in (0, 1):
            for b in (0, 1):
                seen[v + 2 * a + b] = (((y[:, :-1] == a) & (y[:, 1:] == b) & pair) * times[:, None]).sum()
        seen[v + 4] = (y[:, 0] * times).sum()
        for step in range(1, steps + 1):
            w = theta[:v].copy()
            w[0] = 0.0
            s, t = theta[0] + w[x].sum(-1), np.exp(theta[v:v + 4].reshape(2, 2))
            e = np.stack([np.ones_like(s), np.exp(np.clip(s, -30, 30))], -1)
            e[~live] = 1.0
            alpha = np.empty((width, n, 2))
            f = e[:, 0] * np.array([1.0, np.exp(theta[v + 4])])
            for i in range(width):
                if i:
                    f = np.where(live[:, i, None], (alpha[i - 1] @ t) * e[:, i], alpha[i - 1])
                alpha[i] = f / f.sum(1, keepdims=True)
            want, prob = np.zeros_like(theta), np.zeros((n, width))
            beta = np.ones((n, 2))
            for i in range(width - 1, -1, -1):
                p = alpha[i] * beta
                prob[:, i] = p[:, 1] / p.sum(1)
                if i == 0:
                    break
                here = live[:, i]
                back = e[:, i] * beta
                joint = alpha[i - 1][:, :, None] * t[None] * back[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                want[v:v + 4] += (joint[here] * times[here, None, None]).sum(0).ravel()
                nb = back @ t.T
                beta = np.where(here[:, None], nb / nb.sum(1, keepdims=True), beta)
            want[:v] = gathered(prob[live] * of_token, x[live])
            want[v + 4] = (prob[:, 0] * times).sum()
            g = (seen - want) / all_ - l2 * theta / max(1.0, all_) ** 0.5
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
            theta += 0.2 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-10)
            theta[v] = 0.0  # clean to clean is the zero point
        self.state, self.trans, self.start = theta[:v].copy(), theta[v:v + 4].reshape(2, 2).copy(), float(theta[v + 4])
        self.heads = frozenset(w[1:4] for w in self.words)
        return self

    def weight(self, word: str) -> float | None:
        """The state weight a word adds to the bias; None for a word outside the lexicon."""
        got = [f for f in map(self.words.get, parts(word)) if f]
        return float(min(self.state[got].sum(), 40.0)) if got else None

    def _run(self, cache: dict[int, np.ndarray], k: int) -> np.ndarray:
        """The transfer matrix of ``k`` tokens outside the lexicon, scaled to a largest entry of 1."""
        if k not in cache:
            one = np.exp(self.trans) * np.array([1.0, np.exp(self.state[0])])[None, :]
            m = np.eye(2) if k == 0 else one if k == 1 else self._run(cache, k // 2) @ self._run(cache, k - k // 2)
            cache[k] = m / m.max()
        return cache[k]

    def marginals(self, places: list[int], weights: list[float], n: int, cache: dict) -> np.ndarray:
        """P(toxic) of the lexicon tokens at ``places`` (their ``weights`` above the bias) of a text of ``n`` tokens."""
        t = np.exp(self.trans)
        f, at, fs = None, -1, []
        for p, w in zip(places, weights):
            e = np.array([1.0, np.exp(self.state[0] + w)])
            gap = p - at - 1
            if f is None:
                first = np.array([1.0, np.exp(self.start)])
                if gap:
                    first = (first * np.array([1.0, np.exp(self.state[0])])) @ self._run(cache, gap - 1) @ t
                f = first * e
            else:
                f = (f @ self._run(cache, gap) @ t) * e
            f = f / f.sum()
            fs.append(f)
            at = p
        b, out = self._run(cache, n - 1 - at) @ np.ones(2), np.empty(len(fs))
        for i in range(len(fs) - 1, -1, -1):
            p = fs[i] * b
            out[i] = p[1] / p.sum()
            if i:
                e = np.array([1.0, np.exp(self.state[0] + weights[i])])
                b = self._run(cache, places[i] - places[i - 1] - 1) @ t @ (e * b)
                b = b / b.sum()
        return out

    def read(self, text: str | None, cache: dict, spans: bool = True) -> tuple[float, list[tuple[int, int]]]:
        """Expected toxic tokens of a text and its toxic spans as (start, end) code point offsets; adjoining toxic tokens make one span."""
        words = tokens(text)
        heads = self.heads
        found = [(i, f) for i, w in enumerate(words) if w[:3] in heads and (f := self.weight(w)) is not None]
        if not found:
            return 0.0, []
        places = [i for i, _ in found]
        p = self.marginals(places, [f for _, f in found], len(words), cache)
        out: list[tuple[int, int]] = []
        if spans and (p >= SPAN_AT).any():
            low = text.lower()
            src = text if len(low) == len(text) else low  # offsets count in the lower-cased text where that changes lengths
            want, last = {i for i, q in zip(places, p) if q >= SPAN_AT}, -2
            for i, m in enumerate(_TOKEN.finditer(src.lower())):
                if i in want:
                    if i == last + 1 and out:
                        out[-1] = (out[-1][0], m.end())
                    else:
                        out.append(m.span())
                    last = i
        return float(p.sum()), out


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int) -> DataFrame:
    """The bounded sample: ``text, y``; at most ``per_class`` rows of each class, equal texts once."""
    lab = pick(labels, id=doc_id, y=label).where("id is not null and y is not null")
    lab = lab.groupBy("id").agg(F.max(F.col("y").cast("int")).alias("y"))
    halves = [lab.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most 2 * per_class rows of an id and an int
    d = pick(docs, id=doc_id, text=text).where("text is not null")
    return saved(d.join(chosen, "id").groupBy(F.xxhash64("text").alias("th")).agg(F.first("text").alias("text"), F.max("y").alias("y")), "tox-sample")


def learn(sample: DataFrame, lexicon: int = LEXICON) -> Crf:
    """Fit the chain on all windows of the rows ``text, y``; equal windows are one with a count."""
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Crf()

    def frequencies(batches, only=None):
        c: Counter = Counter()
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], names=["part", "k"])
        for batch in batches:
            for t in (t for part in by_bytes(batch, "text", SLICE) for t in part.column("text").to_pylist()):
                own = {f for w in set(tokens(t)) for f in parts(w)}
                c.update(own if only is None else own & only)
                if len(c) > _FLUSH:
                    yield rows()
                    c.clear()
        if c:
            yield rows()

    form = "part string, k long"
    bad = map_arrow(sample.where("y = 1").select("text"), frequencies, form).groupBy("part").agg(F.sum("k").alias("k"))
    bad = {r["part"]: r["k"] for r in bad.where(F.col("k") >= MIN_DOCS).orderBy(F.desc("k"), "part").limit(CANDIDATES).collect()}
    known = frozenset(bad)
    good = map_arrow(sample.where("y = 0").select("text"), lambda b: frequencies(b, known), form).groupBy("part").agg(F.sum("k").alias("k"))
    good = {r["part"]: r["k"] for r in good.collect()}  # at most CANDIDATES rows

    def odds(w: str) -> float:
        return float(np.log((bad[w] + 0.5) / (n[1] + 1.0)) - np.log((good.get(w, 0) + 0.5) / (n[0] + 1.0)))

    def gain(w: str) -> float:
        """Likelihood ratio of the two frequencies: a rare word that fell on toxic documents by chance stays low."""
        a, b, share = bad[w], good.get(w, 0), n[1] / (n[0] + n[1])
        return 2 * (a * np.log(a / ((a + b) * share)) + (b * np.log(b / ((a + b) * (1 - share))) if b else 0.0))

    score = {w: o for w in bad if (o := odds(w)) >= MIN_ODDS and gain(w) >= MIN_GAIN}
    top = sorted(score, key=lambda w: (-score[w], w))[:lexicon]
    score = {w: score[w] for w in top}
    feature = {w: i + 1 for i, w in enumerate(top)}
    if not feature:
        return Crf()
    deep = 7  # features of a token at most

    def windows(text: str, y: int):
        """Windows of a text around its lexicon words (of a text without one, its middle): tokens, features of each, states."""
        x = [[f for f in map(feature.get, parts(w)) if f] for w in tokens(text)]
        odds = [max((score[top[f - 1]] for f in fs), default=-9.0) for fs in x]
        best = max(odds, default=-9.0)
        z = [int(bool(y) and bool(fs) and o >= best - MARGIN) for o, fs in zip(odds, x)]
        done = -1
        for i in [i for i, fs in enumerate(x) if fs] or [len(x) // 2]:
            if i < done or not x:
                continue
            a = max(0, i - WINDOW // 3)
            done = a + WINDOW
            yield len(x[a:done]), x[a:done], z[a:done]

    def texts(batches):
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE):
                yield from zip(part.column("text").to_pylist(), part.column("y").to_pylist())

    def counts(batches):
        seen, toxic = np.zeros(len(top) + 1, np.int64), np.zeros(len(top) + 1, np.int64)
        for t, y in texts(batches):
            for _, xs, zs in windows(t, y):
                for fs, z in zip(xs, zs):
                    for f in fs:
                        seen[f] += 1
                        toxic[f] += z
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at]), pa.array(toxic[at])], names=["f", "seen", "toxic"])

    # a feature that is hardly ever its document's strongest says nothing by itself
    own = map_arrow(sample.select("text", "y"), counts, "f long, seen long, toxic long").groupBy("f").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic"))
    keep = sorted(r["f"] for r in own.where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") >= KEEP * F.col("seen"))).collect())
    place = {f: i + 1 for i, f in enumerate(keep)}

    def narrowed(batches):
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE):
                size, x, y = [], [], []
                for t, label in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                    for n, xs, zs in windows(t, label):
                        flat = np.zeros((WINDOW, deep), np.int32)
                        for k, fs in enumerate(xs):
                            own = [place[f] for f in fs if f in place]
                            flat[k, :len(own)] = own
                        size.append(n)
                        x.append(flat.tobytes())
                        y.append(bytes(zs + [0] * (WINDOW - n)))
                yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["size", "x", "y"])

    each = map_arrow(sample.select("text", "y"), narrowed, "size int, x binary, y binary").groupBy("size", "x", "y").agg(F.count("*").alias("n"))
    got = each.orderBy("size", "x", "y").collect()  # different windows around a lexicon word, of at most 2 * PER_CLASS rows
    if not got:
        return Crf()
    x = np.frombuffer(b"".join(r["x"] for r in got), np.int32).reshape(len(got), WINDOW, deep)
    y = np.frombuffer(b"".join(r["y"] for r in got), np.uint8).reshape(len(got), WINDOW).astype(np.int64)
    crf = Crf(words={top[f - 1]: i for f, i in place.items()}).fit(x, y, np.array([r["size"] for r in got]), np.array([r["n"] for r in got]))

    def expected(batches):
        cache: dict = {}
        for batch in batches:
            for part in by_bytes(batch, "text", SLICE):
                e = [crf.read(t, cache, False)[0] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(e, pa.float64()), part.column("y")], names=["e", "y"])

    rows = map_arrow(sample.select("text", "y"), expected, "e double, y int").toPandas().sort_values(["e", "y"])
    return crf.calibrate(rows["e"].to_numpy(), rows["y"].to_numpy(float))


def score(docs: DataFrame, crf: Crf, text: str = "text", prefix: str = "tox_", spans: bool = True) -> DataFrame:
    """``docs`` with ``<prefix>score`` and ``<prefix>spans`` (array of start, end code point offsets)."""
    names = [*docs.columns, prefix + "score", prefix + "spans"]
    free_names(docs, *names[-2:])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    added = T.StructType.fromDDL("score double, spans array<struct<start:int,end:int>>").fields

    def run(batches):
        cache: dict = {}
        for batch in batches:
            for part in by_bytes(batch, text, SLICE):
                rows = [crf.read(t, cache, spans) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([crf.scored(e) for e, _ in rows], pa.float64()),
                     pa.array([[{"start": a, "end": b} for a, b in s] for _, s in rows], span)], names=names)

    return map_arrow(docs, run, T.StructType([*docs.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names[-2:], added))]))


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
            per_class: int = PER_CLASS) -> Crf:
    """A chain learned from the labelled rows that are not held out."""
    return learn(training_rows(docs.where(~held_out(doc_id)), labels.where(~held_out(doc_id)), doc_id, text, label, per_class))
