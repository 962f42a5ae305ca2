"""Repeated passages, removed exactly: every byte covered by a string of ``length`` bytes that also starts elsewhere.

One suffix array over all text is no distributed job, so the text is dealt into shards that
can be sorted alone. Each window of ``length`` bytes has an anchor, its least-hashed gram of
``gram`` bytes (the leftmost of equals): a function of the window's bytes, so equal windows
have equal anchors. The starts of a text fall into runs that share an anchor; a run is its
anchor's hash (the shard key), the hash of the run's bytes, and its place.

1. Runs are counted by (key, bytes). Equal runs are copies: all their starts repeat, and only
   one copy goes on, so a group of thousands of copies is one row after the map side. Equal runs
   that follow each other in a text (periodic text) are one row with a count from the start.
2. Keys with two or more different runs go to shards, the runs' bytes with them. A shard sorts
   its suffixes by induced sorting and takes permuted common prefixes: a start whose prefix
   shared with a neighbour in suffix order reaches ``length`` repeats.
3. A key with more than ``HOT`` different runs is no single shard: its windows are counted one
   by one by a 128-bit hash, pre-aggregated, which is the same test without a bound on the key.
4. The repeated starts of a document become byte ranges, and its text is cut.

With ``words``, strings of more than so many words that are shorter than ``length`` count too:
each window of ``words + 1`` whole words (runs between white space) of under ``length`` bytes is
counted by a 128-bit hash. Longer windows hold a string of ``length`` bytes already.

Passages of more than so many words are told by the same runs over words instead of bytes
(``repeated_words``; words are runs outside ASCII white space): a window is so many hashed words, its anchor the least-hashed gram of
words. Equal runs are copies; of anchors with different runs the windows are counted one by one,
by a 128-bit hash, as they are few.

Texts are UTF-8 bytes; null counts as empty; texts shorter than ``length`` keep all. Rows
that repeat each other exactly are documents that repeat each other. Null ids are allowed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import by_bytes, dropped, free_names, map_arrow, pick, saved
from quire.llm.suffix import repeated_starts

LENGTH = 400
HOT = 4096
SHARD_BYTES = 1 << 20
CHUNK = 1 << 18
SLICE = 1 << 20
_POS = np.uint64((1 << 22) - 1)
_B = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.array([chr(i).isspace() for i in range(0x3001)] + [False])


def gram_size(length: int) -> int:
    """The largest power of two up to a third of ``length``."""
    if length < 4:
        raise ValueError("length must be at least 4 bytes")
    return 1 << max(0, (length // 3).bit_length() - 1)


def _powers(n: int, base: int = int(_B)) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and their inverses, modulo 2^64, below the ``n``-th; kept for pieces of the usual size."""
    def made(b: int, n: int) -> np.ndarray:
        out = np.full(n, b, np.uint64)
        out[:1] = 1
        with np.errstate(over="ignore"):
            return np.multiply.accumulate(out)

    if n > 2 * CHUNK:
        return made(base, n), made(pow(base, -1, 1 << 64), n)
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        _POWERS[base] = made(base, 2 * CHUNK), made(pow(base, -1, 1 << 64), 2 * CHUNK)
    up, down = _POWERS[base]
    return up[:n], down[:n]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTE = np.random.default_rng(24).integers(0, 1 << 64, 256, np.uint64)  # a fixed random number for each byte


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def _ranges_hashed(h: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = int(_B)) -> np.ndarray:
    """A 64-bit hash of ``h[start:end]`` for many ranges of hashed words, from running sums."""
    up, down = _powers(len(h), base)
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(h * up, dtype=np.uint64)))
        return _mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (or words) at each place, from running sums."""
    up, down = _powers(len(b))
    n = len(b) - gram + 1
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum((_BYTE[b] if b.dtype == np.uint8 else b) * up, dtype=np.uint64)))
        return _mixed((sums[gram:] - sums[:n]) * down[:n])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x) - w + 1
    pad = -len(x) % w
    y = np.concatenate((x, np.full(pad, np.iinfo(np.uint64).max, np.uint64))).reshape(-1, w)
    head = np.minimum.accumulate(y, 1).ravel()
    tail = np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[w - 1:w - 1 + n])


def runs(b: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with one anchor: first start, last start, anchor hash.

    ``b`` holds texts end to end, cut at ``bounds`` (0 first, ``len(b)`` last); at most 2^22 bytes.
    """
    none = np.empty(0, np.int64)
    if len(b) < length:
        return none, none, none
    h = gram_hashes(b, gram)
    mark = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    least = _sliding_min(mark, length - gram + 1)[:len(b) - length + 1]
    text = np.zeros(len(b), np.int32)
    inner = bounds[1:-1]
    np.add.at(text, inner[inner < len(b)], 1)
    text = np.cumsum(text)
    whole = text[:len(least)] == text[length - 1:length - 1 + len(least)]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:len(least)] != text[:len(least) - 1])
    at = np.flatnonzero(whole)
    if not len(at):
        return none, none, none
    fresh = new[at]
    fresh[0] = True
    fresh[1:] |= at[1:] != at[:-1] + 1
    lo = at[fresh]
    hi = np.append(at[np.flatnonzero(fresh)[1:] - 1], at[-1])
    return lo, hi, h[(least[lo] & _POS).astype(np.int64)].view(np.int64)


def _pieces(offsets: np.ndarray, length: int):
    """Cut a batch of texts into pieces of about ``CHUNK`` bytes: (first text, last text, from, to) in bytes.

    Pieces hold whole texts; a longer text is cut into pieces that overlap by ``length - 1``.
    """
    step = max(CHUNK, 2 * length)
    n = len(offsets) - 1
    i = 0
    while i < n:
        if offsets[i + 1] - offsets[i] > step:
            a = offsets[i]
            while True:
                z = min(a + step, offsets[i + 1])
                yield i, i + 1, a, z
                if z == offsets[i + 1]:
                    break
                a = z - length + 1
            i += 1
            continue
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= CHUNK:
            j += 1
        yield i, j, offsets[i], offsets[j]
        i = j


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and its offsets; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buf = column.buffers()
    offsets = np.frombuffer(buf[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buf[2], np.uint8) if buf[2] is not None and buf[2].size else np.empty(0, np.uint8)
    return data, offsets


def _scan(length: int, gram: int):
    def scan(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _bytes_of(batch.column("text"))
            for i, j, a, z in _pieces(offsets, length):
                lo, hi, key = runs(data[a:z], offsets[i:j + 1].clip(a, z) - a, length, gram)
                if not len(lo):
                    continue
                raw = memoryview(data[a:z])
                seg = np.array([xxhash.xxh3_64_intdigest(raw[x:y]) for x, y in zip(lo.tolist(), (hi + length).tolist())], np.uint64).view(np.int64)
                doc = i + np.searchsorted(offsets[i + 1:j + 1] - a, lo, "right")
                # equal runs without a gap are one row
                fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (seg[1:] != seg[:-1]) | (doc[1:] != doc[:-1]) | (lo[1:] != hi[:-1] + 1)))
                first = np.flatnonzero(fresh)
                times = np.diff(first, append=len(lo))
                doc, over = doc[first], hi[first + times - 1] - lo[first]
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first]), pa.array(seg[first]), batch.column("doc").take(take), batch.column("th").take(take),
                     pa.array(lo[first] + a - offsets[doc]), pa.array((hi - lo)[first].astype(np.int32)), pa.array(times), pa.array(over)],
                    names=["key", "seg", "doc", "th", "lo", "n", "times", "reach"])
    return scan


def _fetch(length: int):
    """Rows of documents with the runs wanted of them -> rows of runs with their bytes."""
    def fetch(batches):
        for batch in batches:
            for text, want in zip(batch.column("text"), batch.column("want")):
                raw = (text.as_py() or "").encode()
                rows = want.as_py()
                for at in range(0, len(rows), 4096):
                    part = rows[at:at + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["key"] for r in part]), pa.array([r["seg"] for r in part]),
                         pa.array([raw[r["lo"]:r["lo"] + r["n"] + length] for r in part]), pa.array([r["m"] for r in part], pa.int64()),
                         pa.array([r["hot"] for r in part])],
                        names=["key", "seg", "bytes", "m", "hot"])
    return fetch


def _sort_shard(length: int):
    """Runs sorted by key -> repeated starts of the runs that occur once; whole keys are sorted together."""
    def answer(held):
        out = [(k, g, s.astype(np.int32)) for (k, g, _, m), s in zip(held, repeated_starts([x[2] for x in held], length)) if m == 1 and len(s)]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.int32()))],
            names=["key", "seg", "starts"])

    def sort(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for key, seg, raw, m in zip(*(batch.column(c).to_pylist() for c in ("key", "seg", "bytes", "m"))):
                if key != last and size >= SHARD_BYTES:
                    yield answer(held)
                    held, size = [], 0
                held.append((key, seg, raw, m))
                size += len(raw)
                last = key
        if held:
            yield answer(held)
    return sort


def _windows(length: int):
    """Every window of the runs, by a 128-bit hash."""
    def each(batches):
        for batch in batches:
            for key, seg, raw, m in zip(*(batch.column(c).to_pylist() for c in ("key", "seg", "bytes", "m"))):
                n = len(raw) - length + 1
                view = memoryview(raw)
                d = b"".join(xxhash.xxh3_128_digest(view[i:i + length]) for i in range(n))
                h = np.frombuffer(d, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(np.full(n, key)), pa.array(np.full(n, seg)),
                     pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, m))],
                    names=["h1", "h2", "key", "seg", "at", "m"])
    return each


def word_windows(text: str, words: int, length: int) -> list[tuple[int, int]]:
    """Byte spans, from word start to word end, of the windows of ``words`` words that are shorter than ``length`` bytes."""
    out, base = [], 0
    for a in range(0, len(text), CHUNK):
        # windows that start in this piece end before the piece's reach does; one code point before it tells whether a word starts
        lead = min(a, 1)
        part = text[a - lead:a + CHUNK + length]
        cp = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        at = np.zeros(len(cp) + 1, np.int64)
        np.cumsum(1 + (cp > 0x7F) + (cp > 0x7FF) + (cp > 0xFFFF), out=at[1:])
        edge = np.diff(np.concatenate(([False], ~_SPACE[np.minimum(cp, 0x3001)], [False])).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        start, end = start[:max(0, len(start) - words + 1)], end[words - 1:]
        short = (at[end] - at[start] < length) & (start >= lead) & (start < lead + CHUNK)
        out += zip((at[start[short]] - at[lead] + base).tolist(), (at[end[short]] - at[lead] + base).tolist())
        base += int(at[min(lead + CHUNK, len(cp))] - at[lead])
    return out


def _short_windows(words: int, length: int):
    """Documents -> their short windows of words, by a 128-bit hash; ``hi`` is ``length`` before the window's end, as a start's would be."""
    def each(batches):
        for batch in batches:
            for doc, th, text in zip(batch.column("doc"), batch.column("th"), batch.column("text")):
                text = text.as_py() or ""
                spans = word_windows(text, words, length)
                if not spans:
                    continue
                raw = memoryview(text.encode())
                for at in range(0, len(spans), 10_000):
                    part = spans[at:at + 10_000]
                    h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[a:z]) for a, z in part), np.int64).reshape(-1, 2)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array([doc.as_py()] * n, doc.type), pa.array([th.as_py()] * n, pa.int64()),
                         pa.array([a for a, _ in part], pa.int64()), pa.array([z - length for _, z in part], pa.int64())],
                        names=["h1", "h2", "doc", "th", "lo", "hi"])
    return each


def words_of(b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and ends of the words (runs outside ASCII white space) of texts end to end, cut at ``bounds``."""
    if not len(b):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    solid = ~((b == 32) | ((b - np.uint8(9)) <= 4))
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(b))]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(b))
    with np.errstate(over="ignore"):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_BYTE[b] * up, dtype=np.uint64)))
        h = (sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)
    return _mixed(h), start, end


def _long_words(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words_of`` one text of any length, in pieces that cut no word."""
    out, at = [], 0
    while at < len(b):
        z = min(at + CHUNK, len(b))
        while z < len(b):  # on to the next white space
            part = b[z:z + CHUNK]
            white = np.flatnonzero((part == 32) | ((part - np.uint8(9)) <= 4))
            if len(white):
                z += int(white[0])
                break
            z += len(part)
        h, start, end = words_of(b[at:z], np.array([0, z - at]))
        out.append((h, start + at, end + at))
        at = z
    return tuple(np.concatenate(x) for x in zip(*out)) if out else words_of(b, np.array([0, 0]))


def _word_scan(size: int, gram: int):
    """Runs of windows of ``size`` words with one anchor, as ``_scan`` gives those of bytes; places count words."""
    def found(batch, first: int, h: np.ndarray, bounds: np.ndarray):
        """``bounds`` are those of the texts from row ``first`` on, in words."""
        for a in range(0, max(1, len(h) - size + 1), CHUNK):  # whole texts, or pieces of a long one that overlap by size - 1
            part = h[a:a + CHUNK + size - 1]
            inner = bounds[(bounds > a) & (bounds < a + len(part))] - a
            lo, hi, key = runs(part, np.concatenate(([0], inner, [len(part)])), size, gram)
            if not len(lo):
                continue
            seg = _ranges_hashed(part, lo, hi + size).view(np.int64)
            doc = np.searchsorted(bounds, lo + a, "right") - 1
            fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (seg[1:] != seg[:-1]) | (doc[1:] != doc[:-1]) | (lo[1:] != hi[:-1] + 1)))
            one = np.flatnonzero(fresh)
            times = np.diff(one, append=len(lo))
            over = hi[one + times - 1] - lo[one]
            take = pa.array(first + doc[one])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[one]), pa.array(seg[one]), batch.column("doc").take(take), batch.column("th").take(take),
                 pa.array(lo[one] + a - bounds[doc[one]]), pa.array((hi - lo)[one].astype(np.int32)), pa.array(times), pa.array(over)],
                names=["key", "seg", "doc", "th", "lo", "n", "times", "reach"])

    def scan(batches):
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            i = 0
            while i < batch.num_rows:
                j = i + 1
                while j < batch.num_rows and offsets[j + 1] - offsets[i] <= CHUNK:
                    j += 1
                cut = offsets[i:j + 1] - offsets[i]
                if cut[-1] > CHUNK:
                    h, start, _ = _long_words(data[offsets[i]:offsets[j]])
                else:
                    h, start, _ = words_of(data[offsets[i]:offsets[j]], cut)
                yield from found(batch, i, h, np.searchsorted(start, cut))
                i = j
    return scan


def _wanted_windows(size: int):
    """Rows of documents with the runs wanted of them -> every window of these runs, by a 128-bit hash."""
    def each(batches):
        for batch in batches:
            data, offsets = _bytes_of(batch.column("text"))
            want = batch.column("want")
            ends, rows = want.offsets.to_numpy(), want.values
            seg, lo, n, m = (rows.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("seg", "lo", "n", "m"))
            for k in range(batch.num_rows):
                h, _, _ = _long_words(data[offsets[k]:offsets[k + 1]])
                for a in range(int(ends[k]), int(ends[k + 1]), 10_000):
                    z = min(a + 10_000, int(ends[k + 1]))
                    times = n[a:z] + 1
                    place = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    at = np.repeat(lo[a:z], times) + place
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_ranges_hashed(h, at, at + size, b).view(np.int64)) for b in _BASES]
                        + [pa.array(np.repeat(seg[a:z], times)), pa.array(place.astype(np.int32)), pa.array(np.repeat(m[a:z], times))],
                        names=["h1", "h2", "seg", "at", "m"])
    return each


_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)  # odd


def _told(r: DataFrame, segs: DataFrame, found: DataFrame, *run: str) -> DataFrame:
    """Runs of repeated starts of each text: all of equal runs, the ``found`` starts of single ones."""
    copies = r.join(segs.where("m > 1").select("key", "seg"), ["key", "seg"]).select("doc", "th", "lo", (F.col("lo") + F.col("reach")).alias("hi"))
    single = segs.where("m = 1").select(*run, "rep.doc", "rep.th", "rep.lo").join(found, [*run]).select(
        "doc", "th", F.explode(_joined(F.col("starts"))).alias("s"), "lo").select(
        "doc", "th", (F.col("lo") + F.col("s.a")).alias("lo"), (F.col("lo") + F.col("s.z")).alias("hi"))
    return copies.unionByName(single)


def _counted(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Different runs of anchors that occur more than once, with their number and one place each; rows wanted to tell their windows apart."""
    every = r.groupBy("key", "seg").agg(F.sum("times").alias("m"), F.min(F.struct("doc", "th", "lo", "n")).alias("rep"))
    kinds = every.groupBy("key").agg(F.count("*").alias("d"))
    segs = saved(every.join(kinds, "key").where("m > 1 or d > 1"), "passage-segs")
    return segs, segs.where("d > 1").select("key", "seg", "m", "d", "rep.*")


def _with_wanted(d: DataFrame, want: DataFrame) -> DataFrame:
    by_doc = want.groupBy("doc", "th").agg(F.collect_list(F.struct(*(c for c in want.columns if c not in ("doc", "th")))).alias("want"))
    return d.join(by_doc, d["doc"].eqNullSafe(by_doc["doc"]) & (d["th"] == by_doc["th"])).select("text", "want")


def _starts(w: DataFrame, *run: str) -> DataFrame:
    """Of windows by hash the places of those that occur again, by run."""
    twice = w.groupBy("h1", "h2").agg(F.sum("m").alias("c")).where("c > 1").select("h1", "h2")
    return w.where("m = 1").join(twice, ["h1", "h2"], "left_semi").groupBy(*run).agg(F.collect_list("at").alias("starts"))


def repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 50) -> DataFrame:
    """Rows ``doc, th, ranges``: of each text with repeated strings of more than ``words`` words, the runs of words ``(first, last)`` at which such a string starts."""
    size = words + 1
    gram = gram_size(size)
    d = pick(docs, doc=doc_id, text=text).select("doc", "text", F.xxhash64("text").alias("th"))
    kind = docs.schema[doc_id].dataType.simpleString()
    r = saved(map_arrow(d.where(F.octet_length("text") >= 2 * size - 1), _word_scan(size, gram),
                        f"key long, seg long, doc {kind}, th long, lo long, n int, times long, reach long"), "passage-words")
    segs, want = _counted(r)
    # a run's bytes tell its anchor, so their hash names it
    w = saved(map_arrow(_with_wanted(d, want.drop("d", "key")), _wanted_windows(size), "h1 long, h2 long, seg long, at int, m long"), "passage-windows")
    out = saved(_told(r, segs, _starts(w, "seg"), "seg").groupBy("doc", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")), "passage-ranges")
    dropped(r, segs, w)
    return out


def repeated_ranges(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT, words: int | None = None) -> DataFrame:
    """Rows ``doc, th, ranges``: for each text (id and hash) with repeats, its runs of repeated starts ``(first, last)``.

    With ``words``, repeated strings of more words than that count even if they are shorter than ``length``.
    """
    gram = gram_size(length)
    d = pick(docs, doc=doc_id, text=text).select("doc", "text", F.xxhash64("text").alias("th"))
    kind = docs.schema[doc_id].dataType.simpleString()
    r = saved(map_arrow(d.where(F.octet_length("text") >= length), _scan(length, gram),
                        f"key long, seg long, doc {kind}, th long, lo long, n int, times long, reach long"), "passage-runs")
    segs, want = _counted(r)
    parts = saved(map_arrow(_with_wanted(d, want.withColumn("hot", F.col("d") > hot).drop("d")), _fetch(length),
                            "key long, seg long, bytes binary, m long, hot boolean"), "passage-parts")
    sorted_ = map_arrow(parts.where("not hot").select("key", "seg", "bytes", "m").repartition("key").sortWithinPartitions("key", "seg"),
                        _sort_shard(length), "key long, seg long, starts array<int>")
    w = map_arrow(parts.where("hot").select("key", "seg", "bytes", "m"), _windows(length), "h1 long, h2 long, key long, seg long, at int, m long")
    found = saved(sorted_.unionByName(_starts(w, "key", "seg")), "passage-starts")
    dropped(parts)
    told, used = _told(r, segs, found, "key", "seg"), [r, segs, found]
    if words is not None:
        short = saved(map_arrow(d, _short_windows(words + 1, length), f"h1 long, h2 long, doc {kind}, th long, lo long, hi long"), "passage-short")
        again = short.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
        told = told.unionByName(short.join(again, ["h1", "h2"], "left_semi").select("doc", "th", "lo", "hi"))
        used.append(short)
    out = saved(told.groupBy("doc", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")), "passage-ranges")
    dropped(*used)
    return out


def _joined(starts):
    """An array of starts as runs (first, last)."""
    @F.pandas_udf("array<struct<a:int,z:int>>")
    def join(column):
        out = []
        for x in column:
            x = np.sort(np.asarray(x))
            cut = np.flatnonzero(np.diff(x) > 1)
            out.append([{"a": int(a), "z": int(z)} for a, z in zip(x[np.append(0, cut + 1)], x[np.append(cut, len(x) - 1)])])
        return pd.Series(out)
    return join(starts)


def cut(raw: bytes, ranges: list[tuple[int, int]], length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes left, and the maximal byte spans removed, for repeated starts in runs (first, last)."""
    spans: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi + length)
        else:
            spans.append([lo, hi + length])
    left, at = [], 0
    for a, z in spans:
        left.append(raw[at:a])
        at = z
    left.append(raw[at:])
    return b"".join(left), [(a, z) for a, z in spans]


def word_spans(raw: bytes, ranges: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    """Maximal byte spans that windows of ``size`` words cover, for the windows' first words in runs (first, last)."""
    _, start, end = _long_words(np.frombuffer(raw, np.uint8))
    spans: list[list[int]] = []
    last = -1
    for lo, hi in sorted(ranges):
        a, z = int(start[lo]), int(end[hi + size - 1])
        if spans and lo <= last + 1:
            spans[-1][1] = max(spans[-1][1], z)
        else:
            spans.append([a, z])
        last = max(last, hi + size - 1)
    return [(a, z) for a, z in spans]


def _with_ranges(docs: DataFrame, doc_id: str, text: str, *ranges: DataFrame) -> DataFrame:
    """The columns of ``docs`` as ``c0, c1, ...``, and as ``r0, ...`` each table's ranges of the text (or null)."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    i, t = (names[docs.columns.index(c)] for c in (doc_id, text))
    of = ranges[0].select("doc", "th", F.col("ranges").alias("r0"))
    if len(ranges) > 1:
        more = ranges[1].select(F.col("doc").alias("d1"), F.col("th").alias("t1"), F.col("ranges").alias("r1"))
        of = of.join(more, of["doc"].eqNullSafe(more["d1"]) & (of["th"] == more["t1"]), "full").select(
            F.coalesce("doc", "d1").alias("doc"), F.coalesce("th", "t1").alias("th"), "r0", "r1")
    return docs.toDF(*names).join(of, F.col(i).eqNullSafe(F.col("doc")) & (F.xxhash64(t) == F.col("th")), "left").select(
        *names, *(f"r{k}" for k in range(len(ranges))))


def _pairs(column) -> list[list[tuple[int, int]]]:
    return [[(x["lo"], x["hi"]) for x in rs or []] for rs in column.to_pylist()]


def _cuts(batches, text: str, length: int):
    """Slices of documents with each text's bytes, the bytes left and the spans removed."""
    for batch in batches:
        for part in by_bytes(batch, text, SLICE):
            rows = []
            for t, rs in zip(part.column(text).to_pylist(), _pairs(part.column("r0"))):
                raw = t.encode() if t else b""
                rows.append((raw, *cut(raw, rs, length)))
            yield part, rows


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT,
                    prefix: str = "psg_", words: int | None = None, passages: int | None = None) -> DataFrame:
    """``docs`` with ``<prefix>n_bytes``, ``<prefix>spans`` (byte spans removed), ``<prefix>kept`` (the bytes left).

    With ``passages`` also ``<prefix>passages``: the byte spans covered by strings of more than so many words that are
    there again, shorter than ``length`` or not; they are told, not removed.
    """
    names = [prefix + c for c in ("n_bytes", "spans", "kept", "passages")[:3 if passages is None else 4]]
    free_names(docs, *names)
    told = [repeated_ranges(docs, doc_id, text, length, hot, words), *([] if passages is None else [repeated_words(docs, doc_id, text, passages)])]
    j = _with_ranges(docs, doc_id, text, *told)
    keep, docs_names = j.columns[:len(docs.columns)], docs.columns
    t = keep[docs_names.index(text)]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    rows_of = lambda spans: [{"start": a, "end": z} for a, z in spans]

    def run(batches):
        for part, rows in _cuts(batches, t, length):
            new = [pa.array([len(raw) for raw, _, _ in rows], pa.int64()), pa.array([rows_of(spans) for _, _, spans in rows], span),
                   pa.array([left for _, left, _ in rows], pa.binary())]
            if passages is not None:
                new.append(pa.array([rows_of(word_spans(raw, rs, passages + 1)) if rs else [] for (raw, _, _), rs in zip(rows, _pairs(part.column("r1")))], span))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], names=[*docs_names, *names])

    added = T.StructType.fromDDL("n long, s array<struct<start:long,end:long>>, k binary, p array<struct<start:long,end:long>>").fields
    return map_arrow(j, run, T.StructType([*docs.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names, added))]))


def cut_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, n_chars: str = "n_chars",
                  words: int | None = None) -> DataFrame:
    """``docs`` with their repeated passages cut from the text (and ``n_chars`` counted anew, if there).

    A code point of which the cut leaves only some bytes goes too. Documents that lose all but
    white space go; all others stay, those without a repeat unchanged.
    """
    j = _with_ranges(docs, doc_id, text, repeated_ranges(docs, doc_id, text, length, HOT, words))
    names, keep = docs.columns, j.columns[:len(docs.columns)]
    at = names.index(text)
    count = names.index(n_chars) if n_chars in names else None

    def run(batches):
        for part, rows in _cuts(batches, keep[at], length):
            left = [kept.decode(errors="ignore") if spans else None for _, kept, spans in rows]
            stay = pa.array([x is None or bool(x.strip()) for x in left], pa.bool_())
            columns = [part.column(c) for c in keep]
            columns[at] = pa.array([w if x is None else x for w, x in zip(columns[at].to_pylist(), left)], columns[at].type)
            if count is not None:
                columns[count] = pa.array([w if x is None else len(x) for w, x in zip(columns[count].to_pylist(), left)], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(stay)

    return map_arrow(j, run, docs.schema)
