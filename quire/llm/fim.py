"""Fill-in-the-middle: texts cut at two unit ranks, which an indexable skip list finds.

A text is a row of units: code points, or what a pattern matches (left to right over the code
points; text between matches belongs to the unit after it, what follows the last match to the
last unit). The skip list over the units has a bottom lane with a link for each unit and express
lanes above, in each of which about one node in ``RISE`` of the lane below goes on. A node rises
by a hash of its place, so equal texts have equal lists. Each link carries two widths, the units
and the code points that it passes. To find a unit rank, the search walks a lane while the next
link's unit width stays within the rank, goes down where it would not, and adds up the code-point
widths: at the bottom lane that sum is the cut, exactly.

Both cuts come from a hash of the document id (``cut_ranks``), so runs agree, and so does the
order: prefix, suffix, middle (psm) or suffix, prefix, middle (spm), or the text as it is
(plain), which it always is where it is empty or holds one of the markers.

Null texts are empty. A null id hashes as an empty one. Rows that repeat an id with the same
text have the same output. Other columns pass through unchanged.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import by_bytes, free_names, map_arrow

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: In percent of documents: transformed at all; of these, suffix first.
RATE, SPM_RATE = 90, 20
RISE = 16
_CACHED = 1 << 16  # places whose heights are kept


def risen(a: int, z: int) -> list[np.ndarray]:
    """For each express lane, lowest first, which of the places ``a`` to ``z`` rise to it; place 0 rises to all."""
    x = np.arange(a, z, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    if a == 0 and z > 0:
        x[0] = 0
    lanes, at, bits = [], np.arange(a, z), RISE.bit_length() - 1
    for lane in range(64 // bits):
        up = x[at - a] >> np.uint64(lane * bits) & np.uint64(RISE - 1) == 0
        at = at[up]
        if not len(at):
            break
        lanes.append(at)
    return lanes


_HEIGHTS: list[np.ndarray] = []


def _lanes(n: int) -> list[np.ndarray]:
    """The places of each express lane of ``n`` units, lowest first, the highest lane with more than one link."""
    if not _HEIGHTS:
        _HEIGHTS.extend(risen(0, _CACHED))
    lanes = [x[:np.searchsorted(x, n)] for x in _HEIGHTS]
    if n > _CACHED:
        found: list[list[np.ndarray]] = [[x] for x in lanes]
        for a in range(_CACHED, n, 1 << 20):
            for k, x in enumerate(risen(a, min(n, a + (1 << 20)))):
                if k == len(found):
                    found.append([np.zeros(1, np.int64)])
                found[k].append(x)
        lanes = [np.concatenate(x) for x in found]
    return [x for x in lanes if len(x) > 1]


class SkipList:
    """An indexable skip list over units of the given widths in code points."""

    def __init__(self, widths: np.ndarray):
        """Lanes from the bottom up: link widths in units (None: 1 each) and code points, and each link's place in the lane below."""
        self.n = len(widths)
        self.lanes: list[tuple] = [(None, widths, None)]
        below, chars = None, widths
        for at in _lanes(self.n):
            down = at if below is None else np.searchsorted(below, at)
            chars = np.add.reduceat(chars, down, dtype=np.int64)
            self.lanes.append((np.diff(at, append=self.n), chars, down))
            below = at

    def code_points(self, rank: int) -> int:
        """The code points before the unit of ``rank`` (0 to n)."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        at = units = points = 0
        for k in range(len(self.lanes) - 1, -1, -1):
            width, chars, down = self.lanes[k]
            end = len(chars)
            while at < end and (step := 1 if width is None else int(width[at])) <= rank - units:
                units += step
                points += int(chars[at])
                at += 1
            if units == rank:
                break
            if k:  # the search stands before the rank, so on a node
                at = int(down[at])
        return points


def unit_widths(text: str, pattern: re.Pattern | None = None) -> np.ndarray:
    """Code points of each unit of a text."""
    if pattern is None:
        return np.ones(len(text), np.uint8)
    ends = [m.end() for m in pattern.finditer(text) if m.end() > m.start()]
    if not text:
        return np.empty(0, np.int64)
    if not ends:
        ends = [len(text)]
    ends[-1] = len(text)
    return np.diff(np.array([0, *ends], np.int64))


def cut_ranks(doc_id: int | None, n: int) -> tuple[int, int, int, int]:
    """The two unit ranks of a document's cuts, and two draws below 100: transformed or not, and the order."""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = h1 % (n + 1), h2 % (n + 1)
    return min(a, b), max(a, b), h3 % 100, h4 % 100


def formed(doc_id: int | None, text: str, pattern: re.Pattern | None = None) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    widths = unit_widths(text, pattern)
    a, b, rate, order = cut_ranks(doc_id, len(widths))
    if not text or rate >= RATE or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return len(widths), "plain", None, None, text
    units = SkipList(widths)
    x, y = units.code_points(a), units.code_points(b)
    head, mid, tail = text[:x], text[x:y], text[y:]
    if order < SPM_RATE:
        return len(widths), "spm", x, y - x, f"{SUFFIX}{tail}{PREFIX}{head}{MIDDLE}{mid}"
    return len(widths), "psm", x, y - x, f"{PREFIX}{head}{SUFFIX}{tail}{MIDDLE}{mid}"


def transformed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", prefix: str = "fim_", pattern: str | None = None) -> DataFrame:
    """``docs`` with ``<prefix>n`` (units), ``<prefix>form``, ``<prefix>prefix_chars``, ``<prefix>middle_chars`` and ``<prefix>output``."""
    names = [prefix + c for c in ("n", "form", "prefix_chars", "middle_chars", "output")]
    free_names(docs, *names)
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    keep = docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds))])

    def run(batches):
        units = None if pattern is None else re.compile(pattern)
        arrow = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        for whole in batches:
            for batch in by_bytes(whole, text):
                rows = [formed(i, t or "", units) for i, t in zip(batch.column(doc_id).to_pylist(), batch.column(text).to_pylist())]
                new = [pa.array(v, k) for v, k in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*keep, *names])

    return map_arrow(docs, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The exact text, from the output and its form alone: a transformed text holds no marker of its own, so each marker's first place is its own."""
    def part(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        x, y = F.locate(second, output), F.locate(third, output)
        a = F.substring(output, F.lit(len(first) + 1), x - len(first) - 1)
        b = F.substring(output, x + len(second), y - x - len(second))
        return a, b, F.substring(output, y + len(third), F.length(output))

    a, b, c = part(PREFIX, SUFFIX, MIDDLE)
    psm = F.concat(a, c, b)
    a, b, c = part(SUFFIX, PREFIX, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(b, c, a)).otherwise(output)
