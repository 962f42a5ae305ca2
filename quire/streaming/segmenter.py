"""Incremental segmentation of a completion whose text arrives in pieces.

Rule: run the segment pattern over the unconsumed text and emit, in order, the
raw text and the segments up to the first segment that is still open; keep the
rest. A closed match cannot change when more text arrives (the lazy body already
stops at its end marker, and every earlier position failed on text that is
complete), so the emitted rows equal those of the whole-text segmentation for
every way of cutting the text. Raw text after the last closed segment is kept as
well: the next piece may start a segment there, and one raw row per gap is what
the batch form emits.

Used per key inside the stateful stream processor; the per-row work is a single
regex pass over the unconsumed text.
"""

from __future__ import annotations

import re

from quire.functions import markers as M
from quire.functions.text import ANY_MARKER, ROLE_STARTS

# The shared pattern, with Java's \z spelled as Python's \Z (same meaning).
_SEGMENT_RE = re.compile(M.SEGMENT_PATTERN.replace(r"\z", r"\Z"))
_HEAD_RE = re.compile(M.SEGMENT_HEAD_PATTERN.replace(r"\z", r"\Z"))
_MARKER_RE = re.compile(ANY_MARKER)


def strip_markers(text: str) -> str:
    for m in ROLE_STARTS:
        text = text.replace(m, "")
    return _MARKER_RE.sub("", text)


def parse_segment(match: str) -> tuple[str, str, bool]:
    head = _HEAD_RE.match(match).group(1)
    body = match[len(head):]
    if head.endswith("final<|message|>"):
        channel, end = "final", M.FINAL_END
    elif head.endswith("analysis<|message|>"):
        channel, end = "analysis", M.ANALYSIS_END
    elif head.endswith("to=functions>"):
        channel, end = "tool", M.TOOL_END
    else:
        channel, end = "commentary", M.ANALYSIS_END
    closed = body.endswith(end)
    inner = body[: -len(end)] if closed else body
    content = inner if closed and channel in ("analysis", "final") else strip_markers(inner)
    return channel, content, closed


# The longest start marker: a start that began in scanned text lies this near its end.
_LONGEST_HEAD = len(M.START_ASSISTANT + M.TOOL_START)


def _end_marker(head: str) -> str:
    if head.endswith("final<|message|>"):
        return M.FINAL_END
    return M.TOOL_END if head.endswith("to=functions>") else M.ANALYSIS_END


def advance(buf: str, final: bool, scanned: int = 0, open_at: int = -1) -> tuple[list[tuple[str, str, bool]], str, int]:
    """Segments ready to emit from ``buf``, the text to keep, and where in it an open segment starts (-1: none).

    ``scanned`` and ``open_at`` say what an earlier call kept: so many characters, with an open
    segment there. Only the new text is then searched (with the open segment's end marker, or a
    start marker, reaching back into the old), so many small pieces cost no more than one large.
    With ``final`` (end of stream) everything is emitted, open segments included.
    """
    at = 0
    if not final and scanned:
        if open_at < 0:
            at = max(0, scanned - _LONGEST_HEAD)
        else:
            head = _HEAD_RE.match(buf[open_at:open_at + _LONGEST_HEAD + 1]).group(1)
            end = _end_marker(head)
            if buf.find(end, max(open_at + len(head), scanned - len(end) + 1)) < 0:
                return [], buf, open_at
            at = open_at
    out: list[tuple[str, str, bool]] = []
    prev = 0
    for m in _SEGMENT_RE.finditer(buf, at):
        channel, content, closed = parse_segment(m.group(0))
        if not closed and not final:
            return out, buf[prev:], m.start() - prev
        raw = strip_markers(buf[prev:m.start()])
        if raw:
            out.append(("raw", raw, True))
        out.append((channel, content, closed))
        prev = m.end()
    if not final:
        return out, buf[prev:], -1
    raw = strip_markers(buf[prev:])
    if raw:
        out.append(("raw", raw, True))
    return out, "", -1


def consume(buf: str, final: bool) -> tuple[list[tuple[str, str, bool]], str]:
    """Segments ready to emit from ``buf`` and the text to keep."""
    return advance(buf, final)[:2]


def segments(text: str) -> list[tuple[int, str, str, bool]]:
    """Whole-text segmentation in plain Python: ``(pos, channel, content, closed)``."""
    rows, _ = consume(text or "", final=True)
    return [(i, *r) for i, r in enumerate(rows)]
