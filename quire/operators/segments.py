"""Segmentation of whole marked-up completions (batch).

``segment_array`` turns a completion into an ordered ``array<struct<pos, channel,
content, closed>>`` with two regex passes over the text (``regexp_extract_all``
for segments, ``split`` for the raw text between them); everything after that is
native higher-order functions on the row. No shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import markers as M
from quire.functions.text import strip_markers

SEGMENT_TYPE = "array<struct<pos:int,channel:string,content:string,closed:boolean>>"


def _segment_items(segs: Column) -> Column:
    """Matched segments → ``struct<k, channel, content, closed>`` with odd ``k``.

    Two passes so that each regex runs once per element: the first extracts the
    start marker, the second derives channel, closure and content from fields.
    """
    heads = F.transform(
        segs,
        lambda m, i: F.struct(
            (2 * i + 1).alias("k"), m.alias("m"), F.regexp_extract(m, M.SEGMENT_HEAD_PATTERN, 1).alias("head")
        ),
    )

    def parse(h: Column) -> Column:
        head, m = h["head"], h["m"]
        channel = (
            F.when(head.endswith("final<|message|>"), F.lit("final"))
            .when(head.endswith("analysis<|message|>"), F.lit("analysis"))
            .when(head.endswith("to=functions>"), F.lit("tool"))
            .otherwise(F.lit("commentary"))
        )
        end = (
            F.when(head.endswith("final<|message|>"), F.lit(M.FINAL_END))
            .when(head.endswith("to=functions>"), F.lit(M.TOOL_END))
            .otherwise(F.lit(M.ANALYSIS_END))
        )
        return F.struct(
            h["k"].alias("k"), channel.alias("channel"),
            F.substring(m, F.length(head) + 1, F.length(m)).alias("body"), end.alias("end"),
        )

    def finish(p: Column) -> Column:
        body, end, channel = p["body"], p["end"], p["channel"]
        closed = body.endswith(end)
        inner = F.when(closed, F.substring(body, F.lit(1), F.length(body) - F.length(end))).otherwise(body)
        keep = closed & channel.isin("analysis", "final")
        content = F.when(keep, inner).otherwise(strip_markers(inner))
        return F.struct(p["k"].alias("k"), channel.alias("channel"), content.alias("content"), closed.alias("closed"))

    return F.transform(F.transform(heads, parse), finish)


def _raw_items(raws: Column) -> Column:
    """Raw pieces between segments → even ``k``, markers stripped, empty ones dropped."""
    items = F.transform(
        raws,
        lambda r, i: F.struct(
            (2 * i).alias("k"), F.lit("raw").alias("channel"), strip_markers(r).alias("content"), F.lit(True).alias("closed")
        ),
    )
    return F.filter(items, lambda s: s["content"] != "")


_EXPR_CACHE: dict[tuple, Column] = {}


def segment_array(text: Column | str) -> Column:
    """Ordered segments of a whole completion; empty raw pieces are dropped and
    ``pos`` is dense from 0. Empty or null text gives an empty array.

    Given a column *name*, the (unresolved, reusable) expression is built once per
    SparkContext: it takes several hundred client calls to construct.

    ``split`` yields one more element than ``regexp_extract_all`` (raw text before,
    between and after the segments), so raw piece ``i`` sorts at ``2i`` and segment
    ``i`` at ``2i+1``.
    """
    if isinstance(text, str):
        from pyspark import SparkContext

        sc = SparkContext._active_spark_context
        key = (sc.applicationId, sc.startTime, text)  # a new context never reuses a key
        if key not in _EXPR_CACHE:
            _EXPR_CACHE[key] = segment_array(F.col(text))
        return _EXPR_CACHE[key]
    segs = F.regexp_extract_all(text, F.lit(M.SEGMENT_PATTERN), 0)
    raws = F.split(text, M.SEGMENT_PATTERN, -1)
    ordered = F.array_sort(F.concat(_raw_items(raws), _segment_items(segs)))
    with_pos = F.transform(
        ordered,
        lambda s, i: F.struct(
            i.alias("pos"), s["channel"].alias("channel"), s["content"].alias("content"), s["closed"].alias("closed")
        ),
    )
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast(SEGMENT_TYPE)).otherwise(with_pos)


def completion_segments(completions: DataFrame, id_col: str = "completion_id", text_col: str = "text") -> DataFrame:
    """One row per segment: ``(id, pos, channel, content, closed)``.

    ``inline_outer`` + a null filter rather than ``inline``: the latter makes the
    optimizer add a ``size(array) > 0`` filter that evaluates the segmentation twice.
    """
    return (
        completions.select(F.col(id_col), F.inline_outer(segment_array(text_col)))
        .where(F.col("pos").isNotNull())
    )


def _rendered(s: Column, first_analysis: Column) -> Column:
    ch, content, closed = s["channel"], s["content"], s["closed"]
    nl = F.when(closed, F.lit("\n")).otherwise(F.lit(""))
    return (
        F.when(ch == "raw", content)
        .when(ch == "analysis", F.concat(F.when(first_analysis, F.lit(M.THINKING_PREFIX)).otherwise(F.lit("")), content))
        .when(ch == "final", F.concat(F.lit(M.FINAL_PREFIX), content))
        .when(ch == "commentary", F.concat(F.lit(M.COMMENTARY_PREFIX), content, nl))
        .otherwise(F.concat(F.lit(M.TOOL_PREFIX), content, nl))
    )


def render_transcript(segments: Column) -> Column:
    """Display text of a segment array: ``Thinking:`` before the first analysis only,
    a blank line before each final, ``Commentary:`` / ``Tool:`` lines, raw text as is."""
    first = F.array_position(F.transform(segments, lambda s: s["channel"]), "analysis")
    return F.array_join(F.transform(segments, lambda s, i: _rendered(s, i + 1 == first)), "")


def _joined(segments: Column, channel: str) -> Column:
    picked = F.filter(segments, lambda s: s["channel"] == channel)
    return F.when(F.size(picked) > 0, F.array_join(F.transform(picked, lambda s: s["content"]), ""))


def completion_parts(completions: DataFrame, id_col: str = "completion_id", text_col: str = "text") -> DataFrame:
    """Per completion: thinking text, final answer, whether a final exists and
    whether it was cut off (some segment left open)."""
    segs = segment_array(text_col)
    return completions.select(F.col(id_col), segs.alias("_s")).select(
        F.col(id_col),
        _joined(F.col("_s"), "analysis").alias("thinking"),
        _joined(F.col("_s"), "final").alias("final"),
        F.exists(F.col("_s"), lambda s: s["channel"] == "final").alias("has_final"),
        F.exists(F.col("_s"), lambda s: ~s["closed"]).alias("truncated"),
    )


def tool_calls(completions: DataFrame, id_col: str = "completion_id", text_col: str = "text") -> DataFrame:
    """One row per tool call: ``(id, pos, call, closed)``."""
    return (
        completion_segments(completions, id_col, text_col)
        .where(F.col("channel") == "tool")
        .select(F.col(id_col), "pos", F.col("content").alias("call"), "closed")
    )


def transcripts(completions: DataFrame, id_col: str = "completion_id", text_col: str = "text") -> DataFrame:
    """``id, transcript``: the display text of each completion."""
    return completions.select(F.col(id_col), segment_array(text_col).alias("_s")).select(
        F.col(id_col), render_transcript(F.col("_s")).alias("transcript")
    )
