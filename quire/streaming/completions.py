"""Streaming segmentation of completions (stateful, keyed by completion).

Input rows: ``completion_id, seq, chunk, is_last``; pieces may be cut anywhere
(markers may straddle pieces) and may arrive out of order or across
micro-batches. Per completion the state holds the text not yet emitted (raw text
since the last closed segment plus at most one open segment), the next expected
``seq``, the next output position and out-of-order pieces waiting for their
turn. Rows are emitted as segments close; the piece flagged ``is_last`` flushes
the rest; a one-row tombstone stays (with a retention set, until its timer fires), so a
replayed piece cannot reopen a finished completion. An optional processing-time timeout flushes completions
whose last piece never arrives. A completion whose unfinished text outgrows a bound fails
the query with a message that names it.

The output equals the batch segmentation of the whole text for any cutting
(``quire.streaming.segmenter``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from quire.streaming.segmenter import advance

PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTPUT_SCHEMA = StructType(
    [
        StructField("completion_id", LongType()),
        StructField("pos", IntegerType()),
        StructField("channel", StringType()),
        StructField("content", StringType()),
        StructField("closed", BooleanType()),
    ]
)
_CURSOR = StructType(
    [
        StructField("buf", StringType()),
        StructField("next_seq", IntegerType()),
        StructField("next_pos", IntegerType()),
        StructField("last_seq", IntegerType()),
        StructField("n_pending", IntegerType()),
        StructField("done", BooleanType()),
        StructField("open_at", IntegerType()),
    ]
)
_PIECE_KEY = StructType([StructField("seq", IntegerType())])
_PIECE = StructType([StructField("chunk", StringType()), StructField("is_last", BooleanType())])


# How much unfinished text a completion may hold.
MAX_OPEN_CHARS = 64 << 20


class CompletionSegmenter(StatefulProcessor):
    def __init__(
        self,
        idle_timeout_ms: int | None = None,
        retain_finished_ms: int | None = None,
        max_open_chars: int = MAX_OPEN_CHARS,
        keep_finished: bool = True,
    ):
        self.idle_timeout_ms = idle_timeout_ms
        self.retain_finished_ms = retain_finished_ms
        self.keep_finished = keep_finished
        self.max_open_chars = max_open_chars

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", _CURSOR)
        self.pending = handle.getMapState("pending", _PIECE_KEY, _PIECE)

    def _emit(self, key, rows, start_pos: int) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "completion_id": [key] * len(rows),
                "pos": list(range(start_pos, start_pos + len(rows))),
                "channel": [r[0] for r in rows],
                "content": [r[1] for r in rows],
                "closed": [r[2] for r in rows],
            }
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Pieces of this trigger are joined in memory; only pieces that arrive
        ahead of a gap are written to state, so state traffic per key and trigger
        is constant plus the out-of-order pieces."""
        cid = int(key[0])
        existed = self.cursor.exists()
        if existed:
            buf, next_seq, next_pos, last_seq, n_pending, finished, open_at = self.cursor.get()
            if finished:  # replayed pieces of a finished completion are ignored
                for _ in rows:
                    pass
                return
        else:
            buf, next_seq, next_pos, last_seq, n_pending, open_at = "", 0, 0, -1, 0, -1
        waiting: dict[int, str] = {}
        if n_pending:
            waiting = {k[0]: v[0] for k, v in self.pending.iterator()}
            self.pending.clear()
            n_pending = 0
        for pdf in rows:
            for seq, chunk, is_last in zip(pdf["seq"], pdf["chunk"], pdf["is_last"]):
                seq = int(seq)
                if seq < next_seq:
                    continue  # already consumed (a replayed piece)
                waiting[seq] = chunk if chunk is not None else ""
                if is_last:
                    last_seq = seq
        scanned = len(buf)
        parts = [buf]
        while next_seq in waiting:
            parts.append(waiting.pop(next_seq))
            next_seq += 1
        buf = "".join(parts)
        done = last_seq >= 0 and next_seq > last_seq
        out, rest, open_at = advance(buf, done, scanned, open_at)
        if out:
            yield self._emit(cid, out, next_pos)
        next_pos += len(out)
        if done:  # (pending pieces were loaded and cleared above)
            if self.keep_finished:  # a tombstone keeps late duplicates harmless; a timer drops it
                self.cursor.update(("", next_seq, next_pos, last_seq, 0, True, -1))
                if self.retain_finished_ms:
                    self._arm_timer(timerValues, self.retain_finished_ms)
                else:
                    self._clear_timers()
            elif existed:  # a completion seen whole in one trigger never touched state
                self._clear_timers()
                self.cursor.clear()
            return
        held = len(rest) + sum(map(len, waiting.values()))
        if held > self.max_open_chars:
            raise ValueError(f"completion {cid} holds {held} characters of unfinished text, above the bound of {self.max_open_chars}")
        for seq, chunk in waiting.items():
            self.pending.updateValue((seq,), (chunk, seq == last_seq))
        self.cursor.update((rest, next_seq, next_pos, last_seq, len(waiting), False, open_at))
        if self.idle_timeout_ms:
            self._arm_timer(timerValues, self.idle_timeout_ms)

    def _clear_timers(self) -> None:
        if not (self.idle_timeout_ms or self.retain_finished_ms):
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def _arm_timer(self, timerValues, after_ms: int) -> None:
        self._clear_timers()
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(after_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Abandoned completion: flush what is there (pieces after a gap included, in order)."""
        if not self.cursor.exists():
            return
        buf, next_seq, next_pos, _, n_pending, finished, _ = self.cursor.get()
        if finished:
            self.cursor.clear()
            return
        waiting = sorted(((k[0], v[0]) for k, v in self.pending.iterator())) if n_pending else []
        text = buf + "".join(c for _, c in waiting)
        out, _, _ = advance(text, True)
        if out:
            yield self._emit(int(key[0]), out, next_pos)
        self.cursor.clear()
        self.pending.clear()

    def close(self) -> None:
        pass


def segment_stream(
    pieces: DataFrame,
    idle_timeout_ms: int | None = None,
    retain_finished_ms: int | None = None,
    max_open_chars: int = MAX_OPEN_CHARS,
) -> DataFrame:
    """``completion_id, seq, chunk, is_last`` stream → segment rows (append mode).

    ``idle_timeout_ms``: flush a completion whose last piece has not arrived after
    this long without new pieces; ``retain_finished_ms``: how long a finished
    completion keeps its tombstone, a row of a few bytes (None: for good). Either needs
    processing-time timers, which keep a stream running: streams that stop when they
    have read what is there (``availableNow``) leave both unset. A table read once, as a
    batch, keeps no tombstones. A changed setting needs a new checkpoint.

    One shuffle by completion id; the per-key work is a pass over that completion's
    new text. The state store must be RocksDB: set here if the session names none.
    """
    from quire.session import ship_package

    spark = pieces.sparkSession
    ship_package(spark)
    _ = spark.streams.active  # starts the state-store coordinator (also needed for batch input)
    if spark.conf.get(PROVIDER_CONF, "").rpartition(".")[2] != ROCKSDB_PROVIDER.rpartition(".")[2]:
        spark.conf.set(PROVIDER_CONF, ROCKSDB_PROVIDER)
    time_mode = "ProcessingTime" if idle_timeout_ms or retain_finished_ms else "None"
    return pieces.groupBy("completion_id").transformWithStateInPandas(
        statefulProcessor=CompletionSegmenter(idle_timeout_ms, retain_finished_ms, max_open_chars, keep_finished=pieces.isStreaming),
        outputStructType=OUTPUT_SCHEMA,
        outputMode="Append",
        timeMode=time_mode,
    )
