"""Bounded-space online packing of documents into training sequences (operator 9).

Each task reads its rows once and keeps at most ``open_windows`` unfinished windows.  A
document's ids go to the open window they fit best; when none fits and no further window
may be opened, the fullest window is topped up with the document's first ids, emitted
full, and its place goes to the rest.  What is still open at the end of a task is merged:
the leftover windows of ``fan_in`` neighbouring tasks are packed, whole, by best fit.
Nothing but narrow piece rows is ever shuffled.

Results for odd input: null and empty texts consist of the end id alone; repeated rows
are packed as often as they occur; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import write_table
from tallyspark.llm.tokens import CACHE_ENTRIES, worker_encoder
from tallyspark.llm.wordio import text_slices

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "window_id long, offset long, is_full boolean, window_tokens long, task long")
SMALL_CACHE = 120_000  # pieces whose ids a task keeps where it shares the executor's memory, about 20 MB
_TASK_SHIFT = 36  # window ids: task number, then the window's number within the task


class _Packer:
    """The open windows of one task; ``done`` collects the rows of emitted windows."""

    def __init__(self, task: int, capacity: int, open_windows: int) -> None:
        self.task, self.capacity, self.open_windows = task, capacity, open_windows
        self.next_id = task << _TASK_SHIFT
        self.free: list[tuple[int, int]] = []  # (room left, window id), ascending
        self.rows: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def _emit(self, window: int, is_full: bool) -> None:
        rows = self.rows.pop(window)
        used = sum(r[2] for r in rows)
        self.done.extend((*r, is_full, used, self.task) for r in rows)

    def _put(self, piece: tuple, room: int, window: int) -> None:
        self.rows[window].append((*piece, window, self.capacity - room))
        if room > piece[2]:
            insort(self.free, (room - piece[2], window))
        else:
            self._emit(window, True)

    def add(self, doc_id, ids: bytes) -> None:
        total, start = len(ids) // 4, 0

        def piece(length: int) -> tuple:
            return doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), total

        while start < total:
            length = min(total - start, self.capacity)
            fit = bisect_left(self.free, (length, -1))
            if length < self.capacity and fit < len(self.free):
                room, window = self.free.pop(fit)
            elif length == self.capacity or len(self.free) < self.open_windows:
                room, window = self.capacity, self.next_id
                self.rows[window] = []
                self.next_id += 1
            else:  # the fullest window takes what it has room for
                room, window = self.free.pop(0)
                length = room
            self._put(piece(length), room, window)
            start += length

    def close(self) -> None:
        for window in list(self.rows):
            self._emit(window, False)
        self.free = []

    def take(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
        columns = list(zip(*rows)) or [()] * len(names)
        kinds = [pa.bool_() if n == "is_full" else pa.int64() for n in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _merge(capacity: int):
    def merge(windows: pd.DataFrame) -> pd.DataFrame:
        """Best fit, largest first; a merged sequence takes the id of its first window."""
        windows = windows.sort_values(["window_tokens", "window_id"], ascending=[False, True])
        free: list[tuple[int, int]] = []
        out = []
        for window, size in zip(windows.window_id.tolist(), windows.window_tokens.tolist()):
            fit = bisect_left(free, (size, -1))
            room, sequence = free.pop(fit) if fit < len(free) else (capacity, window)
            out.append((window, sequence, capacity - room))
            if room > size:
                insort(free, (room - size, sequence))
        return pd.DataFrame(out, columns=["window_id", "sequence_id", "base"])

    return merge


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 4096,
         open_windows: int = 32, fan_in: int = 32, share_memory: bool = False) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``share_memory`` is for jobs whose earlier stages left Python workers on the executors: a
    task keeps the ids of fewer words and frees them when it ends; the result is the same.
    A task holds at most ``open_windows`` windows of piece rows (not of ids); a merging
    group holds at most ``fan_in * open_windows`` window rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value, SMALL_CACHE if share_memory else CACHE_ENTRIES)
        packer = _Packer(TaskContext.get().partitionId(), capacity, open_windows)
        for batch in batches:
            for start, stop in text_slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                offsets, ids = encoder.encode(part.column("text"), end_id)
                stops = offsets.tolist()
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), stops, stops[1:]):
                    packer.add(doc_id, ids[a:b].tobytes())
                yield packer.take()
        packer.close()
        yield packer.take()
        if share_memory:
            encoder.cache.clear()

    # written once, so a recomputed task can never disagree with rows already used
    table = write_table(docs.select("doc_id", "text").mapInArrow(pieces, PIECE_SCHEMA), "packing")
    open_pieces = table.where(~F.col("is_full"))
    windows = open_pieces.where(F.col("offset") == 0).select(
        "window_id", "window_tokens", F.floor(F.col("task") / fan_in).alias("group"))
    merged = windows.groupBy("group").applyInPandas(_merge(capacity), "window_id long, sequence_id long, base long")
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = table.where("is_full").select(*kept, F.col("window_id").alias("sequence_id"), "offset")
    rest = open_pieces.join(merged, "window_id").select(
        *kept, "sequence_id", (F.col("base") + F.col("offset")).alias("offset"))
    return full.unionByName(rest)
