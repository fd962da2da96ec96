"""Bounded-space online packing of token ids into windows of at most SIZE tokens.

Each task keeps OPEN windows. A document's full windows stand alone; its rest goes to the open window
that it fits best. When it fits none, the fullest window is emitted, topped up with the beginning of
the rest if at least LEAST_CUT ids fit. At its end a task pours its open windows together, so that
one is left over; the tasks' leftovers are poured together in rounds of GROUP. So all but one window
lack fewer than LEAST_CUT ids, and nothing is sorted or gathered as a whole.

Null text counts as empty; an empty document is its end id. A repeated row is a document of its own.
An empty table gives no rows. A document of any length is cut; each id is in exactly one piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import arrow_schema, find_package, stored
from barlake.llm.simple8b import with_end
from barlake.llm.token_ids import BYTE_BPE, encoder

SIZE = 1024
OPEN = 64
LEAST_CUT = 16
GROUP = 256
END_ID = 0
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, leftover boolean"
)


class Window:
    """Pieces (doc_id, start, ids, doc_tokens) in a row."""

    def __init__(self, sequence_id: int):
        self.sequence_id, self.pieces, self.free = sequence_id, [], SIZE

    def put(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.free -= len(piece[2])

    def top_up(self, piece: tuple) -> tuple:
        """Fill the window with the beginning of a piece, and return the rest of it."""
        doc_id, start, ids, total = piece
        cut = self.free
        self.put((doc_id, start, ids[:cut], total))
        return doc_id, start + cut, ids[cut:], total


class Packer:
    def __init__(self, first_id: int):
        self.next_id = first_id
        self.open: list[tuple[int, int, Window]] = []  # by free space, then age
        self.done: list[Window] = []

    def new(self) -> Window:
        self.next_id += 1
        return Window(self.next_id - 1)

    def keep(self, window: Window) -> None:
        if window.free:
            insort(self.open, (window.free, window.sequence_id, window))
        else:
            self.done.append(window)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, full = len(ids), len(ids) - len(ids) % SIZE
        for start in range(0, full, SIZE):
            window = self.new()
            window.put((doc_id, start, ids[start : start + SIZE], total))
            self.done.append(window)
        if full < total:
            self.place((doc_id, full, ids[full:], total))

    def place(self, piece: tuple) -> None:
        at = bisect_left(self.open, (len(piece[2]),))
        if at < len(self.open):
            window = self.open.pop(at)[2]
        elif len(self.open) < OPEN:
            window = self.new()
        else:
            fullest = self.open.pop(0)[2]
            self.done.append(fullest)
            if fullest.free >= LEAST_CUT:
                piece = fullest.top_up(piece)
            return self.place(piece)
        window.put(piece)
        return self.keep(window)

    def emitted(self) -> list[Window]:
        out, self.done = self.done, []
        return out


def poured(windows: list[Window]) -> list[Window]:
    """Pour the emptiest windows into the fullest; at most one of the result is not full."""
    windows = sorted(windows, key=lambda w: (w.free, w.sequence_id))
    at, last = 0, len(windows) - 1
    while at < last:
        to, source = windows[at], windows[last]
        piece = source.pieces.pop()
        source.free += len(piece[2])
        if len(piece[2]) > to.free:
            piece = to.top_up(piece)
            source.put(piece)
        else:
            to.put(piece)
        at += not to.free
        last -= not source.pieces
    return [w for w in windows if w.pieces]


def rows_of(windows: list[Window], schema: pa.Schema, leftover: bool = False) -> pa.RecordBatch:
    """One row per piece; with ``leftover``, windows that aren't full are marked as such."""
    columns: list[list] = [[] for _ in schema]
    for w in windows:
        offset = 0
        for doc_id, start, ids, total in w.pieces:
            row = (doc_id, start, len(ids), total, w.sequence_id, offset, ids.astype("<u4").tobytes(), leftover and w.free > 0)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def pack(docs: DataFrame, end_id: int = END_ID, tokenizer: str = BYTE_BPE) -> DataFrame:
    """Pieces of documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids (u32 bytes)."""
    find_package(docs.sparkSession)
    target = arrow_schema(docs.sparkSession, PIECES)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                own = batch.slice(at, 1000)
                ids, sizes = with_end(*encoder(tokenizer).encode(own.column(1)), end_id)
                ends = np.cumsum(sizes).tolist()
                for doc_id, start, end in zip(own.column(0).to_pylist(), [0, *ends], ends, strict=False):
                    packer.add(doc_id, ids[start:end])
                if packer.done:
                    yield rows_of(packer.emitted(), target)
        if left := poured([w for _, _, w in packer.open]):
            yield rows_of(left, target, leftover=True)

    pieces = stored(narrow.mapInArrow(online, PIECES), "pieces")
    done, left = pieces.where("NOT leftover"), pieces.where("leftover")
    n = left.select("sequence_id").distinct().count()
    while n > 1:
        groups = -(-n // GROUP)
        merged = stored(_pour(left, groups), "leftovers")
        done = done.unionByName(merged.where("NOT leftover"))
        left = merged.where("leftover")
        if groups == 1:
            break
        n = left.select("sequence_id").distinct().count()
    return done.unionByName(left).drop("leftover")


def _pour(left: DataFrame, groups: int) -> DataFrame:
    target = arrow_schema(left.sparkSession, PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: dict[int, Window] = {}
        for batch in batches:
            for row in batch.to_pylist():
                window = windows.setdefault(row["sequence_id"], Window(row["sequence_id"]))
                window.put((row["doc_id"], row["start"], np.frombuffer(row["ids"], "<u4"), row["doc_tokens"]))
        if windows:
            yield rows_of(poured(list(windows.values())), target, leftover=True)

    # A window's pieces stay together; a task holds a few hundred windows.
    dealt = left.repartition(groups, "sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, pad_id: int = END_ID) -> DataFrame:
    """(sequence_id, n_tokens, ids): whole windows, padded to SIZE except at a power of two."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(ordered, F.lit(b""), lambda done, piece: F.concat(done, piece["ids"])).alias("ids"),
    )
    pad = F.lit(pad_id.to_bytes(4, "little"))
    whole = F.expr("bit_count(n_tokens) = 1")
    padding = F.when(whole, F.lit(b"")).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(SIZE)), F.lit(b""), lambda done, i: F.when(i > F.col("n_tokens"), F.concat(done, pad)).otherwise(done))
    )
    return joined.withColumn("ids", F.concat("ids", padding))
