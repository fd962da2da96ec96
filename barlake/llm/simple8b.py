"""Token-id files: Simple-8b words in blocks, with offsets for vectorised decoding.

A 64-bit word holds a 4-bit selector and 60 bits of data: as many ids as fit at the selector's
width. The first selector stands for zeros only; the second is an escape, and the word behind it is
one raw 64-bit value. Ids are cut into blocks of BLOCK ids, and the offsets of the blocks' words are
kept, so blocks are encoded side by side, and any block can be decoded without those before it.

File: the magic number, then chunks. Chunk: counts of documents, ids, blocks and words (4 x u64);
doc_ids (i64), null flags of the doc_ids (u8), lengths (u64), word offsets of the blocks (u64,
blocks + 1), words (u64); all little-endian. Files are in ascending doc_id order, as are the
documents in a file (null doc_ids first, repeated ones by the hash of their text).

Null text counts as empty; an empty document has its end id only. An empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.scratch import arrow_schema, find_package, shared_folder, stored
from barlake.llm.token_ids import BYTE_BPE, encoder

MAGIC = b"S8BLOCK1"
BLOCK = 4096
ZEROS, ESCAPE = 0, 1
#: Selector -> (ids in a word, bits of each).
PACKINGS = {ZEROS: (120, 0)} | {
    at: (60 // bits, bits) for at, bits in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60), start=2)
}
END_ID = 2
DOCS_IN_CHUNK = 1000
FILE_ROW = "part long, path string, n_docs long, n_ids long, n_bytes long"
ID_ROW = "doc_id long, start long, n_tokens long, ids binary"


def bit_widths(values: np.ndarray) -> np.ndarray:
    top = int(values.max()).bit_length()
    if top <= 20:
        table = np.zeros(1 << top, np.uint8)
        for bits in range(top):
            table[1 << bits :] = bits + 1
        return table[values]
    width = np.zeros(values.shape, np.uint8)
    for bits in range(top):
        width += values >= np.uint64(1 << bits)
    return width


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, word offset of each block and of the end) of unsigned 64-bit integers."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return np.empty(0, np.uint64), np.zeros(1, np.uint64)
    padded = np.zeros((n_blocks, BLOCK + 120), np.uint64)  # a word may reach beyond the end, into zeros
    full = len(ids) // BLOCK
    padded[:full, :BLOCK] = ids[: full * BLOCK].reshape(full, BLOCK)
    if full < n_blocks:
        padded[full, : len(ids) - full * BLOCK] = ids[full * BLOCK :]
    width = bit_widths(padded)
    take, selector = np.ones(padded.shape, np.uint8), np.full(padded.shape, ESCAPE, np.uint8)
    widest, reach = width.copy(), 1  # of the next ``reach`` ids
    for s, (count, bits) in reversed(PACKINGS.items()):
        while reach < count:
            step = min(reach, count - reach)
            widest[:, :-step] = np.maximum(widest[:, :-step], widest[:, step:])
            reach += step
        fits = widest <= bits
        if not fits[:, :BLOCK].any():
            break  # narrower ids need longer runs
        np.copyto(take, count, where=fits)
        np.copyto(selector, s, where=fits)
    sizes = np.full(n_blocks, BLOCK)
    sizes[-1] = len(ids) - BLOCK * (n_blocks - 1)
    rows, at = np.arange(n_blocks), np.zeros(n_blocks, np.int64)
    begins = np.zeros(padded.shape, bool)
    while len(rows):  # one step in all blocks at once
        begins[rows, at] = True
        at = at + take[rows, at]
        inside = at < sizes[rows]
        if not inside.all():
            rows, at = rows[inside], at[inside]
    first = np.flatnonzero(begins)
    row = first // padded.shape[1]
    chosen = selector.ravel()[first]
    n_words = 1 + (chosen == ESCAPE)
    place = np.cumsum(n_words) - n_words
    words = np.zeros(int(n_words.sum()), np.uint64)
    flat = padded.ravel()
    for s in np.unique(chosen).tolist():
        mine = chosen == s
        if s == ESCAPE:
            words[place[mine]] = np.uint64(ESCAPE << 60)
            words[place[mine] + 1] = flat[first[mine]]
            continue
        count, bits = PACKINGS[s]
        word = np.full(int(mine.sum()), s << 60, np.uint64)
        for k in range(count if bits else 0):
            word |= flat[first[mine] + k] << np.uint64(k * bits)
        words[place[mine]] = word
    offsets = np.zeros(n_blocks + 1, np.uint64)
    offsets[1:] = np.cumsum(np.bincount(row, weights=n_words, minlength=n_blocks)).astype(np.uint64)
    return words, offsets


def decode_blocks(words: np.ndarray, offsets: np.ndarray, n_ids: int) -> np.ndarray:
    """The integers of consecutive blocks; all but the last are full."""
    if not n_ids:
        return np.empty(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.uint8)
    escapes = np.flatnonzero(selector == ESCAPE)
    if len(escapes):  # the word behind an escape is raw, whatever it looks like
        raw = np.zeros(len(words), bool)
        for at in escapes.tolist():
            raw[at + 1 : at + 2] = not raw[at]
        head = np.flatnonzero(~raw)
    else:
        head = np.arange(len(words))
    chosen = selector[head]
    counts = np.ones(16, np.int64)
    for s, (count, _) in PACKINGS.items():
        counts[s] = count
    block = np.searchsorted(offsets, head, side="right") - 1
    size = counts[chosen]
    ends = np.cumsum(size)
    # In each block ids start at a multiple of BLOCK, wherever the padding of the one before ends.
    first_word = np.searchsorted(head, offsets[:-1])
    before = (ends - size)[first_word]
    place = ends - size - before[block] + block * BLOCK
    out = np.zeros((len(offsets) - 1) * BLOCK + 120, np.uint64)
    limit = (block + 1) * BLOCK
    for s in np.unique(chosen).tolist():
        mine = chosen == s
        if s == ESCAPE:
            out[place[mine]] = words[head[mine] + 1]
            continue
        count, bits = PACKINGS[s]
        word, to, end, mask = words[head[mine]], place[mine], limit[mine], np.uint64((1 << bits) - 1)
        for k in range(count if bits else 0):
            inside = to + k < end
            out[(to + k)[inside]] = (word[inside] >> np.uint64(k * bits)) & mask
    return out[:n_ids]


def chunk_bytes(doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = encode_blocks(ids)
    nulls = np.array([x is None for x in doc_ids], np.uint8)
    counts = np.array([len(doc_ids), len(ids), len(offsets) - 1, len(words)], "<u8")
    known = np.array([0 if x is None else x for x in doc_ids], "<i8")
    parts = (counts, known, nulls, sizes.astype("<u8"), offsets.astype("<u8"), words.astype("<u8"))
    return b"".join(x.tobytes() for x in parts)


def read_chunks(stream) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, lengths, ids) of each chunk."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token-id file")

    def take(kind: str, n: int) -> np.ndarray:
        data = stream.read(np.dtype(kind).itemsize * n)
        if len(data) != np.dtype(kind).itemsize * n:
            raise ValueError("the token-id file ends too early")
        return np.frombuffer(data, kind)

    while head := stream.read(32):
        n_docs, n_ids, n_blocks, n_words = np.frombuffer(head, "<u8").tolist()
        doc_ids, nulls, sizes = take("<i8", n_docs).tolist(), take("u1", n_docs), take("<u8", n_docs)
        offsets, words = take("<u8", n_blocks + 1), take("<u8", n_words)
        for at in np.flatnonzero(nulls).tolist():
            doc_ids[at] = None
        yield doc_ids, sizes.astype(np.int64), decode_blocks(words, offsets, n_ids)


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each document's ids followed by the end id."""
    return np.insert(ids, np.cumsum(sizes), np.uint32(end_id)), sizes + 1


def write_ids(docs: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str = BYTE_BPE) -> DataFrame:
    """Write the files into ``folder`` and return (part, path, n_docs, n_ids, n_bytes), one row each.

    A task writes a file of its own name; only files of tasks that ended well are in the result, so
    tasks may be repeated.
    """
    find_package(docs.sparkSession)
    target = arrow_schema(docs.sparkSession, FILE_ROW)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    key = ["doc_id", F.xxhash64("text")]
    ordered = narrow.repartitionByRange(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        path, stream, n_docs, n_ids = f"{top}/{part:08d}-{uuid.uuid4().hex}.s8b", None, 0, 0
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, DOCS_IN_CHUNK):
                    own = batch.slice(at, DOCS_IN_CHUNK)
                    if stream is None:
                        files.create_dir(top)
                        stream = files.open_output_stream(path)
                        stream.write(MAGIC)
                    ids, sizes = with_end(*encoder(tokenizer).encode(own.column(1)), end_id)
                    stream.write(chunk_bytes(own.column(0).to_pylist(), sizes, ids))
                    n_docs, n_ids = n_docs + own.num_rows, n_ids + len(ids)
            if stream is None:
                return
            n_bytes = stream.tell()
        finally:
            if stream is not None:
                stream.close()
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": path, "n_docs": n_docs, "n_ids": n_ids, "n_bytes": n_bytes}], schema=target
        )

    return stored(ordered.mapInArrow(run, FILE_ROW), "id-files")


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents in the files; ids as little-endian u32.

    ``start`` counts the ids of all documents before. One row per file is added up for it.
    """
    find_package(files.sparkSession)
    target = arrow_schema(files.sparkSession, ID_ROW)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    spread = placed.repartition(max(1, files.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start = row["base"]
                with source.open_input_stream(row["path"]) as stream:
                    for doc_ids, sizes, ids in read_chunks(stream):
                        ends = np.cumsum(sizes)
                        flat = ids.astype("<u4").tobytes()
                        cut = [flat[4 * a : 4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                        columns = (doc_ids, start + ends - sizes, sizes, cut)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target
                        )
                        start += int(ends[-1]) if len(ends) else 0

    return spread.mapInArrow(run, ID_ROW)


def encoded_and_read(docs: DataFrame) -> DataFrame:
    """Write the documents' ids to a new folder beside the checkpoints and read them back."""
    folder = _uri(docs.sparkSession, shared_folder(docs.sparkSession, "ids"))
    return read_ids(write_ids(docs, folder), folder)


def _uri(spark: SparkSession, folder: str) -> str:
    """The folder with its file system, as Spark itself would complete it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole.replace("file:/", "file:///", 1) if re.match("file:/[^/]", whole) else whole
