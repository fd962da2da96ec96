"""Two tokenizers' tokens aligned by their bytes, with corpus-wide counts of the id pairs that meet.

Both encodings of a text spell the same bytes. Every stretch between two neighbouring token ends, of
either side, lies in one token of each: it is one link. Places where both sides end cut the tokens
into groups. All of it is found for many texts at once from the sorted ends. Texts whose white space
stands alone fall apart into units (a space or newline and what follows) that both sides encode
independently; a bounded memo keeps the alignment of units, which only saves time.

Counting is an external merge. A task turns a chunk of documents into records (pair, document, links),
sorts them by pair and cuts them by radix (the low bits of the A id) into zstd runs: a head with each
pair and its number of documents, a body with the documents. Heads of one radix are merged through a
heap, FAN_IN runs at a time and level by level, so no task reads more than FAN_IN runs however
common a pair is. The last level has one run a radix, in side-major order (A id, then B id), so the
maximum of each A id is a maximum over neighbours. That run then meets the records of the same radix,
group of chunks by group of chunks, and each record sends its pair's count back to its document.

Null and empty texts, and texts whose tokens of either side do not spell space + text, have no tokens:
zeros and an empty digest. Null and repeated ids are documents of their own, as are repeated rows. An
empty table gives no rows. Other columns are not read. One text has to fit into a task's memory.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlake.llm.scratch import arrow_schema, find_package, stored
from barlake.llm.token_ids import RUNS

SIDE_A = "byte_bpe_50k.json"
SIDE_B = "piece_bpe_32k.model"
SPACE = "▁"
MEMO_UNITS = 250_000
#: Units that go through a tokenizer as one text.
JOINED = 200
#: Bits of a pair's code: radix, rest of the A id, B id; and of a document's place in its chunk.
RADIX_BITS, ID_BITS, PLACE_BITS = 4, 16, 16
CHUNK_DOCS, CHUNK_BYTES, PIECE_BYTES = 2048, 2 << 20, 1 << 19
FAN_IN = 64
#: Bytes of runs that one group of chunks may have.
GROUP_BYTES = 128 << 20

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNKS = (
    "chunk long, ids array<long>, " + ", ".join(f"{c} array<long>" for c in _COUNTS) + ", digests array<string>, "
    "runs array<struct<radix: int, head: binary, body: binary>>"
)


class Aligner:
    """Encode texts by both tokenizers and align them."""

    def __init__(self, side_a: str, side_b: str):
        self.a = Tokenizer.from_file(public_tokenizers.path(side_a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(side_b))
        # Byte-level BPE writes a byte that is no printable character as one from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shifted = iter(range(256, 512))
        byte = {chr(b if b in printable else next(shifted)): b for b in range(256)}
        names = [self.a.id_to_token(i) for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(byte[c] for c in n) if n and all(c in byte for c in n) else (n or "").encode() for n in names]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits are not supported")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces):
            raise ValueError("pieces that span words or lines are not supported")
        self.size_a, self.spelt_a = spelling(self.bytes_a)
        self.size_b, self.spelt_b = spelling(self.bytes_b)
        # What is written for an id inside a group, and as the last of its side in the group.
        ids = [f"{i}{mark}" for n, last in ((len(self.bytes_a), "|"), (len(self.bytes_b), ";")) for i in range(n) for mark in (",", last)]
        self.decimals = pa.array(ids, pa.large_string())
        self.memo_units = MEMO_UNITS
        self.clear()

    def clear(self) -> None:
        """An empty memo."""
        self.place: dict[str, int] = {}
        self.good, self.uses = np.empty(0, bool), np.empty(0, np.int64)
        self.counts = np.empty((len(_COUNTS), 0), np.int64)
        self.links, self.marks = np.empty(0, np.int64), np.empty(0, np.int32)

    def forget(self) -> None:
        """Keep the half of the memo that was used most, and let older uses fade."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.memo_units // 2])
        names = list(self.place)
        self.links = gathered(self.links, *chosen(self.counts[3], kept))
        self.marks = gathered(self.marks, *chosen(self.counts[0] + self.counts[1], kept))
        self.place = {names[i]: at for at, i in enumerate(kept.tolist())}
        self.good, self.counts, self.uses = self.good[kept], self.counts[:, kept], self.uses[kept] // 2

    def spells(self, texts: list[str], n_a: np.ndarray, a: np.ndarray, n_b: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which texts both sides spell byte for byte."""
        want = [t.encode() for t in texts]
        sizes, whole = np.fromiter(map(len, want), np.int64, len(want)), np.frombuffer(b"".join(want), np.uint8)
        good = np.ones(len(texts), bool)
        for n, ids, size, (flat, starts) in ((n_a, a, self.size_a, self.spelt_a), (n_b, b, self.size_b, self.spelt_b)):
            spelt = gathered(flat, starts[ids], size[ids])
            if len(spelt) == len(whole) and np.array_equal(spelt, whole) and np.array_equal(added(size[ids], n), sizes):
                continue
            ends = np.cumsum(added(size[ids], n)).tolist()  # not all of them, so one by one
            each = (spelt[s:e].tobytes() == w for s, e, w in zip([0, *ends], ends, want, strict=False))
            good &= np.fromiter(each, bool, len(texts))
        return good

    def ids_a(self, texts: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of each text, ids) of side A. Texts that fall apart anyway are encoded JOINED at a time, which is
        much faster; the bytes that ids stand for say where each text ends."""
        step = JOINED if joined else 1
        parts = ["".join(texts[at : at + step]) for at in range(0, len(texts), step)] if joined else texts
        found = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        if not joined:
            return np.fromiter(map(len, found), np.int64, len(texts)), ids
        ends = np.cumsum(np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts)))
        return np.diff(np.searchsorted(np.cumsum(self.size_a[ids]), ends, side="right"), prepend=0), ids

    def align(
        self, texts: list[str], side_b: list[list[int]], joined: bool = False
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(good, counts, links, marks) of texts of side A and their ids of side B.

        ``good`` says whether both sides spell the text; others have no tokens. ``links`` are the codes of the
        linked pairs, text by text; ``marks`` are the places in ``decimals`` of what is written for the groups.
        """
        n_a, a = self.ids_a(texts, joined)
        n_b = np.fromiter(map(len, side_b), np.int64, len(texts))
        b = np.fromiter(chain.from_iterable(side_b), np.int64)
        good = self.spells(texts, n_a, a, n_b, b)
        if not good.all():
            a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.flatnonzero(np.diff(ends, prepend=0))]
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        both = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        # How many links and groups each text has, from the byte at which it ends.
        last = np.concatenate([[0], ends_a])[np.cumsum(n_a)]
        n_links = np.diff(np.searchsorted(ends, last, side="right"), prepend=0)
        n_groups = np.diff(np.searchsorted(ends[both], last, side="right"), prepend=0)
        counts = np.array([n_a, n_b, n_groups, n_links], np.int64).reshape(len(_COUNTS), -1)
        return good, counts, pair_codes(a[at_a], b[at_b]), self.marked(a, b, at_a[both], at_b[both])

    def marked(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
        """Places in ``decimals``, group by group: a group's ids of side A, then those of side B."""
        out = np.empty(len(a) + len(b), np.int32)
        ending = np.zeros(len(a), np.int64)
        ending[last_a] = 1
        group = np.cumsum(ending) - ending
        out[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group]] = 2 * a + ending
        ending = np.zeros(len(b), np.int64)
        ending[last_b] = 1
        group = np.cumsum(ending) - ending
        out[np.arange(len(b)) + (last_a + 1)[group]] = 2 * (len(self.bytes_a) + b) + ending
        return out

    def digests(self, marks: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Of each text what is written for its groups, hashed; texts without tokens have none."""
        written = self.decimals.take(pa.array(marks))
        ends = np.frombuffer(written.buffers()[1], np.int64, len(marks) + 1)[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        data = memoryview(written.buffers()[2] or b"")
        # Without the mark behind the last group.
        return [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:], strict=False)]

    def units(self, words: list[str]) -> np.ndarray:
        """Places of these different units in the memo; unknown ones are aligned and added."""
        get, n = self.place.get, len(self.place)
        found = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            ids = self.b.encode(new, num_threads=1)
            # Behind a newline there is no space; the one that the library puts in front is dropped.
            lines = [w[0] == "\n" for w in new]
            ids = [x[1:] if line else x for x, line in zip(ids, lines, strict=True)]
            texts = [w if line else " " + w for w, line in zip(new, lines, strict=True)]
            good, counts, links, marks = self.align(texts, ids, joined=True)
            self.good, self.links = np.concatenate([self.good, good]), np.concatenate([self.links, links])
            self.marks = np.concatenate([self.marks, marks])
            self.counts = np.concatenate([self.counts, counts], axis=1)
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            found[missing] = np.arange(n, n + len(new))
            self.place.update(zip(new, range(n, n + len(new)), strict=True))
        return found

    def plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(counts, links, digests) of texts whose white space stands alone: they are put together from units."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        at = np.asarray(coded.indices)
        known = self.units(coded.dictionary.to_pylist())
        self.uses[known] += np.bincount(at, minlength=len(known))
        places = known[at]
        offsets = np.asarray(split.offsets).astype(np.int64) - split.offsets[0].as_py()
        good = np.logical_and.reduceat(self.good[places], offsets[:-1])
        used = places if good.all() else places[np.repeat(good, np.diff(offsets))]
        counts = np.add.reduceat(self.counts[:, places], offsets[:-1], axis=1) * good
        links = gathered(self.links, *chosen(self.counts[3], used))
        marks = gathered(self.marks, *chosen(self.counts[0] + self.counts[1], used))
        return counts, links, self.digests(marks, counts[0] + counts[1])

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(counts, links, owners, digests): by text; the codes of all links, and the text of each."""
        if len(self.place) > self.memo_units:
            self.forget()
        n = len(texts)
        odd = pc.or_(pc.match_substring_regex(texts, RUNS), pc.or_(pc.equal(texts, ""), pc.match_substring(texts, SPACE)))
        odd = np.asarray(odd, dtype=bool)
        counts, digests = np.zeros((len(_COUNTS), n), np.int64), [""] * n
        links: list[np.ndarray] = [np.empty(0, np.int64)]
        owners: list[np.ndarray] = [np.empty(0, np.int64)]
        own = np.flatnonzero(~odd)
        for at, part in ((own, texts.take(pa.array(own))), (np.flatnonzero(odd), None)):
            if part is None:
                at = np.array([i for i in at.tolist() if texts[i].as_py()], np.int64)
                whole = [texts[i].as_py() for i in at.tolist()]
                _, found, codes, marks = self.align([" " + t for t in whole], self.b.encode(whole, num_threads=1))
                hashed = self.digests(marks, found[0] + found[1])
            elif len(at):
                found, codes, hashed = self.plain(part)
            if len(at):
                counts[:, at] = found
                links.append(codes)
                owners.append(np.repeat(at, found[3]))
                for i, mark in zip(at.tolist(), hashed, strict=True):
                    digests[i] = mark
        return counts, np.concatenate(links), np.concatenate(owners), digests


def spelling(names: list[bytes]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Bytes of each id: how many, and all of them in a row with the place of each id's first."""
    sizes = np.array([len(x) for x in names], np.int64)
    return sizes, (np.frombuffer(b"".join(names), np.uint8), np.cumsum(sizes) - sizes)


def chosen(sizes: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the chosen ones of runs that lie one behind the other."""
    return (np.cumsum(sizes) - sizes)[kept], sizes[kept]


def added(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of the given sizes."""
    ends = np.cumsum(sizes)
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[ends] - upto[ends - sizes]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def pair_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Codes that sort by radix, then A id, then B id."""
    radix = a & ((1 << RADIX_BITS) - 1)
    return radix << (2 * ID_BITS) | (a >> RADIX_BITS) << ID_BITS | b


@lru_cache(maxsize=2)
def aligner(side_a: str, side_b: str) -> Aligner:
    return Aligner(side_a, side_b)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, the first of them rising, as one zstd frame."""
    first = np.diff(arrays[0], prepend=0).astype("<u4")
    return zstandard.compress(b"".join(x.astype("<u4" if x is first else "<u8").tobytes() for x in (first, *arrays[1:])), 1)


def unpacked(frame: bytes, wide: int = 1) -> list[np.ndarray]:
    raw = zstandard.decompress(frame)
    n = len(raw) // (4 + 8 * wide)
    first = np.cumsum(np.frombuffer(raw, "<u4", n).astype(np.int64))
    return [first, *np.frombuffer(raw, "<u8", n * wide, 4 * n).astype(np.int64).reshape(wide, n)]


def body(places: np.ndarray, links: np.ndarray) -> bytes:
    return zstandard.compress(places.astype("<u2").tobytes() + links.astype("<u4").tobytes(), 1)


def of_body(frame: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(frame)
    n = len(raw) // 6
    return np.frombuffer(raw, "<u2", n).astype(np.int64), np.frombuffer(raw, "<u4", n, 2 * n).astype(np.int64)


def runs_of(links: np.ndarray) -> list[dict]:
    """The records (pair code and document) of a chunk's links, sorted by pair and cut by radix."""
    records, times = np.unique(links, return_counts=True)
    codes, places = records >> PLACE_BITS, records & ((1 << PLACE_BITS) - 1)
    radices = codes >> (2 * ID_BITS)
    runs = []
    cuts = [0, *(np.flatnonzero(np.diff(radices)) + 1).tolist(), len(codes)]
    for s, e in zip(cuts, cuts[1:], strict=False):
        if s < e:
            pairs, documents = np.unique(codes[s:e] & ((1 << 2 * ID_BITS) - 1), return_counts=True)
            runs.append({"radix": int(radices[s]), "head": packed(pairs, documents), "body": body(places[s:e], times[s:e])})
    return runs


def fitting(sizes: np.ndarray, most: int) -> int:
    """How many of the first texts have ``most`` bytes together; one at least."""
    return max(1, int(np.searchsorted(np.cumsum(sizes), most, side="right")))


def chunk_of(both: Aligner, texts: pa.Array, sizes: np.ndarray) -> dict:
    """A chunk's columns; its texts are aligned a piece at a time."""
    parts, start = [], 0
    while start < len(texts):
        n = fitting(sizes[start:], PIECE_BYTES)
        counts, links, owners, digests = both.texts(texts.slice(start, n))
        parts.append((counts, links << PLACE_BITS | (owners + start), digests))
        start += n
    counts, records, digests = zip(*parts, strict=True)
    columns = dict(zip(_COUNTS, np.concatenate(counts, axis=1), strict=True))
    return columns | {"digests": list(chain.from_iterable(digests)), "runs": runs_of(np.concatenate(records))}


def chunks(docs: DataFrame, side_a: str = SIDE_A, side_b: str = SIDE_B) -> DataFrame:
    """One row for each chunk of documents: their ids, counts and digests, and the chunk's runs."""
    find_package(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    target = arrow_schema(docs.sparkSession, _CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).fill_null("")
            sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
            start = 0
            while start < len(ids):
                stop = start + fitting(sizes[start : start + CHUNK_DOCS], CHUNK_BYTES)
                row = {"chunk": task << 32 | number, "ids": ids.slice(start, stop - start)}
                row |= chunk_of(aligner(side_a, side_b), texts.slice(start, stop - start), sizes[start:stop])
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in target], schema=target)
                start, number = stop, number + 1
        aligner(side_a, side_b).clear()  # the worker goes on to other stages

    return narrow.mapInArrow(run, _CHUNKS)


def merge_heads(heads: list[bytes]) -> bytes:
    """One run of several, through a heap: the documents of a pair add up."""
    streams = [zip(*(x.tolist() for x in unpacked(head)), strict=True) for head in heads]
    pairs: list[int] = []
    documents: list[int] = []
    for pair, n in heapq.merge(*streams):
        if pairs and pairs[-1] == pair:
            documents[-1] += n
        else:
            pairs.append(pair)
            documents.append(n)
    return packed(np.array(pairs, np.int64), np.array(documents, np.int64))


def merged(cut: DataFrame) -> DataFrame:
    """(radix, head): the pairs of each radix with the number of documents that hold them linked."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        head = merge_heads(table.column("head").to_pylist())
        return pa.table({"radix": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "head": [head]})

    n = cut.count()
    level = cut.select("chunk", F.explode("runs").alias("run")).select("run.radix", "chunk", "run.head")
    parts = -(-n // FAN_IN) or 1
    level = level.select("radix", F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part"), "head")
    while True:
        level = stored(level.groupBy("radix", "part").applyInArrow(work, "radix int, part long, head binary"), "pair-runs")
        if parts == 1:
            return level.select("radix", "head")
        parts = -(-parts // FAN_IN)
        level = level.select("radix", F.pmod("part", F.lit(parts)).alias("part"), "head")


def with_best(head: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, documents, best): best where no other pair of the same A id has more documents."""
    pairs, documents = unpacked(head)
    side = pairs >> ID_BITS
    starts = np.flatnonzero(np.diff(side, prepend=-1))
    most = np.repeat(np.maximum.reduceat(documents, starts), np.diff(np.append(starts, len(side))))
    return pairs, documents, documents == most


def pair_counts(totals: DataFrame) -> DataFrame:
    """(a, b, documents, best) of each pair, from what ``merged`` returns."""
    schema = "a long, b long, documents long, best boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for radix, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pairs, documents, best = with_best(head)
                a = (pairs >> ID_BITS) << RADIX_BITS | radix
                yield pa.RecordBatch.from_pydict({"a": a, "b": pairs & ((1 << ID_BITS) - 1), "documents": documents, "best": best})

    return totals.select("radix", "head").mapInArrow(run, schema)


def sent_back(cut: DataFrame, totals: DataFrame) -> DataFrame:
    """(chunk, n_best, count_sum): what the records of one radix add to each document of a chunk."""
    size = F.expr("aggregate(runs, 0L, (n, r) -> n + length(r.head) + length(r.body))")
    groups = -(-(cut.agg(F.sum(size)).first()[0] or 0) // GROUP_BYTES) or 1
    group = F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("part")
    records = cut.select("chunk", group, F.explode("runs").alias("run")).select("run.radix", "part", "chunk", "run.head", "run.body")
    everywhere = totals.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"), "head")

    def work(runs: pa.Table, total: pa.Table) -> pa.Table:
        out: dict[str, list] = {"chunk": [], "n_best": [], "count_sum": []}
        if runs.num_rows:
            pairs, documents, best = with_best(total.column("head")[0].as_py())
            for i in range(runs.num_rows):
                own, n = unpacked(runs.column("head")[i].as_py())
                at = np.repeat(np.searchsorted(pairs, own), n)
                places, links = of_body(runs.column("body")[i].as_py())
                sums = np.zeros((2, int(places.max()) + 1), np.int64)
                np.add.at(sums[0], places, links * best[at])
                np.add.at(sums[1], places, links * documents[at])
                out["chunk"].append(runs.column("chunk")[i].as_py())
                out["n_best"].append(sums[0])
                out["count_sum"].append(sums[1])
        longs = pa.list_(pa.int64())
        return pa.table({"chunk": pa.array(out["chunk"], pa.int64())} | {c: pa.array(out[c], longs) for c in ("n_best", "count_sum")})

    met = records.groupBy("radix", "part").cogroup(everywhere.groupBy("radix", "part"))
    return met.applyInArrow(work, "chunk long, n_best array<long>, count_sum array<long>")


def align(docs: DataFrame, side_a: str = SIDE_A, side_b: str = SIDE_B) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``."""
    cut = stored(chunks(docs, side_a, side_b), "aligned-chunks")
    back = sent_back(cut, merged(cut))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
    target = arrow_schema(docs.sparkSession, schema)

    def work(own: pa.Table, sums: pa.Table) -> pa.Table:
        if not own.num_rows:
            return target.empty_table()
        columns = {"doc_id": own.column("ids")[0].values, "groups_sha256": own.column("digests")[0].values}
        columns |= {c: own.column(c)[0].values for c in _COUNTS}
        for c in ("n_best", "count_sum"):
            total = np.zeros(len(columns["doc_id"]), np.int64)
            for one in sums.column(c):
                part = np.asarray(one.values)
                total[: len(part)] += part
            columns[c] = pa.array(total)
        return pa.Table.from_arrays([columns[f.name].cast(f.type) for f in target], schema=target)

    rows = cut.select("chunk", "ids", *_COUNTS, "digests")
    return rows.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(work, schema)
