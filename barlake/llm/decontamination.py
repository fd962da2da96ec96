"""Benchmark decontamination: rare n-grams seed passages, Smith-Waterman alignment scores them.

Words are compared in lower case and without ASCII marks. A first pass over the corpus counts the
benchmark's word n-grams. Seeds are those that are rare there, and in every stretch of WINDOW
n-grams of an item the rarest, so an item that was copied thousands of times, or is made of common
words, has seeds as well. A second pass cuts out the passages around seeds; Spark joins them to the
items by seed. Each passage is aligned with each such item: a matching word scores 1, another word
or a gap costs PENALTY; the best local score over the item's length is the pair's score.

Items go in blocks of BLOCK_CHARS characters, each with its own two passes, so what tasks hold of the
benchmark is bounded. Null texts count as empty. Items of fewer than NGRAM words are no evidence and
match nothing; repeated item_ids are told apart by their text and give the best of their scores.
Repeated documents give one row. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import scratch
from barlake.llm.scratch import arrow_schema, find_package, over_texts, stored

NGRAM = 3
WINDOW = 3
RARE_SHARE = 1e-6
PENALTY = 0.5
LEAST_SCORE = 0.5
BLOCK_CHARS = 8_000_000
CELLS = 2_000_000
#: An odd number that spreads word numbers over 64 bits. Equal hashes of other n-grams only cost an alignment.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MARKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_MARKS).split()


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: word numbers from 1 on, and the items as such numbers."""

    vocabulary: dict[bytes, int]
    items: list[tuple[int | None, list[int]]]
    grams: np.ndarray

    @property
    def longest(self) -> int:
        return max((len(w) for _, w in self.items), default=0)

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """A hash of 63 bits for each NGRAM of word numbers; -1 where a word is not of the benchmark."""
        n = len(ids) - NGRAM + 1
        if n <= 0:
            return np.empty(0, np.int64)
        out, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(NGRAM):
            part = ids[k : k + n]
            out = (out ^ part.astype(np.uint64)) * FACTOR
            out ^= out >> np.uint64(32)
            known &= part > 0
        return np.where(known, (out >> np.uint64(1)).astype(np.int64), -1)


def build(rows: list[tuple[int | None, str]]) -> Items:
    split = sorted({(i, tuple(words_of(t or ""))) for i, t in rows}, key=repr)
    split = [(i, w) for i, w in split if len(w) >= NGRAM]
    vocabulary = {w: n for n, w in enumerate(sorted({w for _, ws in split for w in ws}), start=1)}
    items = [(i, [vocabulary[w] for w in ws]) for i, ws in split]
    bare = Items(vocabulary, items, np.empty(0, np.int64))
    grams = np.unique(np.concatenate([bare.keys(np.array(w)) for _, w in items])) if items else bare.grams
    return Items(vocabulary, items, grams)


def numbered(items: Items, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all texts in a row, where each text ends); other words are 0."""
    every: list[bytes] = []
    ends = []
    for text in texts:
        every += words_of(text)
        ends.append(len(every))
    return np.fromiter(map(items.vocabulary.get, every, repeat(0)), np.int64, len(every)), np.array(ends, np.int64)


def found_grams(items: Items, ids: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the wanted n-grams; none reaches over the end of a text."""
    keys = items.keys(ids)
    if not len(keys) or not len(wanted):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.flatnonzero(keys >= 0)
    at = np.minimum(np.searchsorted(wanted, keys[places]), len(wanted) - 1)
    places = places[wanted[at] == keys[places]]
    text = np.searchsorted(ends, places, side="right")
    places = places[places + NGRAM <= ends[text]]
    return places, keys[places]


def gram_counts(docs: DataFrame, items: Items) -> tuple[dict[int, int], int]:
    """(occurrences of each n-gram of the items in all documents, number of words)."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def work(ids: list, texts: list[str]) -> dict:
        numbers, ends = numbered(shared.value, texts)
        keys, n = np.unique(found_grams(shared.value, numbers, ends, shared.value.grams)[1], return_counts=True)
        return {"gram": np.append(keys, -1), "n": np.append(n, len(numbers))}

    counted = over_texts(docs, work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    found = {r["gram"]: r["n"] for r in counted.collect()}  # no more than the items have n-grams
    return found, found.pop(-1, 0)


def choose_seeds(items: Items, counts: dict[int, int], n_words: int) -> list[tuple[int, int]]:
    """(n-gram, number of the item), for rare n-grams and the rarest of each stretch."""
    rare, seeds = RARE_SHARE * n_words, set()
    for number, (_, words) in enumerate(items.items):
        keys = items.keys(np.array(words)).tolist()
        n = [counts.get(k, 0) for k in keys]
        chosen = {i for i, c in enumerate(n) if c <= rare}
        for at in range(max(1, len(keys) - WINDOW + 1)):
            chosen.add(min(range(at, min(at + WINDOW, len(keys))), key=lambda i: (n[i], i)))
        seeds |= {(keys[i], number) for i in chosen}
    return sorted(seeds)


def passages(docs: DataFrame, items: Items, seeds: list[tuple[int, int]]) -> DataFrame:
    """(doc_id, start, words, seeds): stretches around seeds, with all that an item could align to."""
    wanted = np.unique(np.array([k for k, _ in seeds], np.int64))
    shared = docs.sparkSession.sparkContext.broadcast((items, wanted))
    # A local alignment that scores enough has fewer gaps than this.
    reach = int(items.longest * (1 + (1 - LEAST_SCORE) / PENALTY)) + 1

    def work(ids: list, texts: list[str]) -> dict:
        own, keys_wanted = shared.value
        numbers, ends = numbered(own, texts)
        places, keys = found_grams(own, numbers, ends, keys_wanted)
        text = np.searchsorted(ends, places, side="right")
        out: dict[str, list] = {"doc_id": [], "start": [], "words": [], "seeds": []}
        if not len(places):
            return out
        first = np.flatnonzero(np.concatenate([[True], (np.diff(places) > 2 * reach) | (np.diff(text) > 0)]))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(places)], strict=True):
            begin = ends[text[a] - 1] if text[a] else 0
            low, high = max(begin, places[a] - reach), min(ends[text[a]], places[b - 1] + NGRAM + reach)
            out["doc_id"].append(ids[text[a]])
            out["start"].append(int(low - begin))
            out["words"].append(numbers[low:high].astype(np.int32))
            out["seeds"].append(np.unique(keys[a:b]))
        return out

    return over_texts(docs, work, "doc_id long, start long, words array<int>, seeds array<long>")


def aligned(words: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair, and the place behind the last word of the passage in it.

    Row by row of the alignment table, for all pairs at once. Gaps in the item come from a running
    maximum, as each word that is left out costs the same.
    """
    n, wide, long = len(words), max(map(len, words)), max(map(len, items))
    passage, item = np.full((n, wide), -1, np.int32), np.full((n, long), -2, np.int32)
    for i, (p, q) in enumerate(zip(words, items, strict=True)):
        passage[i, : len(p)], item[i, : len(q)] = p, q
    passage[passage == 0] = -1  # words that no item has
    ramp = (np.arange(wide + 1) * PENALTY).astype(np.float32)
    row, best, end = np.zeros((n, wide + 1), np.float32), np.zeros(n, np.float32), np.zeros(n, np.int64)
    for k in range(long):
        step = np.where(passage == item[:, k : k + 1], np.float32(1), np.float32(-PENALTY))
        new = np.maximum(row - np.float32(PENALTY), 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + step)
        row = np.maximum.accumulate(new + ramp, axis=1) - ramp
        at = row.argmax(axis=1)
        top = row[np.arange(n), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
    return best, end


def groups_of(words: list[np.ndarray]) -> Iterator[list[int]]:
    """Passages of like length, as many at a time as CELLS allows."""
    group: list[int] = []
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        if group and (len(group) + 1) * (len(words[i]) + 1) > CELLS:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


def align_pairs(pairs: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of the pairs that score LEAST_SCORE or more."""
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    find_package(pairs.sparkSession)
    target = arrow_schema(pairs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            doc_id, item_id, start = (columns[c].to_pylist() for c in ("doc_id", "item_id", "start"))
            words, items = (
                [np.asarray(v.values, np.int32) for v in columns[c]] for c in ("words", "item_words")
            )
            out: list[tuple] = []
            for group in groups_of(words):
                best, end = aligned([words[i] for i in group], [items[i] for i in group])
                share = best / np.array([len(items[i]) for i in group])
                good = np.flatnonzero(share >= LEAST_SCORE - 1e-6).tolist()
                if not good:
                    continue
                back, ends = [group[g] for g in good], end[good].tolist()
                tails = [words[i][:e][::-1] for i, e in zip(back, ends, strict=True)]
                _, length = aligned(tails, [items[i][::-1] for i in back])
                for g, i, e, n in zip(good, back, ends, length.tolist(), strict=True):
                    out.append((doc_id[i], item_id[i], float(share[g]), start[i] + e - n, start[i] + e - 1))
            columns_out = list(zip(*out, strict=True)) if out else [[] for _ in target]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns_out, target, strict=True)], schema=target
            )

    return pairs.mapInArrow(run, schema)


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of about BLOCK_CHARS characters; one is on the driver at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_CHARS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        found = (rows.where(part == k) if n > 1 else rows).collect()
        yield build([tuple(r) for r in found])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): documents that hold an item, or much of it."""
    spark, results = docs.sparkSession, []
    for items in blocks(benchmark):
        seeds = choose_seeds(items, *gram_counts(docs, items))
        cut = stored(passages(docs, items, seeds), "passages")
        # Two small tables, bounded by the block.
        by_seed = spark.createDataFrame(seeds, "seed long, number long")
        by_item = spark.createDataFrame(
            [(n, i, w) for n, (i, w) in enumerate(items.items)], "number long, item_id long, item_words array<int>"
        )
        met = (
            cut.withColumn("passage", F.monotonically_increasing_id())
            .select("passage", "doc_id", "start", "words", F.explode("seeds").alias("seed"))
            .join(F.broadcast(by_seed), "seed")
            .groupBy("passage", "number")
            .agg(*[F.first(c).alias(c) for c in ("doc_id", "start", "words")])
            .join(F.broadcast(by_item), "number")
        )
        # No alignment scores more than the item's words that the passage has.
        shared = F.size(F.filter("item_words", lambda w: F.array_contains(F.col("words"), w)))
        results.append(align_pairs(met.where(shared >= LEAST_SCORE * F.size("item_words"))))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    best = F.max(F.struct("score", "first_word", "last_word")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, each row judged by its own text."""
    whole, number = scratch.numbered(docs)
    found = leaks(whole.select(F.col(number).alias("doc_id"), "text"), benchmark)
    gone = stored(found.select(F.col("doc_id").alias(number)).distinct(), "leaked")
    return whole.join(gone, number, "left_anti").select(*docs.columns)
