"""Token counts, token files and packing, against the tokenizer libraries."""

import io
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barlake.llm import packing, simple8b, token_counts, token_ids
from barlake.llm.simple8b import encoded_and_read
from tests.llm.conftest import ODD_TEXTS

PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
BYTES = Tokenizer.from_file(public_tokenizers.path(token_ids.BYTE_BPE))
TEXTS = st.one_of(
    st.text(max_size=40),
    st.text(alphabet="ab the\n\t .,'é漢🙂▁<s>/0129　 xyzQ-_", max_size=60),
    st.lists(st.text(alphabet="abé.,'0s!?%", min_size=1, max_size=6), max_size=12).map(" ".join),
)


def ids_of(text):
    return BYTES.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_prefix_counts_are_the_librarys(text):
    own = token_counts.counter(token_counts.MODEL)
    want = [len(PIECES.encode(text[:p])) for p in range(len(text) + 1)]
    assert own.every_prefix(text) == want
    assert own.count(text) == want[-1]


def test_memo_is_bounded_and_exact(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_UNITS", 5)
    own = token_counts.PrefixCounter(public_tokenizers.path(token_counts.MODEL))
    for text in ["alpha beta, gamma. delta!", "one two three four five six seven", "alpha two x y z"] * 3:
        assert own.count(text) == len(PIECES.encode(text))
    assert len(own.units) <= 5 and len(own.parts) <= 5


def test_counts_of_odd_texts(spark, docs_of):
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs_of(ODD_TEXTS)).collect()}
    for i, text in enumerate(ODD_TEXTS):
        n = len(PIECES.encode(text or ""))
        assert (got[i]["n_tokens"], got[i]["n_bytes"]) == (n, len((text or "").encode()))
        assert got[i]["over_limit"] == (n > 4096)
    assert token_counts.token_counts(docs_of([])).count() == 0
    assert token_counts.token_counts(docs_of([(None, "a b"), (None, "a b")])).count() == 2


def test_longest_prefix_answers_budgets(spark, docs_of):
    texts = ["hello there, general", "", "transformation of words", None]
    table = token_counts.prefix_table(docs_of(texts))
    for budget in (0, 1, 3, 100):
        rows = table.select("doc_id", token_counts.longest_prefix(table["counts"], budget).alias("p")).collect()
        for r in rows:
            text = texts[r["doc_id"]] or ""
            assert r["p"] == max(p for p in range(len(text) + 1) if len(PIECES.encode(text[:p])) <= budget)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_word_ids_are_the_librarys(texts):
    ids, sizes = token_ids.encoder().encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [ids_of(t) for t in texts] or not texts


def test_word_memo_forgets_rare_words():
    own = token_ids.WordEncoder(token_ids.BYTE_BPE, memo_words=6)
    for text in ["a b c d e f g h", "a b x y z", "a b <|endoftext|> c", "k l m n o p a b"] * 2:
        ids, _ = own.encode(pa.array([text]))
        assert ids.tolist() == ids_of(text)
    assert len(own.place) <= 14


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.one_of(st.integers(0, 1), st.integers(0, 50_256), st.integers(0, 2**64 - 1), st.integers(2**60 - 1, 2**61)),
        max_size=600,
    )
)
def test_blocks_round_trip(values):
    values = np.array(values, np.uint64)
    words, offsets = simple8b.encode_blocks(values)
    assert (simple8b.decode_blocks(words, offsets, len(values)) == values).all()


def test_blocks_decode_alone():
    values = np.random.default_rng(0).integers(0, 50_000, 3 * simple8b.BLOCK + 17).astype(np.uint64)
    words, offsets = simple8b.encode_blocks(values)
    assert len(offsets) == 5 and len(words) < len(values) / 2
    a, b = int(offsets[2]), int(offsets[3])
    own = simple8b.decode_blocks(words[a:b], np.array([0, b - a], np.uint64), simple8b.BLOCK)
    assert (own == values[2 * simple8b.BLOCK : 3 * simple8b.BLOCK]).all()


def test_file_is_checked():
    with pytest.raises(ValueError):
        list(simple8b.read_chunks(io.BytesIO(b"something else")))
    whole = simple8b.MAGIC + simple8b.chunk_bytes([1, None], np.array([2, 1]), np.array([5, 6, 7], np.uint32))
    assert [(d, s.tolist(), i.tolist()) for d, s, i in simple8b.read_chunks(io.BytesIO(whole))] == [([1, None], [2, 1], [5, 6, 7])]
    with pytest.raises(ValueError):
        list(simple8b.read_chunks(io.BytesIO(whole[:-4])))


@pytest.mark.parametrize("odd", [True, False])
def test_files_hold_all_ids_in_order(spark, docs_of, documents, odd):
    docs = docs_of(ODD_TEXTS).repartition(5) if odd else documents.repartition(7)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    start = 0
    rows = sorted(encoded_and_read(docs).collect())
    assert [r["doc_id"] for r in rows] == sorted(texts)
    for r in rows:
        want = [*ids_of(texts[r["doc_id"]]), simple8b.END_ID]
        assert (r["start"], r["n_tokens"]) == (start, len(want))
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        start += len(want)


def test_files_of_repeated_and_null_ids(spark, docs_of):
    rows = encoded_and_read(docs_of([(None, "n"), (3, "b"), (3, "a"), (3, "a"), (1, None)])).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [
        (False, 0, 2), (True, 1, 1), (True, 3, 2), (True, 3, 2), (True, 3, 2),
    ]
    assert encoded_and_read(docs_of([])).count() == 0


def check_packing(docs, pieces):
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    own, windows = defaultdict(list), defaultdict(list)
    for r in pieces:
        own[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(own) == set(texts)
    for doc_id, parts in own.items():
        want, at = np.array([*ids_of(texts[doc_id]), packing.END_ID], "<u4"), 0
        for r in sorted(parts, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want))
            assert r["ids"] == want[at : at + r["length"]].tobytes()
            at += r["length"]
        assert at == len(want)
    free = []
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= packing.SIZE
        free.append(packing.SIZE - at)
    # All but one window lack fewer than LEAST_CUT ids.
    assert sorted(free, reverse=True)[1:2] < [packing.LEAST_CUT]


def test_packing_covers_each_id_once(spark, documents):
    docs = documents.repartition(9)
    check_packing(docs, packing.pack(docs).collect())


def test_packing_of_odd_texts(spark, docs_of, monkeypatch):
    docs = docs_of(ODD_TEXTS)
    check_packing(docs, packing.pack(docs).collect())
    assert packing.pack(docs_of([])).count() == 0
    assert packing.pack(docs_of([(None, "a"), (1, "b"), (1, "b")])).count() == 3


def test_leftovers_merge_in_rounds(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 2)
    docs = docs_of([f"text number {i} " * (5 + i % 40) for i in range(60)]).repartition(12)
    check_packing(docs, packing.pack(docs).collect())


def test_few_open_windows(monkeypatch):
    monkeypatch.setattr(packing, "OPEN", 2)
    packer = packing.Packer(0)
    for i in range(200):
        packer.add(i, np.arange(1 + (i * 37) % 900, dtype=np.uint32))
        assert len(packer.open) <= 2
    full = packer.done
    assert all(w.free < packing.LEAST_CUT for w in full)
    left = packing.poured([w for _, _, w in packer.open])
    total = sum(len(p[2]) for w in [*full, *left] for p in w.pieces)
    assert total == sum(1 + (i * 37) % 900 for i in range(200))
    assert sum(w.free > 0 for w in left) <= 1


def test_sequences_are_padded(spark, docs_of):
    pieces = packing.pack(docs_of([f"some words {i}" for i in range(5)]))
    (row,) = packing.sequences(pieces).collect()
    ids = np.frombuffer(row["ids"], "<u4")
    assert len(ids) in (row["n_tokens"], packing.SIZE)
    assert zlib.crc32(ids[row["n_tokens"] :].tobytes()) == zlib.crc32(bytes(4 * (len(ids) - row["n_tokens"])))
