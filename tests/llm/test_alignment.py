"""Two tokenizers aligned: against plain loops over the libraries' own encodings."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from barlake.llm import alignment
from barlake.llm.queries import REGISTRY
from tests.llm.conftest import ODD_TEXTS

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spelt(text):
    """[(id, start, end)] in bytes of both sides, or None where a side does not spell space + text."""
    global _TOKENIZERS
    if "_TOKENIZERS" not in globals():
        a = Tokenizer.from_file(public_tokenizers.path(alignment.SIDE_A))
        a.encode_special_tokens = True
        b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.SIDE_B))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [x for x in range(256) if x not in printable]
        _TOKENIZERS = a, b, {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(others)}
    a, b, byte = _TOKENIZERS
    if not text:
        return None
    side_a = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    name = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    side_b = [(i, name(i)) for i in b.encode(text)]
    out = []
    for side in (side_a, side_b):
        if b"".join(x for _, x in side) != (" " + text).encode():
            return None
        at, places = 0, []
        for i, x in side:
            places.append((i, at, at + len(x)))
            at += len(x)
        out.append(places)
    return out


def brute(docs):
    rows, held, all_links = [], Counter(), []
    for doc_id, text in docs:
        found = spelt(text)
        links, groups = [], []
        if found:
            a, b = found
            links = [(i, j) for i, s, e in a for j, p, q in b if s < q and p < e]
            cuts = sorted({e for *_, e in a} & {e for *_, e in b})
            groups = [([i for i, s, e in a if lo <= s < hi], [j for j, s, e in b if lo <= s < hi]) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        held.update(set(links))
        all_links.append(links)
        a, b = found or ([], [])
        rows.append([doc_id, len(a), len(b), len(groups), len(links), hashlib.sha256(written.encode()).hexdigest() if found else ""])
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    best = [sum(held[x] == most[x[0]] for x in links) for links in all_links]
    sums = [sum(held[x] for x in links) for links in all_links]
    return sorted((-1 if r[0] is None else r[0], *r[1:5], n, s, r[5]) for r, n, s in zip(rows, best, sums, strict=True)), held


def got(df):
    assert df.columns == COLUMNS
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


TEXTS = [
    "Plain words, that stand alone.\nAnother line, don't you think?", "  two  spaces ", "tab\tinside", "line end\n", "\nline start",
    "a\n b", "nbsp here", "wide　space x", "▁ written out", "a ▁b", "</s> <unk> <|endoftext|> <0x41>", "é漢🙂 naïve 漢字",
    "12345 678,90 -- !!", "x" * 300, "\x00 zero \x1f", "the the the the", "The the THE", "é combining", "line\r\nend", "  sep",
]


def test_texts_against_loops(spark, docs_of):
    texts = [t for t in ODD_TEXTS if len(t or "") < 1000] + TEXTS
    want, held = brute(list(enumerate(texts)))
    assert got(alignment.align(docs_of(texts))) == want
    cut = alignment.stored(alignment.chunks(docs_of(texts)), "test-chunks")
    pairs = alignment.pair_counts(alignment.merged(cut)).collect()
    assert {(r["a"], r["b"]): r["documents"] for r in pairs} == dict(held)
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    assert all(r["best"] == (r["documents"] == most[r["a"]]) for r in pairs)


def test_query_over_documents(spark, small_sf, documents):
    rows = got(REGISTRY["op13_token_alignment"](spark, small_sf))
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 3000]
    held = Counter()
    for _, t in docs:
        found = spelt(t)
        if found:
            a, b = found
            at = {}
            for j, p, q in b:
                at.update(dict.fromkeys(range(p, q), j))
            held.update({(i, at[x]) for i, s, e in a for x in range(s, e)})
    want, _ = brute(short)
    by_id = {r[0]: r for r in rows}
    assert len(rows) == len(docs)
    assert [by_id[w[0]][:5] + by_id[w[0]][7:] for w in want] == [w[:5] + w[7:] for w in want]
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    for i, t in short[:60]:
        a, b = spelt(t)
        links = [(x, y) for x, s, e in a for y, p, q in b if s < q and p < e]
        assert by_id[i][6] == sum(held[x] for x in links)
        assert by_id[i][5] == sum(held[x] == most[x[0]] for x in links)


@pytest.mark.parametrize("memo", [0, 400_000])
def test_many_small_chunks_levels_and_groups(spark, docs_of, monkeypatch, memo):
    """Several merge levels and groups of chunks, a word in every document, ids null and repeated."""
    alignment.aligner.cache_clear()
    for name, value in {"CHUNK_DOCS": 2, "FAN_IN": 2, "GROUP_BYTES": 2000, "MEMO_UNITS": memo}.items():
        monkeypatch.setattr(alignment, name, value)
    docs = [(i % 7 or None, f"the same word w{i % 5} and some {i} more" if i % 3 else "copied text of many") for i in range(60)] + [(3, None), (None, "")]
    want, _ = brute(docs)
    rows = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert got(alignment.align(rows)) == want


def test_empty_table(spark, docs_of):
    assert got(alignment.align(docs_of([]))) == []
    assert got(alignment.align(docs_of([None, ""]))) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]


def test_very_long_text(spark, docs_of):
    """Counts only: the text stands for itself, so every link's pair is in one document."""
    text = "word " * 30_000 + "x" * 20_000
    (row,) = alignment.align(docs_of([text])).collect()
    a, b = spelt(text)
    assert (row["n_a"], row["n_b"]) == (len(a), len(b)) and row["n_best"] == row["count_sum"] == row["n_links"]
    assert row["n_groups"] <= row["n_links"]


def test_memo_keeps_what_is_used_most(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(alignment, "MEMO_UNITS", 4)
    small = alignment.Aligner(alignment.SIDE_A, alignment.SIDE_B)
    whole = alignment.aligner(alignment.SIDE_A, alignment.SIDE_B)
    batches = [["often often b c", "often d e\nf"], ["often g h often", "i j k often"], [" odd  text ", "often b c", "ab▁c"]]
    for batch in batches:
        for left, right in zip(small.texts(pa.array(batch)), whole.texts(pa.array(batch)), strict=True):
            assert list(map(str, left)) == list(map(str, right))
    assert "often" in small.place and len(small.place) < 9
