"""Exact token counts of every prefix of a text, by dynamic programming over a BPE vocabulary.

An encoding is the right one exactly if every two neighbours in it encode to themselves. So the
encoding of a prefix is that of a shorter prefix plus one last piece, and only one last piece fits:
``count[i] = count[i - len(piece)] + 1``. A prefix is answered without encoding anything again.

Pieces never hold a space behind another character, so texts fall apart into units (spaces and the
word behind them) and counts add up; the counts of a unit are kept in a bounded memo.

Null text counts as empty; empty text has 0 tokens. Repeated rows give repeated results, an empty
table an empty one. Very long units are worked through in linear time and not kept.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import public_tokenizers
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.scratch import over_texts

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
MEMO_UNITS = 400_000
MEMO_LENGTH = 40
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PrefixCounter:
    """Token counts of prefixes for a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
        self.score = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.get_piece_size())
            if not any(kind(i) for kind in special)
        }
        self.ending = ahocorasick.Automaton()
        for piece in self.score:
            self.ending.add_word(piece, piece)
        self.ending.make_automaton()
        if any(SPACE in piece.lstrip(SPACE) for piece in self.score):
            raise ValueError("pieces that span words are not supported")
        met = {piece[i : i + 2] for piece in self.score for i in range(len(piece) - 1)}
        after_letters = {pair[1] for pair in met if pair[0].isalpha()}
        # Marks that no piece has behind a letter: units fall apart in front of them.
        marks = "".join(c for c in ".,;:!?|\n" if c not in after_letters)
        self.cut = re.compile(f"(?<=[^\\W\\d_])(?=[{re.escape(marks)}])") if marks else None
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def merged(self, text: str) -> list[str]:
        """Encode a short text by merging the best-scored neighbours, leftmost first."""
        pieces, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(pieces) - 1):
                s = score.get(pieces[i] + pieces[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return pieces
            pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= 2 * MEMO_UNITS:
                self.pairs.clear()
            known = self.pairs[pair] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def prefix_counts(self, unit: str) -> list[int]:
        """Tokens of ``unit[:i]`` for every i; spaces are written as in the vocabulary."""
        counts, last, pairs = [0], [""], self.pairs
        for end, piece in self.ending.iter(unit):  # all pieces that end at a place, place by place
            if end < len(counts) - 1:
                continue  # the last piece there is known
            while len(counts) <= end:
                # A character without a piece becomes its bytes and merges with nothing.
                unknown = unit[len(counts) - 1]
                counts.append(counts[-1] + len(unknown.encode()))
                last.append(unknown)
            start = end + 1 - len(piece)
            fitting = pairs.get((last[start], piece))
            if self.fits(last[start], piece) if fitting is None else fitting:
                counts.append(counts[start] + 1)
                last.append(piece)
        for unknown in unit[len(counts) - 1 :]:
            counts.append(counts[-1] + len(unknown.encode()))
        return counts

    def unit_count(self, unit: str) -> int:
        total = 0
        for part in self.cut.split(unit) if self.cut else (unit,):
            n = self.parts.get(part)
            if n is None:
                n = self.prefix_counts(part)[-1]
                if len(part) <= MEMO_LENGTH:
                    if len(self.parts) >= MEMO_UNITS:
                        self.parts.clear()
                    self.parts[part] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        known = self.units
        if SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            units = [u[1:] if u[1:2] != SPACE else u for u in _UNITS.findall(SPACE + text.replace(" ", SPACE))]
        else:
            units = text.split(" ")
        counts = list(map(known.get, units))
        if None in counts:
            for i, n in enumerate(counts):
                if n is None:
                    unit = units[i]
                    n = known.get(unit)
                    if n is None:
                        n = self.unit_count(unit if unit[:1] == SPACE else SPACE + unit)
                        if len(unit) <= MEMO_LENGTH:
                            if len(known) >= MEMO_UNITS:
                                known.clear()
                            known[unit] = n
                    counts[i] = n
        return sum(counts)

    def every_prefix(self, text: str) -> list[int]:
        """Tokens of ``text[:p]`` for p = 0 .. len(text)."""
        out, before = [0], 0
        if text:
            for unit in _UNITS.findall(SPACE + text.replace(" ", SPACE)):
                counts = self.prefix_counts(unit)
                out += [before + n for n in counts[1:]]
                before += counts[-1]
            del out[1]  # the space that the library puts in front is no prefix of the text
        return out


@lru_cache(maxsize=2)
def counter(model: str) -> PrefixCounter:
    return PrefixCounter(public_tokenizers.path(model))


def token_counts(docs: DataFrame, limit: int = 4096, model: str = MODEL) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): the count of the longest prefix, the whole text."""

    def work(ids: list, texts: list[str]) -> dict:
        count = counter(model).count
        return {"doc_id": ids, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": [count(t) for t in texts]}

    counted = over_texts(docs, work, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def prefix_table(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, counts): ``counts[p]`` tokens in the first p characters, for every p."""

    def work(ids: list, texts: list[str]) -> dict:
        return {"doc_id": ids, "counts": [counter(model).every_prefix(t) for t in texts]}

    return over_texts(docs, work, "doc_id long, counts array<int>", rows=32)


def longest_prefix(counts: Column, budget: int | Column) -> Column:
    """Characters of the longest prefix within ``budget`` tokens (counts need not rise steadily)."""
    fitting = F.transform(counts, lambda n, p: F.when(n <= budget, p))
    return F.array_max(fitting)
