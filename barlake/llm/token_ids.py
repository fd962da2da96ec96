"""Token ids of whole texts by a byte-level BPE tokenizer, with a bounded memo of words.

The pre-tokenizer of byte-level BPE never joins a space with the character before it, so a text
whose white space stands alone falls apart into words that are encoded independently. Known words
are looked up; new ones go through the tokenizers library, as do whole texts of any other shape
(runs of white space, special strings). The ids are those of encoding each text whole.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
MEMO_WORDS = 500_000
_SPACE = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
RUNS = rf"\A{_SPACE}|{_SPACE}{_SPACE}|{_SPACE}\z"
_MARKS = ".,;:!?%*&$#|"


class WordEncoder:
    """Encode batches of texts into one flat array of ids and the texts' lengths."""

    def __init__(self, name: str, memo_words: int = MEMO_WORDS):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.newline = self.whole(["a\nb"])[0][1:2]
        self.memo_words = memo_words
        # Byte-level BPE writes a byte that is no printable character as one from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shifted = iter(range(256, 512))
        self.written = [chr(b) if b in printable else chr(next(shifted)) for b in range(256)]
        self.place: dict[str, int] = {}
        self.flat = np.empty(0, np.uint32)
        self.size = np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, word: str) -> list[int]:
        """Ids of one word: behind a space, or at the start of a line if it begins with a newline."""
        text, before = (word[1:], self.newline) if word[0] == "\n" else (" " + word, [])
        core = text.rstrip(_MARKS)
        letters = core[1:] if core[:1] == " " else core
        if letters.isalpha() and max(letters) < "ɐ":  # Latin letters are letters to every library
            marks = text[len(core) :]
            ids = [t.id for t in self.model.tokenize("".join([self.written[b] for b in core.encode()]))]
            return before + ids + ([t.id for t in self.model.tokenize(marks)] if marks else [])
        return before + self.whole([text])[0]

    def forget(self) -> None:
        """Keep the half of the memo that was used most, and let older uses fade."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.memo_words // 2])
        names = list(self.place)
        self.place = {names[i]: at for at, i in enumerate(kept.tolist())}
        self.flat = self.gather(kept)
        self.size, self.uses = self.size[kept], self.uses[kept] // 2

    def gather(self, places: np.ndarray) -> np.ndarray:
        starts, sizes = (np.cumsum(self.size) - self.size)[places], self.size[places]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]

    def places(self, words: list[str]) -> np.ndarray:
        """Where the ids of these different words are; unknown ones are encoded and added."""
        get, n = self.place.get, len(self.place)
        found = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            ids = [self.word(w) for w in new]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
            self.flat, self.size = np.concatenate([self.flat, flat]), np.concatenate([self.size, sizes])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            found[missing] = np.arange(n, n + len(new))
            self.place.update(zip(new, range(n, n + len(new)), strict=True))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        if len(self.place) > self.memo_words:
            self.forget()
        odd = pc.or_(pc.equal(texts, ""), pc.match_substring_regex(texts, RUNS))
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        # A newline in front makes first words like those of the other lines.
        plain = pc.binary_join_element_wise("\n", pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n"), "")
        split = pc.split_pattern(plain, " ")
        coded = split.flatten().dictionary_encode()
        places = self.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = np.asarray(coded.indices)
        self.uses[places] += np.bincount(at, minlength=len(places))
        places = places[at]
        ids = self.gather(places)
        ends = np.concatenate([[0], np.cumsum(self.size[places])])[np.asarray(split.offsets) - split.offsets[0].as_py()]
        first = np.ones(len(ids), bool)
        first[ends[:-1]] = False  # the newline put in front has one id, which is no part of the text
        ids, sizes = ids[first], np.diff(ends) - 1
        if not pc.any(odd).as_py():
            return ids, sizes
        own = iter(np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        others = iter(self.whole(texts.filter(odd).to_pylist()))
        each = [np.asarray(next(others), np.uint32) if o else next(own) for o in odd.to_pylist()]
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)


@lru_cache(maxsize=2)
def encoder(name: str = BYTE_BPE) -> WordEncoder:
    return WordEncoder(name)
