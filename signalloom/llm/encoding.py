"""Token ids of the word-end BPE vocabulary, equal to the tokenizers library's.

A text made only of characters whose treatment is plain (see ``_PLAIN``) is
split at blanks and around runs of marks, which no token can span, and each word
looked up; a word that its worker does not remember goes through the library's
model.  Any other text goes through the library whole.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Characters on which the vocabulary's normaliser only lower-cases
# and joins blanks, its special marks, and its word pattern restricted to them.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_SPECIAL = "<|"
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
# A whole run of marks and apostrophes is one such part if it has a mark; of apostrophes alone, what follows decides.
_MARKS = r"('*[^\sa-z0-9ß-öø-ÿ'][^\sa-z0-9ß-öø-ÿ]*)"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=4)
def library(path: str):
    """The library's tokenizer, one per worker; truncation and padding off."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=1)
def _letters() -> dict[int, str]:
    """How the vocabulary writes the bytes of each plain character."""
    from tokenizers import pre_tokenizers

    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    plain = [c for c in map(chr, range(0x21, 0x100)) if _PLAIN.fullmatch(c)]
    return {ord(c): "".join(part for part, _ in spell.pre_tokenize_str(c)) for c in plain}


def is_plain(text: str) -> bool:
    """Whether the words of ``text`` can be encoded one by one; if not, only the library can treat it."""
    return _SPECIAL not in text and _PLAIN.fullmatch(text) is not None


def split_parts(text: str) -> list[str] | None:
    """The pieces of words that the vocabulary merges inside of; None if only the library can treat ``text``."""
    return _PARTS.findall(text.lower()) if is_plain(text) else None


def encode_words(words: list[str], path: str) -> list[list[int]]:
    """Ids of lower-cased words of plain characters, or of their pieces."""
    tokenize, letters, out = library(path).model.tokenize, _letters(), []
    for word in words:
        parts = (word,) if word.isalpha() else _PARTS.findall(word)
        out.append([t.id for p in parts for t in tokenize(p if p.isascii() else p.translate(letters))])
    return out


def pieces(path: str) -> list[str]:
    """The piece of each id; ids are 0 to the size of the vocabulary."""
    tokenizer = library(path)
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


class _Numbers(dict):
    """Word to number; a new word gets the next number and a place at the end of ``words``."""

    def __init__(self, words: Iterable[str] = ()):
        self.words = list(words)
        super().__init__(zip(self.words, range(len(self.words)), strict=True))

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number


class WordCache:
    """Encodes batches of texts; remembers the ids of about ``max_words`` words, of the most used ones longest.

    Words are what lies between blanks and runs of marks.  One of several parts
    has the ids of its parts, which are remembered as words are.
    """

    def __init__(self, path: str, max_words: int = 300_000, max_chars: int = 6 << 20):
        self.path, self.max_words, self.max_chars = path, max_words, max_chars
        self.numbers = _Numbers()
        self.chars = 0
        self.ids = np.empty(0, np.uint32)
        # by number of the word: where its ids start, how many there are, how often it was looked up
        self.first, self.lengths, self.uses = (np.empty(0, np.int64) for _ in range(3))

    def _forget(self) -> None:
        """Keeps the most used words, in half of the room; a word seen once goes."""
        words = self.numbers.words
        order = np.argsort(-self.uses, kind="stable")[: self.max_words // 2]
        order = order[self.uses[order] > 1]
        chars = np.cumsum([len(words[i]) for i in order], dtype=np.int64)
        kept = order[: np.searchsorted(chars, self.max_chars // 2, side="right")]
        self.chars = int(chars[len(kept) - 1]) if len(kept) else 0
        self.numbers = _Numbers(words[i] for i in kept)
        self.ids, self.lengths = self._ids_of(kept, np.ones(len(kept), np.int64))
        self.first, self.uses = np.cumsum(self.lengths) - self.lengths, self.uses[kept] // 2

    def _ids_of(self, which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words ``which`` in a row, and how many each run of ``counts`` words has."""
        first, lengths = self.first[which], self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.repeat(first - (ends - lengths), lengths) + np.arange(total)]
        return flat, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])])

    def _learn(self) -> None:
        known, words = len(self.first), self.numbers.words
        several = {}
        for k, word in enumerate(words[known:], known):
            if not word.isalpha() and len(parts := _PARTS.findall(word)) != 1:
                several[k] = [self.numbers[p] for p in parts]
        new = np.zeros(len(words) - known, np.int64)
        if not len(new):
            return
        self.first, self.lengths, self.uses = (np.append(a, new) for a in (self.first, self.lengths, self.uses))
        self.chars += sum(map(len, words[known:]))
        single = [k for k in range(known, len(words)) if k not in several]
        found = encode_words([words[k] for k in single], self.path)
        self._place(single, np.fromiter(itertools.chain.from_iterable(found), np.uint32), list(map(len, found)))
        which = np.fromiter(itertools.chain.from_iterable(several.values()), np.int64)
        self.uses += np.bincount(which, minlength=len(self.uses))
        self._place(list(several), *self._ids_of(which, np.array(list(map(len, several.values())), np.int64)))

    def _place(self, which: list[int], flat: np.ndarray, lengths: np.ndarray | list[int]) -> None:
        """Notes the ids of the new words ``which``."""
        which = np.array(which, np.int64)
        self.lengths[which] = lengths
        self.first[which] = len(self.ids) + np.cumsum(self.lengths[which]) - self.lengths[which]
        self.ids = np.concatenate([self.ids, flat])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row and the number of ids of each text."""
        if len(self.numbers) > self.max_words or self.chars > self.max_chars:
            self._forget()
        plain, odd = [], {}
        for k, text in enumerate(texts):
            if is_plain(text or ""):
                plain.append((text or "").lower())
            else:
                odd[k] = np.asarray(library(self.path).encode(text, add_special_tokens=False).ids, np.uint32)
                plain.append("")
        # each distinct word of the batch is looked up once; an empty one before a leading blank has no ids
        apart = pa.compute.replace_substring_regex(pa.array(plain, pa.string()), _MARKS, r" \1 ")
        words = pa.compute.ascii_split_whitespace(apart)
        counts = pa.compute.list_value_length(words).to_numpy()
        words = words.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False)
        which = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        self._learn()
        self.uses += np.bincount(which, minlength=len(self.uses))
        flat, sizes = self._ids_of(which, counts)
        if odd:
            parts = np.split(flat, np.cumsum(sizes)[:-1])
            for k, ids in odd.items():
                parts[k], sizes[k] = ids, len(ids)
            flat = np.concatenate(parts)
        return flat, sizes


@functools.lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    """One per worker."""
    return WordCache(path)


def with_end(flat: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts, each closed by ``end_id``."""
    return np.insert(flat, np.cumsum(sizes), np.uint32(end_id)), sizes + 1
