"""Ids of public subword tokenizers for whole texts, with each distinct word encoded once per task.

The word tokenizer used here drops white space and never joins across it, so
the ids of a text are those of its white-space-separated words in turn.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from eventmart.llm.textbytes import Words, text_bytes

#: Words a task remembers; rarer ones are encoded again when they come back.
MEMORY = 400_000

#: Words that the tokenizer's own rules split as PIECES does: unaccented and accented Latin letters, digits, ASCII marks.
_PLAIN = re.compile("[!-&(-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


@lru_cache(maxsize=2)
def _loaded(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    shown = {c: level.pre_tokenize_str(c)[0][0] for c in map(chr, (*range(33, 127), *range(0xC0, 0x100)))}
    return tokenizer, str.maketrans(shown), {}


def encode_word(word: str, path: str) -> list[int]:
    """Ids of one word without white space."""
    tokenizer, shown, _ = _loaded(path)
    if "<|" in word or not _PLAIN.fullmatch(word):
        return tokenizer.encode(word, add_special_tokens=False).ids
    tokenize = tokenizer.model.tokenize
    return [t.id for piece in _PIECES.findall(word.lower()) for t in tokenize(piece.translate(shown))]


class WordTable:
    """Ids of up to ``most`` words by the words' hashes, in arrays: 20 bytes a word and 4 for each id."""

    def __init__(self, path: str, most: int = 1 << 20):
        self.path, self.most, self.used = path, most, 0
        self.hashes, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)

    def look_up(self, words: Words, kinds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids, and where each word's begin and how many it has. ``kinds``: different hashes in order, ``at``: a word of each."""
        place = np.searchsorted(self.hashes, kinds)
        begin, length = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        known = np.zeros(len(kinds), bool)
        if len(self.hashes):
            near = np.minimum(place, len(self.hashes) - 1)
            known = self.hashes[near] == kinds
            begin[known], length[known] = self.begin[near[known]], self.length[near[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw = words.data.tobytes()
            found = [encode_word(raw[a:b].decode(), self.path) for a, b in zip(words.start[at[new]].tolist(), words.end[at[new]].tolist())]
            length[new] = np.fromiter(map(len, found), np.int64, len(found))
            upto = self.used + np.cumsum(length[new])
            begin[new] = upto - length[new]
            if upto[-1] > len(self.ids):
                self.ids = np.append(self.ids, np.zeros(int(upto[-1]), np.uint32))
            self.ids[self.used : upto[-1]] = np.fromiter(chain.from_iterable(found), np.uint32, int(upto[-1]) - self.used)
            if len(self.hashes) + len(new) <= self.most:
                self.hashes = np.insert(self.hashes, place[new], kinds[new])
                self.begin = np.insert(self.begin, place[new], begin[new])
                self.length = np.insert(self.length, place[new], length[new])
                self.used = int(upto[-1])
        return self.ids, begin, length


@lru_cache(maxsize=2)
def word_table(path: str) -> WordTable:
    """The one of this worker."""
    return WordTable(path)


def _remembered(words: Words, at: np.ndarray, path: str) -> tuple[np.ndarray, ...]:
    """Ids of the words ``at``, and where each word's begin and how many it has."""
    raw, memory, ids = words.data.tobytes(), _loaded(path)[2], []
    for start, end in zip(words.start[at].tolist(), words.end[at].tolist()):
        word = raw[start:end]
        known = memory.get(word)
        if known is None:
            known = np.array(encode_word(word.decode(), path), np.uint32).tobytes()
            if len(memory) < MEMORY:
                memory[word] = known
        ids.append(known)
    length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    return np.frombuffer(b"".join(ids), np.uint32), np.cumsum(length) - length, length


def encode_texts(column: pa.Array, path: str, end_id: int | None = None, table: WordTable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts end to end (uint32), and how many each has; ``end_id`` is appended to each text."""
    words = Words(*text_bytes(column))
    return encode_words(words, words.hashes(), path, end_id, table)[:2]


def encode_words(words: Words, hashes: np.ndarray, path: str, end_id: int | None = None, table: WordTable | None = None) -> tuple[np.ndarray, ...]:
    """As ``encode_texts``, of words and their hashes; also how many ids each word has. ``table``: remembers words instead of the memory."""
    kinds, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    flat, begin, length = table.look_up(words, kinds, at) if table else _remembered(words, at, path)
    size = length[which]
    total = np.concatenate(([0], np.cumsum(size)))
    n = np.diff(total[words.first])
    tail = end_id is not None
    # where each word's ids go: behind those of the words before it and the ends of the texts before it
    to = total[:-1] + (words.text_of() if tail else 0)
    out = np.zeros(int(total[-1]) + tail * len(n), np.uint32)
    step = np.arange(int(total[-1])) - np.repeat(total[:-1], size)
    out[np.repeat(to, size) + step] = flat[np.repeat(begin[which], size) + step]
    if tail:
        n = n + 1
        out[np.cumsum(n) - 1] = end_id
    return out, n, size
