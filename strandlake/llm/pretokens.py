"""Words of a byte-level BPE tokenizer found with array operations, and a bounded memory of their ids.

The split rule is the tokenizer's pattern: contractions, an optional blank with letters, with digits or with other
signs, blanks before a word, other blanks. Classes come from the Unicode tables of this Python; a text with a character
that these tables do not know is split by the library, whose tables may be newer.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable

import numpy as np

OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
#: Words whose ids a worker remembers, and their bytes.
REMEMBERED, REMEMBERED_BYTES = 1_500_000, 1 << 26
#: Characters split at once.
PIECE = 1 << 17
_CUT = re.compile(r"(?<=\w) (?=\w)")
_B = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _classes() -> np.ndarray:
    spaces = {9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    table = np.empty(sys.maxunicode + 1, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for cp in range(sys.maxunicode + 1):
        c = unicodedata.category(chr(cp))
        table[cp] = SPACE if cp in spaces else UNSURE if c == "Cn" else kinds.get(c[0], OTHER)
    return table


class Splitter:
    """Splits texts into words; its tables are made once in a worker."""

    _table = None
    _powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))

    def __init__(self):
        if Splitter._table is None:
            Splitter._table = _classes()
        self.values = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def unsure(self, text: str) -> bool:
        return not text.isascii() and bool((self._table[np.frombuffer(text.encode("utf-32-le"), np.uint32)] == UNSURE).any())

    def starts(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Where words begin, for the code points of texts that begin at ``firsts``."""
        n = len(points)
        kind = self._table[points]
        begin = np.zeros(n + 1, bool)
        begin[firsts] = True
        begin[n] = True
        space = kind == SPACE
        start = np.empty(n, bool)
        start[0] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        # the last blank before a word stands alone, or belongs to the word if it is 0x20
        before = np.zeros(n, bool)
        before[:-1] = space[:-1] & ~space[1:] & ~begin[1:n]
        at = np.flatnonzero(before)
        start[at] = True
        start[at + 1] = points[at] != 32
        start |= begin[:n]
        quotes = np.flatnonzero(start & (points == 39))
        if len(quotes):
            padded = np.concatenate([points, np.zeros(3, points.dtype)])
            after = np.concatenate([begin, np.ones(3, bool)])
            one, two = padded[quotes + 1], padded[quotes + 2]
            short = np.isin(one, [ord(c) for c in "stmd"]) & ~after[quotes + 1]
            long = np.zeros(len(quotes), bool)
            for a, b in ("re", "ve", "ll"):
                long |= (one == ord(a)) & (two == ord(b))
            long &= ~after[quotes + 1] & ~after[quotes + 2]
            for hit, size in ((quotes[short], 2), (quotes[long], 3)):
                for k in range(1, size):
                    start[hit + k] = False
                ends = hit + size
                start[ends[ends < n]] = True
        return start

    def split(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all texts, byte starts of words with the end appended, hashes of words, words of each text)."""
        joined = "".join(texts)
        data = joined.encode()
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return b"", np.zeros(1, np.int64), np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
        firsts = (ends - lengths)[lengths > 0]
        at = np.flatnonzero(self.starts(points, firsts))
        per_text = np.searchsorted(at, ends) - np.searchsorted(at, ends - lengths)
        if len(data) != len(points):
            size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            at = (np.cumsum(size) - size)[at]
        at = np.append(at, len(data))
        return data, at, self.hashes(np.frombuffer(data, np.uint8), at), per_text

    def hashes(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """64-bit hashes of the spans between ``at``: differences of running sums of values times powers."""
        up, down = self.powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * up[: len(data)], out=sums[1:])
        h = (sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]]
        h ^= np.diff(at).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ (h >> np.uint64(29))

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers[0]) < n:
            size = max(n, 1 << 20)
            inverse = pow(_B, -1, 1 << 64)
            made = []
            for base in (_B, inverse):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                made.append(np.cumprod(p, dtype=np.uint64))
            cls._powers = tuple(made)
        return cls._powers


class WordIds:
    """Ids of words in sorted arrays of their hashes; emptied when it holds too many words or bytes.

    A hash only says where to look: a word has the ids found there if its bytes are those that were put there. Words that
    differ from the one with their hash are kept by their bytes.
    """

    def __init__(self, encode: Callable[[list[bytes]], list]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.word_at = np.zeros(0, np.int64)
        self.word_size = np.zeros(0, np.int64)
        self.words = np.zeros(1 << 16, np.uint8)
        self.words_used = 0
        self.odd: dict[bytes, tuple[int, int]] = {}

    def _put_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.encode(words)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for ids in found for x in ids), np.int32, int(counts.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used: self.used + len(flat)] = flat
        begin = self.used + np.cumsum(counts) - counts
        self.used += len(flat)
        return begin, counts

    def look_up(self, data: bytes, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, count) in ``ids`` of each word."""
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new) and len(self.keys) and (len(self.keys) + len(new) > REMEMBERED or self.words_used + len(data) > REMEMBERED_BYTES):
            self.clear()
            return self.look_up(data, at, hashes)
        sizes = np.diff(at)
        symbols = np.frombuffer(data, np.uint8)
        if len(new):
            words = [data[i:j] for i, j in zip(at[first[new]].tolist(), at[first[new] + 1].tolist())]
            begin, counts = self._put_ids(words)
            joined = np.frombuffer(b"".join(words), np.uint8)
            while self.words_used + len(joined) > len(self.words):
                self.words = np.concatenate([self.words, np.zeros_like(self.words)])
            self.words[self.words_used: self.words_used + len(joined)] = joined
            size = sizes[first[new]]
            spot = place[new]
            self.keys = np.insert(self.keys, spot, distinct[new])
            self.begin = np.insert(self.begin, spot, begin)
            self.count = np.insert(self.count, spot, counts)
            self.word_at = np.insert(self.word_at, spot, self.words_used + np.cumsum(size) - size)
            self.word_size = np.insert(self.word_size, spot, size)
            self.words_used += len(joined)
            place = np.searchsorted(self.keys, distinct)
        begin, count = self.begin[place][inverse], self.count[place][inverse]
        for i in self._others(symbols, at, sizes, first, inverse, place).tolist():
            word = data[at[i]:at[i + 1]]
            if word not in self.odd:
                b, c = self._put_ids([word])
                self.odd[word] = int(b[0]), int(c[0])
            begin[i], count[i] = self.odd[word]
        return begin, count

    def _others(self, symbols, at, sizes, first, inverse, place) -> np.ndarray:
        """Words whose bytes are not those remembered for their hash: each is compared with the first of its hash here,
        and those with the remembered ones."""
        rep = first[inverse]
        bad = _differ(symbols, at[:-1], sizes, symbols, at[rep], sizes[rep])
        firsts = _differ(symbols, at[first], sizes[first], self.words, self.word_at[place], self.word_size[place])
        if not bad.any() and not firsts.any():
            return np.zeros(0, np.int64)
        # where a hash has met another word, all of its words are compared with the remembered one
        mixed = np.zeros(len(first), bool)
        mixed[inverse[bad]] = True
        mixed |= firsts
        some = np.flatnonzero(mixed[inverse])
        spot = place[inverse[some]]
        return some[_differ(symbols, at[some], sizes[some], self.words, self.word_at[spot], self.word_size[spot])]


def _differ(a: np.ndarray, a_at: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_at: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Which byte strings of ``a`` are not those of ``b``, pair by pair."""
    out = a_size != b_size
    use = np.flatnonzero(~out & ((a_at != b_at) | (a is not b)))
    size = a_size[use]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return out
    inside = np.arange(total) - np.repeat(ends - size, size)
    wrong = np.flatnonzero(a[np.repeat(a_at[use], size) + inside] != b[np.repeat(b_at[use], size) + inside])
    out[use[np.searchsorted(ends, wrong, side="right")]] = True
    return out


class Encoder:
    """Whole texts to ids: words by arrays, ids from memory, only new words through ``encode_words``."""

    def __init__(self, encode_words: Callable[[list[bytes]], list], special: dict[str, int],
                 library_split: Callable[[str], list[str]]):
        self.splitter = Splitter()
        self.memory = WordIds(encode_words)
        self.special = special
        self.marks = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.library_split = library_split

    def _ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids of each text)."""
        data, at, hashes, per_text = self.splitter.split(texts)
        return self._gather(data, at, hashes, per_text)

    def _gather(self, data, at, hashes, per_text):
        begin, count = self.memory.look_up(data, at, hashes)
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat(begin - (ends - count), count)
        upto = np.concatenate([[0], ends])[np.cumsum(per_text)] if len(ends) else np.zeros(len(per_text), np.int64)
        return self.memory.ids[where], np.diff(upto, prepend=0)

    def _plain(self, text: str) -> list[np.ndarray]:
        """Ids of a text without special strings, in parts cut where a word begins anyway."""
        if self.splitter.unsure(text):
            words = [w.encode() for w in self.library_split(text)]
            at = np.cumsum([0, *map(len, words)])
            data = b"".join(words)
            return [self._gather(data, at, self.splitter.hashes(np.frombuffer(data, np.uint8), at), np.array([len(words)]))[0]]
        out, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + PIECE) if len(text) - start > 2 * PIECE else None
            end = cut.start() if cut else len(text)
            out.append(self._ids_of([text[start:end]])[0])
            start = end
        return out

    def _alone(self, text: str) -> np.ndarray:
        parts, start = [], 0
        for m in self.marks.finditer(text) if self.marks else ():
            parts += self._plain(text[start: m.start()]) if m.start() > start else []
            parts.append(np.array([self.special[m[0]]], np.int32))
            start = m.end()
        parts += self._plain(text[start:]) if start < len(text) else []
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def encode(self, texts: list[str]):
        """Yields the ids of each text, in order."""
        held, size = [], 0
        for text in texts:
            odd = len(text) > PIECE or (self.marks and self.marks.search(text)) or self.splitter.unsure(text)
            if odd or size >= PIECE:
                yield from self._together(held)
                held, size = [], 0
            if odd:
                yield self._alone(text)
            else:
                held.append(text)
                size += len(text)
        yield from self._together(held)

    def _together(self, texts: list[str]):
        if texts:
            ids, counts = self._ids_of(texts)
            yield from np.split(ids, np.cumsum(counts)[:-1])
