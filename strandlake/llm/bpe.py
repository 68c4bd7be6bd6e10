"""BPE encoding and decoding: greedy proposals, checks of adjacent pairs, exact merging of the words that fail."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandlake.llm import vocabulary
from strandlake.llm.base import prepare, texts
from strandlake.llm.pretokens import Encoder


class SpeculativeBpe:
    """Ids of words.

    A greedy longest match proposes tokens. A row of tokens is what the merges give for its bytes exactly if each pair
    of neighbours is what the merges give for the pair's bytes (tokens give themselves). All pairs of a batch of words
    are looked up in a sorted table at once; pairs not met before are decided by merging their few bytes. Words with a
    pair that fails are merged exactly.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = vocabulary.read(path)
        vocabulary.check_kind(spec)
        self.special = vocabulary.special_ids(spec)
        ids = {vocabulary.to_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.ids = ids
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * self.size
        for t, i in ids.items():
            self.bytes_of[i] = t
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (vocabulary.to_bytes(x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self.ranks.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.longest = max(map(len, ids))
        #: A token that the merges do not give for its own bytes is never proposed.
        self.greedy = {t: i for t, i in ids.items() if len(t) == 1 or self.merged(t) == [i]}
        self.pairs = np.zeros(0, np.int64)
        self.fits = np.zeros(0, bool)
        self.library = Tokenizer.from_file(path).pre_tokenizer

    def split(self, text: str) -> list[str]:
        return [text[i:j] for _, (i, j) in self.library.pre_tokenize_str(text)]

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: the pair of lowest rank first, leftmost first."""
        ids = self.ids
        row = [ids[word[i:i + 1]] for i in range(len(word))]
        ranks = self.ranks
        if len(row) > 64:
            return self._merged_long(row)
        while len(row) > 1:
            best, at = None, -1
            for i in range(len(row) - 1):
                r = ranks.get((row[i], row[i + 1]))
                if r is not None and (best is None or r[0] < best[0]):
                    best, at = r, i
            if best is None:
                break
            row[at: at + 2] = [best[1]]
        return row

    def _merged_long(self, row: list[int]) -> list[int]:
        """The same with a heap, for long words."""
        import heapq

        ranks, n = self.ranks, len(row)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and (r := ranks.get((row[i], row[j]))) is not None:
                heapq.heappush(heap, (r[0], i, row[i], row[j], r[1]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if live[i] else n
            if not live[i] or j >= n or row[i] != a or row[j] != b:
                continue
            row[i], live[j] = new, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return [t for t, x in zip(row, live) if x]

    def propose(self, word: bytes) -> list[int]:
        get, row, i, n = self.greedy.get, [], 0, len(word)
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                t = get(word[i:j])
                if t is not None:
                    row.append(t)
                    i = j
                    break
        return row

    def _compatible(self, codes: np.ndarray) -> np.ndarray:
        """For each pair code: whether merging the pair's bytes gives the pair."""
        asked, inverse = np.unique(codes, return_inverse=True)
        place = np.searchsorted(self.pairs, asked)
        known = place < len(self.pairs)
        known[known] = self.pairs[place[known]] == asked[known]
        new = asked[~known]
        if len(new):
            if len(self.pairs) > 1_000_000:
                self.pairs, self.fits = np.zeros(0, np.int64), np.zeros(0, bool)
                return self._compatible(codes)
            names = self.bytes_of
            good = [self.merged(names[c // self.size] + names[c % self.size]) == [c // self.size, c % self.size]
                    for c in new.tolist()]
            spot = np.searchsorted(self.pairs, new)
            self.pairs = np.insert(self.pairs, spot, new)
            self.fits = np.insert(self.fits, spot, good)
            place = np.searchsorted(self.pairs, asked)
        return self.fits[place][inverse]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        rows = [self.propose(w) for w in words]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.fromiter((t for r in rows for t in r), np.int64, int(counts.sum()))
        if len(flat) < 2:
            return rows
        owner = np.repeat(np.arange(len(rows)), counts)
        inside = owner[1:] == owner[:-1]
        codes = (flat[:-1] * self.size + flat[1:])[inside]
        bad = owner[1:][inside][~self._compatible(codes)] if len(codes) else np.zeros(0, np.int64)
        for i in np.unique(bad).tolist():
            rows[i] = self.merged(words[i])
        return rows

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of the tokens in a row as UTF-8; what is not valid becomes the replacement sign."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_made: dict[str, tuple[SpeculativeBpe, Encoder]] = {}


def coder(path: str) -> tuple[SpeculativeBpe, Encoder]:
    """The tokenizer of this worker, read once."""
    if path not in _made:
        bpe = SpeculativeBpe(path)
        _made[path] = (bpe, Encoder(bpe.encode_words, bpe.special, bpe.split))
    return _made[path]


def encode_decode(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every row as (doc_id, n_tokens, ids_sha256, decoded_sha256), with ``ids`` (array of int) if asked.

    Null texts are empty: no ids. Special strings inside a text are their own ids, as the library takes them. Repeated
    rows give equal results; other columns are ignored. One pass over the texts, nothing is shuffled.
    """
    prepare(docs.sparkSession)
    path = path or vocabulary.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = coder(path)
        for b in batches:
            out: list = [[], [], [], []]
            for ids in encoder.encode(b.column(1).to_pylist()):
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                out[2].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                if with_ids:
                    out[3].append(ids)
            columns = [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(out[3], pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<int>" if with_ids else ""
    return texts(docs).mapInArrow(run, f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
