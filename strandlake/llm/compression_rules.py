"""Quality rules: word and line counts, and compression bands over whole documents and fixed chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from strandlake.llm.base import prepare, texts

LEVEL = 3
#: Bytes of a chunk; a last chunk of under a quarter of it is judged by the band of its own length, one that is too short
#: for a band together with the chunk before it.
CHUNK = 4096
#: Up to so many bytes: the least and most that the raw size may be times the compressed size. Shorter texts hold a
#: larger share of frame and tables, so both limits rise with the length; under the first length nothing is judged. The
#: least lies half way between random bytes in base 64 at the band's longer end and the lowest 0.5 % of the texts labelled
#: good at its shorter end (figures in the README).
SHORTEST = 128
WHOLE_BANDS = ((200, 1.08, 2.5), (300, 1.16, 2.8), (400, 1.24, 3.0), (600, 1.29, 3.2), (1000, 1.38, 3.5), (1500, 1.48, 4.0),
               (2000, 1.55, 4.2), (3000, 1.6, 4.5), (4096, 1.65, 4.5), (8192, 1.7, 4.8), (16384, 1.75, 5.0), (1 << 62, 1.75, 6.0))
CHUNK_BAND = (1.65, 4.5)
#: The part of judged chunks that may be out of their band.
BAD_CHUNKS = 0.25
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of five words found twice or more, the first find included."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) > n - 1:
        return 0
    key = ids
    for k in range(1, window):  # windows of k + 1 words, numbered densely so that the pair fits in 64 bits
        _, key = np.unique(key[: n - k] * len(number) + ids[k:], return_inverse=True)
    counts = np.bincount(key)
    hit = np.flatnonzero(counts[key] > 1)
    if not len(hit):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.encode().strip()]
    return len(lines) - len(set(lines))


def _band(n: int) -> tuple[float, float]:
    return next((a, b) for most, a, b in WHOLE_BANDS if n <= most)


def verdict(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float | None, float | None, bool]:
    """(ratio of the whole, part of chunks out of band, accepted)."""
    n = len(data)
    if n < SHORTEST:
        return None, None, True
    ratio = n / len(compressor.compress(data))
    low, high = _band(n)
    judged = bad = 0
    if n > CHUNK:
        starts = list(range(0, n, CHUNK))
        if n - starts[-1] < SHORTEST:
            starts.pop()
        for k, end in zip(starts, [*starts[1:], n]):
            chunk = data[k:end]
            least, most = CHUNK_BAND if 4 * len(chunk) >= CHUNK else _band(len(chunk))
            judged += 1
            bad += not least <= len(chunk) / len(compressor.compress(chunk)) <= most
    part = bad / judged if judged else None
    return ratio, part, low <= ratio <= high and (part is None or part <= BAD_CHUNKS)


def quality(docs: DataFrame) -> DataFrame:
    """Every row as (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio,
    bad_chunks).

    Null texts have no words. ``kept`` is false where the base rule fails, else the verdict of the compression bands: the
    whole text's ratio must lie in the band of its length, and at most a quarter of its chunks outside theirs. Texts under
    128 bytes are too short for a ratio and pass. One pass, nothing is shuffled; repeated rows are judged alike, other
    columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            out: list = [[] for _ in range(9)]
            for text in b.column(1).to_pylist():
                data = text.encode()
                words = data.split()
                n = len(words)
                repeats = repeated_words(words)
                failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
                ratio, bad, fine = verdict(data, compressor)
                blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
                row = (n, len(text) - blanks, len(_SYMBOLS.findall(text)), duplicate_lines(text), repeats, failed,
                       not failed and fine, ratio, bad)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, out, kinds)], names=names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "ratio", "bad_chunks"]
    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, kept boolean, ratio double, bad_chunks double")
    return texts(docs).mapInArrow(run, schema)
