"""Removal of repeated substrings by bucket-pointer refinement over anchored suffixes.

Every suffix of every text could start a repeat of ``LENGTH`` bytes. Neighbouring starts mostly share their fate, so
suffixes are taken in gaps: the anchor of a start is the smallest hashed gram of ``GRAM`` bytes in its ``LENGTH`` bytes,
which equal strings have at the same offset, and a gap is a run of starts with one anchor.

1. Initial buckets: a gap's bucket is the gram at its anchor. A gap alone in its bucket is done: nothing that starts in
   it starts elsewhere.
2. Refinement by the bucket of later offsets: a gap's bucket is replaced by that of all bytes from its first start to
   the end of the string at its last. Where two or more share it, each start of the gap begins a repeat.
3. Refinement at nearer offsets: the starts of an undecided gap are split by their distance from the anchor into steps
   of ``STEP``. All strings of a step share the bytes around the anchor but for a step's length; a step alone in the
   bucket of those bytes is done.
4. Refinement at offset one: what is left is split into single starts, with buckets of exactly ``LENGTH`` bytes. Decided
   gaps lend the buckets of their steps and starts.

Buckets are named by hashes of their bytes, not by numbers in sorted order, so no task numbers them all. Buckets that
decide what goes (2 and 4) are named by 128-bit XXH3. A decided bucket is used for every gap that points to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.base import Intermediate, prepare, stored, text_key, texts
from strandlake.llm.bitfilter import BitFilter

#: Bytes of a repeat, of an initial bucket, and places in which one anchor is chosen.
LENGTH, GRAM = 400, 100
#: Starts of one step of an undecided gap.
STEP = 64
_B = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Bytes of a text that are hashed at once.
PIECE = 1 << 20


class Spans:
    """Cheap hashes of the byte strings of one text: differences of running sums of values times powers.

    They choose anchors and buckets, where an equal hash of different bytes only costs work. What is removed is decided by
    ``strong`` hashes of the bytes.
    """

    _tables: dict = {}

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.lanes = []
        for seed in (1, 2):
            values, up, self_down = self._table(seed, self.n + 1)
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values[data] * up[: self.n], out=sums[1:])
            self.lanes.append((sums, self_down))

    @classmethod
    def _table(cls, seed: int, n: int):
        made = cls._tables.get(seed)
        if made is None or len(made[1]) < n:
            size = max(n, 1 << 17)
            base = (_B * (2 * seed + 1)) & _MASK | 1
            values = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            powers = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                powers.append(np.cumprod(p, dtype=np.uint64))
            made = cls._tables[seed] = (values, *powers)
        return made

    def of(self, start: np.ndarray, end: np.ndarray, lane: int) -> np.ndarray:
        sums, down = self.lanes[lane]
        h = (sums[end] - sums[start]) * down[start]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def strong(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """XXH3 of 128 bits of byte strings, as two columns."""
    view = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(view[i:j]) for i, j in zip(start.tolist(), end.tolist())])
    return tuple(np.ascontiguousarray(np.frombuffer(raw, "<i8").reshape(-1, 2).T))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value in each window of ``width``."""
    best, size = values, 1
    while size < width:
        step = min(size, width - size)
        best = np.minimum(best[: len(best) - step], best[step:])
        size += step
    return best


def gaps(data: np.ndarray, length: int = LENGTH, gram: int = GRAM, with_steps: bool = True) -> tuple:
    """Of a text of at least ``length`` bytes: (first start, last start, gram bucket, steps or None).

    ``steps`` are (gap, first start, last start, bucket) of the steps of all gaps.

    The anchor of a start is the rightmost smallest gram hash in its window, so it moves on when a gram that is not larger
    enters at the right or when it leaves at the left.
    """
    spans = Spans(data)
    width, count = length - gram + 1, spans.n - gram + 1
    at = np.arange(count)
    order = spans.of(at, at + gram, 0)
    least = sliding_min(order, width)
    enters = order[width - 1:] == least
    begins = enters.copy()
    begins[0] = True
    begins[1:] |= least[1:] > least[:-1]
    first = np.flatnonzero(begins)
    last = np.append(first[1:] - 1, len(least) - 1)
    anchor = first + width - 1
    inside = np.flatnonzero(~enters[first])
    for k in range(0, len(inside), 1024):
        some = inside[k:k + 1024]
        windows = order[first[some][:, None] + np.arange(width)[::-1]]
        anchor[some] = first[some] + width - 1 - windows.argmin(axis=1)
    bucket = spans.of(anchor, anchor + gram, 1).view(np.int64)
    if not with_steps:
        return first, last, bucket, None
    stride = min(STEP, width)
    low, high = (anchor - last) // stride, (anchor - first) // stride
    count = high - low + 1
    gap = np.repeat(np.arange(len(first)), count)
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - low, count)
    at = anchor[gap]
    begin = at - step * stride  # the last start of the step, and so the first byte that its strings share
    key = spans.of(begin, begin - stride + 1 + length, 0) ^ (spans.of(at, at + gram, 1) * np.uint64(3)) ^ (
        step.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    steps = (gap, np.maximum(first[gap], begin - stride + 1), np.minimum(last[gap], begin), key.view(np.int64))
    return first, last, bucket, steps


def pieces(n: int, length: int, piece: int = PIECE) -> Iterator[tuple[int, int]]:
    """Byte ranges of a text whose starts, together, are all starts; a gap may be cut, its starts are not."""
    for begin in range(0, max(0, n - length + 1), piece):
        yield begin, min(n, begin + piece + length - 1)


def merged_ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges (sorted by first) with those that touch or overlap joined."""
    reach = np.maximum.accumulate(last)
    new = np.concatenate([[True], first[1:] > reach[:-1] + 1])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)
    return first[new], reach[ends]


def _bytes_of(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    for value in batch.column(column):
        yield np.frombuffer(value.as_buffer(), np.uint8) if len(value.as_buffer()) else np.zeros(0, np.uint8)


GAP_NAMES = ["t1", "t2", "first", "last", "bucket", "g1", "g2", "weight"]
_GAP_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
_STEP_KIND = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("bucket", pa.int64())])
_GAP_SCHEMA = ("t1 long, t2 long, first long, last long, bucket long, g1 long, g2 long, weight int, "
               "steps array<struct<first: long, last: long, bucket: long>>")
_START_NAMES = ["t1", "t2", "start", "g1", "g2", "open"]
_START_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]


def _table(columns: list, kinds: list, names: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)], names=names)


def _bucket_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, piece: int) -> Iterator[pa.RecordBatch]:
    """(bucket, weight) of the gaps of each text; weight 2 where a text has a bucket more than once."""
    for b in batches:
        out: list = [[], []]
        for data in _bytes_of(b, 0):
            for begin, end in pieces(len(data), length, piece):
                bucket, times = np.unique(gaps(data[begin:end], length, gram, with_steps=False)[2], return_counts=True)
                out[0].append(bucket)
                out[1].append(np.minimum(times, 2))
        if out[0]:
            yield _table(out, [pa.int64(), pa.int32()], ["bucket", "weight"])


def _gap_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, piece: int,
              keep: BitFilter) -> Iterator[pa.RecordBatch]:
    """Gaps of the texts whose buckets may be shared. Of equal gaps in one text one stays, with weight 2; the others' ranges, joined where they touch,
    are decided and have weight 0. So a text of one repeated word gives a few rows."""
    for b in batches:
        out: list = [[] for _ in GAP_NAMES]
        sizes, inside = [], [[], [], []]
        for data, t1, t2 in zip(_bytes_of(b, 0), b.column(1).to_pylist(), b.column(2).to_pylist()):
            for begin, end in pieces(len(data), length, piece):
                first, last, bucket, steps = gaps(data[begin:end], length, gram)
                count = np.bincount(steps[0], minlength=len(first))
                starts = np.cumsum(count) - count
                use = keep.may_hold(bucket)
                first, last, bucket, count, starts = (v[use] for v in (first, last, bucket, count, starts))
                g1, g2 = strong(data[begin:end], first, last + length)
                _, one, which, times = np.unique(g1, return_index=True, return_inverse=True, return_counts=True)
                if (g2 != g2[one][which]).any():
                    _, one, times = np.unique(np.stack([g1, g2]), axis=1, return_index=True, return_counts=True)
                more = np.ones(len(g1), bool)
                more[one] = False
                parts = [(first[one] + begin, last[one] + begin, bucket[one], g1[one], g2[one], np.minimum(times, 2))]
                count, starts = count[one], starts[one]
                where = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - starts, count)
                sizes.append(count)
                for c, v in zip(inside, (steps[1] + begin, steps[2] + begin, steps[3])):
                    c.append(v[where])
                if more.any():
                    lo, hi = merged_ranges(first[more] + begin, last[more] + begin)
                    none = np.zeros(len(lo), np.int64)
                    parts.append((lo, hi, none, none, none, none))
                    sizes.append(none)
                for part in parts:
                    n = len(part[0])
                    for c, v in zip(out, (np.full(n, t1), np.full(n, t2), *part)):
                        c.append(v)
        if out[0]:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in inside], fields=list(_STEP_KIND))
            rows = _table(out, _GAP_KINDS, GAP_NAMES)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(pa.array(offsets), values)],
                                             names=[*GAP_NAMES, "steps"])


def _start_rows(batches: Iterator[pa.RecordBatch], length: int, piece: int) -> Iterator[pa.RecordBatch]:
    """The single starts of the given gaps of each text."""
    for b in batches:
        out: list = [[] for _ in _START_NAMES]
        for data, t1, t2, asked in zip(_bytes_of(b, 0), *(b.column(i).to_pylist() for i in (1, 2, 3))):
            lo, hi = (np.array([g[k] for g in asked], np.int64) for k in ("first", "last"))
            is_open = np.array([g["open"] for g in asked], bool)
            for begin, end in pieces(len(data), length, piece):
                some = np.flatnonzero((lo >= begin) & (lo < begin + piece))
                if len(some):
                    at = np.concatenate([np.arange(lo[i], hi[i] + 1) for i in some.tolist()]) - begin
                    marks = np.repeat(is_open[some], hi[some] - lo[some] + 1)
                    values = (np.full(len(at), t1), np.full(len(at), t2), at + begin,
                              *strong(data[begin:end], at, at + length), marks)
                    for c, v in zip(out, values):
                        c.append(v)
                    if sum(map(len, out[0])) > PIECE:
                        yield _table(out, _START_KINDS, _START_NAMES)
                        out = [[] for _ in _START_NAMES]
        if out[0]:
            yield _table(out, _START_KINDS, _START_NAMES)


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """(t1, t2, first, last): ranges of starts of strings of ``length`` bytes that also start elsewhere, by text.

    ``docs`` has text, t1 and t2 (the text's key). Rows with equal texts repeat each other wholly.
    """
    source = docs.select("text", "t1", "t2")
    # 1. initial buckets: only their sizes are shuffled
    every = source.select("text").mapInArrow(lambda it: _bucket_rows(it, length, gram, piece), "bucket long, weight int")
    shared = stored(every.groupBy("bucket").agg(F.sum("weight").alias("n")).where("n > 1").select("bucket"), "suffix-buckets")
    keep = BitFilter.of(shared, "bucket")  # lets gaps alone in their bucket through at worst; they stay alone below
    live = stored(source.mapInArrow(lambda it: _gap_rows(it, length, gram, piece, keep), _GAP_SCHEMA), "suffix-gaps")
    # 2. buckets of whole gaps
    sizes = live.where("weight > 0").groupBy("g1", "g2").agg(
        F.sum("weight").alias("n"), F.min(F.struct("t1", "t2", "steps")).alias("place"))
    sizes = stored(sizes, "suffix-refined")
    sure = sizes.where("n > 1")
    twice = stored(sure.select("g1", "g2"), "suffix-decided")
    ranges = live.where("weight = 0").select("t1", "t2", "first", "last").unionByName(
        live.where("weight > 0").join(twice, ["g1", "g2"], "left_semi").select("t1", "t2", "first", "last")).distinct()
    # 3. steps of undecided gaps, and of one gap of each decided bucket
    steps = sizes.select("place.t1", "place.t2", (F.col("n") == 1).alias("open"), F.inline("place.steps"))
    met = stored(steps.groupBy("bucket").agg(F.count("*").alias("n"), F.max("open").alias("open"))
                 .where("n > 1 and open").select("bucket"), "suffix-steps")
    asked = stored(steps.join(met, "bucket", "left_semi").groupBy("t1", "t2").agg(
        F.collect_list(F.struct("first", "last", "open")).alias("asked")), "suffix-asked")
    # 4. single starts
    wanted = BitFilter.of(asked, "t1")

    def some_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            use = wanted.may_hold(b.column(1).to_numpy())
            if use.any():
                yield b.filter(pa.array(use))

    # a place is one text's; rows with equal texts lend it once
    few = source.mapInArrow(some_texts, "text string, t1 long, t2 long").join(asked, ["t1", "t2"])
    starts = few.select("text", "t1", "t2", "asked").mapInArrow(
        lambda it: _start_rows(it, length, piece), "t1 long, t2 long, start long, g1 long, g2 long, open boolean")
    starts = stored(starts, "suffix-starts")
    found = stored(starts.groupBy("g1", "g2").agg(F.count("*").alias("n"), F.max("open").alias("open"))
                   .where("n > 1 and open").select("g1", "g2"), "suffix-single")
    ones = starts.where("open").join(found, ["g1", "g2"], "left_semi").select(
        "t1", "t2", F.col("start").alias("first"), F.col("start").alias("last"))
    return ranges.unionByName(ones)


def kept_bytes(data: bytes, ranges: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs) when the strings that start in ``ranges`` go."""
    if not ranges:
        return data, 0, 0
    lo, hi = np.array(sorted(ranges), np.int64).T
    first, last = merged_ranges(lo, hi + length - 1)
    last = last + 1
    at = np.concatenate([[0], last])
    to = np.concatenate([first, [len(data)]])
    return b"".join(data[i:j] for i, j in zip(at.tolist(), to.tolist())), int((last - first).sum()), len(first)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False,
                   piece: int = PIECE) -> DataFrame:
    """Every row as (doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, untouched), with ``kept`` (binary) if asked.
    ``n_kept`` are the bytes left, ``untouched`` says that nothing was removed.

    Each byte of a text that lies in a string of ``length`` bytes which also starts elsewhere, in this row or another, is
    removed. Null texts are empty. Rows are told by their texts, so a repeated row or text is removed wholly if it has
    ``length`` bytes. ``kept`` may cut a character. Other columns are ignored; an empty table gives an empty table.
    """
    prepare(docs.sparkSession)
    source = texts(docs).withColumns(dict(zip(("t1", "t2"), text_key(F.col("text")))))
    with Intermediate(docs.sparkSession) as tables:
        ranges = stored(repeated_starts(source, length, gram, piece).groupBy("t1", "t2").agg(
            F.collect_list(F.struct("first", "last")).alias("gone")), "suffix-ranges")
        tables.keep(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = [[] for _ in range(7)]
            for text, gone in zip(b.column(1), b.column(2).to_pylist()):
                data = text.as_py().encode()
                kept, removed, spans = kept_bytes(data, [(g["first"], g["last"]) for g in gone or ()], length)
                for c, v in zip(out, (len(data), removed, spans, hashlib.sha256(kept).hexdigest(), len(kept), not removed, kept)):
                    c.append(v)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.bool_(), pa.binary()]
            columns = [b.column(0), *map(pa.array, out, kinds)][: len(names)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "untouched"] + ["kept"] * with_text
    schema = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, untouched boolean"
              + ", kept binary" * with_text)
    return source.join(ranges, ["t1", "t2"], "left").select("doc_id", "text", "gone").mapInArrow(run, schema)
