"""Fuzzy line deduplication: MinHash of character shingles, banding, exact Jaccard, union-find.

Lines that share a band are first compared with the band's first line only, which connects groups of copies; then, in
bands whose other lines are still of several components, all of these of different components are compared, each pair in
the first band that it shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strandlake.llm.base import Intermediate, batch_rows, fresh, prepare, stored, text_key, texts
from strandlake.llm.bitfilter import BitFilter
from strandlake.llm.blocks import distinct_buckets, in_blocks, links_within
from strandlake.llm.components import components

#: Characters of a shingle; a shorter line is one shingle.
WIDTH = 7
#: Jaccard similarity of shingle sets from which two lines are copies.
SIMILARITY = 0.8
#: 16 bands of 4 minima miss a pair at 0.8 with probability 2e-4, at 0.85 with 1e-5.
BANDS, ROWS = 16, 4
#: Minima that two lines must have in common to be compared; a pair at 0.8 has fewer with probability 1e-6.
LEAST_COMMON = 34
#: Band keys that are sorted at once before and after they are dealt to parts, and the fewest parts.
KEYS_AT_ONCE, KEYS_OF_PART, LEAST_PARTS = 1 << 20, 1 << 18, 512
#: Rows of an Arrow batch of numbers.
NUMBER_ROWS = 1 << 13
#: Lines of one part of a hot bucket.
BLOCK = 256
#: Lines compared with one first line in one task.
STAR = 4096
#: Characters whose shingle hashes are held at once.
PIECE = 1 << 15
#: Characters from which a line's shingles are compared share by share, and shingles of one share.
LONG, SHARE = 1 << 16, 1 << 18

_RANDOM = np.random.default_rng(20240607)
_A = (_RANDOM.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(line: str) -> str:
    """What is compared of a line: all of it but blanks at its ends. A line of blanks takes no part."""
    return line.strip(" \t\r\x0b\x0c")


def shingles(line: str, width: int = WIDTH) -> set[str]:
    return {line[i:i + width] for i in range(max(1, len(line) - width + 1))}


def _hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(32-bit hashes of the windows at every character of the lines in a row, begin and length of each line).

    A window is its characters shifted by 8 bits each and added up, which for Latin-1 is the window itself: those are read
    as they lie in memory. Windows that run past a line's end mean nothing; a shorter line is one window filled with zeros.
    """
    joined = "".join(lines)
    lengths = np.array([len(x) for x in lines], np.int64)
    begin = np.cumsum(lengths) - lengths
    try:
        data = np.frombuffer(joined.encode("latin-1") + bytes(8), np.uint8)
        value = np.ndarray((len(joined),), "<u8", data, strides=(1,)) & np.uint64((1 << 8 * WIDTH) - 1)
    except UnicodeEncodeError:
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
        value = points.copy()
        for k in range(1, min(WIDTH, len(points))):
            value[: len(points) - k] += points[k:] << np.uint64(8 * k)
    for i in np.flatnonzero(lengths < WIDTH).tolist():
        value[begin[i]] = sum(ord(c) << 8 * k for k, c in enumerate(lines[i])) & (1 << 64) - 1
    value *= _MIX
    value ^= value >> np.uint64(32)
    value *= _MIX
    value >>= np.uint64(32)
    return value.astype(np.uint32), begin, lengths


def _minima(lines: list[str]) -> np.ndarray:
    """Minima (BANDS * ROWS x lines) of the lines' shingles under as many permutations."""
    hashed, begin, lengths = _hashes(lines)
    for k in range(1, WIDTH):  # windows that run past a line's end become its first one again
        some = lengths > k
        hashed[(begin + lengths - k)[some]] = hashed[begin[some]]
    mixed = np.empty_like(hashed)
    out = np.empty((len(_A), len(lines)), np.uint32)
    for r, factor in enumerate(_A):
        np.multiply(hashed, factor, out=mixed)  # an odd factor permutes the well-mixed 32-bit hashes
        np.minimum.reduceat(mixed, begin, out=out[r])
    return out


def _signatures(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (lines x bands) and low bytes of all minima (lines x minima); a long line is signed in pieces.

    The band's number is in a key's upper four bits, such that keys of earlier bands are smaller.
    """
    parts = lines
    if max(map(len, lines)) >= PIECE:
        parts = [x[k:k + PIECE + WIDTH - 1] for x in lines for k in range(0, max(1, len(x) - WIDTH + 1), PIECE)]
        pieces = np.array([len(range(0, max(1, len(x) - WIDTH + 1), PIECE)) for x in lines])
    found, at = [], 0
    while at < len(parts):  # a bounded number of characters at a time
        size, to = 0, at
        while to < len(parts) and (to == at or size + len(parts[to]) <= 2 * PIECE):
            size += len(parts[to])
            to += 1
        found.append(_minima(parts[at:to]))
        at = to
    minima = np.concatenate(found, axis=1) if len(found) > 1 else found[0]
    if len(parts) > len(lines):
        minima = np.minimum.reduceat(minima, np.cumsum(pieces) - pieces, axis=1)
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[:, None], len(lines), axis=1)
    by_band = minima.reshape(BANDS, ROWS, len(lines))
    for r in range(ROWS):
        keys = (keys ^ by_band[:, r]) * _MIX
        keys ^= keys >> np.uint64(32)
    keys = keys >> np.uint64(4) | (np.arange(BANDS, dtype=np.uint64) ^ np.uint64(8))[:, None] << np.uint64(60)
    return np.ascontiguousarray(keys.T).view(np.int64), np.ascontiguousarray(minima.T).astype(np.uint8)


def _shares(line: str, share: int, shares: int) -> set[str]:
    """Those shingles of a line whose hash falls into a share."""
    if len(line) < WIDTH:
        return {line} if share == 0 else set()
    out: set[str] = set()
    for k in range(0, len(line) - WIDTH + 1, PIECE):
        part = line[k:k + PIECE + WIDTH - 1]
        mine = np.flatnonzero(_hashes([part])[0][: len(part) - WIDTH + 1] % np.uint32(shares) == share)
        out.update(part[i:i + WIDTH] for i in mine.tolist())
    return out


class Line:
    """A line, its band, band keys and low bytes of minima, and, where it is short and asked for, its shingles."""

    def __init__(self, text: str, signs: bytes = b"", band: int = 0):
        self.text, self.signs, self.band = text, signs, band

    @cached_property
    def numbers(self) -> np.ndarray | None:
        """The shingles of a short line as sorted numbers, if each of its characters is one byte of Latin-1."""
        if len(self.text) >= LONG:
            return None
        try:
            data = self.text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if len(data) < WIDTH:  # unlike any window, whose upper byte is zero
            return np.array([int.from_bytes(data, "little") | len(data) << 56], np.uint64)
        value = np.ndarray((len(data) - WIDTH + 1,), "<u8", data + b"\0", strides=(1,)) & np.uint64((1 << 8 * WIDTH) - 1)
        value.sort()
        keep = np.ones(len(value), bool)
        np.not_equal(value[1:], value[:-1], out=keep[1:])
        return value[keep]

    @cached_property
    def set(self) -> set[str] | None:
        return shingles(self.text) if len(self.text) < LONG else None

    def similar(self, other: Line, least: float) -> bool:
        """Whether the Jaccard similarity of the shingle sets is at least ``least``; long lines share by share."""
        if self.numbers is not None and other.numbers is not None:
            x, y = len(self.numbers), len(other.numbers)
            if min(x, y) < least * max(x, y):
                return False
            every = np.concatenate([self.numbers, other.numbers])
            every.sort(kind="stable")  # two sorted runs are merged
            both = np.count_nonzero(every[1:] == every[:-1])
            return both >= least * (x + y - both)
        if self.set is not None and other.set is not None:
            x, y = len(self.set), len(other.set)
            if min(x, y) < least * max(x, y):
                return False
            both = len(self.set & other.set)
            return both >= least * (x + y - both)
        shares = -(-max(len(self.text), len(other.text)) // SHARE)
        both = total = 0
        for k in range(shares):
            a, b = _shares(self.text, k, shares), _shares(other.text, k, shares)
            both += len(a & b)
            total += len(a) + len(b)
        return both >= least * (total - both)


def _halves(lines: list[str]) -> np.ndarray:
    """128 bits that stand for each line, as two columns."""
    raw = b"".join([xxhash.xxh128_digest(x.encode()) for x in lines])
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


KEYS = ["k1", "k2"]
_PLACES = "doc_id long, t1 long, t2 long, line_no int, k1 long, k2 long"


def _each_line(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, t1, t2, line number, compared line) of every line that is not blank."""
    for batch in batches:
        for doc_id, text, t1, t2 in zip(*(batch.column(i).to_pylist() for i in range(4))):
            for no, raw in enumerate(text.split("\n")):
                line = normalised(raw)
                if line:
                    yield doc_id, t1, t2, no, line


def _batches(rows: Iterator[tuple]) -> Iterator[tuple[list, list]]:
    """Lists of line places and lines, a bounded number of characters at a time."""
    held, lines, size = [], [], 0
    for *place, line in rows:
        held.append(place)
        lines.append(line)
        size += len(line)
        if size >= PIECE:
            yield held, lines
            held, lines, size = [], [], 0
    if lines:
        yield held, lines


def _places(batches, with_bands: bool):
    """Places of all lines; with bands, each different line of a batch once, at its first place, with its band keys."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    for held, lines in _batches(_each_line(batches)):
        if with_bands:
            first: dict = {}
            for place, line in zip(held, lines):
                old = first.get(line)
                if old is None or _order(place) < _order(old):
                    first[line] = place
            lines, held = list(first), list(first.values())
        columns = [pa.array(c, t) for c, t in zip(zip(*held), kinds)]
        halves = _halves(lines)
        columns += [pa.array(np.ascontiguousarray(halves[:, i])) for i in range(2)]
        names = ["doc_id", "t1", "t2", "line_no", "k1", "k2"]
        if with_bands:
            size = np.arange(len(lines) + 1, dtype=np.int32) * (8 * BANDS)
            columns.append(pa.Array.from_buffers(pa.binary(), len(lines), [None, pa.py_buffer(size), pa.py_buffer(_signatures(lines)[0])]))
            names.append("bands")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def _order(place: list) -> tuple:
    return (place[0] is not None, place[0] or 0, *place[1:])


def _source(docs: DataFrame) -> DataFrame:
    return texts(docs).withColumns(dict(zip(("t1", "t2"), text_key(F.col("text")))))


def line_places(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, line_no from 0, k1, k2) of every line with more than blanks."""
    return _source(docs).mapInArrow(lambda it: _places(it, False), _PLACES)


def _similar(values: list[Line], i: int, others: list[int], least: float) -> np.ndarray:
    """Which of the other lines reach the Jaccard similarity; lines with few minima in common are not compared."""
    signs = np.frombuffer(b"".join([values[j].signs for j in others]), np.uint8).reshape(len(others), -1)
    same = signs[:, 8 * BANDS:] == np.frombuffer(values[i].signs, np.uint8)[8 * BANDS:]
    out = np.count_nonzero(same, axis=1) >= LEAST_COMMON
    for k in np.flatnonzero(out).tolist():
        out[k] = values[i].similar(values[others[k]], least)
    return out


def _similar_in_band(values: list[Line], i: int, others: list[int], least: float) -> np.ndarray:
    """As ``_similar``, but only of the other lines whose first band in common with the i-th is the one they are in."""
    keys = np.frombuffer(b"".join([values[j].signs[:8 * BANDS] for j in others]), np.int64).reshape(len(others), BANDS)
    shared = keys == np.frombuffer(values[i].signs[:8 * BANDS], np.int64)
    out = shared[:, values[i].band] & ~shared[:, :values[i].band].any(axis=1)
    here = np.flatnonzero(out)
    if len(here):
        out[here] = _similar(values, i, [others[k] for k in here.tolist()], least)
    return out


def _lines_of(values: list[bytes]) -> list[Line]:
    """Lines from their band, signs and text in one."""
    size = 1 + (8 + ROWS) * BANDS
    return [Line(x[size:].decode(), x[1:size], x[0]) for x in values]


def _key_parts(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(part, keys) of band keys by their upper bits, in order; a key is there twice at most for many rows."""

    def rows(held: list) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(held))
        keep = np.ones(len(keys), bool)
        keep[2:] = keys[2:] != keys[:-2]
        keys = keys[keep]
        part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        packed = [keys[i:j].tobytes() for i, j in zip(begin.tolist(), [*begin[1:].tolist(), len(keys)])]
        return pa.RecordBatch.from_arrays([pa.array(part[begin]), pa.array(packed, pa.binary())], names=["part", "keys"])

    held, size = [], 0
    for b in batches:
        held.append(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64))
        size += len(held[-1])
        if size >= KEYS_AT_ONCE:
            yield rows(held)
            held, size = [], 0
    if size:
        yield rows(held)


def _keys_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that are there more than once; rows are in order of their part."""

    def met(held: list) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(np.unique(keys[1:][keys[1:] == keys[:-1]]))], names=["bucket"])

    now, held = None, []
    for b in batches:
        for part, keys in zip(*(c.to_pylist() for c in b.columns)):
            if part != now and held:
                yield met(held)
                held = []
            now = part
            held.append(np.frombuffer(keys, np.int64))
    if held:
        yield met(held)


def shared_keys(nodes: DataFrame) -> DataFrame:
    """(bucket) of the keys in ``nodes``' bands (packed in one binary value) that two or more rows have.

    Keys travel packed by ranges, whose number follows the rows, so that a task sorts a bounded number of them.
    """
    parts = max(LEAST_PARTS, nodes.count() * BANDS // KEYS_OF_PART)
    packed = nodes.select("bands").mapInArrow(lambda it: _key_parts(it, parts), "part int, keys binary")
    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(_keys_met, "bucket long")


def _values(batches: Iterator[pa.RecordBatch], keep: BitFilter) -> Iterator[pa.RecordBatch]:
    """(k1, k2, band keys, signs and text in one) of the lines whose key the filter may hold, each different line of a
    batch once."""
    for _, lines in _batches(_each_line(batches)):
        lines = list(dict.fromkeys(lines))
        k1, k2 = np.ascontiguousarray(_halves(lines).T)
        use = np.flatnonzero(keep.may_hold(k1))
        if len(use):
            some = [lines[i] for i in use.tolist()]
            value = [k.tobytes() + g.tobytes() + x.encode() for k, g, x in zip(*_signatures(some), some)]
            yield pa.RecordBatch.from_arrays([pa.array(k1[use]), pa.array(k2[use]), pa.array(value)], names=["k1", "k2", "value"])


def _star_links(rows: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of lines that are like their first line. ``rows``: (first, part, own, node, value); ``own`` marks the
    first line itself, which every part has. Only the first line is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head = None, None
        for batch in batches:
            out: list = []
            for first, part, own, node, value in zip(*(c.to_pylist() for c in batch.columns)):
                line, = _lines_of([b"\0" + value])
                if own:
                    key, head = (first, part), line
                elif (first, part) == key and _similar([head, line], 0, [1], least)[0]:
                    out.append((first, node))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b"])

    keys = ["first", "part"]
    return rows.select(*keys, "own", "node", "value").repartition(*keys).sortWithinPartitions(
        *keys, F.desc("own"), "node").mapInArrow(run, "a long, b long")


def line_components(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Distinct lines as (k1, k2, keep struct): ``keep`` is the first place of the line's component.

    Equal lines are one node. Of the bands only counts are shuffled, and only lines in some shared band have their text
    moved: bit filters of fixed size leave the others out where they can. Every line of a shared band is compared with the
    band's first line, each such pair once. Bands whose other lines are then not all of one component have all of these of
    different components compared, hot ones part against part, each pair in the first band that it shares. Compared means:
    exactly, unless the signatures have too few minima in common.
    """
    prepare(docs.sparkSession)
    with Intermediate(docs.sparkSession) as tables:
        found = _source(docs).mapInArrow(lambda it: _places(it, True), f"{_PLACES}, bands binary")
        lines = found.groupBy(*KEYS).agg(F.min(F.struct("doc_id", "t1", "t2", "line_no")).alias("first"), F.first("bands").alias("bands"))
        nodes = stored(lines.withColumn("node", F.monotonically_increasing_id()), "lines")
        with batch_rows(docs.sparkSession, NUMBER_ROWS):
            crowded = BitFilter.of(shared_keys(nodes), "bucket")

            def in_shared_bands(batches):
                for b in batches:
                    keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
                    use = np.flatnonzero(crowded.may_hold(keys))
                    node = b.column(0).to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(node[use // BANDS]), pa.array(keys[use])], names=["node", "bucket"])

            few = stored(nodes.select("node", "bands").mapInArrow(in_shared_bands, "node long, bucket long"), "line-postings")
        buckets = stored(distinct_buckets(few, with_first=True), "line-buckets")
        members = stored(few.join(buckets, "bucket"), "line-members")
        wanted = stored(members.select("node").distinct().join(nodes.select("node", *KEYS, "first"), "node"), "line-candidates")
        keep = BitFilter.of(wanted, "k1")
        written = _source(docs).mapInArrow(lambda it: _values(it, keep), "k1 long, k2 long, value binary")
        known = stored(wanted.select("node", *KEYS).join(written.groupBy(*KEYS).agg(F.max("value").alias("value")), KEYS).select("node", "value"), "line-texts")

        # 1. lines against the first one of their band
        pairs = stored(members.where("node <> first").select("first", "node").distinct(), "line-pairs")
        parts = pairs.groupBy("first").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
        rest = pairs.join(parts, "first").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("own", F.lit(False))
        own = parts.select("first", F.col("first").alias("node"), "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                           F.lit(True).alias("own"))
        stars = rest.unionByName(own).join(known, "node")
        starred = stored(components(_star_links(stars, least)), "line-stars")

        # 2. lines of different components in one band, but for its first, which all have been compared with
        grown = members.where("node <> first").join(starred, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = grown.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
        left = stored(grown.join(mixed, "bucket", "left_semi"), "line-mixed")
        band = F.unhex(F.lpad(F.hex(F.shiftrightunsigned("bucket", 60).bitwiseXOR(F.lit(8))), 2, "0"))
        grouped = in_blocks(left.join(known, "node").withColumn("value", F.concat(band, "value")), BLOCK)
        links = links_within(grouped, "value", lambda v, i, others: _similar_in_band(v, i, others, least), _lines_of, known="component")
        merged = stored(components(links), "line-merged").select(F.col("node").alias("component"), F.col("component").alias("joined"))
        alone = merged.select(F.col("component").alias("node"), "component")
        linked = starred.unionByName(alone).distinct().join(merged, "component", "left").select(
            "node", F.coalesce("joined", "component").alias("component"))
        known_nodes = stored(wanted.join(linked, "node"), "line-linked")
        firsts = stored(known_nodes.groupBy("component").agg(F.min("first").alias("keep")), "line-firsts")
        moved = stored(known_nodes.join(firsts, "component").select(*KEYS, "keep"), "line-keepers")
        # stored, so that the places of a frequent line are split by adaptive execution when they are joined with it
        return tables.keep(stored(nodes.select(*KEYS, "first").join(moved, KEYS, "left").select(
            *KEYS, F.coalesce("keep", "first").alias("keep")), "line-classes"))


def line_decisions(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Every line with more than blanks as (doc_id, t1, t2, line_no, keep_doc_id, keep_line_no, kept).

    The line that stays is the component's first in the order of doc_id (nulls first), text and line number. Rows that
    repeat doc_id and text are one document, so their lines share one decision. Blank lines are not listed; null and
    empty texts have none. Other columns are ignored.
    """
    classes = line_components(docs, least)
    own = F.struct("doc_id", "t1", "t2", "line_no")
    return line_places(docs).join(classes, KEYS).select(
        "doc_id", "t1", "t2", "line_no", F.col("keep.doc_id").alias("keep_doc_id"),
        F.col("keep.line_no").alias("keep_line_no"), (own == F.col("keep")).alias("kept"))


@F.pandas_udf(StringType())
def _without_lines(values: pd.Series, gone: pd.Series) -> pd.Series:
    def left(text, numbers):
        if numbers is None or text is None:
            return text
        out = set(numbers.tolist())
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in out)

    return pd.Series([left(t, g) for t, g in zip(values, gone)], dtype=object)


def dedup_lines(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one line of each component left in the texts; every row and all columns stay.

    Blank lines stay as they are. A text without removed lines is returned unchanged, null included; a text may become
    empty.
    """
    prepare(docs.sparkSession)
    with Intermediate(docs.sparkSession) as tables:
        gone = line_decisions(docs, least).where("not kept").groupBy("t1", "t2", "doc_id").agg(
            F.sort_array(F.collect_set("line_no")).alias("gone"))
        names = {c: fresh(docs, f"line_{c}") for c in ("t1", "t2", "doc_id", "gone")}
        gone = tables.keep(stored(gone.select(*[F.col(c).alias(n) for c, n in names.items()]), "lines-removed"))
    k1, k2 = text_key(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(gone, (F.col(names["t1"]) == k1) & (F.col(names["t2"]) == k2)
                       & F.col(names["doc_id"]).eqNullSafe(docs["doc_id"]), "left")
    return joined.withColumn("text", _without_lines("text", names["gone"])).select(*docs.columns)
