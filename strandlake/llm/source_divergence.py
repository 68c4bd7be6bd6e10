"""Source divergence audit: how far the word use of each (lang, source) group lies from the others and from its language.

The pairs are dealt as a cube: a cell is (group block, group block, term block) of one language. Every cell gets the
slices of its two group blocks in its term block, computes partial divergences of all its pairs from them, and the
partials are added along the term axis.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandlake.llm.base import Intermediate, prepare, stored

#: Documents of a language that a term must occur in.
LEAST_DOCUMENTS = 10
#: Shares are counted in billionths; each count is raised by this much.
UNIT, RAISED = 1_000_000_000, 2
#: Terms listed for a group.
TOP_TERMS = 10
#: Groups and terms on the sides of a cell, about: at most a few MB of numbers a task.
GROUP_BLOCK, TERM_BLOCK = 32, 4096
#: Terms that a task counts before it hands them on, and bytes of a text that it splits at once.
HELD_TERMS, PIECE = 200_000, 1 << 20

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
#: Bytes of terms stay, A-Z become a-z, all others separate.
_TERM_BYTES = bytes(b if b in _LETTERS else 0x20 for b in range(256)).lower()

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()),
                     ("docs", pa.int64())])


def _pieces(text: str) -> Iterator[bytes]:
    """The bytes of a text with only term bytes and blanks, cut at blanks."""
    data = text.encode().translate(_TERM_BYTES)
    start = 0
    while len(data) - start > 2 * PIECE:
        cut = data.find(b" ", start + PIECE)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


def terms_of(text: str) -> Counter:
    found: Counter = Counter()
    for piece in _pieces(text):
        found.update(piece.split())
    return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, dict] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for at in range(0, len(terms), 65_536):
                some = terms[at:at + 65_536]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(some)), pa.array([source] * len(some)),
                    pa.array([t.decode() if t is not None else None for t in some], pa.string()),
                    pa.array([n[t] for t in some], pa.int64()), pa.array([docs[t] for t in some], pa.int64())], schema=_COUNTS)
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (lang, source) not in held:
                held[lang, source] = Counter({None: 0}), Counter({None: 0})  # a group without terms is one too
            n, docs = held[lang, source]
            found = terms_of(text)
            size -= len(n)
            n.update(found)
            docs.update(found.keys())
            size += len(n)
            if size > HELD_TERMS:
                yield from flush()
                size = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group; null lang, source and text
    are ''. Each group has one row more with a null term. Terms are runs of ASCII letters and of characters above
    ASCII; A-Z are lower-cased, nothing else is."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = plain.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(UNIT * (n + RAISED) / (total + RAISED * kept)) without rounding; 1 where nothing is kept."""
    whole = "decimal(20, 0)"
    return F.expr(f"if({kept} = 0, 1L, 1L + cast({UNIT} as decimal(10, 0)) * (cast({n} as {whole}) + {RAISED}) "
                  f"div (cast({total} as {whole}) + cast({kept} as {whole}) * {RAISED}))")


def _distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most a billion and one, so the square fits a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _blocks(count: str, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(count) / size)).cast("int")


_PARTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("part_value", pa.int64()),
                    ("base", pa.int64())])


def _cell(key: tuple, rows: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of one cell.

    A row without term_id is a group of the cell: its share of a term that it lacks, and the number of kept terms. The
    partial is taken against that of terms that both lack, whose sum over all kept terms is ``base``.
    """
    low, high = key[1].as_py(), key[2].as_py()
    head = rows.column("term_id").is_null()
    groups = rows.filter(head).sort_by("source")
    names = groups.column("source").combine_chunks()
    lacking, kept, block = (groups.column(c).to_numpy() for c in ("p", "kept", "group_block"))
    found = rows.filter(pc.invert(head))
    terms, at = np.unique(found.column("term_id").to_numpy(), return_inverse=True)
    shares = np.repeat(lacking[:, None], len(terms), axis=1)
    shares[pc.index_in(found.column("source"), names).to_numpy(), at] = found.column("p").to_numpy()
    one, other, value, base = [], [], [], []
    for i in np.flatnonzero(block == low):
        js = np.flatnonzero(block == high)
        js = js[js > i] if low == high else js
        p, q = shares[i], shares[js]
        lack = (lacking[i] - lacking[js]) ** 2 // (lacking[i] + lacking[js])
        value.append(((p - q) * (p - q) // (p + q)).sum(axis=1) - len(terms) * lack)
        base.append(kept[i] * lack)
        one.append(np.full(len(js), i))
        other.append(js)
    if not one:
        return _PARTS.empty_table()
    one, other, value, base = map(np.concatenate, (one, other, value, base))
    both = lambda a, b: pa.concat_arrays([names.take(pa.array(a)), names.take(pa.array(b))])
    return pa.table([pa.array([key[0].as_py()] * (2 * len(one)), pa.string()), both(one, other), both(other, one),
                     pa.array(np.tile(value, 2)), pa.array(np.tile(base, 2))], schema=_PARTS)


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_divergence(docs: DataFrame) -> DataFrame:
    """``docs`` (lang, source, text) to (lang, source, part, item, value, rank).

    Part ``pair``: each other source of the language with the summed distance over all kept terms, all ranks. Part
    ``term``: the kept terms that the group uses more than its language, ranks to ``TOP_TERMS``. Groups without terms and
    languages without kept terms have pairs too (value 0 where nothing is kept). Repeated rows count as documents of
    their own; an empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    with Intermediate(docs.sparkSession) as tables:
        counted = stored(term_counts(docs), "source-terms")
        kept = stored(counted.where("term is not null").groupBy("lang", "term").agg(
            F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCUMENTS).select(
            "lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id")), "kept-terms")
        used = stored(counted.where("term is not null").join(kept, ["lang", "term"]).select(
            "lang", "source", "term", "term_id", "n", "lang_n"), "used-terms")
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counted.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(
            langs, "lang", "left").fillna(0, ["total", "kept", "lang_total"])
        many = groups.groupBy("lang").agg(F.count("*").alias("groups"))
        groups = stored(groups.join(many, "lang").select(
            "lang", "source", "total", "lang_total", "kept", _share("0", "total", "kept").alias("lacking"),
            _blocks("groups", GROUP_BLOCK).alias("group_blocks"), _blocks("kept", TERM_BLOCK).alias("term_blocks")).withColumn(
            "group_block", F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int")), "groups")

        shared = used.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "kept"))
        in_lang = shared.withColumn("q", _share("lang_n", "lang_total", "kept")).where("p > q")
        top = _ranked(in_lang.select("lang", "source", F.col("term").alias("item"), _distance("p", "q").alias("value")),
                      "term").where(F.col("rank") <= TOP_TERMS)

        cell = ["lang", "source", "term_id", "p", "kept", "group_block", "group_blocks", "term_block"]
        slices = shared.withColumn("term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int")).select(*cell)
        heads = groups.select("lang", "source", F.lit(None).cast("long").alias("term_id"), F.col("lacking").alias("p"), "kept",
                              "group_block", "group_blocks", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("term_block"))
        dealt = slices.unionByName(heads.select(*cell)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
        dealt = dealt.withColumn("low", F.least("group_block", "other")).withColumn("high", F.greatest("group_block", "other")).drop(
            "other", "group_blocks")
        parts = dealt.groupBy("lang", "low", "high", "term_block").applyInArrow(
            _cell, "lang string, source string, item string, part_value long, base long")
        pairs = parts.groupBy("lang", "source", "item").agg((F.sum("part_value") + F.max("base")).alias("value"))
        return tables.keep(stored(_ranked(pairs, "pair").unionByName(top), "source-divergence"))
