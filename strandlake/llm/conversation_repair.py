"""Conversation structure repair: faults of damaged conversations and the cheapest edits that make their roles alternate.

The edits are found by dynamic programming over four states (nothing yet, system, user, assistant last). Edit prefixes are
persistent linked nodes that share their beginnings; of equally dear ones the ASCII-least stays, found by the longest
common prefix with binary-lifting ancestors and rolling hashes. Conversations are cut into blocks of turns; a block is
solved for each state it may be entered in, and the blocks of a conversation are then chained by the same programme.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.base import Intermediate, prepare, stored

#: Rows of a block: what one solution holds in memory.
BLOCK = 1024
#: Characters of a text that take part in dealing rows by range; the order itself is by whole texts.
RANGE_PREFIX = 64
#: Costs of the edits; an undeleted truncated row costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
_LEGAL = {(1, 2), (2, 3), (3, 2)}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: States from which a user or an assistant turn may follow.
_BEFORE = {USER: (NOTHING, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
_MOD, _BASE = (1 << 61) - 1, 1_000_003
_SPACE = " \t\n\x0b\x0c\r"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after the damage that crc32 of ``conv_id:turn`` gives; null role and text are
    one blank, as are nulls in the key. Equal rows are one row with their number."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    full = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("damage"))
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("damage") == 3, F.lit(2)).otherwise(F.lit(1))
    return full.where("damage <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies")).groupBy(
        "conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def last_sign(text: str) -> Column:
    """The last character of a column that is no white space, or ''."""
    return F.right(F.rtrim(F.col(text), F.lit(_SPACE)), F.lit(1))


def _faults(rows: DataFrame) -> DataFrame:
    """``code`` (role initial and first fault of a row's first copy) for rows of ``damaged``."""
    initial = F.left("role", F.lit(1))
    rows = rows.withColumns({
        "start": F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(NOTHING),
        "last": last_sign("text"), "same": F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)})
    repeated = rows.where("last <> ''").groupBy("conv_id", "same").agg(
        F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col("conv_id").alias("r_conv"), F.col("same").alias("r_same"), "first")
    joined = rows.join(repeated, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("same") == F.col("r_same")), "left")
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    fault = F.when(F.col("last") == "", BLANK).when(later, DUPLICATE).when(~F.col("last").isin(*".!?"), CUT_OFF).otherwise(FINE)
    return joined.select("conv_id", "turn", "role", "text", "copies", (F.col("start") * 4 + fault).cast("int").alias("code"))


class Trail:
    """Edit prefixes as linked nodes that share their beginnings.

    A node is known by its parent and label, so equal prefixes of equal steps are one node: an equal hash of two different
    nodes is a collision, and being the same node verifies an equal hash.
    """

    def __init__(self):
        self.label, self.level, self.hash, self.up = [""], [0], [1], [[]]
        self.made: dict[tuple, int] = {}

    def child(self, node: int, label: str) -> int:
        found = self.made.get((node, label))
        if found is None:
            found = self.made[node, label] = len(self.label)
            self.label.append(label)
            self.level.append(self.level[node] + 1)
            h = self.hash[node]
            for c in label.encode():
                h = (h * _BASE + c) % _MOD
            self.hash.append(h)
            up, at, k = [node], node, 0
            while len(self.up[at]) > k:  # the 2^(k+1)-th ancestor is the 2^k-th one of the 2^k-th
                at = self.up[at][k]
                up.append(at)
                k += 1
            self.up.append(up)
        return found

    def _lift(self, node: int, level: int) -> int:
        while self.level[node] > level:
            k = min((self.level[node] - level).bit_length() - 1, len(self.up[node]) - 1)
            node = self.up[node][k]
        return node

    def _same(self, a: int, b: int) -> bool:
        return self.hash[a] == self.hash[b] and a == b

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` comes before that of ``b``."""
        level = min(self.level[a], self.level[b])
        x, y = self._lift(a, level), self._lift(b, level)
        if self._same(x, y):
            return self.level[a] < self.level[b]
        k = len(self.up[x]) - 1
        while k >= 0:  # down to the first step that differs
            if k < len(self.up[x]) and not self._same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
            k -= 1
        one, two = self.label[x], self.label[y]
        if one.startswith(two) or two.startswith(one):  # blocks of edits: what follows decides
            one, two = self.text(a, self.level[x]), self.text(b, self.level[y])
        return one < two

    def text(self, node: int, level: int = 1) -> str:
        """The labels on the way to a node, from a level on."""
        out = []
        while self.level[node] >= level and node:
            out.append(self.label[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def _offer(trail: Trail, best: list, state: int, cost: int, node: int, label: str) -> None:
    """Take ``node`` + ``label`` as the best way to a state if it is."""
    held = best[state]
    if held is not None and held[0] < cost:
        return
    node = trail.child(node, label) if label else node
    if held is None or cost < held[0] or node != held[1] and trail.less(node, held[1]):
        best[state] = (cost, node)


def _with_inserts(trail: Trail, best: list) -> list:
    """The best ways when up to two turns are inserted; more would come back to the same state."""
    for _ in range(2):
        more = list(best)
        for state, before in _BEFORE.items():
            for b in before:
                if best[b] is not None:
                    _offer(trail, more, state, best[b][0] + INSERT, best[b][1], "I")
        best = more
    return best


def solve(codes: list[int], entry: int) -> list[tuple[int, str] | None]:
    """For rows entered in state ``entry``: cost and edits of the best way to each state, inserts behind the rows left out."""
    trail = Trail()
    best: list = [None] * 4
    best[entry] = (0, 0)
    for code in codes:
        initial, fault = code >> 2, code & 3
        best = _with_inserts(trail, best)
        new: list = [None] * 4
        for state in range(4):
            if best[state] is not None:
                _offer(trail, new, state, best[state][0] + DELETE, best[state][1], "D")
        if fault in (FINE, CUT_OFF):
            extra = TRUNCATED if fault == CUT_OFF else 0
            if initial == SYSTEM and best[NOTHING] is not None:
                _offer(trail, new, SYSTEM, best[NOTHING][0] + extra, best[NOTHING][1], "K")
            for state, before in _BEFORE.items():
                for b in before:
                    if best[b] is not None:
                        if initial == state:
                            _offer(trail, new, state, best[b][0] + extra, best[b][1], "K")
                        _offer(trail, new, state, best[b][0] + extra + REROLE, best[b][1], "R")
        best = new
    return [None if b is None else (b[0], trail.text(b[1])) for b in best]


class Chain:
    """Blocks of one conversation put together in order."""

    def __init__(self):
        self.trail = Trail()
        self.best: list = [(0, 0), None, None, None]

    def add(self, ways: list[list]) -> None:
        """``ways[entry][exit]``: (cost, edits) of the block or None."""
        new: list = [None] * 4
        for entry, found in enumerate(ways):
            for state, way in enumerate(found):
                if self.best[entry] is not None and way is not None:
                    _offer(self.trail, new, state, self.best[entry][0] + way[0], self.best[entry][1], way[1])
        self.best = new

    def end(self) -> tuple[int, str]:
        best = _with_inserts(self.trail, self.best)
        done: list = [None]
        for state in (NOTHING, ASSISTANT):
            if best[state] is not None:
                _offer(self.trail, done, 0, *best[state], "")
        return done[0][0], self.trail.text(done[0][1])


_BLOCK_COLUMNS = ("part int, no int, blank long, duplicate long, truncated long, illegal long, first_start int, last_start int, turns long, "
                  "least_turn long, greatest_turn long, first_turn long, last_turn long, ways array<array<struct<cost: long, edits: string>>>")
_WAYS = pa.list_(pa.list_(pa.struct([("cost", pa.int64()), ("edits", pa.string())])))
_BLOCK_TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), pa.int32(), *[pa.int64()] * 5, _WAYS]
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _block(codes: list[int], turns: list, entries: tuple) -> list:
    starts = [c >> 2 for c in codes]
    known = [t for t in turns if t is not None]
    faults = [sum(c & 3 == f for c in codes) for f in (BLANK, DUPLICATE, CUT_OFF)]
    ways = [[way and {"cost": way[0], "edits": way[1]} for way in (solve(codes, e) if e in entries else [None] * 4)] for e in range(4)]
    return [*faults, sum(pair not in _LEGAL for pair in zip(starts, starts[1:])), starts[0], starts[-1], len(set(known)),
            min(known, default=None), max(known, default=None), turns[0], turns[-1], ways]


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the conversations of a partition whose rows are ordered. Only the first conversation may have begun before."""
    part = TaskContext.get().partitionId()
    key, first, no, codes, turns, out, kind = None, True, 0, [], [], [], None

    def flush() -> None:
        entries = tuple(range(4)) if no or first else (NOTHING,)
        out.append([key[0], part, no, *_block(codes, turns, entries)])

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [kind, *_BLOCK_TYPES])],
                                          names=["conv_id", *(c.split()[0] for c in _BLOCK_COLUMNS.split(", ")[:13]), "ways"])

    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, turn, copies, code in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if key != (conv,):
                if codes:
                    flush()
                first, no, codes, turns = key is None, 0, [], []
                key = (conv,)
            again = code if code & 3 == BLANK else code & ~3 | DUPLICATE
            for k in range(copies):
                if len(codes) == BLOCK:
                    flush()
                    no, codes, turns = no + 1, [], []
                    if len(out) >= 16:
                        yield made()
                        out.clear()
                codes.append(again if k else code)
                turns.append(turn)
        if out:
            yield made()
            out.clear()
    if codes:
        flush()
        yield made()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its blocks in order."""
    key, held = None, None

    def row() -> tuple:
        cost, audit = held["chain"].end()
        gaps = held["greatest"] - held["least"] + 1 - held["turns"] if held["turns"] else 0
        return (key[0], gaps, held["blank"], held["duplicate"], held["truncated"], held["illegal"], cost, audit)

    for batch in batches:
        out = []
        kind = batch.schema.field(0).type
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            b = dict(zip(names, values))
            if key != (b["conv_id"],):
                if held:
                    out.append(row())
                key = (b["conv_id"],)
                held = {"chain": Chain(), "turns": 0, "least": None, "greatest": None, "last": None, "last_turn": None,
                        "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
            for c in ("blank", "duplicate", "truncated", "illegal"):
                held[c] += b[c]
            if held["last"] is not None:
                held["illegal"] += (held["last"], b["first_start"]) not in _LEGAL
            held["last"] = b["last_start"]
            held["turns"] += b["turns"] - (b["first_turn"] is not None and b["first_turn"] == held["last_turn"])
            held["last_turn"] = b["last_turn"]
            if b["turns"]:
                held["least"] = b["least_turn"] if held["least"] is None else min(held["least"], b["least_turn"])
                held["greatest"] = b["greatest_turn"] if held["greatest"] is None else max(held["greatest"], b["greatest_turn"])
            held["chain"].add([[w and (w["cost"], w["edits"]) for w in ways] for ways in b["ways"]])
        if out:
            yield _conversations(out, kind)
    if held:
        yield _conversations([row()], kind)


def _conversations(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, *[pa.int64()] * 6, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["conv_id", *_COUNTS, "audit"])


class _Repaired:
    """Digest of the repaired rows, fed with the rows in order."""

    def __init__(self, audit: str):
        self.edits, self.at, self.state = audit, 0, NOTHING
        self.digest, self.any = hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.digest.update(("\n" * self.any + role + ":" + text).encode())
        self.any = True

    def _insert(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.state = ASSISTANT if self.state == USER else USER
            self._put(_ROLE[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            self._put(role, text)
        elif edit == "R":
            self.state = ASSISTANT if self.state == USER else USER
            self._put(_ROLE[self.state], text)

    def end(self) -> str:
        self._insert()
        return self.digest.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result rows from each conversation's head row and its rows behind it."""
    head, state = None, None
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]

    def made(rows: list) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        out = []
        kind = batch.schema.field(0).type
        for conv, is_row, _, role, text, copies, *counts in zip(*(c.to_pylist() for c in batch.columns)):
            if is_row:
                for _ in range(copies):
                    state.row(role, text)
            else:
                if head:
                    out.append((*head, state.end()))
                head, state = (conv, *counts, text), _Repaired(text)
        if out:
            yield made(out)
    if head:
        yield made([(*head, state.end())])


def repair(conversations: DataFrame) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) to one row per conv_id: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256) of its damaged rows.

    Rows go by turn (nulls first), then role and text, so rows of one turn have a defined order and equal rows follow each
    other. Rows without conv_id are one conversation. One without rows after damage has zeros, an empty audit and the digest
    of nothing; an empty table gives no rows; other columns are ignored. A conversation's turns are dealt to tasks by range
    and solved in blocks; what one task sees of a conversation as a whole is its edits (one letter a row, the audit itself)
    and, row by row, its texts on their way into the digest, which is one sequence by definition.
    """
    prepare(conversations.sparkSession)
    key = conversations.schema["conv_id"].dataType.simpleString()
    order = ["turn", "role", "text"]
    with Intermediate(conversations.sparkSession) as tables:
        rows = stored(_faults(damaged(conversations)), "turns")
        dealt = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(RANGE_PREFIX))).sortWithinPartitions("conv_id", *order)
        blocks = stored(dealt.select("conv_id", "turn", "copies", "code").mapInArrow(
            _blocks_of, f"conv_id {key}, {_BLOCK_COLUMNS}"), "turn-blocks")
        found = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no").mapInArrow(
            _chained, f"conv_id {key}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string")
        found = found.withColumnRenamed("conv_id", "f_conv")
        heads = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("f_conv")), "left")
        counts = [F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS]
        nothing = [F.lit(None).cast("long").alias(c) for c in _COUNTS]
        heads = heads.select("conv_id", F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                             F.coalesce("audit", F.lit("")).alias("text"), F.lit(0).cast("long").alias("copies"), *counts)
        both = heads.unionByName(rows.select("conv_id", F.lit(True).alias("is_row"), *order, "copies", *nothing))
        return tables.keep(stored(both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *order).mapInArrow(
            _digests, f"conv_id {key}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"), "repaired"))
