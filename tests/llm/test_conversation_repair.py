import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from strandlake.llm import conversation_repair as cr
from strandlake.llm.queries import QUERIES

SHAPE = "conv_id long, turn long, role string, text string"
WORD = re.compile("[^\x20\x09-\x0d]")


def cheapest(rows):
    """(cost, edits) of rows (initial, fault) by plain recursion over what is left; fault 0 to 3 as in the operator."""

    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in "-a":
            found.append((0, ""))
        if inserts < 2:
            new = "a" if state == "u" else "u"
            cost, edits = best(i, new, inserts + 1)
            found.append((cost + 5, "I" + edits))
        if i < len(rows):
            initial, fault = rows[i]
            cost, edits = best(i + 1, state, 0)
            found.append((cost + 2, "D" + edits))
            if fault in (0, 3):
                extra = 5 * (fault == 3)
                new = "a" if state == "u" else "u"
                cost, edits = best(i + 1, new, 0)
                found.append((cost + 1 + extra, "R" + edits))
                if initial == new:
                    found.append((cost + extra, "K" + edits))
                if initial == "s" and state == "-":
                    cost, edits = best(i + 1, "s", 0)
                    found.append((cost + extra, "K" + edits))
        return min(found, default=(10**9, "~"))

    return best(0, "-", 0)


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            m = zlib.crc32(key.encode()) % 20
            if m == 0:
                continue
            text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
            kept += [(turn, "user" if m == 4 else role, text)] * (2 if m == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in kept:
            signs = WORD.findall(text)
            fault = 1 if not signs else 2 if (role, text) in seen else 3 if signs[-1] not in ".!?" else 0
            seen.add((role, text))
            marked.append((role[:1], fault))
        cost, edits = cheapest(tuple(marked)) if marked else (0, "")
        turns = [t for t, *_ in kept if t is not None]
        state, repaired, left = "-", [], list(kept)
        for e in edits:
            new = "a" if state == "u" else "u"
            row = None if e == "I" else left.pop(0)
            if e == "D":
                continue
            state = row[1][0] if e == "K" else new
            repaired.append(row[1] + ":" + row[2] if e == "K" else {"u": "user:", "a": "assistant:"}[state] + (row[2] if row else ""))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in repaired))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, f in marked) for k in (1, 2, 3)),
                    sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])), cost, edits,
                    hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows):
    df = spark.createDataFrame(rows, SHAPE)
    for name in ("code", "copies", "last", "same", "first", "n", "part", "audit", "cost", "is_row"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return sorted((tuple(r) for r in cr.repair(df).collect()), key=repr)


def made(seed, conversations, longest, repeats=False):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", "é.", "Long " * 30 + ".", " ", "a\x0b", "Ok. \n", None]
    rows = []
    for c in range(conversations):
        turn = r.randrange(5)
        for _ in range(r.randrange(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", "s", "a", None])
            text = r.choice(texts) if r.random() < 0.5 else f"Word {r.randrange(99)}."
            rows.append((c if c else None, None if r.random() < 0.05 else turn, role, text))
            turn += r.choice([1, 1, 1, 0 if repeats else 1, 3])
        if repeats:
            rows += rows[-2:]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_definition(spark, seed):
    rows = made(seed, 120, 9, repeats=True)
    assert result(spark, rows) == brute(rows)


def test_blocks_of_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(cr, "BLOCK", 3)
    monkeypatch.setattr(cr, "RANGE_PREFIX", 4)
    rows = made(7, 3, 90) + made(8, 40, 5, repeats=True)
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_chained_blocks_equal_recursion(block):
    r = random.Random(block)
    for _ in range(150):
        rows = tuple((r.choice("suax"), r.choice([0, 0, 0, 1, 2, 3, 3])) for _ in range(r.randrange(1, 14)))
        codes = [{"s": 1, "u": 2, "a": 3, "x": 0}[i] * 4 + f for i, f in rows]
        chain = cr.Chain()
        for at in range(0, len(codes), block):
            chain.add([cr.solve(codes[at:at + block], entry) for entry in range(4)])
        assert chain.end() == cheapest(rows), rows


def test_trails_compare_as_texts():
    r = random.Random(3)
    trail, nodes = cr.Trail(), [(0, "")]
    for _ in range(400):
        node, text = r.choice(nodes)
        label = r.choice(["D", "I", "K", "R", "KK", "KI"])
        nodes.append((trail.child(node, label), text + label))
    for _ in range(3000):
        (a, x), (b, y) = r.choice(nodes), r.choice(nodes)
        if x != y:
            assert trail.less(a, b) == (x < y)
        assert trail.text(a) == x


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(cr, "_MOD", 2)  # nearly all hashes collide
    test_chained_blocks_equal_recursion(3)


def test_conversation_that_holds_most_rows(spark):
    rows = [(100, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(5000)] + made(5, 10, 5)
    got = {r[0]: r for r in result(spark, rows)}
    n = sum(1 + (zlib.crc32(f"100:{t}".encode()) % 20 == 3) - (zlib.crc32(f"100:{t}".encode()) % 20 == 0) for t in range(5000))
    assert len(got[100][7].replace("I", "")) == n


def test_edges(spark):
    assert result(spark, []) == []
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    rows = [(9, gone, "user", "x."), (None, None, None, None), (3, None, "user", "Hello."), (3, None, "assistant", "Hi.")]
    assert result(spark, rows) == brute(rows)
    assert (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in result(spark, rows)
    same = [(4, 2, "user", "Again.")] * 50
    assert result(spark, same) == brute(same)


def test_given_table(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.01")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute([tuple(r) for r in given.collect()])
