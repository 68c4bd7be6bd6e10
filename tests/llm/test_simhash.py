import random

import pytest
import xxhash

from strandlake.llm.simhash import keep_one_per_group, simhash, simhash_components
from llm_fixtures import make_docs  # noqa: F401, E402


def plain(text, width=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    rows = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "one", "A b\tC d e É Ü x", "a b c d " * 40, "x\x1cy z w v u"])
def test_fingerprint(text):
    assert simhash(text) & (2**64 - 1) == plain(text)


def brute(prints, bits=4):
    """Component ids of (doc_id, print) rows."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if ((prints[i][1] ^ prints[j][1]) & (2**64 - 1)).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(prints):
        c = find(i)
        low[c] = min(low.get(c, d), d)
    return {d: low[find(i)] for i, (d, _) in enumerate(prints)}


def texts(seed=1):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(25):
        base = [r.choice(words) for _ in range(r.randint(3, 250))]
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for _ in range(r.randint(0, 2)):
                copy[r.randrange(len(copy))] = r.choice(words)
            rows.append((len(rows), " ".join(copy)))
    return rows + [(len(rows), ""), (len(rows) + 1, None)]


def test_components_equal_brute_force(make_docs):
    rows = texts()
    got = {r.doc_id: r.component_id for r in simhash_components(make_docs(rows)).collect()}
    assert got == brute([(d, plain(t or "")) for d, t in rows])


def test_components_of_close_prints(spark):
    """Chains and dense groups of fingerprints, with lists cut into parts."""
    from strandlake.llm import simhash as module

    r = random.Random(2)
    prints = set()
    for _ in range(6):
        p = r.getrandbits(64)
        for _ in range(40):
            prints.add(p)
            for _ in range(r.randint(1, 5)):
                p ^= 1 << r.randrange(64)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    old, module.BLOCK = module.BLOCK, 5
    try:
        linked = module.fingerprint_components(spark.createDataFrame(rows, "i long, node long").select("node"))
        comp = {x.node: x.component for x in linked.collect()}
    finally:
        module.BLOCK = old
    want = brute(rows)
    mine, theirs = {}, {}
    for i, p in rows:
        mine.setdefault(comp.get(p, p), set()).add(i)
        theirs.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_stage_keeps_one(make_docs):
    rows = texts(3) + [(None, "no id at all"), (None, "no id at all"), (7000, "twice here"), (7000, "twice here")]
    docs = make_docs(rows)
    out = keep_one_per_group(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    want = brute([(d, plain(t or "")) for d, t in rows if d is not None])
    assert sorted(i for i in ids if i is not None) == sorted(set(want.values()))
    assert ids.count(None) == 2


def test_empty_and_repeated(make_docs):
    assert simhash_components(make_docs([])).count() == 0
    same = [(4, "a b"), (4, "a b"), (2, "A B"), (9, "long " * 30_000)]
    assert sorted((r.doc_id, r.component_id) for r in simhash_components(make_docs(same)).collect()) == [
        (2, 2), (4, 2), (4, 2), (9, 9)]


def test_texts_that_share_a_doc_id(make_docs):
    x, a, b = ("one two three four five", "red green blue pink grey", "up down left right front")
    out = keep_one_per_group(make_docs([(7, a), (7, b), (3, x), (7, x), (7, b)]))
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted([(3, x), (7, a), (7, b)])
