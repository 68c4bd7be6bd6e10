import hashlib
import random

from strandlake.llm.suffix_dedup import remove_repeats
from llm_fixtures import make_docs  # noqa: F401, E402


def brute(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare(make_docs, rows, length, gram, **more):
    got = {}
    for r in remove_repeats(make_docs(rows), length, gram, **more).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    want = {}
    for (d, _), x in zip(rows, brute([(t or "").encode() for _, t in rows], length)):
        want.setdefault(d, []).append(x)
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items()}


def pieces(seed, alphabet, docs):
    r = random.Random(seed)
    parts = ["".join(r.choice(alphabet) for _ in range(r.randint(5, 60))) for _ in range(8)]
    rows = [(i, "".join(r.choice(parts) if r.random() < 0.5 else "".join(r.choice(alphabet) for _ in range(r.randint(1, 40)))
                        for _ in range(r.randint(0, 7)))) for i in range(docs)]
    return rows + [(900, rows[0][1]), (901, "ab" * 80), (902, "a" * 70), (None, "é" * 50), (903, None), (904, ""), (905, "xyz"), (905, "xyz")]


def test_small_strings(make_docs):
    for seed, alphabet, length, gram in ((1, "ab", 12, 4), (2, "abcdefgh", 20, 6), (3, "abc", 9, 3)):
        compare(make_docs, pieces(seed, alphabet, 60), length, gram)


def test_long_texts_in_pieces(make_docs):
    compare(make_docs, pieces(5, "abcd", 40), 15, 5, piece=37)


def test_production_length(make_docs):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    passage = " ".join(word() for _ in range(150))
    rows = []
    for i in range(30):
        text = " ".join(word() for _ in range(r.randint(10, 300)))
        if i % 3 == 0:
            cut = r.randrange(0, 200)
            text += passage[cut: cut + r.randint(350, 700)] + " ".join(word() for _ in range(30))
        rows.append((i, text))
    compare(make_docs, rows + [(50, rows[4][1]), (51, "Are, " * 500)], 400, 100)
    assert remove_repeats(make_docs([])).count() == 0


def test_strings_with_equal_polynomial_hashes(make_docs):
    """Words in Thue-Morse order and their opposites, which sums of powers take as equal."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join(pair[x] for x in bits) for pair in ("ab", "ba"))
    r = random.Random(4)
    noise = ["".join(r.choice("cdefg") for _ in range(300)) for _ in range(4)]
    compare(make_docs, [(i, noise[i] + w[:n] + noise[i][::-1]) for n in (450, 600, 1024) for i, w in enumerate((one, two))], 400, 100)


def test_columns_of_the_decision(make_docs):
    rows = [(1, "x" * 900), (2, "short"), (3, None)]
    out = {r.doc_id: (r.n_kept, r.untouched) for r in remove_repeats(make_docs(rows)).collect()}
    assert out == {1: (0, False), 2: (5, True), 3: (0, True)}
