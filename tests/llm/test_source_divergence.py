import random
import re
from collections import Counter, defaultdict

import pytest

from strandlake.llm import source_divergence as sd
from llm_fixtures import make_docs  # noqa: F401

_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=10):
    """Rows of (lang, source, text) by the plain definition."""
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        found = Counter(lowered(t) for t in _TERM.findall(text or ""))
        n[lang or "", source or ""].update(found)
        docs[lang or ""].update(found.keys())
    out = []
    for lang, by in docs.items():
        kept = [t for t, d in by.items() if d >= least]
        groups = sorted(s for la, s in n if la == lang)
        whole = sum((n[lang, s] for s in groups), Counter())

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: share(n[lang, s]) for s in groups}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s)
            out += [(lang, s, "pair", o, -v, k) for k, (v, o) in enumerate(pairs, 1)]
            terms = sorted((-f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:10]
            out += [(lang, s, "term", t, -v, k) for k, (v, t) in enumerate(terms, 1)]
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    for name in ("doc_id", "term", "n", "kept", "total", "p", "low", "value", "rank"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def result(spark, rows):
    return sorted(tuple(r) for r in sd.source_divergence(frame(spark, rows)).collect())


def many(seed, n):
    r = random.Random(seed)
    words = ["the", "The", "été", "ÉTÉ", "x1y", "漢字", "a_b", "naïve", "😀", "of", "in", "z" * 300] + [f"{a}{b}" for a in "bcdfg" for b in "aeiou"]
    rows = []
    for _ in range(n):
        source = "hot" if r.random() < 0.4 else f"s{r.randrange(7)}"
        rows.append((r.choice(["en", "en", "fr", None]), r.choice([source, source, None]),
                     " ".join(r.choices(words, k=r.randrange(0, 40)))))
    return rows + [("en", "silent", None), ("en", "silent", ""), ("de", "one", "few words"), ("de", "two", ""), ("xx", "alone", "x")]


def test_equals_definition(spark):
    rows = many(3, 400)
    assert result(spark, rows) == brute(rows)


def test_many_cells(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP_BLOCK", 2)
    monkeypatch.setattr(sd, "TERM_BLOCK", 5)
    rows = many(4, 300) * 2  # repeated rows are documents
    assert result(spark, rows) == brute(rows)


def test_flushes_and_long_texts(monkeypatch):
    text = "Ab é9" * 2000 + "w" * 900
    want = Counter(lowered(t) for t in _TERM.findall(text))
    monkeypatch.setattr(sd, "PIECE", 64)
    assert {t.decode(): c for t, c in sd.terms_of(text).items()} == want


def test_huge_counts_stay_exact(spark):
    df = spark.createDataFrame([(700_000_000_000, 999_999_999_999, 7)], "n long, total long, kept long")
    assert df.select(sd._share("n", "total", "kept").alias("p")).first().p == 1 + 10**9 * 700_000_000_002 // 1_000_000_000_013


def test_empty(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("rows", [[("en", "a", "x"), ("en", "b", None)], [(None, None, None)]])
def test_nothing_kept(spark, rows):
    assert result(spark, rows) == brute(rows)
