import random

from corpus_pipeline import STAGES
from strandlake.llm.line_dedup import dedup_lines, line_decisions, normalised, shingles
from llm_fixtures import make_docs  # noqa: F401, E402


def brute(rows, least=0.8):
    lines = []
    for doc_id, text in rows:
        for no, raw in enumerate((text or "").split("\n")):
            if normalised(raw):
                lines.append(((doc_id is not None, doc_id or 0), no, normalised(raw)))
    lines.sort(key=lambda x: (x[0], x[1]))
    texts = sorted({x[2] for x in lines})
    sets = {t: shingles(t) for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[i + 1:]:
            both = len(sets[a] & sets[b])
            if both >= least * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    first = {}
    out = {}
    for d, no, t in lines:
        c = find(t)
        first.setdefault(c, (d, no))
        out[(d[1] if d[0] else None, no)] = first[c] == (d, no)
    return out


def sample():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9))) for _ in range(400)]
    base = [" ".join(r.choices(words, k=r.randint(8, 25))) for _ in range(30)]
    rows = []
    for doc_id in range(60):
        lines = []
        for _ in range(r.randint(1, 6)):
            line = r.choice(base)
            if r.random() < 0.4:  # far above the threshold, so that banding finds it for certain
                parts = line.split(" ")
                parts[r.randrange(len(parts))] += "x"
                line = " ".join(parts)
            lines.append(line if r.random() < 0.7 else " ".join(r.choices(words, k=12)))
        rows.append((doc_id, "\n".join(lines)))
    return rows


def test_decisions_equal_brute_force(make_docs):
    rows = sample()
    got = {(r.doc_id, r.line_no): r.kept for r in line_decisions(make_docs(rows)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    assert sum(got[k] != want[k] for k in want) <= 0.01 * len(want)


def test_hot_line_and_blocks(make_docs, monkeypatch):
    monkeypatch.setattr("strandlake.llm.line_dedup.BLOCK", 4)
    base = "the quick brown fox jumps over the lazy dog while the band plays on and on number"
    rows = [(i, f"{base} {i % 10}") for i in range(200)] + [(500, "something else that is of no concern to the others")]
    kept = [r.doc_id for r in line_decisions(make_docs(rows)).where("kept").collect()]
    assert sorted(kept) == [0, 500]


def test_edge_rows(make_docs, spark):
    rows = [(None, "a line that is here twice"), (1, None), (2, ""), (3, " \n\t\n"), (4, "a line that is here twice\n\nab"),
            (5, "ab"), (5, "ab"), (6, "x" * 50_000 + "\ny")]
    docs = make_docs(rows)
    out = dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    texts = sorted((str(r.doc_id), r.text) for r in out.collect() if r.doc_id != 6 and r.text is not None)
    assert texts == [("2", ""), ("3", " \n\t\n"), ("4", "\nab"), ("5", ""), ("5", ""), ("None", "a line that is here twice")]
    assert line_decisions(make_docs([])).count() == 0
    assert dedup_lines(make_docs([])).columns == docs.columns


def test_stage_is_listed():
    assert [n for n, _ in STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "source mixing", "bpe encoding"]


def test_similarity_of_lines(monkeypatch):
    from strandlake.llm import line_dedup

    r = random.Random(1)
    lines = ["".join(r.choice("abcdé漢 x\x00"[:r.choice([1, 3, 5, 9])]) for _ in range(r.randint(1, 40))) for _ in range(300)]
    lines += [x + "ab" for x in lines[::3]]
    want = {(a, b): len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)) for a in lines for b in lines[::7] + [a]}
    assert all(line_dedup.Line(a).similar(line_dedup.Line(b), 0.8) == w for (a, b), w in want.items())
    monkeypatch.setattr(line_dedup, "LONG", 20)  # as long lines are, share by share and piece by piece
    monkeypatch.setattr(line_dedup, "SHARE", 9)
    monkeypatch.setattr(line_dedup, "PIECE", 8)
    some = r.sample(sorted(want), 1500)
    assert all(line_dedup.Line(a).similar(line_dedup.Line(b), 0.8) == want[a, b] for a, b in some)


def test_signatures_are_minima(monkeypatch):
    """Signatures equal plain minima over each line's shingles, whatever the lines they are made with or pieces."""
    from strandlake.llm import line_dedup

    r = random.Random(2)
    lines = ["".join(r.choice("abcé漢 ") for _ in range(r.choice([1, 3, 6, 7, 8, 14, 15, 40, 200]))) for _ in range(80)]
    whole, signs = line_dedup._signatures(lines)
    for x, k, g in zip(lines, whole, signs):
        keys, low = line_dedup._signatures([x])
        assert (keys[0] == k).all() and (low[0] == g).all()
    for x, m in zip(lines, line_dedup._minima(lines).T):
        each = [line_dedup._minima([s]) for s in shingles(x)] if len(x) >= line_dedup.WIDTH else [line_dedup._minima([x])]
        assert (min(tuple(e[0]) for e in each)[0] == m[0]) and (sum(each) * 0 + m[:, None] <= each[0]).all()
    monkeypatch.setattr(line_dedup, "PIECE", 16)
    assert (line_dedup._signatures(lines)[0] == whole).all()


def test_long_lines(make_docs):
    r = random.Random(3)
    long = "".join(r.choice("abcdefgh ") for _ in range(150_000))
    rows = [(0, long), (1, long[:70_000] + "#" + long[70_000:]), (2, long[:75_000]), (3, long[::-1] + "\n" + long)]
    kept = {(d.doc_id, d.line_no) for d in line_decisions(make_docs(rows)).where("kept").collect()}
    assert kept == {(0, 0), (2, 0), (3, 0)}


def test_components_of_one_band_join_in_the_second_step(make_docs, monkeypatch):
    """Chains of lines, each like the next only, so that most links are not with the first line of a band."""
    monkeypatch.setattr("strandlake.llm.line_dedup.STAR", 3)
    r = random.Random(6)
    rows, doc = [], 0
    for _ in range(12):
        line = "".join(r.choice("abcdefghijklmnop ") for _ in range(120)) + "q"
        for _ in range(25):
            at = r.randrange(5, 110)
            line = line[:at] + r.choice("XYZ") + line[at + 1:]
            rows.append((doc, line))
            doc += 1
    r.shuffle(rows)
    got = {(d.doc_id, d.line_no): d.kept for d in line_decisions(make_docs(rows)).collect()}
    assert got == brute(rows)


def pairs_at_the_threshold(n):
    """Pairs of lines of 80 characters that differ in two neighbouring letters: 66 of 82 shingles in common."""
    r = random.Random(9)
    out = []
    while len(out) < n:
        a = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(78))
        a, at = f"q{a}q", r.randrange(10, 68)
        b = a[:at] + "#%" + a[at + 2:]
        both = len(shingles(a) & shingles(b))
        if 0.8 <= both / (len(shingles(a)) + len(shingles(b)) - both) < 0.85:
            out.append((a, b))
    return out


def test_pairs_at_the_threshold_are_found(make_docs):
    pairs = pairs_at_the_threshold(3000)
    docs = make_docs([(2 * i + k, x) for i, pair in enumerate(pairs) for k, x in enumerate(pair)])
    kept = {r.doc_id for r in line_decisions(docs).where("kept").collect()}
    assert kept == {2 * i for i in range(len(pairs))}


def test_a_pair_is_compared_in_its_first_band_only(monkeypatch):
    """Over all bands that two lines share, they are compared exactly once, and found as before."""
    from strandlake.llm import line_dedup
    from strandlake.llm.line_dedup import BANDS, Line, _similar_in_band

    r = random.Random(12)
    base = " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9))) for _ in range(40))
    lines = [base]
    for _ in range(40):
        parts = base.split(" ")
        for _ in range(r.randint(1, 5)):
            parts[r.randrange(len(parts))] = r.choice(["xx", "Straße", "漢字"])
        lines.append(" ".join(parts))
    lines = sorted(set(lines))
    keys, low = line_dedup._signatures(lines)
    assert ((keys.view("u8") >> 60) ^ 8 == list(range(BANDS))).all() and (keys[:, 1:] > keys[:, :-1]).all()
    asked = []
    similar = Line.similar
    monkeypatch.setattr(Line, "similar", lambda x, y, least: asked.append((x.text, y.text)) or similar(x, y, least))
    found, meet = set(), 0
    for band in range(BANDS):
        values = [Line(x, k.tobytes() + s.tobytes(), band) for x, k, s in zip(lines, keys, low)]
        for i in range(len(lines)):
            others = [j for j in range(i + 1, len(lines)) if keys[i, band] == keys[j, band]]
            meet += len(others)
            if others:
                found |= {(i, j) for j, like in zip(others, _similar_in_band(values, i, others, 0.8)) if like}
    assert len(asked) == len(set(asked)) and meet > 2 * len(asked)
    sets = [shingles(x) for x in lines]
    want = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and (keys[i] == keys[j]).any()}
    assert found == want and want


def test_shared_band_keys_equal_brute_force(spark, monkeypatch):
    from collections import Counter

    from strandlake.llm import line_dedup
    from strandlake.llm.base import prepare

    prepare(spark)
    monkeypatch.setattr(line_dedup, "KEYS_AT_ONCE", 64)  # several rounds in a task
    r = random.Random(13)
    rows = [[r.choice([r.randrange(-1 << 63, 1 << 63), 5, -5, r.randrange(300)]) for _ in range(16)] for _ in range(400)]
    packed = [(b"".join(k.to_bytes(8, "little", signed=True) for k in row),) for row in rows]
    nodes = spark.createDataFrame(packed, "bands binary").repartition(3)
    got = [x.bucket for x in line_dedup.shared_keys(nodes).collect()]
    assert sorted(got) == sorted(k for k, n in Counter(k for row in rows for k in row).items() if n > 1)
    assert line_dedup.shared_keys(nodes.limit(0)).count() == 0


def test_lines_of_other_scripts_equal_brute_force(make_docs):
    """Lines within and beyond Latin-1, and lines shorter than a shingle with zeros in them."""
    r = random.Random(14)
    rows = []
    for i in range(40):
        chars = ["abcdefgh ", "éüßñçabc ", "漢字仮名交文書 ", "aé漢я "][i % 4]
        line = "q" + "".join(r.choice(chars) for _ in range(90)) + "q"
        at = r.randrange(20, 70)
        rows += [(3 * i, line), (3 * i + 1, line[:at] + r.choice(["x", "é", "漢"]) + line[at + 1:]), (3 * i + 2, line[:at - 10])]
    rows += [(200, "ab\nab\x00\nab\x00\x00\x00\x00\x00"), (201, "ab\x00\x00\x00\x00\x00\x00\nab"), (202, "é\né\x00\nя")]
    got = {(d.doc_id, d.line_no): d.kept for d in line_decisions(make_docs(rows)).collect()}
    assert got == brute(rows)
