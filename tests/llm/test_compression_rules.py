import base64
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from strandlake.llm.compression_rules import quality, repeated_words
from llm_fixtures import make_docs  # noqa: F401, E402

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_repeats(words, size=5):
    seen = {}
    for i in range(len(words) - size + 1):
        seen.setdefault(tuple(words[i:i + size]), []).append(i)
    hit = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(size)}
    return len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_repeats(words):
    assert repeated_words(words) == plain_repeats(words)


def test_rows(make_docs):
    r = random.Random(7)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(900)]
    fine = " ".join(r.choices(words, k=700))
    rows = [(0, fine), (1, None), (2, ""), (3, "too short"), (4, "spam and eggs " * 300),
            (5, "x " + base64.b64encode(r.randbytes(9000)).decode() + " one two three four five six seven eight nine ten"),
            (6, "a b \x1cc\n\n#x\nb c\nb c\n#x |<>&%$*"), (None, fine), (7, "".join(f"{i:x}=" + "ab" * 60 + " " for i in range(300)))]
    out = {r.doc_id: r for r in quality(make_docs(rows)).collect()}
    for d, t in rows:
        t = t or ""
        found = WORDS.findall(t)
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        x = out[d]
        assert (x.n_words, x.word_chars) == (len(found), sum(map(len, found)))
        assert x.n_symbols == sum(t.count(c) for c in "#*$%&|<>")
        assert x.n_dup_lines == len(lines) - len(set(lines))
        assert x.n_repeat_words == plain_repeats(found)
        assert x.base_failed == (len(found) < 10 or 100 * x.n_repeat_words > 20 * len(found))
        assert not (x.base_failed and x.kept)
    assert [out[k].kept for k in (0, None, 1, 2, 3, 4, 5, 7)] == [True, True, False, False, False, False, False, False]
    assert quality(make_docs([])).count() == 0


def test_short_tail_is_judged(make_docs):
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 9))) for _ in range(900)]
    body = " ".join(r.choices(words, k=900))[:4096]
    prose = " ".join(r.choices(words, k=300))
    noise = base64.b85encode(r.randbytes(2000)).decode()
    tails = {1: prose[:1000], 2: "ab" * 500, 3: prose[:200], 4: "c" * 200, 5: prose[:60], 6: noise[:1000]}
    out = {x.doc_id: x for x in quality(make_docs([(k, body + t) for k, t in tails.items()])).collect()}
    assert {k: x.bad_chunks for k, x in out.items()} == {1: 0.0, 2: 0.5, 3: 0.0, 4: 0.5, 5: 0.0, 6: 0.5}
    assert {k for k, x in out.items() if x.kept} == {1, 3, 5}


LENGTHS = (150, 200, 300, 600, 1000, 2000, 3000, 4000, 6000, 20_000)


def test_noise_is_rejected_at_every_length(make_docs):
    """Random bytes in bases 64 and 85, cut into words so that the base rule does not decide."""
    r = random.Random(11)
    rows = []
    for n in LENGTHS:
        for write in (base64.b64encode, base64.b85encode):
            for _ in range(6):
                text = write(r.randbytes(n)).decode()[:n]
                rows.append((len(rows), " ".join(text[i:i + 12] for i in range(0, n, 13))[:n]))
    out = quality(make_docs(rows)).collect()
    assert [x.doc_id for x in out if x.base_failed] == [] and [x.doc_id for x in out if x.kept] == []


def test_good_texts_of_the_same_lengths_are_kept(spark, make_docs):
    """Cuts of the given texts that are labelled good: at most 1 in 100 is out of its band."""
    data = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{data}/documents.parquet").join(
        spark.read.parquet(f"{data}/labels.parquet").where("quality = 1"), "doc_id").select("text").collect()
    r = random.Random(5)
    rows = []
    for n in LENGTHS:
        for (text,) in good:
            if len(text) >= n:
                at = r.randrange(len(text) - n + 1)
                rows.append((len(rows), text[at:at + n]))
    out = [x for x in quality(make_docs(rows)).collect() if not x.base_failed]
    assert len(out) > 300 and sum(not x.kept for x in out) <= 0.01 * len(out)
