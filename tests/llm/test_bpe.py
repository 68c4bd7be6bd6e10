import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tokenizers = pytest.importorskip("tokenizers")

from strandlake.llm import vocabulary  # noqa: E402
from strandlake.llm.bpe import coder, encode_decode  # noqa: E402
from strandlake.llm.library_tokens import library_encoder  # noqa: E402
from llm_fixtures import make_docs  # noqa: F401, E402

PATH = vocabulary.default_path()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
PARTS = ["a", "b", "'s", "'", "'re", "'ll", "ve", " ", "  ", "\n", "\t", "\r\n", "1", "23", "é", "ß", "漢", "字", "!", "...",
         "<|endoftext|>", "Ᲊ", " ", "　", "\x1c", "\x85", "😀", "́", "'t", "'T", "²", "٣", "the", " the", "ing",
         "\x00", "\U000105df", "<|endof", "_"]


def check(text):
    bpe, encoder = coder(PATH)
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert next(iter(encoder.encode([text]))).tolist() == want
    assert next(iter(library_encoder(PATH).encode([text]))).tolist() == want
    assert bpe.decode(np.array(want, np.int64)) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PARTS), max_size=14).map("".join)))
def test_ids_equal_the_library(text):
    check(text)


def test_long_words_and_texts():
    r = random.Random(1)
    check("".join(r.choice("abcdeé") for _ in range(500)))
    check("z" * 3000)
    check(" ".join(r.choice(["the", "it's", "x9", "naïve", "--"]) for _ in range(120_000)))


def test_rows(make_docs):
    rows = [(0, "Hello world, it's <|endoftext|> fine"), (1, None), (2, ""), (None, "é漢"), (3, "twice"), (3, "twice")]
    out = sorted(encode_decode(make_docs(rows), with_ids=True).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for r, (_, text) in zip(out, rows):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert encode_decode(make_docs([])).count() == 0


def opposites(n, a="a", b="b"):
    """Two words in Thue-Morse order, one with the letters of the other exchanged: polynomial hashes take them as equal."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_with_equal_hashes(size):
    one, two = opposites(size)
    three, four = opposites(size, "c", "d")
    for texts in ([f"{one}\n{two}"], [one, two], [two, three, one, four], [f"{three} {four} {one} {three}\n{four}"]):
        want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
        for encoder in (coder(PATH)[1], library_encoder(PATH)):
            for split in (texts, texts[:1], texts):  # in one batch, over batches, and from memory
                assert [x.tolist() for x in encoder.encode(split)] == want[: len(split)]


@pytest.mark.parametrize("keep", [1, 5, 10**6])
def test_any_hash_gives_right_ids(monkeypatch, keep):
    """Even a hash that nearly always collides, and a memory that is emptied all the time."""
    monkeypatch.setattr("strandlake.llm.pretokens.REMEMBERED", keep)
    encoder = coder(PATH)[1]
    encoder.memory.clear()
    plain = encoder.splitter.hashes
    monkeypatch.setattr(encoder.splitter, "hashes", lambda data, at: plain(data, at) % np.uint64(3))
    r = random.Random(keep)
    for _ in range(30):
        texts = ["".join(r.choices(PARTS[:20], k=r.randrange(30))) for _ in range(r.randrange(1, 6))]
        assert [x.tolist() for x in encoder.encode(texts)] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    encoder.memory.clear()


def test_very_long_words():
    for word in ("ab" * 200_000, "漢" * 50_000, "=" * 300_000):
        check(word + " " + word)
