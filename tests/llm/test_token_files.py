import random
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandlake.llm import pfor
from llm_fixtures import make_docs  # noqa: F401, E402

tokenizers = pytest.importorskip("tokenizers")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=300), st.sampled_from([1, 7, 64, 1024]),
       st.sampled_from([0, 50, 95, 100]))
def test_round_trip(ids, block, percentile):
    payload = pfor.pack(np.array(ids, np.int64), block, percentile)
    assert pfor.unpack(payload).tolist() == ids
    for k in range(pfor.block_count(payload)):
        assert pfor.unpack_block(payload, k).tolist() == ids[k * block:(k + 1) * block]


def test_outliers_cost_little():
    ids = np.array([5] * 1000 + [4_000_000_000] + [9] * 1000)
    assert len(pfor.pack(ids)) < 1400


def test_files(make_docs):
    from strandlake.llm import token_files, vocabulary

    library = tokenizers.Tokenizer.from_file(vocabulary.default_path())
    r = random.Random(2)
    rows = [(i * 3, " ".join(r.choice(["alpha", "beta", "x", "é"]) for _ in range(r.randint(0, 40)))) for i in range(120)]
    rows += [(None, "no id"), (1, None), (2, ""), (4, "again"), (4, "again")]
    r.shuffle(rows)
    got = token_files.token_files_round_trip(make_docs(rows), chunk_ids=64).collect()
    at, want = 0, []
    for d, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((d, at, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    key = lambda x: x[1]
    assert sorted([tuple(x) for x in got], key=key) == want
    assert token_files.token_files_round_trip(make_docs([])).count() == 0


def test_blocks_of_one_width_are_packed_together(monkeypatch):
    ids = np.random.default_rng(3).integers(0, 50_000, 64 * 1024 + 77)
    ids[::50] = (1 << 32) - 1 - ids[::50]  # exceptions
    calls, pack_bits = [], np.packbits
    monkeypatch.setattr(np, "packbits", lambda *a, **k: calls.append(1) or pack_bits(*a, **k))
    payload = pfor.pack(ids)
    assert len(calls) <= 4  # not one call a block
    assert (pfor.unpack(payload) == ids).all() and pfor.unpack_block(payload, 64).tolist() == ids[64 * 1024:].tolist()
    calls.clear()
    bounds, unpack_bits = [], np.unpackbits
    monkeypatch.setattr(np, "unpackbits", lambda *a, **k: bounds.append(1) or unpack_bits(*a, **k))
    assert (pfor.unpack(payload) == ids).all() and len(bounds) + len(calls) <= 4
