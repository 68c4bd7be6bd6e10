"""Reading a byte-level BPE vocabulary file of the tokenizers library."""

from __future__ import annotations

import json


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable Latin-1 signs for themselves, then letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()
#: For bytes decoded as Latin-1.
TO_LETTERS = {b: c for b, c in LETTERS.items()}
FROM_LETTERS = {ord(c): b for b, c in LETTERS.items()}


def to_bytes(token: str) -> bytes:
    return token.translate(FROM_LETTERS).encode("latin-1")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def special_ids(spec: dict) -> dict[str, int]:
    for t in spec["added_tokens"]:
        if t["lstrip"] or t["rstrip"] or t["single_word"]:
            raise ValueError(f"added token {t['content']!r} has options that are not supported")
    return {t["content"]: t["id"] for t in spec["added_tokens"]}


def check_kind(spec: dict) -> None:
    pre, model = spec["pre_tokenizer"] or {}, spec["model"]
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) \
            or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("a byte-level BPE without normaliser and prefix blank is needed")
