"""Token ids by the installed tokenizer libraries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strandlake.llm import vocabulary
from strandlake.llm.pretokens import Encoder


class _ByteLevelWords:
    """Words of a byte-level BPE through the library's model, whole texts through ``Encoder``."""

    def __init__(self, path: str, spec: dict):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model, self.pre = tokenizer.model, tokenizer.pre_tokenizer
        self.encoder = Encoder(self.words, vocabulary.special_ids(spec), self.split)
        self.encode = self.encoder.encode

    def words(self, words: list[bytes]) -> list[list[int]]:
        tokenize, letters = self.model.tokenize, vocabulary.TO_LETTERS
        return [[t.id for t in tokenize(w.decode("latin-1").translate(letters))] for w in words]

    def split(self, text: str) -> list[str]:
        return [text[i:j] for _, (i, j) in self.pre.pre_tokenize_str(text)]


class _WholeTexts:
    """Any other file of the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)


class _Pieces:
    """A sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for text in texts:
            yield np.array(self.model.encode(text, num_threads=1), np.int32)


_made: dict[str, object] = {}


def library_encoder(path: str):
    """An object whose ``encode(texts)`` gives the ids of each text without added tokens; read once in a worker."""
    if path not in _made:
        if path.endswith(".model"):
            _made[path] = _Pieces(path)
        else:
            spec = vocabulary.read(path)
            try:
                vocabulary.check_kind(spec)
                _made[path] = _ByteLevelWords(path, spec)
            except ValueError:
                _made[path] = _WholeTexts(path)
    return _made[path]


def token_count(text: Column, path: str | None = None) -> Column:
    """Tokens of a text; null has none."""
    path = path or vocabulary.default_path()

    @F.pandas_udf(LongType())
    def count(values: pd.Series) -> pd.Series:
        return pd.Series([len(ids) for ids in library_encoder(path).encode(values.tolist())], dtype="int64")

    return count(F.coalesce(text, F.lit("")))
