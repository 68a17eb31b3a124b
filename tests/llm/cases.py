"""Fixtures and texts that the tests of this folder share."""

from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of ``(doc_id, text)`` pairs, with extra columns whose names clash with results."""

    def make(rows):
        full = [(i, t, "en" if t else None, None, len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        extra = {c: None for c in ("id", "row", "base", "added", "norm", "words", "hits", "rep", "component_id", "kept", "salt", "length", "ids", "score", "word")}
        from pyspark.sql import functions as F

        return df.withColumns({c: F.lit(v).cast("string") for c, v in extra.items()}).coalesce(3)

    return make


#: Texts that every text operator has to stand.
ODD = [
    None, "", " ", "\n\t\r\x0b\x0c", "\x00", "a", "é", "123", "!!! ???", "KİΣς", "日本語のテキスト", "\U0001f600 \U00010400", "word " * 30000, "x" * 40000,
    "á̀ b", "<|endoftext|> tail", "'s 't don't", "\x85\xa0  z",
]
