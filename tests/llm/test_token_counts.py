"""Token counts against the library on odd texts."""

from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from quire.llm import token_counts
from quire.llm.common import prepare
from tests.llm.test_text_operators import TEXTS

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [*TEXTS, "▁", " ▁ a▁ b", "a \n b", "\n\n  \n", "  ", "a  \n", "<s>x</s><unk>", "<0x0A>", "\r\n", "x" * 20000 + " ", "plain words here",
       "日本語" * 3000, "﻿a​", " \n", "the\nthe the"]


@pytest.mark.parametrize("hot", [token_counts.HOT_TYPES, 5, 0])
def test_counts_equal_library(spark, monkeypatch, hot):
    prepare(spark)
    monkeypatch.setattr(token_counts, "HOT_TYPES", hot)
    monkeypatch.setattr(token_counts, "CUT_BYTES", 3000)
    rows = [(None if i % 7 == 3 else i // 2, t, "k", 5) for i, t in enumerate(ODD + ODD[4:9])]
    docs = spark.createDataFrame(rows, "key long, text string, row string, n_bytes int").repartition(3)
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = Counter((k, r, len((t or "").encode()), len(model.encode(t or ""))) for k, t, r, _ in rows)
    got = token_counts.count_tokens(docs, PATH)
    assert got.columns == ["key", "row", "n_bytes", "n_tokens"]
    assert Counter(map(tuple, got.collect())) == want


def test_empty_table(spark):
    prepare(spark)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(docs, PATH).collect() == []
