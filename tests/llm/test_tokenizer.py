import random

import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from tessera.llm.tokenizer import Encoder, default_vocabulary, encoded, read_merges  # noqa: E402

TEXTS = ["", "Hello world", "  two  spaces\n\nand lines\r\n", "it's we'll THEY'RE don’t", "Mêlée — “½”", "日本語 テスト 😀😀", "<|endoftext|> a", "a" * 3000, " " * 500, "x1234567y", "​﻿ ", "\x00\x01", "ﬁ Ａ", "aaaaabaaab" * 50]


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(str(public.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return Encoder(read_merges(default_vocabulary()))


def test_same_ids_as_the_public_library(encoder, reference):
    r = random.Random(2)
    made = ["".join(r.choice("abc de'\n.1é—") for _ in range(r.randint(0, 60))) for _ in range(500)]
    ids, ends = encoder.encode_batch([*TEXTS, *made])
    for i, e in enumerate(reference.encode_batch([*TEXTS, *made], add_special_tokens=False)):
        assert list(ids[ends[i] : ends[i + 1]]) == e.ids


def test_round_trip(encoder, reference):
    for t in TEXTS:
        assert reference.decode(encoder.encode(t), skip_special_tokens=False) == t


def test_small_lots_and_memory_change_nothing(encoder, monkeypatch):
    from tessera.llm import tokenizer

    e = Encoder(read_merges(default_vocabulary()))
    monkeypatch.setattr(tokenizer, "LAID_OUT", 5)
    monkeypatch.setattr(tokenizer, "REMEMBERED", 3)
    monkeypatch.setattr(tokenizer, "LONGEST", 2)
    for t in TEXTS:
        assert e.encode(t) == encoder.encode(t)


def test_table(spark, reference):
    rows = [(i, t, "k", 1) for i, t in enumerate(TEXTS)] + [(98, None, "k", 2), (99, "dup", "k", 3), (99, "dup", "k", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, rid int")
    got = [(r["doc_id"], r["ids"]) for r in encoded(df, "doc_id", "text").collect()]
    assert sorted(got) == sorted((i, reference.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in rows)
    counts = {(r["doc_id"], r["rid"]): r["n_tokens"] for r in encoded(df, "doc_id", "text", count_only=True, keep=["rid"]).collect()}
    assert counts[98, 2] == 0 and counts[0, 1] == 0 and counts[1, 1] == len(reference.encode("Hello world").ids)
    assert encoded(df.limit(0), "doc_id", "text").collect() == []


def test_very_long_text(encoder, reference):
    t = "Lorem ipsum dolor — sit amet. " * 30_000
    assert encoder.encode(t) == reference.encode(t, add_special_tokens=False).ids
