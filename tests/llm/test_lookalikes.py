import unicodedata
from collections import Counter

import pytest

from tessera.llm.lookalikes import Classes, Rewriter, consistent_forms, count_units, representatives, rewrite_all, units

CORPUS = ["The quick brown fox of Öland jumps over Bêla and éclair", "Half-hand III fi go"] * 5


def form(text):
    return rewrite_all([*CORPUS, text])[-1]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Ｈａｌｆ－ｈａｎｄ", "Half-hand"),
        ("Hаlf‐hand", "Half-hand"),
        ("Hаlf‑hand", "Half-hand"),
        ("H­alf​-﻿hand⁠", "Half-hand"),
        ("Bêla", "Bêla"),
        ("Bе̂la", "Bêla"),
        ("Ｂｅ̂ｌａ", "Bêla"),
        ("quick brown　fox", "quick brown fox"),
        ("Quobanbo Ⅲ", "Quobanbo III"),
        ("Unﬁnished", "Unfinished"),
        ("Gruda＇ѕ Oath", "Gruda's Oath"),
        ("ɑnd ɡo", "and go"),
        ("Ночной паром", "Ночной паром"),
        ("Ночной па​ром", "Ночной паром"),
        ("Φύλακας", "Φύλακας"),
        ("灯籠の渡し", "灯籠の渡し"),
        ("оf the", "of the"),
        ("Ꭺlpha ꓮlpha fⲟo ꜱite", "Alpha Alpha foo Site"),
        ("ⓐbc 𝐀bc a−b", "abc Abc a-b"),
        ("x² ½ ™", "x² ½ ™"),
        ("“a” ½ … – b\nc\td", "“a” ½ … – b\nc\td"),
        ("", ""),
        ("plain", "plain"),
    ],
)
def test_forms(raw, clean):
    assert form(raw) == clean


def test_idempotent_and_long():
    raw = "Hаlf‐hand " * 50_000
    once = form(raw)
    assert once == "Half-hand " * 50_000 and form(once) == once


def test_classes_are_transitive_and_frequency_decides():
    c = Classes()
    for a, b in (("x", "y"), ("y", "z"), ("p", "q")):
        c.union(a, b)
    assert c.find("x") == c.find("z") != c.find("p")
    forms = representatives(Counter({"ɑ": 5, "а": 9, "a": 2}))
    assert forms["а"] in ("ɑ", "a") and set(forms) == {"а"} | ({"a"} if forms["а"] == "ɑ" else {"ɑ"})
    assert representatives(Counter({"a": 50, "а": 1}))["а"] == "a"


def test_ascii_texts_get_the_same_form_as_others():
    assert rewrite_all(["ı ı ı xı", "isi x", "isi Ö", "ısı Ö"]) == ["i i i xi", "isi x", "isi Ö", "isi Ö"]
    w = Rewriter({"i": "ı"})  # whatever stands for a class, it does so in all texts
    assert (w("isi x"), w("isi Ö")) == ("ısı x", "ısı Ö")


def test_units():
    assert list(units("éx")) == ["é", "e", "́", "x"]


def test_rewriter_matches_a_plain_replacement():
    texts = ["Ｂurning ﬁre", "Cаsе", "a b"]
    forms = representatives(Counter(u for t in [*CORPUS, *texts] for u in units(t)))
    w = Rewriter(forms)
    for t in texts:
        plain = t
        for u in sorted(forms, key=len, reverse=True):
            plain = plain.replace(u, forms[u])
        assert w(t) == unicodedata.normalize("NFC", plain)


def test_table(spark, rows):
    data = [(i, CORPUS[0], None, "x") for i in range(5)] + [(9, "brown fоx", "Bеla", "y"), (9, "brown fоx", "Bеla", "y"), (10, None, "", "z")]
    df = spark.createDataFrame(data, "id long, name string, home string, raw string")
    got = rows(consistent_forms(df, "id", ["name", "home"]).where("raw <> clean"))
    assert got == [(9, "home", "Bеla", "Bela"), (9, "home", "Bеla", "Bela"), (9, "name", "brown fоx", "brown fox"), (9, "name", "brown fоx", "brown fox")]
    assert consistent_forms(df.limit(0), "id", ["name"]).collect() == []
    assert count_units(df.limit(0), ["name"]) == {}
