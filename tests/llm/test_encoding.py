import pytest

from tessera.llm.encoding import PAGES, Model, contexts, decode_spans, garbled, learn, spans, to_bytes

SENTENCES = ["Opponent’s limit – by “Mêlée” — ½ at Lüster", "Ábrimir Éloki Ãndri Âthwin", "Kôrbo, Mûrdastá, Halvéni, Dûnreth, Càrholm, façade, naïve, Rúmo, Sîlver, Tüs, fjörd, Vaëm", "Ночной паром", "Φύλακας"]


def model():
    from collections import Counter

    c = Counter()
    for s in SENTENCES:
        for t in contexts(s):
            c[t] += 40
    return Model(c)


def misread(text, page):
    table = {b: c for c, b in to_bytes(page).items()}
    if any(b > 127 and b not in table for b in text.encode()):
        pytest.skip("the page can't show all bytes")
    return "".join(chr(b) if b < 128 else table[b] for b in text.encode())


M = model()


@pytest.mark.parametrize("page", PAGES)
@pytest.mark.parametrize("text", SENTENCES[:3])
def test_misread_utf8_is_restored(page, text):
    assert M.restore(misread(text, page)) == text


def test_twice_misread():
    assert M.restore(misread(misread("Mêlée of Kôrbo", "cp1252"), "cp1252")) == "Mêlée of Kôrbo"


def test_one_passage_only():
    whole = "Halvéni here. Mêlée there. Dûnreth too."
    assert M.restore(whole.replace("Mêlée", misread("Mêlée", "mac_roman"))) == whole


@pytest.mark.parametrize(("page", "read_as"), [("cp1252", "mac_roman"), ("mac_roman", "cp1252")])
def test_single_byte_text_read_as_another(page, read_as):
    for text in ("Mûrdastá Half-hand", "Opponent’s limit – at Kôrbo", "Sîlver fjörd"):
        assert M.restore(text.encode(page).decode(read_as)) == text


@pytest.mark.parametrize("text", [*SENTENCES, "", "plain", "Ãndri", "Âthwin ½", "a © b", "naïve façade", "Еіsel", "Оѕkdörіс", "Дальний дозор"])
def test_right_text_stays(text):
    assert M.restore(text) is None


FOREIGN = ["Երևանի քարտեզը", "שלום עולם טוב", "夜の渡し船が出ます", "საქართველოს რუკა"]


@pytest.mark.parametrize("page", PAGES)
@pytest.mark.parametrize("text", FOREIGN)
def test_letters_that_the_corpus_lacks(text, page):
    if page == "cp1257" and text.startswith("ש"):
        pytest.skip("the garbled text is as well formed under cp1252")
    assert M.restore(misread(text, page)) == text
    assert M.restore(text) is None


def test_one_rare_letter_does_not_keep_the_rest_garbled():
    text = "Mêlée of Kôrbo, Mûrdastá — Halvéni and ჟ, Dûnreth, Càrholm"
    for page in ("cp1252", "mac_roman", "cp850"):
        assert M.restore(misread(text, page)) == text
    # too little speaks for the rare letters here: they stay, the rest is decoded
    text = misread("Mêlée ჟ ж", "cp1252")
    assert M.restore(text).startswith("Mêlée ")


@pytest.mark.parametrize("text", ["сабтек хабат", "Сёма ёж СЁ", "Съешь же ещё этих мягких французских булок, да выпей чаю", "рабочая тетрадь, саботаж, сапфир, тайна", "Φύλακας ΎΈ", "Ölüß Ãß Žß"])
def test_right_text_that_the_corpus_lacks_stays(text):
    from collections import Counter

    assert Model(Counter(t for s in SENTENCES[:3] for t in contexts(s))).restore(text) is None


def test_lost():
    assert M.restore("M�rdast�") == "" and M.restore("Mûr � x") == ""


def test_automaton():
    assert spans([0xC3, 0xA9, -1, 0xE2, 0x80, 0x99, 0xC3, 0xA9]) == [(0, 2), (3, 8)]
    assert spans([0xC0, 0x80]) == spans([0xED, 0xA0, 0x80]) == spans([0xE2, 0x80]) == spans([0xF5, 0x80, 0x80, 0x80]) == []
    for o in (0x80, 0x7FF, 0x800, 0xFFFF, 0x10000, 0x10FFFF, 0xD7FF, 0xE000):
        b = list(chr(o).encode())
        assert spans(b) == [(0, len(b))]
    d = decode_spans("cafÃ© Ã", "cp1252")
    assert (d.text, d.got, d.was, d.now) == ("café Ã", ["é"], [3, 4], [3])
    assert decode_spans("café", "cp1252") is None


def test_table(spark, rows):
    data = [(i, s, None, "x") for i, s in enumerate(SENTENCES * 8)]
    bad = misread("Mûrdastá", "cp1252")
    data += [(100, bad, "", "r"), (100, bad, "", "r"), (101, None, "KÃ´rbo �", "r"), (102, "plain", misread("Mêlée ", "cp850") * 40_000, "r")]
    df = spark.createDataFrame(data, "id long, name string, text string, raw string")
    got = {(r["id"], r["field"]): r["restored"] for r in garbled(df, "id", ["name", "text"]).collect()}
    assert got == {(100, "name"): "Mûrdastá", (101, "text"): "", (102, "text"): "Mêlée " * 40_000}
    assert garbled(df, "id", ["name", "text"]).where("id = 100").count() == 2
    assert garbled(df.limit(0), "id", ["name"]).collect() == []
    assert learn(df.limit(0), ["name"]).n3 == {}


@pytest.mark.parametrize("page", PAGES)
@pytest.mark.parametrize("times", [1, 2])
@pytest.mark.parametrize("text", ["Grüße", "Łódź", "Москва", "Ελλάδα", "東京都", "Ärger", "naïve Œuvre"])
def test_structure_decides_without_any_statistics(text, times, page):
    bad = text
    for _ in range(times):
        bad = misread(bad, page)
    assert Model({}).restore(bad) == text
    assert Model({}).restore(text) is None


@pytest.mark.parametrize("text", ["CAFÉ™ and OLÉ®", "»Ähnlich«, “Éloki”, ‘à la’", "4½ m², 20 °C, 5 €", "ĐÀ NẴNG", "Straße… “Spaß”", "L’Œuvre – déjà-vu"])
def test_right_text_without_statistics_stays(text):
    assert Model({}).restore(text) is None


def test_what_is_restored_was_garbled():
    """The restored text, misread as the page again, gives the garbled text."""
    for text in SENTENCES:
        for page in ("cp1252", "mac_roman", "cp437", "cp1250"):
            got = M.restore(misread(text, page))
            assert misread(got, page) == misread(text, page)
