import math
import random
import statistics

import numpy as np
import pytest

from tessera.llm import reading
from tessera.llm.reading import Counts, Model, isotonic, level_of, n_words, sentences, train

EASY = ["The cat is red.", "We play at home.", "Take the big ball now.", "I see a dog."]
PLAIN = ["Most players keep the card because it is cheap.", "After the match both sides count their points again.", "You should think about the road before you end your turn."]
HARD = ["Historical records indicate that preparation requires considerable patience.", "Experienced commentators disagree about whether restrictions influence strategy."]
LEARNED = ["Notwithstanding the antecedent provision, any characterisation presupposes indeterminate applicability.", "Epistemologically considered, the countervailing interpretation substantiates incommensurable precedents."]
BANDS = dict(zip((1, 2, 3, 4), (EASY, PLAIN, HARD, LEARNED)))


def _corpus(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        band = 1 + i % 4
        near = BANDS[max(1, min(4, band + r.choice((-1, 1))))]
        out.append((i, " ".join(r.choice(BANDS[band]) if r.random() < 0.8 else r.choice(near) for _ in range(16)), band))
    return out


def test_sentences():
    assert sentences("<p>One two.</p><p>Three!</p> four\nfive") == [["One", "two"], ["Three"], ["four"], ["five"]]
    assert sentences("A | mp 1 | x\nReal words http://x.y here") == [["Real", "words", "here"]]
    assert n_words(sentences("It's 5 o'clock well-known.")) == 3
    assert sentences("") == [] and sentences("… !!") == []


def test_isotonic_pools_violators():
    starts, values = isotonic([(1, 1), (2, 3), (3, 2), (4, 4), (4, 4)])
    assert starts == [1, 2, 4] and values == [1, 2.5, 4]
    assert isotonic([(0, 2.0), (1, 2.0)]) == ([0], [2.0])
    assert level_of(0.5, (starts, values)) == 2 and level_of(9, (starts, values)) == 4 and level_of(0, ([0], [-1])) == 1


def test_probabilities_sum_to_one():
    counts = Counts(frozenset(["a", "b"]), [(0, 1, "", "a", 3), (0, 1, "a", "b", 2), (1, 4, "", "b", 2)])
    m = Model(counts)
    everything = np.arange(len(counts.number))
    for p in ("", "a", "b"):
        total = np.exp(-m.surprisal(np.full(len(everything), counts.number[p]), everything)).sum(axis=1)
        assert (total <= 1.001).all() and (total > 0.5).all()
    assert Model(counts, without=0).bigrams[0].sum() == 0


def _tables(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, band string, level int")
    return d, spark.createDataFrame(labels, "doc_id long, band int")


def test_held_out_accuracy(spark):
    made = _corpus(400)
    docs, labels = _tables(spark, [(i, t, "x", 0) for i, t, _ in made], [(i, (b if i % 25 else 5 - b)) for i, _, b in made[:200]] + [(3, None), (4, 9), (8, made[8][2])])
    got = {r["doc_id"]: r["band"] for r in reading.reading_levels(docs, labels).collect()}
    held = made[200:]
    assert len(got) == 400 and sum(got[i] == b for i, _, b in held) / len(held) >= 0.95


def test_what_is_no_prose_gives_no_row(spark):
    made = _corpus(60)
    long = " ".join(EASY * 4_000)
    more = [(900, None, "", 0), (901, "", "", 0), (902, " \n ", "", 0), (903, "Too short.", "", 0), (904, "A | b | c\n" * 60, "", 0), (905, long, "", 0), (906, made[0][1], "", 0), (906, made[0][1], "", 0)]
    docs, labels = _tables(spark, [(i, t, "", 0) for i, t, _ in made] + more, [(i, b) for i, _, b in made])
    got = [(r["doc_id"], r["band"]) for r in reading.reading_levels(docs, labels).where("doc_id >= 900").collect()]
    assert sorted(got) == [(905, 1), (906, 1), (906, 1)]


def test_no_labels_or_no_documents(spark):
    docs, labels = _tables(spark, [(1, " ".join(EASY * 10), "", 0)], [(1, 1)])
    assert reading.reading_levels(docs, labels.limit(0)).collect() == []
    assert reading.reading_levels(docs.limit(0), labels).collect() == []
    assert [r["band"] for r in reading.reading_levels(docs, labels).collect()] == [1]


def test_training_is_bounded(spark):
    made = _corpus(80)
    docs, labels = _tables(spark, [(i, t, "", 0) for i, t, _ in made], [(i, b) for i, _, b in made])
    counts, fit = train(docs, labels, most=20)
    assert counts.by[:, :, counts.keys < len(counts.number)].sum() == 20 * 16  # sentences that begin
    assert fit[0] == sorted(fit[0]) and fit[1] == sorted(fit[1])


@pytest.mark.parametrize("text", ["a b.", "A. B! C?\nD"])
def test_arrays_give_what_the_definition_gives(text):
    levels = (1, 2, 3, 4)
    m = Model(Counts(frozenset("abcd"), [(0, k, "", x, 5) for k, x in zip(levels, "abcd")] + [(1, 2, "a", "b", 3)]))
    uni = [{"a": 5}, {"b": 8}, {"c": 5}, {"d": 5}]
    bi = [{("", "a"): 5}, {("", "b"): 5, ("a", "b"): 3}, {("", "c"): 5}, {("", "d"): 5}]

    def log(models, p, w):
        pooled = (sum(u.get(w, 0) for u in uni) + 0.5) / (23 + 0.5 * (len(m.number) + 20))
        u, b = sum(uni[k].get(w, 0) for k in models), sum(bi[k].get((p, w), 0) for k in models)
        one = (u + reading.BACK_UNIGRAM * pooled) / (sum(sum(uni[k].values()) for k in models) + reading.BACK_UNIGRAM)
        left = sum(n for k in models for (q, _), n in bi[k].items() if q == p)
        return math.log((b + reading.BACK_BIGRAM * one) / (left + reading.BACK_BIGRAM))

    parts = sentences(text)
    want = 0.0
    for step in (1, 2, 3):
        ds = []
        for s in parts:
            words = [w.lower() for w in s]
            ds.append(sum(log(range(step, 4), p, w) - log(range(step), p, w) for p, w in zip(["", *words], words)))
        want += 1 / (1 + math.exp(-statistics.median(ds)))
    assert m.documents([parts, parts]) == pytest.approx([want, want])


def test_any_number_of_levels(spark):
    made = _corpus(160)
    docs, labels = _tables(spark, [(i, t, "", 0) for i, t, _ in made], [(i, 10 if b < 3 else 20) for i, _, b in made])
    got = {r["doc_id"]: r["band"] for r in reading.reading_levels(docs, labels, levels=(10, 20)).collect()}
    assert sum(got[i] == (10 if b < 3 else 20) for i, _, b in made) > 150


def test_chunks_change_nothing(spark, monkeypatch):
    made = _corpus(60)
    docs, labels = _tables(spark, [(i, t, "", 0) for i, t, _ in made], [(i, b) for i, _, b in made])
    one = sorted(map(tuple, reading.reading_levels(docs, labels).collect()))
    monkeypatch.setattr(reading, "CHUNK_WORDS", 1)
    assert sorted(map(tuple, reading.reading_levels(docs, labels).collect())) == one


def test_training_takes_all_labelled_documents(spark):
    n = 20_300
    docs = spark.range(n, numPartitions=4).selectExpr("id as doc_id", "concat('Cat sat ', if(id % 2 = 0, 'here', 'beyond')) as text")
    counts, (starts, values) = train(docs, docs.selectExpr("doc_id", "cast(1 + doc_id % 2 as int) as band"))
    assert counts.by[:, :, counts.keys < len(counts.number)].sum() == n  # sentences that begin
    assert counts.by.sum() == 3 * n and values == [0.0, 1.0]


def test_steps_pooled_in_parts_are_those_of_all_points(spark):
    r = random.Random(3)
    points = [(round(r.gauss(k, 2), 2), float(k)) for k in range(4) for _ in range(500)]
    starts, values = isotonic(points)
    ends = [max((x for x, _ in points if x < s), default=s) for s in starts]
    got = reading.fitted(spark.createDataFrame(points, "x double, y double").repartition(7))
    assert len(starts) > 3 and got == ([(a + s) / 2 for a, s in zip(ends, starts)], values)
    assert reading.fitted(spark.createDataFrame([], "x double, y double")) == ([], [])


@pytest.mark.parametrize("chars", [1, 5_000, 10**9])
def test_joined_bigrams_change_nothing(spark, monkeypatch, chars):
    made = _corpus(60)
    more = [(900, None, "", 0), (901, "Too short.", "", 0), (902, "Unseen words only. " * 30, "", 0), (903, made[0][1], "", 0), (903, made[0][1], "", 0), (3, made[3][1], "", 0)]
    docs, labels = _tables(spark, [(i, t, "", 0) for i, t, _ in made] + more, [(i, b) for i, _, b in made])
    one = sorted(map(tuple, reading.reading_levels(docs, labels).collect()))
    fit = train(docs, labels)[1]
    monkeypatch.setattr(reading, "SENT_BIGRAMS", 0)
    monkeypatch.setattr(reading, "SENT_LABELS", 0)
    monkeypatch.setattr(reading, "JOINED_CHARS", chars)
    counts, again = train(docs, labels)
    assert len(counts) == 0 and again == fit
    assert sorted(map(tuple, reading.reading_levels(docs, labels).collect())) == one and len(one) == 64
