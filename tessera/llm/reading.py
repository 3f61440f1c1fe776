"""Reading level of each document.

Method. Interpolated n-gram models (bigram, unigram, and a pool of all levels) are trained on the labelled documents;
their counts come from Spark aggregates. For each step between two levels there are two models, of the levels up to it
and of those above. Every sentence of a document gets its surprisal under all of them; the document's distribution, over
its whole text, of the difference between the two surprisals of a step is summed up by its median, which says how
surely the document lies above the step. The sum over the steps is its difficulty, and isotonic regression on the labels
maps that monotonically to a level. The regression is fitted on out-of-fold difficulties: the counts of a document's own
fold are subtracted from the models that judge it. Wrong labels are outvoted by the pooling of the regression.

Training reads all labelled documents. The vocabulary is bounded (a word stands in a share of the documents, so there are
at most 1 / LEAST_SHARE times as many words as a document has on average); sums by word are, too. Bigrams aren't: up to
SENT_BIGRAMS different ones are sent to the executors, and scoring is a narrow stage over all documents, in arrays. Beyond,
documents are put together in chunks, and each chunk is joined with the counts of its own bigrams; the same arrays give
the same results. The regression is fitted in sorted parts, whose steps are few, and these are pooled again.
"""

from __future__ import annotations

import bisect
import copy
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The levels of a label, rising; any number of them.
LEVELS = (1, 2, 3, 4)
FOLDS = 5
#: Least words of running prose.
LEAST_WORDS = 40
#: A word of fewer training documents than this, or of a smaller share of them, is known by its length only.
LEAST_DOCS, LEAST_SHARE = 3, 0.001
#: Weights of the interpolation: observations that the coarser model counts for.
BACK_BIGRAM, BACK_UNIGRAM = 2.0, 20.0
#: Words that are scored in one go: the documents that hold so many, or one longer document.
CHUNK_WORDS = 100_000
#: Different words whose number a task remembers.
REMEMBERED = 500_000
#: Different bigrams up to which their counts are sent to the executors, and labels up to which these are.
SENT_BIGRAMS, SENT_LABELS = 300_000, 500_000
#: Characters of the documents that are joined with their bigrams in one go, on average.
JOINED_CHARS = 500_000

_TAG = re.compile(r"<[^<>]*>")
_LINK = re.compile(r"https?:\S+")
_ROW = re.compile(r"\|.*\|")
_END = re.compile(r"(?<=[.!?…])\s+|[\r\n\v\f\x85  ]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*|\d+")


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence of the running prose; rows of lists (fields between bars) are none."""
    plain = _LINK.sub(" ", _TAG.sub("\n", text))
    out = []
    for s in _END.split(plain):
        if not _ROW.search(s) and (words := _WORD.findall(s)):
            out.append(words)
    return out


def n_words(parts: list[list[str]]) -> int:
    return sum(not w[0].isdigit() for p in parts for w in p)


def _norm(w: str) -> str:
    return "0" if w[0].isdigit() else w.casefold()


def coarse(w: str, vocabulary: dict[str, int] | frozenset[str]) -> str:
    """The word, or for an unknown one the class of its length and of a capital."""
    n = _norm(w)
    return n if n in vocabulary else f"<{'A' if w[0].isupper() else 'a'}{min(len(w) // 3, 6)}>"


class Numbers:
    """The numbers of words; '' begins a sentence."""

    def __init__(self, number: dict[str, int]):
        self.number = number
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> list[int]:
        out = []
        for w in words:
            i = self.known.get(w)
            if i is None:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                i = self.known[w] = self.number[coarse(w, self.number)]
            out.append(i)
        return out

    def bigrams(self, docs: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The first and the second word of every bigram of the documents, and where each sentence begins."""
        first: list[int] = []
        second: list[int] = []
        starts: list[int] = []
        for parts in docs:
            for words in parts:
                starts.append(len(second))
                ids = self.of(words)
                first.append(0)
                first += ids[:-1]
                second += ids
        return np.array(first, dtype=np.int64), np.array(second, dtype=np.int64), starts


def numbered(vocabulary: frozenset[str]) -> dict[str, int]:
    classes = [f"<{c}{i}>" for c in "Aa" for i in range(7)]
    return {w: i for i, w in enumerate(["", *classes, *sorted(vocabulary)])}


class Counts:
    """Bigram counts as arrays: first and second word (numbers), and a column of counts for each (fold, level); the
    same by the first and by the second word alone."""

    def __init__(self, vocabulary: frozenset[str], rows: list[tuple[int, int, str, str, int]], levels: tuple[int, ...] = LEVELS):
        number = numbered(vocabulary)
        n = len(number)
        keys, at = np.unique(np.array([number[p] * n + number[w] for _, _, p, w, _ in rows], dtype=np.int64), return_inverse=True)
        by = np.zeros((FOLDS, len(levels), len(keys)))
        place = {k: i for i, k in enumerate(levels)}
        for (fold, level, _, _, count), i in zip(rows, at):
            by[fold, place[level], i] += count
        self._hold(number, levels, keys, by, *(_summed(by, k, n) for k in (keys // n, keys % n)))

    @classmethod
    def of(cls, *arrays) -> Counts:  # noqa: ANN002
        """Of numbers, levels, rising keys, counts, counts by first and by second word (of more bigrams than the keys, maybe)."""
        out = cls.__new__(cls)
        out._hold(*arrays)
        return out

    def _hold(self, number: dict[str, int], levels: tuple[int, ...], keys: np.ndarray, by: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        self.number, self.levels, self.keys, self.by, self.first, self.second = number, levels, keys, by, first, second

    def __len__(self) -> int:
        return len(self.keys)


def _summed(by: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.stack([[np.bincount(at, row, n) for row in fold] for fold in by])


def _steps(by_level: np.ndarray) -> np.ndarray:
    """The counts below each step, then those above."""
    below = np.cumsum(by_level, axis=0)[:-1]
    return np.concatenate([below, by_level.sum(axis=0) - below])


class Model:
    """Surprisal under the interpolated models below and above each step, without one fold (or with all: fold -1)."""

    def __init__(self, counts: Counts, without: int = -1):
        def kept(by: np.ndarray) -> np.ndarray:
            return by.sum(axis=0) - (by[without] if without >= 0 else 0)

        n = len(counts.number)
        self.number, self.keys, self.n = counts.number, counts.keys, n
        self.numbers = Numbers(counts.number)
        self.bigrams = _steps(kept(counts.by))
        second = kept(counts.second)
        self.uni, self.left = _steps(second), _steps(kept(counts.first))
        everything = second.sum(axis=0)
        pooled = (everything + 0.5) / (everything.sum() + 0.5 * (n + 20))
        total = self.uni.sum(axis=1, keepdims=True)
        self.one = (self.uni + BACK_UNIGRAM * pooled) / (total + BACK_UNIGRAM)
        self.steps = len(counts.levels) - 1

    def looking_at(self, keys: np.ndarray, by_level: np.ndarray) -> Model:
        """The same model for texts of which only these bigrams (rising) were seen in training."""
        out = copy.copy(self)
        out.keys, out.bigrams = keys, _steps(by_level)
        return out

    def surprisal(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """-log of the probability of each second word after the first, a row for each model."""
        keys = first * self.n + second
        seen: np.ndarray | float = 0.0
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            seen = np.where(self.keys[at] == keys, self.bigrams[:, at], 0.0)
        return -np.log((seen + BACK_BIGRAM * self.one[:, second]) / (self.left[:, first] + BACK_BIGRAM))

    def documents(self, docs: list[list[list[str]]]) -> list[float]:
        """The difficulty of each document, given as the words of its sentences: at least one sentence each."""
        out: list[float] = []
        if not docs:
            return out
        first, second, starts = self.numbers.bigrams(docs)
        s = self.surprisal(first, second)
        by_sentence = np.add.reduceat(s[: self.steps] - s[self.steps :], starts, axis=1)  # how much more above than below
        i = 0
        for parts in docs:
            out.append(_above(by_sentence[:, i : i + len(parts)]))
            i += len(parts)
        return out


def _above(differences: np.ndarray) -> float:
    """How many steps a document lies above: by the median of its distribution of differences at each step."""
    return float((1 / (1 + np.exp(-np.clip(np.median(differences, axis=1), -500, 500)))).sum())


def pooled(blocks: Iterable[tuple[float, float, float, float]]) -> list[list[float]]:
    """Pool adjacent violators: (first place, last place, sum, number) of each step, of such blocks in rising order. Of
    blocks that were pooled in parts it gives what it gives of all points."""
    steps: list[list[float]] = []
    for block in blocks:
        steps.append(list(block))
        while len(steps) > 1 and steps[-2][2] / steps[-2][3] >= steps[-1][2] / steps[-1][3]:
            _, last, y, n = steps.pop()
            steps[-1][1] = last
            steps[-1][2] += y
            steps[-1][3] += n
    return steps


def isotonic(points: list[tuple[float, float]]) -> tuple[list[float], list[float]]:
    """The starts of the steps and their values, rising."""
    by: dict[float, list[float]] = {}
    for x, y in points:
        at = by.setdefault(x, [0.0, 0.0])
        at[0] += y
        at[1] += 1
    steps = pooled((x, x, *by[x]) for x in sorted(by))
    return [s[0] for s in steps], [s[2] / s[3] for s in steps]


def fitted(points: DataFrame) -> tuple[list[float], list[float]]:
    """The isotonic fit of (x, y): sorted parts are pooled by the executors. A step begins half way from the one below, as
    nothing was seen between them."""

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pooled((x, x, y, n) for b in batches for x, y, n in zip(b["x"], b["y"], b["n"]))
        yield pd.DataFrame(rows, columns=["x", "last", "y", "n"], dtype=float)

    by_x = points.groupBy("x").agg(F.sum("y").alias("y"), F.count("*").cast("double").alias("n"))
    parts = by_x.repartitionByRange("x").sortWithinPartitions("x").mapInPandas(pool, "x double, last double, y double, n double")
    steps = pooled(sorted(map(tuple, parts.collect())))
    ends = [s[0] for s in steps[:1]] + [s[1] for s in steps[:-1]]
    return [(a + s[0]) / 2 for a, s in zip(ends, steps)], [s[2] / s[3] for s in steps]


def level_of(x: float, fit: tuple[list[float], list[float]], levels: tuple[int, ...] = LEVELS) -> int:
    """The level at a difficulty; the fit's values are places in levels, between two the nearer one counts."""
    starts, values = fit
    i = bisect.bisect_right(starts, x) - 1
    return levels[min(len(levels) - 1, max(0, math.floor(values[max(i, 0)] + 0.5)))]


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int | None, levels: tuple[int, ...]) -> DataFrame:
    """(id, text, level, fold): one row a labelled document, the lowest of its most frequent levels."""
    votes = labels.select(F.col("doc_id").alias("id"), F.col("band").cast("int").alias("level")).where(F.col("level").isin(*levels) & F.col("id").isNotNull()).groupBy("id", "level").count()
    one = votes.groupBy("id").agg(F.min(F.struct((-F.col("count")).alias("c"), "level")).alias("b")).select("id", "b.level")
    if most is not None:
        one = one.orderBy(F.xxhash64("id"), "id").limit(most)
    if one.count() <= SENT_LABELS:
        one = F.broadcast(one)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # of documents that share an id one counts, so that no label weighs twice
    return text.join(one, "id").groupBy("id", "level").agg(F.min("text").alias("text")).withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int"))


def _chunks(batches: Iterable[pd.DataFrame], names: tuple[str, ...], least: int = 0) -> Iterator[tuple[list[tuple], list[list[list[str]]]]]:
    """The named columns and the sentences of documents with least words and one sentence, CHUNK_WORDS words at a time.
    The number of words is one more column."""
    for b in batches:
        rows, held, size = [], [], 0
        for text, *row in zip(b["text"], *(b[c] for c in names)):
            parts = sentences(text)
            if parts and (n := n_words(parts)) >= least:
                rows.append((*row, n))
                held.append(parts)
                size += sum(map(len, parts))
                if size >= CHUNK_WORDS:
                    yield rows, held
                    rows, held, size = [], [], 0
        if rows:
            yield rows, held


def _joined(data: DataFrame, keep: tuple[str, ...], kind: str, counts: Counts, bigrams: DataFrame, least: int = 0) -> DataFrame:
    """(keep, n_words, x) of every row of data (text, fold, keep), x being its difficulty without its fold, where there are
    more bigrams than executors can hold: chunks of documents meet the counts of their bigrams."""
    n, n_levels = len(counts.number), len(counts.levels)
    sent = data.sparkSession.sparkContext.broadcast(counts)  # the sums by word
    n_chars = data.agg(F.sum(F.length("text"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("text", *keep), F.lit(max(1, math.ceil(n_chars / JOINED_CHARS))))
    docs = data.select("fold", chunk.alias("chunk"), "text", *keep).repartition("fold", "chunk").groupBy("fold", "chunk", "text", *keep).agg(F.count("*").alias("times"))

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = Numbers(sent.value.number)
        for b in batches:
            for (fold, part), of in b.groupby(["fold", "chunk"]):
                for _, held in _chunks([of], ()):
                    first, second, _ = numbers.bigrams(held)
                    yield pd.DataFrame({"fold": fold, "chunk": part, "key": np.unique(first * n + second)})

    needed = docs.select("fold", "chunk", "text").mapInPandas(keys, "fold int, chunk long, key long").distinct()
    others = [sum(F.when(F.col("fold") == f, F.lit(0)).otherwise(F.col(f"c{f * n_levels + k}")) for f in range(FOLDS)) for k in range(n_levels)]
    found = needed.join(bigrams, "key").select("fold", "chunk", "key", *[c.alias(f"l{k}") for k, c in enumerate(others)])
    cache: dict[int, Model] = {}

    def score(key: tuple, mine: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        fold = int(key[0])
        if fold not in cache:
            cache[fold] = Model(sent.value, without=fold)
        seen = seen.sort_values("key")
        model = cache[fold].looking_at(seen["key"].to_numpy(np.int64), np.stack([seen[f"l{k}"].to_numpy(float) for k in range(n_levels)]))
        out = [(*row, x) for rows, held in _chunks([mine], (*keep, "times"), least) for row, x in zip(rows, model.documents(held))]
        return pd.DataFrame(out, columns=[*keep, "times", "n_words", "x"])

    scored = docs.groupBy("fold", "chunk").cogroup(found.groupBy("fold", "chunk")).applyInPandas(score, f"{kind}, times long, n_words int, x double")
    return scored.withColumn("time", F.explode(F.sequence(F.lit(1), "times"))).select(*keep, "n_words", "x")


def _trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int | None, levels: tuple[int, ...]) -> tuple[Counts, tuple[list[float], list[float]], DataFrame | None]:
    """The counts, the isotonic fit, and the table of bigrams if they are more than the counts hold."""
    data = _labelled(docs, labels, id_col, text_col, most, levels).persist()
    n_docs = data.count()

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c = Counter(w for t in b["text"] for w in {_norm(w) for s in sentences(t) for w in s})
            if c:
                yield pd.DataFrame({"w": list(c.keys()), "n": list(c.values())})

    least = max(LEAST_DOCS if n_docs >= 30 else 1, math.ceil(LEAST_SHARE * n_docs))
    number = numbered(frozenset(r["w"] for r in data.select("text").mapInPandas(words, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect()))
    n, n_levels = len(number), len(levels)
    place = {k: i for i, k in enumerate(levels)}
    slots = FOLDS * n_levels

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = Numbers(number)
        for rows, held in _chunks(batches, ("level", "fold")):
            first, second, _ = numbers.bigrams(held)
            slot = np.repeat([fold * n_levels + place[level] for level, fold, _ in rows], [sum(map(len, parts)) for parts in held])
            got, times = np.unique((first * n + second) * slots + slot, return_counts=True)
            yield pd.DataFrame({"key": got // slots, "slot": got % slots, "n": times})

    columns = [f"c{i}" for i in range(slots)]

    def arrays(table: DataFrame, by: str) -> tuple[np.ndarray, np.ndarray]:
        got = table.toArrow().sort_by(by)
        return got[by].to_numpy(), np.stack([got[c].to_numpy().astype(float) for c in columns]).reshape(FOLDS, n_levels, -1)

    def sums(table: DataFrame, by: str) -> np.ndarray:
        at, held = arrays(table.groupBy(F.expr(by).cast("long").alias("at")).agg(*[F.sum(c).alias(c) for c in columns]), "at")
        out = np.zeros((FOLDS, n_levels, n))
        out[:, :, at] = held
        return out

    one = [F.sum(F.when(F.col("slot") == i, F.col("n")).otherwise(F.lit(0))).alias(c) for i, c in enumerate(columns)]
    bigrams = data.mapInPandas(grams, "key long, slot int, n long").groupBy("key").agg(*one).persist()
    many = bigrams.count() > SENT_BIGRAMS
    if many:
        counts = Counts.of(number, levels, np.zeros(0, np.int64), np.zeros((FOLDS, n_levels, 0)), sums(bigrams, f"key div {n}"), sums(bigrams, f"key % {n}"))
    else:
        keys, by = arrays(bigrams, "key")
        counts = Counts.of(number, levels, keys, by, *(_summed(by, k, n) for k in (keys // n, keys % n)))
        bigrams.unpersist()
        if not len(counts):
            data.unpersist()
            return counts, ([], []), None
    sent = docs.sparkSession.sparkContext.broadcast(counts)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models: dict[int, Model] = {}
        for rows, held in _chunks(batches, ("level", "fold")):
            for fold in sorted({f for _, f, _ in rows}):
                if fold not in models:
                    models[fold] = Model(sent.value, without=fold)
                own = [(level, parts) for (level, f, _), parts in zip(rows, held) if f == fold]
                xs = models[fold].documents([parts for _, parts in own])
                yield pd.DataFrame({"x": xs, "y": [float(place[level]) for level, _ in own]})

    if many:
        at = F.array_position(F.array(*map(F.lit, levels)), F.col("level")) - 1
        points = _joined(data, ("level",), "level int", counts, bigrams).select("x", at.cast("double").alias("y"))
    else:
        points = data.mapInPandas(judge, "x double, y double")
    fit = fitted(points)
    data.unpersist()
    return counts, fit, bigrams if many else None


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int | None = None, levels: tuple[int, ...] = LEVELS) -> tuple[Counts, tuple[list[float], list[float]]]:
    """The counts and the isotonic fit, of all labelled documents unless the caller wants at most some. Of more than
    SENT_BIGRAMS bigrams the counts hold the sums by word only."""
    counts, fit, _ = _trained(docs, labels, id_col, text_col, most, levels)
    return counts, fit


def reading_levels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS, most_labelled: int | None = None, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(id_col, n_words, difficulty, band) of every document with at least least_words words of running prose.

    Null, empty, blank and short texts and lists that are no prose give no row. Repeated rows each give a row; equal
    texts get equal bands. Texts are read whole. Without any usable label nothing can be said: an empty result. Extra
    columns are ignored, whatever their names. All labelled documents count, unless the caller wants at most some.
    """
    src = docs.select(F.col(id_col).alias("rid"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["rid"].dataType.simpleString()
    schema = f"rid {kind}, n_words int, difficulty double, band int"
    counts, fit, bigrams = _trained(docs, labels, id_col, text_col, most_labelled, levels)
    if not fit[0]:
        return docs.sparkSession.createDataFrame([], schema).withColumnRenamed("rid", id_col)
    src = src.where("text is not null")
    if bigrams is not None:
        scored = _joined(src.withColumn("fold", F.lit(-1)), ("rid",), f"rid {kind}", counts, bigrams, least_words)
        band = F.pandas_udf(lambda xs: xs.map(lambda x: level_of(x, fit, levels)).astype("int32"), "int")
        return scored.select(F.col("rid").alias(id_col), "n_words", F.col("x").alias("difficulty"), band("x").alias("band"))
    sent = docs.sparkSession.sparkContext.broadcast((counts, fit))
    cache: list[Model] = []

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not cache:
            cache.append(Model(sent.value[0]))
        for rows, held in _chunks(batches, ("rid",), least_words):
            got = pd.DataFrame(rows, columns=["rid", "n_words"])
            got["difficulty"] = xs = cache[0].documents(held)
            got["band"] = [level_of(x, sent.value[1], levels) for x in xs]
            yield got

    return src.mapInPandas(score, schema).withColumnRenamed("rid", id_col)
