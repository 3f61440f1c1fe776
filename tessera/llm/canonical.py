"""Mapping free-entered values to the entries of reference lists, with unmatched values reported.

Method. A BK-tree over the reference entries under a true edit metric (unrestricted Damerau-Levenshtein, for which the
triangle inequality holds). A search returns every entry within the threshold; the nearest wins. A reference list of a
checked size is broadcast in shards, one tree each; of a larger one, shard after shard is sent to the values, which are
never shuffled or copied for it, and the winners of the shards are merged by an aggregate. Which words around an entry
don't count ("the", "(old)") is learned: a first or last word beside which several entries stand in the values.

Only distinct values that aren't exactly listed are searched, so a value that stands in a third of all rows is searched
once; the answers are joined back by broadcast if they are few, else by a join that adaptive execution splits.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.engine import cut_lineage

#: Entries that are broadcast at most (in all shards), entries of a shard, and answers that are joined by broadcast.
BROADCAST_ENTRIES = 200_000
SHARD_ENTRIES = 20_000
BROADCAST_ANSWERS = 200_000
#: Shards of a larger list that are searched in one plan; after each such round its winners are written down.
ROUND = 16
#: Entries beside which a word must stand to be one that doesn't count, and such words at most.
LEAST_ENTRIES, MAX_AFFIXES = 2, 1_000_000


def fold(text: str) -> str:
    """Without case, accents, blanks and punctuation."""
    return "".join(c for c in unicodedata.normalize("NFKD", text).casefold() if c.isalnum())


def _word(token: str) -> str:
    """A word around an entry, as it is compared: without case and marks, but for brackets."""
    return ("(" if token[0] in "([" else "") + fold(token)


def bare(text: str, before: frozenset[str] = frozenset(), after: frozenset[str] = frozenset()) -> str:
    """The value without the words around it that don't count; at least one word stays."""
    words = text.split()
    while len(words) > 1 and _word(words[0]) in before:
        words = words[1:]
    while len(words) > 1 and (_word(words[-1]) in after or not fold(words[-1])):
        words = words[:-1]
    return " ".join(words)


def readings(text: str) -> list[str]:
    """The folded forms under which a value is looked up, with the words in either order."""
    words = [w for w in re.split(r"[\s,]+", text) if w]
    out = [fold(text)]
    if 1 < len(words) <= 3:
        out += [fold(" ".join(words[i:] + words[:i])) for i in range(1, len(words))]
    return list(dict.fromkeys(f for f in out if f))


def allowed(n: int) -> int:
    """Edits allowed for an entry of n folded characters."""
    return 0 if n <= 3 else 1 if n <= 5 else 2 if n <= 11 else 3


def distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance: insert, delete, replace, swap neighbours. A metric."""
    if a == b:
        return 0
    last: dict[str, int] = {}
    top = len(a) + len(b)
    width = len(b) + 2
    rows = [[top] * width, [top, *range(len(b) + 1)]]
    for i, ca in enumerate(a, 1):
        row = [top, i]
        above = rows[i]
        seen = 0
        for j, cb in enumerate(b, 1):
            k = last.get(cb, 0)
            cost = above[j] + (ca != cb)
            x = above[j + 1] + 1
            if x < cost:
                cost = x
            x = row[j] + 1
            if x < cost:
                cost = x
            if k and seen:
                x = rows[k][seen] + (i - k - 1) + 1 + (j - seen - 1)
                if x < cost:
                    cost = x
            row.append(cost)
            if ca == cb:
                seen = j
        last[ca] = i
        rows.append(row)
    return rows[-1][-1]


class Tree:
    """BK-tree: each node's children lie at distinct distances from it."""

    def __init__(self, words: list[str]):
        self.root: tuple[str, dict] | None = None
        self.longest = max(map(len, words), default=0)
        for w in sorted(set(words)):
            self._add(w)

    def _add(self, w: str) -> None:
        if self.root is None:
            self.root = (w, {})
            return
        node = self.root
        while True:
            d = distance(w, node[0])
            if d == 0:
                return
            if d not in node[1]:
                node[1][d] = (w, {})
                return
            node = node[1][d]

    def within(self, w: str, r: int) -> list[tuple[int, str]]:
        """Every word at a distance of r at most."""
        if len(w) - r > self.longest:
            return []  # longer by more than r edits than any word
        out, todo = [], [self.root] if self.root else []
        while todo:
            word, children = todo.pop()
            d = distance(w, word)
            if d <= r:
                out.append((d, word))
            todo += [c for k, c in children.items() if d - r <= k <= d + r]
        return out


@dataclass(frozen=True)
class Entry:
    key: str
    name: str
    #: its initials, if they mean this entry alone
    short: str | None = None


class Shard:
    """Some of the entries; several names may have one key, and several entries one folded form."""

    def __init__(self, entries: list[Entry]):
        self.by_form: dict[str, list[Entry]] = {}
        self.short: dict[str, Entry] = {}
        for e in sorted(entries, key=lambda e: (e.key, e.name)):
            self.by_form.setdefault(fold(e.name), []).append(e)
            if e.short:
                self.short.setdefault(e.short, e)
        self.tree = Tree([f for f in self.by_form if f])

    def best(self, value: str, before: frozenset[str] = frozenset(), after: frozenset[str] = frozenset()) -> tuple[int, int, str] | None:
        """(distance, distance as written, key) of the nearest entry within its threshold."""
        whole = " ".join(value.split())
        found: list[tuple[int, int, str]] = []
        for text in dict.fromkeys((bare(value, before, after), whole)):
            for turn, form in enumerate(readings(text)):
                if turn == 0 and form in self.short:
                    found.append((0, 1, self.short[form].key))
                hits = [(0, form)] if form in self.by_form else self.tree.within(form, allowed(len(form) + 1))
                for d, word in hits:
                    if d <= allowed(min(len(word), len(form) + 1)) and (turn == 0 or d <= 2):
                        found += [(d, distance(text, e.name), e.key) for e in self.by_form[word]]
        return min(found, default=None)


def _entries(ref: DataFrame, key_col: str, name_cols: list[str], initials: bool) -> DataFrame:
    """(key, name, form, short): the entries; short are initials that no other key's names have in the whole list."""
    names = F.explode(F.array_distinct(F.array(*[F.col(c).cast("string") for c in name_cols]))).alias("name")
    out = ref.select(F.col(key_col).cast("string").alias("key"), names).where("key is not null and name is not null").distinct()
    out = out.withColumn("form", _folded("name"))
    if not initials:
        return out.withColumn("short", F.lit(None).cast("string"))
    out = out.withColumn("initials", _initials("name"))
    alone = out.where("initials is not null").groupBy("initials").agg(F.min("key").alias("key"), F.max("key").alias("k")).where("key = k").select("key", "initials", F.col("initials").alias("short"))
    return out.join(alone, ["key", "initials"], "left").select("key", "name", "form", "short")


def _per_value(of: Callable[[str], object], kind: T.DataType) -> Callable[[str], Column]:
    @F.pandas_udf(kind)
    def each(values: pd.Series) -> pd.Series:
        return values.map(of)

    return each


def _folded(col: str) -> Column:
    return _per_value(fold, T.StringType())(col)


def _initials(col: str) -> Column:
    return _per_value(lambda n: "".join(x[0] for x in w).casefold() if len(w := n.split()) > 1 else None, T.StringType())(col)


def _cut(v: str) -> list[dict]:
    """What a value is without its first and without its last word."""
    words = v.split()
    if len(words) < 2:
        return []
    ends = (("before", words[0], words[1:]), ("after", words[-1], words[:-1]))
    return [{"side": s, "word": _word(w), "form": fold(" ".join(rest))} for s, w, rest in ends if _word(w)]


def _cuts(col: str) -> Column:
    parts = T.StructType().add("side", "string").add("word", "string").add("form", "string")
    return _per_value(_cut, T.ArrayType(parts))(col)


def affixes(values: DataFrame, entries: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """The words before and after entries that don't count: those beside which at least LEAST_ENTRIES entries stand."""
    cut = values.where("value like '% %'").select(F.explode(_cuts("value")).alias("c")).select("c.*").where("form <> ''")
    forms = entries.where("form <> ''").select("key", "form").distinct()
    seen = cut.distinct().join(forms, "form").groupBy("side", "word").agg(F.count_distinct("key").alias("n")).where(F.col("n") >= LEAST_ENTRIES)
    rows = seen.select("side", "word").limit(MAX_AFFIXES + 1).collect()
    if len(rows) > MAX_AFFIXES:
        raise ValueError(f"more than {MAX_AFFIXES} words beside entries")
    return tuple(frozenset(r["word"] for r in rows if r["side"] == side) for side in ("before", "after"))


def _searched(values: DataFrame, shards: list[list[tuple]], around: tuple[frozenset[str], frozenset[str]]) -> DataFrame:
    """(value, best) with the nearest entry of some shards, best null where none is near enough; a narrow stage."""
    sent = values.sparkSession.sparkContext.broadcast((shards, around))
    cache: list[Shard] = []

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not cache:
            cache.extend(Shard([Entry(*e) for e in s]) for s in sent.value[0])
        before, after = sent.value[1]
        for b in batches:
            best = [min((x for s in cache if (x := s.best(v, before, after))), default=(None, None, None)) for v in b["value"]]
            got = pd.DataFrame(best, columns=["d", "w", "key"]).astype({"d": "Int64", "w": "Int64", "key": object})
            got.insert(0, "value", b["value"].to_numpy())
            yield got

    return values.select("value").mapInPandas(search, "value string, d long, w long, key string")


def nearest(values: DataFrame, ref: DataFrame, key_col: str, name_cols: list[str], initials: bool = False, words: tuple[str, ...] = (), broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """(value, ref_key) for the distinct column value; ref_key is '' where no entry is near enough.

    The nearest entry within the threshold wins; of equally near ones the nearest as written (case and accents), then
    the lowest key. words: words before or after an entry that don't count, beside those that are learned. Null values
    give no row. An empty reference list matches nothing.
    """
    values = values.where("value is not null")
    entries = _entries(ref, key_col, name_cols, initials).persist()
    before, after = affixes(values, entries)
    around = (before | {_word(w) for w in words}, after | {_word(w) for w in words})
    taken = entries.select("key", "name", "short").limit(broadcast_entries + 1).collect()
    if len(taken) <= broadcast_entries:
        rows = sorted(map(tuple, taken))
        shards = [rows[i : i + SHARD_ENTRIES] for i in range(0, len(rows), SHARD_ENTRIES)]
        return _searched(values, shards, around).select("value", F.coalesce("key", F.lit("")).alias("ref_key"))
    n = -(-entries.count() // SHARD_ENTRIES)
    sharded = entries.select("key", "name", "short", F.pmod(F.xxhash64("key", "name"), F.lit(n)).alias("shard"))
    winners = None
    for first in range(0, n, ROUND):
        for i in range(first, min(n, first + ROUND)):
            part = _searched(values, [sorted(map(tuple, sharded.where(F.col("shard") == i).drop("shard").collect()))], around)
            winners = part if winners is None else winners.unionByName(part)
        best = F.min(F.when(F.col("d").isNotNull(), F.struct("d", "w", "key"))).alias("best")
        winners = winners.groupBy("value").agg(best).select("value", "best.d", "best.w", "best.key")
        if first + ROUND < n:
            winners = cut_lineage(winners)
    return winners.select("value", F.coalesce("key", F.lit("")).alias("ref_key"))


def with_keys(rows: DataFrame, on: list[str], answers: DataFrame) -> DataFrame:
    """rows and the ref_key of their value; on: the columns of the answers that tell the value."""
    answers = answers.persist()
    few = answers.limit(BROADCAST_ANSWERS + 1).count() <= BROADCAST_ANSWERS
    return rows.join(F.broadcast(answers) if few else answers, on)
