"""Several values packed in one field: infer the delimiters of each source, then split and explode with position.

Plan. (1) Every value is split at each candidate delimiter by itself; for each source, field and delimiter it is
aggregated how many pieces come out, how evenly, and how many of them are regular: of a listed name, of the same type
(integer, decimal, date, code, words by their casing) as others of the value, or a value that stands alone elsewhere in
the field. Words and blanks separate only pieces that are known or strictly typed, as they stand within names too.
(2) A delimiter is accepted for a source if piece-count consistency times type regularity reaches a threshold; small
sources lean on all sources together. (3) Every value is split at the accepted delimiters of its source, outside
quotes, dates and listed names, and exploded.

Nothing is shuffled but the aggregates of (1) and the values that stand alone, which are combined before the exchange; a
source that holds a third of all rows is no more than a third of partial aggregates. The split itself is a narrow,
Arrow-batched stage.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.textform import invisible, is_word, skeleton, skeleton_with_origin

#: Delimiters that are tried, strongest first. Words need blanks around them.
CANDIDATES = (";", "|", "\t", "•", "·", ",", "/", "&", "+", "and", "or", " ", "\n")
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“", "‘": "’", "«": "»", "`": "`"}
BRACKETS = {"[": "]", "(": ")", "{": "}", "<": ">"}

#: A value is known if it stands alone LEAST times.
LEAST = 2
#: Share of a value's pieces that must be of one strict type for a word or a blank to separate them.
STRICT_SHARE = 0.9
#: Sources with few values lean on all sources as if these many values came from them.
PRIOR = 20.0
ACCEPT = 0.5
#: Listed names are sent to the executors in shards of this many, and no more than MAX_NAMES of them.
SHARD, MAX_NAMES = 50_000, 1_000_000
#: Up to this many (source, field) pairs the inferred delimiters are broadcast, beyond they are joined by shuffle.
BROADCAST_SOURCES = 100_000
#: Up to this many values with a line break that are known as a whole are sent to the executors, beyond they are joined.
BROADCAST_LINES = 100_000

#: Types of pieces: what the whole piece matches first. The strict ones can't be a word of a name.
STRICT = (
    ("date", re.compile(r"\d{4}([-/.])\d{1,2}\1\d{1,2}(?:[T ]\d\d:\d\d(?::\d\d)?)?|\d{1,2}([-/.])\d{1,2}\2\d{4}")),
    ("integer", re.compile(r"[+-]?\d+")),
    ("decimal", re.compile(r"[+-]?\d*[.,]\d+(?:[eE][+-]?\d+)?%?")),
    ("code", re.compile(r"(?=[^\W\d_]*[\d_#@.:-])(?=\S*\w)[\w#@.:+-]{2,40}")),
)
_DATE = re.compile(r"(?<![\w/.-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/])")
#: Most words of a piece that is a name or a term; more are prose.
TERM_WORDS = 6

_STRICT = frozenset(n for n, _ in STRICT)
_WORDY = re.compile(r"\w")
_QUOTE = re.compile("[" + "".join(QUOTES) + "]")


@lru_cache(maxsize=64)
def _delimiter(delims: tuple[str, ...]) -> re.Pattern:
    """Matches one delimiter, or a run of them, with the blanks around it."""
    marks = "".join(re.escape(d) for d in delims if not _WORDY.search(d) and d.strip(" "))
    words = "|".join(re.escape(d) for d in delims if _WORDY.search(d))
    alternatives = []
    if marks:
        alternatives.append(rf"[^\S\n\t]*[{marks}](?:\s*[{marks}])*\s*(?:(?:{words})\s+)?" if words else rf"[^\S\n\t]*[{marks}](?:\s*[{marks}])*\s*")
    if words:
        alternatives.append(rf"\s+(?:{words})\s+")
    if " " in delims:
        alternatives.append(r"[^\S\n\t]+")
    return re.compile("|".join(alternatives) or r"(?!)", re.IGNORECASE)


class Names:
    """Listed names; finds those that hold a candidate delimiter in a value by how they look, with one automaton."""

    def __init__(self, names: Iterable[str]):
        self.all = {skeleton(n) for n in names if n} - {""}
        self.automaton = ahocorasick.Automaton()
        for n in self.all:
            if _delimiter(CANDIDATES).search(n):
                self.automaton.add_word(n, len(n))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, value: str) -> list[tuple[int, int]]:
        """Where any name stands as a whole word in the value's drawn form, overlapping ones too."""
        if not len(self.automaton):
            return []
        drawn, _ = skeleton_with_origin(value)
        found = []
        for last, n in self.automaton.iter(drawn):
            a, b = last - n + 1, last + 1
            if not (a and is_word(drawn[a - 1])) and not (b < len(drawn) and is_word(drawn[b])):
                found.append((a, b))
        return found

    def spans(self, value: str) -> list[tuple[int, int]]:
        """Where a name stands, as a whole word; of overlapping ones the first, of those the longest."""
        return _placed(value, self.matches(value))


def _placed(value: str, matches: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Matches in a value's drawn form as places in the value; of overlapping ones the first, of those the longest."""
    found = sorted(matches, key=lambda m: (m[0], -m[1]))
    if not found:
        return []
    _, origin = skeleton_with_origin(value)
    return _apart([(origin[a], origin[b - 1] + 1) for a, b in found])


def _apart(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans:
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


_names_cache: dict[tuple[str, ...], Names] = {}


def _names(names: tuple[str, ...]) -> Names:
    if names not in _names_cache:
        if len(_names_cache) > 8:
            _names_cache.clear()
        _names_cache[names] = Names(names)
    return _names_cache[names]


def clean(piece: str) -> str:
    """The piece without outer blanks, quotes and brackets, line breaks inside as one space."""
    s = re.sub(r"[^\S\n\r]*[\r\n]+[^\S\n\r]*", " ", piece.strip())
    while s:
        if s[0] in QUOTES and s[-1] == QUOTES[s[0]] and len(s) > 1:
            s = s[1:-1].strip()
        elif s[0] in BRACKETS and s[-1] == BRACKETS[s[0]] and len(s) > 1:
            s = s[1:-1].strip()
        elif s[0] in '"“„«[{':
            s = s[1:].strip()
        elif s[-1] in '"”»]}':
            s = s[:-1].strip()
        elif s in ("'", "`", "(", ")"):
            return ""
        else:
            return s
    return s


def _void(piece: str) -> bool:
    return not piece or all(c.isspace() or invisible(c) for c in piece)


def _marked(text: str) -> bool:
    """Whether a value holds a stronger candidate than the blank, so that blanks in it are within values."""
    return any(x in text for x in ";|\t•·,/&+\n")


def _unbracketed(value: str) -> str:
    text = value.strip()
    return text[1:-1].strip() if len(text) > 1 and text[0] == "[" and text[-1] == "]" else text


@lru_cache(maxsize=65536)
def kind(piece: str) -> str:
    """The type of a piece: a strict one, a term by its casing, or '' for prose and marks."""
    for name, pattern in STRICT:
        if pattern.fullmatch(piece):
            return name
    words = piece.split()
    if not 0 < len(words) <= TERM_WORDS or piece[-1] in ".!?:" or not any(c.isalpha() for c in piece):
        return ""
    return "CAPITALS" if piece.isupper() and len(piece) > 1 else "Name" if next(c for c in piece if c.isalpha()).isupper() else "term"


def split_value(value: str, delims: tuple[str, ...], names: Names, guarded: list[tuple[int, int]] | None = None, listed: bool = False) -> list[str]:
    """The values packed in one string, in order, without empty ones.

    A quoted stretch that begins and ends at a delimiter is one value; so is a listed name or what looks like one. A
    line break separates values only where no other accepted delimiter does; otherwise it is a break inside a name.
    Dates stay whole. guarded: where names stand in the value, if that is known already. listed: whether the whole is
    known to be one value though it holds a line break.
    """
    text = _unbracketed(value)
    inline = tuple(d for d in delims if d != "\n" and (d != " " or not _marked(text)))
    if "\n" not in text and not _QUOTE.search(text) and not (inline and _delimiter(inline).search(text)):
        return [c] if not _void(c := clean(text)) else []
    guarded = _with_dates(text, names.spans(text) if guarded is None else guarded)
    pieces = _cut(text, inline, guarded)
    if "\n" in delims and "\n" in text and len(pieces) == 1:
        whole = skeleton(pieces[0])
        if not listed and whole not in names.all:
            pieces = _cut(text, ("\n",), guarded)
    return [c for c in map(clean, pieces) if not _void(c)]


def _with_dates(text: str, guarded: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The guarded places and those of dates."""
    dates = [m.span() for m in _DATE.finditer(text)] if any(c.isdigit() for c in text) else []
    return _apart(sorted([*guarded, *dates], key=lambda s: (s[0], -s[1]))) if dates else guarded


def _cut(text: str, delims: tuple[str, ...], guarded: list[tuple[int, int]]) -> list[str]:
    if not delims:
        return [text]
    pattern = _delimiter(delims)
    if not guarded and not _QUOTE.search(text):
        return pattern.split(text.strip())
    out: list[str] = []
    start = i = 0
    while True:
        # a piece begins: a quoted stretch that ends at a delimiter is one
        while i < len(text) and text[i].isspace() and not pattern.match(text, i):
            i += 1
        if i < len(text) and text[i] in QUOTES and (end := _closing(text, i, pattern)):
            out.append(text[i:end])
            m = pattern.match(text, end)
            i = start = m.end() if m else _skip(text, end)
            continue
        m = _next(text, i, pattern, guarded)
        if m is None:
            out.append(text[start:])
            return out
        out.append(text[start : m.start()])
        i = start = m.end()


def _next(text: str, i: int, pattern: re.Pattern, guarded: list[tuple[int, int]]) -> re.Match | None:
    """The first delimiter from i on that doesn't touch a guarded place."""
    while m := pattern.search(text, i):
        inside = next((s for s in guarded if s[0] <= m.start() < s[1]), None)
        if inside:
            i = inside[1]
        elif m.end() == m.start() or any(s[0] < m.end() and m.start() < s[1] for s in guarded):
            i = m.start() + 1
        else:
            return m
    return None


def _skip(text: str, i: int) -> int:
    while i < len(text) and text[i].isspace():
        i += 1
    return i


def _closing(text: str, i: int, pattern: re.Pattern) -> int:
    """The end of the quoted stretch at i, if a delimiter, another quote or the end follows it; else 0."""
    quote = QUOTES[text[i]]
    j = text.find(quote, i + 1)
    while j > 0:
        k = _skip(text, j + 1)
        if k == len(text) or text[k] in QUOTES or text[k] == "]" or pattern.match(text, j + 1):
            return j + 1
        j = text.find(quote, j + 1)
    return 0


def _profile(value: str, names: Names, guarded: list[tuple[int, int]] | None = None) -> list[tuple[str, int, int, list[str]]]:
    """For each candidate in the value, alone: how many pieces it makes, how many of them are regular by themselves, and
    the keys of the others, which are regular if they stand alone elsewhere."""
    out = []
    text = _unbracketed(value)
    guarded = _with_dates(text, names.spans(text) if guarded is None else guarded)
    for d in CANDIDATES:
        if d in text and (d != " " or not _marked(text)):
            # a listed name with a blank in it speaks against the blank as a delimiter
            pieces = [c for c in map(clean, _cut(text, (d,), guarded if d != " " else _with_dates(text, []))) if not _void(c)]
            if len(pieces) < 2:
                continue
            keys = list(map(skeleton, pieces))
            kinds = list(map(kind, pieces))
            most, n = Counter(k for k in kinds if k).most_common(1)[0] if any(kinds) else ("", 0)
            strict = most in _STRICT
            if _WORDY.search(d) or d in " \n":
                even = strict and n >= STRICT_SHARE * len(pieces)
            else:
                even = n > 1
            others = [k for k, t in zip(keys, kinds) if k not in names.all and not (even and t == most)]
            out.append((d, len(pieces), len(pieces) - len(others), others))
    return out


def _long(df: DataFrame, id_col: str, source_col: str | None, fields: list[str]) -> DataFrame:
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("")) if source_col else F.lit("")
    packed = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields])
    return df.select(F.col(id_col).alias("rid"), source.alias("src"), F.explode(packed).alias("p")).select("rid", "src", "p.field", "p.raw").where("raw is not null")


def _keys(of: Callable[[str], str]):  # noqa: ANN202
    @F.pandas_udf("string")
    def keys(raw: pd.Series) -> pd.Series:
        return raw.map(of)

    return keys


def vocabulary(long: DataFrame) -> DataFrame:
    """(field, key) of the values that stand alone; it stays distributed whatever its size."""
    alone = long.where(~F.col("raw").rlike(r"[;|\t•·,/&+\n]|\s(?i:and|or)\s")).groupBy("field", F.lower(F.trim("raw")).alias("v")).count()
    keyed = alone.select("field", _keys(lambda v: skeleton(clean(v)))("v").alias("key"), "count").where("key <> ''")
    known = keyed.groupBy("field", "key").agg(F.sum("count").alias("n")).where(F.col("n") >= LEAST).select("field", "key").persist()
    single, several = known.where("key not like '% %'"), known.where("key like '% %'")
    # values between blanks only are packed, if each of their words stands alone elsewhere
    words = several.select("field", F.col("key").alias("whole"), F.explode(F.split("key", " ")).alias("key"))
    met = words.join(single.withColumn("lone", F.lit(True)), ["field", "key"], "left").groupBy("field", "whole").agg(F.count("*").alias("n"), F.count("lone").alias("k"))
    return single.unionByName(met.where("k < n").select("field", F.col("whole").alias("key")))


def infer_delimiters(long: DataFrame, names: dict[str, tuple[str, ...]], sharded: frozenset[str], known: DataFrame) -> DataFrame:
    """(src, field, seen, delims): the candidates that a source's values hold and those of them that are accepted; src
    null holds for all sources together, and for each source in the candidates that its values don't hold.

    names: what is sent to the executors. known: (field, key) of further pieces that are regular, which are joined.
    sharded: the fields whose places of names are in the column guard.
    """

    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[str, str, str, str | None], list[float]] = {}
        memo: dict[tuple[str, str], list] = {}
        held = 0
        for b in batches:
            for src, field, raw, guard in zip(b["src"], b["field"], b["raw"], b["guard"]):
                found = memo.get((field, raw))
                if found is None:
                    places = _placed(_unbracketed(raw), zip(guard[::2], guard[1::2])) if field in sharded else None
                    found = _profile(raw, _names(names.get(field, ())), places)
                    held += 1 + sum(len(x[3]) for x in found)
                    if held > 200_000:
                        memo.clear()
                        held = 0
                    memo[field, raw] = found
                for d, n, k, others in found:
                    s = sums.setdefault((src, field, d, None), [0.0] * 4)
                    s[0] += 1
                    s[1] += n
                    s[2] += n * n
                    s[3] += k
                    for key in others:
                        sums.setdefault((src, field, d, key), [0.0] * 4)[3] += 1
            if len(sums) > 50_000:
                yield _sums(sums)
                sums = {}
        if sums:  # a task without rows gives nothing: an empty column has no type to convert
            yield _sums(sums)

    types = "src string, field string, d string, key string, n double, p double, pp double, k double"
    stats = long.select("src", "field", "raw", "guard").mapInPandas(profile, types)
    sums = [F.sum(c).alias(c) for c in ("n", "p", "pp", "k")]
    # pieces are counted before they are joined; of the unknown ones only those that turn out to be known count
    stats = stats.groupBy("src", "field", "d", "key").agg(*sums).join(known.withColumn("hit", F.lit(True)), ["field", "key"], "left")
    by = stats.where("key is null or hit").groupBy("src", "field", "d").agg(*sums).persist()
    by.count()  # two branches read it: computed before, it is computed once
    overall = by.groupBy("field", "d").agg(*[F.sum(c).alias("all_" + c) for c in ("n", "p", "pp", "k")])
    lean = F.lit(PRIOR) / F.col("all_n")
    # overall has a row for each field and candidate: a few dozen, whatever the input
    mixed = by.join(F.broadcast(overall), ["field", "d"]).select("src", "field", "d", *[(F.col(c) + lean * F.col("all_" + c)).alias(c) for c in ("n", "p", "pp", "k")])
    both = mixed.unionByName(overall.select(F.lit(None).cast("string").alias("src"), "field", "d", *[F.col("all_" + c).alias(c) for c in ("n", "p", "pp", "k")]))
    mean = F.col("p") / F.col("n")
    consistency = 1 / (1 + F.greatest(F.lit(0.0), F.col("pp") / F.col("n") - mean * mean) / (mean * mean))
    scored = both.withColumn("score", consistency * F.col("k") / F.col("p"))
    accepted = F.collect_set(F.when(F.col("score") >= ACCEPT, F.col("d")))
    return scored.groupBy("src", "field").agg(F.sort_array(F.collect_set("d")).alias("seen"), F.sort_array(accepted).alias("delims"))


def _sums(sums: dict) -> pd.DataFrame:
    rows = [(*key, *s) for key, s in sums.items()]
    return pd.DataFrame(rows, columns=["src", "field", "d", "key", "n", "p", "pp", "k"])


def _collect_names(names: DataFrame | None, col: str) -> list[tuple[str, ...]]:
    """The listed names in shards of about SHARD, as they are sent to the executors; at most MAX_NAMES."""
    if names is None:
        return [()]
    listed = names.select(F.col(col).cast("string").alias("n")).where("n is not null").distinct()
    rows = sorted(r["n"] for r in listed.limit(MAX_NAMES + 1).collect())
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} listed names")
    return [tuple(rows[i : i + SHARD]) for i in range(0, len(rows), SHARD)] or [()]


def _guarded(long: DataFrame, field: str, shards: list[tuple[str, ...]]) -> DataFrame:
    """long with the column guard: for the field's values, where a name of any shard stands in the drawn form, as start,
    end, start, ... Overlapping ones are all kept, as which of them counts shows only when all shards are seen."""
    for shard in shards:
        find = _finder(long.sparkSession.sparkContext.broadcast(shard))
        long = long.withColumn("guard", F.concat("guard", F.when(F.col("field") == field, find("raw")).otherwise(F.array().cast("array<int>"))))
    return long


def _finder(shard):  # noqa: ANN001, ANN202
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def find(raw: pd.Series) -> pd.Series:
        return pd.Series([[i for span in _names(shard.value).matches(_unbracketed(r)) for i in span] for r in raw])

    return find


def _name_keys(names: DataFrame, col: str, field: str) -> DataFrame:
    """(field, key) of all listed names."""
    name = F.col(col).cast("string")
    return names.select(name.alias("n")).where("n is not null").distinct().select(F.lit(field).alias("field"), _keys(skeleton)("n").alias("key")).where("key <> ''").distinct()


def _whole_known(long: DataFrame, known: DataFrame) -> DataFrame:
    """(field, raw) of the values that hold a line break and are one value as a whole: they stand alone elsewhere."""
    whole = _keys(lambda r: skeleton(_unbracketed(r)))("raw").alias("key")
    lines = long.where(F.col("raw").contains("\n")).select("field", "raw").distinct().select("field", "raw", whole)
    return lines.join(known, ["field", "key"], "left_semi").select("field", "raw")


def split_packed(
    df: DataFrame,
    id_col: str,
    fields: list[str],
    source_col: str | None = None,
    names: dict[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """One row per value of each field: (id_col, field, pos, item, n_items).

    names: per field, a table and its column of names that are one value whatever they hold.
    Null and empty fields give no row; a field with one value gives one row with pos 1; repeated values and repeated
    rows all stay; a field that isn't a string is read as its string. Extra columns are ignored, whatever their names.
    An empty table gives an empty result.
    """
    long = _long(df, id_col, source_col, fields)
    shards = {f: _collect_names(*t) for f, t in (names or {}).items()}
    # one shard goes along with the functions; of more, the places are looked for one after another and the names joined
    listed = {f: s[0] for f, s in shards.items() if len(s) == 1}
    many = {f: s for f, s in shards.items() if len(s) > 1}
    known = vocabulary(long)
    if many:
        long = long.withColumn("guard", F.array().cast("array<int>"))
        for f, parts in many.items():
            long = _guarded(long, f, parts)
            known = known.unionByName(_name_keys(*names[f], f))
        known = known.distinct()
    else:
        long = long.withColumn("guard", F.lit(None).cast("array<int>"))
    known = known.persist()
    sharded = frozenset(many)
    found = infer_delimiters(long, listed, sharded, known).persist()
    small = found.limit(BROADCAST_SOURCES + 1).collect()
    lines = _whole_known(long, known)
    few = lines.limit(BROADCAST_LINES + 1).collect()
    whole = frozenset((r["field"], r["raw"]) for r in few) if len(few) <= BROADCAST_LINES else None
    if len(small) <= BROADCAST_SOURCES:
        rest = {r["field"]: r["delims"] for r in small if r["src"] is None}
        own = {(r["src"], r["field"]): tuple(sorted({*r["delims"], *(set(rest.get(r["field"], ())) - set(r["seen"]))})) for r in small if r["src"] is not None}
        own.update({(None, f): tuple(ds) for f, ds in rest.items()})
        long = long.withColumn("delims", F.lit(None).cast("array<string>"))
    else:
        own = None
        rest = found.where("src is null").select("field", F.col("delims").alias("rest"))  # a row a field
        long = long.join(found.where("src is not null"), ["src", "field"], "left").join(F.broadcast(rest), ["field"], "left")
        none = F.array().cast("array<string>")
        every = F.array_union(F.coalesce("delims", none), F.array_except(F.coalesce("rest", none), F.coalesce("seen", none)))
        long = long.withColumn("delims", F.sort_array(every)).drop("rest", "seen")
    if whole is None:
        broken = F.when(F.col("raw").contains("\n"), F.col("raw"))
        long = long.withColumn("broken", broken).join(lines.select("field", F.col("raw").alias("broken"), F.lit(True).alias("whole")), ["field", "broken"], "left")
    else:
        long = long.withColumn("whole", F.lit(None).cast("boolean"))
    sent = df.sparkSession.sparkContext.broadcast((own, whole))
    memo: dict[tuple, list[str]] = {}  # of one task

    def pieces(s: str, f: str, r: str, d: list[str] | None = None, g: list[int] | None = None, w: bool | None = None) -> list[str] | None:
        if r is None:
            return None
        by_source, lone = sent.value
        ds = tuple(d) if by_source is None else by_source[s, f] if (s, f) in by_source else by_source.get((None, f), ())
        key = (f, r, ds)
        if key not in memo:
            if len(memo) > 200_000:
                memo.clear()
            spans = _placed(_unbracketed(r), zip(g[::2], g[1::2])) if f in sharded else None
            memo[key] = split_value(r, ds, _names(listed.get(f, ())), spans, bool(w) if lone is None else (f, r) in lone)
        return memo[key]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(src: pd.Series, field: pd.Series, raw: pd.Series) -> pd.Series:
        return pd.Series(list(map(pieces, src, field, raw)), dtype=object)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split_joined(src: pd.Series, field: pd.Series, raw: pd.Series, delims: pd.Series, guard: pd.Series, whole: pd.Series) -> pd.Series:
        return pd.Series(list(map(pieces, src, field, raw, delims, guard, whole)), dtype=object)

    # a value of one word goes nowhere: it reaches Python as a null
    word = F.col("raw").rlike(r"^[\p{L}\p{N}-]+$")
    packed = F.when(~word, F.col("raw"))
    plain = own is not None and whole is not None and not many
    made = split("src", "field", packed) if plain else split_joined("src", "field", packed, "delims", "guard", "whole")
    items: Column = F.coalesce(made, F.array("raw"))
    return long.select("rid", "field", items.alias("items")).select("rid", "field", F.size("items").alias("n_items"), F.posexplode("items").alias("p0", "item")).select(F.col("rid").alias(id_col), "field", (F.col("p0") + 1).cast("int").alias("pos"), "item", "n_items")
