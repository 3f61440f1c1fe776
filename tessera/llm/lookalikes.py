"""Visually identical text with different characters: bring all text to one consistent form.

Method. (1) The units of the corpus (code points, and letters with combining marks) are counted in one aggregate whose
result is bounded by the alphabet. (2) Units and strings that are drawn alike are united by union-find: a unit with its
composed form, with the ordinary form of a compatibility character, with the letter that it looks like, an invisible
character with the empty string. The union is transitive. (3) Each class is represented by its most frequent ordinary
member (letters that only look like Latin ones, of whatever script, stand for none). (4) An Aho-Corasick automaton over all units that aren't their representative rewrites every value, greedily,
longest unit first. Letters of another script are rewritten only in words of Latin letters.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.textform import blank, compatible, invisible, look_alikes

#: Most combining marks of a unit; longer stacks are composed mark by mark.
MARKS = 2
#: Different units that go to the driver at most: code points (1.1 million at most) and letters with marks. Beyond it an
#: error is raised; nothing is cut.
MAX_UNITS = 2_000_000

_LOOKS = look_alikes()


def _mark(ch: str) -> bool:
    return unicodedata.category(ch)[0] == "M"


def units(text: str) -> Iterator[str]:
    """Each code point, and each letter together with the (first) marks after it."""
    i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and j - i <= MARKS and _mark(text[j]):
            j += 1
        if j > i + 1 and text[i].isalpha():
            yield text[i:j]
        yield from text[i:j]
        i = j


def count_units(df: DataFrame, fields: list[str]) -> dict[str, int]:
    """Unit -> occurrences in all rows; partial counts by task, so the exchange holds the alphabet only."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter[str] = Counter()
        for b in batches:
            for f in b.columns:
                for text in b[f]:
                    if text:
                        c.update(text if text.isascii() else units(text))
            if len(c) > 200_000:
                yield pd.DataFrame({"unit": list(c.keys()), "n": list(c.values())})
                c.clear()
        if c:  # a task without rows gives nothing: an empty column has no type to convert
            yield pd.DataFrame({"unit": list(c.keys()), "n": list(c.values())})

    parts = df.select(*[F.col(f).cast("string") for f in fields]).mapInPandas(count, "unit string, n long")
    rows = parts.groupBy("unit").agg(F.sum("n").alias("n")).limit(MAX_UNITS + 1).collect()
    if len(rows) > MAX_UNITS:
        raise ValueError(f"more than {MAX_UNITS} different units of text")
    return {r["unit"]: r["n"] for r in rows}


def _latin(ch: str) -> bool:
    return ch.isascii() or unicodedata.name(ch, "").startswith("LATIN")


def _letter_form(unit: str) -> str:
    """The unit with every letter as the Latin letter that it looks like, composed."""
    apart = unicodedata.normalize("NFD", "".join(map(compatible, unit)))
    return unicodedata.normalize("NFC", "".join(_LOOKS.get(c, c) for c in apart))


class Classes:
    """Look-alike classes over strings and code points."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        ra, rb = self.find(a), self.find(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return out


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """Unit -> the form to write, for every unit that isn't written as it should be."""
    classes = Classes()
    for u in counts:
        if len(u) == 1 and invisible(u):
            classes.union(u, "")
        elif len(u) == 1 and blank(u):
            classes.union(u, " ")
        elif len(u) == 1 and _mark(u):
            continue
        else:
            classes.union(u, unicodedata.normalize("NFC", u))
            classes.union(u, "".join(map(compatible, u)))
            classes.union(u, _letter_form(u))

    def ordinary(m: str) -> bool:
        return all(_latin(c) and not _mark(c) and compatible(c) == c and (not blank(c) or c == " ") and not invisible(c) for c in m) and m == unicodedata.normalize("NFC", m)

    def frequency(m: str) -> int:
        return min((counts.get(c, 0) for c in m), default=0) if len(m) > 1 else counts.get(m, 0)

    out = {}
    for members in classes.members().values():
        fit = [m for m in members if ordinary(m) and not any(c in _LOOKS for c in m)]
        if len(members) < 2 or not fit:
            continue
        # frequency decides; ASCII goes before other letters of the same frequency, then the order of the code points
        best = "" if "" in fit else min(fit, key=lambda m: (-frequency(m), not m.isascii(), m))
        out.update({m: best for m in members if m != best})
    return out


class Rewriter:
    """Rewrites text with the representatives of its units."""

    def __init__(self, forms: dict[str, str]):
        self.forms = forms
        self.dropped = {ord(u): None for u, f in forms.items() if f == "" and len(u) == 1}
        #: units that hold letters of another script: rewritten in Latin words only
        self.foreign = {u for u in forms if any(c.isalpha() and not _latin(compatible(c)[0]) for c in u)}
        #: whether ASCII characters always stand for themselves, so that texts of nothing else stay as they are
        self.ascii_stays = not any(u.isascii() for u in forms)
        self.automaton = ahocorasick.Automaton()
        for u, f in forms.items():
            if f != "":
                self.automaton.add_word(u, (u, f))
        if len(self.automaton):
            self.automaton.make_automaton()

    def __call__(self, text: str) -> str:
        if self.ascii_stays and text.isascii():
            return text
        seen = text.translate(self.dropped)
        out, at = [], 0
        if len(self.automaton):
            barred = self._barred(seen)
            for end, (u, f) in self.automaton.iter_long(seen):
                start = end - len(u) + 1
                if start < at or (u in self.foreign and any(barred[start : end + 1])):
                    continue
                out += [seen[at:start], f]
                at = end + 1
        out.append(seen[at:])
        return unicodedata.normalize("NFC", "".join(out))

    def _barred(self, text: str) -> bytearray:
        """1 for each character of a word wholly in another script."""
        barred = bytearray(len(text))
        if not self.foreign:
            return barred
        latin = [c.isalpha() and _latin(compatible(c)[0]) for c in text]
        some = any(latin)
        i = 0
        while i < len(text):
            if not (text[i].isalpha() or _mark(text[i])):
                i += 1
                continue
            j = i
            while j < len(text) and (text[j].isalpha() or _mark(text[j]) or (text[j] in "'’＇" and j + 1 < len(text) and text[j + 1].isalpha())):
                j += 1
            # a word of nothing but look-alikes is a Latin one if it stands among Latin words
            if not any(latin[i:j]) and not (some and all(_latin(_letter_form(c)[0]) for c in text[i:j] if c.isalpha())):
                barred[i:j] = b"\1" * (j - i)
            i = j
        return barred


def consistent_forms(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """(id_col, field, raw, clean) for every non-null value of the fields, clean in the consistent form.

    Null values give no row; empty ones stay empty; repeated rows all stay; very long texts are rewritten whole; ties
    between representatives fall to ASCII, then to the lowest code point. Extra columns are ignored. An empty table
    gives an empty result. Words wholly in another script stay as they are but for invisible characters, composed
    accents and blanks.
    """
    forms = representatives(count_units(df, fields))
    rewriter = df.sparkSession.sparkContext.broadcast(forms)
    cache: dict[int, Rewriter] = {}

    @F.pandas_udf(T.StringType())
    def rewrite(raw: pd.Series) -> pd.Series:
        if 0 not in cache:
            cache[0] = Rewriter(rewriter.value)
        w = cache[0]
        memo: dict[str, str] = {}
        return pd.Series([None if r is None else memo[r] if r in memo else memo.setdefault(r, w(r)) for r in raw], dtype=object)

    packed = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields])).alias("p")
    long = df.select(F.col(id_col).alias("rid"), packed).select("rid", "p.field", "p.raw").where("raw is not null")
    return long.select(F.col("rid").alias(id_col), "field", "raw", rewritten(F.col("raw"), forms, rewrite).alias("clean"))


def rewritten(raw: Column, forms: dict[str, str], rewrite) -> Column:  # noqa: ANN001
    """raw in the consistent form; texts that hold nothing but characters that stay don't leave the JVM."""
    if any(u.isascii() for u in forms):
        return rewrite(raw)
    # a Python function sees every row, whatever the condition around it: what needn't go there goes as a null
    return F.coalesce(rewrite(F.when(~raw.rlike(r"^\p{ASCII}*+\z"), raw)), raw)


def rewrite_all(texts: Iterable[str]) -> list[str]:
    """The same on a list, for tests and small tables."""
    texts = list(texts)
    w = Rewriter(representatives(Counter(u for t in texts for u in units(t))))
    return [w(t) for t in texts]
