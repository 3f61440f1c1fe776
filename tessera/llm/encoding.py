"""Garbled text from wrong character encoding: find the affected values and restore the original text.

Method. (1) Characters are mapped back to the bytes of a legacy code page; a byte-structure automaton finds the maximal
spans of well-formed multibyte UTF-8 in them, and only those spans are decoded, again and again until none is left
(text may be garbled twice). Structure decides: a span counts where it can't stand in a right text (a control, a sign
or an opening quote within a word, a capital after a small letter, two scripts in a word) or where it gives several
characters of one script, and its decoded characters fit the words around it. With one such span in a value, the
others that fit are decoded, too. The statistics of the corpus only choose between code pages that explain a value
equally well, and decide on spans that a right text might hold as they are. (2) Text of one
single-byte code page read as another has no byte structure. It is found by context, in values without such spans only:
for each character beyond ASCII the corpus gives how often it stands between its neighbours; re-reading a passage under
another code page is accepted where the likelihood gain of the best contiguous passage (maximal sum) is large. (3) A
replacement character means that the original is lost.

The context statistics count all values; their keys are classes of neighbours, so their number is bounded by the code
pages and not by the corpus, and they are aggregated before the exchange.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.textform import look_alikes

#: Code pages as which UTF-8 may have been read. Bytes that a page leaves open are read as C1 controls.
PAGES = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "iso8859_2", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859_15", "cp866", "koi8_r")
#: (page of the bytes, page as which they were read) of single-byte text.
SWAPS = (("cp1252", "mac_roman"), ("mac_roman", "cp1252"))
#: Least log-likelihood gain for re-reading a passage, and for the character that gains most in it.
LEAST_GAIN, LEAST_PEAK = 2.5, 2.0
#: Spans proven by structure beside which others are decoded though their characters fit less.
CARRY = 3
#: What well-formed bytes weigh against the statistics of contexts, in log-likelihood a character.
STRUCTURE = 3.0
#: Well-formed characters of one script in a row that are taken whether or not the corpus has them, and so many if they
#: might be a word of another script as they stand.
RUN, LONG_RUN = 3, 6
#: Times that text may have been garbled.
DEPTH = 4
#: Most different (neighbour, character, neighbour) that go to the driver; bounded by classes, see _near.
MAX_CONTEXTS = 2_000_000


@lru_cache(maxsize=None)
def to_bytes(page: str) -> dict[str, int]:
    """Character -> byte from 0x80 on."""
    out = {}
    if page.startswith(("cp125", "iso8859")):
        out.update({chr(b): b for b in range(0x80, 0xA0)})
    for b in range(0x80, 0x100):
        try:
            out[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            pass
    return out


@lru_cache(maxsize=None)
def _shown(page: str) -> frozenset[str]:
    """The C1 controls whose byte the page shows by another character."""
    table = to_bytes(page)
    shown = {b for c, b in table.items() if not "\x80" <= c <= "\x9f"}
    return frozenset(c for c, b in table.items() if "\x80" <= c <= "\x9f" and b in shown)


# The automaton over bytes of well-formed UTF-8: state -> (lowest, highest byte, next state); 0 is between characters.
_STEPS: dict[int, tuple[tuple[int, int, int], ...]] = {
    0: ((0xC2, 0xDF, 1), (0xE0, 0xE0, 2), (0xE1, 0xEC, 3), (0xED, 0xED, 4), (0xEE, 0xEF, 3), (0xF0, 0xF0, 5), (0xF1, 0xF3, 6), (0xF4, 0xF4, 7)),
    1: ((0x80, 0xBF, 0),),
    2: ((0xA0, 0xBF, 1),),
    3: ((0x80, 0xBF, 1),),
    4: ((0x80, 0x9F, 1),),
    5: ((0x90, 0xBF, 3),),
    6: ((0x80, 0xBF, 3),),
    7: ((0x80, 0x8F, 3),),
}
_NEXT = {s: {b: t for lo, hi, t in steps for b in range(lo, hi + 1)} for s, steps in _STEPS.items()}


def spans(codes: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of well-formed multibyte characters in a list of bytes (-1 for what is no byte of the page)."""
    out: list[tuple[int, int]] = []
    i = 0
    while i < len(codes):
        state, j = _NEXT[0].get(codes[i], -1), i + 1
        while state > 0 and j < len(codes):
            state, j = _NEXT[state].get(codes[j], -1), j + 1
        if state == 0:
            if out and out[-1][1] == i:
                out[-1] = (out[-1][0], j)
            else:
                out.append((i, j))
            i = j
        else:
            i += 1
    return out


@lru_cache(maxsize=None)
def _hint(page: str) -> re.Pattern:
    """A first byte of a multibyte character followed by a further one, as the page shows them."""
    table = to_bytes(page)
    first = "".join(re.escape(c) for c, b in table.items() if 0xC2 <= b <= 0xF4)
    later = "".join(re.escape(c) for c, b in table.items() if b <= 0xBF)
    return re.compile(f"[{first}][{later}]")


@lru_cache(maxsize=None)
def _any_hint() -> re.Pattern:
    """What any page has a hint of, so that most right texts are passed over at once."""
    return re.compile("|".join(_hint(p).pattern for p in PAGES))


@dataclass(frozen=True)
class Decoded:
    """A text with its spans decoded, where they were, and where the decoded characters are."""

    text: str
    was: list[int]
    now: list[int]

    @property
    def got(self) -> list[str]:
        return [self.text[i] for i in self.now]


def _runs(text: str, page: str) -> list[tuple[int, int, str]]:
    """Start, end and decoded form of the text's well-formed spans."""
    if not _hint(page).search(text):
        return []
    table = to_bytes(page)
    codes = [table.get(c, -1) if c > "\x7f" else -1 for c in text]
    return [(a, b, bytes(codes[a:b]).decode("utf-8")) for a, b in spans(codes)]


def _decoded(text: str, runs: list[tuple[int, int, str]]) -> Decoded:
    out, at, n = [], 0, 0
    was: list[int] = []
    now: list[int] = []
    for a, b, new in runs:
        n += a - at
        was += range(a, b)
        now += range(n, n + len(new))
        n += len(new)
        out += [text[at:a], new]
        at = b
    return Decoded("".join([*out, text[at:]]), was, now)


def decode_spans(text: str, page: str) -> Decoded | None:
    """The text with its well-formed spans decoded; None if it has none."""
    runs = _runs(text, page)
    return _decoded(text, runs) if runs else None


@lru_cache(maxsize=65536)
def _script(c: str) -> str:
    return unicodedata.name(c, "?").split()[0]


def _one_script(text: str) -> bool:
    """Whether the letters are of one script, if there are any. Japanese mixes three."""
    kinds = {("CJK" if (k := _script(c)) in ("HIRAGANA", "KATAKANA", "KATAKANA-HIRAGANA") else k) for c in text if c.isalpha()}
    return len(kinds) == 1


def _possible(text: str) -> bool:
    """Whether all are characters that a text may hold: no unassigned or private ones, surrogates or controls."""
    return all(unicodedata.category(c) not in ("Cn", "Co", "Cs", "Cc") for c in text)


def _solid(old: str, new: str) -> bool:
    """Whether the structure alone tells that a span was garbled: several characters of one script in a row."""
    if len(new) < RUN or not _possible(new) or not _one_script(new):
        return False
    return len(new) >= LONG_RUN or not (old.isalpha() and _one_script(old))


@lru_cache(maxsize=65536)
def _near(c: str) -> str:
    """The class of a neighbour: a Latin letter without accent and case, a blank, a digit, an ASCII mark, or other."""
    if c.isalpha():
        base = unicodedata.normalize("NFD", c)[0].casefold()[:1]
        return base if base.isascii() else "x̂"
    return " " if c.isspace() else "0" if c.isdigit() else c if c.isascii() else "·"


def contexts(text: str) -> Iterator[tuple[str, str, str]]:
    for i, c in enumerate(text):
        if c > "\x7f":
            yield _near(text[i - 1]) if i else "^", c, _near(text[i + 1]) if i + 1 < len(text) else "$"


#: Signs and blanks that stand in any context.
_SIGNS = frozenset("’‘“”–—…½¼¾•°§©®™«»\xa0")


_LOOKS = look_alikes()
#: Characters by which the code pages show bytes: text garbled twice goes through them.
_STEP_CHARS = frozenset(c for page in PAGES for c in to_bytes(page))
#: Latin letters of living languages beyond Latin-1 and Extended-A.
_MORE_LATIN = frozenset("ƠơƯưȘșȚțǍǎǏǐǑǒǓǔƏəǪǫ")


@lru_cache(maxsize=65536)
def _kind(c: str) -> str:
    return unicodedata.category(c)


@lru_cache(maxsize=65536)
def _apart(c: str) -> bool:
    """Whether a character is a sign that doesn't touch letters in right texts."""
    return _kind(c)[0] == "S" or _kind(c) == "No"


def _mixed(a: str, b: str) -> bool:
    """Whether two letters side by side are of two scripts; words with look-alike letters aren't garbled."""
    return a not in _LOOKS and b not in _LOOKS and _script(a) != _script(b)


def _odd(text: str, a: int, b: int) -> bool:
    """Whether text[a:b] can't stand where it does in a right text."""
    left, right = text[a - 1] if a else " ", text[b] if b < len(text) else " "
    seq = left + text[a:b] + right
    for i in range(1, len(seq)):
        c, before = seq[i], seq[i - 1]
        if before.isalpha() and c.isalpha() and ((c.isupper() and before.islower()) or _mixed(c, before)):
            return True
        if i == len(seq) - 1:
            break
        after = seq[i + 1]
        if "\x80" <= c <= "\x9f" or (_apart(c) and (before.isalpha() or after.isalpha())):
            return True
        if before.isalpha() and after.isalpha() and c not in "’·–—" and _kind(c) in ("Ps", "Pi", "Po", "Pf", "Pe"):
            return True
    return False


@lru_cache(maxsize=65536)
def _written(c: str) -> bool:
    """Whether a decoded character may stand alone between Latin letters or signs: a Latin letter of living languages or
    a sign in use."""
    if c.isalpha():
        return c <= "ſ" or "Ạ" <= c <= "ỹ" or c in _MORE_LATIN or c in "ﬁﬂ"
    if _kind(c) in ("Cn", "Co", "Cs", "Cc", "Mc", "Me", "Lm") or (_kind(c) == "Mn" and not "\u0300" <= c <= "\u036f"):
        return False
    return c <= "ſ" or c in _STEP_CHARS or "\u02b0" <= c <= "\u036f" or "\u2000" <= c <= "\u27ff" or c == "�" or c >= "\U0001f000"


def _fits(text: str, a: int, b: int, new: str) -> bool:
    """Whether a decoded span fits where it stands: its letters are Latin ones or of the script of their neighbours,
    not small where capitals go before, and no oddity is left."""
    seq = (text[a - 1] if a else " ") + new + (text[b] if b < len(text) else " ")
    for i in range(1, len(seq) - 1):
        c = seq[i]
        if not _written(c) and not (c.isalpha() and any(x.isalpha() and not _written(x) and _script(x) == _script(c) for x in (seq[i - 1], seq[i + 1]))):
            return False
        if c.islower() and seq[i - 1].isupper() and a > 1 and text[a - 2].isupper() and i == 1:
            return False
    return not _odd(seq, 1, len(seq) - 1)


class Model:
    """How usual characters beyond ASCII are between their neighbours."""

    def __init__(self, counts: dict[tuple[str, str, str], int]):
        self.n3 = counts
        self.n2: Counter = Counter()
        self.n1: Counter = Counter()
        for (p, c, n), k in counts.items():
            self.n2[p, c, 0] += k
            self.n2[0, c, n] += k
            self.n1[c] += k
        self.seen: dict[tuple[str, str, str], float] = {}  # bounded as the contexts are

    def score(self, p: str, c: str, n: str) -> float:
        got = self.seen.get((p, c, n))
        if got is None:
            got = self.seen[p, c, n] = self._score(p, c, n)
        return got

    def _score(self, p: str, c: str, n: str) -> float:
        return math.log(self.n3.get((p, c, n), 0) + 0.05 * min(self.n2[p, c, 0], self.n2[0, c, n]) + 1e-4 * self.n1[c] + 1e-3)

    def _mean(self, text: str, places: list[int]) -> float:
        return sum(self.score(*t) for t in contexts_at(text, places)) / len(places)

    def _known(self, c: str) -> bool:
        return c in _SIGNS or self.n1[c] > 0

    def _step(self, text: str, page: str, proven: bool) -> tuple[tuple, Decoded, bool] | None:
        """(rank, text with the page's spans decoded, whether it may be the original), or None. proven: whether the text came
        out of a decoding itself."""
        runs = _runs(text, page)
        if not runs:
            return None
        solid = {r for r in runs if _solid(text[r[0] : r[1]], r[2])}
        scripts = {_script(c) for r in solid for c in r[2] if c.isalpha()}
        odd = {r for r in runs if _odd(text, r[0], r[1])}
        fits = {r for r in runs if r in solid or _fits(text, *r)}
        proofs = len(solid) + len((odd & fits) - solid)
        # beside CARRY times as many proofs, spans are decoded though they fit less, and those of the scripts that the
        # proofs show; an odd one may be a step of a text that was garbled several times
        rest = [r for r in runs if r not in fits and _possible(r[2])]
        carried = {r for r in rest if proofs >= CARRY * len(rest) or (scripts and all(_script(c) in scripts for c in r[2] if c.isalpha()))}
        steps = {r for r in odd if all(c in _STEP_CHARS for c in r[2])} - fits - carried
        kept = [r for r in runs if r in fits or r in carried or r in steps]
        if not kept:
            return None
        proof = proven or proofs > 0 or bool(steps)
        usual = sum(all(map(self._known, r[2])) for r in kept)
        d = _decoded(text, kept)
        if not proof:  # nothing but spans that a right text might hold: the corpus must speak for them
            least, mean = self._mean(text, d.was), self._mean(d.text, d.now)
            if not ((usual == len(kept) and mean > least - STRUCTURE) or all(c in _SIGNS for c in d.got)):
                return None
        scripts = {_script(c) for c in d.got if c.isalpha() or _kind(c) == "Mn"}
        marks = sum(_kind(c) == "Mn" for c in d.got)
        controls = sum(text[i] in _shown(page) for i in d.was)
        rare = sum(not self._known(c) for c in d.got)
        # the page that explains the most, with the fewest controls that it would have shown otherwise, in the fewest
        # scripts, with nothing odd left; then the one whose characters the corpus has, then the most usual where they stand
        rank = (-len(d.was), controls, max(1, len(scripts)), marks, bool(steps), rare, -self._mean(d.text, d.now), PAGES.index(page))
        return rank, d, not steps

    def unfold(self, text: str) -> str:
        """The text with UTF-8 spans decoded, repeatedly, each time under the page that explains the most of it."""
        found = now = text
        for _ in range(DEPTH):
            if not _any_hint().search(now):
                break
            steps = [s for page in PAGES if (s := self._step(now, page, now != text))]
            if not steps:
                break
            _, d, whole = min(steps, key=lambda s: s[0])
            now = d.text
            if whole and not any("\x80" <= c <= "\x9f" for c in d.got):
                found = now
        return found

    def reread(self, text: str) -> str:
        """The text with the passage re-read under another single-byte page that gains most, if it gains enough."""
        places = [i for i, c in enumerate(text) if c > "\x7f"]
        best, found = LEAST_GAIN, text
        for page, read_as in SWAPS:
            table = _reread(page, read_as)
            new = list(text)
            for i in places:
                new[i] = table.get(text[i], "")
            changed = "".join(c or text[i] for i, c in enumerate(new))
            gains = []
            for i, old, re_read in zip(places, contexts(text), contexts_at(changed, places)):
                gains.append(self.score(*re_read) - self.score(*old) if new[i] and new[i] != text[i] else (0.0 if new[i] else -1e9))
            gain, a, b = _best_run(gains)
            if gain > best and max(gains[a:b]) > LEAST_PEAK:
                best = gain
                chars = list(text)
                for i in places[a:b]:
                    chars[i] = new[i]
                found = "".join(chars)
        return found

    def restore(self, text: str) -> str | None:
        """The original of a garbled text, '' if it is lost, None if the text isn't garbled."""
        if text.isascii():
            return None
        if "�" in text:
            return ""
        new = self.unfold(text)
        if new == text:
            new = self.reread(text)
        if new == text:
            return None
        return "" if "�" in new else new


@lru_cache(maxsize=None)
def _reread(page: str, read_as: str) -> dict[str, str]:
    """Character of one page -> the character that its byte is in the other."""
    back = {b: c for c, b in to_bytes(page).items()}
    return {c: back[b] for c, b in to_bytes(read_as).items() if b in back and not "\x80" <= back[b] < "\xa0"}


def contexts_at(text: str, places: list[int]) -> Iterator[tuple[str, str, str]]:
    for i in places:
        yield _near(text[i - 1]) if i else "^", text[i], _near(text[i + 1]) if i + 1 < len(text) else "$"


def _best_run(gains: list[float]) -> tuple[float, int, int]:
    """Sum, start and end of the contiguous run with the largest sum."""
    best, at, sum_, start = (0.0, 0, 0), 0, 0.0, 0
    for at, g in enumerate(gains):
        if sum_ <= 0:
            sum_, start = 0.0, at
        sum_ += g
        if sum_ > best[0]:
            best = (sum_, start, at + 1)
    return best


def _long(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    packed = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("raw")) for f in fields])).alias("p")
    # values of ASCII only can't be garbled and never leave the JVM
    return df.select(F.col(id_col).alias("rid"), packed).select("rid", "p.field", "p.raw").where(r"raw is not null and not raw rlike '^\\p{ASCII}*+\\z'")


def learn(df: DataFrame, fields: list[str]) -> Model:
    """The context statistics of all values of the fields."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for b in batches:
            for raw in b["raw"]:
                c.update(set(contexts(raw)))  # values, not occurrences: one long garbled text isn't usage
            if len(c) > 200_000:
                yield _frame(c)
                c.clear()
        yield _frame(c)

    long = _long(df.withColumn("__k", F.lit(0)), "__k", fields).select("raw")
    rows = long.mapInPandas(count, "p string, c string, n string, k long").groupBy("p", "c", "n").agg(F.sum("k").alias("k")).limit(MAX_CONTEXTS + 1).collect()
    if len(rows) > MAX_CONTEXTS:
        raise ValueError(f"more than {MAX_CONTEXTS} different contexts of characters")
    return Model({(r["p"], r["c"], r["n"]): r["k"] for r in rows})


def _frame(c: Counter) -> pd.DataFrame:
    return pd.DataFrame([(*key, n) for key, n in c.items()], columns=["p", "c", "n", "k"])


def garbled(df: DataFrame, id_col: str, fields: list[str], learn_from: list[str] | None = None) -> DataFrame:
    """(id_col, field, raw, restored) for every garbled value; restored is '' where characters are lost for good.

    learn_from: the fields of which the statistics are taken (fields, if not given).

    Null, empty and ASCII-only values are never garbled. Repeated rows each give a row. Very long texts are treated
    whole. Of code pages with equally usual results the first in PAGES counts. Extra columns are ignored, whatever
    their names. An empty table gives an empty result.
    """
    counts = df.sparkSession.sparkContext.broadcast(learn(df, learn_from or fields).n3)
    cache: dict[int, Model] = {}

    def restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if 0 not in cache:
            cache[0] = Model(counts.value)
        memo: dict[str, str | None] = {}
        for b in batches:
            got = []
            for raw in b["raw"]:
                if raw not in memo:
                    if len(memo) > 20_000:
                        memo.clear()
                    memo[raw] = cache[0].restore(raw)
                got.append(memo[raw])
            if any(x is not None for x in got):
                b["restored"] = got
                yield b[b["restored"].notna()]

    long = _long(df, id_col, fields)
    kind = long.schema["rid"].dataType.simpleString()
    return long.mapInPandas(restore, f"rid {kind}, field string, raw string, restored string").withColumnRenamed("rid", id_col)


def md5_hex(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()
