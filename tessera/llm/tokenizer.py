"""Encoding of the whole corpus with a public byte-level BPE tokenizer.

Method: a pair occurrence index. The distinct pieces of a batch of texts are laid out as linked lists of byte symbols;
an index maps each mergeable pair to all its positions. The active ranks are taken in ascending order from a heap; each
merge rewrites all positions of its pair from left to right and updates the lists and the index of the neighbours.
Pieces that were encoded before are remembered, within a bound. It is a narrow stage over Arrow batches: nothing is
shuffled, and what is broadcast is the merge table of the tokenizer.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The public pattern of byte-level BPE that cuts text into pieces.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pieces that a worker remembers at most, and the longest piece that it remembers.
REMEMBERED, LONGEST = 200_000, 64
#: Symbols that are laid out at once, so that the index of a batch is bounded.
LAID_OUT = 2_000_000


def _byte_chars() -> dict[int, str]:
    """The printable character by which a byte is written in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return out


@dataclass(frozen=True)
class Merges:
    """first and second symbol and result of each merge, by rank; ids of the bytes."""

    first: np.ndarray
    second: np.ndarray
    result: np.ndarray
    byte_ids: tuple[int, ...]


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def read_merges(path: str) -> Merges:
    """The merge table of a tokenizer file in the public JSON form."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    chars = _byte_chars()
    ids = lambda xs: np.array([vocab[x] for x in xs], dtype=np.int32)
    return Merges(ids(a for a, _ in pairs), ids(b for _, b in pairs), ids(a + b for a, b in pairs), tuple(vocab[chars[b]] for b in range(256)))


class Encoder:
    def __init__(self, merges: Merges):
        self.rank = {(a, b): r for r, (a, b) in enumerate(zip(merges.first.tolist(), merges.second.tolist()))}
        self.result = merges.result.tolist()
        self.pairs = list(zip(merges.first.tolist(), merges.second.tolist()))
        self.byte_ids = merges.byte_ids
        self.cut = regex.compile(PATTERN).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def encode_pieces(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """The ids of each piece."""
        symbol: list[int] = []
        heads: list[int] = []
        after: list[int] = []
        before: list[int] = []
        ids = self.byte_ids
        for p in pieces:
            heads.append(len(symbol))
            raw = p.encode("utf-8", "surrogatepass")
            n = len(symbol)
            symbol += [ids[b] for b in raw]
            m = len(symbol)
            after += [*range(n + 1, m), -1]
            before += [-1, *range(n, m - 1)]
        rank, get = self.rank, self.rank.get
        index: dict[int, list[int]] = {}
        for i, nxt in enumerate(after):
            if nxt >= 0 and (r := get((symbol[i], symbol[nxt]))) is not None:
                index.setdefault(r, []).append(i)
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            a, b = self.pairs[r]
            new = self.result[r]
            for i in sorted(index.pop(r)):
                j = after[i]
                # the position may have been merged since: then its symbol is another, or it is dead (-1)
                if j < 0 or symbol[i] != a or symbol[j] != b:
                    continue
                symbol[i] = new
                symbol[j] = -1
                k = after[i] = after[j]
                h = before[i]
                if k >= 0:
                    before[k] = i
                    if (x := get((new, symbol[k]))) is not None:
                        if x not in index:
                            index[x] = []
                            heapq.heappush(heap, x)
                        index[x].append(i)
                if h >= 0 and (x := get((symbol[h], new))) is not None:
                    if x not in index:
                        index[x] = []
                        heapq.heappush(heap, x)
                    index[x].append(h)
        out = []
        for i in heads:
            got = []
            while i >= 0:
                got.append(symbol[i])
                i = after[i]
            out.append(tuple(got))
        return out

    def learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of pieces not seen before, laid out in bounded lots."""
        found: dict[str, tuple[int, ...]] = {}
        lot: list[str] = []
        size = 0
        for p in pieces:
            lot.append(p)
            size += len(p)
            if size > LAID_OUT:
                found.update(zip(lot, self.encode_pieces(lot)))
                lot, size = [], 0
        if lot:
            found.update(zip(lot, self.encode_pieces(lot)))
        return found

    def encode_batch(self, texts: list[str | None]) -> tuple[array, array]:
        """(ids of all texts one after another, end of each text in them)."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self.cut(t) if t else [] for t in texts]
        fresh: set[str] = set()
        for c in cut:
            fresh.update(c)
        fresh.difference_update(self.known)
        found = self.learn(fresh)
        self.known.update((p, i) for p, i in found.items() if len(p) <= LONGEST)
        known = self.known.get
        ids, ends = array("i"), array("q", [0])
        for c in cut:
            for p in c:
                ids.extend(known(p) or found[p])
            ends.append(len(ids))
        return ids, ends

    def encode(self, text: str | None) -> list[int]:
        return list(self.encode_batch([text])[0])


def _batches(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most limit bytes of text each (a single longer text is a part of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(n)
    yield batch.slice(start)


def encoded(df: DataFrame, id_col: str, text_col: str, vocabulary: str | None = None, count_only: bool = False, keep: list[str] | None = None) -> DataFrame:
    """(id_col, keep..., ids array<int>), or n_tokens instead of ids, of every row.

    Null and empty texts have no tokens: an empty list, or 0. Special tokens are neither added nor recognised: their
    strings in a text are ordinary text. Repeated rows each give a row. Texts are encoded whole, however long. Extra
    columns are ignored, whatever their names. vocabulary is the path of a tokenizer file, read by the driver.
    """
    merges = df.sparkSession.sparkContext.broadcast(read_merges(vocabulary or default_vocabulary()))
    cache: list[Encoder] = []
    kept = keep or []
    src = df.select(F.col(id_col).alias("rid"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(kept)], F.col(text_col).cast("string").alias("text"))
    fields = [f for f in src.schema.fields if f.name != "text"]
    result = T.StructField("n_tokens", T.LongType()) if count_only else T.StructField("ids", T.ArrayType(T.IntegerType()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not cache:
            cache.append(Encoder(merges.value))
        for whole in batches:
            if not whole.num_rows:
                continue
            for b in _batches(whole, 8 << 20):
                ids, ends = cache[0].encode_batch(b.column("text").to_pylist())
                ends = np.frombuffer(ends, dtype=np.int64)
                if count_only:
                    out = pa.array(np.diff(ends))
                else:
                    out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(ids, dtype=np.int32) if len(ids) else np.empty(0, np.int32)))
                rest = [b.column(i) for i, n in enumerate(b.schema.names) if n != "text"]
                yield pa.RecordBatch.from_arrays([*rest, out], names=[*(f.name for f in fields), result.name])

    out = src.mapInArrow(encode, T.StructType([*fields, result]))
    return out.select(F.col("rid").alias(id_col), *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], result.name)
