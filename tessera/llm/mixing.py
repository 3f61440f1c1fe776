"""Mixing sources to target weights, in tokens of a public tokenizer.

Method: Efraimidis-Spirakis sampling. Each document gets an exponential key scaled by its quality weight; within a
source the documents are taken in the order of the keys up to the source's token budget. Complete epochs come before a
fractional selection, and no document is used more often than its source allows. A document that exceeds what is left of
the budget is passed over, so that a very long one doesn't leave a source short.

The order within a source is never made in one task, as one source may hold a third of all documents. The keys of what
is left fall into FINE buckets, whose sums are aggregated and prefix-summed; the buckets before the one in which the
budget is exceeded are taken whole, that one is divided again if it holds more than BUCKET_DOCS documents and else
sorted, and the same goes on behind it with what is then left, until nothing that fits is left. What the driver holds is
a row for each source and round.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most documents of a source that are sorted in one task, and the buckets into which a range of keys is cut. Neither
#: changes which documents are taken.
BUCKET_DOCS, FINE = 5_000, 4_096
#: Listed sources at most; the list is broadcast. Beyond it an error is raised.
MAX_SOURCES = 100_000


def quality(text: Column) -> Column:
    """A weight in [0.05, 1]: short texts and texts of few letters count less. Built-in functions only."""
    n = F.length(text)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    share = F.least(F.lit(1.0), n / 400.0) * F.least(F.lit(1.0), letters / (F.greatest(n, F.lit(1)) * 0.75))
    return F.when(text.isNull(), 0.05).otherwise(F.greatest(F.lit(0.05), share))


def plan(sizes: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeat, available, budget, epochs, rest, wanted): what to take of each listed source.

    wanted: the source's target share (of the sum of the listed ones) of the mix, whether or not it has it.

    total: tokens of the mix. By default the most that all sources with documents can fill at their target shares, so
    that the shares come out as wished; the share of sources without any document falls to the others in proportion.
    That lets the scarcest source size the mix; corpus_total() is a total that follows the corpus. With a total given,
    a source that can't fill its share within max_repeat falls short, and the report says so.
    Listed twice, a source counts with its first share by value. Null shares and repeats count as 0.
    """
    sizes = sizes.select("source", "available", "n_docs")
    listed = targets.where("source is not null").groupBy("source").agg(F.min(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.min(F.coalesce("max_repeat", F.lit(0))).alias("max_repeat"))
    have = F.broadcast(listed).join(sizes, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    everything = Window.partitionBy(F.lit(0))  # a table of sources: at most MAX_SOURCES rows
    usable = (F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeat") > 0)
    share = F.when(usable, F.col("target_share") / F.sum(F.when(usable, F.col("target_share"))).over(everything)).otherwise(0.0)
    have = have.withColumn("share", share)
    most = F.min(F.when(usable, F.col("available") * F.col("max_repeat") / F.col("share"))).over(everything)
    size = F.lit(float(total)) if total is not None else F.coalesce(most, F.lit(0.0))
    budget = F.floor(F.least(F.col("share") * size + 1e-6, (F.col("available") * F.col("max_repeat")).cast("double")))
    out = have.withColumn("budget", budget).withColumn("epochs", F.when(usable, F.floor(F.col("budget") / F.col("available"))).otherwise(0))
    listed_share = F.greatest(F.col("target_share"), F.lit(0.0))
    all_shares = F.sum(listed_share).over(everything)
    out = out.withColumn("wanted", F.coalesce(F.floor(listed_share / F.when(all_shares > 0, all_shares) * size + 1e-6), F.lit(0)))
    return out.withColumn("rest", F.when(usable, F.col("budget") - F.col("epochs") * F.col("available")).otherwise(0)).drop("share")


def corpus_total(docs: DataFrame, targets: DataFrame) -> float:
    """All tokens of the sources listed with a share and a repeat, each document once: the total of a mix that no
    scarce source makes small. 0 if there are none."""
    usable = targets.where("source is not null").groupBy("source").agg(F.min(F.coalesce("target_share", F.lit(0.0))).alias("s"), F.min(F.coalesce("max_repeat", F.lit(0))).alias("r")).where("s > 0 and r > 0")
    used = docs.where("n_tokens > 0").join(F.broadcast(usable.select("source")), "source", "left_semi")
    return float(used.agg(F.sum("n_tokens")).first()[0] or 0)


def mixed(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of every document that is used at least once.

    docs: doc_id, source, n_tokens, weight. Documents of no or an unlisted source and documents without tokens aren't
    used. weight is a column given with the documents (quality() gives one if none is at hand); null or non-positive
    weights count as the least one. Equal keys are ordered by doc_id. The same input and seed give the same mix, whatever
    the partitions. Empty tables give an empty mix.
    """
    if targets.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    spark = docs.sparkSession
    names = F.broadcast(targets.select("source").where("source is not null").distinct())
    used = docs.select("doc_id", "source", "n_tokens", "weight").where("n_tokens > 0").join(names, "source", "left_semi")
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(1e-3)
    # the logarithm of an exponential key is spread over a few units whatever the weights
    keyed = used.withColumn("key", F.log(-F.log(u) / weight))
    sizes = keyed.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("n_docs"), F.min("key").alias("low"), F.max("key").alias("top")).persist()
    plans = plan(sizes, targets, total).where("available > 0 and max_repeat > 0").select("source", "epochs", "rest").join(F.broadcast(sizes), "source").collect()  # a row a source
    left = {r["source"]: int(r["rest"]) for r in plans}
    top = {r["source"]: r["top"] for r in plans}
    # by source: the keys that are looked at, from (exclusively) and up to
    look = {r["source"]: (float(np.nextafter(r["low"], -np.inf)), r["top"]) for r in plans if r["rest"] > 0}
    taken: dict[str, list[tuple[float, float, int]]] = {}  # keys from, up to: what has no more tokens is taken
    sorted_: dict[str, list[tuple[float, float]]] = {}  # keys from, up to: decided document by document
    kind = used.schema["doc_id"].dataType.simpleString()
    edges = None
    while look:
        state = spark.createDataFrame([(s, lo, hi, left[s]) for s, (lo, hi) in look.items()], "source string, lo double, hi double, left long")
        rest = keyed.join(F.broadcast(state), "source").where("key > lo and key <= hi")
        bucket = F.least(F.lit(FINE - 1), F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * FINE))
        sums = rest.groupBy("source", bucket.alias("bucket")).agg(F.sum(F.when(F.col("n_tokens") <= F.col("left"), F.col("n_tokens")).otherwise(0)).alias("tokens"), F.count("*").alias("n"), F.min("key").alias("first"), F.max("key").alias("last"), F.first("left").alias("left"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("upto", F.sum("tokens").over(upto)).withColumn("seen", F.sum("n").over(upto))
        exceeds = F.col("upto") > F.col("left")
        edge = F.min(F.when(exceeds, F.struct("bucket", "first", "last", "n", (F.col("upto") - F.col("tokens")).alias("before"), (F.col("seen") - F.col("n")).alias("ahead"))))
        at = sums.withColumn("edge", edge.over(Window.partitionBy("source")))
        # the bucket in which the budget is exceeded, with as many after it as can be sorted along with it
        along = F.max(F.when((F.col("bucket") >= F.col("edge.bucket")) & (F.col("seen") - F.col("edge.ahead") <= BUCKET_DOCS), F.col("last")))
        rows = at.groupBy("source").agg(F.first("edge").alias("edge"), along.alias("along"), F.sum("tokens").alias("tokens")).collect()
        fill: dict[str, tuple[float, float]] = {}
        following: dict[str, tuple[float, float]] = {}
        for r in rows:
            s, (lo, hi), e = r["source"], look[r["source"]], r["edge"]
            if e is None:  # all that fits fits together
                taken.setdefault(s, []).append((lo, hi, left[s]))
                left[s] -= int(r["tokens"])
                following[s] = (hi, top[s])
                continue
            start = float(np.nextafter(e["first"], -np.inf))
            taken.setdefault(s, []).append((lo, start, left[s]))
            left[s] -= int(e["before"])
            if e["n"] > BUCKET_DOCS and e["last"] > e["first"]:
                following[s] = (start, e["last"])
            else:
                fill[s] = (start, max(e["last"], r["along"] or e["last"]))
        if fill:
            state = spark.createDataFrame([(s, lo, hi, left[s]) for s, (lo, hi) in fill.items()], "source string, lo double, hi double, left long")
            part = keyed.join(F.broadcast(state), "source").where("key > lo and key <= hi")
            part = part.groupBy("source").applyInPandas(_fill, f"doc_id {kind}, source string, n_tokens long, more int").persist()
            used_up = {r["source"]: int(r["t"]) for r in part.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("more")).alias("t")).collect()}
            edges = part if edges is None else edges.unionByName(part)
            for s, (lo, hi) in fill.items():
                left[s] -= used_up.get(s, 0)
                sorted_.setdefault(s, []).append((lo, hi))
                following[s] = (hi, top[s])
        look = {s: (lo, hi) for s, (lo, hi) in following.items() if left[s] > 0 and lo < hi}
    ranges = "array<struct<lo:double,hi:double,most:long>>"
    steps = spark.createDataFrame([(r["source"], int(r["epochs"]), taken.get(r["source"], []), [(lo, hi, 0) for lo, hi in sorted_.get(r["source"], [])]) for r in plans], f"source string, epochs long, taken {ranges}, sorted {ranges}")
    at = keyed.join(F.broadcast(steps), "source")
    within = lambda x: (F.col("key") > x["lo"]) & (F.col("key") <= x["hi"])
    cols = ["doc_id", "source", F.col("n_tokens").cast("long").alias("n_tokens")]
    whole = at.where(~F.exists("sorted", within)).select(*cols, (F.col("epochs") + F.exists("taken", lambda x: within(x) & (F.col("n_tokens") <= x["most"])).cast("int")).cast("int").alias("copies"))
    if edges is not None:
        single = edges.join(F.broadcast(steps.select("source", "epochs")), "source").select(*cols, (F.col("epochs") + F.col("more")).cast("int").alias("copies"))
        whole = whole.unionByName(single)
    return whole.where("copies > 0")


def _fill(part: pd.DataFrame) -> pd.DataFrame:
    """Documents in the order of their keys: what still fits the budget is used once more."""
    part = part.sort_values(["key", "doc_id"], kind="stable")
    left = int(part["left"].iloc[0])
    more = []
    for n in part["n_tokens"]:
        more.append(int(n <= left))
        left -= n if n <= left else 0
    out = part[["doc_id", "source", "n_tokens"]].copy()
    out["more"] = np.array(more, dtype="int32")
    return out


def shares(mix: DataFrame, docs: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, max_repeat, available, budget, tokens, uses, docs, most_copies, actual_share, shortfall,
    unused) of every listed source. shortfall: tokens that the source lacks of its target share of the whole mix asked
    for; unused: tokens of its documents that aren't in the mix at all."""
    names = F.broadcast(targets.select("source").where("source is not null").distinct())
    sizes = docs.where("n_tokens > 0").join(names, "source", "left_semi").groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("n_docs"))
    got = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("uses"), F.count("*").alias("docs"), F.max("copies").alias("most_copies"), F.sum("n_tokens").alias("touched"))
    out = plan(sizes, targets, total).join(F.broadcast(got), "source", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("available", "budget", "tokens", "uses", "docs", "most_copies")}
    all_tokens = F.sum(F.coalesce("tokens", F.lit(0))).over(Window.partitionBy(F.lit(0)))
    short = F.greatest(F.lit(0), F.col("wanted") - F.coalesce("tokens", F.lit(0)))
    return out.select("source", "target_share", "max_repeat", *zero.values(), F.coalesce(F.coalesce("tokens", F.lit(0)) / F.when(all_tokens > 0, all_tokens), F.lit(0.0)).alias("actual_share"), short.cast("long").alias("shortfall"), (F.col("available") - F.coalesce("touched", F.lit(0))).cast("long").alias("unused"))
