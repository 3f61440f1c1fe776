"""The registered queries of this subpackage; each takes (spark, directory of the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import canonical, encoding, lookalikes, mixing, reading, tokenizer
from tessera.operators.packed import split_packed
from tessera.sources.tables import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Every value that differs from its consistent form and isn't garbled."""
    card = table(spark, d, "card")
    forms = lookalikes.consistent_forms(card, "rec_id", ["name", "home_site"]).where("raw <> clean")
    garbled = encoding.garbled(card, "rec_id", ["name"], learn_from=["name", "text"]).select("rec_id", "field").distinct()
    return forms.join(garbled, ["rec_id", "field"], "left_anti").select("rec_id", "field", "clean")


def p3_forms(spark: SparkSession, d: str) -> DataFrame:
    """How often each consistent form of a name occurs, and in how many ways it is written."""
    card = table(spark, d, "card")
    forms = lookalikes.consistent_forms(card, "rec_id", ["name", "home_site"])
    return forms.groupBy("field", "clean").agg(F.count("*").alias("n"), F.count_distinct("raw").alias("n_written"))


def _entered(spark: SparkSession, d: str) -> DataFrame:
    """(rec_id, field, pos, value): every value of the three fields in its consistent form."""
    card = table(spark, d, "card")
    sites = table(spark, d, "site_ref")
    forms = lookalikes.representatives(lookalikes.count_units(card, ["race", "home_site", "site_type"]))
    sent = spark.sparkContext.broadcast(forms)
    cache: list[lookalikes.Rewriter] = []

    @F.pandas_udf("string")
    def rewrite(raw):  # noqa: ANN001, ANN202
        if not cache:
            cache.append(lookalikes.Rewriter(sent.value))
        return raw.map(cache[0], na_action="ignore")

    one = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("raw")) for f in ("race", "site_type")])).alias("p")
    single = card.select("rec_id", one).select("rec_id", "p.field", F.lit(1).alias("pos"), "p.raw").where("raw is not null")
    packed = split_packed(card, "rec_id", ["home_site"], "source", {"home_site": (sites, "site_name")}).select("rec_id", "field", "pos", F.col("item").alias("raw"))
    return single.unionByName(packed).select("rec_id", "field", "pos", lookalikes.rewritten(F.col("raw"), forms, rewrite).alias("value"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Every entered value that isn't exactly a listed one, with the entry that it means or ''."""
    refs = {
        "race": (table(spark, d, "race_ref"), "race_key", ["race"], ["race"], False),
        "home_site": (table(spark, d, "site_ref"), "site_key", ["site_name"], ["site_name"], False),
        "site_type": (table(spark, d, "site_type_ref"), "site_type", ["site_type"], ["site_type", "label"], True),
    }
    listed = None
    for f, (ref, _, exact, _, _) in refs.items():
        part = ref.select(F.lit(f).alias("field"), F.col(exact[0]).alias("value")).where("value is not null").distinct()
        listed = part if listed is None else listed.unionByName(part)
    rows = _entered(spark, d).join(listed, ["field", "value"], "left_anti").persist()
    answers = None
    for f, (ref, key, _, names, initials) in refs.items():
        part = canonical.nearest(rows.where(F.col("field") == f).select("value").distinct(), ref, key, names, initials)
        part = part.select(F.lit(f).alias("field"), "value", "ref_key")
        answers = part if answers is None else answers.unionByName(part)
    return canonical.with_keys(rows, ["field", "value"], answers).select("rec_id", "field", "pos", "ref_key")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Every garbled value with the MD5 of the original, or '' where it is lost."""
    got = encoding.garbled(table(spark, d, "card"), "rec_id", ["name", "text"])
    return got.select("rec_id", "field", F.when(F.col("restored") == "", "").otherwise(F.md5("restored")).alias("restored_md5"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """The token ids of every document."""
    return tokenizer.encoded(table(spark, d, "documents"), "doc_id", "text")


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("weight", mixing.quality(F.col("text")))
    return tokenizer.encoded(docs, "doc_id", "text", count_only=True, keep=["source", "weight"])


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """Every document of the mix and how many times it is used. The mix is as large as the listed sources' corpus."""
    docs, targets = _sized(spark, d).persist(), table(spark, d, "mix_target")
    return mixing.mixed(docs, targets, mixing.corpus_total(docs, targets))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The actual share of every listed source, what it lacks of its target and what of it is unused."""
    docs, targets = _sized(spark, d).persist(), table(spark, d, "mix_target")
    total = mixing.corpus_total(docs, targets)
    return mixing.shares(mixing.mixed(docs, targets, total), docs, targets, total)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Every document of running prose with its reading level."""
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "level_label")).select("doc_id", "band")


def p9_profile(spark: SparkSession, d: str) -> DataFrame:
    """The corpus by source and reading level."""
    docs = table(spark, d, "documents")
    levels = reading.reading_levels(docs, table(spark, d, "level_label"))
    return docs.select("doc_id", "source").join(levels, "doc_id").groupBy("source", "band").agg(F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.avg("difficulty").alias("mean_difficulty"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p3_found, p3_forms, p4_found, p5_found, p7_ids, p8_mix, p8_shares, p9_found, p9_profile)}


def oracle_sql() -> dict[str, str]:
    """None of these can be said in SQL; tests/llm holds brute-force versions, round trips and held-out accuracy."""
    return {}
