"""Data quality over tables: drill-down counts, conformance to pattern lists, distinct values, rules, duplicate groups,
formulas, JSON schemas. Every report is one aggregate over all rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.schema_check import conforms
from tessera.functions.values import java_regex


def drill_down(df: DataFrame, *attributes: str) -> DataFrame:
    """(attributes..., n): the counts of all levels and the grand total (null below a level's end), values as strings.

    Rows count at every level; a null value is 'None'. One ROLLUP: the partial sums are combined before the exchange.
    """
    named = df.select(*[F.coalesce(F.col(a).cast("string"), F.lit("None")).alias(a) for a in attributes])
    return named.rollup(*attributes).agg(F.count("*").alias("n"))


def one_pattern(patterns: list[str]) -> str:
    """A list of patterns as one: the whole value must match one of them. Lines that begin with # are remarks."""
    kept = [p.strip() for p in patterns if not p.startswith("#")]
    return java_regex("^(?:" + "|".join(f"(?:{p})" for p in kept) + ")$") if kept else "(?!)"


def _all_like(attribute: str, rule: str) -> Column:
    return F.forall(F.col(attribute), lambda x: F.coalesce(x.rlike(rule), F.lit(False)))


def conformance(df: DataFrame, patterns: dict[str, list[str]], label: Column | None = None) -> DataFrame:
    """(attribute, passed, total, example): how many non-null values of each attribute conform to its patterns, and the
    lowest that doesn't. An array conforms if all its elements do. All attributes are counted in one pass."""
    parts = []
    for a, ps in patterns.items():
        rule = one_pattern(ps)
        is_array = isinstance(df.schema[a].dataType, T.ArrayType)
        ok = _all_like(a, rule) if is_array else F.col(a).cast("string").rlike(rule)
        shown = F.to_json(F.col(a)) if is_array else F.col(a).cast("string")
        text = F.concat(shown, F.lit(" ("), label, F.lit(")")) if label is not None else shown
        parts.append(F.struct(F.lit(a).alias("attribute"), F.col(a).isNotNull().alias("there"), ok.alias("ok"), text.alias("text")))
    long = df.select(F.explode(F.array(*parts)).alias("p")).select("p.*").where("there")
    return long.groupBy("attribute").agg(F.count_if("ok").alias("passed"), F.count("*").alias("total"), F.min(F.when(~F.col("ok"), F.col("text"))).alias("example"))


def nonconforming(df: DataFrame, attribute: str, patterns: list[str]) -> DataFrame:
    """The rows whose non-null value of the attribute matches none of the patterns."""
    return df.where(F.col(attribute).isNotNull() & ~F.col(attribute).rlike(one_pattern(patterns)))


def distinct_values(df: DataFrame, attribute: str) -> DataFrame:
    """(value): the different non-null values, those of arrays one by one."""
    is_array = isinstance(df.schema[attribute].dataType, T.ArrayType)
    values = df.select((F.explode(attribute) if is_array else F.col(attribute)).alias("value"))
    return values.where("value is not null").distinct()


def rule_violations(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(rule, n_checked, n_failed): implications 'for all rows with P, Q'. A conclusion that is null fails."""
    aggs = []
    for name, (premise, conclusion) in rules.items():
        holds = F.coalesce(premise, F.lit(False))
        aggs.append(F.struct(F.lit(name).alias("rule"), F.count_if(holds).alias("n_checked"), F.count_if(holds & ~F.coalesce(conclusion, F.lit(False))).alias("n_failed")))
    return df.agg(F.array(*aggs).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def violations(df: DataFrame, premise: Column, conclusion: Column) -> DataFrame:
    """The rows that break a rule."""
    return df.where(F.coalesce(premise, F.lit(False)) & ~F.coalesce(conclusion, F.lit(False)))


def duplicate_groups(df: DataFrame, summary: Column, name: str) -> DataFrame:
    """(summary, n, first_name, last_name): the summaries that more than one row has. Groups may be large, so they are
    counted, not collected."""
    groups = df.groupBy(summary.alias("summary")).agg(F.count("*").alias("n"), F.min(name).alias("first_name"), F.max(name).alias("last_name"))
    return groups.where("n > 1")


def duplicate_rows(df: DataFrame, summary: Column) -> DataFrame:
    """All rows whose summary more than one row has."""
    keyed = df.withColumn("__summary", summary)
    twice = keyed.groupBy("__summary").count().where("count > 1").select("__summary")
    return keyed.join(twice, "__summary", "left_semi").drop("__summary")


def formula_mismatches(df: DataFrame, actual: str, formula: Column) -> DataFrame:
    """The rows whose value isn't the formula's, with the formula's as column calculated; null equals null."""
    return df.withColumn("calculated", formula).where(~F.col(actual).eqNullSafe(F.col("calculated")))


def schema_errors(df: DataFrame, json_text: Column, schema: dict) -> DataFrame:
    """The rows whose JSON text doesn't conform to a JSON schema; a text that is no JSON doesn't."""
    parsed = F.try_parse_json(json_text)
    good = F.when(parsed.isNotNull(), conforms(F.coalesce(F.to_json(parsed), F.lit("null")), F.lit(json.dumps(schema)))).otherwise(False)
    return df.where(~good)
