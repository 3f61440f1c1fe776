"""Reverse templates over tables: HTML documents to nested records, on the executors."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.template import Template


def untemplated(df: DataFrame, id_col: str, html_col: str, template: str, max_tries: int | None = None) -> DataFrame:
    """(id_col, ok, result VARIANT, error) of every row: the document that the template makes of the text, or what was
    expected where. Null texts give ok null. A narrow stage; the template is compiled once for each task."""
    return _run(df.select(F.col(id_col).alias("rid"), F.lit("").alias("kind"), F.col(html_col).cast("string").alias("html")), {"": template}, max_tries, id_col)


def untemplated_by(df: DataFrame, id_col: str, html_col: str, kind_col: str, templates: dict[str, str], max_tries: int | None = None) -> DataFrame:
    """The same with a template for each kind of document; a kind without one is an error of the row."""
    return _run(df.select(F.col(id_col).alias("rid"), F.col(kind_col).cast("string").alias("kind"), F.col(html_col).cast("string").alias("html")), templates, max_tries, id_col)


def _run(src: DataFrame, templates: dict[str, str], max_tries: int | None, id_col: str) -> DataFrame:
    kind = src.schema["rid"].dataType.simpleString()
    for t in templates.values():
        Template(t)  # a wrong template is an error at once

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {k: Template(t, max_tries) for k, t in templates.items()}
        for b in batches:
            rows = []
            for rid, k, html in zip(b["rid"], b["kind"], b["html"]):
                if html is None:
                    rows.append((rid, None, None, None))
                elif k not in compiled:
                    rows.append((rid, False, None, f"no template for {k}"))
                else:
                    ok, got = compiled[k](html)
                    rows.append((rid, ok, json.dumps(got, ensure_ascii=False) if ok else None, None if ok else got))
            out = pd.DataFrame(rows, columns=["rid", "ok", "result", "error"])
            out["ok"] = out["ok"].astype("boolean")
            yield out

    out = src.mapInPandas(run, f"rid {kind}, ok boolean, result string, error string")
    return out.select(F.col("rid").alias(id_col), "ok", F.parse_json("result").alias("result"), "error")
