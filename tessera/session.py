"""The user's entry: a session with a record store, global variables and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.engine import Engine
from tessera.plans.parser import parse


class Session:
    """Runs scripts of the pattern-query language.

    base: the directory of relative paths. strict: a missing key or a value of the wrong kind is an error when it is
    met; otherwise it is null. single_files: SAVE writes one file for a path, streaming through the driver; otherwise a
    directory of parts.
    """

    def __init__(self, spark: SparkSession, base: str | None = None, strict: bool = True, single_files: bool = True):
        self.engine = Engine(spark, base, strict, single_files)

    def query(self, script: str) -> DataFrame | None:
        """The result of the script's last statement, lazily; None for one that has only effects."""
        self.engine._sorted = False
        return self.engine.run(parse(script))

    def create(self, df: DataFrame) -> None:
        """Adds the rows of a DataFrame to the record store."""
        self.engine.create_from(df)
