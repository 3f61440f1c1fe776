"""Reading and writing documents.

JSON: a file is one document. JSONL: a line is one. TEXT: a line is one string, empty lines too. PARQUET, CSV and ORC
are extensions: a row is one document, of the typed lane. Paths may hold captures; they are resolved to a glob, and what
was captured is a variable, so that a bound one selects the files before anything is read.
"""

from __future__ import annotations

import glob as globbing
import os
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.values import VARIANT, Val
from tessera.plans.frame import Frame, fresh


def _local(path: str) -> bool:
    return "://" not in path or path.startswith("file://")


def absolute(path: str, base: str | None) -> str:
    path = path.replace("\\", "/")
    if "://" in path or path.startswith("/"):
        return path
    return os.path.join(base or os.getcwd(), path)


def plain_path(metadata: Column) -> Column:
    """The path of a file as it was given: without scheme, decoded."""
    return F.url_decode(F.replace(F.regexp_replace(metadata, r"^file:/+", "/"), F.lit("+"), F.lit("%2B")))


def existing(pattern: str) -> list[str]:
    """The files of a glob, sorted by path; a remote one is left to Spark."""
    if not _local(pattern):
        return [pattern]
    return sorted(p for p in globbing.glob(pattern.removeprefix("file://")) if not os.path.basename(p).startswith((".", "_")))


def read_documents(spark: SparkSession, fmt: str, paths: list[str], ordered: bool = True, with_path: bool = True) -> Frame:
    """A frame with the document as variable '$doc', and the file's path as '$path', ordered by file and position.

    Positions and paths are columns that a scan must make: they are left out where nothing asks for them.
    """
    f = _read(spark, fmt, paths, ordered, with_path)
    return f if with_path else Frame(f.df, {"$doc": f.env["$doc"]}, f.order)


def _read(spark: SparkSession, fmt: str, paths: list[str], ordered: bool, with_path: bool) -> Frame:
    if not paths:
        empty = spark.createDataFrame([], f"{(d := fresh('d'))} variant, {(p := fresh('p'))} string, {(o := fresh('o'))} bigint")
        return Frame(empty, {"$doc": Val(F.col(d), VARIANT), "$path": Val(F.col(p), T.StringType())}, (o,))
    file = plain_path(F.col("_metadata.file_path")) if with_path else F.lit("")
    p, d = fresh("p"), fresh("d")
    if fmt in ("JSON", "JSONL", "TEXT"):
        raw = spark.read.text(paths, wholetext=fmt == "JSON")
        doc = F.col("value") if fmt == "TEXT" else F.parse_json("value")
        df = raw if fmt != "JSONL" else raw.where(r"value rlike '\\S'")
        position = _position() if ordered else {}
        df = df.select(*[c.alias(n) for n, c in position.items()], file.alias(p), doc.alias(d))
        return Frame(df, {"$doc": Val(F.col(d), T.StringType() if fmt == "TEXT" else VARIANT), "$path": Val(F.col(p), T.StringType())}, tuple(position))
    raw = spark.read.csv(paths, header=True) if fmt == "CSV" else spark.read.format(fmt.lower()).load(paths)
    order: dict[str, Column] = {}
    if ordered and fmt == "PARQUET":
        order = {fresh("o"): plain_path(F.col("_metadata.file_path")), fresh("o"): F.col("_metadata.row_index")}
    elif ordered:
        order = _position()
    extra = [c.alias(n) for n, c in order.items()] + ([file.alias(p)] if with_path else [])
    df = raw.select("*", *extra) if extra else raw
    whole = Val(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), raw.schema)
    return Frame(df, {"$doc": whole, "$path": Val(F.col(p), T.StringType()) if with_path else Val(F.lit(""), T.StringType())}, tuple(order))


def _position() -> dict[str, Column]:
    """Where a line stands: by path, then by the split's offset in the file, then within the split. Splits are packed
    into tasks by size, so the number of the task tells nothing."""
    return {fresh("o"): plain_path(F.col("_metadata.file_path")), fresh("o"): F.col("_metadata.file_block_start"), fresh("o"): F.monotonically_increasing_id()}


def template_glob(literals: tuple[str, ...]) -> str:
    return "*".join(re.sub(r"([*?\[\]])", r"[\1]", x) for x in literals)


class Files:
    """The file system of a path, as the cluster has it: nothing is written to the disk of one machine but where the
    path itself is local."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)
        self.fs.setWriteChecksum(False)

    def path(self, path: str):  # noqa: ANN201
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, directory: str, prefix: str) -> list[str]:
        return sorted(n for x in self.fs.listStatus(self.path(directory)) if (n := x.getPath().getName()).startswith(prefix))

    def put(self, parts: list[str], target: str) -> None:
        """The parts in order as one file; a single part is only renamed, more are copied by the driver's JVM in blocks,
        each deleted then, so that no more than one part's lines stand there twice."""
        to = self.path(target)
        self.fs.mkdirs(to.getParent())
        if len(parts) == 1:
            self.fs.delete(to, True)
            self.fs.rename(self.path(parts[0]), to)
            return
        tmp = self.path(f"{target}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(tmp)
        for part in parts:
            source = self.fs.open(self.path(part))
            self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, self.conf, False)
            source.close()
            self.fs.delete(self.path(part), False)
        out.close()
        self.fs.delete(to, True)
        self.fs.rename(tmp, to)

    def move(self, source: str, target: str) -> None:
        to = self.path(target)
        self.fs.mkdirs(to.getParent())
        self.fs.delete(to, True)
        self.fs.rename(self.path(source), to)

    def drop(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def write_lines(df: DataFrame, line: Column, order: list[str], path: str, single: bool) -> None:
    """The lines in order: a directory of parts whose names sort in order, or one file of them."""
    out = df.select(line.alias("value"), *order)
    out = (out.repartitionByRange(*order).sortWithinPartitions(*order) if order else out).select("value")
    if not single:
        out.write.mode("overwrite").text(path)
        return
    files, tmp = Files(df.sparkSession, path), f"{path}.{uuid.uuid4().hex}.parts"
    try:
        out.write.text(tmp)
        files.put([f"{tmp}/{n}" for n in files.names(tmp, "part-")], path)
    finally:
        files.drop(tmp)


def write_routed(df: DataFrame, path: Column, line: Column, order: list[str], base: str, single: bool) -> None:
    """Each line into the file that its path names, or into a directory of parts under that name. Spark's writer makes
    the parts of each path under base, in shared storage; a path of many lines is written by several tasks."""
    files, tmp = Files(df.sparkSession, base), f"{base.rstrip('/')}/.{uuid.uuid4().hex}.parts"
    named = F.when(path.isNull(), F.raise_error(F.lit("SAVE: a path is null"))).otherwise(path)
    # lines are made behind the exchange: what samples the order for it doesn't make them, too
    p = fresh("p")
    out = df.withColumn(p, named).repartitionByRange(p, *order).sortWithinPartitions(p, *order).select(p, line.alias("value"))
    try:
        out.write.partitionBy(p).text(tmp)
        for directory in files.names(tmp, f"{p}="):
            parts, target = f"{tmp}/{directory}", unquote(directory.removeprefix(f"{p}="))
            if single:
                files.put([f"{parts}/{n}" for n in files.names(parts, "part-")], target)
            else:
                files.move(parts, target)
    finally:
        files.drop(tmp)


# -- the same outside of the query language


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT document a line."""
    return spark.read.text(path).where(r"value rlike '\\S'").select(F.parse_json("value").alias("doc"))


def read_all_jsonl(spark: SparkSession, directory: str, without: str = "index.jsonl") -> DataFrame:
    """The documents of every JSONL file of a directory but the index, with the file."""
    files = [p for p in existing(f"{directory}/*.jsonl") if os.path.basename(p) != without]
    f = read_documents(spark, "JSONL", files)
    return f.df.select(f.env["$path"].col.alias("path"), f.env["$doc"].col.alias("doc"))


def dump_jsonl(df: DataFrame, path: str, single: bool = True) -> None:
    """A row as a line of JSON."""
    write_lines(df, F.to_json(F.struct("*")), [], path, single)
