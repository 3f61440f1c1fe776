"""Schemas that drift between files: one consistent table of all records and a report of each change.

Plan. Records are loaded as path-value maps with raw JSON types (VARIANT). (1) One pass aggregates path and type
statistics by file; what follows works on them, a small table. (2) Each file's statistics stand against those of its
predecessor in the feed: a path on one side only was added or removed, one with other types was retyped. (3) A second
pass reads, of the records of files in which one path went and another came, only the removed and added paths, as hashes,
and groups them by (file, entity): a removed and an added path that hold the same values for the same entities are one
renamed path. No pairs of paths are formed but within one entity. (4) The names that were renamed into each other form
classes over all feeds; the consistent table projects one typed column per class and reports the casts that failed.

A feed with a third of all records is spread by (file, entity); only the ends of its months are ordered in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A removed and an added path are one if at least this share of the entities that could agree do.
SAME_SHARE = 0.35
#: Different pairs of renamed names of all files together (not records) that are taken to the driver to form classes;
#: beyond it an error is raised.
MAX_NAMES = 100_000
#: Up to this many files whose paths must be read again, their list is broadcast; beyond, hashes of all paths are joined.
BROADCAST_FILES = 200_000
TYPES = ("array", "boolean", "number", "object", "string")
#: Stands for a null feed or file name while files are compared.
NOTHING = "\x00"


def _json_type(v: Column) -> Column:
    t = F.schema_of_variant(v)
    return (
        F.when(t == "VOID", None)
        .when(t == "STRING", "string")
        .when(t == "BOOLEAN", "boolean")
        .when(t.startswith("OBJECT"), "object")
        .when(t.startswith("ARRAY"), "array")
        .otherwise("number")
    )


def _as_map(v: Column) -> Column:
    """An object's keys and values; null for anything else."""
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v).cast("map<string,variant>")


def _below(e: Column) -> Column:
    """The paths one level below a (key, value): of an object's keys 'a.b', of an array's elements 'a[]'."""
    entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    of_object = F.transform(F.map_entries(_as_map(e["value"])), lambda x: entry(F.concat(e["key"], F.lit("."), x["key"]), x["value"]))
    as_array = F.when(F.schema_of_variant(e["value"]).startswith("ARRAY"), e["value"]).cast("array<variant>")
    of_array = F.transform(as_array, lambda x: entry(F.concat(e["key"], F.lit("[]")), x))
    return F.coalesce(of_object, of_array, F.array().cast("array<struct<key:string,value:variant>>"))


def _paths(record: Column, depth: int) -> Column:
    """(key, value) of every path of an object down to depth levels."""
    level = F.map_entries(_as_map(record))
    out = level
    for _ in range(depth - 1):
        level = F.flatten(F.transform(level, _below))
        out = F.concat(out, level)
    return out


def _named(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(NOTHING))


def path_values(df: DataFrame, feed: str, file: str, payload: str, keep: list[Column] | None = None, depth: int = 1) -> DataFrame:
    """(feed, file, path, value VARIANT, type) and the columns in keep; payloads that are no JSON object give one row
    without a path."""
    parsed = df.select(_named(feed).alias("feed"), _named(file).alias("file"), *(keep or []), F.try_parse_json(F.col(payload)).alias("record"))
    others = [c for c in parsed.columns if c != "record"]
    rows = parsed.select(*others, F.explode_outer(_paths(F.col("record"), depth)).alias("e"))
    return rows.select(*others, F.col("e.key").alias("path"), F.col("e.value").alias("value")).withColumn("type", _json_type(F.col("value")))


def file_statistics(df: DataFrame, feed: str, file: str, payload: str, at: str, depth: int = 1) -> DataFrame:
    """(feed, file, path, types, n, at): the JSON types of the non-null values, the number of values of the path and the
    earliest time. A file without any field has one row with the path null."""
    rows = path_values(df, feed, file, payload, [F.col(at).alias("at")], depth)
    flags = [F.max(F.col("type") == t).alias(t) for t in TYPES]
    stats = rows.groupBy("feed", "file", "path").agg(*flags, F.count("*").alias("n"), F.min("at").alias("at"))
    return stats.select("feed", "file", "path", F.array_compact(F.array(*[F.when(F.col(t), t) for t in TYPES])).alias("types"), "n", "at")


def _files(stats: DataFrame) -> DataFrame:
    """(feed, file, prev, next): the files of each feed by time; prev is null for the first, next for the last.

    Neighbours are found within the months of a feed, and between months through the ends of each: a feed with a third
    of all files isn't sorted in one task.
    """
    files = stats.groupBy("feed", "file").agg(F.min("at").alias("at")).withColumn("month", F.coalesce(F.date_trunc("month", "at").cast("string"), F.lit("")))
    near = Window.partitionBy("feed", "month").orderBy("at", "file")
    within = files.select("feed", "month", "file", F.lag("file").over(near).alias("p"), F.lead("file").over(near).alias("n"))
    place = F.struct("at", "file")
    ends = files.groupBy("feed", "month").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    months = Window.partitionBy("feed").orderBy("month")
    ends = ends.select("feed", "month", F.lag("last.file").over(months).alias("before"), F.lead("first.file").over(months).alias("after"))
    return within.join(ends, ["feed", "month"]).select("feed", "file", F.coalesce("p", "before").alias("prev"), F.coalesce("n", "after").alias("next"))


def schema_changes(df: DataFrame, feed: str, file: str, at: str, payload: str, entity: str, depth: int = 1) -> DataFrame:
    """(feed, file, change, old_field, new_field): every change from the feed's previous file by time.

    change is 'added' (old_field ''), 'removed' (new_field ''), 'renamed' or 'retyped' (old_field = new_field). A
    feed's first file has none. depth: levels of nested paths ('a.b', 'a[]') that count as fields; 1 is the keys of the
    record. Null payloads, payloads that aren't objects and objects that hold a key twice count as records without
    fields. Repeated records count once. Files of one time are ordered by name, files without a time come first. Null
    feeds are one feed, null file names one file of each feed. An empty table gives an empty result.
    """
    stats = file_statistics(df, feed, file, payload, at, depth).persist()  # a row for each path of each file
    with_files = stats.where("path is not null").select("feed", "file", "path", "types").join(_files(stats), ["feed", "file"])
    # each path of a file stands against the file itself and against the next one
    none = F.lit(None).cast("array<string>")
    here = F.struct(F.col("file").alias("file"), F.col("prev").alias("prev"), F.col("types").alias("new_types"), none.alias("old_types"))
    there = F.struct(F.col("next").alias("file"), F.col("file").alias("prev"), none.alias("new_types"), F.col("types").alias("old_types"))
    sides = with_files.select("feed", "path", F.explode(F.array(here, there)).alias("s")).select("feed", "path", "s.*").where("file is not null and prev is not null")
    both = sides.groupBy("feed", "file", "prev", "path").agg(F.max("old_types").alias("old_types"), F.max("new_types").alias("new_types"))
    change = (
        F.when(F.col("old_types").isNull(), "added")
        .when(F.col("new_types").isNull(), "removed")
        .when((F.size("old_types") > 0) & (F.size("new_types") > 0) & (F.col("old_types") != F.col("new_types")), "retyped")
    )
    changes = both.select("feed", "file", "prev", "path", change.alias("change")).where("change is not null").persist()
    renamed = _renames(df, feed, file, payload, entity, changes, depth)
    # a renamed path is the removed and the added one: all three meet in one group of the path
    ends = renamed.select("feed", "file", F.explode(F.array(F.struct(F.col("old_field").alias("path"), F.lit("removed").alias("change"), F.col("new_field").alias("other")), F.struct(F.col("new_field").alias("path"), F.lit("added").alias("change"), F.lit(None).cast("string").alias("other")))).alias("e"))
    tagged = changes.select("feed", "file", "path", "change", F.lit(None).cast("string").alias("other"), F.lit(0).alias("r")).unionByName(ends.select("feed", "file", "e.*", F.lit(1).alias("r")))
    met = tagged.groupBy("feed", "file", "path", "change").agg(F.max("other").alias("other"), F.max("r").alias("r")).where("r = 0 or other is not null")
    blank = F.lit("")
    return met.select(
        F.nullif("feed", F.lit(NOTHING)).alias("feed"),
        F.nullif("file", F.lit(NOTHING)).alias("file"),
        F.when(F.col("r") == 1, "renamed").otherwise(F.col("change")).alias("change"),
        F.when(F.col("change") == "added", blank).otherwise(F.col("path")).alias("old_field"),
        F.when(F.col("r") == 1, F.col("other")).when(F.col("change") == "removed", blank).otherwise(F.col("path")).alias("new_field"),
    )


def _needed(df: DataFrame, feed: str, file: str, payload: str, entity: str, need: DataFrame, depth: int) -> DataFrame:
    """(feed, at_file, entity, new, path, v): the hashed values of the removed and added paths, by entity."""
    by_file = need.groupBy("feed", "file").agg(F.collect_list(F.struct("path", "at_file", "new")).alias("wanted"))
    entity_of = lambda m: F.try_variant_get(F.try_element_at(m, F.lit(entity)), "$", "string")
    hashed = lambda v: F.xxhash64(F.to_json(v))
    if by_file.limit(BROADCAST_FILES + 1).count() > BROADCAST_FILES or depth > 1:
        keyed = [entity_of(_as_map(F.try_parse_json(F.col(payload)))).alias("entity")]
        values = path_values(df, feed, file, payload, keyed, depth).where("type is not null and entity is not null")
        return values.select("feed", "file", "path", "entity", hashed(F.col("value")).alias("v")).join(need, ["feed", "file", "path"]).select("feed", "at_file", "entity", "new", "path", "v")
    rows = df.select(_named(feed).alias("feed"), _named(file).alias("file"), F.col(payload).alias("payload")).join(F.broadcast(by_file), ["feed", "file"])
    rows = rows.select("feed", "wanted", _as_map(F.try_parse_json("payload")).alias("record"))
    rows = rows.select("feed", entity_of(F.col("record")).alias("entity"), "record", F.explode("wanted").alias("w")).where("entity is not null")
    rows = rows.select("feed", "entity", "w.at_file", "w.new", "w.path", F.try_element_at("record", F.col("w.path")).alias("value"))
    return rows.where(F.col("value").isNotNull() & ~F.is_variant_null("value")).select("feed", "at_file", "entity", "new", "path", hashed(F.col("value")).alias("v"))


def _renames(df: DataFrame, feed: str, file: str, payload: str, entity: str, changes: DataFrame, depth: int) -> DataFrame:
    """(feed, file, old_field, new_field): removed and added paths of a file that are one."""
    swap = Window.partitionBy("feed", "file")
    moved = changes.where("change in ('added', 'removed')")
    # only files in which one path went and another came can hold a renamed one
    moved = moved.withColumn("kinds", F.size(F.collect_set("change").over(swap))).where("kinds = 2")
    need = moved.select("feed", F.col("file").alias("at_file"), "path", F.when(F.col("change") == "removed", F.col("prev")).otherwise(F.col("file")).alias("file"), (F.col("change") == "added").alias("new"))
    rows = _needed(df, feed, file, payload, entity, need, depth)
    # the changed fields of one entity in both files
    one = rows.groupBy("feed", "at_file", "entity").agg(F.collect_set(F.struct("new", "path", "v")).alias("f"))
    old, new = F.filter("f", lambda x: ~x["new"]), F.filter("f", lambda x: x["new"])
    one = one.select("feed", "at_file", old.alias("o"), new.alias("n")).where("size(o) > 0 and size(n) > 0")
    nothing = F.lit(None).cast("string")
    pair = lambda a, b: F.struct(a.alias("old_field"), b.alias("new_field"))
    same = F.flatten(F.transform("o", lambda x: F.transform(F.filter("n", lambda y: y["v"] == x["v"]), lambda y: pair(x["path"], y["path"]))))
    told = F.array_distinct(F.concat(same, F.transform("o", lambda x: pair(x["path"], nothing)), F.transform("n", lambda y: pair(nothing, y["path"]))))
    counts = one.select("feed", "at_file", F.explode(told).alias("p")).groupBy("feed", F.col("at_file").alias("file"), "p.old_field", "p.new_field").count()
    n_old = F.max(F.when(F.col("new_field").isNull(), F.col("count"))).over(Window.partitionBy("feed", "file", "old_field"))
    n_new = F.max(F.when(F.col("old_field").isNull(), F.col("count"))).over(Window.partitionBy("feed", "file", "new_field"))
    scored = counts.withColumn("n_old", n_old).withColumn("n_new", n_new).where("old_field is not null and new_field is not null")
    scored = scored.withColumn("share", F.col("count") / F.least("n_old", "n_new")).where(F.col("share") >= SAME_SHARE)
    best = lambda own, other: Window.partitionBy("feed", "file", own).orderBy(F.desc("share"), F.desc("count"), other)
    ranked = scored.withColumn("ro", F.row_number().over(best("old_field", "new_field"))).withColumn("rn", F.row_number().over(best("new_field", "old_field")))
    return ranked.where("ro = 1 and rn = 1").select("feed", "file", "old_field", "new_field")


def field_classes(changes: DataFrame, wanted: list[str]) -> dict[str, str]:
    """Every name of a wanted field -> that field: names that were renamed into each other in any feed are one class.

    Only distinct pairs of names are collected, at most MAX_NAMES.
    """
    pairs = changes.where("change = 'renamed'").select("old_field", "new_field").distinct().limit(MAX_NAMES + 1).collect()
    if len(pairs) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} pairs of field names")
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r in sorted(pairs):
        a, b = root(r["old_field"]), root(r["new_field"])
        if a != b:
            # a wanted name is the name of its class; two wanted names are never one
            if a in wanted and b in wanted:
                continue
            parent[a if b in wanted else b] = b if b in wanted else a
    return {x: root(x) for x in list(parent) if root(x) in wanted} | {x: x for x in wanted}


def unified(df: DataFrame, payload: str, names: dict[str, str], types: dict[str, str], keep: list[str]) -> DataFrame:
    """One consistent table: keep, a typed column for each field of types, and failed: the names of the fields whose
    value couldn't be cast, that hold several values, or of which the record has several names with different values.

    names maps the names in the files to fields, whatever characters they hold; objects with a 'value' and arrays of one
    element stand for that value; longer arrays and other objects give null and are reported. Where a record has a field
    under two names the first by name counts. The JSON is parsed once.
    """
    keep_as = {c: f"__k{i}" for i, c in enumerate(keep)}
    rows = df.select(*[F.col(c).alias(n) for c, n in keep_as.items()], _as_map(F.try_parse_json(F.col(payload))).alias("__m"))
    present, several = [], {}
    for i, field in enumerate(types):
        held = [F.try_element_at("__m", F.lit(n)) for n in sorted(n for n, f in names.items() if f == field)]
        given = F.filter(F.array(*held), lambda v: v.isNotNull() & ~F.is_variant_null(v)) if held else F.array().cast("array<variant>")
        present.append(given.alias(f"__g{i}"))
        several[field] = len(held) > 1
    rows = rows.select(*keep_as.values(), *present)
    raws = [F.get(f"__g{i}", F.lit(0)).alias(f"__r{i}") for i in range(len(types))]
    twice = [(F.size(F.array_distinct(F.transform(f"__g{i}", lambda v: F.to_json(v)))) > 1 if several[f] else F.lit(False)).alias(f"__d{i}") for i, f in enumerate(types)]
    rows = rows.select(*keep_as.values(), *raws, *twice)
    inner = []
    for i in range(len(types)):
        raw, t = F.col(f"__r{i}"), F.schema_of_variant(f"__r{i}")
        listed = F.when(t.startswith("ARRAY"), raw).cast("array<variant>")
        plain = F.when(t.startswith("OBJECT"), F.try_variant_get(raw, "$.value", "variant")).when(t.startswith("ARRAY"), F.when(F.size(listed) == 1, F.get(listed, F.lit(0)))).otherwise(raw)
        inner.append(plain.alias(f"__v{i}"))
    rows = rows.select(*keep_as.values(), *[f"__d{i}" for i in range(len(types))], *[F.col(f"__r{i}").isNotNull().alias(f"__h{i}") for i in range(len(types))], *inner)
    values = [F.try_variant_get(f"__v{i}", "$", kind).alias(f"__c{i}") for i, kind in enumerate(types.values())]
    rows = rows.select(*keep_as.values(), *[f"__d{i}" for i in range(len(types))], *[f"__h{i}" for i in range(len(types))], *values)
    failed = [F.when((F.col(f"__h{i}") & F.col(f"__c{i}").isNull()) | F.col(f"__d{i}"), F.lit(f)) for i, f in enumerate(types)]
    return rows.select(*[F.col(n).alias(c) for c, n in keep_as.items()], *[F.col(f"__c{i}").alias(f) for i, f in enumerate(types)], F.array_compact(F.array(*failed)).alias("failed"))
