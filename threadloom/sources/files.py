"""File formats of a store: reader and writer options that lose nothing."""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import relaxed
from . import ranges

# Store names and the file format behind each.
FORMATS = {"table": "parquet", "parquet": "parquet", "sqlite": "parquet", "json": "json", "csv": "csv"}

_PLAIN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Both kinds of timestamps keep their microseconds.
_TIMES = {"timestampFormat": _PLAIN + "XXX", "timestampNTZFormat": _PLAIN}
_CSV = {
    "header": "true",
    "escape": '"',
    "nullValue": r"\N",
    # An empty text is written as "" and must not come back as null.
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    **_TIMES,
}
# A damaged file is an error; the default mode would read it as nulls.
_STRICT = {"mode": "FAILFAST"}
_READ = {"json": {**_TIMES, **_STRICT}, "csv": {**_CSV, **_STRICT, "multiLine": "true"}, "parquet": {}}
_WRITE = {
    "json": {**_TIMES, "ignoreNullFields": "true"},
    # Texts contain line breaks, so a CSV file cannot be split by a reader:
    # bounding the rows per file bounds the work of one reading task.
    "csv": {**_CSV, "emptyValue": '""', "maxRecordsPerFile": "500000"},
    "parquet": {},
}


def file_format(name: str) -> str:
    """The file format for a store name, in any case."""
    try:
        return FORMATS[name.lower()]
    except KeyError:
        raise ValueError(f"no file format is known as {name!r}") from None


def _escaped(df: DataFrame, kind: str, pattern: str, change: str) -> DataFrame:
    """A CSV field of nothing but ``\\N`` is null, so a text like that gets one more backslash."""
    if kind != "csv":
        return df
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]

    def changed(text):  # few texts hold the mark, and a substring test is far cheaper than a pattern
        return F.when(F.contains(text, F.lit("\\N")), F.regexp_replace(text, pattern, change)).otherwise(text)

    return df.withColumns({n: changed(F.col(f"`{n}`")) for n in texts})


def read_files(
    spark: SparkSession, fmt: str, paths: str | list[str], schema: T.StructType
) -> DataFrame:
    """Read with an explicit schema: inference would turn an id ``1e5`` into a number."""
    kind = file_format(fmt)
    rows = spark.read.format(kind).options(**_READ[kind]).schema(relaxed(schema)).load(paths)
    return _escaped(rows, kind, r"^\\(\\+N)$", "$1")


def write_files(df: DataFrame, fmt: str, path: str, mode: str = "errorifexists") -> None:
    kind = file_format(fmt)
    escaped = _escaped(df, kind, r"^(\\+N)$", r"\\$1")
    escaped.write.format(kind).options(**_WRITE[kind]).mode(mode).save(path)


def import_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read files that hold one JSON array of objects each, with ISO-8601 timestamps.

    A file of any size is read by many tasks, each one byte range (see
    ``ranges``); records are parsed by Spark.  A file that does not end with its
    array, an element that is no object and a damaged record are errors.  The
    files are read once here and twice when the rows are asked for.
    """
    fragments = ranges.read_fragments(spark, path, ranges.JSON_ARRAY)
    states = ranges.range_states(fragments, ranges.JSON_ARRAY)
    ranges.check_ends(states, ranges.JSON_ARRAY)
    found = ranges.records(fragments, states, ranges.JSON_ARRAY, ranges.json_record)
    return found.select(F.from_json("text", relaxed(schema), _STRICT).alias("record")).select("record.*")


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read CSV files written by other tools, where an empty field means null.

    Columns are taken by each file's own header, in any order; a column that a
    file lacks is null there.  Columns outside ``schema`` are read as text.  A file
    of any size is read by many tasks, also where fields hold line breaks:
    quotes are counted by byte range (see ``ranges``).  Fields with quotes or line breaks
    must be quoted, quotes in them doubled.  All headers come from the pass
    that counts, and files with different headers are parsed side by side.
    """
    kinds = {f.name: f.dataType for f in schema}
    options = {"escape": '"', "multiLine": "true", **_STRICT}
    fragments = ranges.read_fragments(spark, path, ranges.CSV)
    states = ranges.range_states(fragments, ranges.CSV)
    ranges.check_ends(states, ranges.CSV)
    heads = {r["path"]: r["first"] for r in states.where(F.col("start") == 0).select("path", "first").collect()}
    if any(head is None for head in heads.values()):  # longer than a range
        found = ranges.records(fragments, states, ranges.CSV, ranges.csv_record)
        heads |= {r["path"]: r["text"] for r in found.where("first").select("path", "text").collect()}
    groups: dict[str, list[str]] = {}
    for file, head in heads.items():
        groups.setdefault((head or "").removeprefix("\ufeff").removesuffix("\r"), []).append(file)
    if "" in groups:
        raise ValueError(f"{groups[''][0]} has no header in its first line")
    found = ranges.records(fragments, states, ranges.CSV, ranges.csv_record).where(~F.col("first"))
    named = [(file, i) for i, (_, files) in enumerate(sorted(groups.items())) for file in files]
    headers = spark.createDataFrame(named, "path string, header int")
    parsed, columns = [], {}
    for i, header in enumerate(sorted(groups)):
        names = next(csv.reader(io.StringIO(header, newline="")))
        fields = {n: kinds.get(n, T.StringType()) for n in names}
        ddl = ", ".join(f"`{n.replace('`', '``')}` {kind.simpleString()}" for n, kind in fields.items())
        parsed.append(F.when(F.col("header") == i, F.from_csv("text", ddl, options)).alias(f"by{i}"))
        for name, kind in fields.items():
            columns.setdefault(name, (kind, []))[1].append(F.col(f"by{i}").getField(name))
    if not parsed:
        return spark.createDataFrame([], relaxed(schema))
    # One header is the rule; files with others are parsed in the same pass.
    marked = found.withColumn("header", F.lit(0)) if len(groups) == 1 else found.join(headers, "path")
    return marked.select(*parsed).select(*[F.coalesce(*values).alias(n) for n, (_, values) in columns.items()])
