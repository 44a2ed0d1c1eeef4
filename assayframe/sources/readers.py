"""Scans of public-record dumps, ledgers, reports and pages.  Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assayframe.functions.text import snake_name
from assayframe.operators.dedupe import latest_values

#: Lines of a report that are put in order at once; a power of two.
STRETCH = 1 << 16


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, rename: Mapping[str, str] | None = None, sep: str = ",", encoding: str = "UTF-8", skip_bad: bool = False, missing_ok: bool = False) -> DataFrame:
    """Delimited text with a header, projected to the schema's columns and renamed.

    ``skip_bad`` drops lines that don't fit; ``missing_ok`` gives an empty
    table where there is no such path.  Files of little-endian UTF-16 with
    lines that end with CR LF are split too (no line's end inside a value, and
    header names are not compared); other UTF-16 files are one task each.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "DROPMALFORMED" if skip_bad else "PERMISSIVE")
    if encoding.upper().startswith("UTF-16"):
        order, ends = wide_format(spark, paths if isinstance(paths, str) else next(iter(paths)), encoding)
        if order == "UTF-16LE" and ends == "\r\n":
            # as bytes, this line's end can't begin in the middle of a character: U+0A00 is none
            # the byte order mark stands before the first header, which is not compared then
            reader = reader.option("encoding", order).option("lineSep", ends)
        else:
            reader = reader.option("encoding", encoding).option("enforceSchema", False).option("multiLine", True)
    else:
        reader = reader.option("encoding", encoding).option("enforceSchema", False)
    try:
        df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    except Exception as problem:
        if not missing_ok or "PATH_NOT_FOUND" not in str(problem):
            raise
        df = spark.createDataFrame([], schema)
    return df.withColumnsRenamed(dict(rename or {}))


def wide_format(spark: SparkSession, path: str, encoding: str = "UTF-16", looked_at: int = 1 << 16) -> tuple[str, str]:
    """(UTF-16LE or UTF-16BE, the end of the first line) of the first file below a path, by its byte order mark; big without one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    named = encoding.upper() if encoding.upper() in ("UTF-16LE", "UTF-16BE") else None
    for found in files.globStatus(place) or []:
        own = [found] if found.isFile() else sorted((x for x in files.listStatus(found.getPath()) if x.isFile() and x.getLen() and x.getPath().getName()[0] not in "_."), key=lambda x: x.getPath().getName())
        for file in own[:1]:
            stream = files.open(file.getPath())
            try:
                head = bytes(stream.readNBytes(looked_at))
            finally:
                stream.close()
            order = named or ("UTF-16LE" if head[:2] == b"\xff\xfe" else "UTF-16BE")
            first = head[: len(head) // 2 * 2].decode(order, "replace").partition("\n")[0]
            return order, "\r\n" if first.endswith("\r") else "\n"
    return named or "UTF-16BE", "\n"


def read_tree(spark: SparkSession, root: str, schema: T.StructType | str, pattern: str = "*.csv", skip: str | None = None, rename: Mapping[str, str] | None = None, **options) -> DataFrame:
    """All files below a folder whose names fit a pattern, but for those that hold ``skip`` (any case); options as separator and encoding."""
    reader = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).options(**options)
    df = reader.csv(root)
    if skip:
        df = df.where(~F.contains(F.lower(F.replace(F.col("_metadata.file_name"), F.lit("%20"), F.lit(" "))), F.lit(skip.lower())))
    return df.withColumnsRenamed(dict(rename or {}))


def read_config(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object of objects ``{key: {value: [..]}}`` as a table of (key, value), one row for each listed value."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string, struct<{value}: array<string>>>").alias("m"))
    return whole.select(F.explode("m").alias(key, "_v")).select(key, F.explode(f"_v.{value}").alias(value))


def newest_first(files: DataFrame) -> DataFrame:
    """Files (path, modificationTime) with a place: the newest is 1, ties by path."""
    return files.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("modificationTime"), "path")))


def latest_file_wins(df: DataFrame, key: str) -> DataFrame:
    """Of rows read from several files the one of the file that was changed last, for each key."""
    marked = df.select("*", F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_path").alias("_file"))
    best = F.max_by(F.struct(*df.columns), F.struct("_at", "_file"))
    return marked.groupBy(F.col(key).alias("_key")).agg(best.alias("_best")).select("_best.*")


def read_ledger(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """Latest value of each key of a folder of JSON lines ``{key, value}``: later files win, later lines in a file too."""
    lines = spark.read.schema(f"key string, value struct<{value_schema}>").json(path)
    meta = F.col("_metadata")
    log = lines.where(F.col("key").isNotNull()).select("key", "value", meta["file_modification_time"].alias("_at"), meta["file_path"].alias("_file"), F.monotonically_increasing_id().alias("_line"))
    return latest_values(log, "key", "value", ["_at", "_file", "_line"]).select("key", "value.*")


def read_api_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A JSON document of ``meta.view.columns[].name`` and row arrays in ``data``: the named columns, as text.

    Names are looked up by their snake-case form; unknown ones are NULL.
    """
    raw = spark.read.schema("meta struct<view: struct<columns: array<struct<name: string>>>>, data array<array<string>>").option("multiLine", True).json(path)
    names = F.transform(F.col("meta.view.columns"), lambda c: F.lower(F.regexp_replace(F.trim(c["name"]), "[^A-Za-z0-9]+", "_")))
    rows = raw.select(names.alias("_names"), F.explode("data").alias("_row"))
    return rows.select(*[F.try_element_at("_row", F.nullif(F.array_position("_names", snake_name(c)), F.lit(0)).cast("int")).alias(c) for c in columns])


def read_report(spark: SparkSession, path: str, sections: Mapping[str, str], date: str = r"^(\d{1,2}/\d{1,2}/\d{4})\s+(.*)$", analyte: str = r"^(.+?)\s+([<>]?[0-9.]+|ND|Pass|Fail)\s*(\S*)$", skip: Sequence[str] = ()) -> DataFrame:
    """Samples of report-layout text: a date line starts one, section headers lead analyte lines.

    ``sections`` gives the analysis of each header text.  Files are split, and
    lines are put in order within a stretch of ``STRETCH`` of a split at most.  A
    stretch is read with what those of its file before it leave behind: how many
    samples have begun, and the last header of the sample that is open.  These
    are one line for each stretch, so a large file is many tasks, and none sorts
    a whole split.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("at"))
    # a split's rows are numbered in order; numbers with the same upper bits are one stretch of it
    stretch = F.struct("begin", F.floor(F.col("at") / STRETCH).alias("stretch")).alias("split")
    lines = raw.select("file", stretch, "at", F.trim(F.regexp_replace("value", r"\r$", "")).alias("line")).where("line <> ''")
    for text in skip:
        lines = lines.where(~F.contains("line", F.lit(text)))
    header = F.coalesce(*[F.when(F.lower("line") == name.lower(), F.lit(kind)) for name, kind in sections.items()])
    lines = lines.withColumns({"starts": F.col("line").rlike(date), "header": header})
    before = carried(lines)
    order = Window.partitionBy("file", "split").orderBy("at")
    # what a line's state is within its split: a date line ends the header that was open
    state = F.when(F.col("starts"), F.lit("")).otherwise(F.col("header"))
    own = lines.withColumns({"begun": F.sum(F.col("starts").cast("int")).over(order), "open": F.last(state, ignorenulls=True).over(order)})
    own = own.join(F.broadcast(before), ["file", "split"], "left")
    own = own.withColumns({"sample": F.col("begun") + F.coalesce("begun_before", F.lit(0)), "analysis": F.nullif(F.coalesce("open", "open_before"), F.lit(""))}).where("sample > 0")
    head = F.when(F.col("starts"), F.struct(F.regexp_extract("line", date, 1).alias("date"), F.regexp_extract("line", date, 2).alias("product_name")))
    value = F.struct("analysis", F.trim(F.regexp_extract("line", analyte, 1)).alias("name"), F.regexp_extract("line", analyte, 2).alias("value"), F.regexp_extract("line", analyte, 3).alias("units"))
    place = [F.col("split"), F.col("at")]
    result = F.when(~F.col("starts") & F.col("header").isNull() & F.col("analysis").isNotNull() & F.col("line").rlike(analyte), F.struct(*place, value.alias("result")))
    # a product name that is too long goes on in the lines before the first header
    wrapped = F.when(~F.col("starts") & F.col("header").isNull() & F.col("analysis").isNull(), F.struct(*place, "line"))
    grouped = own.groupBy("file", "sample").agg(F.max(head).alias("head"), F.array_sort(F.collect_list(result)).alias("r"), F.array_sort(F.collect_list(wrapped)).alias("w"))
    name = F.array_join(F.concat(F.array("head.product_name"), F.transform("w", lambda x: x["line"])), " ")
    return grouped.select("file", "sample", F.col("head.date").alias("date"), F.trim(name).alias("product_name"), F.transform("r", lambda x: x["result"]).alias("results"))


def carried(lines: DataFrame) -> DataFrame:
    """(file, split, begun_before, open_before): what the splits of a file before each one leave behind, from lines (file, split, at, starts, header).

    Each split leaves the number of its date lines and the last of its states:
    a header, or '' after a date line.  The order of splits is within a file, of
    one line for each of them.
    """
    state = F.when(F.col("starts"), F.lit("")).otherwise(F.col("header"))
    left = lines.groupBy("file", "split").agg(F.sum(F.col("starts").cast("int")).alias("begun"), F.max_by(state, F.when(state.isNotNull(), F.col("at"))).alias("open"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return left.select("file", "split", F.sum("begun").over(earlier).alias("begun_before"), F.last("open", ignorenulls=True).over(earlier).alias("open_before"))


def page_fields(html: Column) -> dict[str, Column]:
    """Title, links and visible text of a page."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]+>", " ")
    return {
        "title": F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit("")),
        "links": F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1)),
        "visible": F.trim(F.regexp_replace(bare, r"\s+", " ")),
    }


def tagged_text(html: Column, tag: str, attribute: str | None = None, value: str | None = None) -> Column:
    """Inner text of all elements of a tag, or of those with an attribute's value (no nested tags of the same name)."""
    mark = rf'[^>]*\b{attribute}="[^"]*\b{value}\b[^"]*"[^>]*' if attribute else "[^>]*"
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b{mark}>(.*?)</{tag}>"), F.lit(1))
    return F.transform(found, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", " "), r"\s+", " ")))


def parse_files(spark: SparkSession, path: str, parser: Callable[[str, bytes], list[dict]], schema: str, pattern: str = "*") -> DataFrame:
    """Rows that a parser function makes of each file's bytes; any format with a Python parser."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "content")
    names = T.StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                yield pd.DataFrame(parser(name, bytes(content)), columns=names)

    return files.mapInPandas(run, schema)


def read_workbooks(spark: SparkSession, path: str, schema: str, sheet: str | int = 0, columns: Sequence[str] | None = None) -> DataFrame:
    """Excel files, one task a file; needs an Excel reader for pandas on the executors."""

    def rows(_: str, content: bytes) -> list[dict]:
        import io

        return pd.read_excel(io.BytesIO(content), sheet_name=sheet, usecols=columns, dtype=str).to_dict("records")

    return parse_files(spark, path, rows, schema, "*.xlsx")


def serial_ids(spark: SparkSession, digits: int, prefix: str = "") -> DataFrame:
    """All zero-padded numbers of so many digits."""
    return spark.range(10**digits).select(F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), digits, "0")).alias("query"))


def dated_ids(spark: SparkSession, first: str, last: str, serials: int, template: str = "yyMMdd") -> DataFrame:
    """Ids of a date and a serial number, for each day of a span."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))
    return days.select(F.date_format("day", template).alias("d"), F.explode(F.sequence(F.lit(1), F.lit(serials))).alias("n")).select(F.concat("d", F.lit("-"), F.lpad(F.col("n").cast("string"), 4, "0")).alias("query"))


def letter_pairs(spark: SparkSession) -> DataFrame:
    return spark.range(26 * 26).select(F.concat(F.char((F.col("id") / 26).cast("int") + 97), F.char(F.col("id") % 26 + 97)).alias("query"))


def latest_by_state(files: DataFrame) -> DataFrame:
    """The last file by name of each state; files: state, path."""
    return files.groupBy("state").agg(F.max("path").alias("path"))


def union_sources(sources: Mapping[str, DataFrame | Callable[[], DataFrame]], failed: dict[str, Exception] | None = None) -> DataFrame:
    """Union by name of named sources, with the name in ``source``; a source is a table or a function that makes one.

    With ``failed`` a source whose function raises an error is left out and noted there.
    """
    out: DataFrame | None = None
    for name, source in sources.items():
        try:
            df = source() if callable(source) else source
        except Exception as problem:
            if failed is None:
                raise
            failed[name] = problem
            continue
        part = df.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sources")
    return out
