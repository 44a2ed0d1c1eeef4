"""Arrays of structs, JSON text, traceability ids, tags and vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import blank_to_null, slug

RESULT_DDL = "array<struct<analysis: string, key: string, name: string, value: string, mg_g: double, units: string, limit: double, lod: double, loq: double, status: string>>"


def as_json(col: Column) -> Column:
    """JSON text of a list or dict literal: quotes of strings, and the words None, True and False outside of them.

    Escapes within strings mean what they mean in the literal: two hexadecimal
    digits after x are a character, and a backslash that starts no escape stays.
    """
    tokens = F.regexp_extract_all(col, F.lit(r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++|['"]"""), F.lit(0))
    alone = r"(?<!\\)((?:\\\\)*+)\\"  # a backslash that is not itself escaped

    def escaped(t: Column) -> Column:
        out = F.regexp_replace(t, alone + "'", "$1'")
        for letter, code in (("a", "0007"), ("v", "000b"), ("0", "0000")):
            out = F.regexp_replace(out, alone + letter, f"$1\\\\u{code}")
        out = F.regexp_replace(out, alone + "x([0-9A-Fa-f]{2})", r"$1\\u00$2")
        out = F.regexp_replace(out, alone + r"""([^"\\/bfnrtu])""", r"$1\\\\$2")
        return F.when(F.contains(t, F.lit("\\")), out).otherwise(t)

    def said(t: Column) -> Column:
        inner = escaped(F.regexp_replace(t.substr(F.lit(2), F.length(t) - 2), r'(?<!\\)((?:\\\\)*+)"', r'$1\\"'))
        words = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
        return F.when(F.startswith(t, F.lit("'")) & (F.length(t) > 1), F.concat(F.lit('"'), inner, F.lit('"'))).when(F.startswith(t, F.lit('"')), escaped(t)).otherwise(words)

    return F.array_join(F.transform(tokens, said), "")


def results_of(col: Column, ddl: str = RESULT_DDL) -> Column:
    """Array of result structs of a JSON text or list literal; NULL if it is neither."""
    return F.coalesce(F.from_json(col, ddl), F.from_json(as_json(col), ddl))


def json_field(col: Column, name: str, kind: str = "string") -> Column:
    return F.get_json_object(col, f"$.{name}").try_cast(kind)


def keyed_value(results: Column, key: str) -> Column:
    """Number of the first result with a key; NULL if there is none, or it isn't a number."""
    return F.get(F.filter(results, lambda r: r["key"] == key), 0)["value"].try_cast("double")


def widened(df: DataFrame, results: str, keys: Sequence[str]) -> DataFrame:
    """One DOUBLE column for each key of the nested results."""
    return df.withColumns({k: keyed_value(F.col(results), k) for k in keys})


def flattened(df: DataFrame, columns: Mapping[str, str], out: str = "results") -> DataFrame:
    """Analyte columns (name by key) to an array of (key, name, value) structs, missing ones left out."""
    parts = [F.when(F.col(c).try_cast("double").isNotNull(), F.struct(F.lit(k).alias("key"), F.lit(c).alias("name"), F.col(c).try_cast("double").alias("value"))) for k, c in columns.items()]
    return df.withColumn(out, F.array_compact(F.array(*parts))).drop(*columns.values())


def analyses_of(results: Column) -> Column:
    return F.array_distinct(F.transform(results, lambda r: r["analysis"]))


def detected(results: Column, analysis: str) -> Column:
    """Keys with a value above 0 in one analysis."""
    return F.transform(F.filter(results, lambda r: (r["analysis"] == analysis) & (r["value"].try_cast("double") > 0)), lambda r: r["key"])


def active_total(results: Column, analysis: str, part: str, factor: float = 0.877) -> Column:
    """Sum of an analysis's results whose key holds ``part``; keys that end with ``a`` (acids) count times the factor."""
    own = F.filter(results, lambda r: (r["analysis"] == analysis) & F.contains(r["key"], F.lit(part)) & r["value"].try_cast("double").isNotNull())
    return F.aggregate(own, F.lit(0.0), lambda s, r: s + r["value"].try_cast("double") * F.when(F.endswith(r["key"], F.lit("a")), factor).otherwise(1.0))


def _suffixed(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def methods(df: DataFrame, column: str = "methods") -> DataFrame:
    """The list of methods and a struct for each filled ``*_method`` column; those columns are dropped."""
    own = _suffixed(df, "_method")
    pair = lambda a, m: F.struct(a.cast("string").alias("analysis"), m.cast("string").alias("method"))
    listed = F.coalesce(F.from_json(as_json(F.col(column)), "array<string>"), F.when(blank_to_null(F.col(column)).isNotNull(), F.array(F.col(column))), F.array().cast("array<string>"))
    first = F.transform(listed, lambda m: pair(F.lit(None), m))
    rest = F.array_compact(F.array(*[F.when(blank_to_null(F.col(c)).isNotNull(), pair(F.lit(c.removesuffix("_method")), F.col(c))) for c in own])) if own else None
    return df.withColumn(column, F.concat(first, rest) if own else first).drop(*own)


def statuses(df: DataFrame, out: str = "statuses") -> DataFrame:
    """Distinct (analysis, lower-cased status) of the filled ``*_status`` columns, which are dropped."""
    own = _suffixed(df, "_status")
    parts = [F.when(blank_to_null(F.col(c)).isNotNull(), F.struct(F.lit(c.removesuffix("_status")).alias("analysis"), F.lower(F.col(c)).alias("status"))) for c in own]
    return df.withColumn(out, F.array_distinct(F.array_compact(F.array(*parts)))).drop(*own)


def traceability_ids(df: DataFrame, prefix: str = "metrc", fields: Sequence[str] = ("batch_id", "batch_number", "traceability_id", "source_id"), keep: Sequence[str] = ("batch_number",), out: str = "traceability_ids") -> DataFrame:
    """Sorted distinct ids of the list column ``{prefix}_ids`` (an array, a list as text, or one id), of the columns with the prefix and of other fields; NULL if none.

    Those columns are dropped, but for the fields to keep.
    """
    listed = f"{prefix}_ids"
    own = [c for c in df.columns if c.startswith(prefix) and c != listed] + [c for c in fields if c in df.columns and not c.startswith(prefix)]
    every = F.array(*[blank_to_null(F.col(c).cast("string")) for c in own]) if own else F.array().cast("array<string>")
    if listed in df.columns:
        col = F.col(listed)
        many = col.cast("array<string>") if dict(df.dtypes)[listed].startswith("array") else F.coalesce(F.from_json(as_json(col), "array<string>"), F.when(blank_to_null(col).isNotNull(), F.array(col)))
        every = F.concat(F.coalesce(many, F.array().cast("array<string>")), every)
    ids = F.array_sort(F.array_distinct(F.array_compact(every)))
    dropped = [c for c in df.columns if c.startswith(prefix) or (c in fields and c not in keep)]
    return df.withColumn(out, F.when(F.size(ids) > 0, ids)).drop(*dropped)


def nth_url(col: Column, index: int = 0) -> Column:
    """Link of the nth element of a list of ``{url}`` objects or of links."""
    listed = F.from_json(as_json(col), "array<struct<url: string>>")
    plain = F.from_json(as_json(col), "array<string>")
    return F.coalesce(F.get(listed, index)["url"], F.get(plain, index))


# fixed values: the tag of every record, and links of the tagged columns
DEFAULT_TAG = {"tag_id": "coas", "tag_name": "COA", "tag_color": "#3498db", "tag_link": "/coas"}
TAG_LINKS = {"state": "/coas?state=%s", "standard_product_type": "/coas?product_type=%s", "standard_strain_name": "/strains/%s", "producer": "/licenses/%s", "lab": "/licenses/%s"}


def tags(columns: Mapping[str, Column], links: Mapping[str, str] = TAG_LINKS, default: Mapping[str, str] = DEFAULT_TAG, colors: Mapping[str, Column] | None = None) -> Column:
    """The default tag and one for each filled column: id (slug), name, color, link.

    Colors are given by column (from a table of known ones), else made of the name's hash.
    """

    def tag(name: Column, kind: str) -> Column:
        key = slug(name)
        color = F.concat(F.lit("#"), F.substring(F.md5(F.lower(F.trim(name))), 1, 6))
        if colors and kind in colors:
            color = F.coalesce(colors[kind], color)
        left, _, right = links[kind].partition("%s")
        return F.struct(key.alias("tag_id"), name.alias("tag_name"), color.alias("tag_color"), F.concat(F.lit(left), key, F.lit(right)).alias("tag_link"))

    first = F.struct(*[F.lit(default[k]).alias(k) for k in ("tag_id", "tag_name", "tag_color", "tag_link")])
    return F.array_compact(F.array(first, *[F.when(blank_to_null(c).isNotNull(), tag(c, kind)) for kind, c in columns.items()]))


def vector(cols: Sequence[Column]) -> Column:
    """Ordered values as an array, missing ones as 0."""
    return F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def with_results(df: DataFrame, results: str) -> DataFrame:
    """Rows whose results (a list as text) are not empty."""
    return df.where(F.size(F.coalesce(F.from_json(as_json(F.col(results)), "array<map<string, string>>"), F.array().cast("array<map<string, string>>"))) > 0)


def table_results(cells: Column, analysis: str, skip: Sequence[str] = (), units: str | None = None) -> Column:
    """Result structs of a table's rows (arrays of cells), without the title, empty rows and those whose first cell holds a word to skip.

    Rows of four cells are two results side by side; others are name, value, limit.
    """
    rows = F.filter(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), lambda r: F.size(r) > 1)
    for word in skip:
        rows = F.filter(rows, _without(word))
    key = lambda name: F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "_")
    made = lambda name, value, limit: F.struct(F.lit(analysis).alias("analysis"), key(name).alias("key"), name.alias("name"), value.alias("value"), limit.alias("limit"), F.lit(units).cast("string").alias("units"))
    none = F.lit(None).cast("string")
    split = lambda r: F.when(F.size(r) == 4, F.array(made(F.get(r, 0), F.get(r, 1), none), made(F.get(r, 2), F.get(r, 3), none))).otherwise(F.array(made(F.get(r, 0), F.get(r, 1), F.get(r, 2))))
    return F.flatten(F.transform(rows, split))


def _without(word: str):
    return lambda row: ~F.contains(F.get(row, 0), F.lit(word))
