"""Projections: renaming, coalescing, coercing, reordering, lookups by small maps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions.numbers import number
from assayframe.functions.text import snake_name


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def renamed(df: DataFrame, how: Callable[[str], str] = snake_name, table: Mapping[str, str] | None = None) -> DataFrame:
    """Rename all columns by a function, then by a map; columns that meet in one name are coalesced in order."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        name = how(c)
        groups.setdefault((table or {}).get(name, name), []).append(c)
    return df.select(*[F.coalesce(*[quoted(c) for c in cols]).alias(name) if len(cols) > 1 else quoted(cols[0]).alias(name) for name, cols in groups.items()])


def coalesced(df: DataFrame, target: str, sources: Sequence[str]) -> DataFrame:
    """target is the first value there in the sources that exist; they are dropped."""
    own = [c for c in sources if c in df.columns]
    if not own:
        return df
    return df.withColumn(target, F.coalesce(*[quoted(c) for c in own])).drop(*[c for c in own if c != target])


def combine_similar(df: DataFrame, similar: Mapping[str, Sequence[str]]) -> DataFrame:
    """Each target takes its own value, else the first of its variants; variants are dropped."""
    for target, variants in similar.items():
        df = coalesced(df, target, [target, *variants])
    return df


def combine_redundant(df: DataFrame, product_types: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns ``base (unit) type`` or ``base type`` become one ``base``, coalesced in column order.

    Of several types that end a column's name the longest counts.
    """
    import re

    groups: dict[str, list[str]] = {}
    for c in df.columns:
        base = c
        if c not in keep:
            ends = sorted((t for t in product_types if c.endswith(f" {t}")), key=len)
            if ends:
                base = re.sub(r"\s*\([^()]*\)$", "", c[: -len(ends[-1]) - 1]).strip()
        groups.setdefault(base, []).append(c)
    return df.select(*[F.coalesce(*[quoted(c) for c in cols]).alias(base) if len(cols) > 1 else quoted(cols[0]).alias(base) for base, cols in groups.items()])


def numeric(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """All columns but the kept ones as DOUBLE; what isn't a number is missing."""
    return df.select(*[quoted(c) if c in keep else number(quoted(c)).alias(c) for c in df.columns])


def ordered(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns in front, the others sorted."""
    front = [c for c in first if c in df.columns]
    return df.select(*[quoted(c) for c in front], *[quoted(c) for c in sorted(set(df.columns) - set(front))])


def without(df: DataFrame, names: Sequence[str] = (), holding: Sequence[str] = (), suffixes: Sequence[str] = ()) -> DataFrame:
    """Drop columns by name, by a part of the name, or by its end."""
    return df.drop(*[c for c in df.columns if c in names or any(h in c for h in holding) or any(c.endswith(s) for s in suffixes)])


def update_where(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns in the rows that meet a condition."""
    return df.withColumns({k: F.when(where, v).otherwise(F.col(k)) for k, v in values.items()})


def update_by_key(df: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Take the values that a table of changes (one row for each key) has, else keep the old ones."""
    new = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = df.join(new, key, "left")
    return out.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).drop(*[f"_new_{c}" for c in columns]).select(*df.columns)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """n rows, the same for the same rows and seed: the smallest hashes of seed and keys."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), *[quoted(k).cast("string") for k in keys])), *keys).limit(n)


def published(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """NaN and empty text as NULL, given columns dropped."""
    out = df.drop(*drop)
    kinds = dict(out.dtypes)
    return out.select(*[F.when(~F.isnan(c), quoted(c)).alias(c) if kinds[c] in ("double", "float") else F.when(quoted(c) != "", quoted(c)).alias(c) if kinds[c] == "string" else quoted(c) for c in out.columns])


def merged(df: DataFrame, constants: Mapping[str, Column], parsed: Mapping[str, Column]) -> DataFrame:
    """Constants, the row and what was parsed as one row: the right one wins where it has a value."""
    out = df.withColumns({k: F.coalesce(F.col(k), v) if k in df.columns else v for k, v in constants.items()})
    return out.withColumns({k: F.coalesce(v, F.col(k)) if k in out.columns else v for k, v in parsed.items()})


def with_metadata(df: DataFrame, data_type: str, id_field: str = "sample_id", created_by: str = "pipeline", now: Column | None = None) -> DataFrame:
    """Add id, data_type, link, created_by, created_at and updated_at (ISO text)."""
    at = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    link = F.concat(F.lit(f"/{data_type}/"), F.col(id_field).cast("string"))
    return df.withColumns({"id": F.col(id_field), "data_type": F.lit(data_type), "link": link, "created_by": F.lit(created_by), "created_at": at, "updated_at": at})
