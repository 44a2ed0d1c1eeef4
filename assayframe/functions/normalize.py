"""Normal forms of states, product types, analyte keys; validation of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: words of test results
PASS_WORDS = ("pass", "passed", "passing", "p", "compliant", "yes", "true", "1")
FAIL_WORDS = ("fail", "failed", "failing", "f", "non-compliant", "no", "false", "0")
NOT_TESTED_WORDS = ("nt", "not tested", "n/t", "not applicable", "n/a", "na", "-", "")
# fixed values: spellings of product types
PRODUCT_TYPES: Mapping[str, Sequence[str]] = {
    "flower": ("flower", "bud", "buds", "cannabis flower", "dried flower", "trim", "shake"),
    "preroll": ("preroll", "pre-roll", "joint", "blunt", "prerolls", "pre-rolls", "infused preroll"),
    "concentrate": ("concentrate", "extract", "wax", "shatter", "rosin", "live resin", "budder", "badder", "sauce", "diamonds", "sugar", "crumble"),
    "vape": ("vape", "cartridge", "cart", "vaporizer", "pod", "disposable", "aio"),
    "edible": ("edible", "gummy", "chocolate", "beverage", "candy", "baked goods", "capsule", "tablet"),
    "tincture": ("tincture", "oil", "drops", "sublingual", "rso"),
    "topical": ("topical", "cream", "lotion", "balm", "salve", "transdermal"),
}
# fixed values: other spellings of analyte keys
ANALYTE_KEYS: Mapping[str, str] = {
    "thc": "delta_9_thc", "d9thc": "delta_9_thc", "delta-9-thc": "delta_9_thc", "delta9thc": "delta_9_thc", "d8thc": "delta_8_thc", "delta-8-thc": "delta_8_thc",
    "thca-a": "thca", "thc-a": "thca", "cbda": "cbda", "cbd-a": "cbda", "cannabidiol": "cbd", "cannabigerol": "cbg",
    "myrcene": "beta_myrcene", "b-myrcene": "beta_myrcene", "limonene": "d_limonene", "d-limonene": "d_limonene", "caryophyllene": "beta_caryophyllene", "b-caryophyllene": "beta_caryophyllene",
    "a-pinene": "alpha_pinene", "b-pinene": "beta_pinene", "a-humulene": "alpha_humulene", "humulene": "alpha_humulene",
}


def mapped(col: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    """Value of a small map; unmapped values give the default (NULL if there is none)."""
    pairs = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    found = F.try_element_at(pairs, col)
    return found if default is None else F.coalesce(found, default)


def status(col: Column) -> Column:
    """``pass``, ``fail`` or ``nt``; other texts lower-cased and trimmed; NULL stays."""
    low = F.lower(F.trim(col))
    return F.when(low.isin(*PASS_WORDS), "pass").when(low.isin(*FAIL_WORDS), "fail").when(low.isin(*NOT_TESTED_WORDS), "nt").otherwise(low)


def product_type(col: Column, types: Mapping[str, Sequence[str]] = PRODUCT_TYPES) -> Column:
    """Category whose spellings hold the text, the first in order; the text as it is if none does."""
    low = F.lower(F.trim(col))
    return F.coalesce(*[F.when(low.isin(*names), F.lit(kind)) for kind, names in types.items()], col)


def member_type(col: Column, types: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """First type whose names hold the exact text; else the default."""
    return F.coalesce(*[F.when(col.isin(*names), F.lit(kind)) for kind, names in types.items()], F.lit(default).cast("string"))


def analyte_key(col: Column, strict: bool = False) -> Column:
    """Analyte key: lower case, spaces and hyphens as underscores, other spellings replaced.

    ``strict`` looks the rewritten key up in the map as it is spelled, so that
    its hyphenated entries are never found; the default finds them.
    """
    key = F.translate(F.lower(F.trim(col)), " -", "__")
    table = dict(ANALYTE_KEYS) if strict else {k.replace("-", "_"): v for k, v in ANALYTE_KEYS.items()}
    return mapped(key, table, key)


@dataclass(frozen=True)
class Rule:
    """What a field must meet; bounds and values are checked where it is there."""

    required: bool = False
    least: float | None = None
    most: float | None = None
    allowed: Sequence[str] | None = None


# fixed values: the rules of a record
STATUS_VALUES = ("pass", "fail", "nt", "n/a")
RULES: Mapping[str, Rule] = {
    "delta_9_thc": Rule(least=0, most=40), "delta_8_thc": Rule(least=0, most=40), "thca": Rule(least=0, most=40), "total_thc": Rule(least=0, most=45),
    "cbd": Rule(least=0, most=30), "cbda": Rule(least=0, most=30), "total_cbd": Rule(least=0, most=35), "total_cannabinoids": Rule(least=0, most=100),
    "total_terpenes": Rule(least=0, most=15), "beta_myrcene": Rule(least=0, most=5), "d_limonene": Rule(least=0, most=5), "beta_caryophyllene": Rule(least=0, most=5), "linalool": Rule(least=0, most=3),
    "moisture_content": Rule(least=0, most=20), "water_activity": Rule(least=0, most=1), "indica_percentage": Rule(least=0, most=1), "sativa_percentage": Rule(least=0, most=1),
    "pesticides_status": Rule(allowed=STATUS_VALUES), "heavy_metals_status": Rule(allowed=STATUS_VALUES), "microbials_status": Rule(allowed=STATUS_VALUES), "mycotoxins_status": Rule(allowed=STATUS_VALUES),
    "residual_solvents_status": Rule(allowed=STATUS_VALUES), "overall_status": Rule(allowed=STATUS_VALUES), "state": Rule(required=True),
}


def validate(df: DataFrame, rules: Mapping[str, Rule] = RULES, errors: str = "errors", valid: str = "is_valid") -> DataFrame:
    """Add the list of broken rules and whether it is empty.

    Missing required fields come first, then bounds and values in the rules'
    order; fields that df lacks count as missing.  Empty text, 0 and false are
    missing for a required field.
    """
    have = set(df.columns)
    checks = []
    for name, rule in rules.items():
        if rule.required:
            text = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
            checks.append(F.when(text.isNull() | text.isin("", "0", "0.0", "false"), F.lit(f"Missing required field: {name}")))
    for name, rule in rules.items():
        if name not in have:
            continue
        col, said = F.col(name), F.col(name).cast("string")
        if rule.least is not None:
            checks.append(F.when(col < rule.least, F.concat(F.lit(f"{name} below minimum: "), said, F.lit(f" < {rule.least}"))))
        if rule.most is not None:
            checks.append(F.when(col > rule.most, F.concat(F.lit(f"{name} above maximum: "), said, F.lit(f" > {rule.most}"))))
        if rule.allowed is not None:
            checks.append(F.when(~col.isin(*rule.allowed), F.concat(F.lit(f"{name} invalid value: "), said)))
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn(errors, found).withColumn(valid, F.size(errors) == 0)


def unknown_values(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Distinct values of a column that a table of known ones lacks."""
    return df.select(F.col(column).alias(key)).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")


def require_known(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """df itself, or a ValueError that names some unknown values."""
    missing = [r[0] for r in unknown_values(df, column, known, key).orderBy(key).limit(10).collect()]
    if missing:
        raise ValueError(f"unknown values of {column}: {missing}")
    return df
