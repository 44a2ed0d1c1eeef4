"""Totals, ratios and indices of analytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import round_even, row_sum, safe_ratio

#: Share of the acid form's mass that is left after decarboxylation.
DECARB = 0.877


def total_active(neutral: Column, acid: Column, nulls: str = "zero") -> Column:
    """neutral + 0.877 * acid; ``nulls``: missing counts as ``zero``, or ``propagate``s."""
    if nulls == "zero":
        neutral, acid = F.coalesce(neutral, F.lit(0.0)), F.coalesce(acid, F.lit(0.0))
    return neutral + F.lit(DECARB) * acid


# fixed values: ratios of a record
RATIOS = {
    "thc_cbd_ratio": ("total_thc", "total_cbd"),
    "beta_pinene_d_limonene_ratio": ("beta_pinene", "d_limonene"),
    "alpha_humulene_beta_caryophyllene_ratio": ("alpha_humulene", "beta_caryophyllene"),
    "camphene_d_limonene_ratio": ("camphene", "d_limonene"),
    "beta_myrcene_beta_pinene_ratio": ("beta_myrcene", "beta_pinene"),
    "beta_caryophyllene_d_limonene_ratio": ("beta_caryophyllene", "d_limonene"),
}


def analyte_stats(df: DataFrame, cannabinoids: Sequence[str], terpenes: Sequence[str]) -> DataFrame:
    """Totals, each only if absent, and ratios; totals are NULL if all parts are missing, missing parts of THC and CBD count as 0.

    Ratios are NULL where they can't be formed, or a column of theirs isn't there.
    """
    have = set(df.columns)
    col = lambda name: F.col(name).cast("double") if name in have else F.lit(None).cast("double")
    new = {
        "total_cannabinoids": row_sum([col(c) for c in cannabinoids], 1),
        "total_terpenes": row_sum([col(c) for c in terpenes if c in have], 1),
        "total_thc": total_active(col("delta_9_thc"), col("thca")),
        "total_cbd": total_active(col("cbd"), col("cbda")),
    }
    out = df.withColumns({k: v for k, v in new.items() if k not in have})
    has = set(out.columns)
    ratio = lambda a, b: safe_ratio(F.col(a), F.col(b)) if {a, b} <= has else F.lit(None).cast("double")
    return out.withColumns({k: ratio(a, b) for k, (a, b) in RATIOS.items()})


def results_stats(df: DataFrame, cannabinoids: Sequence[str] | None = None, terpenes: Sequence[str] | None = None, cbd: str = "cbd", cbda: str = "cbda", thc: str = "delta_9_thc", thca: str = "thca", decarb: float = DECARB) -> DataFrame:
    """Totals and ratios that replace what is there: sums take missing parts as 0, the rest is NULL if a part is missing."""
    out = df
    if cannabinoids is not None:
        active = lambda a, b: F.col(a) + F.lit(decarb) * F.col(b)
        out = out.withColumns({"total_cannabinoids": row_sum([F.col(c) for c in cannabinoids]), "total_thc": active(thc, thca), "total_cbd": active(cbd, cbda)})
        out = out.withColumn("thc_to_cbd_ratio", F.try_divide("total_thc", "total_cbd"))
    if terpenes is not None:
        out = out.withColumns({"total_terpenes": row_sum([F.col(c) for c in terpenes]), "beta_pinene_to_d_limonene_ratio": F.try_divide("beta_pinene", "d_limonene")})
    return out


def rounded_totals(df: DataFrame, cannabinoids: Sequence[str] | None, terpenes: Sequence[str] | None) -> DataFrame:
    """Totals and ratios rounded to two digits; sums only for the lists that are given."""
    out = df
    if cannabinoids:
        out = out.withColumn("total_cannabinoids", round_even(row_sum([F.col(c) for c in cannabinoids]), 2))
    if terpenes:
        out = out.withColumn("total_terpenes", round_even(row_sum([F.col(c) for c in terpenes]), 2))
    if cannabinoids and terpenes:
        out = out.withColumn("cannabinoids_to_terpenes_ratio", round_even(safe_ratio(F.col("total_cannabinoids"), F.col("total_terpenes")), 2))
    thc, cbd = total_active(F.col("delta_9_thc"), F.col("thca"), "propagate"), total_active(F.col("cbd"), F.col("cbda"), "propagate")
    return out.withColumns({"total_thc": round_even(thc, 2), "total_cbd": round_even(cbd, 2), "thc_to_cbd_ratio": round_even(safe_ratio(thc, cbd), 2)})


def ratio_class(ratio: Column) -> Column:
    """Dominance by the decimal logarithm of the THC to CBD ratio; NULL where it has none."""
    log = F.log10(ratio)
    return F.when(ratio > 0, F.when(log < -0.5, "CBD Dominant").when(log > 0.5, "THC Dominant").otherwise("Balanced THC:CBD"))


def shannon(cols: Sequence[Column]) -> Column:
    """Shannon index (base 2) of the positive values' shares; NULL if there is none."""
    values = F.filter(F.array(*[c.cast("double") for c in cols]), lambda x: x > 0)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    index = F.aggregate(values, F.lit(0.0), lambda s, x: s - (x / total(values)) * F.log2(x / total(values)))
    return F.when(F.size(values) > 0, index)


def wet_basis(dry: Column, moisture: Column) -> Column:
    return dry * (1 - moisture / 100)


def milligrams_to_percent(df: DataFrame) -> DataFrame:
    """Columns in mg/g become percent: a tenth, without the unit in the name."""
    import re

    out = []
    for name in df.columns:
        if re.search(r"\(mg/g[;)]", name):
            out.append((F.col(f"`{name}`").try_cast("double") / 10).alias(re.sub(r"\s*\(mg/g[^)]*\)", "", name)))
        else:
            out.append(F.col(f"`{name}`"))
    return df.select(*out)


def decoded_value(col: Column) -> Column:
    """Number of a result text; ``<LOQ``, ``<LOD`` and ``ND`` count as 0."""
    first = F.split(F.trim(col), r"\s+")[0]
    return F.when(F.upper(first).isin("<LOQ", "<LOD", "ND"), 0.0).otherwise(first.try_cast("double"))
