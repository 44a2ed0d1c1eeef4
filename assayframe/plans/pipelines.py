"""Whole pipelines: curation of long records, publishing of certificates, statistics of entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions import chemistry, dates, hashing, nested, normalize, text
from assayframe.operators import columns, dedupe, joins, reshape, statistics


@dataclass(frozen=True)
class Layout:
    """How one source's long records become wide samples."""

    index: Sequence[str]
    test: str
    value: str
    order: Sequence[str]
    tests: Sequence[str] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    product_types: Sequence[str] = ()
    similar: Mapping[str, Sequence[str]] = field(default_factory=dict)
    keys: Mapping[str, str] = field(default_factory=dict)
    any_flags: Sequence[str] = ()
    all_flags: Sequence[str] = ()
    cannabinoids: Sequence[str] = ()
    terpenes: Sequence[str] = ()
    date: str | None = None
    constants: Mapping[str, str] = field(default_factory=dict)


def curate(long: DataFrame, layout: Layout, licenses: DataFrame | None = None, license_key: str | None = None, license_columns: Sequence[str] = (), license_order: Sequence[Column] = ()) -> DataFrame:
    """Long records to one row for each sample.

    Pivot, redundant and similar columns, names, numbers, flags of the
    sample's records, totals, date labels, licence fields, column order.
    """
    rows = long.withColumnsRenamed(dict(layout.rename))
    out = reshape.pivot_first(rows, layout.index, layout.test, layout.value, layout.order, layout.tests)
    if layout.product_types:
        out = columns.combine_redundant(out, layout.product_types, layout.index)
    out = columns.combine_similar(out, layout.similar)
    out = columns.renamed(out, text.snake_name, dict(layout.keys))
    index = [text.snake_name(c) for c in layout.index]
    out = columns.numeric(out, index)
    if layout.any_flags or layout.all_flags:
        flags = rows.groupBy(layout.index[0]).agg(*[F.bool_or(c).alias(c) for c in layout.any_flags], *[F.bool_and(c).alias(c) for c in layout.all_flags])
        out = out.join(flags.withColumnRenamed(layout.index[0], index[0]), index[0], "left")
    if layout.cannabinoids:
        have = set(out.columns)
        out = out.withColumns({c: F.lit(None).cast("double") for c in {*layout.cannabinoids, *layout.terpenes, "delta_9_thc", "thca", "cbd", "cbda"} - have})
        out = chemistry.rounded_totals(out, layout.cannabinoids, layout.terpenes)
    if layout.date:
        out = dates.date_parts(out.withColumn(layout.date, dates.parsed(F.col(layout.date).cast("string"))), layout.date)
    if licenses is not None and license_key:
        out = joins.lookup(out, licenses, license_key, license_columns, license_order)
    out = out.withColumns({k: F.lit(v) for k, v in layout.constants.items()})
    return columns.ordered(out, [*index, *layout.constants])


def publish(ledger: DataFrame, compounds: Sequence[str], terpenes: Sequence[str], uploaded: DataFrame | None = None, types: Mapping[str, Sequence[str]] = normalize.PRODUCT_TYPES, labels: DataFrame | None = None, created_by: str = "pipeline") -> DataFrame:
    """Parsed certificates to documents: de-duplicated, standardized, enriched; one row for each sample.

    ledger: sample_id, sample_hash, coa_parsed_at, product_name, strain_name,
    product_type, lab, lab_state, producer, producer_state, date_tested,
    date_collected, results and methods as text, and what else there is.
    labels: label_hash and standard_strain_name of labels that are known.
    """
    rows = ledger.withColumns({c: F.lower(c) for c in ("lab_state", "producer_state") if c in ledger.columns})
    rows = columns.without(rows, holding=("_per_",))
    rows = dedupe.keep_latest(rows, ["sample_hash"], "coa_parsed_at", ["sample_id"])
    if uploaded is not None:
        rows = joins.not_in(rows, uploaded, "sample_id")
    if "methods" in rows.columns:
        rows = nested.methods(rows)
    rows = nested.statuses(rows)
    rows = dedupe.keep_latest(rows, ["sample_id"], "coa_parsed_at", ["sample_hash"])
    rows = nested.widened(rows.withColumn("results", nested.results_of(F.col("results"))), "results", [*compounds, *terpenes])
    rows = chemistry.analyte_stats(rows, compounds, terpenes)
    rows = rows.withColumns({
        "diversity": chemistry.shannon([F.col(c) for c in [*compounds, *terpenes]]),
        "cannabinoid_type": chemistry.ratio_class(F.col("thc_cbd_ratio")),
        "date_tested": dates.parsed(F.coalesce("date_tested", "date_collected")),
        "standard_product_type": normalize.product_type(F.col("product_type"), types),
        "label": text.label_name(F.col("product_name"), F.col("strain_name")),
    })
    rows = dates.date_parts(rows, "date_tested").withColumn("label_hash", hashing.label_hash(F.col("label")))
    if labels is not None:
        rows = joins.lookup(rows, labels, "label_hash", ["standard_strain_name"], [F.col("standard_strain_name")])
    else:
        rows = rows.withColumn("standard_strain_name", F.lit(None).cast("string"))
    rows = rows.withColumns({
        "title": text.title(F.col("product_name"), F.col("strain_name"), [F.col("sample_id")]),
        "link": text.data_link(F.col("sample_id"), "coas"),
        "id": F.col("sample_id"),
        "data_type": F.lit("coas"),
        "tags": nested.tags({"standard_product_type": F.col("standard_product_type"), "standard_strain_name": F.col("standard_strain_name"), "producer": F.col("producer"), "lab": F.col("lab")}),
        "vector": nested.vector([F.col(c) for c in compounds]).cast("array<float>"),
        "created_by": F.lit(created_by),
    })
    return columns.published(rows, ["label_hash"])


def entity_statistics(base: DataFrame, entity: str, others: Sequence[str], year: str = "year", month: str = "month") -> dict[str, DataFrame]:
    """Statistics of one kind of entity, as tables keyed by it: totals, top values, retention, change.

    Each is one grouped query over the base, projected to what it needs.
    """
    known = base.where(F.col(entity).isNotNull())
    yearly = known.groupBy(entity, year).agg(F.count("*").alias("n"), *[F.countDistinct(o).alias(f"n_{o}") for o in others])
    out = {
        "totals": known.groupBy(entity).agg(F.count("*").alias("n"), *[F.countDistinct(o).alias(f"n_{o}") for o in others]),
        "months": known.groupBy(entity, year, month).agg(F.count("*").alias("n")),
        "growth": joins.previous_listed(yearly, [entity], year, ["n"]).withColumn("change", statistics.change(F.col("n"), F.col("prev_n"))),
    }
    for o in others:
        out[f"top_{o}"] = statistics.top_counts(known, [entity], o, 10)
        out[f"concentration_{o}"] = statistics.concentration(known, [entity], o, 10)
        out[f"retention_{o}"] = statistics.retention(known, [entity], o, year)
        out[f"new_{o}"] = statistics.new_and_returning(known, [entity], o, year)
    return out
