"""Layouts of the public-record dumps: one state's long records to wide samples.

Each function takes the raw table under the names of its dump, the names of
the tests that become columns, and the columns that say which record of a test
is the first.  Records without a value, a test or a part of the sample's key
don't count.  Further columns of the raw table don't disturb.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.functions import dates, text
from assayframe.operators import columns, dedupe, reshape

# fixed values: columns of the dumps and their standard names
OREGON = {"LabId": "lab_id", "SampleCreatedByLicenseId": "producer_id", "SampleId": "sample_id", "MonthOfTest": "month", "YearOfTest": "year", "ProductType": "product_type", "TestName": "test_name", "Result": "result", "PassFail": "status"}
RHODE_ISLAND = {"Id": "sample_id", "TestingFacilityName": "lab", "ItemFromFacilityLicenseNumber": "producer_license_number", "SourcePackageLabels": "label", "TestPerformedDate": "date_tested", "TestTypeName": "test_type", "TestResultLevel": "test_result", "OverallPassed": "status"}
MARYLAND = {"TestPassed": "status", "TestPerformedDate": "date_tested", "PackageId": "package_id", "StrainName": "strain_name", "TestingFacilityId": "lab_id", "ProductCategoryName": "product_type"}
MARYLAND_TYPES = ["Infused Edible", "Infused Non-Edible", "Non-Solvent Concentrate", "R&D Testing", "Raw Plant Material", "Solvent Based Concentrate", "Sub-Contract", "Whole Wet Plant"]
MASSACHUSETTS = {"ProductCategory": "product_type", "PackageLabel": "label", "TestType": "test_type", "TestResult": "test_result", "TestPerformedDate": "date_tested"}
MASSACHUSETTS_TESTS = {"THC (%) Raw Plant Material": "delta_9_thc", "THCA (%) Raw Plant Material": "thca", "Total THC (%) Raw Plant Material": "total_thc", "Total Yeast and Mold (CFU/g) Raw Plant Material": "yeast_and_mold"}
MISSISSIPPI = {"Testing Facility UID": "lab_id", "ResultRecordedDateTime": "date_tested", "Package ID": "product_id", "Quantity": "value", "Name": "test_name", "Note": "notes"}
OHIO = {"Date": "date_tested", "Tag": "product_id", "Analyte": "test_name", "Result": "value", "Disposition": "status", "Notes": "notes"}
NEW_JERSEY = {"TestPerformedDate": "date_tested", "METRCTag": "label", "TestTypeName": "test_type", "TestTypeNamePart": "test_name", "TestPassed": "status", "TestResultLevel": "value", "TestComment": "notes", "TestingFacilityId": "lab_id"}
NEW_JERSEY_CONTROLS = ["Additional", "R&D Testing", "Stability T1", "Stability T2", "Stability T3", "Stability T0"]
NEW_JERSEY_TYPES = {
    "Raw Plant Material": "Flower",
    "Raw Plant Material & Concentrate/Extract": "Mix",
    "Raw Plant Material & Conentrate/Extract": "Mix",
    "Inhalable/Vape Concentrate": "Vape",
    "Solvent Based Concentrate/Extract": "Solvent-based Concentrate",
    "Non-Solvent Concentrate": "Non-solvent Concentrate",
    "Infused Non-Edible": "Infused",
    "Infused Edible": "Edible",
    "Infused Products": "Infused",
    "Edibles": "Edible",
}


def _dated(df: DataFrame, column: str = "date_tested") -> DataFrame:
    """The column as a timestamp (NULL where it is no date), with its month's label and year."""
    return df.withColumn(column, dates.parsed(F.col(column).cast("string"))).withColumns({"month": dates.month_label(F.col(column)), "year": F.year(column)})


def producer_of_tag(tag: Column) -> Column:
    """Characters 13 to 15 of a package's tag."""
    return F.substring(tag, 13, 3)


def oregon(raw: DataFrame, tests: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Samples of a month; samples without a valid month go."""
    rows = raw.withColumnsRenamed(OREGON)
    rows = rows.withColumn("date_tested", dates.parsed(F.concat_ws("-", "year", "month"), ["yyyy-M"]))
    return _dated(reshape.pivot_first(rows, ["sample_id", "producer_id", "lab_id", "product_type", "date_tested"], "test_name", "result", order, tests))


def rhode_island(raw: DataFrame, tests: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Samples of one product type, which stands behind the test's name and units."""
    rows = raw.withColumnsRenamed(RHODE_ISLAND).withColumns(text.test_parts(F.col("test_type")))
    return _dated(reshape.pivot_first(rows, ["sample_id", "producer_license_number", "lab", "label", "date_tested", "product_type"], "test_name", "test_result", order, tests))


def maryland(raw: DataFrame, tests: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each package: of several, the first by date, strain, lab and type; it fails if any test does."""
    rows = raw.withColumnsRenamed(MARYLAND)
    index = ["date_tested", "package_id", "strain_name", "lab_id", "product_type"]
    wide = columns.combine_redundant(reshape.pivot_first(rows, index, "TestTypeName", "TestResultLevel", order, tests), MARYLAND_TYPES, index)
    first = dedupe.keep_first(columns.renamed(wide), ["package_id"], [F.col(c) for c in index])
    status = rows.groupBy("package_id").agg(F.when(F.bool_or(~F.col("status")), "Fail").otherwise("Pass").alias("status"))
    return first.join(status, "package_id")


def massachusetts(raw: DataFrame, order: Sequence[str], tests: Mapping[str, str] = MASSACHUSETTS_TESTS) -> DataFrame:
    """Samples of a label, date and lab; lab and strain stand in either of two columns."""
    rows = columns.coalesced(raw, "lab", ["TestingLabId", "TestingLab"])
    rows = columns.coalesced(rows, "strain_name", ["StrainName", "Strain"]).withColumnsRenamed(MASSACHUSETTS)
    wide = reshape.pivot_first(rows, ["label", "date_tested", "lab"], "test_type", "test_result", order, list(tests)).withColumnsRenamed(dict(tests))
    date = dates.parsed(F.col("date_tested").cast("string"))
    return wide.withColumns({"date": date, "week": dates.week_label(date), "month": dates.month_label(date)})


def mississippi(raw: DataFrame, tests: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Products of a lab and type, with the last date and all different notes of the product.

    The type is what follows the last bracket of the test's name.  A
    product's notes are as many as its tests.
    """
    rows = raw.withColumnsRenamed(MISSISSIPPI)
    rows = rows.withColumns({"product_type": F.trim(F.substring_index("test_name", ")", -1)), "test_name": text.before_bracket(F.col("test_name"))})
    wide = reshape.pivot_first(rows, ["product_id", "lab_id", "product_type"], "test_name", "value", order, tests)
    noted = F.array_sort(F.collect_list(F.when(F.col("notes").isNotNull(), F.struct(*[F.col(c).alias(f"at_{i}") for i, c in enumerate(order)], F.col("notes").alias("note")))))
    whole = rows.groupBy("product_id").agg(F.max("date_tested").alias("date_tested"), noted.alias("notes"))
    whole = whole.withColumn("notes", F.array_join(F.array_distinct(F.transform("notes", lambda n: n["note"])), ", "))
    return wide.join(whole, "product_id")


def ohio(raw: DataFrame, tests: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Products of a date, with their producer's id."""
    rows = raw.withColumnsRenamed(OHIO).withColumn("test_name", text.before_bracket(F.col("test_name")))
    wide = reshape.pivot_first(rows, ["product_id", "date_tested"], "test_name", "value", order, tests)
    return wide.withColumn("producer_id", producer_of_tag(F.col("product_id")))


def new_jersey(raw: DataFrame, tests: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Samples of a label, date, lab and type; a label passes if no test of it fails, and is R&D if any test is."""
    rows = raw.withColumnsRenamed(NEW_JERSEY)
    rows = rows.withColumns({"product_type": text.bracket_type(F.col("test_type")), "r_and_d": F.contains("test_type", F.lit("R&D"))})
    wide = reshape.pivot_first(rows, ["label", "date_tested", "lab_id", "product_type"], "test_name", "value", order, tests)
    flags = rows.groupBy("label").agg(F.when(F.bool_or(~F.col("status")), "Fail").otherwise("Pass").alias("status"), F.bool_or("r_and_d").alias("r_and_d"))
    return _dated(wide.join(flags, "label"))


def new_jersey_sample(wide: DataFrame, first: str = "2023-02-01", end: str = "2024-07-01") -> DataFrame:
    """Samples of a span of dates (its end excluded) without quality controls, product types by their common names (others NULL)."""
    rows = wide.where((F.col("date_tested") >= first) & (F.col("date_tested") < end) & ~F.col("product_type").isin(NEW_JERSEY_CONTROLS))
    named = F.coalesce(*[F.when(F.col("product_type") == old, new) for old, new in NEW_JERSEY_TYPES.items()])
    return rows.withColumns({"product_type": named, "producer_id": producer_of_tag(F.col("label"))})
