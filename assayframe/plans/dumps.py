"""Queries of the dumps' layouts: line items as test records under each dump's names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import layouts
from .registry import query
from .tables import ORDER, SORT

TESTS = {"A": "THC", "N": "THCA", "R": "Moisture"}


def _kind() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in TESTS.items() for x in pair]), F.col("l_returnflag"))


def _raw(t, **named: Column) -> DataFrame:
    return t("lineitem").select(*ORDER, *[c.alias(n.replace("__", " ")) for n, c in named.items()])


def _text(expression: str) -> Column:
    return F.expr(expression).cast("string")


def _first(flag: str, name: str, where: str = "true") -> str:
    return f"arg_min(l_quantity, {SORT}) FILTER (WHERE l_returnflag = '{flag}' AND {where}) AS {name}"


@query(f"SELECT (l_orderkey % 500)::VARCHAR AS sample_id, (l_partkey % 2)::VARCHAR AS producer_id, (l_suppkey % 2)::VARCHAR AS lab_id, l_linestatus AS product_type, strftime(l_shipdate, '%Y-%m') AS month, year(l_shipdate)::INT AS year, {_first('A', 'thc')}, {_first('N', 'thca')}, {_first('R', 'moisture')} FROM lineitem WHERE month(l_shipdate) < 12 GROUP BY ALL")
def r2_oregon(t):
    """Records of December have no valid month."""
    month = F.when(F.month("l_shipdate") < 12, F.month("l_shipdate").cast("string")).otherwise("13")
    raw = _raw(t, LabId=_text("l_suppkey % 2"), SampleCreatedByLicenseId=_text("l_partkey % 2"), SampleId=_text("l_orderkey % 500"), MonthOfTest=month, YearOfTest=F.year("l_shipdate").cast("string"), ProductType=F.col("l_linestatus"), TestName=_kind(), Result=F.col("l_quantity"), PassFail=F.lit("Pass"))
    out = layouts.oregon(raw, list(TESTS.values()), ORDER)
    return out.select("sample_id", "producer_id", "lab_id", "product_type", "month", "year", F.col("THC").alias("thc"), F.col("THCA").alias("thca"), F.col("Moisture").alias("moisture"))


@query(f"SELECT (l_orderkey % 500)::VARCHAR AS sample_id, (l_partkey % 2)::VARCHAR AS producer_license_number, 'lab' AS lab, 'x' || l_suppkey % 2 AS label, CASE l_linestatus WHEN 'F' THEN 'Raw Flower' ELSE 'Edible' END AS product_type, strftime(l_shipdate, '%Y-%m') AS month, year(l_shipdate)::INT AS year, {_first('A', 'thc')}, {_first('N', 'thca')} FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3, 4, 5, 6, 7, l_shipdate")
def r3_rhode_island(t):
    """Tests whose names have no units and type don't count."""
    kind = F.when(F.col("l_returnflag") == "R", F.lit("Moisture")).otherwise(F.concat(_kind(), F.lit(" (%) "), F.when(F.col("l_linestatus") == "F", "Raw Flower").otherwise("Edible")))
    raw = _raw(t, Id=_text("l_orderkey % 500"), TestingFacilityName=F.lit("lab"), ItemFromFacilityLicenseNumber=_text("l_partkey % 2"), SourcePackageLabels=F.concat(F.lit("x"), _text("l_suppkey % 2")), TestPerformedDate=F.date_format("l_shipdate", "yyyy-MM-dd"), TestTypeName=kind, TestResultLevel=F.col("l_quantity"), OverallPassed=F.lit(True))
    out = layouts.rhode_island(raw, ["THC", "THCA"], ORDER)
    return out.select("sample_id", "producer_license_number", "lab", "label", "product_type", "month", "year", F.col("THC").alias("thc"), F.col("THCA").alias("thca"))


@query(f"""WITH w AS (SELECT l_orderkey AS package_id, year(l_shipdate)::VARCHAR AS date_tested, (l_partkey % 3)::VARCHAR AS strain_name, (l_suppkey % 2)::VARCHAR AS lab_id, {_first('A', 'raw', "l_linestatus = 'F'")}, {_first('A', 'edible', "l_linestatus = 'O'")}, {_first('N', 'a', "l_linestatus = 'F'")}, {_first('N', 'b', "l_linestatus = 'O'")} FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
s AS (SELECT l_orderkey AS package_id, CASE WHEN bool_or(l_quantity >= 45) THEN 'Fail' ELSE 'Pass' END AS status FROM lineitem GROUP BY 1)
SELECT package_id, date_tested, strain_name, lab_id, coalesce(raw, edible) AS thc, coalesce(a, b) AS thca, status FROM w JOIN s USING (package_id) QUALIFY row_number() OVER (PARTITION BY package_id ORDER BY date_tested, strain_name, lab_id) = 1""")
def r4_maryland(t):
    kind = F.when(F.col("l_returnflag") != "R", F.concat(_kind(), F.lit(" (%) "), F.when(F.col("l_linestatus") == "F", "Raw Plant Material").otherwise("Infused Edible")))
    raw = _raw(t, TestPerformedDate=F.year("l_shipdate").cast("string"), PackageId=F.col("l_orderkey"), StrainName=_text("l_partkey % 3"), TestingFacilityId=_text("l_suppkey % 2"), ProductCategoryName=F.lit("Buds"), TestTypeName=kind, TestResultLevel=F.col("l_quantity"), TestPassed=F.col("l_quantity") < 45)
    tests = [f"{k} (%) {p}" for k in ("THC", "THCA") for p in ("Raw Plant Material", "Infused Edible")]
    return layouts.maryland(raw, tests, ORDER).select("package_id", "date_tested", "strain_name", "lab_id", "thc", "thca", "status")


@query(f"SELECT l_orderkey % 500 AS label, CASE WHEN l_suppkey % 2 = 0 THEN 'id' ELSE 'name' END AS lab, strftime(l_shipdate, '%Y-%m') AS month, strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') || '/' || strftime(date_trunc('week', l_shipdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS week, {_first('A', 'delta_9_thc')}, {_first('N', 'thca')}, NULL::DOUBLE AS total_thc, {_first('R', 'yeast_and_mold')} FROM lineitem GROUP BY 1, 2, 3, 4, l_shipdate")
def r5_massachusetts(t):
    kind = F.when(F.col("l_returnflag") == "R", F.lit("Total Yeast and Mold (CFU/g) Raw Plant Material")).otherwise(F.concat(_kind(), F.lit(" (%) Raw Plant Material")))
    even = F.col("l_suppkey") % 2 == 0
    raw = _raw(t, TestingLabId=F.when(even, F.lit("id")), TestingLab=F.lit("name"), StrainName=F.lit(None).cast("string"), Strain=F.lit("s"), ProductCategory=F.lit("Buds"), PackageLabel=F.expr("l_orderkey % 500"), TestType=kind, TestResult=F.col("l_quantity"), TestPerformedDate=F.date_format("l_shipdate", "yyyy-MM-dd"))
    return layouts.massachusetts(raw, ORDER).select("label", "lab", "month", "week", "delta_9_thc", "thca", "total_thc", "yeast_and_mold")


@query(f"""WITH w AS (SELECT l_orderkey AS product_id, l_suppkey % 2 AS lab_id, l_linestatus || ' Type' AS product_type, {_first('A', 'thc')}, {_first('N', 'thca')}, {_first('R', 'moisture')} FROM lineitem GROUP BY ALL),
d AS (SELECT l_orderkey AS product_id, strftime(max(l_shipdate), '%Y-%m-%d') AS date_tested FROM lineitem GROUP BY 1),
o AS (SELECT l_orderkey AS product_id, 'q' || l_quantity::INT AS note, min({SORT}) AS place FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL),
n AS (SELECT product_id, string_agg(note, ', ' ORDER BY place) AS notes FROM o GROUP BY 1)
SELECT product_id, lab_id, product_type, thc, thca, moisture, date_tested, coalesce(notes, '') AS notes FROM w JOIN d USING (product_id) LEFT JOIN n USING (product_id)""")
def r6_mississippi(t):
    note = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("q"), F.col("l_quantity").cast("int").cast("string")))
    raw = _raw(t, Testing__Facility__UID=F.expr("l_suppkey % 2"), ResultRecordedDateTime=F.col("l_shipdate"), Package__ID=F.col("l_orderkey"), Quantity=F.col("l_quantity"), Name=F.concat(_kind(), F.lit(" (%) "), "l_linestatus", F.lit(" Type")), Note=note)
    out = layouts.mississippi(raw, list(TESTS.values()), ORDER)
    return out.select("product_id", "lab_id", "product_type", F.col("THC").alias("thc"), F.col("THCA").alias("thca"), F.col("Moisture").alias("moisture"), F.date_format("date_tested", "yyyy-MM-dd").alias("date_tested"), "notes")


TAG = "'1A405030000' || lpad((l_suppkey % 7)::VARCHAR, 4, '0') || l_orderkey % 500"


@query(f"SELECT {TAG} AS product_id, year(l_shipdate)::INT AS date_tested, {_first('A', 'thc')}, {_first('N', 'thca')}, {_first('R', 'moisture')}, lpad((l_suppkey % 7)::VARCHAR, 3, '0') AS producer_id FROM lineitem GROUP BY ALL")
def r7_ohio(t):
    tag = F.concat(F.lit("1A405030000"), F.lpad(_text("l_suppkey % 7"), 4, "0"), _text("l_orderkey % 500"))
    raw = _raw(t, Date=F.year("l_shipdate"), Tag=tag, Analyte=F.concat(_kind(), F.lit(" (mg/g)")), Result=F.col("l_quantity"), Disposition=F.lit("x"), Notes=F.lit(""))
    return layouts.ohio(raw, list(TESTS.values()), ORDER).select("product_id", "date_tested", F.col("THC").alias("thc"), F.col("THCA").alias("thca"), F.col("Moisture").alias("moisture"), "producer_id")


@query(f"""WITH w AS (SELECT {TAG} AS label, strftime(l_shipdate, '%Y-%m') AS month, l_shipdate, CASE l_linestatus WHEN 'F' THEN 'Flower' ELSE 'Edible' END AS product_type, {_first('A', 'thc')}, {_first('N', 'thca')} FROM lineitem WHERE l_returnflag <> 'R' AND l_shipdate >= DATE '1996-02-01' AND l_shipdate < DATE '1998-07-01' GROUP BY ALL),
s AS (SELECT {TAG} AS label, CASE WHEN bool_or(l_quantity >= 49) THEN 'Fail' ELSE 'Pass' END AS status, bool_or(l_returnflag = 'R') AS r_and_d FROM lineitem GROUP BY 1)
SELECT label, month, product_type, thc, thca, status, r_and_d, substr(label, 13, 3) AS producer_id FROM w JOIN s USING (label)""")
def r8_new_jersey(t):
    """Tests of R&D are of a type of their own, which the sample leaves out."""
    tag = F.concat(F.lit("1A405030000"), F.lpad(_text("l_suppkey % 7"), 4, "0"), _text("l_orderkey % 500"))
    kind = F.when(F.col("l_returnflag") == "R", F.lit("Moisture (%) R&D Testing")).otherwise(F.concat(_kind(), F.lit(" (%) "), F.when(F.col("l_linestatus") == "F", "Raw Plant Material").otherwise("Edibles")))
    raw = _raw(t, TestPerformedDate=F.date_format("l_shipdate", "yyyy-MM-dd"), METRCTag=tag, TestTypeName=kind, TestTypeNamePart=_kind(), TestPassed=F.when(F.col("l_linenumber") > 0, F.col("l_quantity") < 49), TestResultLevel=F.col("l_quantity"), TestComment=F.lit(""), TestingFacilityId=F.lit("lab"))
    out = layouts.new_jersey_sample(layouts.new_jersey(raw, list(TESTS.values()), ORDER), "1996-02-01", "1998-07-01")
    return out.select("label", "month", "product_type", F.col("THC").alias("thc"), F.col("THCA").alias("thca"), "status", "r_and_d", "producer_id")
