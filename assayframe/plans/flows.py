"""Queries that run whole pipelines and incremental runs over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.sources import sinks
from assayframe.streaming import incremental

from . import pipelines
from .figures import SAMPLES, samples
from .registry import ORACLES, QUERIES, query, s6
from .tables import FLAGS, ORDER, SORT

LAYOUT = pipelines.Layout(
    index=["label", "lab"],
    test="testType",
    value="l_quantity",
    order=ORDER,
    tests=["THC (%) Buds", "THCA (%) Buds", "Moisture (%) Buds"],
    product_types=["Buds"],
    keys={"thc": "delta_9_thc"},
    any_flags=["passed"],
    cannabinoids=["delta_9_thc", "thca"],
    constants={"lab_state": "nv"},
)


@query(f"""WITH w AS (SELECT l_orderkey AS label, l_suppkey AS lab, {", ".join(f"arg_min(l_quantity, {SORT}) FILTER (WHERE l_returnflag = '{f}') AS {n}" for f, n in zip(FLAGS, ("delta_9_thc", "thca", "moisture")))} FROM lineitem GROUP BY ALL),
p AS (SELECT l_orderkey AS label, bool_or(l_linestatus = 'F') AS passed FROM lineitem GROUP BY 1)
SELECT label, lab, 'nv' AS lab_state, delta_9_thc, moisture, passed, thca, {s6("coalesce(delta_9_thc, 0) + coalesce(thca, 0)", 2)} AS total_cannabinoids, {s6("delta_9_thc + 0.877 * thca", 2)} AS total_thc FROM w JOIN p USING (label)""")
def curate_long_records(t):
    kind = F.when(F.col("l_returnflag") == "A", "THC (%) Buds").when(F.col("l_returnflag") == "N", "THCA (%) Buds").otherwise("Moisture (%) Buds")
    long = t("lineitem").withColumns({"label": F.col("l_orderkey"), "lab": F.col("l_suppkey"), "testType": kind, "passed": F.col("l_linestatus") == "F"})
    return pipelines.curate(long, LAYOUT).select("label", "lab", "lab_state", "delta_9_thc", "moisture", "passed", "thca", "total_cannabinoids", "total_thc")


def _ledger(t) -> DataFrame:
    """Certificates made of orders (sample), parts (product) and line items (results)."""
    lines = t("lineitem").select("l_orderkey", F.col("l_suppkey").alias("lab"), F.struct(F.lit("potency").alias("analysis"), F.element_at(F.create_map(F.lit("A"), F.lit("delta_9_thc"), F.lit("N"), F.lit("thca"), F.lit("R"), F.lit("beta_myrcene")), F.col("l_returnflag")).alias("key"), F.col("l_quantity").cast("string").alias("value")).alias("r"))
    nested = lines.groupBy("l_orderkey").agg(F.min("lab").cast("string").alias("lab"), F.to_json(F.array_sort(F.collect_list("r"))).alias("results"))
    orders = t("orders").join(nested, F.col("o_orderkey") == F.col("l_orderkey"))
    blank = F.lit(None).cast("string")
    return orders.select(
        (F.col("o_orderkey") % 5000).cast("string").alias("sample_id"), F.md5(F.col("o_orderkey").cast("string")).alias("sample_hash"), F.col("o_orderdate").alias("coa_parsed_at"), F.col("o_orderpriority").alias("product_name"), F.col("o_orderstatus").alias("strain_name"),
        F.lit("Pre-Roll").alias("product_type"), "lab", F.lit("NV").alias("lab_state"), F.col("o_custkey").cast("string").alias("producer"), F.lit("NV").alias("producer_state"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_tested"), blank.alias("date_collected"), "results", F.lit("[]").alias("methods"),
    )


@query("""WITH f AS (SELECT o_orderkey % 5000 AS s, arg_max(o_orderkey, row(o_orderdate, -hash_rank)) AS k FROM (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR)) AS hash_rank FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) GROUP BY 1)
SELECT s::VARCHAR AS sample_id, CASE WHEN contains(o_orderpriority, o_orderstatus) THEN o_orderpriority ELSE o_orderpriority || ' (' || o_orderstatus || ')' END AS title, 'preroll' AS standard_product_type, strftime(o_orderdate, '%Y-%m') AS month,
  arg_min(l_quantity, l_quantity::VARCHAR) FILTER (WHERE l_returnflag = 'A') AS delta_9_thc, 4 AS n_tags FROM f JOIN orders ON o_orderkey = k JOIN lineitem ON l_orderkey = k GROUP BY ALL""")
def publish_certificates(t):
    out = pipelines.publish(_ledger(t), ["delta_9_thc", "thca"], ["beta_myrcene"])
    return out.select("sample_id", "title", "standard_product_type", "month", "delta_9_thc", F.size("tags").alias("n_tags"))


@query(f"WITH y AS (SELECT lab, year, count(*) AS n, count(DISTINCT producer) AS n_producer, count(DISTINCT kind) AS n_kind FROM ({SAMPLES}) GROUP BY ALL) SELECT *, lag(n) OVER (PARTITION BY lab ORDER BY year) AS prev_n, {s6('(n - lag(n) OVER (PARTITION BY lab ORDER BY year)) * 100.0::DOUBLE / lag(n) OVER (PARTITION BY lab ORDER BY year)', 2)} AS change FROM y")
def entity_growth(t):
    return pipelines.entity_statistics(samples(t).withColumn("month", F.month("date")), "lab", ["producer", "kind"])["growth"]


def i2_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users and event types, by a file stream that works through what is there."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = incremental.new_files(spark, sf_dir, schema, "events.parquet").select("user_id", "event_type")
    place = sinks.working_dir(spark, "stream-dedupe")
    incremental.run_available(incremental.first_seen(stream, ["user_id", "event_type"]), f"{place}/checkpoint", f"{place}/rows")
    return spark.read.schema("user_id bigint, event_type string").parquet(f"{place}/rows")


def i6_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of six-hour windows by event type, by a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = incremental.new_files(spark, sf_dir, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    place = sinks.working_dir(spark, "stream-windows")
    counts = incremental.period_counts(stream, "ts", "6 hours", ["event_type"])
    incremental.run_available(counts, f"{place}/checkpoint", each=lambda batch, _: batch.write.mode("overwrite").parquet(f"{place}/rows"), mode="complete")
    out = spark.read.schema("start timestamp, end timestamp, event_type string, n bigint").parquet(f"{place}/rows")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


QUERIES |= {"i2_stream_dedupe": i2_stream_dedupe, "i6_stream_windows": i6_stream_windows}
ORACLES |= {
    "i2_stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
    "i6_stream_windows": "SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
