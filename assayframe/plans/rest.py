"""Queries of files, formats, reports, pages and single column functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions import chemistry, dates, html, nested, normalize, numbers, text
from assayframe.functions.html import Rule
from assayframe.operators import columns, dedupe
from assayframe.sources import readers, sinks

from .extras import _places
from .registry import ORACLES, QUERIES, query, r6, s6


@query("SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('420:' || o_orderkey), o_orderkey LIMIT 250)")
def p18_m8_sample(t):
    return columns.sample_rows(t("orders").select("o_orderkey", "o_totalprice"), 250, ["o_orderkey"], 420)


@query("SELECT l_orderkey, arg_min(l_quantity, l_linenumber) FILTER (WHERE l_returnflag = 'A') AS a, arg_min(l_quantity, l_linenumber) FILTER (WHERE l_returnflag = 'N') AS n FROM (SELECT l_orderkey, l_returnflag, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, l_quantity) = 1) GROUP BY 1")
def a28_widened(t):
    """The first result of each of two keys in a column of its own."""
    first = dedupe.keep_first(t("lineitem").select("l_orderkey", "l_returnflag", "l_linenumber", "l_quantity"), ["l_orderkey", "l_returnflag"], [F.col("l_linenumber"), F.col("l_quantity")])
    held = first.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.lower("l_returnflag").alias("key"), F.col("l_quantity").alias("value")))).alias("lines"))
    results = F.transform(F.col("lines"), lambda x: F.struct(F.lit("potency").alias("analysis"), x["key"].alias("key"), x["value"].cast("string").alias("value")))
    return nested.widened(held.select("l_orderkey", results.alias("results")), "results", ["a", "n"]).drop("results")


@query("SELECT p_partkey, concat_ws(';', CASE WHEN p_size > 20 THEN 'size=' || p_size || '.0' END, 'price=' || p_retailprice::DECIMAL(18,1)) AS results FROM (SELECT p_partkey, p_size, floor(p_retailprice) AS p_retailprice FROM part)")
def a29_flattened(t):
    rows = t("part").select("p_partkey", F.when(F.col("p_size") > 20, F.col("p_size")).alias("p_size"), F.floor("p_retailprice").alias("p_retailprice"))
    out = nested.flattened(rows, {"size": "p_size", "price": "p_retailprice"})
    return out.select("p_partkey", F.array_join(F.transform("results", lambda r: F.concat(r["key"], F.lit("="), r["value"].cast("string"))), ";").alias("results"))


@query("SELECT l_orderkey, list_aggregate(list_sort(list(DISTINCT l_returnflag)), 'string_agg', ',') AS analyses FROM lineitem GROUP BY 1")
def f73_analyses(t):
    held = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("analysis"))).alias("r"))
    return held.select("l_orderkey", F.array_join(F.array_sort(nested.analyses_of(F.col("r"))), ",").alias("analyses"))


@query("SELECT p_type AS value FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size <= 25) GROUP BY 1 UNION ALL SELECT 'all known: ' || count(*) FROM part")
def f14_f16_known(t):
    """Values that a table of known ones lacks; and the whole table, where all are known."""
    part = t("part")
    unknown = normalize.unknown_values(part, "p_type", part.where("p_size <= 25").select(F.col("p_type").alias("value")).distinct(), "value")
    known = normalize.require_known(part, "p_type", part.select(F.col("p_type").alias("value")).distinct(), "value")
    return unknown.union(known.agg(F.concat(F.lit("all known: "), F.count("*").cast("string"))))


@query("""SELECT p_partkey, CASE WHEN ends_with(p_name, 'large ring') THEN 'large ring' WHEN ends_with(p_name, 'plate') THEN 'plate' WHEN ends_with(p_name, 'ring') THEN 'ring' END AS kind,
  p_brand AS inner_text, CASE WHEN len(p_name) > 9 THEN p_name[:9] || '...' ELSE p_name END AS short FROM part""")
def f19_f30_text(t):
    said = F.concat(F.lit("a <i>"), "p_brand", F.lit("</i> b"))
    return t("part").select("p_partkey", text.longest_suffix(F.col("p_name"), ["ring", "large ring", "plate"]).alias("kind"), text.between(said, "<i>", "</i>").alias("inner_text"), text.shortened(F.col("p_name"), 9).alias("short"))


@query("SELECT s_suppkey, s_suppkey || ' Main St' AS street, 'New ' || s_name AS city, 'CT' AS state, lpad(s_nationkey::VARCHAR, 5, '0') AS zipcode FROM supplier")
def f31_addresses(t):
    said = F.concat("s_suppkey", F.lit(" Main St, New "), "s_name", F.lit(" CT "), F.lpad(F.col("s_nationkey").cast("string"), 5, "0"))
    return t("supplier").select("s_suppkey", *[c.alias(k) for k, c in text.address_parts(said).items()])


@query("SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN l_quantity::VARCHAR WHEN 'N' THEN 'ND' END AS value, CASE l_returnflag WHEN 'A' THEN 'pass' WHEN 'R' THEN 'fail' END AS status FROM lineitem")
def f33_status_words(t):
    said = F.when(F.col("l_returnflag") == "A", F.concat(F.col("l_quantity").cast("string"), F.lit(" PASS"))).when(F.col("l_returnflag") == "N", "Not Detected").otherwise("Fail")
    return t("lineitem").select("l_orderkey", "l_linenumber", *[c.alias(k) for k, c in text.status_word(said).items()])


@query(f"SELECT p_partkey, {s6('p_retailprice / 10')} AS THC, p_size AS \"CBD (%)\" FROM part")
def f47_percent(t):
    rows = t("part").select("p_partkey", F.col("p_retailprice").alias("THC (mg/g)"), F.col("p_size").alias("CBD (%)"))
    out = chemistry.milligrams_to_percent(rows)
    return out.withColumn("THC", r6(F.col("THC")))


@query(f"""SELECT p_partkey, p_retailprice AS price, {s6("p_retailprice * 0.25", 4)} AS discount, CASE WHEN p_brand = 'Brand#1' THEN 1.0 WHEN p_brand = 'Brand#2' THEN 0.5 END::DOUBLE AS indica,
CASE WHEN p_brand = 'Brand#1' THEN 0.0 WHEN p_brand = 'Brand#2' THEN 0.5 END::DOUBLE AS sativa FROM part""")
def f52_prices(t):
    said = lambda c: F.concat(F.lit("$ "), c.cast("string"))
    price = F.col("p_retailprice")
    shares = text.indica_shares(F.col("p_brand"), {"brand#1": 1.0, "brand#2": 0.5})
    return t("part").select("p_partkey", text.money(said(price)).alias("price"), numbers.round_even(text.discount(said(price), said(price * 0.75)), 4).alias("discount"), *[c.alias(k) for k, c in shares.items()])


@query("""SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '20%y-%m-%d') AS short, strftime(o_orderdate, '%H:%M:%S') AS naive,
  CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m') END AS label FROM orders""")
def f56_f66_dates(t):
    rows = t("orders").withColumn("valid", dates.parsed(F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("soon")))
    out = dates.date_parts(rows, "valid")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return out.select(
        "o_orderkey", day(dates.parsed(F.date_format("o_orderdate", "yyyy-M"))).alias("month"), day(dates.parsed(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("day"), dates.short_year(F.date_format("o_orderdate", "MM/dd/yy")).alias("short"),
        F.date_format(dates.without_zone(F.col("o_orderdate")), "HH:mm:ss").alias("naive"), F.col("month").alias("label"),
    )


@query("SELECT s_nationkey::VARCHAR AS state, max('list-' || lpad(s_suppkey::VARCHAR, 7, '0') || '.csv') AS path FROM supplier GROUP BY 1")
def s19_latest_by_state(t):
    files = t("supplier").select(F.col("s_nationkey").cast("string").alias("state"), F.concat(F.lit("list-"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0"), F.lit(".csv")).alias("path"))
    return readers.latest_by_state(files)


@query(r"""WITH p AS (SELECT page_id, string_split(string_split(html, '<nav>')[2], '</nav>')[1] AS nav, string_split(string_split(html, '<h1>')[2], '</h1>')[1] AS h1 FROM pages)
SELECT page_id, array_to_string(list_transform(string_split(nav, '<a href="')[2:], lambda x: string_split(x, '"')[1]), ' ') AS links, trim(regexp_replace(replace(replace(replace(replace(h1, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS head FROM p""")
def s12_elements(t):
    page = F.col("html")
    links = html.attribute(page, Rule("a", within=Rule("nav")), "href")
    return t("pages").select("page_id", F.array_join(links, " ").alias("links"), F.get(html.texts(page, Rule("h1", within=Rule("article"))), 0).alias("head"))


# -- files written of a table and read back ---------------------------------------------------------------------------


def s3_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, place = _places(spark, sf_dir, "part")
    df.select("p_partkey", "p_name", "p_size").write.option("header", True).option("sep", "\t").option("encoding", "UTF-16LE").option("lineSep", "\r\n").csv(f"{place}/x")
    return readers.read_delimited(spark, f"{place}/x", "p_partkey long, p_name string, p_size int", {"p_name": "product_name"}, sep="\t", encoding="UTF-16LE")


def s9_api_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers of each nation as one document of an interface: names of columns, then rows as lists."""
    df, place = _places(spark, sf_dir, "supplier")
    names = F.array(*[F.struct(F.lit(x).alias("name")) for x in ("Supplier Key", "NAME", "none")])
    rows = df.groupBy("s_nationkey").agg(F.collect_list(F.array(F.col("s_suppkey").cast("string"), "s_name", F.lit("x"))).alias("data"))
    document = F.to_json(F.struct(F.struct(F.struct(names.alias("columns")).alias("view")).alias("meta"), "data"))
    rows.select(document.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{place}/x")
    return readers.read_api_table(spark, f"{place}/x", ["Supplier Key", "Name", "Rating"]).withColumnsRenamed({"Supplier Key": "supplier_key", "Name": "name", "Rating": "rating"})


def s10_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, place = _places(spark, sf_dir, "nation")
    values = df.groupBy("n_regionkey").agg(F.collect_list("n_name").alias("names"))
    whole = values.agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_regionkey").cast("string"), F.struct("names")))).alias("m"))
    whole.select(F.to_json("m").alias("value")).coalesce(1).write.text(f"{place}/x")
    return readers.read_config(spark, f"{place}/x/part-*", "region", "names")


def s11_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as samples of a report, their line items as analytes of two sections."""
    items, place = _places(spark, sf_dir, "lineitem")
    line = F.concat(F.lit("item "), F.col("l_linenumber").cast("string"), F.lit("  "), F.col("l_quantity").cast("int").cast("string"), F.lit(" mg/g"))
    rows = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "A", line))).alias("a"), F.array_sort(F.collect_list(F.when(F.col("l_returnflag") != "A", line))).alias("b"))
    section = lambda title, own: F.when(F.size(own) > 0, F.concat(F.array(F.lit(title)), own)).otherwise(F.array())
    block = F.concat(F.array(F.concat(F.lit("1/2/2024 Order "), F.col("l_orderkey").cast("string"))), section("Cannabinoids", F.col("a")), F.array(F.lit("page footer")), section("Terpenes", F.col("b")))
    rows.select(F.array_join(block, "\n").alias("value")).write.text(f"{place}/x")
    read = readers.read_report(spark, f"{place}/x", {"cannabinoids": "potency", "terpenes": "terpenes"}, skip=["page"])
    one = read.select("product_name", F.explode("results").alias("r")).groupBy("product_name")
    return one.agg(F.count("*").alias("n"), F.count_if(F.col("r.analysis") == "potency").alias("potency"), F.sum(F.col("r.value").cast("long")).alias("total"))


def k1_k2_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated copy and the latest one, and three formats: as many equal rows from each."""
    df, place = _places(spark, sf_dir, "supplier")
    rows, schema = df.select("s_suppkey", "s_name"), "s_suppkey long, s_name string"
    read = {path.rsplit("/", 1)[1]: spark.read.schema(schema).option("header", True).csv(path) for path in sinks.save_dated(rows, place, "labs", "2024-05-01")}
    for path in sinks.save_formats(rows, f"{place}/all"):
        kind = path.rsplit(".", 1)[1]
        read[f"all.{kind}"] = spark.read.schema(schema).option("header", True).format(kind).load(path)
    out = None
    for name, part in read.items():
        part = part.select(F.lit(name).alias("place"), "s_suppkey", "s_name")
        out = part if out is None else out.unionByName(part)
    return out


def d5_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import time

    df, place = _places(spark, sf_dir, "customer")
    rows = df.select("c_custkey", F.lit("old").alias("v"))
    rows.write.parquet(f"{place}/x/1")
    time.sleep(0.5)  # files' times are told in milliseconds
    rows.where("c_custkey % 2 = 0").withColumn("v", F.lit("new")).write.parquet(f"{place}/x/2")
    return readers.latest_file_wins(spark.read.schema("c_custkey long, v string").parquet(f"{place}/x/1", f"{place}/x/2"), "c_custkey")


def d6_duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each supplier with the tens of its nation: all but the oldest of each content, by content."""
    df, place = _places(spark, sf_dir, "supplier")
    rows = df.select("s_suppkey", F.concat(F.lit("nations "), F.floor(F.col("s_nationkey") / 10).cast("string")).alias("value"))
    rows.repartitionByRange(max(2, rows.count() // 5), "s_suppkey").select("value").write.option("maxRecordsPerFile", 1).text(f"{place}/x")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{place}/x")
    return dedupe.duplicate_files(files).groupBy("hash").agg(F.count("*").alias("repeats"))


QUERIES |= {f.__name__: f for f in (s3_wide, s9_api_table, s10_config, s11_report, k1_k2_saved, d5_latest_file, d6_duplicate_files)}
ORACLES |= {
    "s3_wide": "SELECT p_partkey, p_name AS product_name, p_size FROM part",
    "s9_api_table": "SELECT s_suppkey::VARCHAR AS supplier_key, s_name AS name, NULL::VARCHAR AS rating FROM supplier",
    "s10_config": "SELECT n_regionkey::VARCHAR AS region, n_name AS names FROM nation",
    "s11_report": "SELECT 'Order ' || l_orderkey AS product_name, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'A') AS potency, sum(trunc(l_quantity))::BIGINT AS total FROM lineitem GROUP BY l_orderkey",
    "k1_k2_saved": "SELECT place, s_suppkey, s_name FROM supplier, (VALUES ('labs-2024-05-01'), ('labs-latest'), ('all.parquet'), ('all.csv'), ('all.json')) v(place)",
    "d5_latest_file": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS v FROM customer",
    "d6_duplicate_files": "SELECT sha256('nations ' || s_nationkey // 10 || chr(10)) AS hash, count(*) - 1 AS repeats FROM supplier GROUP BY s_nationkey // 10 HAVING count(*) > 1",
}
