"""Queries of records, strains, certificates, segments, file order, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.functions import nested, records, text
from assayframe.operators import columns, dedupe, joins, order, reshape, shards, states, statistics, terms
from assayframe.sources import collectors, readers, runs, sinks

from .registry import ORACLES, QUERIES, query, r6, s6


@query("SELECT event_id, value FROM events WHERE event_type <> 'view' AND value IS NOT NULL")
def p12_drop_missing(t):
    rows = t("events").select("event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("value"))
    return rows.dropna(subset=["value"])


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'")
def p15_with_results(t):
    rows = t("orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderpriority") == "5-LOW", "[]").otherwise("[{'key': 'thc', 'value': '1'}]").alias("results"))
    return nested.with_results(rows, "results").where("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'none' END AS segment, c_name AS name, 'nv' AS state FROM customer")
def p26_merged(t):
    rows = t("customer").select("c_custkey", F.lit("none").alias("segment"), F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("_segment"))
    return columns.merged(rows, {"state": F.lit("nv"), "segment": F.lit("constant")}, {"segment": F.col("_segment")}).drop("_segment")


@query("SELECT vec_id, any_value(text) AS text, len(any_value(embedding)) AS dimensions FROM embeddings JOIN (SELECT doc_id, text FROM documents) ON doc_id = vec_id GROUP BY 1")
def j13_embedding_texts(t):
    docs = t("documents").select(F.col("doc_id").alias("vec_id"), "text")
    out = t("embeddings").join(dedupe.keep_first(docs, ["vec_id"], [F.col("text")]), "vec_id")
    return out.select("vec_id", "text", F.size("embedding").cast("long").alias("dimensions"))


@query(f"SELECT l_suppkey, count(*) AS tests, count(DISTINCT l_partkey) AS products, {s6('count(*)::DOUBLE / count(DISTINCT l_partkey)')} AS per_product, {s6('avg(l_quantity)')} AS quantity FROM lineitem GROUP BY 1")
def j16_a20_aligned(t):
    out = statistics.aggregated(t("lineitem"), ["l_suppkey"], {"tests": ("count", "*"), "products": ("distinct", "l_partkey"), "quantity": ("mean", "l_quantity")})
    return out.select("l_suppkey", "tests", "products", r6(F.col("tests") / F.col("products")).alias("per_product"), r6(F.col("quantity")).alias("quantity"))


@query(f"SELECT count(*) AS n, sum((o_orderstatus = 'F')::INT)::BIGINT AS parsed, {s6('avg((o_orderstatus = chr(70))::INT)')} AS accuracy FROM orders")
def a38_accuracy(t):
    return statistics.accuracy(t("orders"), F.col("o_orderstatus") == "F", "parsed").withColumn("accuracy", r6(F.col("accuracy")))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS part FROM part")
def r13_split_rows(t):
    return reshape.split_rows(t("part").select("p_partkey", "p_name"), "p_name", " ", "part").select("p_partkey", "part")


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(string_split(p_name || ' ' || p_name || ' x', ' '))), ',') AS words FROM part")
def d10_list_unique(t):
    return t("part").select("p_partkey", F.array_join(F.array_sort(F.array_distinct(F.split(F.concat_ws(" ", "p_name", "p_name", F.lit("x")), " "))), ",").alias("words"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS any_returned, bool_and(l_linestatus = 'F') OVER (PARTITION BY l_orderkey) AS all_final FROM lineitem")
def w9_flags_of_all(t):
    out = statistics.with_flags(t("lineitem"), ["l_orderkey"], any_of={"any_returned": F.col("l_returnflag") == "R"}, all_of={"all_final": F.col("l_linestatus") == "F"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "any_returned", "all_final")


@query(f"SELECT segment, {s6('avg(l_quantity)')} AS mean, count(*) AS n FROM (SELECT *, CASE WHEN l_shipdate BETWEEN DATE '1995-03-01' AND DATE '1996-12-31' THEN 0 WHEN l_shipdate BETWEEN DATE '1998-01-01' AND DATE '1999-06-30' THEN 1 END AS segment FROM lineitem) WHERE segment IS NOT NULL GROUP BY 1")
def w10_date_segments(t):
    rows = statistics.segments(t("lineitem"), "l_shipdate", [("1995-03-01", "1996-12-31"), ("1998-01-01", "1999-06-30")])
    return rows.groupBy("segment").agg(r6(F.avg("l_quantity")).alias("mean"), F.count("*").alias("n"))


@query("SELECT name, row_number() OVER (ORDER BY k) AS place FROM (SELECT 'file' || s_suppkey || '.csv' AS name, s_suppkey AS k FROM supplier)")
def o2_o5_natural_order(t):
    files = t("supplier").select(F.concat(F.lit("file"), "s_suppkey", F.lit(".csv")).alias("name"))
    return order.numbered(files, [text.natural_key(F.col("name")), F.col("name")])


@query("SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id) AS newest, row_number() OVER (ORDER BY md5('7:' || event_id), event_id) AS shuffled FROM events")
def o5_time_and_shuffle(t):
    """The newest first, and a repeatable shuffle, over the whole table."""
    newest = order.numbered(t("events").select("event_id", "ts"), [F.desc("ts"), F.col("event_id")], "newest")
    return order.numbered(newest, [F.md5(F.concat(F.lit("7:"), F.col("event_id").cast("string"))), F.col("event_id")], "shuffled").select("event_id", "newest", "shuffled")


@query("SELECT event_id, rank() OVER (ORDER BY value DESC NULLS LAST) AS rank, dense_rank() OVER (ORDER BY value DESC NULLS LAST) AS dense_rank FROM events")
def w2_whole_ranks(t):
    return order.ranked(t("events").select("event_id", "value"), [F.desc("value")], ["value"]).select("event_id", "rank", "dense_rank")


@query(f"SELECT event_id, {s6('avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS moving_average FROM events")
def w1_whole_moving(t):
    out = order.moving(t("events").select("event_id", "ts", "value"), "value", [F.col("ts"), F.col("event_id")])
    return out.select("event_id", r6(F.col("moving_average")).alias("moving_average"))


@query("""SELECT o_orderkey, o_orderpriority AS product_name, o_totalprice AS total_thc, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS date_tested, 0 AS images, 2 AS metrc_ids,
  substr(sha256(o_orderpriority || CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '' END), 1, 16) AS id FROM orders""")
def f8_records(t):
    said = F.to_json(F.struct(F.col("o_orderpriority").alias("product_name"), F.col("o_totalprice").alias("total_thc"), F.lit("?").alias("unknown"), F.array(F.lit("a"), F.lit("b")).alias("metrc_ids"), F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon").alias("date_tested")))
    read = t("orders").select("o_orderkey", records.from_text(said).alias("r"))
    again = read.select("o_orderkey", records.from_text(records.to_text(F.col("r"))).alias("r"), "r.*")
    whole = records.completed(read.select("r.*", "o_orderkey").drop("o_orderkey")).select("id", "product_name", "date_tested", "total_thc").distinct()
    keys = ["product_name", "date_tested", "total_thc"]
    joined = again.select("o_orderkey", *[F.col(f"r.{k}").alias(k) for k in keys], F.size("r.images").alias("images"), F.size("r.metrc_ids").alias("metrc_ids"))
    out = joined.join(whole, [joined[k].eqNullSafe(whole[k]) for k in keys]).select("o_orderkey", joined["product_name"], joined["total_thc"], joined["date_tested"], "images", "metrc_ids", "id")
    return out.withColumn("date_tested", F.date_format("date_tested", "yyyy-MM-dd'T'HH:mm:ss"))


STRAINS = ["blue", "light blue", "red", "dark", "steel"]


@query("""WITH s(s) AS (VALUES ('blue'), ('light blue'), ('red'), ('dark'), ('steel')), m AS (SELECT p_partkey, (SELECT arg_max(s, len(s)) FROM s WHERE contains(lower(p_name || ' ' || p_brand), s)) AS found FROM part)
SELECT p_partkey, CASE found WHEN 'light blue' THEN 'blue' WHEN 'dark' THEN 'black' ELSE found END AS standard_strain_name FROM m WHERE found IS NOT NULL""")
def f24_known_strains(t):
    return joins.known_terms(t("part"), ["p_name", "p_brand"], STRAINS, {"light blue": "blue", "dark": "black"}, "standard_strain_name").select("p_partkey", "standard_strain_name")


_SAID = "(SELECT o_orderkey, o_orderpriority || ' for Customer#' || lpad(o_custkey::VARCHAR, 9, '0') || '-' || o_orderstatus AS said FROM orders)"


@query(f"""WITH terms AS (SELECT lower(c_name) AS term FROM customer UNION SELECT lower(c_name) || '-o' FROM customer WHERE c_custkey % 2 = 0 UNION SELECT 'for customer#' UNION SELECT '-p'),
texts AS (SELECT DISTINCT lower(said) AS said FROM {_SAID}), pairs AS (SELECT said, term FROM texts JOIN terms ON substr(said, strpos(said, 'customer#'), 18) = substr(term, 1, 18) OR (len(term) < 18 AND contains(said, term))),
best AS (SELECT said, arg_min(term, row(-len(term), term)) AS term FROM pairs WHERE contains(said, term) GROUP BY 1)
SELECT o_orderkey, best.term AS strain FROM {_SAID} o JOIN best ON lower(o.said) = best.said""")
def f24_many_strains(t):
    """As many terms as customers have names, and parts of them, in the texts of orders: the longest one."""
    names = F.lower("c_name").alias("term")
    listed = t("customer").select(names).union(t("customer").where("c_custkey % 2 = 0").select(F.concat(F.lower("c_name"), F.lit("-o"))))
    listed = listed.union(listed.sparkSession.createDataFrame([("for customer#",), ("-p",)], "term string"))
    said = F.concat("o_orderpriority", F.lit(" for Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit("-"), "o_orderstatus")
    out = terms.with_best_term(t("orders").select("o_orderkey", said.alias("said")), F.lower("said"), listed, "term", terms.longest_first("term"), "strain")
    return out.where(F.col("strain").isNotNull()).select("o_orderkey", "strain")


_LISTED = r"SELECT DISTINCT trim(x) AS term FROM (SELECT unnest(regexp_split_to_array(text, '[.,]')) AS x FROM benchmark UNION ALL SELECT unnest(string_split(text, ' ')) FROM benchmark) WHERE trim(x) <> ''"


@query(f"""WITH terms AS ({_LISTED}), texts AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL), best AS (SELECT text, arg_min(term, row(-len(term), term)) AS term FROM texts JOIN terms ON contains(text, term) GROUP BY 1)
SELECT doc_id, best.term AS term FROM documents LEFT JOIN best USING (text)""")
def j12_terms_in_documents(t):
    """The longest of the words and clauses of all benchmark items that each whole document holds."""
    listed = t("benchmark").select(F.explode(F.concat(F.split("text", "[.,]"), F.split("text", " "))).alias("term")).select(F.trim("term").alias("term")).where("term <> ''").distinct()
    return terms.with_best_term(t("documents").select("doc_id", "text"), "text", listed, "term", terms.longest_first("term")).select("doc_id", "term")


@query("SELECT p_partkey, p_brand || ' × ' || p_type AS strains FROM part")
def f28_joined_strains(t):
    return t("part").select("p_partkey", text.joined_strains(F.array("p_brand", "p_type")).alias("strains"))


@query("""SELECT p_partkey, 'pesticides:' || replace(lower(p_name), ' ', '_') || ':ND:,pesticides:b:<0.1:,pesticides:c:0.2:' || p_size || '.0' AS results FROM part""")
def f32_table_rows(t):
    """A table of one and of two columns of results, with a header row."""
    cells = F.array(F.array(F.lit("Pesticides\nby LCMS")), F.array(F.lit("Analyte"), F.lit("Pass/Fail")), F.array(F.col("p_name"), F.lit("ND"), F.lit("b"), F.lit("<0.1")), F.array(F.lit("c"), F.lit("0.2"), F.concat(F.col("p_size"), F.lit(".0"))), F.array().cast("array<string>"))
    said = F.transform(nested.table_results(cells, "pesticides", skip=["Pass/Fail", "Analyte"]), lambda r: F.concat_ws(":", r["analysis"], r["key"], r["value"], F.coalesce(r["limit"], F.lit(""))))
    return t("part").select("p_partkey", F.array_join(said, ",").alias("results"))


@query("SELECT p_partkey, CASE WHEN contains(p_name, 'red') THEN 'Red Labs' WHEN contains(p_name, 'blue') OR contains(p_brand, '1') THEN 'Blue Labs' ELSE 'unidentified' END AS lab FROM part")
def f34_identified_lab(t):
    page = F.concat_ws(" ", "p_name", "p_brand")
    return t("part").select("p_partkey", text.identified(page, {"Red Labs": ["red"], "Blue Labs": ["blue", "1"]}, "unidentified").alias("lab"))


@query("SELECT c_custkey, '[\"' || c_mktsegment || '\",\"x\"]' AS analyses, 'coas' AS data_type, '/coas/' || c_custkey AS link, c_custkey::VARCHAR AS id FROM customer")
def f72_f75_metadata(t):
    rows = t("customer").select("c_custkey", F.col("c_custkey").cast("string").alias("sample_id"), F.to_json(F.array("c_mktsegment", F.lit("x"))).alias("analyses"))
    return columns.with_metadata(rows, "coas", "sample_id", "pipeline", F.lit("2024-01-01T00:00:00")).select("c_custkey", "analyses", "data_type", "link", "id")


@query("WITH s(code, name) AS (VALUES ('ca', 'California'), ('wa', 'Washington'), ('mo', 'Missouri')) SELECT n_nationkey, code, name, (code <> 'mo') AS active, (code = 'wa') AS public_records FROM nation JOIN s ON code = list_extract(['ca', 'wa', 'mo', 'xx'], (n_nationkey % 4 + 1)::INT)")
def x7_states(t):
    nations = t("nation").withColumn("code", F.element_at(F.array(*[F.lit(x) for x in ("ca", "wa", "mo", "xx")]), (F.col("n_nationkey") % 4 + 1).cast("int")))
    return nations.join(F.broadcast(records.states(nations.sparkSession)), "code").select("n_nationkey", "code", "name", "active", "public_records")


# -- sources and sinks: files are written of a table and read back ----------------------------------------------------


def _places(spark: SparkSession, sf_dir: str, table: str) -> tuple[DataFrame, str]:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet"), sinks.working_dir(spark, table)


def s2_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, place = _places(spark, sf_dir, "part")
    df.select("p_partkey", "p_name", "p_size").write.option("header", True).option("encoding", "ISO-8859-1").csv(f"{place}/x")
    return readers.read_delimited(spark, f"{place}/x", "p_partkey long, p_name string, p_size int", {"p_name": "product_name"}, encoding="ISO-8859-1")


def s4_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files below a folder but those of one name, which hold the pending orders."""
    df, place = _places(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    for half, rows in (("low", df.where("o_orderkey % 2 = 0")), ("high", df.where("o_orderkey % 2 = 1"))):
        rows.repartitionByRange(2, pending).select("o_orderkey", "o_orderpriority").write.option("header", True).option("sep", "\t").csv(f"{place}/deep/{half}")
    return readers.read_tree(spark, f"{place}/deep", "o_orderkey long, o_orderpriority string", "part-*", "PART-00001", {"o_orderpriority": "priority"}, sep="\t")


def s8_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of several files: the last value of a key wins."""
    df, place = _places(spark, sf_dir, "supplier")
    rows = df.select(F.col("s_suppkey").cast("string").alias("k"), "s_name")
    sinks.append_ledger(rows.withColumn("s_name", F.lit("old")), f"{place}/ledger", "k")
    sinks.append_ledger(rows, f"{place}/ledger", "k")
    return readers.read_ledger(spark, f"{place}/ledger", "s_name string")


def k3_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, place = _places(spark, sf_dir, "orders")
    rows = df.select("o_orderkey", F.year("o_orderdate").alias("year"), F.lit("first").alias("v"))
    sinks.upsert_partitions(rows.where("o_orderkey % 2 = 0"), f"{place}/years", ["o_orderkey"], "year", ["v"])
    sinks.upsert_partitions(rows.where("o_orderkey % 3 = 0").withColumn("v", F.lit("second")), f"{place}/years", ["o_orderkey"], "year", ["v"])
    return runs.read_runs(spark, f"{place}/years").select("o_orderkey", "v", "year")


def k4_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents are added once; an update replaces them."""
    df, place = _places(spark, sf_dir, "customer")
    rows = df.select(F.col("c_custkey").alias("id"), F.lit("first").alias("v"))
    run = lambda part, v, **how: sinks.upsert_documents(rows.where(part).withColumn("v", F.lit(v)), f"{place}/docs", f"{place}/ledger", **how)
    run("id % 2 = 0", "first")
    run("id % 3 = 0", "second")
    run("id % 5 = 0", "third", update=True)
    return sinks.read_documents(spark, f"{place}/docs").select("id", "v")


def k6_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = _places(spark, sf_dir, "orders")
    count = lambda rows: rows.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus")
    rows = df.select("o_orderpriority", key)
    return sinks.changed_only(count(rows), count(rows.where("o_orderpriority <> '1-URGENT' or o_orderstatus is null")), ["o_orderpriority", "o_orderstatus"])


def _yearly_shards(spark: SparkSession, sf_dir: str) -> tuple[shards.Bucketed, shards.Bucketed, list[str]]:
    """Parts, and line items cut into a shard for each year: the early ones name the amount otherwise and have no price."""
    items, parts = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("lineitem", "part"))
    items = items.select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.year("l_shipdate").alias("year"))
    cut = []
    for year in range(1992, 1999):
        own = items.where(F.col("year") == year).drop("year").withColumnsRenamed({"l_partkey": "p_partkey"})
        early = own.drop("l_extendedprice").withColumnRenamed("l_quantity", "amount")
        cut.append(shards.Shard(early, {"amount": "quantity"}) if year < 1995 else shards.Shard(own, {"l_quantity": "quantity", "l_extendedprice": "price"}))
    left = shards.bucketed(parts.select("p_partkey", "p_brand"), "p_partkey", 8)
    order = {"l_orderkey": "long", "l_linenumber": "int"}
    return left, shards.stacked(cut, "p_partkey", {"quantity": "double", "price": "double"}, order, 8), [*order, "quantity"]


def j4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first amount and price of each part over yearly shards; what early shards lack later ones fill."""
    left, stacked, order = _yearly_shards(spark, sf_dir)
    return shards.enriched(left, stacked, ["quantity", "price"], order, spark)


def j5_matched_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the first row of each shard that has them."""
    left, stacked, order = _yearly_shards(spark, sf_dir)
    return shards.matched(left, stacked, ["quantity", "price"], order, spark).withColumnRenamed("_shard", "shard")


def a21_merged_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of line items from states of days, stored by three runs, of which the last makes some days again."""
    items, place = _places(spark, sf_dir, "lineitem")
    items = items.withColumn("date", F.to_date("l_shipdate"))
    days = [r["date"] for r in items.select("date").distinct().collect()]  # one line for each day
    args = ("date", ["l_returnflag"], "l_quantity", "l_partkey")
    wrong = items.withColumn("l_quantity", F.lit(1.0))
    for source, own in ((wrong, [d for d in days if d.year < 1996]), (items, [d for d in days if d.year >= 1996]), (items, [d for d in days if d.year < 1996])):
        states.update(source, f"{place}/states", own, *args)
    got = states.merged(states.stored(spark, f"{place}/states"), ["l_returnflag"])
    # apart: a distinct count beside a digest would make one digest for each part of a month
    by = [F.trunc("date", "month").alias("period"), "l_returnflag"]
    parts = items.select(*by, "l_partkey").distinct().groupBy("period", "l_returnflag").agg(F.count("l_partkey").alias("parts"))
    median = items.groupBy(*by).agg(F.percentile_approx("l_quantity", 0.5, 100_000).alias("median"))
    out = got.join(parts, ["period", "l_returnflag"]).join(median, ["period", "l_returnflag"])
    near = (F.abs(F.col("distinct") - F.col("parts")) <= 0.06 * F.col("parts") + 1) & (F.abs(F.get("quantiles", 1) - F.col("median")) <= 4)
    return out.select(F.date_format("period", "yyyy-MM").alias("month"), "l_returnflag", "n", r6(F.col("mean")).alias("mean"), r6(F.col("std")).alias("std"), "least", "greatest", near.alias("near"))


def _titles(html: str) -> list[dict]:
    title = html.split("<title>", 1)[1].split("</title>", 1)[0]
    return [{"value": title, "n": len(title)}]


def _links(html: str) -> list[dict]:
    return [{"value": part.split('"', 1)[0]} for part in html.split('<a href="')[1:]]


def _strict(html: str) -> list[dict]:
    if "</p>" not in html.rpartition("<article>")[2]:
        raise ValueError("an open paragraph")
    return [{"value": "", "n": 1}] if "<br>" in html else [{"value": "whole", "n": 1}]


def x1_collectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three collectors over all pages, one of which fails on some: records and failures of each."""
    own = [collectors.Collector("titles", "value string, n int", _titles, required=["value"]), collectors.Collector("links", "value string", _links), collectors.Collector("strict", "value string, n int", _strict, required=["value"])]
    pages, place = _places(spark, sf_dir, "pages")
    raw = runs.add_run(collectors.collected_from(pages, own, "page_id", "html"), f"{place}/outcomes")
    got = collectors.all_records(raw, own).groupBy("source", "item").agg(F.count("*").alias("records"), F.max("value").alias("value"))
    failed = collectors.failures(raw).select("source", "item", F.lit(0).cast("long").alias("records"), F.col("error").alias("value"))
    return got.unionByName(failed)


QUERIES |= {f.__name__: f for f in (s2_delimited, s4_tree, s8_ledger, k3_partitions, k4_documents, k6_changes, j4_shards, j5_matched_by_shard, x1_collectors, a21_merged_states)}
ORACLES |= {
    "s2_delimited": "SELECT p_partkey, p_name AS product_name, p_size FROM part",
    "s4_tree": "SELECT o_orderkey, o_orderpriority AS priority FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "s8_ledger": "SELECT s_suppkey::VARCHAR AS key, s_name FROM supplier",
    "k3_partitions": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS v, year(o_orderdate)::INT AS year FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
    "k4_documents": "SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'third' WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS v FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 2 = 0 OR c_custkey % 3 = 0",
    "j4_shards": """SELECT p_partkey, p_brand, arg_min(l_quantity, row(year(l_shipdate), l_orderkey, l_linenumber, l_quantity)) AS quantity,
        arg_min(l_extendedprice, row(year(l_shipdate), l_orderkey, l_linenumber, l_quantity)) FILTER (WHERE year(l_shipdate) >= 1995) AS price FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND year(l_shipdate) BETWEEN 1992 AND 1998 GROUP BY ALL""",
    "j5_matched_by_shard": """SELECT p_partkey, p_brand, (year(l_shipdate) - 1992)::INT AS shard, arg_min(l_quantity, row(l_orderkey, l_linenumber, l_quantity)) AS quantity,
        CASE WHEN year(l_shipdate) >= 1995 THEN arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_quantity)) END AS price FROM part JOIN lineitem ON l_partkey = p_partkey WHERE year(l_shipdate) BETWEEN 1992 AND 1998 GROUP BY p_partkey, p_brand, year(l_shipdate)""",
    "a21_merged_states": f"SELECT strftime(l_shipdate, '%Y-%m') AS month, l_returnflag, count(*) AS n, {s6('avg(l_quantity)')} AS mean, {s6('stddev_samp(l_quantity)')} AS std, min(l_quantity) AS least, max(l_quantity) AS greatest, TRUE AS near FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL",
    "x1_collectors": """WITH p AS (SELECT page_id::VARCHAR AS item, html, list_transform(string_split(html, '<a href="')[2:], lambda x: string_split(x, '"')[1]) AS links, string_split(string_split(html, '<title>')[2], '</title>')[1] AS title,
        contains(string_split(html, '<article>')[-1], '</p>') AS closed FROM pages)
        SELECT 'titles' AS source, item, (title <> '')::BIGINT AS records, CASE WHEN title = '' THEN 'missing: value' ELSE title END AS value FROM p
        UNION ALL SELECT 'links', item, len(links), list_max(links) FROM p WHERE len(links) > 0
        UNION ALL SELECT 'strict', item, (closed AND NOT contains(html, '<br>'))::BIGINT, CASE WHEN NOT closed THEN 'ValueError: an open paragraph' WHEN contains(html, '<br>') THEN 'missing: value' ELSE 'whole' END FROM p""",
    "k6_changes": "SELECT o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P' GROUP BY ALL",
}
