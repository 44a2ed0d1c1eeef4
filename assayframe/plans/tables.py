"""Queries of the table operators: reshaping, projections, de-duplication, joins, sets, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.functions import dates, nested, normalize, numbers
from assayframe.operators import columns, dedupe, joins, reshape, statistics

from .registry import Tables, query, r6, s6

FLAGS = ["A", "N", "R"]
ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
SORT = "row(l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity)"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def wide(t: Tables) -> DataFrame:
    return reshape.pivot_first(t("lineitem"), ["l_orderkey"], "l_returnflag", "l_quantity", ORDER, FLAGS)


WIDE = "SELECT l_orderkey, " + ", ".join(f"arg_min(l_quantity, {SORT}) FILTER (WHERE l_returnflag = '{f}') AS \"{f}\"" for f in FLAGS) + " FROM lineitem GROUP BY 1"


@query(WIDE)
def r1_pivot_first(t):
    return wide(t)


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, " + ", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES) + " FROM orders GROUP BY 1")
def r9_count_matrix(t):
    return reshape.count_matrix(t("orders"), dates.month_label(F.col("o_orderdate")).alias("month"), "o_orderpriority", PRIORITIES)


@query("SELECT year(l_shipdate)::INT AS year, " + ", ".join(s6(f"avg(l_extendedprice) FILTER (WHERE l_returnflag = '{f}')") + f' AS "{f}"' for f in FLAGS) + " FROM lineitem GROUP BY 1")
def r10_mean_matrix(t):
    out = reshape.mean_matrix(t("lineitem"), F.year("l_shipdate").alias("year"), "l_returnflag", FLAGS, F.col("l_extendedprice"))
    return out.select("year", *[r6(F.col(f)).alias(f) for f in FLAGS])


@query("""SELECT l_orderkey, l_linenumber, u.key AS key, u.value::DOUBLE AS value, (u.key = 'price')::INT AS has_price
FROM (SELECT l_orderkey, l_linenumber, unnest([{'key': 'quantity', 'value': l_quantity}, {'key': 'price', 'value': l_extendedprice}, {'key': 'tax', 'value': l_tax}]) AS u FROM lineitem)""")
def r11_explode_long(t):
    line = t("lineitem")
    measured = F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).alias("value")) for k, c in (("quantity", "l_quantity"), ("price", "l_extendedprice"), ("tax", "l_tax"))])
    nested_rows = line.select("l_orderkey", "l_linenumber", measured.alias("results"))
    out = reshape.explode_results(nested_rows, "results")
    return out.select("l_orderkey", "l_linenumber", "key", "value", (F.col("key") == "price").cast("int").alias("has_price"))


@query(" UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS key, {s6(f'sum({c})', 2)} AS value FROM lineitem GROUP BY 1" for c in ("l_quantity", "l_discount", "l_tax")))
def r12_unpivot(t):
    sums = t("lineitem").groupBy("l_returnflag").agg(*[numbers.round_even(F.sum(c), 2).alias(c) for c in ("l_quantity", "l_discount", "l_tax")])
    return reshape.unpivot(sums, ["l_returnflag"], ["l_quantity", "l_discount", "l_tax"])


@query(f'SELECT l_orderkey, coalesce("A", "N", "R") AS value FROM ({WIDE})')
def p6_coalesce(t):
    return columns.coalesced(wide(t), "value", FLAGS)


@query(f'SELECT l_orderkey, coalesce("A", "R") AS "A", "N" FROM ({WIDE})')
def p8_combine_similar(t):
    return columns.combine_similar(wide(t), {"A": ["R"]})


@query(f'SELECT l_orderkey, coalesce("A", "N") AS "Total THC", "R" AS "Moisture" FROM ({WIDE})')
def p7_combine_redundant(t):
    named = wide(t).withColumnsRenamed({"A": "Total THC (%) Buds", "N": "Total THC (mg/g) Raw Buds", "R": "Moisture"})
    return columns.combine_redundant(named, ["Buds", "Raw Buds"], ["l_orderkey"])


@query(f'SELECT l_orderkey, coalesce("A", 0) AS "A", coalesce("N", 0) AS "N", coalesce("R", 0) AS "R" FROM ({WIDE})')
def p9_fill(t):
    return wide(t).fillna(0.0, FLAGS)


@query("SELECT doc_id, try_cast(substr(source, 4) AS DOUBLE) AS number, try_cast(source AS DOUBLE) AS source FROM documents")
def p10_try_cast(t):
    docs = t("documents").select("doc_id", F.substring("source", 4, 9).alias("number"), "source")
    return columns.numeric(docs, ["doc_id"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000 AND (o_orderstatus IN ('F', 'P') OR NOT o_orderpriority IN ('1-URGENT', '5-LOW'))")
def p11_filter(t):
    keep = F.col("o_totalprice").between(100000, 200000) & (F.col("o_orderstatus").isin("F", "P") | ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return t("orders").where(keep).select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)(RED|blue)') AND NOT starts_with(p_name, 'x')")
def p14_contains(t):
    return t("part").where(F.col("p_name").rlike("(?i)(RED|blue)") & ~F.startswith("p_name", F.lit("x"))).select("p_partkey", "p_name")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def p16_update_where(t):
    out = columns.update_where(t("orders"), F.col("o_orderstatus") == "F", {"o_totalprice": F.lit(0.0), "o_orderpriority": F.lit("closed")})
    return out.select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def p17_update_by_key(t):
    customer = t("customer").select("c_custkey", "c_mktsegment")
    changes = customer.where("c_custkey % 10 = 0").select("c_custkey", F.lit("moved").alias("c_mktsegment"))
    return columns.update_by_key(customer, changes, "c_custkey", ["c_mktsegment"])


@query(f"""SELECT l_orderkey, coalesce("A", 0) + coalesce("N", 0) + coalesce("R", 0) AS zero_sum,
  CASE WHEN coalesce("A", "R") IS NOT NULL THEN coalesce("A", 0) + coalesce("R", 0) END AS null_sum FROM ({WIDE})""")
def p19_row_sum_modes(t):
    return wide(t).select("l_orderkey", numbers.row_sum([F.col(f) for f in FLAGS]).alias("zero_sum"), numbers.row_sum([F.col("A"), F.col("R")], 1).alias("null_sum"))


@query(f"""SELECT l_orderkey, CASE WHEN g = "A" THEN 'A' WHEN g = "N" THEN 'N' WHEN g = "R" THEN 'R' END AS dominant
FROM (SELECT *, greatest("A", "N", "R") AS g FROM ({WIDE}))""")
def p20_argmax(t):
    return wide(t).select("l_orderkey", numbers.row_argmax({f: F.col(f) for f in FLAGS}).alias("dominant"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' END AS level FROM orders")
def p21_map_lookup(t):
    return t("orders").select("o_orderkey", normalize.mapped(F.col("o_orderpriority"), {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"}).alias("level"))


@query("SELECT o_orderkey, CASE lower(o_orderpriority) WHEN '1-urgent' THEN 'now' ELSE o_orderpriority END AS priority FROM orders")
def p22_replace(t):
    return t("orders").select("o_orderkey", normalize.mapped(F.lower("o_orderpriority"), {"1-urgent": "now"}, F.col("o_orderpriority")).alias("priority"))


@query("SELECT DISTINCT p_type FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_partkey % 500 = 0)")
def p23_unknown_keys(t):
    part = t("part")
    return normalize.unknown_values(part, "p_type", part.where("p_partkey % 500 = 0").select("p_type").distinct(), "p_type")


@query("SELECT event_id, ts::VARCHAR AS ts, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def d1_keep_first(t):
    return dedupe.keep_first(t("events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("event_id", F.col("ts").cast("string").alias("ts"), "user_id")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events) WHERE n = 1")
def d2_composite_key(t):
    return dedupe.keep_first(t("events"), ["user_id", "event_type"], [F.col("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n = 1")
def d3_latest_per_key(t):
    docs = t("documents").select("doc_id", "n_chars", F.sha2("text", 256).alias("hash"))
    return dedupe.keep_latest(docs, ["hash"], "n_chars", ["doc_id"]).select("doc_id")


@query("""WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id, value ORDER BY event_id) AS n FROM events),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS m FROM a WHERE n = 1) SELECT event_id FROM b WHERE m = 1""")
def d4_two_keys(t):
    return dedupe.successive(t("events"), ["user_id", "value"], ["user_id", "event_type"], [F.col("event_id")]).select("event_id")


@query("SELECT user_id, arg_max(value, row(ts, event_id)) AS value FROM events GROUP BY 1")
def d7_log_latest(t):
    return dedupe.latest_values(t("events"), "user_id", "value", ["ts", "event_id"])


@query("""WITH g AS (SELECT CASE WHEN doc_id % 7 > 0 THEN source || lang END AS k, sha256(text) AS h FROM documents), c AS (SELECT k, count(*) AS n, count(DISTINCT h) AS d FROM g GROUP BY 1)
SELECT sum(n)::BIGINT AS total, count(k) AS distinct_keys, coalesce(sum(n) FILTER (WHERE k IS NULL), 0)::BIGINT AS missing, coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS in_duplicates,
  coalesce(sum((n > 1 AND d > 1)::INT), 0)::BIGINT AS groups_with_several_hashes FROM c""")
def a30_duplicate_report(t):
    docs = t("documents").select(F.when(F.col("doc_id") % 7 > 0, F.concat("source", "lang")).alias("k"), F.sha2("text", 256).alias("h"))
    return dedupe.duplicate_report(docs, "k", "h")


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey")
def j1_left(t):
    orders = t("orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(orders, "l_orderkey", "left")


@query("SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def j3_validated(t):
    customer = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return joins.many_to_one(t("orders"), customer, ["o_custkey"]).select("o_orderkey", "c_mktsegment")


@query(f"""SELECT r_name, n_name, c_mktsegment, count(*) AS n, {s6("sum(l_extendedprice)", 2)} AS price FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def j4_four_dims(t):
    # the large tables meet after aggregation by order; dimensions are looked up for what is left
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("price"))
    by_customer = lines.join(t("orders").select("o_orderkey", "o_custkey"), "o_orderkey").groupBy("o_custkey").agg(F.sum("n").alias("n"), F.sum("price").alias("price"))
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    people = t("customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    out = by_customer.join(people, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_name", "n_name", "c_mktsegment").agg(F.sum("n").alias("n"), F.sum("price").alias("price"))
    return out.withColumn("price", numbers.round_even(F.col("price"), 2))


@query("SELECT o_orderkey, c_custkey, c_name FROM orders JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey")
def j5_matched_only(t):
    return t("orders").join(t("customer").where("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey", "c_name")


@query("SELECT c_custkey, first_status FROM customer LEFT JOIN (SELECT o_custkey, arg_min(o_orderstatus, row(o_orderdate, o_orderkey)) AS first_status FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def j8_lookup_first(t):
    table = t("orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("first_status"), "o_orderdate", "o_orderkey")
    return joins.lookup(t("customer").select("c_custkey"), table, "c_custkey", ["first_status"], [F.col("o_orderdate"), F.col("o_orderkey")])


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j9_anti(t):
    return joins.not_in(t("customer"), t("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 10)")
def j10_semi_topn(t):
    return joins.in_top(t("lineitem"), "l_suppkey", 10).select("l_orderkey", "l_linenumber", "l_partkey")


TERMS = ["red", "blue", "green", "large", "brass", "steel", "tin", "an"]


@query("WITH terms(term, pos) AS (VALUES " + ", ".join(f"('{x}', {i})" for i, x in enumerate(TERMS)) + ") SELECT p_partkey, (SELECT arg_min(term, pos) FROM terms WHERE contains(p_name, term)) AS term FROM part")
def j11_contains_first(t):
    part = t("part").select("p_partkey", "p_name")
    terms = part.sparkSession.createDataFrame(list(enumerate(TERMS)), "pos int, term string")
    return joins.first_contained(part, "p_name", terms, "term", ["pos"]).select("p_partkey", "term")


@query("WITH terms(term, pos) AS (VALUES " + ", ".join(f"('{x}', {i})" for i, x in enumerate(TERMS)) + ") SELECT p_partkey, (SELECT arg_min(term, row(-len(term), pos)) FROM terms WHERE contains(p_name, term)) AS term FROM part")
def j12_longest_match(t):
    return t("part").select("p_partkey", joins.longest_contained(F.col("p_name"), TERMS).alias("term"))


def yearly(t: Tables) -> DataFrame:
    return t("orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))


YEARLY = "SELECT o_orderstatus, year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY ALL"


@query(f"WITH y AS ({YEARLY}) SELECT a.*, b.n AS prev_n, {s6('(a.n - b.n) * 100.0 / b.n', 2)} AS growth FROM y a LEFT JOIN y b ON a.o_orderstatus = b.o_orderstatus AND a.year = b.year + 1")
def j14_prev_year(t):
    out = joins.previous_year(yearly(t), ["o_orderstatus"], "year", ["n"])
    return out.withColumn("growth", statistics.change(F.col("n"), F.col("prev_n"))).select("o_orderstatus", "year", "n", "prev_n", "growth")


@query(f"WITH y AS ({YEARLY}) SELECT *, lag(n) OVER (PARTITION BY o_orderstatus ORDER BY year) AS prev_n FROM y")
def j14_prev_listed(t):
    return joins.previous_listed(yearly(t), ["o_orderstatus"], "year", ["n"])


@query("SELECT kind, name, acctbal, segment FROM (SELECT 'customer' AS kind, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer UNION ALL BY NAME SELECT 'supplier' AS kind, s_name AS name, s_acctbal AS acctbal FROM supplier)")
def u1_union_by_name(t):
    a = t("customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    b = t("supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u2_union_distinct(t):
    return t("customer").select(F.col("c_nationkey").alias("k")).union(t("supplier").select("s_nationkey")).distinct()


@query("SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u3_except(t):
    return t("customer").select(F.col("c_custkey").alias("k")).subtract(t("orders").where("o_orderstatus = 'P'").select("o_custkey"))


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT s_suppkey FROM supplier")
def u4_intersect(t):
    return t("customer").select(F.col("c_custkey").alias("k")).intersect(t("supplier").select("s_suppkey"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o3_top_rows(t):
    return t("orders").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderpriority, n, pos FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) JOIN (VALUES ('5-LOW', 0), ('1-URGENT', 1)) v(p, pos) ON o_orderpriority = p ORDER BY pos")
def o4_given_order(t):
    orders = t("orders")
    given = orders.sparkSession.createDataFrame([("5-LOW", 0), ("1-URGENT", 1)], "o_orderpriority string, pos int")
    return orders.groupBy("o_orderpriority").agg(F.count("*").alias("n")).join(F.broadcast(given), "o_orderpriority").orderBy("pos")


@query("SELECT o_orderkey, o_custkey, count(l_orderkey) AS results, min(l_quantity) AS least, sum((l_returnflag = 'R')::INT)::BIGINT AS returned FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def a27_nest(t):
    lines = t("lineitem").join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    docs = reshape.nest(lines, ["l_orderkey"], ["o_custkey"], ["l_quantity", "l_returnflag", "l_linenumber"], ORDER)
    return docs.select(F.col("l_orderkey").alias("o_orderkey"), "o_custkey", F.size("results").cast("long").alias("results"), F.col("results")[0]["l_quantity"].alias("least"), F.size(F.filter("results", lambda r: r["l_returnflag"] == "R")).cast("long").alias("returned"))


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END + CASE WHEN length(c_name) > 0 THEN 1 ELSE 0 END AS listed FROM customer")
def p25_flatten(t):
    people = t("customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.length("c_name").alias("name_length"))
    return nested.flattened(people, {"balance": "balance", "length": "name_length"}).select("c_custkey", F.size("results").alias("listed"))
