"""Queries of the statistics and models: frequencies, shares, periods, windows, tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.functions import chemistry, dates, distributions
from assayframe.functions.numbers import round_even
from assayframe.operators import joins, models, statistics

from .registry import QUERIES, Tables, query, r6, s6


def samples(t: Tables) -> DataFrame:
    """Test rows with lab, type, producer and date: the base of the statistics."""
    lines = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("lab"), F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("kind"), F.col("l_shipdate").alias("date"))
    return joins.in_tasks(lines, t("orders").select("o_orderkey", F.col("o_custkey").alias("producer")), "o_orderkey").withColumn("year", F.year("date"))


SAMPLES = "SELECT l_suppkey AS lab, CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS kind, l_shipdate AS date, o_custkey AS producer, year(l_shipdate)::INT AS year FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


@query("SELECT l_suppkey, l_shipmonth, count(*) AS n FROM (SELECT l_suppkey, month(l_shipdate)::INT AS l_shipmonth FROM lineitem WHERE l_returnflag <> 'N') GROUP BY ALL")
def a2_value_counts(t):
    rows = t("lineitem").select("l_suppkey", F.when(F.col("l_returnflag") != "N", F.month("l_shipdate")).alias("l_shipmonth"))
    return statistics.value_counts(rows, ["l_suppkey"], "l_shipmonth")


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_orderkey END) AS orders FROM lineitem GROUP BY 1")
def a3_nunique(t):
    return t("lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct(F.when(F.col("l_returnflag") != "N", F.col("l_orderkey"))).alias("orders"))


@query("SELECT l_suppkey, string_agg(DISTINCT l_linenumber::VARCHAR, ',' ORDER BY l_linenumber::VARCHAR) AS numbers FROM lineitem GROUP BY 1")
def a4_distinct_list(t):
    return t("lineitem").groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), ",").alias("numbers"))


@query("SELECT l_suppkey, l_partkey, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rank FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE rank <= 5")
def a5_top_n(t):
    return statistics.top_counts(t("lineitem"), ["l_suppkey"], "l_partkey", 5).withColumn("rank", F.col("rank").cast("long"))


@query(f"""WITH s AS ({SAMPLES}), c AS (SELECT lab, producer, count(*) AS n FROM s WHERE producer IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lab ORDER BY n DESC, producer) AS k FROM c)
SELECT lab, sum(n)::BIGINT AS total, sum(n) FILTER (WHERE k <= 10)::BIGINT AS top, {s6("sum(n) FILTER (WHERE k <= 10) * 100.0::DOUBLE / sum(n)", 2)} AS percent FROM r GROUP BY 1""")
def a6_concentration(t):
    return statistics.concentration(samples(t), ["lab"], "producer", 10)


@query(f"WITH s AS ({SAMPLES}) SELECT * FROM (SELECT lab, kind, n, {s6('n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY lab)', 2)} AS percent FROM (SELECT lab, kind, count(*) AS n FROM s GROUP BY ALL)) WHERE kind IS NOT NULL")
def a7_distribution(t):
    return statistics.distribution(samples(t), ["lab"], "kind")


@query(f"WITH s AS ({SAMPLES}) SELECT lab, count(*) AS n, count(DISTINCT producer) AS entities, {s6('count(*)::DOUBLE / count(DISTINCT producer)')} AS average FROM s GROUP BY 1")
def a8_avg_per_entity(t):
    return statistics.per_entity(samples(t), ["lab"], "producer").withColumn("average", r6(F.col("average")))


@query(f"WITH s AS ({SAMPLES}) SELECT lab, year, month(date)::INT AS month, count(*) AS n FROM (SELECT *, max(year) OVER (PARTITION BY lab) AS y FROM s) WHERE year = y GROUP BY ALL")
def a9_latest_year_months(t):
    return statistics.latest_year_months(samples(t), ["lab"], "date")


@query(f"""WITH s AS (SELECT DISTINCT lab, producer, year FROM ({SAMPLES})), y AS (SELECT DISTINCT lab, year FROM s), f AS (SELECT *, min(year) OVER (PARTITION BY lab) AS m FROM y)
SELECT f.lab, f.year, (SELECT count(*) FROM s a JOIN s b ON a.lab = b.lab AND a.producer = b.producer AND a.year = b.year + 1 WHERE a.lab = f.lab AND a.year = f.year) AS retained FROM f WHERE year > m""")
def a10_retention(t):
    return statistics.retention(samples(t), ["lab"], "producer", "year")


@query(f"""WITH s AS (SELECT DISTINCT lab, producer, year FROM ({SAMPLES})), y AS (SELECT *, lag(year) OVER (PARTITION BY lab ORDER BY year) AS p FROM (SELECT DISTINCT lab, year FROM s))
SELECT s.lab, s.year, count(*) AS total, count(b.producer) AS "returning", count(*) - count(b.producer) AS new FROM s JOIN y ON s.lab = y.lab AND s.year = y.year LEFT JOIN s b ON b.lab = s.lab AND b.producer = s.producer AND b.year = y.p GROUP BY ALL""")
def a11_new_returning(t):
    return statistics.new_and_returning(samples(t), ["lab"], "producer", "year")


@query(f"WITH s AS ({SAMPLES}) SELECT kind, year, count(DISTINCT producer) AS entities FROM s GROUP BY ALL")
def a12_adoption(t):
    return statistics.adoption(samples(t), ["kind"], "producer", "year")


@query(f"""WITH m AS (SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, count(DISTINCT producer) AS producers FROM ({SAMPLES}) GROUP BY 1), p AS (SELECT *, lag(n) OVER (ORDER BY month) AS pn, lag(producers) OVER (ORDER BY month) AS pp FROM m)
SELECT month, n, producers, {s6('(n - pn) * 100.0::DOUBLE / pn', 2)} AS n_change, {s6('(producers - pp) * 100.0::DOUBLE / pp', 2)} AS producers_change FROM p""")
def a14_monthly_change(t):
    from assayframe.operators.joins import previous_listed

    monthly = samples(t).groupBy(dates.month_label(F.col("date")).alias("month")).agg(F.count("*").alias("n"), F.countDistinct("producer").alias("producers"))
    out = previous_listed(monthly.withColumn("_all", F.lit(0)), ["_all"], "month", ["n", "producers"])
    return out.select("month", "n", "producers", *[statistics.change(F.col(c), F.col(f"prev_{c}")).alias(f"{c}_change") for c in ("n", "producers")])


@query(f"""WITH s AS ({SAMPLES}) SELECT lab, kind, n, percent FROM (SELECT lab, kind, n, {s6('n * 100.0::DOUBLE / sum(CASE WHEN kind IS NOT NULL THEN n END) OVER (PARTITION BY lab)', 2)} AS percent FROM (SELECT lab, kind, count(*) AS n FROM s GROUP BY ALL)) WHERE kind IS NOT NULL""")
def a15_market_share(t):
    return statistics.market_share(samples(t), "kind", "lab", known_only=True).select("lab", "kind", "n", "percent")


@query(f"WITH s AS ({SAMPLES}) SELECT year, kind, count(DISTINCT producer) AS entities FROM s GROUP BY ALL")
def a16_nested_distinct(t):
    return statistics.nested_distinct(samples(t), ["year"], "kind", "producer")


@query(f"""WITH s AS (SELECT * FROM ({SAMPLES})), y AS (SELECT DISTINCT year FROM s), g AS (SELECT year, q.q::INT AS quarter FROM y, (VALUES (1), (2), (3), (4)) q(q))
SELECT g.year, g.quarter, count(s.lab) AS n, count(DISTINCT producer) AS n_producer, count(DISTINCT lab) AS n_lab FROM g LEFT JOIN s ON s.year = g.year AND quarter(s.date) = g.quarter GROUP BY ALL""")
def a17_quarters(t):
    return statistics.quarters(samples(t).drop("year"), [], "date", ["producer", "lab"])


@query(f"WITH s AS ({SAMPLES}) SELECT count(*) AS n, count(DISTINCT lab) AS n_lab, count(DISTINCT producer) AS n_producer, count(DISTINCT kind) AS n_kind FROM s")
def a18_totals(t):
    return statistics.totals(samples(t), ["lab", "producer", "kind"])


@query(f"SELECT l_suppkey, year(l_shipdate)::INT AS year, {s6('avg(l_quantity)')} AS quantity, {s6('avg(l_discount)')} AS discount, {s6('max(l_tax)')} AS tax FROM lineitem GROUP BY ALL")
def a19_means(t):
    out = t("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.avg("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.max("l_tax").alias("tax"))
    return out.select("l_suppkey", "year", *[r6(F.col(c)).alias(c) for c in ("quantity", "discount", "tax")])


_STATS = ", ".join(f"{s6(e, 9 if n == 'mean' else 6)} AS {n}" for e, n in (("avg(v)", "mean"), ("stddev_samp(v)", "std"), ("quantile_cont(v, 0.25)", "q25"), ("quantile_cont(v, 0.5)", "q50"), ("quantile_cont(v, 0.75)", "q75"), ("max(v)", "max")))
_LONG = " UNION ALL ".join(f"SELECT l_shipdate AS d, '{c}' AS compound, {c} AS v FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax"))


@query(f"WITH x AS ({_LONG}) " + " UNION ALL ".join(f"SELECT '{statistics.PERIOD_NAMES[k]}' AS period, strftime(date_trunc('{k}', d), '%Y-%m-%d') AS start, CASE WHEN compound = 'l_tax' THEN 'terpene' ELSE 'cannabinoid' END AS type, compound, count(*) AS n, {_STATS} FROM x GROUP BY ALL" for k in dates.PERIODS))
def a21_describe_periods(t):
    out = statistics.describe_periods(t("lineitem"), "l_shipdate", {"cannabinoid": ["l_quantity", "l_discount"], "terpene": ["l_tax"]})
    return out.select("period", F.col("start").cast("string").alias("start"), "type", "compound", "n", *[round_even(F.col(c), 9 if c == "mean" else 6).alias(c) for c in ("mean", "std", "q25", "q50", "q75", "max")])


@query(f"""SELECT l_returnflag, {", ".join(f"{s6(f'quantile_cont(l_quantity, {q / 100})')} AS q{q:02d}" for q in (1, 25, 50, 75, 99))}, {s6('avg(l_quantity)')} AS mean, max(l_quantity) AS max,
  (SELECT l_quantity FROM lineitem b WHERE b.l_returnflag = a.l_returnflag GROUP BY 1 ORDER BY count(*) DESC, l_quantity LIMIT 1) AS mode FROM lineitem a GROUP BY 1""")
def a22_quantiles(t):
    out = statistics.quantiles(t("lineitem"), ["l_returnflag"], "l_quantity")
    return out.select("l_returnflag", *[r6(F.col(c)).alias(c) for c in ("q01", "q25", "q50", "q75", "q99", "mean")], "max", "mode")


@query(f"SELECT strftime(date_trunc('week', l_shipdate), '%Y-%m-%d') AS week, count(*) AS n, {s6('avg((l_quantity >= 45)::INT) * 100')} AS rate FROM lineitem GROUP BY 1")
def a23_rates_week(t):
    week = dates.period_start("week", F.col("l_shipdate")).cast("string").alias("week")
    return statistics.rate(t("lineitem"), [week], statistics.above("l_quantity", 45)).withColumn("rate", r6(F.col("rate")))


@query("SELECT l_orderkey, bool_and(l_returnflag <> 'R') AS all_passed, bool_or(l_returnflag <> 'R') AS any_passed, CASE WHEN bool_and(l_returnflag <> 'R') THEN 'Pass' ELSE 'Fail' END AS status FROM lineitem GROUP BY 1")
def a24_all_any(t):
    return statistics.all_and_any(t("lineitem"), ["l_orderkey"], F.col("l_returnflag") != "R")


@query("""SELECT l_orderkey, string_agg(l_returnflag, ', ' ORDER BY d, k) AS notes FROM (SELECT l_orderkey, l_returnflag, min(row(l_shipdate, l_linenumber, l_returnflag)) AS d, 0 AS k FROM lineitem GROUP BY ALL) GROUP BY 1""")
def a25_notes(t):
    return statistics.joined_notes(t("lineitem"), ["l_orderkey"], "l_returnflag", ["l_shipdate", "l_linenumber", "l_returnflag"])


@query(f"""SELECT bin, n, {s6('n / (sum(n) OVER () * 0.25)')} AS density FROM (SELECT least(floor(value / 0.25), 39)::INT AS bin, count(*) AS n FROM (SELECT l_quantity / 5 AS value FROM lineitem) WHERE value BETWEEN 0 AND 10 GROUP BY 1)""")
def a31_histogram(t):
    return statistics.histogram(t("lineitem").select((F.col("l_quantity") / 5).alias("value")), "value", 40, 0.0, 10.0).withColumn("density", r6(F.col("density")))


@query("SELECT CASE WHEN n < (SELECT count(*) / 24 FROM customer) THEN 'Other' ELSE c_nationkey::VARCHAR END AS nation, sum(n)::BIGINT AS n FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) GROUP BY 1")
def a32_lump_other(t):
    people = t("customer").select(F.col("c_nationkey").cast("string").alias("nation"))
    return statistics.lump_rare(people, "nation", people.count() / 24)


@query(f"""WITH c AS (SELECT year(l_shipdate)::INT AS year, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY year) AS share FROM c),
k AS (SELECT l_suppkey FROM s GROUP BY 1 ORDER BY round(sum(share), 9) DESC, l_suppkey LIMIT 10), g AS (SELECT year, k.l_suppkey FROM (SELECT DISTINCT year FROM s), k),
h AS (SELECT g.year, g.l_suppkey::VARCHAR AS lab, coalesce(share, 0) AS share FROM g LEFT JOIN s USING (year, l_suppkey))
SELECT year, lab, {s6('share')} AS share FROM h UNION ALL SELECT year, 'Others', {s6('1 - sum(share)')} FROM h GROUP BY 1""")
def a33_market_matrix(t):
    # entities are compared as numbers when ranks tie, as in the SQL
    rows = t("lineitem").select(F.year("l_shipdate").alias("year"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0").alias("lab"))
    out = statistics.market_matrix(rows, "year", "lab", 10)
    return out.select("year", F.when(F.col("lab") == "Others", F.col("lab")).otherwise(F.col("lab").try_cast("bigint").cast("string")).alias("lab"), r6(F.col("share")).alias("share"))


@query(f"SELECT period, year, n, {s6('n / (CASE year WHEN 1995 THEN 20.0::DOUBLE WHEN 1996 THEN 21.0::DOUBLE END)')} AS per_capita FROM (SELECT strftime(o_orderdate, '%Y-%m') AS period, year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY ALL)")
def a34_per_capita(t):
    out = statistics.per_capita(t("orders"), dates.month_label(F.col("o_orderdate")), F.year("o_orderdate"), {1995: 2e6, 1996: 2.1e6})
    return out.withColumn("per_capita", r6(F.col("per_capita")))


@query(f"SELECT sum(n)::DOUBLE * 30 AS cost, {s6('sum(n) * 30 + 3 * avg(n) * 30')} AS projected FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)")
def a35_cost(t):
    return statistics.monthly_cost(t("orders"), "o_orderdate", 30.0).withColumn("projected", r6(F.col("projected")))


@query(f"SELECT l_shipdate < TIMESTAMP '1998-01-01' AS before, count(l_quantity) AS n, {s6('avg(l_quantity)')} AS mean FROM lineitem GROUP BY 1")
def a36_before_after(t):
    return statistics.before_after(t("lineitem"), "l_shipdate", "1998-01-01", "l_quantity").withColumn("mean", r6(F.col("mean")))


@query("SELECT event_type, count(*) AS n FROM events WHERE json_extract_string(props, '$.k')::INT > 50 GROUP BY 1")
def a37_filtered_count(t):
    return t("events").where(F.get_json_object("props", "$.k").try_cast("int") > 50).groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"SELECT user_id, event_id, {s6('avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS moving_average FROM events")
def w1_moving_avg(t):
    return statistics.moving_average(t("events"), "value", ["ts", "event_id"], 30, groups=["user_id"]).select("user_id", "event_id", r6(F.col("moving_average")).alias("moving_average"))


@query("SELECT o_orderkey, (dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY date_trunc('month', o_orderdate)) - 1)::INT AS month_number, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) - 1)::INT AS place FROM orders")
def w2_dense_rank(t):
    from pyspark.sql.window import Window

    part = Window.partitionBy("o_orderpriority")
    return t("orders").select("o_orderkey", (F.dense_rank().over(part.orderBy(F.date_trunc("month", "o_orderdate"))) - 1).alias("month_number"), (F.row_number().over(part.orderBy("o_orderdate", "o_orderkey")) - 1).alias("place"))


@query(f"SELECT lab, kind, {s6('n::DOUBLE / sum(n) OVER (PARTITION BY lab)')} AS share FROM (SELECT l_suppkey AS lab, l_returnflag AS kind, count(*) AS n FROM lineitem GROUP BY ALL)")
def w7_share(t):
    from pyspark.sql.window import Window

    counts = t("lineitem").groupBy(F.col("l_suppkey").alias("lab"), F.col("l_returnflag").alias("kind")).agg(F.count("*").alias("n"))
    return counts.select("lab", "kind", r6(F.col("n") / F.sum("n").over(Window.partitionBy("lab"))).alias("share"))


@query("SELECT event_type, day, n FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i, count(*) OVER (PARTITION BY event_type) AS c FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY ALL)) WHERE i > 2 AND i <= c - 1")
def w8_trim(t):
    daily = t("events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    return statistics.trimmed(daily, ["event_type"], "day")


_T = "(SELECT count(*) FILTER (WHERE l_returnflag = 'A') AS n1, count(*) FILTER (WHERE l_returnflag = 'R') AS n2, avg(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS m1, avg(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS m2, var_samp(l_extendedprice) FILTER (WHERE l_returnflag = 'A') AS v1, var_samp(l_extendedprice) FILTER (WHERE l_returnflag = 'R') AS v2 FROM lineitem)"


@query(f"""SELECT 'pooled' AS kind, n1, n2, {s6('(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2))')} AS t, (n1 + n2 - 2)::DOUBLE AS freedom FROM {_T}
UNION ALL SELECT 'welch', n1, n2, {s6('(m1 - m2) / sqrt(v1 / n1 + v2 / n2)')}, {s6('(v1 / n1 + v2 / n2) * (v1 / n1 + v2 / n2) / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1))', 3)} FROM {_T}""")
def m1_ttest(t):
    both = [models.t_test(t("lineitem"), "l_returnflag", "A", "R", "l_extendedprice", equal).select(F.lit(kind).alias("kind"), "n1", "n2", r6(F.col("t")).alias("t"), round_even(F.col("freedom"), 3).alias("freedom")) for kind, equal in (("pooled", True), ("welch", False))]
    return both[0].unionByName(both[1])


@query(f"""WITH d AS (SELECT l_returnflag, substr(floor(l_extendedprice)::BIGINT::VARCHAR, 1, 1)::INT AS digit, count(*) AS n FROM lineitem WHERE l_extendedprice >= 1 GROUP BY ALL),
e AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag) * log10(1 + 1.0::DOUBLE / digit) AS expected FROM d) SELECT l_returnflag, {s6('sum((n - expected) * (n - expected) / expected)', 3)} AS chi_square FROM e GROUP BY 1""")
def m2_benford_chi2(t):
    return models.chi_square(models.benford(t("lineitem"), "l_extendedprice", ["l_returnflag"]), ["l_returnflag"]).withColumn("chi_square", round_even(F.col("chi_square"), 3))


@query(f"""WITH d AS (SELECT l_orderkey, substr(floor(l_extendedprice)::BIGINT::VARCHAR, 1, 1)::INT AS digit, count(*) AS n FROM lineitem WHERE l_extendedprice >= 1 GROUP BY ALL),
e AS (SELECT *, sum(n) OVER (PARTITION BY l_orderkey) * log10(1 + 1.0::DOUBLE / digit) AS expected FROM d), c AS (SELECT l_orderkey, sum((n - expected) * (n - expected) / expected) / 2 AS h FROM e GROUP BY 1)
SELECT l_orderkey, {s6('exp(-h) * (1 + h + h * h / 2 + h * h * h / 6)')} AS p FROM c""")
def m2_p_values(t):
    """The chance of each order's digits by Benford's law, with 8 degrees of freedom."""
    out = models.chi_square(models.benford(t("lineitem"), "l_extendedprice", ["l_orderkey"]), ["l_orderkey"])
    return out.select("l_orderkey", r6(distributions.p_of_chi_square(F.col("chi_square"), F.lit(8.0))).alias("p"))


@query(f"""WITH c AS (SELECT l_returnflag AS g, count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1),
f AS (SELECT (sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / (count(*) - 1) / (sum((n - 1) * v) / (sum(n) - count(*))) AS f, sum(n) - count(*) AS d FROM c)
SELECT {s6('f', 4)} AS f, {s6('pow(1 + 2 * f / d, -d::DOUBLE / 2)')} AS p FROM f""")
def m5_anova_p(t):
    """The chance of the variance between three groups: a closed form, as they leave two degrees of freedom."""
    out = models.anova(t("lineitem"), "l_returnflag", "l_quantity")
    return out.select(round_even(F.col("f"), 4).alias("f"), r6(distributions.p_of_f(F.col("f"), F.col("between_freedom"), F.col("within_freedom"))).alias("p"))


def m5_tukey(spark, sf_dir):
    """Tukey's honest p-values of the pairs of return flags; SQL has no studentized range."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return models.tukey(rows, "l_returnflag", "l_quantity", ["A", "N", "R"]).select("a", "b", r6(F.col("difference")).alias("difference"), r6(F.col("p")).alias("p"))


QUERIES["m5_tukey"] = m5_tukey


@query(f"""WITH m AS (SELECT l_returnflag, date_trunc('month', l_shipdate) AS p, avg(l_quantity) AS a FROM lineitem GROUP BY ALL), x AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY p) - 1 AS k FROM m)
SELECT l_returnflag, {s6('regr_slope(a, k)')} AS slope, {s6('regr_intercept(a, k)')} AS intercept, count(*) AS periods FROM x GROUP BY 1""")
def m3_trend(t):
    out = models.trend(t("lineitem"), ["l_returnflag"], dates.period_start("month", F.col("l_shipdate")), "l_quantity")
    return out.select("l_returnflag", r6(F.col("slope")).alias("slope"), r6(F.col("intercept")).alias("intercept"), "periods")


@query()
def m4_categorical_regression(t):
    rows = t("lineitem").select((F.col("l_extendedprice") / 1000).alias("value"), F.month("l_shipdate").alias("month"), F.col("l_returnflag").alias("lab"))
    fitted = models.categorical_regression(rows, "value ~ month + lab").stages[-1]
    return rows.sparkSession.createDataFrame([(len(fitted.coefficients), round(float(fitted.intercept), 6), round(float(fitted.summary.r2), 6))], "terms int, intercept double, r2 double")


@query(f"""WITH c AS (SELECT l_shipmode AS g, count(*) AS n, avg(v) AS m, var_samp(v) AS s FROM (SELECT l_suppkey AS l_shipmode, l_quantity AS v FROM lineitem) GROUP BY 1)
SELECT {s6('((sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / (count(*) - 1)) / (sum((n - 1) * s) / (sum(n) - count(*)))', 4)} AS f, count(*) - 1 AS between_freedom, (sum(n) - count(*))::BIGINT AS within_freedom FROM c""")
def m5_anova(t):
    return models.anova(t("lineitem"), "l_suppkey", "l_quantity").withColumn("f", round_even(F.col("f"), 4))


@query(f"""WITH c AS (SELECT l_returnflag AS g, count(*) AS n, avg(l_quantity) AS m, var_samp(l_quantity) AS s FROM lineitem GROUP BY 1), e AS (SELECT sum((n - 1) * s) / (sum(n) - count(*)) AS e FROM c)
SELECT a.g AS a, b.g AS b, {s6('b.m - a.m')} AS difference, {s6('abs(b.m - a.m) / sqrt(e / 2 * (1.0::DOUBLE / a.n + 1.0::DOUBLE / b.n))')} AS q FROM c a JOIN c b ON a.g < b.g, e""")
def m5_pairwise(t):
    out = models.pairwise_differences(t("lineitem"), "l_returnflag", "l_quantity", ["A", "N", "R"])
    return out.select("a", "b", r6(F.col("difference")).alias("difference"), r6(F.col("q")).alias("q"))


@query(f"SELECT l_returnflag, {s6('sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity)', 4)} AS slope FROM lineitem GROUP BY 1")
def m6_origin_slope(t):
    return models.origin_slope(t("lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice").withColumn("slope", round_even(F.col("slope"), 4))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {s6('l_quantity + 0.877 * l_extendedprice')} AS dry FROM lineitem")
def f46_dry_total(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", r6(chemistry.total_active(F.col("l_quantity"), F.col("l_extendedprice"))).alias("dry"))
