"""Queries of the column functions: ids, normal forms, text, chemistry, dates, nested values, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.functions import chemistry, dates, hashing, nested, normalize, numbers, text
from assayframe.operators import columns, joins, vectors
from assayframe.sources import readers

from .registry import query, r6, s6
from .tables import FLAGS, WIDE, wide


@query("SELECT o_orderkey, substr(sha256(o_orderkey::VARCHAR || o_orderstatus || o_orderpriority), 1, 16) AS id FROM orders")
def f1_record_id(t):
    return t("orders").select("o_orderkey", hashing.record_id([F.col("o_orderkey"), F.col("o_orderstatus"), F.lit(None), F.col("o_orderpriority")]).alias("id"))


@query("""SELECT o_orderkey, sha256('{"batch": ' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || ', "name": "' || o_orderpriority || '"}') AS hash FROM orders""")
def f2_fields_hash(t):
    fields = {"name": F.col("o_orderpriority"), "batch": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))}
    return t("orders").select("o_orderkey", hashing.fields_hash(fields).alias("hash"))


@query("SELECT page_id, md5(url) AS hash FROM pages")
def f3_md5(t):
    return t("pages").select("page_id", hashing.url_hash(F.col("url")).alias("hash"))


def _snake(x: str) -> str:
    return f"lower(trim(regexp_replace(trim({x}), '[^A-Za-z0-9]+', '_', 'g'), '_'))"


def _pad(key: bytes, byte: int) -> str:
    return bytes(b ^ byte for b in key.ljust(64, b"\0")).hex()


@query(f"SELECT p_partkey, sha256(unhex('{_pad(b'a private key', 0x5C)}') || unhex(sha256(unhex('{_pad(b'a private key', 0x36)}') || encode({_snake('p_name')} || {_snake('p_brand')})))) AS id FROM part")
def f4_sample_id(t):
    return t("part").select("p_partkey", hashing.sample_id("a private key", F.col("p_name"), F.col("p_brand")).alias("id"))


@query("""SELECT p_partkey, sha256('{"batch_number": null, "date_tested": "2024-01-05", "producer": "Caf\\u00e9 \\"x\\" \\ud83d\\ude00", "product_name": "' || p_name || '", "total_thc": ' || p_size || '.5}') AS hash FROM part""")
def f2_sample_hash(t):
    return t("part").select("p_partkey", hashing.sample_hash(F.col("p_name"), F.lit('Café "x" 😀'), F.lit(None), F.col("p_size") + F.lit(0.5), F.lit("2024-01-05")).alias("hash"))


@query("SELECT o_orderkey, concat_ws('-', CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, o_custkey::VARCHAR, o_orderpriority) AS id FROM orders")
def f5_concat_id(t):
    return t("orders").select("o_orderkey", hashing.joined_id([F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.col("o_custkey"), F.col("o_orderpriority")]).alias("id"))


@query("SELECT p_partkey, sha256(lower(trim('  ' || p_name || ' '))) AS hash FROM part")
def f7_label_hash(t):
    return t("part").select("p_partkey", hashing.label_hash(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("hash"))


def cycled(words, key: str):
    """The words of a list in turn, by a whole-number column."""
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.col(key), F.lit(len(words))) + 1).cast("int"))


def _turns(words, key: str) -> str:
    """The same in SQL."""
    return "list_extract([" + ", ".join("NULL" if w is None else "'" + w.replace("'", "''") + "'" for w in words) + f"], ({key} % {len(words)} + 1)::INT)"


# each word as it may stand in a source, and what it is
STATUS_SAID = ["pass", " Passed", "PASSING", "p", "Compliant", "yes", "True", "1", "fail", "FAILED ", "failing", "F", "Non-Compliant", "No", "false", "0", "nt", "Not Tested", "N/T", "not applicable", "N/A", "na", "-", "", "Rejected", "complete", None]
STATUS_IS = ["pass"] * 8 + ["fail"] * 8 + ["nt"] * 8 + ["rejected", "complete", None]


@query(f"SELECT o_orderkey, {_turns(STATUS_IS, 'o_orderkey')} AS status FROM orders")
def f9_status(t):
    return t("orders").select("o_orderkey", normalize.status(cycled(STATUS_SAID, "o_orderkey")).alias("status"))


TYPES_SAID = (
    "flower,bud,Buds,cannabis flower,dried flower,TRIM,shake,preroll, Pre-Roll,joint,blunt,prerolls,pre-rolls,infused preroll,concentrate,extract,WAX,shatter,rosin,live resin,budder,badder,sauce,diamonds,sugar,crumble,"
    "vape,cartridge,cart,vaporizer,pod,disposable,aio,edible,gummy,chocolate,beverage,candy,baked goods,capsule,tablet,tincture,oil,drops,sublingual,RSO ,topical,cream,lotion,balm,salve,transdermal,Seeds,usable marijuana"
).split(",")
TYPES_ARE = ["flower"] * 7 + ["preroll"] * 7 + ["concentrate"] * 12 + ["vape"] * 7 + ["edible"] * 8 + ["tincture"] * 5 + ["topical"] * 6 + ["Seeds", "usable marijuana"]


@query(f"SELECT o_orderkey, {_turns(TYPES_ARE, 'o_orderkey')} AS kind FROM orders")
def f10_product_type(t):
    return t("orders").select("o_orderkey", normalize.product_type(cycled(TYPES_SAID, "o_orderkey")).alias("kind"))


KEYS_SAID = "THC,d9thc,Delta-9-THC,delta9thc,d8thc,delta-8-thc,THCA-A,THC-A,cbda,CBD-A,Cannabidiol,cannabigerol,Myrcene,b-myrcene,limonene, d-Limonene ,caryophyllene,b-caryophyllene,a-pinene,b-pinene,a-humulene,humulene,Total Yeast".split(",")
KEYS_ARE = "delta_9_thc,delta_9_thc,delta_9_thc,delta_9_thc,delta_8_thc,delta_8_thc,thca,thca,cbda,cbda,cbd,cbg,beta_myrcene,beta_myrcene,d_limonene,d_limonene,beta_caryophyllene,beta_caryophyllene,alpha_pinene,beta_pinene,alpha_humulene,alpha_humulene,total_yeast".split(",")
#: Keys with a hyphen in the table aren't found once they have been rewritten.
KEYS_STRICT = "delta_9_thc,delta_9_thc,delta_9_thc,delta_9_thc,delta_8_thc,delta_8_thc,thca_a,thc_a,cbda,cbd_a,cbd,cbg,beta_myrcene,b_myrcene,d_limonene,d_limonene,beta_caryophyllene,b_caryophyllene,a_pinene,b_pinene,a_humulene,alpha_humulene,total_yeast".split(",")


@query(f"SELECT o_orderkey, {_turns(KEYS_ARE, 'o_orderkey')} AS key, {_turns(KEYS_STRICT, 'o_orderkey')} AS strict_key FROM orders")
def f11_analyte_key(t):
    spelled = cycled(KEYS_SAID, "o_orderkey")
    return t("orders").select("o_orderkey", normalize.analyte_key(spelled).alias("key"), normalize.analyte_key(spelled, strict=True).alias("strict_key"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_filter([
  CASE WHEN l_linestatus = 'F' THEN 'Missing required field: state' END,
  CASE WHEN l_quantity - 5 < 0 THEN 'total_thc below minimum: ' || (l_quantity - 5) || ' < 0' END, CASE WHEN l_quantity - 5 > 45 THEN 'total_thc above maximum: ' || (l_quantity - 5) || ' > 45' END,
  CASE WHEN l_quantity > 30 THEN 'cbd above maximum: ' || l_quantity || ' > 30' END,
  CASE WHEN l_quantity / 4 > 5 THEN 'd_limonene above maximum: ' || (l_quantity / 4) || ' > 5' END,
  CASE WHEN l_returnflag = 'A' THEN 'overall_status invalid value: A' END], lambda x: x IS NOT NULL), '; ') AS errors,
  NOT (l_linestatus = 'F' OR l_quantity < 5 OR l_quantity > 50 OR l_quantity > 30 OR l_quantity / 4 > 5 OR l_returnflag = 'A') AS is_valid FROM lineitem""")
def f12_validate(t):
    quantity = F.col("l_quantity")
    made = {"total_thc": quantity - 5, "cbd": quantity, "d_limonene": quantity / 4, "overall_status": F.when(F.col("l_returnflag") == "A", "A").when(F.col("l_returnflag") == "N", "pass"), "state": F.when(F.col("l_linestatus") == "F", "").otherwise("nv")}
    return normalize.validate(t("lineitem").withColumns(made)).select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("errors", "; ").alias("errors"), "is_valid")


@query("SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' WHEN o_orderpriority = '5-LOW' THEN 'slow' ELSE 'Other' END AS kind FROM orders")
def f15_default_other(t):
    kinds = {"rush": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]}
    return t("orders").select("o_orderkey", normalize.member_type(F.col("o_orderpriority"), kinds, "Other").alias("kind"))


@query("""SELECT p_partkey, nullif(regexp_extract(x, '^(.+?) \\((.+?)\\) (.+)$', 1), '') AS test_name, nullif(regexp_extract(x, '^(.+?) \\((.+?)\\) (.+)$', 2), '') AS units,
  nullif(regexp_extract(x, '^(.+?) \\((.+?)\\) (.+)$', 3), '') AS product_type FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name ELSE p_name || ' (mg/g) ' || p_type END AS x FROM part)""")
def f18_test_parts(t):
    named = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" (mg/g) "), "p_type"))
    return t("part").select("p_partkey", *[c.alias(k) for k, c in text.test_parts(named).items()])


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'R&D Testing' ELSE trim(p_type) END AS kind, CASE WHEN p_size % 3 > 0 THEN 'CFU/g' END AS units, trim(p_name) AS name FROM part""")
def f21_bracket_type(t):
    named = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).when(F.col("p_size") % 3 == 1, F.concat("p_name", F.lit(" (CFU/g) "), "p_type")).otherwise(F.concat("p_name", F.lit(" (CFU/g) R&D Testing "), "p_type"))
    return t("part").select("p_partkey", text.bracket_type(named).alias("kind"), text.bracket_units(named).alias("units"), text.before_bracket(named).alias("name"))


@query("SELECT p_partkey, trim(p_name) AS strain FROM part")
def f22_strain(t):
    ends = F.element_at(F.array(*[F.lit(x) for x in (" - 3.5g", " | Buds", " Flower (1g)", " x Kush", ": Bulk", "/Pre-Roll")]), F.pmod(F.col("p_size"), F.lit(6)).cast("int") + 1)
    return t("part").select("p_partkey", text.strain_of_product(F.concat("p_name", ends)).alias("strain"))


STOP = ["the", "of", "and", "a", "in", "to", "is"]
_GRAMS = "list_concat(w, list_concat(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))"
_FREE = f"NOT list_has_any(string_split(gram, ' '), {STOP})"


@query(f"""WITH w AS (SELECT p_partkey, regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}_]+') AS w FROM part), g AS (SELECT p_partkey, unnest({_GRAMS}) AS gram FROM w)
SELECT gram, count(*) AS n FROM g WHERE {_FREE} GROUP BY 1""")
def f23_ngrams(t):
    grams = text.ngrams_to(text.words(F.col("p_name")), 3, STOP)
    return t("part").select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, CASE WHEN s = '' OR contains(lower(p), lower(s)) THEN p WHEN p = '' THEN s ELSE p || ' ' || s END AS label,
  CASE WHEN s = '' THEN p WHEN contains(p, s) THEN p ELSE p || ' (' || s || ')' END AS title
FROM (SELECT p_partkey, trim(p_name) AS p, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN upper(substr(p_name, 1, 3)) ELSE p_brand END AS s FROM part)""")
def f25_label(t):
    strain = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.upper(F.substring("p_name", 1, 3))).otherwise(F.col("p_brand"))
    return t("part").select("p_partkey", text.label_name(F.col("p_name"), strain).alias("label"), text.title(F.trim("p_name"), strain, [F.col("p_brand")]).alias("title"))


@query("SELECT p_partkey, 'https://x.org/coas/' || p_partkey AS link, replace(lower(p_brand), ' ', '-') AS slug, CASE WHEN length(p_name) > 11 THEN substr(p_name, 1, 11) || '...' ELSE p_name END AS short FROM part")
def f27_links(t):
    return t("part").select("p_partkey", text.data_link(F.col("p_partkey").cast("string"), "coas", "https://x.org").alias("link"), text.slug(F.col("p_brand")).alias("slug"), text.shortened(F.col("p_name")).alias("short"))


@query("SELECT s_suppkey, substr(s_name, 13, 3) AS producer, nullif(regexp_extract('id.WAL' || s_suppkey || '.x', '(WAL?[^.]*)\\.', 1), '') AS license FROM supplier")
def f35_tag_parts(t):
    code = F.concat(F.lit("id.WAL"), "s_suppkey", F.lit(".x"))
    return t("supplier").select("s_suppkey", text.tag_producer(F.col("s_name")).alias("producer"), text.license_code(code).alias("license"))


@query("SELECT page_id, split_part(split_part(split_part(url, '#', 1), '?', 1), '/', -1) AS name, nullif(regexp_extract(url, '^https?://([^/]+)', 1), '') AS host FROM pages")
def f38_url(t):
    return t("pages").select("page_id", text.url_name(F.col("url")).alias("name"), text.extract(F.col("url"), "^https?://([^/]+)").alias("host"))


@query(f"""SELECT l_orderkey, CASE WHEN coalesce("A", "N") IS NOT NULL THEN coalesce("A", 0) + coalesce("N", 0) END AS total_cannabinoids, {s6('coalesce("A", 0) + 0.877 * coalesce("N", 0)')} AS total_thc, "R" AS total_terpenes,
  {s6('(coalesce("A", 0) + 0.877 * coalesce("N", 0)) / nullif("R", 0)')} AS thc_cbd_ratio, {s6('"A" / nullif("N", 0)')} AS beta_pinene_d_limonene_ratio, {s6('"N" / nullif("A", 0)')} AS alpha_humulene_beta_caryophyllene_ratio, {s6('"R" / nullif("N", 0)')} AS camphene_d_limonene_ratio,
  {s6('"R" / nullif("A", 0)')} AS beta_myrcene_beta_pinene_ratio, {s6('"A" / nullif("N", 0)')} AS beta_caryophyllene_d_limonene_ratio FROM ({WIDE})""")
def f39_totals(t):
    a, n, r = F.col("A"), F.col("N"), F.col("R")
    named = wide(t).withColumns({"delta_9_thc": a, "thca": n, "beta_myrcene": r, "total_cbd": r, "beta_pinene": a, "d_limonene": n, "alpha_humulene": n, "beta_caryophyllene": a, "camphene": r})
    out = chemistry.analyte_stats(named, ["delta_9_thc", "thca"], ["beta_myrcene", "not_there"])
    return out.select("l_orderkey", "total_cannabinoids", r6(F.col("total_thc")).alias("total_thc"), "total_terpenes", *[r6(F.col(c)).alias(c) for c in chemistry.RATIOS])


@query(f"""SELECT l_orderkey, coalesce("A", 0) + coalesce("N", 0) AS total_cannabinoids, {s6('"A" + 0.877 * "N"')} AS total_thc, {s6('("A" + 0.877 * "N") / nullif("R" + 0.877 * "N", 0)')} AS thc_to_cbd_ratio,
  coalesce("R", 0) AS total_terpenes, {s6('"A" / nullif("R", 0)')} AS beta_pinene_to_d_limonene_ratio FROM ({WIDE})""")
def f40_replaced_totals(t):
    named = wide(t).withColumns({"delta_9_thc": F.col("A"), "thca": F.col("N"), "cbd": F.col("R"), "cbda": F.col("N"), "beta_pinene": F.col("A"), "d_limonene": F.col("R"), "total_thc": F.lit(-1.0)})
    out = chemistry.results_stats(named, ["delta_9_thc", "thca"], ["d_limonene"])
    return out.select("l_orderkey", "total_cannabinoids", r6(F.col("total_thc")).alias("total_thc"), r6(F.col("thc_to_cbd_ratio")).alias("thc_to_cbd_ratio"), "total_terpenes", r6(F.col("beta_pinene_to_d_limonene_ratio")).alias("beta_pinene_to_d_limonene_ratio"))


@query(f"""SELECT l_orderkey, {s6('"A" + 0.877 * "N"', 2)} AS total_thc, {s6('"R" + 0.877 * "N"', 2)} AS total_cbd, {s6('("A" + 0.877 * "N") / ("R" + 0.877 * "N")', 2)} AS thc_to_cbd_ratio FROM ({WIDE})""")
def f41_rounded_totals(t):
    named = wide(t).withColumnsRenamed({"A": "delta_9_thc", "R": "cbd"}).withColumns({"thca": F.col("N"), "cbda": F.col("N")})
    return chemistry.rounded_totals(named, None, None).select("l_orderkey", "total_thc", "total_cbd", "thc_to_cbd_ratio")


@query(f"""SELECT l_orderkey, CASE WHEN r > 0 THEN CASE WHEN log10(r) < -0.5 THEN 'CBD Dominant' WHEN log10(r) > 0.5 THEN 'THC Dominant' ELSE 'Balanced THC:CBD' END END AS kind FROM (SELECT l_orderkey, "A" / nullif("N" - 25, 0) AS r FROM ({WIDE}))""")
def f43_ratio_class(t):
    return wide(t).select("l_orderkey", chemistry.ratio_class(numbers.safe_ratio(F.col("A"), F.col("N") - 25)).alias("kind"))


SHANNON = " - ".join(f'coalesce(CASE WHEN "{f}" > 0 THEN "{f}" / s * log2("{f}" / s) END, 0)' for f in FLAGS)


@query(f"""SELECT l_orderkey, {s6("0 - " + SHANNON)} + 0.0 AS diversity FROM (SELECT *, coalesce("A", 0) + coalesce("N", 0) + coalesce("R", 0) AS s FROM ({WIDE}))""")
def f44_shannon(t):
    return wide(t).select("l_orderkey", (r6(chemistry.shannon([F.col(f) for f in FLAGS])) + 0.0).alias("diversity"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, {s6('l_quantity * (1 - l_discount * 100 / 100)')} AS wet, CASE WHEN l_quantity % 10 = 0 THEN 'plating' ELSE 'qPCR' END AS method, substr(floor(l_extendedprice)::BIGINT::VARCHAR, 1, 1)::INT AS digit FROM lineitem")
def f45_f48_f49_measures(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", r6(chemistry.wet_basis(F.col("l_quantity"), F.col("l_discount") * 100)).alias("wet"), numbers.counting_method(F.col("l_quantity")).alias("method"), numbers.first_digit(F.col("l_extendedprice")).alias("digit"))


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 0 WHEN event_type = 'view' THEN NULL ELSE value END AS value FROM events")
def f50_decoded(t):
    said = F.when(F.col("event_type") == "click", "<LOQ").when(F.col("event_type") == "view", "n.a.").otherwise(F.concat(F.col("value").cast("string"), F.lit(" mg/g +/- 1")))
    return t("events").select("event_id", chemistry.decoded_value(said).alias("value"))


@query(f"SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_size / 2.0 WHEN 1 THEN {s6('p_size * 28.35')} ELSE {s6('1.0 / 8 * 28.35')} END::DOUBLE AS grams, p_retailprice AS price FROM part")
def f51_weight_price(t):
    said = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("Jar ("), (F.col("p_size") / 2).cast("string"), F.lit("g)"))).when(F.col("p_size") % 3 == 1, F.concat("p_size", F.lit(" oz"))).otherwise("1/8 oz bag")
    return t("part").select("p_partkey", r6(text.weight_grams(said)).alias("grams"), text.money(F.concat(F.lit("$"), F.col("p_retailprice").cast("decimal(12,2)").cast("string"))).alias("price"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def f55_parse_dates(t):
    said = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy")).when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("no date")
    return t("orders").select("o_orderkey", F.date_format(dates.parsed(said), "yyyy-MM-dd").alias("day"))


@query("""SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') || '/' || strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS week, strftime(o_orderdate, '%Y-%m') AS month,
  strftime(o_orderdate, '%Y') AS year, strftime((date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH) - INTERVAL 1 DAY, '%Y-%m-%d') AS quarter_end FROM orders""")
def f58_week_label(t):
    out = dates.date_parts(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate")
    return out.select("o_orderkey", "week", "month", "year", dates.period_end("quarter", dates.period_start("quarter", F.col("o_orderdate"))).cast("string").alias("quarter_end"))


@query("""SELECT strftime(m, '%Y-%m-%d') AS month, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 MONTH)) AS m FROM (SELECT date_trunc('month', o_orderdate) AS d FROM orders WHERE month(o_orderdate) % 4 > 0))
LEFT JOIN (SELECT date_trunc('month', o_orderdate) AS d, count(*) AS n FROM orders WHERE month(o_orderdate) % 4 > 0 GROUP BY 1) ON m = d""")
def f63_gap_fill(t):
    monthly = t("orders").where("month(o_orderdate) % 4 > 0").groupBy(dates.period_start("month", F.col("o_orderdate")).alias("month")).agg(F.count("*").alias("n"))
    return dates.fill_months(monthly, "month", "n").select(F.col("month").cast("string").alias("month"), "n")


@query("SELECT o_orderkey, year(o_orderdate) || '-' || lpad(month(o_orderdate)::VARCHAR, 2, '0') AS month, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso FROM orders")
def f64_year_month(t):
    return t("orders").select("o_orderkey", dates.year_month(F.year("o_orderdate"), F.month("o_orderdate")).alias("month"), dates.iso_text(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("iso"))


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def f67_json_field(t):
    return t("events").select("event_id", nested.json_field(F.col("props"), "k", "bigint").alias("k"))


@query("""SELECT o_orderkey, 'null:HPLC,potency:' || o_orderpriority || CASE WHEN o_orderstatus <> 'P' THEN ',moisture:' || o_orderstatus ELSE '' END AS methods FROM orders""")
def f68_methods(t):
    rows = t("orders").select("o_orderkey", F.lit("['HPLC']").alias("methods"), F.col("o_orderpriority").alias("potency_method"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise("").alias("moisture_method"))
    said = F.transform("methods", lambda m: F.concat(F.coalesce(m["analysis"], F.lit("null")), F.lit(":"), m["method"]))
    return nested.methods(rows).select("o_orderkey", F.array_join(said, ",").alias("methods"))


@query("""SELECT o_orderkey, 'microbes:' || lower(o_orderpriority) || CASE WHEN o_orderstatus <> 'P' THEN ',residual:' || lower(o_orderstatus) ELSE '' END AS statuses FROM orders""")
def f69_statuses(t):
    rows = t("orders").select("o_orderkey", F.col("o_orderpriority").alias("microbes_status"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("residual_status"))
    said = F.transform("statuses", lambda m: F.concat(m["analysis"], F.lit(":"), m["status"]))
    return nested.statuses(rows).select("o_orderkey", F.array_join(said, ",").alias("statuses"))


@query("""SELECT o_orderkey, nullif(array_to_string(list_sort(list_distinct(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'a''1' END, CASE WHEN o_orderkey % 3 = 0 THEN 'b' END, CASE WHEN o_orderkey % 3 = 1 THEN 'lone' END,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority END], lambda x: x IS NOT NULL))), ','), '') AS ids, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority END AS batch_number FROM orders""")
def f70_ids(t):
    open_, turn = F.col("o_orderstatus") != "P", F.pmod(F.col("o_orderkey"), F.lit(3))
    rows = t("orders").select(
        "o_orderkey", F.when(turn == 0, "[\"a'1\", 'b']").when(turn == 1, "lone").alias("metrc_ids"), F.when(open_, F.col("o_orderstatus")).alias("metrc_lab_id"), F.when(open_, F.col("o_orderstatus")).otherwise("").alias("source_id"),
        F.when(F.startswith("o_orderpriority", F.lit("1")), F.col("o_orderpriority")).alias("batch_number"),
    )
    return nested.traceability_ids(rows).select("o_orderkey", F.array_join("traceability_ids", ",").alias("ids"), "batch_number")


@query("SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN url || '?second' END AS second FROM pages")
def f71_urls(t):
    listed = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("[{'url': '"), "url", F.lit("', 'filename': None}, {'url': '"), "url", F.lit("?second'}]"))).otherwise(F.concat(F.lit("['"), "url", F.lit("']")))
    return t("pages").select("page_id", nested.nth_url(listed).alias("url"), nested.nth_url(listed, 1).alias("second"))


@query("""SELECT s_suppkey, 'coas:COA:#3498db:/coas' || CASE WHEN s_suppkey % 2 = 0 THEN ';' || replace(lower(s_name), ' ', '-') || ':' || s_name || ':#' || substr(md5(lower(trim(s_name))), 1, 6) || ':/licenses/' || replace(lower(s_name), ' ', '-') ELSE '' END
  || ';nv:nv:#123456:/coas?state=nv' AS tags FROM supplier""")
def f74_tags(t):
    made = nested.tags({"lab": F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")), "producer": F.lit(""), "state": F.lit("nv")}, colors={"state": F.lit("#123456")})
    said = F.transform("tags", lambda x: F.concat_ws(":", x["tag_id"], x["tag_name"], x["tag_color"], x["tag_link"]))
    return t("supplier").select("s_suppkey", made.alias("tags")).select("s_suppkey", F.array_join(said, ";").alias("tags"))


@query(f"SELECT vec_id, len(embedding) AS dimensions, {s6('sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)))', 4)} AS norm FROM embeddings")
def f77_vector_norm(t):
    return t("embeddings").select("vec_id", F.size("embedding").cast("long").alias("dimensions"), numbers.round_even(nested.norm(F.col("embedding")), 4).alias("norm"))


@query("""WITH q AS (SELECT vec_id AS q, embedding::DOUBLE[] AS a FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT q, vec_id, round_even(list_cosine_similarity(a, embedding::DOUBLE[]) * 1e6, 0) / 1e6 AS similarity FROM q, embeddings WHERE q <> vec_id)
SELECT q, vec_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY similarity DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def f78_cosine_topk(t):
    """Queries are the vectors whose id is a multiple of 20, against all vectors."""
    every = t("embeddings").select("vec_id", "embedding")
    return vectors.nearest(every, every.where("vec_id % 20 = 0"), "vec_id", "embedding", 5).select("q", "vec_id", F.col("rank").cast("long").alias("rank"))


@query("SELECT count(*) FILTER (WHERE vec_id % 20 = 0) AS queries, TRUE AS enough FROM embeddings")
def f78_nearest_by_cells(t):
    """The index of coarse cells over all vectors, its recall held against the exact search."""
    every = t("embeddings")
    asked = every.where("vec_id % 20 = 0")
    exact = vectors.nearest(every, asked, "vec_id", "embedding", 5)
    found = vectors.nearest_by_cells(every, asked, "vec_id", "embedding", 5, cells=16, probes=12)
    share = vectors.recall(found, exact, "vec_id").select((F.col("recall") >= 0.9).alias("enough"))
    return asked.agg(F.count("*").alias("queries")).join(F.broadcast(share))  # one row each


@query("SELECT page_id, len(regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1)) AS links, nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title FROM pages")
def t_html_links(t):
    found = readers.page_fields(F.col("html"))
    return t("pages").select("page_id", F.size(found["links"]).cast("long").alias("links"), found["title"].alias("title"))


@query("SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE role = 'user') AS asked, arg_min(role, turn) AS first_role, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1")
def t_post_rollup(t):
    return t("conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("role") == "user").alias("asked"), F.min_by("role", "turn").alias("first_role"), F.sum(F.length("text")).alias("chars"))


@query(f"""WITH w AS (SELECT lang, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents), g AS (SELECT DISTINCT lang, gram FROM (SELECT lang, unnest({_GRAMS}) AS gram FROM w) WHERE {_FREE})
SELECT gram, string_agg(lang, ',' ORDER BY lang) AS groups FROM g GROUP BY 1 HAVING count(*) > 1 AND bool_or(lang = 'en')""")
def j15_shared_ngrams(t):
    return joins.shared_ngrams_to(t("documents"), "lang", text.words(F.col("text")), 3, "en", STOP).select("gram", F.array_join("groups", ",").alias("groups"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus <> '' THEN o_orderstatus END AS status, o_totalprice FROM orders")
def k9_published(t):
    return columns.published(t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice", "o_orderpriority"), ["o_orderpriority"])
