"""One query per operator, over the tables of a data folder, each with the same query in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import email as em
from .functions import fields as fn
from .functions.text import clean, name_key, suspicion
from .operators import checks
from .operators.duplicates import find_duplicates
from .operators.emails import counters, derive, domains_to_ask, judge
from .plans.search import escape_like
from .sources.named_sql import split_queries
from .sources.network import best_mx
from .sources.registry import upsert
from .tables import ORACLES, QUERIES, Tables, both, query

# Analytic queries

@query("q1_top_brands", "SELECT p_brand, count(*) AS parts FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY parts DESC, p_brand LIMIT 5")
def top_brands(t: Tables) -> DataFrame:
    return t.part.filter("p_brand is not null").groupBy("p_brand").agg(F.count("*").alias("parts")).orderBy(F.desc("parts"), "p_brand").limit(5)


@query("q2_balance_by_nation", """SELECT c_nationkey, count(*) AS customers, CAST(round(avg(CAST(c_acctbal AS DECIMAL(12,2))), 2) AS DOUBLE) AS avg_balance,
       min(c_acctbal) AS min_balance, max(c_acctbal) AS max_balance FROM customer WHERE c_acctbal >= 0 AND c_nationkey IS NOT NULL GROUP BY c_nationkey""")
def balance_by_nation(t: Tables) -> DataFrame:
    c = t.customer.filter("c_acctbal >= 0 and c_nationkey is not null")
    return c.groupBy("c_nationkey").agg(F.count("*").alias("customers"), F.round(F.avg(F.col("c_acctbal").cast("decimal(12,2)")), 2).cast("double").alias("avg_balance"), F.min("c_acctbal").alias("min_balance"), F.max("c_acctbal").alias("max_balance"))


@query("q3_large_share_by_type", """SELECT p_type, count(*) AS parts, count(*) FILTER (WHERE p_size > 25) AS large,
       CAST(round(100.0 * count(*) FILTER (WHERE p_size > 25) / count(*), 1) AS DOUBLE) AS large_percent FROM part GROUP BY p_type""")
def large_share(t: Tables) -> DataFrame:
    large = F.count_if(F.col("p_size") > 25)
    return t.part.groupBy("p_type").agg(F.count("*").alias("parts"), large.alias("large"), F.round(100.0 * large / F.count("*"), 1).alias("large_percent"))


# Scans

@query("s2_posexplode", "SELECT doc_id, CAST(k - 1 AS INTEGER) AS place, w AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS w, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents) x")
def exploded(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "line"))


@query("s4_header_zip", "SELECT r_regionkey, r_name AS name, CAST(r_regionkey AS VARCHAR) AS key FROM region")
def header_zip(t: Tables) -> DataFrame:
    m = t.region.select("r_regionkey", F.map_from_arrays(F.array(F.lit("name"), F.lit("key")), F.array("r_name", F.col("r_regionkey").cast("string"))).alias("m"))
    return m.select("r_regionkey", F.col("m")["name"].alias("name"), F.col("m")["key"].alias("key"))


@query("s5_blank_rows", "SELECT conv_id, turn, (trim(role) = '' AND trim(text) = '') AS blank FROM conversations")
def blank_rows(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", F.forall(F.array("role", "text"), lambda v: F.trim(v) == "").alias("blank"))


@query("s6_table_scan", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def table_scan(t: Tables) -> DataFrame:
    return t.sql("SELECT n_nationkey, n_name FROM {nation} WHERE n_regionkey = :region", "nation", region=2)


SCRIPT = """dropped before the first mark
-- @name regions
SELECT count(*) AS regions FROM {region};
-- @name empty
-- @name nations
SELECT count(*) AS nations FROM {nation}
"""


@query("s7_named_script", "SELECT 'nations' AS title, (SELECT count(*) FROM nation) AS n UNION ALL SELECT 'regions', (SELECT count(*) FROM region)")
def named_script(t: Tables) -> DataFrame:
    parts = {k: t.sql(v, *[n for n in ("region", "nation") if "{" + n + "}" in v]) for k, v in split_queries(SCRIPT).items()}
    return parts["nations"].select(F.lit("nations").alias("title"), F.col("nations").alias("n")).unionByName(parts["regions"].select(F.lit("regions").alias("title"), F.col("regions").alias("n")))


both("s8_inline_values", "SELECT m.code, m.label, o.o_orderkey FROM {orders} o JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('P', 'partial')) AS m (code, label) ON m.code = o.o_orderstatus", "orders")

# Projections, filters, predicates

both("p1_projection", "SELECT s_suppkey AS id, s_name AS name FROM {supplier}", "supplier")
both("p2_null_filters", "SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS unlabelled, count(*) FILTER (WHERE l.doc_id IS NOT NULL) AS labelled FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id", "documents", "labels")
both("p3_numeric_filters", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_quantity >= 45 AND l_discount > 0 AND l_tax = 0", "lineitem")
both("p4_string_range", "SELECT c_custkey FROM {customer} WHERE c_name >= 'Customer#000000100' AND c_name < 'Customer#000000700'", "customer")
both("p5_like", "SELECT page_id, url LIKE 'https://%' AS secure FROM {pages} WHERE url LIKE '%1%' AND url NOT LIKE '%/9%'", "pages")


@query("p6_ilike", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%cust%0001%'")
def ilike(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_name").ilike("%cust%0001%")).select("c_custkey", "c_name")


@query("p7_escaped_like", r"SELECT doc_id FROM documents WHERE text LIKE '%\%\%%' ESCAPE '\'")
def escaped(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("text").like(f"%{escape_like('%%')}%")).select("doc_id")


@query("p8_optional_parameter", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def optional(t: Tables) -> DataFrame:
    return t.sql("SELECT c_custkey FROM {customer} WHERE (:segment IS NULL OR c_mktsegment = :segment) AND (CAST(:nation AS INT) IS NULL OR c_nationkey = :nation)", "customer", segment="BUILDING", nation=None)


@query("p9_regex", "SELECT page_id, regexp_matches(url, '[0-9]{2,}') AS numbered FROM pages")
def regex(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.col("url").rlike("[0-9]{2,}").alias("numbered"))


@query("p10_membership", "SELECT doc_id FROM documents WHERE list_contains(string_split(text, ' '), 'the')")
def membership(t: Tables) -> DataFrame:
    return t.documents.filter(F.array_contains(F.split("text", " "), "the")).select("doc_id")


both("p11_distinct_from", "SELECT n.n_nationkey, m.label IS DISTINCT FROM 'two' AS differs FROM {nation} n LEFT JOIN (VALUES (1, 'one'), (2, 'two')) AS m (code, label) ON m.code = n.n_regionkey", "nation")
both(
    "p12_self_exclusion",
    """SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM {orders} a JOIN {orders} b ON a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate
       WHERE a.o_orderkey <> b.o_orderkey""",
    "orders",
)
both("p14_equality", "SELECT o_orderkey FROM {orders} WHERE o_orderstatus = 'P'", "orders")
both("p15_boolean_key", "SELECT o_totalprice > 200000 AS big, o_orderstatus AS status, count(*) AS orders FROM {orders} GROUP BY 1, 2", "orders")
both("p16_constants", "SELECT 'orders' AS metric, CAST(count(*) AS VARCHAR(20)) AS value, 'all' AS note FROM {orders}", "orders")
both("p17_point_lookup", "SELECT o.o_orderkey, c.c_name FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey", "orders", "customer")

# Joins

@query("j1_dimension_join", "SELECT n_name, r_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def dimension(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


both("j2_left_join", "SELECT d.doc_id, l.quality FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id", "documents", "labels")
both("j3_anti_match", "SELECT count(*) AS customers, count(*) FILTER (WHERE o.k IS NULL) AS without_orders FROM {customer} c LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM {orders}) o ON o.k = c.c_custkey", "customer", "orders")
both("j4_correlated_scalar", "SELECT n.n_nationkey, coalesce((SELECT CAST(count(*) AS BIGINT) FROM {customer} c JOIN {orders} o ON o.o_custkey = c.c_custkey WHERE c.c_nationkey = n.n_nationkey), 0) AS orders FROM {nation} n", "customer", "orders", "nation")
both("j5_scalar_subquery", "SELECT c_mktsegment, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {customer}) AS share FROM {customer} GROUP BY c_mktsegment", "customer")


@query("j6_lateral_unnest", "SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) x GROUP BY lang, word")
def unnest(t: Tables) -> DataFrame:
    return t.documents.select("lang", F.explode(F.split("text", " ")).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))


def people(t: Tables) -> DataFrame:
    """Customers in the shape that the search for duplicates takes: the balance's first digits as phone, nation and segment as place."""
    c = t.customer
    return c.select(F.col("c_custkey").cast("string").alias("external_id"), F.col("c_name").alias("name"), F.substring("c_name", -2, 2).alias("name_key"), F.floor(F.abs("c_acctbal") * 2).cast("string").alias("phone_e164"), F.col("c_nationkey").cast("string").alias("city_key"), F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") % 7).cast("string")).alias("address"))


PEOPLE = """WITH p AS (SELECT CAST(c_custkey AS VARCHAR) AS id, substr(c_name, length(c_name) - 1, 2) AS nk, CAST(CAST(floor(abs(c_acctbal) * 2) AS BIGINT) AS VARCHAR) AS ph,
  CAST(c_nationkey AS VARCHAR) AS ci, concat_ws('-', c_mktsegment, CAST(c_custkey % 7 AS VARCHAR)) AS ad FROM customer)
SELECT n.id AS external_id, o.id AS duplicate_of,
  CASE WHEN n.ph = o.ph AND n.ci = o.ci AND n.ad = o.ad THEN 'phone+city_address' WHEN n.ci = o.ci AND n.ad = o.ad AND n.nk = o.nk THEN 'city_address+name'
       WHEN n.ci = o.ci AND n.ad = o.ad THEN 'city_address' ELSE 'phone' END AS match_reason,
  CASE WHEN n.ci = o.ci AND n.ad = o.ad AND (n.ph = o.ph OR n.nk = o.nk) THEN 'high' WHEN n.ci = o.ci AND n.ad = o.ad THEN 'medium' ELSE 'low' END AS confidence
FROM p n JOIN p o ON n.id <> o.id AND (n.ph = o.ph OR (n.ci = o.ci AND n.ad = o.ad))"""


@query("j7_d2_duplicates", PEOPLE)
def duplicates(t: Tables) -> DataFrame:
    p = people(t)
    return find_duplicates(p, p).drop("details")


both("j9_lookup", "SELECT e.event_id, u.segment FROM {events} e LEFT JOIN (SELECT c_custkey AS k, c_mktsegment AS segment FROM {customer}) u ON u.k = e.user_id", "events", "customer")


@query("j10_semi_join", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'F')")
def semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.filter("o_orderstatus <> 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


NAMES = ("ALGERIA", "BRAZIL", "CHINA", "FRANCE", "INDIA", "JAPAN", "PERU", "RUSSIA")


@query("j11_nearest_word", f"""WITH d AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{n.lower()}')" for k, n in enumerate(NAMES))}) AS x (k, w)),
  v AS (SELECT n_nationkey, substr(lower(n_name), 1, 6) || 'a' AS s FROM nation),
  b AS (SELECT n_nationkey, s, w, levenshtein(s, w) AS e, row_number() OVER (PARTITION BY n_nationkey ORDER BY levenshtein(s, w), k) AS r FROM v, d)
  SELECT n_nationkey, CASE WHEN e <= CASE WHEN length(s) <= 6 THEN 1 ELSE 2 END THEN upper(w) END AS nearest FROM b WHERE r = 1""")
def nearest_word(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", fn.nearest(F.concat(F.substring(F.lower("n_name"), 1, 6), F.lit("a")), list(NAMES)).alias("nearest"))


@query("j12_gaps", "SELECT CAST(g AS BIGINT) AS missing FROM (SELECT unnest(range(1, (SELECT max(o_custkey) + 1 FROM orders))) AS g) x WHERE g NOT IN (SELECT o_custkey FROM orders)")
def missing(t: Tables) -> DataFrame:
    return checks.gaps(t.orders, "o_custkey")


# Aggregates

both("a1_count", "SELECT event_type, count(*) AS events FROM {events} GROUP BY event_type", "events")
both("a2_count_column", "SELECT count(l.quality) AS labelled, count(d.text) AS texts FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id", "documents", "labels")
both("a3_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM {lineitem} GROUP BY l_returnflag", "lineitem")
both("a4_filtered_distinct", "SELECT count(DISTINCT l_partkey) FILTER (WHERE l_quantity > 40) AS parts FROM {lineitem}", "lineitem")
both("a5_filtered_count", "SELECT l_linestatus, count(*) FILTER (WHERE l_discount > 0.05) AS discounted FROM {lineitem} GROUP BY l_linestatus", "lineitem")
both("a6_average", "SELECT l_returnflag, CAST(round(avg(CAST(l_quantity AS DECIMAL(12,2))), 2) AS DOUBLE) AS quantity FROM {lineitem} GROUP BY l_returnflag", "lineitem")
both("a7_min_max", "SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high FROM {orders} GROUP BY o_orderpriority", "orders")


@query("a8_max_extracted", "SELECT max(CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS BIGINT)) AS top FROM pages")
def max_extracted(t: Tables) -> DataFrame:
    return t.pages.agg(F.max(F.regexp_extract("url", "([0-9]+)", 1).try_cast("bigint")).alias("top"))


both("a9_sum", "SELECT l_shipdate >= TIMESTAMP '1997-01-01' AS late, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM {lineitem} GROUP BY 1", "lineitem")
both("a10_ratio", "SELECT o_orderpriority, CAST(round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 1) AS DOUBLE) AS filled FROM {orders} GROUP BY o_orderpriority", "orders")


@query("a11_string_agg", "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY n_regionkey")
def string_agg(t: Tables) -> DataFrame:
    return t.sql("SELECT n_regionkey, string_agg(n_name, ', ') WITHIN GROUP (ORDER BY n_name) AS nations FROM {nation} GROUP BY n_regionkey", "nation")


both("a12_having", "SELECT o_custkey, count(*) AS orders FROM {orders} GROUP BY o_custkey HAVING count(*) > 10", "orders")
both("a13_distinct", "SELECT DISTINCT lang, source FROM {documents} ORDER BY lang, source", "documents")
both("a14_ordinals", "SELECT CAST(length(c_mktsegment) AS BIGINT) AS size, count(*) AS n FROM {customer} GROUP BY 1 ORDER BY 1", "customer")
both("a15_global", "SELECT count(*) AS events, min(value) AS low, max(value) AS high FROM {events}", "events")
both("a16_nested", "WITH s AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) > 1) SELECT count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders, CAST(sum(n) - count(*) AS BIGINT) AS surplus FROM s", "orders")
both("a17_frequency", "SELECT event_type, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {events}) AS share FROM {events} GROUP BY event_type", "events")


@query("a19_histogram", "SELECT issue, count(*) AS rows FROM (SELECT unnest(string_split(p_type, ' ')) AS issue FROM part) x GROUP BY issue")
def histogram(t: Tables) -> DataFrame:
    return checks.issue_histogram(t.part.select(F.split("p_type", " ").alias("issues")))


@query("a21_repeated", "SELECT user_id, count(*) AS rows FROM events GROUP BY user_id HAVING count(*) > 1")
def repeated(t: Tables) -> DataFrame:
    return checks.repeated(t.events, "user_id")


both("a23_counters", "SELECT o_orderstatus AS status, o_orderpriority AS stage, count(*) AS n FROM {orders} GROUP BY o_orderstatus, o_orderpriority", "orders")

# Order, limits, sets

both("o1_sort", "SELECT c_custkey, c_acctbal FROM {customer} ORDER BY c_acctbal DESC, c_custkey LIMIT 100", "customer")
both("o2_top_k", "SELECT part, n FROM (SELECT l_partkey AS part, count(*) AS n FROM {lineitem} GROUP BY l_partkey) x ORDER BY n DESC, part LIMIT 20", "lineitem")
both("o3_offset", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100", "orders")
both("o4_nulls_last", "SELECT d.doc_id, l.quality FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id ORDER BY l.quality DESC NULLS LAST, d.doc_id LIMIT 30", "documents", "labels")
both("o5_nulls_first", "SELECT d.doc_id, l.quality FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id ORDER BY l.quality DESC NULLS FIRST, d.doc_id LIMIT 30", "documents", "labels")
both("o6_ordinal_sort", "SELECT o_orderkey, o_orderpriority FROM {orders} ORDER BY o_orderpriority, o_orderkey LIMIT 40", "orders")


@query("o7_metrics", """SELECT 'orders' AS metric, CAST(count(*) AS VARCHAR) AS value FROM orders UNION ALL SELECT 'filled', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'customers', CAST(count(DISTINCT o_custkey) AS VARCHAR) FROM orders UNION ALL SELECT 'urgent', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderpriority LIKE '1%'""")
def metrics(t: Tables) -> DataFrame:
    one = t.orders.agg(F.count("*").alias("a"), F.count_if(F.col("o_orderstatus") == "F").alias("b"), F.count_distinct("o_custkey").alias("c"), F.count_if(F.col("o_orderpriority").like("1%")).alias("d"))
    return one.select(F.stack(F.lit(4), F.lit("orders"), F.col("a").cast("string"), F.lit("filled"), F.col("b").cast("string"), F.lit("customers"), F.col("c").cast("string"), F.lit("urgent"), F.col("d").cast("string")).alias("metric", "value"))


@query("o8_keep_first", "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) x WHERE k = 1")
def keep_first(t: Tables) -> DataFrame:
    return checks.keep_first(t.events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])


@query("o9_first_occurrence", "SELECT event_id, first_value(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS first_id FROM events")
def first_occurrence(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.first("event_id").over(W.partitionBy("user_id").orderBy("event_id")).alias("first_id"))


@query("o10_first_seen", "SELECT source, min(doc_id) AS first_id FROM documents WHERE source IS NOT NULL GROUP BY source")
def first_seen(t: Tables) -> DataFrame:
    return checks.first_seen(t.documents, "source", "doc_id").select("source", F.col("first.doc_id").alias("first_id"))


@query("o11_lowest_priority", "SELECT domain, mx_host FROM (SELECT CAST(n_regionkey AS VARCHAR) AS domain, n_name AS mx_host, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey % 4, n_name) AS k FROM nation) x WHERE k = 1")
def lowest(t: Tables) -> DataFrame:
    return best_mx(t.nation.select(F.col("n_regionkey").cast("string").alias("domain"), F.col("n_name").alias("exchange"), (F.col("n_nationkey") % 4).alias("priority")))


# Scalar functions

@query("f1_clean", "SELECT c_custkey, CASE WHEN s IN ('', '-', 'n/a', 'na', 'null') THEN NULL ELSE s END AS cleaned FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN c_name || ' ' || c_mktsegment ELSE c_mktsegment END AS s0, lower(CASE c_custkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN c_name || ' ' || c_mktsegment ELSE c_mktsegment END) AS s FROM customer) x")
def cleaned(t: Tables) -> DataFrame:
    messy = F.when(F.col("c_custkey") % 4 == 0, "  N/A ").when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("\t"), "c_name", F.lit(" \n  "), "c_mktsegment", F.lit(" "))).otherwise(F.concat(F.lit("  "), "c_mktsegment"))
    return t.customer.select("c_custkey", F.lower(clean(messy)).alias("cleaned"))


@query("f4_name_key", "SELECT s_suppkey, lower(s_name) AS key FROM supplier")
def keys(t: Tables) -> DataFrame:
    form = F.element_at(F.array(F.lit("ООО «"), F.lit("АО \""), F.lit("ип. "), F.lit("")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return t.supplier.select("s_suppkey", name_key(F.concat(form, "s_name", F.lit("» "))).alias("key"))


@query("f8_levenshtein", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, CAST(levenshtein(a.n_name, b.n_name) AS INTEGER) AS edits FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def edits(t: Tables) -> DataFrame:
    b = t.nation.select(F.col("n_nationkey").alias("b"), F.col("n_name").alias("other"), F.col("n_regionkey").alias("r"))
    return t.nation.join(b, (F.col("n_regionkey") == F.col("r")) & (F.col("n_nationkey") < F.col("b"))).select(F.col("n_nationkey").alias("a"), "b", F.levenshtein("n_name", "other").alias("edits"))


@query("f10_rating", """SELECT p_partkey, CASE WHEN p_size % 9 = 8 OR v > 5 THEN NULL ELSE CAST(CAST(floor(v * 10 + 0.5) / 10 AS DECIMAL(2,1)) AS DOUBLE) END AS rating,
  CASE WHEN p_size % 9 = 8 THEN 'rating_not_a_number' WHEN v > 5 THEN 'rating_decimal_comma,rating_out_of_range' ELSE 'rating_decimal_comma' END AS issues FROM (SELECT p_partkey, p_size, CAST(p_size AS DOUBLE) / 8 AS v FROM part) x""")
def ratings(t: Tables) -> DataFrame:
    text = F.when(F.col("p_size") % 9 == 8, "abc").otherwise(F.regexp_replace(F.format_string("%.3f", F.col("p_size") / 8), r"\.", ","))
    r = fn.rating(text, F.lit(False))
    return t.part.select("p_partkey", r["value"].cast("double").alias("rating"), F.array_join(r["issues"], ",").alias("issues"))


@query("f12_reviews", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN NULL ELSE CAST(floor(l_quantity / 4 + 0.5) AS INTEGER) END AS reviews,
  CASE WHEN l_linenumber = 1 THEN 'reviews_missing' WHEN l_linenumber = 2 THEN 'reviews_negative' WHEN l_quantity / 4 <> floor(l_quantity / 4) THEN 'reviews_not_integer' ELSE '' END AS issues FROM lineitem""")
def review_counts(t: Tables) -> DataFrame:
    quarter = F.format_string("%.2f", F.col("l_quantity") / 4)
    text = F.when(F.col("l_linenumber") == 1, "").when(F.col("l_linenumber") == 2, F.concat(F.lit("-"), quarter)).otherwise(quarter)
    r = fn.reviews(text, F.lit(False))
    return t.lineitem.select("l_orderkey", "l_linenumber", r["value"].alias("reviews"), F.array_join(r["issues"], ",").alias("issues"))


@query("f13_site", r"""SELECT page_id, rtrim(lower(regexp_extract(url, '^https?://[^/]*')) || regexp_extract(url, '^https?://[^/]*(.*)$', 1), '/') AS site FROM pages WHERE regexp_matches(url, '^https?://([A-Za-z0-9-]+\.)+[A-Za-z]+(/[A-Za-z0-9_-]+)*/?$')""")
def sites(t: Tables) -> DataFrame:
    p = t.pages.filter(F.col("url").rlike(r"^https?://([A-Za-z0-9-]+\.)+[A-Za-z]+(/[A-Za-z0-9_-]+)*/?$"))
    return p.select("page_id", fn.site(F.col("url"))["value"].alias("site"))


@query("f14_phone", """SELECT c_custkey, CASE WHEN c_custkey % 5 < 2 THEN '+79' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS e164,
  CASE c_custkey % 5 WHEN 2 THEN 'phone_contains_letters' WHEN 3 THEN 'phone_too_short' WHEN 4 THEN 'phone_too_long' ELSE '' END AS issues FROM customer""")
def phones(t: Tables) -> DataFrame:
    nine = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    shapes = [F.concat(F.lit("8 (9"), F.substring(nine, 1, 2), F.lit(") "), F.substring(nine, 3, 3), F.lit("-"), F.substring(nine, 6, 4)), F.concat(F.lit("+7 9"), nine), F.concat(F.lit("8 доб. "), nine), F.lit("+7"), F.concat(F.lit("+7 99"), nine)]
    text = F.element_at(F.array(*shapes), (F.col("c_custkey") % 5 + 1).cast("int"))
    p = fn.phone(text)
    return t.customer.select("c_custkey", p["e164"].alias("e164"), F.array_join(p["issues"], ",").alias("issues"))


@query("f16_id_format", "SELECT c_custkey, regexp_matches(c_name, '^Customer#[0-9]{9}$') AS fits FROM customer")
def id_format(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.col("c_name").rlike("^Customer#[0-9]{9}$").alias("fits"))


@query("f18_shared_hosts", r"""SELECT domain, count(*) AS pages, string_agg(CAST(page_id AS VARCHAR), ', ' ORDER BY page_id) AS who FROM (SELECT page_id, regexp_extract(lower(regexp_replace(regexp_replace(url, '^https?://', ''), '^www\.', '')), '^[^/?#]*') AS domain FROM pages) x GROUP BY domain HAVING count(*) > 1""")
def shared_hosts(t: Tables) -> DataFrame:
    p = t.pages.select("page_id", F.regexp_extract(em.site_domain(F.col("url")), "^[^/?#]*", 0).alias("domain"))
    return p.groupBy("domain").agg(F.count("*").alias("pages"), F.array_join(F.transform(F.sort_array(F.collect_list("page_id")), lambda x: x.cast("string")), ", ").alias("who")).filter("pages > 1")


@query("f19_mail_domain", r"SELECT page_id, CASE WHEN h LIKE '%.%' AND h NOT LIKE '.%' AND h NOT LIKE '%.' THEN h END AS domain FROM (SELECT page_id, regexp_replace(regexp_extract(regexp_replace(lower(trim(url)), '^https?://', ''), '^[^/?#:]*'), '^www\.', '') AS h FROM pages) x")
def mail_domains(t: Tables) -> DataFrame:
    return t.pages.select("page_id", em.mail_domain(F.col("url")).alias("domain"))


both("f20_split_part", "SELECT p_partkey, split_part(p_type, ' ', 2) AS middle FROM {part}", "part")


@query("f21_substring", "SELECT c_custkey, substr(c_name, 12, 3) AS code FROM customer")
def substrings(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.substring("c_name", 12, 3).alias("code"))


@query("f22_extracted_int", "SELECT c_custkey, CAST(nullif(regexp_extract(c_name, '#0*([0-9]+)', 1), '') AS INTEGER) AS n FROM customer")
def extracted(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.regexp_extract("c_name", "#0*([0-9]+)", 1).try_cast("int").alias("n"))


both("f23_coalesce", "SELECT d.doc_id, coalesce(d.lang, '?') || ':' || coalesce(CAST(l.quality AS VARCHAR(9)), '-') AS tag FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id", "documents", "labels")


@query("f24_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_path(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("f25_array_to_string", "SELECT p_partkey, array_to_string(string_split(p_type, ' '), ', ') AS joined FROM part")
def joined(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(F.split("p_type", " "), ", ").alias("joined"))


both("f26_casts", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,1)) AS DOUBLE) AS tenths, CAST(o_custkey AS VARCHAR(20)) AS customer FROM {orders}", "orders")
both("f27_same_value", "SELECT d.doc_id, l.quality IS NOT DISTINCT FROM l.toxic AS same FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id", "documents", "labels")

@query("k4_upsert", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 <> 0 THEN 'new' ELSE 'old' END AS v FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 10 <> 0")
def upserted(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return upsert(t.orders.filter(k % 3 != 0).select(k.alias("k"), F.lit("old").alias("v")), t.orders.filter(k % 10 != 0).select(k.alias("k"), F.lit("new").alias("v")), ["k"])


# E-mail

def addresses(t: Tables) -> DataFrame:
    """Addresses of many shapes: customers' numbers at known, misspelt, throw-away and broken domains."""
    ends = ["gmial.com", "mail.ru", "mailinator.com", "a..b.ru", "x", "-a.ru", "a.r1"]
    starts = ["info", "sales.team", "anna", ".bob", "c d"]
    k = F.col("c_custkey")
    return t.customer.select(k, F.concat(F.element_at(F.array(*map(F.lit, starts)), (k % 5 + 1).cast("int")), F.lit("@"), F.element_at(F.array(*map(F.lit, ends)), (k % 7 + 1).cast("int"))).alias("email"))


ADDRESSES = """a AS (SELECT c_custkey, list_extract(['info', 'sales.team', 'anna', '.bob', 'c d'], c_custkey % 5 + 1) AS l, list_extract(['gmial.com', 'mail.ru', 'mailinator.com', 'a..b.ru', 'x', '-a.ru', 'a.r1'], c_custkey % 7 + 1) AS d FROM customer)"""


@query("e2_domain_typo", f"WITH {ADDRESSES} SELECT c_custkey, l || '@' || CASE d WHEN 'gmial.com' THEN 'gmail.com' WHEN 'a..b.ru' THEN 'a.b.ru' ELSE d END AS email, d IN ('gmial.com', 'a..b.ru') AS fixed FROM a")
def typos(t: Tables) -> DataFrame:
    return addresses(t).select("c_custkey", em.fix_domain(F.col("email")).alias("f")).select("c_custkey", "f.email", "f.fixed")


@query("e3_syntax", f"""WITH {ADDRESSES} SELECT c_custkey, concat_ws(',', CASE WHEN l = 'c d' THEN 'syntax_whitespace' END, CASE WHEN l = '.bob' THEN 'syntax_bad_dots_in_local' END, CASE WHEN l = 'c d' THEN 'syntax_bad_local_chars' END,
  CASE WHEN d = 'x' THEN 'syntax_domain_without_dot' END, CASE WHEN d = '-a.ru' THEN 'syntax_bad_hyphen_in_domain' END, CASE WHEN d IN ('x', 'a.r1') THEN 'syntax_bad_tld' END) AS issues FROM a""")
def syntax_issues(t: Tables) -> DataFrame:
    return addresses(t).select("c_custkey", F.array_join(em.syntax(F.col("email")), ",").alias("issues"))


@query("e4_role", f"WITH {ADDRESSES} SELECT c_custkey, l IN ('info', 'sales.team') AS role FROM a")
def roles(t: Tables) -> DataFrame:
    return addresses(t).select("c_custkey", em.is_role(F.col("email")).alias("role"))


@query("e5_disposable", f"WITH {ADDRESSES} SELECT c_custkey, d = 'mailinator.com' AS disposable FROM a")
def throw_away(t: Tables) -> DataFrame:
    return addresses(t).select("c_custkey", em.is_disposable(F.col("email")).alias("disposable"))


@query("e6_offline_verdict", f"""WITH {ADDRESSES}, b AS (SELECT *, l IN ('.bob', 'c d') OR d IN ('x', '-a.ru', 'a.r1') AS bad FROM a) SELECT c_custkey, CASE WHEN bad OR d = 'mailinator.com' THEN 'rejected' ELSE 'unknown' END AS status,
  CASE WHEN bad THEN 'syntax' WHEN d = 'mailinator.com' THEN 'disposable' END AS stage_failed FROM b""")
def offline(t: Tables) -> DataFrame:
    return addresses(t).select("c_custkey", em.offline_verdict(F.col("email")).alias("v")).select("c_custkey", "v.status", "v.stage_failed")


@query("e9_catch_all", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN 'catch_all' WHEN o_orderstatus = 'O' THEN 'accepted' WHEN o_orderstatus = 'F' THEN 'rejected' ELSE 'unknown' END AS answer FROM orders")
def catch_all(t: Tables) -> DataFrame:
    real = F.when(F.col("o_orderstatus") == "O", "accepted").when(F.col("o_orderstatus") == "F", "rejected").otherwise("unknown")
    return t.orders.select("o_orderkey", em.interpret_smtp(real, F.when(F.col("o_orderkey") % 2 == 0, "accepted").otherwise("rejected")).alias("answer"))


def shops(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("external_id"), F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("https://www.shop-"), F.col("s_suppkey") % 40, F.lit(".ru/about"))).alias("site"))


def shop_facts(t: Tables) -> DataFrame:
    k = F.col("k")
    return t.spark.range(40).select(F.col("id").alias("k")).filter(k % 5 != 4).select(F.concat(F.lit("shop-"), k, F.lit(".ru")).alias("domain"), (k % 5 == 0).alias("has_mx"), F.lit(None).cast("string").alias("mx_host"), F.when(k % 5 < 2, "exists").when(k % 5 == 2, "absent").otherwise("unknown").alias("existence"))


SHOPS = """s AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_suppkey % 40 AS k FROM supplier WHERE s_suppkey % 9 <> 0), c AS (SELECT id, k, p || '@shop-' || k || '.ru' AS email FROM s, (VALUES ('info'), ('sales'), ('contact')) AS x (p))"""


@query("e1_candidates", f"WITH {SHOPS} SELECT id AS external_id, email FROM c")
def email_candidates(t: Tables) -> DataFrame:
    return derive(shops(t)).select("external_id", F.col("verdict.normalized").alias("email"))


@query("e7_domains_to_ask", f"WITH {SHOPS} SELECT DISTINCT 'shop-' || k || '.ru' AS domain FROM s")
def asked(t: Tables) -> DataFrame:
    return domains_to_ask(derive(shops(t)))


@query("e10_e11_final_verdict", f"""WITH {SHOPS} SELECT id AS external_id, email, CASE WHEN k % 5 IN (1, 2) THEN 'rejected' ELSE 'unknown' END AS status, CASE WHEN k % 5 IN (1, 2) THEN 'mx' END AS stage_failed,
  'role_account,' || CASE k % 5 WHEN 0 THEN 'smtp_not_checked' WHEN 1 THEN 'domain_has_no_mx' WHEN 2 THEN 'domain_has_no_mx,domain_does_not_exist' ELSE 'dns_lookup_failed' END AS issues FROM c""")
def final(t: Tables) -> DataFrame:
    return judge(derive(shops(t)), shop_facts(t)).select("external_id", "email", "status", "stage_failed", F.array_join("issues", ",").alias("issues"))


@query("a23_email_counters", f"WITH {SHOPS}, j AS (SELECT CASE WHEN k % 5 IN (1, 2) THEN 'rejected' ELSE 'unknown' END AS status, CASE WHEN k % 5 IN (1, 2) THEN 'mx' END AS stage FROM c) SELECT 'status' AS kind, status AS name, count(*) AS rows FROM j GROUP BY status UNION ALL SELECT 'stage', stage, count(*) FROM j WHERE stage IS NOT NULL GROUP BY stage")
def email_counters(t: Tables) -> DataFrame:
    return counters(judge(derive(shops(t)), shop_facts(t)))


@query("e0_addresses_in_text", "SELECT doc_id, regexp_extract(text, '[A-Za-z0-9._-]+@[A-Za-z0-9.-]+') AS email FROM documents WHERE text LIKE '%@%'")
def in_text(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("text").contains("@")).select("doc_id", F.regexp_extract("text", "[A-Za-z0-9._-]+@[A-Za-z0-9.-]+", 0).alias("email"))


# Queries over company-shaped rows, which register themselves.
from . import company_queries  # noqa: E402, F401

__all__ = ["ORACLES", "QUERIES"]
