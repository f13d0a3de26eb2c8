"""Queries of the relational vocabulary: sources, sinks, projections, joins, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens import sources as src
from firmlens.functions import sets
from firmlens.functions import text as tx
from firmlens.operators import agreement as ag
from firmlens.operators import batches, distribution, sampling
from firmlens.operators import firms as fo
from firmlens.plans import bindings as b
from firmlens.plans.registry import query, rounded
from firmlens.sources import drift

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
SELECT_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def orders(spark, sf):
    return b.table(spark, sf, "orders").select(*ORDER_COLUMNS)


# Sources and sinks. Each writes a whole table to the shared folder and reads it back.


@query("scan_skip_corrupt", SELECT_ORDERS)
def scan_skip_corrupt(spark, sf):
    folder = src.shared_folder(spark, "corrupt")
    src.write_parquet(orders(spark, sf), f"{folder}/good")
    orders(spark, sf).select("o_orderstatus").write.text(f"{folder}/damaged")
    return src.read_parquet(spark, folder, schema=ORDERS, skip_corrupt=True)


@query("scan_unreadable", "SELECT 1::BIGINT AS n_damaged, count(*) AS n_rows FROM orders")
def scan_unreadable(spark, sf):
    """Of good files, an empty one and one that is none, only the last is named and left out."""
    folder = src.shared_folder(spark, "unreadable")
    src.write_parquet(orders(spark, sf), f"{folder}/good")
    src.write_parquet(orders(spark, sf).filter("false"), f"{folder}/empty")
    orders(spark, sf).select("o_orderstatus").coalesce(1).write.text(f"{folder}/damaged")
    named = src.unreadable_files(spark, folder, ORDERS).agg(F.count("*").alias("n")).scalar()
    return src.read_whole_files(spark, folder, ORDERS).agg(named.alias("n_damaged"), F.count("*").alias("n_rows"))


@query("scan_glob", SELECT_ORDERS)
def scan_glob(spark, sf):
    folder = src.shared_folder(spark, "glob")
    table = orders(spark, sf)
    for i in range(2):
        src.write_parquet(table.filter(F.col("o_orderkey") % 2 == i), f"{folder}/day={i}")
    return src.read_parquet(spark, f"{folder}/day=*/*.parquet")


@query("scan_merge_schema", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice FROM orders""")
def scan_merge_schema(spark, sf):
    folder = src.shared_folder(spark, "drift")
    table = orders(spark, sf)
    src.write_parquet(table.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), f"{folder}/v=1")
    src.write_parquet(table.filter("o_orderstatus <> 'F'").select("o_orderkey"), f"{folder}/v=2")
    return src.read_parquet(spark, folder, merge_schema=True).select("o_orderkey", "o_totalprice")


@query("scan_drifting", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN floor(o_totalprice)::DOUBLE WHEN 'O' THEN o_totalprice
             ELSE o_totalprice::FLOAT::DOUBLE END AS o_totalprice,
           CASE o_orderstatus WHEN 'F' THEN [o_orderpriority] WHEN 'O' THEN [o_orderstatus, o_orderpriority] END AS links,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS o_custkey FROM orders""")
def scan_drifting(spark, sf):
    folder = src.shared_folder(spark, "drifting")
    table = orders(spark, sf)
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    key, links = F.col("o_orderkey"), F.col("o_orderpriority")
    src.write_parquet(table.filter(status == "F").select(key.cast("int"), price.cast("long"), links.alias("links")), f"{folder}/a")
    src.write_parquet(table.filter(status == "O").select(key, price, F.array(status, links).alias("links")), f"{folder}/b")
    src.write_parquet(table.filter(status == "P").select("o_custkey", key, price.cast("float")), f"{folder}/c")
    return drift.read_drifting(spark, folder)


@query("scan_csv", SELECT_ORDERS)
def scan_csv(spark, sf):
    path = src.write_csv(orders(spark, sf), src.shared_folder(spark, "csv"))
    return src.read_csv(spark, path, schema=ORDERS)


@query("scan_csv_ragged", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus FROM orders""")
def scan_csv_ragged(spark, sf):
    status = F.col("o_orderstatus")
    head = [F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")]
    # Lines with a surplus field, with all fields, and with the last one missing.
    line = (
        F.when(status == "F", F.concat_ws(",", *head, status, F.lit("surplus")))
        .when(status == "P", F.concat_ws(",", *head)).otherwise(F.concat_ws(",", *head, status))
    )
    path = src.shared_folder(spark, "ragged")
    orders(spark, sf).select(line.alias("value")).write.text(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    return src.read_csv(spark, path, schema=schema, ragged=True, header=False)


@query("union_diagonal", """
    SELECT c_name AS name, c_nationkey AS nationkey, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL, s_acctbal FROM supplier""")
def union_diagonal(spark, sf):
    customer = b.table(spark, sf, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nationkey", "c_mktsegment AS segment")
    supplier = b.table(spark, sf, "supplier").selectExpr(
        "s_name AS name", "s_nationkey AS nationkey", "s_acctbal AS balance")
    paths = [src.write_csv(t, src.shared_folder(spark, "group")) for t in (customer, supplier)]
    return src.load_csv_groups(
        spark, paths, ["name string, nationkey int, segment string", "name string, nationkey int, balance double"])


@query("json_roundtrip", SELECT_ORDERS)
def json_roundtrip(spark, sf):
    path = src.write_json(orders(spark, sf), src.shared_folder(spark, "json"))
    return src.read_json(spark, path, schema=ORDERS)


@query("parquet_roundtrip", SELECT_ORDERS)
def parquet_roundtrip(spark, sf):
    path = src.write_parquet(orders(spark, sf), src.shared_folder(spark, "parquet"), row_group_bytes=1 << 20)
    return src.read_parquet(spark, path)


@query("sink_max_records", "SELECT count(*) AS n_rows, 0::BIGINT AS files_over_limit FROM documents")
def sink_max_records(spark, sf):
    path = src.write_parquet(b.page_text(spark, sf), src.shared_folder(spark, "split"), max_rows_per_file=3000)
    per_file = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 3000).alias("files_over_limit"))


@query("sink_compact", SELECT_ORDERS)
def sink_compact(spark, sf):
    parts = src.write_parquet(orders(spark, sf), src.shared_folder(spark, "parts"), max_rows_per_file=3000)
    return src.read_parquet(spark, src.compact(spark, parts, src.shared_folder(spark, "compact")))


# Projections and filters.


@query("filter_basic", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus <> 'O' AND l_quantity >= 25 AND l_shipdate IS NOT NULL""")
def filter_basic(spark, sf):
    line = b.table(spark, sf, "lineitem")
    return line.filter(
        (F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "O")
        & (F.col("l_quantity") >= 25) & F.col("l_shipdate").isNotNull()
    ).select("l_orderkey", "l_linenumber", "l_quantity")


PATENT_FIRMS = "(SELECT DISTINCT id FROM hits WHERE source = 'pat')"


@query("filter_in_set", f"SELECT * FROM firms WHERE id IN {PATENT_FIRMS}", "hits firms")
def filter_in_set(spark, sf):
    ids = b.hits(spark, sf).filter("source = 'pat'").select("id").distinct()
    return b.firms(spark, sf).join(ids, "id", "left_semi")


@query("filter_not_in_set", f"SELECT * FROM firms WHERE id NOT IN {PATENT_FIRMS}", "hits firms")
def filter_not_in_set(spark, sf):
    ids = b.hits(spark, sf).filter("source = 'pat'").select("id").distinct()
    return b.firms(spark, sf).join(ids, "id", "left_anti")


@query("filter_text", r"""
    SELECT doc_id, lang FROM documents
    WHERE NOT starts_with(text, 'The') AND contains(text, 'the') AND NOT regexp_matches(text, '[0-9]{3}')""")
def filter_text(spark, sf):
    text = F.col("text")
    kept = ~text.startswith("The") & text.contains("the") & ~text.rlike("[0-9]{3}")
    return b.table(spark, sf, "documents").filter(kept).select("doc_id", "lang")


@query("fill_null", """
    SELECT id, url, coalesce(error, 'no error') AS error FROM run""", "run")
def fill_null(spark, sf):
    return b.run(spark, sf).select("id", "url", "error").na.fill("no error", ["error"])


@query("distinct_rows", "SELECT DISTINCT id, category, keyword FROM hits", "hits")
def distinct_rows(spark, sf):
    return b.hits(spark, sf).select("id", "category", "keyword").distinct()


@query("distinct_on_key", """
    SELECT url, id, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY url) AS n FROM page_text)
    WHERE n = 1""", "page_text")
def distinct_on_key(spark, sf):
    return sampling.first_per_key(b.page_text(spark, sf).select("url", "id", "text"), ["text"], "url")


# Joins.


@query("join_inner", "SELECT h.id, page, category, keyword, name, canton FROM hits h JOIN firms f ON h.id = f.id",
       "hits firms")
def join_inner(spark, sf):
    joined = b.hits(spark, sf).join(b.firms(spark, sf), "id")
    return joined.select("id", "page", "category", "keyword", "name", "canton")


@query("join_renamed_key", """
    SELECT o_orderkey, c_custkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_renamed_key(spark, sf):
    customer = b.table(spark, sf, "customer").select("c_custkey", "c_name")
    placed = orders(spark, sf).withColumnRenamed("o_custkey", "c_custkey")
    return placed.join(customer, "c_custkey").select("o_orderkey", "c_custkey", "c_name", "o_totalprice")


@query("join_left_fill", """
    SELECT f.id, f.canton, coalesce(u.category, 'No category') AS category FROM firms f
    LEFT JOIN (SELECT DISTINCT id, category FROM hits WHERE source = 'pat') u ON f.id = u.id""", "hits firms")
def join_left_fill(spark, sf):
    pairs = b.hits(spark, sf).filter("source = 'pat'").select("id", "category").distinct()
    joined = b.firms(spark, sf).select("id", "canton").join(pairs, "id", "left")
    return joined.na.fill("No category", ["category"])


@query("join_full_fill", """
    SELECT coalesce(w.id, p.id) AS id, coalesce(w.n, 0) AS n_web, coalesce(p.n, 0) AS n_pat
    FROM (SELECT id, count(*) AS n FROM hits WHERE source = 'web' GROUP BY id) w
    FULL JOIN (SELECT id, count(*) AS n FROM hits WHERE source = 'pat' GROUP BY id) p ON w.id = p.id""", "hits")
def join_full_fill(spark, sf):
    web, pat = (
        b.hits(spark, sf).filter(F.col("source") == s).groupBy("id").agg(F.count("*").alias(f"n_{s}"))
        for s in ("web", "pat")
    )
    return web.join(pat, "id", "full").na.fill(0, ["n_web", "n_pat"])


# Aggregates.


@query("agg_count", "SELECT category, source, count(*) AS n FROM hits GROUP BY ALL", "hits")
def agg_count(spark, sf):
    return b.hits(spark, sf).groupBy("category", "source").agg(F.count("*").alias("n"))


@query("agg_count_distinct", """
    SELECT category, count(DISTINCT keyword) AS n_keywords, count(DISTINCT id) AS n_firms FROM hits GROUP BY 1""",
       "hits")
def agg_count_distinct(spark, sf):
    return b.hits(spark, sf).groupBy("category").agg(
        F.count_distinct("keyword").alias("n_keywords"), F.count_distinct("id").alias("n_firms"))


@query("agg_first", "SELECT id, arg_min(page, page) AS page, min(category) AS category FROM hits GROUP BY id", "hits")
def agg_first(spark, sf):
    return b.hits(spark, sf).groupBy("id").agg(
        F.min_by("page", "page").alias("page"), F.min("category").alias("category"))


@query("agg_basic", """
    SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS avg_qty, min(l_extendedprice) AS min_price,
           max(l_extendedprice) AS max_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           count(*) AS n
    FROM lineitem GROUP BY 1, 2""")
def agg_basic(spark, sf):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return b.table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"), F.round(F.sum(revenue), 2).alias("revenue"),
        F.count("*").alias("n"))


@query("agg_collect_list", """
    SELECT id, list(n_unique ORDER BY n_unique) AS counts FROM unique_kw WHERE source = 'web' GROUP BY id""",
       "unique_kw")
def agg_collect_list(spark, sf):
    counts = fo.unique_keywords(b.hits(spark, sf).filter("source = 'web'"))
    return counts.groupBy("id").agg(F.sort_array(F.collect_list("n_unique")).alias("counts"))


@query("agg_collect_set", "SELECT id, list_sort(list(DISTINCT category)) AS categories FROM hits GROUP BY id", "hits")
def agg_collect_set(spark, sf):
    return b.hits(spark, sf).groupBy("id").agg(F.sort_array(F.collect_set("category")).alias("categories"))


JACCARD = """
    SELECT a.id, len(list_intersect(a.c, p.c)) / len(list_distinct(list_concat(a.c, p.c))) AS j
    FROM (SELECT id, list(DISTINCT category) AS c FROM hits WHERE source = 'web' GROUP BY id) a
    JOIN (SELECT id, list(DISTINCT category) AS c FROM hits WHERE source = 'pat' GROUP BY id) p ON a.id = p.id"""


def jaccard_values(spark, sf):
    pairs = ag.paired_sets(ag.source_flags(b.hits(spark, sf)), "web", "pat")
    return pairs.select("id", sets.jaccard(F.col("web"), F.col("pat")).alias("j"))


@query("describe_column", f"""
    , j AS ({JACCARD}), q AS (SELECT j, row_number() OVER (ORDER BY j) AS rn, count(*) OVER () AS n FROM j)
    SELECT count(*) AS "count", 0::BIGINT AS null_count, round(avg(j), 6) AS mean, round(stddev_samp(j), 6) AS std,
           round(min(j), 6) AS min, round(max(j), 6) AS max,
           round(max(CASE WHEN rn = round(0.25 * (n - 1)) + 1 THEN j END), 6) AS p25,
           round(max(CASE WHEN rn = round(0.5 * (n - 1)) + 1 THEN j END), 6) AS p50,
           round(max(CASE WHEN rn = round(0.75 * (n - 1)) + 1 THEN j END), 6) AS p75 FROM q""", "hits")
def describe_column(spark, sf):
    return rounded(distribution.describe(jaccard_values(spark, sf), "j"))


@query("histogram_bins", f"""
    , j AS ({JACCARD}), s AS (SELECT min(j) AS lo, (max(j) - min(j)) / 10 AS w FROM j),
    r AS (SELECT j, lo, w, floor((j - lo) / w) + 1 AS b FROM j, s),
    e AS (SELECT CASE WHEN j < lo + (b - 1) * w THEN b - 1 WHEN j >= lo + b * w THEN b + 1 ELSE b END AS b FROM r)
    SELECT greatest(1, least(b, 10))::BIGINT AS bin, count(*) AS n FROM e GROUP BY 1""", "hits")
def histogram_bins(spark, sf):
    return distribution.equal_width_bins(jaccard_values(spark, sf), "j", 10)


# Order, samples, sets.


@query("slice_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 200 OFFSET 100")
def slice_rows(spark, sf):
    return sampling.slice_rows(orders(spark, sf).select("o_orderkey", "o_totalprice"), 100, 200, "o_orderkey")


@query("sample_ids", """
    SELECT url, id FROM page_text WHERE url IN (
      SELECT url FROM page_text ORDER BY ('0x' || substr(md5('7|' || url), 1, 8))::BIGINT, url LIMIT 500)""",
       "page_text")
def sample_ids(spark, sf):
    pages = b.page_ids(spark, sf).select("url", "id")
    return pages.join(sampling.sample_ids(pages, "url", 500, seed=7), "url", "left_semi")


@query("union_all", """
    SELECT c_name AS name, c_nationkey AS nationkey FROM customer
    UNION ALL SELECT s_name, s_nationkey FROM supplier""")
def union_all(spark, sf):
    customer = b.table(spark, sf, "customer").selectExpr("c_name AS name", "c_nationkey AS nationkey")
    return customer.unionByName(
        b.table(spark, sf, "supplier").selectExpr("s_nationkey AS nationkey", "s_name AS name"))


# Scalar functions.


@query("scalar_strings", r"""
    SELECT doc_id, lower(text) AS low, length(text)::BIGINT AS n, substring(text, 1, 14) AS head,
           trim(substring(text, 10, 20)) AS stripped, string_split(substring(text, 1, 60), '. ') AS parts,
           regexp_replace(text, '^(https?://)?', '') AS no_scheme, regexp_replace(text, '["\[\]]', '', 'g') AS plain,
           regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS ascii, starts_with(text, 'The') AS starts,
           contains(text, 'tion') AS has, regexp_matches(text, '[0-9]') AS digits,
           array_to_string([lang, source], ', ') AS joined
    FROM documents""")
def scalar_strings(spark, sf):
    text = F.col("text")
    return b.table(spark, sf, "documents").select(
        "doc_id", F.lower(text).alias("low"), F.char_length(text).cast("long").alias("n"),
        F.substring(text, 1, 14).alias("head"), F.trim(F.substring(text, 10, 20)).alias("stripped"),
        F.split(F.substring(text, 1, 60), r"\Q. \E").alias("parts"),
        F.regexp_replace(text, "^(https?://)?", "").alias("no_scheme"),
        F.regexp_replace(text, r'["\[\]]', "").alias("plain"), tx.strip_non_ascii(text).alias("ascii"),
        text.startswith("The").alias("starts"), text.contains("tion").alias("has"),
        text.rlike("[0-9]").alias("digits"), F.array_join(F.array("lang", "source"), ", ").alias("joined"))


@query("scalar_arrays", """
    , s AS (SELECT id, list_sort(list(DISTINCT category) FILTER (source = 'web')) AS web,
                   list_sort(list(DISTINCT category) FILTER (source = 'pat')) AS pat FROM hits GROUP BY id),
    f AS (SELECT * FROM s WHERE len(web) > 0 AND len(pat) > 0),
    w AS (SELECT id, len(web)::BIGINT AS n_web, web[1] AS first, list_contains(web, 'Brand#2') AS has,
                 len(list_intersect(web, pat))::BIGINT AS n_common,
                 len(list_distinct(list_concat(web, pat)))::BIGINT AS n_any,
                 list_max(web) AS largest, list_position(web, list_max(web))::BIGINT AS place FROM f)
    SELECT id, first, has, largest, place, measure, value FROM (
      UNPIVOT w ON n_web, n_common, n_any INTO NAME measure VALUE value)""", "hits")
def scalar_arrays(spark, sf):
    web, pat = F.col("web"), F.col("pat")
    pairs = ag.paired_sets(ag.source_flags(b.hits(spark, sf)), "web", "pat")
    wide = pairs.select(
        "id", sets.n_items(web).alias("n_web"), F.get(web, F.lit(0)).alias("first"),
        F.array_contains(web, "Brand#2").alias("has"), sets.n_common(web, pat).alias("n_common"),
        sets.n_items(F.array_union(web, pat)).alias("n_any"), F.array_max(web).alias("largest"),
        F.array_position(web, F.array_max(web)).alias("place"))
    return wide.unpivot(["id", "first", "has", "largest", "place"], ["n_web", "n_common", "n_any"], "measure", "value")


@query("scalar_time", """
    SELECT id, url, date_trunc('second', ts) AS at,
           date_diff('second', date_trunc('second', min(ts) OVER ()), date_trunc('second', ts)) AS seconds
    FROM run""", "run")
def scalar_time(spark, sf):
    run = b.run(spark, sf).select("id", "url", tx.parse_ctime(F.col("timestamp")).alias("at"))
    start = run.agg(F.min("at")).scalar()
    return run.withColumn("seconds", F.timestamp_diff("SECOND", start.cast("timestamp"), F.col("at").cast("timestamp")))


@query("scalar_math", """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) AS per_day,
           round(CASE WHEN l_discount > 0 THEN log10(l_discount) END, 6) AS log_discount,
           abs(l_quantity - 25) AS distance, round(l_tax / nullif(l_discount, 0), 6) AS ratio
    FROM lineitem""")
def scalar_math(spark, sf):
    discount = F.col("l_discount")
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 2).alias("per_day"),
        F.round(F.log10(discount), 6).alias("log_discount"), F.abs(F.col("l_quantity") - 25).alias("distance"),
        F.round(F.try_divide("l_tax", discount), 6).alias("ratio"))


@query("udf_batches", """
    SELECT o_orderkey, round(o_totalprice * 2, 2) AS doubled FROM orders""")
def udf_batches(spark, sf):
    def scaled(batch, factor):
        batch["doubled"] = (batch["o_totalprice"] * factor).round(2)
        return batch[["o_orderkey", "doubled"]]

    rows = orders(spark, sf).select("o_orderkey", "o_totalprice")
    return batches.apply_batches(rows, scaled, "o_orderkey bigint, doubled double", 2)
