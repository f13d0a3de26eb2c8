"""Views that stand the test tables in for crawled pages, patents and firms.

Each binding exists twice: as a DataFrame and, in ``VIEWS``, as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.functions.text import domain
from firmlens.sources.files import read_parquet

REGION = "NATION_3"

# Dictionary in the layout of a keyword file. It holds a capitalised
# phrase, padding, a phrase too short to keep, phrases in two categories, multi-word
# phrases and one that never occurs.
KEYWORD_ROWS = [
    ("alpha", "thble, thtion, thing, the"),
    ("beta", "attion, erble, Ertion, thing"),
    ("gamma", "ering, oning , that the"),
    ("delta", "nicht, ontion, retion"),
    ("epsilon", "antion, onble, of the, zzzzzz"),
]

# Stop words of the vocabulary queries.
STOP_WORDS = ["the", "of", "and", "to", "in", "that", "for", "is", "on"]

_KEYWORD_VALUES = ", ".join(f"('{c}', '{p}')" for c, p in KEYWORD_ROWS)

VIEWS = {
    "hits": """
        SELECT o.o_custkey AS id, l.l_orderkey AS page, p.p_brand AS category, p.p_name AS keyword,
               CASE WHEN l.l_linestatus = 'O' THEN 'web' ELSE 'pat' END AS source
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "firms": """
        SELECT c.c_custkey AS id, c.c_name AS name, n.n_name AS canton,
               CAST(floor(abs(c.c_acctbal)) AS BIGINT) AS n_employees
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "run": """
        SELECT user_id AS id, event_id AS url, ts,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS dl_rank,
               CASE event_type WHEN 'view' THEN 'None' WHEN 'click' THEN NULL ELSE event_type END AS error,
               strftime(ts, '%a %b %d %H:%M:%S %Y') AS "timestamp"
        FROM events""",
    "page_text": "SELECT doc_id AS url, source AS id, lang AS canton, text FROM documents",
    "keywords_raw": f"SELECT * FROM (VALUES {_KEYWORD_VALUES}) AS t(category, prompt_output)",
    "brand_phrases": """
        SELECT p_brand AS category, '  ' || upper(p_name) || ', ' || p_type || ', abc,  ' || lower(p_brand) AS prompt_output
        FROM part""",
    "dictionary": """
        SELECT DISTINCT category, lower(trim(k)) AS keyword
        FROM (SELECT category, unnest(string_split(prompt_output, ', ')) AS k FROM keywords_raw)
        WHERE length(trim(k)) > 4""",
    "run_links": """
        SELECT a.page_id, a.url, concat('["', b.url, '", "', c.url, '"]') AS links
        FROM pages a CROSS JOIN (SELECT count(*) AS n FROM pages) s
        JOIN pages b ON b.page_id = (a.page_id * 7 + 1) % s.n
        JOIN pages c ON c.page_id = (a.page_id * 13 + 5) % s.n""",
    "categories": """
        SELECT label, embedding FROM (
          SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings) t
        WHERE rn = 1""",
    "llm_labels": """
        SELECT id, category FROM (
          SELECT id, category, count(DISTINCT keyword) AS n FROM hits GROUP BY id, category) t
        WHERE n >= 2""",
    "corpora": """
        SELECT 'web' AS corpus, doc_id::VARCHAR AS doc, lang, text FROM documents
        UNION ALL
        SELECT 'pat', conv_id::VARCHAR || '-' || turn::VARCHAR, NULL, text FROM conversations""",
    "unique_kw": """
        SELECT source, id, category, count(*) AS n_kw, count(DISTINCT keyword) AS n_unique
        FROM hits GROUP BY ALL""",
}

_NEEDS = {"dictionary": ["keywords_raw"], "llm_labels": ["hits"], "unique_kw": ["hits"]}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views and those they need."""
    ordered: list[str] = []
    for name in names.split():
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    return f"WITH {ctes} {body}" if ctes else body


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf}/{name}.parquet")


def hits(spark: SparkSession, sf: str) -> DataFrame:
    """One row per keyword occurrence: id, page, category, keyword, source."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    order = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    return (
        line.join(part, "l_partkey").join(order, "l_orderkey")
        .select(
            F.col("o_custkey").alias("id"),
            F.col("l_orderkey").alias("page"),
            F.col("p_brand").alias("category"),
            F.col("p_name").alias("keyword"),
            F.when(F.col("l_linestatus") == "O", "web").otherwise("pat").alias("source"),
        )
    )


def firms(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, "n_nationkey").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("canton"),
        F.floor(F.abs("c_acctbal")).cast("long").alias("n_employees"),
    )


def run(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl log. The first page of a firm (dl_rank 0) is found without ranking its pages."""
    event = table(spark, sf, "events")
    first = event.groupBy("user_id").agg(F.min("event_id").alias("first_id"))
    kind = F.col("event_type")
    return event.join(first, "user_id").select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("url"),
        "ts",
        F.when(F.col("event_id") == F.col("first_id"), 0).otherwise(1).alias("dl_rank"),
        F.when(kind == "view", "None").when(kind != "click", kind).alias("error"),
        F.date_format("ts", "EEE MMM dd HH:mm:ss yyyy").alias("timestamp"),
    )


def page_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        F.col("doc_id").alias("url"), F.col("source").alias("id"), F.col("lang").alias("canton"), "text"
    )


def page_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The pages without their texts."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("url"), F.col("source").alias("id"), F.col("lang").alias("canton")
    )


def keywords_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KEYWORD_ROWS, "category string, prompt_output string")


def brand_phrases(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary file as large as ``part``: padded, capitalised, repeated phrases."""
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("category"),
        F.concat(
            F.lit("  "), F.upper("p_name"), F.lit(", "), F.col("p_type"), F.lit(", abc,  "), F.lower("p_brand")
        ).alias("prompt_output"),
    )


def run_links(spark: SparkSession, sf: str) -> DataFrame:
    page = table(spark, sf, "pages").select("page_id", "url")
    n = page.agg(F.count("*").alias("n_pages")).scalar()
    first = page.select(F.col("page_id").alias("k1"), F.col("url").alias("url1"))
    second = page.select(F.col("page_id").alias("k2"), F.col("url").alias("url2"))
    return (
        page.withColumn("k1", (F.col("page_id") * 7 + 1) % n)
        .withColumn("k2", (F.col("page_id") * 13 + 5) % n)
        .join(first, "k1").join(second, "k2")
        .select(
            "page_id", "url",
            F.concat(F.lit('["'), "url1", F.lit('", "'), "url2", F.lit('"]')).alias("links"),
        )
    )


def linked_firms(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with the firm they belong to: its domain, which is also its name."""
    return run_links(spark, sf).withColumn("id", domain(F.col("url"))).withColumn("name", F.col("id"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


def categories(spark: SparkSession, sf: str) -> DataFrame:
    """The first vector of each label stands for the label."""
    return vectors(spark, sf).groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))


def llm_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in answers: categories with two or more unique keywords over both sources."""
    return (
        hits(spark, sf).groupBy("id", "category").agg(F.count_distinct("keyword").alias("n"))
        .filter("n >= 2").select("id", "category")
    )


def corpora(spark: SparkSession, sf: str) -> DataFrame:
    """Two whole corpora in one table: crawled documents (web) and conversations (pat)."""
    docs = table(spark, sf, "documents").select(
        F.lit("web").alias("corpus"), F.col("doc_id").cast("string").alias("doc"), "lang", "text"
    )
    talk = table(spark, sf, "conversations").select(
        F.lit("pat").alias("corpus"),
        F.concat_ws("-", "conv_id", "turn").alias("doc"),
        F.lit(None).cast("string").alias("lang"),
        "text",
    )
    return docs.unionByName(talk)

