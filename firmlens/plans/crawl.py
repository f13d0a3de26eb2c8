"""Queries over the crawl log and the hyperlinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens.functions import text as tx
from firmlens.operators import crawl, links, sampling
from firmlens.operators import firms as fo
from firmlens.plans import bindings as b
from firmlens.plans.registry import query, rounded

ERRORS = """SELECT error, count(*) AS "count", round_even(count(*) * 100 / sum(count(*)) OVER (), 2) AS percent
    FROM run WHERE dl_rank = 0 GROUP BY error"""
SUBPAGES = """SELECT id, count(*) - 1 AS "count" FROM run WHERE error IS NOT NULL GROUP BY id HAVING count(*) > 1"""


@query("error_percent", ERRORS, "run")
def error_percent(spark, sf):
    return crawl.error_percent(b.run(spark, sf))


@query("subpage_counts", SUBPAGES, "run")
def subpage_counts(spark, sf):
    return crawl.subpage_counts(b.run(spark, sf))


@query("run_summary", f"""
    SELECT date_trunc('second', min(ts)) AS start_time, date_trunc('second', max(ts)) AS end_time,
           count(DISTINCT id) AS n_companies,
           date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) AS seconds,
           (SELECT round(avg("count"), 6) FROM ({SUBPAGES})) AS mean_subpages FROM run""", "run")
def run_summary(spark, sf):
    return rounded(crawl.run_summary(b.run(spark, sf)))


@query("run_top_errors", f"SELECT * FROM ({ERRORS}) ORDER BY \"count\" DESC, error NULLS FIRST LIMIT 5", "run")
def run_top_errors(spark, sf):
    return crawl.top_errors(b.run(spark, sf))


DOMAIN = "regexp_extract({}, '^\\s*(https?://)?(www\\.)?([^/]*)', 3)"
EDGES = f""", p AS (SELECT {DOMAIN.format('url')} AS src, links FROM run_links),
    e AS (SELECT DISTINCT src, {DOMAIN.format('link')} AS dst FROM (
            SELECT src, unnest(string_split(regexp_replace(links, '[ "\\[\\]]', '', 'g'), ',')) AS link FROM p)
          WHERE src NOT IN ('google.com', 'accounts.google.com')),
    edges AS (SELECT src, dst FROM e WHERE dst <> '' AND dst IN (SELECT src FROM p))"""


@query("normalize_domain", f"SELECT page_id, url, {DOMAIN.format('url')} AS domain FROM pages")
def normalize_domain(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", "url", tx.domain(F.col("url")).alias("domain"))


@query("firm_url", f"SELECT {DOMAIN.format('url')} AS id, min(url) AS url FROM run_links GROUP BY 1", "run_links")
def firm_url(spark, sf):
    return fo.firm_url(b.linked_firms(spark, sf))


def edges(spark, sf):
    return links.link_edges(b.linked_firms(spark, sf))


@query("link_edges", EDGES + " SELECT src, dst FROM edges", "run_links")
def link_edges(spark, sf):
    return edges(spark, sf)


@query("link_edges_names", f""", p AS (
      SELECT {DOMAIN.format('url')} AS domain, {DOMAIN.format('url')} || ' ' || (page_id % 2) AS name, links
      FROM run_links WHERE page_id % 5 <> 0),
    e AS (SELECT DISTINCT name AS src, {DOMAIN.format('link')} AS target FROM (
            SELECT name, domain, unnest(string_split(regexp_replace(links, '[ "\\[\\]]', '', 'g'), ',')) AS link FROM p)
          WHERE domain NOT IN ('google.com', 'accounts.google.com'))
    SELECT src, dst FROM e JOIN (SELECT DISTINCT domain AS target, name AS dst FROM p) n ON e.target = n.target
    WHERE e.target <> ''""", "run_links")
def link_edges_names(spark, sf):
    """Domains with two names, and pages that failed."""
    pages = b.linked_firms(spark, sf)
    pages = pages.withColumn("name", F.concat("id", F.lit(" "), F.col("page_id") % 2))
    failed = F.when(F.col("page_id") % 5 == 0, "timeout").otherwise("None")
    return links.link_edges(pages.withColumn("error", failed), error="error")


@query("link_relabel", EDGES + f""",
    m AS (SELECT {DOMAIN.format('url')} AS old, 'firm ' || min(page_id) AS new FROM run_links GROUP BY 1)
    SELECT coalesce(a.new, src) AS src, coalesce(c.new, dst) AS dst
    FROM edges LEFT JOIN m a ON a.old = src LEFT JOIN m c ON c.old = dst""", "run_links")
def link_relabel(spark, sf):
    named = b.linked_firms(spark, sf).groupBy(F.col("name").alias("old")).agg(F.min("page_id").alias("page_id"))
    mapping = named.select("old", F.concat(F.lit("firm "), "page_id").alias("new"))
    return links.relabel(edges(spark, sf), mapping)


@query("link_indegree", EDGES + """
    SELECT min(dst) AS dst, n FROM (SELECT dst, count(*) AS n FROM edges GROUP BY dst) GROUP BY n
    ORDER BY n DESC LIMIT 10""", "run_links")
def link_indegree(spark, sf):
    return links.in_degree_ranking(edges(spark, sf))


@query("link_induced", EDGES + " SELECT src, dst FROM edges WHERE dst IN (SELECT src FROM edges)", "run_links")
def link_induced(spark, sf):
    return links.induced(edges(spark, sf))


DEGREES = """SELECT node, count(*) AS degree FROM (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges)
    GROUP BY node"""


@query("link_degrees", EDGES + DEGREES, "run_links")
def link_degrees(spark, sf):
    return links.degrees(edges(spark, sf))


@query("link_degree_histogram", EDGES + f" SELECT degree, count(*) AS n_nodes FROM ({DEGREES}) GROUP BY 1", "run_links")
def link_degree_histogram(spark, sf):
    return links.degree_histogram(edges(spark, sf))


@query("sample_fraction", EDGES + """
    SELECT src, dst FROM edges
    WHERE ('0x' || substr(md5('3|' || src || ' ' || dst), 1, 8))::BIGINT / 4294967296 < 0.5""", "run_links")
def sample_fraction(spark, sf):
    keyed = edges(spark, sf).withColumn("edge", F.concat_ws(" ", "src", "dst"))
    return sampling.sample_fraction(keyed, "edge", 0.5, seed=3).drop("edge")
