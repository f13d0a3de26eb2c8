"""Queries over firm x category counts: panel, distribution, regions, agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlens import sources as src
from firmlens.operators import agreement as ag
from firmlens.operators import distribution as di
from firmlens.operators import firms as fo
from firmlens.operators import regional as re_
from firmlens.operators import sampling
from firmlens.operators import sketches as sk
from firmlens.operators import sweeps as sw
from firmlens.plans import bindings as b
from firmlens.plans.registry import query, rounded

R = b.REGION


def web_counts(spark, sf):
    return fo.unique_keywords(b.hits(spark, sf).filter("source = 'web'"))


def pat_counts(spark, sf):
    return fo.unique_keywords(b.hits(spark, sf).filter("source = 'pat'"))


def located(spark, sf, counts):
    return fo.with_attributes(counts, b.firms(spark, sf).select("id", "canton"))


def source_counts(spark, sf):
    return fo.unique_keywords(b.hits(spark, sf), "source", "id", "category")


def panel(spark, sf):
    return fo.panel_from_counts(b.firms(spark, sf), source_counts(spark, sf))


WEB = "SELECT * FROM unique_kw WHERE source = 'web'"
PAT = "SELECT * FROM unique_kw WHERE source = 'pat'"
LISTS = """SELECT id, list(category ORDER BY category) AS cat_{0}, list(n_kw ORDER BY category)::BIGINT[] AS n_kw_{0},
    list(n_unique ORDER BY category) AS n_unique_kw_{0} FROM unique_kw WHERE source = '{0}' GROUP BY id"""
# Firms on the web with their patent categories, one row of nulls for those without.
LONG_PAT = f""", panel_pat AS (
    SELECT f.id, f.canton, u.category, u.n_kw, u.n_unique
    FROM firms f JOIN (SELECT DISTINCT id FROM ({WEB})) w ON f.id = w.id LEFT JOIN ({PAT}) u ON f.id = u.id)"""
LOCATED = ", located AS (SELECT u.*, f.canton FROM unique_kw u JOIN firms f ON u.id = f.id)"


# Firms.


@query("firm_category_unique", """
    SELECT u.id, category, n_kw, n_unique, name, canton, n_employees
    FROM unique_kw u JOIN firms f ON u.id = f.id WHERE source = 'web'""", "unique_kw firms")
def firm_category_unique(spark, sf):
    return fo.with_attributes(web_counts(spark, sf), b.firms(spark, sf))


@query("firms_with_n_unique", f"""
    SELECT id, list(category ORDER BY category) AS category, count(*) AS n_unique
    FROM ({WEB}) WHERE n_unique >= 2 GROUP BY id""", "unique_kw")
def firms_with_n_unique(spark, sf):
    return fo.firms_with_n_unique(b.hits(spark, sf).filter("source = 'web'"), 2)


@query("firm_lists", LISTS.format("pat"), "unique_kw")
def firm_lists(spark, sf):
    return fo.firm_lists(pat_counts(spark, sf), "pat")


@query("firm_panel", f"""
    SELECT f.*, w.* EXCLUDE (id), p.* EXCLUDE (id) FROM firms f JOIN ({LISTS.format("web")}) w ON f.id = w.id
    LEFT JOIN ({LISTS.format("pat")}) p ON f.id = p.id""", "unique_kw firms")
def firm_panel(spark, sf):
    return panel(spark, sf)


@query("firm_panel_joined", f"""
    SELECT f.*, w.* EXCLUDE (id), p.* EXCLUDE (id) FROM firms f JOIN ({LISTS.format("web")}) w ON f.id = w.id
    LEFT JOIN ({LISTS.format("pat")}) p ON f.id = p.id""", "unique_kw firms")
def firm_panel_joined(spark, sf):
    """The panel from two separate tables of lists."""
    web = fo.firm_lists(web_counts(spark, sf), "web")
    return fo.firm_panel(b.firms(spark, sf), web, fo.firm_lists(pat_counts(spark, sf), "pat"))


@query("firm_publications", """
    SELECT f.id, name, canton, n_employees, 0::BIGINT AS part, publication FROM firms f
    JOIN (SELECT id, list(DISTINCT page ORDER BY page) AS publication FROM hits WHERE source = 'pat' GROUP BY id) p
    ON f.id = p.id""", "hits firms")
def firm_publications(spark, sf):
    held = b.hits(spark, sf).filter("source = 'pat'").select("id", F.col("page").alias("publication")).distinct()
    return fo.publication_lists(held, b.firms(spark, sf))


@query("panel_long", LONG_PAT + f" SELECT id, category, n_kw, n_unique FROM panel_pat WHERE canton <> '{R}'",
       "unique_kw firms")
def panel_long(spark, sf):
    return fo.panel_long(panel(spark, sf), "pat", exclude_canton=R)


APPLICANTS = """SELECT l_orderkey || '-' || l_linenumber AS publication,
    'C' || o_custkey || '; S' || l_suppkey AS applicants FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def patents(spark, sf):
    """Order lines as publications of two applicants each."""
    line = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    order = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return line.join(order, "l_orderkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("publication"), "l_partkey",
        F.concat(F.lit("C"), "o_custkey", F.lit("; S"), "l_suppkey").alias("applicants"))


@query("applicant_explode", f"SELECT publication, unnest(string_split(applicants, '; ')) AS id FROM ({APPLICANTS})")
def applicant_explode(spark, sf):
    return fo.applicants(patents(spark, sf))


@query("filter_id_prefix", f"""
    SELECT DISTINCT id FROM (SELECT unnest(string_split(applicants, '; ')) AS id FROM ({APPLICANTS}))
    WHERE starts_with(id, 'S')""")
def filter_id_prefix(spark, sf):
    return fo.applicants(patents(spark, sf)).filter(F.col("id").startswith("S")).select("id").distinct()


# Distribution.


@query("match_histogram", "SELECT category, n_kw, count(*) AS n_firms FROM unique_kw WHERE source = 'web' GROUP BY ALL",
       "unique_kw")
def match_histogram(spark, sf):
    return di.match_histogram(web_counts(spark, sf), "category")


@query("match_histogram_overall", f"SELECT n_kw, count(*) AS n_firms FROM ({WEB}) GROUP BY ALL", "unique_kw")
def match_histogram_overall(spark, sf):
    return di.match_histogram(web_counts(spark, sf))


def threshold_sql(value: str, thresholds: list[int]) -> str:
    rows = ", ".join(f"({t})" for t in thresholds)
    return f"""SELECT c.category, t.t::BIGINT AS threshold, count(u.id) AS n_firms
        FROM (SELECT DISTINCT category FROM ({WEB})) c CROSS JOIN (VALUES {rows}) t(t)
        LEFT JOIN ({WEB}) u ON u.category = c.category AND u.{value} >= t.t GROUP BY ALL"""


@query("threshold_compare", threshold_sql("n_unique", [1, 3, 5]), "unique_kw")
def threshold_compare(spark, sf):
    return di.threshold_counts(web_counts(spark, sf), [1, 3, 5])


@query("threshold_compare_total", threshold_sql("n_kw", [1, 10, 50]), "unique_kw")
def threshold_compare_total(spark, sf):
    return di.threshold_counts(web_counts(spark, sf), [1, 10, 50], "n_kw")


@query("survival_counts", LONG_PAT + """
    SELECT coalesce(category, 'No category') AS category, coalesce(n_kw, 0)::BIGINT AS n_kw, count(*) AS n_firms
    FROM panel_pat GROUP BY ALL""", "unique_kw firms")
def survival_counts(spark, sf):
    return di.survival_counts(fo.panel_long(panel(spark, sf), "pat"))


@query("survival_curve", f"""
    , h AS (SELECT category, n_unique, count(*) AS n FROM ({PAT}) GROUP BY ALL)
    SELECT a.category, a.n_unique, sum(b.n)::BIGINT AS n_firms
    FROM h a JOIN h b ON a.category = b.category AND b.n_unique >= a.n_unique GROUP BY ALL""", "unique_kw")
def survival_curve(spark, sf):
    return di.survival_curve(pat_counts(spark, sf))


@query("elbow_curve", f"""
    SELECT t.t AS threshold, count(u.id) AS n_matches
    FROM range(1, 30) t(t) LEFT JOIN ({PAT}) u ON u.n_unique >= t.t GROUP BY 1""", "unique_kw")
def elbow_curve(spark, sf):
    return di.elbow_curve(pat_counts(spark, sf), 29)


@query("threshold_ratio", f"""
    SELECT count(*) FILTER (n_unique >= 1) AS n_loose, count(*) FILTER (n_unique >= 3) AS n_strict,
           round(count(*) FILTER (n_unique >= 3) / count(*) FILTER (n_unique >= 1), 6) AS ratio FROM ({PAT})""",
       "unique_kw")
def threshold_ratio(spark, sf):
    return rounded(di.threshold_ratio(pat_counts(spark, sf), 1, 3))


@query("category_cooccurrence", f"""
    , p AS (SELECT DISTINCT id, category FROM ({WEB})), c AS (SELECT DISTINCT category FROM p),
    n AS (SELECT a.category, b.category AS other, count(*) AS n FROM p a JOIN p b ON a.id = b.id GROUP BY ALL)
    SELECT a.category, b.category AS other,
           CASE WHEN a.category = b.category THEN 0 ELSE coalesce(n.n, 0) END::BIGINT AS n_firms
    FROM c a CROSS JOIN c b LEFT JOIN n ON n.category = a.category AND n.other = b.category""", "unique_kw")
def category_cooccurrence(spark, sf):
    return di.category_cooccurrence(b.hits(spark, sf).filter("source = 'web'").select("id", "category"), zeros=True)


@query("rank_keywords", """
    SELECT keyword, n, dense_rank() OVER (ORDER BY n DESC) AS rank
    FROM (SELECT keyword, count(*) AS n FROM hits GROUP BY keyword)""", "hits")
def rank_keywords(spark, sf):
    return di.rank_keywords(b.hits(spark, sf))


TOP5 = f"SELECT category, count(*) AS n FROM ({WEB}) GROUP BY 1 ORDER BY n DESC, category LIMIT 5"


@query("topk_categories", TOP5, "unique_kw")
def topk_categories(spark, sf):
    return di.top_categories(web_counts(spark, sf), 5)


@query("topk_curves", f"""
    , h AS (SELECT category, n_unique, count(*) AS n FROM ({WEB}) GROUP BY ALL)
    SELECT a.category, a.n_unique, sum(b.n)::BIGINT AS n_firms
    FROM h a JOIN h b ON a.category = b.category AND b.n_unique >= a.n_unique
    WHERE a.category IN (SELECT category FROM ({TOP5})) GROUP BY ALL""", "unique_kw")
def topk_curves(spark, sf):
    counts = web_counts(spark, sf)
    return di.survival_curve(counts).join(di.top_categories(counts, 5), "category", "left_semi")


@query("category_drilldown", f"""
    SELECT u.id, category, n_kw, n_unique, url FROM ({PAT}) u
    JOIN (SELECT id, min(page) AS url FROM hits GROUP BY id) p ON u.id = p.id
    WHERE category = 'Brand#5' AND n_unique >= 2""", "unique_kw hits")
def category_drilldown(spark, sf):
    urls = fo.firm_url(b.hits(spark, sf).select("id", F.col("page").alias("url")))
    return di.category_drilldown(pat_counts(spark, sf), urls, "Brand#5", 2)


@query("review_sample", f"""
    , own AS (SELECT f.id, min(u.category) AS category FROM firms f LEFT JOIN ({WEB}) u ON f.id = u.id GROUP BY f.id),
    n AS (SELECT o.id, category, name AS url, row_number() OVER (PARTITION BY category ORDER BY o.id) AS rn
          FROM own o JOIN firms f ON o.id = f.id)
    SELECT coalesce(category, 'None') AS category, id, url FROM n
    WHERE rn <= CASE WHEN category IS NULL THEN 40 ELSE 10 END""", "unique_kw firms")
def review_sample(spark, sf):
    firms = b.firms(spark, sf)
    found = b.hits(spark, sf).filter("source = 'web'").groupBy("id").agg(F.min("category").alias("category"))
    labels = firms.select("id").join(found, "id", "left")
    return sampling.review_sample(labels, firms.select("id", F.col("name").alias("url")))


# Regions.


def rta_sql(source: str, thresh: int, totals: str, extra: str = "TRUE") -> str:
    return f"""{LOCATED},
    c AS (SELECT category, count(*) FILTER (canton = '{R}') AS count_region,
                 count(*) FILTER (canton <> '{R}') AS count_rest
          FROM located WHERE source = '{source}' AND n_unique >= {thresh} GROUP BY category),
    k AS (SELECT * FROM c WHERE count_region > 0 AND count_rest > 0), t AS ({totals}),
    s AS (SELECT k.*, count_region / n_region AS percent_region, count_rest / n_rest AS percent_rest FROM k, t)
    SELECT category, count_region, count_rest, round(percent_region, 6) AS percent_region,
           round(percent_rest, 6) AS percent_rest, round(percent_region / percent_rest, 6) AS ratio,
           round(log10(percent_region / percent_rest), 6) AS log_rta FROM s WHERE {extra}"""


HITS_TOTAL = "SELECT sum(count_region)::DOUBLE AS n_region, sum(count_rest)::DOUBLE AS n_rest FROM k"
FIRMS_TOTAL = f"""SELECT count(DISTINCT id) FILTER (canton = '{R}') AS n_region,
    count(DISTINCT id) FILTER (canton <> '{R}') AS n_rest FROM located WHERE source = '{{}}'"""


@query("rta_share_of_hits", rta_sql("web", 2, HITS_TOTAL), "unique_kw firms")
def rta_share_of_hits(spark, sf):
    return rounded(re_.rta_share_of_hits(located(spark, sf, web_counts(spark, sf)), R, 2))


@query("rta_share_of_firms", rta_sql("web", 1, FIRMS_TOTAL.format("web"), "count_region > 10"), "unique_kw firms")
def rta_share_of_firms(spark, sf):
    return rounded(re_.rta_share_of_firms(located(spark, sf, web_counts(spark, sf)), R, 1, min_count=10))


@query("rta_share_of_rows", LONG_PAT + f""",
    a AS (SELECT category, count(*) FILTER (n_unique >= 2) AS count_rest,
            count(*) FILTER (n_unique >= 2) / (SELECT count(*) FROM panel_pat WHERE canton <> '{R}')
            AS percent_rest FROM panel_pat WHERE canton <> '{R}' GROUP BY 1 HAVING count(*) FILTER (n_unique >= 2) > 0),
    r AS (SELECT category, count(*) FILTER (n_unique >= 2) AS count_region,
            count(*) FILTER (n_unique >= 2) / (SELECT count(*) FROM panel_pat WHERE canton = '{R}')
            AS percent_region FROM panel_pat WHERE canton = '{R}' GROUP BY 1 HAVING count(*) FILTER (n_unique >= 2) > 0)
    SELECT a.category, count_region, count_rest, round(percent_rest, 6) AS percent_rest, round(percent_region, 6) AS percent_region,
           round(percent_region / percent_rest, 6) AS ratio, round(log10(percent_region / percent_rest), 6) AS log_rta
    FROM a JOIN r ON a.category = r.category""", "unique_kw firms")
def rta_share_of_rows(spark, sf):
    return rounded(re_.rta_share_of_rows(fo.panel_long(panel(spark, sf), "pat", keep=["canton"]), R, 2))


@query("region_report", f"""{LOCATED},
    a AS (SELECT category, count(*) FILTER (n_unique >= 2) AS n, (SELECT count(*) FROM located WHERE source = 'web') AS t
          FROM located WHERE source = 'web' GROUP BY 1),
    r AS (SELECT category, count(*) FILTER (n_unique >= 2) AS n,
                 (SELECT count(*) FROM located WHERE source = 'web' AND canton = '{R}') AS t
          FROM located WHERE source = 'web' AND canton = '{R}' GROUP BY 1)
    SELECT r.category, r.n AS n_firms, round(r.n / r.t, 6) AS percent, round((r.n / r.t) / (a.n / a.t), 6) AS ratio
    FROM r JOIN a ON r.category = a.category WHERE r.n > 0""", "unique_kw firms")
def region_report(spark, sf):
    return rounded(re_.region_report(fo.panel_long(panel(spark, sf), "web", keep=["canton"]), R, 2))


def rta_sources_sql() -> str:
    sides = {s: rta_sql(s, 1, FIRMS_TOTAL.format(s)) for s in ("pat", "web")}
    views = "WITH unique_kw AS (SELECT * FROM unique_kw), firms AS (SELECT * FROM firms)"
    renamed = ", ".join(
        f"w.{c} AS {c}_web" for c in ("count_region", "count_rest", "percent_region", "percent_rest", "ratio", "log_rta"))
    return f"""SELECT p.*, {renamed} FROM ({views} {sides["pat"]}) p JOIN ({views} {sides["web"]}) w
        ON p.category = w.category"""


@query("rta_sources", rta_sources_sql(), "unique_kw firms")
def rta_sources(spark, sf):
    return rounded(re_.rta_by_source(located(spark, sf, source_counts(spark, sf)), R, 1))


@query("rta_all_regions", f"""{LOCATED}, u AS (SELECT * FROM located WHERE source = 'web' AND canton IS NOT NULL),
    c AS (SELECT canton, category, count(*) AS count_region FROM u GROUP BY ALL),
    f AS (SELECT canton, count(DISTINCT id) AS n_region FROM u GROUP BY 1),
    j AS (SELECT c.canton, c.category, count_region, a.n - count_region AS count_rest, n_region,
                 (SELECT sum(n_region) FROM f)::BIGINT - n_region AS n_rest
          FROM c JOIN f ON c.canton = f.canton
          JOIN (SELECT category, sum(count_region)::BIGINT AS n FROM c GROUP BY 1) a ON a.category = c.category),
    s AS (SELECT *, count_region / n_region AS p, count_rest / n_rest AS q FROM j WHERE count_rest > 0)
    SELECT canton, category, count_region, count_rest, round(p, 6) AS percent_region, round(q, 6) AS percent_rest,
           round(p / q, 6) AS ratio, round(log10(p / q), 6) AS log_rta FROM s""", "unique_kw firms")
def rta_all_regions(spark, sf):
    return rounded(re_.rta_all_regions(located(spark, sf, web_counts(spark, sf)), 1))


# Agreement.

SETS = """, s AS (SELECT id, list_sort(list(DISTINCT category) FILTER (source = 'web')) AS category_web,
                         list_sort(list(DISTINCT category) FILTER (source = 'pat')) AS category_pat
                  FROM hits GROUP BY id),
    f AS (SELECT * FROM s WHERE len(category_web) > 0 AND len(category_pat) > 0),
    n AS (SELECT *, len(list_intersect(category_web, category_pat)) AS common,
                 len(list_distinct(list_concat(category_web, category_pat))) AS whole FROM f)"""


def source_sets(spark, sf):
    return ag.paired_sets(ag.source_flags(b.hits(spark, sf)), "category_web", "category_pat")


@query("jaccard_sources", SETS + """
    SELECT id, category_web, category_pat, round(common / whole, 6) AS jaccard_similarity FROM n""", "hits")
def jaccard_sources(spark, sf):
    return rounded(ag.with_jaccard(source_sets(spark, sf), "category_web", "category_pat"))


@query("overlap_shares", SETS + """
    SELECT id, category_web, category_pat, round(common / len(category_pat), 6) AS p_web_given_pat,
           round(common / len(category_web), 6) AS p_pat_given_web FROM n""", "hits")
def overlap_shares(spark, sf):
    return rounded(ag.overlap_shares(source_sets(spark, sf), "category_web", "category_pat"))


@query("cond_probability", """
    , p AS (SELECT id, category, max((source = 'web')::INT) AS a, max((source = 'pat')::INT) AS b FROM hits GROUP BY ALL),
    k AS (SELECT *, max(a) OVER (PARTITION BY id) + max(b) OVER (PARTITION BY id) AS sides FROM p)
    SELECT category, round(coalesce(sum(a * b) / nullif(sum(a), 0), 0), 6) AS p_b_given_a,
           round(coalesce(sum(a * b) / nullif(sum(b), 0), 0), 6) AS p_a_given_b FROM k WHERE sides = 2 GROUP BY 1""",
       "hits")
def cond_probability(spark, sf):
    return rounded(ag.conditional_probabilities(ag.source_flags(b.hits(spark, sf))))


@query("avg_categories", SETS + """
    SELECT round(avg(len(category_web)), 6) AS avg_category_web, round(avg(len(category_pat)), 6) AS avg_category_pat
    FROM n""", "hits")
def avg_categories(spark, sf):
    return rounded(ag.mean_sizes(source_sets(spark, sf), "category_web", "category_pat"))


SHARES = """, t AS (SELECT count(DISTINCT id) FILTER (source = 'web') AS web,
                           count(DISTINCT id) FILTER (source = 'pat') AS pat FROM unique_kw),
    c AS (SELECT category, count(*) FILTER (source = 'web') AS web, count(*) FILTER (source = 'pat') AS pat
          FROM unique_kw WHERE n_unique >= 2 GROUP BY 1),
    x AS (SELECT category, c.web / t.web AS percent_web, c.pat / t.pat AS percent_pat FROM c, t
          WHERE c.web > 0 AND c.pat > 0)"""


def shares(spark, sf):
    return ag.source_shares(source_counts(spark, sf), 2)


@query("source_share", SHARES + """
    SELECT category, round(percent_web, 6) AS percent_web, round(percent_pat, 6) AS percent_pat,
           round(abs(percent_pat - percent_web), 6) AS difference FROM x""", "unique_kw")
def source_share(spark, sf):
    return rounded(shares(spark, sf))


@query("source_correlation", SHARES + """,
    r AS (SELECT percent_web, percent_pat,
                 rank() OVER (ORDER BY percent_web) + (count(*) OVER (PARTITION BY percent_web) - 1) / 2 AS rw,
                 rank() OVER (ORDER BY percent_pat) + (count(*) OVER (PARTITION BY percent_pat) - 1) / 2 AS rp FROM x)
    SELECT round(corr(percent_pat, percent_web), 6) AS pearson, round(corr(rp, rw), 6) AS spearman FROM r""",
       "unique_kw")
def source_correlation(spark, sf):
    return rounded(ag.correlations(shares(spark, sf), "percent_pat", "percent_web"))


RANKS = SHARES + """, k AS (SELECT category, row_number() OVER (ORDER BY percent_web DESC, category) AS rank_web,
    row_number() OVER (ORDER BY percent_pat DESC, category) AS rank_pat FROM x)"""


@query("rank_categories", RANKS + " SELECT category, rank_web, rank_pat FROM k", "unique_kw")
def rank_categories(spark, sf):
    return ag.rank_shift(shares(spark, sf)).drop("difference")


@query("rank_shift", RANKS + """
    SELECT category, rank_web, rank_pat, abs(rank_pat - rank_web) AS difference FROM k
    ORDER BY difference DESC, category LIMIT 10""", "unique_kw")
def rank_shift(spark, sf):
    return ag.rank_shift(shares(spark, sf)).orderBy(F.desc("difference"), "category").limit(10)


@query("word_counts_compare", """
    SELECT keyword, count(*) FILTER (source = 'web') AS n_web, count(*) FILTER (source = 'pat') AS n_pat,
           abs(count(*) FILTER (source = 'web') - count(*) FILTER (source = 'pat')) AS diff
    FROM hits WHERE category = 'Brand#7' GROUP BY 1""", "hits")
def word_counts_compare(spark, sf):
    return ag.word_counts(b.hits(spark, sf), "Brand#7")


@query("word_freq_compare", """
    , t AS (SELECT count(*) FILTER (source = 'web') AS web, count(*) FILTER (source = 'pat') AS pat FROM hits),
    w AS (SELECT keyword, count(DISTINCT page) FILTER (source = 'web') / t.web AS fw,
                 count(DISTINCT page) FILTER (source = 'pat') / t.pat AS fp FROM hits, t GROUP BY keyword, t.web, t.pat)
    SELECT w.keyword, round(fw, 6) AS freq_web, round(fp, 6) AS freq_pat, round(abs(fw - fp), 6) AS difference, category
    FROM w JOIN (SELECT DISTINCT p_name AS keyword, p_brand AS category FROM part) d ON w.keyword = d.keyword""", "hits")
def word_freq_compare(spark, sf):
    lookup = b.table(spark, sf, "part").select(
        F.col("p_name").alias("keyword"), F.col("p_brand").alias("category")).distinct()
    return rounded(ag.word_frequencies(b.hits(spark, sf), lookup))


def agreement_sql(thresh: int) -> str:
    return f"""
    , l AS (SELECT id, list_sort(list(category)) AS fields FROM llm_labels GROUP BY id),
    k AS (SELECT id, list_sort(list(category)) AS category FROM ({WEB}) WHERE n_unique >= {thresh} GROUP BY id)
    SELECT l.id, fields, category, round(CASE WHEN fields = category THEN 1 ELSE
      len(list_intersect(fields, category)) / len(list_distinct(list_concat(fields, category))) END, 6) AS jac_sim
    FROM l JOIN k ON l.id = k.id"""


@query("llm_agreement", agreement_sql(1), "llm_labels unique_kw")
def llm_agreement(spark, sf):
    labels = b.hits(spark, sf).filter("source = 'web'").select("id", "category")
    return rounded(ag.answer_agreement(b.llm_labels(spark, sf), labels))


@query("llm_agreement_strict", agreement_sql(2), "llm_labels unique_kw")
def llm_agreement_strict(spark, sf):
    labels = web_counts(spark, sf).filter("n_unique >= 2").select("id", "category")
    return rounded(ag.answer_agreement(b.llm_labels(spark, sf), labels))


@query("set_overlap", """
    , w AS (SELECT DISTINCT id FROM hits WHERE source = 'web'), p AS (SELECT DISTINCT id FROM hits WHERE source = 'pat'),
    c AS (SELECT (SELECT count(*) FROM w) AS n_a, (SELECT count(*) FROM p) AS n_b,
                 (SELECT count(*) FROM w JOIN p ON w.id = p.id) AS n_both)
    SELECT n_a, n_b, n_both, round(n_both / n_a, 6) AS share_of_a FROM c""", "hits")
def set_overlap(spark, sf):
    hits = b.hits(spark, sf)
    return rounded(ag.set_overlap(
        hits.filter("source = 'web'").select("id"), hits.filter("source = 'pat'").select("id")))


# One pass for many thresholds; counts from kept sketches.


@query("threshold_sweep", """
    SELECT t::INTEGER AS threshold, source, count(*) AS n_rows, sum(n_kw)::BIGINT AS n_kw, count(DISTINCT id) AS n_firms,
           count(DISTINCT category) AS n_categories, round(avg(n_kw), 6) AS mean_kw, max(n_kw) AS most_kw
    FROM unique_kw, range(1, 9) r(t) WHERE n_unique >= t GROUP BY t, source""", "unique_kw")
def threshold_sweep(spark, sf):
    return rounded(sw.sweep(
        source_counts(spark, sf), "n_unique", range(1, 9), ["source"], n_rows=sw.rows(), n_kw=sw.total("n_kw"),
        n_firms=sw.different("id"), n_categories=sw.different("category"), mean_kw=sw.mean("n_kw"), most_kw=sw.greatest("n_kw"),
    ))


@query("distinct_sketches", """
    SELECT category, count(DISTINCT id) AS n_firms, count(DISTINCT keyword) AS n_keywords, TRUE AS firms_near, TRUE AS keywords_near
    FROM hits GROUP BY category""", "hits")
def distinct_sketches(spark, sf):
    """Kept by category and source, added up over sources; the exact counts stand beside."""
    hits = b.hits(spark, sf)
    exact = hits.groupBy("category").agg(F.count_distinct("id").alias("n_firms"), F.count_distinct("keyword").alias("n_keywords"))
    for item, name in (("id", "firms"), ("keyword", "keywords")):
        kept = src.stored(sk.distinct_sketches(hits, ["category", "source"], item), "sketches")
        found = sk.estimates(sk.union_sketches(kept, ["category"]), "about")
        near = F.abs(F.col("about") - F.col(f"n_{name}")) <= sk.relative_error() * F.col(f"n_{name}") + 1
        exact = exact.join(found, "category").withColumn(f"{name}_near", near).drop("about")
    return exact


@query("review_quotas")
def review_quotas(spark, sf):
    firms = b.firms(spark, sf)
    found = b.hits(spark, sf).filter("source = 'web'").select("id", "category").distinct()
    return sampling.review_quotas(firms.select("id").join(found, "id", "left"), firms.select("id", F.col("name").alias("url")))
