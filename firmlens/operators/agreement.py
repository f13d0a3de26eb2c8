"""How far two sources or two labellings agree.

Both sides travel in one table of flags, (id, category, a, b) with 0/1 in ``a`` and
``b``, so the sides are never joined and data that comes from one scan is read once.
Sets per firm hold at most one entry per category of the dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.functions.sets import jaccard, n_common, n_items, same_set, share
from firmlens.operators.firms import firm_flags, unique_keywords
from firmlens.sources.files import stored


def label_flags(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Flags of two labellings given as tables (id, category)."""
    both = a.select(key, "category", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        b.select(key, "category", F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    return both.groupBy(key, "category").agg(F.max("a").alias("a"), F.max("b").alias("b"))


def source_flags(hits: DataFrame, thresh: int = 1) -> DataFrame:
    """Flags a = web, b = patents from hits that carry their ``source``."""
    if thresh <= 1:
        pairs = hits
    else:
        counts = unique_keywords(hits, "source", "id", "category")
        pairs = counts.filter(F.col("n_unique") >= thresh)
    web, pat = (F.max((F.col("source") == s).cast("int")) for s in ("web", "pat"))
    return pairs.groupBy("id", "category").agg(web.alias("a"), pat.alias("b"))


def paired_sets(flags: DataFrame, name_a: str, name_b: str, key: str = "id") -> DataFrame:
    """Both sorted category sets of the keys that have one on each side."""
    side = {n: F.sort_array(F.collect_list(F.when(F.col(f) == 1, F.col("category")))).alias(n)
            for f, n in (("a", name_a), ("b", name_b))}
    sets = flags.groupBy(key).agg(side[name_a], side[name_b])
    return sets.filter((F.size(name_a) > 0) & (F.size(name_b) > 0))


def with_jaccard(sets: DataFrame, a: str, b: str) -> DataFrame:
    return sets.withColumn("jaccard_similarity", jaccard(F.col(a), F.col(b)))


def overlap_shares(sets: DataFrame, web: str, pat: str) -> DataFrame:
    """The common categories as a share of each side."""
    common = n_common(F.col(web), F.col(pat))
    return sets.withColumn("p_web_given_pat", share(common, n_items(F.col(pat)))).withColumn(
        "p_pat_given_web", share(common, n_items(F.col(web)))
    )


def mean_sizes(sets: DataFrame, *columns: str) -> DataFrame:
    return sets.agg(*[F.avg(n_items(F.col(c))).alias(f"avg_{c}") for c in columns])


def conditional_probabilities(flags: DataFrame, key: str = "id") -> DataFrame:
    """Per category P(in b | in a) and P(in a | in b) over keys found on both sides; 0 without a case.

    The window spans the categories of one key, never more than the dictionary has.
    """
    of_key = W.partitionBy(key)
    kept = flags.withColumn("sides", F.max("a").over(of_key) + F.max("b").over(of_key)).filter("sides = 2")
    counted = kept.groupBy("category").agg(
        F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.sum(F.col("a") * F.col("b")).alias("n_both")
    )
    zero = F.lit(0.0)
    return counted.select(
        "category",
        F.coalesce(share(F.col("n_both"), F.col("n_a")), zero).alias("p_b_given_a"),
        F.coalesce(share(F.col("n_both"), F.col("n_b")), zero).alias("p_a_given_b"),
    )


def source_shares(counts: DataFrame, thresh: int) -> DataFrame:
    """Share of each source's firms active per category, and the absolute difference.

    ``counts`` has one row per (source, id, category) with ``n_unique``; the firms of a
    source are counted before the threshold. Categories of one source only drop out.
    """
    web, pat = F.col("source") == "web", F.col("source") == "pat"
    enough = F.col("n_unique") >= thresh
    firms = firm_flags(counts, "id", web=web, pat=pat)
    totals = firms.agg(F.struct(F.count_if("web").alias("web"), F.count_if("pat").alias("pat"))).scalar()
    found = counts.groupBy("category").agg(
        F.count_if(enough & web).alias("n_web"), F.count_if(enough & pat).alias("n_pat")
    ).filter("n_web > 0 AND n_pat > 0")
    shares = found.select(
        "category",
        share(F.col("n_web"), totals.getField("web")).alias("percent_web"),
        share(F.col("n_pat"), totals.getField("pat")).alias("percent_pat"),
    )
    return shares.withColumn("difference", F.abs(F.col("percent_pat") - F.col("percent_web")))


def average_rank(column: str) -> Column:
    """Rank in which tied rows share the mean of their positions."""
    ties = W.partitionBy(column)
    return F.rank().over(W.orderBy(column)) + (F.count("*").over(ties) - 1) / 2


def correlations(table: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and Spearman correlation of two columns of a per-category table.

    Ranking orders all rows in one task, so the table must be one row per category.
    """
    ranked = table.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        x, y, average_rank(x).alias("rank_x"), average_rank(y).alias("rank_y")
    )
    return ranked.agg(F.corr(x, y).alias("pearson"), F.corr("rank_x", "rank_y").alias("spearman"))


def rank_shift(shares: DataFrame) -> DataFrame:
    """Rank of every category in both sources and how far it moves between them.

    ``shares`` has one row per category, which bounds the ordering window.
    """
    def rank(column: str) -> Column:
        return F.row_number().over(W.orderBy(F.desc(column), "category")).cast("long")

    ranked = shares.select("category", rank("percent_web").alias("rank_web"), rank("percent_pat").alias("rank_pat"))
    return ranked.withColumn("difference", F.abs(F.col("rank_pat") - F.col("rank_web")))


def word_counts(hits: DataFrame, category: str) -> DataFrame:
    """Occurrences of the keywords of one category on websites and in patents."""
    counted = hits.filter(F.col("category") == category).groupBy("keyword").agg(
        F.count_if(F.col("source") == "web").alias("n_web"),
        F.count_if(F.col("source") == "pat").alias("n_pat"),
    )
    return counted.withColumn("diff", F.abs(F.col("n_web") - F.col("n_pat")))


def word_frequencies(hits: DataFrame, lookup: DataFrame, page: str = "page") -> DataFrame:
    """Pages with a keyword over all rows of the source, for both sources, with the
    categories of the keyword."""
    web, pat = F.col("source") == "web", F.col("source") == "pat"
    # A number of its own keeps adaptive execution from joining the parts to large ones, whose pages make large tables.
    parts = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = hits.select("keyword", "source", page).repartition(parts, "keyword", page)
    pages = dealt.groupBy("keyword", page).agg(F.count_if(web).alias("web"), F.count_if(pat).alias("pat"))
    counted = pages.groupBy("keyword").agg(
        F.count_if(F.col("web") > 0).alias("n_web"), F.count_if(F.col("pat") > 0).alias("n_pat"),
        F.sum("web").alias("web"), F.sum("pat").alias("pat"),
    )
    pages = stored(counted, "word-pages")  # a row for each keyword, from one pass; the totals are its sums
    rows = pages.agg(F.struct(F.sum("web").alias("web"), F.sum("pat").alias("pat"))).scalar()
    frequencies = pages.select(
        "keyword",
        F.coalesce(share(F.col("n_web"), rows.getField("web")), F.lit(0.0)).alias("freq_web"),
        F.coalesce(share(F.col("n_pat"), rows.getField("pat")), F.lit(0.0)).alias("freq_pat"),
    )
    difference = F.abs(F.col("freq_web") - F.col("freq_pat"))
    return frequencies.withColumn("difference", difference).join(lookup, "keyword")


def answer_agreement(answers: DataFrame, keyword_labels: DataFrame) -> DataFrame:
    """Jaccard similarity of answered and keyword categories; equal sets count as 1."""
    sets = paired_sets(label_flags(answers, keyword_labels), "fields", "category")
    return sets.withColumn(
        "jac_sim",
        F.when(same_set(F.col("fields"), F.col("category")), 1.0)
        .otherwise(jaccard(F.col("category"), F.col("fields"))),
    )


def set_overlap(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Size of both key sets, their intersection, and its share of ``a``."""
    flags = label_flags(a.withColumn("category", F.lit(0)), b.withColumn("category", F.lit(0)), key)
    counted = flags.agg(
        F.count_if(F.col("a") == 1).alias("n_a"), F.count_if(F.col("b") == 1).alias("n_b"),
        F.count_if(F.col("a") + F.col("b") == 2).alias("n_both"),
    )
    return counted.withColumn("share_of_a", share(F.col("n_both"), F.col("n_a")))
