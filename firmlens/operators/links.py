"""Hyperlinks between firms as an edge table (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.functions.text import domain
from firmlens.sources.files import stored

# Link sources that are no firms.
NOT_FIRMS = ["google.com", "accounts.google.com"]


def page_links(pages: DataFrame) -> DataFrame:
    """Distinct (id, name, domain, target domain) of a crawl with ``links`` as quoted, bracketed text."""
    link_list = F.split(F.regexp_replace(F.col("links").cast("string"), r'[ "\[\]]', ""), ",")
    return (
        pages.select("id", "name", domain(F.col("url")).alias("domain"), F.explode(link_list).alias("link"))
        .filter(~F.col("domain").isin(NOT_FIRMS))
        .select("id", "name", "domain", domain(F.col("link")).alias("target"))
        .filter(F.col("target") != "")
        .distinct()
    )


def link_edges(pages: DataFrame, error: str | None = None) -> DataFrame:
    """Firm to firm edges, one per linking firm and linked domain.

    Links are reduced to distinct domains before any join. Only domains that belong to a
    crawled firm are kept; a domain with several firm names gives an edge to each. With an
    ``error`` column only pages that say "None" there count. The names are written before
    they are joined, so that a much linked domain is split.
    """
    if error is not None:
        pages = pages.filter(F.col(error) == "None")
    names = pages.select(domain(F.col("url")).alias("target"), F.col("name").alias("dst")).distinct()
    return page_links(pages).join(stored(names, "names"), "target").select(F.col("name").alias("src"), "dst")


def relabel(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace node names by ``mapping`` (old, new); names it lacks stay."""
    for side in ("src", "dst"):
        new = mapping.select(F.col("old").alias(side), F.col("new").alias("__new"))
        edges = edges.join(new, side, "left").withColumn(side, F.coalesce("__new", side)).drop("__new")
    return edges.select("src", "dst")


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("dst").agg(F.count("*").alias("n"))


def in_degree_ranking(edges: DataFrame, k: int = 10) -> DataFrame:
    """The k largest different numbers of mentions, one firm for each."""
    tiers = in_degrees(edges).groupBy("n").agg(F.min("dst").alias("dst"))
    return tiers.select("dst", "n").orderBy(F.desc("n")).limit(k)


def induced(edges: DataFrame) -> DataFrame:
    """Edges whose target is also a source."""
    sources = edges.select(F.col("src").alias("dst")).distinct()
    return edges.join(sources, "dst", "left_semi").select("src", "dst")


def degrees(edges: DataFrame) -> DataFrame:
    """In plus out degree per node of the simple directed graph; a self-loop counts twice."""
    simple = edges.select("src", "dst").distinct()
    ends = simple.select(F.explode(F.array("src", "dst")).alias("node"))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def degree_histogram(edges: DataFrame) -> DataFrame:
    return degrees(edges).groupBy("degree").agg(F.count("*").alias("n_nodes"))
