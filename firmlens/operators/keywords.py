"""Dictionary phrases found as whole words in texts.

``match_keywords`` reads every text once. A text is cut into its different words;
a phrase is a candidate where its longest word (its anchor) is among them, and a
candidate is then counted in the text itself. As long as the dictionary is small
enough to broadcast the texts are never shuffled. A larger one is joined by a
shuffle of words and row digests, and only texts with candidates are looked up
again; both give the same rows, for repeated and null keys too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.joins import broadcast_if_small
from firmlens.functions.text import WORD, whole_word_pattern

BROADCAST_PHRASES = 500_000
#: Phrases of a dictionary whose anchors are looked for in each text before its words are
#: taken apart: a text is then copied for its candidates only, not for each of its words.
FEW_PHRASES = 5_000


def split_phrases(raw: DataFrame, category: str = "category", phrases: str = "prompt_output") -> DataFrame:
    """One trimmed, lower-cased phrase per row of a dictionary with ``", "``-separated lists."""
    pieces = raw.select(category, F.explode(F.split(phrases, ", ")).alias("keyword"))
    return pieces.withColumn("keyword", F.lower(F.regexp_replace("keyword", r"^\s+|\s+$", "")))


def keyword_dictionary(raw: DataFrame, min_chars: int = 5) -> DataFrame:
    """Distinct (category, keyword) of a dictionary file, short phrases left out."""
    return split_phrases(raw).filter(F.char_length("keyword") >= min_chars).distinct()


def keyword_list(raw: DataFrame, min_chars: int = 4) -> DataFrame:
    """Distinct phrases to search for."""
    return split_phrases(raw).filter(F.char_length("keyword") >= min_chars).select("keyword").distinct()


def joined_dictionary(dictionary: DataFrame) -> DataFrame:
    """Back to one ``", "``-separated list per category, phrases in order."""
    return dictionary.groupBy("category").agg(
        F.array_join(F.sort_array(F.collect_set("keyword")), ", ").alias("prompt_output")
    )


def _anchored(keywords: DataFrame, word: str) -> DataFrame:
    """Phrases with their longest word, or their first character where they have none, and
    whether that word is the whole phrase."""
    runs = F.regexp_extract_all("keyword", F.lit(f"({word}+)"), F.lit(0))
    longest = F.reduce(
        runs, F.lit(""), lambda best, run: F.when(F.char_length(run) > F.char_length(best), run).otherwise(best)
    )
    anchor = F.when(longest != "", longest).otherwise(F.substring("keyword", 1, 1))
    own = keywords.select("keyword").filter("keyword <> ''").distinct()
    return own.select("keyword", anchor.alias("anchor"), (longest == F.col("keyword")).alias("single"))


def match_keywords(
    pages: DataFrame,
    keywords: DataFrame,
    key: str = "url",
    text: str = "text",
    compat: bool = False,
    broadcast_phrases: int = BROADCAST_PHRASES,
) -> DataFrame:
    """(key, keyword, n): whole-word occurrences, overlapping ones included, case ignored.

    ``keywords`` is a table of lower-cased phrases. Counting them, up to
    ``broadcast_phrases``, and looking for phrases without a word are the jobs run here.
    ``compat`` leaves out phrases at the start of a text and lets an underscore follow a
    phrase.
    """
    # In compat mode an underscore may end a phrase, so it has to separate words too.
    word = r"[\p{L}\p{N}]" if compat else WORD
    phrases = _anchored(keywords, word)
    signs_only = not phrases.filter(~F.col("anchor").rlike(word)).isEmpty()
    phrases, small = broadcast_if_small(phrases, broadcast_phrases)
    lower = F.col("__text")
    all_words = F.split(lower, rf"[^{word[1:-1]}]+")
    runs = F.col("__words")
    if signs_only:  # anchors of phrases without words
        runs = F.concat(runs, F.split(F.regexp_replace(lower, f"{word}+", ""), ""))
    texts = pages.select(key, F.lower(text).alias("__text")).withColumn("__words", all_words)
    few = small and phrases.limit(FEW_PHRASES + 1).count() <= FEW_PHRASES
    if few:
        anchors = phrases.agg(F.collect_set("anchor").alias("anchors")).scalar()
        texts = texts.withColumn("__runs", F.array_intersect(runs, anchors))
    else:
        texts = texts.withColumn("__runs", F.array_distinct(runs))
    # Outer: for a plain explode Spark adds a filter that takes the words apart a second time.
    if small:
        candidates = texts.withColumn("anchor", F.explode_outer("__runs")).join(phrases, "anchor")
    else:
        # Rows that are equal in key and text have the same digest and the same candidates,
        # which are joined to each of them once.
        row = [F.xxhash64(key, "__text").alias("__row"), F.hash("__text").alias("__check")]
        found = texts.select(*row, F.explode_outer("__runs").alias("anchor")).join(phrases, "anchor")
        found = found.select("__row", "__check", "keyword", "single").distinct()
        candidates = texts.select(key, "__text", "__words", *row).join(found, ["__row", "__check"])
    return _counted(candidates.filter(F.contains("__text", "keyword")), key, compat)


def _counted(candidates: DataFrame, key: str, compat: bool) -> DataFrame:
    n: Column = F.regexp_count("__text", whole_word_pattern(F.col("keyword"), compat)).cast("long")
    if not compat:  # a phrase of one word is counted among the words of the text
        same = F.size(F.filter("__words", lambda w: w == F.col("keyword"))).cast("long")
        n = F.when(F.col("single"), same).otherwise(n)
    # Generated columns are not copied into filters, so every count is taken once.
    return candidates.select(key, "keyword", F.explode(F.array(n)).alias("n")).filter("n > 0")


def match_lists(pages: DataFrame, hits: DataFrame, key: str = "url") -> DataFrame:
    """Per page the sorted list of matches, repeats kept; empty for pages without one."""
    repeated = F.flatten(F.collect_list(F.array_repeat("keyword", F.col("n").cast("int"))))
    lists = hits.groupBy(key).agg(F.sort_array(repeated).alias("matches"))
    none = F.array().cast("array<string>")
    return pages.select(key).join(lists, key, "left").withColumn("matches", F.coalesce("matches", none))


def hits_from_lists(lists: DataFrame, key: str = "url") -> DataFrame:
    """One row per match; pages without matches drop out."""
    return lists.filter(F.size("matches") > 0).select(key, F.explode("matches").alias("keyword"))


def label_unmatched(lists: DataFrame, dictionary: DataFrame, key: str = "url") -> DataFrame:
    """One row per match and category; pages without a match are kept under a label."""
    hits = lists.select(key, F.explode_outer("matches").alias("keyword"))
    lookup, _ = broadcast_if_small(dictionary.select("category", "keyword"), BROADCAST_PHRASES)
    return (
        hits.join(lookup, "keyword", "left")
        .na.fill({"keyword": "No keyword", "category": "No category"})
        .select(key, "keyword", "category")
    )


def attach_category(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The categories of every hit; a keyword in several categories gives several rows."""
    lookup, _ = broadcast_if_small(dictionary.select("category", "keyword"), BROADCAST_PHRASES)
    return hits.join(lookup, "keyword")


def attach_firm(hits: DataFrame, pages: DataFrame, key: str = "url", distinct_pages: bool = False) -> DataFrame:
    """The firm of every hit by page. A page listed twice repeats its hits unless
    ``distinct_pages`` is set."""
    owners = pages.select(key, "id")
    return hits.join(owners.distinct() if distinct_pages else owners, key)
