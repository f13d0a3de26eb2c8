"""Words and their inverse document frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.functions.text import NOT_WORD


DOCUMENT = ""


def document_words(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """Different words of two or more characters per document, with the ``keep`` columns.

    Repeats are removed inside the document, so the later count per word needs no
    distinct shuffle. Each document also gives one empty word: counting that counts the
    documents in the same pass over the texts.
    """
    long = F.filter(F.split(F.lower(text), NOT_WORD), lambda w: F.char_length(w) >= 2)
    # Outer: for a plain explode Spark adds a filter that takes the words apart a second time.
    every = F.explode_outer(F.array_append(F.array_distinct(long), DOCUMENT)).alias("word")
    return docs.select(*keep, every).filter("word is not null")


def document_frequencies(docs: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Number of documents per word and ``by``; the empty word stands for all documents."""
    return document_words(docs, text, *by).groupBy(*by, "word").agg(F.count("*").alias("df"))


def idf_scores(
    frequencies: DataFrame,
    stop_words: Sequence[str] = (),
    min_df: int = 2,
    max_df: float = 0.95,
    corpus: str | None = None,
) -> DataFrame:
    """Smoothed inverse document frequency, ln((1 + n) / (1 + df)) + 1, per word.

    Words of fewer than ``min_df`` documents or more than the share ``max_df`` of them drop
    out. ``corpus`` names a column that tells several corpora apart.
    """
    keys = [corpus] if corpus else []
    # Words are picked by condition here and below: a filter on them would be pushed into
    # the counting, and the two uses of the counts would read the texts twice.
    all_documents = F.max(F.when(F.col("word") == DOCUMENT, F.col("df"))).alias("n_docs")
    sizes = frequencies.groupBy(*keys).agg(all_documents)
    n = F.col("n_docs") if corpus else sizes.scalar()
    if corpus:  # one row for each corpus, whose words a skewed join may split
        frequencies = frequencies.join(sizes, corpus)
    df = F.when(~F.col("word").isin([DOCUMENT, *stop_words]), F.col("df"))
    kept = frequencies.filter((df >= min_df) & (df <= n * max_df))
    return kept.select(*keys, "word", "df", (F.ln((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def idf_words(docs: DataFrame, text: str = "text", corpus: str | None = None, **limits: object) -> DataFrame:
    """Scores of all words of one corpus, or of several told apart by a ``corpus`` column."""
    frequencies = document_frequencies(docs, text, [corpus] if corpus else [])
    return idf_scores(frequencies, corpus=corpus, **limits)


def word_lists(frequencies: DataFrame, languages: Sequence[str], min_df: int = 2) -> DataFrame:
    """Words with one flag per language: found in ``min_df`` documents of that ``lang``."""
    counts = [F.sum(F.when(F.col("lang") == lang, F.col("df"))) for lang in languages]
    return frequencies.groupBy("word").agg(
        *[(F.coalesce(n, F.lit(0)) >= min_df).alias(lang) for n, lang in zip(counts, languages, strict=True)]
    )


def idf_language(scores: DataFrame, flags: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Scores with language flags; words of no language and words with digits drop out."""
    flagged = scores.join(flags, "word", "left").na.fill(False, list(languages))
    known = F.array_contains(F.array(*languages), True)
    return flagged.filter(known & ~F.col("word").rlike("[0-9]"))


def idf_contrast(scores: DataFrame, corpus: str, a: str, b: str) -> DataFrame:
    """Mean score per word of corpora a and b, and their difference, for words of both."""
    mean = {c: F.avg(F.when(F.col(corpus) == c, F.col("idf"))).alias(f"idf_{c}") for c in (a, b)}
    both = scores.groupBy("word").agg(mean[a], mean[b]).dropna()
    return both.withColumn("difference", F.col(f"idf_{a}") - F.col(f"idf_{b}"))
