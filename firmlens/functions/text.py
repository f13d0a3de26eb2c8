"""Text expressions: words, domains, timestamps, stable hashes. All JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]+"


def words(text: Column) -> Column:
    """Lower-cased maximal runs of letters, digits and underscores, in text order."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def escape_regex(literal: Column) -> Column:
    """A pattern that matches ``literal`` exactly, whatever characters it holds."""
    return F.regexp_replace(literal, r"([^\p{L}\p{N}_\s])", r"\\$1")


def whole_word_pattern(phrase: Column, compat: bool = False) -> Column:
    """A zero-width pattern, one match per whole-word occurrence of ``phrase``.

    Being zero-width it also counts occurrences that overlap. ``compat`` keeps two
    quirks some published counts rely on: a phrase at position 0 is not reported and
    a following underscore does not block.
    """
    # The phrase comes first: it fails at the first letter, a look-behind would run everywhere.
    after = r"(?![\p{L}\p{N}]))" if compat else rf"(?!{WORD}))"
    before = r"(?<=[^\p{L}\p{N}_])" if compat else rf"(?<!{WORD})"
    return F.concat(F.lit("(?="), escape_regex(phrase), F.lit(after + before))


def strip_non_ascii(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{ASCII}]", "")


def domain(url: Column) -> Column:
    """Host of a url with or without a scheme, without a leading ``www.``."""
    return F.regexp_extract(url, r"^\s*(https?://)?(www\.)?([^/]*)", 3)


def parse_ctime(text: Column) -> Column:
    """``Mon Jan  1 00:00:07 2024`` as a zone-less timestamp; null if malformed."""
    # The weekday is cut off because Spark's patterns cannot parse it.
    body = F.regexp_replace(F.substring(text, 5, 64), " +", " ")
    return F.try_to_timestamp(body, F.lit("MMM d HH:mm:ss yyyy")).cast("timestamp_ntz")


def hash_fraction(key: Column, seed: int) -> Column:
    """A repeatable number in [0, 1) per key, the same in every run and partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
