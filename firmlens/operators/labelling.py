"""Data work around answers of a language model: whom to ask, with what text, and
how to read the answers. No model is called here."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.operators.firms import unique_keywords
from firmlens.operators.text import group_text
from firmlens.sources.files import read_ndjson

ANSWER = "primary_field string, fields array<string>, explanation string, confidence string"
BATCH_LINE = (
    "custom_id string, response struct<body: struct<choices: array<struct<message: struct<content: string>>>>>"
)


def candidates(hits: DataFrame, thresh: int = 3) -> DataFrame:
    """(id, category, n_unique) on websites at the threshold, for firms that also hold patents.

    The window spans the categories of one firm.
    """
    web, pat = F.col("source") == "web", F.col("source") == "pat"
    counts = unique_keywords(hits, "source", "id", "category")
    counts = counts.withColumn("holds", F.bool_or(pat).over(W.partitionBy("id")))
    return counts.filter(web & (F.col("n_unique") >= thresh) & F.col("holds")).select("id", "category", "n_unique")


def corpus(pages: DataFrame, chosen: DataFrame, **how: object) -> DataFrame:
    """The non-empty texts of the chosen firms, in parts."""
    own = pages.join(chosen.select("id").distinct(), "id", "left_semi")
    return group_text(own, keep_empty=False, **how)


def instructions(fields: Iterable[str] | Mapping[str, str]) -> str:
    """A prompt head that asks for the fields as the JSON of ``ANSWER``; a mapping adds what
    each field covers."""
    covers = fields if isinstance(fields, Mapping) else dict.fromkeys(fields, "")
    listed = "\n".join(f"- {f}: {text}" if text else f"- {f}" for f, text in covers.items())
    return (
        "Decide from the website text below in which of these technology fields the company works.\n"
        f"{listed}\n"
        "Name a field only on clear evidence. Answer with one JSON object with the keys primary_field"
        " (a field or null), fields (a list), explanation (at most three sentences) and confidence"
        " (High, Medium or Low).\nWebsite text:\n"
    )


def prompts(texts: DataFrame, head: str, max_chars: int = 100_000) -> DataFrame:
    """``(id, part, piece, prompt)``: the prompt head followed by a piece of a text, which a
    model's input limit of ``max_chars`` cuts into as many as it takes."""
    count = F.greatest(F.ceil(F.char_length("text") / max_chars), F.lit(1)).cast("int")
    pieces = texts.select("id", "part", "text", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    cut = F.substring("text", F.col("piece") * max_chars + 1, F.lit(max_chars))
    return pieces.select("id", "part", "piece", F.concat(F.lit(head), cut).alias("prompt"))


def parse_answers(answers: DataFrame, text: str = "answer") -> DataFrame:
    """Answers as columns, with the firm's id; what is neither JSON nor a Python literal
    keeps a row of nulls."""
    schema = f"{ANSWER}, malformed string"
    options = {"columnNameOfCorruptRecord": "malformed"}
    # Python's None, True and False outside quotes: only whole quoted parts may follow.
    outside = r"""(?=(?:[^'"]++|'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+")*+$)"""
    literal = F.col(text)
    for python, json in (("None", "null"), ("True", "true"), ("False", "false")):
        literal = F.regexp_replace(literal, rf"\b{python}\b{outside}", json)
    # Tuples are lists, and a comma may follow the last item.
    for python, json in ((r"\(", "["), (r"\)", "]"), (r",(?=\s*[\]}])", "")):
        literal = F.regexp_replace(literal, rf"{python}{outside}", json)
    # In steps, so that every answer is parsed once and only malformed ones a second time.
    first = answers.select("id", text, F.from_json(text, schema, options).alias("first"))
    retry = F.when(F.col("first.malformed").isNotNull(), literal)
    second = first.select("id", "first", F.from_json(retry, schema, options).alias("second"))
    chosen = second.select("id", F.coalesce("second", "first").alias("a"))
    names = [part.split()[0] for part in ANSWER.split(", ")]
    good = F.col("a.malformed").isNull()
    return chosen.select("id", *[F.when(good, F.col(f"a.{n}")).alias(n) for n in names])


def read_batch(spark: SparkSession, path: str, strict: bool = False, id_chars: int = 14) -> DataFrame:
    """Answers of a batch run: the first ``id_chars`` characters of ``custom_id`` are the
    firm; a shorter ``custom_id`` fails the job.

    ``strict`` fails on a malformed line or answer instead of giving nulls.
    """
    content = F.get(F.col("response.body.choices"), F.lit(0)).getField("message").getField("content")
    short = F.raise_error(F.concat(F.lit(f"custom_id of fewer than {id_chars} characters: "), F.col("custom_id")))
    firm = F.when(F.char_length("custom_id") < id_chars, short).otherwise(F.substring("custom_id", 1, id_chars))
    lines = read_ndjson(spark, path, BATCH_LINE, strict).select(firm.alias("id"), content.alias("answer"))
    if strict:
        answer = F.from_json("answer", ANSWER, {"mode": "FAILFAST"})
        return lines.select("id", answer.alias("a")).select("id", "a.*")
    return parse_answers(lines)


def check_table(answers: DataFrame, urls: DataFrame) -> DataFrame:
    """Answers with one url per firm, for checking by hand."""
    return answers.join(urls, "id")
