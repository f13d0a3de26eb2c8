"""Tables with odd rows for the operators on documents."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars int"
#: Names that operators use inside or return; as columns of an input they must not matter.
CLASHING = (
    "n_bytes n_tokens piece start length ids_crc32 sequence_id offset members fill n_words kept content_share query_id rank score"
    " fingerprint component_id component node first least key keys sketch ids spans k digest mark context place last copies id"
    " begin end hash1 total grade expected_grade selected turns _k _digest a b"
).split()


def odd_rows() -> list[tuple]:
    """Null and empty texts, null and repeated keys, repeated rows, ties, very long texts,
    texts that share long passages, and characters of all widths."""
    rng = random.Random(7)
    words = ["the", "of", "thing", "straße", "漢字", "été", "don't", "x1", "a", "\U0001f600", "retention", "Über"]

    def text(n: int) -> str:
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", ", ", "  ", "\t"]) for _ in range(n))

    shared, other = text(160), text(120)
    long = text(9_000)
    plain = text(90)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (None, "a"), (None, None), (5, plain), (6, plain), (6, plain),
        (7, plain + " one more"), (8, text(40) + shared + text(30)), (9, text(25) + shared + other), (10, other + text(9) + shared),
        (11, long), (12, long[:20_000] + " ! " + long[20_000:]), (13, "ab" * 3_000), (14, "é" * 1_500 + "b" * 2_500), (15, "é" * 1_600),
        (16, "<|endoftext|> x <|endoftext|><|endoftext|>"), (17, "word " * 400), (18, "word " * 300),
        (19, "pass" + "word = \"abcdefgh1\" and " + "AKIA" + "ABCDEFGHIJKL" + "MNOP" + " " + "0123456789abcdef" * 2),
        (20, "token=api:password='longer.value/+' " + "q7Zp0Xk2Lw9Rt4Vb8Nc3Ms6Hd" + " " + "d41d8cd98f00b204e9800998ecf8427e"),
        (4, "other text under a key that is taken"),
    ]
    return [(k, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else "src0", None if t is None else len(t)) for i, (k, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(odd_rows(), DOCUMENT).repartition(3)
    return table.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
