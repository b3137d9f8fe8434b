from __future__ import annotations

import pytest

from searchtide.llm.shared import ship
from tests.conftest import SMALL

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
         "the of and to in that it was for on are with as his they be at one have this").split()


def prose(seed: int, n: int) -> str:
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randint(0, 40)) for _ in range(n))


#: nulls, empty and blank texts, one very long word, a long text, ties, repeated rows, odd characters
EDGES = [
    (0, None, "en", "a"), (1, "", None, None), (2, " \t\n ", "en", "a"), (3, "x" * 50_000, "en", "b"), (4, prose(1, 20_000), "en", "b"),
    (5, prose(2, 120), "de", "a"), (6, prose(2, 120), "de", None), (7, prose(2, 119) + " end", "de", "a"), (7, prose(3, 60), "fr", "c"),
    (8, "same same " * 200, "fr", "c"), (9, "\U0001d11e ▁ éß \x00 日本\n\nline\nline\nline", None, "d"), (None, prose(2, 120), "en", "d"), (10, "Short Text", "en", "d"),
    (11, "1 2 3 4", "en", "d"), (11, "1 2 3 4", "en", "d"),
]
#: names that operators use themselves
CLASHING = ("row", "bits", "root", "kept", "size", "hash", "copies", "s", "terms", "_terms", "spans", "part", "seed", "words", "exact", "gone_id", "threshold", "passes")


@pytest.fixture(scope="session")
def ready(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def edges(ready):
    from pyspark.sql import functions as F

    frame = ready.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def docs(ready):
    return ready.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(ready):
    return ready.read.parquet(f"{SMALL}/labels.parquet")
