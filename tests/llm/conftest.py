import re

import pytest

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="session")
def words():
    return plain_words


def odd_rows(extra=()):
    """Nulls, empties, ties and repeats that every operator has to take."""
    return [
        (1, "some ordinary words about nothing", "en", "a"), (1, "some ordinary words about nothing", "en", "a"),
        (None, None, None, None), (2, "", "en", None), (3, None, "de", "b"), (4, "...!!", None, "a"), (5, "é" * 50 + " ñ", "es", "b"),
        (6, "word " * 30_000, "en", "a"), *extra,
    ]


SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture()
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
