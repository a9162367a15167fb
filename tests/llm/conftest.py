import re

import pytest

from skilltide.llm.queries import table

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern="[^\x20\x09-\x0d]+", lower=True):
    return re.findall(pattern, (text or "").translate(LETTERS) if lower else text or "")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


ODD_COLUMNS = (
    "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, kept BOOLEAN, n_words LONG, component_id STRING, "
    "row LONG, mark LONG, size STRING, shard STRING, slot INT, rate DOUBLE, copies INT, n_hit INT, mark_ STRING"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty texts, a long one, repeated rows and ids, near copies, and
    columns called like those of the operators."""
    base = " ".join(f"word{i % 97} of {i}" for i in range(60))
    near = base.replace("of 30", "for 30")
    rest = (None,) * 12
    return spark.createDataFrame(
        [
            (1, base, "en", "a", 10, *rest), (2, base, "en", None, 10, *rest), (3, near, None, "a", None, *rest),
            (3, near, None, "a", None, *rest), (None, base, "en", "a", 1, *rest), (None, None, None, None, None, *rest),
            (None, None, None, None, None, *rest), (4, "", "de", "a", 0, *rest), (5, " \n\t ", "de", "b", 4, *rest),
            (6, "!!! ??? ***", "de", "b", 4, *rest), (7, "one two three", "de", "b", 4, *rest), (8, "ONE Two three", "de", "b", 4, *rest),
            (9, " ".join(f"long{i * 7919 % 10007}" for i in range(60_000)), "fr", "b", 4, *rest), (10, "é " * 80, "fr", "b", 4, *rest),
            (10, "other text of id ten with words", "fr", "b", 4, *rest),
        ],
        ODD_COLUMNS,
    )


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
