import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words):
    made = random.Random(seed)
    return " ".join("".join(made.choice("abcdehilnorst") for _ in range(made.randint(2, 9))) for _ in range(words))


def fixture_rows():
    """Copies, near copies, shared passages, nulls, blanks, long texts, ties, repeated rows."""
    base, passage = prose(1, 150), prose(2, 90)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, base.replace(base.split()[70], "changed", 1), "en", "b", None),
        (4, prose(4, 60) + " " + passage + "\n" + prose(5, 30), "de", "b", 3),
        (5, prose(6, 20) + "\n" + passage + " " + prose(7, 80), "de", None, 3),
        (6, passage, None, "c", 3),
        (7, None, "en", "a", None),
        (8, "", "en", "a", 0),
        (9, " \n\t ", "en", "a", 0),
        (None, base, "en", "a", 1),
        (None, prose(8, 70), None, None, None),
        (10, prose(9, 3000), "en", "a", 5),
        (10, prose(10, 100), "en", "a", 5),
        (11, prose(11, 55), "en", "b", 5),
        (11, prose(11, 55), "en", "b", 5),
        (12, "x" * 3000, "en", "c", 1),
        (13, ("ab " * 700).strip(), "en", "c", 1),
        (14, "\n".join(["one line", "two line", "three line", "four"] * 3), "fr", "c", 1),
        (15, "é ü ß   wide　word\x1cend", "fr", "c", 1),
        (16, prose(12, 40) + " " + base, "fr", "z", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return fixture_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, rows):
    """The same rows with further columns named like those the operators make."""
    extra = "id mark k e fp size shard slot row rid taken target key place start kept spans runs".split()
    schema = SCHEMA + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(*r, *("?" for _ in extra)) for r in rows], schema)
