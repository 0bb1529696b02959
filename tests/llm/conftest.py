import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, words int, row int, key int, "
          "fp string, lines int, removed int, score string, shard int, unit int, doc int, ends int, x int")
EXTRA = (None, 1, 2, 3, "fp", 4, 5, "score", 6, 7, 8, 9, 10)


def passage(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = "\n".join(passage(1000 + i, 12) for i in range(2500))
    shared = "\n".join(passage(i, 9) for i in range(6))
    texts = [
        (0, None, None), (1, "", "en"), (2, "   \n\t ", "en"), (3, shared, "en"), (4, shared, None), (4, shared, None),
        (5, "start\n" + shared + "\nend", "de"), (None, shared, "en"), (None, shared + " more", "en"), (6, long, "en"),
        (7, long[:2000], "en"), (8, "word", "en"), (9, "Two words", "en"), (10, "äöü ÄÖÜ 漢字 " * 30, "fr"),
        (10, "same id, other text", "fr"), (11, "\n".join(["again and again"] * 40), "en"), (12, "a" * 5000, "en"),
        (13, "ab " * 2000, "en"), (14, passage(77, 200), "de"), (15, passage(77, 200) + " tail", "de"), (None, None, None),
    ]
    return [(i, t, lang, None if i == 3 else "src", None if t is None else len(t), *EXTRA) for i, t, lang in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1], r[2]) for r in odd_rows()]


@pytest.fixture(scope="session")
def rows():
    """The rows of a frame as a sorted list of tuples."""
    return lambda df, *c: sorted((tuple(r) for r in (df.select(*c) if c else df).collect()), key=repr)
