import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score_ string, uid_ int"

LINE = "shared line {} of a passage with some words that many documents hold in common"
PASSAGE = "\n".join(LINE.format(i) for i in range(8))


def words(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * 31) % 9973}" for i in range(n))


def rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, names that clash."""
    base = words(1, 60)
    out = [
        (1, base, "en", "a", len(base), "x", 1),
        (2, base, "en", "a", len(base), "x", 1),
        (2, base, "en", "a", len(base), "x", 1),
        (3, base.replace("w7950", "changed"), "en", "b", 0, None, None),
        (4, None, None, None, None, None, None),
        (5, "", "en", "b", 0, "y", 2),
        (6, " \n\t ", "de", "c", 4, "y", 2),
        (None, words(2, 30), "de", None, 3, "z", 3),
        (7, words(3, 4), "fr", "c", 3, "z", 3),
        (8, words(4, 20_000), "fr", "a", 3, "z", 3),
        (9, "start " + words(5, 9) + "\n" + PASSAGE + "\nend " + words(6, 9), "es", "a", 3, "z", 3),
        (10, "other " + words(7, 9) + "\n" + PASSAGE + "\nlast " + words(8, 9), "es", "b", 3, "z", 3),
    ]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
