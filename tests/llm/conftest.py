import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like results."""
    text = " ".join(WORDS[i * 7 % 20] + str(i) for i in range(120))
    rows = [
        (1, text, "en", "a", 10),
        (1, text, "en", "a", 10),
        (2, text, "en", None, None),
        (3, None, None, "b", 0),
        (4, "", "de", "", 0),
        (5, " \n\t ", "de", "b", 4),
        (None, "a null id with seven words", "en", "a", 3),
        (None, None, None, None, None),
        (6, "one", "de", "b", 3),
        (7, "x" * 50_000, "de", "b", 50_000),
        (8, "the same two words the same two words " * 800, "en", "a", 1),
        (9, "ünïcödé \U0001f600 wörter ñandú 漢字", "de", "ß", 1),
        (10, "  ", "de", "ß", 2),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = "chunk score predicted copy row label bucket a b size target kept class_id item_id lang_pred shard place of found id word n".split()
    return frame.selectExpr("*", *(f"'{name}' AS {name}" for name in clashing))


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def table(spark):
    """Documents of ids and texts."""

    def make(rows, columns="doc_id long, text string"):
        return spark.createDataFrame(rows, columns)

    return make
