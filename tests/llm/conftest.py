import pytest

LONG = " ".join(f"w{i % 977} q{i % 31}" for i in range(60_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven quiet cats watch from a tall wooden fence nearby"

#: nulls, empty and blank texts, a very long text, repeated rows, equal texts under other ids, null ids
EDGE = [
    (0, None, "en", "a", 0), (1, "", None, "a", 0), (2, "  \t\n ", "en", None, 5), (3, "!!! ### 123", "en", "a", 11),
    (4, LONG, "en", "b", len(LONG)), (5, LONG, "fr", "b", len(LONG)), (6, PROSE, "en", "b", len(PROSE)),
    (6, PROSE, "en", "b", len(PROSE)), (7, PROSE + " today", "en", None, 1), (8, "Hé ça va bien", "fr", "c", 13),
    (9, "one two", "en", "c", 7), (10, "one  two", "en", "c", 8), (None, PROSE, "en", "c", 3), (None, None, None, None, None),
    (11, "x" * 70_000, None, "a", 70_000), (12, "漢字 тест слово", "ru", "c", 13),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("key", "n", "row", "size", "target", "h", "label", "word", "path", "items", "component")


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"x{c}") for c in CLASH})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
