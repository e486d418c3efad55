import pytest

from tillwork.llm import common

SF = "/root/testdata/sf0.001"
PROSE = ["the quick brown fox jumps over the lazy dog and runs home through the old town",
         "der schnelle braune fuchs springt über den faulen hund und läuft nach hause durch die stadt",
         "el rápido zorro marrón salta sobre el perro perezoso y corre a casa por la ciudad vieja"]
#: Columns whose names operators use inside, or return.
EXTRA = ["row", "size", "_key", "_fp", "block", "drop", "score", "lang_pred", "component_id", "n_lines", "_times", "_id"]


@pytest.fixture(scope="session")
def documents(spark):
    return common.table(spark, SF, "documents")


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rows = [(i, PROSE[i % 3] + f" number {i}", ["en", "de", "es"][i % 3], f"s{i % 3}", 80) for i in range(24)]
    long_text = " ".join(f"{PROSE[i % 3]} {i}" for i in range(4000))
    rows += [(100, None, "en", "s0", None), (101, "", "de", "s1", 0), (None, PROSE[0], "en", None, 5),
             (102, PROSE[1], None, None, 5), (103, long_text, "en", "s2", len(long_text)), (104, "123 456 !?", "en", "s0", 10),
             (105, " \n\t \n", "en", "s0", 5), (106, "x" * 50_000, "en", "s0", 50_000), (None, None, None, None, None),
             (107, "日本語 テキスト   ñ\x1c ü", None, "s0", 9)]
    rows += [(200, PROSE[2], "es", "s1", 7)] * 3 + [(201, PROSE[2], "es", "s1", 7), (202, PROSE[2].upper(), "es", "s1", 7)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def odd_wide(spark, odd):
    """The same with columns that clash with names used inside."""
    from pyspark.sql import functions as F
    return odd.withColumns({name: F.lit("x") for name in EXTRA})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *columns):
    """Rows as sorted tuples, None first."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda t: [(x is not None, x) for x in t])
