import pytest
from pyspark.sql import functions as F

from ratinglens.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, app_name="tests")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


ODD = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (None, "some words here", None, "a", 15), (None, None, None, None, None),
    (3, "   \n\t\x0b ", "en", "b", 6), (4, "one", "en", "b", 3), (5, "one", "en", "b", 3), (5, "one", "en", "b", 3),
    (6, "é token = 'abcdefghijkl1' 😀 AKIAABCDEFGHIJKLMN " + "0123456789abcdef0", "fr", "b", 10),
    (7, "word " * 30_000, "en", "c", 150_000), (8, "same line\nsame line\n\nsame line", "en", "c", 20),
    (9, "x" * 100_000, "de", "c", 100_000), (10, "call +1 (415) 555-2671 or a.b@c.de, 10.0.0.256 and 10.0.0.1, 4111 1111 1111 1111", "en", "c", 70),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, very long and repeated texts, repeated ids, and other columns named as the operators' own."""
    df = spark.createDataFrame(ODD, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("row", "host", "kept", "spans", "node", "seed", "tokens", "place", "n_words", "of_host", "found_id", "kinds"):
        df = df.withColumn(name, F.lit(1))
    return df


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=lambda x: (x is not None, x or 0))
