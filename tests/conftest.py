import pytest

from ratinglens.session import local_session
from ratinglens.sources.order_tables import read_review_tables

SMALL = "/root/testdata/sf0.001"
REVIEW_DDL = """review_id string, business_id string, user_id string, stars double, useful int, funny int, cool int,
    text string, date string"""
BUSINESS_DDL = """name string, city string, business_id string, latitude double, address string, longitude double,
    state string, is_open int, categories string"""


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, app_name="tests")


@pytest.fixture(scope="session")
def tables(spark):
    t = read_review_tables(spark, SMALL)
    for df in (t.reviews, t.business, t.users):
        df.persist()
    return t


@pytest.fixture
def make_reviews(spark):
    """Reviews from dicts; anything left out gets a default."""
    def make(*rows):
        filled = [{
            "review_id": f"r{i}", "business_id": "b", "user_id": "u", "stars": 3.0, "useful": 1, "funny": 0,
            "cool": None, "text": None, "date": "2020-01-15 10:00:00", **row} for i, row in enumerate(rows)]
        names = [c.split()[0] for c in REVIEW_DDL.split(",")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in filled], REVIEW_DDL)
    return make


@pytest.fixture
def make_business(spark):
    def make(*rows):
        filled = [{
            "name": f"n{i:03}", "city": "c", "business_id": f"b{i:03}", "latitude": 0.0, "address": "a",
            "longitude": 0.0, "state": "s", "is_open": 1, "categories": "Food, Bars", **row}
            for i, row in enumerate(rows)]
        names = [c.split()[0] for c in BUSINESS_DDL.split(",")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in filled], BUSINESS_DDL)
    return make


def rows(df):
    """Rows as dicts, in an order that does not depend on the partitioning."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: str(list(r.values())))


def same(a, b):
    """Equal as bags of rows, columns matched by name."""
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
