import json

import pytest
from pyspark.errors import AnalysisException

from ratinglens import schemas
from ratinglens.sources import jdbc, topics
from ratinglens.sources.files import TableFolder, load_or_build_artefact, read_columnar, read_json_lines, write_columnar

from .conftest import rows, same


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "business.json"
    path.write_text("\n".join(json.dumps(b) for b in [
        {"business_id": "b1", "name": "N", "is_open": 1, "unknown": 5}, {"business_id": "b2", "latitude": 1.5}]))
    return str(path)


def test_json_lines_keep_the_schema(spark, dump):
    df = read_json_lines(spark, dump, schemas.BUSINESS, ["business_id", "is_open"])
    assert rows(df) == [{"business_id": "b1", "is_open": 1}, {"business_id": "b2", "is_open": None}]
    assert read_json_lines(spark, dump, schemas.BUSINESS).schema == schemas.BUSINESS


@pytest.mark.parametrize("fmt", ["orc", "parquet"])
def test_artefact_is_built_once(spark, dump, tmp_path, fmt):
    artefact = str(tmp_path / "artefact")
    arguments = (spark, dump, artefact, schemas.BUSINESS, schemas.BUSINESS_COLUMNS, fmt)
    first = load_or_build_artefact(*arguments)
    assert first.columns == schemas.BUSINESS_COLUMNS and first.count() == 2
    with open(dump, "a") as f:
        f.write('\n{"business_id": "b3"}')
    assert load_or_build_artefact(*arguments).count() == 2
    assert load_or_build_artefact(*arguments, refresh=True).count() == 3


def test_only_a_missing_artefact_is_rebuilt(spark, dump, tmp_path):
    with pytest.raises(ValueError):
        load_or_build_artefact(spark, dump, str(tmp_path / "x"), schemas.BUSINESS, ["name"], "csv")
    with pytest.raises(AnalysisException):
        load_or_build_artefact(spark, "/nowhere.json", str(tmp_path / "y"), schemas.BUSINESS, ["name"])


def test_table_folder(spark, make_business, tmp_path):
    store = TableFolder(spark, str(tmp_path))
    store.replace("t", make_business({}, {}))
    store.replace("t", make_business({}, {}, {}), order_by={"name": False})
    assert [r["name"] for r in store.read("t").collect()] == ["n002", "n001", "n000"]
    store.register_views(["t"])
    assert spark.sql("select count(*) as n from t where business_id = :id", args={"id": "b001"}).first()["n"] == 1
    plan = store.read("t").filter("business_id = 'b001'").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(business_id,b001)" in plan and "ReadSchema: struct<name:string,business_id:string>" in plan


def test_partitioned_write(spark, make_business, tmp_path):
    write_columnar(make_business({"state": "x"}, {"state": "y"}), str(tmp_path / "p"), partition_by=["state"])
    assert (tmp_path / "p" / "state=x").is_dir()
    assert read_columnar(spark, str(tmp_path / "p")).filter("state = 'y'").count() == 1


class Recorder:
    """Stands in for a Spark reader or writer and keeps the options it is given."""

    def __init__(self):
        self.seen, self.read, self.write = {}, self, self

    def __getattr__(self, name):
        def call(*args, **options):
            self.seen.update(options)
            if name == "option":
                self.seen[args[0]] = args[1]
            elif args:
                self.seen[name] = args[0]
            return self
        return call


def test_jdbc_options():
    reader = Recorder()
    jdbc.read_jdbc_table(reader, {"url": "jdbc:x", "user": "u"}, "review_table", "id_date", 1, 1000, 8)
    assert reader.seen == {"format": "jdbc", "url": "jdbc:x", "user": "u", "dbtable": "review_table",
                           "partitionColumn": "id_date", "lowerBound": "1", "upperBound": "1000", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.read_jdbc_table(Recorder(), {}, "t", "id_date")
    reader = Recorder()
    by_number = {"partition_column": "id_date", "lower_bound": 1, "upper_bound": 9, "num_partitions": 3}
    jdbc.JdbcTables(reader, {"url": "jdbc:x"}, {"review_table": by_number}).read("review_table")
    assert reader.seen["numPartitions"] == "3" and reader.seen["partitionColumn"] == "id_date"
    writer = Recorder()
    jdbc.JdbcTables(None, {"url": "jdbc:x"}).append("t", writer)
    assert writer.seen == {"format": "jdbc", "url": "jdbc:x", "dbtable": "t", "truncate": "true", "mode": "append"}


def test_message_layout(make_reviews):
    row, = rows(topics.message_text(topics.to_messages(make_reviews({"review_id": "r", "stars": 4.5}))))
    assert row["key"] == "r" and json.loads(row["value"])["stars"] == 4.5
