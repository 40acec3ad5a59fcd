"""Tables in a relational database. Connection options (url, user, driver, ...) always come from the caller."""

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(spark: SparkSession, connection: dict, table: str, partition_column: str | None = None,
                    lower_bound=None, upper_bound=None, num_partitions: int | None = None) -> DataFrame:
    """Whole-table scan; with a partition column and its bounds it runs as ``num_partitions`` parallel queries."""
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", table)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("a partitioned scan needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def write_jdbc_table(df: DataFrame, connection: dict, table: str, mode: str = "overwrite") -> None:
    """Replaces or appends to a table. Replacing truncates, so column types, grants and indexes stay."""
    (
        df.write.format("jdbc").options(**connection).option("dbtable", table)
        .option("truncate", "true").mode(mode).save()
    )


class JdbcTables:
    """Named tables in one database; takes the place of a ``TableFolder``.

    ``partitioning`` gives by table name the arguments of a parallel scan: partition_column, lower_bound, upper_bound
    and num_partitions. A table that is not named there is read by one task, which only suits small ones.
    """

    def __init__(self, spark: SparkSession, connection: dict, partitioning: dict[str, dict] | None = None):
        self.spark, self.connection, self.partitioning = spark, dict(connection), dict(partitioning or {})

    def read(self, name: str) -> DataFrame:
        return read_jdbc_table(self.spark, self.connection, name, **self.partitioning.get(name, {}))

    def replace(self, name: str, df: DataFrame, order_by: dict | None = None) -> None:
        """Rows of a database table have no order, so ``order_by`` is not used."""
        write_jdbc_table(df, self.connection, name)

    def append(self, name: str, df: DataFrame) -> None:
        write_jdbc_table(df, self.connection, name, mode="append")
