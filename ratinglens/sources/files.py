"""File scans, cached artefacts and result tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

COLUMNAR = ("orc", "parquet")
MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_json_lines(spark: SparkSession, path: str, schema, columns=None) -> DataFrame:
    """JSON-lines scan with a fixed schema; only the asked columns are parsed."""
    df = spark.read.schema(schema).json(path)
    return df if columns is None else df.select(*columns)


def read_columnar(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt.lower() not in COLUMNAR:
        raise ValueError(f"unsupported format: {fmt}")
    return spark.read.format(fmt.lower()).load(path)


def write_columnar(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(), mode: str = "overwrite") -> None:
    if fmt.lower() not in COLUMNAR:
        raise ValueError(f"unsupported format: {fmt}")
    df.write.format(fmt.lower()).mode(mode).partitionBy(*partition_by).save(path)


def load_or_build_artefact(spark: SparkSession, json_path: str, artefact_path: str, schema, columns,
                           fmt: str = "orc", refresh: bool = False) -> DataFrame:
    """The columnar copy of a JSON dump, built first where there is none or ``refresh`` asks for it.

    Only a missing copy is rebuilt: any other read error is the caller's to see. The result is always read from the
    copy, so later uses do not parse JSON again.
    """
    if not refresh:
        try:
            return read_columnar(spark, artefact_path, fmt)
        except AnalysisException as error:
            if error.getCondition() not in MISSING:
                raise
    write_columnar(read_json_lines(spark, json_path, schema, columns), artefact_path, fmt)
    return read_columnar(spark, artefact_path, fmt)


class TableFolder:
    """Named tables in one folder, each a columnar directory."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """``SELECT *`` of a stored table; aggregates and filters on it push down as usual."""
        return read_columnar(self.spark, self.path(name), self.fmt)

    def replace(self, name: str, df: DataFrame, order_by: dict | None = None) -> None:
        """Replaces a table; ``order_by`` (column -> ascending) range-sorts it for readers that rely on file order."""
        if order_by:
            df = df.orderBy(*order_by, ascending=list(order_by.values()))
        write_columnar(df, self.path(name), self.fmt)

    def append(self, name: str, df: DataFrame) -> None:
        write_columnar(df, self.path(name), self.fmt, mode="append")

    def register_views(self, names) -> None:
        """Temporary views over the stored tables, for ``spark.sql`` queries by name."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)
