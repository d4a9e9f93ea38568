"""Named tables and how to read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetworks.schemas import CSV_ABSENT, CSV_EXCLUDED, TABLES


def parquet_scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _columns(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().split(" ", 1)) for part in ddl.replace(", ", "\n").split("\n")]


def _is_list(kind: str) -> bool:
    return kind.upper().startswith("ARRAY")


def csv_scan(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Scan one CSV file, or a folder of part files, as the named table.

    The header must match, an empty field is NULL, columns the file lacks get their default, and columns
    that must not be seen are dropped at the scan. A list is text here, its values separated by commas.
    """
    absent = CSV_ABSENT.get(table, {})
    columns = _columns(TABLES[table])
    present = [f"{name} {'STRING' if _is_list(kind) else kind}" for name, kind in columns if name not in absent]
    if table in CSV_EXCLUDED:
        present.append(CSV_EXCLUDED[table])
    df = (
        spark.read.schema(", ".join(present))
        .option("header", True).option("enforceSchema", False).option("nullValue", "").option("mode", "FAILFAST")
        .csv(path)
    )
    fill = {name: F.expr(value) if value else F.lit(None) for name, value in absent.items()}
    kinds = dict(columns)
    return df.select(*[
        fill[name].cast(kinds[name]).alias(name) if name in fill
        else F.split(name, ",").cast(kind).alias(name) if _is_list(kind) else F.col(name) for name, kind in columns
    ])


def conform(df: DataFrame, table: str) -> DataFrame:
    """A result in the stored shape of its table: the table's columns in order, cast, NULL where absent. Lists stay lists."""
    columns = [(F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
               for name, kind in _columns(TABLES[table])]
    return df.select(*columns)


class Catalog:
    """The warehouse tables under one folder, ``<root>/<table>`` as parquet or ``<root>/<table>.csv``.

    ``located`` overrides the path of single tables, so batch scans and the tables the streams land in
    can be the same ones.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", located: dict[str, str] | None = None):
        if fmt not in ("parquet", "csv"):
            raise ValueError(f"unknown table format: {fmt}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.located = located or {}

    def names(self) -> list[str]:
        return list(TABLES)

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise KeyError(f"unknown table: {name}")
        suffix = ".csv" if self.fmt == "csv" else ""
        return self.located.get(name, f"{self.root}/{name}{suffix}")

    def table(self, name: str) -> DataFrame:
        path = self.path(name)
        if self.fmt == "csv":
            return csv_scan(self.spark, name, path)
        # a folder may be partitioned by something of its own, such as the batch that landed it
        return parquet_scan(self.spark, path, TABLES[name]).select(*[column for column, _ in _columns(TABLES[name])])

    def register_views(self, names: list[str] | None = None) -> None:
        for name in names or self.names():
            self.table(name).createOrReplaceTempView(name)
