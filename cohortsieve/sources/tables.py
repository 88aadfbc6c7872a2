"""Read-only source tables and the criteria relation."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cohortsieve import vocabulary as v
from cohortsieve.sources.schemas import OMOP, conform, omop

SOURCE_TABLES = tuple(OMOP)


class Source:
    """The six clinical tables, under the same names wherever they are kept.

    ``Source(spark, path="/data/omop")`` reads ``<path>/<name>`` or ``<path>/<name>.parquet``;
    ``Source(spark, database="catalog.schema")`` reads catalog tables. Repointing from test data to
    real data is a matter of this one argument.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, database: str | None = None,
                 suffix: str = ""):
        if (path is None) == (database is None):
            raise ValueError("give either path or database")
        self.spark, self._path, self._database, self._suffix = spark, path, database, suffix

    def table(self, name: str) -> DataFrame:
        if self._database is not None:
            return self.spark.table(f"{self._database}.{name}")
        return self.spark.read.parquet(f"{self._path.rstrip('/')}/{name}{self._suffix}")

    def conformed(self, name: str) -> DataFrame:
        """The table with exactly its declared columns, order and types."""
        return conform(self.table(name), omop(name))

    def register_views(self, names: Iterable[str] = SOURCE_TABLES) -> list[str]:
        """Expose tables as views over the source; nothing is copied."""
        registered = []
        for name in names:
            self.table(name).createOrReplaceTempView(name)
            registered.append(name)
        return registered


def criteria(spark: SparkSession, rows: Iterable[tuple] = tuple(v.TRIALS),
             columns: str = v.TRIAL_COLUMNS) -> DataFrame:
    """Trials as rows. A NULL requirement leaves that field open.

    The rows go in as an Arrow table, which Spark keeps as a local relation: reading it needs no job.
    """
    schema = StructType.fromDDL(columns)
    by_column = zip(*rows, strict=True)
    table = pa.table(dict(zip(schema.names, map(list, by_column), strict=True)), to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
