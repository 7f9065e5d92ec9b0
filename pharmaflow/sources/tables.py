"""Warehouse tables: logical-name catalog (S6) and replace-mode sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# The driver-provided tables (one parquet file each).
TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet`` (filters and projections on the result
    are pushed into the parquet scan by Catalyst)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Catalog:
    """Logical table names -> physical locations.

    ``tables`` maps a logical name to a parquet path, a metastore table name
    (``"table:db.name"``) or a JDBC spec (``{"jdbc": url, "dbtable": t, ...}``).
    Unknown names raise ``ValueError`` listing the configured ones.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, object]):
        self.spark = spark
        self.tables = dict(tables)

    @classmethod
    def for_dir(cls, spark: SparkSession, sf_dir: str, names=TABLES) -> "Catalog":
        return cls(spark, {n: f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names})

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ValueError(f"no table is named {name!r}; known are {', '.join(sorted(self.tables))}")
        loc = self.tables[name]
        if isinstance(loc, Mapping):
            opts = dict(loc)
            url = opts.pop("jdbc")
            return self.spark.read.format("jdbc").option("url", url).options(**opts).load()
        loc = str(loc)
        if loc.startswith("table:"):
            return self.spark.table(loc[len("table:"):])
        return self.spark.read.parquet(loc)


def save_table(df: DataFrame, path: str, mode: str = "overwrite",
               fmt: str = "parquet", table_name: str | None = None,
               partition_by: list[str] | None = None) -> int:
    """Write ``df`` (replace by default) and return the number of rows written.

    The count is taken with ``DataFrame.observe`` during the write, so the
    data is not scanned a second time.
    """
    obs = Observation("save_table")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table_name:
        writer.option("path", path).saveAsTable(table_name)
    else:
        writer.save(path)
    return int(obs.get.get("rows", 0))
