"""Raw table access.

``TableSource`` resolves a table name to a DataFrame: a Parquet file or
folder below a root (``{root}/{name}.parquet``), or a catalog table
(``catalog.db.table``) when the name is qualified. Reads are lazy;
Catalyst prunes columns and pushes filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class TableSource:
    """Name -> DataFrame resolver over a Parquet root or the catalog."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if "." in name and not name.endswith(".parquet"):
            df = self.spark.table(name)           # scan by full name (SC3)
        else:
            if self.root is None:
                raise ValueError(f"no root given for table {name!r}")
            path = f"{self.root}/{name}"
            if not path.endswith(".parquet") and not self._exists(path):
                path = path + ".parquet"
            df = self.spark.read.parquet(path)
        self._cache[name] = df
        return df

    def _exists(self, path: str) -> bool:
        """Asked of the file system that the path names, local or not."""
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(sc._jsc.hadoopConfiguration()).exists(target)

    __getitem__ = table


def publish(tables: dict[str, DataFrame], namespace: str) -> dict[str, str]:
    """Put tables into the session's catalog; their full names (``global_temp.<namespace>_<name>``).

    The names live as long as the application and hold plans, not rows.
    """
    for name, df in tables.items():
        df.createOrReplaceGlobalTempView(f"{namespace}_{name}")
    return {name: f"global_temp.{namespace}_{name}" for name in tables}


def read_tables(spark: SparkSession, sf_dir: str) -> TableSource:
    return TableSource(spark, sf_dir)
