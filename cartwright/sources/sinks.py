"""Sinks: views (lazy models) and written tables (materialized models).

A written model goes to a fresh folder per build run, so a model is never
overwritten while it is also being read as an input (the reference's full
refresh semantics, without the read/overwrite hazard). Reading the written
table back cuts the lineage: downstream jobs restart from Parquet, not from
the raw sources, when an executor is lost.

A full refresh (``Runs``) never shows readers half of it: all tables of a run
are written first, then one pointer file is replaced in a single rename, and
only then runs beyond a stated number go. A reader that opened the run before
keeps reading its files, as the runs next to the current one stay.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwright.session import file_system, warehouse_path


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View sink (staging models): the plan stays lazy."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> DataFrame:
    """Table sink (marts): write Parquet, return the re-read table."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Catalog table sink."""
    df.write.mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> DataFrame:
    """Table sink in the layout of a key: joins and groupings on it need no exchange."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files of an external table stay
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path)
     .saveAsTable(name))
    return spark.table(name)


class Runs:
    """The runs of a build below one folder: write, switch, remove."""

    def __init__(self, spark: SparkSession, root: str | None = None, keep: int = 2):
        if keep < 1:
            raise ValueError("the current run has to be kept")
        self.spark = spark
        self.root = root or warehouse_path(spark, "runs")
        self.keep = keep

    def new(self) -> str:
        """An id of a new run; ids sort by time."""
        return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f-") + uuid.uuid4().hex[:8]

    def path(self, run_id: str) -> str:
        return f"{self.root}/{run_id}"

    def current(self) -> str | None:
        """The id of the run that readers see, if there is one."""
        fs, pointer = file_system(self.spark, f"{self.root}/_current")
        if not fs.exists(pointer):
            return None
        source = fs.open(pointer)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def table(self, name: str) -> DataFrame:
        """A table of the current run; the frame stays with that run."""
        run_id = self.current()
        if run_id is None:
            raise ValueError(f"nothing is published below {self.root}")
        return self.spark.read.parquet(f"{self.path(run_id)}/{name}")

    def switch(self, run_id: str, names: list[str] | None = None) -> None:
        """Let readers see a finished run, in one rename; ``names`` become views of this session."""
        fs, pointer = file_system(self.spark, f"{self.root}/_current")
        jvm = self.spark.sparkContext._jvm
        fresh = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_next-{run_id}")
        out = fs.create(fresh, True)
        try:
            out.write(bytearray(run_id.encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            pointer.toUri() if pointer.toUri().getScheme() else fs.getUri(),
            self.spark.sparkContext._jsc.hadoopConfiguration())
        option = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        context.rename(fresh, pointer, options)
        for name in names or []:
            as_view(self.table(name), name)

    def ids(self) -> list[str]:
        """All runs with a folder, oldest first."""
        fs, root = file_system(self.spark, self.root)
        found = fs.listStatus(root) if fs.exists(root) else []
        return sorted(f.getPath().getName() for f in found if f.isDirectory())

    def remove(self, run_id: str) -> None:
        fs, path = file_system(self.spark, self.path(run_id))
        fs.delete(path, True)

    def remove_old(self) -> list[str]:
        """Remove all but the newest ``keep`` runs (and never the current one)."""
        current = self.current()
        kept = {*self.ids()[-self.keep:], current}
        gone = [i for i in self.ids() if i not in kept]
        for run_id in gone:
            self.remove(run_id)
        return gone


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
