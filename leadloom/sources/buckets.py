"""Tables in hash buckets of a key: a change reads and rewrites the buckets it falls in, and no others.

Data lie under ``base/data/version=V/bucket=B``, written by Spark's bucketed writer. The manifest ``base/manifest/version=V``
names for every bucket the version that holds it and counts its rows; it is one file, written last. A version without a
manifest does not exist: a change that was lost half-way leaves the table as it was, and is simply made again. The table is
read as a bucketed table, so a join on its key shuffles the other side alone. One writer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators.checkpoints import written

MANIFEST_DDL = "bucket INT, data_version BIGINT, n_rows BIGINT, n_marked BIGINT, n_buckets INT"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions below ``path``, rising; none if it does not exist."""
    try:
        return sorted(r.version for r in spark.read.parquet(path).select("version").distinct().collect())
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise


@dataclass(frozen=True)
class Keyed:
    """A stored table of ``ddl`` below ``base``, hashed by the column ``key``.

    ``buckets`` holds for a new table, a stored one keeps its own number. ``marked`` is a condition whose rows the manifest
    counts in each bucket.
    """

    base: str
    ddl: str
    key: str
    buckets: int = 64
    marked: str = "false"

    def columns(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.ddl).columns

    def newest(self, spark: SparkSession) -> int | None:
        known = versions(spark, f"{self.base}/manifest")
        return known[-1] if known else None

    def manifest(self, spark: SparkSession, version: int | None = None) -> list:
        """A row for each bucket of a version (the newest one); none if there is no table yet."""
        version = self.newest(spark) if version is None else version
        if version is None or version < 0:
            return []
        return spark.read.schema(MANIFEST_DDL).parquet(f"{self.base}/manifest/version={version}").where("bucket >= 0").collect()

    def bucket_of(self, held: list = ()) -> Column:
        """The bucket that Spark's writer and joins give a row."""
        return F.pmod(F.hash(self.key), F.lit(held[0].n_buckets if held else self.buckets)).cast("int").alias("bucket")

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """All rows; the plan knows that they are hashed by the key."""
        return self.read_held(spark, self.manifest(spark, version)).drop("bucket")

    def read_held(self, spark: SparkSession, held: list, touched: Iterable[int] | None = None) -> DataFrame:
        """The rows of a manifest, of some buckets only if these are given, with ``bucket``."""
        if not held:
            return spark.createDataFrame([], f"{self.ddl}, bucket INT")
        files = sorted((r.bucket, r.data_version) for r in held)
        name = "keyed_" + hashlib.md5(f"{self.base} {files} {held[0].n_buckets}".encode()).hexdigest()
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)  # a version that was lost may have been written again
        else:
            spark.sql(f"CREATE TABLE {name} ({self.ddl}, bucket INT) USING parquet PARTITIONED BY (bucket) "
                      f"CLUSTERED BY ({self.key}) INTO {held[0].n_buckets} BUCKETS LOCATION '{self.base}/data'")
            places = " ".join(f"PARTITION (bucket = {b}) LOCATION '{self.base}/data/version={v}/bucket={b}'" for b, v in files)
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
        table = spark.table(name)
        return table if touched is None else table.where(F.col("bucket").isin(sorted(touched)))

    def touched_by(self, rows: DataFrame, held: list) -> set[int]:
        """The buckets that rows fall in: at most as many as there are buckets."""
        return {r.bucket for r in rows.select(self.bucket_of(held)).distinct().collect()}

    def write(self, rows: DataFrame, version: int, held: list, touched: set[int] | None = None) -> int:
        """Write ``rows``, all that is in the ``touched`` buckets now, and commit; returns the rows of the table."""
        spark = rows.sparkSession
        columns, buckets = self.columns(spark), held[0].n_buckets if held else self.buckets
        if touched is not None and not touched:  # no bucket changes: the version is its manifest alone
            return self.commit(spark, [tuple(r) for r in held], version, buckets)
        name = "write_" + hashlib.md5(f"{self.base} {version}".encode()).hexdigest()
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # of an attempt that was lost; the files of an external table stay
        (rows.select(*columns, self.bucket_of(held)).write.format("parquet").mode("overwrite").partitionBy("bucket")
         .bucketBy(buckets, self.key).option("path", f"{self.base}/data/version={version}").saveAsTable(name))
        counted = spark.table(name).groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.expr(self.marked)).alias("marked")).collect()
        spark.sql(f"DROP TABLE {name}")
        kept = [tuple(r) for r in held if touched is not None and r.bucket not in touched]
        return self.commit(spark, kept + [(r.bucket, version, r.n, r.marked, buckets) for r in counted], version, buckets)

    def commit(self, spark: SparkSession, held: list[tuple], version: int, buckets: int) -> int:
        """Write the manifest of a version; returns the rows of the table."""
        listed = list(held)
        listed.append((-1, version, 0, 0, buckets))  # a version without rows is a version, too
        (spark.createDataFrame(listed, MANIFEST_DDL).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.base}/manifest/version={version}"))
        return sum(r[2] for r in listed)

    def upsert(self, spark: SparkSession, rows: DataFrame, version: int | None = None, after: int | None = None) -> int:
        """Replace or add ``rows``, one for each key (rows without key are left out), as ``version``, the next one.

        The change is made to version ``after``, the one before; so a repeated change names its version again.
        """
        version, held = self.start(spark, version, after)
        batch = written(rows.select(*self.columns(spark)).where(F.col(self.key).isNotNull()))
        touched = self.touched_by(batch, held)
        old = self.read_held(spark, held, touched).drop("bucket")
        rest = [c for c in old.columns if c != self.key]
        both = old.select(self.key, F.struct(*rest).alias("old")).join(batch.select(self.key, F.struct(*rest).alias("new")), self.key, "full_outer")
        return self.write(both.select(self.key, F.coalesce("new", "old").alias("row")).select(self.key, "row.*"), version, held, touched)

    def replace(self, spark: SparkSession, rows: DataFrame, version: int | None = None) -> int:
        """Write ``rows`` as the whole table of ``version``, the next one."""
        version, _ = self.start(spark, version, -1)
        return self.write(rows.repartition(self.buckets, self.key), version, [])

    def start(self, spark: SparkSession, version: int | None = None, after: int | None = None) -> tuple[int, list]:
        """The version to write, and the manifest it changes."""
        if version is None:
            newest = self.newest(spark)
            version = 0 if newest is None else newest + 1
        return version, self.manifest(spark, version - 1 if after is None else after)
