"""The baseline, as numbered Parquet snapshots.

A snapshot is written to its own folder and counts only once a marker with its
number exists, so readers never see half a snapshot and nothing that is being
read is overwritten.  Snapshots are bucketed by the key: a tick's lookups and
its merge then shuffle the few rows of the tick and not the whole state.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.schemas import BASELINE, BASELINE_KEY
from rolehabit.sources.folders import create_marker, names_in, remove


class BaselineStore:
    """Snapshots below ``root``.

    ``buckets`` is fixed when the first snapshot is published.  Choose it so that
    a bucket of the expected state fits a task (some 128 MB), and not below
    ``spark.sql.shuffle.partitions``, or Spark prefers to shuffle the state.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        published = self._published()
        if published:
            self.buckets = next(iter(published.values()))[0]
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _published(self) -> dict[int, tuple[int, int]]:
        """Version → (buckets, run), from marker names such as ``00000012-64-1704067200``."""
        markers = [
            [int(part) for part in name.split("-")]
            for name in names_in(self.spark, f"{self.root}/published")
            if not name.startswith((".", "_"))
        ]
        return {version: (buckets, run) for version, buckets, run in markers}

    def _marker(self, version: int, buckets: int, run: int) -> str:
        return f"{self.root}/published/{version:08d}-{buckets}-{run}"

    def versions(self) -> list[int]:
        return sorted(self._published())

    def latest(self) -> int:
        """The newest published version; 0 stands for the empty baseline."""
        return max(self._published(), default=0)

    def runs(self) -> dict[int, int]:
        """Every run (its epoch second) that has published, and its version, expired ones too."""
        gone = [name.split("-") for name in names_in(self.spark, f"{self.root}/expired")]
        runs = {int(run): int(version) for version, run in (n for n in gone if len(n) == 2)}
        return runs | {run: version for version, (_, run) in self._published().items()}

    def _folder(self, version: int) -> str:
        return f"{self.root}/snapshots/v{version:08d}"

    def _table(self, version: int) -> str:
        return f"baseline_{zlib.crc32(self.root.encode()):08x}_v{version}"

    def load(self, version: int | None = None, bucketed: bool = True) -> DataFrame:
        version = self.latest() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], BASELINE)
        if not bucketed:
            return self.spark.read.schema(BASELINE).parquet(self._folder(version))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BASELINE)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table(version)} ({columns}) USING parquet "
            f"CLUSTERED BY ({', '.join(BASELINE_KEY)}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self._folder(version)}'"
        )
        return self.spark.table(self._table(version))

    def write(self, snapshot: DataFrame, version: int) -> None:
        """Write an unpublished version; a leftover of a failed run is replaced."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")
        (
            snapshot.select(*BASELINE.names)
            .write.mode("overwrite")
            .bucketBy(self.buckets, *BASELINE_KEY)
            .option("path", self._folder(version))
            .saveAsTable(self._table(version))
        )

    def publish(self, version: int, run_epoch: int) -> None:
        """Make a version the current one.  A store has one writer at a time; a
        second one that started from the same version is caught here."""
        if version in self._published():
            raise ValueError(f"version {version} already exists")
        create_marker(self.spark, self._marker(version, self.buckets, run_epoch))

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions."""
        published = self._published()
        for version in sorted(published)[: max(len(published) - keep, 0)]:
            gone = f"{version:08d}-{published[version][1]}"
            if gone not in names_in(self.spark, f"{self.root}/expired"):
                create_marker(self.spark, f"{self.root}/expired/{gone}")
            remove(self.spark, self._marker(version, *published[version]))
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")
            remove(self.spark, self._folder(version))


def live(baseline: DataFrame, run_epoch: int) -> DataFrame:
    """Rows that have not expired: a row is still good in its last second."""
    return baseline.where(F.col("ttl") >= F.lit(run_epoch).cast("bigint"))
