"""Inventories as numbered versions, for streams that follow them.

A version holds all roles ever published, those no longer in the inventory marked as such,
the selected accounts, and the changes against the version before.  Writing the changes
is what publishes a version: the job that writes them commits as a whole, and nothing
reads a version without them.  A stream reads the changes folder as a source of its
own, so the checkpoint knows which versions it has taken in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.plans.tick import roles_in_scope
from rolehabit.settings import Settings
from rolehabit.sources.folders import create_marker, names_in, remove
from rolehabit.sources.inventory import selected_accounts

CHANGES = "role_id string, account string, present boolean, version bigint"


class InventoryVersions:
    """Versions below ``root``; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.root}/{kind}/v{version:08d}"

    def latest(self) -> int:
        """The newest version whose changes are committed; 0 if there is none."""
        names = [name for name in names_in(self.spark, f"{self.root}/changes") if name.startswith("v")]
        done = (n for n in sorted(names, reverse=True) if "_SUCCESS" in names_in(self.spark, f"{self.root}/changes/{n}"))
        return next((int(name[1:]) for name in done), 0)

    def publish(self, roles: DataFrame, accounts: DataFrame, settings: Settings = Settings()) -> int:
        """Make these inventories the newest version.  Leftovers of a failed attempt are replaced."""
        version = self.latest() + 1
        accounts = self._written(selected_accounts(accounts, settings), "accounts", version)
        found = roles_in_scope(roles, accounts).withColumn("present", F.lit(True))
        before = self.roles(version - 1) if version > 1 else found.limit(0)
        gone = before.join(found.select("role_id"), "role_id", "left_anti").withColumn("present", F.lit(False))
        every = self._written(found.unionByName(gone), "roles", version)
        was = before.select("role_id", F.col("account").alias("_account"), F.col("present").alias("_present"))
        changed = every.join(was, "role_id", "left").where(
            F.col("_present").isNull() | (F.col("_present") != F.col("present")) | ~F.col("_account").eqNullSafe(F.col("account"))
        )
        changed = changed.select("role_id", "account", "present", F.lit(version).cast("bigint").alias("version"))
        changed.write.mode("overwrite").parquet(self._folder("changes", version))
        return version

    def _written(self, frame: DataFrame, kind: str, version: int) -> DataFrame:
        frame.write.mode("overwrite").parquet(self._folder(kind, version))
        return self.spark.read.schema(frame.schema).parquet(self._folder(kind, version))

    def roles(self, version: int) -> DataFrame:
        """All roles up to a version, ``present`` telling whether they still are."""
        return self.spark.read.parquet(self._folder("roles", version))

    def accounts(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self._folder("accounts", version))

    def changes(self) -> DataFrame:
        """The stream of changes, from the first version on."""
        if not self.latest():
            raise ValueError("publish a version before a stream follows the inventory")
        reader = self.spark.readStream.schema(CHANGES).option("recursiveFileLookup", True)
        return reader.parquet(f"{self.root}/changes")

    def of_batch(self, checkpoint: str, batch_id: int, keep: int = 100) -> int:
        """The version a micro-batch takes details from: the newest, kept next to the
        stream's checkpoint so that a repeated batch takes the same."""
        folder = f"{checkpoint}/inventory"
        kept = dict(tuple(map(int, name.split("-"))) for name in names_in(self.spark, folder) if name[0].isdigit())
        if batch_id not in kept:
            kept[batch_id] = self.latest()
            create_marker(self.spark, f"{folder}/{batch_id:010d}-{kept[batch_id]}")
            for old in sorted(kept)[:-keep]:
                remove(self.spark, f"{folder}/{old:010d}-{kept[old]}")
        return kept[batch_id]
