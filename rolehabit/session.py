"""Session defaults and the shared folder of a cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # '01' in a month folder must stay a text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # re-running a tick replaces that tick's folder and nothing else
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # lets an availableNow run of a processing-time state query come to its end
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(app: str = "rolehabit", **extra: str) -> SparkSession:
    """A session with the defaults above; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere the defaults results depend on."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches, named by ``spark.checkpoint.dir``.

    A local session without one gets a new temporary folder; on a cluster the
    setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="rolehabit-")
    return _LOCAL_FOLDERS[context.applicationId]
