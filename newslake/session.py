"""Session defaults and the shared folder for tables that cut a plan in two."""

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


# What the operators count on. All of these can be set on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages are large; batches bounded by bytes keep the Python workers' memory flat.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
    # A stream's state lies on the executors' disks, not in their heaps, which would hold every id of every stream that a
    # session has run in the last minutes. All stores of an executor share one bound on their memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Put the settings on a session that somebody else made."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name="newslake", master=None, extra=None):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the caller names in ``spark.checkpoint.dir``; where none is named, a local master gets one."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="newslake-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, unique to this call."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _place(spark, path)
    return store.exists(place)


def matches(spark: SparkSession, glob: str) -> bool:
    """Does a path or glob name anything?"""
    store, place = _place(spark, glob)
    return bool(store.globStatus(place))


def child_names(spark: SparkSession, path: str) -> list:
    """The names of the folders in a folder; none where there is no such folder."""
    store, place = _place(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place) if s.isDirectory()] if store.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package has made, with all in it."""
    store, place = _place(spark, path)
    store.delete(place, True)


_passing = []  # for each open ``passing`` block, the tables made in it


@contextlib.contextmanager
def passing(spark: SparkSession):
    """Within the block, tables that ``staged`` makes are removed at its end; its results must be written by then."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            delete(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The result no longer depends on executors staying alive, is computed once however often it is
    used, and its file size is known to the optimizer, so a join with it is broadcast exactly when
    it is below ``spark.sql.autoBroadcastJoinThreshold``. Jobs that write their result remove these tables
    (``passing``); those of an operator whose result is still to be read stay, in a folder named after the application.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _passing:
        _passing[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
