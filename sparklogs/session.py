"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key means its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles methods above 8,000 bytes; Spark then splits the projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stream state lives on disk, so it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "sparklogs", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Without call sites in error messages, building a long chain of columns takes half the time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **RUNTIME_SETTINGS,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name for intermediate tables and stream checkpoints.

    It lies in the shared folder named by spark.checkpoint.dir. Only a local session without that
    setting, as in tests, gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sparklogs-")
    return f"{base.rstrip('/')}/sparklogs/{name}-{uuid.uuid4().hex}"


def spread(frame: DataFrame) -> DataFrame:
    """Rows over all cores when the input has fewer splits than there are cores, as one small file has.

    Parsing is bound by the processor, so this pays for tiny inputs; anything larger stays as it is and
    is not shuffled.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


#: Rows of a task that parses; a row takes up to half a millisecond.
ROWS_A_TASK = 200_000


def tasks_for(frame: DataFrame) -> int:
    """As many tasks as there are cores, and more where one would get above ROWS_A_TASK rows."""
    return max(frame.sparkSession.sparkContext.defaultParallelism, -(-frame.count() // ROWS_A_TASK))


def dealt(frame: DataFrame) -> DataFrame:
    """The rows of a narrow table dealt evenly to tasks of bounded length.

    The splits of a file do not tell how many rows they hold: a large row group lies in one of them, whatever their number.
    """
    return frame.repartition(tasks_for(frame))
