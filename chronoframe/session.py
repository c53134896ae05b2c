"""Session construction and shared-storage helpers.

Scratch output (round trips, cut lineage) goes under the folder the cluster
names in ``spark.checkpoint.dir``. Only a local master without that setting
(unit tests, a bare local session) gets a private temporary folder; on a
cluster a missing setting is an error, as executors share no local folder.
"""

from __future__ import annotations

import os
import shlex
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
#: Only for a session on this machine; a cluster's own settings stand.
_LOCAL = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"}


def _given() -> dict[str, str]:
    """What is configured outside this program: by spark-submit, which then
    runs it, by PYSPARK_SUBMIT_ARGS, or in spark-defaults.conf."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()  # noqa: SLF001 (connects to spark-submit's JVM)
        return dict(SparkConf().getAll())
    found = {}
    defaults = os.path.join(os.environ.get("SPARK_CONF_DIR", ""), "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults) as lines:
            found.update(x.split(None, 1) for x in map(str.strip, lines) if x.startswith("spark.") and len(x.split(None, 1)) == 2)
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    for flag, value in zip(args, args[1:], strict=False):
        if flag == "--master":
            found["spark.master"] = value
        elif flag == "--driver-memory":
            found["spark.driver.memory"] = value
        elif flag == "--conf" and "=" in value:
            key, _, text = value.partition("=")
            found[key] = text
    return found


def get_spark(master: str | None = None, app: str = "chronoframe", **conf: str) -> SparkSession:
    """Build (or return) a session with the engine's defaults.

    What spark-submit or the environment configures is kept: the defaults only
    fill gaps, and the master is ``local[$BENCH_CPUS]`` (8 when unset) only
    where none is given. Keyword settings override (dots written as ``__``).
    """
    given = _given()
    builder = SparkSession.builder.appName(app)
    settings = dict(_DEFAULTS)
    if master or "spark.master" not in given:
        master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
        builder = builder.master(master)
    if (master or given["spark.master"]).startswith("local"):
        settings |= _LOCAL
    settings = {k: v for k, v in settings.items() if k not in given}
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from the path the driver uses."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for scratch tables: the session's checkpoint directory.

    Reads ``spark.checkpoint.dir`` or an already registered checkpoint dir. A
    private temporary one is made only on a local master, as in tests.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: scratch tables need a folder that all executors share")
        root = tempfile.mkdtemp(prefix="chronoframe-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, in a folder of
    this application that :func:`drop_scratch` removes as a whole."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/chronoframe/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this application. Results that still read
    them are lazy, so call it only when they have been written or collected."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Cut lineage by writing a table to the shared checkpoint folder and
    reading it back: computed once, survives executor loss, and later jobs
    scan the (small) written result instead of recomputing it."""
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("overwrite").options(**options or {})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


_TABLES: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, ``{sf_dir}/{name}.parquet``.

    The scan DataFrame (file listing and footer schema) is reused within a
    session; DataFrames are immutable, so sharing one is safe.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df
