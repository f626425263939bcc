"""Session for tests and the bench, and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}


def local_session(cpus: int | str = 8, memory: str = "20g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("aeropanel")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aeropanel-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def tuned(spark: SparkSession) -> SparkSession:
    """Sets the one SQL option the engine asks for, unless the session has its own value.

    The JVM compiles no method over 8000 bytes of bytecode. With this limit Spark runs such a stage from smaller
    methods instead of as a single one that is only interpreted.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == "65535":
        spark.conf.set(limit, "8000")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; only a local session may go without."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="aeropanel-")
    return _own_folder[app]


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    """Gives the context a checkpoint folder below the shared one, unless it has one.

    Learners that run many rounds cut their lineage only if there is one; without it they go on without a word.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/aeropanel/checkpoints")


def written(df: DataFrame, path: str) -> DataFrame:
    """Writes a table and reads it by the schema it has, so that no job is run to find that out."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/aeropanel/{name}-{uuid.uuid4().hex}"
