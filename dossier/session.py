"""Session settings, table access and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings that the operators rely on; all of them can be changed at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(name: str = "dossier", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return prepare(session)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that somebody else made."""
    for key in ("spark.sql.session.timeZone", "spark.sql.mapKeyDedupPolicy"):
        spark.conf.set(key, SETTINGS[key])
    _ship(spark)
    return spark


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="dossier-code-")) / "dossier_code.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, f"dossier/{source.relative_to(package)}")
        spark.sparkContext.addPyFile(str(target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in the one that the session names in ``spark.checkpoint.dir``, which all executors share.

    Where nobody named one, a local master (tests on one machine) gets a temporary folder; a cluster is an error, since its
    executors would each write to a disk of their own. The folder goes when Python ends.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="dossier-")
        _FOLDERS[app] = f"{base.rstrip('/')}/dossier-{app}"
        atexit.register(_remove, spark, _FOLDERS[app])
    return _FOLDERS[app]


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may be gone already
        pass


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    The files outlive executors, so what follows survives their loss; being columnar and compressed they take a fraction of
    the room of checkpointed rows, later steps read only the columns that they need, and their size is known to the planner.
    ``drop_cut`` frees the room once nothing reads the table any more.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    cut = df.sparkSession.read.schema(df.schema).parquet(path)
    cut.cut_path = path
    return cut


def drop_cut(*frames: DataFrame) -> None:
    """Delete the tables of frames that ``cut_lineage`` returned, after all that reads them has been written itself. Others are left alone."""
    for df in frames:
        if path := getattr(df, "cut_path", None):
            _remove(df.sparkSession, path)
