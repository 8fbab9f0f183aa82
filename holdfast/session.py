"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_scratch: tempfile.TemporaryDirectory | None = None
_written: dict[tuple[str, str, str], str] = {}
_schemas: dict[str, StructType] = {}


def local_session(cores: int | str = "*", app: str = "holdfast", warehouse: str = "spark-warehouse") -> SparkSession:
    """Session for tests and benches; a cluster brings its own."""
    parallelism = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str | None:
    """Folder all executors can reach: the cluster's checkpoint folder.

    Where none is set, a local master gets a temporary one and a cluster gets None.
    """
    global _scratch
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        return None
    if _scratch is None:
        _scratch = tempfile.TemporaryDirectory(prefix="holdfast-", ignore_cleanup_errors=True)
    return _scratch.name


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder."""
    base = shared_dir(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{base}/holdfast/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def _files(spark: SparkSession, path: str):
    """File system and path object of Hadoop, which open any store that Spark reads."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


def fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of path, length and time of every file under a path, from listings alone. A path that
    is not there has one too. What Spark does not read (names with a dot or underscore) is left out."""
    files, place = _files(spark, path)
    found, folders = [], [place] if files.exists(place) else []
    while folders:
        for status in files.listStatus(folders.pop()):
            if status.getPath().getName().startswith((".", "_")):
                continue
            if status.isDirectory():
                folders.append(status.getPath())
            else:
                found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def drop_written(spark: SparkSession) -> None:
    """Delete every table this application wrote to the shared folder; later queries write anew."""
    base, app = shared_dir(spark), spark.sparkContext.applicationId
    if base is not None:
        files, place = _files(spark, f"{base}/holdfast/{app}")
        files.delete(place, True)
    for key in [k for k in _written if k[0] == app]:
        _schemas.pop(_written.pop(key), None)


def written_once(
    spark: SparkSession, scope: str, name: str, write: Callable[[str], None]
) -> str:
    """Path of an output that is written once per application and state of its input: ``scope`` is
    the folder of the input, and a file that changes there makes a new output."""
    key = (spark.sparkContext.applicationId, f"{scope} {fingerprint(spark, scope)}", name)
    if key not in _written:
        path = new_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def written_table(spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The built frame, read back from Parquet so later plans start at a pruned scan.

    Without a shared folder the frame is returned as it is.
    """
    if shared_dir(spark) is None:
        return build()

    def write(path: str) -> None:
        frame = build()
        frame.write.mode("errorifexists").parquet(path)
        _schemas[path] = frame.schema

    path = written_once(spark, scope, name, write)
    return spark.read.schema(_schemas[path]).parquet(path)
