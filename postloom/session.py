"""Session settings and the shared folder for tables written between stages."""

from __future__ import annotations

import gc
import hashlib
import importlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Applied to a new session where the application did not set them itself.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL_DIRS: dict[str, str] = {}
_SHIPPED: set[tuple[str, str]] = set()


def build_session(app_name: str = "postloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, taken from ``spark.checkpoint.dir``.

    A local-mode session without the setting gets a fresh temporary folder; on a
    cluster a machine-local folder would be invisible to other hosts, so a missing
    setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    already_set = context.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="postloom-", dir="/tmp")
        context.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/postloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, and fixes values that a
    recomputation might assign differently (positions, remote answers).
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    release_dropped(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_dropped(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files and broadcasts of plans that nothing refers to any more.

    Its cleaner waits until the driver collects its garbage, by itself every 30 minutes;
    a job of many written tables would keep the files of all its earlier shuffles so long,
    and their plans in the driver.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def package_archive(name: str, folder: Path) -> Path:
    """A zip of a package's sources, named by its content: equal sources give equal files."""
    root = Path(importlib.import_module(name).__file__).parent
    sources = [(str(Path(name) / p.relative_to(root)), p.read_bytes()) for p in sorted(root.rglob("*.py"))]
    content = hashlib.sha256()
    for place, code in sources:
        content.update(f"{place}:{len(code)}:".encode() + code)
    archive = folder / f"{name}-{content.hexdigest()[:16]}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for place, code in sources:
            target.writestr(zipfile.ZipInfo(place, date_time=(1980, 1, 1, 0, 0, 0)), code)
    return archive


def ship_packages(spark: SparkSession, *names: str) -> None:
    """Send the source of packages to the executors, whose hooks import them.

    For sessions whose executors do not have the packages installed and that were started
    without ``--py-files``. Each package is sent once per application, in an archive of its
    own, in whatever combination and order calls name it.
    """
    context = spark.sparkContext
    for name in names:
        if (context.applicationId, name) not in _SHIPPED:
            context.addPyFile(str(package_archive(name, Path(tempfile.mkdtemp(prefix="postloom-source-")))))
            _SHIPPED.add((context.applicationId, name))
