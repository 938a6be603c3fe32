"""Session and work folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    n = cores if str(cores).isdigit() else 8
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _own_folder() -> str:
    """A folder on the driver's disk that goes when Python ends."""
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def one_row(spark: SparkSession) -> DataFrame:
    """A frame of one row, to select constants from."""
    return spark.sql("SELECT 1 AS one")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    It is the one named in ``spark.checkpoint.dir``. Only a local session may go without that
    setting; there a temporary folder is made once for the session.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(shared)
        return shared.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(_own_folder())
    return sc.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the work folder that no other run uses."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need not find it
    on their own path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(_own_folder(), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
