"""Session settings and the shared folder that staged data goes to."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_lock = threading.Lock()
_folders: dict[str, str] = {}


def build_session(app_name: str = "tablemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` overrides any of them.

    The shuffle partition count is left to the cluster: AQE coalesces small partitions
    and splits skewed ones at run time.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else by ``setCheckpointDir``.

    A local-mode session without the setting gets a fresh temporary folder.  On a
    cluster a machine-local folder would lose data with its machine, so there the
    setting is required.
    """
    with _lock:
        found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if found:
            return found.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        fresh = tempfile.mkdtemp(prefix="tablemill-")
        spark.conf.set("spark.checkpoint.dir", fresh)
        return fresh


def application_dir(spark: SparkSession) -> str:
    """This application's own folder under the shared one; everything that is staged lies in it."""
    shared, application = shared_dir(spark), spark.sparkContext.applicationId
    with _lock:
        if application not in _folders:
            _folders[application] = f"{shared}/tablemill-{application}-{uuid.uuid4().hex}"
        return _folders[application]


def drop_application_dir(spark: SparkSession) -> None:
    """Remove the application's folder; a new one is made when it is next needed."""
    with _lock:
        folder = _folders.pop(spark.sparkContext.applicationId, None)
    if folder:
        drop_path(spark, folder)


def drop_path(spark: SparkSession, folder: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in the application's folder."""
    return f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked without a job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a line of text to a file, whole or not at all, without a job; a file that is there stays."""
    jvm = spark._jvm
    place, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft)
    out.writeBytes(text)
    out.close()
    if not files.rename(draft, place):
        files.delete(draft, False)


def read_note(spark: SparkSession, path: str) -> str:
    """The text of a small file, without a job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    opened = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()
