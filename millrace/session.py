"""Session settings for large inputs, and where intermediate files go."""

from __future__ import annotations

import io
import os
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings this library is designed around. Joins are left to the
# optimizer: it broadcasts a side only when its size is known to be small, and
# otherwise splits skewed shuffle partitions at run time, also below a chain of
# joins on one key (forceOptimizeSkewedJoin).
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    """Set ``SCALE_SETTINGS`` on a running session and return it."""
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path for staged files, visible to every executor.

    The parent is the session's ``spark.checkpoint.dir``, or else the warehouse.
    On a cluster the latter must be in a store that executors share as well, not
    a folder of the driver's machine.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        parent = spark.conf.get("spark.sql.warehouse.dir")
        on_cluster = not spark.conf.get("spark.master", "local").startswith("local")
        if on_cluster and (":" not in parent or parent.startswith("file:")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return f"{parent.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as tables of the catalog need it."""
    files, place = _file_system(spark, path)
    return files.makeQualified(place).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, if it is there."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of one folder, and of the partition folders in it, into another; what has moved before is not missed."""
    files, place = _file_system(spark, source)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    to = paths(target)
    files.mkdirs(to)
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if name[0] in "_.":
            continue
        if status.isDirectory():
            move_files(spark, status.getPath().toString(), f"{to.toString()}/{name}")
        elif not files.rename(status.getPath(), paths(to, name)):
            raise OSError(f"cannot move {name} to {target}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless there is one; says whether it was written."""
    files, place = _file_system(spark, path)
    try:
        out = files.create(place, False)
    except Exception as e:
        if files.exists(place):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_texts(spark: SparkSession, folder: str) -> dict[str, str]:
    """The small text files of a folder by name; none if there is no such folder.

    A file that another driver removes while the folder is read is left out.
    """
    files, place = _file_system(spark, folder)
    if not files.exists(place):
        return {}
    out = {}
    for status in files.listStatus(place):
        try:
            stream = files.open(status.getPath())
        except Exception:
            if files.exists(status.getPath()):
                raise
            continue
        out[status.getPath().getName()] = bytes(stream.readAllBytes()).decode()
        stream.close()
    return out


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, such as a note or a journal, to any store."""
    files, place = _file_system(spark, path)
    out = files.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


_SHIPPED = "_millrace_shipped"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, once per session: it goes to them as a zip file.

    Nothing is sent if the workers find it on ``PYTHONPATH`` anyway.
    """
    context = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(package)
    if getattr(context, _SHIPPED, False) or parent in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, parent))
    target = f"{scratch_dir(spark, 'package')}/millrace.zip"
    files, place = _file_system(spark, target)
    out = files.create(place, True)
    out.write(bytearray(content.getvalue()))
    out.close()
    context.addPyFile(target)
    setattr(context, _SHIPPED, True)


def written(df: DataFrame, place: str) -> DataFrame:
    """The rows written once and read back, free of their lineage.

    ``place`` is a path, or a label for a new scratch folder.
    """
    path = place if "/" in place else scratch_dir(df.sparkSession, place)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
