"""Driver-side listing of file *paths* through Hadoop's FileSystem (works for
any cluster file system). Only names travel to the driver, never data."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def list_status(spark: SparkSession, root: str, recursive: bool = True) -> list:
    """(path, bytes, modification time in ms) of the files below ``root``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    it = fs.listFiles(path, recursive)
    out = []
    while it.hasNext():
        st = it.next()
        out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return out


def list_files(spark: SparkSession, root: str, recursive: bool = True) -> list:
    """(path, bytes) of the files below ``root``."""
    return [(p, n) for p, n, _ in list_status(spark, root, recursive)]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def uri_path(spark: SparkSession, root: str) -> str:
    """The path part of ``root``'s full URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri().getPath()


def list_dirs(spark: SparkSession, root: str) -> list:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    return [st.getPath().getName() for st in fs.listStatus(path) if st.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate folder of this library (one made by ``session.work_dir``), nothing else."""
    from pitpanel.session import work_dir
    if not path.startswith(f"{work_dir(spark)}/pitpanel/"):
        raise ValueError(f"not an intermediate folder: {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def plain_name(c) -> Column:
    """A file name or path of ``_metadata`` (a URI) without %-escapes; a literal "+" stays."""
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))
