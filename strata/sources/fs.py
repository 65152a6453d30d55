"""Small file-system steps on any Hadoop path (file:, hdfs:, s3a:, …), done by the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """The visible entries of a folder; none if it does not exist."""
    fs, p = _open(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch of a folder's or file's last change."""
    fs, p = _open(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears as a whole: written beside its place under a hidden name, then renamed."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = _open(spark, f"{folder}/.{name}.part")
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target = _open(spark, path)[1]
    if not fs.rename(hidden, target) and not fs.exists(target):
        raise OSError(f"cannot rename to {path}")
