"""File-system calls on the shared storage, through Hadoop's FileSystem API
(so the same code works for local, HDFS or object-store paths)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names of the entries of a folder (empty if it does not exist).
    Names starting with ``_`` or ``.`` are skipped unless ``hidden``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n for n in names if hidden or not n.startswith(("_", ".")))


def total_size(spark: SparkSession, files: list[str]) -> int:
    """Bytes of the files; their folders are listed, once each."""
    folders: dict[str, set] = {}
    for f in files:
        folders.setdefault(f.rsplit("/", 1)[0], set()).add(f)
    size = 0
    for folder, wanted in folders.items():
        fs, p = _fs(spark, folder)
        size += sum(st.getLen() for st in fs.listStatus(p)
                    if st.getPath().toUri().toString() in wanted)
    return size


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole: to a temporary name, then renamed, so a
    reader never sees half of it."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, p):
        raise OSError(f"could not move {path}.tmp into place")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file that must not exist yet; False if it does."""
    from py4j.protocol import Py4JJavaError

    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
