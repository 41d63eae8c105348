"""Driver-side file-system calls through Spark's Hadoop configuration.

Only metadata calls (is this path a directory, set a file's time) and writes of
single small files go through here; everything proportional to the data is a
Spark job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.getFileStatus(hpath).isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form, as the binaryFile listing reports paths."""
    fs, hpath = _fs_and_path(spark, path)
    return str(fs.makeQualified(hpath).toString())


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, hpath = _fs_and_path(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def set_modification_time(spark: SparkSession, path: str, epoch_ms: int) -> None:
    fs, hpath = _fs_and_path(spark, path)
    fs.setTimes(hpath, int(epoch_ms), -1)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _fs_and_path(spark, src)
    _, d = _fs_and_path(spark, dst)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def local_or_uri(path: str) -> str:
    """Spark path -> something pyarrow.fs / open() accept (executor side)."""
    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return p
    return path


def _arrow_path(path: str):
    import pyarrow.fs as pafs

    local = local_or_uri(path)
    return pafs.FileSystem.from_uri(local) if "://" in local else (pafs.LocalFileSystem(), local)


def arrow_file(path: str):
    """A file opened inside a task, for reading at any place."""
    system, plain = _arrow_path(path)
    return system.open_input_file(plain)


def arrow_reads(path: str) -> bool:
    """Whether ``pyarrow.fs`` knows the store of ``path`` (tasks can then open its files themselves)."""
    try:
        _arrow_path(path)
    except Exception:
        return False
    return True


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, hpath = _fs_and_path(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop glob pattern."""
    fs, hpath = _fs_and_path(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(hpath) or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs_and_path(spark, path)
    fs.delete(hpath, True)


def modification_time(spark: SparkSession, path: str) -> int:
    fs, hpath = _fs_and_path(spark, path)
    return int(fs.getFileStatus(hpath).getModificationTime())


def rename_new(spark: SparkSession, src: str, dst: str) -> None:
    """Rename that fails if ``dst`` exists."""
    jvm = spark.sparkContext._jvm
    (_, s), (_, d) = _fs_and_path(spark, src), _fs_and_path(spark, dst)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(d.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(context.makeQualified(s), context.makeQualified(d), kinds)
