"""Session helpers: the shared scratch root and a local session for tests.

Intermediate tables (landed report pages, the flattened "lake" set, target
tables of the example runs) are written under the folder the cluster names in
``spark.checkpoint.dir``; that folder is shared storage on a real cluster, so
written data survives the loss of any executor.  Only when the setting is
absent (plain local sessions, tests) does this module make its own folder.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN_ROOTS: dict[int, str] = {}


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _is_local(spark: SparkSession, sc) -> bool:
    """Whether the session runs in local mode (driver and executors share one disk)."""
    master = None
    try:
        master = spark.conf.get("spark.master", None)
    except Exception:
        master = None
    if not master and sc is not None:
        master = sc.master
    return bool(master) and master.startswith("local") and not master.startswith("local-cluster")


def shared_root(spark: SparkSession) -> str:
    """Folder for lineage cuts and written intermediate tables."""
    configured = None
    try:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        configured = None
    sc = _context(spark)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark, sc):
        # A folder made here would live on the driver's disk only: executors
        # could not read it, and it would vanish with the driver.
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder on shared storage "
            "(HDFS, S3, ...) for intermediate tables")
    key = id(sc) if sc is not None else id(spark)
    if key not in _OWN_ROOTS:
        # Only local sessions without a configured folder (tests, plain local runs).
        root = tempfile.mkdtemp(prefix="ledgerline-")
        if sc is not None:
            sc.setCheckpointDir(root)
        _OWN_ROOTS[key] = root
    return _OWN_ROOTS[key]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never used folder under the shared root."""
    return f"{shared_root(spark)}/ledgerline/{label}-{uuid.uuid4().hex[:12]}"


def keyed_dir(spark: SparkSession, label: str, key: str) -> str:
    """A deterministic folder under the shared root (for reusable outputs)."""
    return f"{shared_root(spark)}/ledgerline/{label}/{key}"


def _hadoop_path(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path (any scheme), or None on Spark Connect."""
    sc = _context(spark)
    if sc is None:
        return None
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs, hpath


def _local(path: str) -> str:
    if "://" in path and not path.startswith("file:"):
        raise RuntimeError(f"no Hadoop file system access for {path} on this session")
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    h = _hadoop_path(spark, path)
    if h is None:
        return os.path.exists(_local(path))
    fs, hpath = h
    return bool(fs.exists(hpath))


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` (empty if it does not exist)."""
    h = _hadoop_path(spark, path)
    if h is None:
        p = _local(path)
        return sorted(os.listdir(p)) if os.path.isdir(p) else []
    fs, hpath = h
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath)]


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted (empty if it does not exist)."""
    h = _hadoop_path(spark, path)
    if h is None:
        p = _local(path)
        return sorted(n for n in (os.listdir(p) if os.path.isdir(p) else []) if os.path.isdir(os.path.join(p, n)))
    fs, hpath = h
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory())


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file, without a Spark job."""
    h = _hadoop_path(spark, path)
    if h is None:
        with open(_local(path)) as source:
            return source.read()
    fs, hpath = h
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_exclusive(spark: SparkSession, path: str, content: str) -> None:
    """Create a small file with its content; raises FileExistsError when it exists.

    Of several writers exactly one succeeds where the store has an exclusive
    create: a hard link on local and shared POSIX folders, the name node on
    HDFS.  Object stores need conditional writes for it.
    """
    h = _hadoop_path(spark, path)
    if h is None or h[0].getScheme() == "file":
        target = _local(path) if h is None else h[1].toUri().getPath()
        folder, name = os.path.split(target)
        os.makedirs(folder, exist_ok=True)
        draft = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
        with open(draft, "w") as out:
            out.write(content)
        try:
            os.link(draft, target)
        finally:
            os.remove(draft)
        return
    fs, hpath = h
    if fs.exists(hpath):
        raise FileExistsError(path)
    try:
        stream = fs.create(hpath, False)
    except Exception as error:
        if fs.exists(hpath):
            raise FileExistsError(path) from error
        raise
    stream.write(bytearray(content.encode()))
    stream.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library made and nothing reads any more (a missing one is no error)."""
    h = _hadoop_path(spark, path)
    if h is None:
        shutil.rmtree(_local(path), ignore_errors=True)
        return
    fs, hpath = h
    fs.delete(hpath, True)


def file_fingerprint(spark: SparkSession, path: str) -> str:
    """Length and modification time of a file or folder, for cache keys."""
    h = _hadoop_path(spark, path)
    if h is None:
        p = _local(path)
        names = sorted(os.listdir(p)) if os.path.isdir(p) else [""]
        parts = []
        for n in names:
            st = os.stat(os.path.join(p, n) if n else p)
            parts.append(f"{n}:{st.st_size}:{int(st.st_mtime * 1000)}")
        return "|".join(parts)
    fs, hpath = h
    st = fs.getFileStatus(hpath)
    if st.isDirectory():
        parts = sorted(
            f"{c.getPath().getName()}:{c.getLen()}:{c.getModificationTime()}"
            for c in fs.listStatus(hpath)
        )
        return "|".join(parts)
    return f"{st.getLen()}:{st.getModificationTime()}"


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline", driver_memory: str | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be."""
    n_cores = (os.cpu_count() or 1) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Small inputs still split into about three tasks per core; on large
        # inputs spark.sql.files.maxPartitionBytes sets the split size instead.
        .config("spark.sql.files.minPartitionNum", str(3 * n_cores))
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
