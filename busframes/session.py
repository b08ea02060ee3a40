"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone: all formatted times are UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app: str = "busframes", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above. Without
    ``shuffle_partitions`` Spark's own setting holds."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at a shared file
    system; leaving it unset there is an error. Only a session with a local
    master (tests) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    context_dir = spark.sparkContext.getCheckpointDir()
    if base and not context_dir:
        # named in the configuration but not yet applied to the context
        spark.sparkContext.setCheckpointDir(base)
    if not base:
        base = context_dir
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="busframes-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return _qualified(spark, base).rstrip("/")


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without scheme belongs to Spark's default file system; tasks
    that open files themselves need to see that in the path."""
    if "://" in path or path.startswith("file:"):
        return path
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(conf).makeQualified(p).toString()
    return "file://" + full[len("file:"):] if full.startswith("file:/") and not full.startswith("file://") else full


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path under the shared checkpoint folder."""
    return f"{checkpoint_base(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``busframes`` importable in Python workers (once per context).

    Operators that run Python on executors (framing, data sources, sinks)
    call this. The package is zipped in memory, written into the shared
    checkpoint folder (through pyarrow's file-system layer, so HDFS or
    object stores work too) and registered with ``addPyFile``, as
    ``--py-files`` would on a cluster.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    target = shared_dir(spark, "pyfiles")
    from pyarrow import fs as pafs

    filesystem, root_path = pafs.FileSystem.from_uri(target)
    filesystem.create_dir(root_path, recursive=True)
    with filesystem.open_output_stream(f"{root_path}/busframes.zip") as out:
        out.write(data.getvalue())
    sc.addPyFile(f"{target}/busframes.zip")
    _SHIPPED.add(key)
