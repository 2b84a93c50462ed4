"""Session settings and lineage cutting.

Iterative jobs (connected components, dense ids, rounds) cut their lineage by
writing each step as Parquet under the folder the cluster names in
``spark.checkpoint.dir`` and reading it back.  A written step survives the
loss of executors, gives AQE real sizes for its broadcast decisions, and is
computed once (``Dataset.checkpoint`` would compute an uncached plan twice).
"""

from __future__ import annotations

import functools
import re
import tempfile
import threading
import uuid
from typing import Any, Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings every session should carry: AQE re-plans joins from real sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` on ``cores`` cores.

    Scans are cut into ``partition_bytes`` splits.  Shuffles start with
    enough partitions for the largest edge shuffle (about the input size, at
    ``partition_bytes`` each, and at least two waves of tasks) and AQE
    coalesces them towards the same advisory size; a partition is treated as
    skewed above four times that size and split.
    """
    parts = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 8),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def get_session(master: str | None = None, app: str = "stellate",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local-mode session without one gets a private temporary folder;
    on a cluster a missing setting is an error, since a machine-local folder
    would not be seen by the other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):  # one process; not local-cluster
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="stellate-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


#: Written steps of the functions under :func:`tidy` that are running in this thread.
_scopes = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place under the checkpoint folder (see :func:`tidy`)."""
    path = f"{checkpoint_root(spark).rstrip('/')}/stellate/{name}-{uuid.uuid4().hex}"
    running = getattr(_scopes, "stack", None)
    if running:
        running[-1][path] = spark
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return a scan of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: reading it back needs no inference job.
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stellate_path = path  # type: ignore[attr-defined]
    return out


def _frames(result: Any) -> list[DataFrame]:
    """The DataFrames in the result of a library function."""
    if isinstance(result, DataFrame):
        return [result]
    if isinstance(result, (list, tuple)):
        return [f for x in result for f in _frames(x)]
    if hasattr(result, "__dataclass_fields__"):
        return [f for x in vars(result).values() for f in _frames(x)]
    return []


def _read_paths(df: DataFrame) -> set[str]:
    """Root folders of the files that a DataFrame will read."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths()
                out |= {roots.apply(k).toUri().getPath() for k in range(roots.size())}
    return out


def tidy(fn: Callable) -> Callable:
    """Decorator: when ``fn`` returns, the steps that it has written and that
    its result does not read are deleted (all of them if it fails).  The
    others go with the result, see :func:`release`, or with the function
    around it that is tidied too."""
    @functools.wraps(fn)
    def run(*args, **kwargs):
        stack = _scopes.__dict__.setdefault("stack", [])
        mine: dict[str, SparkSession] = {}
        stack.append(mine)
        try:
            out = fn(*args, **kwargs)
            frames = _frames(out) if mine else []
            reads = [_read_paths(f) for f in frames]
        except BaseException:
            stack.pop()
            for path, spark in mine.items():
                delete_path(spark, path)
            raise
        stack.pop()
        for f in frames:
            f._stellate_steps = []  # type: ignore[attr-defined]
        for path, spark in mine.items():
            root = hadoop_fs(spark, path)[0].toUri().getPath()
            readers = [f for f, r in zip(frames, reads) if any(f"{x}/".startswith(f"{root}/") for x in r)]
            for f in readers:
                f._stellate_steps.append(path)  # type: ignore[attr-defined]
            if not readers:
                delete_path(spark, path)
            elif stack:
                stack[-1][path] = spark
        return out

    return run


def hadoop_fs(spark: SparkSession, path: str):
    """``(Path, FileSystem)`` of a location, through the session's Hadoop
    configuration (works for any file system the cluster is set up for)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a whole small file at once: it is written aside and renamed to
    ``path``.  False (and nothing changed) if there is a file already."""
    p, fs = hadoop_fs(spark, path)
    aside, _ = hadoop_fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(aside, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    none = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").valueOf("NONE")
    how = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    how[0] = none
    try:
        # Unlike FileSystem.rename, this one fails where the name is taken.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(aside), fs.makeQualified(p), how)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(aside, False)


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file (metadata)."""
    p, fs = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote (old steps of an iteration)."""
    p, fs = hadoop_fs(spark, path)
    fs.delete(p, True)


def release(df: DataFrame | None) -> None:
    """Delete the files behind a DataFrame made by :func:`materialize`, or
    the steps that the result of a tidied function reads, after its use."""
    if df is None:
        return
    path = getattr(df, "_stellate_path", None)
    for p in [path] if path else getattr(df, "_stellate_steps", ()):
        delete_path(df.sparkSession, p)


def stored_bytes(df: DataFrame) -> int | None:
    """Size on storage of a DataFrame made by :func:`materialize`."""
    path = getattr(df, "_stellate_path", None)
    if not path:
        return None
    p, fs = hadoop_fs(df.sparkSession, path)
    return int(fs.getContentSummary(p).getLength())


def broadcast_limit(spark: SparkSession) -> int:
    """The broadcast threshold in bytes (-1: never broadcast)."""
    v = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    v = v.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
    for u in sorted(units, key=len, reverse=True):
        if v.endswith(u) and v[:-len(u)].strip().lstrip("-").isdigit():
            return int(v[:-len(u)]) * units[u]
    return int(v)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan: the figure Spark compares with
    the broadcast threshold when it plans a join."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_input(df: DataFrame, name: str) -> DataFrame:
    """Prepare the one-row-per-key side of a join.

    Under the broadcast threshold the plan is left as it is and Spark
    broadcasts it (a checked size).  Above it the side is written out: AQE's
    skew split needs both join inputs to be plain shuffle stages, and a side
    that ends in an aggregate or a join is not one.  Written, a hot key on
    the other side (a hub vertex, a giant component) is split over tasks.
    """
    limit = broadcast_limit(df.sparkSession)
    if 0 <= limit and estimated_bytes(df) <= limit:
        return df
    return materialize(df, name)


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    p, fs = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty when it does not exist)."""
    p, fs = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def few_listing_tasks(spark: SparkSession) -> None:
    """From now on the session lists many folders or files in at most as many
    tasks as a shuffle has, and not in one task each.  A file stream reads the
    setting of its session at every batch, so it stays."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    spark.conf.set(name, str(min(int(spark.conf.get(name)), max(1, shuffle_partitions(spark)))))


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
            null_safe: tuple[str, ...] = ()) -> DataFrame:
    """Equi-join on same-named ``keys``, keeping one copy of each key.

    Keys named in ``null_safe`` match NULL to NULL (``<=>``); Spark still
    plans these as equi-join keys (hash / sort-merge), so nothing is lost in
    the physical plan.
    """
    if not null_safe:
        return left.join(right, keys, how)
    r = right.select(*[right[k].alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = (left[k].eqNullSafe(r[f"_r_{k}"]) if k in null_safe else left[k] == r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    return out.drop(*[f"_r_{k}" for k in keys])
