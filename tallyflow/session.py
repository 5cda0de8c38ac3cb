"""Session helpers: one place for time zone, ANSI mode and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str = "local[*]",
    app_name: str = "tallyflow",
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Classic session with the settings every job here assumes.

    UTC is mandatory: zone-less event times are read in the session zone and
    the silver day partitions are rendered from it. AQE stays on so shuffle
    partition counts adapt at runtime and skewed partitions are split.
    ``input_bytes`` sizes scans and shuffles for a run (``scale_settings``);
    ``shuffle_partitions`` is for tests and small runs and wins over it.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    sizing = scale_settings(input_bytes) if input_bytes else {}
    if shuffle_partitions:
        sizing["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        sizing.pop("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    for key, value in {**sizing, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MiB = 1024 * 1024


def scale_settings(
    input_bytes: int,
    scan_bytes: int = 512 * MiB,
    shuffle_bytes: int = 2048 * MiB,
) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of bronze.

    Scans split at ``scan_bytes`` (M map tasks); the widest shuffle (silver
    dedup, about the whole validated row set) gets one reducer per
    ``shuffle_bytes`` (R), sorted with spill, and AQE coalesces small ones.
    Keeping R well below M bounds the M x R shuffle blocks the driver tracks:
    at 100 TB, M ~ 200k and R ~ 51k (compressed map statuses of a few KB per
    map task) instead of 400k x 400k with uniform 256 MiB partitions.
    """
    reducers = max(200, -(-input_bytes // shuffle_bytes))
    return {
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_bytes // (2 * MiB)}m",
        "spark.sql.files.maxPartitionBytes": f"{scan_bytes // MiB}m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; the session's own values come back after."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def sized_for(spark: SparkSession, input_bytes: int):
    """Sizing for a run over ``input_bytes``. Inputs below a gigabyte keep the session's values."""
    return settings(spark, scale_settings(input_bytes) if input_bytes >= 1024 * MiB else {})


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (the pipeline contract) and return the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset and the session is local (a
    test or a laptop run) do we create one under the system temp root; a
    cluster without the setting is an error, never a silent machine-local dir.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(
        CHECKPOINT_CONF, None
    )
    if not root:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} must name a shared folder on a cluster"
            )
        root = tempfile.mkdtemp(prefix="tallyflow-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/tallyflow/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for what a job must write and read again. Jobs that know
    when they are done remove theirs; a result that is read later keeps its folders
    until ``remove_scratch``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove all that this application has left below the checkpoint root: call it when
    every result has been read or written."""
    remove(spark, scratch_root(spark))


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS, object store)."""
    fs, p = _file(spark, path)
    return bool(fs.exists(p))


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _file(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isFile())


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``; 0 where it doesn't exist."""
    fs, p = _file(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch at which the file or folder last changed."""
    fs, p = _file(spark, path)
    return fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    """A small control file's text."""
    fs, p = _file(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file; an existing one is an error."""
    fs, p = _file(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def _rename(spark: SparkSession, source: str, target: str, how: str) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    _, p = _file(spark, source)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = getattr(kind, how)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(p), context.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), options)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless the new name is taken; whether it was renamed."""
    from py4j.protocol import Py4JJavaError

    try:
        _rename(spark, source, target, "NONE")
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small control file in one step: written aside, then renamed over it."""
    aside = f"{path}.{uuid.uuid4().hex[:8]}"
    create_file(spark, aside, text)
    _rename(spark, aside, path, "OVERWRITE")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file(spark, path)
    if not fs.exists(p):
        fs.mkdirs(p)


def rename_over(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, over one of that name."""
    _rename(spark, source, target, "OVERWRITE")


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below a folder."""
    fs, p = _file(spark, path)
    found, files = [], fs.listFiles(p, True)
    while files.hasNext():
        found.append(files.next().getPath().toString())
    return found


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it doesn't exist."""
    fs, p = _file(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file(spark, path)
    fs.delete(p, True)
