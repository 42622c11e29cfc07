"""Session construction and the shared scratch / checkpoint location.

On a cluster the checkpoint folder must be shared storage named by the
cluster's ``spark.checkpoint.dir``; we only ever read that setting. A folder of
our own is chosen only when the setting is absent *and* the master is local
(tests, laptops), because a machine-local folder is useless to executors on
other hosts.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Scratch folders made and not yet removed, and the catalog tables over them.
_SCRATCH: list[tuple[SparkSession, str]] = []
_TABLES: list[tuple[SparkSession, str, str]] = []

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "snapmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with UTC time, ANSI mode and AQE on.

    ``master`` is normally supplied by ``spark-submit``; pass it only for local
    runs. ``shuffle_partitions`` should track the cluster's cores for the data
    size at hand; AQE coalesces small partitions at runtime either way.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # A reused session keeps its own static conf; the runtime ones we can set.
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(key, conf[key])
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        return spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - some versions raise for unset keys
        return None


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session (no driver JVM here)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises when it is accessed
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, applying ``spark.checkpoint.dir`` if needed.

    A folder of our own (a local temp folder) is chosen only when nothing is
    configured and the master is local; otherwise a missing setting raises.
    """
    sc = _context(spark)
    if sc is None:  # Spark Connect: the server owns the checkpoint folder
        configured = _conf(spark, "spark.checkpoint.dir")
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or _conf(
        spark, "spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="snapmart-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/GCS) before running snapmart operators that cut lineage"
        )
    return sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """The context's checkpoint folder, with the uuid that Spark appends to the setting."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    It lasts until the :func:`scratch_run` around the call ends, or the driver does.
    """
    path = f"{checkpoint_root(spark)}/snapmart-scratch/{label}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(clear_scratch)
    _SCRATCH.append((spark, path))
    return path


def scratch_table(spark: SparkSession, label: str, path: str) -> str:
    """A fresh name for a catalog table over ``path``, which is dropped when that scratch folder goes, or the driver."""
    name = f"{label}_{uuid.uuid4().hex}".replace("-", "_")
    if not _SCRATCH and not _TABLES:
        atexit.register(clear_scratch)
    _TABLES.append((spark, name, path))
    return name


def _drop_tables(gone: Callable[[str], bool]) -> None:
    for entry in [t for t in _TABLES if gone(t[2])]:
        _TABLES.remove(entry)
        try:
            entry[0].sql(f"DROP TABLE IF EXISTS {entry[1]}")
        except Exception:  # noqa: BLE001 - the session may be stopped already
            continue


def clear_scratch(keep: int = 0) -> None:
    """Delete all scratch folders but the ``keep`` oldest; frames that read them end with them.

    Tables over them are dropped; with ``keep`` 0 also those over folders of a caller's, whose files stay.
    """
    if not keep:
        _drop_tables(lambda path: True)
    while len(_SCRATCH) > keep:
        spark, path = _SCRATCH.pop()
        _drop_tables(lambda over: over == path)  # noqa: B023 - used at once
        try:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # noqa: BLE001 - the session may be stopped already
            continue


@contextmanager
def scratch_run() -> Iterator[None]:
    """Delete the scratch folders that were made inside when the block ends.

    Read or write out what the queries returned before leaving it.
    """
    made = len(_SCRATCH)
    try:
        yield
    finally:
        clear_scratch(made)
