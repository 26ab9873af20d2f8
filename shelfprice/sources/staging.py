"""Layer tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Layers take room until the query ends: a third less with this codec than with the default one.
CODEC = "zstd"
#: Short rows, and rows with a text, that are worth a file of their own.
ROWS_A_FILE, TEXTS_A_FILE = 1 << 16, 1 << 11
_own_dirs: dict[str, str] = {}
_written: list[str] = []
#: Scans of layers, with the path of each.
_layers: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it, so a missing setting is an error there.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors can reach")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="shelfprice-")
    return _own_dirs[context.applicationId]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Each query run inside deletes its shuffle files when it ends.

    Otherwise they stay until the driver happens to collect its garbage, so a job that writes one layer after the other
    holds the shuffles of all. For results that are written or collected once: a frame that is run again shuffles again.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def in_few_files(df: DataFrame, rows: int, a_file: int = ROWS_A_FILE) -> DataFrame:
    """``df``, of about ``rows`` rows, in no more partitions than it has shares of ``a_file`` rows.

    A shuffle leaves as many partitions as are set, whatever the rows, and each file costs a task several calls of the
    file system (on a local one without Hadoop's native library, processes that set its rights).
    """
    return df.coalesce(1 + rows // a_file)


def write_through(df: DataFrame, label: str, rows: int | None = None, a_file: int = ROWS_A_FILE, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the scan of it.

    Used where several consumers share an expensive input. It cuts the lineage
    without tying data to executors, later reads prune columns and push
    filters, and the planner knows the real size of the table. A frame that
    is such a scan already is returned as it is, not written a second time.
    With ``rows``, about how many there are, it is written in few files.
    """
    if df in _layers:
        return df
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shelfprice/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    writer = (df if rows is None else in_few_files(df, rows, a_file)).write
    (writer if codec is None else writer.option("compression", codec)).parquet(path)
    layer = spark.read.schema(df.schema).parquet(path)
    _layers[layer] = path
    return layer


def write_layer(df: DataFrame, label: str) -> DataFrame:
    """``write_through`` that spares the disk: the layer takes less room, and what was shuffled for it is deleted."""
    with shuffles_dropped(df.sparkSession):
        return write_through(df, label, codec=CODEC)


def rows_of(layer: DataFrame, condition: Column) -> DataFrame:
    """Some rows of a layer, which ``write_through`` does not write a second time either: reading them costs a scan."""
    rows = layer.filter(condition)
    if layer in _layers:
        _layers[rows] = _layers[layer]
    return rows


def drop(*layers: DataFrame) -> None:
    """Delete layers that nothing reads any more; a frame that is no layer is left alone."""
    for layer in layers:
        path = _layers.pop(layer, None)
        if path in _written:
            _written.remove(path)
            delete(layer.sparkSession, path)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the layers that this process has written, the first ``since`` of them excepted.

    For when the results that read them are written elsewhere or no longer
    needed: a layer is as large as what it holds, and nothing else removes it.
    """
    while len(_written) > since:
        delete(spark, _written.pop())


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def short_lived_layers(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Layers written inside are deleted at the end, those excepted that are put into the list; what else is to stay
    has to be written elsewhere inside."""
    before, kept = len(_written), []
    try:
        yield kept
    finally:
        staying = [path for path in map(_layers.get, kept) if path in _written[before:]]
        _written[before:] = [path for path in _written[before:] if path not in staying]
        release(spark, before)
        _written.extend(staying)
