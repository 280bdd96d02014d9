"""What the operators share: table access, the shared folder, shipping code to executors."""

from __future__ import annotations

import atexit
import functools
import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = 2000
_LOCK = threading.Lock()
_BEFORE: list[dict] = []
_SHIPPED: set[str] = set()
_ROOTS: list[tuple] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application.

    Executors then need no copy of it on their own path; the archive travels
    through Spark's file server.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="sparlode-")
    archive = os.path.join(folder, f"sparlode-{app}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, as the cluster sets it.

    Only a local session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="sparlode-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _folder(spark: SparkSession, path: str) -> tuple:
    """A folder's file system and path, as JVM objects."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@atexit.register
def clean(first: int = 0) -> None:
    """Delete the scratch folders of this process, from the one numbered `first` on; sessions may be stopped by then, the JVM not."""
    while len(_ROOTS) > first:
        fs, where = _ROOTS.pop()
        try:
            fs.delete(where, True)
        except Exception:  # the JVM is gone, too; the folder is scratch
            pass


@contextmanager
def _writing(spark: SparkSession, most: int):
    """The settings of scratch writes; the last of several at once restores what was set before."""
    conf = spark.conf
    before = conf.get(_BATCH)
    rows = before if 0 < int(before) <= most else str(most)
    with _LOCK:
        if not _BEFORE:
            _BEFORE.append({k: conf.get(k, None) for k in (_BATCH, _CLEANUP)})
            conf.set(_CLEANUP, "true")
        conf.set(_BATCH, rows)
        _BEFORE.append({})
    try:
        yield
    finally:
        with _LOCK:
            _BEFORE.pop()
            if len(_BEFORE) == 1:
                for k, v in _BEFORE.pop().items():
                    conf.unset(k) if v is None else conf.set(k, v)


class Scratch:
    """Intermediate tables in the shared folder: written once, read again with short lineage."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        _ROOTS.append(_folder(spark, self.root))

    def put(self, df: DataFrame, name: str, rows: int = BATCH_ROWS) -> DataFrame:
        """Write a table and read it again.

        While it is written, batches for Python hold at most `rows` rows: rows hold whole
        texts, and an executor has a batch in each direction for every core. Spark deletes the
        shuffle files of the write when it is done; the table takes their place.
        """
        path = f"{self.root}/{name}"
        with _writing(self.spark, rows):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        fs, where = _folder(self.spark, f"{self.root}/{name}")
        fs.delete(where, True)


def scratch_count() -> int:
    """How many scratch folders there are: `clean` from there deletes what later steps write."""
    return len(_ROOTS)


def wide(spark: SparkSession) -> int:
    """Partitions for a shuffle by key: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_remainder(column: str, modulus: int):
    """crc32 of an identifier as text, modulo `modulus`; null for a null identifier."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


@functools.cache
def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def splitting_pattern() -> str:
    """The pattern that goes with the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN
