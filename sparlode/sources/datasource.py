"""The format name `sparlode` for spark.read.format(...) and df.write.format(...).

Rows cross to Python, so this is for compatibility with code that names a format; read_index
and plain Parquet are the fast way. Files are read by pyarrow, so paths must be local or
mounted on every executor. The schema comes from the files unless given. Options: path; push,
"true" to prune by filters on top-level columns, which needs the session setting
spark.sql.python.filterPushdown.enabled.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql import datasource as api
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType


def _local(path: str) -> str:
    return path.removeprefix("file://")


def _dataset(path: str) -> ds.Dataset:
    return ds.dataset(_local(path), format="parquet", partitioning="hive", exclude_invalid_files=False, ignore_prefixes=["_", "."])


@dataclass
class FilePartition(api.InputPartition):
    file: str


def _expression(f: api.Filter) -> pc.Expression | None:
    """The filter for pyarrow, or None where the two might differ."""
    if isinstance(f, api.Not):
        return None  # three-valued logic is left to Spark
    if len(f.attribute) != 1:
        return None
    col = pc.field(f.attribute[0])
    if isinstance(f, api.IsNull):
        return col.is_null()
    if isinstance(f, api.IsNotNull):
        return col.is_valid()
    if isinstance(f, api.In):
        return col.isin(list(f.value))
    if isinstance(f.value, float):
        return None  # NaN is ordered differently
    for kind, make in ((api.EqualTo, col.__eq__), (api.GreaterThan, col.__gt__), (api.GreaterThanOrEqual, col.__ge__), (api.LessThan, col.__lt__), (api.LessThanOrEqual, col.__le__)):
        if type(f) is kind:
            return make(pc.scalar(f.value))
    return None


class Reader(api.DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.filters = path, schema, []

    def partitions(self) -> list[FilePartition]:
        return [FilePartition(f) for f in _dataset(self.path).files] or [FilePartition("")]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        data = ds.dataset(partition.file, format="parquet", partitioning="hive", partition_base_dir=_local(self.path))
        condition = None
        for e in self.filters:
            condition = e if condition is None else condition & e
        target = to_arrow_schema(self.schema)
        for batch in data.to_batches(columns=target.names, filter=condition):
            yield batch.cast(target) if batch.schema != target else batch


class PushingReader(Reader):
    def pushFilters(self, filters: list[api.Filter]):
        for f in filters:
            e = _expression(f)
            if e is not None:
                self.filters.append(e)
            yield f  # Spark checks every filter again


class Writer(api.DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.job = _local(path), overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> api.WriterCommitMessage:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        os.makedirs(self.path, exist_ok=True)
        names = []
        writer = None
        staged = os.path.join(self.path, f".{self.job}-{TaskContext.get().taskAttemptId()}")
        for batch in iterator:
            if writer is None:
                writer = pq.ParquetWriter(staged, batch.schema)
                names.append(staged)
            writer.write_batch(batch)
        if writer is not None:
            writer.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        new = [n for m in messages if m is not None for n in m.files]
        old = [os.path.join(at, name) for at, _, names in os.walk(self.path) for name in names if name.endswith(".parquet")] if self.overwrite else []
        for i, staged in enumerate(new):
            os.replace(staged, os.path.join(self.path, f"part-{i:05d}-{self.job}.parquet"))
        for name in old:  # only when the new files are there
            os.remove(name)
        for at, _, _ in os.walk(self.path, topdown=False) if self.overwrite else ():
            if at != self.path and not os.listdir(at):
                os.rmdir(at)

    def abort(self, messages: list) -> None:
        for m in messages:
            for staged in m.files if m is not None else ():
                os.remove(staged)


@dataclass
class Written(api.WriterCommitMessage):
    files: list[str]


class Source(api.DataSource):
    @classmethod
    def name(cls) -> str:
        return "sparlode"

    def schema(self) -> StructType:
        return from_arrow_schema(_dataset(self.options["path"]).schema)

    def reader(self, schema: StructType) -> Reader:
        kind = PushingReader if self.options.get("push", "false").lower() == "true" else Reader
        return kind(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Make the format name known to a session."""
    spark.dataSource.register(Source)
