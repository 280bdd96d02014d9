"""Tables kept in memory by path, and dropped when they are written."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


class CacheRegistry:
    """Persisted DataFrames by path; bounded, the least recently used goes first."""

    def __init__(self, most: int = 32):
        self.most = most
        self.held: dict[str, tuple[str, DataFrame]] = {}
        self.hits = self.misses = 0

    def get(self, spark: SparkSession, path: str, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_DESER, version: str = "") -> DataFrame:
        """The table at the path; one held under another version is dropped and read anew."""
        key = path.rstrip("/")
        known, df = self.held.pop(key, ("", None))
        if df is not None and (known != version or df.sparkSession.sparkContext is not spark.sparkContext):
            if df.sparkSession.sparkContext is spark.sparkContext:
                df.unpersist()
            df = None
        if df is None:
            self.misses += 1
            df = spark.read.parquet(path).persist(level)
        else:
            self.hits += 1
        self.held[key] = (version, df)
        while len(self.held) > self.most:
            self.held.pop(next(iter(self.held)))[1].unpersist()
        return df

    def invalidate(self, path: str) -> None:
        _, df = self.held.pop(path.rstrip("/"), ("", None))
        if df is not None:
            df.unpersist()

    def clear(self) -> None:
        for key in list(self.held):
            self.invalidate(key)


registry = CacheRegistry()
