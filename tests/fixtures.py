"""Small tables: typed columns with nulls, nested values, and rows that are easy to get wrong."""

import datetime as dt

DDL = (
    "isDeleted boolean, Day date, Timestamp timestamp, CustomerID string, CustomerName string, StandardPackage int, ExtraOption1 bigint, ExtraOption2 float, ExtraOption3 double, "
    "ArrayInfo array<string>, MapInfo map<string,string>, MapArray map<string,array<string>>, StructInfo struct<name: string, age: int, map_tags: array<string>>, ImpDay int"
)


def typed(spark):
    day = lambda d, m=5: dt.date(2023, m, d)
    at = lambda d, s, m=5: dt.datetime(2023, m, d, 0, 0, s)
    rows = [
        (False, day(29), at(29, 1), "CA869", "Phạm Uyển Trinh", None, None, 2200.01, None, ["1", "2", "3"], {}, {"sport": ["football", "basketball"]}, ("John Doe", 30, ["football", "basketball"]), 20230529),
        (True, day(29), at(29, 2), "CA870", "Nguyễn Liên Thảo", None, None, 2000.02, 1350.05, ["1", "2", "3"], None, {"sport": ["football"]}, ("Jane Smith", 25, ["football"]), 20230529),
        (False, day(30), at(30, 1), "CA871", "Lê Thị Nga", 17000, None, None, None, ["1", "2", "3"], {"color": "yellow", "0.3": "1"}, {"sport": ["football", "basketball", "tennis"]}, ("David Johnson", 40, ["football", "basketball", "tennis"]), 20230530),
        (False, day(31), at(31, 1), "CA872", "Phan Tố Nga", None, None, 2000.02, None, ["1", "2", "3"], {"color": "blue", "0.3": "1"}, {}, ("Sarah Williams", 35, []), 20230531),
        (False, day(1, 6), at(1, 1, 6), "CA873", "Nguyễn Thị Teresa Teng", None, 132324, 1200.03, 1350.06, ["1", "2", "3", "4"], {"color": "red", "0.5": "2"}, None, ("Michael Brown", 45, None), 20230601),
    ]
    return spark.createDataFrame(rows, DDL)


def tags(spark, n=2000):
    """Random tags: each of ten tags with a chance of a half, each of its ten values with a half, empty lists left out."""
    from pyspark.sql import functions as F

    names = ["sports", "art", "music", "food", "travel", "books", "games", "film", "cars", "pets"]
    values = lambda t: F.filter(F.array(*[F.when(F.pmod(F.xxhash64("id", F.lit(f"{t}{k}")), F.lit(2)) == 0, F.lit(f"{t}-{k}")) for k in range(10)]), lambda x: x.isNotNull())
    entries = F.array(*[F.struct(F.lit(t).alias("key"), values(t).alias("value")) for t in names])
    kept = F.filter(entries, lambda e: (F.size(e["value"]) > 0) & (F.pmod(F.xxhash64("id", e["key"]), F.lit(2)) == 0))
    return spark.range(n).select(
        F.col("id").cast("string").alias("user_id"), F.pmod(F.xxhash64("id", F.lit("age")), F.lit(70)).cast("int").alias("age"), (F.col("id") % 2 == 0).alias("gender"),
        (F.col("id") % 100).cast("int").alias("region"), (F.col("id") % 5).cast("int").alias("occupation"), F.map_from_entries(kept).alias("map_tags"),
    )
