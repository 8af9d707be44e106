"""Rows in one global order, stored with their positions, so that a page is found without a sort or a scan.

Rows are dealt into ranges of the order, so a hot day or issue spreads over as many tasks as its rows need. Each range
is sorted by itself and written once to a folder of its own, with the place of each row in it. The ranges' counts, added
up, give the position each range begins at: a page opens the one or two folders that hold it.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

RANGE = 100_000     # rows in a range, about
MOST = 1000         # ranges: a larger table has larger ranges, as the borders are chosen from 100 keys a range in one place
PLACE = [T.StructField("range_at", T.LongType()), T.StructField("range_part", T.IntegerType())]
COUNTS = "range_part INT, n BIGINT, before BIGINT"


def newest_first() -> list[Column]:
    """The order of evidence; rows without a time come last."""
    return [F.col("timestamp").desc(), F.col("source").asc(), F.col("feedback_id").asc()]


class Ordered:
    """Stored rows in order. `path` holds the folders of the ranges, and their counts once all are written.

    Rows equal in all columns of the order stand in one range, in an order that is fixed when it is written.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.columns = spark, path, schema.names
        self.schema = T.StructType([*schema.fields, *PLACE])

    @classmethod
    def write(cls, df: DataFrame, order: list[Column], path: str, per_range: int = RANGE) -> "Ordered":
        """Order the rows below a new folder. Ranges are chosen from a sample, so they differ somewhat in size; there are
        at most `MOST`, so that the sample and the folders to list stay as many whatever the number of rows."""
        ranges = min(MOST, max(1, -(-df.count() // per_range)))
        placed = (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                  .withColumn("range_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
                  .withColumn("range_part", F.spark_partition_id()))
        placed.write.partitionBy("range_part").parquet(f"{path}/rows")
        out = cls(df.sparkSession, path, df.schema)
        parts = out._rows().groupBy("range_part").agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(W.orderBy("range_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        parts.withColumn("before", before).coalesce(1).write.parquet(f"{path}/counts")    # one row per range
        return out

    def _rows(self, parts=None) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        if parts is None:
            return reader.parquet(f"{self.path}/rows")
        return reader.option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/range_part={p}" for p in parts])

    def counts(self) -> DataFrame:
        return self.spark.read.schema(COUNTS).parquet(f"{self.path}/counts")

    def total(self) -> int:
        return self.counts().agg(F.max(F.col("before") + F.col("n"))).first()[0] or 0

    def slice(self, skip: int, size: int) -> DataFrame:
        """The `size` rows after the first `skip`, in order. Only the folders that hold them are opened."""
        end = F.col("before") + F.col("n")
        parts = (self.counts().where((F.col("before") < skip + size) & (end > skip)).orderBy("range_part").collect()
                 if size > 0 else [])       # at most `size` ranges
        if not parts:
            return self.spark.createDataFrame([], T.StructType(self.schema.fields[:-2]))
        inside = F.lit(False)
        for p in (parts[0], parts[-1]) if len(parts) > 1 else parts:
            first, last = max(0, skip - p["before"]), min(p["n"], skip + size - p["before"])
            inside |= (F.col("range_part") == p["range_part"]) & F.col("range_at").between(first, last - 1)
        if len(parts) > 2:
            inside |= (F.col("range_part") > parts[0]["range_part"]) & (F.col("range_part") < parts[-1]["range_part"])
        return (self._rows([p["range_part"] for p in parts]).where(inside).orderBy("range_part", "range_at")
                .select(*self.columns))

    def page(self, number: int, size: int = 25) -> DataFrame:
        """Page `number`, clamped to the pages there are."""
        last = max(1, -(-self.total() // size)) if number > 1 else 1
        return self.slice((min(max(1, number), last) - 1) * size, size)

    def positions(self, name: str = "position", within: tuple = ()) -> DataFrame:
        """All rows with their position from 1 on; with `within`, the columns that the order begins with, their position in
        the group of these. A group's begin is the least position in it, combined per task, so a hot group is no one task."""
        at = F.col("before") + F.col("range_at")
        rows = self._rows().join(self.counts().select("range_part", "before"), "range_part").withColumn(name, at + 1)
        if within:
            keys = [f"_key_{i}" for i in range(len(within))]
            begins = rows.groupBy(*[F.col(c).alias(k) for c, k in zip(within, keys)]).agg(F.min(name).alias("_begin"))
            same = [rows[c].eqNullSafe(begins[k]) for c, k in zip(within, keys)]
            rows = rows.join(begins, same).withColumn(name, F.col(name) - F.col("_begin") + 1)
        return rows.select(*self.columns, name)
