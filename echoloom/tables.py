"""Run-scoped stages and published versions, as plain parquet folders.

Tables are cut into buckets by a hash of their key, and a version of a table is a list of
folders, one for each bucket, that are never written again. A publication adds one file to the
log that names the folders of all tables, so readers switch at once and a pinned version never
changes. A run writes the buckets that it touches; the others stay the folders they were, and
the counts kept with them spare reading them. A table may also be one folder (a copy, a table
written by hand): the next run cuts it into buckets.
"""

import contextlib
import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from echoloom import schemas as S
from echoloom.operators.incremental import one_answer
from echoloom.operators.ordered import RANGE, Ordered, newest_first

LOG = ("version BIGINT, run_id STRING, parent BIGINT, folders MAP<STRING, ARRAY<STRING>>, "
       "stats MAP<STRING, ARRAY<STRUCT<rows: BIGINT, review: BIGINT, active: BIGINT>>>, cut STRING, published_at TIMESTAMP")
BUCKETS = 16    # a run rewrites whole buckets: choose as many as keep one bucket a small job
SPLITS = 4      # parts of a bucket by key: a task joins one part, which is to fit in its memory
CACHE_BUCKETS = 64  # a run reads the cache buckets of the keys it lacks


def key_bucket(n: int):
    """By the hash of Spark's bucketed files, so that each of a table's parts lies in one bucket."""
    return F.pmod(F.hash(*S.KEYS), F.lit(n)).cast("int")


def user_bucket(n: int):
    return F.pmod(F.xxhash64("source", "user_id"), F.lit(n)).cast("int")


def cache_bucket(n: int):
    return F.pmod(F.xxhash64("_cache_key"), F.lit(n)).cast("int")


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PIECES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_PIECES = 128  # Spark joins small ones, and never cuts large ones


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written here takes its shuffle files off the disks when it is done: a barrier is read, not made again.
    A run of many steps then holds the shuffles of one write, not those of all. A shuffle begins with many pieces, so that those
    of a large load still fit in the memory of a task, whatever number the session names."""
    before, pieces = spark.conf.get(CLEAN_UP), spark.conf.get(PIECES, None)
    spark.conf.set(CLEAN_UP, "true")
    if pieces is None:
        spark.conf.set(PIECES, max(LEAST_PIECES, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)
        if pieces is None:
            spark.conf.unset(PIECES)


KEYED = ("feedback_clean", "feedback_analyzed", "feedback_with_issue_type")     # their rows lie in parts by key
COUNTED = ("feedback_clean", "feedback_analyzed", "feedback_with_issue_type")


class Conflict(RuntimeError):
    """Another run published first."""


def counts_of(entry) -> dict:
    """The bucket counts of a version as plain values."""
    return {name: [c.asDict() for c in counts] for name, counts in (entry["stats"] or {}).items()}


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, cache_buckets: int = CACHE_BUCKETS):
        self.spark, self.root, self.buckets, self.cache_buckets = spark, root.rstrip("/"), buckets, cache_buckets

    # --- stages -----------------------------------------------------------------------

    def stage_path(self, run_id, name):
        return f"{self.root}/stage/run={run_id}/{name}"

    @property
    def parts(self) -> int:
        return self.buckets * SPLITS

    @property
    def cut(self) -> str:
        """How keyed tables are laid out here; a version that is laid out otherwise is cut anew by the next run."""
        return f"hash/{self.buckets}/{self.parts}"

    def by_parts(self, df: DataFrame, keys) -> DataFrame:
        """Rows dealt by key to a task per part."""
        return df.repartition(self.parts, *keys)

    def few_tasks(self, df: DataFrame) -> DataFrame:
        """Half as many tasks as parts at most, without a shuffle: each writes its rows of every part, so a part has a file per
        task, and their number is bounded whatever the load."""
        return df.coalesce(max(1, self.parts // 2))

    def _table(self, schema, keys, path, folders=None) -> str:
        """Name Spark's bucketed files below a path (with the bucket as last column: in folders by bucket) as a table of the
        session: what joins or groups them by their keys shuffles nothing."""
        name, by_folder = f"echoloom_{uuid.uuid4().hex}", "PARTITIONED BY (`bucket`) " if "bucket" in schema.names else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        named = ", ".join(f"`{k}`" for k in keys)
        at = lambda p: "'" + p.replace("\\", "\\\\").replace("'", "\\'") + "'"
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by_folder}CLUSTERED BY ({named}) "
                       f"INTO {self.parts} BUCKETS LOCATION {at(path)}")
        if folders:
            self.spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
                f"PARTITION (`bucket` = {b}) LOCATION {at(f)}" for b, f in folders.items()))
        return name

    def _write_parts(self, df: DataFrame, path, keys):
        name = self._table(df.schema, keys, path)
        df.write.insertInto(name, overwrite=True)
        self.spark.sql(f"DROP TABLE {name}")    # the files stay

    def save_stage(self, df: DataFrame, run_id, name, keys=()) -> DataFrame:
        """Write and read back. A barrier: what follows reads files, not the plan. Safe to repeat. With `keys` the rows lie
        in parts by these."""
        path = self.stage_path(run_id, name)
        with shuffles_dropped(self.spark):
            if keys:
                self._write_parts(df, path, keys)
            else:
                df.write.mode("overwrite").parquet(path)
        return self.stage(run_id, name, df.schema, keys)

    def save_buckets(self, df: DataFrame, path, bucket, keys=()) -> None:
        """Write a folder per bucket. Each task writes its rows of every bucket, as they come out of the join before:
        rows are not shuffled again, and a bucket has a file per task. With `keys` the files are parts by these."""
        with shuffles_dropped(self.spark):
            rows = df.withColumn("bucket", bucket)
            if keys:
                self._write_parts(rows.select(*[c for c in rows.columns if c != "bucket"], "bucket"), path, keys)
            else:
                rows.write.mode("overwrite").partitionBy("bucket").parquet(path)

    def bucket_folders(self, path) -> dict[int, str]:
        """The buckets below a folder that hold rows."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        return {int(n.split("=")[1]): f"{path}/{n}" for n in names if n.startswith("bucket=")}

    def stage(self, run_id, name, schema=None, keys=()) -> DataFrame:
        """A stage; `keys` are those it was written by in parts, if it was."""
        path = self.stage_path(run_id, name)
        if keys:
            folders = self.bucket_folders(path) if "bucket" in schema.names else None
            return self.spark.table(self._table(schema, keys, path, folders))
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(path)

    # --- published tables -------------------------------------------------------------

    def _path(self, name, run_id):
        return f"{self.root}/published/{name}/v={run_id}"

    def _log(self):
        return self._read_or_none(f"{self.root}/publications", LOG, "json")

    def _read_or_none(self, path, schema, fmt="parquet"):
        try:
            return self.spark.read.schema(schema).format(fmt).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def head(self):
        """The current publication, or None before bootstrap."""
        log = self._log()
        row = None if log is None else log.orderBy(F.desc("version"), "run_id").first()
        return None if row is None else row.asDict()

    def _entry(self, version):
        rows = self._log().where(F.col("version") == version).take(2)
        if len(rows) > 1:
            raise Conflict(f"version {version} is in the log twice")
        return rows[0].asDict() if rows else None

    def has_published(self, run_id) -> bool:
        log = self._log()
        return log is not None and bool(log.where(F.col("run_id") == run_id).take(1))

    def entry(self, version=None) -> dict:
        if isinstance(version, dict):
            return version
        found = self.head() if version is None else self._entry(version)
        if found is None:
            raise ValueError(f"no published version {version}")
        return found

    def read(self, name, version=None, buckets=None) -> DataFrame:
        """A published table, at the current version or a pinned one (its number or log entry); only some
        of its buckets if they are named."""
        entry = self.entry(version)
        folders = entry["folders"][name]
        laid = entry.get("cut") == self.cut and len(folders) == self.buckets
        if buckets is None or len(folders) == self.buckets and (laid or name in S.BY_USER):
            return self.read_folders(name, folders if buckets is None else [folders[b] for b in buckets], laid)
        cut = user_bucket if name in S.BY_USER else key_bucket
        return self.read_folders(name, folders).where(cut(self.buckets).isin([int(b) for b in buckets]))

    def read_folders(self, name, folders, laid=False) -> DataFrame:
        """Buckets without rows have no folder. In a version `laid` out as here, keyed tables are in parts."""
        there = [f for f in folders if f]
        if not there:
            return self.spark.createDataFrame([], S.PUBLISHED[name])
        if laid and name in KEYED:
            schema = T.StructType([*S.PUBLISHED[name], T.StructField("bucket", T.IntegerType())])
            return self.spark.table(self._table(schema, S.KEYS, there[0], dict(enumerate(there)))).drop("bucket")
        return self.spark.read.schema(S.PUBLISHED[name]).parquet(*there)

    def pages(self, version=None, name="feedback_with_issue_type", per_range: int = RANGE) -> Ordered:
        """A version's rows, newest first, by page: ordered once per version, when first asked for. Of two builds at
        once both are whole, and later readers share one."""
        entry = self.entry(version)
        path = f"{self.root}/pages/{name}/v={entry['version']}"
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        builds = sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []
        for build in builds:
            done = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{build}/counts/_SUCCESS")
            if files.exists(done):
                return Ordered(self.spark, f"{path}/{build}", S.PUBLISHED[name])
        return Ordered.write(self.read(name, entry), newest_first(), f"{path}/build={uuid.uuid4().hex}", per_range)

    def in_buckets(self, entry) -> bool:
        """Whether all tables of a version are cut into this store's buckets, with counts."""
        return entry.get("cut") == self.cut and all(len(entry["folders"].get(n) or []) == self.buckets for n in (*S.BY_KEY, *S.BY_USER)) and all(
            len((entry["stats"] or {}).get(n) or []) == self.buckets for n in COUNTED)

    def write_version(self, name, df: DataFrame, run_id) -> str:
        """Write a complete table for a run; returns its folder."""
        path = self._path(name, run_id)
        with shuffles_dropped(self.spark):
            df.select(*[F.col(f.name).cast(f.dataType) for f in S.PUBLISHED[name]]) \
                .write.mode("overwrite").parquet(path)
        return path

    def commit(self, run_id, parent, folders=None, stats=None, cut=None):
        """Make the run's folders current: one log file named by version, created only if it
        is absent, so of two commits on one parent the second fails. Tables without a folder
        were written by `write_version`. `stats` are the counts of the buckets, `cut` says how they are
        laid out; without these, or with a table in one folder, the next run touches every bucket. With `cut`, keyed tables
        that are not one folder written by hand are in parts."""
        paths = {name: (folders or {}).get(name, self._path(name, run_id)) for name in S.PUBLISHED}
        paths = {name: [p] if isinstance(p, str) else list(p) for name, p in paths.items()}
        entry = {"version": parent + 1, "run_id": run_id, "parent": parent, "folders": paths,
                 "stats": stats or {}, "cut": cut, "published_at": dt.datetime.now(dt.timezone.utc).isoformat()}
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/publications/{parent + 1:020d}.json")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            out = files.create(path, False)
        except Py4JJavaError as error:
            if not files.exists(path):
                raise
            raise Conflict(f"version {parent + 1} is published already; start a fresh run") from error
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()

    def bootstrap(self):
        """Create the empty tables as version 0; existing tables are untouched."""
        if self.head() is None:
            none = {"rows": 0, "review": 0, "active": 0}
            self.write_version("issue_summary", self.spark.createDataFrame([], S.SUMMARY), "bootstrap")
            self.commit("bootstrap", -1, {n: [""] * self.buckets for n in (*S.BY_KEY, *S.BY_USER)},
                        {n: [none] * self.buckets for n in COUNTED}, self.cut)
        return self

    def start_from(self, other: "Store"):
        """Begin at the other store's current tables without copying them."""
        if self.head() is not None:
            raise FileExistsError(f"{self.root} already holds published tables")
        head = other.head()
        self.commit(head["run_id"], head["version"] - 1, head["folders"], counts_of(head), head["cut"])
        return self

    def clone_to(self, other: "Store"):
        """Snapshot copy of the current tables; fails if the target has tables already."""
        if other.head() is not None:
            raise FileExistsError(f"{other.root} already holds published tables")
        for name in S.PUBLISHED:
            self.read(name).write.mode("errorifexists").parquet(other._path(name, "clone"))
        other.commit("clone", -1)
        return other

    # --- append-only tables ------------------------------------------------------------

    def cache(self, buckets=None) -> DataFrame:
        """Answers of all runs; two runs may have asked for one key, see `one_answer`. Only some buckets
        if they are named: the folders of the others are not opened, but for answers that were cut into another number."""
        found = self._answers()
        if found is None:
            return self.spark.createDataFrame([], S.AI_CACHE)
        if buckets is not None:
            found = found.where((F.col("cut") != self.cache_buckets) | F.col("bucket").isin([int(b) for b in buckets]))
        return found.select(*S.AI_CACHE.names)

    def _answers(self):
        cut = T.StructType([*S.AI_CACHE.fields, T.StructField("cut", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        return self._read_or_none(f"{self.root}/ai_answers", cut)

    def cached(self, keys: DataFrame) -> DataFrame:
        """One answer per cache key of `keys` that has one, from the buckets of these keys."""
        if self._answers() is None:
            return self.spark.createDataFrame([], S.AI_CACHE)
        met = keys.select(cache_bucket(self.cache_buckets).alias("b")).distinct().collect()    # at most one row per bucket
        asked = keys.select("_cache_key")
        return one_answer(self.cache(sorted(r["b"] for r in met)).join(asked, "_cache_key", "left_semi"))

    def append_cache(self, rows: DataFrame, run_id):
        """A run's answers, in a new folder cut into buckets: nothing that is there is replaced, so a step that
        is repeated after a failure keeps what the first attempt was answered."""
        path = f"{self.root}/ai_answers/cut={self.cache_buckets}/by_run={run_id}/part={uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            rows.select(*S.AI_CACHE.names, cache_bucket(self.cache_buckets).alias("bucket")).repartition("bucket") \
                .sortWithinPartitions("bucket", "_cache_key").write.partitionBy("bucket").parquet(path)

    def reports(self) -> DataFrame:
        return self.spark.read.schema(S.RUN_LOG).json(f"{self.root}/runs")

    def record_report(self, run_id, step, status, report: str):
        """Counts only: no customer text reaches the run log."""
        row = self.spark.range(1).select(
            F.lit(run_id).alias("run_id"), F.lit(step).alias("step"), F.lit(status).alias("status"),
            F.lit(report).alias("report"), F.current_timestamp().alias("recorded_at"))
        row.coalesce(1).write.mode("append").json(f"{self.root}/runs")
