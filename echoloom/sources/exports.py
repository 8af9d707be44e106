"""Raw exports: readers and the projections to the canonical row."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from echoloom import schemas as S
from echoloom.operators import gates
from echoloom.sources.records import csv_records


def read_csv_export(spark: SparkSession, path, schema, line_breaks=True) -> DataFrame:
    """Header CSV with doubled quotes; a malformed row fails the read. Files are split among tasks.

    Quoted fields may hold line breaks. Where it is known that none do, `line_breaks=False` takes Spark's own
    reader, which needs no count of quotes beforehand.
    """
    options = {"mode": "FAILFAST", "escape": '"'}
    if not line_breaks:
        return spark.read.schema(schema).options(header=True, **options).csv(path)
    parsed = F.from_csv("record", schema.toDDL(), options | {"multiLine": "true"})
    return csv_records(spark, path).select(parsed.alias("r")).select("r.*")


def read_json_export(spark: SparkSession, path, schema, lines=False) -> DataFrame:
    """One JSON array per file, or JSON lines (splittable) with lines=True."""
    return (spark.read.schema(schema)
            .options(multiLine=not lines, mode="FAILFAST").json(path))


def load_raw(spark: SparkSession, path, fmt, types=None) -> DataFrame:
    """Exploratory load: each column gets the narrowest type that all its values fit (see `inferred`).

    `types` names types for some columns. What does not fit stands in the map `_rescued`, by
    column, and a CSV record with too few or too many fields as a whole under `_record`. CSV
    files are split among tasks, also where fields hold line breaks; JSON files hold an array each.
    """
    if fmt == "json":
        return spark.read.options(multiLine=True).json(path).drop("_corrupt_record")
    names = spark.read.options(header=True, escape='"').csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, RECORD)])
    options = {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": RECORD}
    text = csv_records(spark, path).select(F.from_csv("record", schema.toDDL(), options).alias("r")).select("r.*")
    return typed(text, inferred(text.drop(*(types or {}))) | dict(types or {}))


RECORD = "_record"
# Types from narrow to wide; text fits all. A value must look like the type, not only be castable to it.
LOOKS = {"int": r"[+-]?\d+", "bigint": r"[+-]?\d+", "double": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?",
         "boolean": "(?i)true|false", "date": r"\d{4}-\d{2}-\d{2}", "timestamp": r"\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}.*)?"}


def _fits(name, kind):
    value = F.trim(F.col(f"`{name}`"))
    return F.when(value.isNotNull(), F.rlike(value, F.lit(f"^(?:{LOOKS[kind]})$")) & value.try_cast(kind).isNotNull())


def inferred(text: DataFrame) -> dict[str, str]:
    """The type of every text column, from one aggregation: which types all its values fit.

    What fits two parts of a table is what fits both, so tasks combine their answers in any
    order. Null fits all; a column of nulls is text.
    """
    names = [n for n in text.columns if n != RECORD]
    flags = [F.bool_and(_fits(n, kind)).alias(f"{i} {kind}") for i, n in enumerate(names) for kind in LOOKS]
    found = text.agg(*flags).first() if flags else {}
    return {n: next((kind for kind in LOOKS if found[f"{i} {kind}"]), "string") for i, n in enumerate(names)}


def typed(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns as their types, and `_rescued`: the texts that do not fit, by column, or null."""
    names = [n for n in text.columns if n != RECORD]
    cast = {n: F.col(f"`{n}`") if types.get(n, "string") == "string" else F.trim(F.col(f"`{n}`")).try_cast(types[n]) for n in names}
    lost = [F.when(F.col(f"`{n}`").isNotNull() & cast[n].isNull(), F.struct(F.lit(n).alias("key"), F.col(f"`{n}`").alias("value")))
            for n in names if types.get(n, "string") != "string"]
    if RECORD in text.columns:
        lost.append(F.when(F.col(RECORD).isNotNull(), F.struct(F.lit(RECORD).alias("key"), F.col(RECORD).alias("value"))))
    kept = F.filter(F.array(*lost), lambda x: x.isNotNull()) if lost else F.lit(None)
    rescued = F.when(F.size(kept) > 0, F.map_from_entries(kept)) if lost else F.lit(None).cast("map<string,string>")
    return text.select(*[cast[n].alias(n) for n in names], rescued.alias("_rescued"))


def normalize_app_store(df: DataFrame) -> DataFrame:
    return df.select(
        F.lit("app_store").alias("source"), F.col("id").alias("feedback_id"),
        F.col("nickname").alias("user_id"),
        F.concat_ws(" - ", "title", "body").alias("message_text"),
        F.col("rating").try_cast("int").alias("rating"),
        F.col("date").try_cast("timestamp").alias("timestamp"),
        F.col("version").alias("app_version"),
        _metadata(country="country"))


def normalize_google_play(df: DataFrame) -> DataFrame:
    return df.select(
        F.lit("google_play").alias("source"), F.col("reviewId").alias("feedback_id"),
        F.col("userName").alias("user_id"), F.col("content").alias("message_text"),
        F.col("score").try_cast("int").alias("rating"),
        F.try_to_timestamp("at", F.lit("dd/MM/yyyy HH:mm")).alias("timestamp"),
        F.col("appVersion").alias("app_version"),
        _metadata(thumbsUp="thumbsUpCount"))


def normalize_in_app(df: DataFrame) -> DataFrame:
    """In-app messages carry no ID: it is derived from user, message and time."""
    return df.select(
        F.lit("in_app").alias("source"),
        F.md5(F.concat_ws("|", "uid", "msg", "ts")).alias("feedback_id"),
        F.col("uid").alias("user_id"), F.col("msg").alias("message_text"),
        F.lit(None).cast("int").alias("rating"),
        F.col("ts").try_cast("timestamp").alias("timestamp"), "app_version",
        _metadata(device="device", screen="screen"))


def normalize_support(df: DataFrame, digits: int = None) -> DataFrame:
    """The customer's address is replaced by its hash; `digits` shortens it, and users that
    share the first digits then count as one."""
    pseudonym = _short(F.sha2("customer_email", 256), digits)
    return df.select(
        F.lit("support").alias("source"), F.col("ticket_id").alias("feedback_id"),
        F.concat(F.lit("user_"), pseudonym).alias("user_id"),
        F.concat_ws(" - ", "subject", "message").alias("message_text"),
        F.lit(None).cast("int").alias("rating"),
        F.timestamp_millis(F.col("created_at").try_cast("bigint")).alias("timestamp"),
        F.lit(None).cast("string").alias("app_version"),
        _metadata(status="status", channel="channel"))


def normalize_submission(df: DataFrame, note="submitted via app", digits: int = None) -> DataFrame:
    return df.select(
        F.lit("app_submission").alias("source"), F.col("id").alias("feedback_id"),
        F.concat(F.lit("customer_"), _short(F.col("id"), digits)).alias("user_id"),
        "message_text", "rating", F.col("created_at").alias("timestamp"),
        F.lit("demo").alias("app_version"), F.lit(note).alias("metadata"))


def _short(col, digits):
    return col if digits is None else F.substring(col, 1, digits)


def _metadata(**parts):
    """label:|value|label:|value - a NULL value leaves only its label."""
    items = []
    for label, column in parts.items():
        items += [F.lit(f"{label}:"), F.col(column)]
    return F.concat_ws("|", *items).alias("metadata")


def canonical(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).cast(dtype).alias(name) for name, dtype in S.BASE_FIELDS])


def unify(*normalized: DataFrame) -> DataFrame:
    """Union by name of any number of normalised sources."""
    out = normalized[0]
    for df in normalized[1:]:
        out = out.unionByName(df)
    return canonical(out)


def unify_exports(app_store, google_play, in_app, support) -> DataFrame:
    return unify(normalize_app_store(app_store), normalize_google_play(google_play),
                 normalize_in_app(in_app), normalize_support(support))


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count("*").alias("rows"))


def read_submissions(submissions: DataFrame, ids: DataFrame = None) -> DataFrame:
    """Saved submissions, optionally restricted to the requested IDs."""
    picked = submissions if ids is None else submissions.join(ids.select("id"), "id", "left_semi")
    return canonical(normalize_submission(picked))


def read_snapshot(store, version: int = None) -> DataFrame:
    """The read side's rows of a published version; refused if a needed field is missing or a key is there twice."""
    rows = feedback_snapshot(store.read("feedback_with_issue_type", version))
    checked = gates.row(gates.key_violations(rows, missing=gates.missing_snapshot_field(), empty=gates.empty_key()))
    gates.enforce(checked, {"missing": "the table lacks fields that the read side needs",
                            "duplicate_keys": "the table holds a key twice", "empty": "the table holds an empty key"}, {})
    return rows


def feedback_snapshot(df: DataFrame) -> DataFrame:
    """The read side's 13 columns; scores that are not finite become NULL."""
    score = F.col("confidence_score").try_cast("double")
    finite = ~F.isnan(score) & (F.abs(score) != float("inf"))
    rating = F.col("rating").try_cast("int")
    return df.select(
        "source", "feedback_id", "user_id", "message_text",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        rating.alias("rating"), "category", "sentiment",
        F.when(finite, score).alias("confidence_score"), "explanation",
        F.coalesce(F.col("uncertain_classification").try_cast("boolean"), F.lit(False))
        .alias("uncertain_classification"), "issue_type", "issue_cat")
