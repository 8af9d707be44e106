"""Feedback exports derived from general tables (documents, orders, events, conversations).

Every adapter is a projection or an equi-join of whole tables, so volume follows the tables.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from echoloom import schemas as S
from echoloom.functions import labels
from echoloom.functions.text import mask
from echoloom.session import scratch
from echoloom.sources import exports as X
from echoloom.tables import BUCKETS, SPLITS, Store, key_bucket, shuffles_dropped

# Message texts, chosen to reach every rule, fallback and near miss.
PHRASES = [
    "Payment failed at checkout, card was charged anyway.",
    "The app keeps crashing and the spinner is stuck.",
    "Login error: the otp never arrives.",
    "Search is broken, results do not show.",
    "The confirm button does nothing when I tap it.",
    "Error after the last update, version 4.2 is broken.",
    "My voucher shows an error.",
    "Charged twice for one meal, seems broken.",
    "Something is broken on my tablet.",
    "Please add dark mode to the app.",
    "I would love to split bill with friends.",
    "Please add a way to schedule an order for later.",
    "It would be great to bookmark my favourite places.",
    "Please add real-time gps tracking of the driver.",
    "I wish there was a notification when the meal is ready.",
    "Please add vegan and gluten filter options.",
    "Could you add a tip option?",
    "Please add a new logo design.",
    "Feature request: paypal wallet.",
    "Please add more languages.",
    "Delivery was 40 minutes late.",
    "Food was cold when it arrived.",
    "The order was wrong, not what I picked.",
    "Missing items, the food came incomplete.",
    "The courier never came and it said cancel.",
    "Driver could not find the address of my building.",
    "Food arrived soggy, the box had a spill.",
    "The delivery was bad.",
    "The service fee is too expensive.",
    "Prices are higher than in the shop, bad price.",
    "I am still waiting for a refund, customer service gives no reply.",
    "A support agent closed my ticket without an answer.",
    "The app feels laggy and confusing.",
    "Great service, love the chocolate cake!",
    "Excellent app, thank you.",
    "Amazing price but the food was cold.",
    "How do I change my address?",
    "Where can I see my old orders?",
    "ok",
    "hmm, not sure about this",
    "Call me on 07700 900190 or mail person@example.com, payment failed.",
    "Reach me at 07700-900190 and +1-234-567-8900, delivery never came.",
    "Found Pho 24. CHK-500 on 4.2.1 shows an error.",
    "Context menu shows an error.",
    "I love it but the app crashed twice.",
    "Discount code gives an error, duplicate charge.",
    "Perfect meal,\tthanks a lot!",
]
BASE_TIME = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; timestamps without zone are read as UTC instants."""
    path = f"{sf_dir}/{name}.parquet"
    return _instants(spark.read.schema(_schema(spark, path)).parquet(path))


_known = {}


def _schema(spark, path):
    """Schema of a given file, looked up once."""
    if path not in _known:
        _known[path] = spark.read.parquet(path).schema
    return _known[path]


_split = {}


def stream(spark: SparkSession, sf_dir: str, name: str, time: str, batches: int = 3, per_batch: int = None) -> DataFrame:
    """The same table as a file stream in time order, rows without a time first; about one micro-batch for each part.

    There are `batches` parts, or with `per_batch` as many as keep a part at about so many rows, if these are more. The table
    is read once for the borders and once to cut it by them; each part is then dealt into its files, one part after the other,
    as a file stream takes files in the order of their times.
    """
    path = f"{sf_dir}/{name}.parquet"
    schema = _schema(spark, path)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = (spark.sparkContext.applicationId, path, time, batches, per_batch)
    if key not in _split:
        df, out, cut = spark.read.schema(schema).parquet(path), scratch(spark, f"stream-{name}"), scratch(spark, f"cut-{name}")
        at = F.col(time).cast("timestamp").cast("double")
        if per_batch:
            batches = max(batches, -(-df.count() // per_batch))
        cuts = df.agg(F.percentile_approx(at, [i / batches for i in range(1, batches)])).first()[0] or []
        part = F.lit(0)     # one more for each border at or before the time
        for border in sorted(set(cuts)):
            part = part + F.coalesce((at >= border).cast("int"), F.lit(0))
        df.withColumn("_part", part).write.partitionBy("_part").parquet(cut)
        with shuffles_dropped(spark):
            for i in range(len(set(cuts)) + 1):
                rows = spark.read.schema(T.StructType([*schema, T.StructField("_part", T.IntegerType())])).parquet(cut).where(F.col("_part") == i)
                rows.drop("_part").repartition(files).write.mode("append").parquet(out)
        _split[key] = out
    out = _split[key]
    return _instants(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(out))


def _instants(df: DataFrame) -> DataFrame:
    naive = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def phrase(key: Column, shift=0) -> Column:
    items = F.expr("array({})".format(", ".join(f"'{p}'" for p in PHRASES)))
    return F.element_at(items, ((key + shift) % len(PHRASES) + 1).cast("int"))


def _order_text(shift=0) -> Column:
    return F.concat(phrase(F.col("o_orderkey"), shift), F.lit(" Order "), F.col("o_orderkey"), F.lit("."))


def app_store_raw(spark, sf):
    minutes = F.make_dt_interval(mins=F.col("doc_id") % 500000)
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("reader_"), F.col("doc_id") % 50).alias("nickname"),
        F.col("source").alias("title"), F.col("text").alias("body"),
        (F.col("doc_id") % 5 + 1).cast("string").alias("rating"),
        F.date_format(F.lit(BASE_TIME).cast("timestamp") + minutes, "yyyy-MM-dd HH:mm:ss")
        .alias("date"),
        F.lit(None).cast("string").alias("version"), F.col("lang").alias("country"))


def _reviews(orders: DataFrame, customer: DataFrame, text: Column, lines: DataFrame = None) -> DataFrame:
    """One review per order, or per order line: names are joined first, so lines travel as keys only and the copies of
    a review come out next to each other."""
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return (rows if lines is None else rows.join(lines, "o_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("reviewId"), F.col("c_name").alias("userName"),
        text.alias("content"), F.substring("o_orderpriority", 1, 1).alias("score"),
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("at"),
        F.concat(F.lit("4."), F.col("c_nationkey")).alias("appVersion"),
        F.col("c_nationkey").cast("string").alias("thumbsUpCount"))


def google_play_raw(spark, sf):
    return _reviews(table(spark, sf, "orders"), table(spark, sf, "customer"), _order_text())


def google_play_reexported(spark, sf):
    """The same reviews exported once per order line: exact copies of one payload per key."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return _reviews(table(spark, sf, "orders"), table(spark, sf, "customer"), _order_text(), lines)


def in_app_raw(spark, sf, device="event_type"):
    device = F.col(device) if isinstance(device, str) else device
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("uid"),
        F.concat(phrase(F.col("event_id")), F.lit(" Session "), F.col("user_id"), F.lit("."))
        .alias("msg"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.lit(None).cast("string").alias("app_version"), device.alias("device"),
        F.col("props").alias("screen"))


def support_raw(spark, sf):
    created = F.lit(1704067200000) + F.col("conv_id") * 3600000 + F.col("turn") * 60000
    return table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("ticket_id"),
        F.concat(F.lit("user"), F.col("conv_id"), F.lit("@mail.example.com")).alias("customer_email"),
        F.col("role").alias("subject"), F.col("text").alias("message"),
        created.cast("string").alias("created_at"),
        F.when(F.col("turn") == 0, "open").otherwise("pending").alias("status"),
        F.col("role").alias("channel"))


def raw_exports(spark, sf, reexported=False):
    play = google_play_reexported if reexported else google_play_raw
    return {"app_store": app_store_raw(spark, sf), "google_play": play(spark, sf),
            "in_app": in_app_raw(spark, sf), "support": support_raw(spark, sf)}


def corpus(spark, sf) -> DataFrame:
    """Canonical rows of this load, before masking."""
    return X.unify_exports(**raw_exports(spark, sf))


def clean(spark, sf) -> DataFrame:
    return mask(corpus(spark, sf))


def label(df: DataFrame) -> DataFrame:
    """Keyword labels as columns, with the review flag."""
    return labels.with_keyword_label(df).select(
        *S.BASE, F.col("_label.value").alias("category"),
        F.col("_label.confidence_score").alias("confidence_score"),
        F.col("_label.rationale").alias("explanation"), "sentiment",
        F.lit(False).alias("uncertain_classification")
    ).withColumn("uncertain_classification", labels.review_flag())


def spread(rows: DataFrame) -> DataFrame:
    """Canonical rows dealt out by their key over the tasks of a shuffle: the given files have one row group each, whatever
    their size, so a task that masks or labels what it reads would hold a whole table. (Dealing without a key sorts first.) The
    tasks are a multiple of a store's parts, so rows that are written to a store lie by part already."""
    tasks, parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), BUCKETS * SPLITS
    return rows.repartition(-(-tasks // parts) * parts, *S.KEYS)


def _labelled(rows: DataFrame) -> DataFrame:
    rows = labels.with_issue_type(label(rows))
    return rows.withColumn("issue_cat", labels.issue_cat()).select(*S.GROUPED.names)


_saved = {}


def saved(spark, sf, name, build) -> DataFrame:
    """Derived rows, written once per session to the shared folder and read from there. They are cut as a store cuts its
    tables, see `saved_at`.

    What reads labelled rows starts from a stored table, as after a refresh: a filter on a
    label would otherwise be pushed below the rules and evaluate them again.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _saved:
        path = scratch(spark, name)
        Store(spark, path).save_buckets(build(spark, sf), path, key_bucket(BUCKETS), S.KEYS)
        _saved[key] = path
    return spark.read.schema(S.GROUPED).parquet(_saved[key]).select(S.GROUPED.names)


def saved_at(spark, sf, name) -> str:
    """The folder of saved rows, by bucket and in parts by key: a store can publish it in place."""
    return _saved[spark.sparkContext.applicationId, sf, name]


def grouped(spark, sf) -> DataFrame:
    """Labelled rows of this load with their issues."""
    return saved(spark, sf, "current", lambda *a: _labelled(mask(spread(corpus(*a)))))


def analyzed(spark, sf) -> DataFrame:
    return grouped(spark, sf).select(*S.ANALYZED.names)


def stored(spark, sf) -> DataFrame:
    """Canonical, masked rows of this load, as stored."""
    return grouped(spark, sf).select(*S.BASE)


def previous_raw(spark, sf):
    """What the load before this one held.

    Open orders had not been reviewed yet and pending ones had another text; sign-ups are
    new; error events named no device; German documents are new; the web pages were
    exported then and are not exported any more.
    """
    orders = table(spark, sf, "orders").where("o_orderstatus <> 'O'")
    text = F.when(F.col("o_orderstatus") == "P", _order_text(1)).otherwise(_order_text())
    device = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type"))
    in_app = in_app_raw(spark, sf, device).where("device is null or device <> 'signup'")
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id")).alias("id"),
        F.lit(None).cast("string").alias("nickname"), F.col("url").alias("title"),
        F.col("html").alias("body"), F.lit("3").alias("rating"),
        F.lit("2023-12-01 00:00:00").alias("date"), F.lit(None).cast("string").alias("version"),
        F.lit(None).cast("string").alias("country"))
    return {"app_store": app_store_raw(spark, sf).where("country <> 'de'").unionByName(pages),
            "google_play": _reviews(orders, table(spark, sf, "customer"), text),
            "in_app": in_app, "support": support_raw(spark, sf)}


def previous_grouped(spark, sf) -> DataFrame:
    """What the earlier load published; delivery issues were grouped by hand under one name."""
    def build(spark, sf):
        rows = _labelled(mask(spread(X.unify_exports(**previous_raw(spark, sf)))))
        by_hand = F.when(F.col("category") == "COMPLAINT_DELIVERY", "Delivery (reviewed)")
        return rows.withColumns({"explanation": F.lit("Saved earlier."),
                                 "issue_type": F.coalesce(by_hand, "issue_type")})

    return saved(spark, sf, "previous", build)


def previous_analyzed(spark, sf) -> DataFrame:
    return previous_grouped(spark, sf).select(*S.ANALYZED.names)


def previous_clean(spark, sf) -> DataFrame:
    return previous_grouped(spark, sf).select(*S.BASE)


def _uuid(text: Column) -> Column:
    h = F.md5(text)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.concat(F.lit("4"), F.substring(h, 14, 3)),
                       F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def submission_forms(spark, sf) -> DataFrame:
    """Form posts before validation: in-app events, and whole documents as long messages."""
    events = table(spark, sf, "events").select(
        F.upper(_uuid(F.concat(F.lit("event "), F.col("event_id")))).alias("id"),
        F.concat(F.lit(" \t"), phrase(F.col("event_id")), F.lit(" \n")).alias("message"),
        (F.col("event_id") % 7).cast("int").alias("rating"),
        F.concat(F.lit("actor_"), F.col("event_type")).alias("created_by"),
        F.col("ts").alias("created_at"))
    docs = table(spark, sf, "documents").select(
        F.when(F.col("lang") == "fr", F.concat(F.lit("doc-"), F.col("doc_id")))
        .otherwise(_uuid(F.concat(F.lit("document "), F.col("doc_id")))).alias("id"),
        F.when(F.col("lang") == "es", F.concat(F.lit("\x01"), F.col("text")))
        .otherwise(F.col("text")).alias("message"),
        F.lit(None).cast("int").alias("rating"),
        F.concat(F.lit("actor_"), F.col("source")).alias("created_by"),
        F.lit(BASE_TIME).cast("timestamp").alias("created_at"))
    return events.unionByName(docs)


def submission_attempts(spark, sf) -> DataFrame:
    """Posts that reuse IDs: one per order line, so an ID may come back with other content."""
    return attempts_from(table(spark, sf, "lineitem"))


def attempts_from(lines: DataFrame) -> DataFrame:
    return lines.select(
        _uuid(F.concat(F.lit("line "), F.col("l_orderkey"), F.lit("/"), F.col("l_linenumber")))
        .alias("id"),
        F.concat(F.lit("actor_"), F.col("l_returnflag")).alias("created_by"),
        phrase(F.col("l_orderkey")).alias("message"),
        (F.col("l_quantity").cast("int") % 2 + 1).alias("rating"),
        F.col("l_shipdate").alias("created_at"))


def submissions(spark, sf) -> DataFrame:
    """Saved submissions (every column of the stored table)."""
    return submissions_from(table(spark, sf, "events"))


def submissions_from(events: DataFrame) -> DataFrame:
    done = F.col("event_type") == "purchase"
    return events.select(
        _uuid(F.concat(F.lit("event "), F.col("event_id"))).alias("id"),
        F.concat(phrase(F.col("event_id")), F.lit(" Sent by "), F.col("user_id")).alias("message_text"),
        (F.col("event_id") % 5 + 1).cast("int").alias("rating"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("created_by"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") != "signup", F.col("event_id")).alias("run_id"),
        F.lit(0).alias("attempt"),
        F.when(F.col("event_type") == "signup", "Not started.").alias("dispatch_error"),
        F.when(done, F.to_json(F.struct(F.col("event_id").alias("run_id")))).alias("result"),
        F.when(done, F.col("ts")).alias("completed_at"))


def runs(spark, sf) -> DataFrame:
    """State of the run a submission started."""
    kind = F.col("event_type")
    return table(spark, sf, "events").where("event_type <> 'signup'").select(
        F.col("event_id").alias("run_id"),
        F.when(kind == "error", "INTERNAL_ERROR").when(kind == "click", "RUNNING")
        .otherwise("TERMINATED").alias("life_cycle_state"),
        F.when(kind == "view", "FAILED").when(kind == "purchase", "SUCCESS")
        .alias("result_state"))


def run_tasks(spark, sf) -> DataFrame:
    """Task attempts of runs: one row per order line."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("step_"), F.col("l_returnflag")).alias("task_key"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("attempt_number"),
        F.struct(F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")).alias("seq"),
        F.when(F.col("l_linestatus") == "O", "RUNNING").alias("life_cycle_state"),
        F.when(F.col("l_returnflag") == "R", "FAILED").alias("result_state"))


def issue_names(key: Column):
    """Columns (issue_cat, issue_type) cycling through the rule table."""
    from echoloom.functions.rules import ISSUE_CATEGORY, ISSUE_RULES
    pairs = [(ISSUE_CATEGORY.get(c, c), name) for c, rules in ISSUE_RULES.items()
             for _, name in rules]
    at = (key % len(pairs) + 1).cast("int")
    return (F.element_at(F.array(*[F.lit(c) for c, _ in pairs]), at),
            F.element_at(F.array(*[F.lit(n) for _, n in pairs]), at))


def decision_forms(spark, sf) -> DataFrame:
    """Decision changes as posted: some with a bad key, status or priority, some blank."""
    from echoloom.functions.identity import issue_key
    cat, name = issue_names(F.col("c_custkey"))
    k = F.col("c_custkey")
    statuses = F.array(*[F.lit(s) for s in ["approved", "rejected", "needs_info", "maybe"]])
    priorities = F.array(*[F.lit(p) for p in ["P0", "P1", "P2", "P3", "P9", ""]])
    return table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("Not a key!"))
        .otherwise(F.concat(F.lit(" "), issue_key(cat, name))).alias("issue_key"),
        F.element_at(statuses, (k % 4 + 1).cast("int")).alias("status"),
        F.element_at(priorities, (k % 6 + 1).cast("int")).alias("priority"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.repeat("c_name", F.lit(6)))).alias("owner"),
        F.concat(F.lit("\t"), F.repeat("c_mktsegment", F.lit(60)), F.lit(" ")).alias("note"),
        (F.lit(BASE_TIME).cast("timestamp") + F.make_dt_interval(mins=k % 500000)).alias("decided_at"))


def decisions(spark, sf) -> DataFrame:
    """Saved decisions, one per issue key; some name an issue that is not seen any more."""
    from echoloom.functions.identity import issue_key
    cat, name = issue_names(F.col("s_suppkey"))
    gone = F.col("s_nationkey") == 0
    key = F.when(gone, issue_key(F.lit("OLD"), F.col("s_name"))).otherwise(issue_key(cat, name))
    rows = table(spark, sf, "supplier").select(
        key.alias("issue_key"), F.lit("approved").alias("status"), F.lit("P2").alias("priority"),
        F.col("s_name").alias("owner"), F.lit(None).cast("string").alias("note"),
        (F.lit(BASE_TIME).cast("timestamp") + F.make_dt_interval(mins=F.col("s_suppkey") % 500000))
        .alias("decided_at"))
    newest = F.max(F.struct("decided_at", "owner", "status", "priority", "note")).alias("r")
    return rows.groupBy("issue_key").agg(newest).select("issue_key", "r.status", "r.priority",
                                                        "r.owner", "r.note", "r.decided_at")
