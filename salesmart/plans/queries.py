"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the driver tables through the adapter in sources.testdata and
run the same operators the batch job uses.  Two of them write first and
read back what they wrote (the CSV ingest path and the partitioned publish),
always into a fresh folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart import config, counter, functions
from salesmart.operators import infer, ledger_base, marts
from salesmart.operators.conform import HEADER_LINE, conform, good_rows
from salesmart.operators.enrich import enrich, unmatched
from salesmart.operators.ledger import already_done, latest_state
from salesmart.plans import job
from salesmart.plans.ingest import NoValidFile, check_files, ingest
from salesmart.schemas import MANDATORY_COLUMNS, MONEY, SELLER_MART_DETAIL
from salesmart.sinks.publish import read_partitioned, write_partitioned
from salesmart.sources import testdata as td
from salesmart.sources.files import data_lines, list_drop
from salesmart.streaming import ledger as ledger_stream


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(td.sales(spark, sf_dir), *td.dimensions(spark, sf_dir))


def star_enrich(spark, sf_dir):
    return enriched(spark, sf_dir)


def _star(spark, sf_dir):
    return (td.sales(spark, sf_dir), *td.dimensions(spark, sf_dir))


# Monthly marts aggregate the fact before joining dimension attributes (see
# operators.marts); the driver tables' dimension keys are unique.
def customer_monthly(spark, sf_dir):
    return marts.customer_monthly_from_fact(*_star(spark, sf_dir))


def customer_monthly_window(spark, sf_dir):
    return marts.customer_month_sums(*_star(spark, sf_dir))


def _seller_monthly(spark, sf_dir):
    return marts.seller_monthly_from_fact(*_star(spark, sf_dir))


def seller_monthly(spark, sf_dir):
    return _seller_monthly(spark, sf_dir)


def seller_rank(spark, sf_dir):
    return marts.seller_rank(_seller_monthly(spark, sf_dir))


def _seller_sums(spark, sf_dir):
    fact, customer, store, team = _star(spark, sf_dir)
    return marts.seller_sums_from_fact(fact, customer, store), team


def top_sellers(spark, sf_dir):
    return marts.top_sellers(*_seller_sums(spark, sf_dir))


def seller_incentive(spark, sf_dir):
    return marts.seller_mart_from_sums(*_seller_sums(spark, sf_dir))


def customer_mart_detail(spark, sf_dir):
    return marts.customer_mart_detail(enriched(spark, sf_dir))


def seller_mart_detail(spark, sf_dir):
    return marts.seller_mart_detail(enriched(spark, sf_dir))


_SELLER_DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.IntegerType()),
        T.StructField("sales_person_id", T.LongType()),
        T.StructField("sales_person_first_name", T.StringType()),
        T.StructField("sales_person_last_name", T.StringType()),
        T.StructField("store_manager_name", T.StringType()),
        T.StructField("manager_id", T.LongType()),
        T.StructField("is_manager", T.StringType()),
        T.StructField("sales_person_address", T.StringType()),
        T.StructField("sales_person_pincode", T.StringType()),
        T.StructField("sales_date", T.DateType()),
        T.StructField("total_cost", MONEY),
        T.StructField("sales_month", T.StringType()),
    ]
)
assert _SELLER_DETAIL_SCHEMA.names == SELLER_MART_DETAIL


def partition_counts(spark, sf_dir):
    """Publish the seller detail partitioned by month and store, read the
    partitions back and count rows / sum cost per partition."""
    path = config.shared_path(spark, "queries", "seller_detail_partitioned")
    write_partitioned(seller_mart_detail(spark, sf_dir), path, ["sales_month", "store_id"])
    back = read_partitioned(spark, path, _SELLER_DETAIL_SCHEMA)
    return back.groupBy("sales_month", "store_id").agg(
        F.count(F.lit(1)).alias("n"), marts.money(F.sum("total_cost")).alias("total_cost")
    )


def fold_extra(spark, sf_dir):
    """Unexpected columns (here the two flags) folded into one."""
    sales = td.sales(spark, sf_dir)
    return good_rows(conform(sales))


def _staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written once (in folders ``by`` columns): the files of a drop are cut from it without joining the sales anew for each."""
    path = config.shared_path(df.sparkSession, "queries", name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_drop(spark: SparkSession, sf_dir: str) -> str:
    """Sales written as a CSV drop: two header layouts (rows without extras in
    a shuffled column order, rows with two extra columns in another), plus
    files the contract must set aside (a CSV lacking sales columns and a
    non-CSV file)."""
    root = config.shared_path(spark, "queries", "sales_drop")
    sales = _staged(td.sales(spark, sf_dir), "sales_staged")
    plain = list(reversed(MANDATORY_COLUMNS))
    extra = ["channel", *MANDATORY_COLUMNS[4:], "payment_mode", *MANDATORY_COLUMNS[:4]]
    opts = {"header": True}
    sales.where(F.col("payment_mode") == "A").select(*plain).write.options(**opts).csv(f"{root}/plain")
    sales.where(F.col("payment_mode") != "A").select(*extra).write.options(**opts).csv(f"{root}/extra")
    td.table(spark, sf_dir, "region").write.options(**opts).csv(f"{root}/wrong_layout")
    td.table(spark, sf_dir, "nation").write.json(f"{root}/not_csv")
    return root


def conform_union(spark, sf_dir):
    """The CSV drop through listing, header contract, conformance and union."""
    got = ingest(spark, _write_drop(spark, sf_dir))
    return got.rows.select(*MANDATORY_COLUMNS, "additional_column")


def unmatched_customers(spark, sf_dir):
    # the cut of the dimension is what makes sales unmatched here
    return unmatched(td.sales(spark, sf_dir), td.customer_dim(spark, sf_dir, least_balance=0), "customer_id")


def unmatched_stores(spark, sf_dir):
    dim = td.store_dim(spark, sf_dir).where(F.col("id") % 3 != 0)
    return unmatched(td.sales(spark, sf_dir), dim, "store_id", "id")


def unmatched_sellers(spark, sf_dir):
    dim = td.sales_team_dim(spark, sf_dir).where("is_manager = 'N'")
    return unmatched(td.sales(spark, sf_dir), dim, "sales_person_id", "id")


# Files and rows of every case, written from the tables; folders tell the files apart.
def _odd_drop(spark: SparkSession, sf_dir: str) -> str:
    root = config.shared_path(spark, "queries", "odd_drop")
    sales = _staged(td.sales(spark, sf_dir), "sales_staged")
    opts = {"header": True}

    def put(df: DataFrame, folder: str) -> None:
        df.write.options(**opts).csv(f"{root}/{folder}")

    text = sales.select(*[F.col(c).cast("string") for c in MANDATORY_COLUMNS])
    # every value that can be broken is broken in some rows, by the quantity
    broken = text.withColumns({
        "customer_id": F.when(F.col("quantity") % 10 == 1, F.concat(F.lit("c"), "customer_id")).otherwise(F.col("customer_id")),
        "sales_date": F.when(F.col("quantity") % 10 == 2, F.lit("2023-13-45")).otherwise(F.col("sales_date")),
        "total_cost": F.when(F.col("quantity") % 10 <= 2, F.lit("n/a")).otherwise(F.col("total_cost")),
    })
    put(broken.where(sales["payment_mode"] == "A"), "broken")
    put(text.where(sales["payment_mode"] == "R").withColumnRenamed("product_name", " Product_Name "), "sales[1]?")
    put(sales.where("payment_mode = 'N'").select(*MANDATORY_COLUMNS, F.col("channel").alias("city, state"), F.col("payment_mode").alias("payment.mode")), "sales 100%")
    put(text.drop("store_id", "price"), "missing")
    put(text.withColumn("again", F.lit("x")).toDF(*MANDATORY_COLUMNS, " Total_Cost"), "duplicate")
    put(td.table(spark, sf_dir, "region"), "region")
    td.table(spark, sf_dir, "nation").write.json(f"{root}/json")
    return root


def _folder(location):
    return F.element_at(F.split(location, "/"), -2)


def reject_files(spark, sf_dir):
    """Folders of the odd drop whose files are set aside, with reason and missing columns."""
    got = ingest(spark, _odd_drop(spark, sf_dir))
    rows = got.rejected_files.where(~F.startswith("file_name", F.lit("_")))
    return rows.select(_folder("file_location").alias("folder"), "reason", F.array_join(F.array_sort("missing_columns"), ",").alias("missing")).distinct()


def bad_rows_by_column(spark, sf_dir):
    """Rows of the odd drop by folder and the columns that do not cast."""
    got = ingest(spark, _odd_drop(spark, sf_dir))
    rows = got.conformed.where(F.col("_errors") != HEADER_LINE).select(_folder("file_location").alias("folder"), F.col("_errors").alias("errors"), "additional_column")
    return rows.groupBy("folder", "errors").agg(F.count(F.lit(1)).alias("n"), F.count("additional_column").alias("n_additional"))


def _job_dims(spark, sf_dir) -> job.Dimensions:
    return job.Dimensions(*td.dimensions(spark, sf_dir))


def _put_sales(sales: DataFrame, root: str, folder: str, mode: str) -> None:
    """The sales of a payment mode as CSV files written in parallel, and those of one quantity as one file ``sales.csv``."""
    _sales_of(sales, mode, rest=False).write.option("header", True).csv(f"{root}/{folder}/most")
    _put_named(_sales_of(sales, mode, rest=True), f"{root}/{folder}/rest")


def _sales_of(sales: DataFrame, mode: str, rest: bool) -> DataFrame:
    """Of ``_job_sales`` those of a payment mode, of one quantity or of the others; only their folder is read."""
    some = sales.where((F.col("payment_mode") == mode) & (F.col("rest") == rest))
    return some.where("quantity = 1" if rest else "quantity <> 1").select(*MANDATORY_COLUMNS)


def _put_named(df: DataFrame, folder: str) -> None:
    """A small ``df`` as the one file ``sales.csv`` of ``folder``, replacing an earlier one."""
    jvm = df.sparkSession.sparkContext._jvm
    aside = config.shared_path(df.sparkSession, "queries", "named")
    # one task writes the rows; what computes them keeps its own
    df.repartition(1).write.option("header", True).csv(aside)
    path, target = jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(f"{folder}/sales.csv")
    fs = path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    for status in fs.listStatus(path):
        if status.getPath().getName().endswith(".csv"):
            fs.delete(target, False)
            fs.rename(status.getPath(), target)
    fs.delete(path, True)


def _job_sales(spark, sf_dir) -> DataFrame:
    config.job_settings(spark)
    sales = td.sales(spark, sf_dir).select(*MANDATORY_COLUMNS, "payment_mode")
    return _staged(sales.withColumn("rest", F.coalesce(F.col("quantity") == 1, F.lit(False))), "sales_staged", "payment_mode", "rest")


def _two_drops(spark, sf_dir) -> str:
    """The fact as CSV drops through the whole run: a month across both drops,
    a drop offered again, same-named files in two folders, and files set aside
    (runs that fail are for the tests)."""
    root, out = config.shared_path(spark, "queries", "job_drop"), config.shared_path(spark, "queries", "job_out")
    sales, dims = _job_sales(spark, sf_dir), _job_dims(spark, sf_dir)
    _put_sales(sales, root, "first", "A")
    td.table(spark, sf_dir, "region").write.option("header", True).csv(f"{root}/region")
    job.run(spark, root, out, dims)
    if _nothing_new(spark, root, out, dims) is not None:
        raise AssertionError("a file was counted twice")
    _put_sales(sales, root, "second", "R")
    _put_sales(sales, root, "third", "N")
    job.run(spark, root, out, dims)
    return out


def _nothing_new(spark, root, out, dims):
    try:
        return job.run(spark, root, out, dims)
    except NoValidFile:
        return None


def job_customer_monthly(spark, sf_dir):
    return spark.read.parquet(f"{_two_drops(spark, sf_dir)}/customer_monthly").withColumn("sales_date_month", F.col("sales_date_month").cast("string"))


def job_seller_monthly(spark, sf_dir):
    return spark.read.parquet(f"{_two_drops(spark, sf_dir)}/seller_monthly").withColumn("sales_month", F.col("sales_month").cast("string"))


def job_detail_committed(spark, sf_dir):
    """The seller detail as readers see it, per month and store."""
    detail = job.read_committed(spark, _two_drops(spark, sf_dir), "seller_detail")
    return detail.groupBy("sales_month", F.col("store_id").cast("int").alias("store_id")).agg(
        F.count(F.lit(1)).alias("n"), marts.money(F.sum("total_cost")).alias("total_cost")
    )


def job_snapshots(spark, sf_dir):
    """Two runs that overlap, after a first one: months of both marts as of each snapshot."""
    root, out = config.shared_path(spark, "queries", "snapshot_drop"), config.shared_path(spark, "queries", "snapshot_out")
    sales, dims = _job_sales(spark, sf_dir), _job_dims(spark, sf_dir)
    for folder, mode in (("first", "A"), ("second", "R"), ("third", "N")):
        _put_sales(sales, root, folder, mode)
    job.run(spark, f"{root}/first", out, dims)
    # the third drop is committed while the second one's run is about to
    job.run(spark, f"{root}/second", out, dims, before_commit=lambda _: job.run(spark, f"{root}/third", out, dims))
    parts = []
    for number in (1, 2, 3):
        for mart, month in (("customer_monthly", "sales_date_month"), ("seller_monthly", "sales_month")):
            rows = job.read_months(spark, out, mart, number).groupBy(F.col(month).alias("sales_month"))
            rows = rows.agg(F.count(F.lit(1)).alias("n"), marts.money(F.sum("total_sales")).alias("total_sales"))
            parts.append(rows.select(F.lit(number).alias("snapshot"), F.lit(mart).alias("mart"), "sales_month", "n", "total_sales"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def job_monthly_incremental(spark, sf_dir):
    """Months merged from the deltas of three runs, with a file that is delivered wrong and then replaced."""
    root, out = config.shared_path(spark, "queries", "merge_drop"), config.shared_path(spark, "queries", "merge_out")
    sales, dims = _job_sales(spark, sf_dir), _job_dims(spark, sf_dir)
    _put_sales(sales, root, "first", "A")
    job.run(spark, root, out, dims, replace=True)
    _put_sales(sales, root, "second", "R")
    wrong = _sales_of(sales, "N", rest=True)
    _put_named(wrong.withColumn("total_cost", F.col("total_cost") * 3).unionByName(wrong), f"{root}/third/rest")
    job.run(spark, root, out, dims, replace=True)
    _put_sales(sales, root, "third", "N")
    job.run(spark, root, out, dims, replace=True)
    return job.read_months(spark, out, "seller_monthly").select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive")


def stream_ledger_latest(spark, sf_dir):
    """The events as a ledger stream in three deliveries, late and repeated ones among them, with a restart after each."""
    root, out = config.shared_path(spark, "queries", "ledger_stream"), config.shared_path(spark, "queries", "ledger_changes")
    entries = _events_as_ledger(spark, sf_dir).select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"), F.col("event_type").alias("status"))
    for share in ("seq % 3 = 1", "seq % 3 = 0 OR seq % 5 = 0", "seq % 3 = 2 OR seq % 7 = 0"):
        entries.where(share).write.mode("append").parquet(f"{root}/in")
        source = lambda own: own.readStream.schema(ledger_stream.ENTRIES).option("maxFilesPerTrigger", 8).parquet(f"{root}/in")
        query = ledger_stream.start(spark, source, out, f"{root}/checkpoint", ("purchase",))
        query.awaitTermination()
    return ledger_stream.latest(spark, out).select(F.col("key").alias("user_id"), "status", F.col("ts").alias("updated_at"))


def conform_multiline(spark, sf_dir):
    """Sales with a quoted line break in the names of a third of the rows, through the ingest."""
    root = config.shared_path(spark, "queries", "multiline_drop")
    sales = _staged(td.sales(spark, sf_dir), "sales_staged")
    broken = F.concat("product_name", F.lit('\nline "two", and\n\nlast'))
    named = sales.withColumn("product_name", F.when(F.col("quantity") % 3 == 0, broken).otherwise(F.col("product_name")))
    opts = {"header": True, "escape": '"'}
    named.where("payment_mode = 'A'").select(*MANDATORY_COLUMNS).write.options(**opts).csv(f"{root}/plain")
    named.where("payment_mode <> 'A'").select("channel", *reversed(MANDATORY_COLUMNS)).write.options(**opts).csv(f"{root}/extra")
    return ingest(spark, root, multiline=True).rows.select(*MANDATORY_COLUMNS, "additional_column")


def inferred_types(spark, sf_dir):
    """Types found in three layouts of the sales, widened over them, and where they drift."""
    root = config.shared_path(spark, "queries", "typed_drop")
    sales, opts = _staged(td.sales(spark, sf_dir), "sales_staged"), {"header": True}
    put = lambda mode, folder, **columns: sales.where(F.col("payment_mode") == mode).select(*MANDATORY_COLUMNS).withColumns(columns).write.options(**opts).csv(f"{root}/{folder}")
    put("A", "plain")
    put("R", "large", customer_id=F.col("customer_id") + 3_000_000_000, price=F.floor("price").cast("int"))
    put(
        "N", "odd", quantity=F.when(F.col("quantity") % 10 == 1, F.lit("n/a")).otherwise(F.col("quantity").cast("string")),
        sales_date=F.concat(F.col("sales_date").cast("string"), F.lit(" 12:30:00")), total_cost=F.lit(None).cast("string"),
    )
    contract = check_files(list_drop(spark, root), root)
    lines = data_lines(spark, root, contract.where(F.col("reason").isNull()))
    masks = infer.column_masks(lines.withColumn("folder", _folder("file_location")), "folder")
    return infer.inferred_types(masks, "folder")


#: Buckets of the ledger's base in the query.
BUCKETS = 16


def ledger_anti_join(spark, sf_dir):
    """Users and days with a signup that the ledger has not finished (no purchase on the day): a bucketed base of
    earlier purchases, and a delta."""
    events = _events_as_ledger(spark, sf_dir).withColumn("day", F.to_date("ts")).withColumn("version", ledger_base.version_of("user_id", "day"))
    done = events.where("event_type = 'purchase'")
    name = "ledger_base_" + uuid.uuid4().hex
    path = config.shared_path(spark, "queries", "ledger_base")
    ledger_base.write_base(done.where("event_id % 4 <> 0"), name, path, BUCKETS)
    base = ledger_base.open_base(spark, name, path, BUCKETS)
    listing = events.where("event_type = 'signup'").select("user_id", "day", "version").distinct()
    return ledger_base.not_in_base(listing, base, done.where("event_id % 4 = 0"), BUCKETS).select("user_id", "day")


def fold_variant(spark, sf_dir):
    """Unexpected columns as one VARIANT: values and found types of each name."""
    sales = td.sales(spark, sf_dir).select(
        "payment_mode", "channel", (F.col("quantity") % 7).cast("string").alias("discount"),
        F.when(F.col("quantity") % 2 == 0, F.col("quantity").cast("string")).otherwise(F.concat(F.lit("q"), "quantity")).alias("mixed"),
    )
    folded = sales.select(functions.fold_variant(sales.columns).alias("extras"))
    values = folded.lateralJoin(spark.tvf.variant_explode(F.col("extras").outer()))
    return values.groupBy(F.col("key").alias("name")).agg(
        F.schema_of_variant_agg("value").alias("found_type"), F.count(F.lit(1)).alias("n"),
        F.countDistinct(F.col("value").cast("string")).alias("n_distinct"), F.sum(functions.variant_long("value")).alias("total"),
    )


def synth_sales(spark, sf_dir):
    """As many generated sales as line items, keys drawn from the tables, an eighth of them on one customer and seller."""
    customer = td.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    team = td.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("store_id"))
    product = td.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_retailprice").cast(MONEY).alias("price"))
    rows = td.table(spark, sf_dir, "lineitem").count()
    return counter.counted_sales(spark, rows, 20, customer, team, product, hot_permille=125)


def _events_as_ledger(spark, sf_dir):
    # events stand in for the ledger: user = file, event type = status.
    return td.table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")


def ledger_latest(spark, sf_dir):
    last = latest_state(_events_as_ledger(spark, sf_dir), "user_id", ["ts", "event_id"], ["event_type", "ts"])
    return last.select("user_id", F.col("event_type").alias("status"), F.col("ts").alias("updated_at"))


def ledger_prior_run(spark, sf_dir):
    """Names offered in this run (users with a signup) that the ledger already
    has as done ('purchase')."""
    ledger = _events_as_ledger(spark, sf_dir)
    listing = ledger.where(F.col("event_type") == "signup").select("user_id")
    return already_done(listing, ledger, "user_id", "event_type", "purchase")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "star_enrich": star_enrich,
    "customer_monthly": customer_monthly,
    "customer_monthly_window": customer_monthly_window,
    "seller_monthly": seller_monthly,
    "seller_rank": seller_rank,
    "top_sellers": top_sellers,
    "seller_incentive": seller_incentive,
    "customer_mart_detail": customer_mart_detail,
    "seller_mart_detail": seller_mart_detail,
    "partition_counts": partition_counts,
    "fold_extra": fold_extra,
    "conform_union": conform_union,
    "unmatched_customers": unmatched_customers,
    "unmatched_stores": unmatched_stores,
    "unmatched_sellers": unmatched_sellers,
    "reject_files": reject_files,
    "bad_rows_by_column": bad_rows_by_column,
    "job_customer_monthly": job_customer_monthly,
    "job_seller_monthly": job_seller_monthly,
    "job_detail_committed": job_detail_committed,
    "job_snapshots": job_snapshots,
    "job_monthly_incremental": job_monthly_incremental,
    "stream_ledger_latest": stream_ledger_latest,
    "conform_multiline": conform_multiline,
    "inferred_types": inferred_types,
    "ledger_anti_join": ledger_anti_join,
    "fold_variant": fold_variant,
    "synth_sales": synth_sales,
    "ledger_latest": ledger_latest,
    "ledger_prior_run": ledger_prior_run,
}
