"""Records over split borders, inferred types, the bucketed ledger, the ledger stream, counters and variants."""
import csv
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from salesmart import counter, functions, synth
from salesmart.operators import conform, infer, ledger_base
from salesmart.operators.ledger import latest_state
from salesmart.plans.ingest import ingest
from salesmart.schemas import MANDATORY_COLUMNS
from salesmart.sources.files import data_lines, list_drop
from salesmart.sources.records import open_splits, text_records
from salesmart.sources import records
from salesmart.streaming import ledger


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("broadcast", [True, False])
def test_records_over_split_borders(spark, tmp_path, small_splits, monkeypatch, broadcast):
    """Quoted breaks in a third of the rows, some longer than several splits, and all kinds of quotes."""
    if not broadcast:
        monkeypatch.setattr(records, "fits_broadcast", lambda df: False)
    rng = random.Random(4)
    want = {}
    for name in ("a", "b"):
        rows = []
        for k in range(300):
            text = f"plain {k}" if k % 3 else "\n".join(rng.choice(["", 'say "hi"', "x,y", "word " * rng.randrange(1, 400 if k % 30 == 0 else 8)]) for _ in range(rng.randrange(1, 6)))
            rows.append([str(k), text, "é" * rng.randrange(5)])
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\r\n" if name == "b" else "\n").writerows(rows)
        with open(tmp_path / f"{name}.csv", newline="") as f:
            want[name] = [r for r in csv.reader(f)]
    got = text_records(spark, str(tmp_path))
    for name, rows in want.items():
        found = [r["value"] for r in got.where(F.col("file_location").endswith(f"{name}.csv")).collect()]
        assert sorted(next(csv.reader([v], strict=True)) if "\n" not in v else next(csv.reader(v.splitlines(True))) for v in found) == sorted(rows)
    splits = records._lines(spark, str(tmp_path)).select("file_location", "start").distinct().count()
    assert splits > 25 and open_splits(records._lines(spark, str(tmp_path))).count() > 3


def test_multiline_ingest_equals_one_line(spark, tmp_path, small_splits):
    """Without quoted breaks both ways give the same rows; a quote that is never closed is one bad row."""
    synth.extra_column_file(spark, f"{tmp_path}/drop", rows=200, seed=5)
    rows = lambda multiline: sorted(map(repr, ingest(spark, f"{tmp_path}/drop", multiline=multiline).rows.drop("source_file").collect()))
    assert rows(True) == rows(False)
    os.makedirs(tmp_path / "open")
    header = ",".join(MANDATORY_COLUMNS)
    (tmp_path / "open" / "x.csv").write_text(header + "\n" + '1,121,"tea\nno end,2023-03-03,1,4,2,8.50\n' * 1 + "1,121,tea,2023-03-03,1,4,2,8.50\n" * 30)
    got = ingest(spark, f"{tmp_path}/open", multiline=True)
    assert (got.rows.count(), got.bad_rows.count()) == (0, 1)


def test_inferred_types_merge(spark, tmp_path):
    """Types of each file, widened; masks of parts merge to the mask of the whole."""
    files = {"a": ["1", "2", ""], "b": ["3000000000", "-4"], "c": ["1.5", "1e3"], "d": ["", ""], "e": ["true", "False"], "f": ["2024-02-30"], "g": ["2024-02-28", "2024-02-28 10:00"], "h": ["1", "x"], "i": ["99999999999999999999"]}
    for name, values in files.items():
        (tmp_path / f"{name}.csv").write_text("v,w\n" + "".join(f"{v},k\n" for v in values))
    contract = infer_contract(spark, str(tmp_path))
    masks = infer.column_masks(data_lines(spark, str(tmp_path), contract))
    got = {(os.path.basename(r["file_location"])[0], r["column"]): (r["type"], r["drift"]) for r in infer.inferred_types(masks).collect()}
    types = {"a": "int", "b": "bigint", "c": "double", "d": "void", "e": "boolean", "f": "string", "g": "timestamp", "h": "string", "i": "double"}
    assert {k: got[k, "v"][0] for k in types} == types
    assert {k for k in types if got[k, "v"][1]} == {"a", "b", "c", "e", "g", "i"} and not got["a", "w"][1]
    whole = infer.merge_masks(masks, ["column"])
    half = F.col("file_location").rlike("[a-d].csv")
    parts = infer.merge_masks(infer.merge_masks(masks.where(half), ["column"]).unionByName(infer.merge_masks(masks.where(~half), ["column"])), ["column"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def infer_contract(spark, root):
    from salesmart.plans.ingest import check_files

    return check_files(list_drop(spark, root), root, ["v", "w"])


def test_the_ledgers_base_is_not_shuffled(spark, tmp_path):
    done = spark.range(5000).select(ledger_base.version_of("id").alias("version"))
    name, path = "base_of_test", str(tmp_path / "base")
    ledger_base.write_base(done, name, path, 6)
    listing = spark.range(4900, 5200).select("id", ledger_base.version_of("id").alias("version"))
    delta = spark.range(5100, 5150).select(ledger_base.version_of("id").alias("version"))
    fresh = ledger_base.not_in_base(listing, ledger_base.open_base(spark, name, path, 6), delta, 6)
    assert sorted(r["id"] for r in fresh.collect()) == [*range(5000, 5100), *range(5150, 5200)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    base_side = plan[plan.rindex("SortMergeJoin"):].split("\n")
    scan = next(k for k, line in enumerate(base_side) if name in line or "Bucketed: true" in line)
    # between the join and the base's scan there is no exchange
    depth = base_side[scan].index("FileScan")
    above = []
    for line in reversed(base_side[:scan]):
        at = min((line.index(c) for c in line if c.isalpha()), default=0)
        if at < depth:
            above.append(line)
            depth = at
        if "SortMergeJoin" in line:
            break
    assert not any("Exchange" in line for line in above), plan
    bigger = ledger_base.compact(spark, spark.table(name), delta, name + "_2", str(tmp_path / "base2"), 6)
    assert bigger.count() == 5050
    spark.sql(f"DROP TABLE {name}")  # another session: the files are registered again
    assert ledger_base.open_base(spark, name, path, 6).count() == 5000


def test_versions_tell_nulls_and_borders_apart(spark):
    rows = spark.createDataFrame([("a", "b"), ("ab", None), ("a", None), (None, "a"), ("ab", ""), ("", "ab"), (None, None)], "x string, y string")
    assert rows.select(ledger_base.version_of("x", "y")).distinct().count() == 7


def deliver(spark, root, rows):
    spark.createDataFrame(rows, ledger.ENTRIES).coalesce(1).write.mode("append").parquet(f"{root}/in")


def consume(spark, root, files=1):
    source = lambda own: own.readStream.schema(ledger.ENTRIES).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
    query = ledger.start(spark, source, f"{root}/out", f"{root}/checkpoint", ("done",))
    query.awaitTermination(300)
    assert query.exception() is None
    return {r["key"]: (r["seq"], r["status"], r["overdue"]) for r in ledger.latest(spark, f"{root}/out").collect()}


def test_ledger_stream_late_and_repeated_entries(spark, tmp_path):
    """Late and re-delivered entries change nothing; a started key that was never done is reported once."""
    import datetime as dt

    root, old, now = str(tmp_path), dt.datetime(2024, 1, 1), dt.datetime.now()
    deliver(spark, root, [(1, old, 1, "started"), (2, now, 2, "started"), (None, old, 3, "started"), (3, old, 9, "done")])
    first = consume(spark, root)
    assert first[2] == (2, "started", False) and first[3] == (9, "done", False) and first[1] == (1, "started", True)
    deliver(spark, root, [(1, old, 1, "started"), (3, old, 8, "started"), (2, now, 2, "started"), (3, None, 99, "started")])
    assert consume(spark, root) == first
    changes = spark.read.parquet(f"{root}/out").count()
    deliver(spark, root, [(1, now, 20, "done"), (None, now, 21, "done")])
    last = consume(spark, root)
    assert last == {**first, 1: (20, "done", False), None: (21, "done", False)}
    assert spark.read.parquet(f"{root}/out").count() == changes + 2
    assert consume(spark, root) == last  # a restart without anything new


def test_ledger_stream_with_a_hot_key(spark, tmp_path):
    """A third of the entries on one key: the stream ends where the batch aggregate does."""
    import datetime as dt

    rng, root = random.Random(8), str(tmp_path)
    rows = [(0 if k % 3 == 0 else rng.randrange(40), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(5000)), k, rng.choice(["started", "done"])) for k in range(3000)]
    for k in range(3):
        deliver(spark, root, rows[k::3])
    got = {k: v[:2] for k, v in consume(spark, root).items()}
    want = latest_state(spark.createDataFrame(rows, ledger.ENTRIES), "key", ["ts", "seq"], ["seq", "status"]).collect()
    assert got == {r["key"]: (r["seq"], r["status"]) for r in want}


def test_counters_do_not_depend_on_partitions(spark):
    customer, team = spark.range(50, 250).toDF("customer_id"), spark.range(9).selectExpr("id", "CAST(id % 3 AS INT) AS store_id")
    product = synth.product_dim(spark).selectExpr("id AS product_id", "name AS product_name", "current_price AS price")
    runs = [sorted(map(tuple, counter.counted_sales(spark, 4000, 3, customer.repartition(n), team, product, 300, n).collect())) for n in (1, 7, 200)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 4000
    hot = sum(r[1] == 50 for r in runs[0]) / 4000
    assert 0.28 < hot < 0.34 and len({r[1] for r in runs[0]}) == 200
    other = counter.counted_sales(spark, 4000, 4, customer, team, product, 300).collect()
    assert sum(tuple(a) == b for a, b in zip(sorted(other), runs[0])) < 100


def test_the_first_key_of_a_shuffled_dimension_is_dealt_over_tasks(spark, monkeypatch):
    customer, team = spark.range(50, 250).toDF("customer_id"), spark.range(9).selectExpr("id", "CAST(id % 3 AS INT) AS store_id")
    product = synth.product_dim(spark).selectExpr("id AS product_id", "name AS product_name", "current_price AS price")
    made = lambda: counter.counted_sales(spark, 4000, 3, customer, team, product, 300)
    want = sorted(map(tuple, made().collect()))
    monkeypatch.setattr(counter, "TASK_ROWS", 100, raising=False)
    spark.conf.set("salesmart.broadcast.maxRows", "20")
    try:
        rows = made()
        assert sorted(map(tuple, rows.collect())) == want
        assert rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 600
    finally:
        spark.conf.unset("salesmart.broadcast.maxRows")


def test_variants_keep_found_types(spark):
    rows = spark.createDataFrame([("1", "x", None), ("2.5", "true", '{"a":1}'), (None, "", "[1,2]")], "`a.b` string, c string, `d e` string")
    got = rows.select(functions.fold_variant(rows.columns).alias("v"), functions.fold_variant([]).alias("none"))
    assert [r[0] for r in got.select(F.to_json("v")).collect()] == ['{"a.b":1,"c":"x","d e":null}', '{"a.b":2.5,"c":true,"d e":{"a":1}}', '{"a.b":null,"c":"","d e":[1,2]}']
    assert got.where("none IS NOT NULL").count() == 0
    assert got.select(F.try_variant_get("v", "$['a.b']", "double")).collect()[1][0] == 2.5


def test_time_of_ledger_stream_timer():
    assert ledger._ms(None) is None and ledger._ms(__import__("datetime").datetime(1970, 1, 1, 0, 0, 1)) == 1_000_000 and time.time() > 0


def test_a_filter_on_errors_parses_no_line_again(spark):
    """The plan of the good rows splits a line as often as the plan of all rows does."""
    lines = spark.createDataFrame(
        [("1,121,tea,2023-03-03,1,4,2,8.50", MANDATORY_COLUMNS, [], False, "f", "f")],
        "value string, columns array<string>, extra array<struct<name string, at int>>, is_header boolean, file_location string, file_name string",
    )
    rows = conform.conform_lines(lines)
    splits = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("split(")
    assert splits(conform.good_rows(rows)) == splits(rows) > 0
    assert conform.good_rows(rows).count() == 1


def test_variant_long_casts_what_casts(spark):
    """Strings with a letter are not tried; everything else casts as before."""
    texts = ["5", " 5 ", "+5", "007", "q31", "1e3", "2.5", "true", "null", ".", "", '"12"', '"12a"', "[1]", "٣", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(functions.columns.variant_of(F.col("t")).alias("v"))
    got = rows.select(functions.variant_long("v").alias("a"), F.try_variant_get("v", "$", "bigint").alias("b")).collect()
    assert [r["a"] for r in got] == [r["b"] for r in got]
    plan = rows.select(functions.variant_long("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan
