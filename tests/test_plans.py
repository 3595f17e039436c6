"""Physical-plan properties the scale design relies on."""

import re

from salesmart.plans import queries as Q

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_scans_are_pruned_and_filters_pushed(spark):
    text = _formatted(Q.seller_incentive(spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all("l_comment" not in s and "l_tax" not in s and "l_discount" not in s for s in lineitem)
    assert "c_acctbal" not in text
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in _formatted(Q.unmatched_customers(spark, SF))


def test_top_seller_and_incentive_use_no_window(spark):
    for df in (Q.top_sellers(spark, SF), Q.seller_incentive(spark, SF)):
        plan = _plan(df)
        assert "Window" not in plan
        assert "partial_max" in plan


def test_rank_window_is_partitioned_by_range(spark):
    plan = _plan(Q.seller_rank(spark, SF))
    windows = [line for line in plan.splitlines() if "Window [" in line and "__v" in line]
    assert windows and all("__a" in line and "__b" in line for line in windows)


def test_names_are_joined_once_and_the_fact_meets_the_team_on_sums_only(spark):
    plan = _plan(Q.seller_incentive(spark, SF))
    assert plan.count("s_name") and len(re.findall(r"FileScan parquet \[[^\]]*s_name", plan)) == 1


def test_ingest_gathers_no_paths(spark, tmp_path):
    from salesmart.plans.ingest import ingest
    from salesmart.sources.files import LISTING_PARTITIONS

    (tmp_path / "drop").mkdir()
    for k in range(5):
        (tmp_path / "drop" / f"{k}.csv").write_text("customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost\n1,1,a,2024-01-01,1,1,1,1\n")
    got = ingest(spark, str(tmp_path / "drop"))
    assert "collect_list" not in _plan(got.rows) and got.rows.count() == 5
    assert got.listing.rdd.getNumPartitions() <= LISTING_PARTITIONS


def test_monthly_totals_are_partial_aggregates(spark):
    for df in (Q.customer_monthly(spark, SF), Q.customer_monthly_window(spark, SF), Q.ledger_latest(spark, SF)):
        plan = _plan(df)
        assert "Window" not in plan
        assert "partial_" in plan


def test_small_dimensions_are_broadcast(spark):
    plan = _plan(Q.star_enrich(spark, SF))
    assert plan.count("BroadcastHashJoin") >= 6
    assert "SortMergeJoin" not in plan
