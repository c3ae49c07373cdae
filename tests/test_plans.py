"""Physical-plan shape tests: the operators the scale design relies on."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import groups, ranges, windows
from tessera.plans import kpi, reconcile, rtp, stages


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_group_limits_before_the_shuffle(spark, sf_dir):
    p = plan(rtp.q_top3_services(spark, sf_dir))
    assert "WindowGroupLimit" in p


def test_global_top_n_is_take_ordered(spark, sf_dir):
    df = rtp.q_top10_partners(spark, sf_dir)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [rtp.q_service_amounts, rtp.q_top3_services])
def test_facts_are_aggregated_before_the_registry_join(spark, sf_dir, query):
    p = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    join = next(i for i, x in enumerate(p.split("\n")) if "Join" in x and "iuv_prefix" in x)
    below = p.split("\n")[join + 1:]
    assert any("HashAggregate(keys=[iuv_prefix" in x for x in below)


@pytest.mark.parametrize("query", [rtp.q_partner_distinct, rtp.q_top2_orgs, rtp.q_top10_partners])
def test_positions_are_counted_before_the_registry_join(spark, sf_dir, query):
    p = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("\n")
    join = next(i for i, x in enumerate(p) if "Join" in x and "iuv_prefix" in x)
    assert any("Aggregate(keys=[" in x and "_set" in x for x in p[join + 1:])
    assert not any("iupd" in x for x in p[:join])


def test_no_round_robin_and_no_hint(spark, sf_dir):
    for query in (rtp.q_partner_join, rtp.q_semi_waterfall, kpi.q_kpi_gold, reconcile.q_enrich_left):
        p = query(spark, sf_dir)._jdf.queryExecution().toString()
        assert "RoundRobinPartitioning" not in p and "ResolvedHint" not in p


def test_kpi_gold_and_waterfall_scan_little(spark, sf_dir):
    assert kpi.q_kpi_gold(spark, sf_dir)._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 3
    assert rtp.q_semi_waterfall(spark, sf_dir)._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 5


def test_interval_join_is_an_equi_join(spark, sf_dir):
    p = plan(reconcile.q_range_overlap_cross(spark, sf_dir))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_kpi_rollup_aggregates_before_shuffling(spark, sf_dir):
    src = kpi._src(spark, sf_dir)
    p = groups.provider_totals(src)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in p and "partial_max" in p


def test_scan_filters_and_pruning_reach_parquet(spark, sf_dir):
    p = stages.q_scan_project(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_keep_last_is_an_aggregate_not_a_sort(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("seq"), F.col("id").alias("v"))
    p = windows.keep_last(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in p and "max_by" in p


def test_bucket_reports_are_one_aggregate(spark):
    from tessera.operators.quality import length_histogram

    df = spark.range(1000).select(F.repeat(F.lit("x"), (F.col("id") % 200).cast("int")).alias("d"))
    p = length_histogram(df, "d")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and "Window" not in p   # labels come from the aggregate itself
    assert p.count("HashAggregate") == 2           # partial + final of one global aggregate


def test_adjacent_overlap_windows_are_bucketed(spark, sf_dir):
    p = ranges.overlap_adjacent(reconcile.fixture(spark, sf_dir, "issuer_range"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "_b" in p  # the window partitions include the start bucket
