"""Plan-shape checks: the scale properties must survive refactoring."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

QUERIES = E.queries()


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_filter_reaches_the_parquet_scan(spark):
    p = plan(spark, "filter_year")
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


def test_flagship_prunes_columns_and_broadcasts_dimensions_not_facts(spark):
    p = plan(spark, "sector_signal")
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p
    assert "BuildLeft" not in p  # the dimension is the build side, never the daily aggregate
    assert "SortAggregate" not in p


def test_bars_are_one_hash_aggregate(spark):
    p = plan(spark, "bars_source")
    assert "SortAggregate" not in p
    assert p.count("HashAggregate") == 2  # partial and final
    assert p.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(Date" in p


@pytest.mark.parametrize("name, columns", [("distinct_keys", "l_suppkey:bigint"), ("hash_split", "l_suppkey:bigint,l_shipdate:timestamp_ntz"),
                                           ("chrono_split", "l_suppkey:bigint,l_shipdate:timestamp_ntz")])
def test_keys_are_read_alone(spark, name, columns):
    p = plan(spark, name)
    assert f"ReadSchema: struct<{columns}>" in p and p.count("FileScan") == 1


@pytest.mark.parametrize("name", ["lexicon_sentiment", "daily_sentiment", "clean_text", "lemmatize",
                                  "tone_daily_std", "dedup_url", "sector_signal", "auc_rank"])
def test_no_python_udf_in_hot_path(spark, name):
    p = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("name", ["lexicon_sentiment", "daily_sentiment", "minmax_range", "lexicon_sentiment_join"])
def test_tokens_are_never_shuffled_by_word(spark, name):
    p = plan(spark, name)
    assert "hashpartitioning(word" not in p and "BroadcastHashJoin [word" in p


def test_documents_are_read_once_for_scores(spark):
    p = plan(spark, "lexicon_sentiment")
    assert p.count("text:string") == 1


def test_per_stock_ols_is_one_pass(spark):
    p = plan(spark, "lr_per_stock")
    assert "SortMergeJoin Inner" not in p.split("Window")[0]  # no coefficient join back above the split


def test_landed_events_prune_partitions(spark):
    p = plan(spark, "landed_events")
    assert "PartitionFilters: [isnotnull(Day" in p and "(Day#" in p


def _unpartitioned_windows(plan_text):
    """Window lines whose partition spec is empty (printed lists: [exprs], [partition], [order])."""
    bad = []
    for line in plan_text.splitlines():
        if "Window [" not in line:
            continue
        tail = line.split(" AS ")[-1]
        lists = tail.split("], [")[1:]  # lists printed after the window expressions
        if not lists or (len(lists) == 1 and (" ASC" in lists[0] or " DESC" in lists[0])):
            bad.append(line.strip())
    return bad


def test_unpartitioned_window_detector(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(5).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert _unpartitioned_windows(df._jdf.queryExecution().executedPlan().toString())
    df = spark.range(5).withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("id")))
    assert not _unpartitioned_windows(df._jdf.queryExecution().executedPlan().toString())


def test_no_single_partition_window_over_rows(spark):
    # the reference's unpartitioned windows are gone from the per-row queries
    for name in ("chrono_split", "rank_rows", "moving_avg", "lag_features", "minmax_per_stock",
                 "lr_per_stock", "buysell_signal"):
        p = plan(spark, name)
        assert not _unpartitioned_windows(p), (name, _unpartitioned_windows(p))
        assert "SinglePartition" not in p, name


@pytest.mark.parametrize("name", ["bars_source", "dedup_url", "tone_daily_std", "sector_vwap", "daily_sentiment"])
def test_aggregates_combine_map_side_before_shuffle(spark, name):
    # a key holding a large share of the rows must collapse before the exchange
    p = plan(spark, name)
    assert "partial_" in p
    first_exchange = p.find("Exchange")
    assert first_exchange > 0 and "partial_" in p[first_exchange:]


@pytest.mark.parametrize("name, most", [("tone_gapfill", 6), ("tone_daily_std", 6), ("join_three_way", 40)])
def test_shared_results_are_planned_once(spark, name, most):
    assert plan(spark, name).count("Exchange") <= most


@pytest.mark.parametrize("name", ["dedup_url", "tone_source", "tone_daily_std"])
def test_dedup_sorts_no_rows_to_aggregate(spark, name):
    assert "SortAggregate" not in plan(spark, name)
