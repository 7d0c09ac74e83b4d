"""Plan regression guards: the scale properties the design relies on."""

import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.01"
# fits and streams run whole jobs while they are built; the training-data operators are tested in tests/llm
HEAVY = ("train_", "best_model", "model_roundtrip", "close_time_linear", "score_requests", "stream_", "op", "pipeline", "tree_splits", "boosting_", "candidate_", "best_candidate", "request_predictions", "paged_stream")
BATCH = sorted(k for k in se.queries() if not k.startswith(HEAVY))


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_no_python(spark, name):
    plan = physical(se.queries()[name](spark, SF))
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]:
        assert bad not in plan, f"{name}: {bad}"


def test_flagship_shape(spark):
    df = se.queries()["market_feature_matrix"](spark, SF)
    text = formatted(spark, df)
    assert "WindowGroupLimit" in text                  # tails trimmed before their shuffle
    assert "PartitionFilters: [market" in text         # store partitions pruned
    assert "SortMergeJoin" not in text                  # one-pass pivot, no five-way join
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 2             # bars + tails, nothing re-derived from ticks


def test_range_mean_reads_once_and_runs_a_running_sum(spark):
    text = formatted(spark, se.queries()["trailing_avg_range7d"](spark, SF))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1
    assert "unboundedpreceding" in text.lower()         # no frame is summed again for each row


def test_top_n_is_limited_before_the_shuffle(spark):
    text = formatted(spark, se.queries()["latest_bars"](spark, SF))
    assert text.count("WindowGroupLimit") >= 2          # partial + final


def test_serving_time_filter_reaches_the_scan(spark):
    text = formatted(spark, se.queries()["serving_window_avg"](spark, SF))
    assert "GreaterThanOrEqual(datetime" in text and "LessThanOrEqual(datetime" in text


def test_event_scans_are_pruned(spark):
    text = formatted(spark, se.queries()["point_avg"](spark, SF))
    read = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert read and all("props" not in ln and "user_id" not in ln for ln in read)


def test_scaled_features_fit_reads_no_matrix(spark):
    text = formatted(spark, se.queries()["scaled_features"](spark, SF))
    assert text.split("\n\n")[0].count("Scan parquet") == 1 and "Aggregate" not in text.split("\n\n")[0]


def test_narrow_range_chunks_sum_before_they_shuffle(spark):
    tree = formatted(spark, se.queries()["tick_avg_range7d"](spark, SF)).split("\n\n")[0]
    assert tree.count("HashAggregate") == 2 and tree.count("Scan parquet") == 2      # chunk totals: partial and final
