"""Physical plan checks: the shapes the operators are designed to have."""

import os
import tempfile

from opslog.operators import large_renders, last_job_run, last_package_error, report_queries, report_stats
from opslog.operators.joins import preserving_left_join, salted_join
from opslog.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_last_job_run_aggregates_narrow_rows(spark):
    hist = spark.createDataFrame([(1, "j", 1, "old"), (2, "j", 1, "new")], "instance_id long, job_id string, step_id int, message string")
    steps = spark.createDataFrame([("j", 1, "s", "T", "", 1, 0, 0, 0)],
                                  "job_id string, step_id int, step_name string, subsystem string, command string, "
                                  "last_run_outcome int, last_run_date int, last_run_time int, last_run_duration int")
    jobs = spark.createDataFrame([("j", "n", 1)], "job_id string, name string, enabled int")
    df = last_job_run(hist, steps, jobs)
    # no text in an aggregation buffer: a hash aggregate of the newest instance, no sort of the history for it
    assert "SortAggregate" not in plan(df) and "max_by" not in optimized(df) and "max(instance_id" in optimized(df)
    assert [(r.instance_id, r.message) for r in df.collect()] == [(2, "new")]


def test_last_package_error_uses_group_limit(spark):
    q = QUERIES["last_package_error"](spark, "/root/testdata/sf0.001")
    lines = [l.strip(" :+-") for l in plan(q).split("\n")]
    final = next(i for i, l in enumerate(lines) if l.startswith("WindowGroupLimit") and l.endswith("Final"))
    exchange = next(i for i, l in enumerate(lines) if i > final and l.startswith("Exchange hashpartitioning(operation_id"))
    partial = next(i for i, l in enumerate(lines) if i > exchange and l.startswith("WindowGroupLimit"))
    # rank-1 rows are kept map-side before the shuffle and again after it
    assert lines[partial].endswith("Partial")


def test_report_queries_has_no_shuffle(spark):
    cat = spark.createDataFrame([(1, "r", "/r", 2, "<Report/>")], "ItemID long, Name string, Path string, Type int, Content string")
    p = plan(report_queries(cat))
    assert "Exchange" not in p and "Generate" in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def test_report_stats_aggregates_before_join(spark):
    q = QUERIES["q13_report_stats"](spark, "/root/testdata/sf0.001")
    p = optimized(q)
    join_at = p.index("Join Inner")
    # the log-side aggregate (by ReportID) sits below the join
    assert "Aggregate [ReportID" in p[join_at:]


def test_preserving_left_join_has_no_outer_join(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    fact = spark.createDataFrame([(1, "x")] * 5 + [(None, "n")], "fk long, w string")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    j = preserving_left_join(dim, fact, "k", "fk", ids)
    p = optimized(j)
    assert "LeftOuter" not in p and "LeftAnti" in p
    assert sorted((r.k, r.fk, r.w) for r in j.collect()) == [(1, 1, "x")] * 5 + [(2, None, None)]


def test_salted_join_keeps_rows_and_spreads_a_hot_key(spark):
    from pyspark.sql import functions as F

    many = spark.range(400).select(F.when(F.col("id") < 300, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    few = spark.createDataFrame([(1, "a"), (1, "b"), (350, "c"), (9999, "d")], "fk long, w string")
    j = salted_join(many, few, "k", "fk", rows_per_salt=50)
    want = sorted((r.k, r.v, w) for r in many.collect() for fk, w in ((1, "a"), (1, "b"), (350, "c")) if r.k == fk)
    assert sorted((r.k, r.v, r.w) for r in j.collect()) == want and j.columns == ["k", "v", "fk", "w"]


def test_global_sorts_sample_no_document_or_message(spark):
    """Range exchanges hold the asked keys and one hash; wide columns stay out of the sampled key."""
    import re

    asked = {"q1_reports_with_sources": ["ReportName"], "q3_subscription_jobs": ["ReportName", "LastRunDateTime"],
             "q6_shared_data_sources": ["DataSourcePath", "SharedDataSourceName"], "q7_data_source_dependents": ["DataSourcePath", "SharedDataSourceName"],
             "q8_report_runs": ["TimeStart"], "q9_runs_since": ["TimeStart"], "q11_large_renders": ["ByteCount"],
             "q17_subscriptions_matching": ["ReportPath", "ReportName"], "new_failures": ["JobName", "StepName", "LastRunDateTime"]}
    for name, keys in asked.items():
        p = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        ranges = re.findall(r"Exchange rangepartitioning\((.*?), \d+\), ENSURE", p)
        assert ranges, name
        for r in ranges:
            assert len(re.findall("(?:ASC|DESC) NULLS", r)) == len(keys) + 1, (name, r)
            bare = re.sub(r"xxhash64\([^()]*\)", "", r)  # the sample holds the hash, not what goes into it
            assert set(re.findall(r"(\w+)#\d+", bare)) <= {*keys, "_key"}, (name, r)


def test_asked_order_holds(spark):
    order = {"q8_report_runs": [("TimeStart", True)], "q9_runs_since": [("TimeStart", True)], "q10_running_requests": [("StartDate", False)],
             "q11_large_renders": [("ByteCount", True)], "q12_runs_in_range": [("TimeStart", False)], "q1_reports_with_sources": [("ReportName", False)],
             "q2_catalog_types": [("Name", False)], "q6_shared_data_sources": [("DataSourcePath", False)], "q13_report_stats": [("AvgProcTimeMS", True)],
             "q7_data_source_dependents": [("DataSourcePath", False)], "q17_subscriptions_matching": [("ReportPath", False)], "q3_subscription_jobs": [("ReportName", False)]}
    for name, keys in order.items():
        for col, desc in keys:
            got = [r[0] for r in QUERIES[name](spark, "/root/testdata/sf0.001").select(col).collect() if r[0] is not None]
            assert got and got == sorted(got, reverse=desc), name


def test_values_are_extracted_once(spark):
    for name, most in (("q17_subscriptions_matching", 1), ("q3_subscription_jobs", 1), ("q7_data_source_dependents", 0)):
        p = optimized(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert p.count("XPathStringEvaluator") == most, name
    assert optimized(QUERIES["q7_data_source_dependents"](spark, "/root/testdata/sf0.001")).count("from_xml") <= 3


def test_large_renders_range_reaches_parquet(spark):
    d = tempfile.mkdtemp(prefix="opslog-plan-")
    path = os.path.join(d, "log")
    spark.createDataFrame([(1, 200000), (2, 5)], "ReportID long, ByteCount long").write.parquet(path)
    p = plan(large_renders(spark.read.parquet(path), 100))
    assert "GreaterThanOrEqual(ByteCount,103424)" in p
    assert [r.ReportID for r in large_renders(spark.read.parquet(path), 100).collect()] == [1]


def test_no_python_udf_anywhere(spark):
    for name in QUERIES:
        p = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_sort_balanced_splits_a_hot_sort_value(spark):
    from pyspark.sql import functions as F

    from opslog.operators.ordering import sort_balanced

    # a third of the rows share one sort value
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("v"))
    out = sort_balanced(df, F.col("k").desc())
    ks = [r.k for r in out.collect()]
    assert ks == sorted(ks, reverse=True)
    # the hot value spreads over several range partitions (tiny data: keep AQE
    # from merging the partitions back into one)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (sort_balanced(df, "k").withColumn("p", F.spark_partition_id())
                 .filter(F.col("k") == 7).select("p").distinct().count())
        plain = (df.orderBy("k").withColumn("p", F.spark_partition_id())
                 .filter(F.col("k") == 7).select("p").distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert plain == 1 and parts > 1


def test_day_partitioned_log_prunes_folders(spark):
    import datetime as dt

    from opslog.operators import runs_in_range, runs_per_user
    from opslog.sources.logstore import write_by_period

    d = tempfile.mkdtemp(prefix="opslog-days-")
    path = os.path.join(d, "log")
    data = [(1, "u", dt.datetime(2024, 1, day, 12, 0, 0), dt.datetime(2024, 1, day, 12, 0, 5), 1, 5, 1)
            for day in (1, 2, 3, 4)]
    schema = ("ReportID long, UserName string, TimeStart timestamp_ntz, TimeEnd timestamp_ntz, "
              "TimeDataRetrieval int, TimeProcessing int, TimeRendering int")
    write_by_period(spark.createDataFrame(data, schema), path, "TimeStart")
    log = spark.read.parquet(path)
    q = runs_per_user(log, "2024-01-02 00:00:00", "2024-01-03 23:00:00")
    p = plan(q)
    assert "log_day" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert q.first()["NumReports"] == 2
    cat = spark.createDataFrame([(1, "r")], "ItemID long, Name string")
    assert runs_in_range(log, cat, "2024-01-02 00:00:00", "2024-01-02 23:00:00").count() == 1


def test_bucketed_log_and_catalog_join_without_exchange(spark):
    import uuid

    from opslog.operators import execution_history
    from opslog.sources.bucketed import save_bucketed

    suffix = uuid.uuid4().hex[:8]
    log = spark.createDataFrame(
        [(i % 7, "DOM\\u", "PDF", "k", "ok", None, None, 1, 2, 3, 2048, 1) for i in range(50)],
        "ReportID long, UserName string, Format string, Parameters string, Status string, TimeStart timestamp_ntz, "
        "TimeEnd timestamp_ntz, TimeDataRetrieval int, TimeProcessing int, TimeRendering int, ByteCount long, RowCount long")
    cat = spark.createDataFrame([(i, f"r{i}", f"/f/r{i}") for i in range(7)], "ItemID long, Name string, Path string")
    save_bucketed(log, f"log_{suffix}", "ReportID", 4)
    save_bucketed(cat, f"cat_{suffix}", "ItemID", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        q = execution_history(spark.table(f"log_{suffix}"), spark.table(f"cat_{suffix}"), "DOM\\")
        p = plan(q)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert q.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_grouping_by_name_hashes_and_folds_case(spark):
    import datetime as dt

    from opslog.operators import runs_per_user

    log = spark.createDataFrame([("DOM\\Ann", dt.datetime(2024, 1, 1)), ("dom\\ann", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1))],
                                "UserName string, TimeStart timestamp_ntz")
    args = (log, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert "SortAggregate" not in plan(runs_per_user(*args))
    assert sorted(map(tuple, runs_per_user(*args).collect())) == [("DOM\\Ann", 1), ("b", 1), ("dom\\ann", 1)]
    assert [tuple(r) for r in runs_per_user(*args, case_sensitive=False).collect()] == [("b", 1), ("DOM\\Ann", 2)]
    assert "SortAggregate" not in plan(QUERIES["q13_report_stats"](spark, "/root/testdata/sf0.001"))


def test_period_store_follows_rewritten_tables(spark, tmp_path):
    import os
    import shutil

    from opslog.plans.registry import QUERIES

    sf = tmp_path / "sf"
    seen = []
    for size in ("sf0.001", "sf0.01"):
        sf.mkdir(exist_ok=True)
        for name in os.listdir(f"/root/testdata/{size}"):  # contents only: the test data is read-only
            shutil.copyfile(f"/root/testdata/{size}/{name}", sf / name)
        spark.catalog.clearCache()
        got, want = (sorted(map(str, QUERIES[q](spark, str(sf)).collect())) for q in ("runs_in_range_by_period", "q12_runs_in_range"))
        assert got == want
        seen.append(got)
    assert seen[0] != seen[1]


def test_settings_are_extracted_in_a_stage_that_no_sort_samples(spark):
    """The XML values are computed between two exchanges: the first deals the documents to all tasks,
    the second keeps the range sort's sampling from running them again."""
    for q in ("q17_subscriptions_matching", "q3_subscription_jobs"):
        lines = plan(QUERIES[q](spark, "/root/testdata/sf0.001")).split("\n")
        lines = lines[:lines.index("") if "" in lines else len(lines)]
        at = next(i for i, x in enumerate(lines) if "Generate" in x)
        exchanges = [next(i for i, x in enumerate(lines) if kind in x)
                     for kind in ("rangepartitioning", "REPARTITION_BY_COL", "REPARTITION_BY_NUM")]
        assert exchanges[0] < exchanges[1] < at < exchanges[2], q
