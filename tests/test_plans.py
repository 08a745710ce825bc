"""What the physical plans must keep: pruned scans, no cross joins, no Python evaluation."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from growthmill.operators import loading, skew, staging
from growthmill.plans import marketing
from growthmill.sources import product_events, specs
from verification.registry import QUERIES, Models

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookback_reads_only_its_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(i, date(2024, 1, i)) for i in range(1, 10)], "id int, day date")
    loading.write_table(rows, str(tmp_path / "t"), "overwrite", "day")
    text = plan(loading.lookback_window(spark.read.parquet(str(tmp_path / "t")), "day", date(2024, 1, 5), 2))
    assert "PartitionFilters: [isnotnull(day" in text and "2024-01-03" in text and "2024-01-06" in text


def test_lines_without_a_wanted_name_are_not_parsed(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"event":"A"}\n')
    frame = product_events.read_events(spark, str(tmp_path), ["A", "B"], export_day=date(2024, 1, 1))
    text = plan(frame)
    pushed = text[text.index("PushedFilters") : text.index("ReadSchema")]
    assert "StringContains(value,A)" in pushed and "StringContains(value,B)" in pushed
    steps = frame._jdf.queryExecution().executedPlan().toString()
    assert steps.count("from_json") == 1


def test_the_roi_mart_reads_only_its_columns(spark, tmp_path):
    for spec, name in ((specs.GOOGLE_ADS, "g"), (specs.META_ADS, "m")):
        spark.createDataFrame([], spec.schema).write.parquet(str(tmp_path / name))
    google = staging.stg_google_ads(spark.read.parquet(str(tmp_path / "g")))
    meta = staging.stg_meta_ads(spark.read.parquet(str(tmp_path / "m")))
    text = plan(marketing.fct_ad_spend_roi(marketing.fct_campaign_performance(google, meta)))
    for unused in ("ad_group_name", "video_views", "search_impression_share", "frequency", "_extracted_at"):
        assert unused not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_declared_fields_prune_nested_columns(spark, tmp_path):
    from growthmill.sources.ads import GOOGLE_ADS_PAYLOAD

    spark.createDataFrame([], GOOGLE_ADS_PAYLOAD).write.parquet(str(tmp_path / "g"))
    text = plan(specs.declared_projection(spark.read.parquet(str(tmp_path / "g")), specs.GOOGLE_ADS))
    schema = text[text.index("ReadSchema") :]
    assert "advertising_channel_type" not in schema and "average_cpc" not in schema


def test_hot_keys_are_the_only_broadcast_hint(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    assert skew.heaviest_keys(left, ["k"], 7).count() == 6
    assert skew.heaviest_keys(left, ["k"], 4).count() == 0
    joined = skew.join_key_table(left, right, ["k"])
    logical = joined._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("strategy=broadcast") == 2


EAGER = ("sink_", "src_", "stream_", "merge_", "backfill_", "incremental_", "run_", "materialize", "lenient_")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name].run(Models(spark, SF_DIR)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert operator not in text
