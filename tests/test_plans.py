"""Physical-plan properties that the scale design relies on."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from convforge.operators import split as splitting
from convforge.operators import stats as st
from convforge.operators import validate as va
from convforge.plans import injected as inj


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_is_hash_aggregated(spark):
    t = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    p = plan_of(va.profile_turns(t))
    assert "HashAggregate" in p
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_stats_combine_partially(spark):
    t = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    p = plan_of(st.corpus_stats(va.profile_turns(t).where(F.col("reason").isNull())))
    assert p.count("HashAggregate") >= 4  # partial + final for both levels


def test_reason_filter_stays_above_the_fence(spark):
    lines = inj.damaged_lines(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    plan = va.accepted(va.validate_values(lines), ["conv_id"])._jdf.queryExecution().optimizedPlan().toString()
    # the filter on reason sits on the generator output, not inside the parse
    filt = [ln for ln in plan.splitlines() if "Filter" in ln and "reason" in ln]
    assert filt and all("parse_json" not in ln.lower() for ln in filt)


def test_rank_sorts_within_buckets_only(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    s = splitting.assign_split(df, "k", hex_chars=2)
    s.collect()
    p = plan_of(s)
    # the row-level window is partitioned by bucket
    windows = [ln for ln in p.splitlines() if "Window [" in ln]
    assert windows and any("_bkt" in ln for ln in windows)
