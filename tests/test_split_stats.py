"""Exact split (C19, properties) and statistics."""

import hashlib

from pyspark.sql import functions as F

from convforge.operators import split as splitting
from convforge.operators import stats as st
from convforge.operators import validate as va


def split_counts(spark, n, ratio):
    df = spark.range(n).withColumnRenamed("id", "k")
    s = splitting.assign_split(df, F.col("k"), val_ratio=ratio, seed=42)
    c = {r["split"]: r["n"] for r in st.split_sizes(s).collect()}
    return c.get("train", 0), c.get("val", 0)


def test_c19_sizes(spark):
    expect = {(1, 0.1): 0, (10, 0.1): 9, (20, 0.1): 18, (98, 0.1): 88, (100, 0.1): 90,
              (1, 0.15): 0, (10, 0.15): 8, (20, 0.15): 17, (98, 0.15): 83, (100, 0.15): 85}
    for (n, ratio), train in expect.items():
        assert train == int(n * (1 - ratio))
        assert split_counts(spark, n, ratio) == (train, n - train)


def test_split_properties_and_rank(spark):
    n = 5000
    df = spark.range(n).withColumnRenamed("id", "k").repartition(7)
    s = splitting.assign_split(df, F.col("k"), val_ratio=0.2, seed=7, hex_chars=2).collect()
    order = sorted(range(n), key=lambda k: hashlib.md5(f"{k}:7".encode()).hexdigest())
    rank = {k: i + 1 for i, k in enumerate(order)}
    cut = int(n * (1 - 0.2))
    assert all(r["shuffle_rank"] == rank[r["k"]] for r in s)
    assert sorted(r["k"] for r in s if r["split"] == "train") == sorted(order[:cut])
    assert sorted(r["k"] for r in s if r["split"] == "val") == sorted(order[cut:])
    val_ranks = sorted(r["split_rank"] for r in s if r["split"] == "val")
    assert val_ranks == list(range(1, n - cut + 1))


def test_split_overlap_reports_duplicates(spark):
    df = spark.createDataFrame([(i, f"text{i % 40}") for i in range(100)], "k long, body string")
    s = splitting.assign_split(df, F.col("k"), val_ratio=0.5)
    r = splitting.split_overlap(s, F.col("body")).first()
    assert r["n_train"] + r["n_val"] == 100 and r["n_shared_keys"] > 0


def conv_df(spark, convs):
    rows = [(i, [(r, c) for r, c in m]) for i, m in enumerate(convs)]
    return spark.createDataFrame(rows, "k long, messages array<struct<role:string,content:string>>")


def test_c20_c21_stats(spark):
    convs = [[("system", "s"), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],
             [("user", "x"), ("assistant", "y")]]
    s = st.corpus_stats(va.profile_conversations(conv_df(spark, convs), ["k"])).first().asDict()
    assert s == {"conversations": 2, "total_turns": 7, "system_prompts": 1, "user_messages": 3,
                 "assistant_messages": 3, "multi_turn_conversations": 1, "total_characters": 7,
                 "estimated_tokens": 2}
    two = [[("user", "a"), ("assistant", "b")], [("user", "c"), ("assistant", "d")]]
    s2 = st.corpus_stats(va.profile_conversations(conv_df(spark, two), ["k"])).first()
    assert s2["total_characters"] == 4 and s2["estimated_tokens"] == 1


def test_empty_stats_are_zero(spark):
    empty = conv_df(spark, []).where("false")
    s = st.corpus_stats(va.profile_conversations(empty, ["k"])).first().asDict()
    assert set(s.values()) == {0}


def test_stats_report_labels(spark):
    convs = [[("user", "a" * 1500), ("assistant", "b")]]
    rep = st.stats_report(st.corpus_stats(va.profile_conversations(conv_df(spark, convs), ["k"])))
    rows = {r["stat"]: (r["label"], r["display"]) for r in rep.collect()}
    assert rows["multi_turn_conversations"][0] == "Multi Turn Conversations"
    assert rows["total_characters"] == ("Total Characters", "1,501")
