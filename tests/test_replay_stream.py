"""Replay (C27), streaming ingest (R1 = batch), generation."""

import json
import os

from pyspark.sql import functions as F

from convforge.operators import generate as gen
from convforge.operators import replay as rp
from convforge.plans import prepare as prep
from convforge.streaming import ingest as stream


def test_c27_replay(spark):
    log = ["hi", "  ", "RESET", " ok ", "quit", "late"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(log)],
                               "session long, line_no long, text string")
    out = rp.replay_sessions(df, system_prompt="SYS", block=2).orderBy("segment", "position").collect()
    assert [(r["segment"], r["position"], r["role"], r["content"]) for r in out] == [
        (0, 0, "system", "SYS"), (0, 1, "user", "hi"),
        (1, 0, "system", "SYS"), (1, 1, "user", "ok")]


def test_stream_equals_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    good = json.dumps({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]})
    for f in range(3):
        with open(os.path.join(src, f"f{f}.jsonl"), "w") as fh:
            fh.write("\n".join([good, "{bad", "", '{"x":1}', good]) + "\n")
    q = stream.start_ingest(spark, src, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"),
                            max_files_per_trigger=1)
    q.awaitTermination()
    ok = stream.accepted_conversations(spark, os.path.join(tmp_dir, "out"))
    bad = stream.rejected_values(spark, os.path.join(tmp_dir, "out"))
    b = prep.ingest(spark, src, json_glob=None)
    key = ["file_path", "file_name", "object_index", "line_no"]
    for got, want in ((ok, b.where(F.col("reason").isNull())), (bad, b.where(F.col("reason").isNotNull()))):
        assert sorted(map(tuple, got.select(*key).collect()), key=str) == \
            sorted(map(tuple, want.select(*key).collect()), key=str)
    assert ok.count() == 6 and {r["reason"] for r in bad.collect()} == {"parse_error", "no_messages_key"}


def test_generate_strips_and_passes_params(spark):
    class Gen:
        def __call__(self, prompts, **params):
            return [f"  {p}|{params['max_new_tokens']}|{params['temperature']} \n" for p in prompts]
    df = spark.createDataFrame([(0, "a"), (1, "b")], "k long, prompt string")
    out = {r["k"]: r["generated"] for r in
           gen.batch_generate(df, Gen, ["k"], params={"temperature": 0.2}).collect()}
    assert out == {0: "a|512|0.2", 1: "b|512|0.2"}


def test_generate_micro_batches_and_partitions(spark):
    class Gen:
        def __call__(self, prompts, **params):
            assert len(prompts) <= 3
            return [f"{p}|{len(prompts)}" for p in prompts]
    df = spark.range(20).selectExpr("id as k", "cast(id as string) as prompt").coalesce(1)
    out = gen.batch_generate(df, Gen, ["k"], batch_size=3, num_partitions=4)
    rows = {r["k"]: r["generated"] for r in out.collect()}
    assert sorted(rows) == list(range(20))
    assert all(v.split("|")[0] == str(k) for k, v in rows.items())
