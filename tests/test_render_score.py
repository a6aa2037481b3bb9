"""Rendering (T1-T7, C22, C26), scoring and perplexity."""

import math

from pyspark.sql import functions as F

from convforge.functions.template import ChatTemplate
from convforge.operators import render as rd
from convforge.operators import score as sc
from convforge.operators.ordering import running_within


def conv_df(spark, convs):
    rows = [(i, [(r, c) for r, c in m]) for i, m in enumerate(convs)]
    return spark.createDataFrame(rows, "k long, messages array<struct<role:string,content:string>>")


def test_t1_t2_chatml(spark):
    df = conv_df(spark, [[("system", "S"), ("user", "U"), ("assistant", "A")]])
    t = rd.chat_text(df, ["k"]).first()["text"]
    assert t == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n" \
                "<|im_start|>assistant\nA<|im_end|>\n"
    p = rd.chat_text(df, ["k"], add_generation_prompt=True).first()["text"]
    assert p == t + "<|im_start|>assistant\n"
    tpl = ChatTemplate("[{role}] ", "\n", "[assistant] ", default_system="D")
    assert rd.chat_text(conv_df(spark, [[("user", "U")]]), ["k"], tpl).first()["text"] == \
        "[system] D\n[user] U\n"


def test_c22_context_and_expected(spark):
    df = conv_df(spark, [[("system", "S"), ("assistant", "early"), ("user", "Q"), ("assistant", "late")],
                         [("system", "S"), ("assistant", "only")]])
    rows = rd.eval_prompts(df, ["k"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["user_query"] == "Q" and r["expected"] == "early"
    assert r["prompt"].endswith("<|im_start|>user\nQ<|im_end|>\n<|im_start|>assistant\n")
    assert "late" not in r["prompt"] and "early" in r["prompt"]


def test_c26_system_prompt_default(spark):
    q = spark.createDataFrame([(0, "hi")], "id long, query string")
    for system, expect in ((None, "DEF"), ("", "DEF"), ("given", "given")):
        m = rd.build_prompts(q, ["id"], system=system, default_system="DEF").first()["messages"]
        assert [x["role"] for x in m] == ["system", "user"]
        assert m[0]["content"] == expect and m[1]["content"] == "hi"


def test_truncation_estimate_and_exact(spark):
    df = spark.createDataFrame([(0, "x" * 10), (1, "y" * 4)], "k long, text string")
    out = {r["k"]: r for r in rd.truncate_by_estimate(df, max_tokens=2).collect()}
    assert out[0]["text"] == "x" * 6 and out[0]["is_truncated"] and out[0]["est_tokens"] == 3
    assert out[1]["text"] == "y" * 4 and not out[1]["is_truncated"]

    class Words:
        def encode(self, s):
            return s.split(" ")

        def decode(self, ids):
            return " ".join(ids)
    df2 = spark.createDataFrame([(0, "a b c d e"), (1, "a b")], "k long, text string")
    ex = {r["k"]: r for r in rd.truncate_exact(df2, Words, max_tokens=3).collect()}
    assert ex[0]["text"] == "a b c" and ex[0]["n_tokens"] == 3 and ex[0]["is_truncated"]
    assert ex[1]["text"] == "a b" and ex[1]["n_tokens"] == 2


def test_c23_c25_perplexity(spark):
    s = spark.createDataFrame([(0, 2.0, 10), (1, 1.0, 30)], "k long, loss double, n_tokens long")
    assert math.isclose(sc.perplexity(s).first()["perplexity"], math.exp(1.25))
    assert sc.perplexity(s.where("false")).first()["perplexity"] is None


def test_c24_running_every_tenth(spark):
    rows = [(i + 1, 0.1 * (i % 5), 3 + i % 4) for i in range(25)]
    s = spark.createDataFrame(rows, "pos long, loss double, n_tokens long")
    got = sc.running_perplexity(s, "pos", F.floor((F.col("pos") - 1) / 7).cast("int")).collect()
    assert sorted(r["processed"] for r in got) == [10, 20]
    for r in got:
        k = r["processed"]
        num = sum(x[1] * x[2] for x in rows[:k])
        den = sum(x[2] for x in rows[:k])
        assert math.isclose(r["running_perplexity"], math.exp(num / den))


def test_unigram_matches_brute_force(spark):
    import re
    train = ["the cat sat", "the dog ran", "a cat ran"]
    val = ["the cat ran away", "zebra", ""]
    tr = spark.createDataFrame(list(enumerate(train)), "k long, text string")
    va_ = spark.createDataFrame(list(enumerate(val)), "k long, text string")
    scorer = sc.UnigramScorer.fit(tr, max_tokens=3)
    got = {r["k"]: (r["loss"], r["n_tokens"]) for r in scorer.score(va_, ["k"]).collect()}
    words = [w for t in train for w in re.findall(r"\w+", t)]
    counts = {w: words.count(w) for w in set(words)}
    denom = len(words) + len(counts) + 1
    for k, t in enumerate(val):
        toks = re.findall(r"\w+", t)[:3]
        if not toks:
            assert got[k] == (None, 0)
            continue
        loss = sum(-math.log((counts.get(w, 0) + 1) / denom) for w in toks) / len(toks)
        assert math.isclose(got[k][0], loss) and got[k][1] == len(toks)


def test_running_within_matches_cumsum(spark):
    rows = [(g, i, (i * 7 + g) % 5) for g in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "g long, i long, v long")
    out = running_within(df, "g", "i", F.floor(F.col("i") / 17).cast("long"), ["v"]).collect()
    for r in out:
        assert r["run_v"] == sum(x[2] for x in rows if x[0] == r["g"] and x[1] <= r["i"])


def test_exact_truncation_with_a_user_tokenizer(spark):
    class WordCodec:  # words are tokens
        def encode(self, text):
            return text.split()

        def decode(self, ids):
            return " ".join(ids)

    df = spark.createDataFrame([(0, "the cat sat on the mat"), (1, "a dog")], "k long, text string")
    out = {r["k"]: r for r in rd.truncate_exact(df, WordCodec, max_tokens=3).collect()}
    assert out[0]["n_tokens"] == 3 and out[0]["is_truncated"] and out[0]["text"] == "the cat sat"
    assert out[1]["n_tokens"] == 2 and not out[1]["is_truncated"] and out[1]["text"] == "a dog"
