"""End-to-end jobs: prepare -> training text -> evaluate -> inference."""

import glob
import json
import os

from convforge.operators.generate import EchoGenerator
from convforge.plans import evaluate as ev
from convforge.plans import inference as inf
from convforge.plans import prepare as prep
from convforge.plans import training_text as tt
from convforge.sources import processed as pr


def make_raw(d, n=60):
    os.makedirs(d)
    rows = []
    for i in range(n):
        msgs = [{"role": "system", "content": "sys"}, {"role": "user", "content": f" question {i} "},
                {"role": "assistant", "content": f"answer {i} " + "word " * (i % 7)}]
        if i % 10 == 3:
            msgs[1]["role"] = "tool"
        rows.append(json.dumps({"id": i, "messages": msgs}))
    with open(os.path.join(d, "a.jsonl"), "w") as f:
        f.write("\n".join(rows[: n // 2]) + "\n\n")
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write(",\n".join(json.dumps(json.loads(r), indent=2) for r in rows[n // 2:]))


def test_prepare_train_text_evaluate(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw")
    out = os.path.join(tmp_dir, "data")
    make_raw(raw_dir)
    res = prep.prepare_data(spark, raw_dir, out, val_ratio=0.1, seed=42)
    assert res.stats["conversations"] == 54 and res.stats["system_prompts"] == 54
    assert (res.train, res.val) == (48, 6)
    audit = {r["file_name"]: (r["raw_objects"], r["valid_conversations"]) for r in res.audit.collect()}
    assert audit == {"a.jsonl": (30, 27), "b.json": (30, 27)}
    assert {r["reason"] for r in res.rejects.collect()} == {"bad_role"}

    train, val = tt.load_splits(spark, f"{out}/train.jsonl", f"{out}/val.jsonl")
    texts = tt.training_texts(train, max_tokens=5)
    assert texts.count() == 48 and texts.where("is_truncated").count() == 48
    # a 5-token budget keeps 15 characters
    assert tt.first_text_preview(texts).first()["preview"] == "<|im_start|>sys"

    report = os.path.join(tmp_dir, "eval.json")
    r = ev.evaluate(spark, f"{out}/val.jsonl", EchoGenerator, train_path=f"{out}/train.jsonl",
                    num_samples=3, output=report)
    doc = json.load(open(glob.glob(r["report_path"] + "/part-*")[0], encoding="utf-8"))
    assert doc["num_val_samples"] == 6 and len(doc["sample_responses"]) == 3
    assert doc["perplexity"] > 1.0
    assert doc["sample_responses"][0]["generated"].startswith("reply:")
    assert spark.read.parquet(r["running_path"]).count() == 0  # 6 examples: none is a 10th

    r2 = ev.evaluate(spark, f"{out}/train.jsonl", EchoGenerator, train_path=f"{out}/train.jsonl",
                     num_samples=None, output=os.path.join(tmp_dir, "eval2.json"))
    run = spark.read.parquet(r2["running_path"]).orderBy("processed").collect()
    assert [x["processed"] for x in run] == [10, 20, 30, 40]
    assert run[-1]["running_display"] == f"{run[-1]['running_perplexity']:.2f}"
    doc = json.load(open(glob.glob(r2["report_path"] + "/part-*")[0], encoding="utf-8"))
    assert len(doc["sample_responses"]) == 48 and doc["num_val_samples"] == 48
    r3 = ev.evaluate(spark, f"{out}/val.jsonl", EchoGenerator, train_path=f"{out}/train.jsonl",
                     max_samples=3, num_samples=1, output=os.path.join(tmp_dir, "eval3.json"))
    assert r3["num_val_samples"] == 6  # the split, not what was scored


def test_empty_validation_split_reports_null_perplexity(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw")
    make_raw(raw_dir, n=10)
    out = os.path.join(tmp_dir, "data")
    res = prep.prepare_data(spark, raw_dir, out, val_ratio=0.0)
    assert (res.train, res.val) == (9, 0)
    r = ev.evaluate(spark, f"{out}/val.jsonl", EchoGenerator, train_path=f"{out}/train.jsonl",
                    output=os.path.join(tmp_dir, "r.json"))
    doc = json.load(open(glob.glob(r["report_path"] + "/part-*")[0], encoding="utf-8"))
    assert doc == {"perplexity": None, "num_val_samples": 0, "sample_responses": []}


def test_evaluate_with_external_scores(spark, tmp_dir):
    import math
    path = os.path.join(tmp_dir, "val.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        for i in range(4):
            f.write(json.dumps({"messages": [{"role": "user", "content": f"q{i}"},
                                             {"role": "assistant", "content": "a"}]}) + "\n")
    # scores computed elsewhere, keyed by file and line of the validation file
    ext = spark.createDataFrame([("val.jsonl", 0, 2.0, 10), ("val.jsonl", 1, 1.0, 30),
                                 ("val.jsonl", 2, 1.0, 0), ("val.jsonl", 3, 1.0, 0)],
                                "file_name string, line_index int, loss double, n_tokens long")
    r = ev.evaluate(spark, path, EchoGenerator, scores_table=ext, num_samples=1,
                    output=os.path.join(tmp_dir, "r.json"))
    assert math.isclose(r["perplexity"], math.exp(1.25)) and r["num_val_samples"] == 4


def test_evaluate_plain_single_file(spark, tmp_dir):
    # a split file as a plain JSONL file, the reference's own format
    path = os.path.join(tmp_dir, "val.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        for i in range(23):
            f.write(json.dumps({"messages": [{"role": "user", "content": f"q {i}"},
                                             {"role": "assistant", "content": f"a {i}"}]},
                               ensure_ascii=False) + "\n")
    r = ev.evaluate(spark, path, EchoGenerator, train_path=path, num_samples=2,
                    output=os.path.join(tmp_dir, "r.json"))
    assert r["num_val_samples"] == 23
    run = spark.read.parquet(r["running_path"]).orderBy("processed").collect()
    assert [x["processed"] for x in run] == [10, 20]
    order = pr.dataset_order(pr.read_processed(spark, path)).orderBy("example").collect()
    assert [x["messages"][0]["content"] for x in order] == [f"q {i}" for i in range(23)]


def test_inference_queries(spark):
    q = pr.query_table(spark, ["Mera naam?", "When?"])
    out = {r["query_id"]: r for r in inf.answer_queries(q, EchoGenerator, system_prompt="S").collect()}
    assert out[0]["prompt"].startswith("<|im_start|>system\nS<|im_end|>")
    import hashlib
    assert out[1]["generated"] == (f"reply:{len(out[1]['prompt'])} "
                                   + hashlib.md5(out[1]["prompt"].encode()).hexdigest())
    assert inf.answer_one(spark, "hello", EchoGenerator).startswith("reply:")


def test_command_line_jobs(tmp_dir, capsys, spark):
    raw_dir = os.path.join(tmp_dir, "raw")
    out = os.path.join(tmp_dir, "data")
    make_raw(raw_dir, n=30)
    assert prep.main(["--raw_dir", raw_dir, "--output_dir", out]) == 0
    text = capsys.readouterr().out
    assert "Multi Turn Conversations: 0" in text and "Conversations: 27" in text
    assert "24 training, 3 validation" in text
    assert "a.jsonl: 2 x bad_role" in text
    assert ev.main(["--val_path", f"{out}/val.jsonl", "--train_path", f"{out}/train.jsonl",
                    "--generator", "convforge.operators.generate:EchoGenerator",
                    "--output", os.path.join(tmp_dir, "r.json")]) == 0
    assert "validation examples, perplexity" in capsys.readouterr().out
    assert inf.main(["--generator", "convforge.operators.generate:EchoGenerator",
                     "--query", "hello"]) == 0
    assert capsys.readouterr().out.startswith("reply:")
    assert tt.main(["--train", f"{out}/train.jsonl", "--val", f"{out}/val.jsonl",
                    "--out", os.path.join(tmp_dir, "texts")]) == 0
    assert "train samples: 24" in capsys.readouterr().out
    assert prep.main(["--raw_dir", os.path.join(tmp_dir, "missing")]) == 1
    arr_dir = os.path.join(tmp_dir, "arr")
    os.makedirs(arr_dir)
    with open(os.path.join(arr_dir, "a.json"), "w") as f:
        f.write(json.dumps([json.loads(r) for r in [
            json.dumps({"messages": [{"role": "user", "content": f"q{i}"},
                                     {"role": "assistant", "content": "a"}]}) for i in range(5)]]))
    assert prep.main(["--raw_dir", arr_dir, "--output_dir", os.path.join(tmp_dir, "o2"),
                      "--explode_arrays"]) == 0
    assert "Conversations: 5" in capsys.readouterr().out
    scores = os.path.join(tmp_dir, "scores")
    spark.createDataFrame([("x", 0, 1.0, 3)], "file_name string, line_index int, loss double, "
                          "n_tokens long").write.parquet(scores)
    assert ev.main(["--val_path", f"{out}/val.jsonl", "--generator",
                    "convforge.operators.generate:EchoGenerator", "--scores_table", scores,
                    "--output", os.path.join(tmp_dir, "r3.json")]) == 0
    assert "perplexity n/a" in capsys.readouterr().out  # no score matched


def test_curated_chats_join_the_corpus(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw")
    make_raw(raw_dir, n=10)
    with open(os.path.join(raw_dir, "chats.md"), "w") as f:
        f.write("# Chats\n\n---\n\n### One\n**User:** Hi\n\n**Bot:** Hello\n\n---\n\n"
                "### Two\n**User:** Q\n\n**Bot:** A\n\n---\n\n### Three\n**User:** Q\n\n**Bot:**  \n")
    res = prep.prepare_data(spark, raw_dir, os.path.join(tmp_dir, "data"), curated_glob="*.md",
                            assistant_label="Bot")
    assert res.stats["conversations"] == 9 + 2
    audit = {r["file_name"]: (r["raw_objects"], r["valid_conversations"]) for r in res.audit.collect()}
    assert audit["chats.md"] == (3, 2)


def test_sessions_are_answered_with_their_history(spark):
    class Counter:
        def __call__(self, prompts, **params):
            return [f" reply {p.count('<|im_start|>user')} after {p.count('<|im_start|>assistant') - 1}" for p in prompts]

    log = spark.createDataFrame([("s", 1, "a"), ("s", 2, " "), ("s", 3, "b"), ("s", 4, "reset"), ("s", 5, "c"),
                                 ("t", 1, "d"), ("t", 2, "quit"), ("t", 3, "e")],
                                "session string, line_no long, text string")
    got = {(r["session"], r["segment"]): [(m["role"], m["content"]) for m in r["messages"]]
           for r in inf.answer_sessions(log, Counter, system_prompt="S").collect()}
    assert got == {
        ("s", 0): [("system", "S"), ("user", "a"), ("assistant", "reply 1 after 0"),
                   ("user", "b"), ("assistant", "reply 2 after 1")],
        ("s", 1): [("system", "S"), ("user", "c"), ("assistant", "reply 1 after 0")],
        ("t", 0): [("system", "S"), ("user", "d"), ("assistant", "reply 1 after 0")]}
