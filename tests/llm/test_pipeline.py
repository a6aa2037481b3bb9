"""Every stage against a brute-force reading of its input, and the whole run."""

import zlib

import corpus_pipeline
import __spark_entry__ as E
from conftest import SF_SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = E.queries()
    assert [n for k in range(1, 14) for n in names if n.startswith(f"op{k}_")] and "pipeline" in names
    assert len([n for n in names if n.startswith("op")]) == 13


def test_stages(spark, small_docs):
    rows = {}
    docs = small_docs
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF_SMALL), f"test-{name}")
        rows[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == COLUMNS
    q = E.queries()["op1_quality"](spark, SF_SMALL)
    kept = {r["doc_id"] for r in q.where("predicted = 1").collect()}
    assert {r["doc_id"] for r in rows["quality"][1].collect()} == kept

    from llm.test_jaccard import brute
    before, after = rows["near_duplicates"]
    groups = brute([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80, 100)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({c for _, _, c in groups})

    before, after = rows["decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in after.collect()}
    for r in before.collect():
        if any(t in r["text"] for t in items):
            assert r["doc_id"] not in left
    assert len(left) > 0.8 * before.count()

    before, after = rows["mixing"]
    copies = {}
    for r in after.collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 3 and set(copies) <= {r["doc_id"] for r in before.collect()}

    before, after = rows["sharding"]
    got = after.collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in before.collect())
    assert all(r["text_crc32"] == zlib.crc32(r["text"].encode()) for r in got)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_stages_on_awkward_rows(spark, awkward, nothing):
    for docs in (awkward.select(*COLUMNS), nothing.select(*COLUMNS)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert out.count() <= 3 * n
            if name == "near_duplicates" and n:
                assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
                    ["1", "3", "4", "5", "6", "6", "None", "7", "8", "9"])


def test_decisions_are_by_row(spark):
    """Ids that are null or shared by several texts: only the rows concerned go."""
    w = ["w%d" % i for i in range(120)]
    text = " ".join(w)
    near = " ".join(w[:-1] + ["x"])
    other = " ".join("v%d" % i for i in range(90))
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("text").head()["text"]
    rows = [(1, text), (2, near), (2, other), (3, other + " more"), (None, text), (None, "a text of its own"),
            (1, text), (4, item), (4, "clean " + other[::-1]), (None, item + " tail"), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stages = dict(corpus_pipeline.STAGES)
    left = sorted(((r["doc_id"], r["text"]) for r in stages["near_duplicates"](spark, docs, SF_SMALL).collect()), key=str)
    assert left == sorted([(1, text), (2, other), (None, "a text of its own"), (4, "clean " + other[::-1]), (5, None), (5, ""),
                           *[(i, t) for i, t in rows if t and item in t and i == 4]]
                          + ([] if near_enough(item) else [(None, item + " tail")]), key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in stages["decontamination"](spark, docs, SF_SMALL).collect()), key=str)
    assert left == sorted([(i, t) for i, t in rows if item not in (t or "")], key=str)


def near_enough(item):
    n = max(1, len(item.split()) - 4)
    return n >= 0.8 * (n + 1)
