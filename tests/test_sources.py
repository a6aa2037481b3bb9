"""Raw readers (S1-S3, S9) and processed files (S4, S5); FIXTURES C2, C15-C18."""

import json
import os

from pyspark.sql import functions as F

from convforge.operators import validate as va
from convforge.plans import prepare as prep
from convforge.sources import curated, processed, raw


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def conv_json(u, a, **extra):
    d = {"messages": [{"role": "user", "content": u}, {"role": "assistant", "content": a}]}
    d.update(extra)
    return json.dumps(d, ensure_ascii=False)


def test_c2_jsonl_blank_lines_and_numbering(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.jsonl"),
          "\n".join([conv_json("u0", "a0"), "", "   ", "{broken", conv_json("u1", "a1"),
                     '{"x": 1}', conv_json("u2", "a2")]) + "\n")
    v = prep.ingest(spark, tmp_dir, json_glob=None)
    rows = sorted((r["object_index"] if r["object_index"] is not None else -1, r["reason"], r["line_no"])
                  for r in v.collect())
    # blanks are not values; the broken line is reported (with its physical
    # line number, as the reference warns) but not numbered as a value
    assert rows == [(-1, "parse_error", 4), (0, None, 1), (1, None, 5),
                    (2, "no_messages_key", 6), (3, None, 7)]


def test_jsonl_numbering_across_splits(spark, tmp_dir):
    lines = [conv_json(f"u{i}", f"a{i}") for i in range(3000)]
    write(os.path.join(tmp_dir, "big.jsonl"), "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        v = raw.read_jsonl(spark, tmp_dir)
        got = {r["object_index"]: json.loads(r["value"])["messages"][0]["content"] for r in v.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: f"u{i}" for i in range(3000)}


def test_c15_c16_concatenated_files(spark, tmp_dir):
    pretty = json.dumps(json.loads(conv_json("p", "q")), indent=2)
    write(os.path.join(tmp_dir, "two.json"), conv_json("a", "b") + ",\n" + pretty + "\n")
    write(os.path.join(tmp_dir, "junk.json"),
          conv_json("1", "1") + conv_json("2", "2") + "\n" + conv_json("3", "3") + "\njunk [4]")
    v = raw.read_mixed_json(spark, tmp_dir)
    two = sorted((r["object_index"], r["value"]) for r in v.where(F.col("file_name") == "two.json").collect())
    assert [i for i, _ in two] == [0, 1]
    assert json.loads(two[1][1])["messages"][0]["content"] == "p"
    junk = v.where(F.col("file_name") == "junk.json").collect()
    values = sorted((r["object_index"], r["value"]) for r in junk if r["value"] is not None)
    assert [json.loads(x) for _, x in values][-1] == [4]
    assert len(values) == 4
    assert sum(r["errors_before"] for r in junk) == 4  # 'j','u','n','k'
    checked = va.validate_values(v.where(F.col("value").isNotNull()))
    reasons = [r["reason"] for r in checked.where(F.col("file_name") == "junk.json")
               .orderBy("object_index").collect()]
    assert reasons == [None, None, None, "no_messages_key"]


def test_c17_top_level_array_rejected(spark, tmp_dir):
    write(os.path.join(tmp_dir, "arr.json"), "[" + conv_json("a", "b") + "," + conv_json("c", "d") + "]")
    v = va.validate_values(raw.read_mixed_json(spark, tmp_dir))
    assert [(r["object_index"], r["reason"]) for r in v.collect()] == [(0, "no_messages_key")]


def test_c18_truncated_object_then_good(spark, tmp_dir):
    good = conv_json("good", "yes")
    write(os.path.join(tmp_dir, "t.json"), '{"messages": [{"role": "user", "con\n' + good)
    v = va.validate_values(raw.read_mixed_json(spark, tmp_dir).where(F.col("value").isNotNull()))
    kept = va.accepted(v, ["object_index"]).collect()
    assert [m["content"] for m in kept[-1]["messages"]] == ["good", "yes"]
    assert len(kept) == 1 and v.count() > 1  # fragments are ordinary rejects


def test_s3_dispatch_by_suffix(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.jsonl"), conv_json("x", "y") + "\n")
    write(os.path.join(tmp_dir, "b.json"), conv_json("p", "q") + conv_json("r", "s"))
    write(os.path.join(tmp_dir, "c.txt"), conv_json("no", "no") + "\n")
    write(os.path.join(tmp_dir, "D.JSON"), conv_json("no", "no"))
    v = prep.ingest(spark, tmp_dir)
    assert sorted(r["file_name"] for r in v.collect()) == ["a.jsonl", "b.json", "b.json"]
    mixed = prep.ingest(spark, tmp_dir, reader="mixed")
    assert mixed.count() == 3


def test_missing_dir(spark, tmp_dir):
    import pytest
    with pytest.raises(FileNotFoundError):
        prep.ingest(spark, os.path.join(tmp_dir, "nope"))


def test_s5_s4_roundtrip_keeps_order_and_text(spark, tmp_dir):
    rows = [(i, [("user", f"q{i} é"), ("assistant", f"a{i}")]) for i in range(50)]
    df = spark.createDataFrame(rows, "rank long, messages array<struct<role:string,content:string>>")
    out = os.path.join(tmp_dir, "train.jsonl")
    processed.write_jsonl(df, out, order="rank", num_files=4)
    back = processed.read_processed(spark, out).orderBy("file_name", "line_index").collect()
    assert [r["messages"][0]["content"] for r in back] == [f"q{i} é" for i in range(50)]
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read()
                   for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert "é" in text and "\\u00e9" not in text
    assert processed.read_processed(spark, os.path.join(tmp_dir, "none.jsonl")) is None


def test_s9_curated_markdown(spark, tmp_dir):
    md = ("# Title\n\nIntro line.\n\n---\n\n### Conversation 1: One\n**User:** Hello there.\n"
          "Second line.\n\n**Bot:** Reply one.\n*(aside)*\nMore.\n\n---\n\n"
          "### Conversation 2: Two\n**User:** Q2\n\n**Bot:** A2\n")
    write(os.path.join(tmp_dir, "chats.md"), md)
    df = curated.read_curated_markdown(spark, tmp_dir, assistant_label="Bot").orderBy("block_index")
    rows = df.collect()
    assert [r["title"] for r in rows] == ["Conversation 1: One", "Conversation 2: Two"]
    assert rows[0]["messages"][0]["content"] == "Hello there.\nSecond line."
    assert rows[0]["messages"][1]["content"] == "Reply one.\n*(aside)*\nMore."
    assert [m["role"] for m in rows[1]["messages"]] == ["user", "assistant"]


COLUMNS = ["file_name", "object_index", "value", "errors_before"]

FILES = {
    "a": conv_json("a", "b") + ",\n" + json.dumps(json.loads(conv_json("p {[", "q")), indent=2)
         + "\n" + conv_json("x", "y") + conv_json("z", "w") + "\n",
    "b": "\n\n" + "\n".join(json.dumps(json.loads(conv_json(f"u{i}", "]}")), indent=1) + ","
                               for i in range(60)),
    "c": conv_json("1", "1") + "\njunk [4]",
    "d": '{"messages": [{"role": "user", "con\n' + conv_json("good", "yes"),
    "e": "[" + conv_json("a", "b") + "," + conv_json("c", "d") + "]",
    "f": "",
    "g": '] {"a":\n1}\n' + conv_json("k", "l"),
    "h": "}\n" + "\n".join(conv_json(f"s{i}", "t") for i in range(30)),
    "i": "[\n" + ",\n".join(conv_json(f"s{i}", "t") for i in range(30)),
    "j": "\u00a0" + conv_json("nbsp", "x") + "\u00a0\n\u00a0" + conv_json("nbsp", "y") + "\u00a0\n",
    "k": "[" * 50_000 + conv_json("deep", "x"),
    "l": '{"a": NaN, ' + conv_json("nan", "x")[1:] + "\n-Infinity",
}


def test_every_split_size_and_suffix_gives_the_same_values(spark, tmp_dir):
    """A file is decoded alike as one split or many, whatever its name's suffix."""
    seen = {}
    for suffix, size in (("json", "128m"), ("jsonl", "4096"), ("txt", "600")):
        folder = os.path.join(tmp_dir, f"_landing-{suffix}")  # a hidden parent is no hidden file
        os.makedirs(folder)
        for n, t in FILES.items():
            write(os.path.join(folder, f"{n}.{suffix}"), t)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = raw.read_mixed_json(spark, folder, glob=f"*.{suffix}", recursive=suffix == "json")
            rows = [(r[0].split(".")[0], *r[1:]) for r in map(tuple, got.select(*COLUMNS).collect())]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        seen[suffix, size] = sorted(rows, key=str)
    first = seen["json", "128m"]
    assert all(rows == first for rows in seen.values())
    by = {n: sorted((r for r in first if r[0] == n and r[2] is not None), key=lambda r: r[1]) for n in FILES}
    assert [len(by[n]) for n in "abcefghijl"] == [4, 60, 2, 1, 0, 2, 30, 30, 2, 2]
    assert [r[3] for r in by["c"]] == [0, 4]
    assert [r[3] for r in by["h"]][:2] == [1, 0] and [r[3] for r in by["i"]][:2] == [1, 0]
    assert [r[3] for r in by["j"]] == [0, 2]
    assert json.loads(by["k"][-1][2]) and len(by["k"]) >= 1
    assert json.loads(by["l"][0][2])["a"] is None


def test_value_over_many_splits_is_decided_over_its_own_splits(spark, tmp_dir, monkeypatch):
    """Values over many splits, stray brackets that close far away, late or never, and
    invalid ones: the rows of one split, and no other split's values decoded again."""
    from convforge.sources import concatenated
    small = [conv_json(f"s{i}", "t {[") + ("," if i % 2 else "") for i in range(120)]
    big = json.dumps({"messages": [{"role": "user" if i % 2 == 0 else "assistant", "content": f"m ]}} {i}"}
                                   for i in range(60)]}, indent=1)
    listed = ",\n".join(small[i] for i in range(0, 40, 2))
    files = {
        "one": [*small[:60], "x " + big + " y", *small[60:]],
        "two": [*small[:60], big + big, "@@", *small[60:90], big],
        "never": [*small[:30], "[", listed, big, *small[30:60]],
        "late": [*small[:30], "[[", listed, "@@", *small[30:60], "]", big, "]"],
        "array": ["7", "[" + listed + ",", big + ",", "[" + big + "]]", *small[:20]],
        "broken": ["[", listed, ", [", big, ", {", listed, "}]", big, "]", "\u00a0"],
    }
    for n, parts in files.items():
        write(os.path.join(tmp_dir, f"{n}.json"), "\n".join(parts) + "\n")
    again = {}

    def spy(df, name, through=concatenated.write_through):
        out = through(df, name)
        if "value" in out.columns and name != "json-splits":
            for r in out.where("value is not null").groupBy("file_path").count().collect():
                n = os.path.basename(r["file_path"])
                again[n] = again.get(n, 0) + r["count"]
        return out

    monkeypatch.setattr(concatenated, "write_through", spy)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    seen = {}
    try:
        for size in ("128m", "1500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            again.clear()
            got = raw.read_mixed_json(spark, tmp_dir).select(*COLUMNS).collect()
            seen[size] = sorted(map(tuple, got), key=str)
            if size == "1500":
                assert again["one.json"] < 60, again
            # Files that Python workers cannot open are scanned instead: the same rows.
            spark.conf.set("spark.convforge.rangeSchemes", "none")
            scanned = raw.read_mixed_json(spark, tmp_dir).select(*COLUMNS).collect()
            spark.conf.unset("spark.convforge.rangeSchemes")
            assert sorted(map(tuple, scanned), key=str) == seen[size]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for n, parts in files.items():
        want, _, _ = concatenated.spans(("\n".join(parts) + "\n").strip())
        for size, rows in seen.items():
            values = sorted((r[1:] for r in rows if r[0] == f"{n}.json" and r[2] is not None), key=lambda r: r[0])
            assert values == [(i, s.text, s.skipped) for i, s in enumerate(want)], (n, size)
    assert seen["1500"] == seen["128m"]


def test_q13_bom_first_line_accepted(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "bom.jsonl"), "w", encoding="utf-8-sig") as f:
        f.write(conv_json("first", "a") + "\n" + conv_json("second", "b") + "\n")
    v = prep.ingest(spark, tmp_dir, json_glob=None).orderBy("object_index").collect()
    assert [r["reason"] for r in v] == [None, None]
    assert [r["object_index"] for r in v] == [0, 1]


def test_scan_raw_dir_modes(spark, tmp_dir):
    write(os.path.join(tmp_dir, "a.jsonl"), conv_json("x", "y") + "\n{bad\n")
    write(os.path.join(tmp_dir, "b.json"), conv_json("p", "q") + conv_json("r", "s"))
    auto = raw.scan_raw_dir(spark, tmp_dir)
    assert sorted((r["file_name"], r["object_index"]) for r in auto.collect() if r["object_index"] is not None) \
        == [("a.jsonl", 0), ("b.json", 0), ("b.json", 1)]
    mixed = raw.scan_raw_dir(spark, tmp_dir, reader="mixed")
    assert mixed.where(F.col("file_name") == "a.jsonl").count() == 1


def test_same_file_name_in_two_folders(spark, tmp_dir):
    for sub, words in (("a", ["x0", "x1"]), ("b", ["y0", "y1", "y2"])):
        os.makedirs(os.path.join(tmp_dir, sub))
        write(os.path.join(tmp_dir, sub, "part.jsonl"),
              "\n".join(conv_json(w, "r") for w in words) + "\n")
    v = prep.ingest(spark, tmp_dir, json_glob=None, recursive=True).collect()
    got = sorted((r["file_path"].rsplit("/", 2)[-2], r["object_index"]) for r in v)
    assert got == [("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 2)]
    out = os.path.join(tmp_dir, "out")
    res = prep.prepare_data(spark, tmp_dir, out, val_ratio=0.4, recursive=True, json_glob=None)
    assert (res.train, res.val) == (3, 2) and res.stats["conversations"] == 5


def test_q4_optional_array_explosion(spark, tmp_dir):
    write(os.path.join(tmp_dir, "arr.json"),
          "[" + conv_json("a", "b") + "," + conv_json("c", "d") + ', 5]' + conv_json("e", "f"))
    write(os.path.join(tmp_dir, "l.jsonl"), "[" + conv_json("g", "h") + "]\n[]\n" + conv_json("i", "j") + "\n")
    plain = prep.ingest(spark, tmp_dir)
    assert plain.where(F.col("reason").isNull()).count() == 2  # arrays rejected whole
    ex = prep.ingest(spark, tmp_dir, explode_arrays=True)
    got = sorted((r["file_name"], r["object_index"], r["element_index"], r["reason"]) for r in ex.collect())
    assert got == [("arr.json", 0, 0, None), ("arr.json", 0, 1, None), ("arr.json", 0, 2, "no_messages_key"),
                   ("arr.json", 1, None, None),
                   ("l.jsonl", 0, 0, None), ("l.jsonl", 1, None, "no_messages_key"),
                   ("l.jsonl", 2, None, None)]
    res = prep.prepare_data(spark, tmp_dir, os.path.join(tmp_dir, "out"), val_ratio=0.2,
                            explode_arrays=True)
    assert res.stats["conversations"] == 5 and (res.train, res.val) == (4, 1)


def test_numbering_with_many_uncounted_lines(spark, tmp_dir):
    """Blank and undecodable lines in any amount, small input splits, several files."""
    import random
    rng = random.Random(2)
    want = []
    for f in range(3):
        lines = [rng.choice(["", "  ", "{bad", '{"a":%d}' % i, "[1]"]) if f else '{"a":%d}' % i for i in range(700)]
        with open(os.path.join(tmp_dir, f"f{f}.jsonl"), "w") as h:
            h.write("\n".join(lines) + "\n")
        n = 0
        for k, line in enumerate(lines, 1):
            good = line.startswith("{\"") or line == "[1]"
            if line.strip():
                want.append((f"f{f}.jsonl", k, n if good else None))
            n += good
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        lines = raw.read_jsonl_lines(spark, tmp_dir, keep_blank=True)
        got = raw.number_within_file(lines, counted=F.col("value").rlike(r'^(\{"|\[1\])'), line_col="line_no")
        plan = got._jdf.queryExecution().toString()
        rows = got.where("trim(value) <> ''").select("file_name", "line_no", "object_index").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((tuple(r) for r in rows), key=str) == sorted(want, key=str)
    assert "Arrow" not in plan and "Python" not in plan


def test_bytes_that_are_no_utf8_read_alike(spark, tmp_dir):
    """One file as lines and as values: a lone byte, a cut character, an overlong form and a
    surrogate become replacement characters; nothing stops."""
    line = b'{"messages":[{"role":"user","content":"%s q"},{"role":"assistant","content":"r"}]}'
    texts = [b"\xff", b"\xe4\xb8", b"a\x80b", b"\xc3\xa9 fine", b"\xf0\x9f\x98", b"plain"]
    for name in ("a.jsonl", "b.json"):
        with open(os.path.join(tmp_dir, name), "wb") as h:
            h.write(b"\n".join(line % t for t in texts) + b"\n")
    from convforge.plans import prepare as prep
    rows = {}
    for r in prep.ingest(spark, tmp_dir).collect():
        assert r["reason"] is None
        rows.setdefault(r["file_name"], []).append((r["object_index"], r["messages"][0]["content"], r["replaced"]))
    a, b = sorted(rows["a.jsonl"]), sorted(rows["b.json"])
    assert a == b and [c for _, c, _ in a] == [t.decode(errors="replace") + " q" for t in texts]
    assert [x for *_, x in a] == [True, True, True, False, True, False]


def test_curated_turns_of_any_number(spark, tmp_dir):
    from convforge.plans import prepare as prep
    blocks = ["# Chats\nsome prose", "### Two\n**User:** a\n\n**Assistant:** b\nmore\n\n**User:** c\n**Assistant:** d",
              "### No reply\n**User:** alone", "### Reply first\n**Assistant:** x\n**User:** y",
              "### Blank\n**User:**   \n**Assistant:** z", "### Two users\n**User:** p\n**User:** q"]
    with open(os.path.join(tmp_dir, "c.md"), "w") as h:
        h.write("\n\n---\n\n".join(blocks) + "\n")
    got = prep.ingest(spark, tmp_dir, curated_glob="*.md").orderBy("object_index").collect()
    assert [r["reason"] for r in got] == [None, "messages_not_list_or_short", None, "blank_content", "missing_user_or_assistant"]
    assert [(m["role"], m["content"]) for m in got[0]["messages"]] == [
        ("user", "a"), ("assistant", "b\nmore"), ("user", "c"), ("assistant", "d")]
    assert [m["role"] for m in got[2]["messages"]] == ["assistant", "user"]


def test_byte_ranges_hold_the_lines_of_the_scan(spark, tmp_dir):
    """Any line terminators, bytes that are no UTF-8, odd names, splits without a line."""
    import random

    from pyspark.sql import Window

    from convforge.sources import concatenated, ranges
    rng = random.Random(5)
    for i, name in enumerate(["a b%20c#d.txt", "\u00e9.txt", "ends.txt", "long.txt"]):
        parts = [b"x" * rng.choice([0, 0, 1, 5, 30, 200 if i == 3 else 3]) + rng.choice([b"", "\u4e8c".encode(), b"\xe4\xb8"])
                 + rng.choice([b"\n", b"\r\n", b"\r", b"\r\r\n"]) for _ in range(150)]
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(b"".join(parts) + (b"" if i == 2 else b"end"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("16", "61"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            src = spark.read.text(tmp_dir).select(
                F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("blk"),
                (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")
                 >= F.col("_metadata.file_size")).alias("last"), F.make_valid_utf8("value").alias("value"))
            needed = concatenated.write_through(src.select("file_path", "blk", "last").distinct().withColumn(
                "end", F.lead("blk").over(Window.partitionBy("file_path").orderBy("blk"))), "needed")
            assert needed.where(~ranges.by_range(spark, F.col("file_path"))).isEmpty()
            got = {tuple(r)[:2]: tuple(r)[2:] for r in ranges.range_texts(needed).collect()}
            spark.conf.set("spark.convforge.rangeSchemes", "none")
            want = {tuple(r)[:2]: tuple(r)[2:] for r in concatenated._whole_texts(src, needed).collect()}
            spark.conf.unset("spark.convforge.rangeSchemes")
            assert len(got) > 50 and got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
