"""Properties from the test plan: split invariants under repartitioning,
statistics of a union, validation agreeing across input forms."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st_
from pyspark.sql import functions as F

from convforge.operators import conversations as conv
from convforge.operators import split as splitting
from convforge.operators import stats as st
from convforge.operators import validate as va

SLOW = settings(max_examples=15, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


# Conversations are built with their outcome: a sound one, then one fault put in.
GOOD = st_.sampled_from(["hi", " pad ", "नमस्ते", "a\nb", "　x　"])
EMPTY = st_.sampled_from(["", "   ", "\u3000", "\n\t"])
FAULTS = ["none", "short", "role", "empty", "one_sided"]


@st_.composite
def built(draw):
    """([(role, content)], expected reason) of one conversation."""
    middle = draw(st_.lists(st_.tuples(st_.sampled_from(["system", "user", "assistant"]), GOOD), max_size=3))
    sound = draw(st_.permutations([*middle, ("user", draw(GOOD)), ("assistant", draw(GOOD))]))
    fault = draw(st_.sampled_from(FAULTS))
    at = draw(st_.integers(0, len(sound) - 1))
    if fault == "short":
        return sound[:draw(st_.integers(0, 1))], "messages_not_list_or_short"
    if fault == "role":
        return [*sound[:at], (draw(st_.sampled_from(["tool", "User"])), draw(GOOD)), *sound[at:]], "bad_role"
    if fault == "empty":
        return [*sound[:at], ("user", draw(EMPTY)), *sound[at:]], "blank_content"
    if fault == "one_sided":
        left = draw(st_.sampled_from(["user", "assistant"]))
        return [("system", "s"), *[(left, c) for _, c in sound]], "missing_user_or_assistant"
    return list(sound), None


@SLOW
@given(st_.lists(built(), min_size=1, max_size=8))
def test_three_validators_find_the_built_fault(spark, cases):
    convs = [m for m, _ in cases]
    lines = [json.dumps({"messages": [{"role": r, "content": c} for r, c in m]}) for m in convs]
    raw = spark.createDataFrame(list(enumerate(lines)), "k long, value string")
    from_json = {r["k"]: r["reason"] for r in va.validate_values(raw).collect()}
    rows = [(i, t, r, c) for i, m in enumerate(convs) for t, (r, c) in enumerate(m)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    long = {r["conv_id"]: r["reason"] for r in va.profile_turns(turns).collect()}
    typed = {r["conv_id"]: r["reason"] for r in va.validate_typed(conv.to_nested(turns)).collect()}
    expect = dict(enumerate(reason for _, reason in cases))
    assert from_json == expect
    assert long == typed == {k: v for k, v in expect.items() if convs[k]}


@SLOW
@given(st_.integers(min_value=0, max_value=400), st_.integers(min_value=1, max_value=9),
       st_.sampled_from([0.0, 0.1, 0.15, 0.5, 1.0]))
def test_split_invariants_under_repartitioning(spark, n, parts, ratio):
    df = spark.range(n).withColumnRenamed("id", "k")
    a = splitting.assign_split(df.repartition(parts), "k", val_ratio=ratio, hex_chars=1)
    b = splitting.assign_split(df.coalesce(1), "k", val_ratio=ratio, hex_chars=2)
    ra = {r["k"]: (r["split"], r["split_rank"]) for r in a.collect()}
    rb = {r["k"]: (r["split"], r["split_rank"]) for r in b.collect()}
    assert ra == rb and len(ra) == n
    n_train = sum(1 for s, _ in ra.values() if s == "train")
    assert n_train == int(n * (1 - ratio))
    assert sorted(r for s, r in ra.values() if s == "train") == list(range(1, n_train + 1))


def test_stats_of_union_are_sums(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    p = va.profile_turns(t).where(F.col("reason").isNull())
    a, b = p.where(F.col("conv_id") % 2 == 0), p.where(F.col("conv_id") % 2 == 1)
    whole = st.corpus_stats(p).first().asDict()
    sa, sb = st.corpus_stats(a).first().asDict(), st.corpus_stats(b).first().asDict()
    for k in whole:
        if k == "estimated_tokens":
            assert whole[k] == whole["total_characters"] // 3
            assert whole[k] >= sa[k] + sb[k]
        else:
            assert whole[k] == sa[k] + sb[k]


# A log is built from the conversations it must give back.
SAID = st_.sampled_from(["hi", "ok", "q 2", "नमस्ते", "reset me", "exiting"])
NOISE = st_.lists(st_.sampled_from(["", "  ", "\u3000"]), max_size=2)


@st_.composite
def session(draw):
    """(log lines, {segment: user messages}) of one session."""
    lines, said = [], {}
    for segment in range(draw(st_.integers(0, 4))):
        for text in draw(st_.lists(SAID, max_size=5)):
            lines += [*draw(NOISE), draw(st_.sampled_from(["", " "])) + text]
            said.setdefault(segment, []).append(text)
        lines += [*draw(NOISE), draw(st_.sampled_from(["reset", " RESET "]))]
    if draw(st_.booleans()):
        lines += [draw(st_.sampled_from(["quit", "Exit "])), *draw(st_.lists(SAID, max_size=3))]
    return lines, said


@SLOW
@given(st_.lists(session(), min_size=1, max_size=4))
def test_replay_gives_back_the_logged_conversations(spark, sessions):
    from convforge.operators import replay as rp
    rows = [(sid, i, t) for sid, (lines, _) in enumerate(sessions) for i, t in enumerate(lines)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "session long, line_no long, text string")
    got = sorted((r["session"], r["segment"], r["position"], r["role"], r["content"])
                 for r in rp.replay_sessions(df, system_prompt="SYS", block=3).collect())
    expect = sorted((sid, segment, i, "user" if i else "system", c) for sid, (_, said) in enumerate(sessions)
                    for segment, texts in said.items() for i, c in enumerate(["SYS", *texts]))
    assert got == expect


@SLOW
@given(st_.lists(st_.sampled_from(["good", "blank", "bad", "array"]), min_size=1, max_size=60))
def test_jsonl_numbering_matches_enumerate(spark, tmp_dir, kinds):
    import os
    from convforge.plans import prepare as prep
    text = {"good": json.dumps({"messages": [{"role": "user", "content": "q"},
                                             {"role": "assistant", "content": "a"}]}),
            "blank": "   ", "bad": "{oops", "array": "[1, 2]"}
    d = os.path.join(tmp_dir, f"n{abs(hash(tuple(kinds)))}")
    os.makedirs(d, exist_ok=True)  # an example may be replayed
    with open(os.path.join(d, "f.jsonl"), "w") as f:
        f.write("\n".join(text[k] for k in kinds) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        got = sorted((r["line_no"], r["object_index"]) for r in
                     prep.ingest(spark, d, json_glob=None).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expect, idx = [], 0
    for line_no, k in enumerate(kinds, 1):
        if k == "blank":
            continue
        if k == "bad":
            expect.append((line_no, None))
        else:
            expect.append((line_no, idx))
            idx += 1
    assert sorted(expect, key=str) == sorted(got, key=str)


PIECE = st_.sampled_from([
    "OBJ", "PRETTY", "ARR", ",", "\n", " ", "\n\n", "@@", "}", "]", "{", "[",
    '"open', '"str"', "42", "{\"a\": [1, {\"b\": \"}{\"}]}", "tr", "null",
])


@SLOW
@given(st_.lists(st_.lists(PIECE, max_size=30), min_size=1, max_size=3))
def test_concatenated_reader_is_the_same_at_any_split_size(spark, tmp_dir, files):
    import os
    from convforge.sources import raw
    obj = json.dumps({"messages": [{"role": "user", "content": "q ]"},
                                   {"role": "assistant", "content": "a {"}]})
    render = {"OBJ": obj, "PRETTY": json.dumps(json.loads(obj), indent=2), "ARR": "[" + obj + "]"}
    d = os.path.join(tmp_dir, f"m{abs(hash(tuple(map(tuple, files))))}")
    os.makedirs(d, exist_ok=True)  # an example may be replayed
    for i, pieces in enumerate(files):
        with open(os.path.join(d, f"f{i}.json"), "w") as f:
            f.write("".join(render.get(p, p) for p in pieces))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        cols = ["file_name", "object_index", "value", "errors_before"]
        split = sorted(map(tuple, raw.read_mixed_json(spark, d).select(*cols).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    whole = sorted(map(tuple, raw.read_mixed_json(spark, d).select(*cols).collect()), key=str)
    assert whole == split
