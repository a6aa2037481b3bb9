"""Rule chain on raw JSON values (FIXTURES C1, C3-C14)."""

import json

from pyspark.sql import functions as F

from conftest import lines_df
from convforge.operators import validate as va


def outcomes(spark, lines):
    v = va.validate_values(lines_df(spark, lines)).orderBy("k")
    return [(r["reason"], r["bad_index"], r["messages"]) for r in v.collect()]


def ok_conv(*pairs):
    return json.dumps({"messages": [{"role": r, "content": c} for r, c in pairs]})


def test_c1_valid_extra_keys_dropped(spark):
    line = json.dumps({"id": 7, "tags": ["x"], "messages": [
        {"role": "system", "content": "s", "x": 1},
        {"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]})
    [(reason, idx, msgs)] = outcomes(spark, [line])
    assert reason is None and idx is None
    assert [m.asDict() for m in msgs] == [{"role": "system", "content": "s"},
                                          {"role": "user", "content": "hi"},
                                          {"role": "assistant", "content": "yo"}]


def test_c3_parse_errors(spark):
    bad = ['{"messages": [', '{"messages":1}x', '{"a":1}{"b":2}', '{"a":1,}', "{'a': 1}"]
    assert [o[0] for o in outcomes(spark, bad)] == ["parse_error"] * len(bad)


def test_c4_no_messages_key(spark):
    vals = ["5", "null", '"messages"', '["messages"]', "{}", '{"msgs": []}']
    assert [o[0] for o in outcomes(spark, vals)] == ["no_messages_key"] * len(vals)


def test_c5_not_list_or_short(spark):
    vals = ['{"messages": {"role": "user"}}', '{"messages": "x"}', '{"messages": null}',
            '{"messages": [{"role": "user", "content": "a"}]}']
    assert [o[0] for o in outcomes(spark, vals)] == ["messages_not_list_or_short"] * 4


def test_c6_to_c10_message_rules(spark):
    u = {"role": "user", "content": "q"}
    a = {"role": "assistant", "content": "r"}
    cases = [
        ({"messages": [u, "str"]}, "message_not_object", 1),
        ({"messages": [{"role": "user"}, a]}, "missing_role_or_content", 0),
        ({"messages": [u, {"content": "x"}]}, "missing_role_or_content", 1),
        ({"messages": [u, {"role": "tool", "content": "x"}]}, "bad_role", 1),
        ({"messages": [{"role": "User", "content": "x"}, a]}, "bad_role", 0),
        ({"messages": [{"role": " user", "content": "x"}, a]}, "bad_role", 0),
        ({"messages": [{"role": None, "content": "x"}, a]}, "bad_role", 0),
        ({"messages": [u, {"role": "assistant", "content": ""}]}, "blank_content", 1),
        ({"messages": [u, {"role": "assistant", "content": "   "}]}, "blank_content", 1),
        ({"messages": [u, {"role": "assistant", "content": " 　\u001c"}]}, "blank_content", 1),
        ({"messages": [u, {"role": "assistant", "content": None}]}, "content_not_string", 1),
        ({"messages": [u, {"role": "assistant", "content": 5}]}, "content_not_string", 1),
    ]
    got = outcomes(spark, [json.dumps(c) for c, _, _ in cases])
    assert [(g[0], g[1]) for g in got] == [(r, i) for _, r, i in cases]


def test_c11_first_failure_wins(spark):
    line = json.dumps({"messages": [{"role": "user", "content": " "},
                                    {"role": "bad", "content": "x"}]})
    assert outcomes(spark, [line])[0][:2] == ("blank_content", 0)


def test_c12_missing_user_or_assistant(spark):
    vals = [ok_conv(("system", "s"), ("user", "u")), ok_conv(("user", "a"), ("user", "b")),
            ok_conv(("assistant", "a"), ("assistant", "b"))]
    assert [o[0] for o in outcomes(spark, vals)] == ["missing_user_or_assistant"] * 3


def test_c13_strip_and_code_points(spark):
    content = " \n नमस्ते 😀 \t"
    [(reason, _, msgs)] = outcomes(spark, [ok_conv(("user", content), ("assistant", "ok"))])
    assert reason is None
    assert msgs[0]["content"] == content.strip() == "नमस्ते 😀"
    n = (va.profile_conversations(
        va.accepted(va.validate_values(lines_df(spark, [ok_conv(("user", content), ("assistant", "ok"))])), ["k"]),
        ["k"]).first()["n_chars"])
    assert n == len(content.strip()) + 2


def test_c14_duplicate_key_last_wins(spark):
    line = '{"messages": [{"role": "user", "content": "a", "content": "b"}, {"role": "assistant", "content": "c"}]}'
    [(reason, _, msgs)] = outcomes(spark, [line])
    assert reason is None and msgs[0]["content"] == "b"


def test_typed_and_long_forms_agree(spark):
    rows = [(1, 0, "user", " a "), (1, 1, "assistant", "b"),
            (2, 0, "system", "s"), (2, 1, "user", "u"),
            (3, 0, "user", "q"), (3, 1, "assistant", " "),
            (4, 0, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from convforge.operators import conversations as conv
    typed = {r["conv_id"]: r["reason"] for r in va.validate_typed(conv.to_nested(turns)).collect()}
    long = {r["conv_id"]: r["reason"] for r in va.profile_turns(turns).collect()}
    assert typed == long == {1: None, 2: "missing_user_or_assistant", 3: "blank_content",
                             4: "messages_not_list_or_short"}


def test_strict_parse_matches_python(spark):
    from convforge.functions.jsonparse import strict_parse
    samples = ['{"a": 1}', ' {"a": [1, 2]} ', '[1,2]', '"x"', '1', 'true', 'null', '{"a":1}x',
               '[1]]', '{}{}', '{"a":1,}', "{'a':1}", '', '  ', '{"a": "\\u00e9"}', '[', '1 2']
    df = lines_df(spark, samples).select("k", strict_parse(F.col("value")).isNotNull().alias("ok"))
    got = [r["ok"] for r in df.orderBy("k").collect()]

    def py_ok(s):
        try:
            json.loads(s.strip())
            return True
        except ValueError:
            return False
    assert got == [py_ok(s) for s in samples]


def test_values_beyond_variant_meet_the_same_rules(spark):
    """Neither size nor NaN in a key that does not matter decides validity."""
    big = "x" * (24 * 1024 * 1024)
    nan = ok_conv(("user", "q"), ("assistant", "a"))[:-1] + ', "score": NaN, "p": [-Infinity, "NaN"]}'
    lines = [ok_conv(("user", big), ("assistant", "y")), ok_conv(("user", big), ("tool", "y")), "{bad", nan,
             '{"messages": NaN}', "NaN", '{"a": "NaN"', ok_conv(("user", big), ("user", "y")),
             '{"messages": [{"role": "user", "content": NaN}, {"role": "assistant", "content": "a"}]}']
    assert [o[0] for o in outcomes(spark, lines)] == [
        None, "bad_role", "parse_error", None, "messages_not_list_or_short", "no_messages_key", "parse_error",
        "missing_user_or_assistant", "content_not_string"]
