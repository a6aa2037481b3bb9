"""Concatenated JSON values in files of any size.

Every input split is decoded where it is scanned, in file order, as if the
reader stood between two values at its first line.  JSON strings cannot span
lines and a split starts at a line, so that guess is right unless a value is
still open at the end of the split before.  Then that value's text (from its
opening to the end of its split) is decoded again together with the next
split's head, the lines up to its last closing bracket without a partner; the
next split's values that began before the true end are dropped.  Values are
written once and never shuffled; only one narrow row per split is joined.

A value that the next split's head does not end is decided over its own splits:
the bracket balances of the file's splits (one narrow row each) tell by which
split it can have ended at all, and its text is joined with twice as many further
splits each round until it ends, proves to be no value or has reached that one.
The splits it runs over whole lose their values; all others keep theirs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convforge.operators.joins import lookup_small
from convforge.schemas import MIXED_JSON_SEPARATORS
from convforge.session import write_through
from convforge.sources.ranges import by_range, range_texts

# Not a number and infinity have no JSON form; as null they meet the same rules.
_DECODER = json.JSONDecoder(parse_constant=lambda _: None)
# The next character at which a JSON value can begin.
_CANDIDATE = re.compile(r'[\[{"0-9tfnNI-]')
_SEPARATOR = re.compile("[" + re.escape(MIXED_JSON_SEPARATORS) + "]+")
_TOKEN = re.compile(r'"(?:[^"\\\n]|\\.)*"|[\[{]|[\]}]')
_RUN = re.compile(r"\[+")


class Span:
    """A decoded value: text[begin:end], and the unusable characters before it."""

    __slots__ = ("begin", "end", "text", "skipped", "total")

    def __init__(self, begin, end, text, skipped, total):
        self.begin, self.end, self.text, self.skipped, self.total = begin, end, text, skipped, total


def _attempt(text: str, at: int):
    """(value, end) | None for no value | 'open' when the text ends inside one | 'deep'."""
    try:
        return _DECODER.scan_once(text, at)
    except StopIteration as e:
        return "open" if e.value is not None and e.value >= len(text) else None
    except json.JSONDecodeError as e:
        return "open" if e.pos >= len(text) else None
    except RecursionError:
        return "deep"


def _encode(value) -> str:
    """Compact JSON; unpaired surrogates, which have no UTF-8 form, stay escaped."""
    s = json.dumps(value, ensure_ascii=False)
    try:
        s.encode()
    except UnicodeEncodeError:
        s = json.dumps(value)
    return s


def _junk(text: str, a: int, b: int) -> int:
    """Characters of text[a:b] that are no separators."""
    return b - a - sum(len(s) for s in _SEPARATOR.findall(text, a, b))


def spans(text: str, final: bool = True, begin: int = 0, until: int | None = None):
    """Decode the values of ``text``; returns (spans, place, total skipped).

    Between values separators are passed and any other character that starts
    no value is skipped and counted.  Without ``final`` decoding stops at the
    first value that the text's end leaves open, and ``place`` is where it
    begins; else ``place`` is where decoding ended.  With ``until``, decoding
    stops at the first position from there on.
    """
    out: list[Span] = []
    place, skipped, total = begin, 0, 0
    stop = len(text) if until is None else until
    while place < stop:
        found = _CANDIDATE.search(text, place)
        at = min(found.start() if found else len(text), stop)
        lost = _junk(text, place, at)
        if at >= stop:
            return out, at, total + lost
        got = _attempt(text, at)
        if got == "open" and not final:
            return out, at, total + lost
        if isinstance(got, tuple):
            skipped, total = skipped + lost, total + lost
            out.append(Span(at, got[1], _encode(got[0]), skipped, total))
            place, skipped = got[1], 0
            continue
        step = 1
        if got == "deep":
            # All brackets of a run that lead as deep fail alike: find the first that does not.
            run = _RUN.match(text, at)
            low, high = 1, (run.end() - at if run else 1)
            while low < high:
                mid = (low + high) // 2
                low, high = (mid + 1, high) if _attempt(text, at + mid) == "deep" else (low, mid)
            step = low
        skipped, total = skipped + lost + step, total + lost + step
        place = at + step
    return out, place, total


def head_of(text: str) -> str:
    """The text up to its last closing bracket that has no opening one in it."""
    depth, end = 0, 0
    for m in _TOKEN.finditer(text):
        c = m.group()
        if c in "[{":
            depth += 1
        elif c in "]}":
            if depth:
                depth -= 1
            else:
                end = m.end()
    return text[:end]


def balance(text: str) -> tuple[int, int]:
    """(lowest, final) number of opening less closing brackets outside strings."""
    depth, lowest = 0, 0
    for m in _TOKEN.finditer(text):
        c = m.group()
        if c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            lowest = min(lowest, depth)
    return lowest, depth


def most_open(tail: str) -> int:
    """The most brackets of an open value's text that can be open at its end, wherever
    in it a value may begin (inside a string, too: strings end with their line)."""
    lowest, depth = balance(tail)
    return depth - lowest + max(x.count("[") + x.count("{") for x in tail.split("\n"))


_SPLIT = ("file_path string, blk bigint, ord bigint, pos bigint, value string, skipped bigint, cum bigint, "
          "open boolean, tail string, head string, n bigint, total bigint, blank bigint, last boolean, "
          "lowest bigint, final bigint, deepest bigint")


def _split_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, str]]:
    """Lines in scan order -> (file_path, blk, last, text) of every input split."""
    def whole(key, lines):
        path, blk, last = key
        text = "\n".join(lines) + ("" if last else "\n")
        # White space at the file's two ends is none of its content.
        text = text.lstrip() if blk == 0 else text
        return path, blk, last, text.rstrip() if last else text

    key, lines = None, []
    for b in batches:
        path, blk, last, value = (b.column(i).to_pylist() for i in range(4))
        for p, s, e, v in zip(path, blk, last, value):
            if (p, s, e) != key:
                if key is not None:
                    yield whole(key, lines)
                key, lines = (p, s, e), []
            lines.append(v)
    if key is not None:
        yield whole(key, lines)


def _decode_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in scan order -> value rows, then one summary row per input split."""
    names = [f.split()[0] for f in _SPLIT.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, _SPLIT.split(", "))])

    for path, blk, last, text in _split_texts(batches):
        got, place, total = spans(text, final=last)
        rows = [(path, blk, i, s.begin, s.text, s.skipped, s.total) + (None,) * 10 for i, s in enumerate(got)]
        is_open = not last and place < len(text)
        blank = 0 if is_open else _junk(text, max(len(text.rstrip()), got[-1].end if got else 0), len(text))
        rows.append((path, blk, None, None, None, None, got[-1].total if got else None, is_open,
                     text[place:] if is_open else None, head_of(text) if blk else None,
                     len(got), total, blank, last, *balance(text), most_open(text[place:]) if is_open else None))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_JOINED = ("file_path string, blk bigint, next_blk bigint, j bigint, value string, skipped bigint, cum bigint, "
           "added bigint, added_total bigint, added_last bigint, cut bigint, dropped bigint, cut_total bigint, "
           "undecided boolean")


def _decode_seams(pdfs):
    """An open value's text with the next split's head -> its values and the cut in
    the next split; undecided when the head does not end it."""
    import pandas as pd
    names = [f.split()[0] for f in _JOINED.split(", ")]
    for pdf in pdfs:
        rows = []
        for path, blk, nxt, tail, head, last in zip(pdf["file_path"], pdf["blk"], pdf["next_blk"],
                                                    pdf["tail"], pdf["head"], pdf["next_last"]):
            text, mark = tail + head, len(tail)
            got, place, total = spans(text, final=bool(last), until=mark)
            if place < mark:  # open beyond the head
                rows.append((path, blk, nxt, *[None] * 10, True))
                continue
            cut = place - mark
            before, _, cut_total = spans(head, until=cut)
            rows += [(path, blk, nxt, j, s.text, s.skipped, s.total, *[None] * 6, None)
                     for j, s in enumerate(got)]
            rows.append((path, blk, nxt, None, None, None, None, len(got), total,
                         got[-1].total if got else None, cut, len(before), cut_total, False))
        frame = pd.DataFrame(rows, columns=names)
        yield frame.astype({n: "Int64" for n, k in (f.split() for f in _JOINED.split(", ")) if k == "bigint"})


def _reach(pdf):
    """One file's splits -> for every undecided one its place in the file's order and
    that of the split by which its values end (its own: they never do)."""
    import numpy as np
    import pandas as pd
    pdf = pdf.sort_values("blk")
    end = pdf["final"].to_numpy(dtype=np.int64).cumsum()
    low = end - pdf["final"].to_numpy(dtype=np.int64) + pdf["lowest"].to_numpy(dtype=np.int64)
    rows, falling = [], []  # falling: splits after i that go lower than all between, the next one last
    for i in range(len(pdf) - 1, -1, -1):
        if pdf["undecided"].iat[i]:
            # The first split down to the target; with none, the one that gets lowest.
            target, a, z = end[i] - int(pdf["deepest"].iat[i]), 0, len(falling)
            while a < z:
                mid = (a + z) // 2
                a, z = (mid + 1, z) if low[falling[mid]] <= target else (a, mid)
            k = falling[a - 1] if a else (falling[0] if falling else i)
            rows.append((pdf["file_path"].iat[i], int(pdf["blk"].iat[i]), i, k if low[k] < end[i] else i))
        while falling and low[falling[-1]] >= low[i]:
            falling.pop()
        falling.append(i)
    return pd.DataFrame(rows, columns=["file_path", "blk", "i", "until"])


def _decode_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file_path, blk, i, until, k, at_blk, text, last), sorted, where k = i has the open
    value's text and the others whole splits -> rows like those of _decode_seams."""
    names = [f.split()[0] for f in _JOINED.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, _JOINED.split(", "))])

    def finish(key, parts):
        path, blk, until = key
        text, mark = "".join(t for _, _, t in parts), len(parts[0][2])
        got, place, total = spans(text, final=parts[-1][0] >= until, until=mark)
        if place < mark:
            rows = [(path, blk, *[None] * 11, True)]
        else:
            # The split that the last value ends in; those between are run over whole.
            at, cut, before, cut_total = None, place - mark, [], 0
            for _, at, t in parts[1:]:
                if cut <= len(t):
                    before, _, cut_total = spans(t, until=cut)
                    break
                cut -= len(t)
            rows = [(path, blk, at, j, s.text, s.skipped, s.total, *[None] * 6, None) for j, s in enumerate(got)]
            rows.append((path, blk, at, None, None, None, None, len(got), total,
                         got[-1].total if got else None, cut, len(before), cut_total, False))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    key, parts = None, []
    for b in batches:
        for path, blk, _, until, k, at, text, last in zip(*(c.to_pylist() for c in b.columns)):
            text = text.rstrip() if last else text  # as in _split_texts
            if key is not None and (path, blk, until) != key:
                yield finish(key, parts)
                parts = []
            key = (path, blk, until)
            parts.append((k, at, text))
    if key is not None:
        yield finish(key, parts)


def _whole_texts(src: DataFrame, needed: DataFrame) -> DataFrame:
    """(file_path, blk, last, text) of the ``needed`` splits: read by their byte ranges
    where Python workers can open the file, else put together from the lines of a scan
    of the files, in scan order and without Python."""
    ranged = by_range(needed.sparkSession, F.col("file_path"))
    texts = range_texts(needed.where(ranged))
    scanned = needed.where(~ranged).select("file_path", "blk")
    if scanned.isEmpty():
        return texts
    lines = src.withColumn("at", F.monotonically_increasing_id())
    return texts.unionByName(
        lookup_small(lines, scanned, ["file_path", "blk"])
        .groupBy("file_path", "blk", "last")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("lines"))
        .select("file_path", "blk", "last",
                F.concat(F.array_join(F.col("lines.value"), "\n"),
                         F.when(F.col("last"), "").otherwise("\n")).alias("text")))


def _decide(src: DataFrame, parts: DataFrame, ends: DataFrame, undecided: DataFrame) -> list[DataFrame]:
    """Rows of _decode_chains for every ``undecided`` split (file_path, blk)."""
    files = write_through(undecided.select("file_path").distinct(), "json-undecided-files")
    splits = write_through(
        lookup_small(ends.select("file_path", "blk", "next_blk", "last", "lowest", "final", "deepest"), files,
                     ["file_path"])
        .join(undecided.withColumn("undecided", F.lit(True)), ["file_path", "blk"], "left")
        .na.fill(False, ["undecided"])
        .withColumn("k", F.row_number().over(Window.partitionBy("file_path").orderBy("blk")) - 1), "json-balances")
    left = write_through(splits.groupBy("file_path").applyInPandas(
        _reach, "file_path string, blk bigint, i bigint, until bigint"), "json-reach")
    done, further = [], 2
    while not left.isEmpty():
        wanted = write_through(
            left.select("*", F.explode(F.sequence("i", F.least("until", F.col("i") + further))).alias("k"))
            .join(splits.select("file_path", "k", F.col("blk").alias("at_blk"), F.col("next_blk").alias("end"), "last"),
                  ["file_path", "k"])
            .select("file_path", "blk", "i", "until", "k", "at_blk", "end", "last"), "json-wanted")
        columns = ["file_path", "blk", "i", "until", "k", "at_blk", "text", "last"]
        tails = (wanted.where("k = i")
                 .join(parts.where("open").select("file_path", "blk", F.col("tail").alias("text")), ["file_path", "blk"])
                 .withColumn("last", F.lit(False)).select(*columns))
        whole = wanted.where("k > i")
        needed = write_through(whole.select("file_path", F.col("at_blk").alias("blk"), "end", "last").distinct(),
                               "json-needed")
        texts = _whole_texts(src, needed).withColumnRenamed("blk", "at_blk").drop("last")
        rows = (tails.unionByName(whole.join(texts, ["file_path", "at_blk"]).select(*columns))
                .repartition("file_path", "blk").sortWithinPartitions("file_path", "blk", "k"))
        got = write_through(rows.mapInArrow(_decode_chains, _JOINED), "json-chains")
        done.append(got.where("not coalesce(undecided, false)"))
        left = write_through(left.join(got.where("undecided").select("file_path", "blk"), ["file_path", "blk"]),
                             "json-left")
        further *= 2
    return done


def read_mixed_json(spark: SparkSession, path: str, glob: str = "*.json",
                    recursive: bool = False) -> DataFrame:
    """(file_path, file_name, object_index, value, errors_before); ``file_name``
    is relative to ``path``.

    Values are numbered from 0 within their file and re-encoded as compact JSON;
    ``errors_before`` counts the characters skipped since the previous value (a
    row with NULL value carries those after a file's last one).
    """
    lines = (spark.read.option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).text(path))
    src = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("blk"),
        (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length")
         >= F.col("_metadata.file_size")).alias("last"),
        F.make_valid_utf8("value").alias("value"))  # Q14: other bytes become U+FFFD
    parts = write_through(src.mapInArrow(_decode_splits, _SPLIT), "json-splits")
    # A split may hold no line start: the next one with lines follows.
    by_file = Window.partitionBy("file_path").orderBy("blk")
    ends = write_through(
        parts.where("n is not null")
        .select("file_path", "blk", "n", "total", "blank", "last", F.col("cum").alias("last_cum"), "lowest", "final",
                "deepest")
        .withColumn("next_blk", F.lead("blk").over(by_file))
        # White space at the end of the file's last lines is none of its content.
        .withColumn("total", F.col("total") - F.when(F.col("next_blk").isNull(), F.col("blank")).otherwise(0)),
        "json-ends")
    heads = parts.where("n is not null").select("file_path", F.col("blk").alias("next_blk"), "head",
                                                F.col("last").alias("next_last"))
    seams = (parts.where("open").select("file_path", "blk", "tail")
             .join(ends.select("file_path", "blk", "next_blk"), ["file_path", "blk"])
             .join(heads, ["file_path", "next_blk"], "left")
             .select("file_path", "blk", "next_blk", "tail", F.coalesce("head", F.lit("")).alias("head"),
                     F.coalesce("next_last", F.lit(True)).alias("next_last")))
    joined = write_through(seams.mapInPandas(_decode_seams, _JOINED), "json-seams")
    undecided = write_through(joined.where("undecided").select("file_path", "blk"), "json-undecided")
    joined = joined.where("not coalesce(undecided, false)")
    if not undecided.isEmpty():
        for rows in _decide(src, parts, ends, undecided):
            joined = joined.unionByName(rows)

    # One narrow row per split: its share of the file's numbers.  In a split that a value
    # from before runs over whole (``over``), nothing counts; what begins inside a value
    # ends by its end, so of several cuts in one split the last is the value's.
    cuts = joined.where("cut is not null")
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    table = (ends.join(cuts.where("next_blk is not null").groupBy("file_path", F.col("next_blk").alias("blk"))
                       .agg(F.max(F.struct("cut", "dropped", "cut_total")).alias("c"))
                       .select("file_path", "blk", "c.*"), ["file_path", "blk"], "left")
             .join(cuts.select("file_path", "blk", F.col("next_blk").alias("ends_in"), "added", "added_total",
                               "added_last"), ["file_path", "blk"], "left")
             .na.fill(0, ["cut", "dropped", "cut_total", "added", "added_total"])
             .withColumn("over", F.coalesce(F.max("ends_in").over(before) > F.col("blk"), F.lit(False)))
             .withColumn("cut", F.when(F.col("over"), F.lit(1 << 62)).otherwise(F.col("cut")))
             .withColumn("dropped", F.when(F.col("over"), F.col("n")).otherwise(F.col("dropped")))
             .withColumn("cut_total", F.when(F.col("over"), F.col("total")).otherwise(F.col("cut_total")))
             .withColumn("added", F.when(F.col("over"), 0).otherwise(F.col("added")))
             .withColumn("added_total", F.when(F.col("over"), 0).otherwise(F.col("added_total")))
             .withColumn("own", F.col("n") - F.col("dropped"))
             .withColumn("own_total", F.col("total") - F.col("cut_total"))
             .withColumn("count", F.col("own") + F.col("added"))
             .withColumn("errors", F.col("own_total") + F.col("added_total"))
             .withColumn("at_last", F.when(F.col("added") > 0, F.col("own_total") + F.col("added_last"))
                         .when(F.col("own") > 0, F.col("last_cum") - F.col("cut_total"))))
    table = (table.withColumn("index0", F.coalesce(F.sum("count").over(before), F.lit(0)))
             .withColumn("errors0", F.coalesce(F.sum("errors").over(before), F.lit(0)))
             .withColumn("at", F.col("errors0") + F.col("at_last"))
             .withColumn("carry", F.col("errors0") - F.coalesce(F.max("at").over(before), F.lit(0))))
    table = write_through(table.select("file_path", "blk", "cut", "dropped", "cut_total", "own", "own_total",
                                       "index0", "errors0", "carry", "errors", "at", "over"), "json-table")

    first = F.col("ord") == F.col("dropped")
    own = (lookup_small(parts.where("ord is not null").select("file_path", "blk", "ord", "pos", "value",
                                                              "skipped", "cum"), table, ["file_path", "blk"])
           .where("pos >= cut")
           .select("file_path", (F.col("index0") + F.col("ord") - F.col("dropped")).alias("object_index"), "value",
                   F.when(first, F.col("cum") - F.col("cut_total") + F.col("carry")).otherwise(F.col("skipped"))
                   .alias("errors_before")))
    # Errors before a split's first added value: since its last own value, or carried.
    since = F.when(F.col("own") > 0, F.col("own_total") - (F.col("last_cum") - F.col("cut_total"))).otherwise(
        F.col("own_total") + F.col("carry"))
    added = (joined.where("j is not null").select("file_path", "blk", "j", "value", "skipped")
             .join(table.where("not over").join(ends.select("file_path", "blk", "last_cum"), ["file_path", "blk"]),
                   ["file_path", "blk"])
             .select("file_path", (F.col("index0") + F.col("own") + F.col("j")).alias("object_index"), "value",
                     (F.col("skipped") + F.when(F.col("j") == 0, since).otherwise(0)).alias("errors_before")))
    rest = (table.groupBy("file_path").agg(F.sum("errors").alias("e"), F.max("at").alias("at"))
            .select("file_path", F.lit(None).cast("bigint").alias("object_index"),
                    F.lit(None).cast("string").alias("value"),
                    (F.col("e") - F.coalesce("at", F.lit(0))).alias("errors_before")).where("errors_before > 0"))
    out = own.unionByName(added).unionByName(rest)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getRawPath().rstrip("/") + "/"
    at = F.locate(root, F.col("file_path"))
    name = (F.when(at > 0, F.substring(F.col("file_path"), at + F.lit(len(root)), F.lit(1 << 30)))
            .otherwise(F.element_at(F.split("file_path", "/"), -1)))
    return out.select("file_path", name.alias("file_name"), "object_index", "value", "errors_before")
