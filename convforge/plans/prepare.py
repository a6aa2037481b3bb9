"""Raw files -> validated conversations -> statistics -> split files.

The data-preparation job of the reference (``prepare_data``), as one Spark
plan:

    scan .jsonl (split by lines) + .json (decoded split by split)
      -> strict parse + rule chain (row-local)
      -> number decoded values within each file (counts per input split)
      -> write the validated table once to shared storage (lineage cut)
      -> audit, rejects, statistics, exact split, JSONL split files

Shuffles: the rank of the split and the small aggregates.  Everything else is
row-local.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convforge.functions.text import is_blank
from convforge.operators import split as splitting
from convforge.operators import stats as st
from convforge.operators import validate as va
from convforge.schemas import DEFAULT_SEED, DEFAULT_VAL_RATIO
from convforge.sources import curated as cur
from convforge.sources import processed as pr
from convforge.sources import raw

VALIDATED_COLUMNS = ["file_path", "file_name", "object_index", "element_index", "line_no",
                     "value", "reason", "bad_index", "messages", "errors_before"]


def validate_jsonl_lines(lines: DataFrame, explode_arrays: bool = False) -> DataFrame:
    """Validate JSONL lines (blank ones included), number decodable values
    within each file and give every line its 1-based physical line number,
    then drop the blank lines."""
    if explode_arrays:
        lines = raw.explode_top_level_arrays(lines)
    else:
        lines = lines.withColumn("element_index", F.lit(None).cast("int"))
    v = va.validate_values(lines)
    # Numbered per full path: base names can repeat across folders.
    v = raw.number_within_file(v, file_col="file_path",
                               counted=F.col("reason").isNull() | (F.col("reason") != va.PARSE_ERROR),
                               line_col="line_no")
    return (v.where(~is_blank(F.col("value")))
            .withColumn("errors_before", F.lit(0).cast("bigint")).select(*VALIDATED_COLUMNS))


def ingest(spark: SparkSession, raw_dir: str, reader: str = "auto",
           jsonl_glob: str = "*.jsonl", json_glob: str = "*.json",
           recursive: bool = False, explode_arrays: bool = False,
           curated_glob: str | None = None, assistant_label: str = "Assistant") -> DataFrame:
    """Validated RAW rows of every raw file under ``raw_dir``.

    Columns: file_path, file_name, object_index, line_no (JSONL only, the
    reference's warning line), value, reason, bad_index, messages,
    errors_before, replaced.  ``reason`` is NULL for accepted rows; ``replaced`` tells
    that the value holds U+FFFD, which stands for bytes that are no UTF-8 (Q14).
    ``explode_arrays`` turns each element of a top-level JSON
    array into its own value (``element_index``); by default such an array
    is one rejected value, as in the reference.
    """
    if not raw._path_exists(spark, raw_dir):
        raise FileNotFoundError(f"raw data directory not found: {raw_dir}")
    parts = []
    if reader == "auto":
        if jsonl_glob:
            parts.append(validate_jsonl_lines(
                raw.read_jsonl_lines(spark, raw_dir, jsonl_glob, recursive, keep_blank=True),
                explode_arrays))
        mixed_globs = [json_glob]
    elif reader == "mixed":
        mixed_globs = [jsonl_glob, json_glob]
    else:
        raise ValueError("reader must be 'auto' or 'mixed'")
    for g in [g for g in mixed_globs if g]:
        vals = raw.read_mixed_json(spark, raw_dir, g, recursive).where(F.col("value").isNotNull())
        vals = (raw.explode_top_level_arrays(vals) if explode_arrays
                else vals.withColumn("element_index", F.lit(None).cast("int")))
        parts.append(va.validate_values(vals)
                     .withColumn("line_no", F.lit(None).cast("bigint")).select(*VALIDATED_COLUMNS))
    if curated_glob:
        # Hand-written Markdown chats join the corpus as values of their own.
        blocks = cur.read_curated_markdown(spark, raw_dir, curated_glob, assistant_label=assistant_label)
        by_file = Window.partitionBy("file_path").orderBy("block_index")  # a hand-written file
        v = va.validate_typed(blocks.withColumn("value", F.to_json(F.struct("messages")))
                              .withColumn("object_index", F.row_number().over(by_file).cast("bigint") - 1))
        parts.append(v.withColumn("element_index", F.lit(None).cast("int"))
                     .withColumn("line_no", F.lit(None).cast("bigint"))
                     .withColumn("errors_before", F.lit(0).cast("bigint")).select(*VALIDATED_COLUMNS))
    if not parts:
        raise ValueError("no file pattern given: set jsonl_glob and/or json_glob")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("replaced", F.contains("value", F.lit("\ufffd")))


@dataclass
class PrepareResult:
    stats: dict
    train: int
    val: int
    audit: DataFrame
    rejects: DataFrame


def prepare_data(spark: SparkSession, raw_dir: str, output_dir: str,
                 val_ratio: float = DEFAULT_VAL_RATIO, seed: int = DEFAULT_SEED,
                 reader: str = "auto", work_dir: str | None = None,
                 jsonl_glob: str = "*.jsonl", json_glob: str = "*.json",
                 recursive: bool = False, explode_arrays: bool = False,
                 curated_glob: str | None = None, assistant_label: str = "Assistant") -> PrepareResult:
    """The full preparation job; writes ``train.jsonl`` / ``val.jsonl``
    directories plus ``rejects`` and ``audit`` tables under ``output_dir``.

    The validated table is materialised once (``work_dir``, default
    ``output_dir/_validated``) so the four consumers below read it instead of
    re-parsing the raw files, and a lost executor only recomputes from it.
    """
    work = work_dir or f"{output_dir.rstrip('/')}/_validated"
    (ingest(spark, raw_dir, reader, jsonl_glob, json_glob, recursive,
            explode_arrays=explode_arrays, curated_glob=curated_glob, assistant_label=assistant_label)
     .write.mode("overwrite").parquet(work))
    validated = spark.read.parquet(work)

    # Files are known by their name relative to the folder: unique also below
    # subfolders, and the same split wherever the folder lies.
    file_key = "file_name"
    audit = st.file_audit(validated, by=file_key)
    audit.write.mode("overwrite").parquet(f"{output_dir}/audit")
    rejects = va.rejected(validated, ["file_path", "file_name", "object_index", "element_index",
                                      "line_no"])
    rejects.write.mode("overwrite").parquet(f"{output_dir}/rejects")

    # Split keys must be non-NULL and unique.  Exploded array elements add
    # their position (-1 for values that were not arrays).
    keys = [file_key, "object_index"]
    if explode_arrays:
        validated = validated.withColumn("_element", F.coalesce("element_index", F.lit(-1)))
        keys.append("_element")
    conv = va.accepted(validated, keys)
    if conv.isEmpty():  # P14
        raise ValueError("no valid conversations found")
    stats_row = st.corpus_stats(va.profile_conversations(conv, keys)).first()

    # The split is materialised too: three consumers, one ranking.
    (splitting.assign_split(conv, keys, val_ratio=val_ratio, seed=seed)
     .write.mode("overwrite").parquet(f"{work}_split"))
    labelled = spark.read.parquet(f"{work}_split")
    for name, label in (("train.jsonl", splitting.TRAIN), ("val.jsonl", splitting.VAL)):
        pr.write_jsonl(labelled.where(F.col("split") == label), f"{output_dir}/{name}",
                       order="split_rank")
    sizes = {r["split"]: r["n"] for r in st.split_sizes(labelled).collect()}
    return PrepareResult(stats=stats_row.asDict(), train=sizes.get(splitting.TRAIN, 0),
                         val=sizes.get(splitting.VAL, 0),
                         audit=spark.read.parquet(f"{output_dir}/audit"),
                         rejects=spark.read.parquet(f"{output_dir}/rejects"))


def main(argv=None) -> int:
    """``python -m convforge.plans.prepare --raw_dir data/raw --output_dir data``"""
    import argparse

    from convforge.plans.cli import session

    ap = argparse.ArgumentParser(description="Validate raw conversations, report statistics, "
                                             "write an exact train/validation split")
    ap.add_argument("--raw_dir", default="data/raw")
    ap.add_argument("--output_dir", default="data")
    ap.add_argument("--val_ratio", type=float, default=DEFAULT_VAL_RATIO)
    ap.add_argument("--seed", type=int, default=DEFAULT_SEED)
    ap.add_argument("--reader", choices=["auto", "mixed"], default="auto")
    ap.add_argument("--curated_glob", default=None, help="also read curated Markdown chats, e.g. '*.md'")
    ap.add_argument("--assistant_label", default="Assistant", help="speaker label in curated chats")
    ap.add_argument("--explode_arrays", action="store_true",
                    help="one value per element of a top-level JSON array")
    a = ap.parse_args(argv)
    spark = session("convforge-prepare")
    try:
        res = prepare_data(spark, a.raw_dir, a.output_dir, a.val_ratio, a.seed, a.reader,
                           explode_arrays=a.explode_arrays, curated_glob=a.curated_glob,
                           assistant_label=a.assistant_label)
    except FileNotFoundError as e:
        print(f"Error: {e}")
        return 1
    except ValueError as e:
        print(f"\n{e}")
        return 1
    for r in res.audit.orderBy("file_name").collect():  # one row per file
        print(f"{r['file_name']}: {r['valid_conversations']} of {r['raw_objects']} values kept, "
              f"{r['parse_errors']} undecodable")
    # Rejects by file and reason (at most files x reasons rows); every
    # rejected object with its index and line is in <output_dir>/rejects.
    for r in (st.reject_counts(res.rejects, by=("file_name",))
              .orderBy("file_name", "reason").collect()):
        print(f"  {r['file_name']}: {r['n']} x {r['reason']}")
    stats = spark.createDataFrame([res.stats])
    print("corpus:")
    for r in st.stats_report(stats).orderBy("position").collect():  # eight rows
        print(f"  {r['label']}: {r['display']}")
    print(f"written: {res.train} training, {res.val} validation")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
