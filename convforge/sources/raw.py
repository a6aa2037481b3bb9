"""Raw conversation files.

Every reader returns RAW rows ``(file_name, object_index, value)``: one JSON
text per row, numbered from 0 within its file in file order, counting only
decodable values (blank lines and undecodable lines are not numbered, as in
the reference).  Undecodable JSONL lines are kept with ``object_index`` NULL
so they can be reported; ``operators.validate.validate_values`` marks them
``parse_error``.

* ``.jsonl`` files are split by Spark's line reader like any large text
  file, so one file is read by many tasks.
* ``.json`` files hold concatenated / pretty-printed values with optional
  commas between them; ``sources.concatenated`` decodes them split by split.
  Spark's own ``multiLine`` JSON would return only the first value of such a
  file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convforge.functions.jsonparse import strict_parse
from convforge.functions.text import is_blank
from convforge.session import write_through
from convforge.sources.concatenated import read_mixed_json

RAW_COLUMNS = ["file_name", "object_index", "value"]


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def relative_name(spark: SparkSession, path: str):
    """The file's name relative to the folder ``path``: unique within it, and the
    same wherever the folder lies.  For a single file or a pattern, its base name."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path).toUri().getRawPath().rstrip("/") + "/"
    at = F.locate(root, F.col("_metadata.file_path"))
    return (F.when(at > 0, F.substring(F.col("_metadata.file_path"), at + F.lit(len(root)), F.lit(1 << 30)))
            .otherwise(F.col("_metadata.file_name")))


def readable(col):
    """Text as read from a file: bytes that are no UTF-8 become U+FFFD (Q14), before
    any function or Python worker meets them."""
    return F.make_valid_utf8(col)


#: Rows that are not counted, and input splits, up to which their table is broadcast.
MAX_GAPS, MAX_SPLITS = 5_000_000, 500_000


def number_within_file(df: DataFrame, file_col: str = "file_path", block_col: str = "_blk",
                       out: str = "object_index", counted=None, line_col: str | None = None) -> DataFrame:
    """0-based position of each row inside its file, in file order.

    ``df`` must still have the rows of the scan in scan order (row-local steps
    only): the rows of an input split (``block_col``) then lie one after the other
    in one task, and differ by their position in Spark's monotone row numbers.  The
    rows are written with those and not shuffled; one narrow row per split is summed
    up within its file and joined back.  With ``counted`` (a boolean column) only
    those rows are numbered and only they advance the count; the others get NULL.
    A split's row lists the few that do not count, in groups of the root of their
    number, so that a row finds those before it in two short steps.  ``line_col``
    adds the 1-based number among all rows.
    """
    flag = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    rows = write_through(df.withColumns({"_is": flag, "_at": F.monotonically_increasing_id()}), "numbered")
    per_split = (rows.groupBy(file_col, block_col)
                 .agg(F.min("_at").alias("_at0"), F.count(F.lit(1)).alias("_n"), F.count_if("_is").alias("_c"),
                      F.array_sort(F.collect_list(F.when(~F.col("_is"), F.col("_at")))).alias("_gaps"))
                 .withColumn("_w", F.greatest(F.ceil(F.sqrt(F.size("_gaps"))).cast("int"), F.lit(1)))
                 .withColumn("_groups", F.expr("transform(sequence(0, greatest(size(_gaps) - 1, 0) div _w), "
                                               "i -> slice(_gaps, cast(i * _w + 1 as int), _w))")))
    before = (Window.partitionBy(file_col).orderBy(block_col)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = write_through(per_split.select(
        file_col, block_col, "_at0", "_w", "_groups", F.size("_gaps").alias("_k"),
        F.transform("_groups", lambda g: F.get(g, F.lit(0))).alias("_firsts"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c0")), "split-offsets")
    size = offsets.agg(F.count(F.lit(1)).alias("splits"), F.sum("_k").alias("gaps")).head()
    if size["splits"] <= MAX_SPLITS and (size["gaps"] or 0) <= MAX_GAPS:
        offsets = F.broadcast(offsets)
    at = F.col("_at") - F.col("_at0")
    res = rows.join(offsets, [file_col, block_col])
    if line_col:
        res = res.withColumn(line_col, F.col("_n0") + at + 1)
    if counted is None:
        index = F.col("_c0") + at
    else:
        full = "size(filter(_firsts, f -> f < _at))"
        gaps = F.expr(f"case when {full} = 0 then 0 else ({full} - 1) * _w "
                      f"+ size(filter(get(_groups, {full} - 1), g -> g < _at)) end")
        index = F.when(F.col("_is"), F.col("_c0") + at - F.when(F.col("_k") == 0, 0).otherwise(gaps))
    return (res.withColumn(out, index.cast("bigint"))
            .drop("_is", "_at", "_at0", "_w", "_groups", "_firsts", "_k", "_n0", "_c0"))


def read_jsonl_lines(spark: SparkSession, path: str, glob: str = "*.jsonl",
                     recursive: bool = False, keep_blank: bool = False) -> DataFrame:
    """Lines of JSONL files with their file-order keys.

    Columns: file_path, file_name (relative to ``path``), _blk (input split start),
    value.  Number them with ``number_within_file`` after validation, counting
    only decodable values.  Blank lines are dropped
    unless ``keep_blank`` (to count physical line numbers first).
    """
    lines = (spark.read.option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower())
             .text(path)
             .select(F.col("_metadata.file_path").alias("file_path"),
                     relative_name(spark, path).alias("file_name"),
                     F.col("_metadata.file_block_start").alias("_blk"),
                     readable("value").alias("value")))
    return lines if keep_blank else lines.where(~is_blank(F.col("value")))


def read_jsonl(spark: SparkSession, path: str, glob: str = "*.jsonl",
               recursive: bool = False) -> DataFrame:
    """S1 as RAW rows: decodable values numbered within their file, lines
    that do not decode kept with NULL ``object_index``."""
    lines = read_jsonl_lines(spark, path, glob, recursive)
    numbered = number_within_file(lines, file_col="file_path",
                                  counted=strict_parse(F.col("value")).isNotNull())
    return numbered.select(*RAW_COLUMNS)


def explode_top_level_arrays(values: DataFrame, value: str = "value") -> DataFrame:
    """Option for Q4: a value that is a JSON array becomes one value per
    element (re-encoded JSON), with ``element_index`` its position; other
    values pass unchanged with ``element_index`` NULL.  An empty array stays
    one (rejected) value.  Off by default: the reference rejects the array
    whole."""
    arr = F.try_variant_get(strict_parse(F.col(value)), "$", "array<variant>")
    usable = F.when(F.size(arr) > 0, arr)
    return (values.select("*", F.posexplode_outer(usable).alias("element_index", "_elem"))
            .withColumn(value, F.coalesce(F.to_json("_elem"), F.col(value)))
            .withColumn("element_index", F.col("element_index").cast("int"))
            .drop("_elem"))


def scan_raw_dir(spark: SparkSession, raw_dir: str, reader: str = "auto") -> DataFrame:
    """S3 as RAW rows (unvalidated): ``.jsonl`` by lines and ``.json`` as
    concatenated values (``reader='auto'``), or both suffixes as concatenated
    values (``reader='mixed'``).  Suffixes are case-sensitive; other files
    are ignored.  ``plans.prepare.ingest`` is the validated form.
    """
    if not _path_exists(spark, raw_dir):
        raise FileNotFoundError(f"raw data directory not found: {raw_dir}")
    if reader == "auto":
        jl = read_jsonl(spark, raw_dir)
    elif reader == "mixed":
        jl = read_mixed_json(spark, raw_dir, glob="*.jsonl").where(F.col("value").isNotNull())
        jl = jl.select(*RAW_COLUMNS)
    else:
        raise ValueError("reader must be 'auto' or 'mixed'")
    js = read_mixed_json(spark, raw_dir).where(F.col("value").isNotNull()).select(*RAW_COLUMNS)
    return jl.unionByName(js)
