"""Texts of single input splits, read by byte range.

Spark can only read a file as a whole set of splits.  A step that wants a few
splits again reads just their byte ranges: one narrow row per range is spread
over the tasks, and each task seeks to its ranges.  The lines of a range are
those that Hadoop's line reader gives the split: they begin after its first
byte (a file's first line: at it) and no later than the byte behind it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TERMINATOR = re.compile(rb"\r\n|\r|\n")
_MORE = 1 << 16
#: Tasks of one reading at most; more ranges share tasks.
MAX_TASKS = 4096
#: Suffixes of files whose bytes are not their text.
COMPRESSED = r"(?i)\.(bz2|gz|deflate|lz4|snappy|zst|zstd)$"


def schemes(spark: SparkSession) -> list[str]:
    """URI schemes that Python workers open themselves (``spark.convforge.rangeSchemes``);
    name ``hdfs``, ``s3a`` or ``gs`` where the workers' Arrow has access to them."""
    return [s.strip() for s in spark.conf.get("spark.convforge.rangeSchemes", "file").split(",") if s.strip()]


def by_range(spark: SparkSession, file_path: Column) -> Column:
    """Whether a file's ranges can be read: its scheme is named, its bytes are its text."""
    return (F.regexp_extract(file_path, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1).isin(schemes(spark))
            & ~F.regexp_like(file_path, F.lit(COMPRESSED)))


def open_file(uri: str):
    """A seekable file of a URI as Spark's ``_metadata.file_path`` gives it."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(unquote(urlsplit(uri).path))
    system, path = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
    return system.open_input_file(path)


def range_lines(f, begin: int, end: int | None) -> list[bytes]:
    """The lines of the split [begin, end) of an open file (end None: to its end)."""
    f.seek(begin)
    if end is None:
        data, stop = f.read(), None
    else:
        # On to the end of the line that begins at ``end`` or runs over it.
        size = end - begin
        data, at, stop = f.read(size), max(size - 1, 0), None
        while True:
            more = f.read(_MORE)
            data += more
            found = None
            for m in _TERMINATOR.finditer(data, at):
                if m.end() > size:
                    found = m
                    break
            # A carriage return at the end of what is read may be half a terminator.
            if found and (found.end() < len(data) or found.group() != b"\r" or not more):
                stop = found.end()
                break
            if not more:
                break
            at = max(size - 1, len(data) - 1)
    if begin:
        first = _TERMINATOR.search(data)
        start = first.end() if first else len(data)
    else:
        start = 0
    lines = _TERMINATOR.split(data[start:stop])
    return lines[:-1] if not lines[-1] else lines


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, begin, end, last in zip(*(c.to_pylist() for c in b.columns)):
            with open_file(path) as f:
                text = b"\n".join(range_lines(f, begin, end)) + (b"" if last else b"\n")
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([begin], pa.int64()), pa.array([last]), pa.array([text], pa.binary())],
                names=["file_path", "blk", "last", "bytes"])


def range_texts(ranges: DataFrame) -> DataFrame:
    """Written rows (file_path, blk, end, last) -> (file_path, blk, last, text).

    ``end`` is where the next split with lines begins (null: the file's end); the
    lines are joined by line feeds, and one ends the text unless ``last``.  Bytes
    that are no UTF-8 become U+FFFD, as in every reader.
    """
    tasks = max(1, min(ranges.count(), MAX_TASKS))
    got = (ranges.select("file_path", "blk", "end", "last").repartition(tasks, "file_path", "blk")
           .mapInArrow(_read, "file_path string, blk bigint, last boolean, bytes binary"))
    return got.select("file_path", "blk", "last", F.make_valid_utf8(F.col("bytes").cast("string")).alias("text"))
