"""Homomorphic multiset fingerprints of paragraphs.

A paragraph (a line with at least one word) hashes to a sparse wide vector: a
few of ``LANES`` lanes, each with a 64-bit value.  A document's vector is the
sum of its paragraphs' vectors modulo 2**64 per lane.  The sum does not depend
on order, a paragraph is inserted by adding its vector and deleted by
subtracting it, and two documents have equal vectors if their paragraph
multisets are equal (and else only by a hash collision).

How much differs is read from a second part of the vector, equally a sum.  A
paragraph falls into one cell of one level, half of the paragraphs into level 0, a
quarter into level 1 and so on; a cell sums 1, h and h**2 for the 64-bit hashes h
of its paragraphs.  In the difference of two documents' cells a single differing
paragraph shows, with the number of its copies, whatever both have in common;
where a level is crowded the sparser ones stand for it, so the length of a text
sets no limit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from convforge.llm.common import batch, bounded_batches, written

LANES = 512
TOUCHED = 4
#: The last level takes all paragraphs beyond it: 256 cells for one in 2**23.
LEVELS, CELLS = 24, 256
#: A level is read if at least this share of its cells is without difference.
CLEAR = 0.25


def paragraphs(text: str | None) -> list[bytes]:
    """Lines with at least one word, whole, separators at both ends removed."""
    return [p for p in (x.strip(b" \t\r\x0b\x0c") for x in (text or "").encode().split(b"\n")) if p]


def paragraph_vectors(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(lane, value) of all paragraphs: TOUCHED entries each."""
    raw = b"".join(hashlib.blake2b(p, digest_size=TOUCHED * 10).digest() for p in parts)
    a = np.frombuffer(raw, dtype=np.uint8).reshape(len(parts) * TOUCHED, 10)
    lane = np.ascontiguousarray(a[:, :2]).view("<u2")[:, 0] % LANES
    return lane.astype(np.int64), np.ascontiguousarray(a[:, 2:]).view("<u8")[:, 0]


def vector(parts: list[bytes]) -> np.ndarray:
    """LANES sums, then the cells' sums of 1, of h and of h**2."""
    out = np.zeros(LANES + 3 * LEVELS * CELLS, dtype=np.uint64)
    if parts:
        lane, value = paragraph_vectors(parts)
        np.add.at(out, lane, value)
        _, place, h, _ = value.reshape(-1, TOUCHED).T
        rest = (place >> np.uint64(8)) | np.uint64(1 << (LEVELS - 1))
        level = np.log2((rest & (~rest + np.uint64(1))).astype(float)).astype(np.int64)
        cell = LANES + level * CELLS + (place % np.uint64(CELLS)).astype(np.int64)
        for i, x in enumerate((np.ones_like(h), h, h * h)):
            np.add.at(out, cell + i * LEVELS * CELLS, x)
    return out


def insert(v: np.ndarray, parts: list[bytes]) -> np.ndarray:
    return v + vector(parts)


def delete(v: np.ndarray, parts: list[bytes]) -> np.ndarray:
    return v - vector(parts)


def digest(v: np.ndarray) -> str:
    """The fingerprint as text: SHA-256 of the vector, lowercase hex."""
    return hashlib.sha256(v[:LANES].astype("<u8").tobytes()).hexdigest()


def encode(v: np.ndarray) -> bytes:
    """The whole vector as bytes: the places that are not 0 (4 bytes each), then their sums (8 bytes each)."""
    place = np.flatnonzero(v)
    return place.astype("<u4").tobytes() + v[place].astype("<u8").tobytes()


def decode(data: bytes) -> np.ndarray:
    """The vector that ``encode`` wrote; ``insert``, ``delete``, ``digest`` and ``likeness`` take it."""
    out = np.zeros(LANES + 3 * LEVELS * CELLS, dtype=np.uint64)
    n = len(data) // 12
    out[np.frombuffer(data, "<u4", n)] = np.frombuffer(data, "<u8", n, 4 * n)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated paragraphs in common over paragraphs in either (multisets, copies
    counted); 1 for equal vectors.

    The numbers of paragraphs are exact.  The number that differ is summed over
    cells: exact in one with a single differing paragraph, expected in others from
    how many cells have none, in all levels from the first that is not crowded.  Up to a hundred differing
    paragraphs it is nearly exact; beyond, its standard error is a tenth or less,
    more where a few paragraphs' many copies make up the difference.
    """
    if (a == b).all():
        return 1.0
    n_a, n_b = (int(v[LANES:LANES + LEVELS * CELLS].sum()) for v in (a, b))
    count, first, second = (a - b)[LANES:].reshape(3, LEVELS, CELLS)
    empty = (count == 0) & (first == 0) & (second == 0)
    single = (count != 0) & (first * first == count * second)
    clear = empty.mean(axis=1)
    crowded = np.flatnonzero(clear < CLEAR)
    start = int(crowded[-1]) + 1 if len(crowded) else 0
    start = min(start, LEVELS - 1)
    differ = 0.0
    for level in range(start, LEVELS):
        shared = ~empty[level] & ~single[level]
        size = np.abs(count[level].view(np.int64))
        alone = float(size[single[level]].sum())
        if shared.any():
            # Paragraphs expected in a cell of two or more, each of the copies seen alone.
            mean = -np.log(max(clear[level], 1 / CELLS))
            held = mean * (1 - np.exp(-mean)) / max(1 - np.exp(-mean) * (1 + mean), 1e-9)
            held *= alone / max(int(single[level].sum()), 1) if alone else 1.0
            alone += float(np.maximum(size[shared], held).sum())
        differ += alone * 2.0 ** start
    differ = min(max(differ, abs(n_a - n_b)), n_a + n_b)
    return (n_a + n_b - differ) / (n_a + n_b + differ) if n_a + n_b else 1.0


def _fields(text: str, following: str) -> tuple:
    quarter = len(text) // 4
    edited = text[:len(text) - quarter] + following[:quarter]
    own, ed = vector(paragraphs(text)), vector(paragraphs(edited))
    nxt = vector(paragraphs(following))
    return (len(text), hashlib.sha256(edited.encode()).hexdigest(), digest(own), digest(ed),
            likeness(own, ed), likeness(own, nxt))


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_DDL = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """``n_chars`` (code points), ``fingerprint`` and ``vector`` (see ``encode``) of every
    row (null text: empty)."""
    from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType
    cols = [F.col(id_col), *[F.col(c) for c in keep]]
    src = bounded_batches(docs).select(*cols, F.col(text_col).cast("string").alias("_text"))
    out = StructType([*src.schema.fields[:-1], StructField("n_chars", LongType()),
                      StructField("fingerprint", StringType()), StructField("vector", BinaryType())])

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            got = [(digest(v), encode(v)) for v in (vector(paragraphs(t)) for t in texts)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([d for d, _ in got], pa.string()), pa.array([e for _, e in got], pa.binary())],
                names=[*b.schema.names[:-1], "n_chars", "fingerprint", "vector"])

    return src.mapInArrow(run, out)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every whole text, its edited text and the next document.

    The edited text replaces the last floor(n/4) code points by the first as
    many of the next row's text in ascending id (null id first, rows of equal id
    by text; after the last row: the first).  Rows are range-partitioned by id,
    text moves once; a task holds two texts at a time.  A partition's last row
    needs the first text of the next partition with rows: those few rows (one
    per partition) are completed by a join on the partition number.  A single
    row follows itself; no rows give no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = (bounded_batches(docs).select(F.col(id_col).cast("bigint").alias("_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
               .repartitionByRange(parts, "_id").sortWithinPartitions("_id", "_text"))
    schema = pa.schema([("_id", pa.int64()), ("_part", pa.int64()), ("_edge", pa.string()),
                        ("_text", pa.string()), *zip(NAMES, _TYPES)])

    def run(batches):
        part = TaskContext.get().partitionId()
        last = None

        def rows_of(rows):
            cols = list(zip(*rows))
            return batch(schema, **{f.name: list(c) for f, c in zip(schema, cols)})

        for b in batches:
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if last is None:
                    out.append((doc, part, "first", text, *[None] * 6))
                else:
                    out.append((last[0], part, None, None, *_fields(last[1], text)))
                last = (doc, text)
            if out:
                yield rows_of(out)
        if last is not None:
            yield rows_of([(last[0], part, "last", last[1], *[None] * 6)])

    done = written(src.mapInArrow(run, f"_id bigint, _part bigint, _edge string, _text string, {_DDL}"),
                   "fingerprints")
    # One narrow row per partition with rows; the last one is followed by the first.
    turn = Window.orderBy("_part")
    whole = turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = (done.where("_edge = 'first'").select("_part")
                 .withColumn("_next", F.coalesce(F.lead("_part").over(turn), F.first("_part").over(whole))))
    firsts = done.where("_edge = 'first'").select(F.col("_part").alias("_next"),
                                                  F.col("_text").alias("_following"))
    edges = (done.where("_edge = 'last'").select("_id", "_part", "_text")
                 .join(after, "_part").join(firsts, "_next").select("_id", "_text", "_following"))

    def finish(batches):
        for b in batches:
            rows = [(i, *_fields(t, f)) for i, t, f in zip(*(b.column(k).to_pylist() for k in range(3)))]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), [pa.int64(), *_TYPES])],
                    names=["_id", *NAMES])

    edge_rows = edges.mapInArrow(finish, f"_id bigint, {_DDL}")
    return (done.where("_edge is null").select("_id", *NAMES).unionByName(edge_rows)
                .withColumnRenamed("_id", id_col))
