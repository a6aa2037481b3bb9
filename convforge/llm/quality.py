"""Quality score from two compression dictionaries.

One zstandard dictionary holds snippets of text labelled good, the other of
text labelled bad.  All of a text is compressed with each, in consecutive
pieces of at most ``PIECE`` bytes that each start from the fresh dictionary (in
one long frame the text itself displaces it).  The difference of the two summed
sizes over the text's size in bytes (positive: the good dictionary fits better)
is calibrated by a logistic regression on labelled rows outside the
dictionaries, with a length term because the difference of a short text says
little.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import bounded_batches, held_out, text_buffers

LEVEL = 6
HALF_LENGTH = 200.0
PIECE = 16 << 10


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    weights: tuple[float, float, float]  # difference, short-text term, intercept


def _features(difference, n_bytes):
    n = np.asarray(n_bytes, dtype=float)
    return np.column_stack([np.asarray(difference) / np.maximum(n, 1.0) * 100.0,
                            1.0 / (1.0 + n / HALF_LENGTH), np.ones(len(n))])


def _probability(x, weights):
    return 1.0 / (1.0 + np.exp(-np.clip(x @ np.asarray(weights), -60, 60)))


def _compressor(data: bytes):
    options = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if len(data) < 8:
        return zstandard.ZstdCompressor(**options)
    d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, **options)


def _pieces(n: int) -> list[tuple[int, int]]:
    """(begin, end) of the fewest pieces of at most PIECE that cover n bytes, of equal size up to one byte."""
    k = -(-n // PIECE)
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


def _differences(docs: DataFrame, good: bytes, bad: bytes, text_col: str, carried: list[str]) -> DataFrame:
    """``carried`` columns plus difference (bytes) and n_bytes of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))
    source = bounded_batches(docs).select(*carried, F.col(text_col).cast("string").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]

    def run(batches):
        first, second = (_compressor(d) for d in shared.value)
        schema = None
        for b in batches:
            off, data = text_buffers(b.column(b.num_columns - 1))
            n = np.diff(off)
            diff = np.zeros(len(n), dtype=np.int64)
            view = memoryview(data)
            for i in np.flatnonzero(n):
                text = view[off[i]:off[i + 1]]
                diff[i] = sum(len(second.compress(text[a:z])) - len(first.compress(text[a:z]))
                              for a, z in _pieces(int(n[i])))
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            schema = schema or pa.schema([*list(b.schema)[:-1], pa.field("_diff", pa.int64()),
                                          pa.field("_bytes", pa.int64())])
            yield pa.RecordBatch.from_arrays([*kept, pa.array(diff), pa.array(n)], schema=schema)

    return source.mapInArrow(run, ", ".join([*fields, "_diff bigint", "_bytes bigint"]))


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _probability(x, w)
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", dictionary_docs: int = 1500, snippet: int = 800,
        calibration_docs: int = 8000) -> QualityModel:
    """Fit on a bounded sample of labelled rows, chosen by a hash of the id.

    Three quarters of the labelled ids (by hash) may enter the dictionaries, the
    others calibrate.  Up to ``dictionary_docs`` snippets of ``snippet`` characters
    per label (about 1 MB) fill each dictionary, both cut to the size of the
    smaller one (else the larger fits any text better); ``calibration_docs`` whole
    texts fit the calibration.  An id with conflicting labels counts as bad; null
    labels and ids without a text are left out.  With one class only, every
    score is that class's rate with add-one smoothing (no rows: 0.5).
    """
    lab = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
                 .where("_id is not null and _y is not null")
                 .groupBy("_id").agg(F.min("_y").alias("_y"))
                 .withColumn("_h", F.xxhash64(F.col("_id").cast("string"), F.lit("quality")))
                 .withColumn("_side", F.pmod("_h", F.lit(4))))
    picked = [r for y in (0, 1) for r in lab.where((F.col("_side") > 0) & (F.col("_y") == y))
              .orderBy("_h", "_id")
              .limit(dictionary_docs).collect()]  # bounded: ids only
    spark = docs.sparkSession
    in_dict = spark.createDataFrame([(r["_id"], r["_y"], r["_h"]) for r in picked],
                                    lab.select("_id", "_y", "_h").schema)
    text = F.coalesce(F.col("_text"), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    begin = F.pmod(F.col("_h"), F.greatest(F.length(text) - snippet, F.lit(0)) + 1).cast("int") + 1
    rows = (source.join(F.broadcast(in_dict), "_id")
                  .select("_id", "_y", "_h", F.substring(text, begin, F.lit(snippet)).alias("_s"))
                  .groupBy("_id").agg(F.max(F.struct("_h", "_y", "_s")).alias("r"))
                  .select("r.*").orderBy("_h").collect())  # bounded: dictionary_docs snippets per label
    good, bad = (b"\n".join(r["_s"].encode() for r in rows if r["_y"] == y) for y in (1, 0))
    size = min(len(good), len(bad))
    good, bad = good[:size], bad[:size]

    rest = lab.where("_side = 0").orderBy("_h", "_id").limit(calibration_docs).select("_id", "_y")
    cal = source.join(F.broadcast(rest), "_id")
    # One row per id, whatever the number of its rows.
    got = (_differences(cal, good, bad, "_text", ["_id", "_y"]).groupBy("_id")
           .agg(F.max(F.struct("_bytes", "_diff", "_y")).alias("r")).select("r.*").collect())
    y = np.array([r["_y"] for r in got], dtype=float)
    if len(set(y.tolist())) < 2:
        rate = (y.sum() + 1.0) / (len(y) + 2.0)
        return QualityModel(good, bad, (0.0, 0.0, float(np.log(rate / (1 - rate)))))
    order = np.lexsort(([r["_bytes"] for r in got], [r["_diff"] for r in got], y))
    x = _features([r["_diff"] for r in got], [r["_bytes"] for r in got])[order]
    return QualityModel(good, bad, tuple(float(v) for v in _fit_logistic(x, y[order])))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text",
          keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.7) -> DataFrame:
    """``keep`` columns plus ``score`` (0 to 1, higher: better) and ``predicted``
    (1 if score >= ``threshold``) of every whole text.

    Null and empty texts have no difference and get the calibrated score of an
    empty text.  Equal texts get equal scores.
    """
    names = [f"_k{i}" for i in range(len(keep))]
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)],
                          F.col(text_col).alias("_text"))
    d = _differences(renamed, model.good, model.bad, "_text", names)
    a, b, c = (F.lit(w) for w in model.weights)
    z = (a * F.col("_diff") / F.greatest(F.col("_bytes"), F.lit(1)) * 100.0
         + b / (1.0 + F.col("_bytes") / HALF_LENGTH) + c)
    return (d.withColumn("score", 1.0 / (1.0 + F.exp(-z)))
             .select(*[F.col(n).alias(k) for n, k in zip(names, keep)], "score",
                     F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted")))


def learnable(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Labelled rows that may be learnt from: crc32(id as text) mod 4 is not 2."""
    return labels.where(~held_out(id_col, 4, 2))
