"""Toxicity severity by cumulative-link ordinal regression.

Grades 0..K share one weight vector over sparse word features; ordered
thresholds separate them: P(grade > k) = sigmoid(w.x - theta_k).  The output is
the expected severity, the sum of these probabilities.  Features are the log
counts of words and word prefixes (inflected forms share one) in a bounded
vocabulary: those whose document rates differ most between graded and clean
labelled texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import bitmap, blocks, bounded_batches, find, written

LEAST_DOCS = 3
LEAST_Z = 2.5  # log odds over its standard error; less is noise
PREFIXES = (5, 6, 7, 8)  # bytes


def _features(w) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and word prefix of a block."""
    row = np.repeat(np.arange(len(w)), np.diff(w.offset))
    rows, hashes = [row], [w.hash]
    for n in PREFIXES:
        at, h = w.prefixes(n)
        rows.append(row[at])
        hashes.append(h)
    return np.concatenate(rows), np.concatenate(hashes)


@dataclass
class SeverityModel:
    vocabulary: np.ndarray  # sorted word hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, levels: int, ridge: float = 1e-4,
                steps: int = 600, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the cumulative-link model by Adam on the full batch;
    thresholds are a first one plus positive gaps, so they stay ordered."""
    n, dim = x.shape
    p = np.zeros(dim + levels)
    p[dim] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    rows = np.arange(n)
    for t in range(1, steps + 1):
        w, raw = p[:dim], p[dim:]
        gaps = np.concatenate([[raw[0]], np.exp(raw[1:])])
        theta = np.cumsum(gaps)
        over = _sigmoid((x @ w)[:, None] - theta)            # P(grade > k)
        edge = np.column_stack([np.ones(n), over, np.zeros(n)])
        like = np.maximum(edge[rows, grade] - edge[rows, grade + 1], 1e-12)
        slope = np.column_stack([np.zeros(n), over * (1 - over), np.zeros(n)])
        d_eta = -(slope[rows, grade] - slope[rows, grade + 1]) / like / n
        d_theta = np.zeros(levels + 2)
        np.add.at(d_theta, grade, slope[rows, grade] / like / n)
        np.add.at(d_theta, grade + 1, -slope[rows, grade + 1] / like / n)
        d_theta = d_theta[1:-1]
        back = np.cumsum(d_theta[::-1])[::-1]
        g = np.concatenate([x.T @ d_eta + ridge * w, back * np.concatenate([[1.0], gaps[1:]])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return p[:dim], np.cumsum(np.concatenate([[p[dim]], np.exp(p[dim + 1:])]))


def _word_rows(source: DataFrame) -> DataFrame:
    """(_id, _y, word, n): distinct features of every text with their counts."""
    kind = source.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for w in blocks(b.column(2), punctuation=True):
                row, hashes = _features(w)
                if not len(row):
                    continue
                order = np.lexsort((hashes, row))
                r, h = row[order], hashes[order]
                new = np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))
                at = np.flatnonzero(new)
                i = pa.array(w.first + r[at])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(i), b.column(1).take(i), pa.array(h[at].view(np.int64)),
                     pa.array(np.diff(np.append(at, len(h))))], names=["_id", "_y", "word", "n"])

    return source.mapInArrow(run, f"_id {kind}, _y int, word bigint, n bigint")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", docs_per_label: int = 2000, vocabulary: int = 600,
        levels: int = 2) -> SeverityModel:
    """Fit on at most ``docs_per_label`` labelled texts per label, chosen by a hash
    of the id, whole texts; the vocabulary is bounded by ``vocabulary``.

    A label above 0 is a grade as it stands when labels go beyond 1.  Labels of
    only 0 and 1 are refined: the toxic texts are graded 1 to ``levels`` by
    quantiles of their share of words that mark toxic texts.  Conflicting labels
    of an id: the highest counts; null labels and ids are left out.  Without
    texts of both kinds every severity is 0.
    """
    lab = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
                 .where("_id is not null and _y is not null").groupBy("_id").agg(F.max("_y").alias("_y"))
                 .withColumn("_h", F.xxhash64(F.col("_id").cast("string"), F.lit("toxicity"))))
    picked = [r for c in ("_y = 0", "_y > 0")
              for r in lab.where(c).orderBy("_h", "_id").limit(docs_per_label).collect()]  # ids only
    chosen = docs.sparkSession.createDataFrame([(r["_id"], r["_y"]) for r in picked],
                                               lab.select("_id", "_y").schema)
    source = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
                  .join(F.broadcast(chosen), "_id").select("_id", "_y", "_text"))
    rows = written(_word_rows(source), "toxicity-sample")
    toxic = F.col("_y") > 0
    once = rows.select("_id", "_y", "word").distinct()  # repeated rows of an id count once
    words = (once.groupBy("word").agg(F.sum(F.when(toxic, 1).otherwise(0)).alias("t"),
                                      F.sum(F.when(toxic, 0).otherwise(1)).alias("c"))
                 .where(F.col("t") + F.col("c") >= LEAST_DOCS))
    n_t = max(1, sum(r["_y"] > 0 for r in picked))
    n_c = max(1, sum(r["_y"] == 0 for r in picked))
    # Log odds over its standard error: strong and well-attested words first.
    p, q = (F.col("t") + 0.5) / (n_t + 1.0), (F.col("c") + 0.5) / (n_c + 1.0)
    z = (F.log(p / (1 - p)) - F.log(q / (1 - q))) / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    top = (words.withColumn("z", z).where(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "word").limit(vocabulary)
                .select("word", "z").collect())
    if not top or not any(r["_y"] > 0 for r in picked) or not any(r["_y"] == 0 for r in picked):
        return SeverityModel(np.zeros(0, np.uint64), np.zeros(0), np.full(levels, 60.0))
    vocab = np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64))
    marks = np.zeros(len(vocab))
    for r in top:
        marks[np.searchsorted(vocab, np.int64(r["word"]).view(np.uint64))] = r["z"]
    known = docs.sparkSession.createDataFrame([(r["word"],) for r in top], "word bigint")
    got = (rows.join(F.broadcast(known), "word").groupBy("_id", "_y", "word").agg(F.max("n").alias("n"))
               .orderBy("_id", "word").collect())  # sample documents x vocabulary
    ids = {r["_id"]: i for i, r in enumerate(sorted(picked, key=lambda r: r["_id"]))}
    x = np.zeros((len(ids), len(vocab)))
    for r in got:
        x[ids[r["_id"]], np.searchsorted(vocab, np.int64(r["word"]).view(np.uint64))] = np.log1p(r["n"])
    y = np.zeros(len(ids), dtype=np.int64)
    for r in picked:
        y[ids[r["_id"]]] = r["_y"]
    if y.max() == 1 and levels > 1:
        strength = (x * np.maximum(marks, 0)).sum(axis=1)
        cuts = np.quantile(strength[y > 0], np.arange(1, levels) / levels)
        y[y > 0] = 1 + np.searchsorted(cuts, strength[y > 0], side="left")
    levels = int(max(levels, y.max()))
    return SeverityModel(vocab, *fit_ordinal(x, y, levels))


def severity(docs: DataFrame, model: SeverityModel, text_col: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``severity`` (expected grade), ``p_toxic`` (probability
    of any grade above 0) and ``toxic`` (p_toxic >= 0.5) of every whole text.
    Null and empty texts have no feature and get the score of none."""
    src = bounded_batches(docs).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                      F.col(text_col).cast("string").alias("_text"))
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]],
                     "severity double", "p_toxic double", "toxic boolean"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        size = len(model.vocabulary)
        bits = bitmap(model.vocabulary)
        for b in batches:
            eta = np.zeros(b.num_rows)
            for w in blocks(b.column(b.num_columns - 1), punctuation=True) if size else ():
                row, hashes = _features(w)
                hit, at = find(hashes, model.vocabulary, bits)
                key, n = np.unique(row[hit] * size + at, return_counts=True)
                np.add.at(eta, w.first + key // size, model.weights[key % size] * np.log1p(n))
            over = _sigmoid(eta[:, None] - model.thresholds)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(b.num_columns - 1)], pa.array(over.sum(axis=1)),
                 pa.array(np.ascontiguousarray(over[:, 0])), pa.array(over[:, 0] >= 0.5)],
                names=[*b.schema.names[:-1], "severity", "p_toxic", "toxic"])

    return (src.mapInArrow(run, ddl)
               .withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)}))
