"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

From every position of a test item the shortest n-gram that is rare by chance
(product of its words' corpus frequencies at most ``RARE``) is a seed; rarity
does not depend on how often the item itself was copied.  Seeds join documents
to items; around each seed the document's words are aligned with the item's by
a local alignment.  The alignment score over that of an identical copy tells
how much of the item the document holds, edited words and gaps included.

The items are a query set: they are taken in blocks of bounded size, each
block against all documents, whose texts never move.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import bitmap, blocks, bounded_batches, find, gram_hash, word_grams

RARE = 1e-9
SHORTEST, LONGEST = 3, 8
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words in common, edits taken off, that count in an item of any length.
ENOUGH = 20
#: Words of test items that one pass over the documents takes (bounded broadcast).
BLOCK_WORDS = 500_000


def _item_words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for w in blocks(pa.array(texts, pa.string()), punctuation=True):
        out += [w.hash[a:b] for a, b in zip(w.offset[:-1], w.offset[1:])]
    return out


def _frequencies(texts: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Corpus counts of ``vocabulary`` (sorted hashes) and the number of all words."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        table = shared.value
        bits = bitmap(table)
        count, total = np.zeros(len(table), dtype=np.int64), 0
        for b in batches:
            for w in blocks(b.column(0), punctuation=True):
                total += len(w.hash)
                _, where = find(w.hash, table, bits)
                count += np.bincount(where, minlength=len(table))
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(count[seen], total))], names=["word", "n"])

    got = texts.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(len(vocabulary), dtype=np.int64)  # at most one row per word of the block
    total = 0
    for r in got:
        if r["word"] < 0:
            total = r["n"]
        else:
            count[r["word"]] = r["n"]
    return count, total


def _seeds(items: list[np.ndarray], vocabulary: np.ndarray, count: np.ndarray, total: int) -> dict:
    """{n: (sorted distinct hashes, list of (item, position) per hash)}."""
    found: dict[int, dict[int, list]] = {}
    limit = math.log(RARE)
    for k, w in enumerate(items):
        if not len(w):
            continue
        p = np.log(np.maximum(count[np.searchsorted(vocabulary, w)], 0.5) / max(total, 1))
        added = False
        for i in range(len(w)):
            n = SHORTEST
            while n < LONGEST and p[i:i + n].sum() > limit:
                n += 1
            if i + n <= len(w):
                found.setdefault(n, {}).setdefault(int(gram_hash(w[i:i + n])), []).append((k, i))
                added = True
        if not added:  # a short item of common words: its whole sequence
            found.setdefault(len(w), {}).setdefault(int(gram_hash(w)), []).append((k, 0))
    out = {}
    for n, d in found.items():
        keys = np.array(sorted(d), dtype=np.uint64)
        out[n] = (keys, [d[int(x)] for x in keys])
    return out


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment of each row of ``a`` (items) with that of ``b``
    (passages): score and the passage position after its end.  Padding: 0 in
    ``a``, 1 in ``b`` (no word hash is so small).  A row of the matrix is computed
    for all pairs at once; a run of gaps in it is a running maximum."""
    pairs, m = a.shape
    width = b.shape[1]
    ramp = -GAP * np.arange(width, dtype=np.int32)
    h = np.zeros((pairs, width + 1), dtype=np.int32)
    best = np.zeros(pairs, dtype=np.int32)
    end = np.zeros(pairs, dtype=np.int64)
    rows = np.arange(pairs)
    for i in range(m):
        step = np.where(a[:, i:i + 1] == b, MATCH, MISMATCH).astype(np.int32)
        t = np.maximum(np.maximum(h[:, :-1] + step, h[:, 1:] + GAP), 0)
        t = np.maximum.accumulate(t + ramp, axis=1) - ramp
        h[:, 1:] = t
        j = t.argmax(axis=1)
        top = t[rows, j]
        better = top > best
        best[better], end[better] = top[better], j[better] + 1
    return best, end


def _pad(rows: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows))), fill, dtype=np.uint64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _align_windows(items, windows, cells: int = 2_000_000):
    """(score share, start, end) per (item, passage words); similar sizes together."""
    size = np.array([len(w) for _, w in windows])
    order = np.argsort(size, kind="stable")
    out = [None] * len(windows)
    k = 0
    while k < len(order):
        take = [order[k]]
        k += 1
        while k < len(order) and (len(take) + 1) * size[order[k]] <= cells // 8:
            take.append(order[k])
            k += 1
        a, b = [items[windows[i][0]] for i in take], [windows[i][1] for i in take]
        score, end = align(_pad(a, 0), _pad(b, 1))
        # The same from behind gives the start.
        back, tail = align(_pad([x[::-1] for x in a], 0), _pad([x[::-1] for x in b], 1))
        for i, x, y, s, e, f in zip(take, a, b, score, end, tail):
            out[i] = (s / (MATCH * len(x)), max(0, len(y) - int(f)), int(e))
    return out


def _block(docs: DataFrame, items: list[tuple], threshold: float, enough: int) -> DataFrame:
    ids = [i for i, _ in items]
    words = _item_words([t for _, t in items])
    vocabulary = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
    count, total = _frequencies(docs.select("_text"), vocabulary)
    seeds = _seeds(words, vocabulary, count, total)
    shared = docs.sparkSession.sparkContext.broadcast((words, seeds))
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches):
        items, seeds = shared.value
        maps = {n: bitmap(keys) for n, (keys, _) in seeds.items()}
        for b in batches:
            found = []  # row, item, score, start, end
            for w in blocks(b.column(1), punctuation=True):
                hits = []
                for n, (keys, places) in seeds.items():
                    at, where = find(word_grams(w.hash, n), keys, maps[n])
                    if not len(at):
                        continue
                    row = np.searchsorted(w.offset, at, side="right") - 1
                    for p, r, s in zip(at[at + n <= w.offset[row + 1]], row[at + n <= w.offset[row + 1]],
                                       where[at + n <= w.offset[row + 1]]):
                        hits += [(int(r), k, int(p) - i) for k, i in places[s]]
                if not hits:
                    continue
                # Passages around seeds; those that overlap are one.
                windows, place = [], []
                slack = lambda k: 4 + len(items[k]) // 4
                last, held = None, []
                for (r, k, begin), n in sorted(Counter(hits).items()):
                    lo = max(int(w.offset[r]), begin - slack(k))
                    hi = min(int(w.offset[r + 1]), begin + len(items[k]) + slack(k))
                    if last and last[:2] == (r, k) and lo <= last[3]:
                        last = (r, k, last[2], hi)
                        place[-1] = last
                        held[-1] += n
                    else:
                        last = (r, k, lo, hi)
                        place.append(last)
                        held.append(n)
                windows = [(k, w.hash[lo:hi]) for _, k, lo, hi in place]
                best = {}
                for (r, k, lo, _), (share, s, e), n in zip(place, _align_windows(items, windows), held):
                    # Frequent words alone can align far; a part must hold many rare seeds as well.
                    part = share * len(items[k]) >= enough and 2 * n >= enough
                    if (part or share >= threshold) and share > best.get((r, k), (0,))[0]:
                        best[r, k] = (share, lo - int(w.offset[r]) + s, lo - int(w.offset[r]) + e)
                found += [(w.first + r, k, *v) for (r, k), v in best.items()]
            cols = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["_id", "_item", "score", "start_word", "end_word"])

    got = docs.mapInArrow(run, f"_id {kind}, _item bigint, score double, start_word bigint, end_word bigint")
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), "_item bigint, item_id bigint")
    return got.join(F.broadcast(names), "_item").select("_id", "item_id", "score", "start_word", "end_word")


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text",
                       threshold: float = 0.5, enough: int = ENOUGH) -> DataFrame:
    """Documents that hold at least ``threshold`` of a test item, or an alignment with
    it worth ``enough`` words with half as many seeds (a part of a long item).

    Returns the document's id, ``item_id``, ``score`` (0 to 1, of the best passage)
    and the passage's words [start_word, end_word); words are runs of letters,
    digits and non-ASCII characters.  Null, empty or blank texts and items match
    nothing; repeated rows and items are each reported; no rows give no rows.
    """
    src = bounded_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    it = (items.select(F.col(item_col).cast("bigint").alias("k"), F.col(item_text_col).cast("string").alias("t"))
               .where("t is not null"))
    words = it.agg(F.sum(F.size(F.split("t", r"\s+")))).head()[0] or 0
    n = max(1, math.ceil(words / BLOCK_WORDS))
    parts = []
    for k in range(n):
        rows = [(r["k"], r["t"]) for r in it.where(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == k)
                .orderBy("k", "t").collect()]  # one block
        if rows:
            parts.append(_block(src, rows, threshold, enough))
    if not parts:
        return (src.where("false").select("_id").withColumn("item_id", F.lit(0).cast("bigint"))
                .withColumn("score", F.lit(0.0)).withColumn("start_word", F.lit(0).cast("bigint"))
                .withColumn("end_word", F.lit(0).cast("bigint")).withColumnRenamed("_id", id_col))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumnRenamed("_id", id_col)
