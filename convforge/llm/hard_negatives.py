"""Exact mining of hard negatives over Hilbert-ordered blocks with zone maps.

1. Candidates are sorted along a Hilbert curve through the dimensions of largest
   variance and written as Parquet, one row per block of ``BLOCK`` vectors, with
   the minimum and maximum of each dimension and of the labels beside it (its
   zone map).  A range partition of the curve is a zone.
2. Anchors travel in pages of at most ``PAGE``; each page meets each zone's zone
   maps (two columns of the index).  Interval arithmetic bounds the inner product
   of an anchor with all vectors of a block; a window (least, greatest score)
   needs the blocks whose interval meets it and whose labels can fit.
3. Only blocks that some anchor needs are read.  A zone's blocks are held in its
   task while the pages that need them stream past; every page leaves its first
   rows per anchor and window, and a window function merges the zones' lists.

A window that asks for its first k rows is served twice: first from the block
with the highest bound in each zone, whose k-th score then raises the window's
least score for the second, complete search.  Scores are integers, exact at any
order of the work.  A task holds one zone and one page.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convforge.llm.common import bounded_batches, written
from convforge.llm.vectors import matrix, per_dimension, scaled, usable

BLOCK, PAGE, TOGETHER = 128, 1024, 64
#: Rows that a zone should have, from small tables to large ones.
ZONE_ROWS = (4096, 32768)
CURVE_DIMS, CURVE_BITS = 8, 4
FAR = 1 << 62


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (rows of coordinates below
    2**bits): the coordinates are untwisted from the highest bit down, Gray-coded
    across the dimensions, and their bits dealt in turn."""
    x = [c.astype(np.int64) for c in cells.T]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where(x[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            out = out << 1 | ((c ^ turn) >> bit & 1)
    return out


class Index:
    """The written blocks: ``blocks`` (zone, block, n, rows, ids, labels, x, lo, hi,
    label_lo, label_hi), the number of zones and the dimension."""

    def __init__(self, blocks: DataFrame, zones: int, dims: int, exact: bool):
        self.blocks, self.zones, self.dims = blocks, zones, dims
        self.number = np.float64 if exact else np.int64


def build_index(vectors: DataFrame) -> Index:
    """``vectors`` (id, label, x) -> blocks in Hilbert order."""
    spark = vectors.sparkSession
    vectors = written(vectors, "vectors")
    stats = per_dimension(vectors, "x", F.count("*").alias("n"), F.avg("c").alias("mean"),
                          F.stddev_pop("c").alias("sd"), F.max(F.abs("c")).alias("most"))
    dims = max((r["dim"] for r in stats), default=-1) + 1
    count = max((r["n"] for r in stats), default=vectors.count())
    wide = sorted((r for r in stats if r["sd"]), key=lambda r: (-r["sd"], r["dim"]))[:CURVE_DIMS]
    use = [r["dim"] for r in wide]
    mean, sd = np.array([r["mean"] for r in wide]), np.array([r["sd"] for r in wide])

    def place(batches):
        for b in batches:
            x = matrix(b.column(2), dims)
            cells = np.floor((x[:, use] - mean) / sd * (1 << CURVE_BITS - 2)) + (1 << CURVE_BITS - 1)
            at = hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS) if use else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], names=["id", "label", "x", "at"])

    small, large = ZONE_ROWS
    parts = max(1, -(-count // large), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // small)))
    # The row number breaks ties, so that equal vectors may lie in several zones.
    placed = written(bounded_batches(vectors).mapInArrow(place, "id bigint, label bigint, x array<bigint>, at bigint")
                     .withColumn("row", F.monotonically_increasing_id()), "vectors-placed")
    ordered = placed.repartitionByRange(parts, "at", "row").sortWithinPartitions("at", "row")

    def block(batches):
        zone, k, held = TaskContext.get().partitionId(), 0, None
        for b in batches:
            if not b.num_rows:
                continue
            held = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            while held.num_rows >= BLOCK:
                yield one(zone, k, held.slice(0, BLOCK))
                held, k = held.slice(BLOCK), k + 1
        if held is not None and held.num_rows:
            yield one(zone, k, held)

    def one(zone, k, b):
        x = matrix(b.column(2), dims).astype("<i4")
        label = np.asarray(b.column(1)).astype(np.int64)

        def many(c):
            return pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), c)
        return pa.RecordBatch.from_arrays(
            [pa.array([zone], pa.int32()), pa.array([k], pa.int32()), many(b.column(4)), many(b.column(0)),
             many(b.column(1)), pa.array([x.tobytes()], pa.binary()),
             pa.array([x.min(axis=0).tobytes()], pa.binary()), pa.array([x.max(axis=0).tobytes()], pa.binary()),
             pa.array([label.min()], pa.int64()), pa.array([label.max()], pa.int64())],
            names=["zone", "block", "rows", "ids", "labels", "x", "lo", "hi", "label_lo", "label_hi"])

    blocks = written(ordered.mapInArrow(
        block, "zone int, block int, rows array<bigint>, ids array<bigint>, labels array<bigint>, x binary, "
               "lo binary, hi binary, label_lo bigint, label_hi bigint"), "vectors-blocks")
    zones = blocks.agg(F.max("zone")).head()[0]
    most = max((r["most"] for r in stats), default=0)
    return Index(blocks, -1 if zones is None else zones, dims, dims * most * most < 1 << 53)


def _anchors(index: Index, anchors: Column) -> DataFrame:
    """(row, id, label, x) of the rows that ``anchors``, a condition on ``id``, takes."""
    dims = index.dims

    def single(batches):
        for b in batches:
            for rows, ids, labels, x in zip(*[c.to_pylist() for c in b.columns]):
                at = 4 * dims
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(labels, pa.int64()),
                     pa.array([x[i * at:(i + 1) * at] for i in range(len(rows))], pa.binary())],
                    names=["row", "id", "label", "x"])

    return (index.blocks.select("rows", "ids", "labels", "x")
            .mapInArrow(single, "row bigint, id bigint, label bigint, x binary").where(anchors))


_UNION = "zone int, kind int, seq bigint, rows array<bigint>, ids array<bigint>, labels array<bigint>, x binary, lo binary, hi binary"


def _pages(asked: DataFrame) -> DataFrame:
    """``asked`` (row, label, x, lo, hi: arrays, one window each) in pages."""
    def pack(batches):
        part, k, held = TaskContext.get().partitionId(), 0, []

        def page():
            rows, labels, x, lo, hi = zip(*held)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + k], pa.int64()), pa.array([rows], pa.list_(pa.int64())),
                 pa.array([labels], pa.list_(pa.int64())), pa.array([b"".join(x)], pa.binary()),
                 pa.array([np.array(lo, dtype="<i8").tobytes()], pa.binary()),
                 pa.array([np.array(hi, dtype="<i8").tobytes()], pa.binary())],
                names=["seq", "rows", "labels", "x", "lo", "hi"])

        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns]):
                held.append(r)
                if len(held) == PAGE:
                    yield page()
                    held, k = [], k + 1
        if held:
            yield page()

    return asked.select("row", "label", "x", "lo", "hi").mapInArrow(
        pack, "seq bigint, rows array<bigint>, labels array<bigint>, x binary, lo binary, hi binary")


def bounds(anchors: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of every anchor with any vector between lo and hi."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T


def _in_zones(batches, held, page):
    """Rows of a zone's blocks (kind 0) come before the pages (kind 1): ``held`` turns
    the former into what ``page`` gets with every one of the latter."""
    zone, blocks, ready = None, [], None
    for b in batches:
        for r in b.to_pylist():
            if r["zone"] != zone:
                zone, blocks, ready = r["zone"], [], None
            if r["kind"] == 0:
                blocks.append(r)
            elif blocks:
                if ready is None:
                    ready = held(blocks)
                out = page(r, ready)
                if out is not None:
                    yield out


def _choose(index: Index, pages: DataFrame, windows: int, same: bool, best: bool) -> DataFrame:
    """(zone, seq, wanted): which blocks of a zone the anchors of a page read, as a bit
    matrix of anchors and blocks.  ``best``: one block per anchor, window and zone."""
    dims, number = index.dims, index.number

    def maps(blocks):
        def of(k):
            return np.frombuffer(b"".join(b[k] for b in blocks), dtype="<i4").reshape(len(blocks), dims).astype(number)
        # labels hold the least and greatest label here
        return of("lo"), of("hi"), np.array([b["labels"] for b in blocks]), np.array([b["seq"] for b in blocks])

    def page(r, zone):
        lo, hi, label, blocks = zone
        n = len(r["rows"])
        a = np.frombuffer(r["x"], dtype="<i4").reshape(n, dims).astype(number)
        least, most = bounds(a, lo, hi)
        own = np.array(r["labels"])[:, None]
        fits = (label[:, 0] <= own) & (own <= label[:, 1]) if same else (label[:, 0] != own) | (label[:, 1] != own)
        low, high = (np.frombuffer(r[k], dtype="<i8").reshape(n, windows) for k in ("lo", "hi"))
        wanted = np.zeros((n, int(blocks.max()) + 1), dtype=bool)
        for w in range(windows):
            ok = fits & (most >= low[:, w:w + 1]) & (least <= high[:, w:w + 1])
            if best:
                at = np.argmax(np.where(ok, most, -np.inf), axis=1)
                some = ok.any(axis=1)
                wanted[np.flatnonzero(some), blocks[at[some]]] = True
            else:
                wanted[:, blocks] |= ok
        if not wanted.any():
            return None
        used = np.flatnonzero(wanted.any(axis=0))
        return pa.RecordBatch.from_arrays(
            [pa.array([r["zone"]], pa.int32()), pa.array([r["seq"]], pa.int64()),
             pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
             pa.array([np.packbits(wanted[:, used]).tobytes()], pa.binary())], names=["zone", "seq", "blocks", "wanted"])

    zone_maps = index.blocks.select(
        "zone", F.lit(0).alias("kind"), F.col("block").cast("bigint").alias("seq"),
        F.lit(None).cast("array<bigint>").alias("rows"), F.lit(None).cast("array<bigint>").alias("ids"),
        F.array("label_lo", "label_hi").alias("labels"), F.lit(None).cast("binary").alias("x"), "lo", "hi")
    everywhere = pages.select(
        F.explode(F.sequence(F.lit(0), F.lit(index.zones))).alias("zone"), F.lit(1).alias("kind"), "seq", "rows",
        F.lit(None).cast("array<bigint>").alias("ids"), "labels", "x", "lo", "hi")
    return (zone_maps.unionByName(everywhere).repartition("zone").sortWithinPartitions("zone", "kind", "seq")
            .mapInArrow(lambda batches: _in_zones(batches, maps, page),
                        "zone int, seq bigint, blocks array<int>, wanted binary"))


def _first(scores: np.ndarray, ok: np.ndarray, k: int):
    """(anchor, column, score) of the first k columns of each row by score, ties by column."""
    low = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
    s = np.where(ok, scores, low)
    if s.shape[1] > k:
        ok = ok & (s >= np.partition(s, s.shape[1] - k, axis=1)[:, [s.shape[1] - k]])
    a, c = np.nonzero(ok)
    order = np.lexsort((c, -s[a, c], a))
    a, c = a[order], c[order]
    begin = np.searchsorted(a, a)
    keep = np.arange(len(a)) - begin < k
    return a[keep], c[keep], s[a[keep], c[keep]]


def _read(index: Index, pages: DataFrame, chosen: DataFrame, windows: int, same: bool, k: int) -> DataFrame:
    """(anchor, window, score, id, row): the first k rows of each window in each zone."""
    dims, number = index.dims, index.number

    def held(blocks):
        ids = np.array([(1 << 63) - 1 if i is None else i for b in blocks for i in b["ids"]], dtype=np.int64)
        null = np.array([i is None for b in blocks for i in b["ids"]], dtype=bool)
        rows = np.array([i for b in blocks for i in b["rows"]], dtype=np.int64)
        order = np.lexsort((rows, null, ids))
        x = np.frombuffer(b"".join(b["x"] for b in blocks), dtype="<i4").reshape(len(ids), dims)[order].astype(number)
        block = np.repeat([b["seq"] for b in blocks], [len(b["rows"]) for b in blocks])[order]
        label = np.array([i for b in blocks for i in b["labels"]], dtype=np.int64)[order]
        return x, block, label, ids[order], null[order], rows[order]

    def page(r, zone):
        x, block, label, ids, null, rows = zone
        n = len(r["rows"])
        a = np.frombuffer(r["x"], dtype="<i4").reshape(n, dims).astype(number)
        own, mine = np.array(r["labels"]), np.array(r["rows"])
        low, high = (np.frombuffer(r[c], dtype="<i8").reshape(n, windows) for c in ("lo", "hi"))
        used = np.array(r["blocks"])
        wanted = np.unpackbits(np.frombuffer(r["wanted"], dtype=np.uint8), count=n * len(used)).reshape(n, len(used)) > 0
        column = np.searchsorted(used, block).clip(max=len(used) - 1)
        here = used[column] == block
        out = []
        for s in range(0, n, TOGETHER):
            t = slice(s, s + TOGETHER)
            if not wanted[t].any():
                continue
            score = a[t] @ x.T
            ok = wanted[t][:, column] & here & ((label == own[t][:, None]) == same) & (rows != mine[t][:, None])
            for w in range(windows):
                i, c, v = _first(score, ok & (score >= low[t, w:w + 1]) & (score <= high[t, w:w + 1]), k)
                out.append((mine[t][i], np.full(len(i), w), v.astype(np.int64), c))
        if not out:
            return None
        who, w, v, c = (np.concatenate(o) for o in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(who, pa.int64()), pa.array(w, pa.int32()), pa.array(v, pa.int64()),
             pa.array(ids[c], pa.int64(), mask=null[c]), pa.array(rows[c], pa.int64())],
            names=["anchor", "window", "score", "id", "row"])

    needed = chosen.select("zone", F.explode("blocks").alias("block")).distinct()
    empty = F.lit(None).cast("binary")
    blocks = (index.blocks.select("zone", "block", "rows", "ids", "labels", "x").join(needed, ["zone", "block"], "left_semi")
              .select("zone", F.lit(0).alias("kind"), F.col("block").cast("bigint").alias("seq"), "rows", "ids", "labels",
                      "x", empty.alias("lo"), empty.alias("hi"), F.lit(None).cast("array<int>").alias("blocks"),
                      empty.alias("wanted")))
    asking = chosen.join(pages, "seq").select(
        "zone", F.lit(1).alias("kind"), "seq", "rows", F.lit(None).cast("array<bigint>").alias("ids"), "labels", "x",
        "lo", "hi", "blocks", "wanted")
    return (blocks.unionByName(asking).repartition("zone").sortWithinPartitions("zone", "kind", "seq")
            .mapInArrow(lambda batches: _in_zones(batches, held, page),
                        "anchor bigint, window int, score bigint, id bigint, row bigint"))


def first_rows(index: Index, asked: DataFrame, windows: int, same: bool, k: int) -> DataFrame:
    """(anchor, window, rank, score, id) of the first ``k`` rows of each window of the
    anchors in ``asked`` (row, label, x, lo, hi): other rows of the same label, or rows
    of another one, whose score is within the window; higher scores, then smaller ids
    first (no id last)."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")

    def search(asked, best):
        pages = written(_pages(asked), "vectors-pages")
        chosen = written(_choose(index, pages, windows, same, best), "vectors-chosen")
        found = _read(index, pages, chosen, windows, same, k)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    least = (search(asked, True).groupBy("anchor", "window").agg(F.count("*").alias("c"), F.min("score").alias("t"))
             .where(F.col("c") >= k).groupBy("anchor")
             .agg(F.map_from_entries(F.collect_list(F.struct("window", "t"))).alias("t")))  # one entry per window
    raised = (asked.join(least.withColumnRenamed("anchor", "row"), "row", "left")
              .withColumn("lo", F.when(F.col("t").isNull(), F.col("lo")).otherwise(
                  F.transform("lo", lambda v, w: F.greatest(v, F.col("t")[w])))))
    return search(written(raised.select("row", "label", "x", "lo", "hi"), "vectors-asked"), False).drop("row")


def mine_hard_negatives(embeddings: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label",
                        vector_col: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 10,
                        share: tuple[int, int] = (30, 90)) -> DataFrame:
    """Hard negatives of every anchor (``anchors``: a condition on ``id``) and positive.

    Vectors become integers, floor(scale * component); shorter ones end in zeros.  A
    row's score is its inner product with the anchor; higher scores come first, ties
    by smaller id (no id last).  An anchor's positives are the first ``positives``
    other rows of its label; for each, the first ``negatives`` rows of another label
    with share[0] % to share[1] % of its score are returned, ``rank`` from 1.  Rows
    without a label or a vector of finite components take no part.  Repeated rows
    are rows of their own: each is an anchor, and a copy of an anchor can be its
    positive.  No rows, no anchors or one label only give no rows.
    """
    src = embeddings.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
                            F.col(vector_col).alias("v"))
    src = src.where(F.col("label").isNotNull() & usable("v")).select("id", "label", scaled("v", scale).alias("x"))
    index = build_index(src)
    asking = written(_anchors(index, anchors), "vectors-anchors")
    low, high = share
    found = written(first_rows(
        index, asking.withColumns({"lo": F.array(F.lit(-FAR)), "hi": F.array(F.lit(FAR))}), 1, True, positives),
        "vectors-positives")
    # A negative score is no multiple of which another could be between the shares.
    window = found.where("score >= 0").select(
        "anchor", F.struct(F.col("rank").alias("positive"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score"),
                           F.expr(f"({low} * score + 99) div 100").alias("lo"),
                           F.expr(f"{high} * score div 100").alias("hi")).alias("w"))
    windows = window.groupBy("anchor").agg(F.array_sort(F.collect_list("w")).alias("w"))  # at most ``positives``

    def bound(side: str, none: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(positives - 1)),
                           lambda i: F.coalesce(F.get("w", i)[side], F.lit(none)))
    wanted = written(asking.join(windows.withColumnRenamed("anchor", "row"), "row")
                     .withColumns({"lo": bound("lo", FAR), "hi": bound("hi", -FAR)}), "vectors-windows")
    hard = first_rows(index, wanted.select("row", "label", "x", "lo", "hi"), positives, False, negatives)
    return (hard.join(wanted.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), "w"), "anchor")
                .withColumn("p", F.get("w", F.col("window")))
                .select("anchor_id", F.col("p.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        F.col("id").alias("negative_id"), F.col("p.positive_score").alias("positive_score"),
                        F.col("score").alias("negative_score")))
