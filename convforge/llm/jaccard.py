"""Exact n-gram Jaccard join with a token-group matrix.

A document is the set of its distinct word n-grams (64-bit hashes).  Equal sets
are one class.  Tokens have one global order, rare ones first (frequencies from
a fixed-size counting sketch over the whole corpus, ties by hash), so that
linked sets share a token in a short prefix of each.

1. Classes that share prefix tokens are partitioned into groups of similar sets.
   Every token has a hub, the class with the fewest rarer tokens before it (of a
   family of edits mostly the text that they were made from); a class joins that
   of its tokens' hubs that is the most wanted and that it may be near to.
2. The token-group matrix holds, per token and group, the union of the members'
   prefixes with the range of their sizes and the most tokens that can follow.
   Groups meet groups in it (by token and size band), and the overlap of any two
   members is bounded, as is their difference by the groups' centres and radii in
   parity signatures; only pairs of groups whose bounds allow a link qualify.
3. Each class is compared with its group's pivot, pivots with the pivots of
   qualifying groups.  Then qualifying pairs of groups are opened, but only where
   these links have not already put their members in the same component.  A
   class's size and signature, then parity bitmaps, bound the difference before
   that.
4. Every comparison is verified on the full sets.  Components of the links give
   the result, so no group of copies is expanded into all its pairs.

Hot groups are spread by the joins (AQE splits skewed partitions; aggregates
combine before the shuffle); no group is collected into a task.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import attach_small, blocks, bounded_batches, mix64, written
from convforge.llm.components import components

SKETCH_BITS = 22
SKETCH_BLOCKS = 64
MERGE = 64
_SHIFT = np.uint64(64 - SKETCH_BITS)


def _sketch(texts: DataFrame, words: int) -> np.ndarray:
    """Class (log scale) of every sketch counter; 2**SKETCH_BITS counters at any
    input size.  Partial sketches are merged in rounds of MERGE at a time."""
    size = 1 << SKETCH_BITS
    step = size // SKETCH_BLOCKS

    def count(batches):
        total = np.zeros(size, dtype=np.uint32)  # a task reads no 2**32 words
        for b in batches:
            for w in blocks(b.column(0)):
                s, _ = w.shingles(words)
                np.add.at(total, (s >> _SHIFT).astype(np.int64), np.uint32(1))
        if total.any():
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * SKETCH_BLOCKS, pa.int64()), pa.array(range(SKETCH_BLOCKS), pa.int64()),
                 pa.array([zlib.compress(total[k * step:(k + 1) * step].astype(np.int64).tobytes(), 1)
                           for k in range(SKETCH_BLOCKS)], pa.binary())], names=["part", "block", "counts"])

    def merge(t: pa.Table) -> pa.Table:
        total = np.zeros(step, dtype=np.int64)
        for c in t.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(c), dtype=np.int64)
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int64()),
                         "block": pa.array([t.column("block")[0].as_py()], pa.int64()),
                         "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    ddl = "part bigint, block bigint, counts binary"
    rows = written(texts.mapInArrow(count, ddl), "sketch")
    top = rows.agg(F.max("part")).head()[0]
    while top:
        rows = written(rows.withColumn("part", F.floor(F.col("part") / MERGE).cast("bigint"))
                           .groupBy("block", "part").applyInArrow(merge, ddl), "sketch")
        top //= MERGE
    classes = np.zeros(size, dtype=np.uint16)
    for r in rows.collect():  # SKETCH_BLOCKS rows
        total = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int64)
        classes[r["block"] * step:(r["block"] + 1) * step] = np.minimum(np.floor(8 * np.log2(total + 1.0)), 511)
    return classes


def _distinct(shingles: np.ndarray, off: np.ndarray):
    """(row, sorted distinct hashes) of every row with any."""
    for r in np.flatnonzero(np.diff(off)):
        yield r, np.unique(shingles[off[r]:off[r + 1]])


def _digest(u: np.ndarray) -> tuple[int, int]:
    a = mix64(u).sum(dtype=np.uint64)
    b = mix64(u ^ np.uint64(0xA5A5A5A5DEADBEEF)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _parity(u: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set: a power of two of at least twice its size in bits, 128
    to 4096.  Two bitmaps of one length differ in at most as many bits as the sets
    in elements; folding a bitmap in half gives the one of half the length."""
    m = min(4096, max(128, 1 << (2 * len(u) - 1).bit_length()))
    odd = np.bincount((u & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signature(u: np.ndarray) -> np.ndarray:
    """The 512-bit parity bitmap of a set, as eight integers (any two sets compare)."""
    odd = np.bincount((u & np.uint64(511)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


SIGNATURE = [f"s{k}" for k in range(8)]
CENTRE = [f"p{k}" for k in range(8)]


def _apart(a, b) -> str:
    """SQL: bits in which two signatures differ, at most the elements in which the sets do."""
    return "(" + " + ".join(f"bit_count({x} ^ {y})" for x, y in zip(a, b)) + ")"


def _plausible(n: str, bits: str, size: str, bits2: str, num: int, den: int) -> str:
    """SQL: two parity bitmaps allow the similarity of sets with n and size elements.
    (Sizes further apart than a factor of two have no bitmaps of one length.)"""
    def half(b):
        return f"""zip_with(slice({b}, 1, size({b}) div 2), slice({b}, size({b}) div 2 + 1, size({b}) div 2),
                (x, y) -> x ^ y)"""
    return f"""(greatest(size({bits}), size({bits2})) > 2 * least(size({bits}), size({bits2})) or aggregate(zip_with(
            case when size({bits}) <= size({bits2}) then {bits} else {half(bits)} end,
            case when size({bits2}) <= size({bits}) then {bits2} else {half(bits2)} end,
            (x, y) -> bit_count(x ^ y)), 0, (a, x) -> a + coalesce(x, 0))
        <= {n} + {size} - 2 * ({_ceil(f'{n} + {size}', num, num + den)}))"""


def _sets(docs: DataFrame, words: int, num: int, den: int, classes: np.ndarray) -> DataFrame:
    """(_id, hash, n, d1, d2, s0..s7, bits, tokens): hash of the text, size, digest and parity bitmaps of each set
    and its prefix in token order."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)  # 2**SKETCH_BITS small integers

    def run(batches):
        rank = shared.value
        for b in batches:
            rows = b.num_rows
            n = np.zeros(rows, dtype=np.int64)
            d = np.zeros((rows, 2), dtype=np.int64)
            g = np.zeros((rows, len(SIGNATURE)), dtype=np.int64)
            tokens, bits = [None] * rows, [None] * rows
            for w in blocks(b.column(1)):
                for r, u in _distinct(*w.shingles(words)):
                    i = w.first + r
                    n[i] = m = len(u)
                    d[i] = _digest(u)
                    bits[i], g[i] = _parity(u), _signature(u)
                    p = m - (num * m + den - 1) // den + 1
                    key = (rank[(u >> _SHIFT).astype(np.int64)].astype(np.uint64) << np.uint64(55)) \
                        | (u >> np.uint64(9))
                    first = np.argpartition(key, p - 1)[:p] if p < m else np.arange(m)
                    first = first[np.argsort(key[first], kind="stable")]
                    tokens[i] = u[first].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n), pa.array(np.ascontiguousarray(d[:, 0])),
                 pa.array(np.ascontiguousarray(d[:, 1])),
                 *[pa.array(np.ascontiguousarray(g[:, k])) for k in range(len(SIGNATURE))],
                 *[pa.array(x, pa.list_(pa.int64())) for x in (bits, tokens)]],
                names=["_id", "hash", "n", "d1", "d2", *SIGNATURE, "bits", "tokens"])

    kind = docs.schema["_id"].dataType.simpleString()
    docs = docs.select("_id", "_text", F.xxhash64("_text").alias("hash"))
    return docs.mapInArrow(run, f"_id {kind}, hash bigint, n bigint, d1 bigint, d2 bigint, "
                                + "".join(f"{c} bigint, " for c in SIGNATURE) + "bits array<bigint>, tokens array<bigint>")


def _ceil(expr: str, num: int, den: int) -> str:
    return f"({num} * ({expr}) + {den - 1}) div {den}"


def _verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v) of classes whose full sets reach the similarity.

    The sets of the classes in ``pairs`` are computed from one text each and
    joined to both sides of a pair.
    """
    used = pairs.select(F.explode(F.array("u", "v")).alias("cid")).distinct()
    wanted = written(classes.select("cid", "rep", "hash", "d1", "d2").join(used, "cid"), "join-used")
    # An id may be null or name several texts: the text's hash is part of the key.
    source = attach_small(docs.withColumn("_hash", F.xxhash64("_text")), wanted,
                          F.col("_id").eqNullSafe(F.col("rep")) & (F.col("_hash") == F.col("hash")))
    source = source.select("cid", "d1", "d2", "_text")

    def sets(batches):
        seen = set()  # a repeated row gives its set once per task
        for b in batches:
            cid, d1, d2 = (b.column(k).to_pylist() for k in range(3))
            out = {}
            for w in blocks(b.column(3)):
                for r, u in _distinct(*w.shingles(words)):
                    i = w.first + r
                    if cid[i] not in seen and _digest(u) == (d1[i], d2[i]):
                        seen.add(cid[i])
                        out[cid[i]] = u.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()),
                                              pa.array(list(out.values()), pa.binary())],
                                             names=["cid", "tokens"])

    full = written(source.mapInArrow(sets, "cid bigint, tokens binary"), "join-sets")
    both = (pairs.join(full.toDF("u", "a"), "u").join(full.toDF("v", "b"), "v")
                 .select("u", "v", "a", "b"))

    def linked(batches):
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = (np.frombuffer(t.as_buffer(), dtype=np.uint64) for t in (x, y))
                at = np.searchsorted(y, x)
                same = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if den * same >= num * (len(x) + len(y) - same):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [b.column(k).take(pa.array(keep, pa.int64())) for k in (0, 1)], names=["u", "v"])

    return both.mapInArrow(linked, "u bigint, v bigint").distinct()


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """Components of documents whose n-gram sets reach a Jaccard similarity.

    Words are lower-cased in A-Z.  A text with fewer than ``words`` words has its
    whole sequence as its one n-gram.  Two rows link when den * intersection >=
    num * union, ``similarity`` = (num, den).  Returns the id, ``n_shingles`` and
    ``component_id``, the least id reachable by links.  Null, empty and blank
    texts have no set and are linked with nothing; repeated rows and equal sets
    are linked at any similarity; a null id sorts before any other and is no
    component's name unless all its ids are null.
    """
    num, den = similarity
    g = math.gcd(num, den)
    num, den = num // g, den // g
    src = bounded_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    order = _sketch(src.select("_text"), words)
    sets = written(_sets(src, words, num, den, order), "join-rows")
    classes = written(sets.where("n > 0").groupBy("n", "d1", "d2")
                      .agg(F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("rep"), "hash")).alias("r"),
                           F.first(F.struct("tokens", "bits", *SIGNATURE)).alias("s"))
                      .select("n", "d1", "d2", "r.rep", "r.hash", "s.*")
                      .withColumn("cid", F.monotonically_increasing_id()), "join-classes")

    # Prefix tokens that at least two classes have, one of them in its index prefix.
    # Size and position travel as one number, as these are most of the rows moved.
    posts = classes.select("cid", "n", F.posexplode("tokens").alias("pos", "token"))
    idx = F.expr(f"pos <= n - {_ceil('n', 2 * num, num + den)}")
    common = (posts.select("token", F.when(idx, 1 + (1 << 40)).otherwise(1).cast("bigint").alias("w"))
              .groupBy("token").agg(F.sum("w").alias("w"))
              .where(f"w % {1 << 40} > 1 and w > {1 << 40}").select("token"))
    posts = (posts.select("token", "cid", F.expr("shiftleft(n, 32) + pos").alias("at"))
             .join(common, "token")
             .select("cid", "token", F.shiftright("at", 32).alias("n"),
                     (F.col("at") % (1 << 32)).alias("pos")).withColumn("idx", idx))
    posts = written(posts, "join-posts")

    # Groups of similar classes.  In a family of edits of one text, that text has the
    # family's tokens at the front of its prefix, where edits have tokens of their own.
    # So a token's hub is the class that has it foremost, and a class joins the hub of
    # one of its tokens: of those that may be as similar as the join asks, the one with
    # the most votes (a hub's tokens have a vote of every class that has them).  One
    # without such a hub is a group of its own.  A hub may itself be in another's group.
    maps = written(classes.select("cid", "n", *SIGNATURE, "bits")
                   .join(posts.select("cid").distinct(), "cid", "left_semi"), "join-maps")
    hubs = posts.groupBy("token").agg(F.min(F.struct("pos", "cid")).alias("p"), F.count("*").alias("held"))
    hubs = hubs.select("token", F.col("p.cid").alias("pivot"), "held")
    flat = maps.drop("bits")
    pivots = (flat.join(hubs.groupBy("pivot").agg(F.sum("held").alias("votes")), F.col("cid") == F.col("pivot"))
              .select("pivot", "votes", F.col("n").alias("pivot_n"), *[F.col(c).alias(p) for c, p in zip(SIGNATURE, CENTRE)]))
    differ = f"(n + {{}}) * {den - num} div {num + den}"  # elements that two linked sets may differ in
    near = F.expr(f"""{den} * least(n, pivot_n) >= {num} * greatest(n, pivot_n)
        and {_apart(SIGNATURE, CENTRE)} <= {differ.format('pivot_n')}""")
    asked = (posts.select("token", "cid").join(hubs.select("token", "pivot"), "token").select("cid", "pivot").distinct()
             .join(flat, "cid").join(pivots, "pivot").where(near)
             .select("cid", "n", *SIGNATURE, "votes", "pivot", F.expr(_apart(SIGNATURE, CENTRE)).alias("away")))
    alone = flat.select("cid", "n", *SIGNATURE, F.lit(0).cast("bigint").alias("votes"), F.col("cid").alias("pivot"),
                        F.lit(0).alias("away"))
    member = written(asked.unionByName(alone).groupBy("cid", "n", *SIGNATURE)
                     .agg(F.max(F.struct("votes", "pivot", "away")).alias("p"))
                     .select("cid", "n", *SIGNATURE, F.col("p.pivot").alias("grp"), "p.away"), "join-members")
    # A group's centre and radius: q is at least as far from a member as from the
    # centre less the radius.
    centres = flat.select(F.col("cid").alias("grp"), F.col("n").alias("centre_n"),
                          *[F.col(c).alias(p) for c, p in zip(SIGNATURE, CENTRE)])

    # Token-group matrix: per token and group, what its members' prefixes allow.  Groups
    # meet groups, so that a row of the join stands for all pairs of their members.
    rows = posts.join(member.select("cid", "grp"), "cid")
    about = written(member.groupBy("grp").agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"),
                                              F.max("away").alias("radius"))
                    .join(centres, "grp"), "join-groups")
    matrix = written(rows.groupBy("token", "grp").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.expr("n - pos")).alias("rest"),
        F.min(F.when(F.col("idx"), F.col("n"))).alias("lo1"), F.max(F.when(F.col("idx"), F.col("n"))).alias("hi1"),
        F.max(F.when(F.col("idx"), F.expr("n - pos"))).alias("rest1")), "join-matrix")
    # Linked sets' sizes differ at most by the factor den / num: bands a little wider,
    # each group in those of its members and the one below.  Two groups meet once per
    # token, in the lowest band that both have, and either may hold the larger set.
    width = max(math.log(den / num), 1e-9) * (1 + 1e-9)
    band = f"cast(floor(ln({{}}) / {width!r}) as bigint)"
    facts = ["lo", "hi", "rest", "lo1", "hi1", "rest1", "low_band"]
    side = matrix.withColumn("low_band", F.expr(band.format("lo")) - 1)
    side = side.select("token", F.explode(F.expr(f"sequence(low_band, {band.format('hi')})")).alias("band"), "grp", *facts)

    def allows(x: str, y: str) -> str:
        """A set of x may be linked with one of y that is no larger and has the token early."""
        n0 = f"greatest({x}lo, {y}lo1)"
        s0 = f"greatest({y}lo1, {_ceil(n0, num, den)})"
        return f"""coalesce({y}hi1 >= {_ceil(f'{x}lo', num, den)} and {y}lo1 <= {x}hi
            and least({x}rest, {y}rest1) >= {_ceil(f'{n0} + {s0}', num, num + den)}, false)"""

    met = (side.toDF("token", "band", "x", *[f"x_{c}" for c in facts])
           .join(side.toDF("token", "band", "y", *[f"y_{c}" for c in facts]), ["token", "band"])
           .where(F.expr(f"x < y and band = greatest(x_low_band, y_low_band) "
                         f"and ({allows('x_', 'y_')} or {allows('y_', 'x_')})"))
           .select("x", "y", F.expr(allows("x_", "y_")).alias("xy"), F.expr(allows("y_", "x_")).alias("yx"))
           .groupBy("x", "y").agg(F.max("xy").alias("xy"), F.max("yx").alias("yx")))
    met = met.select(F.explode(F.filter(F.array(
        F.when(F.col("xy"), F.struct(F.col("x").alias("own"), F.col("y").alias("grp"))),
        F.when(F.col("yx"), F.struct(F.col("y").alias("own"), F.col("x").alias("grp")))), lambda m: m.isNotNull())).alias("m")
        ).select("m.own", "m.grp")
    own = about.select(F.col("grp").alias("own"), F.col("most_n").alias("own_n"), F.col("radius").alias("own_r"),
                       *[F.col(c).alias(f"s{k}") for k, c in enumerate(CENTRE)])
    close = F.expr(f"""{_apart(SIGNATURE, CENTRE)} - radius - own_r
        <= (own_n + least(own_n, most_n)) * {den - num} div {num + den}""")
    between = written(met.join(about, "grp").join(own, "own").where(close).select("own", "grp"), "join-between")

    star = member.where("cid <> grp").select(F.greatest("cid", "grp").alias("u"), F.least("cid", "grp").alias("v"))
    ends = about.select("grp", "centre_n")
    pivots_met = (between.join(ends, "grp").join(ends.toDF("own", "n1"), "own")
                  .where(F.expr(f"{den} * least(n1, centre_n) >= {num} * greatest(n1, centre_n)"))
                  .select(F.greatest("own", "grp").alias("u"), F.least("own", "grp").alias("v")))
    tried = written(star.unionByName(pivots_met).distinct(), "join-pairs")
    maps = maps.select("cid", "n", "bits")
    likely = written(tried.join(maps.toDF("u", "n", "bits"), "u").join(maps.toDF("v", "size", "bits2"), "v")
                     .where(_plausible("n", "bits", "size", "bits2", num, den)).select("u", "v"), "join-likely")
    links = written(_verify(src, classes, likely, words, num, den), "join-links")
    roots = components(links)

    # Open the qualifying groups towards members of other components whose size and
    # parity bitmap allow the similarity.  Most of a group of copies is in one
    # component by now: two groups of one component are not opened at all, and a
    # class asks only where members of another component are.
    part = written(member.join(roots.withColumnRenamed("v", "cid"), "cid", "left")
                   .join(maps.select("cid", "bits"), "cid")
                   .select("cid", "n", "grp", *SIGNATURE, "bits", F.coalesce("root", "cid").alias("root")), "join-parts")
    sizes = part.groupBy("grp", "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy("grp").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("roots"))
    main = written(main.select("grp", F.col("m.root").alias("main"), "roots"), "join-main")
    opened = (between.unionByName(main.where("roots > 1").select(F.col("grp").alias("own"), "grp"))
              .join(main, "grp").join(main.toDF("own", "own_main", "own_roots"), "own")
              .where("roots > 1 or own_roots > 1 or main <> own_main")
              .join(about.select("grp", "least_n", "most_n", "radius", *CENTRE), "grp"))
    asking = (part.select("cid", "n", F.col("grp").alias("own"), *SIGNATURE, "root")
              .join(opened, "own")
              .where(F.expr(f"""(roots > 1 or root <> main) and most_n >= {_ceil('n', num, den)} and least_n <= n
                  and {_apart(SIGNATURE, CENTRE)} - radius <= {differ.format('least(most_n, n)')}"""))
              .select("cid", "n", F.expr(_ceil("n", num, den)).alias("least"), "grp", "main", "roots", "root")
              .join(part.select("cid", "bits"), "cid"))
    target = part.select("grp", F.col("root").alias("other"), F.col("cid").alias("m"), F.col("n").alias("size"),
                         F.col("bits").alias("bits2"))
    fits = F.expr("other <> root and size >= least and size <= n and "
                  + _plausible("n", "bits", "size", "bits2", num, den))
    rest = target.join(main.where("roots > 1"), "grp").where("other <> main").drop("main", "roots")
    pairs = (asking.where("root = main").join(rest, "grp").where(fits).select("cid", "m")
             .unionByName(asking.where("root <> main").join(target, "grp").where(fits).select("cid", "m"))
             .select(F.greatest("cid", "m").alias("u"), F.least("cid", "m").alias("v")).distinct()
             .join(tried, ["u", "v"], "left_anti"))
    pairs = written(pairs, "join-pairs")
    if not pairs.isEmpty():
        more = written(_verify(src, classes, pairs, words, num, den), "join-links")
        if not more.isEmpty():
            roots = components(links.unionByName(more))

    named = (classes.select("cid", "n", "d1", "d2", "rep")
             .join(roots.withColumnRenamed("v", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    names = named.groupBy("root").agg(F.min("rep").alias("component"))
    named = named.join(names, "root").select("n", "d1", "d2", "component")
    return (sets.select("_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"], "left")
                .select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.coalesce("component", "_id").alias("component_id")))
