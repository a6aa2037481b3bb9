"""Hard negatives and whitening against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from convforge.llm import hard_negatives, queries, whitening
from convforge.llm.vectors import scaled, usable

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, row bigint, x string"
NAN, INF = float("nan"), float("inf")


def clean(rows):
    """(id, label, integer vector) of the rows that take part."""
    out = []
    for i, v, label in rows:
        if label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        out.append((i, label, [math.floor(256 * float(c)) for c in v]))
    dims = max((len(x) for _, _, x in out), default=0)
    return [(i, label, np.array(x + [0] * (dims - len(x)), dtype=np.int64)) for i, label, x in out]


def brute(rows, every=100):
    """The contract's result by scanning all rows for every anchor."""
    rows, out = clean(rows), []
    for me, (a, la, xa) in enumerate(rows):
        if a is None or a % every:
            continue
        scored = sorted(((-int(x @ xa), i is None, i or 0, n) for n, (i, _, x) in enumerate(rows) if n != me))
        best = [(n, -s) for s, _, _, n in scored if rows[n][1] == la][:5]
        for n, p in best:
            hard = [(m, -s) for s, _, _, m in scored if rows[m][1] != la and 30 * p <= -100 * s <= 90 * p][:10]
            out += [(a, rows[n][0], k, rows[m][0], p, q) for k, (m, q) in enumerate(hard, 1)]
    return sorted(out, key=str)


def mined(df, every=100, **kw):
    got = hard_negatives.mine_hard_negatives(df, F.col("id") % every == 0, **kw).collect()
    return sorted((tuple(r) for r in got), key=str)


def test_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 1)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[range(side)] * dims)).reshape(dims, -1).T
        at = hard_negatives.hilbert(cells, bits)
        assert sorted(at) == list(range(side ** dims))
        assert (np.abs(np.diff(cells[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    x, a = rng.integers(-99, 99, (50, 7)), rng.integers(-99, 99, (9, 7))
    least, most = hard_negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    assert (least <= a @ x.T).all() and (a @ x.T <= most).all()


def test_hard_negative_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    shifted = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows]
    got = sorted((tuple(r) for r in queries.QUERIES["op12_hard_negatives"](spark, SMALL).collect()), key=str)
    assert len(got) > 100 and got == brute(shifted)


@pytest.mark.parametrize("blocks", [(4, (16, 32)), (128, (4096, 32768))])
def test_hard_negatives_of_clusters_ties_and_copies(spark, monkeypatch, blocks):
    """Clusters, integer ties, repeated rows and a vector that a third of the rows have."""
    monkeypatch.setattr(hard_negatives, "BLOCK", blocks[0])
    monkeypatch.setattr(hard_negatives, "ZONE_ROWS", blocks[1])
    monkeypatch.setattr(hard_negatives, "PAGE", 3)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    rows = [(int(i), [float(c) for c in np.round(centres[i % 4] + rng.normal(size=6) * 0.2, 2)], int(rng.integers(3)))
            for i in range(120)]
    rows += [(1000 + i, [0.5, 0.25, 0.0, 1.0, -1.0, 0.5], i % 3) for i in range(60)]
    rows += rows[:10] + [(20, rows[3][1], 1), (40, [0.0] * 6, 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    want = brute([(i, np.float32(v).tolist(), lab) for i, v, lab in rows], 20)
    assert want and mined(df, 20) == want


def test_awkward_vectors(spark):
    rows = [(0, [0.1, 0.2], 1, 0.5, 1, "a"), (100, None, 1, None, None, None), (200, [0.3, None], 1, None, 2, ""),
            (300, [NAN, 0.1], 2, None, None, None), (400, [INF, 0.1], 2, None, None, None), (None, [0.4, 0.1], 2, 1.0, 3, "b"),
            (500, [0.4, 0.1], None, None, None, None), (600, [], 1, None, None, None), (7, [0.9], 2, None, None, None),
            (8, [0.3, 0.3], 1, None, None, None), (8, [0.3, 0.3], 1, None, None, None), (9, [0.2, 0.1], 3, None, None, None),
            (10, [-0.2, -0.1], 3, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = [(i, None if v is None else [c if c is None else float(np.float32(c)) for c in v], lab) for i, v, lab, *_ in rows]
    assert mined(df) == brute(plain)
    none = spark.createDataFrame([], SCHEMA)
    assert mined(none) == [] and whitening.whiten_embeddings(none).count() == 0
    assert mined(df.where("label = 1")) == []
    assert hard_negatives.mine_hard_negatives(df, F.col("id") < 0).count() == 0
    got = whitening.whiten_embeddings(df).collect()
    assert {r["vec_id"] for r in got} == set(
        i for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v))
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {7}
    with pytest.raises(Exception, match="beyond"):
        hard_negatives.mine_hard_negatives(spark.createDataFrame([(0, [3e38], 1)], "vec_id bigint, embedding array<float>, label int"),
                                           F.col("id") == 0).collect()


# --- whitening --------------------------------------------------------------
@pytest.mark.parametrize("kind", ["random", "close", "multiple", "low rank", "diagonal", "scalar", "huge range", "one"])
def test_components_equal_a_library_solver(kind):
    rng = np.random.default_rng(3)
    n = 1 if kind == "one" else 40
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    e = {"random": rng.random(n), "close": 1 + 1e-9 * np.arange(n), "multiple": np.repeat([3.0, 2.0, 2.0, 0.5], 10),
         "low rank": np.r_[5, 4, 3, np.zeros(max(n - 3, 0))][:n], "diagonal": np.arange(n, dtype=float), "scalar": np.full(n, 2.0),
         "huge range": 10.0 ** -np.arange(0, n / 4, 0.25), "one": np.array([7.0])}[kind]
    a = np.diag(e) if kind in ("diagonal", "scalar", "one") else q @ np.diag(e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.components(a)
    size = np.linalg.norm(a)
    assert np.abs(np.sort(values) - np.sort(np.linalg.eigvalsh(a))).max() <= 1e-13 * n * size
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * size
    some, _ = whitening.components(a, 4)
    assert np.allclose(some[:min(4, n)], np.sort(e)[::-1][:4], atol=1e-13 * n * size)


def test_polar_factor_of_an_ill_conditioned_matrix():
    q, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(30, 30)))
    e = np.r_[10.0 ** -np.arange(0, 15), -10.0 ** -np.arange(0, 15)]
    u = whitening.polar(q @ np.diag(e) @ q.T)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-13
    assert np.abs(u[:, :] - q @ np.diag(np.sign(e)) @ q.T).max() < 1e-2  # values of 1e-14 are noise themselves


@pytest.mark.parametrize("copies", [1, 10])
def test_whitening_query_equals_numpy(spark, copies):
    """Repeated rows leave the model as it is."""
    src = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    ids, v = zip(*[(r["vec_id"], r["embedding"]) for r in src.collect()])
    x = np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)
    d = np.unique(x, axis=0)
    n, s = len(d), d.sum(axis=0)
    cov = np.cov(d.T, bias=True)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    want = {i: ((x[k] - s / n) @ u / np.sqrt(e), int(((n * x[k] - s) ** 2).sum())) for k, i in enumerate(ids)}
    rows = (queries.QUERIES["op13_whitening"](spark, SMALL) if copies == 1 else
            whitening.whiten_embeddings(src.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(copies)))))).collect()
    assert len(rows) == 4 * copies * len(x)
    sign = {}
    for r in rows:
        w, far = want[r["vec_id"]]
        c = r["component"] - 1
        sign.setdefault(c, np.sign(w[c] * r["whitened"]))
        assert abs(r["whitened"] - sign[c] * w[c]) < 1e-8 and r["deviation"] == far and r["n"] == n
        assert abs(r["explained"] - e[c] / np.trace(cov)) < 1e-10 and r["identity_error"] < 1e-10


def test_vectors_without_variance(spark):
    df = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(5)], "vec_id bigint, embedding array<float>")
    got = whitening.whiten_embeddings(df).collect()
    assert len(got) == 10 and all(r["whitened"] is None and r["deviation"] == 0 and r["n"] == 1 for r in got)
    flat = spark.createDataFrame([(i, [float(i), 0.25, float(i)]) for i in range(5)], "vec_id bigint, embedding array<float>")
    got = whitening.whiten_embeddings(flat).where("component = 1").collect()
    assert sorted(abs(round(r["whitened"], 9)) for r in got) == sorted(abs(round((i - 2) / 2 ** 0.5, 9)) for i in range(5))


def test_scaled_components(spark):
    row = spark.sql("select array(float('-0.001'), float('0'), float('1')) as v").select(scaled("v", 256).alias("x"), usable("v")).head()
    assert row["x"] == [-1, 0, 256] and row[1]
