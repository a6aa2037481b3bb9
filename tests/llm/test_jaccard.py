import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from convforge.llm import jaccard
from convforge.llm.components import components
from convforge.llm.jaccard import ngram_jaccard_join

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, k, num, den):
    """Components by counting the shared n-grams of every pair of rows."""
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k
                    else ({tuple(w)} if w else set()))
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    shared = Counter(p for l in where.values() for p in combinations(l, 2))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[i]), least.get(root(i)) if sets[i] else d)
                   for i, (d, _) in enumerate(rows)), key=str)


def joined(df, **kw):
    got = ngram_jaccard_join(df, **kw).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


@pytest.mark.parametrize("words,similarity", [(3, (90, 100)), (5, (80, 100))])
def test_small_corpus_equals_brute_force(small_docs, words, similarity):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]
    assert joined(small_docs, words=words, similarity=similarity) == brute(rows, words, *similarity)


def test_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert joined(awkward, words=3, similarity=(90, 100)) == brute(rows, 3, 90, 100)
    assert joined(nothing) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_edits_equal_brute_force(spark, seed):
    """Chains and families whose members differ by few words, with a passage that
    many rows share, so that pivots do not link to all and groups must be opened."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    common = [word() for _ in range(30)]
    rows, n = [], 0
    for _ in range(12):
        text = [word() for _ in range(rng.randrange(20, 150))]
        for _ in range(rng.randrange(2, 16)):
            t = list(text)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = word()
            if rng.random() < 0.3:
                text = t  # a chain: the next edits start here
            if rng.random() < 0.3:
                t = t + common
            if rng.random() < 0.2:
                t = common + [word()]
            rows.append((n * 7 % 1009, " ".join(t)))
            n += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k, num, den in ((3, 90, 100), (2, 70, 100)):
        assert joined(df, words=k, similarity=(num, den)) == brute(rows, k, num, den)


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_rows_without_an_id_link_and_bridge(spark):
    """A row with a null id that is near to two others which are not near to each other,
    null-id near copies of each other, and one id with two near texts."""
    w = ["w%d" % i for i in range(100)]
    left, mid, right = w[:], w[3:] + ["x1", "x2", "x3"], w[6:] + ["x1", "x2", "x3", "y1", "y2", "y3"]
    other = ["v%d" % i for i in range(80)]
    rows = [(5, " ".join(left)), (None, " ".join(mid)), (9, " ".join(right)), (None, " ".join(other)),
            (None, " ".join(other[:-1] + ["z"])), (3, " ".join(other[1:])), (3, " ".join(other[2:] + ["q"])),
            (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = joined(df, words=3, similarity=(90, 100))
    assert got == brute(rows, 3, 90, 100)
    assert {c for d, _, c in got if d in (5, 9)} == {5}


def test_a_hot_group_that_no_pivot_unites(spark):
    """Copies with edits of their own: any two differ by more than the original and one."""
    rng = random.Random(4)
    base = ["w%d" % i for i in range(200)]
    rows = []
    for i in range(60):
        t = list(base)
        for k in rng.sample(range(200), rng.choice((2, 3, 5, 6))):
            t[k] = "e%d_%d" % (i, k)
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for k, num, den in ((3, 90, 100), (1, 97, 100), (2, 1, 1)):
        assert joined(df, words=k, similarity=(num, den)) == brute(rows, k, num, den)


def test_pairs_of_groups_do_not_grow_with_the_square_of_a_family(spark, monkeypatch):
    """Edits of one text, some of which coincide and so begin with a token that few
    share, are in its group: four times the family has not 16 times the pairs."""
    kept, real, pairs = {}, jaccard.written, []

    def keep(df, name):
        kept[name] = real(df, name)
        return kept[name]

    monkeypatch.setattr(jaccard, "written", keep)
    for size in (100, 400):
        rng = random.Random(8)
        base = ["w%d" % i for i in range(200)]
        rows = []
        for i in range(size):
            t = list(base)
            for k in rng.sample(range(200), rng.choice((1, 2, 4)) if i else 0):
                t[k] = "e%d" % rng.randrange(4)
            rows.append((i * 37 % 1009, " ".join(t)))
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert joined(df, words=5, similarity=(80, 100)) == brute(rows, 5, 80, 100)
        per_token = kept["join-matrix"].groupBy("token").count().collect()
        pairs.append(sum(r["count"] * (r["count"] - 1) // 2 for r in per_token))
    assert pairs[1] < 6 * max(pairs[0], 100)
