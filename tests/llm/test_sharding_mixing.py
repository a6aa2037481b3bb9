import re
import zlib
from collections import defaultdict

from convforge.llm.mixing import mix_sources
from convforge.llm.sharding import shard_by_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_shards(rows, n):
    rows = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8)
                   for i, t in rows))
    total = sum(r[3] for r in rows)
    out, at, slots = [], 0, defaultdict(int)
    for has, i, crc, size in rows:
        s = min(n - 1, (2 * at + size) * n // (2 * total))
        out.append((i if has else None, size, crc, s, slots[s]))
        slots[s] += 1
        at += size
    return out


def shards(df, n):
    got = shard_by_bytes(df, n).collect()
    assert all(r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got),
                  key=lambda r: (r[3], r[4]))


def test_shards_equal_brute_force(small_docs):
    rows = [(r["doc_id"], r["text"]) for r in small_docs.select("doc_id", "text").collect()]
    assert shards(small_docs, 24) == brute_shards(rows, 24)


def test_shards_of_awkward_rows(awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert shards(awkward, 4) == brute_shards(rows, 4)
    assert shards(nothing, 4) == []
    kept = shard_by_bytes(awkward, 4, keep=("lang", "score", "text"))
    assert kept.columns[-3:] == ["lang", "score", "text"] and kept.count() == 12


def brute_targets(sizes, cap=3):
    """Targets by repeated resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > cap * sizes[s]]
        if not over:
            target.update({s: left * weight[s] / w for s in free})
            break
        for s in over:
            target[s] = cap * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


def check_mix(df, near):
    got = mix_sources(df, keep=("source",)).collect()
    rows = df.select("doc_id", "text", "source").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, len(WORD.findall(r["text"] or ""))) for r in rows)
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        n = len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    target = brute_targets(dict(sizes)) if rows else {}
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) <= 1e-6 * max(1, target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in target:
        assert abs(taken[s] - target[s]) <= near * largest[s] + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mix_sources(df, keep=("source",)).collect()))


def test_mix_meets_targets(small_docs):
    check_mix(small_docs, near=1.0)


def test_mix_of_awkward_rows(awkward, nothing):
    check_mix(awkward, near=3.0)
    check_mix(nothing, near=1.0)


def test_tilt_solves_the_dual(small_docs):
    """Rates meet each source's words before rounding."""
    got = mix_sources(small_docs, keep=("source",)).collect()
    words, target = defaultdict(float), {}
    for r in got:
        words[r["source"]] += r["rate"] * r["size"]
        target[r["source"]] = r["target"]
    for s in target:
        assert abs(words[s] - target[s]) <= 1e-6 * target[s]
