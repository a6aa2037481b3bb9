"""Secrets: fixed patterns, plus random strings found by character Markov models.

Two order-1 character models are trained from labelled samples, one on random
strings (keys, hashes, tokens) and one on ordinary identifiers and words.  A
candidate run of key characters is a secret when its log-likelihood ratio per
character passes a threshold.  Spans of the fixed patterns always stay.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import bounded_batches



# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # same as maximal runs of 24 or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = {"assign": 0, "access": 1, "hex": 2, "random": 3}

#: Runs that the Markov models judge.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

_CLASS = np.full(128, 39, dtype=np.int64)  # other
for _c in range(26):
    _CLASS[97 + _c] = _c
    _CLASS[65 + _c] = 40 + _c
for _c in range(10):
    _CLASS[48 + _c] = 26 + _c
for _k, _c in enumerate("+/_"):
    _CLASS[ord(_c)] = 36 + _k
STATES = 67  # 66 characters or classes and the start
START = 66


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost non-overlapping per kind."""
    out = []
    low = text.translate(_ASCII_LOWER) if not text.islower() else text
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return out


_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


@dataclass
class MarkovModel:
    ratio: np.ndarray  # log P(next | previous) of random minus ordinary strings
    threshold: float   # least mean ratio per character


def _codes(s: str) -> np.ndarray:
    return _CLASS[np.frombuffer(s.encode("ascii", "replace"), dtype=np.uint8) & 127]


def _transitions(strings: list[str], smooth: float = 0.5) -> np.ndarray:
    n = np.full((STATES, STATES), smooth)
    for s in strings:
        c = _codes(s)
        np.add.at(n, (np.concatenate([[START], c[:-1]]), c), 1.0)
    return np.log(n / n.sum(axis=1, keepdims=True))


def mean_ratio(s: str, ratio: np.ndarray) -> float:
    c = _codes(s)
    return float(ratio[np.concatenate([[START], c[:-1]]), c].mean()) if len(c) else 0.0


#: Distinct labelled strings per label that the models are trained on at most.
MAX_PER_LABEL = 5_000


def _order(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode(), digest_size=8).digest(), "big", signed=True)


def fit(samples: DataFrame, string_col: str = "string", label_col: str = "random",
        order_col: str = "order", max_per_label: int = MAX_PER_LABEL,
        threshold: float = 0.1) -> MarkovModel:
    """Train both models on distinct labelled strings, the ``max_per_label`` least
    in ``order_col`` (a hash of the string) per label.  Null strings and labels are left out; without
    samples the ratio is zero everywhere and nothing is added."""
    s = (samples.select(F.col(string_col).alias("s"), F.col(label_col).cast("boolean").alias("y"),
                        F.col(order_col).alias("o"))
                .where("s is not null and y is not null").distinct())
    got = {y: sorted(r["s"] for r in s.where(F.col("y") == y)
                     .orderBy("o", "s").limit(max_per_label).collect())  # bounded
           for y in (True, False)}
    return MarkovModel(_transitions(got[True]) - _transitions(got[False]), threshold)


def corpus_samples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Labelled samples (string, random, order) from a corpus: values found by the
    fixed patterns are random strings, words of texts without such values ordinary
    ones.  A batch emits its MAX_PER_LABEL least ordinary words by hash, which hold
    those of the corpus, however it is divided."""
    src = bounded_batches(docs).select(F.col(text_col).cast("string").alias("_text"))
    word = re.compile(r"[A-Za-z0-9+/_=-]{4,}")

    def run(batches):
        for b in batches:
            found, plain = set(), set()
            for text in b.column(0).to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                if spans:
                    for at, kind, end in spans:
                        m = ASSIGN.match(text, at) if kind == "assign" else None
                        found.add(m.group(2) if m else text[at:end])
                else:
                    plain.update(word.findall(text))
            rows = [(w, True, _order(w)) for w in found]
            rows += [(w, False, o) for o, w in heapq.nsmallest(
                MAX_PER_LABEL, ((_order(w), w) for w in plain))]
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64()))],
                names=["string", "random", "order"])

    return src.mapInArrow(run, "string string, random boolean, `order` bigint")


def find(docs: DataFrame, model: MarkovModel, id_col: str = "doc_id", text_col: str = "text",
         keep: tuple[str, ...] = ()) -> DataFrame:
    """Spans of every whole text (null: empty), in code points, end exclusive.

    Returns the id, ``keep``, the counts ``n_assign``, ``n_access``, ``n_hex``,
    ``n_random``, ``base_sha256`` and ``spans``: kind:start:end by start, then kind
    in the order assign, access, hex, random; joined by commas ('' without any).
    A random span is a candidate run that overlaps no base span.
    """
    src = bounded_batches(docs).select(F.col(id_col).alias("_id"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                      F.col(text_col).cast("string").alias("_text"))
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]],
                     "n_assign bigint", "n_access bigint", "n_hex bigint", "n_random bigint",
                     "base_sha256 string", "spans string"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b in batches:
            rows = []
            for text in b.column(b.num_columns - 1).to_pylist():
                text = text or ""
                base = base_spans(text)
                base.sort(key=lambda s: (s[0], KINDS[s[1]]))
                added = []
                for m in CANDIDATE.finditer(text):
                    s = m.group()
                    if s.isdigit():
                        continue  # a number is no key
                    if (mean_ratio(s, model.ratio) >= model.threshold
                            and not any(a < m.end() and m.start() < e for a, _, e in base)):
                        added.append((m.start(), "random", m.end()))
                line = ",".join(f"{k}:{a}:{e}" for a, k, e in base)
                both = sorted([*base, *added], key=lambda s: (s[0], KINDS[s[1]]))
                count = {k: 0 for k in KINDS}
                for _, k, _ in both:
                    count[k] += 1
                rows.append((*count.values(), hashlib.sha256(line.encode()).hexdigest(),
                             ",".join(f"{k}:{a}:{e}" for a, k, e in both)))
            kept = [b.column(i) for i in range(b.num_columns - 1)]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(list(c), pa.int64()) for c in cols[:4]],
                 *[pa.array(list(c), pa.string()) for c in cols[4:]]],
                names=[*b.schema.names[:-1], "n_assign", "n_access", "n_hex", "n_random",
                       "base_sha256", "spans"])

    return (src.mapInArrow(run, ddl)
               .withColumnsRenamed({"_id": id_col, **{f"_k{i}": c for i, c in enumerate(keep)}}))
