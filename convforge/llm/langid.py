"""Language identification by segmentation-marginalised unigrams.

Every language has a unigram distribution over the pieces of a fixed public
vocabulary (never trained here; its path is a parameter).  The probability of a
word is the sum over all its segmentations into pieces, by the forward
algorithm; a text's score is the sum of its words' log probabilities.  The
piece probabilities are fitted by expectation-maximisation (forward-backward
over all segmentations) on a bounded sample of labelled texts.

Words are separated by white space and carry the vocabulary's word-start
marker.  Single bytes are pieces too, so that every word has a segmentation;
a word of any length is scored over all its segmentations.  The recursions are
vectorised over the distinct words of equal length, of words over ``LONGEST``
bytes over all of a block.  Only the fit takes such words in runs of that length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import _BYTE, _powers, blocks, bounded_batches, held_out

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = 0x20  # byte that stands for the word-start marker; no word has it inside
LONGEST = 32
_BITS = 20
_SHIFT = np.uint64(64 - _BITS)


def load_pieces(path: str = VOCABULARY) -> list[bytes]:
    """The vocabulary's pieces as bytes, plus all single bytes; marker as MARK."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([b]) for b in range(256)}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        p = sp.id_to_piece(i)
        p = (" " if p.startswith("▁") else "") + p.lstrip("▁")
        if p and "▁" not in p and " " not in p[1:]:
            out.add(p.encode())
    return sorted(out)


class Pieces:
    """Piece lookup by hash of a byte range."""

    def __init__(self, pieces: list[bytes]):
        self.longest = max(map(len, pieces))
        h = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(h)
        self.keys, self.ids = h[order], order
        self.map = np.zeros(1 << _BITS, dtype=bool)
        self.map[(h >> _SHIFT).astype(np.int64)] = True

    @staticmethod
    def _hash(p: bytes) -> np.uint64:
        b = np.frombuffer(p, dtype=np.uint8)
        return (_BYTE[b] * _powers(len(b))[0]).sum(dtype=np.uint64)

    def spans(self, words: np.ndarray):
        """(start, end, words, pieces): of equally long words, those whose bytes from
        start to end are a piece, and that piece; ascending by end."""
        n = words.shape[1]
        p, q = _powers(n)
        total = np.zeros((n + 1, len(words)), dtype=np.uint64)
        np.cumsum(_BYTE[words.T] * p[:, None], axis=0, out=total[1:])
        for e in range(1, n + 1):
            for s in range(max(0, e - self.longest), e):
                h = (total[e] - total[s]) * q[s]
                at = np.flatnonzero(self.map[h >> _SHIFT])
                if len(at):
                    where = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
                    ok = self.keys[where] == h[at]
                    yield s, e, at[ok], self.ids[where[ok]]


def forward(pieces: Pieces, words: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Probability of every word under every language."""
    alpha = np.zeros((words.shape[1] + 1, len(words), prob.shape[1]))
    alpha[0] = 1.0
    for s, e, at, ids in pieces.spans(words):
        alpha[e][at] += alpha[s][at] * prob[ids]
    return alpha[-1]


def forward_long(pieces: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray, prob: np.ndarray,
                 cells: int = 1 << 18) -> np.ndarray:
    """Log probability, under every language, of the words data[start:end] of any
    lengths, each after the marker.

    One step takes a byte of all words that reach so far.  Only as many states are
    held as the longest piece has bytes, rescaled before they can underflow; the
    pieces are found for ``cells`` bytes of the words at a time.
    """
    size = end - start + 1
    order = np.argsort(-size, kind="stable")
    size, start = size[order], start[order]
    ring, langs = pieces.longest + 1, prob.shape[1]
    alpha = np.zeros((ring, len(size), langs))
    alpha[0] = 1.0
    scale, out = np.zeros((len(size), langs)), np.zeros((len(size), langs))
    t0 = 0
    while len(size) and t0 < size[0]:
        live = int(np.searchsorted(-size, -t0))  # words with more than t0 bytes come first
        width = min(max(pieces.longest, cells // live), int(size[0]) - t0)
        back = min(t0, pieces.longest - 1)
        place = np.arange(t0 - back, t0 + width)
        at = start[:live, None] + np.maximum(place - 1, 0)
        m = np.where(place == 0, MARK, data[np.minimum(at, len(data) - 1)])
        p, q = _powers(len(place))
        total = np.zeros((live, len(place) + 1), dtype=np.uint64)
        np.cumsum(_BYTE[m] * p, axis=1, out=total[:, 1:])
        ends, rows, lengths, ids = [], [], [], []
        for n in range(1, min(pieces.longest, len(place)) + 1):
            h = (total[:, n:] - total[:, :-n]) * q[:len(place) - n + 1]
            r, s = np.nonzero(pieces.map[h >> _SHIFT])
            e = s + n - back  # bytes after t0 at the piece's end
            ok = (e > 0) & (t0 + e <= size[r])
            r, s, e = r[ok], s[ok], e[ok]
            where = np.minimum(np.searchsorted(pieces.keys, h[r, s]), len(pieces.keys) - 1)
            ok = pieces.keys[where] == h[r, s]
            ends.append(e[ok])
            rows.append(r[ok])
            lengths.append(np.full(int(ok.sum()), n))
            ids.append(pieces.ids[where[ok]])
        ends, rows, lengths, ids = (np.concatenate(x) for x in (ends, rows, lengths, ids))
        by = np.argsort(ends, kind="stable")
        rows, lengths, ids = rows[by], lengths[by], ids[by]
        cut = np.searchsorted(ends[by], np.arange(1, width + 2))
        for e in range(1, width + 1):
            t, span = t0 + e, slice(cut[e - 1], cut[e])
            alpha[t % ring] = 0.0
            np.add.at(alpha[t % ring], rows[span], alpha[(t - lengths[span]) % ring, rows[span]] * prob[ids[span]])
            if t % 8 == 0:
                top = alpha.max(axis=0)
                top[top <= 0] = 1.0
                alpha /= top
                scale += np.log(top)
            done = slice(int(np.searchsorted(-size, -t)), int(np.searchsorted(-size, -t, side="right")))
            if done.start < done.stop:
                with np.errstate(divide="ignore"):
                    out[done] = np.log(alpha[t % ring, done]) + scale[done]
        t0 += width
    back_order = np.empty_like(out)
    back_order[order] = out
    return back_order


def _expected(pieces: Pieces, words: np.ndarray, weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """Expected piece counts over all segmentations (forward-backward)."""
    n = words.shape[1]
    spans = list(pieces.spans(words))
    alpha = np.zeros((n + 1, len(words), prob.shape[1]))
    beta = np.zeros_like(alpha)
    alpha[0], beta[n] = 1.0, 1.0
    for s, e, at, ids in spans:
        alpha[e][at] += alpha[s][at] * prob[ids]
    for s, e, at, ids in sorted(spans, key=lambda x: -x[0]):
        beta[s][at] += prob[ids] * beta[e][at]
    share = weight / np.maximum(alpha[n], 1e-300)
    out = np.zeros_like(prob)
    for s, e, at, ids in spans:
        c = alpha[s][at] * prob[ids] * beta[e][at] * share[at]
        for k in range(prob.shape[1]):
            out[:, k] += np.bincount(ids, weights=c[:, k], minlength=len(prob))
    return out


def _by_length(words: list[bytes]):
    """Runs of at most LONGEST bytes with the marker first in a word's first run:
    {length: (matrix, index of the word of each row)}."""
    groups: dict[int, list] = {}
    for i, w in enumerate(words):
        for k in range(0, len(w), LONGEST):
            run = (b" " if k == 0 else b"") + w[k:k + LONGEST]
            groups.setdefault(len(run), []).append((run, i))
    return {n: (np.frombuffer(b"".join(r for r, _ in g), dtype=np.uint8).reshape(len(g), n),
                np.array([i for _, i in g])) for n, g in groups.items()}


def _short(w, rows: np.ndarray, size: np.ndarray, cells: int = 1 << 18):
    """The words ``rows`` of a block, of at most LONGEST bytes, by length: (matrix with the
    marker first, index in ``rows``), of about ``cells`` bytes at a time."""
    for n in np.unique(size[(size > 0) & (size <= LONGEST)]):
        every = np.flatnonzero(size == n)
        step = max(1, cells // int(n))
        for a in range(0, len(every), step):
            i = every[a:a + step]
            m = w.data[w.start[rows[i]][:, None] + np.arange(n)]
            yield np.column_stack([np.full(len(i), MARK, dtype=np.uint8), m]), i


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[bytes]
    prob: np.ndarray  # (pieces, languages)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        vocabulary: str = VOCABULARY, docs_per_language: int = 800, rounds: int = 3,
        smooth: float = 200.0) -> LanguageModel:
    """Fit on about ``docs_per_language`` whole texts per language, chosen by a
    hash of the id.  Rows with null text or language are left out."""
    src = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).cast("string").alias("_text"),
                      F.col(lang_col).cast("string").alias("_lang")).where("_text is not null and _lang is not null")
    counts = {r["_lang"]: r["count"] for r in src.groupBy("_lang").count().collect()}  # languages only
    pieces = load_pieces(vocabulary)
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], pieces, np.zeros((len(pieces), 0)))
    share = F.create_map(*[x for k, v in counts.items()
                           for x in (F.lit(k), F.lit(min(1.0, docs_per_language / v)))])
    u = F.xxhash64(F.coalesce("_id", F.lit("")), F.lit("language")).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    sample = src.where(u < share[F.col("_lang")]).select("_lang", "_text")

    def run(batches):
        for b in batches:
            seen: dict[tuple, int] = {}
            langs = b.column(0).to_pylist()
            for w in blocks(b.column(1), lower=False):
                raw = w.data.tobytes()
                for r in range(len(w)):
                    lang = langs[w.first + r]
                    for k in range(w.offset[r], w.offset[r + 1]):
                        key = (lang, raw[w.start[k]:w.end[k]])
                        seen[key] = seen.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.binary()),
                 pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])

    got = (sample.mapInArrow(run, "lang string, word binary, n bigint")
                 .groupBy("word", "lang").agg(F.sum("n").alias("n")).toArrow())  # words of the sample
    words = got.column("word").to_pylist()
    lang = np.array([languages.index(x) for x in got.column("lang").to_pylist()], dtype=np.int64)
    n = got.column("n").to_numpy().astype(float)
    table = Pieces(pieces)
    prob = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    groups = _by_length(words)
    for _ in range(rounds):
        total = np.zeros_like(prob)
        for size in sorted(groups):
            m, index = groups[size]
            for a in range(0, len(m), 20_000):
                i = index[a:a + 20_000]
                weight = np.zeros((len(i), len(languages)))
                weight[np.arange(len(i)), lang[i]] = n[i]
                total += _expected(table, m[a:a + 20_000], weight, prob)
        # A shared floor keeps every piece possible in every language.
        floor = (total.sum(axis=1, keepdims=True) + 1.0) / (total.sum() + len(prob))
        prob = (total + smooth * floor) / (total.sum(axis=0) + smooth)
    return LanguageModel(languages, pieces, prob)


def learnable(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learnt from: crc32(id as text) mod 3 is not 1."""
    return docs.where(~held_out(id_col, 3, 1))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",), cache_words: int = 1_000_000) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score``, the posterior probability
    of the predicted language (equal priors) given the whole text.

    A null text, one without a letter, or a model without languages: 'und' and 0.
    Ties go to the first language in order.
    """
    src = bounded_batches(docs).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                      F.col(text_col).cast("string").alias("_text"))
    ddl = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]],
                     "lang_pred string", "score double"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        langs = len(model.languages)
        table = Pieces(model.pieces)
        known, value = np.zeros(0, dtype=np.uint64), np.zeros((0, langs))
        for b in batches:
            texts = b.column(b.num_columns - 1)
            total = np.zeros((b.num_rows, langs))
            for w in blocks(texts, lower=False) if langs else ():
                keys, first, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
                at = np.searchsorted(known, keys)
                have = np.zeros(len(keys), dtype=bool)
                if len(known):
                    have = known[np.minimum(at, len(known) - 1)] == keys
                logs = np.zeros((len(keys), langs))
                logs[have] = value[at[have]]
                new = np.flatnonzero(~have)
                rows = first[new]
                size = w.end[rows] - w.start[rows]
                for m, i in _short(w, rows, size):
                    logs[new[i]] = np.log(np.maximum(forward(table, m, model.prob), 1e-300))
                long = np.flatnonzero(size > LONGEST)
                for a in range(0, len(long), 10_000):
                    i = long[a:a + 10_000]
                    logs[new[i]] = forward_long(table, w.data, w.start[rows[i]], w.end[rows[i]], model.prob)
                if len(new) and len(known) + len(new) <= cache_words:
                    known = np.concatenate([known, keys[new]])
                    order = np.argsort(known)
                    known, value = known[order], np.concatenate([value, logs[new]])[order]
                filled = np.flatnonzero(np.diff(w.offset))
                if len(filled):
                    total[w.first + filled] = np.add.reduceat(logs[inverse], w.offset[filled], axis=0)
            pred, score = [], []
            best = total.argmax(axis=1) if langs else None
            if langs:
                top = total.max(axis=1)
                post = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
            for i, t in enumerate(texts.to_pylist()):
                if not langs or t is None or not any(c.isalpha() for c in t):
                    pred.append("und")
                    score.append(0.0)
                else:
                    pred.append(model.languages[best[i]])
                    score.append(float(post[i]))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(b.num_columns - 1)], pa.array(pred, pa.string()),
                 pa.array(score, pa.float64())],
                names=[*b.schema.names[:-1], "lang_pred", "score"])

    return (src.mapInArrow(run, ddl)
               .withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)}))
