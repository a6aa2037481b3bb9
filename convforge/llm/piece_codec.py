"""SentencePiece encoding and decoding through a table of distinct chunks.

A piece of the vocabulary never holds a white-space marker after another
character; no piece joins a line break to anything, nor a comma to a letter before
it.  So no piece crosses the place before a marker, or such a place inside a marked
word: a text falls into *chunks* (marked words, cut where no piece joins the two
characters) that are segmented independently of each other.

1. Frequent chunks: every task counts the chunks of its texts and reports those
   that it saw at least twice; the ``MAX_FREQUENT`` most frequent are segmented
   once, in a distributed step, and broadcast.
2. Any other chunk is sent to the partition of its hash, where equal chunks are
   neighbours: each distinct one is segmented once, and its ids go back to the
   place that it has among its text's rare chunks.
3. A text travels as its codes (ranks of frequent chunks, 0 for a rare one,
   compressed), meets its rare chunks' ids by the hash of the text, and its ids
   are gathered by position.

Copies of a text share one hash, so their rare chunks are segmented and returned
once; a chunk outside the broadcast table is rare or very long (those are spread
over a few partitions), so no key of step 2 is hot.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import bounded_batches, discard, written

MARK = "▁"
#: Chunks in the broadcast table; rarer ones take the other way, at any number.
MAX_FREQUENT = 1 << 19
#: First bytes of codes of one byte and of two; the others' have two more.
ONE, TWO = 150, 96
#: A broadcast chunk's characters and those of all of them at most.
MAX_FREQUENT_CHARS, MAX_TABLE_CHARS = 256, 1 << 25
#: Distinct chunks, and characters of text, after which a counting task reports and starts anew.
COUNTED, COUNTED_CHARS = 1 << 18, 1 << 26
#: Partitions among which a longer chunk's places are spread, as such a one may be frequent.
LONG_SPREAD = 32
_KEY = ["_key", "_check"]
#: What a cut inside a marked word puts before the character.
CUT = rf" {MARK}\g<0>"
#: Longer chunks are cut at every lone character, not only at those of ASCII.
LONG = 48


def _runs(parts: list[str]) -> list[str]:
    """Runs of empty strings are markers of their own: they belong to the marked word
    that follows, or are one chunk."""
    out, at = [], 0
    while True:
        try:
            i = parts.index("", at)
        except ValueError:
            return out + parts[at:]
        out += parts[at:i]
        at = i
        while at < len(parts) and not parts[at]:
            at += 1
        if at < len(parts) and not parts[at].startswith(MARK):
            out.append(" " * (at - i) + parts[at])
            at += 1
        else:
            out.append(" " * (at - i - 1))


class Chunks:
    """Cutting and segmenting with one model.

    A chunk is written without its marker: ``b`` stands for the marked word
    ``▁b``, ``" b"`` for ``▁▁b``, the empty string for a marker alone.  A chunk
    that no marker precedes starts with ``▁`` instead (``▁b`` is ``b`` itself).
    """

    def __init__(self, proto: bytes):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        sample = "Ａ ﬁ  é\t　x "
        if sp.normalize(sample) != MARK + sample.replace(" ", MARK):
            raise ValueError("the model normalises text; chunks are cut for models that only mark white space")
        self.size = sp.get_piece_size()
        together, joined = set(), set()
        for i in range(self.size):
            p = sp.id_to_piece(i)
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
                continue
            if MARK in p.lstrip(MARK):
                raise ValueError(f"piece {p!r} crosses a white-space marker")
            if len(p) > 1:
                together.update(p)
            joined.update(zip(p, p[1:]))
        if "\n" in together:
            raise ValueError("a piece joins a line break to another character")
        together.discard(MARK)
        self.lone = re.compile("[^ " + "".join(map(re.escape, sorted(together))) + "]+")
        ascii_ = [chr(c) for c in range(128) if chr(c) != " "]
        self.lone_ascii = [c for c in ascii_ if c not in together]
        # Characters that no letter or digit precedes in a piece: cut before them,
        # but not after one that does (a space stands for a marker here).
        before = {c: "".join(x for x in [" ", *ascii_] if (x.replace(" ", MARK), c) in joined)
                  for c in ascii_ if c in together and not any(x.isalnum() and y == c for x, y in joined)}
        self.before = re.compile("|".join(f"{re.escape(c)}(?<![{re.escape(x)}].)" if x else re.escape(c)
                                          for c, x in before.items()) or "(?!)")
        self.mark = sp.piece_to_id(MARK)
        self.lead = len(sp.encode("\n"))
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")

    def cut(self, text: str) -> list[str]:
        """The chunks of a text in order; none for the empty text.

        Spaces stand for markers; a cut without one is written `` ▁``, so that a
        split at spaces gives the chunks in their notation.
        """
        if not text:
            return []
        s = self.before.sub(CUT, " " + text.replace(MARK, " "))[1:]
        for c in self.lone_ascii:
            if c in s:
                s = s.replace(c, f" {MARK}{c} {MARK}")
        parts = s.split(" ")
        if "" in parts:
            parts = _runs(parts)
        if not text.isascii() and max(map(len, parts)) > LONG:
            parts = [q for p in parts for q in (self._apart(p) if len(p) > LONG else (p,))]
        return parts

    def _apart(self, chunk: str) -> list[str]:
        """A long chunk (text without spaces) is cut at all lone characters."""
        mark = MARK if chunk.startswith(MARK) else ""
        body = chunk[len(mark):]
        spaces = len(body) - len(body.lstrip(" "))  # a run of markers stays with what follows
        rest = self.lone.sub(lambda m: f" {MARK}" + f" {MARK}".join(m.group()) + f" {MARK}", body[spaces:]).split(" ")
        if spaces and not rest[0]:
            return [" " * spaces, *rest[1:]]
        return [mark + " " * spaces + rest[0], *rest[1:]]

    def segment(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, packed."""
        ids = self.sp.encode(["\n" + c[1:] if c.startswith(MARK) else c for c in chunks], num_threads=1)
        return [np.array(i[self.lead:] if c.startswith(MARK) else i if c else [self.mark], dtype=self.dtype).tobytes()
                for c, i in zip(chunks, ids)]


class Shared:
    """A broadcast variable with a name of its own (``id``) in the workers."""

    _last = 0

    def __init__(self, sc, value):
        Shared._last += 1
        self.id, self._b = Shared._last, sc.broadcast(value)

    @property
    def value(self):
        return self._b.value


def _worker(shared, cache={}) -> Chunks:
    """The model of a broadcast variable, built once per Python worker."""
    if shared.id not in cache:
        cache.clear()
        cache[shared.id] = Chunks(shared.value)
    return cache[shared.id]


def _codes_of(shared, cache={}) -> dict[str, int]:
    """Chunk -> code of the broadcast table, built once per Python worker."""
    if shared.id not in cache:
        cache.clear()
        cache[shared.id] = {c: i for i, c in enumerate(shared.value.chunks.to_pylist(), 1)}
    return cache[shared.id]


def _report(counts: Counter) -> pa.RecordBatch:
    often = [(c, n) for c, n in counts.items() if n > 1 and len(c) <= MAX_FREQUENT_CHARS]
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in often], pa.string()),
                                       pa.array([n for _, n in often], pa.int64())], names=["chunk", "n"])


def frequent_chunks(texts: DataFrame, model: Shared, limit: int) -> pa.Table:
    """(chunk, n, ids) of at most ``limit`` chunks, the most frequent first.

    A chunk that no task sees twice before it reports is not counted: such a one
    occurs at most once in some 10**6 chunks.  Chunks whose count shares its
    eighth of an octave with more than would fit stay out.  The table decides
    which way a chunk's ids take, never what they are.
    """
    def count(batches):
        chunks, counts, seen = _worker(model), Counter(), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(chunks.cut(t))
                seen += len(t)
                if len(counts) > COUNTED or seen > COUNTED_CHARS:
                    yield _report(counts)
                    counts, seen = Counter(), 0
        yield _report(counts)

    def segment(batches):
        chunks = _worker(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(chunks.segment(b.column(0).to_pylist()), pa.binary())],
                names=["chunk", "n", "ids"])

    counts = written(texts.mapInArrow(count, "chunk string, n bigint").groupBy("chunk")
                          .agg(F.sum("n").alias("n")), "chunk-counts")
    octave = F.floor(8 * F.log2("n")).cast("int")
    room, chars, least = limit, MAX_TABLE_CHARS, 1 << 30
    totals = counts.groupBy(octave.alias("o")).agg(F.count("*").alias("rows"), F.sum(F.length("chunk")).alias("chars"))
    for r in totals.orderBy(F.desc("o")).collect():  # at most 512 rows
        room, chars = room - r["rows"], chars - r["chars"]
        if min(room, chars) < 0:
            break
        least = r["o"]
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = (counts.where(octave >= least).repartition(parts, "chunk")
                 .mapInArrow(segment, "chunk string, n bigint, ids binary").toArrow())
    discard(counts)
    return top.sort_by([("n", "descending"), ("chunk", "ascending")])


def _pack(codes: np.ndarray) -> bytes:
    """Codes in one, two or three bytes, the frequent ones in one; first bytes, then the
    others, compressed."""
    v = codes.astype(np.int64)
    two, three = np.flatnonzero((v >= ONE) & (v < ONE + TWO * 256)), np.flatnonzero(v >= ONE + TWO * 256)
    first = v.copy()
    first[two] = ONE + (v[two] - ONE >> 8)
    rest = v[three] - ONE - TWO * 256
    first[three] = ONE + TWO + (rest >> 16)
    data = (first.astype(np.uint8).tobytes() + ((v[two] - ONE) & 255).astype(np.uint8).tobytes()
            + (rest & 0xFFFF).astype("<u2").tobytes())
    return struct.pack("<I", len(v)) + zlib.compress(data, 1)


def _unpack(packed: bytes) -> np.ndarray:
    n, = struct.unpack_from("<I", packed)
    data = np.frombuffer(zlib.decompress(packed[4:]), dtype=np.uint8)
    v = data[:n].astype(np.int64)
    two, three = np.flatnonzero((v >= ONE) & (v < ONE + TWO)), np.flatnonzero(v >= ONE + TWO)
    v[two] = ONE + (v[two] - ONE << 8) + data[n:n + len(two)]
    v[three] = ONE + TWO * 256 + (v[three] - ONE - TWO << 16) + data[n + len(two):].copy().view("<u2")
    return v


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start, ..., start + size - 1 of every range, one after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - end + size, size)


class Table:
    """The frequent chunks: code k (from 1) has the ids flat[start[k]:start[k] + size[k]];
    the last code has those that end every text."""

    def __init__(self, rows: pa.Table, tail: list[int], dtype: np.dtype):
        self.chunks = rows.column("chunk").combine_chunks()
        ids = [*rows.column("ids").to_pylist(), np.array(tail, dtype=dtype).tobytes()]
        self.flat = np.frombuffer(b"".join(ids), dtype=dtype)
        self.size = np.array([0, *(len(x) // dtype.itemsize for x in ids)], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size

    def gather(self, codes: list[np.ndarray], rare: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each ends): those of the frequent chunks, and the rare
        ones' in their places, which are those of code 0."""
        last = np.array([len(self.size) - 1], dtype=np.int64)
        ends = np.cumsum([len(c) + 1 for c in codes])
        codes = np.concatenate([x for c in codes for x in (c, last)])
        size, start = self.size[codes], self.start[codes]
        at = np.flatnonzero(codes == 0)
        lens = np.array([len(r) // self.flat.itemsize for r in rare], dtype=np.int64)
        size[at], start[at] = lens, len(self.flat) + np.cumsum(lens) - lens
        ids = np.concatenate([self.flat, np.frombuffer(b"".join(rare), dtype=self.flat.dtype)])
        return ids[_ranges(start, size)], np.cumsum(size)[ends - 1]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           end_id: bool = True, frequent: int = MAX_FREQUENT) -> DataFrame:
    """Token ids of every text, equal to the sentencepiece library's.

    Returns the columns ``keep`` and ``ids`` (array<int>; with ``end_id`` the
    model's end id last).  A null text counts as empty, an empty one has no ids
    but the end id; bytes that are no UTF-8 count as U+FFFD.  Every row gives one
    row; repeated rows give equal ids.  ``model_path`` is read on the driver.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        proto = f.read()
    here = Chunks(proto)
    tail = [here.sp.eos_id()] if end_id else []
    model = Shared(spark.sparkContext, proto)
    kept = [f"_keep_{i}" for i in range(len(keep))]
    text = F.make_valid_utf8(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    src = bounded_batches(docs).select(text.alias("_text"), *[F.col(c).alias(k) for c, k in zip(keep, kept)])
    src = src.withColumns({"_key": F.xxhash64("_text"), "_check": F.pmod(F.hash("_text"), F.lit(1 << 16)).cast("bigint")})

    top = frequent_chunks(src.select("_text"), model, min(frequent, MAX_FREQUENT))
    table = Shared(spark.sparkContext, Table(top, tail, here.dtype))

    def rare(batches):
        chunks, codes = _worker(model), _codes_of(table)
        for b in batches:
            row, place, found = [], [], []
            for i, t in enumerate(b.column(0).to_pylist()):
                r = [c for c in chunks.cut(t) if c not in codes]
                row += repeat(i, len(r))
                place += range(len(r))
                found += r
            at = pa.array(row, pa.int64())
            # one number for the check and the place among the text's rare chunks
            where = (np.asarray(b.column(2).take(at)) << 32) + np.array(place, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column(1).take(at), pa.array(where, pa.int64()),
                                              pa.array(found, pa.string())], names=["_key", "_where", "_chunk"])

    def segment(batches):
        """Equal chunks are neighbours here, and copies of a place among them too."""
        chunks, last, ids, place = _worker(model), None, b"", None
        for b in batches:
            seen = b.column(2).to_pylist()
            new = [c for i, c in enumerate(seen) if c != (seen[i - 1] if i else last)]
            packed, keep_rows, out = iter(chunks.segment(new)), [], []
            for i, (c, p) in enumerate(zip(seen, zip(b.column(0).to_pylist(), b.column(1).to_pylist()))):
                if c != last:
                    last, ids, place = c, next(packed), None
                if p != place:
                    place = p
                    keep_rows.append(i)
                    out.append(struct.pack(">I", p[1] & 0xFFFFFFFF) + ids)  # sorts by place
            at = pa.array(keep_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), pa.array(np.asarray(b.column(1).take(at)) >> 32, pa.int64()),
                 pa.array(out, pa.binary())], names=[*_KEY, "_ids"])

    def codes(batches):
        chunks, known = _worker(model), _codes_of(table).get
        for b in batches:
            cut = [chunks.cut(t) for t in b.column(0).to_pylist()]
            packed = [_pack(np.fromiter(map(known, c, repeat(0)), dtype=np.uint32, count=len(c))) for c in cut]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(packed, pa.binary())],
                                             names=[*b.schema.names[1:], "_codes"])

    def gather(batches):
        frequent_ids = table.value
        for b in batches:
            if not b.num_rows:
                continue
            ids, ends = frequent_ids.gather([_unpack(c) for c in b.column(0).to_pylist()],
                                            [x[4:] for r in b.column(1).to_pylist() for x in r or ()])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns[2:], lists], names=[*b.schema.names[2:], "ids"])

    def ddl(names, df):
        return ", ".join(f"{n} {df.schema[n].dataType.simpleString()}" for n in names)

    found = (src.select("_text", *_KEY).mapInArrow(rare, "_key bigint, _where bigint, _chunk string")
                .repartition("_chunk", F.when(F.length("_chunk") > MAX_FREQUENT_CHARS, F.pmod("_key", F.lit(LONG_SPREAD)))
                             .otherwise(0))
                .sortWithinPartitions("_chunk", "_key", "_where")
                .mapInArrow(segment, "_key bigint, _check bigint, _ids binary"))
    found = found.groupBy(*_KEY).agg(F.array_sort(F.collect_list("_ids")).alias("_rare"))
    coded = src.select("_text", *_KEY, *kept).mapInArrow(codes, ddl([*_KEY, *kept], src) + ", _codes binary")
    return (coded.join(found, _KEY, "left").select("_codes", "_rare", *kept)
                 .mapInArrow(gather, ", ".join([*([ddl(kept, src)] if kept else []), "ids array<int>"]))
                 .select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "ids"))


class Surfaces:
    """The bytes that each piece stands for in a decoded text."""

    def __init__(self, proto: bytes):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        self.control = np.array([sp.is_control(i) for i in range(n)])
        self.unknown = np.array([sp.is_unknown(i) for i in range(n)])
        names = [sp.id_to_piece(i) for i in range(n)]
        data = [b"" if self.control[i] else bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode()
                for i, p in enumerate(names)]
        self.marked = np.array([p.startswith(MARK) for p in names])
        self.size = np.array([len(d) for d in data], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(data), dtype=np.uint8)

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The texts of the id lists.  Unknown ids, control ids before others and bytes
        that are no UTF-8 are left to the library."""
        size = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        ids = np.asarray(lists.flatten()).astype(np.int64)
        end = np.cumsum(size)
        first = (end - size)[size > 0]
        inner = np.ones(len(ids), dtype=bool)
        inner[end[size > 0] - 1] = False
        if lists.null_count == 0 and not (self.unknown[ids] | self.control[ids] & inner).any():
            begin, width = self.start[ids], self.size[ids]
            strip = first[self.marked[ids[first]]]  # the marker that stands before every text
            begin[strip] += 1
            width[strip] -= 1
            data = self.flat[_ranges(begin, width)].tobytes()
            offset = np.concatenate([[0], np.concatenate([[0], np.cumsum(width)])[end]])
            try:
                for a, b in zip(offset[:-1].tolist(), offset[1:].tolist()):
                    data[a:b].decode()
            except UnicodeDecodeError:
                pass
            else:
                return pa.Array.from_buffers(pa.large_string(), len(size), [
                    None, pa.py_buffer(offset.astype(np.int64).tobytes()), pa.py_buffer(data)]).cast(pa.string())
        return pa.array([None if i is None else self.sp.decode(i) for i in lists.to_pylist()], pa.string())


def _surfaces(shared, cache={}) -> Surfaces:
    if shared.id not in cache:
        cache.clear()
        cache[shared.id] = Surfaces(shared.value)
    return cache[shared.id]


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",),
           into: str = "decoded") -> DataFrame:
    """The text of every row's ids, as the library decodes them (null: null)."""
    with open(model_path, "rb") as f:
        model = Shared(encoded.sparkSession.sparkContext, f.read())
    kept = [f"_keep_{i}" for i in range(len(keep))]
    src = bounded_batches(encoded).select(F.col(ids_col).alias("_ids"), *[F.col(c).alias(k) for c, k in zip(keep, kept)])

    def run(batches):
        pieces = _surfaces(model)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pieces.decode(b.column(0))], names=[*b.schema.names[1:], into])

    fields = [f"{k} {src.schema[k].dataType.simpleString()}" for k in kept]
    return (src.mapInArrow(run, ", ".join([*fields, f"`{into}` string"]))
               .select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], into))
