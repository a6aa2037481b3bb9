"""Helpers shared by the operators of this subpackage.

* ``written`` / ``attach_small``: materialise through the shared checkpoint
  folder, and join a table that is broadcast only below a checked bound.
* ``TextBlocks``: words and word n-grams of an Arrow string column as NumPy
  arrays of 64-bit hashes.  The texts of a batch are taken as one byte buffer;
  a word's hash is a difference of prefix sums of ``T[byte] * P**i`` modulo
  2**64, so the work is vectorised over bytes, not per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convforge.session import apply_core_conf, scratch_path

#: Rows that may be broadcast or collected as model state (checked by count).
MAX_BROADCAST_ROWS = 500_000

#: Word characters of every operator here: anything but these separators.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_core_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back:
    computed once, lineage cut, columns still pruned by later readers."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    if _recorded is not None:
        _recorded.append(out)
    return out


#: Where ``recording`` notes what ``written`` makes.
_recorded: list[DataFrame] | None = None


@contextmanager
def recording(tables: list[DataFrame]):
    """Note in ``tables`` what is written meanwhile, to ``discard`` it later."""
    global _recorded
    before, _recorded = _recorded, tables
    try:
        yield
    finally:
        _recorded = before


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` returned, once nothing reads them any more (what
    was made from them is itself written or collected)."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(conf).delete(path, True)


#: Rows and bytes of text that a Python worker and the JVM beside it hold at once.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, for a step in Python: Arrow batches of bounded size from now on."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def row_key(id_col: str, text_col: str):
    """A key of a row that is never null and differs where id or text do; by id, null last."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                    F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit(1), text_col).alias("b"))


def attach_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Equi-join ``small`` (already materialised) to ``big``: broadcast when its
    counted rows are within ``max_rows``, else a shuffle join (AQE splits skew)."""
    if small.limit(max_rows + 1).count() <= max_rows:
        small = F.broadcast(small)
    return big.join(small, on, how)


def held_out(id_col, parts: int, remainder: int):
    """crc32 of the id as text modulo ``parts`` equals ``remainder`` (null id: of '')."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % parts == remainder


# ---------------------------------------------------------------------------
# Hashing of words
# ---------------------------------------------------------------------------
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Also every other ASCII character that is not a letter or digit.
_PUNCTUATION = _SPACE.copy()
_PUNCTUATION[[c for c in range(128) if not chr(c).isalnum()]] = True
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_pow = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n (kept per worker, doubled on demand)."""
    have = _pow.get("n", 0)
    if have < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        out = []
        for base in (_P, _P_INV):
            a = np.ones(size, dtype=np.uint64)
            a[1:] = np.uint64(base)
            out.append(np.cumprod(a))
        _pow.update(n=size, p=out[0], q=out[1])
    return _pow["p"][:n], _pow["q"][:n]


class Words:
    """Words of rows [first, first + len(self)) of an Arrow string column.

    ``hash`` holds one 64-bit value per word; the words of row ``r`` are
    ``hash[offset[r]:offset[r + 1]]``; ``start`` / ``end`` are byte positions
    within ``data``, ``row_start`` the bytes at which rows begin.
    """

    __slots__ = ("first", "data", "row_start", "start", "end", "hash", "offset", "_total", "_q")

    def __len__(self):
        return len(self.offset) - 1

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(words longer than n bytes, hash of their first n bytes)."""
        at = np.flatnonzero(self.end - self.start > n)
        s = self.start[at]
        return at, mix64((self._total[s + n] - self._total[s]) * self._q[s] + _GRAM[n % len(_GRAM)])

    def grams(self, n: int) -> np.ndarray:
        """Hash of the n words from every position (meaningful inside a row)."""
        return word_grams(self.hash, n)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word shingles (not distinct) and their row offsets; a
        row of 1 to n-1 words has one shingle: its whole sequence."""
        count = np.diff(self.offset)
        per_row = np.where(count >= n, count - n + 1, np.minimum(count, 1))
        off = np.concatenate([[0], np.cumsum(per_row)])
        g = self.grams(n)
        # first gram of each row, then consecutive ones
        pos = np.repeat(self.offset[:-1] - off[:-1], per_row) + np.arange(off[-1])
        short = np.flatnonzero((count > 0) & (count < n))
        if len(g):
            out = g[np.minimum(pos, len(g) - 1)]
        else:
            out = np.zeros(len(pos), dtype=np.uint64)
        for r in short:
            out[off[r]] = gram_hash(self.hash[self.offset[r]:self.offset[r + 1]])
        return out, off


def word_grams(w: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from every position of a word-hash sequence."""
    if len(w) < n:
        return np.zeros(0, dtype=np.uint64)
    m = len(w) - n + 1
    g = w[:m] * _GRAM[0]
    for k in range(1, n):
        g = g + w[k:m + k] * _GRAM[k]
    return mix64(g)


def gram_hash(words: np.ndarray) -> np.uint64:
    """Hash of one word sequence, as ``Words.grams`` gives it for its length."""
    with np.errstate(over="ignore"):
        k = np.arange(len(words)) % len(_GRAM)
        return mix64(np.array([(words * _GRAM[k]).sum(dtype=np.uint64)], dtype=np.uint64))[0]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(row offsets, bytes) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return off, data


def blocks(column, lower: bool = True, block_bytes: int = 1 << 20,
           punctuation: bool = False) -> Iterator[Words]:
    """Words of a column in blocks of whole rows of about ``block_bytes`` (a
    longer text is a block of its own), which bounds the arrays held at once.
    ``punctuation``: ASCII punctuation separates words too."""
    separator = _PUNCTUATION if punctuation else _SPACE
    off, data = text_buffers(column)
    n, a = len(off) - 1, 0
    table = _BYTE_LOWER if lower else _BYTE
    while a < n:
        b = int(np.searchsorted(off, off[a] + block_bytes, side="right")) - 1
        b = min(n, max(b, a + 1))
        w = Words()
        w.first, w.data = a, data[off[a]:off[b]]
        rows = off[a:b + 1] - off[a]
        w.row_start = rows
        size = len(w.data)
        if size == 0:
            w.start = w.end = np.zeros(0, dtype=np.int64)
            w._total = w._q = np.zeros(1, dtype=np.uint64)
            w.hash = np.zeros(0, dtype=np.uint64)
            w.offset = np.zeros(b - a + 1, dtype=np.int64)
        else:
            space = separator[w.data]
            before = np.empty(size, dtype=bool)
            before[0], before[1:] = True, space[:-1]
            after = np.empty(size, dtype=bool)
            after[-1], after[:-1] = True, space[1:]
            inner = rows[(rows > 0) & (rows < size)]
            before[inner] = True
            after[inner - 1] = True
            w.start = np.flatnonzero(~space & before)
            w.end = np.flatnonzero(~space & after) + 1
            p, q = _powers(size)
            total = np.empty(size + 1, dtype=np.uint64)
            total[0] = 0
            np.cumsum(table[w.data] * p, out=total[1:])
            w._total, w._q = total, q
            w.hash = mix64((total[w.end] - total[w.start]) * q[w.start])
            w.offset = np.searchsorted(w.start, rows)
        yield w
        a = b


_BITS = 20
_BIT_SHIFT = np.uint64(64 - _BITS)


def bitmap(values: np.ndarray) -> np.ndarray:
    """Which leading bits occur among ``values``: a cheap first test for ``find``."""
    m = np.zeros(1 << _BITS, dtype=bool)
    m[values >> _BIT_SHIFT] = True
    return m


def find(values: np.ndarray, table: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``values`` that occur in the sorted ``table``, and where."""
    at = np.flatnonzero(bits[values >> _BIT_SHIFT])
    where = np.searchsorted(table, values[at])
    ok = table[np.minimum(where, len(table) - 1)] == values[at]
    return at[ok], where[ok]


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of ``schema`` from columns by name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(k).type)
         for k, c in ((f.name, columns[f.name]) for f in schema)], schema=schema)
