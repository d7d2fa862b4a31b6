"""What the operators share: stored intermediate tables, size-checked lookups, hashed words in numpy."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.session import checkpoint_dir

#: Rows up to which a table of one or two numbers a row is sent to every executor (about 16 MB).
BROADCAST_ROWS = 1_000_000

#: Rows of an Arrow batch that holds whole texts.
BATCH_ROWS = 1000

_U = np.uint64


#: Lets Spark delete the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: survives lost executors and cuts the lineage.

    The files of the shuffles that led to it are deleted with the write, as nothing reads them any more.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def drop(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session sending texts to Python a thousand rows at a time: a batch of whole texts stays small."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(name)) > BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def released(out: Iterator) -> Iterator:
    """``out``; at its end the memory that its batches needed goes back to the system, as workers live on when idle."""
    try:
        yield from out
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a stored table has at most ``rows`` rows; counted, not estimated."""
    return df.limit(rows + 1).count() <= rows


def lookup(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Join to a stored narrow table: sent to all executors if its counted rows are few, shuffled otherwise.

    The shuffled form relies on adaptive skew splitting of the left side; ``right`` has one row a key.
    """
    return left.join(F.broadcast(right) if small(right) else right, on, how)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` lacks."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


def row_key(*cols: str | Column) -> Column:
    """Same for equal rows only (64-bit hash); nulls count as a value of their own."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*[x for c in cols for x in (c, c.isNull())])


# ---------------------------------------------------------------------------------------------- words in numpy


def _lut(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


SPACE = _lut(b" \t\n\r\x0b\x0c")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

with np.errstate(over="ignore"):
    _BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
    _PLACES = np.random.Generator(np.random.PCG64(21)).integers(1, 2**63, 64, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_powers = np.ones(1, _U)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def _power(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        with np.errstate(over="ignore"):
            top = _powers[-1:] * _BASE
            _powers = np.concatenate([_powers, _powers * top])
    return _powers


class Words:
    """Words of several texts, parted by ``gap`` bytes (ASCII white space), with 64-bit hashes.

    ``doc`` is the text's number of each word, ``first`` the number of each text's first word (one more at the end).
    """

    def __init__(self, texts: list[bytes], gap: np.ndarray = SPACE):
        self.n_docs = len(texts)
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        self.data = data
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.concatenate([[0], np.cumsum(lens + 1)])
        self.space = gap[data]
        inside = ~self.space
        edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.count)
        n = len(self.start)
        if not n:
            self.hash = np.empty(0, _U)
            return
        where = np.flatnonzero(inside)
        size = self.end - self.start
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(len(where)) - np.repeat(begin, size)
        with np.errstate(over="ignore"):
            total = np.add.reduceat(_BYTES[data[where]] * _power(int(size.max()))[place], begin)
            self.hash = mix(total + size.astype(_U))

    def per_word(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each word has."""
        c = np.concatenate([[0], np.cumsum(flags)])
        return c[self.end] - c[self.start]

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        c = np.concatenate([[0], np.cumsum(flags)])
        return c[self.at[1:]] - c[self.at[:-1]]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words; ``len(hashes) - n + 1`` of them."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, _U)
    with np.errstate(over="ignore"):
        total = np.full(m, _U(n))
        for k in range(n):
            total += hashes[k : k + m] * _PLACES[k]
    return mix(total)


def chunks(texts, lower: bool = False, most: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 (null: empty), about ``most`` bytes at a time; a longer text comes alone and whole."""
    part: list[bytes] = []
    size = begin = 0
    for k, t in enumerate(texts):
        b = t.encode() if isinstance(t, str) else b""
        if lower:
            b = b.translate(LOWER)
        if part and size + len(b) > most:
            yield begin, part
            part, size, begin = [], 0, k
        part.append(b)
        size += len(b)
    if part:
        yield begin, part
