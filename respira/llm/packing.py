"""Harmonic packing: pieces go to reciprocal-capacity classes, and class k's bins take k pieces each.

A piece of length ``l`` belongs to class ``k = capacity // l``, and ``k`` pieces of that class always fit into one bin,
so a bin needs no search and no knowledge of other workers. Documents may be cut, so a length that would leave much of
its share of a bin empty gives up a piece of exactly the next class's share first.
"""

from __future__ import annotations

import functools
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from respira.llm.common import LOWER, bounded_batches, released

CAPACITY = 2048
#: Share of a piece's place in its bin that may stay empty before the piece is cut.
MAX_WASTE = 0.02
#: Pieces no longer than this are not cut further.
SHORT = 32
#: Words after which a worker's memo becomes the older of two generations (memory only, never results).
MEMO = 200_000
END_ID = 1
SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """Token ids (little-endian unsigned 32-bit) of whole texts, remembered by white-space-separated run.

    The vocabulary's pre-tokenizer drops white space and never joins what it parts, so ids of a text are those of its
    runs in order. A full stop or comma after an ASCII letter is a token of its own.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words: those of small ASCII letters are one pre-token as they stand and go to the model itself; the
        others are encoded in one call, and their ids parted by where each token begins."""
        merge = self.tokenizer.model.tokenize
        for w in words:
            if w.isalpha() and w.islower():
                self.memo[w] = array("I", [t.id for t in merge(w.decode())]).tobytes()
        words = [w for w in words if w not in self.memo]
        if not words:
            return
        texts = [w.decode() for w in words]
        enc = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        begin = np.fromiter((a for a, _ in enc.offsets), np.int64, len(enc.offsets))
        ids = np.array(enc.ids, "<u4")
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        cut = np.searchsorted(begin, ends)
        raw, a = ids.tobytes(), 0
        for w, b in zip(words, (cut * 4).tolist(), strict=True):
            self.memo[w] = raw[a:b]
            a = b

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.memo) > MEMO:
            self.memo, self.old = {}, self.memo
        memo, old = self.memo, self.old
        # The vocabulary is lower-case; only the strings of special tokens are told apart by case.
        split = [(t if b"<|" in t else t.translate(LOWER)).split() for t in texts]
        new = {w for words in split for w in words if w not in memo}
        again = [w for w in new if w in old]
        memo.update((w, old[w]) for w in again)
        new.difference_update(again)
        if new:
            stem = {w: w[:-1] for w in new if w[-1:] in b".," and w[-2:-1].isalpha()}
            need = {stem.get(w, w) for w in new} | {w[-1:] for w in stem}
            need = sorted(w for w in need if w not in memo)
            if need:
                self._learn(need)
            for w, s in stem.items():
                memo[w] = memo[s] + memo[w[-1:]]
        return [b"".join([memo[w] for w in words]) for words in split]


@functools.cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut_lengths(n: int, capacity: int = CAPACITY, waste: float = MAX_WASTE, short: int = SHORT) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: full sequences, then shares 1/k of the capacity."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        share = capacity // k
        if rest <= short or share - rest <= waste * share:
            out.append(rest)
            break
        out.append(capacity // (k + 1))
        rest -= out[-1]
    return out


class Bins:
    """Open bins of one worker: one for each class, closed as soon as it holds the class's number of pieces."""

    def __init__(self, base: int, capacity: int):
        self.next, self.capacity = base, capacity
        self.open: dict[int, list] = {}

    def put(self, length: int, piece: list) -> list[list]:
        """Pieces that are placed now: ``piece`` gets its sequence and offset when its bin closes."""
        k = self.capacity // length
        held = self.open.setdefault(k, [])
        held.append((length, piece))
        if len(held) < k:
            return []
        return self._close(self.open.pop(k))

    def _close(self, held: list) -> list[list]:
        at, out = 0, []
        for length, piece in held:
            out.append([*piece, self.next, at])
            at += length
        self.next += 1
        return out

    def finish(self) -> list[list]:
        """The unfilled bins, at most one for each class, share sequences: largest first, into the first with room."""
        rest = sorted((sum(x for x, _ in held), held) for held in self.open.values() if held)
        merged: list[tuple[int, list]] = []
        for size, held in sorted(rest, key=lambda x: -x[0]):
            for i, (used, items) in enumerate(merged):
                if used + size <= self.capacity:
                    merged[i] = (used + size, items + held)
                    break
            else:
                merged.append((size, held))
        self.open = {}
        return [x for _, held in merged for x in self._close(held)]


def _pack(frames: Iterator[pd.DataFrame], path: str, capacity: int) -> Iterator[pd.DataFrame]:
    tok, bins = _tokenizer(path), Bins(TaskContext.get().partitionId() << 40, capacity)
    names = ["doc_id", *[c.split()[0] for c in SCHEMA.split(", ")]]
    end = np.array([END_ID], "<u4").tobytes()
    frame = lambda rows: pd.DataFrame(rows, columns=names)
    for f in frames:
        for a in range(0, len(f), 256):
            part, out = f.iloc[a : a + 256], []
            texts = [t.encode() if isinstance(t, str) else b"" for t in part["text"]]
            for key, ids in zip(part["doc_id"], tok.encode(texts), strict=True):
                ids += end
                n, start = len(ids) // 4, 0
                for length in cut_lengths(n, capacity):
                    piece = [key, start, length, ids[4 * start : 4 * (start + length)], n]
                    out += bins.put(length, piece)
                    start += length
            if out:
                yield frame(out)
    if rows := bins.finish():
        yield frame(rows)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
         capacity: int = CAPACITY) -> DataFrame:
    """Token sequences of at most ``capacity`` from whole documents, one row a piece.

    Each document is its text's ids and id 1; null and empty texts give that one id. Every worker fills its own bins
    while it streams, holding at most one open bin a class, so nothing is shuffled, and a task that is run again gives
    the same sequences. ``ids`` are little-endian unsigned 32-bit. Repeated rows and null ids are packed like any other;
    other columns are ignored.
    """
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    # Ids travel as text: next to a null pandas would keep large integers as rounded floats.
    d = bounded_batches(docs).select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.mapInPandas(lambda it: released(_pack(it, path, capacity)), f"doc_id string, {SCHEMA}")
    return d.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def digests(packed: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_packing(spark, sf: str) -> DataFrame:
    return digests(pack(spark.read.parquet(f"{sf}/documents.parquet")))
