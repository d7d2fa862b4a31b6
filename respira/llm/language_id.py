"""Language identification, word first: known words by their log frequency in each language, unseen words by
progressively shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.llm.common import bounded_batches, chunks, mix, released, store

#: The classifier is fitted on at most about this many labelled documents, drawn by a hash of their id and text.
MAX_TRAIN_DOCS = 20_000
GRAM_LENGTHS = (5, 4, 3, 2, 1)
#: Weight of one back-off step.
BACKOFF = 0.7
#: Words after which evidence no longer sharpens the score.
FULL_EVIDENCE = 20
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_U = np.uint64
with np.errstate(over="ignore"):
    _PLACES = np.cumprod(np.full(1 << 12, _U(0x9E3779B97F4A7C15)))


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    return _WORD.findall(text.lower()) if text else []


class Letters:
    """Code points of words, one blank around each, with 64-bit hashes of words and of their n-grams."""

    def __init__(self, words: list[str]):
        self.code = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(_U)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size + 1) - self.size

    def words(self) -> np.ndarray:
        """Hash of each word."""
        if not len(self.size):
            return np.empty(0, _U)
        place = np.arange(int(self.size.sum())) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        at = np.repeat(self.start, self.size) + place
        far, place = divmod(place, len(_PLACES))
        with np.errstate(over="ignore"):
            each = mix(self.code[at] + far.astype(_U) * _U(1 << 32)) * _PLACES[place]
            return mix(np.add.reduceat(each, np.cumsum(self.size) - self.size) + self.size.astype(_U))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the word and hash of each of its n-grams, blanks around it included."""
        count = np.maximum(self.size + 3 - n, 0)
        word = np.repeat(np.arange(len(count)), count)
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + self.start[word] - 1
        h = np.full(len(at), _U(n))
        with np.errstate(over="ignore"):
            for k in range(n):
                h += mix(self.code[at + k]) * _PLACES[k]
        return word, mix(h)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words (size 0) and of n-grams by length, as hashes."""
    for f in frames:
        for a in range(0, len(f), 500):
            part = f.iloc[a : a + 500]
            for lang, texts in part.groupby("lang")["text"]:
                c = Counter(w for t in texts for w in words_of(t))
                if not c:
                    continue
                x, n = Letters(list(c)), np.fromiter(c.values(), np.int64, len(c))
                for size, word, h in [(0, np.arange(len(n)), x.words()), *((k, *x.grams(k)) for k in GRAM_LENGTHS)]:
                    item, at = np.unique(h, return_inverse=True)
                    total = np.bincount(at, n[word], len(item)).astype(np.int64)
                    yield pd.DataFrame({"lang": lang, "size": size, "item": item.view(np.int64), "n": total})


class Model:
    """Log frequencies of words and n-grams in each language, add-half smoothed over all items of one length.

    ``tables[k]``: sorted hashes of the n-grams of length ``k`` (0: words) and a row of log frequencies for each.
    """

    def __init__(self, counts: pd.DataFrame | None, langs: list[str]):
        """``counts``: one row an item: its size, hash, and count in each of the sorted ``langs`` (null: none)."""
        self.langs = langs
        self.tables = {k: (np.empty(0, _U), np.zeros((0, len(langs)), np.float32)) for k in (0, *GRAM_LENGTHS)}
        if counts is None:
            return
        size, item = counts["size"].to_numpy(), counts["item"].to_numpy().view(_U)
        n = counts.iloc[:, 2:].fillna(0).to_numpy(float)
        for k in self.tables:
            m = np.flatnonzero(size == k)
            m = m[np.argsort(item[m])]
            rows = np.log((n[m] + 0.5) / (n[m].sum(0) + 0.5 * len(m)))
            self.tables[k] = item[m], rows.astype(np.float32)

    def _find(self, k: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each hash, and whether it is known."""
        keys = self.tables[k][0]
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return at, keys[at] == h

    def score(self, words: list[str]) -> np.ndarray:
        """Log scores by language below the best, one row a word; of an unseen word the longest known n-grams decide."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        x = Letters(words)
        at, known = self._find(0, x.words())
        out[known] = self.tables[0][1][at[known]]
        left = np.flatnonzero(~known)
        for step, k in enumerate(GRAM_LENGTHS):
            if not len(left):
                break
            word, h = Letters([words[i] for i in left]).grams(k)
            at, ok = self._find(k, h)
            n = np.bincount(word[ok], minlength=len(left))
            rows = self.tables[k][1][at[ok]]
            total = np.stack([np.bincount(word[ok], rows[:, j], len(left)) for j in range(len(self.langs))], 1)
            hit = n > 0
            mean = total[hit] / n[hit, None]
            out[left[hit]] = (mean - mean.max(1, keepdims=True)) * BACKOFF ** (step + 1)
            left = left[~hit]
        return out - out.max(1, keepdims=True)


class Predictor:
    """Scores whole texts with a model, remembering the rows of words seen before (memory only, never results)."""

    MOST = 100_000

    def __init__(self, model: Model):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.table = np.zeros((0, max(1, len(self.model.langs))), np.float32)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        m = self.model
        words = [words_of(t) for t in texts]
        if not m.langs:
            return [(UNKNOWN, 0.0)] * len(texts)
        if len(self.row) > self.MOST:
            self._clear()
        row = self.row
        new = list({w for ws in words for w in ws if w not in row})
        if new:
            row.update(zip(new, range(len(row), len(row) + len(new)), strict=True))
            self.table = np.concatenate([self.table, m.score(new)])
        out = []
        for t, ws in zip(texts, words, strict=True):
            if not ws:  # letters outside of words do not occur, but for what is a letter and a digit at once
                out.append((m.langs[0], 1.0 / len(m.langs)) if any(map(str.isalpha, t or "")) else (UNKNOWN, 0.0))
                continue
            total = self.table[[row[w] for w in ws]].sum(0, dtype=np.float64) * min(1.0, FULL_EVIDENCE / len(ws))
            best = int(total.argmax())
            out.append((m.langs[best], float(1 / np.exp(total - total[best]).sum())))
        return out


def held_out(id_col: str = "doc_id"):
    """Documents never learned from: crc32 of the id as text divides by 5 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_TRAIN_DOCS) -> Model:
    """Fit on a sample of the labelled rows of ``docs`` whose size ``max_docs`` bounds; counts are summed by Spark.

    Rows without language or text are left out. Every word and n-gram of the sample is kept.
    """
    d = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    d = d.filter("lang is not null and text is not null")
    n = d.count()
    key = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    d = d.filter(key < int((1 << 30) * min(1.0, max_docs / max(n, 1)))).select("lang", "text")
    c = d.mapInPandas(lambda it: released(_count(it)), "lang string, size int, item long, n long")
    c = store(c.groupBy("lang", "size", "item").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in c.select("lang").distinct().collect())
    if not langs:
        return Model(None, [])
    wide = c.groupBy("size", "item").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n"))).alias(f"n{i}") for i, x in enumerate(langs)])
    return Model(wide.toArrow().to_pandas(), langs)


def predictions(spark, model: Model):
    """Column function: struct ``lang_pred, score`` of a text column."""
    handle = spark.sparkContext.broadcast(model)

    def predict(batches):
        p = Predictor(handle.value)
        for b in batches:
            texts = [t if isinstance(t, str) else None for t in b]
            out = [x for a, part in chunks(b) for x in p.predict(texts[a : a + len(part)])]
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return released(predict(batches))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "lang_pred string, score double")


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document, learned from those not held out.

    ``und`` with score 0 where the text is null or has no letter, or nothing could be learned. The score is the share of
    the best language after at most ``FULL_EVIDENCE`` words' worth of evidence; ties go to the smaller code. Repeated
    rows each get their row; other columns are ignored.
    """
    model = train(docs.filter(~held_out(id_col) & F.col(id_col).isNotNull()), id_col, text_col, lang_col)
    run = predictions(docs.sparkSession, model)
    d = docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("p"))
    return d.select("doc_id", held_out().alias("held_out"), "p.*")


def op6_language_id(spark, sf: str) -> DataFrame:
    return language_id(spark.read.parquet(f"{sf}/documents.parquet"))
