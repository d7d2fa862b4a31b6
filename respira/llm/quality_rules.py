"""Quality rules by repetition coverage: how much of a text lies inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.llm.common import Words, bounded_batches, chunks, grams, mix

# Published limits on the share of characters inside repeated n-grams (by n) and lines.
GRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "dup_line_share double, " + ", ".join(f"dup_gram{n}_share double" for n in GRAM_LIMITS)
)
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))


def _covered(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Words inside n-grams that their own text has twice or more: all places, and all but each n-gram's first."""
    every, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    g = grams(h, n)
    at = np.flatnonzero(doc[: len(g)] == doc[n - 1 :]) if len(g) else np.empty(0, np.int64)
    if not len(at):
        return every, later
    key = mix(g[at] ^ mix(doc[at].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, member = np.zeros(len(at), bool), np.zeros(len(at), bool)
    again[order[1:]] = same
    member[order[:-1]] = same
    member |= again
    for mark, out in ((member, every), (again, later)):
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, at[mark], 1)
        np.add.at(step, at[mark] + n, -1)
        out[:] = np.cumsum(step[:-1]) > 0
    return every, later


def _lines(text: bytes) -> tuple[int, int, int]:
    """Repeated lines, their characters, and the characters of all lines that have a word."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    chars = sum(len(x.decode()) for x in lines) if lines else 0
    if len(set(lines)) == len(lines):
        return 0, 0, chars
    seen: set[bytes] = set()
    n = dup = 0
    for x in lines:
        if x in seen:
            n, dup = n + 1, dup + len(x.decode())
        seen.add(x)
    return n, dup, chars


def measure(texts) -> pd.DataFrame:
    """One row of ``SCHEMA`` for each text; null counts as empty, and shares of nothing are 0."""
    out = []
    for _, part in chunks(texts):
        w = Words(part)
        add = lambda x, w=w: np.bincount(w.doc, x, w.n_docs)
        code_points = w.per_word((w.data & 0xC0) != 0x80)
        chars = add(code_points)
        shares = {n: np.zeros(w.n_docs) for n in GRAM_LIMITS}
        repeat = np.zeros(w.n_docs)
        low, *rest = GRAM_LIMITS
        every, later = _covered(w.hash, w.doc, low)
        shares[low] = add(code_points * later)
        # A longer n-gram that repeats holds shorter ones that repeat, so only the texts found above need more.
        hit = np.flatnonzero(add(every) > 0)
        if len(hit):
            keep = np.isin(w.doc, hit)
            h, doc, cp = w.hash[keep], w.doc[keep], code_points[keep]
            for n in rest:
                every, later = _covered(h, doc, n)
                shares[n] = np.bincount(doc, cp * later, w.n_docs)
                if n == WINDOW:
                    repeat = np.bincount(doc, every, w.n_docs)
        lines = np.array([_lines(x) for x in part], float).reshape(-1, 3)
        with np.errstate(invalid="ignore", divide="ignore"):
            cols = {
                "n_words": w.count, "word_chars": chars.astype("int64"), "n_symbols": w.per_doc(_SYMBOLS[w.data]),
                "n_dup_lines": lines[:, 0].astype("int64"), "n_repeat_words": repeat.astype("int64"),
                "dup_line_share": np.nan_to_num(lines[:, 1] / lines[:, 2]),
            }
            cols |= {f"dup_gram{n}_share": np.nan_to_num(s / chars) for n, s in shares.items()}
        out.append(pd.DataFrame(cols))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"n_words": []})


def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield measure(b)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Repetition measures and a verdict for every document, in one pass without a shuffle.

    Words are runs without ASCII white space. ``base_failed``: fewer than ``MIN_WORDS`` words, or more than
    ``MAX_REPEAT_PERCENT`` percent of them in 8-word windows that the text has twice. Otherwise the verdict compares the
    share of characters inside repeated n-grams (all but the first copy) and repeated lines with the published limits.
    Null and empty texts have no words and fail; repeated rows each get their row; other columns are ignored.
    """
    d = bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.pandas_udf(_measured, SCHEMA)(F.col(text_col)).alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    over = F.col("dup_line_share") > LINE_LIMIT
    for n, limit in GRAM_LIMITS.items():
        over = over | (F.col(f"dup_gram{n}_share") > limit)
    return d.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)


def op10_quality_rules(spark, sf: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf}/documents.parquet"))
