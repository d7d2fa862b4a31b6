"""Licence scan: matching statistics against a suffix automaton of licence words, chained into template spans."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.llm.common import bounded_batches
from respira.llm.license_texts import BASE_PHRASES, TEMPLATES

#: Words of the shortest match that takes part in a chain.
MIN_MATCH = 3
#: Words a chain may skip between two matches, in the text and in the template.
MAX_GAP = 8
#: Share of a template's words that a chain must cover for its label.
MIN_COVER = 0.8

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,first:int,end:int,cover:double>>"
)
# ASCII letters lower-cased, every other ASCII character but digits made a space; bytes of other characters stay.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORDS).split() if text else []


class Automaton:
    """Generalised suffix automaton over sequences of word numbers.

    ``ends[state]`` holds, for each sequence that contains the state's words, where their first place there ends.
    """

    def __init__(self, sequences: list[list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        places: list[tuple[int, int, int]] = []
        for k, seq in enumerate(sequences):
            last = 0
            for i, w in enumerate(seq):
                last = self._extend(last, w)
                places.append((last, k, i + 1))
        self.ends: list[dict[int, int]] = [{} for _ in self.step]
        for state, k, end in places:
            while state > 0:
                if end < self.ends[state].get(k, 1 << 30):
                    self.ends[state][k] = end
                state = self.link[state]

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state of exactly one more word than ``p``, taken out of ``q``."""
        copy = self._new(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if (q := self.step[last].get(w)) is not None:  # an earlier sequence has this already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.length[last] + 1, {}, 0), last
        while p != -1 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p != -1:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def find(self, seq: list[int]) -> int:
        state = 0
        for w in seq:
            state = self.step[state][w]
        return state


class Scanner:
    """Licence templates and phrases as one automaton; its size depends on them alone."""

    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]):
        sequences = [words_of(t) for _, t in [*templates, *phrases]]
        self.number = {w: i for i, w in enumerate(sorted({w for s in sequences for w in s}))}
        seqs = [[self.number[w] for w in s] for s in sequences]
        self.labels, self.sizes = [x for x, _ in templates], [len(s) for s in seqs[: len(templates)]]
        self.auto = a = Automaton(seqs)
        own = {a.find(s): (k, len(s)) for k, s in enumerate(seqs[len(templates) :])}
        self.phrase_labels = [x for x, _ in phrases]
        # Phrases that end where a state's words end: those on the state's path of suffix links.
        self.phrases: list[list[tuple[int, int]]] = []
        for state in range(len(a.step)):
            found = []
            while state > 0:
                if state in own:
                    found.append(own[state])
                state = a.link[state]
            self.phrases.append(found)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
        """Phrases as ``(first word, phrase)`` and maximal matches as ``(end, length, state)`` of a text's words."""
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int32, len(words))
        known = ids >= 0
        # Only runs of two or more template words can hold anything.
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        long = end - begin > 1
        step, link, length, phrases = self.auto.step, self.auto.link, self.auto.length, self.phrases
        places, matches = [], []
        for b, e in zip(begin[long].tolist(), end[long].tolist(), strict=True):
            state = size = 0
            for i, w in enumerate(ids[b:e].tolist(), b):
                nxt = step[state].get(w)
                if nxt is None:
                    if size >= MIN_MATCH:
                        matches.append((i, size, state))
                    while nxt is None and state:
                        state = link[state]
                        size = length[state]
                        nxt = step[state].get(w)
                state, size = (0, 0) if nxt is None else (nxt, size + 1)
                for k, n in phrases[state]:
                    if size >= n:
                        places.append((i + 1 - n, k))
            if size >= MIN_MATCH:
                matches.append((e, size, state))
        return places, matches

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Template spans ``(label, first word, end, covered share)``: matches in order, near each other in both."""
        open_: dict[int, list[tuple[int, int, int, int]]] = {}
        done = []

        def close(k: int, c: tuple[int, int, int, int]) -> None:
            if c[3] >= MIN_COVER * self.sizes[k]:
                done.append((self.labels[k], c[0], c[1], min(1.0, c[3] / self.sizes[k])))

        for end, size, state in matches:
            for k, at in self.auto.ends[state].items():
                if k >= len(self.labels):
                    continue
                best = (end - size, end, at, size)
                live = []
                for c in open_.get(k, ()):
                    if end - size - c[1] > MAX_GAP:
                        close(k, c)
                        continue
                    # Words that overlap the chain, in the text or in the template, count once.
                    new = min(size, end - c[1], at - c[2])
                    if new > 0 and at - size - c[2] <= MAX_GAP:
                        best = max(best, (c[0], end, at, c[3] + new), key=lambda x: x[3])
                    else:
                        live.append(c)
                open_[k] = [*live, best]
        for k, cs in open_.items():
            for c in cs:
                close(k, c)
        return sorted(done, key=lambda x: (x[1], x[2], x[0]))

    def row(self, text: str | None) -> tuple:
        words = words_of(text)
        places, matches = self.scan(words)
        spans = self.chains(matches) if matches else []
        base = {self.phrase_labels[k] for _, k in places}
        starts = [s for s, _ in places]
        score = 1.0 if base else max((s[3] for s in spans), default=0.0)
        named = [{"label": a, "first": b, "end": c, "cover": d} for a, b, c, d in spans]
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {s[0] for s in spans})), score, named,
        )


@functools.cache
def scanner() -> Scanner:
    return Scanner(BASE_PHRASES, TEMPLATES)


def _scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    s = scanner()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    for b in batches:
        f = pd.DataFrame([s.row(t if isinstance(t, str) else None) for t in b], columns=names)
        yield f.astype({"first_word": "Int64", "last_word": "Int64"})


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base phrases, licence labels and template spans of every document, in one pass without a shuffle.

    Words are runs of ASCII letters and digits and of all non-ASCII characters, lower-cased in ASCII. ``n_base`` counts
    the places of the base phrases, ``first_word`` and ``last_word`` their smallest and largest start. A template's label
    is added where a chain of long matches covers ``MIN_COVER`` of it; the score is that share, or 1 with a base phrase.
    Null and empty texts have no words, null starts and score 0; repeated rows each get their row; other columns are
    ignored.
    """
    d = bounded_batches(docs).select(F.col(id_col).alias("doc_id"), F.pandas_udf(_scanned, SCHEMA)(F.col(text_col)).alias("r"))
    return d.select("doc_id", "r.*")


def op1_license_scan(spark, sf: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf}/documents.parquet")).drop("spans")
