"""Phrases whose words keep together: counted length by length with double-array tries over encoded texts.

Texts are encoded once, in blocks: a block's distinct words as hashes, and each position's place among them. A phrase can
only be frequent if the phrases without its last and without its first word are, so each pass sends tries of the frequent
phrases of one length (in slices of bounded size) to all workers. Numpy moves the states of all positions of a block
through a trie, one word at a time; where a position and the next both end in accepting states, the position's state
and the following word name a candidate one word longer. A block's candidates are numbered and counted, and Spark sums
the blocks.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respira.llm.common import Words, _lut, bounded_batches, chunks, lookup, mix, store

#: Word positions of a block.
BLOCK_WORDS = 500_000
#: Phrases of one slice of a trie: a bound on what is sent to every worker (tens of MB), not on what is counted.
SLICE = 500_000
#: Rows ranked in one task.
RANK_ROWS = 200_000
LONGEST = 5
#: Slots of a double array that are tried together.
_STEP = 1024

#: Between words: blank, tab and whatever ends a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_GAP, _END = _lut(b" \t" + _ENDS), _lut(_ENDS)
_U = np.uint64


class Trie:
    """Double array over phrases of one length: node ``s`` goes to ``base[s] + code`` if ``check`` there says ``s``.

    ``words`` are the sorted hashes of the phrases' words; a word's code is its place among them, from 1. ``value`` holds
    the phrase's number where a phrase ends.
    """

    def __init__(self, phrases: np.ndarray, numbers: np.ndarray):
        """``phrases``: one row of word hashes a phrase."""
        self.words, codes = np.unique(phrases, return_inverse=True)
        codes = codes.reshape(phrases.shape) + 1
        codes, numbers = (x[np.lexsort(codes.T[::-1])] for x in (codes, numbers))
        n, depth = codes.shape
        # Nodes level by level: rows that agree up to a column share one.
        parent, arcs, size = np.zeros(n, np.int64), [], 1
        for d in range(depth):
            new = np.ones(n, bool)
            new[1:] = (parent[1:] != parent[:-1]) | (codes[1:, d] != codes[:-1, d])
            child = size - 1 + np.cumsum(new)
            arcs.append((parent[new], codes[new, d], child[new]))
            parent, size = child, size + int(new.sum())
        up, code, node = (np.concatenate(x) for x in zip(*arcs, strict=True))
        place = self._lay(up, code, node, size)
        self.value = np.full(len(self.check), -1, np.int64)
        self.value[place[parent]] = numbers

    def _lay(self, up: np.ndarray, code: np.ndarray, node: np.ndarray, size: int) -> np.ndarray:
        """Find a base for each node with children; returns each node's slot."""
        top = int(code.max(initial=0))
        cap = len(code) + 2 * top + 2
        used = np.zeros(cap, bool)
        used[0] = True  # the root
        place, base = np.zeros(size, np.int64), np.zeros(size, np.int64)
        first = np.flatnonzero(np.diff(up, prepend=-1))
        count = np.diff(np.append(first, len(up)))
        start = 0
        for j in np.argsort(-count, kind="stable")[: int((count > 1).sum())].tolist():
            c = code[first[j] : first[j] + count[j]]
            while start + _STEP < len(used) and used[start : start + _STEP].mean() > 0.95:
                start += _STEP
            a, b = start, -1
            while b < 0:
                if a + _STEP + top >= len(used):
                    used = np.concatenate([used, np.zeros(len(used) + _STEP + top, bool)])
                b = self._fit(used, a, c)
                a += _STEP
            base[up[first[j]]] = b
            used[b + c] = True
            place[node[first[j] : first[j] + count[j]]] = b + c
        # Single children take whatever slot is left; their base may be negative.
        lone = first[count == 1]
        free = np.flatnonzero(~used)
        free = np.concatenate([free, len(used) + np.arange(max(0, len(lone) - len(free)))])
        place[node[lone]] = free[: len(lone)]
        base[up[lone]] = free[: len(lone)] - code[lone]
        width = int(place.max(initial=0)) + 1
        self.base, self.check = np.zeros(width, np.int32), np.full(width, -1, np.int32)
        self.base[place] = base
        self.check[place[node]] = place[up]
        return place

    @staticmethod
    def _fit(used: np.ndarray, a: int, c: np.ndarray) -> int:
        """The first base that puts the first child near ``a`` and all children on free slots, or -1."""
        free = a + np.flatnonzero(~used[a : a + _STEP])
        free = free[free >= c[0]]
        for x in c[1:] - c[0]:
            free = free[~used[free + x]]
            if not len(free):
                return -1
        return int(free[0] - c[0])

    def codes(self, words: np.ndarray) -> np.ndarray:
        """Code of each word, 0 where no phrase has it."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, 0)

    def find(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """For each position the number of the phrase of ``depth`` words that begins there, or -1."""
        out = np.full(len(codes), -1, np.int64)
        at = np.flatnonzero(codes > 0)
        state = np.zeros(len(at), np.int64)
        for d in range(depth):
            inside = at + d < len(codes)
            at, state = at[inside], state[inside]
            c = codes[at + d]
            to = self.base[state].astype(np.int64) + c
            ok = (c > 0) & (to >= 0) & (to < len(self.check))
            ok[ok] = self.check[to[ok]] == state[ok]
            at, state = at[ok], to[ok]
        out[at] = self.value[state]
        return out


def _numbers(x: np.ndarray) -> bytes:
    return zlib.compress(x.astype("<i4").tobytes(), 1)


def _ints(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), "<i4").astype(np.int64)


class _Block:
    """Positions of one language gathered by a worker: word hashes, 0 at every end of a piece, and the words' spelling."""

    def __init__(self, lang: str):
        self.salt = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), _U)
        self.parts, self.spell, self.size = [], {}, 0

    def add(self, texts: list[bytes]) -> None:
        w = Words(texts, _GAP)
        if not len(w.hash):
            return
        with np.errstate(over="ignore"):
            h = mix(w.hash + self.salt) | _U(1)
        ends = np.cumsum(_END[w.data])
        piece = ends[w.start] + w.doc * 2**32
        new = np.flatnonzero(np.diff(piece, prepend=piece[0] - 1))
        self.parts.append(np.insert(h, new, _U(0)))
        self.size += len(h)
        values, first = np.unique(h, return_index=True)
        for x, i in zip(values.tolist(), first.tolist(), strict=True):
            if x not in self.spell:
                self.spell[x] = w.data[w.start[i] : w.end[i]].tobytes()

    def row(self, lang: str) -> tuple:
        words, at = np.unique(np.concatenate([np.zeros(1, _U), *self.parts]), return_inverse=True)
        count = np.bincount(at[1:], minlength=len(words))[1:]
        spelling = b" ".join(self.spell[x] for x in words[1:].tolist()).decode()
        return lang, words[1:].view(np.int64), count, spelling, _numbers(at[1:])


def _encode(frames):
    """Blocks of encoded text by language; all blocks of a worker together stay below a size."""
    names = ["lang", "words", "counts", "spelling", "places"]
    held: dict[str, _Block] = {}
    size = 0
    for f in frames:
        langs = f["lang"].to_numpy()
        for lang in pd.unique(langs):
            texts = f["text"][langs == lang]
            for _, part in chunks(texts, lower=True):
                b = held.setdefault(lang, _Block(lang))
                before = b.size
                b.add(part)
                size += b.size - before
                if b.size >= BLOCK_WORDS:
                    size -= b.size
                    yield pd.DataFrame([held.pop(lang).row(lang)], columns=names)
        if size >= 4 * BLOCK_WORDS or len(held) > 1000:
            yield pd.DataFrame([b.row(k) for k, b in held.items() if b.size], columns=names)
            held, size = {}, 0
    if rows := [b.row(k) for k, b in held.items() if b.size]:
        yield pd.DataFrame(rows, columns=names)


def _slices(phrases: DataFrame) -> list[DataFrame]:
    """Tries of the phrases (``number, words``), one row a slice, built by the workers."""

    def build(f):
        t = Trie(np.array(f["words"].tolist(), np.int64).view(_U), f["number"].to_numpy())
        return pd.DataFrame({"data": [zlib.compress(pickle.dumps(t), 1)]})

    n = max(1, -(-phrases.count() // SLICE))
    d = phrases.withColumn("slice", F.pmod(F.xxhash64("number"), F.lit(n)))
    d = store(d.groupBy("slice").applyInPandas(lambda k, f: build(f).assign(slice=k[0]), "slice long, data binary"))
    return [d.filter(F.col("slice") == i) for i in range(n)]


def _found(blocks: DataFrame, trie: DataFrame, depth: int, last: bool, least: int) -> DataFrame:
    """Blocks with the phrases of one more slice, or (of the last) the candidates one word longer whose sums reach ``least``; stored."""
    row = trie.select("data").toArrow().to_pandas()["data"]  # one slice: bounded
    sent = blocks.sparkSession.sparkContext.broadcast(row.iloc[0] if len(row) else None)

    def states(frames):
        """Places of each block, and which phrase begins at each."""
        trie = pickle.loads(zlib.decompress(sent.value)) if sent.value is not None else None
        for f in frames:
            for words, places, found in zip(f["words"], f["places"], f["found"], strict=True):
                p = _ints(places)
                s = np.frombuffer(zlib.decompress(found), np.int64) if found else np.full(len(p), -1, np.int64)
                if trie is not None:
                    got = trie.find(np.concatenate([[0], trie.codes(words.view(_U))])[p], depth)
                    s = np.where(got >= 0, got, s)
                yield words, places, p, s

    def more(frames):
        for words, places, _, s in states(frames):
            yield pd.DataFrame({"words": [words], "places": [places], "found": [zlib.compress(s.tobytes(), 1)]})

    def count(frames):
        for words, _, p, s in states(frames):
            at = np.flatnonzero((s[:-1] >= 0) & (s[1:] >= 0))
            # Candidates by state and next word, numbered within the block.
            kinds, state = np.unique(s[at], return_inverse=True)
            key, which = np.unique(state * (len(words) + 1) + p[at + depth], return_inverse=True)
            if len(key):
                a, w = np.divmod(key, len(words) + 1)
                yield pd.DataFrame({"head": kinds[a], "tail": words[w - 1], "f": np.bincount(which)})

    if last:
        sums = blocks.mapInPandas(count, "head long, tail long, f long").groupBy("head", "tail").agg(F.sum("f").alias("f"))
        out = store(sums.filter(F.col("f") >= least))
    else:
        out = store(blocks.mapInPandas(more, blocks.schema))
    sent.destroy()
    return out


def phrase_counts(docs: DataFrame, text_col: str, lang_col: str, least: int) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, f`` of all phrases of 1 to 5 words with ``f >= least``, and ``lang, n``: words in all."""
    d = bounded_batches(docs).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    schema = "lang string, words array<long>, counts array<long>, spelling string, places binary"
    blocks = store(d.mapInPandas(_encode, schema))
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts", F.split("spelling", " ").alias("names"))).alias("w"))
    each = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f"), F.first("w.names").alias("phrase"))
    each = store(each)
    total = store(each.groupBy("lang").agg(F.sum("f").alias("n")))
    words = each.filter(F.col("f") >= least)
    level = store(words.select("lang", F.array("word").alias("words"), "phrase", "f", F.monotonically_increasing_id().alias("number")))
    names = store(words.select(F.col("word").alias("tail"), F.col("phrase").alias("last")))
    levels = [level]
    text = blocks.select("words", "places", F.lit(None).cast("binary").alias("found"))
    for depth in range(1, LONGEST):
        tries, now = _slices(level.select("number", "words")), text
        for t in tries[:-1]:
            now = _found(now, t, depth, False, least)
        grown = _found(now, tries[-1], depth, True, least)
        grown = lookup(grown, names, "tail", "inner")
        heads = level.select(F.col("number").alias("head"), "lang", "words", "phrase")
        level = lookup(grown, heads, "head", "inner").select(
            "lang", F.concat("words", F.array("tail")).alias("words"), F.concat_ws(" ", "phrase", "last").alias("phrase"), "f",
            F.monotonically_increasing_id().alias("number"),
        )
        level = store(level)
        levels.append(level)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return store(out.select("lang", "words", "phrase", "f")), total


def _best(d: DataFrame, most: int) -> DataFrame:
    """First ``most`` rows of each language with their rank; large languages are cut down in parts first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = -(-d.count() // RANK_ROWS)
    while parts > 1:
        w = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        d = d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).drop("rank")
        parts //= 32
    return d.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= most)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, most: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``most`` phrases of each language whose words attract each other most.

    Lower-cased (ASCII) texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs.
    ``a`` counts all places of a phrase of 2 to 5 words, at least ``least`` of them; ``n`` all words of the language;
    ``l`` and ``r`` the two parts of the phrase at the cut with the lowest ``score``, ``floor(1000 * a * n / (l * r))``
    (of equal scores the first cut). A phrase is left out if one longer by a word contains it and is as frequent. Ties in
    score go by ``a``, then by the phrase's bytes. A null language is ``und``; null and blank texts hold no words; repeated
    rows count each; other columns are ignored. Words are told apart by 64-bit hashes.
    """
    counts, total = phrase_counts(docs, text_col, lang_col, least)
    size = F.size("words")
    many = counts.filter(size > 1)
    cut = many.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.withColumn("left", F.slice("words", F.lit(1), F.col("k"))).withColumn("right", F.slice("words", F.col("k") + 1, size))
    part = counts.select("words", "f")
    cut = lookup(cut, part.toDF("left", "l"), "left", "inner")
    cut = lookup(cut, part.toDF("right", "r"), "right", "inner")
    cut = lookup(cut, total, "lang", "inner")
    # Decimals of 38 digits hold the products of any counts below 10^17 exactly.
    cut = cut.withColumn("score", F.expr("(cast(1000 as decimal(38, 0)) * f * n) div (cast(l as decimal(38, 0)) * r)"))
    best = cut.groupBy("lang", "words", "phrase", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    longer = many.filter(size > 2)
    inner = [longer.select(F.slice("words", F.lit(b), size - 1).alias("words"), F.col("f").alias("a")) for b in (1, 2)]
    best = best.join(inner[0].union(inner[1]).distinct(), ["words", "a"], "left_anti")
    d = store(best.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score"))
    return _best(d, most).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf}/documents.parquet"))
