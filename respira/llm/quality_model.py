"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text, with sharded tables.

A log probability is a sum of values that each depend on one n-gram: ``log p1(w)``, the back-off weights of the contexts,
and what a seen bigram or trigram adds to its lower order. So nothing of the model has to be in one place. N-grams lie
in shards by the hash of their last two words, single words in shards by their own; a shard asks the owners of its contexts
and words for their sums, and every document's n-grams travel to the shards in compressed blocks, whose answer is one
number a document. Nothing is left out or merged: every word and n-gram of the trusted text has its own counts.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.llm.common import SPACE, bounded_batches, chunks, drop, lookup, mix, released, row_key, store

#: Words of the longest n-grams of the classifier.
ORDER = 3
#: Trusted n-grams of a shard, and n-grams of a block that meet a shard in one task, about.
SHARD_ROWS = 2_000_000
BLOCK_ROWS = 8_000_000
#: N-grams gathered before a worker sends them on.
SEND_ROWS = 1_000_000
#: Rounds in which documents' n-grams go to the shards; each sends those of its own shards only.
ROUNDS = 4
#: Rounds in which shards ask the owners of their contexts and words.
ASKS = 2
#: Bits of the filter of one round's trusted bigrams, over all its shards: at most, and for each bigram.
FILTER_BITS = 1 << 26
KEY_BITS = 8
#: Words of more bytes are hashed one by one.
LONG_WORD = 64
#: A document goes if its log perplexity lies above this quantile of trusted text in its language, by this margin.
QUANTILE = 0.99
MARGIN = 0.4
#: Shorter documents are judged leniently: their mean varies by this over the square root of their words.
SPREAD = 6.0

_U = np.uint64
#: Stands before the first word of a text.
BEGIN = _U(0)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    with np.errstate(over="ignore"):
        return mix(a * _U(0x9E3779B97F4A7C15) + mix(b + _U(0x632BE59BD9B4E019)))


def _split(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one, where their words start and end, and the number of each text's first word (one more at the end)."""
    data = b" ".join(texts) + b" "
    edge = np.flatnonzero(np.diff(SPACE[np.frombuffer(data, np.uint8)], prepend=True))
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, edge[::2], edge[1::2], np.searchsorted(edge[::2], at)


def _hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time."""
    size = end - start
    whole = np.frombuffer(data + bytes(16 - len(data) % 8), _U)
    out = size.astype(_U)
    with np.errstate(over="ignore"):
        for k in range(0, min(int(size.max(initial=0)), LONG_WORD), 8):
            i = np.flatnonzero(size > k) if k else slice(None)
            at, left = start[i] + k, np.minimum(size[i] - k, 8).astype(_U)
            shift = (at % 8 * 8).astype(_U)
            x = (whole[at // 8] >> shift) | ((whole[at // 8 + 1] << _U(1)) << (_U(63) - shift))
            out[i] = mix(out[i] * _U(0x9E3779B97F4A7C15) + (x & (~_U(0) >> (_U(64) - _U(8) * left))))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = int.from_bytes(blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return out


_BEGIN_PAIR = _pair(np.array([BEGIN]), np.array([BEGIN]))[0]


def _ngrams(part: list[bytes], order: int) -> tuple[np.ndarray, ...]:
    """The words ``u, v, w`` that end at every word of the texts, its text's number, whether another word follows."""
    data, start, end, bounds = _split(part)
    w, count = _hashes(data, start, end), np.diff(bounds)
    some = count > 0
    first = bounds[:-1][some]
    v = np.concatenate([[BEGIN], w[:-1]]).astype(_U)[: len(w)]
    v[first] = BEGIN
    u = np.concatenate([[BEGIN], v[:-1]]).astype(_U)[: len(w)] if order > 2 else np.full(len(w), BEGIN)
    u[first] = BEGIN
    more = np.ones(len(w), bool)
    more[bounds[1:][some] - 1] = False
    return u, v, w, np.repeat(np.arange(len(part)), count), more


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers: bytes of equal rank together, as many ranks as the largest needs, deflated; low ones of hashes as they are."""
    x = np.asarray(x, "<u8")
    ranks = -(-int(x.max(initial=0)).bit_length() // 8)
    plain, z = ranks - 2 if ranks > 4 else 0, zlib.compressobj(1, strategy=zlib.Z_RLE)
    planes = x.view(np.uint8).reshape(-1, 8).T
    return bytes([ranks, plain]) + len(x).to_bytes(8, "little") + planes[:plain].tobytes() + z.compress(planes[plain:ranks].tobytes()) + z.flush()


def _unplanes(b: bytes) -> np.ndarray:
    ranks, plain, n = b[0], b[1], int.from_bytes(b[2:10], "little")
    out, deflated = np.zeros((n, 8), np.uint8), 10 + plain * n
    if n and ranks:
        out[:, :plain] = np.frombuffer(b, np.uint8, plain * n, 10).reshape(plain, n).T
        out[:, plain:ranks] = np.frombuffer(zlib.decompress(b[deflated:]), np.uint8).reshape(ranks - plain, n).T
    return out.view("<u8").ravel()


def _rising(x: np.ndarray, at: np.ndarray | None = None) -> bytes:
    """Numbers that rise (from each place in ``at`` anew), as differences."""
    x = np.asarray(x, _U)
    d = np.diff(x, prepend=_U(0))
    if at is not None:
        d[at] = x[at]
    return _planes(d)


def _unrising(b: bytes, at: np.ndarray | None = None) -> np.ndarray:
    d = _unplanes(b)
    x = np.cumsum(d, dtype=_U)
    if at is not None and len(at):
        x -= np.repeat(x[at] - d[at], np.diff(np.append(at, len(x))))
    return x


def _numbers(x: np.ndarray) -> tuple[bytes, bytes]:
    """Numbers of which few are different."""
    values, at = np.unique(np.asarray(x, np.float64), return_inverse=True)
    return values.tobytes(), _planes(at)


def _unnumbers(b: tuple[bytes, bytes]) -> np.ndarray:
    return np.frombuffer(b[0])[_unplanes(b[1])]


def _bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def _unbits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


def _pack(u: np.ndarray, v: np.ndarray, w: np.ndarray, doc: np.ndarray | None = None) -> tuple[tuple[bytes, ...], np.ndarray]:
    """N-grams, by places among their distinct words, ordered by ``v, w``, text and ``u``; and that order."""
    names, at = np.unique(np.concatenate([u, v, w]), return_inverse=True)
    u, v, w = np.split(at.astype(_U), 3)
    d = np.zeros(len(u), _U) if doc is None else doc.astype(_U)
    bits, low = len(names).bit_length(), int(d.max(initial=0)).bit_length()
    if 3 * bits + low <= 64:
        order = np.argsort((((v << _U(bits) | w) << _U(low)) | d) << _U(bits) | u)
    else:
        order = np.lexsort((u, d, w, v))
    u, v, w, d = u[order], v[order], w[order], d[order]
    pair = _starts(v, w)
    texts = () if doc is None else (_rising(d, pair),)
    return (_rising(names), _rising(v[pair]), _rising(w[pair], _starts(v[pair])), _planes(np.diff(np.append(pair, len(u)))), _planes(u), *texts), order


def _unpack(names: bytes, v: bytes, w: bytes, runs: bytes, u: bytes, *doc: bytes) -> tuple[np.ndarray, ...]:
    """``v`` and ``w`` of each bigram, where its n-grams begin, ``u`` of all n-grams, and their texts."""
    h, v, runs = _unrising(names), _unrising(v), _unplanes(runs).astype(np.int64)
    at = np.cumsum(runs) - runs
    return h[v], h[_unrising(w, _starts(v))], at, h[_unplanes(u)], *(_unrising(d, at).astype(np.int64) for d in doc)


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return (mix(key) % _U(shards)).astype(np.int64)


def _starts(*sorted_: np.ndarray) -> np.ndarray:
    """Where a new combination begins in columns sorted together."""
    n = len(sorted_[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([c[1:] != c[:-1] for c in sorted_], axis=0)
    return np.flatnonzero(new)


def _distinct(u, v, w, n, followed) -> tuple[np.ndarray, ...]:
    """Distinct n-grams, counts and whether a word ever follows, sorted by the hash of their last two words, then by the first."""
    low = _pair(v, w)
    order = np.lexsort((u, low))
    u, v, w, n, followed, low = u[order], v[order], w[order], n[order], followed[order], low[order]
    at = _starts(low, u)
    if len(at):
        n, followed = np.add.reduceat(n, at), np.logical_or.reduceat(followed, at)
    return u[at], v[at], w[at], n, followed, low[at]


def _pack_counts(u, v, w, n, followed) -> bytes:
    packed, order = _pack(u, v, w)
    return pickle.dumps((packed, _planes(n[order]), _bits(followed[order])))


def _unpack_counts(data: bytes) -> tuple[np.ndarray, ...]:
    packed, n, followed = pickle.loads(data)
    v, w, at, u = _unpack(*packed)
    runs = np.diff(np.append(at, len(u)))
    return u, np.repeat(v, runs), np.repeat(w, runs), _unplanes(n).astype(np.int64), _unbits(followed, len(u))


def _counts(frames, order: int, shards: int) -> Iterator[pd.DataFrame]:
    """Blocks of distinct n-grams with counts, by shard."""
    held, size = [], 0

    def send():
        u, v, w, followed = (np.concatenate(c) for c in zip(*held, strict=True))
        *ngrams, low = _distinct(u, v, w, np.ones(len(u), np.int64), followed)
        s = _shard(low, shards)
        rows = [(k, _pack_counts(*(c[s == k] for c in ngrams))) for k in np.unique(s).tolist()]
        return pd.DataFrame(rows, columns=["shard", "data"])

    for f in frames:
        for _, part in chunks(f["text"], lower=True):
            u, v, w, _, more = _ngrams(part, order)
            held.append((u, v, w, more))
            size += len(w)
            if size >= SEND_ROWS:
                yield send()
                held, size = [], 0
    if size:
        yield send()


_TYPES = [f"{t}{k}" for t in ("top", "low") for k in (1, 2, 3, 4)] + ["bigrams"]


def _filter_places(key: np.ndarray, bits) -> tuple[np.ndarray, ...]:
    """The two bits of each key among so many."""
    bits = np.asarray(bits, _U)
    return tuple(((half * bits) >> _U(32)).astype(np.int64) for half in (key & _U(0xFFFFFFFF), key >> _U(32)))


def _filter(key: np.ndarray, most: int) -> bytes:
    bits = np.zeros(-(-max(1, min(KEY_BITS * len(key), most)) // 8) * 8, bool)
    for at in _filter_places(key, len(bits)):
        bits[at] = True
    return _bits(bits)


class Known:
    """Filters of a round's shards: bigrams that they don't know are left at home, as these add nothing."""

    def __init__(self, filters: dict[int, bytes], shards: int):
        self.data = np.frombuffer(b"".join(filters.get(k, b"\0") for k in range(shards)), np.uint8)
        self.size = np.array([8 * len(filters.get(k, b"\0")) for k in range(shards)])
        self.begin = np.cumsum(self.size) - self.size

    def may_have(self, key: np.ndarray, shard: np.ndarray) -> np.ndarray:
        places = (self.begin[shard] + at for at in _filter_places(key, self.size[shard]))
        one, two = (self.data[at >> 3] << (at & 7).astype(np.uint8) & 128 for at in places)
        return (one & two) > 0


def _merge(f: pd.DataFrame, order: int, most: int) -> pd.DataFrame:
    """One row a shard: its distinct n-grams with counts over all blocks, and how many there are of each count."""
    t = Table(_distinct(*(np.concatenate(c) for c in zip(*map(_unpack_counts, f["data"]), strict=True))), order)
    kinds = [int((x == k).sum()) for x in (t.n, t.n_low) for k in (1, 2, 3, 4)]
    data = _pack_counts(t.u, t.v, t.w, t.n, t.followed)
    return pd.DataFrame([(int(f["shard"].iloc[0]), data, _filter(t.key, most), *kinds, len(t.key))], columns=["shard", "data", "known", *_TYPES])


class Table:
    """N-grams of a shard in order, and its bigrams: ``key`` with counts (of order 3: of distinct words before it)."""

    def __init__(self, ngrams, order: int):
        self.u, self.v, self.w, self.n, self.followed, low = ngrams
        self.at = _starts(low)
        self.key = low[self.at]
        self.bigram = np.repeat(np.arange(len(self.at)), np.diff(np.append(self.at, len(low))))
        self.n_low = np.bincount(self.bigram, None if order > 2 else self.n, len(self.at)).astype(np.int64)
        self.v_low, self.w_low = self.v[self.at], self.w[self.at]

    @classmethod
    def of(cls, data: bytes, order: int) -> Table:
        return cls(_distinct(*_unpack_counts(data)), order)

    def contexts(self) -> np.ndarray:
        """Keys of the bigrams that a word follows somewhere, rising."""
        return self.key[np.logical_or.reduceat(self.followed, self.at)] if len(self.at) else self.key


def _discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """Modified discounts for counts 1, 2 and 3 or more, kept inside their ranges where counts of counts are sparse."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / max(n1, 1), 2 - 3 * y * n3 / max(n2, 1), 3 - 4 * y * n4 / max(n3, 1)]
    return np.array([0.0, *(min(max(d, 0.1), k - 0.1) for k, d in enumerate(raw, 1))])


def _ask(frames, order: int, shards: int, top: np.ndarray, low: np.ndarray, turn: int = 0, asks: int = 1) -> Iterator[pd.DataFrame]:
    """A shard's sums of each context (count, discounted mass) and word (distinct contexts), to the key's owner if it has its turn."""

    def numbered(key):
        mine = np.flatnonzero(_shard(key, shards) % asks == turn)
        return mine, *np.unique(key[mine], return_inverse=True)

    for f in frames:
        for shard, data in zip(f["shard"], f["data"], strict=True):
            t = Table.of(data, order)
            pairs = len(t.key)
            mine, key, at = numbered(np.concatenate([t.v_low, t.w_low]))
            cut = np.searchsorted(mine, pairs)
            (v, w), n = np.split(at, [cut]), t.n_low[mine[:cut]]
            sums = [(1, key, np.bincount(v, n, len(key)), np.bincount(v, low[np.minimum(n, 3)], len(key)), np.bincount(w, minlength=len(key)))]
            if order > 2:
                mine, key, at = numbered(_pair(t.u, t.v))
                n = t.n[mine]
                sums.append((2, key, np.bincount(at, n, len(key)), np.bincount(at, top[np.minimum(n, 3)], len(key)), np.zeros(len(key))))
            out = []
            for kind, key, *x in sums:
                s = _shard(key, shards)
                for k in np.unique(s).tolist():
                    a = s == k
                    out.append((k, kind, shard, pickle.dumps((_rising(key[a]), *(_numbers(c[a]) for c in x)))))
            yield pd.DataFrame(out, columns=["owner", "kind", "asker", "data"])


def _tell(f: pd.DataFrame) -> pd.DataFrame:
    """Sums over all askers: one row for the owner itself (kind 1 or 2), one for each asker (3 or 4).

    Only words (kind 1) come with their keys; others know theirs, and get their numbers by rising key.
    """
    parts = [(_unrising(k), *map(_unnumbers, x)) for k, *x in map(pickle.loads, f["data"])]
    key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = [np.bincount(at, np.concatenate([p[i] for p in parts]), len(key)) for i in (1, 2, 3)]
    kind, owner = int(f["kind"].iloc[0]), int(f["owner"].iloc[0])
    begin = np.isin(key, [BEGIN, _BEGIN_PAIR])
    first = float(np.log(total[1][begin] / total[0][begin]).sum())
    words = int((total[2] > 0).sum())
    if kind == 1:
        own = (_rising(key), *map(_numbers, total))
    else:
        own = tuple(_numbers(c[key != _BEGIN_PAIR]) for c in total[:2])
        total = total[1:2]
    out = [(owner, kind, owner, pickle.dumps(own), words, first)]
    cut = np.cumsum([0, *(len(p[0]) for p in parts)])
    for s, a, b in zip(f["asker"], cut, cut[1:], strict=False):
        out.append((s, kind + 2, owner, pickle.dumps(tuple(_numbers(c[at[a:b]]) for c in total)), 0, 0.0))
    return pd.DataFrame(out, columns=["shard", "kind", "owner", "data", "words", "first"])


def _find(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return at, keys[at] == key


class Model:
    """What one shard knows."""

    def __init__(self, rows: pd.DataFrame, order: int, shards: int, top: np.ndarray, low: np.ndarray, bigrams: int, words: int):
        self.order, self.top, self.low = order, top, low
        self.norm = bigrams + 0.5 * (words + 2)
        told = {k: [(o, pickle.loads(b) if k else b) for o, b in zip(g["owner"], g["data"], strict=True)] for k, g in rows.groupby("kind")}

        def replies(kind, keys, columns):
            """What the owners of the shard's rising keys told."""
            out, owner = np.zeros((columns, len(keys))), _shard(keys, shards)
            for k, x in told.get(kind, []):
                out[:, owner == k] = [_unnumbers(c) for c in x]
            return out

        def weight(total, mass):
            return np.log(np.where(total > 0, mass, 1) / np.where(total > 0, total, 1))

        self.words, left = np.empty(0, _U), np.empty(0)
        self.word_weight = left
        for _, (key, *x) in told.get(1, []):
            total, mass, left = map(_unnumbers, x)
            self.words, self.word_weight = _unrising(key), weight(total, mass)
        self.word_log = np.log(self.p1(left))
        self.keys, self.n, self.rest = np.empty(0, _U), np.empty(0, np.int64), np.empty(0)
        self.tops, self.n_top, self.rest_top = np.empty(0, _U), np.empty(0, np.int64), np.empty(0)
        self.contexts, self.context_weight = np.empty(0, _U), np.empty(0)
        if 0 in told:
            t = Table.of(told[0][0][1], order)
            key = np.unique(np.concatenate([t.v_low, t.w_low]))
            total, mass, left = replies(3, key, 3)
            v, w = np.searchsorted(key, t.v_low), np.searchsorted(key, t.w_low)
            self.keys, self.n, self.rest = t.key, t.n_low, mass[v] * self.p1(left[w])
            if order > 2:
                p2 = (self.n - low[np.minimum(self.n, 3)] + self.rest) / total[v]
                key, at = np.unique(_pair(t.u, t.v), return_inverse=True)
                rest = replies(4, key, 1)[0][at] * p2[t.bigram]
                tops = _pair(t.u, t.key[t.bigram])
                o = np.argsort(tops)
                self.tops, self.n_top, self.rest_top = tops[o], t.n[o], rest[o]
                for _, x in told.get(2, []):
                    total, mass = map(_unnumbers, x)
                    if len(total):
                        self.contexts, self.context_weight = t.contexts(), weight(total, mass)

    def p1(self, left: np.ndarray) -> np.ndarray:
        """Share of distinct contexts, evened out by half a context for each word (and for all unseen ones)."""
        return (left + 0.5) / self.norm

    def of_words(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each word by itself, and its back-off weight as a context."""
        at, ok = _find(self.words, w)
        if not ok.any():
            return np.full(len(w), np.log(self.p1(0.0))), np.zeros(len(w))
        return np.where(ok, self.word_log[at], np.log(self.p1(0.0))), np.where(ok, self.word_weight[at], 0.0)

    @staticmethod
    def _gain(n, rest, discount, own) -> np.ndarray:
        left = np.maximum(n - own, 0)
        kept = np.maximum(left - discount[np.minimum(left, 3)], 0)
        return np.where(left > 0, np.log1p(kept / (rest + 1e-300)), 0.0)

    def of_ngrams(self, v, w, at, u, doc, more, trusted) -> np.ndarray:
        """What n-grams, ordered by bigram, text and first word, add to the words' own values."""
        key, runs = _pair(v, w), np.diff(np.append(at, len(u)))
        bigram = np.repeat(np.arange(len(key)), runs)
        same, alike = _starts(bigram, doc), _starts(bigram, doc, u)
        size, size_alike = (np.diff(np.append(x, len(u))) for x in (same, alike))
        own = size
        if self.order > 2:  # a bigram counts once for each word before it
            new = np.zeros(len(u), np.int64)
            new[alike] = 1
            own = np.add.reduceat(new, same)
        place, ok = _find(self.keys, key)
        out = np.zeros(len(u))
        hit = ok[bigram]
        if hit.any():
            b, mine = place[bigram[hit]], trusted[hit]
            out[hit] = self._gain(self.n[b], self.rest[b], self.low, np.repeat(own, size)[hit] * mine)
            if self.order > 2:
                top, there = _find(self.tops, _pair(u[hit], key[bigram[hit]]))
                top, hit = top[there], np.flatnonzero(hit)[there]
                out[hit] += self._gain(self.n_top[top], self.rest_top[top], self.top, (np.repeat(size_alike, size_alike)[hit] * mine[there]))
        if self.order > 2:
            place, ok = _find(self.contexts, key)
            if ok.any():
                out += np.where(ok[bigram] & more, self.context_weight[place[bigram]], 0.0)
        return out


def _send(frames, order: int, shards: int, blocks: int, turn: int, rounds: int, known: Known) -> Iterator[pd.DataFrame]:
    """Blocks of documents' words and of n-grams that may add to them, by shard; of shards whose turn it is."""
    ngrams, words, keys, trust, size, sent = [], [], [], [], 0, 0
    part_id = TaskContext.get().partitionId()

    def send():
        out, row, t = [], np.array(keys, np.int64), np.array(trust, bool)
        chunk = part_id << 32 | sent

        def add(kind, shard, *data):
            if not out:  # the texts' keys go along once
                data = (*data, row.tobytes())
            out.append((shard, (part_id + sent) % blocks, chunk, pickle.dumps((kind, len(row), *data))))

        for kind, held in ((2, ngrams), (1, words)):
            *cols, doc, more, s = (np.concatenate(c) for c in zip(*held, strict=True))
            for k in np.unique(s).tolist():
                a = s == k
                d, m = doc[a], more[a]
                if kind == 2:
                    packed, order_by = _pack(*(c[a] for c in cols), d)
                    add(kind, k, _bits(t), packed, _bits(m[order_by]))
                    continue
                names, at = np.unique(cols[0][a], return_inverse=True)
                pair, at, n = np.unique(at * len(row) + d, return_inverse=True, return_counts=True)
                name = pair // len(row)
                starts = _starts(name)
                last = n - np.bincount(at, m, len(pair)).astype(np.int64)
                add(kind, k, _rising(names), _planes(np.diff(np.append(starts, len(pair)))), _rising(pair % len(row), starts), _planes(n), _planes(last))
        return pd.DataFrame(out, columns=["shard", "block", "chunk", "data"])

    for f in frames:
        for begin, part in chunks(f["text"], lower=True):
            u, v, w, doc, more = _ngrams(part, order)
            doc = doc + len(keys)
            for held, key, cols in ((ngrams, _pair(v, w), (u, v, w)), (words, w, (w,))):
                s = _shard(key, shards)
                a = np.flatnonzero(s % rounds == turn)
                if held is ngrams:
                    a = a[known.may_have(key[a], s[a])]
                held.append(tuple(c[a] for c in (*cols, doc, more, s)))
            keys += f["key"].iloc[begin : begin + len(part)].tolist()
            trust += f["trusted"].iloc[begin : begin + len(part)].tolist()
            size += len(ngrams[-1][0]) + len(words[-1][0]) // 3
            if size >= SEND_ROWS or len(keys) >= SEND_ROWS:
                yield send()
                ngrams, words, keys, trust, size, sent = [], [], [], [], 0, sent + 1
    if any(len(x[0]) for x in (*ngrams, *words)):
        yield send()


def _answer(left: pd.DataFrame, right: pd.DataFrame, *model) -> pd.DataFrame:
    """Summed values of each document in a shard, one row a block; trusted documents don't count their own n-grams."""
    out, m = [], Model(right, *model)
    for chunk, b in zip(left["chunk"], left["data"], strict=True):
        kind, docs, *data = pickle.loads(b)
        if kind == 1:
            names, runs, doc, n, last, *keys = data
            runs = _unplanes(runs).astype(np.int64)
            doc = _unrising(doc, np.cumsum(runs) - runs).astype(np.int64)
            n, last = _unplanes(n).astype(np.int64), _unplanes(last).astype(np.int64)
            log, weight = m.of_words(_unrising(names))
            gain = n * np.repeat(log, runs) + (n - last) * np.repeat(weight, runs)
        else:
            trusted, packed, more, *keys = data
            *ngrams, doc = _unpack(*packed)
            gain = m.of_ngrams(*ngrams, doc, _unbits(more, len(doc)), _unbits(trusted, docs)[doc])
        gain = np.bincount(doc, gain, docs)
        hit = np.flatnonzero(gain)
        out.append((chunk, _rising(hit), gain[hit].tobytes(), keys[0] if keys else None))
    return pd.DataFrame(out, columns=["chunk", "docs", "gains", "keys"])


def _sum_chunk(f: pd.DataFrame) -> pd.DataFrame:
    """Gains of each document of a chunk over all shards."""
    key = np.frombuffer(next(b for b in f["keys"] if b is not None), np.int64)
    doc = np.concatenate([_unrising(b) for b in f["docs"]]).astype(np.int64)
    gain = np.bincount(doc, np.concatenate([np.frombuffer(b) for b in f["gains"]]), len(key))
    return pd.DataFrame({"key": key, "gain": gain})


def _freed(fn, *args) -> pd.DataFrame:
    """A group's result; the memory that it took goes back to the system."""
    (out,) = released(fn(*a) for a in [args])
    return out


def perplexity(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 2
) -> DataFrame:
    """``doc_id, lang, n_words, trusted, log_perplexity`` of every document under a model of the trusted ones.

    ``trusted`` has the ids (column ``doc_id``), ``order`` is 2 or 3. All trusted text is counted and every word of every
    document scored, a trusted document without its own n-grams' counts (of its bigrams in order 3: without its distinct
    words before them). Words are lower-cased in ASCII and parted by ASCII white space. Log perplexity is null without
    words, or without any trusted text.
    """
    ids = store(trusted.select(F.col("doc_id").alias("id"), F.lit(True).alias("trusted")).filter("id is not null").distinct())
    d = bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    d = lookup(d.withColumn("key", row_key("id", "text")), ids, "id").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    good = d.filter("trusted").select("text")

    def n_words(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in it:
            yield pd.Series([n for _, part in chunks(texts) for n in np.diff(_split(part)[3]).tolist()], dtype="int64")

    n_words.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    each = store(d.select("id", "lang", "key", "trusted", F.pandas_udf(n_words, "long")("text").alias("n")))
    size = each.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("trusted"), F.col("n"))).alias("good")).first()
    shards = max(1, -(-(size["good"] or 0) // SHARD_ROWS))
    rounds = min(ROUNDS, shards)
    shards = -(-shards // rounds) * rounds
    most = FILTER_BITS * rounds // shards
    blocks = max(1, -(-(size["all"] or 0) // (shards * BLOCK_ROWS)))
    table = good.mapInPandas(lambda it: released(_counts(it, order, shards)), "shard long, data binary").groupBy("shard")
    table = store(table.applyInPandas(lambda f: _freed(_merge, f, order, most), "shard long, data binary, known binary, " + ", ".join(f"{c} long" for c in _TYPES)))
    of = table.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TYPES]).first()
    top, low = (_discounts(*(of[f"{t}{k}"] for k in (1, 2, 3, 4))) for t in ("top", "low"))
    told, asks = [], min(ASKS, shards)
    for turn in range(asks):
        asked = table.select("shard", "data").mapInPandas(
            lambda it, turn=turn: released(_ask(it, order, shards, top, low, turn, asks)), "owner long, kind int, asker long, data binary"
        )
        answers = asked.groupBy("owner", "kind").applyInPandas(lambda f: _freed(_tell, f), "shard long, kind int, owner long, data binary, words long, first double")
        told.append(store(answers))
    tables, told = [table, *told], reduce(DataFrame.unionByName, told)
    whole = told.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.sum("first"), F.lit(0.0)).alias("first")).first()
    model = (order, shards, top, low, of["bigrams"], whole["words"])
    right = told.select("shard", "kind", "owner", "data").unionByName(
        table.select("shard", F.lit(0).alias("kind"), F.col("shard").alias("owner"), "data")
    )
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    parts = []
    for turn in range(rounds):  # the documents' n-grams are many times the model: only some shards' lie on disk at a time
        mine = (F.col("shard") % rounds) == turn
        filters = {r["shard"]: bytes(r["known"]) for r in table.filter(mine).select("shard", "known").collect()}
        known = docs.sparkSession.sparkContext.broadcast(Known(filters, shards))
        sent = d.select("key", "text", "trusted").mapInPandas(
            lambda it, turn=turn, known=known: released(_send(it, order, shards, blocks, turn, rounds, known.value)),
            "shard long, block long, chunk long, data binary",
        )
        own = right.filter(mine)
        gains = sent.groupBy("shard", "block").cogroup(own.groupBy("shard", "block")).applyInPandas(
            lambda a, b: _freed(_answer, a, b, *model), "chunk long, docs binary, gains binary, keys binary"
        )
        gains = gains.groupBy("chunk").applyInPandas(_sum_chunk, "key long, gain double")
        parts.append(store(gains.groupBy("key").agg(F.sum("gain").alias("gain"))))
        known.destroy()
    drop(*tables)
    gains = reduce(DataFrame.unionByName, parts).groupBy("key").agg(F.sum("gain").alias("gain"))
    copies = each.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))  # equal rows were summed up together
    gains = gains.join(copies, "key").select("key", (F.col("gain") / F.col("copies")).alias("gain"))
    out = each.join(gains, "key", "left")
    any_trusted = F.lit(bool(whole["words"]))
    score = F.when((F.col("n") > 0) & any_trusted, -(F.lit(float(whole["first"])) + F.coalesce("gain", F.lit(0.0))) / F.col("n"))
    return out.select(F.col("id").alias("doc_id"), "lang", F.col("n").alias("n_words"), "trusted", score.alias("log_perplexity"))


def quality_model(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang, n_words, log_perplexity, threshold, kept`` for every document.

    A document is kept if its log perplexity is at most its language's threshold, the ``QUANTILE`` of the trusted
    documents in that language and ``MARGIN``, and an allowance for few words. Without trusted text in a language the
    threshold is null and documents with words are kept; documents without words are not. A null language is one of its
    own; repeated rows each get their row; other columns are ignored.
    """
    p = store(perplexity(docs, trusted, id_col, text_col, lang_col, ORDER))
    slack = SPREAD / F.sqrt(F.greatest("n_words", F.lit(1)))
    good = p.filter("trusted and log_perplexity is not null").withColumn("over", F.col("log_perplexity") - slack)
    limits = good.groupBy(row_key("lang").alias("_k")).agg((F.percentile_approx("over", QUANTILE, 10_000) + MARGIN).alias("limit"))
    p = lookup(p.withColumn("_k", row_key("lang")), store(limits), "_k")
    threshold = F.col("limit") + slack
    kept = (F.col("n_words") > 0) & F.coalesce(F.col("log_perplexity") <= threshold, F.lit(True))
    return p.select("doc_id", "lang", "n_words", "log_perplexity", threshold.alias("threshold"), kept.alias("kept"))


def op8_quality_model(spark, sf: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    trusted = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    return quality_model(spark.read.parquet(f"{sf}/documents.parquet"), trusted)
