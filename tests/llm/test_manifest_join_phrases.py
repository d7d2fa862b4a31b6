"""Merkle manifest, n-gram join and collocations against brute force on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from test_llm import DOCS, bag, odd_docs, shingles

from respira.llm import collocations, merkle_manifest, ngram_join
from respira.llm.common import LOWER

SF = "/root/testdata/sf0.001"
UPPER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def odd(spark):
    return odd_docs(spark)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------------------------------------ Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        x = out[-1]
        out.append([digest(*x[i : i + 8]) for i in range(0, len(x), 8)])
    return out


def plain_manifest(rows):
    """``(doc_id, source, lang, n_chars, text)`` to the query's rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r, leaf(*r)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = levels([x[1] for x in groups[g]])
    top, out = levels([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for i, (r, own) in enumerate(groups[g]):
            path = []
            for tree, j in ((trees[g], i), (top, k)):
                for level in tree[:-1]:
                    a = j // 8 * 8
                    path.append((level[a:j], level[j + 1 : a + 8]))
                    j //= 8
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            up = leaf(*r[:4], r[4].translate(UPPER)) if hit else own
            for before, after in path:
                up = digest(*before, up, *after)
            proof = digest(*[x for before, after in path for x in before + after])
            out.append((r[0], own, trees[g][-1][0], top[-1][0], proof, up, up == top[-1][0]))
    return out


def write(docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("digits", [4, 1])
def test_manifest(spark, odd, tmp_path, monkeypatch, digits):
    """With one digit a block, the tree has three tiers."""
    monkeypatch.setattr(merkle_manifest, "DIGITS", digits)
    monkeypatch.setattr(merkle_manifest, "RANGE_ROWS", 40)
    big = spark.createDataFrame([(2**60 + 1, "ABC", "en"), (2**60 + 3, "Abd", "en"), (7, "one", "x")], "doc_id long, text string, lang string")
    more = spark.read.parquet(f"{SF}/documents.parquet")
    docs = odd.unionByName(big, allowMissingColumns=True).unionByName(more, allowMissingColumns=True)
    got = merkle_manifest.op11_merkle_manifest(spark, write(docs, tmp_path)).collect()
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert bag(got) == bag(plain_manifest(rows))
    assert {r.verified for r in got} == {True, False}


def test_manifest_edges(spark, none):
    assert merkle_manifest.manifest(none).count() == 0
    one = spark.createDataFrame([(None, None)], "doc_id long, text string")
    r = merkle_manifest.manifest(one, group_col="text", fields=("doc_id", "text")).first()
    assert r.leaf == r.subroot == r.root == r.folded_root == digest("--") and r.verified and r.proof == []


# --------------------------------------------------------------------------------------------------- n-gram join


def plain_components(rows, k, percent):
    """Smallest id reachable for every row, by all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(low[r], d)
    return [(d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.mark.parametrize(("k", "percent", "rare"), [(3, 90, 64), (3, 90, 1), (1, 60, 3)])
def test_ngram_join(spark, odd, none, monkeypatch, k, percent, rare):
    """With few rare tokens most keys are pairs of frequent ones."""
    monkeypatch.setattr(ngram_join, "RARE", rare)
    monkeypatch.setattr(ngram_join, "MEET", 3)
    rng = random.Random(5)
    base, texts = [f"v{i}" for i in range(60)], []
    for _ in range(60):
        t = list(base)
        for i in rng.sample(range(60), rng.randrange(5)):
            t[i] = rng.choice(["new", "other", f"z{rng.randrange(40)}"])
        texts.append(" ".join(t[: rng.choice([60, 60, 58, 55])]))
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    big = spark.createDataFrame([(2**60 + 1 + 2 * i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd.unionByName(big, allowMissingColumns=True)
    got = ngram_join.ngram_join(docs, words=k, percent=percent).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert bag(got) == bag(plain_components(rows, k, percent))
    assert ngram_join.ngram_join(none).count() == 0


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x, y = (np.unique(rng.integers(0, 3000, rng.integers(1, 900))).astype(np.uint64) << np.uint64(40) for _ in range(2))
        differ = int(np.bitwise_count((ngram_join.parity(x) ^ ngram_join.parity(y)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(x, y))


def test_candidates_of_long_texts_and_equal_keys(spark, none):
    """Long texts pass on full bits only; keys with the same members give each pair once."""
    rng = np.random.default_rng(2)
    common = rng.integers(0, 2**63, 1600).astype(np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 2**63, 400).astype(np.uint64))) for _ in range(2)]
    sets += [common[:100], common[:99]]
    rows = [(i, len(x), ngram_join.parity(x).tolist()) for i, x in enumerate(sets)]
    nodes = spark.createDataFrame(rows, "node long, n long, bits array<long>")
    members = spark.createDataFrame([(k, i, 3) for k in range(20) for i in range(2 * (k % 2), 2 * (k % 2) + 2)], "key long, node long, size long")
    comp = spark.createDataFrame([], "node long, component long")
    join = ngram_join.Join(none, "doc_id", "text", 3, 90)
    assert [tuple(r) for r in join.candidates(members, comp, nodes).collect()] == [(2, 3)]


def test_inner_tables_are_deleted(spark):
    """Tokens and texts that only lead to keys and links leave the disk with them."""
    held, store = [], ngram_join.store
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ngram_join, "store", lambda d: held.append(store(d)) or held[-1])
        docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g h")], "doc_id long, text string")
        assert [r.component_id for r in ngram_join.ngram_join(docs, words=1, percent=80).collect()] == [1, 1]
    gone = [d for d in held if d.columns == ["node", "text"]]
    assert gone and not any(Path(d.inputFiles()[0].removeprefix("file://")).exists() for d in gone)


def test_join_percent(spark, none):
    with pytest.raises(ValueError):
        ngram_join.ngram_join(none, percent=50)


# --------------------------------------------------------------------------------------------------- collocations


def plain_collocations(rows, least, most):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOWER).decode()):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang in f:
        often = {p: a for p, a in f[lang].items() if a >= least}
        found = []
        for p, a in often.items():
            inside = any(often[q] >= a for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if len(p) > 1 and not inside:
                score, k = min((1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), often[p[:k]], often[p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -s))
    return out


@pytest.mark.parametrize(("least", "most", "small"), [(3, 40, False), (2, 2000, True)])
def test_collocations(spark, odd, none, monkeypatch, least, most, small):
    """Small limits give many blocks, slices of tries and ranked parts."""
    if small:
        monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
        monkeypatch.setattr(collocations, "SLICE", 40)
        monkeypatch.setattr(collocations, "RANK_ROWS", 30)
    rng = random.Random(4)
    made = []
    for i in range(60):
        t = [rng.choice(["New", "york", "a", "of", "É", "b's"]) + rng.choice([" ", " ", "\t", ", ", ".\n", "\x0b", " ", "\r"]) for _ in range(40)]
        made.append((2**60 + i, "".join(t), rng.choice(["en", None, "und", ""])))
    made += [(None, "z " * 30, "en"), (None, " \t. ;", "de"), (None, "x" * 3000 + " y", "fr")]
    docs = odd.unionByName(spark.createDataFrame(made, "doc_id long, text string, lang string"), allowMissingColumns=True)
    got = collocations.collocations(docs, least=least, most=most).collect()
    rows = [tuple(r) for r in docs.select("text", "lang").collect()]
    assert bag(got) == bag(plain_collocations(rows, least, most)) and len(got) > 50
    assert collocations.collocations(none).count() == 0


def test_rare_candidates_are_not_stored(spark, monkeypatch):
    """Most candidates are rare; only those that reach ``least`` take disk."""
    held, store = [], collocations.store
    monkeypatch.setattr(collocations, "store", lambda d: held.append(store(d)) or held[-1])
    rng = random.Random(3)
    docs = [(" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300)) + " x y" * 20, "en") for _ in range(4)]
    counts, _ = collocations.phrase_counts(spark.createDataFrame(docs, "text string, lang string"), "text", "lang", 20)
    found = [d for d in held if "head" in d.columns]
    assert len(found) == collocations.LONGEST - 1 and counts.count()
    assert all(d.filter("f < 20").isEmpty() for d in found) and not found[0].isEmpty()


def test_scores_pass_64_bits(spark):
    """Products of counts are exact beyond 64 bits, as the query's expression computes them."""
    f, n, x, y = 9_876_543_211, 98_765_432_109_877, 9_876_543_299, 12_345_678_901
    d = spark.createDataFrame([(f, n, x, y)], "f long, n long, l long, r long")
    got = d.selectExpr("(cast(1000 as decimal(38, 0)) * f * n) div (cast(l as decimal(38, 0)) * r) as s").first().s
    assert got == 1000 * f * n // (x * y)


def test_double_array():
    rng = np.random.default_rng(2)
    for depth in (1, 2, 4):
        phrases = np.unique(rng.integers(1, 30, (400, depth)), axis=0).astype(np.uint64) * np.uint64(977)
        t = collocations.Trie(phrases, np.arange(len(phrases)) + 5)
        known = {tuple(p): i + 5 for i, p in enumerate(phrases.tolist())}
        text = rng.integers(0, 33, 5000).astype(np.uint64) * np.uint64(977)
        got = t.find(t.codes(text), depth)
        want = [known.get(tuple(text[i : i + depth].tolist()), -1) for i in range(len(text))]
        assert got.tolist() == want
