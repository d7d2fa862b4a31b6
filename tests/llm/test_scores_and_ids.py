"""Language scores against a plain restatement; ids beyond doubles beside nulls."""

import math
import os
import random
import threading
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from respira.llm import language_id, packing, quality_model, source_mixing
from respira.llm.common import checkpoint_dir, released, store

BIG = [2**60 + 1, None, 2**60 + 3]


def test_scores_by_words_then_shorter_ngrams(spark):
    rng = random.Random(6)
    words = {x: ["".join(rng.choice(a) for _ in range(rng.randrange(1, 8))) for _ in range(60)] for x, a in (("de", "abcdß"), ("en", "abcdé"), ("fr", "bcdef𝒳"))}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randrange(1, 40))), x) for i in range(90) for x in [rng.choice("de en fr".split())]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_id.train(docs)
    counts = defaultdict(lambda: defaultdict(Counter))
    for _, text, lang in rows:
        for w in language_id.words_of(text):
            counts[0][lang][w] += 1
            for k in language_id.GRAM_LENGTHS:
                counts[k][lang].update(f" {w} "[i : i + k] for i in range(len(w) + 3 - k))
    langs = ["de", "en", "fr"]
    items = {k: set().union(*counts[k].values()) for k in counts}
    total = {k: {x: counts[k][x].total() + 0.5 * len(items[k]) for x in langs} for k in counts}

    def log(k, item):
        return [math.log((counts[k][x][item] + 0.5) / total[k][x]) for x in langs]

    def score(w):
        if w in items[0]:
            s = log(0, w)
            return [x - max(s) for x in s]
        for step, k in enumerate(language_id.GRAM_LENGTHS):
            found = [log(k, g) for g in (f" {w} "[i : i + k] for i in range(len(w) + 3 - k)) if g in items[k]]
            if found:
                s = [sum(c) / len(found) for c in zip(*found, strict=True)]
                return [(x - max(s)) * 0.7 ** (step + 1) for x in s]
        return [0.0] * 3

    asked = ["abc", "ßßß", "zzzz", "éa𝒳", "q", "b", rows[0][1].split()[0], "abcdabcdabcd", "c" * 9000]
    for w, s in zip(asked, got.score(asked), strict=True):
        assert s.tolist() == pytest.approx(score(w), abs=1e-4), w
    texts = [r[1] for r in rows[:20]] + ["abc ßß zz", "", None, "12 3"]
    for t, (lang, p) in zip(texts, language_id.Predictor(got).predict(texts), strict=True):
        ws = language_id.words_of(t)
        if not ws:
            assert (lang, p) == ("und", 0.0)
            continue
        sums = [sum(c) * min(1, 20 / len(ws)) for c in zip(*map(score, ws), strict=True)]
        assert p == pytest.approx(1 / sum(math.exp(x - max(sums)) for x in sums), abs=1e-3)
        assert sums[langs.index(lang)] == pytest.approx(max(sums), abs=1e-3)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ids_stay_intact(spark, kind):
    docs = spark.createDataFrame([(i, f"some words here {k}", "en", "a") for k, i in enumerate(BIG)], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("doc_id", docs["doc_id"].cast(kind)).coalesce(1)
    want = {None if i is None else str(i) for i in BIG}
    trusted = docs.select("doc_id")
    for out in (packing.pack(docs), source_mixing.mix(docs), quality_model.quality_model(docs, trusted), language_id.language_id(docs)):
        assert dict(out.dtypes)["doc_id"] == docs.dtypes[0][1]
        assert {None if r.doc_id is None else str(r.doc_id) for r in out.select("doc_id").collect()} == want


def test_quality_model_on_disk(spark, monkeypatch):
    """Shuffle files and stored tables of the classifier stay small beside its words, at every moment."""
    monkeypatch.setattr(quality_model, "SHARD_ROWS", 25_000)
    rng = np.random.default_rng(8)
    words = np.array([f"word{i}" for i in range(60_000)])
    texts = [" ".join(words[np.minimum(rng.zipf(1.2, 500), 60_000) - 1]) for _ in range(800)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    docs = store(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2))
    trusted = spark.createDataFrame([(i,) for i in range(0, 800, 3)], "doc_id long")
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [*local, checkpoint_dir(spark).removeprefix("file:")]

    def used():
        total = 0
        for f in folders:
            for at, _, files in os.walk(f):
                for name in files:
                    try:
                        total += os.path.getsize(os.path.join(at, name))
                    except OSError:
                        pass
        return total

    before, peak, ended = used(), [0], threading.Event()

    def watch():
        while not ended.wait(0.02):
            peak[0] = max(peak[0], used())

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        assert quality_model.perplexity(docs, trusted, order=3).filter("log_perplexity > 0").count() == 800
    finally:
        ended.set()
        thread.join()
    assert peak[0] - before < 12 * 500 * 800


def test_store_deletes_shuffle_files(spark):
    """What a stored table was shuffled by goes with the write; the session's own setting stays."""

    def files():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    before, name = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    out = store(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert out.count() == 1000 and spark.conf.get(name) == "false"


def test_memory_goes_back_at_the_end():
    """A worker that used much small memory is as small as before, once its batches have ended."""

    def batches():
        held = [np.zeros(2000) for _ in range(20_000)]
        yield len(held)

    def rss():
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 / 1e6

    keep, before = [], rss()
    for _ in released(batches()):
        keep.append([np.zeros(2000) for _ in range(10)])  # lies above the batch, which alone can't shrink the heap then
    assert rss() - before < 100
