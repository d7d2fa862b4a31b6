"""Secret scan with corpus-wide ownership: widely copied values are examples, values of one owner look live."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.llm.common import bounded_batches, fresh, released, row_key, small, store

# Patterns of the base kinds, in order. Length limits stand in the quantifier where that is the same.
BASE = {
    "assign": re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]{14,}"),
    "hex": re.compile(r"[0-9a-f]{16,}"),
}
MIN_ASSIGNED = 12
# Published shapes of provider credentials, which the method adds where their owners show them live.
MORE = {
    "github": re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    "google": re.compile(r"\bAIza[A-Za-z0-9_-]{35}"),
    "stripe": re.compile(r"\b[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    "jwt": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "basic": re.compile(r"\b[a-z][a-z0-9+.-]{1,10}://[^\s/:@]{1,64}:([^\s/:@]{8,64})@"),
    "pem": re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[^-]{32,}-----END"),
}
KINDS = [*BASE, *MORE]
#: A value that more owners or repositories than these have is a copied example.
MAX_OWNERS = 2
MAX_REPOS = 5

_CANDIDATE = "kind int, start int, end int, hash long, base boolean"


def candidates(text: str | None) -> list[tuple[int, int, int, int, bool]]:
    """``(kind, start, end, hash of the value, base)`` in code points, by start and kind; null counts as empty."""
    out = []
    for rank, kind in enumerate(KINDS):
        pattern = BASE.get(kind) or MORE[kind]
        for m in pattern.finditer(text or ""):
            value = m[2] if kind == "assign" else m[1] if kind == "basic" else m[0]
            if kind == "assign" and len(value) < MIN_ASSIGNED:
                continue
            h = hashlib.blake2b(value.encode(), digest_size=8).digest()
            out.append((rank, m.start(), m.end(), int.from_bytes(h, "big", signed=True), kind in BASE))
    return sorted(out, key=lambda x: (x[1], x[0]))


def _found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    names = [x.split()[0] for x in _CANDIDATE.split(", ")]
    return released(pd.Series([[dict(zip(names, c, strict=True)) for c in candidates(t if isinstance(t, str) else None)] for t in b]) for b in batches)


def _found_column(text: Column) -> Column:
    fields = ",".join(x.replace(" ", ":") for x in _CANDIDATE.split(", "))
    return F.pandas_udf(_found, f"array<struct<{fields}>>")(text)


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_repos, n_owners`` over the whole corpus, from ``hash, repo, owner`` rows.

    Distinct triples are summed up before each shuffle, so a value that fills a third of the corpus sends one row a task
    and owner.
    """
    pairs = found.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("_"))
    owners = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def _scanned(docs: DataFrame, id_col: str, text_col: str, owner: Column, repo: Column) -> tuple[DataFrame, DataFrame]:
    """Stored candidates of every row, and for every row key the verdicts on its candidates."""
    d = bounded_batches(docs).select(
        F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), owner.alias("owner"), repo.alias("repo"),
        _found_column(F.col(text_col)).alias("found"),
    )
    d = store(d)
    each = d.select("key", "owner", "repo", F.explode("found").alias("c")).select("key", "owner", "repo", "c.*")
    owned = store(ownership(each.select("hash", "owner", "repo")))
    copied = store(owned.filter((F.col("n_owners") > MAX_OWNERS) | (F.col("n_repos") > MAX_REPOS)).select("hash", F.lit(True).alias("copied")))
    # Values found often are the copied ones; those alone could make a hot key, and a row of theirs stays put where they fit.
    one = each.select("key", "kind", "start", "end", "hash", "base").distinct()
    j = one.join(F.broadcast(copied) if small(copied) else copied, "hash", "left")
    span = F.struct("start", F.col("kind").alias("rank"), "end")
    live = F.col("copied").isNull()
    verdicts = j.groupBy("key").agg(
        F.array_sort(F.collect_list(F.when(F.col("base") | live, span))).alias("all"),
        F.count(F.when(live, 1)).alias("n_live"), F.count(F.when(~live, 1)).alias("n_example"),
    )
    return d, verdicts


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"], s["end"])), ",")


def _how_many(rank: int) -> Column:
    return F.size(F.filter("found", lambda c: c["kind"] == rank)).cast("long")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
                repo: Column | None = None) -> DataFrame:
    """One row a document with counts and spans of its secrets (``kind:start:end``, code points, end exclusive).

    Base kinds always stay. Further credential shapes are added where the value looks live: at most ``MAX_OWNERS``
    owners and ``MAX_REPOS`` repositories have it anywhere in the corpus. By default the owner is the document's source
    and the repository that source's part in one language. Null and empty texts have no spans and an empty list's hash;
    equal rows get equal rows; a null owner or repository counts as one of its own; other columns are ignored.
    """
    owner = F.col("source") if owner is None else owner
    repo = F.struct("source", "lang").cast("string") if repo is None else repo
    d, verdicts = _scanned(docs, id_col, text_col, owner, repo)
    kinds = {f"n_{k}": _how_many(i) for i, k in enumerate(BASE)}
    base = F.transform(F.filter("found", lambda c: c["base"]), lambda c: F.struct(c["start"], c["kind"].alias("rank"), c["end"]))
    d = d.withColumns(kinds).withColumn("base_sha256", F.sha2(_text(base).cast("binary"), 256))
    rows = d.select("doc_id", "key", *kinds, "base_sha256", (F.size("found") == 0).alias("none"))
    # Rows without a candidate are done; only the others meet their verdicts.
    plain = rows.filter("none").select(
        "doc_id", *kinds, "base_sha256", F.lit("").alias("spans"), F.lit(0).cast("long").alias("n_live"),
        F.lit(0).cast("long").alias("n_example"),
    )
    some = rows.filter("not none").join(verdicts, "key").select(
        "doc_id", *kinds, "base_sha256", _text(F.col("all")).alias("spans"), "n_live", "n_example"
    )
    return plain.unionByName(some)


def _redact(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, spans in batches:
        out = []
        for t, found in zip(texts, spans, strict=True):
            if not isinstance(t, str) or found is None or not len(found):
                out.append(t if isinstance(t, str) else None)
                continue
            parts, at = [], 0
            for s in found:
                if s["start"] >= at:
                    parts += [t[at : s["start"]], "[secret]"]
                at = max(at, s["end"])
            out.append("".join([*parts, t[at:]]))
        yield pd.Series(out, dtype=object)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
           repo: Column | None = None) -> DataFrame:
    """``docs`` with every span of ``secret_scan`` replaced by ``[secret]``; rows without one are not shuffled."""
    owner = F.col("source") if owner is None else owner
    repo = F.struct("source", "lang").cast("string") if repo is None else repo
    d, verdicts = _scanned(docs, id_col, text_col, owner, repo)
    key, spans = fresh(docs, "_key"), fresh(docs, "_spans")
    v = store(verdicts.filter(F.size("all") > 0).select(F.col("key").alias(key), F.col("all").alias(spans)))
    few = small(v, 50_000)
    out = docs.withColumn(key, row_key(id_col, text_col)).join(F.broadcast(v) if few else v, key, "left")
    run = F.pandas_udf(_redact, "string")
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(run(F.col(text_col), F.col(spans)))
    return out.withColumn(text_col, text).select(*docs.columns)


def op3_secret_scan(spark, sf: str) -> DataFrame:
    return secret_scan(spark.read.parquet(f"{sf}/documents.parquet"))
