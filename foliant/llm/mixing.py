"""Mixing sources to target weights, sizes in tokens of a public tokenizer.

Method: subset-sum budget fitting. Documents are counted by source and exact token length. A source is
used whole as often as its budget and its cap on repeats allow; what remains of the budget is fitted
from the counts: first the same share of every length, then, for the last tokens, a bounded-knapsack
dynamic programme over the lengths that are left. Documents of a chosen length are taken by a seeded
hash. Only the counts by length come to the driver, never documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.bpe import with_token_count
from foliant.session import ensure_checkpoint_dir

#: Tokens up to which the last part of a budget is fitted by dynamic programming.
EXACT_WINDOW = 1 << 16
SEED = 20_240
#: Rows that one hash slot of a source and length should hold at most.
ROWS_PER_SLOT = 20_000


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length sum up closest to, and not over, the budget; counts bound each."""
    used = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not len(lengths):
        return used
    items: list[tuple[int, int]] = []  # (which length, how many at once): powers of two and a rest
    for i, (size, n) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        if size <= 0 or size > budget:
            continue
        n, k = min(n, budget // size), 1
        while n > 0:
            k = min(k, n)
            items.append((i, k))
            n -= k
            k *= 2
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    first = np.full(budget + 1, -1, np.int64)  # the item by which a sum was first reached
    for at, (i, k) in enumerate(items):
        w = int(lengths[i]) * k
        if w > budget:
            continue
        fresh = reached[:-w] & ~reached[w:]
        first[w:][fresh] = at
        reached[w:] |= fresh
        if reached[budget]:
            break
    left = int(np.flatnonzero(reached)[-1])
    while left:
        i, k = items[first[left]]
        used[i] += k
        left -= int(lengths[i]) * k
    return used


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = EXACT_WINDOW) -> np.ndarray:
    """How many of each length to take so that their sum comes as close to the budget as it can from below."""
    order = np.argsort(lengths)
    size, left = lengths[order].astype(np.int64), counts[order].astype(np.int64).copy()
    total = int((size * left).sum())
    if budget >= total:
        return counts.astype(np.int64).copy()
    take = np.zeros(len(size), np.int64)
    if budget > window:  # the same share of every length, so that the sample has the source's lengths
        take = (left * (budget - window // 2) // max(1, total)).astype(np.int64)
        left -= take
    rest = budget - int((size * take).sum())
    for i in range(len(size) - 1, -1, -1):  # what rounding left, longest first, down to the window
        if rest <= window:
            break
        if size[i]:
            n = min(int(left[i]), (rest - window // 2) // int(size[i]))
            if n > 0:
                take[i] += n
                left[i] -= n
                rest -= n * int(size[i])
    take += knapsack(size, left, min(rest, window) if rest > window else rest)
    out = np.empty(len(size), np.int64)
    out[order] = take
    return out


PLAN = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("n_tokens", T.LongType()), T.StructField("copies", T.IntegerType()), T.StructField("extra", T.LongType()),
])


def plan(histogram: list[tuple[str, int, int]], targets: list[tuple[str, float, int]]) -> list[tuple[str, int, int, int]]:
    """(source, n_tokens, copies of every document, documents with one copy more) from counts and targets."""
    by: dict[str, list[tuple[int, int]]] = {}
    for source, size, n in histogram:
        by.setdefault(source, []).append((size, n))
    total = sum(size * n for source, share, cap in targets for size, n in by.get(source, ()))
    out = []
    for source, share, cap in targets:
        rows = sorted(by.get(source, ()))
        if not rows or not cap or cap < 0 or not share or share < 0:
            continue
        lengths, counts = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        own = int((lengths * counts).sum())
        budget = round(share * total)
        copies = min(cap, budget // own) if own else cap
        extra = fit_budget(lengths, counts, budget - copies * own) if copies < cap else np.zeros(len(lengths), np.int64)
        out += [(source, int(x), int(copies), int(e)) for x, e in zip(lengths, extra, strict=True)]
    return out


def _sizes(documents: DataFrame, targets: DataFrame, tokenizer: str, folder: str | None) -> DataFrame:
    """(doc_id, source, n_tokens) of the listed sources' documents, kept so that texts are encoded once."""
    ensure_checkpoint_dir(documents.sparkSession)
    listed = targets.filter(F.col("source").isNotNull()).select("source").distinct()
    own = documents.select("doc_id", "source", "text").join(listed, "source", "left_semi")
    return with_token_count(own, "text", tokenizer, folder=folder).select("doc_id", "source", "n_tokens").checkpoint()


def _planned(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    counts = sizes.groupBy("source", "n_tokens").agg(F.count("*").alias("n")).collect()
    wanted = [(r.source, float(r.target_share or 0), int(r.max_repeats or 0)) for r in targets.filter(F.col("source").isNotNull()).groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats")).orderBy("source").collect()]
    return sizes.sparkSession.createDataFrame(plan([(r.source, r.n_tokens, r.n) for r in counts], wanted), PLAN)


def _mixed(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    chosen = _planned(sizes, targets)
    slots = max(16, -(-sizes.count() // ROWS_PER_SLOT))
    # of n documents of a source and length exactly `extra` get one copy more: whole hash slots up to the
    # one in which the number is reached, and only within that slot documents are ranked
    rows = sizes.join(chosen, ["source", "n_tokens"]).withColumn("_h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("_slot", F.pmod("_h", F.lit(slots)).cast("int"))
    some = rows.filter(F.col("extra") > 0)
    per_slot = some.groupBy("source", "n_tokens", "_slot").agg(F.count("*").alias("_n"))
    before = per_slot.selectExpr("source", "n_tokens", "_slot", "_n", "coalesce(sum(_n) OVER (PARTITION BY source, n_tokens ORDER BY _slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    placed = some.join(before, ["source", "n_tokens", "_slot"])
    whole = placed.filter(F.col("_before") + F.col("_n") <= F.col("extra")).withColumn("_more", F.lit(1))
    edge = placed.filter((F.col("_before") < F.col("extra")) & (F.col("_before") + F.col("_n") > F.col("extra")))
    ranked = edge.selectExpr("*", "row_number() OVER (PARTITION BY source, n_tokens, _slot ORDER BY _h, doc_id) AS _rank")
    cut = ranked.withColumn("_more", (F.col("_rank") <= F.col("extra") - F.col("_before")).cast("int"))
    names = ["doc_id", "source", "n_tokens", "copies", "_more"]
    none_more = rows.filter(F.col("extra") == 0).withColumn("_more", F.lit(0))
    skipped = placed.filter(F.col("_before") >= F.col("extra")).withColumn("_more", F.lit(0))
    every = none_more.select(names).unionByName(whole.select(names)).unionByName(cut.select(names)).unionByName(skipped.select(names))
    return every.withColumn("copies", (F.col("copies") + F.col("_more")).cast("int")).filter(F.col("copies") > 0).drop("_more")


def mixture(documents: DataFrame, targets: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, n_tokens, copies): each document used, with the number of times it is used.

    A source's budget is target_share of all tokens of the listed sources' documents. A source without
    documents contributes nothing; one too small for its budget under its cap falls short, and both show
    in ``shares``. Documents of no listed source or of a null one are left out; null and empty texts have
    size 0. Same inputs and seed give the same mixture. Rows of equal doc_id count as documents of their own.
    """
    return _mixed(_sizes(documents, targets, tokenizer, folder), targets, seed)


def shares(documents: DataFrame, targets: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str | None = None, seed: int = SEED) -> DataFrame:
    """One row of each listed source: target and actual tokens and share, documents, most copies of one."""
    sizes = _sizes(documents, targets, tokenizer, folder)
    used = _mixed(sizes, targets, seed).groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("actual_tokens"), F.count("*").alias("n_docs"), F.max("copies").alias("most_copies"))
    total = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    full = targets.filter(F.col("source").isNotNull()).join(used, "source", "left").crossJoin(F.broadcast(total))  # one row: the total
    return full.select(
        "source", "target_share", "max_repeats", F.round(F.col("target_share") * F.col("total")).cast("long").alias("target_tokens"), zero("actual_tokens"),
        F.when(F.col("total") > 0, F.coalesce("actual_tokens", F.lit(0)) / F.col("total")).alias("actual_share"), zero("n_docs"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )
