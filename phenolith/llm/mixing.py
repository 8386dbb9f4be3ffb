"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target in words; whole copies of its documents fill most of it, and what is left
is a subset-sum problem over the counts of documents by exact length: bounded-knapsack dynamic
programming picks how many documents of each length are taken once more, and a seeded order says which.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_parts, written

#: Words of a source's budget that dynamic programming fits at the end; the rest is filled in proportion to the counts.
DP_WORDS = 1 << 15
#: Parts by hash into which the documents of one source and length are dealt.
BUCKETS = 256


def fit(lengths: np.ndarray, counts: np.ndarray, budget: float, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to budget (at most the sum of all).

    Exact where dynamic programming reaches the budget, else the nearest sum it reaches.
    """
    order = np.argsort(lengths)
    length, count = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    all_words = int((length * count).sum())
    goal = min(int(round(budget)), all_words)
    taken = np.floor(count * max(0.0, (goal - dp_words) / max(1, all_words))).astype(np.int64)
    rest = goal - int((length * taken).sum())
    for k in range(len(length) - 1, -1, -1):  # longest first, as long as dp_words are left
        if length[k] and rest > dp_words:
            more = min(int(count[k] - taken[k]), (rest - dp_words) // int(length[k]))
            taken[k] += more
            rest -= more * int(length[k])
    free = count - taken
    cap = 2 * rest + 1  # sums above that are farther off than taking none
    sums, steps, mask = 1, [], (1 << cap) - 1
    for k in range(len(length)):
        w, n, chunk = int(length[k]), int(free[k]), 1
        if not w or w >= cap or sums >> rest & 1:
            continue
        n = min(n, cap // w)
        while n and not sums >> rest & 1:
            part = min(chunk, n)
            steps.append((k, part, sums))
            sums = (sums | sums << w * part) & mask
            n, chunk = n - part, chunk * 2
    below = (sums & ((1 << rest + 1) - 1)).bit_length() - 1
    above = sums >> rest
    above = rest + (above & -above).bit_length() - 1 if above else -1
    at = above if above >= 0 and above - rest < rest - below else below
    for k, part, before in reversed(steps):
        if not before >> at & 1:
            taken[k] += part
            at -= part * int(length[k])
    out = np.empty_like(taken)
    out[order] = taken
    return out


def _ranked(sources: DataFrame) -> DataFrame:
    """sources with rank: its place by code point, null last; places come from sorted partitions and their counts."""
    parts = shuffle_parts(sources.sparkSession)
    dealt = written(sources.repartitionByRange(parts, "no_src", "src").withColumn("part", F.spark_partition_id()), "mix-sources")
    before, total = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in dealt.groupBy("part").agg(F.count("*").alias("n")).collect()):  # a row per partition
        before[part], total = total, total + n
    offset = F.create_map(*(F.lit(x) for kv in before.items() for x in kv))[F.col("part")] if before else F.lit(0)
    return dealt.withColumn("rank", offset + F.row_number().over(Window.partitionBy("part").orderBy("no_src", "src")) - 1).drop("part")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(no_src, src, source_size) with target: shares of budget times all sizes by weight, held at cap times the source's size, the excess reshared by weight until none is above. The driver sees sums only."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(_ranked(sources).withColumn("w", w), "mix-ranked")
    want = budget * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, held = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("w") * level > cap * F.col("source_size")
        words, open_w, n = ranked.agg(F.sum(F.when(above, F.col("source_size")).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("w"))), F.count_if(above)).first()
        if n == held or not open_w:
            break
        held, level = n, (want - cap * (words or 0)) / open_w
    full = cap * F.col("source_size")
    return ranked.select("no_src", "src", "source_size", F.least(F.col("w") * F.lit(float(level or 0.0)), full).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken): one row per row of docs.

    size counts the words [^\\x20\\x09-\\x0D]+ (null text: 0); taken is size times the copies taken, 0 to
    cap of them. Null sources are one source, the last. Repeated rows are documents of their own.
    Reruns take the same documents: their order is a hash of id and seed. Groups of one source and
    length are dealt into BUCKETS parts by a hash of id and text, so neither a group of copies nor the
    rows without an id are ranked in one task.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[source_col].isNull().alias("no_src"), F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("src"), size.alias("size"), F.xxhash64(text).alias("text_hash"))
    sized = written(rows.withColumn("h", F.xxhash64(F.lit(seed), "id")).withColumn("b", F.pmod(F.xxhash64("h", "text_hash"), F.lit(BUCKETS)).cast("int")), "mix-sized")
    per_bucket = written(sized.groupBy("no_src", "src", "size", "b").agg(F.count("*").alias("n")), "mix-counts")
    by_length = per_bucket.groupBy("no_src", "src", "size").agg(F.sum("n").alias("n"))
    target = targets(by_length.groupBy("no_src", "src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, budget, cap)

    def plan(rows: pd.DataFrame) -> pd.DataFrame:  # a row per length of one source
        goal, words = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
        copies = int(goal // words) if words else 0
        extra = fit(rows["size"].to_numpy(), rows["n"].to_numpy(), goal - copies * words) if words and copies < cap else np.zeros(len(rows), np.int64)
        return rows.assign(copies=copies, extra=extra)[["no_src", "src", "size", "source_size", "target", "copies", "extra"]]

    plans = by_length.join(target, ["no_src", "src"]).groupBy("no_src", "src").applyInPandas(plan, "no_src boolean, src string, size long, source_size long, target double, copies long, extra long")
    key = ["no_src", "src", "size"]
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    dealt = per_bucket.join(plans, key).withColumn("take", F.greatest(F.lit(0), F.least("n", F.col("extra") - before))).drop("n", "extra")
    place = F.row_number().over(Window.partitionBy(*key, "b").orderBy("h", "id", "text_hash"))
    copies = F.col("copies") + (F.col("place") <= F.col("take")).cast("long")
    found = sized.join(dealt, [*key, "b"]).withColumn("place", place).withColumn("copies", copies)
    return found.select("id", F.when(~F.col("no_src"), F.col("src")).alias("source"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", **options: object) -> DataFrame:
    """The rows of docs, all columns unchanged, each as often as mix() takes it. Rows that share an id (null too) are taken as often as the least taken of them."""
    chosen = mix(docs, id_col, **options).groupBy("id").agg(F.min("copies").alias("copies")).where("copies > 0")
    # the columns of docs travel in one struct, so that none of them can clash
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("doc"), docs[id_col].cast("long").alias("of"))
    return rows.join(chosen, F.col("of").eqNullSafe(F.col("id"))).select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
