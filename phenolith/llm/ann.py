"""Approximate nearest neighbours by inner product: inverted lists of coarse centroids, product-quantised residuals, exact reranking.

Centroids and codebooks are fitted on a bounded sample, and the number of probed lists is calibrated on
it; there are about as many lists as the square root of the rows, and every row is indexed. Lists are packed into
blocks of bounded size, crowded ones split, and a query goes to the blocks that hold a list it probes,
once each, in chunks of bounded size. Asymmetric distance tables rank a block's rows, and the best are
rescored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, small_side, written

#: Rows of the sample on which the index is fitted: those of the smallest hashes of their ids.
SAMPLE = 20_000
#: Most lists, parts of a code, values of a part, least rows reranked in a block, and the recall for which probes are calibrated.
LISTS, PARTS, WORDS, RERANK, RECALL = 1024, 16, 256, 600, 0.97
#: Most rows of a block, bytes of its vectors, and queries that meet it in one group.
BLOCK, BLOCK_BYTES, CHUNK = 16_384, 32 << 20, 4_096


def _means(rows: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    k = min(k, len(rows))
    centres = rows[rng.choice(len(rows), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(rows, centres)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, rows)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = 0.5 * (centres * centres).sum(1)
    return np.concatenate([np.argmax(rows[a : a + 8192] @ centres.T - half, axis=1) for a in range(0, len(rows), 8192)]) if len(rows) else np.empty(0, np.int64)


class Index:
    """Coarse centroids, codebooks of residuals and the number of lists to probe; a few hundred kB, whatever the table's size."""

    def __init__(self, sample: np.ndarray, k: int, lists: int, parts: int, recall: float):
        rng, self.dim = np.random.default_rng(5), sample.shape[1]
        self.centres = _means(sample, min(lists, max(1, len(sample) // 8)), 10, rng)
        near = _nearest(sample, self.centres)
        residual = sample - self.centres[near]
        self.cuts = np.linspace(0, self.dim, min(parts, self.dim) + 1).astype(int)
        self.books = [_means(residual[:, a:b], WORDS, 8, rng) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        # how far down each sampled query's list order its true neighbours in the sample lie
        query = np.arange(0, len(sample), max(1, len(sample) // 500))
        exact = sample[query] @ sample.T
        exact[np.arange(len(query)), query] = -np.inf
        top = np.argpartition(-exact, min(k, len(sample) - 1), axis=1)[:, :k]
        place = np.argsort(np.argsort(-(sample[query] @ self.centres.T), axis=1), axis=1)
        self.probes = min(len(self.centres), int(np.quantile(np.take_along_axis(place, near[top], axis=1), recall)) + 1)

    def probed(self, queries: np.ndarray) -> np.ndarray:
        """A flag for each query and list."""
        near = queries @ self.centres.T
        flags = np.zeros(near.shape, bool)
        np.put_along_axis(flags, np.argsort(-near, axis=1, kind="stable")[:, : self.probes], True, axis=1)
        return flags

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = _nearest(rows, self.centres)
        residual = rows - self.centres[near]
        return near, np.stack([_nearest(residual[:, a:b], c).astype(np.uint8) for a, b, c in zip(self.cuts, self.cuts[1:], self.books, strict=False)], 1)


def valid_vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec array<double>) of the rows that take part: id not null; vector not null, not zero, and of finite components."""
    v = F.col("vec")
    fine = v.isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return table.select(table[id_col].cast("long").alias("id"), table[vec_col].cast("array<double>").alias("vec")).where(F.col("id").isNotNull() & fine)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of dim components; shorter vectors get zeros at the end."""
    flat, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
    if len(flat) == dim * len(vectors) and (np.diff(ends, prepend=0) == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(vectors), dim))
    for row, a, z in zip(out, np.r_[0, ends[:-1]], ends, strict=True):
        row[: z - a] = flat[a:z]
    return out


def _packed_lists(sizes: dict[int, int], lists: int, rows: int) -> dict[int, tuple[int, int]]:
    """First block and number of blocks of each list: small lists share a block of at most `rows` rows, larger ones have several."""
    out, block, room = {}, -1, 0
    for x in range(lists):
        n = sizes.get(x, 0)
        if n > rows:
            out[x] = (block + 1, -(-n // rows))
            block, room = block + out[x][1], 0
        else:
            if n > room:
                block, room = block + 1, rows
            room -= n
            out[x] = (max(block, 0), 1)
    return out


def search(table: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, sample: int = SAMPLE, lists: int | None = None, parts: int = PARTS, recall: float = RECALL, block_rows: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, nearest first, ties to the smaller id.

    is_query is a condition on `id`. Score is the exact inner product in double precision. Every valid
    row (see valid_vectors) is a candidate for all queries but itself; rows that share an id are rows of
    their own, as queries too. A vector shorter than the longest counts as if zeros followed it. No valid
    rows give no result.
    """
    spark = table.sparkSession
    out = "query long, query_id long, vec_id long, score double"
    rows = written(valid_vectors(table, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    n, dim = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fitted = rows.select("vec", "id", "row").orderBy(F.xxhash64("id"), "id", "row").limit(sample).select("vec").toArrow()
    index = Index(_matrix(fitted.column("vec").combine_chunks(), dim), k, lists or int(np.clip(np.sqrt(n), 16, LISTS)), parts, recall)
    sent = spark.sparkContext.broadcast(index)
    most = int(np.clip(BLOCK_BYTES // (8 * dim), 256, block_rows))

    @lean
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(2), model.dim)
                near, code = model.encode(x)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()), pa.array([r.tobytes() for r in x], pa.binary())], ["row", "id", "list", "code", "raw"])

    indexed = written(rows.select("row", "id", "vec").mapInArrow(assign, "row long, id long, list int, code binary, raw binary"), "ann-index")
    sizes = {r["list"]: r["n"] for r in indexed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # a row per list
    packed = _packed_lists(sizes, len(index.centres), most)
    blocks = F.broadcast(spark.createDataFrame([(x, *v) for x, v in packed.items()], "list int, first int, many int"))  # a row per list

    def spread(key: str, parts: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(7)), parts).cast("int")

    stored = indexed.join(blocks, "list").withColumn("block", F.col("first") + spread("row", F.col("many"))).drop("first", "many")

    @lean
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        in_block = np.zeros((len(model.centres), max(a + m for a, m in packed.values())), bool)
        for x, (a, m) in packed.items():
            in_block[x, a : a + m] = True
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(2), model.dim)
                to = [np.flatnonzero(r).astype(np.int32) for r in model.probed(x) @ in_block]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(to, pa.list_(pa.int32()))], ["row", "id", "raw", "blocks"])

    asked = written(rows.where(is_query).select("row", "id", "vec").mapInArrow(probe, "row long, id long, raw binary, blocks array<int>"), "ann-queries")
    chunks = written(asked.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "ann-chunks")
    chunks = small_side(chunks)
    stored = stored.join(chunks, "block").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    asked = asked.withColumn("block", F.explode("blocks")).join(chunks, "block").withColumn("chunk", spread("row", F.col("chunks"))).select("block", "chunk", "row", "id", "raw")

    def scan(key: tuple, have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(ask):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": []})
        model, have = sent.value, have.sort_values(["id", "row"], kind="stable")
        ids, own_row, of = have["id"].to_numpy(), have["row"].to_numpy(), have["list"].to_numpy()
        vec = np.frombuffer(b"".join(have["raw"]), np.float64).reshape(-1, model.dim)
        code = np.frombuffer(b"".join(have["code"]), np.uint8).reshape(len(ids), -1)
        want, q_all = min(max(RERANK, 2 * k) + 1, len(ids)), np.frombuffer(b"".join(ask["raw"]), np.float64).reshape(-1, model.dim)
        found = []
        for at in range(0, len(ask), 64):
            q, q_row, q_id = q_all[at : at + 64], ask["row"].to_numpy()[at : at + 64], ask["id"].to_numpy()[at : at + 64]
            near = (q @ model.centres.T)[:, of]
            for m, (a, b) in enumerate(zip(model.cuts, model.cuts[1:], strict=False)):
                near += (q[:, a:b] @ model.books[m].T)[:, code[:, m]]
            near[~model.probed(q)[:, of]] = -np.inf
            near[q_row[:, None] == own_row[None, :]] = -np.inf
            least = np.partition(near, len(ids) - want, axis=1)[:, len(ids) - want]
            for j in range(len(q)):
                pick = np.flatnonzero((near[j] >= least[j]) & (near[j] > -np.inf))
                if len(pick) > want:  # ties at the end: the smaller ids stay
                    pick = pick[np.argsort(-near[j][pick], kind="stable")[:want]]
                score = (vec[pick] * q[j]).sum(1)
                best = np.lexsort((ids[pick], -score))[:k]
                found.append((np.full(len(best), q_row[j]), np.full(len(best), q_id[j]), ids[pick][best], score[best]))
        return pd.DataFrame(dict(zip(("query", "query_id", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    groups = ["block", "chunk"]
    near = stored.groupBy(*groups).cogroup(asked.groupBy(*groups)).applyInPandas(scan, out)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
