"""SimHash near-duplicates: an inverted index over byte positions, with count filtering.

A 64-bit fingerprint has eight positional bytes. Two fingerprints that differ in at most two bits
share at least 6 of them, so 6 is the guaranteed minimum of the tally of shared positional bytes.
Postings of single bytes would each hold 1/256 of the corpus and pairing inside them is quadratic,
so the index is keyed by what the count filter asks for: each fingerprint has one posting per choice
of 6 of the 8 positions (28), and two fingerprints meet in a posting exactly when their tally
reaches 6. In a posting only two bytes are free, so it holds 65,536 fingerprints at most, however
many documents there are. Each posting is then tallied and verified without emitting its pairs:
it gives a spanning star for each of its linked sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, lean, packed, release, shuffle_parts, small_batches, small_side, written
from .components import connected_components

SEED = 42
#: Choices of the positions whose bytes must be equal.
KEPT = list(combinations(range(8), 6))
PIECE = 1 << 16
#: Texts in which common shingles are counted, the texts a common one is in at least, and how many are kept. They order the index only; any choice gives the same links.
SAMPLE, COMMON, MOST = 5_000, 3, 100_000
#: Part of the hashes, the lowest, that is counted in all texts: prefixes at 0.8 are filled from it, so a passage that few of SAMPLE texts hold stays out of the prefixes of long ones.
COUNTED = 0.25
#: Longs of the bitmap of a text's shingles; its size has no part in the result.
BITMAP = 8


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of UTF-8 text; 0 where there is no word."""
    words = text.lower().split()  # on bytes: A-Z only, and \x20 \x09-\x0D only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    h64, join, total, n = xxhash.xxh64_intdigest, b" ".join, np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, PIECE):
        part = words[at : min(at + PIECE, n) + shingle - 1]
        h = np.array([h64(join(x), SEED) for x in zip(*(part[k:] for k in range(shingle)), strict=False)], "<u8")
        raw = np.zeros((-(-len(h) // 255) * 255, 8), np.uint8)  # sums of 255 bits fit a byte
        raw[: len(h)] = h.view(np.uint8).reshape(-1, 8)
        sums = np.add.reduce(np.unpackbits(raw, axis=1, bitorder="little").reshape(-1, 255, 64), axis=1, dtype=np.uint8)
        total += sums.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp long): one row per row of docs; null and wordless texts have fingerprint 0. Other columns are not read."""

    small_batches(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in b.column(1).cast(pa.binary())), "<u8", b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view("<i8"))], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, "id long, fp long")


def _mask(kept: tuple[int, ...]) -> int:
    m = sum(0xFF << 8 * k for k in kept)
    return m - (1 << 64) if m >> 63 else m


def _linked(fps: np.ndarray, bits: int, shared: int) -> np.ndarray:
    """For the distinct fingerprints of one posting, the index of the first one that each reaches by links inside it."""
    n = len(fps)
    label = np.arange(n)
    if n <= 256:
        x = fps[:, None] ^ fps[None, :]
        tally = (x.view(np.uint8).reshape(n, n, 8) == 0).sum(2)
        link = (tally >= shared) & (np.bitwise_count(x) <= bits)
        while True:
            new = np.where(link, label[None, :], n).min(1)
            if (new == label).all():
                return label
            label = new
    order = np.argsort(fps)
    ranked = fps[order]
    free = [k for k in range(64) if np.any((fps ^ fps[0]) >> np.uint64(k) & np.uint64(1))]
    flips = [sum(1 << b for b in c) for d in range(1, bits + 1) for c in combinations(free, d)]
    lab = np.arange(n)
    while True:
        before = lab.copy()
        for f in flips:
            other = ranked ^ np.uint64(f)
            at = np.minimum(np.searchsorted(ranked, other), n - 1)
            hit = ranked[at] == other
            np.minimum.at(lab, np.flatnonzero(hit), lab[at[hit]])
        if (lab == before).all():
            break
    label[order] = order[lab]
    return label


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """Distinct (fp) -> (src, dst) that connect just what pairs at `bits` (0 to 2) or fewer differing bits connect."""
    if not 0 <= bits <= 2:
        raise ValueError("the guaranteed minimum of 6 shared bytes holds for up to two differing bits")
    postings = F.array(*(F.struct(F.lit(k).alias("c"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("key"), "fp") for k, p in enumerate(KEPT)))
    rows = distinct.select(F.inline(postings)).repartition(shuffle_parts(distinct.sparkSession), "c", "key").sortWithinPartitions("c", "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3

        def groups(c, key, fp) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            same = (c[1:] == c[:-1]) & (key[1:] == key[:-1])
            starts = np.flatnonzero(np.r_[True, ~same])
            ends = np.r_[starts[1:], len(fp)]
            for k in np.flatnonzero(ends - starts > 1):
                own = fp[starts[k] : ends[k]]
                root = _linked(own.view("<u8"), bits, 6)
                moved = root != np.arange(len(own))
                yield own[moved], own[root[moved]]

        def out(*parts) -> Iterator[pa.RecordBatch]:
            found = list(groups(*parts)) if len(parts[0]) else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["src", "dst"])

        for b in batches:
            if not b.num_rows:
                continue
            parts = [np.concatenate([h, b.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k, h in enumerate(held)]
            c, key, _ = parts
            last = int(np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (key[1:] != key[:-1])])[-1])
            yield from out(*(p[:last] for p in parts))
            held = [p[last:] for p in parts]
        yield from out(*held)

    return rows.mapInArrow(run, "src long, dst long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """(id, fp, component): one row per row of docs; component is the smallest id reachable over links, null ids apart.

    Repeated rows and equal texts share a fingerprint and so a component. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-fp")
    roots = written(connected_components(links(distinct.select("fp"), bits)), "simhash-cc")
    labelled = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = labelled.groupBy("root").agg(F.min("least").alias("component"))
    label = labelled.join(best, "root").select("fp", "component")
    return rows.join(label, "fp").select("id", "fp", "component")


def _shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Distinct XXH64 of the word shingles (fewer words: the whole sequence; none: no hash), in order."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h64, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= shingle:
        return np.array([h64(join(words), SEED)], np.uint64)
    return np.unique(np.fromiter((h64(join(x), SEED) for x in zip(*(words[k:] for k in range(shingle)), strict=False)), np.uint64))


def _common(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes that COMMON or more texts hold, in order, and in how many: the lowest COUNTED of them by all texts, the others by SAMPLE texts, scaled."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).where("id is not null")
    ids = texts.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    bound = np.uint64(int(COUNTED * 2**64))

    small_batches(docs.sparkSession)

    def counted(texts: DataFrame, low: bool) -> tuple[np.ndarray, np.ndarray]:
        @lean
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                some = [np.empty(0, np.uint64)]
                for t in b.column(0).cast(pa.binary()):
                    hashes = _shingle_hashes(t.as_py() or b"", shingle)
                    at = np.searchsorted(hashes, bound)
                    some.append((hashes[:at] if low else hashes[at:]).copy())
                hashes, n = np.unique(np.concatenate(some), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

        found = texts.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= COMMON)
        rows = found.orderBy(F.desc("n"), "h").limit(MOST).collect()
        return np.array([r["h"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.int64)

    low, high = counted(texts, True), counted(texts.join(F.broadcast(ids), "id"), False)
    hashes, n = np.concatenate([low[0], high[0]]), np.concatenate([low[1], high[1] * max(1, texts.count() // SAMPLE)])
    order = np.argsort(hashes)
    return hashes[order], n[order]


def _prefix(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The first hashes of a text, rare before common, so many that two texts of that similarity share one of them: each lacks n - ceil(similarity * n) of its own at most."""
    if not len(hashes):
        return hashes
    known, n = common
    rank = np.zeros(len(hashes), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        rank = np.where(known[at] == hashes, n[at], 0)
    return hashes[np.lexsort((hashes, rank))[: len(hashes) - math.ceil(similarity * len(hashes) - 1e-6) + 1]]


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """BITMAP longs, a bit each for whether an odd number of the hashes falls on it: two texts differ in as many shingles at least as in bits."""
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % (64 * BITMAP), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _wide(hashes: np.ndarray) -> bytes:
    """The same as a bitmap that grows with the text, 1 to 2 bits a hash: BITMAP longs say nothing about texts of thousands of shingles. Its length is a power of two, so that one folds onto a shorter one."""
    size = 1 << max(6, (len(hashes) - 1).bit_length())
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % size, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _differing(one: bytes, other: bytes) -> int:
    """Bits in which two bitmaps of _wide() differ, the longer one folded: never more than the hashes that only one of the two texts has."""
    x, y = (np.frombuffer(b, np.uint64).reshape(-1, min(len(one), len(other)) // 8) for b in (one, other))
    return int(np.bitwise_count(np.bitwise_xor.reduce(x) ^ np.bitwise_xor.reduce(y)).sum())


def _may_reach(n: Column, bits: Column, other_n: Column, other_bits: Column, similarity: float) -> Column:
    """Whether sizes and bitmaps leave room for that similarity: the larger is not too large, and the bits that differ are no more than the shingles that may."""
    differ = sum(F.bit_count(bits[k].bitwiseXOR(other_bits[k])) for k in range(BITMAP))
    return (F.least(n, other_n) >= similarity * F.greatest(n, other_n) - 1e-6) & (differ <= (1 - similarity) / (1 + similarity) * (n + other_n) + 1e-6)


def _keyed(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(id, whole, n, bits, wide, keys): whole is a digest of the words, n counts the shingles, bits and wide are their bitmaps, keys are those of _prefix(). Rows without an id are left out."""
    common = _common(docs, id_col, text_col, shingle)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                whole, n, bits, wide, keys = [], [], [], [], []
                for t in part.column(1).cast(pa.binary()):
                    t = t.as_py() or b""
                    whole.append(xxhash.xxh64_intdigest(b" ".join(t.lower().split()), SEED))
                    hashes = _shingle_hashes(t, shingle)
                    n.append(len(hashes))
                    bits.append(_bitmap(hashes))
                    wide.append(_wide(hashes))
                    keys.append(_prefix(hashes, common, similarity).view(np.int64))
                ends = np.cumsum([0, *map(len, keys)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
                maps = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BITMAP, pa.int32()), pa.array(np.concatenate(bits)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(whole, np.uint64).view(np.int64)), pa.array(n, pa.int64()), maps, pa.array(wide, pa.binary()), lists], ["id", "whole", "n", "bits", "wide", "keys"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).where("id is not null")
    return rows.mapInArrow(run, "id long, whole long, n long, bits array<long>, wide binary, keys array<long>")


def _screened(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (src, dst) whose wide bitmaps leave room for that similarity: these are a small part of the texts, which then need not meet."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy() + b.column(3).to_numpy()
            differ = np.fromiter((_differing(x.as_py(), y.as_py()) for x, y in zip(b.column(4), b.column(5), strict=True)), np.int64, b.num_rows)
            yield b.select([0, 1]).filter(pa.array(differ <= (1 - similarity) / (1 + similarity) * n + 1e-6))

    one, other = (sets.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n"), F.col("wide").alias(f"{x}_wide")) for x in ("src", "dst"))
    return pairs.join(one, "src").join(other, "dst").select("src", "dst", "src_n", "dst_n", "src_wide", "dst_wide").mapInArrow(run, "src long, dst long")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(src, dst) of the pairs whose shingle sets have that Jaccard similarity. Texts meet as Zstandard frames; a hot text is repeated by Spark's split of skewed joins."""
    ids = small_side(written(pairs.select(F.explode(F.array("src", "dst")).alias("of")).distinct(), "similar-ids"))
    texts = docs.select(F.col(id_col).cast("long").alias("key"), F.lit(0).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    z = written(packed(texts).select("key", "z").join(ids, F.col("key") == F.col("of"), "left_semi"), "similar-texts")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        last: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                if last[0] != (frame := y.as_py()):
                    last = (frame, _shingle_hashes(press.decompress(frame), shingle))
                one, other = _shingle_hashes(press.decompress(x.as_py()), shingle), last[1]
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(both >= similarity * (len(one) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(z.select(F.col("key").alias("src"), F.col("z").alias("a")), "src")
    return left.join(z.select(F.col("key").alias("dst"), F.col("z").alias("b")), "dst").select("src", "dst", "a", "b").mapInArrow(run, "src long, dst long")


def similar_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(node, root) of the documents linked to another one by shingle sets of that similarity; root is the smallest id reached.

    near_duplicates() gives the first pairs: each text and its component's smallest id. At `similarity` fingerprints may
    differ in more than two bits, so the others come from an exact candidate rule: shingles have one order, rare before common, and two texts at `similarity`
    share one of the first of each (prefix filtering); sizes and bitmaps, short ones and then ones that grow with the text, rule out pairs that cannot reach it. In a
    posting every text first meets two pivots, the smallest id and one that differs by posting. Then those that are not yet in
    one component meet all the others of theirs, so that each pair of a posting is linked or compared;
    a join on the posting does that, which Spark splits where it is hot. Pairs are verified on the whole
    texts. Equal texts (by words) are one node before that.
    """
    spark = docs.sparkSession

    def step(df: DataFrame, name: str, *done: DataFrame) -> DataFrame:
        """df written; tables that nothing reads any more and shuffle files go, as each of them is as large as the texts."""
        out = written(df, f"similar-{name}")
        for old in done:
            drop_written(old)
        release(spark)
        return out

    rows = step(_keyed(docs, id_col, text_col, shingle, similarity), "rows")
    of = F.min_by(F.struct("n", "bits", "wide", "keys"), "id").alias("of")
    first = step(rows.groupBy("whole").agg(F.min("id").alias("least"), of).select(F.col("least").alias("id"), "whole", "of.n", "of.bits", "of.wide", "of.keys"), "distinct")
    copies = step(rows.join(first.select("whole", F.col("id").alias("least")), "whole").where("id <> least").select(F.col("id").alias("src"), F.col("least").alias("dst")), "copies", rows)
    sets = step(first.select("id", "n", "bits", "wide"), "sets")
    every = first.select("id", F.explode("keys").alias("key"))
    by = F.struct(F.hash("id", "key").alias("h"), "id")
    ends = step(every.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("lo"), F.max(by).alias("hi")).where("m > 1").select("key", F.array("lo", "hi.id").alias("pivots")), "postings")
    posts = step(every.join(ends, "key"), "posts", first, ends)
    hashed = step(near_duplicates(docs, id_col, text_col).where("id <> component").select(F.col("id").alias("src"), F.col("component").alias("dst")), "simhash")
    met = posts.select("id", F.explode("pivots").alias("o")).where("id <> o").select(F.greatest("id", "o").alias("src"), F.least("id", "o").alias("dst")).unionAll(hashed).distinct()
    one, other = (sets.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n"), F.col("bits").alias(f"{x}_bits")) for x in ("src", "dst"))
    may = _may_reach(F.col("src_n"), F.col("src_bits"), F.col("dst_n"), F.col("dst_bits"), similarity)
    pairs = step(met.join(one, "src").join(other, "dst").where(may).select("src", "dst"), "pairs")
    likely = step(_screened(pairs, sets, similarity), "likely")
    links = step(_verified(likely, docs, id_col, text_col, shingle, similarity), "links", likely)

    roots = step(connected_components(links), "roots")
    in_posts = step(posts.join(roots, posts.id == roots.node, "left").select("key", "id", F.coalesce("root", "id").alias("root")), "labelled", posts, roots)
    sizes = in_posts.groupBy("key", "root").count()
    top = sizes.groupBy("key").agg(F.max(F.struct("count", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1").select("key", F.col("top.root").alias("top"))
    still = step(in_posts.join(step(top, "open"), "key").join(sets.select("id", "n", "bits"), "id"), "still", in_posts)
    one, other = (still.select("key", "top", *(F.col(c).alias(f"{x}_{c}") for c in ("id", "root", "n", "bits"))) for x in ("a", "b"))
    # of two outside the largest component, the larger id asks
    asks = (F.col("a_root") != F.col("b_root")) & ((F.col("b_root") == F.col("top")) | (F.col("a_id") > F.col("b_id")))
    may = _may_reach(F.col("a_n"), F.col("a_bits"), F.col("b_n"), F.col("b_bits"), similarity)
    open_pairs = one.where("a_root <> top").drop("top").join(other, "key").where(asks & may).select(F.greatest("a_id", "b_id").alias("src"), F.least("a_id", "b_id").alias("dst")).distinct()
    more = step(open_pairs.join(pairs, ["src", "dst"], "left_anti"), "more-pairs", still, pairs)
    likely = step(_screened(more, sets, similarity), "more-likely", more, sets)
    late = step(_verified(likely, docs, id_col, text_col, shingle, similarity), "more-links", likely)
    return connected_components(links.unionAll(late).unionAll(copies))


def similar_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of docs, all columns unchanged, whose id is the smallest of those linked by similar_links().

    Of repeated rows with that id one stays, as do rows without an id; wordless texts are copies of one another.
    """
    gone = written(similar_links(docs, id_col, text_col, shingle, similarity).where("node <> root").select("node").distinct(), "similar-gone")
    kept = docs.where(F.col(id_col).isNotNull()).join(gone, docs[id_col] == gone["node"], "left_anti").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """The rows of docs, all columns unchanged, whose id is their component's smallest.

    Of repeated rows with that id one stays, as do rows without an id.
    """
    member = near_duplicates(docs, id_col, text_col, shingle, bits).where("id = component").select("id").distinct()
    kept = docs.join(member, docs[id_col] == member["id"], "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
