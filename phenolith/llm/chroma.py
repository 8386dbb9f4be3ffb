"""Chroma fingerprints of audio columns, and alignment of recordings.

Spectra are folded into twelve pitch classes a frame; filters on the integral image of the frames give
two bits each, packed into one integer a frame. An inverted index has the places of each integer. A query
looks up its integers, each also with its least certain bits turned over, and every hit votes for an
offset of a recording; offsets with enough votes are laid over the recording, and the bit errors decide.
Integers with very many places (silence, say) do not vote. A query that looks up one of them is laid over all
recordings that hold such integers at every offset, in blocks, instead, and over all others too where it consists of them for the most part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches, written

RATE, FRAME, HOP, WIDTH = 4096, 1024, 256, 8
#: Overlapping frames and share of differing bits at which a recording counts as found.
OVERLAP, ERROR = 10, 0.2
BLOCK, CHUNK = 2_000, 500
#: Least certain bits of a query's integer that are turned over in all ways, votes that an offset needs, and places beyond which an integer does not vote.
FLIPS, VOTES, HOT = 6, 2, 5_000
#: Frames that are analysed at once.
PIECE = 4_096
LEVELS = np.array([-0.2, 0.0, 0.2])
GRAY = np.array([0, 1, 3, 2], np.uint32)
#: (kind, first pitch class, pitch classes, frames) of the sixteen filters, by rule.
FILTERS = [(k % 4, 3 * k % 10, 2 + k % 3 if 3 * k % 10 + 2 + k % 3 <= 12 else 2, (4, 6, 8)[k % 3]) for k in range(16)]
_BIN = np.fft.rfftfreq(FRAME, 1 / RATE)
_USED = (_BIN >= 55) & (_BIN <= 1760)
_FOLD = np.zeros((_USED.sum(), 12))
_FOLD[np.arange(_USED.sum()), np.round(12 * np.log2(_BIN[_USED] / 55)).astype(int) % 12] = 1


def _pieces(pcm: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes of some windows at a time; for each window and filter how far the value is from the nearest level, and the bit that crossing it turns over."""
    x = np.frombuffer(pcm, "<i2", len(pcm) // 2)
    n = (len(x) - FRAME) // HOP + 1
    for first in range(0, n - WIDTH + 1, PIECE):
        some = min(PIECE + WIDTH - 1, n - first)
        part = x[first * HOP : (first + some - 1) * HOP + FRAME].astype(float)
        frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP] * np.hanning(FRAME)
        chroma = np.abs(np.fft.rfft(frames, axis=1))[:, _USED] ** 2 @ _FOLD
        chroma /= np.linalg.norm(chroma, axis=1, keepdims=True) + 1e-9
        image = np.zeros((some + 1, 13))
        image[1:, 1:] = chroma.cumsum(0).cumsum(1)
        yield _filtered(image, np.arange(some - WIDTH + 1))


def _filtered(image: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    area = lambda t, w, y, h: image[at + t + w, y + h] - image[at + t, y + h] - image[at + t + w, y] + image[at + t, y]
    code, far, bit = np.zeros(len(at), np.uint32), np.empty((len(at), len(FILTERS))), np.empty((len(at), len(FILTERS)), np.uint32)
    for k, (kind, y, h, w) in enumerate(FILTERS):
        whole, half, rows = area(0, w, y, h), w // 2, h // 2
        if kind == 0:  # earlier against later
            part = area(0, half, y, h)
        elif kind == 1:  # lower against higher classes
            part = area(0, w, y, rows)
        elif kind == 2:  # two opposite quarters against the others
            part = area(0, half, y, rows) + area(half, w - half, y + rows, h - rows)
        else:  # the middle against both sides
            part = area(w // 4, half, y, h)
        value = np.log((1 + part) / (1 + whole - part))
        code = code << np.uint32(2) | GRAY[np.searchsorted(LEVELS, value)]
        gap = np.abs(value[:, None] - LEVELS)
        level = gap.argmin(1)
        far[:, k] = gap[np.arange(len(at)), level]
        bit[:, k] = (GRAY[level] ^ GRAY[level + 1]) << np.uint32(2 * (len(FILTERS) - 1 - k))
    return code, far, bit


def fingerprint(pcm: bytes) -> np.ndarray:
    """Unsigned 32-bit codes, one per frame, of 16-bit little-endian mono samples at RATE; none if there are too few samples. Long recordings are analysed in pieces."""
    return np.concatenate([np.empty(0, np.uint32), *(code for code, _, _ in _pieces(pcm))])


def keys(pcm: bytes, flips: int = FLIPS) -> np.ndarray:
    """(frames, 2 ** flips) integers under which each frame is looked up, the code itself first."""
    out = [np.empty((0, 1 << flips), np.uint32)]
    for code, far, bit in _pieces(pcm):
        turned = np.take_along_axis(bit, np.argsort(far, axis=1, kind="stable")[:, :flips], axis=1)
        found = code[:, None]
        for k in range(flips):
            found = np.concatenate([found, found ^ turned[:, k : k + 1]], axis=1)
        out.append(found)
    return np.concatenate(out)


def fingerprints(media: DataFrame, id_col: str, audio_col: str, flips: int | None = None) -> DataFrame:
    """(id, codes): codes as little-endian unsigned 32-bit integers; null and short recordings have none. With flips also looked_up: keys(), frame by frame."""
    small_batches(media.sparkSession)
    names = ["id", "codes"] + ["looked_up"] * (flips is not None)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, rows = b.slice(at, 256), []
                for x in part.column(1):
                    if flips is None:
                        rows.append((fingerprint(x.as_py() or b"").astype("<u4").tobytes(),))
                    else:
                        found = keys(x.as_py() or b"", flips)
                        rows.append((found[:, 0].astype("<u4").tobytes(), found.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.binary()) for c in zip(*rows, strict=True))], names)

    schema = "id long, codes binary" + (", looked_up binary" if flips is not None else "")
    return media.select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).alias("a")).mapInArrow(run, schema)


def _places(rows: DataFrame, column: str, name: str, width: int = 1) -> DataFrame:
    """(id, codes) -> (code, name, at): a row per code and frame; width codes stand for one frame."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                some = [np.frombuffer(x.as_py(), "<u4") for x in b.column(1).slice(at, 64)]
                size = [len(x) for x in some]
                ids = np.repeat(b.column(0).slice(at, 64).to_numpy(zero_copy_only=False), size)
                place = np.concatenate([np.arange(n, dtype=np.int32) // width for n in size])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(some).view(np.int32)), pa.array(ids), pa.array(place.astype(np.int32))], ["code", name, "at"])

    return rows.select(name, column).mapInArrow(run, f"code int, {name} long, at int")


def align(query: np.ndarray, block: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """(recording, offset, votes, overlap, error) of each recording in the block that the query lies in, at the offset of most equal bits beyond half; votes are its equal codes. block: all codes; starts: by recording, with the end.

    Bit errors are summed at every offset: gaps between recordings keep a query from reaching two of them.
    """
    size, gap = len(query), len(query) - 1
    at = starts[:-1] + gap * np.arange(1, len(starts))
    place = np.arange(len(block)) + np.repeat(gap * np.arange(1, len(starts)), np.diff(starts))
    wide, real = np.zeros(len(block) + gap * len(starts), np.uint32), np.zeros(len(block) + gap * len(starts), np.uint8)
    wide[place], real[place] = block, 1
    slots = len(wide) - gap
    ends = np.r_[0, np.cumsum(real, dtype=np.int32)]
    n = ends[size:] - ends[:slots]
    most = np.where(n >= OVERLAP, np.floor(ERROR * 32 * n + 1e-9), -1).astype(np.int32)
    wrong, alive = np.zeros(slots, np.int32), None
    differ, count = np.empty(slots, np.uint32), np.empty(slots, np.uint8)
    for first in range(0, size, 7):  # the errors of seven codes fit a byte
        codes = query[first : first + 7]
        if alive is None:
            part = np.zeros(slots, np.uint8)
            for k, code in enumerate(codes, first):
                np.bitwise_count(np.bitwise_xor(wide[k : k + slots], code, out=differ), out=count)
                count *= real[k : k + slots]
                part += count
            wrong += part
            open_ = wrong <= most
            if np.count_nonzero(open_) * 8 < slots:  # the others are above the bound for good
                alive = np.flatnonzero(open_)
        else:
            for k, code in enumerate(codes, first):
                wrong[alive] += np.bitwise_count(wide[alive + k] ^ code) * real[alive + k]
            alive = alive[wrong[alive] <= most[alive]]
    slot = np.flatnonzero(wrong <= most) if alive is None else alive
    rec = np.searchsorted(at - gap, slot, "right") - 1
    offset, n, wrong = slot - at[rec], n[slot], wrong[slot].astype(np.int64)
    best = np.lexsort((offset, wrong - 16 * n, rec))
    for k in best[np.r_[True, rec[best][1:] != rec[best][:-1]]] if len(best) else best:
        a, own = max(0, -offset[k]), block[starts[rec[k]] : starts[rec[k] + 1]]
        z = a + n[k]
        yield int(rec[k]), int(offset[k]), int((query[a:z] == own[a + offset[k] : z + offset[k]]).sum()), int(n[k]), float(wrong[k]) / (32 * int(n[k]))


FOUND = "query long, class_id long, offset_frames int, votes int, overlap int, bit_error double"


def _by_votes(have: DataFrame, ask: DataFrame, hot: DataFrame, flips: int, votes: int) -> DataFrame:
    """FOUND rows: offsets that enough frames of a query vote for, of each recording the one of most equal bits beyond half."""
    index = _places(have, "codes", "id").withColumnRenamed("at", "there")
    asked = _places(ask, "looked_up", "query", 1 << flips)
    hits = asked.join(hot, "code", "left_anti").join(index, "code").select("query", "id", (F.col("there") - F.col("at")).alias("offset"))
    voted = hits.groupBy("query", "id", "offset").agg(F.count("*").alias("n")).where(F.col("n") >= votes).groupBy("query", "id").agg(F.collect_list("offset").alias("offsets"))
    laid = voted.join(ask.select("query", F.col("codes").alias("q")), "query").join(have.select("id", F.col("codes").alias("c")), "id")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for query, i, offsets, q, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                q, c, best = np.frombuffer(q, "<u4"), np.frombuffer(c, "<u4"), None
                for o in sorted(offsets):
                    first, last = max(0, -o), min(len(q), len(c) - o)
                    n = last - first
                    if n >= OVERLAP:
                        differ = q[first:last] ^ c[first + o : last + o]
                        wrong = int(np.bitwise_count(differ).sum())
                        if wrong <= np.floor(ERROR * 32 * n + 1e-9) and (best is None or wrong - 16 * n < best[0]):
                            best = wrong - 16 * n, o, int((differ == 0).sum()), n, wrong / (32 * n)
                if best:
                    rows.append((query, i, *best[1:]))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in FOUND.split(", ")])

    return laid.select("query", "id", "offsets", "q", "c").mapInArrow(run, FOUND)


def _at_all_offsets(have: DataFrame, ask: DataFrame) -> DataFrame:
    """FOUND rows by laying queries over every recording at every offset: blocks of recordings meet chunks of queries, so groups are bounded and nothing is left out."""
    blocks, chunks = max(1, -(-have.count() // BLOCK)), max(1, -(-ask.count() // CHUNK))
    left = have.withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(blocks))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = ask.select("query", "codes").withColumn("chunk", F.pmod(F.xxhash64("query", F.lit(3)), F.lit(chunks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def run(recs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(recs) and len(asked):
            sizes = recs["codes"].str.len().to_numpy() // 4
            block, starts = np.frombuffer(b"".join(recs["codes"]), "<u4"), np.r_[0, np.cumsum(sizes)]
            ids = recs["id"].to_numpy()
            for q, codes in zip(asked["query"], asked["codes"], strict=True):
                out += [(q, ids[r], *rest) for r, *rest in align(np.frombuffer(codes, "<u4"), block, starts)]
        return pd.DataFrame(out, columns=[x.split()[0] for x in FOUND.split(", ")])

    return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(run, FOUND)


def search(media: DataFrame, queries: DataFrame, id_col: str, audio_col: str, flips: int = FLIPS, votes: int = VOTES, hot: int = HOT) -> DataFrame:
    """(query_id, class_id, n_copies, offset_frames, votes, overlap, bit_error) of every aligned class of recordings; votes are equal codes.

    media and queries: (id, 16-bit PCM). Recordings of equal fingerprints are one class, named by its
    smallest id; n_copies says how many they are. Rows with a null id, and recordings shorter than WIDTH
    frames, take no part; repeated recordings are copies, repeated queries count once. A code with more
    than `hot` places does not vote, which touches the queries that look it up, and recordings that hold such
    codes: these meet at every offset. A query that has such codes in half of its frames or more is laid
    over all recordings so.
    """
    some = F.octet_length("codes") > 0
    classes = fingerprints(media, id_col, audio_col).where(some & F.col("id").isNotNull()).groupBy("codes").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    have = written(classes, "chroma-classes")
    asked = fingerprints(queries, id_col, audio_col, flips).where(some & F.col("id").isNotNull()).dropDuplicates(["id", "codes"])
    ask = written(asked.withColumn("query", F.monotonically_increasing_id()), "chroma-queries")
    crowded = written(_places(have, "codes", "id").groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("code"), "chroma-hot")
    if crowded.isEmpty():
        found = _by_votes(have, ask, crowded, flips, votes)
    else:
        own = _places(ask, "codes", "query").join(crowded, "code", "left_semi").groupBy("query").agg(F.count("*").alias("n"))
        touched = _places(ask, "looked_up", "query", 1 << flips).join(crowded, "code", "left_semi").select("query").distinct()
        steady = F.coalesce(2 * F.col("n") >= F.octet_length("codes") / 4, F.lit(False)).alias("steady")
        touched = written(touched.join(ask.select("query", "codes"), "query").join(own, "query", "left").select("query", "codes", steady), "chroma-touched")
        holds = written(_places(have, "codes", "id").join(crowded, "code", "left_semi").select("id").distinct(), "chroma-holds")
        some, rest = touched.where("not steady"), touched.where("steady")
        by_votes = _by_votes(have, ask.join(rest, "query", "left_anti"), crowded, flips, votes)
        settled = some.select("query", F.lit(True).alias("some")), holds.select(F.col("id").alias("class_id"), F.lit(True).alias("held"))
        by_votes = by_votes.join(settled[0], "query", "left").join(settled[1], "class_id", "left").where("some is null or held is null")
        names = [x.split()[0] for x in FOUND.split(", ")]
        found = by_votes.select(names).unionAll(_at_all_offsets(have.join(holds, "id", "left_semi"), some)).unionAll(_at_all_offsets(have, rest))
    found = found.join(ask.select("query", F.col("id").alias("query_id")), "query").join(have.select(F.col("id").alias("class_id"), F.col("copies").alias("n_copies")), "class_id")
    return found.select("query_id", "class_id", "n_copies", "offset_frames", "votes", "overlap", "bit_error")


def rendered(vectors: DataFrame, id_col: str, vec_col: str, skip: int = 0, noise: float = 0.0) -> DataFrame:
    """(id, audio): a tune of each vector, one tone of HOP samples per component, as test tables hold no audio. skip leaves out first tones; noise is added by a rule of the id. Vectors that are null or hold null or non-finite components have null audio."""

    def render(i: int | None, v: list | None) -> bytes | None:
        if not v or any(x is None or not np.isfinite(x) for x in v):
            return None
        key = np.clip(np.round(np.array(v, float) * 60) + 18, 0, 40)[skip:]
        phase = 2 * np.pi * np.cumsum(np.repeat(110 * 2 ** (key / 12), HOP)) / RATE
        wave = 0.6 * np.sin(phase) + 0.2 * np.sin(2 * phase)
        if noise:
            wave += noise * np.random.default_rng(i or 0).standard_normal(len(phase))
        return (np.clip(wave, -1, 1) * 32000).astype("<i2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                audio = [render(i, v) for i, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(audio, pa.binary())], ["id", "audio"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).mapInArrow(run, "id long, audio binary")


def excerpts_found(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Noisy excerpts of the recordings chosen by is_query (a condition on id_col), searched in all recordings."""
    media = rendered(vectors, id_col, vec_col)
    return search(media, rendered(vectors.where(is_query), id_col, vec_col, skip=12, noise=0.05), "id", "audio")
