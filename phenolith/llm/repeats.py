"""Removal of repeated byte strings by prefix-free parsing.

Rolling-hash triggers cut every text into phrases. A trigger is the least hash of eight bytes among
WINDOW window starts, so it depends on the bytes of a repeated string alone, each string of `length`
bytes holds one, and equal strings have theirs at the same place. The dictionary has what precedes each
trigger, the parse what follows it: a string is a suffix of a dictionary phrase and then the beginning
of a parse suffix. A row stands for all strings of one trigger, and rows that are equal are kept once.

Strings of one trigger share the bytes right after it (the stem). Only triggers whose stem occurs
again can begin a repeat; of these, rows that occur again are repeated as a whole, which settles
the inside of every copy. What is left are the ends of copies. There the suffix array of the parse (rows
in order of what follows the trigger, and the common prefixes of neighbours) and that of the dictionary
(rows in order of what precedes it, read backwards, and the same of neighbours) are combined into
corpus order, offset by offset: strings are equal where both orders have no break at their depth.
Suffixes are compared as far as `length` bytes, as nothing deeper is asked for. Stems are dealt over
tasks; one of very many rows is dealt by bands of offsets and counted by what the bands hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from .common import lean, packed, shuffle_parts, small_batches, written

LENGTH, GRAM = 200, 8
#: Starts among which a trigger is chosen, and starts of a text that are handled at once.
WINDOW, SEGMENT = 160, 1 << 18
PLACE_BITS = np.uint64(20)
#: Bits of a stem's digest, distinct rows up to which a stem is handled in one task, rows that are ordered at once, and offsets of a band.
STEM_MASK, FEW, ORDERED, BAND = (1 << 48) - 1, 2_000, 16_384, 16
#: A row's place in its text: the first start, the trigger's distance from it, and how many more starts there are.
FIRST, LEAD, MORE = 20, 10, (1 << 10) - 1


def triggers(text: bytes, length: int = LENGTH, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first, last): for each trigger, the starts of the strings whose trigger it is."""
    n, found = len(text) - length + 1, []
    for at in range(0, max(0, n), SEGMENT):
        starts = min(SEGMENT, n - at)
        size = starts + window - 1
        h = np.frombuffer(text, np.uint8, size + GRAM - 1, at).astype(np.uint64)
        for step in (1, 2, 4):
            h = h[:-step] | h[step:] << np.uint64(8 * step)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        # the place in the low bits: of equal hashes the first is the trigger
        key = np.full(-(-size // window) * window, np.iinfo(np.uint64).max)
        key[:size] = h >> PLACE_BITS << PLACE_BITS | np.arange(size, dtype=np.uint64)
        key = key.reshape(-1, window)
        to_left = np.minimum.accumulate(key, axis=1).ravel()
        to_right = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
        place = np.minimum(to_right[:starts], to_left[window - 1 : window - 1 + starts]) & np.uint64((1 << 20) - 1)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        found.append((place[first].astype(np.int64) + at, first + at, np.r_[first[1:] - 1, starts - 1] + at))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, t): key is the id where ids are unique and not null; else rows get numbers, which are written down."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").limit(1).count() == 0:
        return rows.select(F.col("id").alias("key"), "id", "t")
    return written(rows.select(F.monotonically_increasing_id().alias("key"), "id", "t"), "repeats-rows")


def _phrases(rows: DataFrame, length: int, window: int, only_stems: bool) -> DataFrame:
    """(stem, phrase, key, at): a row per trigger, phrase being a digest of all that its strings cover."""
    stem = length - window + 1
    small_batches(rows.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stems, wholes, keys, ats = [], [], [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), strict=True):
                text = text.as_py() or b""
                trigger, first, last = triggers(text, length, window)
                stems += [xxh3_64_intdigest(text[a : a + stem]) & STEM_MASK for a in trigger.tolist()]
                if not only_stems:
                    wholes += [xxh3_64_intdigest(text[a : z + length], z - a) for a, z in zip(first.tolist(), last.tolist(), strict=True)]
                    ats.append(first << FIRST | trigger - first << LEAD | last - first)
                    keys.append(np.full(len(first), key))
                if len(stems) >= 200_000:
                    yield out(stems, wholes, keys, ats)
                    stems, wholes, keys, ats = [], [], [], []
            if stems:
                yield out(stems, wholes, keys, ats)

    def out(stems, wholes, keys, ats) -> pa.RecordBatch:
        more = [] if only_stems else [_signed(wholes), pa.array(np.concatenate(keys)), pa.array(np.concatenate(ats))]
        return pa.RecordBatch.from_arrays([_signed(stems), *more], ["stem", "phrase", "key", "at"][: 1 + len(more)])

    return rows.select("key", "t").mapInArrow(run, "stem long" if only_stems else "stem long, phrase long, key long, at long")


def _cut_out(rows: DataFrame, taken: DataFrame, length: int) -> DataFrame:
    """taken (stem, key, at, alone, many) with the bytes that each phrase covers."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            for k in range(b.num_rows):
                text = press.decompress(b.column(1)[k].as_py())
                parts = b.column(2)[k].values
                cut = [text[x >> FIRST : (x >> FIRST) + (x & MORE) + length] for x in parts.field("at").to_pylist()]
                key = pa.array([b.column(0)[k].as_py()] * len(cut), pa.int64())
                yield pa.RecordBatch.from_arrays([parts.field("stem"), key, parts.field("at"), parts.field("alone"), parts.field("many"), pa.array(cut, pa.binary())], ["stem", "key", "at", "alone", "many", "phrase"])

    by_key = taken.groupBy("key").agg(F.collect_list(F.struct("stem", "at", "alone", "many")).alias("parts"))
    return packed(rows).join(by_key, "key").select("key", "z", "parts").mapInArrow(run, "stem long, key long, at long, alone boolean, many boolean, phrase binary")


def suffix_array(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes in order: their numbers, and for each but the first the bytes it has in common with the one before."""
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(">u8")
    order = np.lexsort(words.T[::-1])
    ranked = rows[order]
    differ = ranked[1:] != ranked[:-1]
    return order, np.where(differ.any(1), differ.argmax(1), rows.shape[1])


def repeated_offsets(phrases: list[bytes], lead: np.ndarray, more: np.ndarray, length: int, window: int) -> np.ndarray:
    """For each phrase (bytes around its trigger, which is lead bytes in) and start 0 to more: whether another phrase holds the string there, its trigger at the same place."""
    n = len(phrases)
    after, before = np.zeros((n, length), np.uint8), np.zeros((n, window), np.uint8)
    for k, (p, at) in enumerate(zip(phrases, lead.tolist(), strict=True)):
        own = np.frombuffer(p, np.uint8)
        after[k, : len(own) - at] = own[at:]
        before[k, :at] = own[:at][::-1]
    parse, parse_common = suffix_array(after)
    dictionary, dictionary_common = suffix_array(before)

    def classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
        """Rows have the same number if they agree that deep."""
        out = np.empty(n, np.int64)
        out[order] = np.r_[0, np.cumsum(common < depth)]
        return out

    found = np.zeros((n, window), bool)
    for offset in range(int((lead - more).min()), int(lead.max()) + 1):  # of the trigger in the string
        has = np.flatnonzero((lead >= offset) & (lead - more <= offset))
        place = classes(dictionary, dictionary_common, offset)[has] * n + classes(parse, parse_common, length - offset)[has]
        order = np.argsort(place, kind="stable")
        same = place[order][1:] == place[order][:-1]
        twice = np.r_[False, same] | np.r_[same, False]
        row = has[order[twice]]
        found[row, lead[row] - offset] = True
    return found


def _runs(found: np.ndarray, keys: np.ndarray, firsts: np.ndarray) -> pa.RecordBatch:
    """(key, at) of each run of flagged starts."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    return pa.RecordBatch.from_arrays([pa.array(keys[row]), pa.array(firsts[row] + begin << FIRST | end - begin - 1)], ["key", "at"])


def _few(phrases: DataFrame, length: int, window: int) -> DataFrame:
    """(key, at) of the strings of phrases that are alone and occur in another phrase of their stem, at most FEW in a stem."""

    def ordered(rows: list[tuple]) -> pa.RecordBatch:
        keys, at, alone = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
        found = repeated_offsets([r[4] for r in rows], at >> LEAD & MORE, at & MORE, length, window)
        return _runs(found & (alone > 0)[:, None], keys, at >> FIRST)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if len(held) >= ORDERED and row[0] != held[-1][0]:  # whole stems
                    yield ordered(held)
                    held = []
                held.append(row)
        if held:
            yield ordered(held)

    dealt = phrases.where("not many").repartition(shuffle_parts(phrases.sparkSession), "stem").sortWithinPartitions("stem")
    return dealt.select("stem", "key", "at", "alone", "phrase").mapInArrow(run, "key long, at long")


def _bands(phrases: DataFrame, length: int, band: int) -> DataFrame:
    """(key, at, alone, band, inner, all): a row for each phrase and band of offsets that it has strings of; digests of what all strings of the band share, and of all that they cover."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, at, alone, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lead, more = at >> LEAD & MORE, at & MORE
                for low in range((lead - more) // band * band, lead + 1, band):
                    a, z = max(low, lead - more), min(low + band - 1, lead)
                    inner = p[lead - low : lead - low - band + 1 + length]
                    rows.append((key, at, alone, low, xxh3_128_digest(inner, low), xxh3_128_digest(p[lead - z : lead - a + length], a << 10 | z)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "at", "alone", "band", "inner", "all"])

    return phrases.select("key", "at", "alone", "phrase").mapInArrow(run, "key long, at long, alone boolean, band int, inner binary, all binary")


def _crowded(phrases: DataFrame, length: int, band: int) -> DataFrame:
    """The same for stems of any number of phrases, by counts with map-side combining, in two steps.

    Bands whose bytes occur again are repeated as a whole; in the others, only of phrases that share
    the inner bytes of the band with another one are strings counted one by one.
    """
    crowded = phrases.where("many")
    rows = written(_bands(crowded, length, band), "repeats-bands")
    sorts = written(rows.groupBy("inner", "all").agg(F.count("*").alias("n"), F.min(F.struct("key", "at", "alone", "band")).alias("one")), "repeats-band-sorts")
    lead, more = F.shiftright("at", LEAD).bitwiseAND(MORE), F.col("at").bitwiseAND(MORE)
    low, high = F.greatest(F.col("band"), lead - more), F.least(F.col("band") + band - 1, lead)  # offsets
    whole = rows.where("alone").join(sorts.where("n > 1").select("inner", "all"), ["inner", "all"], "left_semi")
    whole = whole.select("key", (F.shiftleft(F.shiftright("at", FIRST) + lead - high, FIRST) + high - low).alias("at"))
    shared = written(sorts.groupBy("inner").agg(F.count("*").alias("m")).where("m > 1").select("inner"), "repeats-shared")
    ends = sorts.join(shared, "inner", "left_semi").select("one.key", "one.at", "one.band", (F.col("one.alone") & (F.col("n") == 1)).alias("asks"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, keys, ats, asking = [], [], [], []
            for key, at, low, asks, p in zip(*(c.to_pylist() for c in b.columns), strict=True):
                lead, more = at >> LEAD & MORE, at & MORE
                for i in range(max(0, lead - low - band + 1), min(more, lead - low) + 1):
                    digests.append(xxh3_128_digest(p[i : i + length], lead - i))
                    keys.append(key)
                    ats.append((at >> FIRST) + i << FIRST)
                    asking.append(asks)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(keys, pa.int64()), pa.array(ats, pa.int64()), pa.array(asking, pa.bool_())], ["string", "key", "at", "asks"])

    strings = crowded.select("key", "at", "phrase").join(ends, ["key", "at"]).select("key", "at", "band", "asks", "phrase").mapInArrow(run, "string binary, key long, at long, asks boolean")
    strings = written(strings, "repeats-strings")
    twice = written(strings.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string"), "repeats-twice")
    return whole.unionAll(strings.where("asks").join(twice, "string", "left_semi").select("key", "at"))


def repeated_starts(rows: DataFrame, length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """(key, t) -> (key, at): packed ranges of the starts of strings that also start elsewhere.

    Counts have map-side combining and are written before they are joined back: between two plain scans
    Spark splits a hot key, so a passage in any share of the texts is no hot group. Rows are told apart by
    digests of 64 bits within equal stems (of 48 bits), bands and strings by digests of 128 bits.
    """
    again = written(_phrases(rows, length, window, True).groupBy("stem").agg(F.count("*").alias("n")).where("n > 1").select("stem"), "repeats-stems")
    found = written(_phrases(rows, length, window, False).join(again, "stem", "left_semi"), "repeats-phrases")
    dictionary = written(found.groupBy("stem", "phrase").agg(F.count("*").alias("n"), F.min(F.struct("key", "at")).alias("one")), "repeats-dictionary")
    whole = found.join(dictionary.where("n > 1").select("stem", "phrase"), ["stem", "phrase"], "left_semi").select("key", F.col("at").bitwiseAND(~(MORE << LEAD)).alias("at"))
    several = dictionary.groupBy("stem").agg(F.count("*").alias("m"), F.count_if(F.col("n") == 1).alias("alone")).where("m > 1 and alone > 0").select("stem", (F.col("m") > FEW).alias("many"))
    several = written(several, "repeats-several")
    taken = dictionary.join(several, "stem").select("stem", "one.*", (F.col("n") == 1).alias("alone"), "many")
    phrases = written(_cut_out(rows, taken, length), "repeats-cut-out", compression="zstd")
    ends = written(_few(phrases, length, window), "repeats-few").unionAll(written(_crowded(phrases, length, BAND), "repeats-crowded"))
    return whole.unionAll(ends)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, window: int = WINDOW) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): one row per row of docs; kept has the bytes outside all repeats, in order.

    Null texts are empty ones; repeated rows repeat one another's strings; texts below `length` bytes stay whole.
    """
    if window + GRAM > length + 1 or window < 1 or length > MORE:
        raise ValueError("a string must hold every trigger candidate")
    rows = _keyed(docs, id_col, text_col)
    ranges = repeated_starts(rows, length, window).groupBy("key").agg(F.collect_list("at").alias("ats"))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                done = [cut(press.decompress(z.as_py()), a) for z, a in zip(part.column(1), part.column(2), strict=True)]
                numbers = [pa.array(x, pa.int64()) for x in list(zip(*done, strict=True))[:3]]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, pa.array([d[3] for d in done], pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    def cut(text: bytes, ats: pa.ListScalar) -> tuple[int, int, int, bytes]:
        if not ats.is_valid or not len(ats):
            return len(text), 0, 0, text
        at = ats.values.to_numpy()
        depth = np.zeros(len(text) + 1, np.int64)
        np.add.at(depth, at >> FIRST, 1)
        np.add.at(depth, (at >> FIRST) + (at & MORE) + length, -1)
        gone = np.cumsum(depth)[:-1] > 0
        return len(text), int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), np.frombuffer(text, np.uint8)[~gone].tobytes()

    return packed(rows).join(ranges, "key", "left").select("id", "z", "ats").mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
