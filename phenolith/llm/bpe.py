"""BPE encoding by speculation and verification, and decoding.

A word's tokens are first proposed by greedy longest match. A sequence of tokens is the word's BPE
encoding exactly if each adjacent pair is its own encoding, so the pairs of all new words of a batch
are tested together, in numpy; words with a failing pair are merged exactly. The vocabulary file is
read by the driver and sent to the executors once; its size does not depend on the data.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches

#: Characters with the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0  -     　"
#: Ranges of characters that the regular expressions here call letters or numbers and the
#: tokenizer library, of an older Unicode version, does not; and capitals (first, last, distance to the
#: small letters) that this Python, of an older version still, does not know.
NOT_YET = [(0x558, 0x558), (0x58b, 0x58c), (0x88f, 0x88f), (0xc5c, 0xc5c), (0xcdc, 0xcdc), (0x208f, 0x208f), (0x209d, 0x209f), (0xa7ce, 0xa7cf), (0xa7d2, 0xa7d2), (0xa7d4, 0xa7d4), (0xa7dd, 0xa7dd), (0xa7e2, 0xa7e2), (0xa7f1, 0xa7f1), (0xab6c, 0xab6d), (0x107bb, 0x107bf), (0x10940, 0x10959), (0x10ec5, 0x10ec7), (0x10ed9, 0x10eee), (0x11b0a, 0x11b0a), (0x11db0, 0x11ddb), (0x11de0, 0x11de9), (0x11df1, 0x11df1), (0x1246f, 0x1246f), (0x12475, 0x1247f), (0x12550, 0x12686), (0x16ea0, 0x16eb8), (0x16ebb, 0x16ed3), (0x16ff2, 0x16ff3), (0x16ff4, 0x16ff6), (0x187f8, 0x187ff), (0x18cd6, 0x18cda), (0x18d09, 0x18d20), (0x18d80, 0x18df2), (0x18e00, 0x19191), (0x191a0, 0x191d2), (0x1b123, 0x1b128), (0x1b168, 0x1b168), (0x1d6a6, 0x1d6a6), (0x1df1f, 0x1df24), (0x1df2b, 0x1df81), (0x1df90, 0x1df96), (0x1dfcd, 0x1dfff), (0x1e6c0, 0x1e6de), (0x1e6e0, 0x1e6e2), (0x1e6e4, 0x1e6e5), (0x1e6e7, 0x1e6ed), (0x1e6f0, 0x1e6f4), (0x1e6fe, 0x1e6ff), (0x2b73a, 0x2b73f), (0x2b81e, 0x2b81e), (0x2cea2, 0x2cead), (0x323b0, 0x33479), (0x3d000, 0x3fc3f)]
CAPITALS = [(0x1c89, 0x1c89, 1), (0xa7cb, 0xa7cb, -42343), (0xa7cc, 0xa7cc, 1), (0xa7ce, 0xa7ce, 1), (0xa7d2, 0xa7d2, 1), (0xa7d4, 0xa7d4, 1), (0xa7da, 0xa7da, 1), (0xa7dc, 0xa7dc, -42561), (0x10d50, 0x10d65, 32), (0x16ea0, 0x16eb8, 27)]
#: Words that the cache holds before it starts anew, characters of a word that may enter it, and of texts handled at once.
CACHE_WORDS, CACHE_CHARS, PIECE = 200_000, 40, 1 << 19
#: Symbols up to which words are merged side by side in numpy; longer ones are merged one by one, with a heap.
SIDE_BY_SIDE = 64
NEVER = np.int64(1) << 62


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Lookup:
    """A fixed map from non-negative longs to longs, by open addressing in numpy arrays."""

    def __init__(self, keys: list[int], values: list[int]):
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        todo, code, val = np.arange(len(keys)), np.array(keys, np.int64), np.array(values, np.int64)
        slot = self._slot(code)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            first = todo[free][np.unique(slot[todo[free]], return_index=True)[1]]
            self.keys[slot[first]], self.values[slot[first]] = code[first], val[first]
            todo = np.setdiff1d(todo, first)
            taken = todo[self.keys[slot[todo]] >= 0]
            slot[taken] = (slot[taken] + 1) & ((1 << self.bits) - 1)

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, code: np.ndarray, default: int) -> np.ndarray:
        slot = self._slot(code)
        key = self.keys[slot]
        out = np.where(key == code, self.values[slot], default)
        left = np.flatnonzero((key != code) & (key >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            key = self.keys[slot[left]]
            hit = key == code[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (key >= 0)]
        return out


def token_strings(spec: dict) -> list[str]:
    """Token strings by id, those of special tokens included."""
    every = spec["model"]["vocab"] | {a["content"]: a["id"] for a in spec["added_tokens"]}
    out = [""] * (max(every.values()) + 1)
    for s, k in every.items():
        out[k] = s
    return out


class WordBpe:
    """Byte-level BPE with word ends over lower-cased NFC text, from the JSON of a tokenizer file."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        self.end = model["end_of_word_suffix"]
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {a["content"]: a["id"] for a in j["added_tokens"]}
        self.strings = token_strings(j)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = j["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE)
        newer = "".join(f"{chr(a)}-{chr(b)}" for a, b in NOT_YET)
        self.words = regex.compile(f"(?V1){pattern}".replace(r"[\p{L}]", rf"[\p{{L}}--[{newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{newer}]]").replace(rf"[^{SPACE}\p{{L}}\p{{N}}]+", rf"(?:[^{SPACE}\p{{L}}\p{{N}}]|[{newer}])+"))
        self.small = {c: c + d for a, b, d in CAPITALS for c in range(a, b + 1)}
        # the same in the standard library's syntax, letters first, for texts of characters that its classes hold alike
        known = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+"
        self.plain_words = re.compile(r"[^\W\d_]+|'(?:[stmd]|re|ve|ll)|\d|(?:[^\w\s]|_)+") if pattern == known else None
        self.plain: dict[str, bool] = {}
        size, back = len(self.strings), {c: b for b, c in enumerate(byte_chars())}
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.merge.setdefault((x, y), (r, z))
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        self.pair_rank = Lookup([x * size + y for x, y in self.merge], [r for r, _ in self.merge.values()])
        self.made = np.zeros(len(merges), np.int64)
        for r, z in self.merge.values():
            self.made[r] = z
        self.size = size
        raw = lambda s: bytes(back[c] for c in s)
        self.inner = {raw(s): k for s, k in vocab.items() if not s.endswith(self.end)}
        self.final = {raw(s[: -len(self.end)]): k for s, k in vocab.items() if s.endswith(self.end)}
        # a token that merging cannot reach is never proposed
        for table, at_end in ((self.inner, False), (self.final, True)):
            for s in [s for s, k in table.items() if len(s) > 1 and self._merged(s, at_end) != [k]]:
                del table[s]
        self.single_inner = np.array([self.inner[bytes([b])] for b in range(256)], np.int64)
        self.single_final = np.array([self.final[bytes([b])] for b in range(256)], np.int64)
        self._trie()
        self.forget()

    def forget(self) -> None:
        """Drop words and pairs met so far: the worker process may do other work next."""
        self.cache: dict[str, bytes] = {}
        self.known, self.valid = np.empty(0, np.int64), np.empty(0, bool)

    def _merged(self, word: bytes, at_end: bool = True) -> list[int]:
        """Exact merging: the pair of least rank first, of equal ranks the leftmost."""
        n = len(word)
        ids = [self.inner[word[i : i + 1]] for i in range(n)]
        if at_end:
            ids[-1] = self.final[word[-1:]]
        if n == 1:
            return ids
        before, after, merge = [*range(-1, n - 1)], [*range(1, n + 1)], self.merge
        heap = [(m[0], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := merge.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            k = after[i]
            if ids[i] != a or k >= n or ids[k] != b:
                continue
            ids[i], ids[k] = merge[a, b][1], -1
            after[i] = after[k]
            if after[i] < n:
                before[after[i]] = i
                if m := merge.get((ids[i], ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[after[i]]))
            if before[i] >= 0 and (m := merge.get((ids[before[i]], ids[i]))):
                heapq.heappush(heap, (m[0], before[i], ids[before[i]], ids[i]))
        return [k for k in ids if k >= 0]

    def _trie(self) -> None:
        nodes = {b"": 0}
        for t in (self.inner, self.final):
            for token in t:
                for k in range(1, len(token) + 1):
                    nodes.setdefault(token[:k], len(nodes))
        self.steps = Lookup([nodes[s[:-1]] * 256 + s[-1] for s in nodes if s], [k for s, k in nodes.items() if s])
        self.inner_at, self.final_at = np.full(len(nodes), -1, np.int64), np.full(len(nodes), -1, np.int64)
        for t, at in ((self.inner, self.inner_at), (self.final, self.final_at)):
            for token, k in t.items():
                at[nodes[token]] = k

    def _greedy(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Owners and ids of the tokens proposed for the words data[start:end], by longest match; all words advance together."""
        owners, tokens = [], []
        word, at, pos, node = np.arange(len(starts)), starts.copy(), starts.copy(), np.zeros(len(starts), np.int64)
        best, best_to = np.full(len(starts), -1, np.int64), starts.copy()
        while len(word):
            more = pos < ends[word]
            nxt = np.full(len(word), -1, np.int64)
            nxt[more] = self.steps.get(node[more] * 256 + data[pos[more]], -1)
            go = nxt >= 0
            g = np.flatnonzero(go)
            node[g] = nxt[g]
            pos[g] += 1
            found = np.where(pos[g] == ends[word[g]], self.final_at[node[g]], self.inner_at[node[g]])
            hit = found >= 0
            best[g[hit]], best_to[g[hit]] = found[hit], pos[g[hit]]
            d = np.flatnonzero(~go)
            owners.append(word[d])
            tokens.append(best[d])
            at[d] = pos[d] = best_to[d]
            node[d] = 0
            best[d] = -1
            left = np.ones(len(word), bool)
            left[d] = at[d] < ends[word[d]]
            if not left.all():
                word, at, pos, node, best, best_to = (v[left] for v in (word, at, pos, node, best, best_to))
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return owner[order], token[order]

    def _merged_all(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words: in each round, each word's pair of least rank, of equal ranks the leftmost."""
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), NEVER)
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self.pair_rank.get(ids[inside] * self.size + ids[inside + 1], NEVER)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            low = np.minimum.reduceat(rank, starts)
            length = np.diff(np.r_[starts, len(ids)])
            open_ = np.repeat(low < NEVER, length)
            done_ids.append(ids[~open_])
            done_owner.append(owner[~open_])
            is_low = np.flatnonzero(open_ & (rank == np.repeat(low, length)))
            first = is_low[np.r_[True, owner[is_low[1:]] != owner[is_low[:-1]]]] if len(is_low) else is_low
            ids[first] = self.made[rank[first]]
            open_[first + 1] = False
            ids, owner = ids[open_], owner[open_]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def _compatible(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is the encoding of its own bytes.

        Walks back in time over what stood on either side of the border: a merge across it would
        have come first if its rank is below that of the merge that used up the left piece, and not
        above that of the merge that used up the right piece.
        """
        ok = np.ones(len(one), bool)
        at, x, y = np.arange(len(one)), one.astype(np.int64), two.astype(np.int64)
        used_x = np.full(len(one), NEVER)
        used_y = used_x.copy()
        while len(at):
            m = self.pair_rank.get(x * self.size + y, NEVER)
            cross = (m < used_x) & (m <= used_y) & (m < NEVER)
            ok[at[cross]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~cross & ((rx >= 0) | (ry >= 0))
            at, x, y, used_x, used_y, rx, ry = (v[go] for v in (at, x, y, used_x, used_y, rx, ry))
            undo = rx > ry
            used_x, used_y = np.where(undo, rx, used_x), np.where(undo, used_y, ry)
            x, y = np.where(undo, self.right[x], x), np.where(undo, y, self.left[y])
        return ok

    def _pairs_ok(self, code: np.ndarray) -> np.ndarray:
        """Of pair codes, from those already judged and else by _compatible."""
        new = np.setdiff1d(code, self.known)
        if len(new):
            if len(self.known) > 2_000_000:
                self.known, self.valid, new = np.empty(0, np.int64), np.empty(0, bool), np.unique(code)
            known = np.r_[self.known, new]
            valid = np.r_[self.valid, self._compatible(new // self.size, new % self.size)]
            order = np.argsort(known, kind="stable")
            self.known, self.valid = known[order], valid[order]
        return self.valid[np.searchsorted(self.known, code)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        data, ends = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64), np.cumsum([len(w) for w in raw])
        starts = np.r_[0, ends[:-1]]
        owner, ids = self._greedy(data, starts, ends)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        bad = np.zeros(len(raw), bool)
        bad[owner[inside[~self._pairs_ok(ids[inside] * self.size + ids[inside + 1])]]] = True
        keep = ~bad[owner]
        parts = [(ids[keep], owner[keep])]
        short = bad & (ends - starts <= SIDE_BY_SIDE)
        if short.any():
            of = np.repeat(np.arange(len(raw)), ends - starts)
            single = self.single_inner[data]
            single[ends - 1] = self.single_final[data[ends - 1]]
            parts.append(self._merged_all(single[short[of]], of[short[of]]))
        for k in np.flatnonzero(bad & ~short).tolist():
            exact = self._merged(raw[k])
            parts.append((np.array(exact, np.int64), np.full(len(exact), k)))
        ids, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        out, cuts = ids[np.argsort(owner, kind="stable")].astype("<u4").tobytes(), np.r_[0, np.cumsum(np.bincount(owner, minlength=len(raw)))] * 4
        return [out[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]

    def _words(self, text: str) -> list[str | int]:
        out: list[str | int] = []
        for k, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                if not part.isascii():
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ").translate(self.small)
                part = part.lower()
                out += (self.plain_words if self.plain_words and all(map(self._is_plain, set(part))) else self.words).findall(part)
        return out

    def _is_plain(self, c: str) -> bool:
        if c not in self.plain:
            kind = unicodedata.category(c)[0]
            self.plain[c] = unicodedata.category(c) != "Cn" and (kind == "L") == bool(re.match(r"[^\W\d_]", c)) and (kind == "N") == bool(re.match(r"\d", c)) and bool(re.match(f"[{SPACE}]", c)) == bool(re.match(r"\s", c))
        return self.plain[c]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        split, cache = [self._words(t) for t in texts], self.cache
        used = set(chain.from_iterable(split))
        new = used.difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = used
        fresh = [w for w in new if isinstance(w, str)]
        now: dict = {w: w.to_bytes(4, "little") for w in new if isinstance(w, int)}
        now |= zip(fresh, self.encode_words(fresh), strict=True)
        cache.update(now)
        out = [b"".join(map(cache.__getitem__, ws)) for ws in split]
        for w in now:
            if isinstance(w, str) and len(w) > CACHE_CHARS:
                del cache[w]
        return out


def _model(sent: object) -> WordBpe:
    """One model for each worker process and vocabulary."""
    held = globals().setdefault("_HELD", {})
    if sent.id not in held:
        held[sent.id] = WordBpe(sent.value)
    return held[sent.id]


class _Sent:
    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.id, self.b = hash(spec), spark.sparkContext.broadcast(spec)

    @property
    def value(self) -> str:
        return self.b.value


def _runs(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Slices of a column of texts, each of PIECE characters or so, with their places; a null is an empty text."""
    part: list[str] = []
    size, first = 0, 0
    for k, t in enumerate(column):
        part.append(t.as_py() or "")
        size += len(part[-1])
        if size >= PIECE:
            yield first, part
            part, size, first = [], 0, k + 1
    if part:
        yield first, part


def _encoded(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None, schema: str, rows: Callable[[list[bytes]], list[pa.Array]]) -> DataFrame:
    """One worker a task, and batches that leave it as soon as they are encoded: its memory does not depend on Spark's batch size."""
    small_batches(docs.sparkSession)
    sent = _Sent(docs.sparkSession, vocabulary or default_path())
    names = [x.split()[0] for x in schema.split(", ")]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(sent)
        for b in batches:
            for first, texts in _runs(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), *rows(model.encode_batch(texts))], names)
        model.forget()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, ids): one row per row of docs; ids holds little-endian unsigned 32-bit token ids. A null text is an empty one."""
    return _encoded(docs, id_col, text_col, vocabulary, "id long, ids binary", lambda ids: [pa.array(ids, pa.binary())])


def token_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, n_tokens, token_ids array<int>): one row per row of docs, as encode()."""

    def rows(ids: list[bytes]) -> list[pa.Array]:
        cuts = np.r_[0, np.cumsum([len(x) // 4 for x in ids])].astype(np.int32)
        return [pa.array(np.diff(cuts), pa.int64()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))]

    return _encoded(docs, id_col, text_col, vocabulary, "id long, n_tokens long, token_ids array<int>", rows)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(id, ids) -> (id, ids, text): token strings joined by spaces, as the file names no decoder."""
    sent = _Sent(encoded.sparkSession, vocabulary or default_path())

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = token_strings(json.loads(sent.value))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [" ".join([strings[k] for k in np.frombuffer(x.as_py() or b"", "<u4").tolist()]) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, ids binary, text string")
