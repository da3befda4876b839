"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that is
a token itself.  Tier two: the other pre-tokens are merged with a heap of ranked
neighbour pairs over a linked list of bytes, O(n log n) in the pre-token's length,
so a long run without a blank costs no more per byte than prose.  The short ones of
a slice of texts, each once, are merged together, a pair of each at a time.  Each task
keeps the ids of recent pre-tokens (a bounded memory), as most come back often.

The vocabulary (ranks and pattern) is a parameter.  The driver reads the file,
builds the hash and broadcasts both; their size is bounded by ``MAX_VOCABULARY``.

Defined results for odd input: a null text is an empty text and has no tokens;
repeated rows are encoded each on their own; clashing input columns are replaced
by the operator's; a text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import binary, slices

#: Entries and bytes a vocabulary may have, as it is broadcast.
MAX_VOCABULARY, MAX_VOCABULARY_BYTES = 2_000_000, 64 << 20
#: Bytes of text whose pre-tokens are merged together, and of such a pre-token at most (below 64).
TOGETHER, SHORT = 1 << 20, 32
#: More than any rank, and bits of a rank in the number of a pair.
NONE, RANK_BITS = 1 << 40, 21
#: Pre-tokens whose ids a task remembers.
REMEMBERED = 200_000
#: Mean keys in a bucket of the perfect hash.
BUCKET = 4
#: Plain characters: tab, line ends, printable ASCII and Latin letters, on which all engines agree.
PLAIN = (9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250))
_NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7E\u00A1-\u024F]").search


@dataclass(frozen=True)
class PerfectHash:
    """A minimal perfect hash (hash and displace): n keys, n slots, no empty slot.

    A key's 64-bit hash names its bucket; the bucket's seed names the slot.
    ``slots[k]`` is the index of the key that lives in slot k.  Keys must differ.
    """

    seeds: np.ndarray
    slots: np.ndarray

    @staticmethod
    def build(keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        if len(set(keys)) < n:
            raise ValueError("a perfect hash needs different keys")
        n_buckets = max(1, n // BUCKET)
        buckets: list[list[int]] = [[] for _ in range(n_buckets)]
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            buckets[h % n_buckets].append(i)
        seeds, slots = np.zeros(n_buckets, np.int64), np.full(n, -1, np.int64)
        taken, free = bytearray(n), None
        for b in sorted(range(n_buckets), key=lambda b: -len(buckets[b])):
            own = buckets[b]
            if not own:
                break
            if len(own) == 1:  # a single key takes any free slot; its seed is -1 - slot
                free = free or iter([s for s in range(n) if not taken[s]])
                at, seeds[b] = [next(free)], 0
                seeds[b] = -1 - at[0]
            else:
                seed = 1
                while True:
                    at = [slot(hashes[i], seed, n) for i in own]
                    if len(set(at)) == len(at) and not any(taken[s] for s in at):
                        break
                    seed += 1
                seeds[b] = seed
            for i, s in zip(own, at):
                slots[s], taken[s] = i, 1
        return PerfectHash(seeds, slots)


def plain_pattern(pattern: str) -> Callable | None:
    """The pattern for texts of plain characters: letters and numbers as ranges, for Python's own
    engine, which is twice as fast; None if the pattern has other properties."""
    ranges = {}
    for kind in "LN":
        own = [chr(c) for c in PLAIN if unicodedata.category(chr(c)).startswith(kind)]
        ranges[kind] = "".join(map(re.escape, own))

    def spelled(m: re.Match) -> str:
        inside = re.sub(r"\\p\{([LN])\}", lambda x: ranges[x[1]], m[0])
        return inside if m[0].startswith("[") else f"[{inside}]"

    out = re.sub(r"\[(?:\\.|[^\]\\])*\]|\\p\{[LN]\}", spelled, pattern)
    try:
        return None if r"\p" in out or r"\P" in out else re.compile(out).findall
    except re.error:
        return None


def slot(h: int, seed: int, n: int) -> int:
    """The slot of a hash under a seed."""
    x = (h ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 29)) % n


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by rank, the pattern that cuts pre-tokens, the perfect hash of the ranks, and the
    pairs of tokens that make a short token (sorted numbers) with its rank."""

    tokens: list[bytes]
    pattern: str
    lookup: PerfectHash
    pairs: np.ndarray
    merged: np.ndarray

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        """Read a rank file (base64 token, blank, rank on each line)."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return Vocabulary.of(ranks, pattern)

    @staticmethod
    def of(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
        if len(ranks) > MAX_VOCABULARY or sum(map(len, ranks)) > MAX_VOCABULARY_BYTES:
            raise ValueError(f"a vocabulary of {len(ranks)} tokens is too large to broadcast")
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks the single bytes {missing}")
        if max(ranks.values()) >= MAX_VOCABULARY or min(ranks.values()) < 0 or len(set(ranks.values())) < len(ranks):
            raise ValueError("ranks must be different numbers below the largest vocabulary")
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        # Ranks may have gaps; only tokens are keys.
        lookup = PerfectHash.build(list(ranks))
        found = sorted((ranks[a] << RANK_BITS | ranks[b], rank) for t, rank in ranks.items() if len(t) <= SHORT
                       for k in range(1, len(t)) if (a := t[:k]) in ranks and (b := t[k:]) in ranks)
        pairs, merged = np.array(found or [(-1, NONE)], np.int64).T.copy()
        return Vocabulary(tokens, pattern, PerfectHash(lookup.seeds, np.array(list(ranks.values()))[lookup.slots]), pairs, merged)


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.tokens, self.n = vocabulary.tokens, len(vocabulary.lookup.slots)
        self.seeds, self.slots = vocabulary.lookup.seeds.tolist(), vocabulary.lookup.slots.tolist()
        self.pieces, self.plain_pieces = regex.compile(vocabulary.pattern).findall, plain_pattern(vocabulary.pattern)
        self.ranks = {t: i for i, t in enumerate(self.tokens) if t}
        self.packed = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        self.pairs, self.ranks_merged = vocabulary.pairs, vocabulary.merged
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.memory = Memory(self, remembered)

    def whole(self, piece: bytes) -> int:
        """The id of a pre-token that is a token, else -1 (minimal perfect hash)."""
        h = xxhash.xxh64_intdigest(piece)
        seed = self.seeds[h % len(self.seeds)]
        i = self.slots[-1 - seed if seed < 0 else slot(h, seed, self.n)]
        return i if self.tokens[i] == piece else -1

    def merged(self, piece: bytes) -> list[int]:
        """Ids by repeatedly merging the pair of lowest rank, leftmost first."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))       # of the part that starts here; 0 when it is gone
        before = list(range(-1, n - 1))   # start of the part to the left
        # A pair's rank, start and stop as one number: (rank * n + start) * (n + 1) + stop.
        m = n + 1
        heap = [(r * n + i) * m + i + 2 for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            key = heapq.heappop(heap)
            i, stop = key // m % n, key % m
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue                  # one of the two parts has changed
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r * n + i) * m + end[stop])
            left = before[i]
            if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heapq.heappush(heap, (r * n + left) * m + stop)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the token that each pair makes, else ``NONE``."""
        pair = a << RANK_BITS | b
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks_merged[at], NONE)

    def merged_together(self, pieces: list[bytes]) -> list[bytes]:
        """What ``merged`` gives for each of many short pre-tokens, packed: all parts in one array; each round
        merges the pair of lowest rank, leftmost first, of every pre-token that has one."""
        sizes, which = np.fromiter(map(len, pieces), np.int64, len(pieces)), np.arange(len(pieces))
        parts = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.append(self.rank(parts[:-1], parts[1:]), NONE)   # of a part with the next one
        ranks[np.cumsum(sizes) - 1] = NONE
        ready = []
        while len(which):
            starts = np.cumsum(sizes) - sizes
            place = np.arange(len(parts)) - np.repeat(starts, sizes)
            best = np.minimum.reduceat(ranks << 6 | place, starts)
            live = best >> 6 < NONE
            if not live.all():
                kept = np.repeat(live, sizes)
                ready.append((which[~live], sizes[~live], parts[~kept]))
                parts, ranks, which, sizes, best = parts[kept], ranks[kept], which[live], sizes[live], best[live]
            at = np.cumsum(sizes) - sizes + (best & 63)
            parts[at] = best >> 6
            kept = np.ones(len(parts), bool)
            kept[at + 1] = False
            parts, ranks, sizes = parts[kept], ranks[kept], sizes - 1
            stops = np.cumsum(sizes)
            at = stops - sizes + (best & 63)
            ranks[at] = NONE
            right, left = at[at + 1 < stops], at[best & 63 > 0] - 1
            ranks[right] = self.rank(parts[right], parts[right + 1])
            ranks[left] = self.rank(parts[left], parts[left + 1])
        out = [b""] * len(pieces)
        for own, lengths, ids in ready:
            packed, stops = ids.astype("<u4").tobytes(), 4 * np.cumsum(lengths)
            for k, start, stop in zip(own.tolist(), (stops - 4 * lengths).tolist(), stops.tolist()):
                out[k] = packed[start:stop]
        return out

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text."""
        return (self.plain_pieces if self.plain_pieces and not _NOT_PLAIN(text) else self.pieces)(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        self.memory.trim()
        return b"".join(map(self.memory.__getitem__, self.cut(text)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the pre-tokens of all texts that are not remembered are looked up together."""
        self.memory.trim()
        cut = [self.cut(t) for t in texts]
        self.memory.learn(set().union(*cut).difference(self.memory))
        return [b"".join(map(self.memory.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        return decoded(self.tokens, ids)


def decoded(tokens: list[bytes], ids: bytes) -> bytes:
    """The bytes of packed ids; needs the tokens only."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Memory(dict):
    """Packed ids by pre-token; computed when first asked for."""

    def __init__(self, codec: Codec, most: int):
        super().__init__()
        self.codec, self.most = codec, most

    def __missing__(self, piece: str) -> bytes:
        codec, data = self.codec, piece.encode()
        i = codec.whole(data)
        out = codec.packed[i] if i >= 0 else b"".join(codec.packed[t] for t in codec.merged(data))
        if len(data) <= 64:               # long pre-tokens seldom come back
            self[piece] = out
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Remember all of the pieces that are short; the others are left for when they are asked for."""
        codec, rest = self.codec, {}
        for piece in pieces:
            if len(data := piece.encode()) <= SHORT:
                if (i := codec.whole(data)) >= 0:
                    self[piece] = codec.packed[i]
                else:
                    rest[piece] = data
        self.update(zip(rest, codec.merged_together(list(rest.values()))))

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


def _mapped(docs: DataFrame, vocabulary: Vocabulary, column: str, results: tuple[str, ...],
            one: Callable[[Vocabulary], Callable]) -> DataFrame:
    """``docs`` with the binary columns ``results`` that ``one`` makes from the values of ``column``."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = docs.drop(*results)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), *(f"`{r}` binary" for r in results)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = one(held.value)
        for part in slices(batches, column, TOGETHER):
            made = convert(binary(part.column(column)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *(pa.array(x, pa.binary()) for x in made)], [*part.schema.names, *results])

    return kept.mapInArrow(work, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` plus ``ids``: the token ids as little-endian unsigned 32-bit integers."""
    def one(held: Vocabulary) -> Callable:
        codec = Codec(held)
        return lambda texts: (codec.encode_all([x.decode() for x in texts]),)

    return _mapped(docs, vocabulary, text, (ids,), one)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` plus ``into``: the bytes of the tokens, concatenated."""
    return _mapped(docs, vocabulary, ids, (into,), lambda held: lambda packed: ([decoded(held.tokens, x) for x in packed],))


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` plus the ids and their decoding, both made in one pass by one worker of each task."""
    def one(held: Vocabulary) -> Callable:
        codec = Codec(held)

        def both(texts: list[bytes]) -> tuple[list[bytes], list[bytes]]:
            packed = codec.encode_all([x.decode() for x in texts])
            return packed, [codec.decode(x) for x in packed]
        return both

    return _mapped(docs, vocabulary, text, (ids, into), one)


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes."""
    return round_trip(docs.select("doc_id", "text"), vocabulary).select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
