"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers cut the same bytes.  Byte offsets where both end a token cut a text into
groups; two tokens whose byte ranges overlap are linked.  For every pair (A id, B id) an
inverted index holds compressed bitmaps of the documents in which the pair is linked:

    docs      the documents of a container (at most 65,536 neighbouring ones): their
              16-bit places while they are few, else one bit for each place
    planes    bitmaps of the binary digits of (links in the document - 1), lowest first

Bitmaps of one container are united (OR) as its slices are read; a pair's document count
is the sum of its containers' popcounts, its link count adds 2^k popcounts of plane k.
Then the postings return scores: every container meets its pairs' counts and deals them
out to the documents that its bitmaps name, as often as the planes say.

The shuffles carry one row for each pair and container, so a pair that occurs in every
document is spread over the containers, and counts are combined before they move.  The
best counts, one for each A id, are bounded by A's vocabulary (``MAX_VOCABULARY``).

Defined results for odd input: texts that are null or empty, or whose tokens do not spell
the text (invalid bytes, a tokenizer that normalises) have no tokens: all counts are zero
and ``groups`` is empty; repeated rows and rows without an id are documents of their own;
an empty table gives no rows; other columns are ignored; only one text has to fit a task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import Staging, binary, slices

#: Ids a vocabulary may have, and bytes of a tokenizer's file, as it is broadcast.
MAX_VOCABULARY, MAX_FILE_BYTES = 2_000_000, 64 << 20
#: Places in a container; links after which it is closed; bytes of text in a slice.
PLACES, MAX_LINKS, SLICE = 1 << 16, 10_000_000, 2 << 20
#: From so many documents on a bitmap has one bit for each place: 2^16 bits.
DENSE = 4096
#: Posting rows in an Arrow batch.
BATCH = 100_000
# Fixed value: the pattern by which byte-level tokenizers of this file format cut a text.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose class no library's Unicode tables disagree on: a text with others is encoded by A's own library.
SETTLED = "\\t\\n\\r\x20-\x7E\u00A1-\u024F\u0400-\u045F\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3"


def byte_of_symbol() -> dict[str, int]:
    """The byte that each printable symbol of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, all other bytes follow from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass(frozen=True)
class Tokenizers:
    """The files of both tokenizers: A is byte-level (JSON), B a piece model with byte fallback."""

    a: bytes
    b: bytes

    @staticmethod
    def load(path_a: str, path_b: str) -> Tokenizers:
        with open(path_a, "rb") as a, open(path_b, "rb") as b:
            files = Tokenizers(a.read(), b.read())
        if max(len(files.a), len(files.b)) > MAX_FILE_BYTES:
            raise ValueError("a tokenizer's file is too large to broadcast")
        return files


class Aligner:
    """Both tokenizers of one task, the bytes of their tokens, and the alignment of a slice."""

    def __init__(self, files: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        symbol = byte_of_symbol()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(symbol[c] for c in token if c in symbol)
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        if max(len(self.bytes_a), len(self.bytes_b)) > MAX_VOCABULARY:
            raise ValueError("a vocabulary is too large")
        self.ranked = self._by_rank(files.a)
        self.unsettled = re.compile(f"[^{SETTLED}]").search
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # Ids as text with the mark that follows them: A's within and at the end of a group, then B's.
        self.marked = [b"%d%s" % (i, mark) for n, marks in ((len(self.bytes_a), (b",", b"|")), (len(self.bytes_b), (b",", b";")))
                       for mark in marks for i in range(n)]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(re.fullmatch("<0x([0-9A-F]{2})>", piece)[1], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()

    def _by_rank(self, file: bytes):
        """The same tokenizer as a rank table, several times as fast, if its file is no more than that."""
        import tiktoken

        content = json.loads(file)
        model, cut = content["model"], content["pre_tokenizer"] or {}
        odd = [content["normalizer"], *(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                               "end_of_word_suffix", "byte_fallback", "ignore_merges"))]
        if model["type"] != "BPE" or any(odd) or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space"):
            return None
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in pairs]
        ranks = {t: i for i, t in enumerate(self.bytes_a) if i < 256 or len(t) > 1}
        if ids != list(range(256, 256 + len(ids))) or {len(t) for t in self.bytes_a[:256]} != {1}:
            return None       # ranks are not the order of the merges
        ranks = {t: i for t, i in ranks.items() if i < 256 + len(ids)}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        fast = [self.ranked is not None and not self.unsettled(x) for x in texts]
        slow = iter(self.a.encode_batch_fast([x for x, f in zip(texts, fast) if not f], add_special_tokens=False))
        return [self.ranked.encode_ordinary(x) if f else next(slow).ids for x, f in zip(texts, fast)]

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[int]], list[list[int]]]:
        """(rows, A ids, B ids) of the texts whose tokens spell a blank and the text."""
        rows = [k for k, x in enumerate(texts) if x]
        plain = [texts[k].decode(errors="replace") for k in rows]
        a = self.ids_a([" " + x for x in plain])
        b = self.b.encode(plain, num_threads=1) if plain else []
        good = [n for n, k in enumerate(rows) if self._spells(self.bytes_a, a[n], texts[k])
                and self._spells(self.bytes_b, b[n], texts[k])]
        return np.array([rows[n] for n in good], np.int64), [a[n] for n in good], [b[n] for n in good]

    @staticmethod
    def _spells(table: list[bytes], ids: list[int], text: bytes) -> bool:
        return b"".join(map(table.__getitem__, ids)) == b" " + text

    def aligned(self, texts: list[bytes]) -> Aligned:
        rows, a, b = self.ids(texts)
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        a, b = (np.concatenate([np.array(x, np.int64) for x in [[], *lists]]) for lists in (a, b))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        borders = np.cumsum([0, *(len(texts[k]) + 1 for k in rows)])
        at_a, at_b = np.zeros(borders[-1], bool), np.zeros(borders[-1], bool)
        at_a[ends_a - 1], at_b[ends_b - 1] = True, True
        upto_a, upto_b = np.cumsum(at_a), np.cumsum(at_b)       # tokens that end up to each byte
        joint = np.flatnonzero(at_a & at_b)
        # Between neighbouring ends of either side lies one piece of one A and one B token.
        pieces = np.flatnonzero(at_a | at_b)
        link_a, link_b = a[upto_a[pieces] - at_a[pieces]], b[upto_b[pieces] - at_b[pieces]]
        per_text = lambda places: np.diff(np.searchsorted(places, borders))
        n_links = per_text(pieces)
        return Aligned(rows, n_a, n_b, per_text(joint), n_links, np.repeat(rows, n_links), link_a, link_b,
                       self._groups(a, b, upto_a[joint], upto_b[joint], n_a + n_b))

    def _groups(self, a, b, last_a, last_b, n) -> list[str]:
        """The SHA-256 of each text's groups, written out as ids; a group ends with tokens ``last_a``, ``last_b`` (from 1)."""
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a - 1], mark_b[last_b - 1] = 1, 1
        group_a, group_b = np.cumsum(mark_a) - mark_a, np.cumsum(mark_b) - mark_b
        out = np.empty(len(a) + len(b), np.int64)
        # An A token stands behind the B tokens of earlier groups, a B token behind the A tokens up to its own.
        out[np.arange(len(a)) + np.append(0, last_b)[group_a]] = a + mark_a * len(self.bytes_a)
        out[np.arange(len(b)) + last_a[group_b]] = 2 * len(self.bytes_a) + b + mark_b * len(self.bytes_b)
        marked, at, digests = self.marked, 0, []
        for size in n.tolist():
            written = b"".join(map(marked.__getitem__, out[at:at + size].tolist()))
            digests.append(hashlib.sha256(written[:-1]).hexdigest())
            at += size
        return digests


@dataclass
class Aligned:
    """A slice's texts that have tokens (``rows``), their counts, links and written groups."""

    rows: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_row: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    groups: list[str]


def bitmaps(places: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Compressed bitmaps of runs of sorted 16-bit places; ``counts`` are the runs' lengths."""
    data, ends = places.astype("<u2"), np.cumsum(counts)
    if not (counts >= DENSE).any():
        offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
    out = []
    for stop, n in zip(ends.tolist(), counts.tolist()):
        run = data[stop - n:stop]
        if n >= DENSE:
            bits = np.zeros(PLACES, bool)
            bits[run] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
        else:
            out.append(run.tobytes())
    return pa.array(out, pa.binary())


def places(bitmap: bytes) -> np.ndarray:
    """The places in a compressed bitmap."""
    if len(bitmap) < 2 * DENSE:
        return np.frombuffer(bitmap, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little"))


POSTING = "container long, pair long, docs binary, planes array<binary>"
COUNTS = "at int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def postings(container: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The posting rows of a container; a key is a link's pair above its document's 16-bit place."""
    keys, links = np.unique(keys, return_counts=True)
    pair, place = keys >> np.uint64(16), (keys & np.uint64(0xFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
    for lo in range(0, len(first), BATCH):
        heads = first[lo:lo + BATCH]
        stop = first[lo + BATCH] if lo + BATCH < len(first) else len(pair)
        counts = np.diff(np.append(heads, stop))
        more, run = links[heads[0]:stop] - 1, np.repeat(np.arange(len(heads)), counts)
        # A bit of every digit: (run, digit) slots in order, places ascending in each.
        digits = np.zeros(len(heads), np.int64)
        many = np.flatnonzero(more)
        np.maximum.at(digits, run[many], np.frexp(more[many].astype(float))[1])
        slot = np.concatenate([[0], np.cumsum(digits)])
        width = int(digits.max(initial=0))
        found = [(many[(more[many] >> k & 1).astype(bool)], k) for k in range(width)]
        at = np.concatenate([slot[run[i]] + k for i, k in found] or [many])
        which = np.concatenate([i for i, _ in found] or [many])
        order = np.lexsort((which, at))
        planes = bitmaps(place[heads[0]:stop][which[order]], np.bincount(at, minlength=slot[-1]).astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(heads), container)), pa.array(pair[heads].astype(np.int64)),
             bitmaps(place[heads[0]:stop], counts), pa.ListArray.from_arrays(pa.array(slot.astype(np.int32)), planes)],
            ["container", "pair", "docs", "planes"])


def index(docs: DataFrame, files: Tokenizers, max_links: int = MAX_LINKS) -> DataFrame:
    """Two kinds of rows: one for each document (its container, place and counts), and the postings.

    A pair is A id * 2^24 + B id.
    """
    held = docs.sparkSession.sparkContext.broadcast(files)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, container, size, keys, links = Aligner(held.value), TaskContext.get().partitionId() << 32, 0, [], 0
        id_type = None
        for part in slices(batches, "text", SLICE):
            for part in (part.slice(k, PLACES) for k in range(0, part.num_rows, PLACES)):
                id_type = part.column("doc_id").type
                if size + part.num_rows > PLACES or links > max_links:
                    yield from (_wide(b, id_type) for b in postings(container, np.concatenate(keys)))
                    container, size, keys, links = container + 1, 0, [], 0
                found = aligner.aligned(binary(part.column("text")).to_pylist())
                pairs = found.link_a.astype(np.uint64) << np.uint64(24) | found.link_b.astype(np.uint64)
                # United with what the container has when it is closed.
                keys.append(np.sort(pairs << np.uint64(16) | (found.link_row + size).astype(np.uint64)))
                links += len(pairs)
                yield _documents(part, found, container, size)
                size += part.num_rows
        if keys:
            yield from (_wide(b, id_type) for b in postings(container, np.concatenate(keys)))

    return docs.select("doc_id", "text").mapInArrow(work, f"{POSTING}, doc_id {kind}, {COUNTS}")


def _documents(part: pa.RecordBatch, found: Aligned, container: int, size: int) -> pa.RecordBatch:
    n = part.num_rows
    counts = np.zeros((4, n), np.int64)
    counts[:, found.rows] = found.n_a, found.n_b, found.n_groups, found.n_links
    groups = [""] * n
    for row, digest in zip(found.rows.tolist(), found.groups):
        groups[row] = digest
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, container)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.binary())),
         part.column("doc_id"), pa.array(np.arange(size, size + n, dtype=np.int32)), *map(pa.array, counts), pa.array(groups)],
        ["container", "pair", "docs", "planes", "doc_id", "at", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])


def _wide(batch: pa.RecordBatch, id_type: pa.DataType) -> pa.RecordBatch:
    n = batch.num_rows
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.nulls(n, id_type), pa.nulls(n, pa.int32()), *(pa.nulls(n, pa.int64()) for _ in range(4)), pa.nulls(n, pa.string())],
        [*batch.schema.names, "doc_id", "at", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])


def popcount(bitmap) -> F.Column:
    """The number of places in a compressed bitmap column."""
    return F.when(F.octet_length(bitmap) < 2 * DENSE, (F.octet_length(bitmap) / 2).cast("long")).otherwise(F.bitmap_count(bitmap))


def pair_counts(posted: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links, best): popcounts of each pair's bitmaps over all containers.

    ``best`` is whether no other pair of the same A id occurs in more documents.
    """
    links = popcount(F.col("docs")) + F.aggregate(
        F.transform("planes", lambda p, k: F.pow(F.lit(2), k).cast("long") * popcount(p)),
        F.lit(0).cast("long"), lambda total, n: total + n)
    counts = posted.groupBy("pair").agg(F.sum(popcount(F.col("docs"))).alias("n_docs"), F.sum(links).alias("n_links"))
    most = counts.groupBy(F.shiftright("pair", 24).alias("a")).agg(F.max("n_docs").alias("most"))
    # One row for each A id: bounded by the vocabulary.
    return counts.join(F.broadcast(most), F.shiftright("pair", 24) == F.col("a")).select(
        "pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def returned(posted: DataFrame, counts: DataFrame) -> DataFrame:
    """(container, at, n_best, count_sum): what the postings return to each document."""
    def work(table: pa.Table) -> pa.Table:
        best, total = np.zeros(PLACES, np.int64), np.zeros(PLACES, np.int64)
        hit = np.zeros(PLACES, bool)
        for batch in table.to_batches(max_chunksize=10_000):
            rows = zip(batch.column("docs").to_pylist(), batch.column("planes").to_pylist(),
                       batch.column("n_docs").to_pylist(), batch.column("best").to_pylist())
            for docs, planes, n_docs, is_best in rows:
                for bitmap, weight in ((docs, 1), *((p, 1 << k) for k, p in enumerate(planes))):
                    at = places(bitmap)
                    hit[at] = True
                    total[at] += weight * n_docs
                    if is_best:
                        best[at] += weight
        at = np.flatnonzero(hit)
        return pa.table({"container": pa.array(np.full(len(at), table.column("container")[0].as_py())),
                         "at": pa.array(at.astype(np.int32)), "n_best": best[at], "count_sum": total[at]})

    rows = posted.join(counts, "pair").select("container", "docs", "planes", "n_docs", "best")
    return rows.groupBy("container").applyInArrow(work, "container long, at int, n_best long, count_sum long")


def align(docs: DataFrame, files: Tokenizers, max_links: int = MAX_LINKS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every document."""
    staging = Staging(docs.sparkSession, "token-alignment")
    both = staging.put("index", index(docs, files, max_links))
    posted = both.where("pair IS NOT NULL").select("container", "pair", "docs", "planes")
    scores = returned(posted, pair_counts(posted)).withColumnsRenamed({"container": "c", "at": "t"})
    texts = both.where("pair IS NULL")
    out = texts.join(scores, (F.col("container") == F.col("c")) & (F.col("at") == F.col("t")), "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")}
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero.values(), "groups_sha256")


def alignment(docs: DataFrame, files: Tokenizers) -> DataFrame:
    """(pair_a, pair_b, n_docs, n_links, best): the corpus-wide counts of all linked pairs."""
    staging = Staging(docs.sparkSession, "token-alignment")
    posted = staging.put("index", index(docs, files)).where("pair IS NOT NULL")
    return pair_counts(posted).select(F.shiftright("pair", 24).cast("int").alias("a"),
                                      F.col("pair").bitwiseAND((1 << 24) - 1).cast("int").alias("b"), "n_docs", "n_links", "best")
