"""Byte-level BPE encoding and decoding (operator 9).

Text is cut into pre-tokens by the vocabulary's pattern, and each pre-token is
encoded on its own. Two tiers give its ids:

1. a minimal perfect hash over the vocabulary answers pre-tokens that are
   vocabulary entries as a whole, by one vectorised probe and one comparison;
2. all others merge bytes by rank: the bytes form a linked list, a heap holds
   the mergeable neighbours, and the lowest rank (leftmost on ties) merges
   first, in O(n log n) also for very long pre-tokens.

The hash, at most a vocabulary in size, is built once on the driver and
broadcast. Nothing is shuffled: a lost task reads its documents again.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import col, worker_cache

#: Distinct pre-tokens of a generation that a Python worker remembers, about 250
#: bytes each; it holds two generations, and what is used again moves to the new one.
MEMO_ENTRIES = 3 << 16
_M64 = (1 << 64) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """The token bytes and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash from keys to ``0..n-1``, by hash and displace.

    ``shift[h % n]`` holds, for a bucket of several keys, the displacement that
    sends them all to free slots, and for a single key ``-1 - slot``.
    """

    def __init__(self, shift: np.ndarray, slot_key: np.ndarray):
        self.n, self.shift, self.slot_key = len(shift), shift, slot_key

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        n = len(keys)
        shift, slot_key = np.zeros(n, np.int64), np.zeros(n, np.int64)
        buckets: dict[int, list[tuple[int, int]]] = {}
        for k, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            buckets.setdefault(h % n, []).append((h, k))
        free = bytearray(b"\1") * n
        singles = []
        for b, members in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                singles.append((b, members[0][1]))
                continue
            d = 1
            while True:
                slots = [cls._mix(h, d) % n for h, _ in members]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                d += 1
            shift[b] = d
            for s, (_, k) in zip(slots, members):
                free[s] = 0
                slot_key[s] = k
        for (b, k), s in zip(singles, (s for s in range(n) if free[s])):
            shift[b] = -1 - s
            slot_key[s] = k
        return cls(shift, slot_key)

    @staticmethod
    def _mix(h: int, d: int) -> int:
        h = ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & _M64
        return h ^ (h >> 31)

    def probe(self, keys: list[bytes]) -> np.ndarray:
        """For each key the one entry that it can equal."""
        h = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        d = self.shift[(h % np.uint64(self.n)).astype(np.int64)]
        mixed = (h ^ (np.maximum(d, 0).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(31)
        return self.slot_key[np.where(d < 0, -1 - d, (mixed % np.uint64(self.n)).astype(np.int64))]


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token by merging neighbours of lowest rank first."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    after = list(range(1, n + 1))  # where the node that starts here ends
    before = list(range(-1, n - 1))
    rank_of = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if j <= 0 or j >= n or after[j] != end:  # one of the two has merged since
            continue
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            if (r := rank_of(piece[i:after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if (p := before[i]) >= 0 and (r := rank_of(piece[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


class Encoder:
    """Both tiers for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, hashed: PerfectHash):
        self.keys, self.ids, self.ranks, self.hash = list(ranks), list(ranks.values()), ranks, hashed
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode("utf-8") for p in pieces]
        for piece, key, k in zip(pieces, raw, self.hash.probe(raw).tolist()):
            ids = [self.ids[k]] if self.keys[k] == key else merge_bytes(key, self.ranks)
            self.memo[piece] = b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(self, text: str) -> bytes:
        """Ids as packed little-endian unsigned 32-bit integers."""
        pieces = self.split(text)
        memo = self.memo
        if new := [p for p in set(pieces) if p not in memo]:
            if len(memo) + len(new) > MEMO_ENTRIES:
                self.older, self.memo = memo, (memo := {})
                new = list(set(pieces))
            older = self.older
            memo.update((p, older[p]) for p in new if p in older)
            self._learn([p for p in new if p not in older])
        return b"".join(map(memo.__getitem__, pieces))


def _chunks(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that few long texts are in Python at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _encoder_state(vocabulary: str) -> tuple:
    """What an encoder needs, at most a vocabulary in size."""
    ranks = load_ranks(vocabulary)
    hashed = PerfectHash.build(list(ranks))
    return ranks, hashed.shift, hashed.slot_key


def _encoder(state: tuple, pattern: str) -> Encoder:
    ranks, shift, slot_key = state
    return Encoder(ranks, pattern, PerfectHash(shift, slot_key))


def _decoder_table(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id; ids that the vocabulary leaves out have none."""
    entries = {i: k for k, i in ranks.items()}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]


def _decode(packed: bytes | None, entry) -> bytes | None:
    return None if packed is None else b"".join(map(entry, np.frombuffer(packed, "<u4").tolist()))


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, token_ids`` with one row per input row.

    ``token_ids`` is binary: little-endian unsigned 32-bit ids, four bytes per
    token. A null or empty text gives zero bytes. A null id stays null, repeated
    rows are encoded each, and further columns of ``docs`` are not read.
    ``vocabulary`` is the path of a rank file and ``pattern`` the pre-token
    expression (``regex`` syntax).
    """
    shared = docs.sparkSession.sparkContext.broadcast(_encoder_state(vocabulary))

    def run(batches):
        enc = worker_cache(("bpe-encoder", vocabulary, pattern), lambda: _encoder(shared.value, pattern))
        for whole in batches:
            for b in _chunks(whole):
                ids = [enc.encode(t) if t else b"" for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "token_ids"])

    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    return docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, token_ids binary")


def decode_tokens(tokens: DataFrame, vocabulary: str, keep: list[str]) -> DataFrame:
    """Adds ``decoded`` (binary) to the columns ``keep``: the bytes that the
    packed ids in ``token_ids`` stand for, which need not be valid UTF-8 when
    ids were cut. Null ids give null."""
    spark = tokens.sparkSession
    shared = spark.sparkContext.broadcast(_decoder_table(load_ranks(vocabulary)))

    def run(batches):
        entry = worker_cache(("bpe-decoder", vocabulary), lambda: shared.value).__getitem__
        for whole in batches:
            for b in _chunks(whole):
                packed = b.column(b.num_columns - 1).to_pylist()
                out = pa.array([_decode(p, entry) for p in packed], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], out], [*keep, "decoded"])

    frame = tokens.select(*[col(c) for c in keep], F.col("token_ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[:-1])
    return frame.mapInArrow(run, f"{kinds}, decoded binary")


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id, token_ids, decoded`` with a row per input row: the ids of
    ``encode_documents`` and the bytes that ``decode_tokens`` makes of them, in
    one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(_encoder_state(vocabulary))

    def run(batches):
        enc = worker_cache(("bpe-encoder", vocabulary, pattern), lambda: _encoder(shared.value, pattern))
        entry = worker_cache(("bpe-decoder", vocabulary), lambda: _decoder_table(enc.ranks)).__getitem__
        for whole in batches:
            for b in _chunks(whole):
                ids = [enc.encode(t) if t else b"" for t in b.column(1).to_pylist()]
                text = [_decode(p, entry) for p in ids]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(text, pa.binary())],
                                                 ["doc_id", "token_ids", "decoded"])

    frame = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, token_ids binary, decoded binary")


def digests(coded: DataFrame) -> DataFrame:
    """From ``round_trip``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``
    (lower-case hex)."""
    return coded.select("doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
