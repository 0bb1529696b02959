"""Removal of repeated long byte strings (operator 8).

Every byte inside a string of ``LENGTH`` bytes that also starts earlier in the
corpus is removed. Equal strings must meet, and long ones differ in most places
of a corpus, so candidates are narrowed first:

1. Winnowing. Every window of ``LENGTH`` bytes has an anchor, the 32-byte string
   in it with the least hash. Equal windows have equal anchors at equal offsets.
   Anchor hashes are counted; a filter of bounded size tells which repeat. (A
   corpus too large for the filter lets more through, never less.)
2. Units. Windows with one anchor start next to each other. Their starts are cut
   into blocks of ``STEP`` by their offset from the anchor; a unit is the text
   under such a block, and its key a hash of the bytes that all windows of the
   whole block share. So all occurrences of a window meet at one key, and a
   passage of any popularity is spread over many keys. Equal units of one task
   are sent once, and within a key only the earliest of equal units goes on;
   the others are removed as a whole.
3. Suffix array. Different units of the same keys are joined into texts of
   bounded size. Over the Burrows-Wheeler transform of a suffix array, intervals
   of suffixes with a common prefix are extended backwards, breadth first, so
   that common prefixes are found by increasing length. Intervals of one suffix
   are dropped, and extension stops at ``LENGTH``. What remains are the repeated
   windows; all but the earliest occurrence are removed.

A key with more than ``CROWD`` different units is not held in memory: its windows
are grouped by their bytes in a shuffle that combines them beforehand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .common import col, written

LENGTH = 100
ANCHOR = 32
STEP = 23
#: Bytes of different units that one suffix array covers, about.
BLOCK_BYTES = 1 << 20
#: Different units of one key that a task holds.
CROWD = 8_000
#: Greatest size of the filter of repeated anchors, in bits.
MAX_FILTER_BITS = 1 << 27
#: Bytes of units that a task holds to find equal ones before the shuffle.
HELD_BYTES = 48 << 20
#: No byte of UTF-8.
END = 0xFF

_CHUNK_BITS = 20
_WINDOW = LENGTH - ANCHOR + 1  # anchor places in a window


class _Rolling:
    """Hashes of all substrings of one length, from prefix sums modulo 2**64."""

    def __init__(self):
        n, base = 1 << _CHUNK_BITS, 0x9E3779B97F4A7C15
        power, inverse = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
        power[0] = inverse[0] = 1
        self.power, self.inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        self.place = np.arange(n, dtype=np.uint64)

    def sums(self, chunk: np.ndarray) -> np.ndarray:
        out = np.zeros(len(chunk) + 1, np.uint64)
        np.cumsum((chunk.astype(np.uint64) + np.uint64(1)) * self.power[:len(chunk)], out=out[1:])
        return out

    @staticmethod
    def mix(h: np.ndarray) -> np.ndarray:
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def anchors(self, chunk: np.ndarray, sums: np.ndarray):
        """Hash and place of each anchor, and the window starts ``[a, b)`` that have it."""
        m = len(chunk) - ANCHOR + 1
        h = self.mix((sums[ANCHOR:] - sums[:-ANCHOR]) * self.inverse[:m])
        low = np.uint64((1 << _CHUNK_BITS) - 1)
        least, size = (h & ~low) | self.place[:m], 1
        while 2 * size <= _WINDOW:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < _WINDOW:
            rest = _WINDOW - size
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & low).astype(np.int64)
        a = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        return h[at[a]], at[a], a, np.concatenate([a[1:], [len(at)]])


def _chunks(text: bytes):
    """Pieces of a text with their place; every window lies in exactly one."""
    size = 1 << _CHUNK_BITS
    for at in range(0, max(1, len(text) - LENGTH + 1), size - LENGTH + 1):
        piece = text[at:at + size]
        if len(piece) >= LENGTH:
            yield at, piece


def _texts(batch: pa.RecordBatch, i: int):
    return (x.as_py() for x in batch.column(i).cast(pa.binary()))


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """``h``: hashes of anchors that occur twice or more, of ``doc_id, doc_key, text``."""

    def run(batches):
        rolling = _Rolling()
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                found = []
                for text in _texts(whole.slice(at, 2048), 0):
                    for _, piece in _chunks(text or b""):
                        chunk = np.frombuffer(piece, np.uint8)
                        found.append(rolling.anchors(chunk, rolling.sums(chunk))[0])
                if found:
                    h, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(np.minimum(n, 2).astype(np.int8))], ["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n byte").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1").select("h")


def _filter_words(repeated: DataFrame) -> np.ndarray:
    """A two-probe bit filter of the hashes, as 64-bit words."""
    bits = min(MAX_FILTER_BITS, max(1 << 12, 1 << (12 * repeated.count()).bit_length()))
    slots = repeated.select(F.explode(F.array(
        F.col("h").bitwiseAND(bits - 1), F.shiftright("h", 32).bitwiseAND(bits - 1))).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return out


_UNIT = "key long, off int, unit binary, doc_id long, doc_key long, pos long, len int"


def units(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """Units of ``docs`` around anchors that the filter knows. A row without
    ``unit`` is a range ``pos, len`` found to be repeated already."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    names = [c.split()[0] for c in _UNIT.split(", ")]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches):
        rolling, words = _Rolling(), shared.value
        mask = np.uint64(len(words) * 64 - 1)
        held: dict[tuple, tuple] = {}
        again: list[tuple] = []
        size = 0

        def known(h):
            ok = np.ones(len(h), bool)
            for probe in (h & mask, (h >> np.uint64(32)) & mask):
                ok &= (words[(probe >> np.uint64(6)).astype(np.int64)] >> (probe & np.uint64(63)) & np.uint64(1)).astype(bool)
            return ok

        def cut(piece):
            """(key, offset of the anchor, start, end) of the units of a piece."""
            chunk = np.frombuffer(piece, np.uint8)
            sums = rolling.sums(chunk)
            h, p, a, b = rolling.anchors(chunk, sums)
            ok = known(h)
            p, a, b = p[ok], a[ok], b[ok]
            for q in range(-(-_WINDOW // STEP)):
                lo, hi = np.maximum(a, p - q * STEP - STEP + 1), np.minimum(b - 1, p - q * STEP)
                on = lo <= hi
                pp, lo, hi = p[on], lo[on], hi[on]
                # what every window of a whole block holds: from its last start to its first end
                core, end = pp - q * STEP, pp - q * STEP - STEP + 1 + LENGTH
                key = rolling.mix((sums[end] - sums[core]) * rolling.inverse[core] + np.uint64(q)).view(np.int64)
                yield from zip(key.tolist(), (pp - lo).tolist(), lo.tolist(), (hi + LENGTH).tolist())

        def rows():
            runs: list[list] = []  # what is repeated within the task, overlapping ranges merged
            for doc, text_key, at, n in sorted(again, key=lambda r: _order(r[:3])):
                if runs and runs[-1][:2] == [doc, text_key] and at <= runs[-1][3]:
                    runs[-1][3] = max(runs[-1][3], at + n)
                else:
                    runs.append([doc, text_key, at, at + n])
            for doc, text_key, at, end in runs:
                # spread by place: these only pass through the shuffle
                yield hash((text_key, at)), None, None, doc, text_key, at, end - at
            for (key, off, unit), (doc, text_key, at) in held.items():
                yield key, off, unit, doc, text_key, at, len(unit)

        def flush():
            lines = list(rows())
            for i in range(0, len(lines), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines[i:i + 10_000]), types)], names)
            held.clear()
            again.clear()

        for b in batches:
            for doc, text_key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _texts(b, 2)):
                for at, piece in _chunks(text or b""):
                    for key, off, lo, hi in cut(piece):
                        name, place = (key, off, piece[lo:hi]), (doc, text_key, at + lo)
                        if (old := held.get(name)) is None:
                            held[name] = place
                            size += hi - lo + 200
                        elif old != place:
                            first, later = (old, place) if _order(old) < _order(place) else (place, old)
                            held[name] = first
                            again.append((*later, hi - lo))
                            size += 120
                if size > HELD_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select("doc_id", "doc_key", "text").mapInArrow(run, _UNIT)


def _order(place: tuple) -> tuple:
    """Places by document, null ids last, then by text and position."""
    doc, text_key, at = place
    return doc is None, doc or 0, text_key, at


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their next ``depth`` bytes (at least 8), and a rank
    by 8 bytes. Ranks are joined three at a time, so text is under 2 MB."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + n]
    order, rank = _ranked(key)
    by8, known = rank, 8
    while known < depth:
        parts = []
        for step in (0, 1, 2):
            shift = min(step * known, depth - known)
            parts.append(np.concatenate([rank[shift:] + np.uint64(1), np.zeros(min(shift, n), np.uint64)])[:n])
        order, rank = _ranked((parts[0] << np.uint64(42)) | (parts[1] << np.uint64(21)) | parts[2])
        known = min(3 * known, depth)
    return order, by8


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64)
    return order, rank


def repeated_intervals(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of ``text`` and the intervals ``[lo, hi)`` of it, of two
    suffixes or more, that share their first ``length`` bytes, none of them END.

    Suffixes sorted by ``length`` bytes only are enough: an interval of common
    prefixes up to that length is the same in whichever order ties are.
    """
    order, by8 = suffix_array(text, length)
    before = text[order - 1]  # the transform; position 0 is preceded by the last byte, an END
    step = np.empty(len(text), np.int64)  # where the suffix that starts one byte earlier is
    step[np.argsort(before, kind="stable")] = np.arange(len(text))
    changes = np.flatnonzero(before[1:] != before[:-1]) + 1
    run_end = np.repeat(np.concatenate([changes, [len(text)]]), np.diff(np.concatenate([[0], changes, [len(text)]])))

    # the first sort gave the common prefixes of 8 bytes
    sorted8 = by8[order]
    lo = np.concatenate([[0], np.flatnonzero(sorted8[1:] != sorted8[:-1]) + 1])
    hi = np.concatenate([lo[1:], [len(text)]])
    ends = np.concatenate([[0], np.cumsum(text == END)])
    reach = np.minimum(order[lo] + 8, len(text))
    good = (hi - lo > 1) & (ends[reach] == ends[order[lo]]) & (order[lo] + 8 <= len(text))
    lo, hi = lo[good], hi[good]
    for _ in range(8, length):
        if not len(lo):
            break
        one = run_end[lo] >= hi  # all suffixes of the interval are preceded by the same byte
        same = one & (before[lo] != END)
        new_lo = step[lo[same]]
        new_hi = new_lo + (hi - lo)[same]
        lo, hi = lo[~one], hi[~one]
        if len(lo):
            size = hi - lo
            which = np.repeat(np.arange(len(lo)), size)
            j = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
            c = before[j].astype(np.int64)
            key = which * 256 + c
            by = np.argsort(key, kind="stable")
            key, first = key[by], step[j[by]]
            at = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            n = np.diff(np.concatenate([at, [len(key)]]))
            ok = (n > 1) & (key[at] % 256 != END)
            new_lo, new_hi = np.concatenate([new_lo, first[at[ok]]]), np.concatenate([new_hi, first[at[ok]] + n[ok]])
        lo, hi = new_lo, new_hi
    return order, lo, hi


def later_windows(parts: list[bytes], ranks: list, length: int = LENGTH):
    """``(part, start, end)``: bytes of parts inside windows that another part
    holds too and of which this is not the occurrence of least rank."""
    text = np.frombuffer(b"".join(p + bytes([END]) for p in parts), np.uint8)
    order, lo, hi = repeated_intervals(text, length)
    if not len(lo):
        return []
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    rank = np.empty(len(parts), np.int64)
    rank[sorted(range(len(parts)), key=ranks.__getitem__)] = np.arange(len(parts))
    size = hi - lo
    at = np.cumsum(size) - size
    pos = order[np.arange(size.sum()) - np.repeat(at, size) + np.repeat(lo, size)]
    part = np.searchsorted(starts, pos, "right") - 1
    own = rank[part]
    late = np.sort(pos[own != np.repeat(np.minimum.reduceat(own, at), size)])
    if not len(late):
        return []
    owner = np.searchsorted(starts, late, "right") - 1
    cut = np.flatnonzero((np.diff(late) > 1) | (np.diff(owner) > 0)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(late)]]) - 1
    return [(o, a - starts[o], b - starts[o] + length) for o, a, b in zip(owner[first].tolist(), late[first].tolist(), late[last].tolist())]


def repeated_ranges(dealt: DataFrame) -> DataFrame:
    """``doc_id, doc_key, start, end`` (and ``unit`` where a key was crowded) from
    units that are partitioned by key and sorted."""
    names = ["doc_id", "doc_key", "start", "end", "unit"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        out: list[tuple] = []
        block: list[tuple] = []  # (unit, place of the anchor, start)
        group: list[tuple] = []
        state = {"bytes": 0, "crowded": False}

        def expand():
            for i, a, b in later_windows([u for u, _, _ in block], [_order(p) for _, p, _ in block]):
                (doc, text_key, _), at = block[i][1], block[i][2]
                out.append((doc, text_key, at + int(a), at + int(b), None))
            block.clear()
            state["bytes"] = 0

        def spill():
            out.extend((p[0], p[1], at, at + len(u), u) for u, p, at in group)
            group.clear()

        def close():
            if state["crowded"]:
                spill()
            elif len(group) > 1:
                block.extend(group)
                state["bytes"] += sum(len(u) for u, _, _ in group)
                if state["bytes"] >= BLOCK_BYTES:
                    expand()
            group.clear()
            state["crowded"] = False

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out.clear()
            return made

        key = off = unit = place = None
        for b in batches:
            for k, o, u, doc, text_key, at, n in zip(*(c.to_pylist() for c in b.columns)):
                if u is None:
                    out.append((doc, text_key, at, at + n, None))
                    continue
                if k != key:
                    close()
                    unit = None
                if u == unit and o == off:
                    if (doc, text_key, at) != place:
                        out.append((doc, text_key, at, at + n, None))
                    continue
                key, off, unit, place = k, o, u, (doc, text_key, at)
                group.append((u, (doc, text_key, at + o), at))
                if len(group) > CROWD:
                    state["crowded"] = True
                    spill()
                if len(out) >= 20_000:
                    yield batch()
        close()
        expand() if block else None
        if out:
            yield batch()

    return dealt.mapInArrow(run, "doc_id long, doc_key long, start long, end long, unit binary")


def _crowded_ranges(spilled: DataFrame) -> DataFrame:
    """Ranges of units whose key was crowded, by grouping all their windows."""
    windows = spilled.select("doc_id", "doc_key", F.explode(F.transform(
        F.sequence(F.lit(0), F.octet_length("unit") - LENGTH), lambda i: F.struct(
            (F.col("start") + i).alias("at"), F.substring(F.col("unit"), i + 1, F.lit(LENGTH)).alias("w")))).alias("x")).select(
        "doc_id", "doc_key", "x.*")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "doc_key", "at")
    first = windows.groupBy("w").agg(F.min(place).alias("first"))
    return windows.join(first, "w").where(place > F.col("first")).select(
        "doc_id", "doc_key", F.col("at").alias("start"), (F.col("at") + LENGTH).alias("end"))


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_key, ranges``: byte ranges ``start, end`` to remove, not yet
    merged, for documents that have any."""
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("doc_key"), col(text_col).alias("text")).where(
        F.octet_length("text") >= LENGTH)
    words = _filter_words(written(repeated_anchors(rows), "anchors"))
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = units(rows, words).repartition(int(parts), "key").sortWithinPartitions(
        "key", "off", "unit", F.col("doc_id").isNull(), "doc_id", "doc_key", "pos")
    found = written(repeated_ranges(dealt), "repeats")
    ranges = found.where("unit IS NULL").select("doc_id", "doc_key", "start", "end").unionByName(
        _crowded_ranges(found.where("unit IS NOT NULL")))
    return ranges.groupBy("doc_id", "doc_key").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` with a row per input row.

    ``spans`` are the maximal removed runs as ``start, end`` in bytes, ``kept``
    (binary) the other bytes. A null or empty text is empty, and texts under
    ``LENGTH`` bytes stay whole. Earlier means: by id (an integer), then, among
    rows of one id or of none, by a hash of the text; null ids are last. Rows
    equal in id and text are one document and get one result.
    """
    found = find_repeats(docs, id_col, text_col).select(F.col("doc_id").alias("r_id"), F.col("doc_key").alias("r_key"), "ranges")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.xxhash64(col(text_col)).alias("doc_key"), col(text_col).alias("text"))
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("doc_key") == F.col("r_key")), "left").select(
        "doc_id", "text", F.array_sort("ranges").alias("ranges"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                sizes, spans, kept = [], [], []
                for text, ranges in zip(_texts(b, 1), b.column(2).to_pylist()):
                    text, runs, left, at = text or b"", [], [], 0
                    for r in ranges or ():
                        if runs and r["start"] <= runs[-1]["end"]:
                            runs[-1]["end"] = max(runs[-1]["end"], r["end"])
                        else:
                            runs.append(r)
                    for r in runs:
                        left.append(text[at:r["start"]])
                        at = r["end"]
                    sizes.append(len(text))
                    spans.append(runs)
                    kept.append(b"".join([*left, text[at:]]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")
