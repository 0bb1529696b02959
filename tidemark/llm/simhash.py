"""SimHash near-dedup with pigeonring filtering (operator 2).

Documents get a 64-bit fingerprint of their word shingles. Fingerprints that
differ in at most ``MAX_BITS`` = 2 bits are linked, and groups are what links
connect.

The 64 bits are dealt over a ring of five segments. If two fingerprints differ
in at most 2 bits, some segment starts a chain whose first ``l`` segments differ
in at most ``2 l / 5`` bits, for every ``l`` (pigeonring principle). Rounded
down the budgets are 0, 0, 1, 1 and 2 bits: two neighbouring segments are equal,
and at least one of the next two. These three segments, 38 or 39 bits, are the
join key; the chain's budgets are checked next, and the full Hamming distance
only for what is left. Ten keys cover all starts.

Equal fingerprints meet once, whatever the number of copies. A key that many
*different* fingerprints share is not paired up: its members are linked through
their one-bit neighbours among the bits outside the key. Two of them within 2
bits share such a neighbour, and members that share one are within 2 bits, so
the links connect the same groups, with rows in proportion to the members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame

from .common import col, written
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: First bit and width of the ring's segments.
SEGMENTS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Keys with more fingerprints are linked through neighbours.
PAIRED_KEY = 32


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text in UTF-8, as a signed 64-bit number."""
    words = text.lower().split()  # of bytes: A-Z, and blanks 9 to 13 and 32
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - shingle + 1)
    spans = zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, last)
    ones = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 15):
        part = h[at:at + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > last, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, doc_key, fp``, a row per input row; ``doc_key`` is a hash of the
    whole text. Null and blank texts have fingerprint 0; fewer words than a
    shingle make one shingle."""

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                fp = [fingerprint(t or b"", shingle) for t in b.column(2).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(fp, pa.int64())], ["doc_id", "doc_key", "fp"])

    frame = docs.select(col(id_col).alias("doc_id"), F.xxhash64(col(text_col)).alias("doc_key"), col(text_col).alias("text"))
    return frame.mapInArrow(run, f"doc_id {frame.schema[0].dataType.simpleString()}, doc_key long, fp long")


def _mask(*segments: int) -> int:
    m = sum(((1 << SEGMENTS[s % 5][1]) - 1) << SEGMENTS[s % 5][0] for s in segments)
    return m - (1 << 64) if m >> 63 else m


def _chains() -> list[tuple[int, int]]:
    """(bits of the key, bits on which the chain may differ by one) of each key."""
    return [(_mask(i, i + 1, i + 2 + k), _mask(i + 3 - k)) for i in range(5) for k in (0, 1)]


def links(nodes: DataFrame, paired_key: int = PAIRED_KEY) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all
    within ``MAX_BITS`` bits. Beside document fingerprints they may name one-bit
    neighbours, as points that join members of crowded keys."""
    chains = _chains()
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(k)) for k, _ in chains])).alias("chain", "key"))
    keyed = written(keyed, "simhash-keys")
    sizes = keyed.groupBy("chain", "key").agg(F.count("*").alias("n")).where("n > 1")

    few = sizes.where(F.col("n") <= paired_key).select("chain", "key")
    members = keyed.join(few, ["chain", "key"])
    free = F.element_at(F.array(*[F.lit(m) for _, m in chains]), F.col("chain") + 1)
    groups = members.groupBy("chain", "key").agg(F.array_sort(F.collect_list("fp")).alias("fps"))  # paired_key at most
    pairs = groups.select("chain", "fps", F.posexplode("fps").alias("i", "a")).select(
        "chain", "a", F.explode(F.slice("fps", F.col("i") + 2, F.size("fps"))).alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    near = pairs.where(F.bit_count(x.bitwiseAND(free)) <= 1).where(F.bit_count(x) <= MAX_BITS).select("a", "b")

    many = sizes.where(F.col("n") > paired_key).select("chain", "key")
    crowd = keyed.join(many, ["chain", "key"])
    outside = [[b for b in range(64) if not (k >> b) & 1] for k, _ in chains]
    flips = F.element_at(F.array(*[F.array(*[F.lit(_signed(1 << b)) for b in bits], *[F.lit(0)]) for bits in outside]), F.col("chain") + 1)
    hubs = crowd.select(F.col("fp").alias("a"), F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("b")).distinct()
    met = hubs.groupBy("b").agg(F.min("a").alias("low"), F.count("*").alias("n")).where("n > 1")
    via = hubs.join(met, "b").where("a <> low").select("low", "a").toDF("a", "b")
    return near.unionByName(via).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def group_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, doc_key, fp, root, component_id`` with a row per input row.

    ``root`` is the smallest fingerprint (or joining point) of the group.

    ``component_id`` is the smallest id that links reach, the document's own
    included; null ids are no candidates, and a group without other ids has a
    null one. All texts without words link, as their fingerprints are equal.
    Repeated rows get equal results; further columns are not read.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-nodes")
    groups = written(connected_components(links(nodes)), "fingerprint-groups")
    shared = groups.join(nodes, groups["node"] == nodes["fp"]).groupBy("root").agg(F.min("low").alias("least"))
    linked = groups.join(shared, "root").select(F.col("node").alias("fp"), "root", "least")
    # written, so that in the last join both sides are plain shuffles, which Spark splits where many copies share a fingerprint
    by_fp = written(nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("least")).alias("component_id")), "fingerprint-roots")
    return marked.join(by_fp, "fp").select("doc_id", "doc_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, with all columns of ``docs``: that of the smallest
    id (null ids last; among rows of one id, by a hash of the text). Of rows
    equal in id and text the one whose columns sort first stays, so columns must
    be of types that sort."""
    groups = group_documents(docs, id_col, text_col, shingle)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "doc_key")).alias("x")).select(
        F.col("x.doc_id").alias("k_id"), F.col("x.doc_key").alias("k_key"))
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("doc"), col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("key"))
    kept = rows.join(first, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("key") == F.col("k_key")), "left_semi")
    return kept.groupBy("id", "key").agg(F.min("doc").alias("doc")).select("doc.*")


def hex_digits(fp: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
