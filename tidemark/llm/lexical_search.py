"""Exact ranked lexical search with two trees (operator 11).

The score of a document for an item is a sum over the item's terms, so both are
sparse vectors: a document's coordinate is the saturated frequency of a term, an
item's its number of occurrences times the term's weight. A node of a tree of
documents holds the greatest coordinate of its documents, term by term, and a node
of a tree of items that of its items. The product of the two is no less than any
score of a document below the one for an item below the other. Where that bound
can't reach the weakest k-th score among the node's items, the whole batch of pairs
is left out, without loss.

Items are dealt into blocks of bounded size, which go to every task. For each block:

1. a pass over the texts writes each document's frequencies of the block's terms;
   document frequencies and lengths are summed from that table;
2. tasks build trees over chunks of documents (a forest) and search them with the
   tree of items, both sides descending together. A task keeps the best k of each
   item, which tightens the bounds as it goes;
3. before that, the same search over one chunk's worth of documents in
   ``PROBE_SHARE`` gives each item a k-th score to start from. It is the k-th best of
   some documents, so no pruning by it loses one of the best of all.

Scores are 64-bit integers; bounds are computed in doubles and rounded up.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from .common import LOWER, UPPER, col, written

#: Bytes of item texts in a block, about, which bounds the block's terms.
BLOCK_BYTES = 128 << 10
#: Documents of a tree, entries after which it is closed before, and the
#: documents and items of a leaf.
TREE_DOCUMENTS, TREE_ENTRIES, LEAF_DOCUMENTS, LEAF_ITEMS = 4096, 2_000_000, 16, 8
#: Coordinates of all leaves of a tree; where items have very many terms, leaves hold more documents.
LEAF_CELLS = 4 << 20
#: One document in so many is searched first, for the scores to start from.
PROBE_SHARE = 64

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Letters lower-cased and separators made blanks, byte by byte; bytes of characters
#: outside ASCII all belong to terms.
_TABLE = bytes.maketrans(_SEPARATORS + UPPER.encode(), b" " * len(_SEPARATORS) + LOWER.encode())


def terms(text: bytes | None) -> list[bytes]:
    """A text's terms in order, with repeats; none for null."""
    return (text or b"").translate(_TABLE).split()


class Block:
    """Items with their terms, numbered by the block's vocabulary."""

    def __init__(self, rows):
        """``rows``: (number, text as bytes)."""
        self.numbers = [n for n, _ in rows]
        self.vocabulary: dict[bytes, int] = {}
        self.items = []  # (term numbers, occurrences) of each item
        for _, text in rows:
            seen: dict[int, int] = {}
            for t in terms(text):
                i = self.vocabulary.setdefault(t, len(self.vocabulary))
                seen[i] = seen.get(i, 0) + 1
            self.items.append((np.array(list(seen), "i8"), np.array(list(seen.values()), "i8")))


def item_blocks(items: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES):
    """Written ``number, item, block, text`` and the number of blocks; ``item`` is
    the whole row. Blocks are dealt by a hash, so they are of about that size."""
    numbered = written(items.select(F.monotonically_increasing_id().alias("number"), F.struct("*").alias("item"),
                                    col(text_col).cast("binary").alias("text")), "search-items")
    total = numbered.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    return numbered.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks))), blocks


def vectors(docs: DataFrame, block: Block, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: a document's number of terms, and its
    frequencies of the block's terms."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def run(batches):
        number = vocabulary.value
        for b in batches:
            n, ends, ids, tfs = [], [0], [], []
            for text in b.column(1):
                words, seen = terms(text.as_py()), {}
                for w in words:
                    seen[w] = seen.get(w, 0) + 1
                known = seen.keys() & number.keys()
                ids += [number[w] for w in known]
                tfs += [seen[w] for w in known]
                n.append(len(words))
                ends.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (ids, tfs)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _split_order(ends, ids, values, width: int, leaf: int):
    """An order of sparse rows in which similar rows are close: halves by two
    distant rows, again and again, down to ``leaf`` rows."""
    lengths = np.diff(ends)
    order, parts = np.arange(len(lengths)), [(0, len(lengths))]
    norm = np.sqrt(np.bincount(np.repeat(order, lengths), values * values, len(lengths))) + 1e-9
    dense = np.zeros(width)
    while parts:
        a, z = parts.pop()
        if z - a <= leaf:
            continue
        rows = order[a:z]
        entries, own = _entries(ends, rows)
        terms_, weights = ids[entries], values[entries]

        def likeness(pivot):
            mine = ids[ends[pivot]:ends[pivot + 1]]
            dense[mine] = values[ends[pivot]:ends[pivot + 1]]
            out = np.bincount(own, weights * dense[terms_], len(rows)) / norm[rows] / norm[pivot]  # noqa: B023
            dense[mine] = 0
            return out

        one = rows[np.argmin(likeness(rows[0]))]
        near = likeness(one)
        far = likeness(rows[np.argmin(near)])
        order[a:z] = rows[np.argsort(far - near, kind="stable")]
        half = max(1, (z - a) // 2)
        parts += [(a, a + half), (a + half, z)]
    return order


def _entries(ends, rows):
    """The entries of some rows of compressed sparse rows, and which row each is of."""
    lengths = ends[rows + 1] - ends[rows]
    own = np.repeat(np.arange(len(rows)), lengths)
    return np.arange(len(own)) + np.repeat(ends[rows] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths), own


class ItemTree:
    """A binary tree over a block's items: greatest weights, and items, of each node."""

    def __init__(self, items, weights: np.ndarray):
        """``items``: each one's term numbers and occurrences."""
        self.items = [(t, n * weights[t]) for t, n in items]
        self.width = len(weights)
        ends = np.concatenate([[0], np.cumsum([len(t) for t, _ in self.items])]).astype("i8")
        ids = np.concatenate([t for t, _ in self.items]) if self.items else np.zeros(0, "i8")
        values = np.concatenate([v for _, v in self.items]).astype("f8") if self.items else np.zeros(0)
        self.root = self._node(_split_order(ends, ids, values, self.width, LEAF_ITEMS))

    def _node(self, members):
        if len(members) <= LEAF_ITEMS:
            children, parts = [], [self.items[i] for i in members]
        else:
            half = max(1, len(members) // 2)
            children = [self._node(members[:half]), self._node(members[half:])]
            parts = [c["top"] for c in children]
        ids, place = np.unique(np.concatenate([t for t, _ in parts]) if parts else np.zeros(0, "i8"), return_inverse=True)
        top = np.zeros(len(ids), "i8")
        np.maximum.at(top, place, np.concatenate([v for _, v in parts]) if parts else np.zeros(0, "i8"))
        return {"members": members, "children": children, "top": (ids, top)}


class Best:
    """The best k documents of each item so far, and the score that a document
    must reach."""

    def __init__(self, k: int, floors):
        """``floors``: the k-th best score known of each item, or 0."""
        self.k, self.rows = k, [[] for _ in floors]
        self.floors = [max(int(f), 1) for f in floors]

    def weakest(self, members) -> int:
        return min(self.floors[i] for i in members)

    def add(self, item: int, scores, docs):
        keep = np.flatnonzero(scores >= self.floors[item])
        if len(keep):
            rows = self.rows[item] + [(-int(scores[i]), docs[i] is None, docs[i] or 0) for i in keep]
            rows.sort()
            self.rows[item] = rows = rows[:self.k]
            if len(rows) == self.k:
                self.floors[item] = max(self.floors[item], -rows[-1][0])


def search_tree(tree: ItemTree, best: Best, docs, ends, ids, values) -> int:
    """Search a chunk of documents; the number of scores computed. ``docs`` are
    ids; ``ends, ids, values`` their coordinates as compressed sparse rows."""
    used, column = np.unique(ids, return_inverse=True)  # the terms that the chunk has
    leaf = max(LEAF_DOCUMENTS, -(-len(docs) * len(used) // LEAF_CELLS))
    order = _split_order(ends, ids, values.astype("f8"), tree.width, leaf)
    # leaves of equal numbers of documents in that order, and levels of pairs of nodes above
    leaf_of = np.empty(len(docs), "i8")
    leaf_of[order] = np.arange(len(docs)) // leaf
    n_leaves = -(-len(docs) // leaf)
    low = np.zeros((n_leaves, len(used)))
    np.maximum.at(low.reshape(-1), np.repeat(leaf_of, np.diff(ends)) * len(used) + column, values.astype("f8"))
    levels = [low]
    while len(levels[-1]) > 8:
        x = levels[-1]
        if len(x) % 2:
            x = np.concatenate([x, np.zeros((1, x.shape[1]))])
        levels.append(x.reshape(-1, 2, x.shape[1]).max(1))
    place = np.full(tree.width, -1)
    place[used] = np.arange(len(used))
    scored = 0

    def bounds(level, nodes, top):
        at = place[top[0]]
        here = at >= 0
        if not here.any():
            return np.zeros(len(nodes))
        return levels[level][np.ix_(nodes, at[here])] @ top[1][here].astype("f8") * (1 + 1e-9)

    def visit(item_node, level, nodes):
        nonlocal scored
        reach = bounds(level, nodes, item_node["top"])
        keep = reach >= best.weakest(item_node["members"])
        if not keep.any():
            return
        nodes, reach = nodes[keep], reach[keep]
        if level:
            below = np.concatenate([nodes * 2, nodes * 2 + 1])
            nodes = np.sort(below[below < len(levels[level - 1])])
            for child in item_node["children"] or [item_node]:
                visit(child, level - 1, nodes)
        elif item_node["children"]:
            for child in item_node["children"]:
                visit(child, 0, nodes)
        else:
            downwards = np.argsort(-reach, kind="stable")
            for at in range(0, len(downwards), 4):
                some = downwards[at:at + 4]
                if reach[some[0]] < best.weakest(item_node["members"]):
                    break  # the leaves after these reach no further
                scored += score(item_node, nodes[some])

    def score(item_node, leaves):
        """Exact scores of all documents of some leaves for all items of a leaf."""
        rows = np.concatenate([order[n * leaf:(n + 1) * leaf] for n in leaves])
        entries, own = _entries(ends, rows)
        terms_ = item_node["top"][0]
        at = np.full(tree.width, -1)
        at[terms_] = np.arange(len(terms_))
        where = at[ids[entries]]
        hit = where >= 0
        dense = np.zeros((len(rows), len(terms_)), "i8")
        dense[own[hit], where[hit]] = values[entries[hit]]
        names = [docs[i] for i in rows]
        for i in item_node["members"]:
            t, w = tree.items[i]
            best.add(i, dense[:, at[t]] @ w, names)
        return len(rows) * len(item_node["members"])

    top = len(levels) - 1
    if len(used) and len(tree.items):
        visit(tree.root, top, np.arange(len(levels[top])))
    return scored


def search(rows: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, floors, k: int) -> DataFrame:
    """``number, doc_id, score``: the best ``k`` documents of each item in each
    task, among those that reach the floors."""
    shared = rows.sparkSession.sparkContext.broadcast((block.numbers, block.items, weights, floors))  # plain data, which tasks can read

    def run(batches):
        numbers, items, weights, floors = shared.value
        tree, best = ItemTree(items, weights), Best(k, floors)
        held = []

        def flush():
            docs = [x for b in held for x in b.column(0).to_pylist()]
            n = np.concatenate([b.column(1).to_numpy() for b in held])
            lengths = np.concatenate([np.diff(b.column(2).offsets.to_numpy()) for b in held])
            ids = np.concatenate([b.column(2).flatten().to_numpy() for b in held]).astype("i8")
            tf = np.concatenate([b.column(3).flatten().to_numpy() for b in held]).astype("i8")
            held.clear()
            if len(n) and int(n.max()) * 25 * n_docs >= 1 << 63:
                n = n.astype(object)  # whole numbers of any size
            m = np.repeat((75 + 25 * n * n_docs // n_terms).astype("i8"), lengths)
            search_tree(tree, best, docs, np.concatenate([[0], np.cumsum(lengths)]).astype("i8"), ids,
                        1_000_000_000 * tf // (1000 * tf + 12 * m))

        for b in batches:
            a = 0
            while a < b.num_rows:
                room = TREE_DOCUMENTS - sum(x.num_rows for x in held)
                part = b.slice(a, room)
                held.append(part)
                a += part.num_rows
                if part.num_rows == room or sum(len(x.column(2).flatten()) for x in held) > TREE_ENTRIES:
                    flush()
        if held:
            flush()
        out = [(numbers[i], None if none else d, -s) for i, found in enumerate(best.rows) for s, none, d in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), (), ()))], ["number", "doc_id", "score"])

    return rows.where("size(terms) > 0").select("doc_id", "n", "terms", "tfs").mapInArrow(run, "number long, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                  item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, probe_share: int = PROBE_SHARE) -> DataFrame:
    """``item, rank, doc_id, score``: for each row of ``items`` (``item``, the whole
    row as a struct) its ``k`` best documents with a score above 0, or all of them
    if there are fewer; equal scores by ascending id, null ids last.

    Every row is a document or an item of its own, also if its id is repeated or
    null. Null texts and texts without terms match nothing. Ids are whole numbers.
    Further columns of ``docs`` are not read. Empty tables give no rows.
    """
    numbered, n_blocks = item_blocks(items, item_text_col, block_bytes)
    found = None
    for i in range(n_blocks):
        block = Block([(r.number, r.text) for r in numbered.where(F.col("block") == i).select("number", "text").collect()])  # bounded
        rows = written(vectors(docs, block, id_col, text_col), f"search-vectors-{i}")
        n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(block.vocabulary), "i8")
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term of the block
            df[r.t] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], "i8")
        run = lambda some, floors: search(some, block, weights, n_docs, n_terms, floors, k)  # noqa: E731, B023
        probe = run(rows.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(probe_share)) == 0), [0] * len(block.items))
        kth = {r.number: r.score for r in _top(probe, k).where(F.col("rank") == k).select("number", "score").collect()}  # a row per item
        best = written(_top(run(rows, [kth.get(n, 0) for n in block.numbers]), k), f"search-found-{i}")
        found = best if found is None else found.unionByName(best)
    return found.join(numbered.select("number", "item"), "number").select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
