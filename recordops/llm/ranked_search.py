"""Ranked lexical search: branch and bound over tries of documents, frequent terms first.

Documents are restricted to the terms of the items and kept as vectors of (term, tf) in a
stored table, which also gives the counts of the measure. Each task then takes a few
thousand vectors at a time, orders their terms by falling document frequency and lets
them share the paths of a trie (an FP-tree whose unbranched stretches are one node;
documents with the same vector and measure share a leaf). Every node carries the largest
tf of each term and the smallest length part m below it. With these the score formula
gives a bound for all documents below: w (tf / (tf + m)) rises in tf and falls in m. The
search goes depth first, best bounds first, per item, in blocks of (node, item) pairs,
and leaves a subtree when its bound is below the item's worst kept score (or equal to it
and no smaller id lies below). The kept lists go on from trie to trie of a task; at the
end each task sends its best rows, and the best of these are the result.

Items are worked through in blocks of a bounded number of terms, so what is broadcast is
bounded for any number of items. Rows of one item id are one item (their terms together);
null and empty texts have no terms: such items get no rows, such documents are not found.
Documents with the same id are ranked each for itself. Document ids are integers; those
without id rank last among equal scores. No result depends on partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordops.llm.base import ALNUM, LOWER, bounded, flat_bytes, settle, slices, word_spans

BLOCK_TERMS = 1 << 17  # terms of items in one block, about
TRIE_ROWS = 4096  # documents in one trie
SMALL = 4  # a subtree of so few different vectors is not split any further
PAIRS = 8192  # (node, item) pairs opened together
LOOK_UPS = 1 << 20  # terms looked up together
NO_ID = np.iinfo(np.int64).max


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different lower-cased terms of the texts, the number of each term in order, and the terms before each row."""
    data, offsets = flat_bytes(texts)
    data = LOWER[data]
    starts, ends, before = word_spans(data, offsets, ALNUM)
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = np.ascontiguousarray(data[ALNUM[data]])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(kept)])
    words = words.dictionary_encode()
    return words.dictionary, np.asarray(words.indices, dtype=np.int64), before


def item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Different terms of each item: item_id (of its own type), term."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                terms, at, before = words_of(batch.column(1)[a:b])
                row = np.repeat(np.arange(b - a), np.diff(before))
                pairs = np.unique(row * max(len(terms), 1) + at)
                found = terms.take(pa.array(pairs % max(len(terms), 1)))
                ids = batch.column(0)[a:b].take(pa.array(pairs // max(len(terms), 1)))
                yield pa.RecordBatch.from_arrays([ids, found.cast(pa.binary())], names=["item_id", "term"])

    kind = items.schema[id_column].dataType.simpleString()
    texts = items.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("binary").alias("text"))
    return bounded(texts).mapInArrow(run, f"item_id {kind}, term binary").distinct()


def restricted_vectors(docs: DataFrame, terms, id_column: str, text_column: str) -> DataFrame:
    """For each document with a term: doc_id, n, and places in the sorted vocabulary with their tf."""

    def run(batches):
        vocabulary = pa.array(terms.value, pa.large_binary())
        for batch in batches:
            for a, b in slices(batch.column(1), 1 << 22):
                found, at, before = words_of(batch.column(1)[a:b])
                known = np.asarray(pc.fill_null(pc.index_in(found, value_set=vocabulary), -1), dtype=np.int64)[at]
                row = np.repeat(np.arange(b - a), np.diff(before))
                pairs, counts = np.unique((row * len(vocabulary) + known)[known >= 0], return_counts=True)
                n = np.diff(before)
                sizes = np.bincount(pairs // len(vocabulary), minlength=b - a)
                places = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                lists = [pa.ListArray.from_arrays(places, pa.array(v, k)) for v, k in ((pairs % len(vocabulary), pa.int32()), (counts, pa.int64()))]
                out = pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return bounded(texts).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


@dataclass
class Query:
    """The items of a block: terms (numbered by falling document frequency) in one row after the other, and their weights."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    rank: np.ndarray  # number of a vocabulary place
    documents: int
    words: int

    def size(self) -> int:
        return len(self.starts) - 1


def length_part(n: np.ndarray, documents: int, words: int) -> np.ndarray:
    return 50 + (50 * n * documents) // max(words, 1)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Trie:
    """Vectors as a trie: nodes with the largest tf of each term, the smallest m and the smallest id below them.

    Nodes 0 .. leaves - 1 are different vectors; the others are inner nodes, the last one is the root.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, most: int):
        same: dict[bytes, list[int]] = {}
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            same.setdefault(m[i].tobytes() + terms[a:b].tobytes() + tfs[a:b].tobytes(), []).append(i)
        first = np.array([g[0] for g in same.values()], np.int64)
        # Equal scores rank by id, so of the ids of one leaf only the first `most` can ever be shown.
        self.ids = [np.sort(ids[g])[:most] for g in same.values()]
        self.leaves = len(first)
        sizes = (starts[1:] - starts[:-1])[first]
        at = np.repeat(starts[first], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        self.width = int(terms.max()) + 1 if len(terms) else 1
        self.children: dict[int, np.ndarray] = {}
        parents = self.grow(begin, terms[at], sizes)
        owner = np.repeat(np.arange(self.leaves), sizes)
        self.summarise(owner * self.width + terms[at], tfs[at], m[first], parents)

    def grow(self, begin: np.ndarray, terms: np.ndarray, sizes: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Splits groups of vectors at the first term that tells them apart; inner nodes, deepest last."""
        nodes = [np.arange(self.leaves)]  # members of the inner nodes, by order of creation
        below: list[list[int]] = [[]]  # children: a leaf as it is, an inner node as -1 - order
        open_nodes, depth = [0] if self.leaves > SMALL else [], 0
        if not open_nodes:
            below[0] = list(range(self.leaves))
        while open_nodes:
            members = np.concatenate([nodes[o] for o in open_nodes])
            group = np.repeat(np.arange(len(open_nodes)), [len(nodes[o]) for o in open_nodes])
            more = sizes[members] > depth
            step = np.zeros(len(members), np.int64)
            step[more] = terms[begin[members[more]] + depth] + 1
            order = np.lexsort((step, group))
            members, group, step = members[order], group[order], step[order]
            new = np.concatenate([[True], (group[1:] != group[:-1]) | (step[1:] != step[:-1])])
            cuts = np.flatnonzero(new)
            parts = np.split(members, cuts[1:])
            branches = np.bincount(group[cuts], minlength=len(open_nodes))
            still = []
            for part, g, s in zip(parts, group[cuts].tolist(), step[cuts].tolist()):
                o = open_nodes[g]
                if len(part) <= SMALL or not s:
                    below[o].extend(part.tolist())
                elif branches[g] == 1:
                    still.append(o)  # all go the same way: the node stretches
                else:
                    below[o].append(-len(nodes))
                    nodes.append(part)
                    below.append([])
                    still.append(len(nodes) - 1)
            open_nodes, depth = still, depth + 1
        self.inner = len(nodes)
        number = lambda c: c if c >= 0 else self.root + c
        self.root = self.leaves + self.inner - 1
        out = []
        for o, own in enumerate(below):
            out.append((self.root - o, np.array([number(c) for c in own], np.int64)))
        self.children = dict(out)
        return out

    def summarise(self, keys: np.ndarray, tfs: np.ndarray, m: np.ndarray, parents: list[tuple[int, np.ndarray]]):
        """Largest tf, smallest m and smallest id of all nodes, children before their parents."""
        total = self.leaves + self.inner
        self.m = np.concatenate([m, np.zeros(self.inner, np.int64)])
        self.least_id = np.array([i[0] for i in self.ids] + [NO_ID] * self.inner, np.int64)
        bounds = np.searchsorted(keys, np.arange(self.leaves + 1) * self.width)
        own = [(keys[a:b] % self.width, tfs[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        own += [None] * self.inner
        for node, children in reversed(parents):
            self.m[node] = self.m[children].min()
            self.least_id[node] = self.least_id[children].min()
            terms = np.concatenate([own[c][0] for c in children])
            order = np.argsort(terms, kind="stable")
            terms = terms[order]
            first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else order
            values = np.concatenate([own[c][1] for c in children])[order]
            own[node] = terms[first], np.maximum.reduceat(values, first) if len(terms) else values
        self.keys = np.concatenate([t + i * self.width for i, (t, _) in enumerate(own)])
        self.tfs = np.concatenate([v for _, v in own])
        self.degree = np.array([len(self.children.get(i, ())) for i in range(total)])

    def scores(self, query: Query, nodes: np.ndarray, items: np.ndarray) -> np.ndarray:
        """The score formula on (node, item) pairs: exact for leaves, a bound for inner nodes."""
        out = np.zeros(len(nodes), np.int64)
        sizes = query.starts[items + 1] - query.starts[items]
        ends = np.cumsum(sizes)
        a = 0
        while a < len(nodes):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LOOK_UPS)))
            n = sizes[a:b]
            at = np.repeat(query.starts[items[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            node = np.repeat(nodes[a:b], n)
            terms = query.terms[at]
            wanted = node * self.width + terms
            place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = np.flatnonzero((self.keys[place] == wanted) & (terms < self.width)) if len(self.keys) else np.zeros(0, np.int64)
            tf, m = self.tfs[place[hit]], self.m[node[hit]]
            gain = query.weights[at[hit]] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            sums = np.concatenate([[0], np.cumsum(gain)])
            pair_ends = np.searchsorted(hit, np.cumsum(n))
            out[a:b] = np.diff(sums[np.concatenate([[0], pair_ends])])
            a = b
        return out


class Best:
    """The `most` best (score, id) of each item so far."""

    def __init__(self, items: int, most: int):
        self.score = np.zeros((items, most), np.int64)
        self.id = np.full((items, most), NO_ID, np.int64)
        self.most = most

    def open(self, items: np.ndarray, bounds: np.ndarray, least_ids: np.ndarray) -> np.ndarray:
        """Whether a bound may still bring a row into the list."""
        worst = self.score[items, -1]
        return (bounds > worst) | ((bounds == worst) & (bounds > 0) & (least_ids < self.id[items, -1]))

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray):
        touched, at = np.unique(items, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(touched)), self.most), at])
        score = np.concatenate([self.score[touched].ravel(), scores])
        name = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((name, -score, row))
        row, score, name = row[order], score[order], name[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept = place < self.most
        self.score[touched[row[kept]], place[kept]] = score[kept]
        self.id[touched[row[kept]], place[kept]] = name[kept]


def search_trie(trie: Trie, query: Query, best: Best) -> int:
    """Depth-first branch and bound; returns how many (node, item) pairs were looked at."""
    items = np.arange(query.size())
    root = np.full(len(items), trie.root)
    stack = [(root, items, trie.scores(query, root, items))]
    seen = len(items)
    while stack:
        nodes, items, bounds = stack.pop()
        if len(nodes) > PAIRS:
            stack.append((nodes[:-PAIRS], items[:-PAIRS], bounds[:-PAIRS]))
            nodes, items, bounds = nodes[-PAIRS:], items[-PAIRS:], bounds[-PAIRS:]
        live = best.open(items, bounds, trie.least_id[nodes])
        nodes, items = nodes[live], items[live]
        if not len(nodes):
            continue
        degree = trie.degree[nodes]
        items = np.repeat(items, degree)
        nodes = np.concatenate([trie.children[n] for n in nodes.tolist()])
        bounds = trie.scores(query, nodes, items)
        seen += len(nodes)
        live = best.open(items, bounds, trie.least_id[nodes])
        nodes, items, bounds = nodes[live], items[live], bounds[live]
        leaf = nodes < trie.leaves
        if leaf.any():
            names = [trie.ids[n] for n in nodes[leaf].tolist()]
            count = np.array([len(x) for x in names])
            best.add(np.repeat(items[leaf], count), np.repeat(bounds[leaf], count), np.concatenate(names))
        nodes, items, bounds = nodes[~leaf], items[~leaf], bounds[~leaf]
        if len(nodes):
            order = np.argsort(bounds, kind="stable")  # the best on top of the stack
            stack.append((nodes[order], items[order], bounds[order]))
    return seen


def best_of_tasks(vectors: DataFrame, query, most: int) -> DataFrame:
    """The best rows of each task: item (place in the block), doc_id, score."""

    def tries(batches) -> Iterator[Trie]:
        q: Query = query.value
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= TRIE_ROWS:
                yield trie_of(pa.Table.from_batches(held).combine_chunks(), q)
                held, rows = [], 0
        if rows:
            yield trie_of(pa.Table.from_batches(held).combine_chunks(), q)

    def trie_of(table: pa.Table, q: Query) -> Trie:
        ids, n, terms, tfs = (table.column(c).chunk(0) for c in ("doc_id", "n", "terms", "tfs"))
        starts = np.asarray(terms.offsets, dtype=np.int64)
        starts = starts - starts[0]
        rank = q.rank[np.asarray(terms.flatten(), dtype=np.int64)]
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.lexsort((rank, owner))
        m = length_part(np.asarray(n, dtype=np.int64), q.documents, q.words)
        ids = np.asarray(pc.fill_null(ids, NO_ID), dtype=np.int64)
        return Trie(ids, m, starts, rank[order], np.asarray(tfs.flatten(), dtype=np.int64)[order], most)

    def run(batches):
        q: Query = query.value
        best = Best(q.size(), most)
        for trie in tries(batches):
            search_trie(trie, q, best)
        item, place = np.nonzero(best.score > 0)
        ids = best.id[item, place]
        columns = [pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(best.score[item, place], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return bounded(vectors).mapInArrow(run, "item int, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    most: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The `most` highest-scoring documents of each item: item_id, rank, doc_id, score.

    A document's score sums w (1e9 tf div (1000 tf + 20 m)) over the item's terms, with
    w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 50 + (50 n N div L), in 64 bits.
    """
    terms = settle(item_terms(items, item_column, item_text_column), "item-terms")
    blocks = terms.count() // BLOCK_TERMS + 1
    block_of = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    parts = [block(docs, terms.filter(block_of == i), most, id_column, text_column) for i in range(blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def block(docs: DataFrame, terms: DataFrame, most: int, id_column: str, text_column: str) -> DataFrame:
    """`search` for one block of items."""
    context = docs.sparkSession.sparkContext
    # At most a block of terms by the choice of blocks.
    lists = terms.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
    vocabulary = sorted({bytes(t) for row in lists for t in row["terms"]})
    if not vocabulary:
        return terms.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    vectors = settle(restricted_vectors(docs, context.broadcast(vocabulary), id_column, text_column), "vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[row["t"]] = row["df"]
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    place = {t: i for i, t in enumerate(vocabulary)}
    starts, numbers, weights = [0], [], []
    for row in lists:
        own = sorted((int(rank[p]), weight(total["n"], int(df[p]))) for p in (place[bytes(t)] for t in row["terms"]) if df[p])
        own = [(r, w) for r, w in own if w]  # a weight of 0 adds nothing
        numbers += [r for r, _ in own]
        weights += [w for _, w in own]
        starts.append(len(numbers))
    query = Query(*(np.array(v, np.int64) for v in (starts, numbers, weights)), rank, total["n"], total["l"])
    best = best_of_tasks(vectors, context.broadcast(query), most)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # The limit on the row number keeps only `most` rows of an item in each task before the shuffle.
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= most)
    kind = terms.schema["item_id"].dataType.simpleString()
    names = docs.sparkSession.createDataFrame([(i, row["item_id"]) for i, row in enumerate(lists)], f"item int, item_id {kind}")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
