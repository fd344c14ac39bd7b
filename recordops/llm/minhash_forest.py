"""Near duplicates by a MinHash LSH forest, links confirmed on full sets of shingles.

A set of word shingles has a signature of 64 minima. The forest is 16 sorted orders of
the signatures, each starting at another place of them. In an order the neighbours of a
signature are those with the longest common prefix; where a region is crowded they share
more than the least depth of four values. An order is one range-sorted
shuffle: a crowded prefix spreads over many tasks, and the rows at the edges of the ranges
are compared in a second, small pass.

A prefix that more rows share than an order compares is completed afterwards on full sets.
Where its rows outside the largest component fit one block, they meet one another and the
rows of that component block by block, so a row costs at most a block. Rows of all larger
crowds together, those of at most 2,048 shingles, go through a prefix-filtered set join instead: shingles are ordered
by rarity among these rows, sets alike at the asked share have one of their rarest shingles
in common, and only rows with such a shingle in common meet, each pair at its first one and
only if its place leaves room for the overlap. Texts of one template share their frequent
shingles, which are none of these. Longer sets would carry too many shingles: in a larger
crowd they meet block by block, all of them, with the square of their number. Rows of one
component are never compared.

Rows with equal sets are one node beforehand, so copies are never compared. Candidates
whose signatures agree in too few values to reach the similarity are left out; of the
others the closest two of each node are confirmed on the full sets first, then those that
would still join two components. Candidates closed by confirmed links are in one component
already and change nothing.

Missing a pair: a pair at 0.85 has a common prefix of four in one of 16 orders with a
probability of 0.999993; at the mean of near copies, 0.95, of all but 1e-11.

Texts without words (null and empty ones too) have an empty set and are linked with
nothing. Rows with one document id form one component even if their texts differ; rows
without an id are linked with nothing and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from recordops.llm.base import LOWER, NOT_BLANK, RunHash, bounded, flat_bytes, row_key, settle, slices, word_hashes, word_spans
from recordops.llm.components import components

VALUES, ORDERS, DEPTH, NEAR = 64, 16, 4, 4
ROWS, SHINGLES = 512, 250_000  # of a block, about
LONG = 2048  # shingles of a set that meets others by block in any crowd
_draw = np.random.default_rng(20240607)
TURN = _draw.integers(0, 1 << 32, VALUES, dtype=np.uint32)
FACTOR = _draw.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int, word: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle count as one."""
    starts, ends, before = word_spans(data, offsets, word)
    words = word_hashes(data, starts, ends)
    hashes = RunHash(words)
    out = []
    at = np.arange(max(0, len(words) - size + 1))
    whole = hashes(at, at + size)
    for lo, hi in zip(before[:-1].tolist(), before[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(whole[lo : hi - size + 1]))
        elif hi > lo:
            out.append(hashes(np.array([lo]), np.array([hi])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """64 minima of 16 bits for each set that is not empty."""
    flat = np.concatenate(sets)
    short = (flat >> np.uint64(32)).astype(np.uint32)
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), VALUES), np.uint16)
    for i in range(VALUES):
        least = np.minimum.reduceat((short ^ TURN[i]) * FACTOR[i], begins)
        out[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def sketches(docs: DataFrame, text_column: str, size: int, word: np.ndarray) -> DataFrame:
    """Each row's id and key, size of the set, 128 bits that name the set, signature."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(2)):
                data, offsets = flat_bytes(batch.column(2)[a:b])
                sets = shingle_sets(LOWER[data], offsets, size, word)
                full = [s for s in sets if len(s)]
                table = signatures(full) if full else np.zeros((0, VALUES), np.uint16)
                at = np.cumsum([len(s) > 0 for s in sets]) - 1
                names = [pair(s) if len(s) else None for s in sets]
                rows = [table[i].astype(">u2").tobytes() if len(s) else None for i, s in zip(at, sets)]
                columns = [batch.column(0)[a:b], batch.column(1)[a:b], pa.array([len(s) for s in sets], pa.int64()), pa.array([n and n[0] for n in names], pa.int64()), pa.array([n and n[1] for n in names], pa.int64()), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "_key", "n_shingles", "set1", "set2", "signature"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "_key", F.col(text_column).cast("binary")).mapInArrow(run, f"id {kind}, _key binary, n_shingles long, set1 long, set2 long, signature binary")


def pair(s: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128(s.tobytes()).intdigest()
    return int(np.uint64(d >> 64).view(np.int64)), int(np.uint64(d & (1 << 64) - 1).view(np.int64))


def neighbours(least: int, last: bool):
    """Pairs of close rows in sorted rows; unless `last`, also the first and last rows of the task."""

    def run(batches):
        held: pa.RecordBatch | None = None
        head = 0
        for batch in batches:
            ids, keys, order, turned = batch.columns
            if held is not None:
                merged = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()
                batch = merged[0]
                ids, keys, order, turned = batch.columns
            old = 0 if held is None else held.num_rows
            if not last and head < NEAR:
                take = batch.slice(old, NEAR - head)
                head += take.num_rows
                yield edge(take)
            grid = np.frombuffer(b"".join(turned.to_pylist()), np.uint16).reshape(-1, VALUES)
            tree = np.asarray(order)
            for step in range(1, NEAR + 1):
                if batch.num_rows <= step:
                    break
                same = grid[step:] == grid[:-step]
                good = (tree[step:] == tree[:-step]) & same[:, :DEPTH].all(1)
                good[: max(0, old - step)] = False  # met in the batch before
                agree = same.sum(1)
                i = np.flatnonzero(good & (agree >= least))
                if len(i):
                    j = i + step
                    columns = [ids.take(pa.array(i)), keys.take(pa.array(i)), ids.take(pa.array(j)), keys.take(pa.array(j)), pa.array(agree[i], pa.int32()), pa.nulls(len(i), pa.int32()), pa.nulls(len(i), pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=FIELDS)
            held = batch.slice(max(0, batch.num_rows - NEAR))
        if held is not None and not last:
            yield edge(held)

    def edge(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = rows.num_rows
        ids, keys, order, turned = rows.columns
        return pa.RecordBatch.from_arrays([ids, keys, pa.nulls(n, ids.type), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()), order, turned], names=FIELDS)

    return run


FIELDS = ["a", "a_key", "b", "b_key", "agree", "tree", "turned"]


def candidates(nodes: DataFrame, least: int) -> DataFrame:
    """Distinct pairs of nodes that are neighbours in one of the orders, with the number of equal values."""
    kind = nodes.schema["id"].dataType.simpleString()
    schema = f"a {kind}, a_key binary, b {kind}, b_key binary, agree int, tree int, turned binary"
    step = 2 * VALUES // ORDERS
    turned = F.expr(f"concat(substring(signature, tree * {step} + 1), substring(signature, 1, tree * {step}))")
    rows = nodes.select("id", "_key", "signature", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"))
    rows = rows.select("id", "_key", "tree", turned.alias("turned"))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "tree", "turned").sortWithinPartitions("tree", "turned")
    found = settle(ordered.mapInArrow(neighbours(least, False), schema), "forest")
    # at most 2 x NEAR rows from each task: those that stand next to another task's rows
    edges = found.filter("tree is not null").select(F.col("a").alias("id"), F.col("a_key").alias("_key"), "tree", "turned").distinct()
    edges = edges.coalesce(1).sortWithinPartitions("tree", "turned").mapInArrow(neighbours(least, True), schema)
    both = found.filter("tree is null").unionByName(edges).filter("a <> b")
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    both = both.select(pick("a", "b").alias("a"), pick("a_key", "b_key").alias("a_key"), pick("b", "a").alias("b"), pick("b_key", "a_key").alias("b_key"), "agree")
    return both.groupBy("a", "a_key", "b", "b_key").agg(F.max("agree").alias("agree"))


def confirm(pairs: DataFrame, texts: DataFrame, size: int, word: np.ndarray, percent: int) -> DataFrame:
    """Pairs whose full sets reach 100 * common >= percent * union."""

    def run(batches):
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            good = []
            for key, x, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                if key not in known:
                    known = {key: set_of(x)}
                mine, other = known[key], set_of(y)
                common = len(np.intersect1d(mine, other, assume_unique=True))
                good.append(100 * common >= percent * (len(mine) + len(other) - common) and common > 0)
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    def set_of(text) -> np.ndarray:
        data = np.frombuffer(text.as_buffer(), np.uint8)
        return shingle_sets(LOWER[data], np.array([0, len(data)]), size, word)[0]

    kind = pairs.schema["a"].dataType.simpleString()
    other = pairs.join(texts.select(F.col("_key").alias("b_key"), F.col("text").alias("b_text")), "b_key")
    both = other.join(texts.select(F.col("_key").alias("a_key"), F.col("text").alias("a_text")), "a_key")
    return both.select("a", "b", "a_key", "a_text", "b_text").mapInArrow(run, f"a {kind}, b {kind}")


def crowds(nodes: DataFrame, parts: DataFrame, texts: DataFrame, least: int, size: int, word: np.ndarray, percent: int) -> DataFrame:
    """Links between components of rows that share the least prefix with more rows than an order compares.

    `parts` has the components so far (node, component), `texts` the text of every _key.
    """
    kind = nodes.schema["id"].dataType.simpleString()
    rows = nodes.join(parts, nodes["id"] == parts["node"], "left").select("id", "_key", "signature", "n_shingles", F.coalesce("component", "id").alias("part"))
    rows = settle(rows, "parts")
    step = 2 * VALUES // ORDERS
    trees = rows.select("_key", "n_shingles", "part", "signature", F.explode(F.sequence(F.lit(0), F.lit(ORDERS - 1))).alias("tree"))
    trees = trees.select("tree", F.expr(f"substring(signature, tree * {step} + 1, {2 * DEPTH})").alias("prefix"), "_key", "n_shingles", "part", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("earlier"))
    members, groups = mixed_groups(trees, NEAR + 2)
    met = in_blocks(members, groups.filter("others <= 1"))
    large = groups.filter("others > 1").select(*GROUP)
    crossed = not large.isEmpty()
    if crossed:
        members = settle(members.join(large, GROUP, "left_semi"), "large")
        # long texts meet in blocks; those that a long text may reach take both ways
        met = met.unionByName(in_blocks(*mixed_groups(members.filter(F.col("n_shingles") * 100 > percent * LONG), 2)))
        many = settle(members.filter(F.col("n_shingles") <= LONG).select("_key").distinct(), "many")
    met = settle(met, "met")
    some = met.select("_key").unionByName(many).distinct() if crossed else met.select("_key").distinct()
    full = texts.join(some, "_key", "left_semi").dropDuplicates(["_key"])
    full = settle(rows.join(full.mapInArrow(set_bytes(size, word), "_key binary, shingles binary"), "_key"), "sets")
    if crossed:
        many = full.join(many, "_key", "left_semi").select("_key", "n_shingles", "part", "shingles")
        tokens = settle(leading_tokens(many, percent), "tokens")
        met = met.unionByName(settle(in_blocks(*mixed_groups(tokens, 2)), "met"))
    pairs = met.join(full, "_key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    pairs = pairs.select(*GROUP, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "id", "part", "signature", "shingles", "block", "place", "earlier")
    by = [*GROUP, "lo", "hi"]
    return pairs.repartition(*by).sortWithinPartitions(*by).mapInArrow(each_block(block_links(least, percent)), f"a {kind}, b {kind}")


GROUP = ["tree", "prefix"]  # of an order of signatures, or TOKENS and a shingle
TOKENS = ORDERS
RARITY_BITS = 20


def mixed_groups(members: DataFrame, fewest: int) -> tuple[DataFrame, DataFrame]:
    """Members of the groups with at least `fewest` rows of several components; each group's largest component and blocks."""
    full = members.groupBy(*GROUP).agg(F.count("*").alias("n"), F.min("part").alias("low"), F.max("part").alias("high"))
    full = settle(full.filter((F.col("n") >= fewest) & (F.col("low") < F.col("high"))).select(*GROUP), "mixed")
    members = settle(members.join(full, GROUP), "members")
    groups = members.groupBy(*GROUP, "part").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    groups = groups.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max(F.struct("n", "total", "part")).alias("most"))
    blocks = lambda n, total: F.greatest(F.ceil(n / ROWS), F.ceil(total / SHINGLES)).cast("int")
    others = blocks(F.col("n") - F.col("most.n"), F.col("total") - F.col("most.total"))
    groups = groups.select(*GROUP, F.col("most.part").alias("main"), others.alias("others"), blocks(F.col("most.n"), F.col("most.total")).alias("mains"))
    return members, settle(groups, "groups")


def in_blocks(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members with their block and the last block they meet; blocks of the largest component do not meet one another."""
    place, main = F.xxhash64("_key"), F.col("part") == F.col("main")
    met = members.join(groups, GROUP)
    block = F.when(main, F.col("others") + F.pmod(place, "mains")).otherwise(F.pmod(place, "others")).cast("int")
    last = F.when(main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    return met.select("_key", *GROUP, "place", "earlier", block.alias("block"), last.alias("last"))


def leading_tokens(rows: DataFrame, percent: int) -> DataFrame:
    """The first shingles of each set, so many that sets alike at `percent` share one, each with those before it.

    One order for all sets: by the number of sets with a shingle of the same leading bits,
    counted over `rows` in a table of fixed size, then by the shingle itself. Leading bits
    heard in one component only come before all others and their shingles are left out,
    since no two rows that may meet share them. `place` counts them.
    """

    def tally(batches):
        heard = np.zeros(1 << RARITY_BITS, np.int64)
        low, high = np.full(len(heard), np.iinfo(np.int64).max), np.full(len(heard), np.iinfo(np.int64).min)
        for batch in batches:
            data, offsets = flat_bytes(batch.column(0))
            at = (data.view(np.uint64) >> np.uint64(64 - RARITY_BITS)).astype(np.int64)
            part = np.repeat(np.asarray(batch.column(1)), np.diff(offsets) // 8)
            heard += np.bincount(at, minlength=len(heard))
            np.minimum.at(low, at, part)
            np.maximum.at(high, at, part)
        at = np.flatnonzero(heard)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(heard[at]), pa.array(low[at]), pa.array(high[at])], names=["place", "n", "low", "high"])

    found = bounded(rows).select("shingles", F.xxhash64("part")).mapInArrow(tally, "place int, n long, low long, high long")
    found = found.groupBy("place").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    counts = found.filter("low < high").select("place", "n").toArrow()
    heard = np.zeros(1 << RARITY_BITS, np.int64)
    heard[np.asarray(counts["place"])] = np.asarray(counts["n"])
    rarity = rows.sparkSession.sparkContext.broadcast(heard)

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(3), 1 << 17):
                part = batch.slice(a, b - a)
                leads, places = zip(*(lead(np.frombuffer(s.as_buffer(), np.uint64)) for s in part.column(3)))
                at = pa.array(np.repeat(np.arange(len(leads)), [len(x) for x in leads]))
                tokens = [x.byteswap().tobytes() for x in leads]
                prefix = [t[i : i + 8] for t in tokens for i in range(0, len(t), 8)]
                earlier = [t[:i] for t in tokens for i in range(0, len(t), 8)]
                columns = [pa.array([TOKENS] * len(at), pa.int32()), pa.array(prefix, pa.binary())]
                columns += [part.column(i).take(at) for i in range(3)] + [pa.array(np.concatenate(places), pa.int32()), pa.array(earlier, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "prefix", "_key", "n_shingles", "part", "place", "earlier"])

    def lead(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = -(-percent * len(s) // 100)
        heard = rarity.value[s >> np.uint64(64 - RARITY_BITS)]
        order = np.lexsort((s, heard))[: len(s) - least + 1]
        places = np.flatnonzero(heard[order])
        return s[order[places]], places

    kind = rows.schema["part"].dataType.simpleString()
    return rows.select("_key", "n_shingles", "part", "shingles").mapInArrow(run, f"tree int, prefix binary, _key binary, n_shingles long, part {kind}, place int, earlier binary")


def set_bytes(size: int, word: np.ndarray):
    """The sets of texts (_key, text) as bytes."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, offsets = flat_bytes(batch.column(1)[a:b])
                sets = shingle_sets(LOWER[data], offsets, size, word)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array([s.tobytes() for s in sets], pa.binary())], names=["_key", "shingles"])

    return run


def each_block(links):
    """Applies `links` to each run of rows of one group and pair of blocks; a run is bounded, a batch may hold many."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            same = np.ones(batch.num_rows, bool)
            for column in batch.columns[:4]:
                codes = np.asarray(column.dictionary_encode().indices)
                same[1:] &= codes[1:] == codes[:-1]
            if held:
                same[0] = all(held[-1].column(c)[-1] == batch.column(c)[0] for c in range(4))
            cuts = [0, *(np.flatnonzero(~same[1:]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if held and (a or not same[0]):
                    yield from links(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from links(pa.Table.from_batches(held))

    return run


def block_links(least: int, percent: int):
    """Links that join the components of two blocks of rows, or of one block, as far as full sets reach `percent`."""

    def links(table: pa.Table):
        ids = table["id"].combine_chunks()
        tree, lo, hi = (table[c][0].as_py() for c in ("tree", "lo", "hi"))
        grid = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, VALUES)
        root = np.array(table["part"].combine_chunks().dictionary_encode().indices)
        block = np.asarray(table["block"])
        sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        todo = (root[:, None] != root) & (100 * np.minimum(sizes[:, None], sizes) >= percent * np.maximum(sizes[:, None], sizes))
        if lo != hi:
            todo &= block[:, None] != block
        # each pair in the first order, or at the first shingle, that it shares
        if tree == TOKENS:
            earlier = [np.frombuffer(e, np.uint64) for e in table["earlier"].to_pylist()]
            left = sizes - np.asarray(table["place"])
            todo &= (100 + percent) * np.minimum(left[:, None], left) >= percent * (sizes[:, None] + sizes)
            shared = np.concatenate(earlier)
            order = np.argsort(shared, kind="stable")
            owner = np.repeat(np.arange(len(ids)), [len(e) for e in earlier])[order]
            for rows in np.split(owner, np.flatnonzero(np.diff(shared[order])) + 1):
                if len(rows) > 1:
                    todo[np.ix_(rows, rows)] = False
        for t in range(tree if tree < TOKENS else 0):
            at = t * VALUES // ORDERS
            first = np.ascontiguousarray(grid[:, at : at + DEPTH]).view(np.uint64)[:, 0]
            todo &= first[:, None] != first
        if not todo.any():
            return
        agree = np.zeros((len(ids), len(ids)), np.uint8)
        for values in grid.T:
            agree += values[:, None] == values
        todo &= agree >= least
        if not todo.any():
            return
        found = []
        names, codes = np.unique(np.concatenate(sets), return_inverse=True)
        codes = np.split(codes, np.cumsum(sizes)[:-1])
        inside = np.zeros(len(names), bool)
        # rows close to many others first: they may join all of them
        for i in np.argsort(-agree.sum(1, dtype=np.int64), kind="stable"):
            near = np.flatnonzero(todo[i] & (root != root[i]))
            todo[:, i] = False
            if len(near):
                inside[codes[i]] = True
                begins = np.cumsum(sizes[near]) - sizes[near]
                common = np.add.reduceat(inside[np.concatenate([codes[j] for j in near])], begins, dtype=np.int64)
                inside[codes[i]] = False
                for j in near[100 * common >= percent * (sizes[i] + sizes[near] - common)]:
                    if root[j] != root[i]:
                        root[root == root[j]] = root[i]
                        found.append((i, j))
        if found:
            first, second = (pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([ids.take(first), ids.take(second)], names=["a", "b"])

    return links


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, word: np.ndarray = NOT_BLANK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of `docs`: id, size of the set, smallest id of the component, whether the row's id is that one."""
    keyed = bounded(docs).select(F.col(id_column).alias("id"), row_key(id_column, text_column).alias("_key"), F.col(text_column).alias("text"))
    rows = settle(sketches(keyed, "text", size, word), "sketches")
    sets = rows.filter("n_shingles > 0 and id is not null")
    nodes = sets.groupBy("set1", "set2").agg(F.min(F.struct("id", "_key")).alias("r"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
    nodes = settle(nodes.select(F.col("r.id").alias("id"), F.col("r._key").alias("_key"), "signature", "n_shingles", "set1", "set2"), "nodes")
    # sets that agree at `percent` miss this number of equal values with a probability below 1e-7
    share = percent / 100
    least = int(VALUES * share - 5.5 * (VALUES * share * (1 - share)) ** 0.5)
    pairs = settle(candidates(nodes, least), "pairs")
    ends = pairs.select(F.col("a_key").alias("_key")).union(pairs.select("b_key")).distinct()
    texts = keyed.select("_key", F.col("text").cast("binary").alias("text")).join(ends, "_key", "left_semi").dropDuplicates(["_key"])
    texts = settle(texts, "texts")
    # the two closest partners of each node first
    sides = pairs.select("a", "a_key", "b", "b_key", "agree", F.explode(F.array("a_key", "b_key")).alias("node"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("agree"), "a", "b"))
    first = settle(sides.withColumn("place", place).filter("place <= 2").select("a", "a_key", "b", "b_key").distinct(), "closest")
    links = settle(confirm(first, texts, size, word, percent), "confirmed")
    joined = components(links)
    of = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"{c}_part"))
    rest = pairs.drop("agree").join(first.select("a_key", "b_key"), ["a_key", "b_key"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
    rest = rest.filter("a_part is null or b_part is null or a_part <> b_part").select("a", "a_key", "b", "b_key")
    more = settle(confirm(rest, texts, size, word, percent), "confirmed")
    # what is joined so far counts as one link a node
    star = lambda parts: parts.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    joined = components(star(joined).unionByName(more))
    every = keyed.select("_key", F.col("text").cast("binary").alias("text"))
    crowded = settle(crowds(nodes, joined, every, least, size, word, percent), "crowded")
    # rows of equal sets or of equal ids hang together by the smallest id of the set
    same = sets.join(nodes.select("set1", "set2", F.col("id").alias("b")), ["set1", "set2"]).filter("id <> b").select(F.col("id").alias("a"), "b").distinct()
    parts = components(star(joined).unionByName(crowded).unionByName(same))
    out = rows.select("id", "n_shingles").join(parts, F.col("id") == F.col("node"), "left")
    out = out.withColumn("component_id", F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_column), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
