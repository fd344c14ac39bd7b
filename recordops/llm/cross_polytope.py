"""Nearest neighbours by inner product with cross-polytope hashing and multiprobe tables.

A vector is turned by three rounds of random signs and a fast Hadamard transform, and is
assigned to the nearest signed axis; its hash in a table is the axes of one or more such
turns, chained. A query probes, in each table, the hashes nearest to it: those for which
the squared distances to the best axis, added over the chain, are smallest. If norms differ,
vectors are lifted by one component to one length, which keeps the order of inner products.
Candidates are reranked by exact inner products.

Chain and number of probes are fitted: the exact neighbours of `ASKED` drawn entries are
found in one pass over all entries, and for every length of the chain the smallest number of
probes is taken that finds a share `WANTED` of them. Of these the cheapest is chosen, by the
vectors looked at (counted on a sample of at most `SAMPLE` entries) and the rows that probes
cost, so the chain gets longer as the table grows. All entries are indexed.

A bucket of more than `BLOCK` vectors is dealt out in blocks by its own count, so no task
holds a whole bucket and only its queries are copied; each block returns its best candidates
for each query. Equal vectors are one entry with the smallest ids that any query can need,
and queries of equal vectors are searched once.

Vectors that are null, empty, zero or hold null or non-finite components take no part; nor
do vectors of another length than the most frequent one (of equally frequent, the smaller).
Rows of equal id are separate entries, a null id takes no part.
Every answer is complete: a query with fewer than `nearest` rows (or all candidates) after
the probes is searched exactly over all entries, block by block.
`recall` measures results against brute force.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordops.llm.base import settle

TABLES, BLOCK, SPARE = 8, 16384, 8
SAMPLE, ASKED, WANTED = 2000, 128, 0.97  # entries on which costs and recall are fitted, and the recall wanted
CHAIN, LISTED, PROBE = 3, 1024, 500  # longest chain, most probes of a chain, vectors that cost as much as a probe


def transform(x: np.ndarray) -> np.ndarray:
    """Hadamard transform of the rows; their length is a power of two."""
    n, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(n, -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, width)
        h *= 2
    return x


def turned(x: np.ndarray, table: int, link: int) -> np.ndarray:
    signs = np.random.default_rng([7, table, link]).choice([-1.0, 1.0], (3, x.shape[1]))
    for one in signs:
        x = transform(x * one)
    return x / x.shape[1] ** 1.5


def lifted(x: np.ndarray, longest: float, lift: bool, query: bool) -> np.ndarray:
    """Rows padded to a power of two, with the component that makes all norms equal."""
    width = 1 << max(0, int(x.shape[1] + lift - 1).bit_length())
    out = np.zeros((len(x), width))
    out[:, : x.shape[1]] = x / longest
    if lift and not query:
        out[:, x.shape[1]] = np.sqrt(np.maximum(0.0, 1 - (out * out).sum(1)))
    return out


def codes(x: np.ndarray, table: int, chain: int, probes: int) -> np.ndarray:
    """The nearest hashes of each row, nearest first; without a chain the one hash 0."""
    code = np.zeros((len(x), 1), np.int64)
    cost = np.zeros((len(x), 1))
    for link in range(chain):
        y = turned(x, table, link)
        both = np.concatenate([y, -y], 1)
        gap = (both.max(1, keepdims=True) - both) ** 2
        # the best of a longer chain start with the best of the shorter one
        axis = np.argsort(gap, 1, kind="stable")[:, :probes]
        gap = np.take_along_axis(gap, axis, 1)
        total = (cost[:, :, None] + gap[:, None, :]).reshape(len(x), -1)
        code = (code[:, :, None] * both.shape[1] + axis[:, None, :]).reshape(len(x), -1)
        best = np.argsort(total, 1, kind="stable")[:, :probes]
        cost, code = np.take_along_axis(total, best, 1), np.take_along_axis(code, best, 1)
    return code


def fit(asked: np.ndarray, near: list[np.ndarray], sample: np.ndarray, n: int, tables: int, longest: float, lift: bool, chains: list[int]) -> tuple[int, int]:
    """The cheapest chain and number of probes that find enough of the nearest of the asked vectors.

    `near` has the nearest vectors of each asked one, `sample` some of all `n` entries.
    """
    query = lifted(asked, longest, lift, True)
    true = lifted(np.concatenate(near), longest, lift, False)
    base = lifted(sample, longest, lift, False)
    who = np.repeat(np.arange(len(near)), [len(v) for v in near])
    best = None
    for chain in chains:
        most = 2 * query.shape[1] if chain == 1 else LISTED
        least = np.full(len(who), most)
        seen = np.zeros((len(query), most))  # sampled vectors in the buckets of the first probes
        for t in range(tables):
            mine = codes(true, t, chain, 1)[:, 0]
            held, count = np.unique(codes(base, t, chain, 1)[:, 0], return_counts=True)
            for i in range(len(query)):
                probed = codes(query[i : i + 1], t, chain, most)[0]
                order = np.argsort(probed)
                place = lambda wanted: order[np.minimum(np.searchsorted(probed, wanted, sorter=order), len(probed) - 1)]  # noqa: B023, E731
                at, wanted = place(mine[who == i]), mine[who == i]
                least[who == i] = np.minimum(least[who == i], np.where(probed[at] == wanted, at, most))
                at = place(held)
                hit = probed[at] == held
                seen[i, at[hit]] += count[hit]
        probes = int(np.quantile(least, WANTED, method="higher")) + 1 + (chain == 1)
        if probes > most and chain > 1:
            continue  # not found among the listed probes
        probes = min(probes, most)
        cost = seen[:, :probes].sum(1).mean() / max(len(base), 1) * n + PROBE * probes * tables
        if best is None or cost < best[0]:
            best = cost, chain, probes
    return (best[1], best[2]) if best else (1, 2 * query.shape[1])


def valid(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    v = F.col(vector_column)
    fine = v.isNotNull() & (F.size(v) > 0) & F.col(id_column).isNotNull()
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    rows = rows.filter(fine & finite & F.exists(v, lambda x: x != 0)).select(F.col(id_column).alias("id"), F.transform(v, lambda x: x.cast("double")).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).first()
    return rows.filter(F.size("v") == (lengths["n"] if lengths else 0))


def exact_nearest(entries: DataFrame, asked: np.ndarray, nearest: int) -> list[np.ndarray]:
    """The nearest other vectors of a few asked ones, by one pass over all entries; a task returns its best only."""

    def run(batches):
        held, scores = np.zeros((0, asked.shape[1])), np.zeros((len(asked), 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array(batch.column(0).values, dtype=np.float64).reshape(batch.num_rows, -1)
            held, scores = np.concatenate([held, v]), np.concatenate([scores, asked @ v.T], 1)
            if len(held) > nearest + 1:
                keep = np.unique(np.argpartition(-scores, nearest, 1)[:, : nearest + 1])
                held, scores = held[keep], scores[:, keep]
        best = np.argsort(-scores, 1)[:, : nearest + 1]
        who = np.repeat(np.arange(len(asked)), best.shape[1])
        rows = [held[j].tobytes() for j in best.ravel()]
        found = np.take_along_axis(scores, best, 1).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.int32()), pa.array(found), pa.array(rows, pa.binary())], names=["asked", "near", "x"])

    found = entries.select("v").mapInArrow(run, "asked int, near double, x binary")
    place = F.row_number().over(Window.partitionBy("asked").orderBy(F.desc("near"), "x"))
    found = found.withColumn("place", place).filter(F.col("place") <= nearest + 1).collect()
    out: list = [[] for _ in asked]
    for row in sorted(found, key=lambda r: r["place"]):
        if row["x"] != asked[row["asked"]].tobytes():
            out[row["asked"]].append(np.frombuffer(row["x"], np.float64))
    return [np.array(v[:nearest]).reshape(-1, asked.shape[1]) for v in out]


def search(rows: DataFrame, queries, nearest: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", tables: int = TABLES, chain: int | None = None) -> DataFrame:
    """The `nearest` found for each row that satisfies the condition `queries` on `id`: query_id, rank, id, score.

    `chain` fixes the number of chained polytopes, which is fitted otherwise; one polytope
    with all its axes is probed where the listed probes of that chain do not find enough.
    """
    rows = settle(valid(rows, id_column, vector_column), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    bounds = rows.agg(F.min(norm).alias("least"), F.max(norm).alias("most"), F.count("*").alias("n")).first()
    longest, lift = bounds["most"] or 1.0, bool(bounds["n"]) and bounds["least"] < 0.999 * bounds["most"]
    # entries: distinct vectors with the smallest ids; a query needs one more than `nearest`, itself excluded
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= nearest + 1)
    members = few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("members"))
    asked = rows.groupBy("v").agg(F.max(queries.cast("int")).alias("asked"))
    entries = members.join(asked, "v").select(F.col("members")[0].alias("entry"), "members", "v", (F.col("asked") == 1).alias("asked"))
    entries = settle(entries, "entries")
    kind = rows.schema["id"].dataType.simpleString()
    total = entries.count()
    share = min(1.0, 1.5 * SAMPLE / max(total, 1))
    drawn = entries.select("v", F.xxhash64("v").alias("place")).filter(F.pmod("place", F.lit(1 << 30)) <= int(share * (1 << 30)))
    drawn = np.array([r["v"] for r in drawn.orderBy("place", "v").limit(SAMPLE).collect()], np.float64)
    links, probes = 1, 1
    if len(drawn) > 1:
        near = exact_nearest(entries, drawn[:ASKED], min(nearest, total - 1))
        width = 2 * lifted(drawn[:1], longest, lift, False).shape[1]
        useful = [c for c in range(1, CHAIN + 1) if c == 1 or 64 * width ** (c - 1) < total]
        links, probes = fit(drawn[:ASKED], near, drawn, total, tables, longest, lift, [chain] if chain else useful)

    def hashed(tables: int, chain: int, probes: int, query: bool):
        """Each row with its hash in each table, a query with those it probes."""

        def run(batches):
            # rows of probes are written in portions of about as many vectors
            step = max(1, 4096 // probes) if query else 512
            for batch in batches:
                v = np.array(batch.column(1).values, dtype=np.float64).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
                for lo in range(0, batch.num_rows, step):
                    x, ids = v[lo : lo + step], batch.column(0)[lo : lo + step]
                    data = pa.array([r.tobytes() for r in x], pa.binary())
                    for t in range(tables):
                        code = codes(lifted(x, longest, lift, query), t, chain, probes if query else 1)
                        yield rows_of(ids, data, np.repeat(np.arange(len(x)), code.shape[1]), t, code.ravel(), query)

        return run

    def rows_of(ids, data, who, t, code, query):
        take = pa.array(who)
        n = len(who)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, t), pa.int32()), pa.array(code, pa.int64()), pa.array(np.full(n, query), pa.bool_()), ids.take(take), data.take(take)], names=["tree", "code", "query", "entry", "x"])

    def ranked(batches):
        """In each block, the best entries of every query; entries come before queries."""
        group, base_ids, base, waiting = None, [], [], []

        def answer():
            ids, matrix = base_ids, np.frombuffer(b"".join(base), np.float64).reshape(len(base), -1)
            q = np.frombuffer(b"".join(x for _, x in waiting), np.float64).reshape(len(waiting), -1)
            scores = q @ matrix.T
            keep = min(nearest + 1 + SPARE, len(ids))
            best = np.argpartition(-scores, keep - 1, 1)[:, :keep]
            found = np.take_along_axis(scores, best, 1)
            who = [waiting[i][0] for i in range(len(waiting)) for _ in range(keep)]
            kinds = [entry_type, entry_type, pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((who, [ids[j] for j in best.ravel().tolist()], found.ravel()), kinds)], names=["query", "entry", "near"])

        for batch in batches:
            entry_type = batch.schema.field(4).type
            for t, code, block, query, entry, x in zip(*(c.to_pylist() for c in batch.columns)):
                if (t, code, block) != group:
                    if waiting and base:
                        yield answer()
                    group, base_ids, base, waiting = (t, code, block), [], [], []
                if not query:
                    base_ids.append(entry)
                    base.append(x)
                elif base:
                    waiting.append((entry, x))
                    if len(waiting) >= 512:
                        yield answer()
                        waiting = []
        if waiting and base:
            yield answer()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def answers(asked, tables, chain, probes):
        """The `nearest` of each of the `asked` (entry, v) in the buckets they probe, for its query ids."""
        row = f"tree int, code long, query boolean, entry {kind}, x binary"
        held = entries.select("entry", "v").mapInArrow(hashed(tables, chain, probes, False), row)
        probing = asked.mapInArrow(hashed(tables, chain, probes, True), row)
        crowded = held.groupBy("tree", "code").count().filter(F.col("count") > BLOCK)
        crowded = settle(crowded.select("tree", "code", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "buckets")
        dealt = held.unionByName(probing).join(crowded, ["tree", "code"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("entry", "x"), "blocks").cast("int"))
        block = F.explode(F.when(F.col("query"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own))
        dealt = dealt.select("tree", "code", block.alias("block"), "query", "entry", "x")
        dealt = dealt.repartition(n, "tree", "code", "block").sortWithinPartitions("tree", "code", "block", "query")
        near = dealt.mapInArrow(ranked, f"query {kind}, entry {kind}, near double").groupBy("query", "entry").agg(F.max("near").alias("near"))
        best = near.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("near"), "entry"))).filter(F.col("place") <= nearest + 1 + SPARE)
        # exact scores on the original vectors, components added in order
        sides = [entries.select(F.col("entry").alias(c), F.col("v").alias(f"{c}_v")) for c in ("query", "entry")]
        terms = F.zip_with("query_v", "entry_v", lambda a, b: a * b)
        scored = best.select("query", "entry").join(sides[0], "query").join(sides[1], "entry").select("query", "entry", F.aggregate(terms, F.lit(0.0), lambda a, x: a + x).alias("score"))
        listed = scored.join(entries.select("entry", "members"), "entry").select("query", "score", F.explode("members").alias("id"))
        top = listed.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).filter(F.col("place") <= nearest + 1).drop("place")
        own = top.join(asking, "query").filter("id <> query_id")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        return own.withColumn("rank", rank).filter(F.col("rank") <= nearest).select("query", "query_id", F.col("rank").cast("int"), "id", "score")

    asking = rows.filter(queries).join(entries.filter("asked").select("v", F.col("entry").alias("query")), "v").select(F.col("id").alias("query_id"), "query")
    asking = settle(asking, "queries")
    found = settle(answers(entries.filter("asked").select("entry", "v"), tables, links, probes), "nearest")
    # Queries whose buckets held too few are searched once more, over all entries in blocks.
    full = min(nearest, max(int(bounds["n"]) - 1, 0))
    got = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= full)
    short = settle(asking.join(got, "query_id", "left_anti").select("query").distinct(), "short")
    if full and not short.isEmpty():
        again = entries.join(short, entries["entry"] == short["query"], "left_semi").select("entry", "v")
        again = answers(again, 1, 0, 1)
        found = found.join(short, "query", "left_anti").unionByName(again)
    return found.select("query_id", "rank", F.col("id").alias(id_column), "score")


def recall(found: list[tuple], vectors: dict, nearest: int = 20, queries: list | None = None) -> float:
    """Share of the true nearest that are among (query, rank, id, score) rows; for samples.

    Queries without any row count as having found nothing, if `queries` names them all.
    """
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids.tolist()], np.float64)
    got: dict = {q: set() for q in queries or []}
    for q, _, i, _ in found:
        got.setdefault(q, set()).add(i)
    hit = total = 0
    for q, mine in got.items():
        scores = matrix @ np.array(vectors[q], np.float64)
        scores[ids == q] = -np.inf
        true = ids[np.lexsort((ids, -scores))[: min(nearest, len(ids) - 1)]]
        hit += len(mine.intersection(true.tolist()))
        total += len(true)
    return hit / max(total, 1)
