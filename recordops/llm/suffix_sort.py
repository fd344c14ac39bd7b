"""Removal of repeated byte strings by difference-cover suffix sorting in buckets.

Sorting every suffix of a corpus takes several times its size in shuffles. Here the
suffixes that cannot have a repeated prefix of `size` bytes are put aside first, and
whole stretches that recur as they are need no sorting:

1. In each string of `size` bytes the 64 bytes of smallest hash are its anchor. Equal
   strings have equal anchors at equal places, so a string whose anchor's bytes occur
   once in the corpus is not repeated. Neighbouring strings of one anchor make a segment.
2. Segments of recurring anchors that are equal as a whole are repeated as a whole.
3. Of the others, one of each kind goes to the bucket of its anchor. Only suffixes of one
   bucket can be equal in `size` bytes. Each bucket is sorted by a difference cover modulo
   3: triples at the places 1 and 2 modulo 3 are sorted and named, the names are sorted
   recursively to the depth that `size` needs, the remaining suffixes are merged in, and
   neighbours in that order are compared over `size` bytes.
4. A bucket of more than `CROWDED` different segments is not sorted in one task; its
   strings are counted by 128-bit hashes in a grouped aggregate instead.

Every byte covered by a repeated string goes; strings are judged on the input. Null and
empty texts have no bytes. Rows of equal id and text each count as an occurrence, so all
their strings are repeated. Shuffled: a row for about 70 bytes of text, the text once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import OTHER_BASE, RunHash, bounded, flat_bytes, settle, slices

ANCHOR, BUCKET_BYTES = 64, 1 << 20
CROWDED = 8192  # segments of one bucket, each below 340 bytes, that a task sorts: less than 3 MB


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes in order of their first 3**depth symbols at least; symbols are positive."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    # places 1 modulo 3 end with one beyond the text if needed, so that no triple runs into the next class
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    t = np.concatenate([text, np.zeros(3, text.dtype)]).astype(np.uint64)
    size = t.max() + np.uint64(1)
    heads = t[sample] * size + t[sample + 1]
    if int(size) > 1 << 21:  # name the pairs first, so that a triple fits in 64 bits
        heads = np.unique(heads, return_inverse=True)[1].astype(np.uint64)
    triples = heads * size + t[sample + 2]
    kinds, names = np.unique(triples, return_inverse=True)
    if len(kinds) < len(sample) and depth > 1:
        inner = suffix_order(names + 1, depth - 1)
        names = np.empty(len(sample), np.int64)
        names[inner] = np.arange(len(sample))
        order = sample[inner]
    else:
        order = sample[np.argsort(names, kind="stable")]
    rank = np.zeros(n + 3, np.uint64)
    rank[sample] = names.astype(np.uint64) + np.uint64(1)
    order = order[order < n]
    zero = np.arange(0, n, 3)
    wide = np.uint64(len(sample) + 2)
    by_one = t[zero] * wide + rank[zero + 1]
    rest = zero[np.argsort(by_one, kind="stable")]
    # merge: against place 1 compare (symbol, rank), against place 2 (symbol, symbol, rank)
    first, second = order[order % 3 == 1], order[order % 3 == 2]
    below = np.searchsorted(t[first] * wide + rank[first + 1], np.sort(by_one))
    two_heads = t[second] * size + t[second + 1]
    rest_heads = t[rest] * size + t[rest + 1]
    if int(size) > 1 << 21:
        both = np.unique(np.concatenate([two_heads, rest_heads]), return_inverse=True)[1].astype(np.uint64)
        two_heads, rest_heads = both[: len(second)], both[len(second) :]
    below += np.searchsorted(two_heads * wide + rank[second + 2], rest_heads * wide + rank[rest + 2])
    out = np.empty(n, np.int64)
    at = np.maximum.accumulate(below) + np.arange(len(rest))
    out[at] = rest
    free = np.ones(n, bool)
    free[at] = False
    out[free] = order
    return out


def repeated_starts(segments: list[bytes], size: int) -> list[np.ndarray]:
    """For each segment which of its strings of `size` bytes start elsewhere in the segments too."""
    data = np.frombuffer(b"\0".join(segments) + b"\0" * 8, np.uint8)
    lengths = np.array([len(s) for s in segments])
    begins = np.cumsum(lengths + 1) - lengths - 1
    counts = np.maximum(lengths - size + 1, 0)
    symbols = data[:-8].astype(np.int64) + 2
    ends = (begins + lengths)[:-1]
    symbols[ends] = 1
    asked = np.zeros(len(symbols), bool)
    for b, c in zip(begins.tolist(), counts.tolist()):
        asked[b : b + c] = True
    depth = 1
    while 3**depth < size:
        depth += 1
    order = suffix_order(symbols, depth)
    order = order[asked[order]]
    words = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    a, b = order[:-1], order[1:]
    for at in [*range(0, size - 7, 8), size - 8]:
        same = (words[a + at] == words[b + at]).all(1)
        a, b = a[same], b[same]
    hit = np.zeros(len(symbols), bool)
    hit[a] = hit[b] = True
    return [np.flatnonzero(hit[s : s + c]) for s, c in zip(begins.tolist(), counts.tolist())]


def segments_of(data: np.ndarray, offsets: np.ndarray, size: int):
    """Rows, starts, counts of strings, anchors and hashes of the segments of several texts."""
    n, reach = len(data), size - ANCHOR + 1
    if n < size:
        return [np.zeros(0, np.int64)] * 5
    hashes = RunHash(data.astype(np.uint64))
    at = np.arange(n - ANCHOR + 1)
    grams = hashes(at, at + ANCHOR)
    # smallest hash, the leftmost of equal ones: its upper half, then its place
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    width = 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
    row = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - size + 1, 0))
    if not len(row):
        return [np.zeros(0, np.int64)] * 5
    base = np.repeat(offsets[:-1], np.maximum(np.diff(offsets) - size + 1, 0))
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = (least[base + inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (places[1:] != places[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(row)))
    starts = base[first] + inside[first]
    whole = hashes(starts, starts + length + size - 1) ^ (places[first] - starts).astype(np.uint64)
    return row[first], inside[first], length, grams[places[first]].view(np.int64), whole.view(np.int64)


def anchored(docs: DataFrame, size: int, only_anchor: bool) -> DataFrame:
    """A row for each segment; with `only_anchor` just its anchor, for counting."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(2)):
                data, offsets = flat_bytes(batch.column(2)[a:b])
                row, start, count, anchor, whole = segments_of(data, offsets, size)
                if only_anchor:
                    yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64())], names=["anchor"])
                else:
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(whole, pa.int64()), batch.column(0)[a:b].take(take), batch.column(1)[a:b].take(take), pa.array(start, pa.int32()), pa.array(count, pa.int32())], names=["anchor", "whole", "key1", "key2", "start", "count"])

    schema = "anchor long" if only_anchor else "anchor long, whole long, key1 long, key2 long, start int, count int"
    return docs.select("key1", "key2", "text").mapInArrow(run, schema)


def cut_out(joined: DataFrame, size: int) -> DataFrame:
    """The bytes of the wanted segments of each text."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                text = memoryview(batch.column(2)[i].as_buffer())
                found = batch.column(3)[i].values
                start, count = found.field("start").to_pylist(), found.field("count").to_pylist()
                n = len(start)
                pieces = pa.array([bytes(text[s : s + c + size - 1]) for s, c in zip(start, count)], pa.binary())
                keys = [pa.array([batch.column(k)[i].as_py()] * n, pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([found.field("anchor"), *keys, found.field("start"), found.field("crowd"), found.field("once"), pieces], names=["anchor", "key1", "key2", "start", "crowd", "once", "piece"])

    return joined.mapInArrow(run, "anchor long, key1 long, key2 long, start int, crowd long, once boolean, piece binary")


def sorted_buckets(pieces: DataFrame, size: int) -> DataFrame:
    """Starts of repeated strings in the pieces that stand once, bucket by bucket."""
    names = ["key1", "key2", "start", "count"]

    def run(batches):
        held: list[tuple] = []
        total = 0

        def flush(rows):
            found = []
            for (_, k1, k2, start, once, _), at in zip(rows, repeated_starts([r[5] for r in rows], size)):
                if once and len(at):
                    new = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                    for s, c in zip(at[new].tolist(), np.diff(np.append(new, len(at))).tolist()):
                        found.append((k1, k2, start + s, c))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if total >= BUCKET_BYTES and row[0] != held[-1][0]:
                    yield flush(held)
                    held, total = [], 0
                held.append(row)
                total += len(row[5])
        if held:
            yield flush(held)

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.select("anchor", "key1", "key2", "start", "once", "piece").repartition(n, "anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(run, "key1 long, key2 long, start int, count int")


def counted_buckets(pieces: DataFrame, size: int) -> DataFrame:
    """The same for crowded buckets: a row for each string, counted by its hash."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(4)[i].as_buffer(), np.uint8).astype(np.uint64)
                at = np.arange(len(data) - size + 1)
                h = [RunHash(data, base)(at, at + size).view(np.int64) for base in (0x9E3779B97F4A7C15, OTHER_BASE)]
                n = len(at)
                keys = [pa.array([batch.column(k)[i].as_py()] * n, pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in h), *keys, pa.array(at + batch.column(2)[i].as_py(), pa.int32()), pa.array([batch.column(3)[i].as_py()] * n, pa.bool_())], names=["h1", "h2", "key1", "key2", "start", "once"])

    rows = pieces.select("key1", "key2", "start", "once", "piece").mapInArrow(run, "h1 long, h2 long, key1 long, key2 long, start int, once boolean")
    more = rows.groupBy("h1", "h2").count().filter("count > 1").drop("count")
    return rows.filter("once").join(more, ["h1", "h2"]).select("key1", "key2", "start", F.lit(1).alias("count"))


def remove_repeats(docs: DataFrame, size: int = 200, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """Each row with what is left of its text: id, bytes, bytes and runs removed, digest of the kept bytes, those bytes.

    With `carry` the row as it came follows in a struct `row`, its text column null. `size` is at least 72.
    """
    if size < ANCHOR + 8:
        raise ValueError("strings must have 72 bytes at least")
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    keys = [F.xxhash64(id_column, text_column), F.xxhash64(text_column, F.lit(1), id_column)]
    row = F.struct(*(F.lit(None).cast(t).alias(c) if c == text_column else F.col(c) for c, t in docs.dtypes))
    docs = bounded(docs).select(F.col(id_column).alias("id"), keys[0].alias("key1"), keys[1].alias("key2"), text.alias("text"), *[row.alias("row")] * carry)
    recur = anchored(docs, size, True).groupBy("anchor").count().filter("count > 1").select("anchor")
    recur = settle(recur, "anchors")  # so that the join's sides are plain shuffles, which split at hot anchors
    segments = settle(anchored(docs, size, False).join(recur, "anchor"), "segments")
    kinds = segments.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key1", "key2", "start", "count")).alias("r"))
    kinds = settle(kinds, "segment-kinds")
    crowd = kinds.groupBy("anchor").agg(F.count("*").alias("crowd"), F.min("n").alias("least")).filter("crowd > 1 and least = 1").drop("least")
    asked = kinds.join(crowd, "anchor").select("r.*", "anchor", "crowd", (F.col("n") == 1).alias("once"))
    listed = asked.groupBy("key1", "key2").agg(F.collect_list(F.struct("anchor", "start", "count", "crowd", "once")).alias("wanted"))
    cut = cut_out(docs.join(listed, ["key1", "key2"]).select("key1", "key2", "text", "wanted"), size)
    pieces = settle(cut, "pieces")
    alone = sorted_buckets(pieces.filter(F.col("crowd") <= CROWDED), size).unionByName(counted_buckets(pieces.filter(F.col("crowd") > CROWDED), size))
    copies = segments.join(kinds.filter("n > 1").select("anchor", "whole"), ["anchor", "whole"]).select("key1", "key2", "start", "count")
    places = alone.unionByName(copies).groupBy("key1", "key2").agg(F.collect_list(F.struct("start", "count")).alias("places"))
    joined = docs.join(places, ["key1", "key2"], "left").select("id", "text", "places", *["row"] * carry)
    kind = docs.schema["id"].dataType.simpleString()
    carried = f", row {docs.schema['row'].dataType.simpleString()}" if carry else ""

    def run(batches):
        names = [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", *["row"] * carry]
        kinds_ = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        for batch in batches:
            for a, b in slices(batch.column(1)):
                out = []
                for i in range(a, b):
                    data = bytes(batch.column(1)[i].as_buffer())
                    found = batch.column(2)[i]
                    if not found.is_valid:
                        out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest(), data))
                        continue
                    start = np.asarray(found.values.field("start")).astype(np.int64)
                    steps = np.zeros(len(data) + 1, np.int64)
                    np.add.at(steps, start, 1)
                    np.add.at(steps, start + np.asarray(found.values.field("count")) + size - 1, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    out.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *(pa.array([r[k] for r in out], t) for k, t in enumerate(kinds_)), *(c[a:b] for c in batch.columns[3:])], names=names)

    return joined.mapInArrow(run, f"{id_column} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary" + carried)


def brute_force(texts: list[tuple], size: int = 200) -> dict:
    """The contract on one machine, for tests."""
    from collections import Counter

    rows = [(name, (text or "").encode()) for name, text in texts]
    seen = Counter(t[i : i + size] for _, t in rows for i in range(len(t) - size + 1))
    out = {}
    for name, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[name] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
