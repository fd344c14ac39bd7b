"""Benchmark decontamination by a prefix-filtered set join of word windows.

An item's windows are all its runs of `window` words; a shorter item is one window.
A window is a set of shingles (runs of five words, fewer for shorter windows) and an
occurrence must hold all of them, so one necessary token is enough as its prefix: the
shingle that is rarest in the corpus. Documents are read once: shingles that pass a
filter of fixed size over the shingles of the benchmark are kept as segments with the
words around them. Their counts give the order by rarity; kept shingles meet the prefix
table in an equality join; the place of the shingle in its window bounds where the
window would start and end in the document (position and length bounds), and the words
there are compared one by one.

A document word inside an occurrence is hit. Null and empty texts have no words and are
clean; items without words have no window. Rows of the same id and text share a result,
rows of the same id and different texts do not. Any id types; item ids sort as strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordops.llm.base import ALNUM, LOWER, bounded, flat_bytes, row_key, settle, slices, word_hashes, word_spans, RunHash

SHINGLE = 5
FILTER_BITS = 23  # one megabyte, whatever the size of the benchmark
SEGMENT = 48  # shingles kept in one segment at most
SCHEMA_ITEM = "item_id string, words string, size int, shingles array<struct<hash:long,size:int,place:int>>"


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` words, from hashes of the words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    return (RunHash(words)(at, at + size) + np.uint64(size)).view(np.int64)


def windows_of(items: DataFrame, id_column: str, text_column: str, window: int, shingle: int) -> DataFrame:
    """The windows of all items: item, words joined by blanks, number of words, hashes of the shingles."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, offsets = flat_bytes(batch.column(1)[a:b])
                data = LOWER[data]
                starts, ends, before = word_spans(data, offsets, ALNUM)
                hashes = word_hashes(data, starts, ends)
                whole = data.tobytes()
                words = [whole[s:e].decode("utf-8", "replace") for s, e in zip(starts.tolist(), ends.tolist())]
                rows = []
                for name, lo, hi in zip(batch.column(0)[a:b].to_pylist(), before[:-1].tolist(), before[1:].tolist()):
                    size = min(window, hi - lo)
                    k = min(shingle, size)
                    if not size:
                        continue
                    own = shingle_hashes(hashes[lo:hi], k).tolist()
                    for s in range(hi - lo - size + 1):
                        rows.append((name, " ".join(words[lo + s : lo + s + size]), size, [{"hash": h, "size": k, "place": p} for p, h in enumerate(own[s : s + size - k + 1])]))
                kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.struct([("hash", pa.int64()), ("size", pa.int32()), ("place", pa.int32())]))]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["item_id", "words", "size", "shingles"])

    return bounded(items).select(F.col(id_column).cast("string"), F.col(text_column).cast("binary")).mapInArrow(run, SCHEMA_ITEM)


def membership(windows: DataFrame) -> tuple[list[int], np.ndarray]:
    """The shingle sizes in use and a bit for each hash modulo the filter's size: the bound holds for any benchmark."""
    place = F.shiftrightunsigned(F.col("s.hash"), 64 - FILTER_BITS)
    tokens = windows.select(F.explode("shingles").alias("s")).select(F.col("s.size").alias("size"), place.alias("place")).distinct()
    words = tokens.groupBy("size", F.floor(F.col("place") / 32768).alias("page")).agg(F.collect_set("place").alias("places"))
    bits = np.zeros(1 << FILTER_BITS, bool)
    sizes = set()
    for row in words.toLocalIterator():
        sizes.add(row["size"])
        bits[row["places"]] = True
    return sorted(sizes), np.packbits(bits)


def segments_of(docs: DataFrame, sizes: list[int], bits, window: int, text_column: str) -> DataFrame:
    """Each row with its number of words and the segments around shingles that pass the filter."""

    def passing(hashes: np.ndarray) -> np.ndarray:
        place = hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
        return (bits.value[place >> np.uint64(3)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1

    def segments(hashes: np.ndarray, first: int, last: int, spans, whole: bytes) -> Iterator[dict]:
        """Of one document: runs of passing shingles, at most SEGMENT places long, with the words of any window on them."""
        for size in sizes:
            own = shingle_hashes(hashes[first:last], size)
            at = np.flatnonzero(passing(own))
            if not len(at):
                continue
            reach = window - size
            new = np.ones(len(at), bool)
            new[1:] = np.diff(at) > reach
            group = np.cumsum(new)
            begins = np.flatnonzero(new)
            new |= (at - at[begins[group - 1]]) % SEGMENT < np.concatenate([[1], np.diff(at)])
            for part in np.split(at, np.flatnonzero(new)[1:]):
                lo, hi = max(0, part[0] - reach), min(last - first, part[-1] + size + reach)
                s, e = spans[0][first + lo : first + hi].tolist(), spans[1][first + lo : first + hi].tolist()
                yield {"start": int(lo), "size": size, "words": " ".join(whole[x:y].decode("utf-8", "replace") for x, y in zip(s, e)), "places": (part - lo).tolist(), "hashes": own[part].tolist()}

    segment = pa.struct([("start", pa.int64()), ("size", pa.int32()), ("words", pa.string()), ("places", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, offsets = flat_bytes(batch.column(1)[a:b])
                data = LOWER[data]
                spans = word_spans(data, offsets, ALNUM)
                hashes = word_hashes(data, spans[0], spans[1])
                whole, before = data.tobytes(), spans[2].tolist()
                found = [list(segments(hashes, lo, hi, spans, whole)) for lo, hi in zip(before, before[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.diff(spans[2]), pa.int64()), pa.array(found, pa.list_(segment))], names=["_key", "n_words", "segments"])

    return docs.select("_key", F.col(text_column).cast("binary")).mapInArrow(run, "_key binary, n_words long, segments array<struct<start:long,size:int,words:string,places:array<int>,hashes:array<long>>>")


def occurrences(docs: DataFrame, items: DataFrame, id_column="doc_id", text_column="text", item_column="item_id", item_text="text", window=13, shingle=SHINGLE):
    """Rows of documents with number of words; occurrences of windows; windows by item. All stored."""
    spark = docs.sparkSession
    windows = settle(windows_of(items, item_column, item_text, window, min(shingle, window)), "windows")
    sizes, packed = membership(windows)
    bits = spark.sparkContext.broadcast(packed)
    keyed = bounded(docs).select(row_key(id_column, text_column).alias("_key"), F.col(text_column).alias("_text"))
    read = settle(segments_of(keyed, sizes, bits, window, "_text"), "segments")
    segment = read.filter(F.size("segments") > 0).select("_key", "n_words", F.explode("segments").alias("g"))
    tokens = segment.select("_key", "n_words", "g.start", "g.words", F.explode(F.arrays_zip("g.places", "g.hashes")).alias("t"))
    tokens = tokens.select("_key", "n_words", "start", "words", F.col("t.hashes").alias("hash"), F.col("t.places").alias("at"))
    # how often each shingle of the benchmark stands in the corpus, over all documents
    heard = read.select(F.explode(F.flatten("segments.hashes")).alias("hash")).groupBy("hash").count()
    texts = windows.select("words", "size", "shingles").distinct()
    each = texts.select("words", "size", F.explode("shingles").alias("s")).select("words", "size", "s.hash", "s.place")
    ranked = each.join(heard, "hash")  # a window with a shingle that the corpus lacks cannot occur
    rarest = ranked.groupBy("words", "size").agg(F.count("*").alias("there"), F.min(F.struct("count", "hash", "place")).alias("r"))
    complete = F.col("there") == F.col("size") - F.least(F.col("size"), F.lit(min(shingle, window))) + 1
    prefix = rarest.filter(complete).select(F.col("words").alias("window"), "size", "r.hash", "r.place")
    found = tokens.join(prefix, "hash")
    begin = F.col("at") - F.col("place")
    inside = (begin >= 0) & (F.col("start") + begin + F.col("size") <= F.col("n_words"))
    # the place lies in the kept words; compare exactly those of the window
    same = F.array_join(F.slice(F.split("words", " "), begin + 1, F.col("size")), " ") == F.col("window")
    found = found.filter(inside).filter(same).select("_key", (F.col("start") + begin).alias("begin"), "size", "window").distinct()
    return read, settle(found, "occurrences"), windows


def decontaminate(docs: DataFrame, items: DataFrame, id_column="doc_id", text_column="text", item_column="item_id", item_text="text", window=13, share=20) -> DataFrame:
    """Each row's words, hit words, items and whether it is contaminated (share * hit >= words > 0 hits), by `_key`; one row a key."""
    read, found, windows = occurrences(docs, items, id_column, text_column, item_column, item_text, window)
    # hit words: each occurrence adds the words beyond the furthest end before it; a window keeps only its growth
    spans = found.groupBy("_key", "begin").agg(F.max(F.col("begin") + F.col("size")).alias("end"))
    earlier = F.max("end").over(Window.partitionBy("_key").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.greatest(F.col("end") - F.greatest(F.col("begin"), F.coalesce(earlier, F.lit(0))), F.lit(0)))
    hits = spans.groupBy("_key").agg(F.sum("new").alias("n_hit"))
    owners = windows.select("item_id", F.col("words").alias("window")).distinct()
    by_item = found.select("_key", "window").distinct().join(owners, "window").select("_key", "item_id").distinct()
    listed = by_item.groupBy("_key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    rows = read.groupBy("_key").agg(F.max("n_words").alias("n_words"))
    out = rows.join(hits.join(listed, "_key"), "_key", "left")
    out = out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long")).withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row for each document row, with the digest of its items."""
    id_column, text_column = options.get("id_column", "doc_id"), options.get("text_column", "text")
    flags = decontaminate(docs, items, **options)
    rows = docs.select(F.col(id_column), row_key(id_column, text_column).alias("_key")).join(flags, "_key", "left")
    digest = F.sha2(F.array_join("items", ","), 256)
    return rows.select(id_column, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated", "items")


def brute_force(docs: list[tuple], items: list[tuple], window: int = 13) -> dict:
    """The contract on one machine, for tests."""
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    kept: dict[tuple, set] = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for s in range(len(w) - size + 1 if size else 0):
            kept.setdefault(tuple(w[s : s + size]), set()).add(str(name))
    sizes = {len(w) for w in kept}
    out = {}
    for name, text in docs:
        w = words(text)
        hit, own = set(), set()
        for size in sizes:
            for s in range(len(w) - size + 1):
                if (t := tuple(w[s : s + size])) in kept:
                    hit.update(range(s, s + size))
                    own |= kept[t]
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out[name] = (len(w), len(hit), len(own), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out
