"""Collocations: Misra-Gries summaries name the phrases that may be frequent, a second pass counts them exactly.

First pass. Every run of 1 to `longest` words is hashed into one of a number of classes.
A map task counts the runs of its rows; what it sends for a class is a Misra-Gries summary
from which nothing was taken yet. The summaries of a class are merged: counts of equal
keys are added, and where more than `capacity` keys are left, the (capacity + 1)-th
largest count is taken from all of them. The capacity exceeds the class's mass divided by
the threshold, so that all that was ever taken from a key (`lost`) stays below the
threshold, and each key whose true count reaches it is still there. Keys with
`count + lost` below the threshold cannot reach it and are left out. Hash collisions only
add survivors. The mass of a class is sent ahead of its summaries in rows that sort first.

Second pass. A bit for each survivor (16 bits a survivor, at most 64 MB for any corpus;
beyond that more phrases pass, with the same results) lets map tasks skip nearly all other
runs; those that pass are grouped as texts, word by word and not by hash, and counted.

All arithmetic of scores is exact (38-digit decimals). Null and empty texts have no words,
a null language is `und`, rows of any id count, repeated rows each time. Ties in score and
count go by the bytes of the phrase. An empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordops.llm.base import LOWER, bounded, byte_classes, flat_bytes, mix, settle, slices, word_spans

SLICE = 1 << 20  # bytes of text looked at together
FLUSH = 1 << 20  # different runs that a map task holds
CLASS_MASS = 1 << 22  # runs in a class, about
ROW_KEYS = 1 << 12  # keys in one shuffled row
MOST_BITS = 29  # of the filter of survivors
KEY_BITS = 40
PARTS = 256  # into which the phrases of a language are dealt before the best are sought
WORD = byte_classes([(0x20, 0x20), (0x09, 0x09)] + [(ord(c), ord(c)) for c in ".,;:!?"] + [(0x0A, 0x0D)])
BREAK = ~byte_classes([(ord(c), ord(c)) for c in ".,;:!?"] + [(0x0A, 0x0D)])
SUMMARY = "class int, kind int, mass long, keys binary, counts binary"


class Words:
    """The words of some texts: ids into a dictionary of texts, hashes with the language, and the piece of each."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = flat_bytes(texts)
        data = LOWER[data]
        starts, ends, before = word_spans(data, offsets, WORD)
        row = np.repeat(np.arange(len(texts)), np.diff(before))
        self.piece = np.cumsum(BREAK[data])[starts] + row if len(starts) else starts
        kept = np.ascontiguousarray(data[WORD[data]])
        places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(kept)])
        words = words.dictionary_encode()
        self.texts, self.id = words.dictionary, np.asarray(words.indices, dtype=np.int64)
        langs = langs.dictionary_encode()
        self.langs, self.lang = langs.dictionary, np.asarray(langs.indices, dtype=np.int64)[row]
        word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.texts.to_pylist()), np.uint64, len(self.texts))
        lang = np.fromiter((xxhash.xxh3_64_intdigest(w, seed=1) for w in self.langs.to_pylist()), np.uint64, len(self.langs))
        self.hash = mix(word[self.id] + lang[self.lang])

    def runs(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, first words and hashes of the runs of each size that lie within a piece."""
        at, sums = np.arange(len(self.id)), self.hash
        for size in range(1, longest + 1):
            if size > 1:
                within = self.piece[at + size - 1 - (at + size > len(self.id))] == self.piece[at]
                within &= at + size <= len(self.id)
                at, sums = at[within], sums[within]
                sums = sums * np.uint64(0x9E3779B97F4A7C15) + self.hash[at + size - 1]
            yield size, at, mix(sums + np.uint64(size))


def spread(hashes: np.ndarray, classes: int) -> np.ndarray:
    """Class and key of a run in one number; a class never gets so full that 40 bits were too few."""
    key = hashes & np.uint64((1 << KEY_BITS) - 1)
    return ((hashes >> np.uint64(KEY_BITS)) % np.uint64(classes)) << np.uint64(KEY_BITS) | key


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.concatenate([first, [len(keys)]])).astype(np.int64)


class Summary:
    """A Misra-Gries summary: at most `capacity` keys with counts, and what was taken from every count."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self):
        parts = [(self.keys, self.counts), *self.waiting]
        self.keys, self.counts = add_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        self.waiting, self.size = [], 0
        surplus = len(self.keys) - self.capacity
        if surplus > 0:
            taken = np.partition(self.counts, surplus - 1)[surplus - 1]
            left = self.counts > taken
            self.keys, self.counts = self.keys[left], self.counts[left] - taken
            self.lost += int(taken)

    def possible(self, least: int) -> np.ndarray:
        """The keys whose true count may reach `least`."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


def planes(values: np.ndarray, size: int) -> bytes:
    """The low bytes of all values, then the next ones: sorted keys and small counts compress well so."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def from_planes(data: bytes, size: int) -> np.ndarray:
    n = len(data) // size
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, n).T
    return out.reshape(-1).view("<u8")


def summary_rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """For each class a row with its mass and rows of keys and counts."""
    classes = (keys >> np.uint64(KEY_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    rows = []
    for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        rows.append((int(classes[lo]), 0, int(counts[lo:hi].sum()), b"", b""))
        for a in range(lo, hi, ROW_KEYS):
            b = min(a + ROW_KEYS, hi)
            rows.append((int(classes[lo]), 1, 0, planes(keys[a:b] & np.uint64((1 << KEY_BITS) - 1), 5), planes(counts[a:b], 5)))
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["class", "kind", "mass", "keys", "counts"])


def survivors(texts: DataFrame, classes: int, least: int, longest: int) -> DataFrame:
    """First pass over (lang, text) as bytes: a mixed hash (mark) of every run that may occur `least` times."""

    def local(batches):
        parts, held = [], 0
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                words = Words(batch.column(1)[a:b], batch.column(0)[a:b])
                part = distinct(np.concatenate([spread(h, classes) for _, _, h in words.runs(longest)]))
                parts.append(part)
                held += len(part[0])
                if held > FLUSH:
                    parts = [add_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))]
                    held = len(parts[0][0])
                    if 2 * held > FLUSH:
                        yield summary_rows(*parts[0])
                        parts, held = [], 0
        if held:
            yield summary_rows(*add_up(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])))

    def merged(batches):
        now, mass, summary = None, 0, None

        def result():
            keys = summary.possible(least) | np.uint64(now << KEY_BITS)
            return pa.RecordBatch.from_arrays([pa.array(mix(keys).view(np.int64), pa.int64())], names=["mark"])

        for batch in batches:
            for at in range(batch.num_rows):
                name, kind, part, keys, counts = (c[at].as_py() for c in batch.columns)
                if name != now:
                    if summary is not None:
                        yield result()
                    now, mass, summary = name, 0, None
                if kind == 0:
                    mass += part
                    continue
                if summary is None:
                    summary = Summary(mass // least + 1)
                summary.add(from_planes(keys, 5), from_planes(counts, 5).astype(np.int64))
        if summary is not None:
            yield result()

    sent = bounded(texts).mapInArrow(local, SUMMARY)
    sent = sent.repartitionById(classes, F.col("class")).sortWithinPartitions("class", "kind")
    return sent.mapInArrow(merged, "mark long")


def filter_of(marks: DataFrame) -> tuple[int, np.ndarray]:
    """Bits, and a bit set for the first bits of each mark: 16 bits a mark, at most 2**MOST_BITS."""
    bits = min(max((16 * marks.count()).bit_length(), 20), MOST_BITS)
    place = (F.shiftrightunsigned("mark", 64 - bits) + 1).alias("place")  # Spark numbers places and pages from 1
    pages = marks.select(place).groupBy(F.bitmap_bucket_number("place").alias("page"))
    pages = pages.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("map"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in pages.toLocalIterator():
        at = (row["page"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(row["map"]), np.uint8)
    return bits, out


def in_filter(bits: int, filled: np.ndarray, marks: np.ndarray) -> np.ndarray:
    place = marks >> np.uint64(64 - bits)
    return (filled[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def exact_counts(texts: DataFrame, classes: int, bits: int, filled, longest: int) -> DataFrame:
    """Second pass: lang, size, phrase, f for runs that pass the filter, and the number of words (size 0) of each lang."""

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1), SLICE):
                words = Words(batch.column(1)[a:b], batch.column(0)[a:b])
                per_lang = np.bincount(words.lang, minlength=len(words.langs))
                yield rows(words, 0, np.arange(len(words.langs)), [], per_lang)
                # Equal ids are equal runs: a run's id is a number for (run without its last word, last word).
                ids = np.unique(words.lang * max(len(words.texts), 1) + words.id, return_inverse=True)[1]
                run_at, run_id = np.arange(len(ids)), ids
                for size, at, hashes in words.runs(longest):
                    at = at[in_filter(bits, filled.value, mix(spread(hashes, classes)))]
                    if size > 1:
                        place = np.searchsorted(run_at, at)
                        known = place < len(run_at)
                        known[known] = run_at[place[known]] == at[known]  # a frequent run begins with a frequent run
                        at, place = at[known], place[known]
                        both = run_id[place] * (len(ids) + 1) + ids[at + size - 1]
                    else:
                        both = ids[at]
                    _, first, numbers, counts = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
                    run_at, run_id = at, numbers
                    shown = at[first]
                    yield rows(words, size, words.lang[shown], [words.id[shown + i] for i in range(size)], counts)

    def rows(words, size, langs, parts, counts):
        phrase = pa.array([b""] * len(langs), pa.large_binary())
        if parts:
            phrase = pc.binary_join_element_wise(*[words.texts.take(pa.array(p)) for p in parts], pa.scalar(b" ", pa.large_binary()))
        columns = [words.langs.take(pa.array(langs)), pa.array(np.full(len(langs), size, np.int32)), phrase.cast(pa.binary()), pa.array(counts, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "f"])

    found = bounded(texts).mapInArrow(run, "lang binary, size int, phrase binary, f long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def frequent_runs(docs: DataFrame, least: int, longest: int, text_column: str, lang_column: str) -> DataFrame:
    """Exact counts f of all runs of 1 to `longest` words that occur `least` times in a lang; size 0 counts the words."""
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und"))
    texts = docs.select(lang.cast("binary").alias("lang"), F.col(text_column).cast("binary").alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    classes = max(1, min(total * longest // 6 // CLASS_MASS + 1, 1 << 23))
    marks = settle(survivors(texts, classes, least, longest), "survivors")
    bits, filled = filter_of(marks)
    counted = exact_counts(texts, classes, bits, docs.sparkSession.sparkContext.broadcast(filled), longest)
    counted = counted.filter((F.col("size") == 0) | (F.col("f") >= least))
    counted = counted.select(F.col("lang").cast("string"), "size", F.col("phrase").cast("string"), "f")
    return settle(counted, "runs")


def collocations(
    docs: DataFrame, least: int = 10, longest: int = 3, top: int = 2000, absorbed: int = 50, text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """Each language's best phrases of 2 to `longest` words: lang, rank, phrase, a, l, r, n, score.

    A phrase with count a, cut into parts with counts l and r, scores 1,000,000 a a div (l r)
    at its worst cut (k words before it, smallest k of ties). Phrases that stand inside a
    longer frequent one with at least `absorbed` percent of their count are left out.
    """
    runs = frequent_runs(docs, least, longest, text_column, lang_column)
    counts = runs.filter("size > 0")
    phrases = counts.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))
    cuts = phrases.select("lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    words_from = lambda start, length: F.array_join(F.slice("words", start, length), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", words_from(F.lit(1), F.col("k")).alias("first"), words_from(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    for name, value in (("first", "l"), ("rest", "r")):
        known = counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
        cuts = cuts.join(known, ["lang", name])
    exact = "cast({} as decimal(38,0))".format
    score = F.expr(f"(cast(1000000 * {exact('a')} * a as decimal(38,0))) div cast({exact('l')} * r as decimal(38,0))")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(words, i, n), ' '))))"
    )
    inside = phrases.filter("size > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = worst.join(inside, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {absorbed} * a")
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    # A language's best are among the best of its parts, so no task gets all phrases of a large language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    ranked = kept.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    words = runs.filter("size = 0").select("lang", F.col("f").alias("n"))
    long = lambda c: F.col(c).cast("long")
    return ranked.join(words, "lang").select("lang", long("rank").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", long("cut.score").alias("score"))
