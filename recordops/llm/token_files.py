"""Token ids of whole texts in compressed files, in order of document.

Texts are range-partitioned by document, each task tokenises its range and packs
the ids, an end id after each text, into blocks of whole documents that the
mixing coder compresses. A file row is one block with the list of its documents;
blocks decode alone, so a reader fetches any of them. Spark's writer commits the
files, so a lost executor costs its running tasks only.

Null and empty texts hold only the end id. Rows of equal document ids stay apart,
in order of the first bytes of their texts, then of a digest; equal rows are dealt to
several ranges, so no id has to fit one task. A null document id comes first. The tokenizer is told to
take the strings of special tokens as ordinary text.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordops.llm import mixing_coder
from recordops.llm.base import LOWER, NOT_BLANK, bounded, slices
from recordops.session import scratch_dir

BLOCK_IDS = 1 << 20  # a block is closed once it holds so many; a document is never cut
HEAD = 64  # first bytes of a text that order rows of one id
SLICE = 1 << 23  # bytes of text tokenised together
CACHED = 700_000  # words in each of two generations of the cache
#: Small letters of ASCII and all letters of Latin-1 beyond it, in UTF-8.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: Second bytes of Latin-1 capitals to those of their small letters.
SMALL_LATIN = bytes(b + 0x20 if 0x80 <= b <= 0x9E and b != 0x97 else b for b in range(256))
BLANK, LETTER, MARK, OTHER = range(4)
#: What a byte is in lower-cased text; those of Latin-1 letters are found by their neighbours.
KIND = np.full(256, OTHER, np.uint8)
KIND[~NOT_BLANK] = BLANK
KIND[ord("a") : ord("z") + 1] = LETTER
KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = MARK
#: What the step from one kind to the next tells: a word begins, ends, is cut before marks, or is not plain.
BEGINS, ENDS, CUTS, ODD = 1, 2, 4, 8
STEP = np.zeros(16, np.uint8)
STEP[[LETTER, MARK, OTHER]] |= BEGINS
STEP[[LETTER << 2, MARK << 2, OTHER << 2]] |= ENDS
STEP[LETTER << 2 | MARK] |= CUTS
STEP[[OTHER, LETTER << 2 | OTHER, MARK << 2 | OTHER, OTHER << 2 | OTHER, MARK << 2 | LETTER, MARK]] |= ODD
LATIN = np.zeros(256, bool)
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False


@lru_cache(2)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t, Words(t)


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, then from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Words(dict):
    """Ids of words as little-endian 16-bit integers, in two generations, so that memory stays bounded.

    A word of plain letters goes straight to the tokenizer's model, as normalising
    only makes it small and splitting leaves it whole. All other words, and the marks
    after plain ones, which are a piece of their own, take the tokenizer's whole way.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.tokenize, self.old = tokenizer, tokenizer.model.tokenize, {}
        self.letters = byte_letters()
        self.packed = [struct.pack("<H", i) for i in range(1 << 16)]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha():  # small letters of ASCII
                ids = self.join(self.tokenize(word.decode("ascii")))
            elif LETTERS.fullmatch(word):
                ids = self.join(self.tokenize(word.translate(SMALL_LATIN).decode("latin-1").translate(self.letters)))
            else:
                ids = self.whole(word)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def join(self, pieces) -> bytes:
        packed = self.packed
        return b"".join([packed[p.id] for p in pieces])

    def whole(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u2").tobytes()


def pieces_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of lower-cased bytes that begin and end with a blank, and the kinds of bytes.

    A word of letters and marks after them is two pieces; every other word is one.
    """
    kind = KIND[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[LATIN[data[lead + 1]]]
    kind[lead] = LETTER
    kind[lead + 1] = LETTER
    step = STEP[(kind[:-1] << 2) | kind[1:]]
    starts, ends = (np.flatnonzero(step & which) + 1 for which in (BEGINS, ENDS))
    odd = np.searchsorted(starts, np.flatnonzero(step & ODD) + 1, side="right") - 1
    plain = np.ones(len(starts), bool)
    plain[odd] = False
    cuts = np.flatnonzero(step & CUTS) + 1
    cuts = cuts[plain[np.searchsorted(starts, cuts, side="right") - 1]]
    starts, ends = (np.sort(np.concatenate([x, cuts]), kind="stable") for x in (starts, ends))
    return starts, ends, kind


def encode_words(texts: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after the other, and the place of each text's first one.

    White space is never part of a token of this tokenizer and always ends one, so
    a text's ids are those of its words one after the other; capitals are made small by
    the tokenizer itself. Of each slice the distinct pieces are looked up once, and the
    tokenizer sees a piece once while the cache holds it.
    """
    data = LOWER[np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)]
    rows = np.cumsum([0, *(len(x) + 1 for x in texts)]) + 1
    starts, ends, kind = pieces_of(data)
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = data[kind != BLANK]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(kept)])
    words = words.dictionary_encode()
    distinct, at = words.dictionary, np.asarray(words.indices, dtype=np.int64)
    edges = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset :][: len(distinct) + 1].tolist()
    blob = distinct.buffers()[2].to_pybytes() if len(distinct) else b""
    known = tokenizer(path)[1].__getitem__
    found = [known(blob[a:b]) for a, b in zip(edges, edges[1:])]
    sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 1
    size = sizes[at]
    upto = np.concatenate([[0], np.cumsum(size)])
    first = (np.cumsum(sizes) - sizes)[at] - upto[:-1]
    ids = np.frombuffer(b"".join(found), "<u2")[np.repeat(first, size) + np.arange(upto[-1])]
    return ids, upto[np.searchsorted(starts, rows)]


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", shards: int | None = None) -> None:
    """Files of blocks below `folder`, a shard for each range of documents."""
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_column].dataType.simpleString()
    end = np.array([end_id], "<u2").tobytes()

    def run(batches):
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        names: list = []
        parts: list[bytes] = []
        held = 0

        def close():
            ids = np.frombuffer(b"".join(parts), "<u2").astype(np.int64)
            row = [[shard], [block], [len(ids)], [names], [[len(p) // 2 for p in parts]], [mixing_coder.pack(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, fields)], schema=fields)

        fields = None
        for batch in batches:
            fields = fields or pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("names", pa.list_(batch.column(0).type)), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary())])
            for a, b in slices(batch.column(1), SLICE):
                ids, edges = encode_words([x or b"" for x in batch.column(1)[a:b].to_pylist()], path)
                edges = edges.tolist()
                for name, lo, hi in zip(batch.column(0)[a:b].to_pylist(), edges, edges[1:]):
                    names.append(name)
                    parts.append(ids[lo:hi].tobytes() + end)
                    held += hi - lo + 1
                    if held >= BLOCK_IDS:
                        yield close()
                        names, parts, held, block = [], [], 0, block + 1
        if parts:
            yield close()

    named = bounded(docs).select(F.col(id_column).alias("name"), F.col(text_column).cast("binary").alias("text"))
    named = named.withColumns({"head": F.substring("text", 1, HEAD), "digest": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    order = [F.col("name").asc_nulls_first(), "head", "digest", "salt"]
    ordered = named.repartitionByRange(n, *order).sortWithinPartitions(*order).select("name", "text")
    ordered.mapInArrow(run, f"shard int, block int, n_ids long, names array<{kind}>, sizes array<long>, ids binary").write.parquet(folder)


def read(files: DataFrame, id_column: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row for each document of the files: its place among all ids, its number of ids, their CRC-32 and, if wanted, the ids.

    Places add up the blocks of a shard and the shards before it; no window holds more than the blocks of one shard or the list of shards.
    """
    index = files.select("shard", "block", "n_ids")
    totals = index.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("shard")) - F.col("total")
    totals = totals.select("shard", earlier.alias("shard_start"))
    in_shard = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    places = index.withColumn("in_shard", in_shard).join(totals, "shard").select("shard", "block", (F.col("shard_start") + F.col("in_shard")).alias("block_start"))
    kind = files.schema["names"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for shard, block, names, sizes, payload in zip(*(batch.column(i) for i in range(5))):
                ids = mixing_coder.unpack(payload.as_py()).astype("<u4")
                sizes = sizes.values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                whole = ids.tobytes()
                cuts = [whole[4 * a : 4 * b] for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                n = len(sizes)
                columns = [pa.array([shard.as_py()] * n, pa.int32()), pa.array([block.as_py()] * n, pa.int32()), names.values, pa.array(ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                fields = ["shard", "block", id_column, "in_block", "n_tokens", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(cuts, pa.binary()))
                    fields.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=fields)

    schema = f"shard int, block int, {id_column} {kind}, in_block long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids
    rows = files.select("shard", "block", "names", "sizes", "ids").mapInArrow(run, schema)
    placed = rows.join(places, ["shard", "block"]).withColumn("start", F.col("block_start") + F.col("in_block"))
    return placed.select(id_column, "start", "n_tokens", "ids_crc32", "shard", "block", *["ids"] * keep_ids)


def round_trip(docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "token-files")
    write(docs, folder, path, end_id, id_column, text_column)
    return read(spark.read.parquet(folder), id_column)
