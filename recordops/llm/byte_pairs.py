"""Byte-level BPE: array-based pre-tokenisation, cached pair merging, decoding by offsets.

Text becomes an array of code point classes. Each class is a transition function
of the splitting automaton that either sets the start of the current run or keeps
it; composing such functions is associative, so one running maximum gives the
state at every place at once. The boundaries follow from the state and from the
neighbouring classes. The slices between them go through a cache of merged pieces.
The place of each token's bytes in the text is kept beside the ids; decoding puts the
bytes of every token at its place, all at once, and any part of a text can be decoded
from the tokens that overlap it.

Null and empty texts give no ids. Bytes that are not UTF-8 count as U+FFFD.
Equal rows give equal results; rows are independent of one another.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import bounded, slices

LETTER, NUMBER, OTHER, BLANK, SPACE, END = range(6)
#: The code points of white space, and the endings that split off.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
CACHED = 120_000  # pieces in each of two generations of the cache


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point."""
    by_category = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((by_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = BLANK
    out[32] = SPACE
    return out


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of the pieces in code points of several texts; `ends` marks the place after each text."""
    n = len(points)
    kind = classes()[points]
    kind[ends] = END
    blank = (kind == BLANK) | (kind == SPACE)
    run = np.where(blank, BLANK, kind)
    fresh = np.ones(n, bool)
    fresh[1:] = run[1:] != run[:-1]
    # scan: a fresh place sets the start of the run, any other place keeps it
    since = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    start = fresh.copy()
    after_space = np.zeros(n, bool)
    after_space[1:] = kind[:-1] == SPACE
    solid = ~blank & (kind != END)
    start &= ~(solid & after_space)  # a space belongs to what follows it
    last_blank = np.zeros(n, bool)
    last_blank[:-1] = blank[:-1] & solid[1:]
    start |= last_blank  # the last blank of a run stands apart
    quotes = np.flatnonzero((points == 39) & (since == np.arange(n)) & ~after_space & (kind == OTHER))
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    for ending in ENDINGS:
        hit = quotes
        for i, c in enumerate(ending, 1):
            hit = hit[padded[hit + i] == ord(c)]
        start[hit + 1] = False
        start[hit + 1 + len(ending)] = True
    start[ends] = True
    return np.flatnonzero(start)


class Pieces(dict):
    """Ids of pieces as bytes: two generations, so that memory stays bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.old = ranks, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode("utf-8", "replace"), self.ranks), "<u4").tobytes()
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Joins the neighbouring pair of the smallest rank, the leftmost first, until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > 48:
        return merge_long(parts, ranks)
    none = len(ranks) + 1
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and a linked list, for pieces of any length."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    whole: list[bytes | None] = list(parts)
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int):
        if i >= 0 and after[i] < n:
            pair = whole[i] + whole[after[i]]
            if pair in ranks:
                heapq.heappush(heap, (ranks[pair], i, pair))

    for i in range(n):
        offer(i)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if whole[i] is not None else n
        if j >= n or whole[i] + whole[j] != pair:
            continue
        whole[i], whole[j] = pair, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[p] for p in whole if p is not None]


@lru_cache(2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(2)
def codec(path: str) -> tuple[Pieces, np.ndarray, np.ndarray, np.ndarray]:
    """The cache of merged pieces; the bytes of all tokens one after the other, their places and lengths by id."""
    ranks = load_ranks(path)
    words = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        words[i] = piece
    sizes = np.array([len(w) for w in words], np.int32)
    return Pieces(ranks), np.frombuffer(b"".join(words), np.uint8), (np.cumsum(sizes) - sizes).astype(np.int32), sizes


def encode_texts(texts: list[str], path: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """Ids of each text as little-endian 32-bit integers, and the code point offsets of its pieces."""
    cache = codec(path)[0]
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = boundaries(points, ends)
    places = starts.tolist()
    at = np.searchsorted(starts, ends).tolist()
    begin = 0
    for end in at:
        cuts = places[begin : end + 1]
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        yield b"".join(map(cache.__getitem__, pieces)), starts[begin:end]
        begin = end + 1


def token_offsets(ids: bytes, path: str) -> bytes:
    """Where the bytes of each token begin, and where the last one ends, as little-endian 32-bit integers."""
    sizes = codec(path)[3][np.frombuffer(ids, "<u4")]
    return np.concatenate([[0], np.cumsum(sizes)]).astype("<u4").tobytes()


def decode_ids(ids: bytes, offsets: bytes, path: str, first: int = 0, last: int | None = None) -> bytes:
    """The bytes that ids stand for, or those from place `first` to before place `last`, read from the tokens there only."""
    _, bytes_of, place, _ = codec(path)
    starts = np.frombuffer(offsets, "<u4").astype(np.int64)
    last = int(starts[-1]) if last is None else min(last, int(starts[-1]))
    first = max(first, 0)
    if first >= last:
        return b""
    lo, hi = np.searchsorted(starts, first, side="right") - 1, np.searchsorted(starts, last)
    at = starts[lo : hi + 1]
    source = np.repeat(place[np.frombuffer(ids, "<u4")[lo:hi]] - at[:-1], np.diff(at))
    source += np.arange(at[0], at[-1])
    return bytes_of[source].tobytes()[first - int(at[0]) : last - int(at[0])]


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row for each text: number of ids, their digest, the digest of the decoded bytes and, if wanted, ids and offsets."""
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ids_field = [("ids", pa.binary()), ("offsets", pa.binary())] if keep_ids else []
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, offsets binary" * keep_ids

    def run(batches):
        for batch in batches:
            names = batch.column(0)
            texts = batch.column(1)
            for a, b in slices(texts):
                rows = [bytes(x.as_buffer()).decode("utf-8", "replace") if x.is_valid else "" for x in texts[a:b]]
                coded = [(i, token_offsets(i, path)) for i, _ in encode_texts(rows, path)]
                out = [(len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(decode_ids(i, o, path)).hexdigest(), i, o) for i, o in coded]
                columns = [pa.array([r[k] for r in out], f[1]) for k, f in enumerate(fields + ids_field)]
                yield pa.RecordBatch.from_arrays([names[a:b], *columns], names=[id_column, *(f[0] for f in fields + ids_field)])

    named = bounded(docs).select(F.col(id_column), F.col(text_column).cast("binary").alias("text"))
    return named.mapInArrow(run, schema)
