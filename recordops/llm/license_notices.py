"""Licence notices in texts: exact base phrases and a fuzzy search for short notices.

A notice that may differ by k edits, cut into k + 1 pieces, must hold one piece
unchanged (pigeonhole). The pieces of all notices are searched exactly in one pass
per text; around each find the regex library matches the whole notice with bounded
errors and reports the span. Base phrases are words that stand consecutively,
whatever separates them.

Texts are lower-cased in A-Z only and searched whole. Null and empty texts have no
words, no labels and the score 0. Rows are independent, so repeated rows repeat.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import ALNUM, LOWER, bounded, flat_bytes, slices, word_spans

#: Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices to be found with up to `k` edits (inserted, deleted or changed characters), and their labels.
NOTICES = [
    ("licensed under the apache license, version 2.0", 4, "apache-2.0"),
    ("released under the mit license", 3, "mit"),
    ("permission is hereby granted, free of charge", 4, "mit"),
    ("licensed under the gnu general public license", 4, "gpl"),
    ("gnu lesser general public license", 3, "lgpl"),
    ("gnu affero general public license", 3, "agpl"),
    ("licensed under a creative commons attribution", 4, "cc-by"),
    ("mozilla public license", 2, "mpl"),
    ("redistribution and use in source and binary forms", 4, "bsd"),
    ("dedicated to the public domain", 3, "public-domain"),
    ("all rights reserved", 2, "reserved"),
]
WORD, GAP = rb"0-9a-z\x80-\xff", rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def base_pattern(phrases: dict[str, str]) -> re.Pattern:
    parts = [b"(" + GAP.join(re.escape(w.encode()) for w in p.split()) + b")" for p in phrases]
    return re.compile(b"(?<![" + WORD + b"])(?=(?:" + b"|".join(parts) + b")(?![" + WORD + b"]))")


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """The notice in edits + 1 pieces of nearly equal length, each with its place."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b].encode()) for a, b in zip(cuts, cuts[1:])]


@lru_cache(4)
def searcher(notices: tuple):
    import ahocorasick
    import regex

    seeds: dict[str, list] = {}
    fuzzy = []
    for i, (notice, edits, _) in enumerate(notices):
        for place, piece in pieces(notice, edits):
            seeds.setdefault(piece.decode("latin-1"), []).append((i, place))
        fuzzy.append(regex.compile(b"(?b)(?:" + re.escape(notice.encode()) + b"){e<=%d}" % edits))
    machine = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        machine.add_word(piece, (len(piece), uses))
    machine.make_automaton()
    return machine, fuzzy


@lru_cache(1 << 16)
def best_match(notices: tuple, i: int, window: bytes) -> tuple[int, int, int] | None:
    """Edits, start and end of the best match of a notice in a window; texts share most of their notices, so finds are kept."""
    at = window.find(notices[i][0].encode())
    if at >= 0:
        return 0, at, at + len(notices[i][0])
    m = searcher(notices)[1][i].search(window)
    return (sum(m.fuzzy_counts), m.start(), m.end()) if m else None


def find_notices(text: bytes, notices: tuple = tuple(NOTICES)) -> list[tuple[int, int, int, int]]:
    """Spans of notices in a lower-cased text: start, end, notice, edits.

    Each seed has a window as long as its notice and the allowed edits on both sides,
    and the best match in it is a find; equal windows are searched once, so the work
    grows with the number of seeds. Of finds of a notice that overlap, the one with
    fewest edits stays, then the first, then the shortest.
    """
    machine, _ = searcher(notices)
    windows: dict[int, set[tuple[int, int]]] = {}
    for end, (length, uses) in machine.iter(text.decode("latin-1")):
        start = end + 1 - length
        for i, place in uses:
            notice, edits, _ = notices[i]
            a = start - place - edits
            windows.setdefault(i, set()).add((max(0, a), min(len(text), a + len(notice) + 2 * edits)))
    found = []
    for i, mine in windows.items():
        finds = set()
        for a, b in mine:
            if best := best_match(notices, i, text[a:b]):
                finds.add((best[0], a + best[1], a + best[2]))
        kept: list[tuple[int, int]] = []
        for edits, start, end in sorted(finds):
            at = bisect_left(kept, (start, end))
            if (at == len(kept) or kept[at][0] >= end) and (at == 0 or kept[at - 1][1] <= start):
                kept.insert(at, (start, end))
                found.append((start, end, i, edits))
    return sorted(found)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases: dict[str, str] | None = None, notices: list | None = None) -> DataFrame:
    """One row for each text: words, places of base phrases, labels, score and the spans of the notices.

    A span gives start and end in bytes of the text in UTF-8, label and edits. The score
    is 1 with a base phrase, else that of the best notice: 1 - edits / (allowed + 1).
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    notices = tuple(NOTICES if notices is None else notices)
    base = base_pattern(phrases)
    names = list(phrases.values())
    kind = docs.schema[id_column].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("edits", pa.int32())])
    fields = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))]

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                data, offsets = flat_bytes(batch.column(1)[a:b])
                data = LOWER[data]
                starts, _, before = word_spans(data, offsets, ALNUM)
                whole = data.tobytes()
                out = []
                for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    text = whole[lo:hi]
                    hits = [(m.start(), m.lastindex) for m in base.finditer(text)]
                    own = sorted({names[k - 1] for _, k in hits})
                    spans = find_notices(text, notices)
                    words = [int(np.searchsorted(starts, lo + h) - before[row]) for h, _ in (hits[0], hits[-1])] if hits else [None, None]
                    labels = sorted({*own, *(notices[i][2] for _, _, i, _ in spans)})
                    score = 1.0 if hits else max((1 - e / (notices[i][1] + 1) for _, _, i, e in spans), default=0.0)
                    out.append((int(before[row + 1] - before[row]), len(hits), *words, ",".join(own), ",".join(labels), score, [{"start": s, "end": e, "label": notices[i][2], "edits": k} for s, e, i, k in spans]))
                columns = [pa.array([r[k] for r in out], f[1]) for k, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *columns], names=[id_column, *(f[0] for f in fields)])

    schema = f"{id_column} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<start:long,end:long,label:string,edits:int>>"
    return bounded(docs).select(F.col(id_column), F.col(text_column).cast("binary").alias("text")).mapInArrow(run, schema)
