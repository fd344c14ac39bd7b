"""Phrases, ranked search and mixing of sources against plain versions of their contracts."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordops.llm import phrases, ranked_search, source_mix

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, f long, score string, row string, size string, terms string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, 1, "x", "x", "x", "x") for i, t, lang, s in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows(texts):
    """The shared texts with languages and sources, many of them null, one source with a third of the rows."""
    langs, sources = ["en", None, "und", "de"], ["hot", "b", None, "a", "é", "hot"]
    out = [(i, t, langs[k % 4], sources[k % 6]) for k, (i, t) in enumerate(texts)]
    rng = random.Random(8)
    words = ["Zu", "und", "mit", "ñandú", "IN", "x1", "a_b", "the", "é"]
    for k in range(60):
        out.append((100 + k // 2, "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", " "]) for _ in range(rng.randint(1, 60))), langs[k % 4], sources[k % 6]))
    return out + [(900, "same words again and again", "en", "hot")] * 40


def plain_phrases(rows, least, longest, top, absorbed):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    longer, found, out = collections.Counter(), collections.defaultdict(list), []
    for (lang, p), a in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if a >= least:
                    longer[lang, p[i : i + k]] = max(a, longer[lang, p[i : i + k]])
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least and not (longer[lang, p] and 100 * longer[lang, p] >= absorbed * a):
            parts = [(f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, k = min((1_000_000 * a * a // (x * y), k) for k, (x, y) in enumerate(parts))
            found[lang].append((-score, -a, " ".join(p).encode(), *parts[k]))
    for lang, best in found.items():
        for rank, (score, a, p, x, y) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, n[lang], -score))
    return sorted(out)


def test_phrases(spark, rows):
    docs = table(spark, rows)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for least, longest, top, absorbed in ((10, 3, 2000, 50), (3, 4, 15, 80), (1, 2, 2000, 50)):
        got = phrases.collocations(docs, least, longest, top, absorbed).select(columns).collect()
        assert sorted(map(tuple, got)) == plain_phrases(rows, least, longest, top, absorbed)
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.filter("text is null or text = ''")).count() == 0


def test_phrases_in_many_classes(spark, rows, monkeypatch):
    """Small classes, flushes, slices and a nearly full filter change nothing."""
    monkeypatch.setattr(phrases, "CLASS_MASS", 500)
    docs = table(spark, rows)
    got = phrases.collocations(docs, 4).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 4, 3, 2000, 50)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    score = spark.range(1).select(F.lit(big).alias("a"), F.lit(big + 7).alias("l"), F.lit(big + 1).alias("r"))
    exact = "cast({} as decimal(38,0))".format
    got = score.select(F.expr(f"(cast(1000000 * {exact('a')} * a as decimal(38,0))) div cast({exact('l')} * r as decimal(38,0))")).first()[0]
    assert got == 1_000_000 * big * big // ((big + 7) * (big + 1))


def test_summary_keeps_every_frequent_key():
    """Skewed counts in many parts, merged in any order: no key with `least` occurrences is missed, few others stay."""
    rng = np.random.default_rng(5)
    for least in (2, 10, 40):
        stream = np.concatenate([rng.zipf(1.3, 40_000) % 9_000, rng.integers(10_000, 60_000, 40_000)]).astype(np.uint64)
        rng.shuffle(stream)
        summary = phrases.Summary(len(stream) // least + 1)
        for part in np.array_split(stream, 37):
            summary.add(*phrases.distinct(part))
            summary.merge()
        kept = set(summary.possible(least).tolist())
        keys, counts = np.unique(stream, return_counts=True)
        assert set(keys[counts >= least].tolist()) <= kept
        assert len(kept) <= summary.capacity and summary.lost < least


def test_planes_are_read_back():
    values = np.array([0, 1, 255, 256, (1 << 40) - 1], np.uint64)
    assert phrases.from_planes(phrases.planes(values, 5), 5).tolist() == values.tolist()


def plain_ranking(rows, items, most):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    docs = [(i, collections.Counter(re.findall(pattern, lower(t)))) for i, t, *_ in rows]
    docs = [(i, c) for i, c in docs if c]
    total, words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(re.findall(pattern, lower(t)))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in docs:
            m = 50 + (50 * sum(c.values()) * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:most], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "the same words"), (2, None), (3, ""), (4, "Zu zu ZU mit in"), (5, "nothing of this occurs: qqq"), (6, "é x1 again"), (None, "und mit ñandú"), (4, "x1"), (7, "again and again")]


def test_ranked_search(spark, rows):
    docs = table(spark, rows)
    texts = [t for _, t, *_ in rows if t]
    items = ITEMS + [(20 + k, " ".join(texts[k].split()[:40])) for k in range(0, len(texts), 5)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    for most in (50, 3):
        got = ranked_search.search(docs, asked, most).select("item_id", "rank", "doc_id", "score").collect()
        assert sorted(map(tuple, got), key=str) == plain_ranking(rows, items, most)
    assert ranked_search.search(docs.limit(0), asked).count() == 0
    assert ranked_search.search(docs, asked.limit(0)).count() == 0
    assert ranked_search.search(docs, asked.filter("item_id = 2")).count() == 0


def test_ranked_search_in_blocks_of_items(spark, rows, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 6)
    got = ranked_search.search(table(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string"), 10)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == plain_ranking(rows, ITEMS, 10)


def random_trie(rng, n, width):
    sizes = rng.integers(0, 12, n)
    sizes[: n // 3] = sizes[0]
    lists = [np.sort(rng.choice(width, s, replace=False, p=(w := 1 / np.arange(1, width + 1)) / w.sum())) for s in sizes]
    lists[: n // 3] = [lists[0]] * (n // 3)  # a third of the rows share one vector
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    terms = np.concatenate(lists).astype(np.int64)
    tfs = rng.integers(1, 6, len(terms))
    tfs[: starts[n // 3]] = 1
    m = rng.integers(50, 300, n)
    m[: n // 3] = 77
    return ranked_search.Trie(rng.permutation(n), m, starts, terms, tfs, 5), lists


def test_bounds_hold_and_prune():
    """No document below a node scores more than its bound, and the search leaves subtrees."""
    rng = np.random.default_rng(2)
    trie, _ = random_trie(rng, 1200, 60)
    lists = [np.sort(rng.choice(60, 6, replace=False)) for _ in range(9)]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    query = ranked_search.Query(starts, np.concatenate(lists), rng.integers(1, 9000, starts[-1]), np.arange(60), 1200, 9000)
    items = np.arange(9)

    def leaves(node):
        return [node] if node < trie.leaves else [x for c in trie.children[node].tolist() for x in leaves(c)]

    for node in list(trie.children)[:: max(1, len(trie.children) // 40)]:
        bound = trie.scores(query, np.full(9, node), items)
        for leaf in leaves(node):
            assert (trie.scores(query, np.full(9, leaf), items) <= bound).all()
    assert sorted(leaves(trie.root)) == list(range(trie.leaves))
    best = ranked_search.Best(9, 5)
    looked_at = ranked_search.search_trie(trie, query, best)
    every = trie.scores(query, np.repeat(np.arange(trie.leaves), 9), np.tile(items, trie.leaves)).reshape(-1, 9)
    for i in range(9):
        want = sorted(((-int(every[leaf, i]), int(d)) for leaf in range(trie.leaves) for d in trie.ids[leaf] if every[leaf, i]))[:5]
        assert [(-int(s), int(d)) for s, d in zip(best.score[i], best.id[i])] == want
    assert looked_at < 9 * trie.leaves


def plain_targets(sizes, weights, share, most):
    """Targets by repeated sharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left = {}, sum(sizes.values()) * share / 100
    while True:
        free = [s for s in names if s not in target]
        rate = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if rate * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: rate * weight[s] for s in free}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]


def mixed_rows(spark, rows, **parameters):
    got = source_mix.mix(table(spark, rows), **parameters)
    return [r.asDict() for r in got.collect()]


def test_mix(spark, rows):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    for share in (150, 60, 195):
        got = mixed_rows(spark, rows, share=share)
        want = plain_targets(sizes, (3, 1, 2), share, 2)
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted((i is None, i or 0, size(t)) for i, t, *_ in rows)
        taken = collections.Counter()
        for r in got:
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
            assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
            assert math.floor(r["expected"]) <= r["copies"] <= math.ceil(r["expected"]) or not r["size"]
            taken[r["source"]] += r["taken"]
        for s in sizes:  # the cut is nearest, so it is off by half a document at most
            assert abs(taken[s] - want[s]) <= max(size(t) for _, t, _, x in rows if x == s) / 2 + 1e-6
        again = mixed_rows(spark, list(reversed(rows)), share=share)
        assert sorted(map(str, map(dict.items, got))) == sorted(map(str, map(dict.items, again)))
    assert source_mix.mix(table(spark, rows).limit(0)).count() == 0
    assert {r["taken"] for r in mixed_rows(spark, [(1, None, "en", "a"), (2, "", None, None)])} == {0}


def test_mix_with_unequal_weights(spark):
    """Inclusion follows the weights, words meet the targets, and no row passes the limit."""
    rng = random.Random(6)
    rows = [(k, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(1, 30))), "en", "hot" if k % 3 else f"s{k % 4}") for k in range(6000)]
    value = F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    got = mixed_rows(spark, rows, weights=(2, 1), share=40, value=value)
    for s in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 15
        assert all(0 <= r["copies"] <= 2 for r in mine)
        if s == "hot":
            share = [np.mean([r["copies"] for r in mine if r["doc_id"] % 2 == odd]) for odd in (0, 1)]
            expected = [np.mean([r["expected"] for r in mine if r["doc_id"] % 2 == odd]) for odd in (0, 1)]
            assert expected[0] == pytest.approx(3 * expected[1]) and share == pytest.approx(expected, abs=0.05)
    heavy = mixed_rows(spark, rows, weights=(2, 1), share=180, value=value)  # many rows reach the limit
    for s in {r["source"] for r in heavy}:
        mine = [r for r in heavy if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 15 and max(r["copies"] for r in mine) == 2


def test_mix_written_out(spark, rows):
    docs = table(spark, rows)
    planned = source_mix.mix(docs, carry=True)
    written = source_mix.repeated(planned)
    assert written.columns == docs.columns
    assert written.count() == planned.agg(F.sum("copies")).first()[0]
