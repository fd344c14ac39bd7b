"""Each operator against brute force, exact round trips or held-out accuracy."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recordops.llm import (
    block_labeller,
    byte_pairs,
    cross_polytope,
    decontamination,
    license_notices,
    minhash_forest,
    mixing_coder,
    quality,
    suffix_sort,
    token_files,
    warc,
)

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_decontamination(spark, docs, texts, no_docs):
    items = [(1, " ".join(texts[6][1].split()[38:70])), (2, texts[7][1][300:]), (3, "One"), (4, None), (5, "changed"), (11, texts[6][1][:90])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = decontamination.brute_force([((i, t), t) for i, t in texts], items)
    got = decontamination.report(docs, bench)
    assert listed(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(((i, *want[i, t]) for i, t in texts), key=str)
    assert decontamination.report(no_docs, bench).count() == 0
    assert decontamination.report(docs, bench.limit(0)).filter("contaminated or n_hit > 0").count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(3)
    vectors = {i: rng.standard_normal(24).astype(np.float32) * (1 + i % 3) for i in range(1500)}
    vectors[40] *= 4
    for i in range(300, 700):
        vectors[i] = vectors[40]  # a vector that a third of the rows hold
    rows = [(i, v.tolist()) for i, v in vectors.items()]
    rows += [(2000, None), (2020, []), (2040, [0.0] * 24), (2060, [float("nan")] * 24), (2080, [None] * 24), (2100, [1.0])]
    found = cross_polytope.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 20 == 0)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == 75 * 20 and {q for q, *_ in got} == set(range(0, 1500, 20))
    assert cross_polytope.recall(got, vectors) >= 0.9
    for q, _, i, score in got[::37]:
        assert score == pytest.approx(float(vectors[q].astype(float) @ vectors[i].astype(float)), rel=1e-12)
    mine = sorted((r, i) for q, r, i, _ in got if q == 40)
    assert [i for _, i in mine] == list(range(300, 320)) and [r for r, _ in mine] == list(range(1, 21))
    assert cross_polytope.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("id") % 20 == 0).count() == 0


@pytest.mark.parametrize("chain", [1, 2, 3])
def test_chained_polytopes_with_crowded_buckets(spark, monkeypatch, chain):
    """Clusters, one with a third of the vectors, in buckets that are cut into many blocks."""
    monkeypatch.setattr(cross_polytope, "BLOCK", 50)
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((30, 16))
    vectors = {i: (centres[0 if i % 3 == 0 else i % 30] + 0.3 * rng.standard_normal(16)).astype(np.float32) for i in range(1200)}
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in cross_polytope.search(rows, F.col("id") % 40 == 0, chain=chain).collect()]
    assert sorted(r[:2] for r in got) == [(q, r) for q in range(0, 1200, 40) for r in range(1, 21)]
    assert cross_polytope.recall(got, vectors, queries=list(range(0, 1200, 40))) >= 0.9


def test_chain_is_fitted_to_the_size():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16))[rng.integers(0, 300, 3000)] + 0.2 * rng.standard_normal((3000, 16))
    near = [x[np.argsort(-(x @ q))[1:6]] for q in x[:40]]
    longest = np.sqrt((x * x).sum(1)).max()
    small, large = (cross_polytope.fit(x[:40], near, x[:1000], n, 8, longest, True, [1, 2]) for n in (3000, 10**9))
    assert small[0] == 1 and large[0] == 2
    lists = [cross_polytope.codes(x[:5], 3, 2, k) for k in (1, 10, 400)]  # probes of a shorter list lead a longer one
    assert (lists[2][:, :10] == lists[1]).all() and (lists[1][:, :1] == lists[0]).all()


def test_answers_are_complete(spark):
    """Few vectors, and outliers beside one tight cluster: each query has 20 rows, or all candidates."""
    rng = np.random.default_rng(8)
    schema = "vec_id long, embedding array<float>, entry long, query long, v string"
    table = lambda vectors: spark.createDataFrame([(i, v.tolist(), 1, 1, "x") for i, v in vectors.items()], schema)
    few = {i: rng.standard_normal(8).astype(np.float32) for i in range(21)}
    centre = rng.standard_normal(32) * 3
    near = {i: (centre + 0.01 * rng.standard_normal(32)).astype(np.float32) for i in range(1000)}
    near |= {i: rng.standard_normal(32).astype(np.float32) for i in range(0, 1000, 100)}
    for vectors in (few, near, {0: few[0]}, {0: few[0], 1: few[1]}):
        got = [tuple(r) for r in cross_polytope.search(table(vectors), F.col("id") % 20 == 0).collect()]
        asked = [i for i in vectors if i % 20 == 0]
        full = min(20, len(vectors) - 1)
        assert sorted(r[:2] for r in got) == [(q, r) for q in asked for r in range(1, full + 1)]
        assert cross_polytope.recall(got, vectors, queries=asked) >= (0.9 if full else 0)
    assert cross_polytope.recall([], near, queries=[0, 20]) == 0


def test_license_notices(docs, texts, no_docs):
    got = license_notices.scan(docs)
    want = []
    for i, t in texts:
        w = plain_words(t)
        hits = [(k, label) for p, label in license_notices.BASE_PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        at = [k for k, _ in hits]
        want.append((i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in hits}))))
    assert listed(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(want, key=str)
    fuzzy = got.filter("doc_id = 34").first()
    assert fuzzy["labels"] == "mit" and 0 < fuzzy["score"] < 1 and fuzzy["spans"][0]["edits"] == 2
    assert got.filter("not score between 0 and 1").count() == 0 and license_notices.scan(no_docs).count() == 0


def test_fuzzy_search_finds_every_bounded_edit():
    rng = random.Random(1)
    notice, edits, _ = license_notices.NOTICES[0]
    for _ in range(300):
        text = list(notice)
        for _ in range(edits):
            k = rng.randrange(len(text))
            text[k : k + 1] = rng.choice([[], [rng.choice("xyz")], [text[k], "q"]])
        assert any(i == 0 for *_, i, _ in license_notices.find_notices(("zz " * 50 + "".join(text) + " yy" * 50).encode()))


def test_quality(spark, docs, no_docs):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    scored = quality.score(rows, quality.fit(rows)).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    right = scored.select(F.avg((F.col("quality_kept") == (F.col("quality") == 1)).cast("double")), F.avg(F.when(F.col("quality") == 1, F.col("quality_kept").cast("double")))).first()
    assert right[0] > 0.95 and right[1] > 0.99
    model = quality.fit(docs)
    kept = {r["doc_id"]: r["quality_kept"] for r in quality.score(docs, model).collect()}
    assert not kept[1] and not kept[2] and not kept[3] and kept[10] and kept[30]
    assert quality.score(no_docs, quality.fit(no_docs)).count() == 0


def test_sample_is_bounded_and_fair(spark, monkeypatch):
    """With a third of the rows without id, and many equal ones, at most `sample` different rows are drawn."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "of", "the", "and"]
    rows = [(None if i % 3 == 0 else i, " ".join(rng.choice(words) for _ in range(30))) for i in range(900)]
    rows += [(None, "the same text again and again")] * 600
    seen = []
    monkeypatch.setattr(quality, "train", lambda model, drawn: seen.append(drawn))
    for parts in (3, 11):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        quality.fit(docs, sample=80)
    first, second = seen
    assert 40 <= len(first) <= 80
    assert [(y, a.tolist(), n.tolist()) for y, a, n in first] == [(y, a.tolist(), n.tolist()) for y, a, n in second]


def test_estimate_equals_plain_expectation_maximisation():
    patterns = np.array(list(itertools.product(range(3), repeat=3)))
    counts = np.random.default_rng(1).integers(0, 40, len(patterns)).astype(float)
    model = quality.estimate(patterns, counts, rounds=7)
    good = [{0: 0.98, 1: 0.3}.get(sum(v == quality.BAD for v in p), 0.02) for p in patterns.tolist()]
    for _ in range(7):
        mass = sum(c * g for c, g in zip(counts, good))
        prior = min(max(mass / counts.sum(), 1e-3), 1 - 1e-3)
        chance = {}
        for m in range(3):
            for side in (0, 1):
                weight = {v: 0.5 + sum(c * (g if side else 1 - g) for p, c, g in zip(patterns.tolist(), counts, good) if p[m] == v) for v in range(3)}
                chance |= {(m, side, v): w / sum(weight.values()) for v, w in weight.items()}
        good = []
        for p in patterns.tolist():
            bad_side, good_side = ((1 - prior, prior)[side] * np.prod([chance[m, side, v] for m, v in enumerate(p)]) for side in (0, 1))
            good.append(good_side / (good_side + bad_side))
    assert model.prior == pytest.approx(prior)
    assert model.posterior(patterns) == pytest.approx(good)


def distances(text, notice):
    """Fewest edits of the notice to any part of the text that ends at each place."""
    row = np.arange(len(notice) + 1)
    out = [int(row[-1])]
    for c in text:
        new = np.empty_like(row)
        new[0] = 0
        for j, d in enumerate(notice, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d))
        row = new
        out.append(int(row[-1]))
    return out


def test_notices_equal_a_search_of_all_places():
    rng = random.Random(9)
    notices = (("released under the mit license", 3, "mit"), ("all rights reserved", 2, "reserved"), ("mozilla public license", 2, "mpl"))
    for _ in range(60):
        text = ""
        while len(text) < 300:
            piece = list(rng.choice(notices)[0] if rng.random() < 0.6 else "lorem ipsum dolor sit")
            for _ in range(rng.randint(0, 5)):
                at = rng.randrange(len(piece))
                piece[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "e", " "])
            text += "".join(piece) + rng.choice(["", " ", " " * 9])
        found = license_notices.find_notices(text.encode(), notices)
        for i, (notice, edits, _) in enumerate(notices):
            mine = [(s, e, k) for s, e, j, k in found if j == i]
            ends = distances(text, notice)
            assert min((k for *_, k in mine), default=9) == (min(ends) if min(ends) <= edits else 9)
            for s, e, k in mine:
                assert distances(text[s:e], notice)[-1] <= k <= edits
            assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))
            for at in [p for p, d in enumerate(ends) if d <= edits]:  # every place is under a find or beside a better one
                assert any(s < at + len(notice) and e > at - len(notice) - edits for s, e, _ in mine)


def test_repeated_notices_take_time_in_proportion():
    import time

    for line in (b"released under the mot licence ", b"all rihts reserved all rights reserve "):
        start = time.perf_counter()
        found = license_notices.find_notices(line * (1_000_000 // len(line)))
        assert time.perf_counter() - start < 10
        assert len(found) >= 1_000_000 // len(line)


def test_suffix_order_is_exact():
    rng = np.random.default_rng(1)
    for n, k in itertools.product((1, 2, 3, 4, 5, 8, 40, 200), (1, 2, 5)):
        x = rng.integers(1, k + 1, n)
        assert suffix_sort.suffix_order(x, 9).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


@pytest.mark.parametrize("crowded", [8192, 2])
def test_repeated_strings(docs, texts, no_docs, monkeypatch, crowded):
    monkeypatch.setattr(suffix_sort, "CROWDED", crowded)
    want = suffix_sort.brute_force([((k, i), t) for k, (i, t) in enumerate(texts)])
    got = suffix_sort.remove_repeats(docs, carry=True)
    assert listed(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(((i, *want[k, i]) for k, (i, _) in enumerate(texts)), key=str)
    assert got.filter("row._key <> 'clash'").count() == 0 and suffix_sort.remove_repeats(no_docs).count() == 0


def test_near_duplicates(docs, texts, no_docs):
    sets = []
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append((i, {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} - {()}))
    group = {i: i for i, _ in sets if i is not None}
    for _ in sets:
        for (a, x), (b, y) in itertools.combinations([s for s in sets if s[0] is not None], 2):
            if x & y and 100 * len(x & y) >= 85 * len(x | y):
                group[a] = group[b] = min(group[a], group[b])
    got = listed(minhash_forest.near_duplicates(docs, size=3, percent=85), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(((i, len(s), group.get(i), i is None or group[i] == i) for i, s in sets), key=str)
    assert minhash_forest.near_duplicates(no_docs).count() == 0


def test_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert got.select("component_id").distinct().count() == 1


def test_star_of_variants_is_one_component(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(302)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        words = list(base)
        for k in rng.sample(range(1, 60), 7):
            words[k * 5] = f"x{i}"  # 21 of 300 shingles: 0.87 of the first text, about 0.76 of one another
        rows.append((i, " ".join(words)))
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), size=3, percent=85)
    assert got.groupBy("component_id").count().collect() == [(0, 1001)]


@pytest.mark.parametrize("rows_of_block", [512, 100])
def test_pairs_among_texts_of_one_template(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(minhash_forest, "ROWS", rows_of_block)
    frame = [f"w{k}" for k in range(249)]
    rows = [(i, " ".join(frame + [f"x{i}_{k}" for k in range(51)])) for i in range(600)]  # 0.7 alike
    for i in range(30):  # 0.86 alike to one of them
        words = rows[i * 20][1].split()
        words[265:288] = [f"y{i}_{k}" for k in range(23)]
        rows.append((1000 + i, " ".join(words)))
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), size=3, percent=84)
    parts = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert parts == {i: i for i in range(600)} | {1000 + i: i * 20 for i in range(30)}


@pytest.mark.parametrize("rows_of_block, long", [(20, 2048), (20, 100)])
def test_template_with_words_from_a_short_list(spark, monkeypatch, rows_of_block, long):
    monkeypatch.setattr(minhash_forest, "ROWS", rows_of_block)
    monkeypatch.setattr(minhash_forest, "LONG", long)
    rng = random.Random(9)
    frame = [f"w{k}" for k in range(96)]
    rows = []
    for i in range(300):
        words = list(frame)
        for k in range(0, 96, 12):
            words[k] = f"s{k}_{rng.randrange(4)}"
        rows.append((i, " ".join(words + ["more"] * (i % 3) + [f"t{k}" for k in range(i % 5)])))
    sets = [(i, set(zip(w, w[1:], w[2:]))) for i, t in rows for w in [t.split()]]
    group = {i: i for i, _ in sets}
    links = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if 100 * len(x & y) >= 85 * len(x | y)]
    for _ in range(10):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    assert 20 < len(links) and 20 < len(set(group.values())) < 290
    got = minhash_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), size=3, percent=85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == group


def test_leading_shingles_and_runs_of_groups(spark):
    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 1 << 62, 60, dtype=np.uint64) << np.uint64(2))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in [1, 2, 20, 20, 21, 40, 50, 55]]
    rows = [(bytes([i]), len(s), i, s.tobytes()) for i, s in enumerate(sets)]
    found = minhash_forest.leading_tokens(spark.createDataFrame(rows, "_key binary, n_shingles long, part long, shingles binary"), 60).collect()
    leads = {i: {bytes(r["prefix"]): bytes(r["earlier"]) for r in found if r["part"] == i} for i in range(len(sets))}
    for (a, x), (b, y) in itertools.combinations(enumerate(sets), 2):
        common = len(np.intersect1d(x, y))
        if 100 * common >= 60 * (len(x) + len(y) - common):
            assert leads[a].keys() & leads[b].keys()
        both = leads[a].keys() & leads[b].keys()
        firsts = [t for t in both if not any(leads[a][t][i : i + 8] in both for i in range(0, len(leads[a][t]), 8))]
        assert len(firsts) == min(1, len(both))
    assert all(r["place"] <= len(sets[r["part"]]) - -(-60 * len(sets[r["part"]]) // 100) for r in found)
    one = spark.createDataFrame([(k, n, 0, s) for k, n, _, s in rows], "_key binary, n_shingles long, part long, shingles binary")
    assert minhash_forest.leading_tokens(one, 60).count() == 0
    import pyarrow as pa

    batch = lambda rows: pa.RecordBatch.from_pylist([dict(zip(["tree", "prefix", "lo", "hi", "row"], (0, b"%d" % g, 0, 0, r))) for g, r in rows], pa.schema([("tree", pa.int32()), ("prefix", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("row", pa.int64())]))
    batches = [batch([(1, 0), (1, 1), (2, 2)]), batch([]), batch([(2, 3)]), batch([(3, 4), (4, 5)]), batch([(5, 6)])]
    seen = minhash_forest.each_block(lambda table: [table["row"].to_pylist()])(iter(batches))
    assert list(seen) == [[0, 1], [2, 3], [4], [5], [6]]


def test_warc(spark):
    big = "<p>é</p>" * 40_000
    rows = [(5, "http://a", "<p>x</p>"), (3, "http://b c\n", "<p>x</p>"), (9, None, ""), (8, "u", None), (7, "v", big), (6, "w", big)]
    rows += [(100 + i, f"http://h/{i}", f"<p>{i}</p>\r\n\r\nWARC/1.1\r\n") for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    first, want = {}, []
    for i, _, h in sorted(rows):
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        f = first.setdefault(digest, i)
        want.append((i, len(data), digest, "response" if f == i else "revisit", None if f == i else str(f)))
    got = warc.archive(pages)
    assert listed(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)
    assert {r["page_id"]: r["payload"] for r in got.collect()}[6] == big.encode()
    assert warc.archive(pages.limit(0)).count() == 0
    few = warc.records(pages, least_bytes=1)
    assert few.filter("not stored").count() == 2  # empty payloads are stored each time


def test_labeller_on_pages_it_has_not_seen(spark):
    rng, wrong, total = random.Random(77), 0, 0
    for _ in range(60):
        found = block_labeller.blocks(block_labeller.sample_page(rng))
        if found:
            chance = block_labeller.label([[(t.lstrip(block_labeller.MAIN), *r) for t, *r in found]], block_labeller.trained())[0]
            wrong += sum((c >= 0.5) != t.startswith(block_labeller.MAIN) for c, (t, *_) in zip(chance, found))
            total += len(found)
    assert wrong <= 0.03 * total
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>" + "word " * 30 + "<p>two<b>three</b> <script>if (a<b) x('</p>')</script></article><footer>&copy; z</footer>"), (4, "u", "<p a='>" * 3000)]
    got = {r["page_id"]: r["text"] for r in block_labeller.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), keep_blocks=True).collect()}
    assert got[1] == got[2] == "" and got[3] == "A & B " + "word " * 30 + "twothree"


def test_elements_without_text_end_where_they_close():
    texts_of = lambda page: [b[0] for b in block_labeller.blocks(page)]
    assert texts_of("<p>a</p><svg class=i /><p>b</p><math/><p>c<svg><path/></svg>d</p>") == ["a", "b", "cd"]
    for name in ("svg", "math", "iframe", "object", "canvas", "template"):
        assert texts_of(f"<p>a</p><{name} x=1><p>b</p>") == ["a", "b"], name
        assert texts_of(f"<p>a</p><{name}>x</{name}><p>b</p>") == ["a", "b"], name
    for name in ("svg", "math", "object", "canvas", "template"):
        assert texts_of(f"<p>a</p><{name}>x<{name.upper()}>y</{name}>z</{name} ><p>b</p>") == ["a", "b"], name
        assert texts_of(f"<p>a</p><{name}><p>b</p><{name}>x</{name}><p>c</p>") == ["a", "b", "c"], name
    assert texts_of("<p>a</p><svg><svg/>x</svg><p>b</p><svg><script/>x</svg><p>c</p>") == ["a", "b", "c"]
    assert texts_of("<p>a</p><script>'<svg>'</script><p>b</p><svg>x<!-- </svg> -->y</svg><p>c</p>") == ["a", "b", "c"]
    assert texts_of("<p>a</p><style>x</style><p>b</p><script>x <p>c</p>") == ["a", "b"]


@pytest.mark.parametrize("kinds", [1, 3, 60_000])
def test_coder_round_trip(kinds):
    rng = np.random.default_rng(kinds)
    for n in (0, 1, 2, 129, 5000):
        ids = rng.integers(0, kinds, n)
        block = mixing_coder.pack(ids)
        assert (mixing_coder.unpack(block) == ids).all()
        if n:
            broken = bytearray(block)
            broken[-1] ^= 1
            with pytest.raises(mixing_coder.Damaged):
                mixing_coder.unpack(bytes(broken))


def test_words_of_any_letters_give_the_ids_of_the_text():
    odd = ["Σας ΣΑΣ İstanbul ﬁ ſt éa Straßë ẞ?", "it's don't 'tis ab'' x...y", "×÷ æ×æ Œuvre naïve,— a b c\x85d \x1c e\x0bf"]
    odd += ["12ab ab12 <|endoftext|> </w> a</w> #@! Ĳ Ñandú. «Éa» µm ªº", "Å", "ÅNGSTRÖM, ÅÅ!! A\u030a e\u0301a \u0301x", "", " \t\n"]
    whole = token_files.tokenizer(WORDS)[0]
    odd += ["a--b ...c -d e-f- --", "3.14, 2nd!", "«x» ÀÉ× ÷ß”. x×y", "a\x00b ñ.", "don't!? (yes).", "éé,é é.. .é", "ab\u3000c é\u2028.", "À", "zÃ©Ã"]
    ids, edges = token_files.encode_words([x.encode() for x in odd], WORDS)
    for text, a, b in zip(odd, edges, edges[1:]):
        assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert token_files.encode_words([], WORDS)[1].tolist() == [0]


def test_token_files_of_a_hot_id(spark, tmp_path):
    """A third of the rows has no id: they are dealt to several files, equal ones too, and no id is lost."""
    rows = [(None if i % 3 == 0 else i, "same text" if i % 2 else f"text number {i} of many", "x") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(6)
    token_files.write(docs, str(tmp_path / "ids"), WORDS, 1, shards=8)
    files = spark.read.parquet(str(tmp_path / "ids"))
    hot = files.select("shard", F.explode("names").alias("name")).filter("name is null").groupBy("shard").count().collect()
    assert len(hot) >= 2 and max(r["count"] for r in hot) < 700
    whole = token_files.tokenizer(WORDS)[0]
    got = token_files.read(files, keep_ids=True).collect()
    want = [(str(i), tuple(whole.encode(t, add_special_tokens=False).ids + [1])) for i, t, _ in rows]
    assert sorted(want) == sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got)
    starts = sorted((r["start"], r["n_tokens"], r["doc_id"] is not None, r["doc_id"] or 0) for r in got)
    assert [s for s, *_ in starts] == [0, *np.cumsum([n for _, n, *_ in starts])[:-1].tolist()]
    assert [r[2:] for r in starts] == sorted(r[2:] for r in starts)


def test_token_files(docs, texts, no_docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    want, start = [], 0
    for i, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert listed(token_files.round_trip(docs, WORDS, 1), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    assert token_files.round_trip(no_docs, WORDS, 1).count() == 0


def test_parts_are_decoded_by_offsets(docs):
    for row in byte_pairs.encode(docs, RANKS).join(docs.select("doc_id", "text"), "doc_id").collect():
        whole, ids, offsets = (row["text"] or "").encode(), bytes(row["ids"]), bytes(row["offsets"])
        places = np.frombuffer(offsets, "<u4")
        assert len(places) == row["n_tokens"] + 1 and places[-1] == len(whole)
        assert byte_pairs.decode_ids(ids, offsets, RANKS) == whole
        for first, last in ((0, 5), (3, 17), (len(whole) // 2, len(whole) // 2 + 1), (len(whole) - 4, len(whole) + 9), (9, 9)):
            assert byte_pairs.decode_ids(ids, offsets, RANKS, first, last) == whole[max(first, 0) : max(last, 0)]


def test_byte_pairs(docs, texts, no_docs):
    import tiktoken

    ranks = byte_pairs.load_ranks(RANKS)
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text in texts:
        ids = whole.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert listed(byte_pairs.encode(docs, RANKS), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    assert byte_pairs.encode(no_docs, RANKS).count() == 0
    rng = random.Random(1)
    parts = ["'", "s", "re", "'ll", " ", "  ", "\n", "\xa0", "é", "٣", "!", "　", "日本", "🙂", "\x1c", "\0"]
    odd = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert [np.frombuffer(i, "<u4").tolist() for i, _ in byte_pairs.encode_texts(odd, RANKS)] == whole.encode_ordinary_batch(odd)


def test_pipeline_stages_take_any_documents(spark, docs, no_docs):
    sf = "/root/testdata/sf0.001"
    for start in (docs, no_docs):
        rows = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, sf)
            assert rows.columns == docs.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
        assert last.filter("n_tokens is null").count() == 0
    assert last.count() == 0


def test_pipeline_keeps_one_of_each_group(spark, docs):
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert kept.count(36) == 1 and 30 in kept and 31 not in kept and 5 not in kept and None in kept
