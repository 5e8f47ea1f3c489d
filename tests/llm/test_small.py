"""Operators on small tables: brute force, round trips and odd rows (nulls,
empty and repeated rows, ties, empty tables, clashing extra columns)."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_ORACLE, SF_SMALL
from tidemark.llm import ann, chat, decontam, jaccard, licenses, lm, mixing, pii, quality, warc
from tidemark.llm.common import components, read

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
LONG = " ".join(WORDS[i * i % 19] + str(i % 97) for i in range(3000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label int"


def docs_of(spark, texts):
    rows = [(i, t, None, "s" if (i or 0) % 3 else None, len(t or ""), 0.5, 7) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


ODD = [
    (1, "Mail a.b@c.org now or call +49 30 1234567, card 4111 1111 1111 1111 and 10.0.0.1 or 300.1.1.1"),
    (2, ""), (3, None), (4, LONG), (5, LONG + " more"), (6, LONG + " more"), (6, LONG + " more"), (None, LONG + " tail"),
    (7, "one two"), (8, "ONE two"), (9, "under the MIT license, Apache License version 2 and CC-BY-NC"), (10, "x" * 50_000),
    (11, "1" * 30_000), (12, "a@b.c@d.e%x@y.z 1.2.3.4.5.6.7.8"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return [w.decode() for w in (t or "").encode().lower().split()]


def shingle_set(t):
    w = words(t)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(texts):
    sets = [shingle_set(t) for _, t in texts]
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * c >= 75 * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [b if x == a else x for x in comp]
    ids = {}
    for (d, _), c in zip(texts, comp):
        ids.setdefault(c, []).append(d)
    return Counter((d, len(s), min((x for x in ids[c] if x is not None), default=None)) for (d, _), s, c in zip(texts, sets, comp))


def test_jaccard_odd_rows(odd, empty):
    got = jaccard.classes(odd).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(ODD)
    assert jaccard.classes(empty).count() == 0


def test_jaccard_random_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 5)  # so that blocks are divided
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 10)
    rng, texts = np.random.default_rng(3), []
    for g in range(12):
        base = [f"w{x}" for x in rng.integers(0, 60, int(rng.integers(6, 90)))]
        for _ in range(int(rng.integers(1, 14))):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(len(t)))] = f"w{rng.integers(60)}"
            texts.append((len(texts), "common opening line of many texts here " * int(rng.integers(0, 2)) + " ".join(t)))
    got = jaccard.classes(docs_of(spark, texts)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(texts)


def test_jaccard_sends_only_sets_that_may_link(spark, monkeypatch):
    """Sets that share a passage but by their sizes, or by the place of their
    first common token, cannot link send no bitmaps; what links is still found."""
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 1)  # so that the passage is not put last
    rng = np.random.default_rng(8)
    some = lambda n: " ".join(f"v{x}" for x in rng.integers(0, 10**9, n))
    passage = some(12)
    texts = [(i, f"{some(20 + 40 * i * i)} {passage} {some(10)}") for i in range(12)]
    base = some(200)
    texts += [(100, base), (101, base + " " + some(40)), (102, some(30) + " " + base), (103, base[: len(base) // 2]), (104, "two words"), (105, None)]
    sent = []
    join_bitmaps = jaccard.join_bitmaps
    monkeypatch.setattr(jaccard, "join_bitmaps", lambda blocks, nodes: sent.extend(r.node for r in blocks.collect()) or join_bitmaps(blocks, nodes))
    docs = docs_of(spark, texts)
    got = jaccard.classes(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == brute_components(texts)
    few = {r.doc_id for r in got if r.doc_id < 12 and r.n_shingles > 1000}
    row = {r.rid: r.doc_id for r in jaccard.describe(docs, jaccard.frequent_tokens(docs, docs.count())).select("rid", "doc_id").collect()}
    assert len(few) > 4 and not few & {row[x] for x in sent}


def test_jaccard_reach_keeps_every_link(spark):
    """Where two sets link, each one's size is within the other's reach at the first token they share."""
    rng, rows = np.random.default_rng(9), []
    for _ in range(400):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.75, 1)], rng.integers(0, 2**63, int(len(a) * rng.uniform(0, 0.3)), dtype=np.uint64)]))
        common = np.intersect1d(a, b)
        if len(common) and jaccard.enough(len(common), len(a), len(b)):
            rows.append((len(a), int(np.searchsorted(a, common[0])), len(b), int(np.searchsorted(b, common[0]))))
    assert len(rows) > 100
    pairs = spark.createDataFrame(rows, "n long, i int, m long, j int")
    ok = (F.col("m") <= jaccard.reach(F.col("n"), F.col("i"))) & (F.col("n") <= jaccard.reach(F.col("m"), F.col("j")))
    assert pairs.filter(~ok).count() == 0
    assert spark.createDataFrame([(40, 0, 53, 54), (100, 15, 0, 0)], "n long, i int, m long, x long").select(jaccard.reach(F.col("n"), F.col("i"))).collect()[0][0] == 53


def test_frequent_tokens_are_counted_in_all_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 40)
    rng = np.random.default_rng(5)
    lines = [" ".join(f"l{i}w{j}" for j in range(9)) for i in range(40)]  # line i stands in about i + 1 of 400 texts
    texts = [(k, " | ".join([f"own{k} text{k}", *(x for i, x in enumerate(lines) if rng.random() < (i + 1) / 400)]) if k % 50 else None) for k in range(400)]
    counts = Counter(x for _, t in texts for x in (jaccard.shingles((t or "").encode()) >> np.uint64(64 - jaccard.FREQUENT_BITS)).tolist())
    want = {x for x, n in counts.items() if n >= 20}
    got = jaccard.frequent_tokens(docs_of(spark, texts).repartition(7), 400)
    assert len(want) > 50 and set(np.flatnonzero(got).tolist()) == want
    assert not jaccard.frequent_tokens(docs_of(spark, []), 0).any()


def test_keep_one(odd):
    kept = sorted((r.doc_id for r in jaccard.keep_one(odd).collect()), key=str)
    assert kept == sorted([1, 2, 3, 4, 7, 9, 10, 11, 12], key=str)


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 1), (7, 9), (9, 8), (7, 8)], "a long, b long")
    got = {r.node: r.root for r in components(e).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {7: 7, 8: 7, 9: 7}


def test_components_do_not_stop_early(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(e, max_rounds=1)


def test_lm_counts_base_and_normalisation(spark, odd, empty):
    rows = odd.select("doc_id", "text").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(True)))
    got = lm.score_corpus(rows, output_words=10, frequent=50).collect()
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 3 == 0
    c = Counter(w for d, t in ODD if not held(d) for w in words(t) + [""])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t in ODD:
        w = words(t) + [""]
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(d, held(d), len(w), sum(c[x] > 0 for x in w), n, round(base, 5))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert lm.score_corpus(empty.select("doc_id", "text").withColumn("held_out", F.lit(False))).count() == 0


def test_lm_distribution_sums_to_one():
    share = np.full(20, 0.05)
    p = lm.start_parameters(share)
    flat = np.array([20, 20, 20, 20, 3, 5], np.int32)
    total = 0.0
    for w in range(20):
        flat[5] = w
        total += 10 ** lm.log_probabilities(p, 20, flat, np.array([5]))[0]
    assert abs(total - 1) < 1e-5


def test_lm_groups_sum_to_one():
    v = 600
    share = 1 / np.arange(5.0, 5.0 + v)
    p = lm.start_parameters(share / share.sum()) + np.random.default_rng(1).normal(0, 0.5, len(lm.start_parameters(share))).astype(np.float32)
    assert len(lm.group_bounds(v)) > 10 and len(lm.group_of(v)) == v and (np.diff(lm.group_of(v)) >= 0).all()
    flat = np.tile(np.array([v, 9, 40, 577, 0], np.int32), v)
    flat[4::5] = np.arange(v)
    assert abs((10 ** lm.log_probabilities(p, v, flat, np.arange(4, 5 * v, 5))).sum() - 1) < 1e-4
    steep = p * 100  # beyond what exp holds
    assert abs((10 ** lm.log_probabilities(steep, v, flat, np.arange(4, 5 * v, 5))).sum() - 1) < 1e-4


def test_lm_learns_every_frequent_word(spark):
    # 200 words are more frequent than those of the pairs, which all are of one class
    pairs = [("leftish", "pearone"), ("rightish", "peartwo")]
    texts = [(k, " ".join(pairs[k % 2] * 2)) for k in range(120)]
    texts += [(1000 + k, " ".join(f"extra{(k * 8 + i) % 200}" for i in range(8))) for k in range(4000)]
    asked = {(-1, "leftish", "pearone"): 1, (-2, "rightish", "peartwo"): 1, (-3, "leftish", "peartwo"): -1, (-4, "rightish", "pearone"): -1}
    texts += [(d, f"{a} {b}") for d, a, b in asked]
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(2).withColumn("held_out", F.col("doc_id") < 0)
    score = {r.doc_id: r.score for r in lm.score_corpus(rows).collect()}
    # inside a class, scored by shares alone, the sum would be 0 whatever the contexts
    assert sum(sign * score[d] for (d, _, _), sign in asked.items()) > 0.05


def test_lm_rows_are_averaged_by_use():
    share, parts = np.full(40, 1 / 40), []
    for seed, ids in ((0, [14, 15, 16] * 20), (1, [14, 20, 21] * 60)):
        t = lm.Trainer(lm.start_parameters(share), share, seed)
        t.learn([(np.full(lm.CONTEXT, 40, np.int32), np.array(ids, np.int32))])
        parts.append(t)
    for part in range(4):
        rows = [x for t in parts for x in t.blocks() if x[0] == part]
        got = lm.averaged(pa.table(dict(zip(("part", "block", "i", "n", "x"), map(list, zip(*rows)))))).to_pylist()[0]
        i = np.frombuffer(got["i"], np.int32)
        n = [t.times[part][i, None] for t in parts]
        want = sum(k * t.parts[part][i] for k, t in zip(n, parts)) / sum(n)
        assert got["part"] == part and np.allclose(np.frombuffer(got["x"], np.float32).reshape(want.shape), want, atol=1e-5)
    assert {14, 15, 16, 20, 21} <= set(np.flatnonzero(parts[0].times[2] + parts[1].times[2]).tolist())


def test_lm_beats_base_on_held_out(spark):
    r = lm.op1_lm_score(spark, SF_ORACLE).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_nearest(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(8, 16))[rng.integers(8, size=600)] + 0.3 * rng.normal(size=(600, 16)), np.tile(rng.normal(size=16), (40, 1))])
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x.astype(np.float32))]
    bad = [(1000, None, 0), (1050, [0.0] * 16, 0), (1100, [float("nan")] * 16, 0), (1150, [1.0, None] + [1.0] * 14, 0), (None, [1.0] * 16, 0), (1200, [1.0] * 3, 0)]
    got = ann.nearest(spark.createDataFrame(rows + bad + rows[:2], "vec_id long, embedding array<float>, rank int"), F.col("vec_id") % 20 == 0).collect()
    y = x.astype(np.float32).astype(float)
    hit = total = 0
    for q in range(0, len(y), 20):
        s = (y * y[q]).sum(1) / (np.sqrt((y * y).sum(1)) * np.sqrt((y[q] ** 2).sum()))
        best = [i for i in np.lexsort((np.arange(len(y)), -np.round(s, 12))) if i != q][:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and all(abs(s[i] - v) < 1e-12 for _, i, v in mine)
        hit += len({m[1] for m in mine} & set(best))
        total += 5
    assert hit / total >= 0.9 and {r.query_id for r in got} == set(range(0, len(y), 20))
    three = ann.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<float>, rank int"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in three) == [1, 2]
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_nearest_in_many_cells_blocks_and_lots(spark, monkeypatch):
    """Recall against brute force where queries are routed between cells; no group outgrows its bounds."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(30, 16))
    x = np.concatenate([centre[rng.integers(30, size=1600)] + 0.3 * rng.normal(size=(1600, 16)), rng.normal(size=(800, 16))]).astype(np.float32)
    monkeypatch.setattr(ann, "CELL_ROWS", 150)
    monkeypatch.setattr(ann, "BLOCK", 60)
    monkeypatch.setattr(ann, "ASKED", 16)
    plain = ann.search_block

    def bounded(ids, vectors, queries, *rest):
        assert len(ids) <= 120 and len(queries) <= 48, (len(ids), len(queries))
        return plain(ids, vectors, queries, *rest)

    monkeypatch.setattr(ann, "search_block", bounded)
    got = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), F.col("vec_id") % 10 == 0).collect()
    y = x.astype(float)
    u = y / np.sqrt((y * y).sum(1, keepdims=True))
    hit = 0
    for q in range(0, len(y), 10):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5] and all(abs(u[i] @ u[q] - v) < 1e-9 for _, i, v in mine)
        s = u @ u[q]
        s[q] = -2
        hit += len({m[1] for m in mine} & {*np.argsort(-s)[:5].tolist()})
    assert hit / len(got) >= 0.95 and len(got) == 5 * 240


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_decontamination(spark, odd, empty):
    item = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of remarkable strength"
    near = item.replace("brown", "brwn").replace("seven", "eleven")
    far = " ".join(reversed(item.split()))
    texts = [(1, "Intro. " + item.upper() + "! outro"), (2, "x " + near + " y"), (3, far), (4, None), (5, ""), (6, item[:50]), (7, "say tiny today"), (8, item + ". " + item)]
    bench = spark.createDataFrame([(10, item, 1), (11, "Tiny", 2), (12, None, 3), (13, "", 4)], "item_id long, text string, doc_id long")
    got = decontam.find_matches(docs_of(spark, texts), bench).collect()
    assert sorted({(r.doc_id, r.item_id) for r in got}) == [(1, 10), (2, 10), (7, 11), (8, 10)]
    assert sum(r.doc_id == 8 for r in got) == 2
    for r in got:
        if r.item_id == 10:
            piece = decontam.normal(dict(texts)[r.doc_id].encode())[r.start : r.end]
            assert edit_distance(decontam.normal(item.encode()), piece) == r.edits <= 0.08 * len(item)
    assert [r.doc_id for r in decontam.keep_clean(docs_of(spark, texts), bench).orderBy("doc_id").collect()] == [3, 4, 5, 6]
    assert decontam.find_matches(empty, bench).count() == 0 and decontam.keep_clean(odd, bench.limit(0)).count() == len(ODD)


def test_decontamination_short_items():
    found = lambda items, docs: list(decontam.matches(decontam.Items(items, decontam.ERROR), docs))
    assert found([(1, b"tiny")], [b"tiny tiny say tiny tinyx"]) == [(0, 0, 0, 4, 0), (0, 0, 5, 9, 0), (0, 0, 14, 18, 0)]
    rng = np.random.default_rng(5)
    for m in range(8, 30):
        item = bytes(rng.integers(97, 123, m).astype(np.uint8))
        docs = [item, b"some words " + item + b" more " + item, b"x"]
        for k in range(m):  # one letter put in, left out or changed
            docs += [b"ab " + item[:k] + c + item[k + d :] + b" cd" for c, d in ((b"0", 0), (b"", 1), (b"0", 1))]
        got = found([(1, item)], docs)
        for d, text in enumerate(docs):
            best = min(edit_distance(item, text[a:b]) for a in range(len(text)) for b in range(a + max(0, m - 2), min(len(text), a + m + 2) + 1)) if len(text) >= m - 2 else m
            mine = [g for g in got if g[0] == d]
            assert bool(mine) == (best <= int(decontam.ERROR * m)), (m, text)
            assert all(edit_distance(item, text[s:t]) == e for _, _, s, t, e in mine)
        assert sum(g[0] == 1 for g in got) == 2


def test_decontamination_band_against_whole_matrix():
    """Long items with random edits, at the ends of texts too: the places and
    edits of the band are those of the whole matrix."""
    rng = np.random.default_rng(11)
    words = lambda n: b" ".join(bytes(rng.integers(97, 103, rng.integers(2, 9)).astype(np.uint8)) for _ in range(n))

    def fewest(item, text):  # edits of the whole item against any part of the text
        row = [0] * (len(text) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    seen = set()
    for size in (20, 60):
        item = words(size)
        budget = int(decontam.ERROR * len(item))
        for edits in (0, 1, budget // 2, budget - 1, budget, budget + 1, 2 * budget):
            for before, behind in ((b"", b""), (b"", words(6)), (words(6), b""), (words(9), words(3))):
                near = bytearray(item)
                for _ in range(edits):
                    k = int(rng.integers(len(near)))
                    near[k : k + int(rng.integers(2))] = bytes(rng.integers(97, 103, int(rng.integers(2))).astype(np.uint8))
                text = b" ".join(x for x in (before, bytes(near), behind) if x)
                got = list(decontam.matches(decontam.Items([(1, item)], decontam.ERROR), [b"other", text, item[:40]]))
                best = fewest(item, text)
                seen.add(best <= budget)
                assert bool(got) == (best <= budget), (edits, best)
                for d, _, s, t, e in got:
                    assert d == 1 and e == best == edit_distance(item, text[s:t]) and 0 <= s < t <= len(text)
    assert seen == {True, False}


def test_decontamination_long_item_fills_only_its_band():
    rng = np.random.default_rng(12)
    item = bytes(rng.integers(97, 123, 20_000).astype(np.uint8))
    near = bytearray(item)
    for k in rng.integers(0, len(item), 100):
        near[k] = 48
    text = b"some words " + bytes(near) + b" more"
    ((_, _, s, t, e),) = decontam.matches(decontam.Items([(1, item)], decontam.ERROR), [text])
    assert (s, t) == (11, 11 + len(item)) and e == len(set(np.flatnonzero(np.frombuffer(item, np.uint8) != np.frombuffer(bytes(near), np.uint8))))
    # a text that leaves the budget early is given up there
    assert decontam.align(item, bytes(rng.integers(97, 123, 20_000).astype(np.uint8)), 0, 3202, 1600) is None


def test_mixing(spark, odd, empty):
    docs = docs_of(spark, [(i, " ".join(["w"] * (1 + i % 7)), ) for i in range(900)]).withColumn(
        "source", F.when(F.col("doc_id") < 700, "big").when(F.col("doc_id") < 850, "mid").otherwise("small"))
    rows = mixing.mix(docs).collect()
    t = Counter()
    seen = Counter()
    w = {}
    for r in rows:
        t[r.source] += r.n_tokens
        seen[r.source] += r.n_tokens * r.epochs
        w[r.source] = r.weight
        assert r.epochs == len(r.draws) and r.epochs >= 1
    assert abs(sum(w.values()) - 1) < 1e-9
    for s in t:
        assert abs(seen[s] / sum(seen.values()) - w[s]) < 0.02
    assert max(seen[s] / t[s] for s in t) <= mixing.REPEAT + 0.05
    half = mixing.mix(docs, budget=sum(t.values()) / 2).collect()
    assert abs(sum(r.n_tokens * r.epochs for r in half) - sum(t.values()) / 2) < 3 * 8
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(empty).count() == 0


def test_quality(spark, odd, empty):
    r = quality.op6_quality(spark, SF_ORACLE).join(read(spark, SF_ORACLE, "labels"), "doc_id").filter("held_out").collect()
    assert np.mean([x.predicted == x.quality for x in r]) > 0.95
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels)
    kept = quality.keep_good(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert quality.fit(empty, labels)[1] == 0.0 and quality.keep_good(empty, model).count() == 0


def brute_features(text):
    """Features of one text, word by word."""
    out, h64 = Counter(), (1 << 64) - 1
    word = lambda w: sum(c * pow(int(quality.BASE), k, 1 << 64) for k, c in enumerate(w)) & h64
    words = text.split()
    for i, w in enumerate(words):
        out[int(quality.bucket(np.array([word(w)], np.uint64), 1)[0])] += 1
        out[quality.AGAIN] += i > 0 and words[i - 1] == w
        padded = b" " + w + b" "
        for n in quality.GRAMS:
            for k in range(len(padded) - n + 1):
                h = 0
                for c in padded[k : k + n]:
                    h = (h * int(quality.BASE) + c) & h64
                out[int(quality.bucket(np.array([h], np.uint64), n)[0])] += 1
    return +out


def test_quality_features_do_not_depend_on_pieces():
    rng = np.random.default_rng(1)
    texts = [("ab cde ab ab " * 400).encode(), b"x" * 900 + b" " + b"x" * 900, b" \n" * 300 + b"to to" + b"\t" * 300 + b"to", b"", b"   ", b"end end\n"]
    texts += [b" ".join(rng.choice([b"a", b"bb", b"bb", b"ccc"], int(rng.integers(1, 200)))) for _ in range(20)]
    want = [brute_features(t) for t in texts]
    for size in (3, 97, 1000, quality.PIECE):
        got = [Counter() for _ in texts]
        for owner, found in quality.all_features(texts, size):
            for o, f in zip(owner.tolist(), found.tolist()):
                got[o][f] += 1
        assert got == want


def test_quality_model_by_hand(spark):
    """Scores and the sample by plain Python: the labelled learning rows, their
    counts, the same training, the mean of the weights."""
    docs = read(spark, SF_SMALL, "documents").select("doc_id", "text", F.lit(1).alias("score"), F.lit("k").alias("k"))
    labels = read(spark, SF_SMALL, "labels")
    weight, bias = quality.fit(docs, labels)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    learn = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.doc_id in texts]
    key = {r.doc_id: r.k for r in docs.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}
    rows = []
    for d, y in sorted(learn, key=lambda x: key[x[0]]):
        c = brute_features(texts[d])
        f = sorted(c)
        rows.append((y, np.array(f, np.uint16), np.array([c[x] for x in f], np.uint32)))
    by_hand = quality.train(rows)
    assert np.array_equal(by_hand[0], weight) and by_hand[1] == bias
    got = {r.doc_id: r.score for r in quality.score_texts(docs.select("doc_id", "text", F.lit(True).alias("held_out")), (weight, bias)).collect()}
    for d, t in list(texts.items())[:40]:
        c = brute_features(t)
        z = sum(float(weight[f]) * n for f, n in c.items()) / max(1, sum(c.values())) + bias
        assert abs(got[d] - 1 / (1 + math.exp(-z))) < 1e-5
    # a sample bounded by bytes takes fewer rows
    assert quality.sample(docs, labels, 4000, 10**5).count() < len(rows) == quality.sample(docs, labels, 4000, 1 << 28).count()


def test_lm_runs_keep_their_context():
    text = np.arange(1, 12, dtype=np.int16)
    runs = [r for group in lm.batches_of([text, text[:2]], pad=0, limit=5) for r in group]
    assert [r[1].tolist() for r in runs] == [[1, 2, 3, 4, 5], [6, 7, 8, 9, 10], [11], [1, 2]]
    assert [r[0].tolist() for r in runs] == [[0, 0, 0, 0], [2, 3, 4, 5], [7, 8, 9, 10], [0, 0, 0, 0]]


CLASHING = "weight whole rest cut_text src block tk spans sid stk gid gtk row clean n_tokens draws reads rid kind start end key root".split()


def test_clashing_names_come_back_untouched(spark, odd):
    wide = odd.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHING])
    own = {"n_tokens", "weight", "epochs", "draws"}
    for name, out in {"mix": mixing.mix(wide), "sanitise": pii.sanitise(wide), "keep_one": jaccard.keep_one(wide)}.items():
        kept = [c for c in wide.columns if name != "mix" or c not in own]
        assert [c for c in out.columns if c in kept] == kept
        for r in out.collect():
            assert all(r[c] == f"{c}{'-' if r.doc_id is None else r.doc_id}" for c in CLASHING if c in kept), name
    model = np.zeros(quality.BUCKETS, np.float32), 0.0
    assert quality.keep_good(wide, model).columns == wide.columns


def test_chat_roles_of_any_characters(spark):
    roles = ["a\u0000b", "\\\\n", "\\n", "\n", "\\", "<|x", "<\\|", "\\\\\n\\\\\\n\u0000", ""]
    back = spark.createDataFrame([(r,) for r in roles], "r string").select("r", chat.unescape_role(chat.escape_role(F.col("r"))).alias("b")).collect()
    assert all(x.r == x.b for x in back)


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "\\", "<\\|", "<<|x", "a\\<|\\\\|", "", None, "é<|im_start|>user\nhi", "ends with <"]
    rows = [(c, t, ("user", "assistant", "sys\ntem\\n<|")[t % 3], nasty[(c + t) % len(nasty)], 1) for c in range(9) for t in range(7)]
    rows += [(3, 2, "user", "tie", 1), (None, 0, "user", "null id", 1), (3, 2, "user", "tie", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree int")
    got = {r.conv_id: r for r in chat.digest(frame).collect()}
    assert set(got) == set(range(9)) | {None}
    for c, r in got.items():
        mine = sorted(((t, role, text) for k, t, role, text, _ in rows if k == c), key=lambda x: (x[0], x[1], x[2] is not None, x[2] or ""))
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b or ''}\n" for _, a, b in mine).encode()).hexdigest()
        loss = "".join(b or "" for _, a, b in mine if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest(frame.limit(0)).count() == 0


def test_reply_branches(spark):
    m = spark.createDataFrame([(1, 1, None, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 99, None), (2, 1, None, 1.0)], "tree long, msg long, parent long, score double")
    got = {}
    for r in sorted(chat.reply_paths(m).collect(), key=lambda r: -r.above):
        got.setdefault((r.tree, r.leaf), (r.branch, []))[1].append(r.msg)
    assert got == {(1, 4): (1, [1, 2, 4]), (1, 3): (2, [1, 3]), (1, 5): (3, [5]), (2, 1): (1, [1])}
    assert {(r.tree, r.leaf) for r in chat.reply_paths(m, 1).collect()} == {(1, 4), (2, 1)}


def test_reply_paths_long_and_cyclic(spark):
    chain = [(1, i, i - 1 if i else None, 1.0) for i in range(300)] + [(1, 900 + i, 100 * i, 0.5) for i in range(3)]
    cycle = [(2, 1, 2, 1.0), (2, 2, 1, 1.0), (2, 3, 1, 1.0), (2, 4, None, None)]
    m = spark.createDataFrame(chain + cycle, "tree long, msg long, parent long, score double")
    got = {}
    for r in sorted(chat.reply_paths(m).collect(), key=lambda r: -r.above):
        got.setdefault((r.tree, r.leaf, r.branch, r.path_score), []).append(r.msg)
    want = {(1, 299, 1, 300.0): list(range(300)), (2, 4, 1, 0.0): [4]}
    want |= {(1, 900 + i, 4 - i, 100 * i + 1.5): [*range(100 * i + 1), 900 + i] for i in range(3)}
    assert got == want


def licence_base(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    at = [(i, label) for label, p in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def test_licenses(spark, odd, empty):
    notice = licenses.NOTICES[0][1].split()
    texts = ODD + [(20, " ".join(notice[:6] + ["really"] + notice[6:15])), (21, " ".join(notice[:5]))]
    got = licenses.scan(docs_of(spark, texts)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter((d, *licence_base(t)) for d, t in texts)
    by = {r.doc_id: r for r in got}
    assert by[20].labels == "mit" and 0.6 <= by[20].score < 1 and by[21].labels == "" and by[9].labels == "apache-2,cc-by-nc,mit"
    assert licenses.scan(empty).count() == 0


def test_license_statements_and_bodies(spark):
    body = "THE SOFTWARE IS PROVIDED 'AS IS', WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    head = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation"
    want = {
        "intro.\nThis work is licensed under the GNU General Public License, version 3. end": "gpl-3",
        "intro.\nAll rights reserved. end": "all-rights-reserved",
        "Licensed under CC BY-SA 4.0.": "cc-by-sa",
        "Licensed under CC BY 4.0": "cc-by",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Creative Commons Attribution-NonCommercial-ShareAlike 3.0": "cc-by-nc-sa",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl-2.1",
        "SPDX-License-Identifier: MIT": "mit",
        "GNU Affero General Public License v3": "agpl-3",
        "GNU General Public License": "gpl",
        "chapter. " + body + " chapter": "mit",
        head.format("program", ""): "gpl",
        head.format("program", "Affero "): "agpl",
        head.format("library", "Lesser "): "lgpl",
        "all rights were reserved under the general public": "",
    }
    got = licenses.scan(docs_of(spark, list(enumerate(want)))).collect()
    assert {list(want)[r.doc_id]: r.labels for r in got} == want
    assert all((r.n_base, r.base_labels) == ((1, "cc-by-nc") if r.labels == "cc-by-nc" else (0, "")) for r in got)


def parse_warc(data: bytes):
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        yield fields, rest[:n]
        data = rest[n + 4 :]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/x", "<html lang=en><title>A &amp; B</title><script>no<p></script><p>Hé<b>llo</b></p><a href='/y?a=1&amp;b'>link</a>", 0), (2, None, None, 0), (2, None, None, 0), (3, "http://c", "<p>" + "word " * 20000, 0)],
        "page_id long, url string, html string, key int",
    )
    out = warc.derive(warc.page_responses(pages))
    rows = out.collect()
    assert Counter(r.warc_type for r in rows) == {"metadata": 4, "conversion": 4}
    one = {r.warc_type: r for r in rows if r.key == 1}
    assert one["conversion"].block == "A & B\nHéllo\nlink" and one["conversion"].refers_to == one["metadata"].refers_to
    assert "title: A & B\r\nlanguage: en\r\noutlink: /y?a=1&b" in one["metadata"].block
    path = str(tmp_path / "warc")
    warc.write_warc(out, path)
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    got = list(parse_warc(data))
    assert len(got) == 8 and {f["WARC-Record-ID"] for f, _ in got} == {r.record_id for r in rows}
    assert all(f["WARC-Block-Digest"] == warc.sha1(b) for f, b in got)
    assert warc.derive(warc.page_responses(pages.limit(0))).count() == 0


def test_warc_unclosed_elements():
    assert warc.plain_text('<p>a</p><svg width="1"/><p>b</p><SVG>no</svg>c<svg class=x /><b>d</b>') == "a\nb\nc d"
    assert warc.plain_text("a<noscript>b<template>c<svg viewBox=1>d<p>e</p>") == "abcd\ne"
    assert warc.plain_text("a<template>no</template>b<svg>c<svg>d<script>no</script>e<style>no") == "a bcd e"
    assert warc.plain_text("a<!-- no <svg> -->b<!-- no") == "a b"
    meta = warc.derivatives("r", "u", "", "", "<svg/><a href='/x'>x</a><template><a href=/y>y</a>")[0][-1]
    assert "outlink: /x\r\noutlink: /y" in meta


def test_warc_hidden_titles_and_other_attributes():
    page = (
        "<!-- <title>old</title> --><svg><title>icon</title></svg><HTML class=x lang='de'><title>Real\n one</title>"
        "<a data-href='/wrong' href=\"/right?a=1&amp;b\">x</a><a name=href>y</a><a HREF = /bare>z</a><a title='href=/no'>w</a><title>late</title>"
    )
    assert warc.described(warc.shown(page)) == ("Real one", "de", ["/right?a=1&b", "/bare"])


def test_warc_unclosed_tags_take_linear_time():
    import time

    for piece in ("<title>", "<a ", "<svg ", "<svg>", "<a href='", "<!--", "<noscript>", "<html lang=", "<p", "</"):
        for page in (piece * 100_000, piece * 100_000 + ">"):
            begin = time.process_time()
            warc.derivatives("r", "u", "", "", page)
            assert time.process_time() - begin < 5, piece


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_base(t):
    t, out = t or "", []
    find = lambda p: list(re.finditer(p, t))
    out += [("email", m.start(), m.end()) for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    out += [("ip", m.start(), m.end()) for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(x) <= 255 for x in m[0].split("."))]
    for m in find(r"[0-9]([\x20-]?[0-9])+"):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_pii(spark, odd, empty):
    got = pii.digest(odd).collect()
    want = Counter()
    for d, t in ODD:
        b = ",".join(f"{k}:{a}:{e}" for k, a, e in pii_base(t))
        want[(d, hashlib.sha256(b.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    clean = {r.doc_id: r.text for r in pii.sanitise(odd).collect()}
    assert clean[1] == "Mail [EMAIL] now or call [PHONE], card [CARD] and [IP] or 300.1.1.1"
    assert clean[2] == "" and clean[3] is None and clean[4] == LONG
    assert pii.digest(empty).count() == 0 and pii.sanitise(empty).columns == empty.columns


def test_pii_terms_that_reveal(spark):
    texts = [(i, f"note {i}: Zanzibar desk, jo@x.org wrote the letter {i}") for i in range(6)]
    texts += [(100 + i, f"plain text {i} the letter desk") for i in range(60)]
    by = {r.doc_id: r.spans for r in pii.digest(docs_of(spark, texts)).collect()}
    assert all("term:8:16" in by[i] and f"term:" in by[i] for i in range(6)) and all(by[100 + i] == "" for i in range(60))
    out = {r.doc_id: r.text for r in pii.sanitise(docs_of(spark, texts)).collect()}
    assert "Zanzibar" not in out[0] and "the letter" in out[0] and out[100] == texts[6][1]


def brute_terms(texts):
    """{doc_id: (terms to generalise, terms to remove)} straight from the docstring's rule."""
    n = len(texts)
    assert n == len({t for _, t in texts})
    outside, values, owners = {}, {}, {}
    for d, t in texts:
        low, base = t.lower(), pii_base(t)
        values[d], owners[d] = set(), set()
        for k, a, e in base:
            v, digits = low[a:e], re.sub("[^0-9]", "", low[a:e])[:6]
            shared = v.split("@")[-1] if k == "email" else v.rsplit(".", 1)[0] if k == "ip" else digits
            values[d] |= {(k, v), (k, "shared", shared)}
            if k == "email":
                owners[d] |= set(re.findall("[a-z]{3,}", v.rsplit(".", 1)[0]))
                low = low[:a] + " " * (e - a) + low[e:]
        outside[d] = set(re.findall("[a-z]{2,}", low))
    df, dv, do = (Counter(x for xs in y.values() for x in xs) for y in (outside, values, owners))
    co = Counter((w, v) for d in outside for w in outside[d] for v in values[d])
    same = Counter(w for d in outside for w in outside[d] & owners[d])
    sets = {frozenset(d for d in values if v in values[d]) for v in dv if 2 <= dv[v] < n}
    trials = max(n, len(sets) * sum(c > 1 for c in df.values()))
    out = {}
    for d in outside:
        left = {}
        for w in outside[d]:
            for v in values[d]:
                c, mean = co[w, v], df[w] * dv[v] / n
                if 2 <= dv[v] < n and c > mean and math.exp(c - mean - c * math.log(c / mean)) <= pii.ALPHA / trials:
                    left[w] = min(left.get(w, 99), -math.log2((c + dv[v] / n) / (df[w] + 1)))
            if w in owners[d]:
                left[w] = min(left.get(w, 99), -math.log2((same[w] + do[w] / n) / (df[w] + 1)))
        out[d] = {w for w, x in left.items() if pii.REMOVE < x <= pii.GENERALISE}, {w for w, x in left.items() if x <= pii.REMOVE}
    return out


def check_terms(spark, texts):
    """Spans and cleaned texts against brute force; returns the number of places masked."""
    by = {r.doc_id: {s for s in r.spans.split(",") if s.startswith("term")} for r in pii.digest(docs_of(spark, texts)).collect()}
    out = {r.doc_id: r.text for r in pii.sanitise(docs_of(spark, texts)).collect()}
    brute, places = brute_terms(texts), 0
    for d, t in texts:
        base = [(a, e) for _, a, e in pii_base(t)]
        at = [m for m in re.finditer("[A-Za-z]{2,}", t) if m[0].lower() in brute[d][0] | brute[d][1] and all(m.end() <= a or m.start() >= e for a, e in base)]
        assert by[d] == {f"term:{m.start()}:{m.end()}" for m in at}
        places += len(at)
        assert out[d].count("[TERM]") == sum(m[0].lower() in brute[d][0] for m in at)
        if not base:
            assert out[d] == t
    return places


def test_pii_terms_of_rare_entities(spark):
    filler = "plain words stand here " * 30  # far more than any window
    texts = [(0, "Quorvex runs it. " + filler + "Mail jo@x.org, Quorvex's address; rare@quorvex.org. " + filler + "quorvex-based")]
    texts += [(1 + i, f"{filler} note {i}") for i in range(60)] + [(99, "Mail plain words"), (100, "Mail it runs address based rare org jo")]
    texts += [(200 + i, f"ann{i}@x.org Belvar {filler}") for i in range(2)] + [(300, f"Belvar {filler}")]
    t = texts[0][1]
    want = {f"term:{m.start()}:{m.end()}" for m in re.finditer("quorvex", t, re.I) if t[m.start() - 1] != "@"}
    assert len(want) == 3 == check_terms(spark, texts)  # words that stand in one text beside an entity are no evidence
    by = {r.doc_id: r.spans.split(",") for r in pii.digest(docs_of(spark, texts)).collect()}
    assert want <= set(by[0])
    out = {r.doc_id: r.text for r in pii.sanitise(docs_of(spark, texts)).collect()}
    assert "uorvex" not in out[0] and out[0].startswith("[TERM] runs it. plain") and "[EMAIL]" in out[0] and out[5] == texts[5][1]


def entity_corpus(n, seed=4):
    """Random texts; some hold entities of shared domains, networks and numbers, each with its own telling word."""
    rng = np.random.default_rng(seed)
    texts = []
    for i in range(n):
        ws = [f"w{'abcdefghij'[x % 10]}{'klmnopqrst'[x // 10 % 10]}{'uvwxyz'[x // 100 % 6]}" for x in rng.zipf(1.3, 25) % 600]
        k = i % 12
        if k < 4:
            ws.insert(int(rng.integers(25)), [f"u{i}@firm{i % 5}.org", f"10.20.{i % 4}.{i % 256}", f"+4930{i % 3}00{i:04d}", f"boss{i % 7}@home.net"][k])
        if k < 3 and rng.random() < 0.9:
            ws.insert(int(rng.integers(25)), [f"Acme{'abcde'[i % 5]}", f"Rack{'abcd'[i % 4]}", f"Ward{'abc'[i % 3]}"][k])
        if k == 3 and rng.random() < 0.5:
            ws.append("boss")
        texts.append((i, " ".join(ws) + f" {i}"))
    return texts


@pytest.mark.parametrize("n", [240, 1200])
def test_pii_terms_against_brute_force(spark, n):
    texts = entity_corpus(n)
    assert check_terms(spark, texts) > n / 12
    masked = set().union(*(a | b for a, b in brute_terms(texts).values()))
    assert all(w.startswith(("acme", "rack", "ward", "boss")) for w in masked) and "acmea" in masked


def test_pii_shuffled_words_are_no_evidence(spark):
    texts = entity_corpus(1200)
    entity = re.compile(r"[@+]|\d\.\d")
    pool = [w for _, t in texts for w in t.split()[:-1] if not entity.search(w)]
    pool = iter(np.random.default_rng(1).permutation(pool))
    mixed = [(d, " ".join(w if entity.search(w) or j == len(t.split()) - 1 else str(next(pool)) for j, w in enumerate(t.split()))) for d, t in texts]
    assert check_terms(spark, mixed) <= 1


def test_pipeline(spark):
    docs = read(spark, SF_SMALL, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontaminate", "pii", "mix"]
    out = corpus_pipeline.run(spark, SF_SMALL)
    rows = out.collect()
    assert {*docs.columns} < {*out.columns} and 0 < len(rows) <= docs.count()
    assert all(r.epochs >= 1 for r in rows) and not any(k in ("email", "ip", "card", "phone") for r in rows for k, *_ in pii_base(r.text))
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0


def fewest_edits(item, text):
    """Edits of the whole item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def pipeline_fixture(spark, folder):
    rng = np.random.default_rng(8)
    good = lambda n=28: " ".join(str(rng.choice(WORDS)) + str(rng.integers(30)) for _ in range(n))
    item = "seven quiet wizards brew a potion of remarkable strength below the old mill"
    texts = {i: good() for i in range(30)} | {40 + i: " ".join(rng.choice(["BUY", "now!!!", "$$$", "click"], 20)) + f" {i}" for i in range(12)}
    texts[60] = texts[0] + " tail"  # a chain of near copies, and one with too many changes
    texts[61] = texts[60] + " more words"
    texts[62] = texts[1][: len(texts[1]) // 2] + good(14)
    texts[63], texts[64] = f"{good(8)} {item.upper()}. {good(8)}", f"{good(8)} {item.replace('quiet', 'quet')} {good(8)}"
    texts[65] = f"{good(8)} seven wizards brew remarkable mill {good(8)}"
    texts |= {70 + i: f"{good(10)} Quorvex mail {'abcd'[i]}@quorvex.org or +49 30 123456{i} {good(8)}" for i in range(4)}
    texts |= {80: None, 81: "", 82: good(4000), None: good()}
    rows = [*texts.items(), (5, texts[5]), (5, texts[5])]
    docs = docs_of(spark, rows).withColumn("source", F.when(F.col("doc_id") < 20, "big").when(F.col("doc_id") > 69, "rare"))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(d, int(not 40 <= d < 52), 0) for d in texts if d is not None and d < 60]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item, 63), (2, None, None)], "item_id long, text string, doc_id long").write.parquet(f"{folder}/benchmark.parquet")
    return item


def cleaned(text, terms):
    """A text with its entities and terms replaced, from left to right."""
    generalise, remove = terms
    base = [(a, e, k) for k, a, e in pii_base(text)]
    spans = [(a, e, f"[{k.upper()}]") for a, e, k in base]
    for m in re.finditer("[A-Za-z]{2,}", text):
        w = m[0].lower()
        if w in generalise | remove and all(m.end() <= a or m.start() >= e for a, e, _ in base):
            spans.append((m.start(), m.end(), "[TERM]" if w in generalise else ""))
    out, at = "", 0
    for a, e, new in sorted(spans):
        if a >= at:
            out += text[at:a] + new
        at = max(at, e)
    return out + text[at:]


def test_pipeline_stages_against_plain_python(spark, tmp_path):
    """Every stage on its own input; repeated, null, empty and long rows go through all of them."""
    item = pipeline_fixture(spark, tmp_path)
    stages, sf = dict(corpus_pipeline.STAGES), str(tmp_path)
    docs = read(spark, sf, "documents")
    columns = docs.columns

    def step(name, docs):
        out = stages[name](spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        return spark.read.parquet(f"{sf}/{name}")

    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    weight, bias = quality.fit(docs, read(spark, sf, "labels"))

    def rated(text):
        c = brute_features((text or "").encode())
        return 1 / (1 + math.exp(-sum(float(weight[f]) * n for f, n in c.items()) / max(1, sum(c.values())) - bias))

    before, docs = pairs(docs), step("quality", docs)
    assert docs.columns == columns
    assert Counter(pairs(docs)) == Counter(x for x in before if rated(x[1]) >= quality.THRESHOLD)
    ids = {d for d, _ in pairs(docs)}
    assert not ids & set(range(40, 52)) and {*range(30), *range(60, 66), *range(70, 74), 82, None} <= ids

    before, docs = pairs(docs), step("near_duplicates", docs)
    sets = {x: shingle_set(x[1]) for x in before}
    group = {x: {x} for x in sets}
    for x in sets:
        for y in sets:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                both = group[x] | group[y]
                group |= dict.fromkeys(both, both)
    first = lambda g: min(g, key=lambda x: (x[0] is None, x[0]))
    want = Counter(x for x in before if not sets[x]) + Counter({first(g) for x, g in group.items() if sets[x]})
    assert docs.columns == columns and Counter(pairs(docs)) == want
    ids = {d for d, _ in want}
    assert 0 in ids and 62 in ids and not ids & {60, 61} and sum(d == 5 for d, _ in pairs(docs)) == 1

    before, docs = pairs(docs), step("decontaminate", docs)
    target = decontam.normal(item.encode())
    held = lambda t: fewest_edits(target, decontam.normal((t or "").encode())) <= int(decontam.ERROR * len(target))
    assert docs.columns == columns and Counter(pairs(docs)) == Counter(x for x in before if not held(x[1]))
    assert {d for d, _ in before} - {d for d, _ in pairs(docs)} == {63, 64}

    before, docs = docs.collect(), step("pii", docs)
    terms = brute_terms([(t, t) for t in {r.text or "" for r in before}])
    want = Counter((r.doc_id, t, r.source, len(t or "") if t is not None else r.n_chars) for r in before for t in [r.text and cleaned(r.text, terms[r.text])])
    assert docs.columns == columns and Counter((r.doc_id, r.text, r.source, r.n_chars) for r in docs.collect()) == want
    assert all("uorvex" not in (t or "") and ("[EMAIL]" in t) == (d in range(70, 74)) for d, t, *_ in want if t)

    before, rows = docs.collect(), stages["mix"](spark, docs, sf).collect()
    size = lambda t: len((t or "").split())
    tokens = Counter()
    for r in before:
        tokens[r.source or ""] += size(r.text)
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items()}

    def weights(alpha):
        z = sum(p**alpha for p in share.values())
        return {s: p**alpha / z for s, p in share.items()}

    def bisect(holds):
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if holds(weights(mid)) else (lo, mid)
        return hi if holds(weights(1.0)) else lo

    big = max(tokens, key=tokens.get)
    reads = lambda w: {s: w[s] * tokens[big] / w[big] / tokens[s] for s in w}
    alpha = bisect(lambda w: -sum(p * math.log(p) for p in w.values()) >= mixing.ENTROPY * math.log(len(w)) - 1e-12)
    if max(reads(weights(alpha)).values()) > mixing.REPEAT:
        low, high = 0.0, 1.0  # repeats fall with the exponent
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (low, mid) if max(reads(weights(mid)).values()) <= mixing.REPEAT else (mid, high)
        alpha = max(alpha, high)
    w, asked = weights(alpha), reads(weights(alpha))
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in before)
    for s in tokens:
        mine = [r for r in rows if (r.source or "") == s]
        whole = math.floor(round(asked[s], 6))
        assert all(abs(r.weight - w[s]) < 1e-5 and r.epochs in (whole, whole + 1) for r in mine)
        late = [(r.draws[-1].block_key, r.draws[-1].text_key, size(r.text)) for r in mine if r.epochs > whole and size(r.text)]
        rest = (asked[s] - whole) * tokens[s]
        drawn = sum(x[2] for x in late)
        assert not late and rest < 1 or drawn - max(late)[2] < rest + 0.1 and drawn > rest - 0.1
