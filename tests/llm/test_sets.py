"""Set joins, vectors, toxicity, suffix trees and the pipeline against brute force."""

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from cladespark.llm import jaccard, neardup, queries, suffix_tree, topk, toxicity  # noqa: E402
from cladespark.llm.components import components  # noqa: E402
from cladespark.storage import scratch  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def groups_by_brute_force(rows, size, percent):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in enumerate(sets):
        for b in range(a):
            both = len(s & sets[b])
            if both and 100 * both >= percent * (len(s) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for a, (key, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), key), key)
    return sorted((key, len(sets[a]), least[find(a)]) for a, (key, _) in enumerate(rows))


def families(seed):
    rng, rows = random.Random(seed), []
    for _ in range(25):
        base = [f"w{rng.randint(0, 200)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 12, 40, 100, 300]))]
        for _ in range(rng.randint(1, 20)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 30, len(base) // 12])):
                at = rng.randrange(len(own)) if own else 0
                rng.choice([lambda o, a: o.insert(a, f"x{rng.randint(0, 9)}"), lambda o, a: o and o.pop(min(a, len(o) - 1))])(own, at)
            rows.append((len(rows), " ".join(own).upper() if rng.random() < 0.1 else "\t".join(own)))
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n"), (len(rows) + 3, rows[0][1])]


@pytest.mark.parametrize(("size", "percent", "long_list"), [(3, 90, 2048), (5, 80, 2048), (2, 50, 3)])
def test_jaccard_groups(spark, monkeypatch, size, percent, long_list):
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    monkeypatch.setattr(jaccard, "SMALL_LIST", 1)
    rows = families(size)
    df = spark.createDataFrame([(k, t, 0, 0) for k, t in rows], "doc_id long, text string, n long, class long")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(df, size, percent).collect())
    assert got == groups_by_brute_force(rows, size, percent)


def test_jaccard_of_nothing_and_repeats(spark):
    assert jaccard.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.groups(df).collect()), key=str)
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (None, 0, None)], key=str)


def test_blocks_of_linked_sets_meet():
    """Sets that link share a list, whatever differs: for random pairs at the very bound."""
    rng = np.random.default_rng(1)
    for join in (jaccard.Join(3, 90), jaccard.Join(5, 80)):
        for n in (9, 10, 19, 60, 400, 3000):
            for _ in range(20):
                whole = rng.integers(0, 2**63, n, dtype=np.uint64)
                away = join.apart(2 * n - 1) if n > 1 else 0
                x, y = np.sort(whole), np.sort(np.concatenate([whole[: n - away // 2], rng.integers(0, 2**63, away - away // 2, dtype=np.uint64)]))
                both = len(np.intersect1d(x, y))
                if 100 * both >= join.percent * (len(x) + len(y) - both):
                    assert set(jaccard.block_keys(join, x)[0].tolist()) & set(jaccard.block_keys(join, y)[0].tolist()) or (len(x) == len(y) == both)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    names = rng.sample(range(10_000), 300)
    edges = list(zip(names[:100], names[1:100])) + [(names[100], x) for x in names[101:200]]
    with scratch(spark) as tables:
        got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), tables).collect()}
    assert got == {**{x: min(names[:100]) for x in names[:100]}, **{x: min(names[100:200]) for x in names[100:200]}}


def vectors(count, width, seed):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((count, width)).astype(np.float32)
    for i in range(0, count - 1, 3):
        rows[i + 1] = rows[i] + rng.standard_normal(width).astype(np.float32) * rng.choice([0, 0.05, 0.2])
    return rows


ODD_VECTORS = [None, [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf")] * 16, [], [1.0, 2.0]]


def test_near_vectors(spark):
    rows = vectors(400, 16, 2)
    data = [(i, v.tolist(), 1) for i, v in enumerate(rows)] + [(1000 + i, v, 1) for i, v in enumerate(ODD_VECTORS)] + [(2000, rows[0].tolist(), 1)]
    got = {r.vec_id: r for r in neardup.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<float>, class int")).collect()}
    ok = {i: np.pad(np.array(v, float), (0, 16 - len(v))) for i, v, _ in data if v and None not in v and np.isfinite(v).all() and np.any(v)}
    keys = list(ok)
    unit = np.array([ok[k] / np.linalg.norm(ok[k]) for k in keys])
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    links = {k: int(n) for k, n in zip(keys, near.sum(1))}
    found = sum(got[k].n_links for k in keys)
    assert all(got[k].n_links <= links[k] for k in keys)
    assert found >= 0.97 * sum(links.values())
    for i in range(len(ODD_VECTORS)):
        if 1000 + i not in ok:
            assert tuple(got[1000 + i]) == (1000 + i, 0, 1000 + i, True)
    assert got[2000].component_id == got[0].component_id == 0
    assert neardup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LARGE", 7)
    base = vectors(1, 8, 5)[0]
    rng = np.random.default_rng(3)
    rows = [(i, (base + rng.standard_normal(8).astype(np.float32) * 0.02).tolist()) for i in range(60)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.n_links for r in got} == {59}
    assert {r.component_id for r in got} == {0}


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(4)
    u = rng.standard_normal(64)
    u /= np.linalg.norm(u)
    v = u + rng.standard_normal(64) * 0.05
    v /= np.linalg.norm(v)
    found, inside = [], 0
    for seed in range(300):
        codes = neardup.Codes(neardup.Plan(64, 0.95, 2, 1, seed * 7 + 1))
        turned, signs, factor = codes.estimates(np.array([u]))
        estimate = float((signs @ codes.estimates(np.array([v]))[0].T)[0, 0] / (factor[0] * 8))
        found.append(estimate)
        inside += abs(estimate - u @ v) <= neardup.BOUND * math.sqrt((1 - factor[0] ** 2) / factor[0] ** 2 / 63)
    assert np.mean(found) == pytest.approx(u @ v, abs=0.02)
    assert inside >= 299


def test_exact_search(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 16)
    monkeypatch.setattr(topk, "QUERIES_IN_BLOCK", 3)
    rows = vectors(300, 16, 6)
    rows[7] = rows[3]
    data = [(i, v.tolist(), 0) for i, v in enumerate(rows)] + [(1000 + i, v, 0) for i, v in enumerate(ODD_VECTORS)] + [(9, rows[9].tolist(), 0)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score int")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, lambda key: key % 10 == 0, 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    ok = [(i, np.floor(1024 * np.pad(np.array(v, float), (0, 16 - len(v)))).astype(np.int64)) for i, v, _ in data if v is not None and None not in v and np.isfinite(v).all()]
    for q, x in ok:
        if q % 10 == 0:
            scores = sorted((-(int(x @ y)), i) for i, y in ok if i != q)[:5]
            assert got[q] == [(i, -s) for s, i in scores]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda key: key % 10 == 0).count() == 0
    few = topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>"), lambda key: key == 0).collect()
    assert [tuple(r) for r in few] == [(0, 1, 1, 1024 * 2048)]


def labelled(seed, count):
    rng = random.Random(seed)
    syllables = ["ba", "ne", "ti", "lo", "ker", "mun", "sa", "vi", "dro", "pel"]
    out = []
    for i in range(count):
        text = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(20, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["idiot", "moron", "stupid", "worthless"]))
        out.append((i, " ".join(text) + ".", toxic))
    return out


def test_toxic_texts_held_out():
    rows = labelled(1, 900)
    machine = toxicity.train([t for _, t, _ in rows[:600]], [y for *_, y in rows[:600]])
    scorer = toxicity.Scorer(machine)
    scores = scorer.scores([t for _, t, _ in rows[600:]])
    y = np.array([y for *_, y in rows[600:]])
    assert ((scores >= toxicity.THRESHOLD) == y).mean() > 0.97
    plain, dotted, spaced, inserted, missing, clean, empty, none = scorer.scores(["you idiot idiot", "you i.d.i.o.t i.d.i.o.t", "you i d i o t", "stuxpid worthlesss", "wortless stupd", rows[0][1] if not rows[0][2] else rows[1][1], "", None])
    assert min(plain, dotted, spaced, inserted) >= toxicity.THRESHOLD
    assert empty == none < toxicity.THRESHOLD
    assert missing > empty


def test_kernel_is_that_of_gapped_subsequences():
    import itertools

    def brute(s, t):
        def weights(x):
            x = f"\0{x}\0"
            out = collections.Counter()
            for at in itertools.combinations(range(len(x)), toxicity.ORDER):
                if at[-1] - at[0] < toxicity.SPAN:
                    out[tuple(toxicity.letter_codes()[ord(x[i])] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] - toxicity.ORDER + 1)
            return out

        a, b = weights(s), weights(t)
        norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return sum(v * b[k] for k, v in a.items()) / norm

    for s, t in (("idiot", "idxiot"), ("moron", "moran"), ("worthless", "wworthles"), ("abcd", "wxyz")):
        who, code, weight = toxicity.subsequences([s, t])
        one, two = ({int(c): w for c, w in zip(code[who == k], weight[who == k])} for k in (0, 1))
        assert sum(w * two.get(c, 0) for c, w in one.items()) == pytest.approx(brute(s, t), abs=1e-9)


def test_toxicity_query(spark):
    rows = labelled(2, 300)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, "idiot", "x"), (5000, None, "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, machine, ["doc_id"]).collect()}
    assert len(got) == 302
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [(got[i].predicted, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.score(docs, None, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), machine, ["doc_id"]).count() == 0


def test_a_task_fits_the_machine(spark, monkeypatch):
    driver, train = os.getpid(), toxicity.train

    def elsewhere(texts, labels):
        if os.getpid() == driver:
            raise MemoryError("the driver fits it")
        return train(texts, labels)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    rows = labelled(2, 300)
    machine = toxicity.fit(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert machine.margins(["idiot"])[0] > machine.margins(["table"])[0]


def tree_by_brute_force(train, tests):
    """Scores by the definition, over counters of word tuples."""
    tokens = [t + [None] for t in train]
    n = sum(map(len, tokens))
    uni = collections.Counter(w for t in tokens for w in t)
    z = n + 0.1 * (len(uni) + 1)
    base = lambda w: (uni[w] + 0.1) / z
    least = suffix_tree.LEAST
    often = {w for w, c in uni.items() if c >= least} | {None}
    levels, runs = [], {(w,): uni[w] for w in often if w is not None}
    for k in range(1, suffix_tree.DEPTH + 1):
        found = collections.Counter(tuple(t[i : i + k + 1]) for t in tokens for i in range(len(t) - k) if tuple(t[i : i + k]) in runs and t[i + k] in often)
        level = {g: c for g, c in found.items() if c >= least}
        levels.append((runs, level))
        runs = {g: c for g, c in level.items() if g[-1] is not None}
    after = [collections.defaultdict(dict) for _ in levels]
    for k, (own, level) in enumerate(levels):
        for g, c in level.items():
            after[k][g[:-1]][g[-1]] = (c - suffix_tree.DISCOUNT) / own[g[:-1]]
    kept = set()

    def probability(s, w):
        if not s:
            return base(w)
        own = after[len(s) - 1][s]
        if w in own:
            return own[w]
        before = s[1:]
        return max(1e-9, 1 - sum(own.values())) / max(1e-9, 1 - sum(probability(before, x) for x in own)) * probability(before, w)

    for k in range(len(levels)):
        for s, own in after[k].items():
            before = s[1:]
            if before and before not in kept:  # the tree grows from its root
                continue
            p = {w: probability(before, w) for w in own}
            rest, rest_before = max(1e-9, 1 - sum(own.values())), max(1e-9, 1 - sum(p.values()))
            if sum(q * math.log(q / p[w]) for w, q in own.items()) + rest * math.log(rest / rest_before) >= suffix_tree.DIVERGENCE:
                kept.add(s)
    def score(t):
        total = 0.0
        for i, w in enumerate(t + [None]):
            s = tuple(t[max(0, i - suffix_tree.DEPTH) : i])
            while s and s not in kept:
                s = s[1:]
            total += math.log10(probability(s, w))
        return total

    return [(len(t) + 1, sum(uni[w] > 0 for w in t) + (uni[None] > 0), n, sum(math.log10(base(w)) for w in t + [None]), score(t)) for t in tests]


def test_suffix_tree_scores(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "CHUNK", 700)
    monkeypatch.setattr(suffix_tree, "CHUNKS_TO_STORE", 2)
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(12)]
    texts = [[rng.choice("abcdefghij") for _ in range(rng.randint(0, 60))] + (passage if rng.random() < 0.4 else []) + [f"r{rng.randint(0, 400)}"] for _ in range(150)]
    rows = [(i, " ".join(t).upper() if i % 3 else " ".join(t), "x") for i, t in enumerate(texts)] + [(500, None, "x"), (501, "", "x"), (0, " ".join(texts[0]), "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = sorted(tuple(r) for r in suffix_tree.score_texts(df).collect())
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    own = [(i, words(t)) for i, t, _ in rows]
    want = sorted((i, held(i), *v) for (i, _), v in zip(own, tree_by_brute_force([t for i, t in own if not held(i)], [t for _, t in own])))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    np.testing.assert_allclose([g[6] for g in got], [w[6] for w in want], rtol=1e-6)  # what is left is sent in single precision
    assert sum(g[6] for g in got if g[1]) > sum(g[5] for g in got if g[1])


def test_packed_numbers_round_trip():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 1000):
        for top in (200, 2**40, 2**64 - 1):
            rows = np.sort(rng.integers(0, top, size, dtype=np.uint64, endpoint=True))
            assert (suffix_tree.unpacked(suffix_tree.packed(rows)) == rows).all()
            counts = rng.integers(0, 600, size)
            assert (suffix_tree.unpacked_counts(suffix_tree.packed_counts(counts)) == counts).all()
    for gaps in (np.zeros(0, np.float32), np.array([1.5, np.nan, -2, np.nan, 0, 7, 8, 9, np.nan], np.float32)):
        np.testing.assert_array_equal(suffix_tree.with_gaps(suffix_tree.without_gaps(gaps)), gaps)
    ids = rng.integers(0, 2**32, 1000, dtype=np.uint32)
    assert (suffix_tree.from_planes(suffix_tree.in_planes(ids)) == ids).all()


def test_classes_without_keys_link(spark):
    """Texts of rows without keys connect others."""
    own = [f"w{i}" for i in range(200)]
    texts = [" ".join(own[k : k + 150]) for k in (0, 5, 10)]
    rows = [(1, texts[0]), (None, texts[1]), (None, texts[1]), (3, texts[2])]
    got = {(r.doc_id, r.component_id) for r in jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (None, 1), (3, 1)}


def test_parts_of_a_bucket_ask_both_codes():
    """Pairs of two parts are found as within one."""
    rng = np.random.default_rng(3)
    codes = neardup.Codes(neardup.Plan(64, 0.95, 2, 1, 1))
    rows = rng.normal(size=(40, 64))
    rows = np.vstack([rows, rows + rng.normal(size=(40, 64)) * 0.02]).astype(codes.plan.number)
    side = [(i, 1, r.tobytes()) for i, r in enumerate(rows)]
    real = codes.estimates
    asked = []

    def shy(units):  # codes of the first part give nothing away
        turned, signs, factor = real(units)
        asked.append(len(units))
        return turned, (signs * -1 if len(asked) == 1 else signs), factor

    codes.estimates = shy
    a, b = neardup.compare(0, side[:40], side[40:], codes)
    assert {*range(40)} <= {i for i, j in zip(a.tolist(), b.tolist()) if i == j}


def test_runs_count_at_any_size(spark):
    """A pair seen twice counts however many other tokens there are; a share of the tokens would ask for three here."""
    texts = ["zip zap"] * 2 + [" ".join(f"w{i}x{j}" for j in range(2000)) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in suffix_tree.score_texts(spark.createDataFrame([*rows, (900, "zip zap")], "doc_id long, text string"), divisor=10**6, held=zlib.crc32(b"900") % 10**6).collect()}
    assert got[900].held_out
    assert got[900].train_tokens > 2 / 2e-5
    n, distinct = got[900].train_tokens, 2 + 60 * 2000 + 1
    z = n + 0.1 * (distinct + 1)
    # the first word has no context; zap follows zip, and the end zap, both times
    assert got[900].score == pytest.approx(math.log10(2.1 / z) + 2 * math.log10(0.75), rel=1e-9)


def test_suffix_tree_of_little(spark):
    assert suffix_tree.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = suffix_tree.score_texts(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(None, 3, 0, 0)]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).unionByName(docs.limit(1)).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    current = docs.unionByName(extra)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, SF)
        assert after.columns == docs.columns
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in current.select("doc_id").collect()}
        current = after
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).select("doc_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(k for k, _ in kept) == sorted(k for k, _, c in groups_by_brute_force(rows, 5, 80) if k == c)
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() >= packed.select("doc_id").distinct().count() > 0


def test_pipeline_stages_keep_columns_of_any_name(spark):
    """Columns that are called as the stages' own, null and empty texts, and an empty table."""
    mail = "Write to jane.doe@example.com or call Dr. Smith, please."
    rows = [(1, mail, 9, 0.5, [1], "x"), (2, None, None, 0.1, None, None), (3, "", 0, 0.2, [], ""), (4, "just a quiet text of some words that is clean", 3, 0.3, [2], "y"), (None, "no key here at all", 1, None, None, "z"), (5, "w" * 100_000, 7, 1.0, [3], "long")]
    kinds = "doc_id long, text string, n_chars int, score double, _found array<int>, predicted string"
    for docs in (spark.createDataFrame(rows, kinds), spark.createDataFrame([], kinds)):
        more = docs
        for name in ("entities", "_first", "_names", "_pieces", "_made", "_row", "_moved", "_given", "_text", "row", "_scored", "component_id", "n_shingles", "class", "key", "list", "label"):
            more = more.withColumn(name, F.col("score"))
        current = more
        for _, stage in corpus_pipeline.STAGES[:-1]:
            current = stage(spark, current, SF)
            assert current.columns == more.columns and current.dtypes == more.dtypes
            current = current.checkpoint()
        got = {r.doc_id: r for r in current.collect()}
        if docs.limit(1).count():
            assert set(got) == {1, 2, 3, 4, 5, None}
            for k, text, n, score, found, predicted in rows:
                r = got[k]
                assert (r["score"], r["_found"], r["predicted"], r["entities"], r["_made"]) == (score, found, predicted, score, score)
                assert (r["text"], r["n_chars"]) == ((text, n) if k != 1 else (r["text"], len(r["text"])))
            assert "jane.doe" not in got[1]["text"]
        assert corpus_pipeline.pack(spark, current, SF).filter("doc_id = 1").count() == docs.filter("doc_id = 1").count()
