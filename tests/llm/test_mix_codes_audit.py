"""Vector codes, mixing and the filter audit against brute force, with odd rows."""

import collections
import hashlib
import itertools
import random
import re
import struct

import numpy as np
import pytest
import xxhash

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from cladespark.llm import filter_audit, joins, mixing, vector_codes  # noqa: E402
from cladespark.storage import scratch  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- vector codes ---


def codes_by_brute_force(rows):
    """(key, vector, label) rows in Python's whole numbers: the rows that ``compress`` must give, sorted."""
    kept = [r for r in rows if r[1] is not None and None not in r[1] and np.isfinite([1024 * x for x in r[1]]).all()]
    width = -(-max((len(r[1]) for r in kept), default=1) // 4) or 1
    whole = [[int(np.floor(1024 * x)) for x in r[1]] + [0] * (4 * width - len(r[1])) for r in kept]
    start = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:256]
    books = [[whole[i][p * width : (p + 1) * width] for i in start] for p in range(4)]

    def nearest(v, p):
        part = v[p * width : (p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(4):
        found = [[nearest(v, p)[1] for v in whole] for p in range(4)]
        for p in range(4):
            for e in range(len(books[p])):
                own = [v[p * width : (p + 1) * width] for v, f in zip(whole, found[p]) if f == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()
    last = [[nearest(v, p) for p in range(4)] for v in whole]
    errors = [sum(d for d, _ in x) for x in last]
    sums = collections.Counter()
    for r, e in zip(kept, errors):
        sums[r[2]] += e
    top = 2**63 - 1
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in x), min(d, top), min(sums[r[2]], top), digest) for r, x, d in zip(kept, last, errors)), key=str)


def coded(spark, rows, kind="double"):
    df = spark.createDataFrame([(k, v, b, "x", 1, 2) for k, v, b in rows], f"vec_id long, embedding array<{kind}>, label int, code string, error int, key int").repartition(5)
    return sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=str)


def odd_vectors(count, width, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(3 * count), [rng.choice([-0.25, 0.0, 0.5, round(rng.gauss(0, 0.2), 3)]) for _ in range(width)], rng.choice([None, 0, 0, 0, 7])) for _ in range(count)]
    rows += rows[:3] + [(None, rows[-1][1], 1), (None, [0.1] * width, None), (5, None, 0), (6, [0.5, None], 0), (7, [float("nan")] * width, 0), (8, [float("inf")] + [0.0] * (width - 1), 0), (9, [], 3), (10, [0.3, -0.3], 3)]
    return rows


@pytest.mark.parametrize(("count", "width"), [(320, 8), (40, 10), (1, 3)])
def test_codes_are_those_of_whole_numbers(spark, monkeypatch, count, width):
    monkeypatch.setattr(vector_codes, "AT_ONCE", 50)
    rows = odd_vectors(count, width, count)
    assert coded(spark, rows) == codes_by_brute_force(rows)


def test_labels_that_are_not_broadcast(spark, monkeypatch):
    rows = odd_vectors(30, 4, 2)
    monkeypatch.setattr(joins, "BROADCAST_GROUPS", 1)
    assert coded(spark, rows) == codes_by_brute_force(rows)


def test_components_beyond_64_bits(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e30, -1e30, 3e25, 1e8, 0.5, -2.0]) * rng.random() for _ in range(8)], i % 2) for i in range(60)] + [(99, [1e306] * 8, 0)]
    assert coded(spark, rows) == codes_by_brute_force(rows)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 0)]):
        assert coded(spark, rows) == []


def test_intervals_hold_every_distance():
    rng = np.random.default_rng(1)
    for scale, width in itertools.product((1, 50, 2**20, 2**27), (1, 16, 200)):
        entries = rng.integers(-scale, scale + 1, (256, width))
        rows = np.vstack([rng.integers(-scale, scale + 1, (80, width)), entries[:20] + rng.integers(0, 2, (20, width))]).astype(float)
        book = vector_codes.Codebook(entries.tolist(), 2**40)
        exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in entries.tolist()] for x in rows.tolist()]
        best = [min(d) for d in exact]
        asked = collections.defaultdict(set)
        for r, e in zip(*book.screened(rows)):
            asked[int(r)].add(int(book.index[e]))
        seen = {tuple(c): at for at, c in reversed(list(enumerate(entries.tolist())))}
        for r, d in enumerate(exact):
            ties = {seen[tuple(entries[e].tolist())] for e in range(256) if d[e] == best[r]}
            assert ties <= asked[r]
        if scale >= 50 and width >= 16:  # and it saves work
            assert sum(map(len, asked.values())) < 3 * len(rows)


# --- mixing ---


def shuffled_by_brute_force(x, n, *keys):
    """keys: (value, its struct code). A round is an int, of four bytes."""
    state = 42
    for v, code in keys:
        state = xxhash.xxh64_intdigest(struct.pack(code, v), state)
    key = xxhash.xxh64_intdigest(struct.pack("<Q", state), 42)
    for r in range(mixing.ROUNDS):
        own = xxhash.xxh64_intdigest(struct.pack("<i", r), key)
        other = ((own - (1 << 64) if own >> 63 else own) - x) % n
        if xxhash.xxh64_intdigest(struct.pack("<q", max(x, other)), own) >> 63:
            x = other
    return x


def test_permutations_are_permutations(spark):
    for n in (1, 2, 3, 10, 1000):
        got = [r["p"] for r in mixing.shuffled(spark.range(n).withColumn("n", F.lit(n).cast("long")), "id", "n", [F.lit(5).cast("long"), F.col("n")], "p").orderBy("id").collect()]
        assert sorted(got) == list(range(n))
        assert got == [shuffled_by_brute_force(x, n, (5, "<q"), (n, "<q")) for x in range(n)]
        if n == 1000:
            assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.12
            assert len({b - a for a, b in zip(got, got[1:])}) > 600


def targets_by_brute_force(sizes):
    """sizes: words by source. Excess shared again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        level = (goal - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        above = {s for s in rest if weight[s] * level > 2 * sizes[s]}
        if not above:
            return {s: float(2 * sizes[s]) if s in full else weight[s] * level for s in order}
        full |= above


def odd_documents(seed, count=300):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = rng.choice(["hot"] * 5 + ["a", "b", "é", "\U0001f600", "", None, "z9"])
        rows.append((i, " ".join(rng.choice(["w", "ab", "Über", "x y"]) for _ in range(rng.choice([0, 1, 3, 40, 700]))), source))
    return rows + [(1, None, "a"), (None, "one two three", "hot"), (None, None, None), (7, " \t\n\x0b ", "only white")] + rows[:5] * 2 + [(5000, "long " * 6_000, "long")]


def mixed(spark, rows, **more):
    df = spark.createDataFrame([(k, t, s, "x", 1, 2.0) for k, t, s in rows], "doc_id long, text string, source string, number string, size int, target double")
    return sorted((tuple(r) for r in mixing.taken(df.repartition(4), **more).collect()), key=str)


def test_mix_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 5000)
    rows = odd_documents(1)
    got = mixed(spark, rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    targets = targets_by_brute_force(sizes)
    assert sorted((k, len(WORD.findall(t or "")), sizes[s], round(targets[s], 6)) for k, t, s in rows if k is not None) == sorted((k, n, m, round(g, 6)) for k, n, m, g, _ in got if k is not None)
    assert len(got) == len(rows)
    assert all(0 <= took <= 2 * n for _, n, _, _, took in got)
    by = {}
    for _, n, m, g, took in got:
        by.setdefault((m, round(g, 6)), [0, g])[0] += took
    for (m, _), (took, g) in by.items():  # sources by their size and target
        same = sum(1 for s in sizes if sizes[s] == m)
        assert abs(took - g * same) <= 64 * same
    monkeypatch.setattr(mixing, "STRETCH", 7)
    monkeypatch.setattr(joins, "BROADCAST_GROUPS", 2)
    assert mixed(spark, rows[::-1]) == got
    assert mixed(spark, rows, recipe=mixing.Recipe(seed=2)) != got


def test_slots_are_blocks_of_their_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 300)
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(i * 7 % 90)), "s%d" % (i % 4)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    recipe = mixing.Recipe(block=20, shard=50)
    with scratch(spark) as tables:
        mix = mixing.mix(docs, tables, recipe)
        texts = {(r["shard"], r["slot"]): r["text"].split() for r in mixing.texts(mix.spans, docs).collect()}
        slots = {(r["shard"], r["slot"]): (r["number"], r["draw"]) for r in mixing.drawn(mix.sources, recipe, tables).collect()}
        sources = {r["number"]: r for r in mix.sources.collect()}
        spans = mix.spans.collect()
        plan = mix.spans._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    total = sum(s["quota"] for s in sources.values())
    assert len(slots) == total
    assert sorted(slots) == [(i // 50, i % 50) for i in range(total)]  # every place once
    for number, s in sources.items():
        draws = sorted(d for n, d in slots.values() if n == number)
        assert draws == list(range(s["quota"]))
        whole = sorted(w for i, t, name in rows if name == s["source"] for w in t.split())
        times = collections.Counter(w for at, (n, _) in slots.items() if n == number for w in texts[at])
        assert set(times) <= set(whole)
        rounds, rest = divmod(s["quota"], s["blocks"])
        assert set(times.values()) <= {rounds, rounds + 1}
        assert len(whole) - len(times) < 20 * s["blocks"] if rounds == 0 else len(times) == len(whole)
    assert all(0 < len(t) <= 20 for t in texts.values())
    for s in spans:  # the block of each slot is that of its source's permutation
        number, draw = slots[s["shard"], s["slot"]]
        turn, index = divmod(draw, sources[number]["blocks"])
        assert s["block"] == shuffled_by_brute_force(index, sources[number]["blocks"], (recipe.seed, "<i"), (number, "<q"), (turn, "<q"))
        assert s["length"] > 0 and s["at"] + s["length"] <= 20
    by_shard = collections.Counter((shard, n) for (shard, _), (n, _) in slots.items())
    shares = {n: s["quota"] / total for n, s in sources.items()}
    assert len({by_shard[k, 0] for k in range(total // 50)}) > 1  # drawn, not dealt
    assert all(abs(by_shard[k, n] - 50 * p) < 6 * (50 * p * (1 - p)) ** 0.5 + 1 for n, p in shares.items() for k in range(total // 50 - 1))


def test_mix_of_nothing(spark):
    assert mixed(spark, []) == []
    assert mixed(spark, [(1, None, None), (2, "", "a")]) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixed(spark, [(1, "a b c", None)]) in ([(1, 3, 3, 4.5, 3)], [(1, 3, 3, 4.5, 6)])


# --- filter audit ---


def audit_by_brute_force(rows, labels):
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    docs = []
    for key, text, part in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = {c for c, f in zip("ABCDE", (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)), key is not None and key > first[t])) if f}
        docs.append((part or "", fails, key in good, key in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            for step in range(5):
                here, before = order[step], set(order[:step])
                removed = [d for d in own if here in d[1] and not d[1] & before]
                out[part, "".join(order), step + 1] = [
                    sum(1 for d in own if not d[1] & (before | {here})), len(removed), sum(1 for d in own if here in d[1] and d[1] & before), sum(1 for d in own if d[1] == {here}),
                    sum(1 for d in removed if d[2]), sum(1 for d in removed if d[3]),
                ]
        for c in "ABCDE":
            shapley = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == c and len(v) == 6)
            for (p, o, s), v in out.items():
                if p == part and o[s - 1] == c:
                    v.append(shapley)
    return sorted((*k, *v) for k, v in out.items())


def test_audit_counts_every_order(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SLICE", 40)
    rng = random.Random(4)
    parts = [["w%d" % i for i in range(120)], ["same"] * 150, ["LOUD", "Words"] * 60, ["a", "b#"], ["über", "\U0001f600", "x y", "c\x1cd"] * 40, ["w%d" % i for i in range(99)]]
    rows = []
    for i in range(160):
        chosen = [w for p in rng.sample(parts, rng.choice([1, 1, 2])) for w in p]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(chosen), rng.choice(["en", "en", "de", None, ""])))
    rows += rows[:4] + [(3, None, "en"), (500, "", "fr"), (501, None, None), (None, rows[0][1], "en"), (None, None, "en"), (600, "#$%&*|" * 40, "en"), (601, "Q " * 100_000, "en"), (602, "x" * 300_000, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for i in range(120)] + [(5, 1, 1), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(k, t, p, "x", 1, "y") for k, t, p in rows], "doc_id long, text string, lang string, mask string, quality int, part string").repartition(6)
    marks = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, text string")
    got = sorted(tuple(r) for r in filter_audit.audit(docs, marks).collect())
    assert got == audit_by_brute_force(rows, labels)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, marks).collect() == []
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    got = filter_audit.audit(one, marks).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {""}
