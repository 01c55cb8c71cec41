"""SimHash near-dedup, cap-filter dedup, top-k and components against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from metroframe.llm import capfilters, queries, simhash, topk
from metroframe.llm.components import components


def smallest_reachable(ids, links):
    """id -> smallest id reachable, by plain union-find."""
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 80)]
    noise = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(90)]
    links = chain + [(b, a) for a, b in hub] + noise + [(5, 5), (7, 8), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = smallest_reachable({x for l in real for x in l}, real)
    assert set(got) == set(want)
    groups = {}
    for node, root in got.items():
        groups.setdefault(root, set()).add(want[node])
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == len(set(want.values()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "   \n", "One", "one TWO", "a b c", "A b c d " * 50, "ÉTÉ\u2003x y Ω z", "x" * 70_000, "w " * 70_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("shingle", [1, 3, 4])
def test_fingerprint_of_long_texts_in_runs(monkeypatch, shingle):
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abC") for _ in range(rng.randrange(1, 9))) for _ in range(n)) + " " * pad for n in (1, 2, 3, 4, 40, 333) for pad in (0, 9)]
    whole = [simhash.fingerprint(t.encode(), shingle) for t in texts]
    assert whole == [plain_fingerprint(t, shingle) for t in texts]
    monkeypatch.setattr(simhash, "RUN_BYTES", 7)
    assert [simhash.fingerprint(t.encode(), shingle) for t in texts] == whole


def near_codes(rng, n, groups, flips):
    out = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(n // groups):
            code = base
            for _ in range(rng.randrange(flips + 1)):
                code ^= 1 << rng.randrange(64)
            out.add(code)
    return sorted(out)


@pytest.mark.parametrize("max_bits,bucket_rows", [(3, 1024), (3, 7), (1, 16), (5, 50), (0, 8)])
def test_hamming_links_equal_brute_force(spark, max_bits, bucket_rows):
    codes = near_codes(random.Random(max_bits), 300, 5, 5)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed] + [(None,)], "fp long")
    got = [(r.a, r.b, r.distance) for r in simhash.links(df, "fp", max_bits, bucket_rows).collect()]
    want = {(min(a, b), max(a, b), (x ^ y).bit_count())
            for (a, x), (b, y) in itertools.combinations(zip(signed, codes), 2) if (x ^ y).bit_count() <= max_bits}
    assert len(got) == len(set(got)) and set(got) == want


def test_trie_walk_in_small_steps():
    codes = np.array(near_codes(random.Random(9), 200, 2, 4), np.uint64)
    whole = np.array([[0, len(codes)]])
    pairs = lambda most: sorted((int(i), int(j), int(d)) for a, b, c in simhash.trie_pairs(codes, whole, whole, 0, 3, most)
                                for i, j, d in zip(np.minimum(a, b), np.maximum(a, b), c))
    brute = sorted((i, j, d) for i, j in itertools.combinations(range(len(codes)), 2) if (d := (int(codes[i]) ^ int(codes[j])).bit_count()) <= 3)
    assert pairs(1 << 20) == pairs(16) == brute


DOCS = [(1, "alpha beta gamma delta epsilon"), (2, "ALPHA beta  gamma delta epsilon"), (2, "other words stand here now"), (3, None), (4, ""), (5, " \t"),
        (None, "alpha beta gamma delta epsilon"), (None, "nobody else says this at all"), (7, "other words stand here now"), (7, "other words stand here now"),
        (8, "long " * 5000)]


def simhash_brute(rows):
    fps = [plain_fingerprint(t or "") for _, t in rows]
    places = range(len(rows))
    group = smallest_reachable(places, [(i, j) for i, j in itertools.combinations(places, 2) if (fps[i] ^ fps[j]).bit_count() <= 3])
    members = {}
    for i in places:
        members.setdefault(group[i], []).append(i)
    least = {g: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for g, m in members.items()}
    return [(rows[i][0], f"{fps[i]:016x}", least[group[i]]) for i in places], members


def test_simhash_edge_cases(spark):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in DOCS], "doc_id long, text string, component_id string, fp int")
    got = simhash.near_duplicates(df).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    want, members = simhash_brute(DOCS)
    order = lambda rows: sorted(map(tuple, rows), key=str)
    assert order(got) == order(want)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns and kept.count() == len(members)
    empty = df.limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


def test_simhash_query_equals_brute_force(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op3_simhash_dedup(spark, sf_small).collect()))
    assert got == sorted(simhash_brute(rows)[0])


# ---- embeddings

def cosine_brute(rows, threshold):
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    links = []
    for i, j in itertools.combinations(good, 2):
        a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
        if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
            links.append((i, j))
    group = smallest_reachable(range(len(rows)), links)
    count = [0] * len(rows)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    least = {}
    for i, g in group.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], count[i], least.get(group[i])) for i in range(len(rows))), key=str)


def clustered(rng, n, dims, spread):
    centres = rng.normal(size=(6, dims))
    return [(centres[rng.integers(6)] + spread * rng.normal(size=dims)).tolist() for _ in range(n)]


@pytest.mark.parametrize("bucket_rows", [128, 5, 2])
def test_cap_filters_equal_brute_force(spark, bucket_rows):
    rng = np.random.default_rng(4)
    vectors = clustered(rng, 120, 24, 0.12)
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate(vectors)] + [
        (200, vectors[0]), (200, vectors[0]), (None, vectors[1]), (201, None), (202, []), (203, [0.0] * 24), (204, [nan] + [1.0] * 23),
        (205, [inf] * 24), (206, [None] + [1.0] * 23), (207, [1.0, 2.0]), (208, [2.0, 4.0]), (209, (np.array(vectors[2]) * 1e-30).tolist())]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, class double")
    got = capfilters.near_duplicates(df, bucket_rows=bucket_rows).collect()
    assert sorted(map(tuple, got), key=str) == cosine_brute(rows, 0.95)
    assert capfilters.near_duplicates(df.limit(0)).count() == 0


def test_cap_filter_query_recall(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    want = cosine_brute(rows, 0.95)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in queries.op2_cap_filter_dedup(spark, sf_small).collect()), key=str)
    assert len(got) == len(want)
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want))


def test_recall_at_the_threshold():
    """Pairs of a cosine of exactly 0.95 share a direction: well over nine in ten."""
    rng = np.random.default_rng(5)
    n, dims = 51_000, 64
    words = math.ceil((capfilters.DIRECTIONS_PER_VECTOR * n) ** (1 / capfilters.BLOCKS))
    x = capfilters.unit_rows(rng.normal(size=(400, dims)))
    side = rng.normal(size=x.shape)
    side = capfilters.unit_rows(side - (side * x).sum(axis=1, keepdims=True) * x)
    y, found = 0.95 * x + math.sqrt(1 - 0.95**2) * side, set()
    for seed in range(capfilters.CODES):
        code = capfilters.ProductCode(dims, words, seed)
        least = code.fit(x)
        a, b = (set(zip(*(part.tolist() for part in code.filters(z, least)))) for z in (x, y))
        found |= {row for row, _ in a & b}
    assert len(found) >= 0.97 * len(x)


def top_brute(rows, k, asks):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v))}
    whole = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in good}
    out = []
    for i, q in whole:
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows,query_rows", [(1024, 1024), (16, 3)])
def test_top_k_equals_brute_force(spark, block_rows, query_rows):
    rng = np.random.default_rng(8)
    vectors = [(np.round(rng.normal(size=6) * 4) / 256).tolist() for _ in range(90)]  # many ties
    rows = [(i, v) for i, v in enumerate(vectors)] + [(0, vectors[0]), (100, vectors[0]), (None, vectors[1]), (105, None), (110, [float("nan")] * 6),
                                                      (115, [None] * 6), (120, []), (125, [0.5]), (130, [0.25]), (135, [0.0] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, 5, block_rows=block_rows, query_rows=query_rows).collect()
    assert sorted(map(tuple, got)) == top_brute(rows, 5, lambda i: i % 5 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    two = spark.createDataFrame(rows[:2], "vec_id long, embedding array<double>")
    assert topk.top_k(two, F.col("vec_id") == 0).count() == 1
