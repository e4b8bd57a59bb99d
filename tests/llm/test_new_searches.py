"""SimHash links, hard negatives and ranked search, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from corpus_mt.llm import components, hard_negatives, ranked_search, simhash

LOWER = {c: c + 32 for c in range(65, 91)}


# --- fingerprints and their links -----------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def documents(seed=5, n=160):
    rng, out = random.Random(seed), []
    for _ in range(n // 8):
        base = [f"W{rng.randrange(3000)}" for _ in range(rng.randrange(5, 300))]
        for _ in range(8):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 6))):
                words[rng.randrange(len(words))] = f"é{rng.randrange(10**6)}"
            out.append(rng.choice((" ", "\n", "\t  ")).join(words))
    return out + [None, "", " \n", "one", "One", "one two three", "a b c d", "  x", "A B C D", "w " * 300_000, "z" * 3_000_000 + " tail of text"]


def test_fingerprints_and_components_like_brute_force(spark):
    texts = documents()
    rows = [(i, t, "x", 3) for i, t in enumerate(texts)] + [(7, texts[7], "again", 4), (None, texts[0], "y", 5), (None, "all alone here now", "y", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, place int").repartition(5)
    got = [tuple(r) for r in simhash.classes(df).collect()]
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for t in texts]
    roots = plain_components(fps)
    want = [(i, f"{fp:016x}", root) for i, (fp, root) in enumerate(zip(fps, roots, strict=True))]
    want += [want[7], (None, f"{fps[0]:016x}", roots[0]), (None, f"{plain_fingerprint('all alone here now'):016x}", None)]
    assert Counter(got) == Counter(want)
    assert simhash.classes(df.limit(0)).collect() == []


@pytest.mark.parametrize("small", [False, True])
def test_links_of_hot_values(spark, monkeypatch, small):
    """A dense ball, chains, values that half of all fingerprints share; blocks and joins give the same."""
    if small:
        monkeypatch.setattr(simhash, "FEW", 2)
        monkeypatch.setattr(simhash, "FEW_PROBES", 5)
        monkeypatch.setattr(simhash, "BLOCK", 37)
    rng = np.random.default_rng(2)
    fps = {0, (1 << 64) - 1}
    for centre, n in ((0x0123456789ABCDEF, 300), (0xFFFF000000000000, 100)):
        fps |= {centre ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 7)))) for _ in range(n)}
    fps |= {(0xABCD << 48) | int(x) for x in rng.integers(0, 1 << 48, 150)}  # one value of a partition, far apart
    chain = 0x5555555555555555
    for k in range(0, 60, 3):
        chain ^= 0b111 << k
        fps.add(chain)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(4).cache()
    pairs = simhash.bit_pairs(nodes)
    order, n = simhash.correlated_order(pairs), int(pairs[-1])
    assert n == len(fps) and sorted(order) == list(range(64))
    shares = simhash.distance_shares(simhash.octet_counts(nodes, order))
    want = plain_components(fps)
    for layout in simhash.LAYOUTS:
        placed = simhash.places(nodes, order, shares, n, layout).cache()
        found = {r.node: r.root for r in components.components(simhash.links(placed), thin=small).collect()}
        groups = defaultdict(set)
        for f in fps:
            key = int(np.uint64(f).astype(np.int64))
            groups[found.get(key, key)].add(f)
        plain = defaultdict(set)
        for f, r in zip(fps, want, strict=True):
            plain[r].add(f)
        assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in plain.values()}


def test_thresholds_are_the_cheapest():
    """The dynamic program against all allocations."""
    rng = np.random.default_rng(4)
    values = rng.integers(0, 256, (20, 8)).astype(np.uint8)
    counts = rng.integers(0, 50, (8, 256))
    counts = counts * 1000 // counts.sum(1, keepdims=True)
    shares = simhash.distance_shares(counts)
    layout = (3, 3, 2)
    got, cost = simhash.allocate(values, layout, shares, 10_000)
    assert (got.sum(1) == 5).all()

    def price(row, k, u):
        if not u:
            return 0.0
        near = np.array([1.0, 0, 0, 0, 0])
        for octet in range(sum(layout[:k]), sum(layout[: k + 1])):
            near = np.convolve(near, shares[octet][row[octet]])[:5]
        probes = sum(math.comb(8 * layout[k], d) for d in range(u))
        return 10_000 * near[:u].sum() + simhash.PROBE_COST * probes

    for row, c in zip(values, cost, strict=True):
        every = [sum(price(row, k, u) for k, u in enumerate((a, b, 5 - a - b))) for a in range(6) for b in range(6 - a)]
        assert math.isclose(c, min(every), rel_tol=1e-9)


def test_components_with_hubs(spark):
    star = [(0 if i % 2 else i, i) for i in range(1, 400)] + [(1000, i) for i in range(600, 1000)] + [(5000, 5000), (None, 3)]
    path = [(2000 + i, 2001 + i) for i in range(60)]
    edges = spark.createDataFrame([(b, a) for a, b in star + path + path[:7]], "a long, b long")
    found = {r.node: r.root for r in components.components(edges).collect()}
    want = {i: 0 for i in range(0, 400) if i % 2} | {0: 0} | {i: 600 for i in range(600, 1001)} | {i: 2000 for i in range(2000, 2061)}
    assert found == want
    assert components.components(edges.limit(0)).collect() == []


# --- hard negatives ----------------------------------------------------------------------------------


def plain_negatives(rows, every):
    rows = list(dict.fromkeys((i, y, tuple(v)) for i, y, v in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)))
    whole = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows]
    out = []
    for i, y, v in whole:
        if i % every:
            continue
        scored = sorted(((sum(a * b for a, b in zip(v, w)), k, z) for k, z, w in whole if k != i), key=lambda s: (-s[0], s[1]))
        for p, k, _ in [s for s in scored if s[2] == y][:5]:
            for rank, (n, m, _) in enumerate([s for s in scored if s[2] != y and 50 * p <= 100 * s[0] <= 95 * p][:3], 1):
                out.append((i, k, rank, m, p, n))
    return out


def test_hard_negatives_like_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(6, 20))
    rows = []
    for i in range(400):
        v = base[rng.integers(6)] + 0.4 * rng.normal(size=20)
        rows.append((int(i) - 100, int(rng.integers(3)) if i % 3 else 0, [float(np.float32(x)) for x in v]))
    rows += [(900 + i, 1, rows[3][2]) for i in range(6)] + [(950 + i, 2, rows[3][2]) for i in range(6)]  # ties
    rows += [(2000, None, rows[0][2]), (None, 1, rows[0][2]), (2010, 1, None), (2020, 1, [float("nan")] * 20), (2030, 1, [None] + rows[0][2][1:])]
    rows += [(2040, 0, []), (2050, 0, [0.0] * 20), (2060, 1, [50.0] * 3), (2070, 2, [-4000.25] * 30), rows[0], rows[1]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, no string, score int").repartition(3)
    want = sorted(plain_negatives(rows, 10))
    got = sorted(tuple(r) for r in hard_negatives.mine(df, 10).collect())
    assert got == want and len(want) > 100
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "STORED_ROWS", 64)
    assert sorted(tuple(r) for r in hard_negatives.mine(df, 10).collect()) == want
    assert hard_negatives.mine(df.limit(0), 10).collect() == []
    assert hard_negatives.mine(df.filter("vec_id % 10 <> 0"), 10).collect() == []


def test_hard_negatives_of_huge_components(spark):
    """Numbers beyond 64 bits do not crash, and small ones beside them stay right."""
    rows = [(0, 0, [1.0, 0.5]), (1, 0, [2.0, 1.0]), (2, 1, [1.0, 1.0]), (3, 1, [3e38, -3e38])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = [tuple(r) for r in hard_negatives.mine(df, 10).collect()]
    assert (0, 1, 1, 2, 256 * 512 + 128 * 256, 256 * 256 + 128 * 256) in got


@pytest.mark.parametrize("size", [5, 400, 2**40])
def test_lookups_are_inner_products(size):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-size, size, (30, 24)), rng.integers(-size, size, (50, 24))
    planes = int(size).bit_length() + 1
    body = hard_negatives.bit_planes(b, planes)
    assert (hard_negatives.scores(hard_negatives.subset_sums(a, planes), body) == b @ a.T).all()


# --- ranked search ---------------------------------------------------------------------------------------

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_ranking(docs, items, top):
    counts = [(i, Counter(TERMS.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    terms, out = defaultdict(set), []
    for i, t in items:
        terms[i] |= set(TERMS.findall((t or "").translate(LOWER)))
    for i, wanted in terms.items():
        scored = []
        for d, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t])
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return out


def searchable(seed=8):
    rng = random.Random(seed)
    word = lambda: "Té" + str(int(rng.expovariate(0.05)))
    docs = [(i * 3 % 1009, " ".join(word() for _ in range(rng.randrange(0, 80)))) for i in range(700)]
    docs += [(5000 + i, docs[4][1]) for i in range(90)] + [docs[4], docs[4], (None, docs[4][1]), (None, "Té0"), (6000, None), (6001, ""), (6002, "-- ,,"), (6003, "té1 " * 400_000)]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 30)))) for i in range(12)]
    items += [(50, docs[4][1]), (51, None), (52, ""), (53, "nowhere"), (0, "té3, TÉ3 té4_té5"), (None, "té1 té2"), (54, "té0 " * 50_000)]
    return docs, items


def test_ranked_search_like_brute_force(spark, monkeypatch):
    docs, items = searchable()
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, id string, n int").repartition(6)
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, term string")
    order = lambda rows: sorted(rows, key=str)
    want = order(plain_ranking(docs, items, 50))
    assert order(tuple(r) for r in ranked_search.search(d, q).collect()) == want
    monkeypatch.setattr(ranked_search, "CHUNK_POSTINGS", 300)
    monkeypatch.setattr(ranked_search, "CHUNK_DOCS", 20)
    monkeypatch.setattr(ranked_search, "OPENED", 3)
    monkeypatch.setattr(ranked_search, "ITEM_TERMS", 60)
    assert order(tuple(r) for r in ranked_search.search(d, q).collect()) == want
    assert order(tuple(r) for r in ranked_search.search(d, q, 3).collect()) == order(plain_ranking(docs, items, 3))
    assert ranked_search.search(d.limit(0), q).collect() == [] == ranked_search.search(d, q.limit(0)).collect()
    assert ranked_search.search(d, q).columns == ["item_id", "rank", "doc_id", "score"]


def test_range_maxima_bound_every_interval():
    rng = np.random.default_rng(3)
    docs = 200
    sizes = rng.integers(1, 10, docs)
    terms = np.concatenate([rng.choice(12, s, replace=False) for s in sizes])
    tfs = rng.integers(1, 9, len(terms))
    lengths = rng.integers(10, 100, docs)
    chunk = ranked_search.Chunk(np.arange(docs), lengths, sizes.astype(np.int64), terms, tfs, 12, (docs, int(lengths.sum())))
    impact = ranked_search.IMPACT_UNIT * tfs // (1000 * tfs + 20 * np.repeat(50 + 50 * lengths * docs // lengths.sum(), sizes))
    doc = np.repeat(np.arange(docs), sizes)
    asked, weights = np.array([1, 4, 7]), np.array([900, 1500, 40])
    for low, high in rng.integers(0, docs, (50, 2)):
        if low < high:
            l, h = (np.searchsorted(chunk.keys, asked * docs + x)[None] for x in (low, high))
            inside = [impact[(terms == t) & (doc >= low) & (doc < high)] for t in asked]
            assert chunk.bounds(l, h, weights)[0][0] == sum(w * x.max(initial=0) for w, x in zip(weights, inside))
