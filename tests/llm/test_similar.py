"""Near duplicates and nearest neighbours, against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_mt.llm import ann, neardup


def groups(rows):
    out = defaultdict(set)
    for r in rows:
        out[r.class_id].add(r.doc_id)
    return {frozenset(v) for v in out.values()}


def brute(texts, log_idf, similarity=0.8):
    """Classes of all pairs of weighted shingle sets, equal texts included."""
    sets = [(u, n * np.exp(log_idf[neardup._buckets(u)].astype(float))) for u, n in neardup.shingle_sets(texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or neardup.weighted_jaccard(sets[i], sets[j]) >= similarity:
                root[find(i)] = find(j)
    out = defaultdict(set)
    for i in range(len(texts)):
        out[find(i)].add(i)
    return {frozenset(v) for v in out.values()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=3):
    rng, texts = random.Random(seed), []
    for g in range(12):
        base = [f"w{rng.randrange(4000)}" for _ in range(200)]
        texts += [edited(rng, base, rng.choice((0, 1, 1, 2, 30))) for _ in range(6)]
    texts += [None, "", "", "...", "one two", "One, two!", "one two three", "x " * 500, "x " * 500 + "y"]
    shared = " ".join(f"s{i}" for i in range(60))
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(10)]
    return texts


def test_classes_like_brute_force(spark):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, node string, class_id int").repartition(5)
    got = neardup.classes(df).collect()
    assert len(got) == len(texts) and groups(got) == brute(texts, neardup.shingle_weights(df))
    sizes = {c: len(c) for c in groups(got)}
    assert all(r.class_id == min(c) and r.class_size == sizes[c] for r in got for c in sizes if r.doc_id in c)
    kept = neardup.keep_one(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted(min(c) for c in sizes) and kept[0].asDict().keys() == {"doc_id", "text", "node", "class_id"}


@pytest.mark.parametrize("parts", [3, 40])
def test_large_group_and_divided_buckets(spark, monkeypatch, parts):
    """Hundreds of copies of one text, of which each differs in a word, and as many equal ones."""
    monkeypatch.setattr(neardup, "LARGE", 40)
    monkeypatch.setattr(neardup, "SMALL", 3)
    monkeypatch.setattr(neardup, "CHUNK_DOCS", 30)
    monkeypatch.setattr(neardup, "PARTS", parts)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    texts = [edited(rng, base, 1) for _ in range(150)] + [" ".join(base)] * 150 + [" ".join(f"z{rng.randrange(10**6)}" for _ in range(50)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = groups(neardup.classes(df).collect())
    assert sorted(map(len, found), reverse=True)[:2] == [300, 1]


def families(rng, n, shared, own):
    """Texts of one template, every two of which are a pair that shares more than the template."""
    base, out = [f"t{i}" for i in range(shared)], []
    for _ in range(n // 2):
        tail = [f"u{rng.randrange(10**9)}" for _ in range(own)]
        out += [" ".join(base + tail + [f"v{rng.randrange(10**9)}" for _ in range(own)]) for _ in range(2)]
    return out


@pytest.mark.parametrize("large", [20, 1_500])
def test_pairs_inside_a_large_template_family(spark, monkeypatch, large):
    """The template alone is not enough (under 0.8), but the pairs in it are; one page has many near copies."""
    monkeypatch.setattr(neardup, "LARGE", large)
    monkeypatch.setattr(neardup, "CHUNK_DOCS", 20)
    monkeypatch.setattr(neardup, "PARTS", 3)
    rng = random.Random(5)
    texts = families(rng, 200, 310, 25)
    texts += [edited(rng, texts[0].split(), 1) for _ in range(150)]  # a class of several parts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = brute(texts, neardup.shingle_weights(df))
    assert sorted(map(len, want), reverse=True)[:3] == [152, 2, 2] and len(want) == 100
    assert groups(neardup.classes(df).collect()) == want


def test_null_and_repeated_keys(spark):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(None, long), (None, long), (None, "other words than those here"), (4, "four"), (4, "four"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.classes(df).collect()
    assert len(got) == 7 and {(r.class_id, r.class_size) for r in got} == {(None, 2), (None, 1), (4, 2), (5, 2)}
    kept = sorted((r.doc_id or 0, r.text or "") for r in neardup.keep_one(df).collect())
    assert kept == sorted([(0, long), (0, "other words than those here"), (4, "four"), (5, "")])
    assert neardup.classes(df.limit(0)).count() == neardup.keep_one(df.limit(0)).count() == 0


def test_samples_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    tables, log_idf = neardup.sampling_tables(), np.zeros(1 << neardup.COUNT_BITS, np.float32)
    for share in (0.5, 0.8, 0.95):
        agree, n = 0, 200
        for _ in range(n):
            a = np.sort(rng.integers(1, 1 << 63, 400, dtype=np.uint64))
            b = a.copy()
            k = round(400 * (1 - share) / (1 + share))
            b[:k] = rng.integers(1, 1 << 63, k, dtype=np.uint64)
            ones = np.ones(400, np.int64)
            s = neardup.samples_of([(a, ones), (np.sort(b), ones)], log_idf, tables)
            agree += (s[0] == s[1]).mean()
        assert agree / n == pytest.approx(share, abs=0.03)


def test_weights_count_in_samples():
    tables, log_idf = neardup.sampling_tables(), np.zeros(1 << neardup.COUNT_BITS, np.float32)
    rng, agree = np.random.default_rng(2), []
    for _ in range(300):
        u = np.sort(rng.integers(1, 1 << 63, 100, dtype=np.uint64))
        a, b = np.ones(100, np.int64), np.ones(100, np.int64)
        b[:50] = 3  # weighted Jaccard 100 / 200
        s = neardup.samples_of([(u, a), (u, b)], log_idf, tables)
        agree.append((s[0] == s[1]).mean())
    assert np.mean(agree) == pytest.approx(0.5, abs=0.03)


def test_words_hash_alike_wherever_they_stand(monkeypatch):
    line = " ".join(f"word{i % 97}" for i in range(4000)).encode()
    whole, _ = neardup._hash_words(line)
    monkeypatch.setattr(neardup, "SLICE_BYTES", 64)
    sliced, places = neardup._hash_words(line)
    assert (whole == sliced).all() and (whole[:97] == whole[97:194]).all() and len(set(whole[:97].tolist())) == 97
    assert [line[p : p + 4] for p in places[:3]] == [b"word"] * 3


def test_proposals_hold_alike_rows_together():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, neardup.SAMPLES, dtype=np.uint8)
    rows = np.tile(base, (60, 1))
    rows[np.arange(60), rng.integers(0, neardup.SAMPLES, 60)] ^= 1
    other = rng.integers(0, 256, (5, neardup.SAMPLES), dtype=np.uint8)
    pairs = neardup.propose(np.concatenate([rows, other]))
    assert len(pairs) == 59 and pairs.max() < 60 and len(set(pairs.ravel().tolist())) == 60


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(100, 101), (101, 100)], "a long, b long"))
    assert {(r.node, r.root) for r in neardup.components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}
    assert neardup.components(edges.limit(0)).count() == 0


# --- vectors -------------------------------------------------------------------------------


def nearest(ids, vectors, query, top):
    scores = [(-float((vectors[query] * v).sum()), i) for i, v in zip(ids, vectors, strict=True) if i != ids[query]]
    return [(i, -s) for s, i in sorted(scores)[:top]]


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    vectors[50:150] = vectors[50]  # a third are equal
    rows = [(i, [float(x) for x in v], i) for i, v in enumerate(vectors)]
    rows += [(400, None, 0), (420, [0.0] * 8, 0), (440, [1.0, None] * 4, 0), (460, [float("nan")] * 8, 0), (480, [float("inf")] * 8, 0), (500, [1.0], 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(4)
    got = defaultdict(list)
    for r in ann.search(df, df.filter("vec_id % 20 = 0"), top=20).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        want = nearest(list(range(300)), vectors, q, 20)
        assert [(k + 1, i) for k, (i, _) in enumerate(want)] == [f[:2] for f in sorted(found)]
        assert [s for *_, s in sorted(found)] == pytest.approx([s for _, s in want], abs=1e-12)


def test_fewer_vectors_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (20, [1.0, 1.0])], "vec_id long, embedding array<double>")
    rows = ann.search(df, df.filter("vec_id % 20 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rows) == [(0, 1, 20), (0, 2, 1), (20, 1, 0), (20, 2, 1)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0
    one = df.filter("vec_id = 0")
    assert ann.search(one, one).count() == 0


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 150)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = df.orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    index = ann.build_index(ann.usable(df), list_rows=100)
    assert len(index.centroids) >= 20
    found, _ = ann.walk(index, ann.lift(vectors, index.longest), 1)
    exact = ann._distances(ann.lift(vectors, index.longest), index.centroids).argmin(1)
    assert (found[:, 0] == exact).mean() > 0.95
    sizes = np.bincount(exact, minlength=len(index.centroids))
    assert sizes.max() < 4 * sizes.mean()
    got = defaultdict(set)
    for r in ann.search(df, df.filter("vec_id % 20 = 0")).collect():
        got[r.query_id].add(r.vec_id)
    hits = sum(len(got[ids[q]] & {i for i, _ in nearest(ids, vectors, q, 20)}) for q in range(len(ids)) if ids[q] % 20 == 0)
    assert hits >= 0.9 * 20 * sum(i % 20 == 0 for i in ids)


def test_recall_holds_where_lists_are_many(spark):
    """Vectors without any clusters, in far more lists than a fixed number of visits covers."""
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(12_000, 64)).astype(np.float32)
    vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    asked = [i for i in range(len(vectors)) if i % 20 == 0]
    got = defaultdict(set)
    for r in ann.search(df, df.filter("vec_id % 20 = 0"), list_rows=30).collect():
        got[r.query_id].add(r.vec_id)
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    hits = sum(len(got[q] & set(np.argpartition(-row, 20)[:20].tolist())) for q, row in zip(asked, scores, strict=True))
    print("recall", hits / (20 * len(asked)))
    assert hits >= 0.9 * 20 * len(asked)


def test_longest_inner_product_wins_over_the_nearest_direction(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [9.0, 9.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in ann.search(df, df.filter("vec_id = 0"), top=1).collect()] == [2]


def test_queries_walk_to_the_lists_of_all_within_the_ratio(monkeypatch):
    """Clustered centroids: the walk finds the lists that comparing with every centroid finds, and compares with fewer."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(40, 16))
    centroids = (middles[rng.integers(0, 40, 3_000)] + 0.3 * rng.normal(size=(3_000, 16))).astype(np.float32)
    index = ann.Index(centroids, *ann.centroid_graph(centroids), 1.0)
    points = (middles[rng.integers(0, 40, 300)] + 0.3 * rng.normal(size=(300, 16))).astype(np.float32)
    far = np.sqrt(ann._distances(points, centroids))
    nearest = far.min(1, keepdims=True)
    for ratio in (1.0, 1.4):
        limit = np.maximum(np.minimum(np.sort(far, 1)[:, ann.PROBES - 1 : ann.PROBES], ann.PRUNE * nearest), ratio * nearest)
        wanted = set(zip(*np.nonzero(far <= limit), strict=True))
        row, lists = ann.lists_to_visit(index, points, ratio)
        got = list(zip(row, lists, strict=True))
        assert len(got) == len(set(got))
        assert len(wanted & set(got)) >= 0.97 * len(wanted)
    opened = []
    graph = index.graph

    class Counted:
        def __getitem__(self, nodes):
            opened.append(np.size(nodes))
            return graph[nodes]

    ann.lists_to_visit(index._replace(graph=Counted()), points, 1.0)
    looked = len(index.starts) + sum(opened) * graph.shape[1] / len(points)
    print("compared with", looked, "of", len(centroids))
    assert looked < 0.6 * len(centroids)


def test_visits_of_few_lists():
    for n in (1, 2, 5):
        centroids = np.arange(n, dtype=np.float32)[:, None]
        index = ann.Index(centroids, *ann.centroid_graph(centroids), 1.0)
        row, lists = ann.lists_to_visit(index, np.array([[0.1], [n + 1.0]], np.float32), 1e6)
        assert sorted(zip(row.tolist(), lists.tolist(), strict=True)) == [(q, c) for q in range(2) for c in range(n)]
    row, lists = ann.lists_to_visit(index, np.zeros((0, 1), np.float32), 1.0)
    assert len(row) == len(lists) == 0
