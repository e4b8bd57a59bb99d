"""Near-duplicate documents: consistent weighted sampling over TF-IDF word shingles.

A document is a weighted set of five-word shingles.  Improved consistent weighted sampling picks
one shingle per hash so that two documents agree on it with the probability of their
weighted Jaccard similarity.  Bands of such samples put likely pairs into buckets, the samples
themselves sort out most others, and the weighted Jaccard similarity of the whole texts decides.

Equal texts are one node throughout.  A bucket is never opened into all its pairs: a spanning
forest of those that the samples do not rule out holds it together.  The components of these forests
are what is verified, in tasks that each hold a few hundred documents.  Very large buckets are divided by further
samples first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_mt.llm.common import mix64, small_batches, text_slices, worker_state
from corpus_mt.llm.components import components
from corpus_mt.operators.skew import spread_join
from corpus_mt.session import stage_table

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 12, 4
SAMPLES = BANDS * BAND_ROWS
# Buckets of the document counts, and how much more a shingle of one document weighs than one
# of all documents.  The spread is small on purpose: with plain IDF the many copies in a large group
# would make what they share weigh next to nothing against their few differences.
COUNT_BITS, IDF_SPREAD = 18, 0.25
# Share of equal samples below which a pair is ruled out.
PROPOSE = 0.65
# Buckets up to SMALL are opened where they are; from LARGE on they are divided.
SMALL, LARGE = 6, 1_500
# Documents of one part of a component, about, and parts above which proposed pairs are verified first.
CHUNK_DOCS, PARTS = 200, 40
SLICE_BYTES = 1 << 20
# Rows of one Arrow batch of whole texts.
BATCH_ROWS = 500
_TABLE_BITS = 16

# A-Z are lower-cased before; ASCII characters that are no letters or digits part words.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


# --- shingles --------------------------------------------------------------------------------


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, for a slice."""

    def make() -> tuple[np.ndarray, np.ndarray]:
        base = 0x9E3779B97F4A7C15
        n, out = 2 * SLICE_BYTES, []
        for x in (base, pow(base, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            step = x
            while len(p) < n:
                p = np.concatenate([p, p * np.uint64(step)])
                step = step * step % (1 << 64)
            out.append(p)
        return out[0], out[1]

    return worker_state("powers", make)


def _hash_words(line: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every word of a folded line, worked through in slices."""
    hashes, places, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    forward, backward = _powers()
    while at < len(line):
        stop = len(line)
        if stop - at > SLICE_BYTES:
            stop = line.rfind(b" ", at, at + SLICE_BYTES) + 1
            if stop <= at:  # a word longer than a slice
                stop = line.find(b" ", at + SLICE_BYTES)
                stop = len(line) if stop < 0 else stop
        codes = np.frombuffer(line, np.uint8, stop - at, at)
        inside = np.concatenate([[False], codes != 32, [False]])
        starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        if len(codes) > len(forward):
            h = np.array([hash_long(line[at + a : at + b]) for a, b in zip(starts, ends, strict=True)], np.uint64)
        else:
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * forward[: len(codes)], dtype=np.uint64)])
            h = mix64((sums[ends] - sums[starts]) * backward[starts])
        hashes.append(h)
        places.append(starts + at)
        at = stop
    return np.concatenate(hashes), np.concatenate(places)


def hash_long(word: bytes) -> int:
    """Hash of a word too long for the tables of powers."""
    import hashlib

    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


_STEPS = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes of each text, and how often each occurs.

    A text of fewer words is one shingle; one without words has none.
    """
    lines = [(t or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD) for t in texts]
    hashes, places = _hash_words(b" ".join(lines))
    ends = np.cumsum([len(x) + 1 for x in lines])
    bounds = np.concatenate([[0], np.searchsorted(places, ends)])
    n = len(hashes) - SHINGLE + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        rolled += hashes[k : k + n] * _STEPS[k]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1], return_counts=True))
        elif b > a:
            short = (hashes[a:b] * _STEPS[: b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append((mix64(short + np.uint64(b - a)), np.ones(1, np.int64)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    return out


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    for a, b in text_slices(texts.fill_null(""), SLICE_BYTES):
        yield a, texts.slice(a, b - a).to_pylist()


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def shingle_weights(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log of the IDF weight by bucket of shingles, from all documents.

    A bucket counts the (document, shingle) pairs that fall into it; its table is as long at any
    size of the corpus, and every document sees the same weights.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << COUNT_BITS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, texts in _slices(batch.column(0)):
                found = np.concatenate([u for u, _ in shingle_sets(texts)])
                total += np.bincount(_buckets(found), minlength=len(total))
        at = np.flatnonzero(total)
        bucket = np.concatenate([at, [-1]]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.concatenate([total[at], [n]]))], ["bucket", "n"])

    counts = docs.select(text).mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    with small_batches(docs.sparkSession, BATCH_ROWS):
        counted = counts.toPandas()
    seen = np.zeros(1 << COUNT_BITS)
    rows = counted["bucket"].to_numpy() >= 0
    seen[counted["bucket"].to_numpy()[rows]] = counted["n"].to_numpy()[rows]
    total = max(float(counted["n"].to_numpy()[~rows].sum()), 1.0)
    idf = np.log((total + 1.0) / (np.minimum(seen, total) + 1.0)) / np.log(total + 1.0)
    return np.log1p(IDF_SPREAD * idf).astype(np.float32)


# --- samples -----------------------------------------------------------------------------------


def sampling_tables(seed: int = 11) -> tuple[np.ndarray, ...]:
    """Random numbers that a shingle's hashes point into: r, 1 / r, beta, r (beta - 1), ln c."""
    random, n = np.random.default_rng(seed), 1 << _TABLE_BITS
    r, c, beta = random.gamma(2.0, 1.0, n), random.gamma(2.0, 1.0, n), random.random(n)
    r = np.maximum(r, 1e-3)
    multipliers = random.integers(1 << 63, (1 << 64) - 1, (SAMPLES, 2), dtype=np.uint64) | np.uint64(1)
    return tuple(x.astype(np.float32) for x in (r, 1.0 / r, beta, r * (beta - 1.0), np.log(c))) + (multipliers,)


def samples_of(sets: list[tuple[np.ndarray, np.ndarray]], log_idf: np.ndarray, tables: tuple[np.ndarray, ...]) -> np.ndarray:
    """A row of ``SAMPLES`` 64-bit samples for each set; all sets have a shingle.

    Per shingle of weight S: t = floor(ln S / r + beta), ln a = ln c - r (t - beta) - r; the
    shingle with the least a is the sample, together with t, of which a is a function.
    """
    r, inverse, beta, back, log_c, multipliers = tables
    shingles = np.concatenate([u for u, _ in sets])
    log_s = np.log(np.concatenate([n for _, n in sets]).astype(np.float32)) + log_idf[_buckets(shingles)]
    starts = np.concatenate([[0], np.cumsum([len(u) for u, _ in sets])])[:-1]
    low = shingles & np.uint64(0xFFFFFFFF)
    out = np.empty((len(sets), SAMPLES), np.uint64)
    mask = (1 << _TABLE_BITS) - 1
    for k in range(SAMPLES):
        mixed = ((shingles * multipliers[k, 0] + multipliers[k, 1]) >> np.uint64(64 - 2 * _TABLE_BITS)).astype(np.int64)
        i, j = mixed >> _TABLE_BITS, mixed & mask
        t = np.floor(log_s * inverse[i] + beta[i])
        log_a = log_c[j] + back[i] - r[i] * t
        # Positive floats order like their bits; the shingle breaks ties alike everywhere.
        key = ((log_a + np.float32(256.0)).view(np.uint32).astype(np.uint64) << np.uint64(32)) | low
        out[:, k] = np.minimum.reduceat(key, starts)
    return mix64(out)


def band_keys(samples: np.ndarray) -> np.ndarray:
    key = np.zeros((len(samples), BANDS), np.uint64)
    for k in range(BAND_ROWS):
        key = mix64(key + samples[:, k::BAND_ROWS] + np.uint64(k + 1))
    return (key + mix64(np.arange(BANDS, dtype=np.uint64))).view(np.int64)


def node_of(text: Column) -> Column:
    """128 bits that stand for a whole text; null is empty."""
    return F.unhex(F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8")))


def sketch(docs: DataFrame, log_idf: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, node, keys, bytes`` for every row: band keys, and a byte of each sample."""
    shared = docs.sparkSession.sparkContext.broadcast((log_idf, sampling_tables()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tables = shared.value
        for batch in batches:
            keys: list[list[int] | None] = [None] * batch.num_rows
            short: list[bytes | None] = [None] * batch.num_rows
            for at, texts in _slices(batch.column(2)):
                sets = shingle_sets(texts)
                rows = [i for i, (u, _) in enumerate(sets) if len(u)]
                if rows:
                    samples = samples_of([sets[i] for i in rows], known, tables)
                    for i, k, s in zip(rows, band_keys(samples).tolist(), samples.astype(np.uint8), strict=True):
                        keys[at + i], short[at + i] = k, s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array(short, pa.binary())], ["key", "node", "keys", "bytes"]
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), node_of(F.col(text)).alias("node"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, node binary, keys array<bigint>, bytes binary")


# --- candidate pairs ------------------------------------------------------------------------


def _equal_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, None] == b[None]).sum(2, dtype=np.int16)


def propose(samples: np.ndarray) -> np.ndarray:
    """Pairs of rows that hold a bucket's similar rows together.

    A forest of the graph in which pairs from ``PROPOSE`` on are joined: every row is tied to the
    likeliest earlier row of each tree that it is joined to, so pairs are fewer than rows.
    """
    n, least = len(samples), PROPOSE * SAMPLES
    tree = np.arange(n)
    pairs: list[tuple[int, int]] = []
    for at in range(0, n, 128):
        equal = _equal_counts(samples[at : at + 128], samples)
        for k in range(len(equal)):
            i = at + k
            near = np.flatnonzero(equal[k, :i] >= least)
            near = near[np.argsort(-equal[k, near], kind="stable")]
            trees, first = np.unique(tree[near], return_index=True)
            for t, j in zip(trees, near[first], strict=True):
                pairs.append((int(j), i))
                tree[tree == tree[i]] = t
    return np.array(pairs, np.int64).reshape(-1, 2)


def _propose_frame(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("node")
    samples = np.frombuffer(b"".join(frame["bytes"]), np.uint8).reshape(len(frame), SAMPLES)
    nodes, pairs = frame["node"].to_numpy(), propose(samples)
    return pd.DataFrame({"a": nodes[pairs[:, 0]], "b": nodes[pairs[:, 1]]})


def _bucket_sizes(filed: DataFrame, by: str) -> DataFrame:
    return filed.groupBy(by).agg(F.count("*").alias("size"), F.min("node").alias("pivot")).filter("size > 1")


def candidates(nodes: DataFrame) -> DataFrame:
    """Distinct pairs ``a < b`` of nodes to verify, from staged ``node, keys, bytes``."""
    filed = nodes.select("node", F.explode("keys").alias("bucket"))
    sized = stage_table(filed.join(_bucket_sizes(filed, "bucket"), "bucket"), "buckets")
    # A pair in a bucket of its own, or few: all of them.
    few = sized.filter(F.col("size") <= SMALL).groupBy("bucket").agg(F.array_sort(F.collect_list("node")).alias("m"))
    later = lambda x, i: F.transform(F.slice("m", i + 2, F.greatest(F.size("m") - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))
    pairs = few.select(F.explode(F.flatten(F.transform("m", later))).alias("p")).select("p.a", "p.b")
    some = sized.filter((F.col("size") > SMALL) & (F.col("size") <= LARGE)).select("bucket", "node")
    many = sized.filter(F.col("size") > LARGE)
    # Three more samples, in every group of three, part a large bucket again.
    threes = [F.xxhash64("bucket", F.lit(i), F.substring("bytes", 3 * i + 1, 3)) for i in range(SAMPLES // 3)]
    parted = many.select("bucket", "node").join(nodes.select("node", "bytes"), "node").select("node", F.explode(F.array(*threes)).alias("bucket"))
    sizes = _bucket_sizes(parted, "bucket")
    parted = stage_table(parted.join(sizes, "bucket"), "parted")
    some = some.unionByName(parted.filter(F.col("size") <= LARGE).select("bucket", "node"))
    proposed = some.join(nodes.select("node", "bytes"), "node").groupBy("bucket").applyInPandas(_propose_frame, "a bigint, b bigint")
    # What is as large even then is alike in seven samples: a star holds it together.
    huge = many.unionByName(parted.filter(F.col("size") > LARGE).select("bucket", "node", "size", "pivot"), allowMissingColumns=True)
    stars = huge.filter(F.col("node") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    return pairs.unionByName(proposed).unionByName(stars).distinct()


# --- verification ------------------------------------------------------------------------------


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two weighted sets, each with sorted members."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    shared = np.minimum(a[1][same], b[1][at[same]]).sum()
    total = a[1].sum() + b[1].sum() - shared
    return float(shared / total) if total else 0.0


def _verifier(shared, similarity: float):
    def run(docs: pd.DataFrame) -> pd.DataFrame:
        log_idf = shared.value
        docs = docs.drop_duplicates("node").sort_values("node")
        samples = np.frombuffer(b"".join(docs["bytes"]), np.uint8).reshape(len(docs), SAMPLES)
        nodes, part, texts, sets = docs["node"].to_list(), docs["part"].to_numpy(), docs["text"].to_list(), {}

        def weighted(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in sets:
                u, n = shingle_sets([texts[i]])[0]
                sets[i] = (u, n * np.exp(log_idf[_buckets(u)].astype(np.float64)))
            return sets[i]

        equal = np.concatenate([_equal_counts(samples[at : at + 128], samples) for at in range(0, len(docs), 128)])
        a, b = np.nonzero(np.triu(equal >= PROPOSE * SAMPLES, 1))
        if len(np.unique(part)) > 1:  # pairs within one part meet in a chunk of their own
            a, b = a[part[a] != part[b]], b[part[a] != part[b]]
        # What an earlier pass has linked begins in one tree.
        first: dict[int, int] = {}
        root = [i if c < 0 else first.setdefault(c, i) for i, c in enumerate(docs["linked"].to_list())]

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for k in np.argsort(-equal[a, b], kind="stable"):
            x, y = find(a[k]), find(b[k])
            if x != y and weighted_jaccard(weighted(a[k]), weighted(b[k])) >= similarity:
                root[max(x, y)] = min(x, y)
        linked = [(nodes[find(i)], nodes[i]) for i in range(len(nodes)) if find(i) != i]
        return pd.DataFrame(linked, columns=["a", "b"])

    return run


def _parts_that_meet(large: DataFrame, links: DataFrame) -> DataFrame:
    """``chunk, node, part, linked`` of every two parts of a component but those of one linked class.

    ``large`` has ``node, root``.  A class that fills a part has parts of its own, which need not
    meet each other; all other documents are dealt over parts of the rest.
    """
    linked = large.join(components(links).withColumnRenamed("root", "linked"), "node", "left")
    linked = stage_table(linked.withColumn("linked", F.coalesce("linked", "node")), "linked")
    sizes = linked.groupBy("linked").agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK_DOCS)
    full = spread_join(linked, sizes.withColumn("own", F.col("linked")), "linked")
    rest = full.filter("own IS NULL").groupBy("root").agg(F.count("*").alias("rest"))
    full = spread_join(full, rest, "root")
    parts = F.ceil(F.coalesce("n", "rest") / CHUNK_DOCS)
    dealt = full.select("node", "root", "linked", "own", F.xxhash64("root", "own", F.pmod(F.xxhash64("node"), parts)).alias("part"))
    dealt = stage_table(dealt, "dealt")
    each = dealt.groupBy("root", "part").agg(F.first("own").alias("own"))
    both = [each.select("root", F.col("part").alias(f"part_{c}"), F.col("own").alias(f"own_{c}")) for c in "ab"]
    one_class = F.coalesce(F.col("own_a") == F.col("own_b"), F.lit(False))
    meet = both[0].join(both[1], "root").filter(~one_class).select(F.col("part_a").alias("part"), F.xxhash64("root", F.least("part_a", "part_b"), F.greatest("part_a", "part_b")).alias("chunk"))
    return dealt.select("node", "part", "linked").join(meet, "part")


def verified_links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, log_idf: np.ndarray, text: str, key: str, similarity: float) -> DataFrame:
    """Links that hold every verified class together.

    The proposed pairs only say which documents may belong together.  All pairs of such a
    component that the samples do not rule out are verified where their documents meet, most similar
    first, but for those whose documents are linked by then; none is written out.  A component is cut into
    parts and every two parts meet in one task.  In a component of over ``PARTS`` parts those documents
    meet first that are proposed to each other, and then every two parts but those of one class linked so far.
    """
    placed = components(pairs)
    parts = placed.groupBy("root").agg(F.ceil(F.count("*") / CHUNK_DOCS).alias("parts"))
    placed = placed.join(parts, "root").select("node", "root", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"))
    placed = stage_table(placed, "placed")
    chunk = lambda x, y: F.xxhash64("root", F.least(x, y), F.greatest(x, y)).alias("chunk")
    shared = docs.sparkSession.sparkContext.broadcast(log_idf)

    def verify(needed: DataFrame) -> DataFrame:
        needed = stage_table(needed.join(nodes.select("node", "hash", F.col("least").alias("rep"), "bytes"), "node"), "needed")
        bodies = docs.select(F.col(key).alias("rep"), node_of(F.col(text)).alias("hash"), F.col(text).alias("text"))
        keyed = (bodies["hash"] == needed["hash"]) & bodies["rep"].eqNullSafe(needed["rep"])
        bodies = bodies.join(needed, keyed).select("chunk", "node", "part", "linked", "text", "bytes")
        return bodies.groupBy("chunk").applyInPandas(_verifier(shared, similarity), "a bigint, b bigint")

    none = F.lit(-1).cast("bigint").alias("linked")
    usual = placed.filter(F.col("parts") <= PARTS).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    needed = usual.select("node", "part", chunk("part", "other"))
    large = placed.filter(F.col("parts") > PARTS)
    if large.isEmpty():
        return verify(needed.select("*", none))
    ends = [large.select(F.col("node").alias(c), "root", F.col("part").alias(f"part_{c}")) for c in "ab"]
    met = pairs.join(ends[0], "a").join(ends[1].drop("root"), "b").withColumn("chunk", chunk("part_a", "part_b"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("part_a").alias("part")), F.struct(F.col("b").alias("node"), F.col("part_b").alias("part"))))
    needed = needed.unionByName(met.select("chunk", sides.alias("s")).select("s.node", "s.part", "chunk").distinct())
    links = stage_table(verify(needed.select("*", none)), "links")
    return links.unionByName(verify(_parts_that_meet(large.select("node", "root"), links)))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """``key, class_id, class_size, node`` for every row; the class id is the least key of the class.

    Equal texts are of one class.  Texts without words, null ones among them, are near nothing
    but their equals; texts of fewer than five words are near those with the same words in
    order.  Null keys stay (the class id is null only if all keys of a class are), repeated rows
    each count.  Other columns play no part.  An empty table gives no rows.  Texts are
    compared whole.
    """
    log_idf = shingle_weights(docs, text)
    with small_batches(docs.sparkSession, BATCH_ROWS):
        sketched = stage_table(sketch(docs, log_idf, text, key), "sketched")
    # Texts are numbered once; all that follows moves and compares their numbers.
    nodes = sketched.withColumnRenamed("node", "hash").groupBy("hash").agg(F.first("keys").alias("keys"), F.first("bytes").alias("bytes"), F.min("key").alias("least"), F.count("*").alias("n"))
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    pairs = stage_table(candidates(nodes.select("node", "keys", "bytes")), "pairs")
    links = stage_table(verified_links(docs, nodes, pairs, log_idf, text, key, similarity), "links")
    joined = nodes.select("node", "hash", "least", "n").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    joined = stage_table(joined, "classes")
    totals = joined.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"), F.count("*").alias("_nodes"))
    named = spread_join(joined.select("hash", "root"), totals.drop("_nodes"), "root", totals.select("root", F.col("_nodes").alias("n")))
    named = named.select(F.col("hash").alias("node"), "class_id", "class_size")
    out = spread_join(sketched.select("key", "node"), named, "node", nodes.select(F.col("hash").alias("node"), "n"))
    return out.select(F.col("key").alias(key), "class_id", "class_size", "node")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, that with the least key, with the columns of ``docs``."""
    found = classes(docs, text, key, similarity)
    kept = found.groupBy("class_id").agg(F.min(F.struct(F.col(key).isNull().alias("_none"), F.col(key).alias("_key"), "node")).alias("_k"))
    # A class without any key is known by its text alone.
    lone = found.filter(F.col("class_id").isNull()).select(F.lit(None).cast(docs.schema[key].dataType).alias("_key"), "node").distinct()
    kept = kept.filter("class_id IS NOT NULL").select("_k._key", "_k.node").unionByName(lone)
    boxed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_key"), node_of(F.col(text)).alias("node"))
    chosen = boxed.join(kept.withColumnsRenamed({"_key": "_kept", "node": "_node"}), F.col("node").eqNullSafe(F.col("_node")) & F.col("_key").eqNullSafe(F.col("_kept")), "left_semi")
    # Rows that repeat key and text.
    return chosen.groupBy("_key", "node").agg(F.first("_row").alias("_row")).select("_row.*")
