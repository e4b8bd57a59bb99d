"""SimHash near duplicates by the general pigeonhole principle.

Two fingerprints that differ in at most ``DISTANCE`` bits, cut into m partitions with thresholds that
sum to ``DISTANCE - m + 1``, agree within the threshold of at least one partition; a threshold of -1
leaves a partition out.  Correlated bits lie in one partition, so that the others are as selective as can be.
Every fingerprint has thresholds of its own: a dynamic program takes those with the fewest probes and estimated
candidates.  Probes meet the partitions' values in a join, and the distance over all bits decides.

The statistics (correlations, counts of every octet's values) cover all fingerprints; they decide on
the cost alone, never on the result.  Only links are kept, and of a value that very many fingerprints
share only a spanning forest of its links, found in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_mt.llm.common import line_pieces, small_batches, text_slices
from corpus_mt.llm.components import components
from corpus_mt.operators.skew import spread_join
from corpus_mt.session import stage_table

SHINGLE, SEED, BITS, DISTANCE = 4, 42, 64, 4
# Octets of bits in each partition; the layout with the least estimated cost is used.
LAYOUTS = ((4, 4), (3, 3, 2), (2, 2, 2, 2))
# What a probe costs, in candidates compared.
PROBE_COST = 30.0
# A value with more fingerprints, or asked for by more, is compared in blocks of so many.
FEW, FEW_PROBES, BLOCK = 64, 4_096, 2_048
SLICE_BYTES = 1 << 20
BATCH_ROWS = 500

_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_LABELS = np.iinfo(np.int32).max


# --- fingerprints --------------------------------------------------------------------------------


def fingerprint(text: bytes) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number; 0 without words."""
    digest = xxhash.xxh64_intdigest
    ones, n, words = np.zeros(BITS, np.int64), 0, []
    for piece in line_pieces(text.translate(_FOLD), SLICE_BYTES):
        words += [w for w in piece.split(b" ") if w]
        if len(words) >= SHINGLE:
            shingles = zip(*(words[k:] for k in range(SHINGLE)), strict=False)
            hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], "<u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            n += len(hashes)
            words = words[1 - SHINGLE :]
    if not n:
        return digest(b" ".join(words), SEED) if words else 0
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, fp`` of every row, the fingerprint as the signed number of its bits; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b in text_slices(texts, 8 * SLICE_BYTES):
                bodies = texts.slice(a, b - a).cast(pa.large_string()).cast(pa.large_binary())
                fps = np.array([fingerprint(t.as_py()) for t in bodies], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(fps)], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, fp bigint")


def fingerprint_text(fp) -> F.Column:
    """A signed fingerprint as 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- partitions of correlated bits ---------------------------------------------------------------


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_pairs(nodes: DataFrame) -> np.ndarray:
    """How many fingerprints have both bits set, for any two bits; the last row holds their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
            total += bits.T @ bits
            n += batch.num_rows
        flat = np.concatenate([total.ravel(), [n]]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "n"])

    rows = nodes.select("fp").mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    flat = np.zeros(BITS * BITS + 1)
    flat[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return flat


def correlated_order(pairs: np.ndarray) -> np.ndarray:
    """The bits, those that go together next to each other.

    Each octet starts with the most correlated bits that are left and takes on what is closest to it; the
    next one starts close to it, so that octets that go together share a partition.
    """
    n, both = max(pairs[-1], 1.0), pairs[:-1].reshape(BITS, BITS)
    p = both.diagonal() / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    close = np.abs(both / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(close, 0.0)
    left, order = list(range(BITS)), []
    while left:
        octet = order[-8:]
        picked = max(left, key=lambda i: (close[i, octet].mean() if octet else close[i, left].max(), -i))
        group = [picked]
        left.remove(picked)
        while len(group) < 8:
            picked = max(left, key=lambda i: (close[i, group].mean(), -i))
            group.append(picked)
            left.remove(picked)
        order += group
    return np.array(order)


def octets(fps: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Eight numbers for each fingerprint, its bits in the given order."""
    return np.packbits(_bits(fps)[:, order], axis=1, bitorder="little")


def octet_counts(nodes: DataFrame, order: np.ndarray) -> np.ndarray:
    """How many fingerprints hold each value of each octet."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(8 * 256, np.int64)
        for batch in batches:
            values = octets(batch.column(0).to_numpy(), order).astype(np.int64) + 256 * np.arange(8)
            total += np.bincount(values.ravel(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    rows = nodes.select("fp").mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(8 * 256, np.int64)
    out[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(8, 256)


# --- thresholds ------------------------------------------------------------------------------------


def distance_shares(counts: np.ndarray) -> np.ndarray:
    """Share of the fingerprints at each distance up to ``DISTANCE`` from each value of each octet."""
    values = np.arange(256, dtype=np.uint8)
    apart = np.bitwise_count(values[:, None] ^ values[None])
    n = max(counts[0].sum(), 1)
    return np.stack([[(apart == d) @ octet for d in range(DISTANCE + 1)] for octet in counts]).transpose(0, 2, 1) / n


def _variants(bits: int, far: int) -> int:
    total, term = 0, 1
    for d in range(far + 1):
        total += term
        term = term * (bits - d) // (d + 1)
    return total


def allocate(values: np.ndarray, layout: tuple[int, ...], shares: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds plus one of every partition, a row for each fingerprint, and what they cost.

    Thresholds plus one sum to ``DISTANCE + 1``.  Candidates are estimated as if octets were
    independent: the distances within a partition are the convolution of those within its octets.
    """
    rows, least = len(values), np.zeros((len(values), DISTANCE + 2))
    least[:, 1:] = np.inf
    chosen, at = np.zeros((len(layout), rows, DISTANCE + 2), np.int8), 0
    for k, width in enumerate(layout):
        near = np.zeros((rows, DISTANCE + 1))
        near[:, 0] = 1.0
        for octet in range(at, at + width):
            share = shares[octet][values[:, octet]]
            near = np.stack([sum(near[:, i] * share[:, d - i] for i in range(d + 1)) for d in range(DISTANCE + 1)], 1)
        at += width
        probes = np.array([_variants(8 * width, d) for d in range(DISTANCE + 1)])
        cost = np.concatenate([np.zeros((rows, 1)), n * near.cumsum(1) + PROBE_COST * probes], 1)
        total = np.full_like(least, np.inf)
        for s in range(DISTANCE + 2):
            ways = np.stack([least[:, s - u] + cost[:, u] for u in range(s + 1)], 1)
            chosen[k, :, s] = ways.argmin(1)
            total[:, s] = ways.min(1)
        least = total
    out, left = np.zeros((rows, len(layout)), np.int8), np.full(rows, DISTANCE + 1)
    for k in reversed(range(len(layout))):
        out[:, k] = chosen[k, np.arange(rows), left]
        left = left - out[:, k]
    return out, least[:, -1]


@lru_cache(maxsize=64)
def _masks(bits: int, far: int) -> np.ndarray:
    """All numbers of ``bits`` bits with at most ``far`` set."""
    return np.array([sum(1 << b for b in c) for d in range(far + 1) for c in combinations(range(bits), d)], np.int64)


def cheapest_layout(nodes: DataFrame, order: np.ndarray, shares: np.ndarray, n: int) -> tuple[int, ...]:
    """The layout of ``LAYOUTS`` with the least estimated cost over all fingerprints."""

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(LAYOUTS))
        for batch in batches:
            values = octets(batch.column(0).to_numpy(), order)
            total += [allocate(values, layout, shares, n)[1].sum() for layout in LAYOUTS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(LAYOUTS))), pa.array(total)], ["layout", "cost"])

    costs = nodes.select("fp").mapInArrow(cost, "layout bigint, cost double").groupBy("layout").agg(F.sum("cost").alias("cost"))
    best = costs.orderBy("cost", "layout").first()
    return LAYOUTS[best["layout"] if best else 0]


def places(nodes: DataFrame, order: np.ndarray, shares: np.ndarray, n: int, layout: tuple[int, ...]) -> DataFrame:
    """``place, fp, asks``: where every fingerprint stands, once for each partition, and where it asks for others.

    A place is a partition and a value of its bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                fps = whole.column(0).slice(first, 1024).to_numpy()
                values = octets(fps, order)
                thresholds, _ = allocate(values, layout, shares, n)
                at = 0
                for k, width in enumerate(layout):
                    value = np.zeros(len(fps), np.int64)
                    for octet in range(at + width - 1, at - 1, -1):
                        value = value << 8 | values[:, octet]
                    at += width
                    place = np.int64(k << 32) | value
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(fps), pa.array(np.zeros(len(fps), bool))], ["place", "fp", "asks"])
                    for u in range(1, DISTANCE + 2):
                        rows = np.flatnonzero(thresholds[:, k] == u)
                        masks = _masks(8 * width, u - 1)
                        step = max(1, (1 << 17) // len(masks))
                        for a in range(0, len(rows), step):
                            asked = rows[a : a + step]
                            probes = (place[asked, None] ^ masks[None]).ravel()
                            asking = np.repeat(fps[asked], len(masks))
                            yield pa.RecordBatch.from_arrays([pa.array(probes), pa.array(asking), pa.array(np.ones(len(probes), bool))], ["place", "fp", "asks"])

    return nodes.select("fp").mapInArrow(run, "place bigint, fp bigint, asks boolean")


# --- links -------------------------------------------------------------------------------------------


def block_forest(stored: np.ndarray, asking: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block and the least one that the links between both sides tie each to."""
    nodes, at = np.unique(np.concatenate([stored, asking]), return_inverse=True)
    s, q = at[: len(stored)], at[len(stored) :]
    label = np.arange(len(nodes), dtype=np.int32)
    near = np.empty((len(q), len(s)), bool)
    x, y = asking.view(np.uint64), stored.view(np.uint64)  # of a signed number the bits of its absolute value are counted
    for a in range(0, len(q), 256):
        near[a : a + 256] = np.bitwise_count(x[a : a + 256, None] ^ y[None]) <= distance
    busy = near.any(1)
    q, near = q[busy], near[busy]
    while len(q):
        before = label.copy()
        for a in range(0, len(q), 256):
            rows = near[a : a + 256]
            low = np.minimum(label[q[a : a + 256]], np.where(rows, label[s], _LABELS).min(1))
            label[q[a : a + 256]] = low
            label[s] = np.minimum(label[s], np.where(rows, low[:, None], _LABELS).min(0))
        if (label == before).all():
            break
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of consecutive blocks ``place, i, j, asks, fp``; one block is held at a time."""

    def edges(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        asks, fps = (np.concatenate([p[k] for p in parts]) for k in range(2))
        a, b = block_forest(fps[~asks], fps[asks])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        asks, fps = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy()
        cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True):
            block = tuple(ids[a])
            if held and block != last:
                yield edges(held)
                held = []
            held.append((asks[a:b], fps[a:b]))
            last = block
    if held:
        yield edges(held)


def links(placed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``a, b`` of fingerprints, from staged ``place, fp, asks``, as far as their components need.

    All links of a place with few fingerprints; a spanning forest of those in every block of one with many.
    """
    stands, asks = F.sum((~F.col("asks")).cast("bigint")), F.sum(F.col("asks").cast("bigint"))
    sizes = placed.groupBy("place").agg(stands.alias("n_s"), asks.alias("n_q"))
    sizes = sizes.filter((F.col("n_s") > 0) & (F.col("n_q") > 0) & ((F.col("n_s") > FEW) | (F.col("n_q") > FEW_PROBES)))
    sizes = stage_table(sizes, "sizes")
    usual = placed.join(sizes.select("place"), "place", "left_anti")
    x, y = usual.filter("NOT asks").select("place", F.col("fp").alias("a")), usual.filter("asks").select("place", F.col("fp").alias("b"))
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance) & (F.col("a") != F.col("b"))
    few = x.join(y, "place").filter(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    many = placed.join(sizes, "place")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK)
    dealt = lambda n: F.pmod(F.xxhash64("fp"), blocks(n)).cast("bigint")
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), blocks(n) - 1)
    opened = many.withColumn("i", F.explode(F.when(F.col("asks"), every("n_s")).otherwise(F.array(dealt("n_s")))))
    opened = opened.withColumn("j", F.explode(F.when(F.col("asks"), F.array(dealt("n_q"))).otherwise(every("n_q"))))
    rows = opened.select("place", "i", "j", "asks", "fp").repartition("place", "i", "j").sortWithinPartitions("place", "i", "j")
    return few.unionByName(rows.mapInArrow(_blocks, "a bigint, b bigint"))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", distance: int = DISTANCE) -> DataFrame:
    """``key, fingerprint, component_id`` for every row; the id is the least key that links lead to.

    Equal fingerprints are linked, zero ones among them: those of texts that are null, empty
    or without words.  Null keys stay; the id is null only where all keys of a component are.  Repeated rows
    each count.  Other columns play no part.  An empty table gives no rows.  Texts are taken whole,
    in pieces, so their length costs time and no memory.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be from 0 to {DISTANCE}")
    with small_batches(docs.sparkSession, BATCH_ROWS):
        printed = stage_table(fingerprints(docs, text, key), "printed")
    nodes = stage_table(printed.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n")), "nodes")
    pairs = bit_pairs(nodes)
    order, n = correlated_order(pairs), int(pairs[-1])
    shares = distance_shares(octet_counts(nodes, order))
    placed = stage_table(places(nodes, order, shares, n, cheapest_layout(nodes, order, shares, n)), "places")
    found = components(links(placed, distance), thin=True)
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = stage_table(rooted, "rooted")
    totals = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = spread_join(rooted.select("fp", "root"), totals.drop("n"), "root", totals.select("root", "n"))
    out = spread_join(printed, named.select("fp", "component_id"), "fp", nodes.select("fp", "n"))
    return out.select(F.col("key").alias(key), fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")
