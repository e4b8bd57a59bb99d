"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions.

Every source's documents are cut into blocks.  Block j of a source with weight w (of W units
in all) is released at floor(j W / w) and due at ceil((j + 1) W / w).  In every slot the released
block with the earliest deadline goes next, which keeps each source less than one block from its
target at every point.  With whole weights the order repeats every W slots, so one
period is worked out from the weights alone, and each row finds its slot by arithmetic.

Where a source runs out, a new phase begins in which the others share its weight.

Of more than ``SOURCES`` sources all go by the same rule along their fluid shares, see ``fair_slots``: phases
of a period each would number as many as the sources, so blocks are released and due by the time at which the
shares, which grow as sources run out, reach them.
"""

from __future__ import annotations

import heapq
import math
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_mt.operators.layout import number_rows, sort_rows
from corpus_mt.session import stage_table, staged_dir

BLOCK_DOCS = 32
# Units the weights are rounded to, and sources planned by periods; the plan holds no more than their product.
UNITS = 1_000
SOURCES = 500
# Of more sources: weights are whole numbers of up to so many bits, and runs of slots leave the driver so many at a time.
WEIGHT_BITS = 40
RUNS = 1 << 17
# Slots of a run at most.
RUN_SLOTS = 1 << 14


def whole_weights(weights: Mapping[str | None, float], units: int = UNITS) -> dict[str | None, int]:
    """Weights as whole units by largest remainder; a positive weight gets one unit at least."""
    positive = {s: w for s, w in weights.items() if w > 0}
    total = sum(positive.values())
    exact = {s: w / total * max(units, len(positive)) for s, w in positive.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s is not None, s or ""))
    for s in order[: max(0, units - sum(out.values()))]:
        out[s] += 1
    return out


def pfair_period(weights: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """The slots of each source in one period: earliest deadline first among the released blocks."""
    period = sum(weights.values())
    names = sorted(weights, key=lambda s: (s is not None, s or ""))
    slots: dict[str | None, list[int]] = {s: [] for s in names}
    due = lambda s, j: -(-(j + 1) * period // weights[s])
    waiting = [(0, i) for i in range(len(names))]  # by release
    ready: list[tuple[int, int]] = []  # by deadline
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            i = heapq.heappop(waiting)[1]
            heapq.heappush(ready, (due(names[i], len(slots[names[i]])), i))
        i = heapq.heappop(ready)[1]
        s = names[i]
        slots[s].append(t)
        j = len(slots[s])
        if j < weights[s]:
            heapq.heappush(waiting, (j * period // weights[s], i))
    return slots


def plan_phases(blocks: Mapping[str | None, int], weights: Mapping[str | None, int]) -> list[dict]:
    """A row for each source and phase: where the source's blocks of that phase go.

    Sources without a weight come last, all alike.
    """
    left, used, rows, start, phase = dict(blocks), dict.fromkeys(blocks, 0), [], 0, 0
    while active := [s for s, n in left.items() if n > 0]:
        shares = {s: weights[s] for s in active if weights.get(s, 0) > 0} or dict.fromkeys(active, 1)
        slots, period = pfair_period(shares), sum(shares.values())
        last = lambda s: (left[s] - 1) // shares[s] * period + slots[s][(left[s] - 1) % shares[s]]
        end = min(map(last, shares)) + 1  # the phase is over with the first source to run out
        for s, w in shares.items():
            rows.append({"source": s, "phase": phase, "first": used[s], "start": start, "period": period, "slots": slots[s]})
            n = end // period * w + sum(t < end % period for t in slots[s])
            used[s] += n
            left[s] -= n
        start, phase = start + end, phase + 1
    return rows


_PHASES = "source string, phases array<struct<first:bigint,phase:int,start:bigint,period:bigint,slots:array<int>>>"


def tempered(counts: Mapping[str | None, int], power: float) -> dict[str | None, float]:
    """Target weights between the sources' shares (power 1) and equal ones (power 0)."""
    return {s: n**power for s, n in counts.items()}


def schedule(
    docs: DataFrame,
    weights: Mapping[str | None, float] | float,
    source: str = "source",
    key: str = "doc_id",
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``docs`` with ``block, phase, release, deadline, slot, place``, the last being the place in the block.

    ``weights`` are given by source, or as a power that tempers the sources' sizes.  Within a
    source documents follow a hash of their key.  Rows are ranked by one range sort that spreads
    a frequent source over many tasks; nothing is dropped or repeated.  A null source
    is a source of its own, null and repeated keys are placed like others, rows of one hash in any
    order that stays, an empty table gives no rows.  Columns of ``docs`` named like the new ones are replaced.

    Of more than ``SOURCES`` sources ``phase`` counts the times before the release at which shares grew.
    """
    new = ("block", "phase", "release", "deadline", "slot", "place")
    spark = docs.sparkSession
    rows = docs.drop(*new).withColumns({"_source": F.col(source).cast("string"), "_hash": F.xxhash64(key)})
    ranked = number_rows(rows, ["_source", "_hash"], "_index").drop("_hash")
    counts = stage_table(ranked.groupBy("_source").agg(F.count("*").alias("n"), F.min("_index").alias("at")), "sources")
    if counts.limit(SOURCES + 1).count() > SOURCES:
        return _schedule_many(ranked, counts, weights, block_docs)
    found = counts.collect()
    sizes = {r["_source"]: r["n"] for r in found}
    blocks = {s: -(-n // block_docs) for s, n in sizes.items()}
    given = weights if isinstance(weights, Mapping) else tempered(sizes, weights)
    shares = {s: given.get(s, 0.0) for s in sizes}
    starts = F.broadcast(spark.createDataFrame([(r["_source"], r["at"]) for r in found], "_s string, at bigint"))
    placed = ranked.join(starts, F.col("_source").eqNullSafe(F.col("_s"))).withColumns(_cut("at", block_docs)).drop("_s", "at")
    plan: dict[str | None, list[tuple]] = {s: [] for s in blocks}
    for r in plan_phases(blocks, whole_weights(shares)):
        plan[r["source"]].append((r["first"], r["phase"], r["start"], r["period"], r["slots"]))
    table = F.broadcast(spark.createDataFrame([(s, p) for s, p in plan.items()], _PHASES).withColumnRenamed("source", "_s"))
    placed = placed.join(table, F.col("_source").eqNullSafe(F.col("_s")))
    placed = placed.withColumn("_p", F.element_at(F.filter("phases", lambda p: p["first"] <= F.col("block")), -1)).drop("phases")
    j, w, period, start = F.col("block") - F.col("_p.first"), F.size("_p.slots"), F.col("_p.period"), F.col("_p.start")
    placed = placed.withColumns(
        {
            "phase": F.col("_p.phase"),
            "release": start + F.floor(j * period / w).cast("bigint"),
            "deadline": start + F.ceil((j + 1) * period / w).cast("bigint"),
            "slot": start + F.floor(j / w).cast("bigint") * period + F.get("_p.slots", F.pmod(j, w).cast("int")),
        }
    )
    return placed.drop("_source", "_s", "_index", "_p")


def _cut(first: str, block_docs: int) -> dict[str, Column]:
    """Block and place of a row of a source, whose rows are numbered from ``first`` on."""
    rank = F.col("_index") - F.col(first)
    return {"block": F.floor(rank / block_docs).cast("bigint"), "place": F.pmod(rank, F.lit(block_docs)).cast("int")}


def fair_slots(classes: Sequence[tuple[int, int, int, int]], start: int = 0, phase: int = 0) -> Iterator[tuple[int, ...]]:
    """Runs ``(rank, block, phase, release, deadline, slot, length)``: that block of the sources of the ranks from the first on, one a slot.

    ``classes`` holds ``(first rank, sources, blocks, weight)``: sources alike in blocks and weight, which is a whole number.
    Fluidly, every source left has its weight's share of each moment, so with T(v) blocks done when a weight of one has v,
    block j of weight w is in work from T(j / w) to T((j + 1) / w).  Released and due at the slots around these, blocks go by the
    earliest deadline among the released: every source stays less than one block from its fluid share, and no slot is
    empty.  All is worked out in whole numbers.  Two blocks of a class at most are released and not done.
    """
    exact = lambda n, w: (n << 2 * WEIGHT_BITS + 8) // w  # noqa: E731  # in the order of the fractions, and equal only where they are
    ends = sorted({exact(n, w) for _, _, n, w in classes})
    done, active = [0] * (len(ends) + 1), [0] * (len(ends) + 1)
    for _, m, n, w in classes:
        k = bisect_right(ends, exact(n, w))
        done[k] += m * n
        active[k - 1] += m * w
    for k in range(len(ends)):  # done at the end of a phase, active until then
        done[k + 1] += done[k]
        active[-k - 2] += active[-k - 1]

    def reached(j: int, w: int) -> tuple[int, int, int]:
        k = bisect_right(ends, exact(j, w))
        return k, done[k] + j * active[k] // w, done[k] - (-j * active[k] // w)

    t = 0
    waiting = [(0, c, 0, 0) for c in range(len(classes))]  # by release: class, block, phase
    heapq.heapify(waiting)
    ready: list[tuple[int, ...]] = []  # by deadline: class, block, source, phase, release
    while waiting or ready:
        while waiting and waiting[0][0] <= t:
            release, c, j, k = heapq.heappop(waiting)
            _, _, n, w = classes[c]
            after, following, due = reached(j + 1, w)
            heapq.heappush(ready, (due, c, j, 0, k, release))
            if j + 1 < n:
                heapq.heappush(waiting, (following, c, j + 1, after))
        due, c, j, i, k, release = heapq.heappop(ready)
        rank, m, _, _ = classes[c]
        length = min(m - i, RUN_SLOTS, waiting[0][0] - t if waiting else RUN_SLOTS)
        yield rank + i, j, phase + k, start + release, start + due, start + t, length
        t += length
        if i + length < m:
            heapq.heappush(ready, (due, c, j, i + length, k, release))


def _stage_runs(spark: SparkSession, runs: Iterable[tuple[int, ...]]) -> DataFrame:
    """Staged runs; the driver holds ``RUNS`` of them."""
    names = ("_first", "block", "phase", "release", "deadline", "_slot", "_length")
    path, runs = f"{staged_dir(spark)}/runs-{uuid.uuid4().hex}", iter(runs)
    while part := list(islice(runs, RUNS)):
        table = pa.table([pa.array(column, pa.int64()) for column in zip(*part, strict=True)], names)
        spark.createDataFrame(table).write.mode("append").parquet(path)
    return spark.read.schema(", ".join(f"{n} bigint" for n in names)).parquet(path)


def _schedule_many(ranked: DataFrame, counts: DataFrame, weights: Mapping[str | None, float] | float, block_docs: int) -> DataFrame:
    """The schedule of any number of sources, all by ``fair_slots``; those without a weight come last, all alike.

    ``ranked`` has ``_source`` and ``_index``, the number of a row in the order of the sources; ``counts`` the sources with
    their rows ``n`` and first number ``at``.  The driver holds a row for each number of blocks and weight that sources
    have in common: with tempered weights that follows the number of rows, and numbers of rows that differ are fewer
    than the root of twice the table.
    """
    spark = ranked.sparkSession
    sources = counts.withColumn("_blocks", F.ceil(F.col("n") / block_docs).cast("bigint"))
    if isinstance(weights, Mapping):
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items() if w > 0], "_s string, _w double")
        sources = sources.join(F.broadcast(given), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s")
    else:
        sources = sources.withColumn("_w", F.pow("n", F.lit(float(weights))))
    most = sources.agg(F.max("_w")).first()[0] or 1.0
    units = F.greatest(F.round(F.col("_w") / most * float(1 << WEIGHT_BITS)).cast("bigint"), F.lit(1))
    sources = sources.withColumns({"_last": F.col("_w").isNull().cast("int"), "_w": F.when(F.col("_w").isNull(), 1).otherwise(units)})
    kind = ["_last", "_blocks", "_w"]
    sources = number_rows(sources.withColumnRenamed("_source", "_s"), [*kind, "_s"], "_rank")
    groups = sorted(tuple(r) for r in sources.groupBy(*kind).count().collect())
    parts: tuple[list, list] = ([], [])
    first = 0
    for last, n, w, m in groups:
        parts[last].append((first, m, n, w))
        first += m
    ahead = sum(m * n for _, m, n, _ in parts[0])
    phases = len({Fraction(n, w) for _, _, n, w in parts[0]})

    def runs() -> Iterator[tuple[int, ...]]:
        yield from fair_slots(parts[0])
        yield from fair_slots(parts[1], ahead, phases)

    slots = _stage_runs(spark, runs()).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_length") - 1)))
    slots = slots.select((F.col("_first") + F.col("_k")).alias("_rank"), "block", F.col("phase").cast("int").alias("phase"), "release", "deadline", (F.col("_slot") + F.col("_k")).alias("slot"))
    # The largest sources are sent around, so that their rows stay where they are; no other fills a task.
    starts = sources.select("_s", F.col("at").alias("_from"), "_rank", "n")
    large = F.broadcast(starts.orderBy(F.desc("n"), "_rank").limit(SOURCES - 1))
    small = starts.join(large.select("_rank"), "_rank", "left_anti")
    placed = [ranked.join(table.drop("n"), F.col("_source").eqNullSafe(F.col("_s"))) for table in (large, small)]
    placed = placed[0].unionByName(placed[1]).withColumns(_cut("_from", block_docs))
    own = [c for c in ranked.columns if c not in ("_source", "_index")]
    return placed.join(slots, ["_rank", "block"]).select(*[f"`{c}`" for c in own], "block", "place", "phase", "release", "deadline", "slot")


def mix(docs: DataFrame, weights: Mapping[str | None, float] | float, source: str = "source", key: str = "doc_id", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of ``docs``, with their own columns, in mixed order."""
    boxed = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(source).alias("_src"), F.col(key).alias("_key"))
    mixed = schedule(boxed, weights, "_src", "_key", block_docs)
    return sort_rows(mixed.select("_doc", "slot", "place"), ["slot", "place"]).select("_doc.*")
