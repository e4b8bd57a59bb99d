"""Source mixing: every prefix of the mix is less than a block from its target."""

from collections import Counter
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from corpus_mt.llm import mixing


@settings(max_examples=200, deadline=None)
@given(hs.dictionaries(hs.sampled_from([None, *"abcdefgh"]), hs.integers(1, 40), min_size=1))
def test_period_keeps_every_prefix_near_its_target(weights):
    slots, period = mixing.pfair_period(weights), sum(weights.values())
    order = {t: s for s, ts in slots.items() for t in ts}
    assert sorted(order) == list(range(period))
    seen = Counter()
    for t in range(period):
        seen[order[t]] += 1
        assert all(abs(seen[s] - w * (t + 1) / period) < 1 for s, w in weights.items())
    for s, w in weights.items():
        for j, t in enumerate(slots[s]):
            assert j * period // w <= t < -(-(j + 1) * period // w)


@settings(max_examples=100, deadline=None)
@given(hs.dictionaries(hs.sampled_from([None, *"abcde"]), hs.tuples(hs.integers(1, 60), hs.floats(0, 5)), min_size=1))
def test_phases_place_every_block_once(case):
    blocks = {s: n for s, (n, _) in case.items()}
    weights = mixing.whole_weights({s: w for s, (_, w) in case.items()}, 50)
    taken = []
    rows = mixing.plan_phases(blocks, weights)
    for s, n in blocks.items():
        own = sorted((r for r in rows if r["source"] == s), key=lambda r: r["phase"])
        for j in range(n):
            r = [x for x in own if x["first"] <= j][-1]
            k, w = j - r["first"], len(r["slots"])
            taken.append(r["start"] + k // w * r["period"] + r["slots"][k % w])
    assert sorted(taken) == list(range(sum(blocks.values())))


def test_weights_are_whole_and_sum_up():
    got = mixing.whole_weights({"a": 1e-9, "b": 2.0, "c": 1.0, "d": 0.0, None: 1.0}, 100)
    assert got["a"] == 1 and "d" not in got and 100 <= sum(got.values()) <= 101 and got["b"] > got["c"]
    assert mixing.whole_weights({}) == {}


def test_schedule_of_a_table(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.lit("clash").alias("slot"), F.lit("clash").alias("_source"),
    ).repartition(7)
    weights = {"hot": 1.0, "s0": 3.0, "s1": 2.0, "s2": 2.0, "s3": 2.0}
    got = mixing.schedule(rows.drop("_source"), weights, block_docs=10).collect()
    assert len({r.doc_id for r in got}) == len(got) == 2000
    blocks = {(r.source, r.block): r for r in got}
    slots = {r.slot: r.source for r in got}
    assert sorted(slots) == list(range(len(blocks))) and all(r.release <= r.slot < r.deadline for r in got)
    assert slots[max(slots)] is None  # without a weight: last
    units = mixing.whole_weights(weights)
    first, seen = sum(r.phase == 0 for r in blocks.values()), Counter()
    for t in range(first):
        seen[slots[t]] += 1
        assert all(abs(seen[s] - w * (t + 1) / sum(units.values())) < 1 for s, w in units.items())


def test_mixed_rows_keep_their_columns_and_order(spark):
    df = spark.createDataFrame([(i, f"t{i}", "ab"[i % 2]) for i in range(200)] + [(None, None, None)] * 2, "doc_id long, text string, source string")
    mixed = mixing.mix(df, 0.5, block_docs=5)
    assert mixed.columns == df.columns and sorted(map(str, mixed.collect())) == sorted(map(str, df.collect()))
    order = [r.source for r in mixed.collect() if r.source][:40]
    assert 15 <= order.count("a") <= 25
    assert mixing.schedule(df.limit(0), 0.5).count() == mixing.mix(df.limit(0), 1.0).count() == 0


def test_more_sources_than_are_planned_one_by_one(spark, monkeypatch):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 700)).alias("source"))
    for weights in (0.5, {"hot": 1.0, "s1": 2.0, "s699": 1.0, "none": 9.0}):
        got = mixing.schedule(rows, weights, block_docs=4).collect()
        assert len({r.doc_id for r in got}) == len(got) == 3000 and set(got[0].asDict()) == {"doc_id", "source", "block", "phase", "release", "deadline", "slot", "place"}
        assert len({(r.slot, r.place) for r in got}) == 3000 and all(r.release <= r.slot < r.deadline for r in got)
        assert {(r.doc_id, r.source) for r in got} == {(r.doc_id, r.source) for r in rows.collect()}
    # One large source beside a pool of the others: each prefix is less than a block from the two weights.
    monkeypatch.setattr(mixing, "SOURCES", 2)
    got = mixing.schedule(rows, {"hot": 1.0, **{f"s{i}": 0.01 for i in range(700)}}, block_docs=4).collect()
    slots = {r.slot: r.source == "hot" for r in got}
    first = max(r.slot for r in got if r.phase == 0)
    n = sum(1 for i in range(700) if any((x % 700 == i and x % 3) for x in range(i, 3000, 700)))
    share, seen = 1.0 / (1.0 + 0.01 * n), 0
    for t in range(first + 1):
        seen += slots[t]
        assert abs(seen - share * (t + 1)) < 1.5


def test_pooled_sources_follow_their_own_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 2)
    size = {"big": 400, "a": 200, "b": 120, "c": 40, None: 40, "z": 20}
    names = [s for s, n in size.items() for _ in range(n)]
    rows = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string")
    weights = {"big": 1.0, "a": 6.0, "b": 1.0, "c": 2.0, None: 1.0}
    got = mixing.schedule(rows, weights, block_docs=4).collect()
    assert len({r.doc_id for r in got}) == len({(r.slot, r.place) for r in got}) == len(got) == len(names)
    blocks = {(r.source, r.block): r.slot for r in got}
    assert len(blocks) == len(set(blocks.values())) == sum(n // 4 for n in size.values()) and max(blocks.values()) == len(blocks) - 1
    assert all(blocks[s, j] < blocks[s, j + 1] for s, j in blocks if (s, j + 1) in blocks)
    assert [s for (s, _), _ in sorted(blocks.items(), key=lambda x: x[1])][-5:] == ["z"] * 5  # without a weight: last
    pool = [s for (s, _), _ in sorted(blocks.items(), key=lambda x: x[1]) if s not in ("big", "z")]
    seen = Counter()
    for k, s in enumerate(pool, 1):
        seen[s] += 1
        if any(seen[x] == size[x] // 4 for x in seen):
            break  # one has run out
        for x in ("a", "b", "c", None):
            target = k * weights[x] / 10
            assert target - 1 - 1e-9 <= seen[x] <= target + weights[x] / 2.5 + 1


def _fluid(classes, t):
    """Blocks that a source of each class has done by the time t, if all go on at once by their weights."""
    did, now = [Fraction(0)] * len(classes), Fraction(0)
    while now < t and (left := [i for i, (_, _, n, _) in enumerate(classes) if did[i] < n]):
        total = sum(classes[i][1] * classes[i][3] for i in left)
        step = min([t - now, *((classes[i][2] - did[i]) * total / classes[i][3] for i in left)])
        for i in left:
            did[i] += step * classes[i][3] / total
        now += step
    return did


@settings(max_examples=150, deadline=None)
@given(hs.lists(hs.tuples(hs.integers(1, 4), hs.integers(1, 9), hs.integers(1, 30)), min_size=1, max_size=6, unique_by=lambda x: x[1:]))
def test_any_number_of_sources_stay_near_their_fluid_shares(found):
    classes, first = [], 0
    for m, n, w in found:
        classes.append((first, m, n, w))
        first += m
    at, total = {}, sum(m * n for _, m, n, _ in classes)
    for rank, j, _, release, due, slot, length in mixing.fair_slots(classes):
        assert release <= slot and slot + length <= due
        for k in range(length):
            assert slot + k not in at
            at[slot + k] = (rank + k, j)
    assert sorted(at) == list(range(total))
    seen = Counter()
    for t in range(total):
        rank, j = at[t]
        assert j == seen[rank]  # in order
        seen[rank] += 1
        for (first, m, _, _), want in zip(classes, _fluid(classes, t + 1), strict=True):
            assert all(abs(seen[first + i] - want) < 1 for i in range(m))


def test_small_sources_of_many_have_their_own_releases_and_deadlines(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES", 3)
    monkeypatch.setattr(mixing, "RUNS", 7)
    size = {"big": 64, "a": 36, "b": 16, "c": 16, "d": 4, None: 4}
    names = [s for s, n in size.items() for _ in range(n)]
    rows = spark.createDataFrame([(i, s, "x") for i, s in enumerate(names)], "doc_id long, source string, n string").repartition(5)
    got = mixing.schedule(rows, 0.5, block_docs=2).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(names))) and len({(r.slot, r.place) for r in got}) == len(got)
    classes = [(0, 1, n // 2, round(n**0.5)) for n in size.values()]
    total = sum(n for _, _, n, _ in classes)
    times = [_fluid(classes, t) for t in range(total + 1)]
    blocks = {(r.source, r.block): r for r in got}
    assert len(blocks) == total and sorted(r.slot for r in blocks.values()) == list(range(total))
    for (source, j), r in blocks.items():
        i = list(size).index(source)
        assert r.release <= r.slot < r.deadline
        assert times[r.release][i] <= j < times[r.release + 1][i]
        assert times[r.deadline - 1][i] < j + 1 <= times[r.deadline][i]
    weightless = mixing.schedule(rows, {"big": 1.0, "a": 2.0, "none": 1.0}, block_docs=2).collect()
    assert max(r.slot for r in weightless if r.source in ("big", "a")) < min(r.slot for r in weightless if r.source not in ("big", "a"))
    assert all(r.release <= r.slot < r.deadline for r in weightless) and len({r.slot for r in weightless}) == total


def test_mix_follows_the_weights_of_all_of_many_sources(spark, monkeypatch):
    """Sources beyond the planned ones are in the mix at every point as their weights ask, in ``mix`` as well."""
    monkeypatch.setattr(mixing, "SOURCES", 2)
    df = spark.createDataFrame([(i, "aaaaaabbcd"[i % 10]) for i in range(2000)], "doc_id long, source string")
    order = [r.source for r in mixing.mix(df, 1.0, block_docs=1).collect()]
    for k in range(1, len(order) + 1):
        seen = Counter(order[:k])
        assert all(abs(seen[s] - k * w / 10) < 1 for s, w in (("a", 6), ("b", 2), ("c", 1), ("d", 1)))
