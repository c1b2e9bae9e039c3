"""Problem 9: documents into containers of fixed capacity.

A configuration is a multiset of lengths that fills a container. The linear program over all configurations (cover the histogram of
lengths with as few containers as possible) is solved by multiplicative weights and rounded as it goes: in each phase a length
weighs its size times an exponential of its share that is not yet covered, one knapsack dynamic program prices the best
configuration through every length at once, and each is used for a whole number of containers, a part of what the length still
needs. Prices also give a dual bound. What is left at the end, a few per cent, is filled by the same knapsack, bounded by what is
there and built around the longest item. All of that sees only the histogram, which has no more rows than the capacity has units;
documents get their container from their rank among the documents of their length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sample import positions
from . import common
from .encode import count_tokens

CAPACITY = 2048
#: Phases at most, what part of a length's need a phase covers, and how much more the less covered lengths weigh.
PHASES, PART, RATE = 300, 8, 0.5
#: Lengths of no more items are not divided over phases.
THIN = 8
#: Share of the space that is left to the bounded knapsack, and phases in a row that may cover next to nothing.
REST, IDLE = 0.03, 3

#: The dual solution: classes of lengths, units of the capacity, steps, and how fast a covered class loses weight.
CLASSES, UNITS, STEPS, SPREAD = 48, 256, 4000, 0.03
#: Under prices that aren't sizes: what fullness weighs beside them, and the share of the greatest value that a configuration must have.
FILL, NEARLY = 0.05, 0.9

Config = tuple[dict[int, int], int]


@dataclass
class Plan:
    """Containers by configuration; the first n_program of `configs` come from the program, the others from what it left."""

    configs: list[Config]
    n_program: int
    #: No packing of the whole items needs fewer containers: the best dual solution met.
    bound: float

    @property
    def containers(self) -> int:
        return sum(times for _, times in self.configs)

    @property
    def program_share(self) -> float:
        return sum(times for _, times in self.configs[: self.n_program]) / max(1, self.containers)


def priced(weights: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest weight for each room and the item it is reached with (0: a unit stays free), lengths without bound."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    w, upto = weights[lengths], np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(int(lengths[0]), capacity + 1):
        total = best[c - lengths[: upto[c]]] + w[: upto[c]]
        i = int(total.argmax())
        if total[i] > best[c - 1] + 1e-12:
            best[c], pick[c] = total[i], lengths[i]
        else:
            best[c] = best[c - 1]
    return best, pick


def _traced(pick: np.ndarray, room: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while room > 0:
        ell = int(pick[room])
        if ell:
            out[ell] = out.get(ell, 0) + 1
        room -= ell or 1
    return out


def heaviest(weights: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of greatest weight with at most left[l] items of length l, a few powers of two of each."""
    best = np.zeros(capacity + 1)
    stages: list[tuple[int, int, np.ndarray]] = []
    for ell in (np.flatnonzero(left[1 : capacity + 1] > 0) + 1).tolist():
        n, k = min(int(left[ell]), capacity // ell), 1
        while n > 0:
            k = min(k, n)
            n -= k
            size = ell * k
            total = best[:-size] + weights[ell] * k
            better = total > best[size:] + 1e-12
            best = best.copy()
            best[size:][better] = total[better]
            stages.append((ell, k, better))
            k *= 2
    out: dict[int, int] = {}
    c = int(best.argmax())
    for ell, k, better in reversed(stages):
        if c >= ell * k and better[c - ell * k]:
            out[ell] = out.get(ell, 0) + k
            c -= ell * k
    return out


def prices(counts: np.ndarray, capacity: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """(price of each length, dual bound): a dual solution of the program by multiplicative weights, no configuration dearer than 1.

    Lengths are put into at most CLASSES classes of about the same space, classes weigh less the more of them is covered, and each
    step covers with the configuration of greatest weight. Sizes as shares of the capacity are a dual solution too: the better one
    is returned.
    """
    size = np.arange(capacity + 1)
    plain, lengths = size / capacity, np.flatnonzero(counts)
    lengths = lengths[lengths > 0]
    least = float((counts * plain).sum())
    if not len(lengths):
        return plain, least
    space = np.cumsum((counts * size)[lengths])
    ends = np.unique(np.minimum(np.searchsorted(space, np.linspace(0, space[-1], CLASSES + 1)[1:] - 1e-9), len(lengths) - 1))
    of = np.searchsorted(lengths[ends], lengths)
    need = np.bincount(of, counts[lengths])
    # in coarser units of the capacity, rounded up: whatever fits then fits
    units = min(UNITS, capacity)
    z = -(-np.maximum.reduceat(lengths, np.r_[0, ends[:-1] + 1]) * units // capacity)
    upto, covered = np.searchsorted(z, np.arange(units + 1), side="right"), np.zeros(len(z))
    price, bound = np.zeros(len(z)), 0.0
    for step in range(steps):
        if step == steps // 4 and bound <= least:
            break  # sizes are the better solution already
        p = np.exp(-(covered - covered.min()) / SPREAD) / need
        best, pick = np.zeros(units + 1), np.full(units + 1, -1)
        for c in range(1, units + 1):
            best[c] = best[c - 1]
            if upto[c]:
                total = best[c - z[: upto[c]]] + p[: upto[c]]
                i = int(total.argmax())
                if total[i] > best[c]:
                    best[c], pick[c] = total[i], i
        bound = max(bound, float((need * p).sum() / best[units]))
        if step >= steps // 2:
            price += p / best[units]
        a, c = np.zeros(len(z)), units
        while c > 0:
            if pick[c] < 0:
                c -= 1
                continue
            a[pick[c]] += 1
            c -= int(z[pick[c]])
        covered += a / need * (0.25 * SPREAD * (need[a > 0] / a[a > 0]).min())
    # classes are rounded, so this bound holds for them alone; it has to be clearly better to be believed
    if bound <= least * (1 + 2 / CLASSES):
        return plain, least
    out = np.zeros(capacity + 1)
    # a shorter item is never dearer
    out[lengths] = np.maximum.accumulate(price[of])
    # and whole lengths fit better than rounded ones: no configuration is dearer than 1
    out /= priced(out, lengths, capacity)[0][capacity]
    return out, max(least, float((counts * out).sum()))


def plan(counts: np.ndarray, capacity: int = CAPACITY, phases: int = PHASES) -> Plan:
    """Whole containers by configuration that hold every item of the histogram exactly once; counts[l] items of length l."""
    size = np.arange(capacity + 1)
    left = counts.astype(np.int64).copy()
    left[0] = 0
    need, space, idle = np.maximum(left, 1).astype(float), int((left * size).sum()), 0
    price, bound = prices(left, capacity)
    by_size = price[capacity] == 1 and (price == size / capacity).all()
    # of configurations of one value the fullest
    base = price if by_size else price + FILL * size / capacity
    out: list[Config] = []

    def take(config: dict[int, int], of: np.ndarray) -> int:
        """As many containers as the items of `of` allow."""
        times = min(int(of[ell] // n) for ell, n in config.items())
        if times > 0:
            out.append((config, times))
            for ell, n in config.items():
                left[ell] -= n * times
                if of is not left:
                    of[ell] -= n * times
        return max(0, times)

    for _ in range(phases):
        lengths = np.flatnonzero(left)
        if not len(lengths) or (left * size).sum() <= REST * space or idle >= IDLE:
            break
        open_ = left / need
        weights = np.where(left > 0, base * np.exp(RATE * (open_ - open_[lengths].mean())), 0.0)
        best, pick = priced(weights, lengths, capacity)
        bound = max(bound, float((counts * weights)[1:].sum() / best[capacity])) if by_size else bound
        # an optimal solution only uses configurations of the greatest value
        value = 1.0 - 1e-9 if by_size else NEARLY * float(priced(np.where(left > 0, price, 0.0), lengths, capacity)[0][capacity])
        # all lengths are covered in step: none is spent beyond its part of the phase
        quota, taken = np.minimum(left, np.maximum(-(-left // PART), THIN)), 0
        for ell in lengths[::-1].tolist():
            if quota[ell]:
                config = _traced(pick, capacity - ell)
                config[ell] = config.get(ell, 0) + 1
                if sum(price[x] * n for x, n in config.items()) >= value:
                    taken += take(config, quota)
        idle = idle + 1 if taken * capacity < 0.002 * (left * size).sum() else 0
    n_program = len(out)
    # of equally good ones that of the fewest items: small items are what fills the last containers
    weights = base * capacity - 0.2 / capacity
    while left.any():
        ell = int(np.flatnonzero(left)[-1])
        left[ell] -= 1
        config = heaviest(weights, left, capacity - ell) if ell < capacity else {}
        left[ell] += 1
        config[ell] = config.get(ell, 0) + 1
        take(config, left)
    return Plan(out, n_program, max(bound, float(space / capacity)))


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """No packing needs fewer containers than this."""
    return -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)


def segments(configs: list[Config]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: from which rank on, items per container, first container."""
    at: dict[int, int] = {}
    parts: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for config, times in configs:
        for ell, n in config.items():
            parts.setdefault(ell, []).append((at.get(ell, 0), n, first))
            at[ell] = at.get(ell, 0) + n * times
        first += times
    return {ell: tuple(np.array(x, np.int64) for x in zip(*p)) for ell, p in parts.items()}


def _items(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, first_unit, size, rank): what goes into containers, ranked among the items of its size."""
    size = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0).cast("long"))
    whole = F.greatest(F.ceil(size / capacity), F.lit(1))
    items = sizes.select("doc_id", size.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), (whole - 1).cast("long"))).alias("piece"))
    items = items.select("doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("first_unit"), F.least(F.col("n") - F.col("piece") * capacity, F.lit(capacity)).alias("size"))
    # ranks come from slices of a range partitioning: a length of a third of all rows is in many tasks
    ranked = positions(common.materialize(items), "size", ["doc_id", "piece"])
    return common.materialize(ranked.select("doc_id", "piece", "first_unit", "size", F.col("_pos").alias("rank")))


def histogram(items: DataFrame, capacity: int) -> np.ndarray:
    """Items of each length; what reaches the driver has at most capacity + 1 rows."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in items.groupBy("size").agg(F.count("*").alias("n")).collect():
        counts[r["size"]] = r["n"]
    return counts


def _placed(ranked: DataFrame, made: Plan) -> DataFrame:
    places, n_containers = segments(made.configs), made.containers

    def place(batches):
        for batch in batches:
            ell, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            to = np.zeros(len(ell), np.int64)
            for x in np.unique(ell):
                own = ell == x
                if x == 0:
                    to[own] = rank[own] % max(1, n_containers)
                    continue
                start, per, first = places[int(x)]
                k = np.searchsorted(start, rank[own], side="right") - 1
                to[own] = first[k] + (rank[own] - start[k]) // per[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "first_unit", "size")), pa.array(to)], ["doc_id", "piece", "first_unit", "size", "container"])

    return ranked.mapInArrow(place, "doc_id long, piece int, first_unit long, size long, container long")


def pack(sizes: DataFrame, capacity: int = CAPACITY, phases: int = PHASES) -> DataFrame:
    """(doc_id, piece, first_unit, size, container) for df's (doc_id, n_tokens).

    An item beyond the capacity is cut into full pieces and a rest; every other item is one piece (piece 0). Items of size 0 or
    null take no space and go to containers in turn (container 0 if there are no others). Ties are broken by doc_id; rows of a
    repeated doc_id are items of their own. An empty input gives an empty frame.
    """
    items = _items(sizes, capacity)
    return _placed(items, plan(histogram(items, capacity), capacity, phases))


def p9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, piece, first_unit, size, container): a container for every document, sizes in tokens."""
    return pack(count_tokens(common.table(spark, sf_dir, "documents")))


def p9_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_items, n_containers, tokens, least_containers, fullest, program_share, gap): how well the containers are filled.

    program_share is the share of containers from the program's phases, gap what n_containers is above the dual bound, as a share.
    """
    items = _items(count_tokens(common.table(spark, sf_dir, "documents")), CAPACITY)
    made = plan(histogram(items, CAPACITY))
    per = _placed(items, made).groupBy("container").agg(F.sum("size").alias("tokens"), F.count("*").alias("n"))
    total = F.sum("tokens")
    return per.agg(
        F.sum("n").alias("n_items"),
        F.count("*").alias("n_containers"),
        total.alias("tokens"),
        F.ceil(total / CAPACITY).cast("long").alias("least_containers"),
        F.max("tokens").alias("fullest"),
        F.lit(made.program_share).alias("program_share"),
        F.lit(made.containers / made.bound - 1 if made.bound else 0.0).alias("gap"),
    )


QUERIES = {"p9_pack": p9_pack, "p9_summary": p9_summary}
