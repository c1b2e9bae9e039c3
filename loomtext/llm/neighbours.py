"""Problem 5: the most similar vectors of every vector.

Shifted space-filling curves: the vectors are projected to a few dimensions, shifted, and laid along a Hilbert curve, several
times over. The projections are random directions weighted by the spectrum of the vectors (of a bounded sample), and the curves are
fine enough to tell the rows of a dense group apart. Spark range-partitions each ordering; in a partition the vectors within a
window of neighbouring keys are compared by one matrix product a block, on sixteen-bit copies. The windows' best merge, and the exact
vectors rerank them. How wide windows have to be is measured: some probes are compared with all vectors, and the least reach is
taken that shows the wanted share of the probes' true neighbours. Where windows would then meet as many rows as there are, all are
compared with all, block by block.
Vectors of equal content are folded to one before and unfolded after, k neighbours each, so a hot group stays linear.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WIDTH = 64
K = 5
MIN_SIMILARITY = 0.9
#: Orderings where near neighbours are wanted, and where any are; dimensions and bits of a curve.
ORDERINGS, MORE_ORDERINGS, DIMENSIONS, BITS = 8, 32, 12, 10
#: Rows that a vector meets in all its windows at least.
LEAST_MET = 8192
#: Rows that projections are fitted on, and probes among them that the reach is measured with; the share of their neighbours wanted.
FITTED_ON, PROBES, RECALL = 20_000, 600, 0.95
#: What sixteen bits may cost a similarity.
SLACK = 1e-4
#: Candidates of a vector in one window, beyond the k that are wanted.
SPARE = 3
#: Rows of a range partition.
PARTITION_ROWS = 60_000
#: Vectors of a block in the exact comparison, and its rows that are multiplied at a time.
BLOCK, STRIP = 4096, 512
#: Blocks that a task holds of the side that is passed again and again.
HELD = 64
#: What single precision may cost a similarity.
ROUNDING = 1e-6
SEED = 20


def unit(values: list | None, width: int = WIDTH) -> np.ndarray | None:
    """The vector at unit length, padded with zeros or cut to the width; None for null, empty, all-zero and non-finite ones."""
    if not values:
        return None
    v = np.zeros(width)
    x = np.array([np.nan if a is None else a for a in values[:width]], float)
    v[: len(x)] = x
    n = float(np.sqrt(v @ v))
    return (v / n).astype(np.float32) if np.isfinite(n) and n > 0 else None


def hilbert_words(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Positions along the Hilbert curve of points with integer coordinates of so many bits (Skilling's transform, all rows at once)."""
    x = x.astype(np.uint64)
    n, d = x.shape
    for k in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << k), np.uint64((1 << k) - 1)
        for i in range(d):
            invert = (x[:, i] & q) != 0
            swap = np.where(invert, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(invert, low, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.uint64)
    for k in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, d - 1] >> np.uint64(k)) & np.uint64(1) != 0, np.uint64((1 << k) - 1), np.uint64(0))
    x ^= flip[:, None]
    # as many planes of bits a word as go into a signed one, the highest first
    planes, words = max(1, 63 // d), []
    for top in range(bits, 0, -planes):
        key = np.zeros(n, np.uint64)
        for b in range(top - 1, max(0, top - planes) - 1, -1):
            for i in range(d):
                key = key << np.uint64(1) | (x[:, i] >> np.uint64(b)) & np.uint64(1)
        words.append(key)
    return words


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """hilbert_words of points whose positions go into one word."""
    (key,) = hilbert_words(x, bits)
    return key


class Curves:
    """Projections, scales and shifts of the orderings, the same in every run over the same rows."""

    def __init__(self, sample: np.ndarray, orderings: int):
        """sample: unit vectors the spectrum is taken from; random directions where there are too few."""
        rng, width = np.random.default_rng(SEED), sample.shape[1]
        d = min(width, DIMENSIONS)
        self.mean = sample.mean(0) if len(sample) else np.zeros(width)
        spread, axes = np.ones(width), np.eye(width)
        if len(sample) > 4 * width:
            values, axes = np.linalg.eigh(np.cov(sample.T))
            spread = np.sqrt(np.maximum(values, 1e-3 * values[-1]))
        self.parts = []
        for _ in range(orderings):
            q, _ = np.linalg.qr(axes @ (rng.normal(size=(width, d)) * spread[:, None]))
            z = (sample - self.mean) @ q
            scale = z.std(0) if len(sample) > 1 else np.ones(d)
            self.parts.append((q.astype(np.float32), np.where(scale > 0, scale, 1.0).astype(np.float32), rng.uniform(0, 1, d).astype(np.float32)))
        self.mean = self.mean.astype(np.float32)

    def keys(self, v: np.ndarray, ordering: int) -> list[np.ndarray]:
        """Curve positions of unit vectors, two words each. Three standard deviations either way fill the curve's cube."""
        q, scale, shift = self.parts[ordering]
        z = ((v - self.mean) @ q / (6 * scale) + 0.5) * 0.8 + 0.2 * shift
        cells = 1 << BITS
        return hilbert_words(np.clip(z * cells, 0, cells - 1).astype(np.int64), BITS)


def _units(part: dict) -> dict:
    """Usable vectors: their values at full width, and a key of their direction."""
    rows = [(i, e, u) for i, e in zip(part["rec_id"], part["embedding"]) if (u := unit(e)) is not None]
    raw = []
    for _, e, _ in rows:
        v = np.zeros(WIDTH, np.float32)
        v[: min(WIDTH, len(e))] = e[:WIDTH]
        raw.append(v.tobytes())
    return {"rec_id": [i for i, *_ in rows], "key": [blake2b((u + np.float32(0)).tobytes(), digest_size=16).digest() for *_, u in rows], "vec": raw}


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, WIDTH)


def _normed(v: np.ndarray) -> np.ndarray:
    x = v.astype(float)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def _orderings(curves: Curves):
    def run(batches):
        for batch in batches:
            ids, v = batch.column("rec_id"), _normed(_matrix(batch.column("vec")))
            if not len(v):
                continue
            small = pa.array([x.tobytes() for x in np.round(v * 32767 / np.abs(v).max(1, keepdims=True)).astype(np.int16)], pa.binary())
            for o in range(len(curves.parts)):
                hi, lo = (k.astype(np.int64) for k in curves.keys(v, o))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), o, np.int32)), pa.array(hi), pa.array(lo), ids, small], ["o", "hi", "lo", "rec_id", "small"])

    return run


def _laid(one: DataFrame, n: int, curves: Curves) -> DataFrame:
    """(o, part, rec_id, small): all orderings, each partition's rows in curve order in one file."""
    parts = max(common.big_partitions(one.sparkSession), -(-n * len(curves.parts) // PARTITION_ROWS))
    # rows of one position lie in another order in each ordering
    laid = one.mapInArrow(_orderings(curves), "o int, hi long, lo long, rec_id long, small binary").withColumn("tie", F.xxhash64("o", "rec_id"))
    laid = laid.repartitionByRange(parts, "o", "hi", "lo", "tie").sortWithinPartitions("o", "hi", "lo", "tie")
    return common.materialize(laid.select("o", F.spark_partition_id().alias("part"), "rec_id", "small"))


def _runs(batch: pa.RecordBatch):
    """(ordering and partition, from, to) of a batch's runs of rows that lie on one curve."""
    o, part = batch.column("o").to_numpy(), batch.column("part").to_numpy()
    cuts = [0, *(np.flatnonzero((np.diff(o) != 0) | (np.diff(part) != 0)) + 1), len(o)]
    return [((int(o[a]), int(part[a])), a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def _places(watched: np.ndarray):
    """(rec_id, o, part, at) of the watched rows: where on which curve they lie."""

    def run(batches):
        where, at = None, 0
        for batch in batches:
            ids = batch.column("rec_id").to_numpy()
            for on, a, b in _runs(batch):
                at = at if on == where else 0
                where = on
                hit = np.flatnonzero(np.isin(ids[a:b], watched))
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a:b][hit]), pa.array(np.full(len(hit), on[0], np.int32)), pa.array(np.full(len(hit), on[1], np.int32)), pa.array(hit + at)], ["rec_id", "o", "part", "at"])
                at += b - a

    return run


def _windows(k: int, floor: float, reach: int):
    """Of rows in curve order: each row's k best among the `reach` rows before and after it, as lists (a, b, s)."""

    def best(v: np.ndarray, ids: np.ndarray, a: int, b: int):
        """Rows a..b against the rows around them; v and ids may begin and end anywhere."""
        lo, hi = max(0, a - reach), min(len(ids), b + reach)
        s = v[a:b] @ v[lo:hi].T
        off = np.arange(lo, hi)[None, :] - np.arange(a, b)[:, None]
        s[(off == 0) | (np.abs(off) > reach)] = -3
        m = min(k, s.shape[1])
        top = np.argpartition(-s, m - 1, axis=1)[:, :m]
        val = np.take_along_axis(s, top, 1)
        good = val >= max(floor, -2)
        n = good.sum(1)
        rows = np.flatnonzero(n)
        ends = np.concatenate(([0], np.cumsum(n[rows]))).astype(np.int32)
        lists = (pa.ListArray.from_arrays(pa.array(ends), pa.array(x[good])) for x in (ids[lo:hi][top], val))
        return pa.RecordBatch.from_arrays([pa.array(ids[a:b][rows]), *lists], ["a", "b", "s"])

    def run(batches):
        held_v, held_i, where, done = np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64), None, 0

        def out(a: int, b: int):
            for at in range(a, b, 512):
                got = best(held_v, held_i, at, min(b, at + 512))
                if got.num_rows:
                    yield got

        for batch in batches:
            ids = batch.column("rec_id").to_numpy()
            q = np.frombuffer(b"".join(batch.column("small").to_pylist()), np.int16).reshape(-1, WIDTH).astype(np.float32)
            q /= np.linalg.norm(q, axis=1, keepdims=True)
            for on, a, b in _runs(batch):
                if on != where:
                    yield from out(done, len(held_i))
                    held_v, held_i, where, done = held_v[:0], held_i[:0], on, 0
                held_v, held_i = np.concatenate((held_v, q[a:b])), np.concatenate((held_i, ids[a:b]))
                ready = len(held_i) - reach
                if ready > done:
                    yield from out(done, ready)
                    drop = max(0, ready - reach)
                    held_v, held_i, done = held_v[drop:], held_i[drop:], ready - drop
        yield from out(done, len(held_i))

    return run


def _merged(k: int):
    """The k best of each row's lists from all windows: (a, b). A pair that several windows show counts once."""

    def run(batches):
        for batch in batches:
            a, lists_b, lists_s = batch.column("a").to_numpy(), batch.column("b"), batch.column("s")
            b, s = lists_b.flatten().flatten().to_numpy(), lists_s.flatten().flatten().to_numpy()
            per = np.array([sum(map(len, x)) for x in lists_b.to_pylist()], np.int64)
            row = np.repeat(np.arange(len(a)), per)
            order = np.lexsort((-s, b, row))
            row, b, s = row[order], b[order], s[order]
            once = np.concatenate((np.ones(min(1, len(b)), bool), (row[1:] != row[:-1]) | (b[1:] != b[:-1])))
            row, b, s = row[once], b[once], s[once]
            order = np.lexsort((b, -s, row))
            row, b = row[order], b[order]
            first = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1)) if len(row) else np.zeros(0, int)
            rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
            yield pa.RecordBatch.from_arrays([pa.array(a[row[rank < k]]), pa.array(b[rank < k])], ["a", "b"])

    return run


def _reranked(part: dict) -> dict:
    a, b = (np.frombuffer(b"".join(part[x]), np.float32).reshape(-1, WIDTH) for x in ("vec_a", "vec_b"))
    return {"a": part["a"], "b": part["b"], "sim": _similarities(a, b).tolist()}


def _similarities(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(float), b.astype(float)
    return (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))


def _blocks(batches):
    """Rows to blocks of BLOCK rows, the last one shorter."""
    ids, vec = [], []

    def block(n: int):
        out = pa.RecordBatch.from_arrays([pa.array([np.array(ids[:n], np.int64).tobytes()], pa.binary()), pa.array([b"".join(vec[:n])], pa.binary())], ["ids", "vecs"])
        del ids[:n], vec[:n]
        return out

    for batch in batches:
        ids += batch.column("rec_id").to_pylist()
        vec += batch.column("vec").to_pylist()
        while len(ids) >= BLOCK:
            yield block(BLOCK)
    if ids:
        yield block(len(ids))


def _best_of_blocks(k: int, floor: float):
    """Of pairs of blocks: the k best in the second ones for each row of a first one, as far as its pairs come one after another."""

    def merge(rows, ids, sims):
        """The k best of each row, ordered by row."""
        order = np.lexsort((ids, -sims, rows))
        rows, ids, sims = rows[order], ids[order], sims[order]
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.zeros(0, int)
        rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.r_[first, len(rows)]))
        return rows[rank < k], ids[rank < k], sims[rank < k]

    def strip(q, q_ids, v, v_ids, held):
        rows, ids, sims = held
        q_raw, v_raw, q, v = q, v, _normed(q), _normed(v)
        # the k-th best so far, where there are k; else the block's own, the row itself left aside
        least = np.full(len(q), floor)
        full = np.bincount(rows, minlength=len(q)) == k
        np.minimum.at(kth := np.full(len(q), np.inf), rows, sims)
        least[full] = np.maximum(least[full], kth[full])
        s = q @ v.T
        new = np.flatnonzero(~full)
        if len(new) and len(v) > k + 1:
            least[new] = np.maximum(least[new], np.partition(s[new], -(k + 1), axis=1)[:, -(k + 1)])
        r, c = np.nonzero(s >= (least - ROUNDING).astype(np.float32)[:, None])
        other = q_ids[r] != v_ids[c]
        r, c = r[other], c[other]
        for at in range(0, len(r), 65_536):
            a, b = r[at : at + 65_536], c[at : at + 65_536]
            exact = _similarities(q_raw[a], v_raw[b])
            keep = exact >= floor
            rows, ids, sims = merge(np.concatenate((rows, a[keep])), np.concatenate((ids, v_ids[b[keep]])), np.concatenate((sims, exact[keep])))
        return rows, ids, sims

    def run(batches):
        whose, q, q_ids, held = None, None, None, []

        def out():
            for i, (rows, ids, sims) in enumerate(held):
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(q_ids[rows + i * STRIP]), pa.array(ids), pa.array(sims)], ["a", "b", "sim"])

        for batch in batches:
            for n in range(batch.num_rows):
                ids_a, vecs_a, ids_b, vecs_b = (batch.column(x)[n].as_buffer() for x in ("ids_a", "vecs_a", "ids_b", "vecs_b"))
                ids = np.frombuffer(ids_a, np.int64)
                if whose != ids[0]:
                    yield from out()
                    whose, q_ids, q = ids[0], ids.copy(), np.frombuffer(vecs_a, np.float32).reshape(-1, WIDTH).copy()
                    held = [(np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)) for _ in range(0, len(q), STRIP)]
                v, v_ids = np.frombuffer(vecs_b, np.float32).reshape(-1, WIDTH), np.frombuffer(ids_b, np.int64)
                for i, at in enumerate(range(0, len(q), STRIP)):
                    held[i] = strip(q[at : at + STRIP], q_ids[at : at + STRIP], v, v_ids, held[i])
        yield from out()

    return run


def _compared(asked: DataFrame, one: DataFrame, k: int, floor: float) -> DataFrame:
    """(a, b, sim): the k rows of one that are most similar to each row of asked, and of at least floor. Exact; every row meets every row."""
    spark = one.sparkSession
    packed = []
    for x, df in (("a", asked), ("b", one)):
        blocks = -(-df.count() // BLOCK)
        parts = max(1, min(blocks, common.big_partitions(spark)) if x == "a" else -(-blocks // HELD))
        made = common.materialize(df.select("rec_id", "vec").repartition(max(1, min(blocks, common.big_partitions(spark)))).mapInArrow(_blocks, "ids binary, vecs binary"))
        packed.append((made, made.select(F.col("ids").alias(f"ids_{x}"), F.col("vecs").alias(f"vecs_{x}")).repartition(parts)))
    (made_a, a), (made_b, b) = packed
    # a row is two blocks: batches have to be short
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "4")
    try:
        pairs = a.crossJoin(b.hint("shuffle_replicate_nl")).mapInArrow(_best_of_blocks(k, floor), "a long, b long, sim double")
        best = common.materialize(pairs)
    finally:
        spark.conf.set(name, before)
    common.drop(made_a, made_b)
    return best


def _picked(one: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, unit vectors) of at most FITTED_ON of n rows, by a hash of their ids.

    A threshold of the hash picks them where they lie; sorting all rows for it would send every task's first ones to a single task.
    """
    share = min(1.0, 1.05 * FITTED_ON / n)
    hashed = F.pmod(F.xxhash64("rec_id"), F.lit(1 << 30))
    t = one.where(hashed <= int(share * (1 << 30))).select("rec_id", hashed.alias("h"), "vec").toArrow().sort_by([("h", "ascending"), ("rec_id", "ascending")]).slice(0, FITTED_ON)
    if not t.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, WIDTH), np.float32)
    return t.column("rec_id").to_numpy(), _normed(_matrix(t.column("vec")))


def _true_neighbours(one: DataFrame, ids: np.ndarray, q: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
    """(probe, neighbour): the k most similar of all rows for each probe, of at least floor."""

    def run(batches):
        sims, near = np.full((len(ids), 0), -3.0, np.float32), np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            other = batch.column("rec_id").to_numpy()
            s = q @ _normed(_matrix(batch.column("vec"))).T
            s[ids[:, None] == other[None, :]] = -3
            sims, near = np.concatenate((sims, s), 1), np.concatenate((near, np.broadcast_to(other, s.shape)), 1)
            if sims.shape[1] > k:
                top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                sims, near = np.take_along_axis(sims, top, 1), np.take_along_axis(near, top, 1)
        r, c = np.nonzero(sims >= max(floor, -2))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(near[r, c]), pa.array(sims[r, c])], ["a", "b", "s"])

    found = one.mapInArrow(run, "a long, b long, s float")
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))).where(F.col("r") <= k)
    return [(r["a"], r["b"]) for r in best.select("a", "b").collect()]  # PROBES x k at most


def _reach(laid: DataFrame, pairs: list[tuple[int, int]], recall: float) -> float:
    """The least reach at which windows show the wanted share of the pairs; infinite where no curve of this layout does."""
    watched = np.unique(np.array(pairs, np.int64).ravel())
    at: dict[int, dict] = {}
    for r in laid.select("o", "part", "rec_id").mapInArrow(_places(watched), "rec_id long, o int, part int, at long").collect():
        at.setdefault(r["rec_id"], {})[r["o"]] = (r["part"], r["at"])
    gaps = []
    for a, b in pairs:
        x, y = at.get(a, {}), at.get(b, {})
        gaps.append(min((abs(x[o][1] - y[o][1]) for o in x.keys() & y.keys() if x[o][0] == y[o][0]), default=np.inf))
    return float(np.quantile(gaps, recall, method="higher"))


def _windowed(one: DataFrame, n: int, k: int, floor: float, orderings: int, recall: float) -> DataFrame | None:
    """(a, b, sim): up to k neighbours b of each row a from the windows, of at least floor; None if windows would meet all rows anyway."""
    reach = LEAST_MET // (2 * orderings)
    if 2 * reach * orderings >= n:
        return None
    ids, sample = _picked(one, n)
    laid = _laid(one, n, Curves(sample, orderings))
    pairs = _true_neighbours(one, ids[:PROBES], sample[:PROBES], k, floor)
    if pairs:
        reach = max(reach, _reach(laid, pairs, recall))
    if 2 * reach * orderings >= n:
        common.drop(laid)
        return None
    lists = laid.mapInArrow(_windows(k + SPARE, floor - SLACK, int(reach)), "a long, b array<long>, s array<float>")
    merged = lists.groupBy("a").agg(F.collect_list("b").alias("b"), F.collect_list("s").alias("s"))  # a list an ordering
    found = common.materialize(merged.mapInArrow(_merged(k + SPARE), "a long, b long"))
    common.drop(laid)
    ends = [one.select(F.col("rec_id").alias(x), F.col("vec").alias(f"vec_{x}")) for x in "ab"]
    exact = common.map_batches(found.join(ends[0], "a").join(ends[1], "b"), _reranked, "a long, b long, sim double", rows=20_000).where(F.col("sim") >= floor)
    exact = common.materialize(exact)
    common.drop(found)
    return exact


def nearest(df: DataFrame, k: int = K, min_similarity: float | None = None, orderings: int | None = None, recall: float = RECALL) -> DataFrame:
    """(rec_id, rank, other, sim): the k most similar other rows of df's (rec_id, embedding), of at least min_similarity if one is given.

    Approximate: windows are as wide as it takes to show `recall` of the neighbours of PROBES rows that were compared with all rows;
    LEAST_MET rows or fewer are compared with one another, exactly. By default there are more orderings where any similarity counts.

    Short embeddings are padded with zeros, long ones cut; null, empty, all-zero and non-finite ones neither have nor are neighbours.
    Ties go to the lower id; rows of one direction are each other's neighbours at 1.0, so of a large group every row names the
    lowest ids. A repeated id counts once for each content.
    """
    spark = df.sparkSession
    rows = common.materialize(common.map_batches(df.select("rec_id", "embedding"), _units, "rec_id long, key binary, vec binary", rows=10_000))
    reps = rows.groupBy("key").agg(F.min("rec_id").alias("rep"))
    members = common.materialize(rows.select("rec_id", "key").join(reps, "key").select("rec_id", "rep").distinct())
    one = common.materialize(rows.join(members.where("rec_id = rep").select("rec_id"), "rec_id", "left_semi").dropDuplicates(["rec_id"]).select("rec_id", "vec"))
    common.drop(rows)
    n = one.count()
    if n == 0:
        return spark.createDataFrame([], "rec_id long, rank int, other long, sim double")
    floor = -2.0 if min_similarity is None else min_similarity
    links = _windowed(one, n, k, floor, orderings or (MORE_ORDERINGS if min_similarity is None else ORDERINGS), recall)
    if links is None:
        links = _compared(one, one, k, floor)
    common.drop(one)
    # a class's k + 1 lowest ids are all that anybody needs of it; they are picked before the shuffle
    w = Window.partitionBy("rep").orderBy("rec_id")
    lowest = members.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1).select("rep", F.col("rec_id").alias("other"))
    own = lowest.select("rep", "other", F.lit(1.0).alias("sim"))
    others = links.join(lowest.withColumnRenamed("rep", "b"), "b").select(F.col("a").alias("rep"), "other", "sim")
    ranked = own.unionByName(others).withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("sim"), "other"))).where(F.col("r") <= k + 1)
    lists = ranked.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("r", "other", "sim"))).alias("best")).where(F.size("best") > 1)
    per = members.join(lists, "rep").select("rec_id", F.slice(F.filter("best", lambda x: x["other"] != F.col("rec_id")), 1, k).alias("best"))
    out = per.select("rec_id", F.posexplode("best").alias("rank", "x"))
    return out.select("rec_id", (F.col("rank") + 1).alias("rank"), F.col("x.other").alias("other"), F.col("x.sim").alias("sim"))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.table(spark, sf_dir, "chunks").where("embedding IS NOT NULL").select(F.col("id").cast("long").alias("rec_id"), "embedding")


def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_id, rank, other, sim): the five most similar for every usable embedding of chunks, sim to six digits."""
    return nearest(_chunks(spark, sf_dir)).withColumn("sim", F.round("sim", 6))


def p5_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_queries, n_true, n_found): how many of the five true neighbours p5_neighbours names of each row whose id is divisible by 100.

    The true ones come from comparing those rows with all rows; equally similar ones count alike.
    """
    rows = _chunks(spark, sf_dir)
    named = common.materialize(nearest(rows).where("rec_id % 100 = 0"))
    usable = common.map_batches(rows, _units, "rec_id long, key binary, vec binary", rows=10_000).select("rec_id", "vec").dropDuplicates(["rec_id"])
    usable = common.materialize(usable)
    best = _compared(usable.where("rec_id % 100 = 0"), usable, K, -2.0)
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))).where(F.col("r") <= K)
    per = best.groupBy(F.col("a").alias("rec_id")).agg(F.count("*").alias("n"), F.min("sim").alias("least"))
    hits = per.join(named.select("rec_id", "sim"), "rec_id", "left").withColumn("hit", (F.col("sim") >= F.col("least") - 1e-9).cast("long"))
    each = hits.groupBy("rec_id").agg(F.first("n").alias("n"), F.least(F.first("n"), F.coalesce(F.sum("hit"), F.lit(0))).alias("found"))
    none = F.lit(0).cast("long")
    return each.agg(F.count("*").alias("n_queries"), F.coalesce(F.sum("n"), none).alias("n_true"), F.coalesce(F.sum("found"), none).alias("n_found"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_a, id_b): pairs at 0.9 or more of which one is among the other's five most similar."""
    best = nearest(_chunks(spark, sf_dir), min_similarity=MIN_SIMILARITY)
    return best.select(F.least("rec_id", "other").alias("id_a"), F.greatest("rec_id", "other").alias("id_b")).distinct()


SQL = {
    "p5_found": """
WITH v AS (SELECT id, list_resize(embedding::DOUBLE[], 64, 0.0::DOUBLE) AS e FROM chunks WHERE embedding IS NOT NULL),
u AS (SELECT id, e FROM v WHERE list_sum(list_transform(e, lambda x: x * x)) > 0),
s AS (SELECT a.id AS x, b.id AS y, list_cosine_similarity(a.e, b.e) AS s FROM u a JOIN u b ON a.id <> b.id),
r AS (SELECT x, y, s, row_number() OVER (PARTITION BY x ORDER BY round(s, 9) DESC, y) AS r FROM s)
SELECT DISTINCT least(x, y) AS id_a, greatest(x, y) AS id_b FROM r WHERE r <= 5 AND s >= 0.9""",
    # exact up to LEAST_MET vectors of different directions
    "p5_neighbours": """
WITH v AS (SELECT id, list_resize(embedding::DOUBLE[], 64, 0.0::DOUBLE) AS e FROM chunks WHERE embedding IS NOT NULL),
u AS (SELECT id, e FROM v WHERE list_sum(list_transform(e, lambda x: x * x)) > 0),
s AS (SELECT a.id AS x, b.id AS y, list_cosine_similarity(a.e, b.e) AS s FROM u a JOIN u b ON a.id <> b.id),
r AS (SELECT x, y, s, row_number() OVER (PARTITION BY x ORDER BY round(s, 9) DESC, y) AS r FROM s)
SELECT x AS rec_id, CAST(r AS INTEGER) AS rank, y AS other, round(s, 6) AS sim FROM r WHERE r <= 5""",
}
QUERIES = {"p5_found": p5_found, "p5_neighbours": p5_neighbours, "p5_recall": p5_recall}
