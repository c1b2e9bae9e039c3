"""Problem 1: rows that are versions of one another.

One-permutation hashing: every distinct 5-character window of a text is hashed once, the hash names a bin and a value, and the
bins' least values are the signature; empty bins borrow from full ones by optimal densification (each draws its own
donor from a universal hash). Bands of the signature are buckets. Within a bucket only star edges to its least row are
candidates, so candidates are linear in the rows; rows that turn out unlike their star's centre form the next star, until no
bucket holds any. Exact similarity decides. Classes come from the stars alone. Where all pairs are asked for, two rows tied to one
centre are compared too, if their similarities to it allow the threshold: one less the similarity is a metric.
Rows of equal content are folded to one representative before anything else and unfolded at the end.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .lookalike import Shapes, one_form, public_shapes

WIDTH = 5
THRESHOLD = 0.7
#: Bands and values per band: of pairs at 0.75 all but one in 3,000 share a bucket, of pairs at 0.2 one in 100 does.
BANDS, ROWS = 30, 5
BINS = BANDS * ROWS
#: How many times as many centres a bucket has in each further round.
GROWTH = 8
#: Edges of one centre that go to one task: the contents of busier centres are sent to several.
EDGES_A_TASK = 5000
SKETCHED = 64
#: Share of sketch values that must agree before contents are compared: six standard deviations under a pair at 0.75.
LIKELY = 0.45

#: How contents travel: two bytes an ideograph, one a plain letter.
PACKED = "gb18030"

_NOT_ALNUM = re.compile(r"[\W_]+")
_POWERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_EMPTY = np.uint64(1) << np.uint64(40)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def content(text: str, shapes: Shapes | None = None) -> str:
    """Letters and digits of the text's common form in lower case, what similarity is measured on."""
    return _NOT_ALNUM.sub("", one_form(text, shapes).lower())


def windows(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(string index, 64-bit window hash) of every window, repeats included. A string shorter than a window is its own window."""
    padded = [s if len(s) >= WIDTH else s + "\0" * (WIDTH - len(s)) for s in strings]
    sizes = np.array([len(s) for s in padded], np.int64)
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(padded)), sizes)
    if not len(codes):
        return of, codes
    n = len(codes) - WIDTH + 1
    h = np.zeros(n, np.uint64)
    for k in range(WIDTH):
        h += codes[k : k + n] * _POWERS[k]
    inside = of[:n] == of[WIDTH - 1 :]
    return of[:n][inside], _mix(h[inside])


def signatures(strings: list[str]) -> np.ndarray:
    """Densified one-permutation signatures, one row of BINS values for each string."""
    of, h = windows(strings)
    sig = np.full(len(strings) * BINS, _EMPTY, np.uint64)
    bins = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    np.minimum.at(sig, of * BINS + bins.astype(np.int64), h & np.uint64(0xFFFFFFFF))
    sig = sig.reshape(len(strings), BINS)
    full = sig < _EMPTY
    row, at = np.nonzero(~full)
    draw = 0
    while len(row):
        draw += 1
        donor = (_mix(at.astype(np.uint64) * _POWERS[1] + _POWERS[2:3] * np.uint64(draw)) % np.uint64(BINS)).astype(np.int64)
        got = full[row, donor]
        sig[row[got], at[got]] = sig[row[got], donor[got]]
        row, at = row[~got], at[~got]
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    """One 40-bit bucket key for each band; the band's number is part of it."""
    h = np.zeros((len(sig), BANDS), np.uint64)
    parts = sig.reshape(len(sig), BANDS, ROWS)
    for k in range(ROWS):
        h = _mix(h + (parts[:, :, k] + np.uint64(1)) * _POWERS[k])
    # 40 bits are less to shuffle: of ten billion keys one in a hundred shares a bucket by accident, which costs a look at its sketch
    return (_mix(h + np.arange(1, BANDS + 1, dtype=np.uint64) * _POWERS[3]) >> np.uint64(24)).view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct hashes."""
    both = np.concatenate((a, b))
    both.sort()
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return same / (len(both) - same) if len(both) else 1.0


def similarity(a: str, b: str) -> float:
    """The exact similarity of two texts."""
    return jaccard(*(np.unique(windows([content(x)])[1]) for x in (a, b)))


def sketches(sig: np.ndarray) -> np.ndarray:
    """Four bits of the first SKETCHED signature values, two to a byte."""
    low = (_mix(sig[:, :SKETCHED] + _POWERS[4]) & np.uint64(15)).astype(np.uint8)
    return low[:, ::2] << 4 | low[:, 1::2]


def _rows(part: dict, shapes: Shapes) -> dict:
    body = [content(t, shapes) for t in part["text"]]
    # texts without a letter or digit are alike only if their forms are equal
    key = [blake2b((c or "\0" + one_form(t, shapes)).encode("utf-8", "surrogatepass"), digest_size=16).digest() for c, t in zip(body, part["text"])]
    sig = signatures(body)
    # five bytes a band
    b = np.ascontiguousarray(bands(sig)).view(np.uint8).reshape(len(sig), BANDS, 8)[:, :, :5]
    return {"tab": part["tab"], "rec_id": part["rec_id"], "key": key, "body": [c.encode(PACKED) for c in body], "bands": [x.tobytes() for x in b], "sketch": [x.tobytes() for x in sketches(sig)]}


def _near(part: dict) -> dict:
    """Edges whose sketches agree so rarely that the similarity can't reach the threshold have likely = False."""
    a, b = (np.frombuffer(b"".join(part[x]), np.uint8).reshape(-1, SKETCHED // 2) for x in ("sketch_a", "sketch_b"))
    x = a ^ b
    agree = ((x >> 4) == 0).sum(1) + ((x & 15) == 0).sum(1)
    return {"t": part["t"], "a": part["a"], "b": part["b"], "likely": (agree >= LIKELY * SKETCHED).tolist()}


def _checked(part: dict) -> dict:
    """Edges with both contents to edges with similarity; each distinct string is windowed once per slice."""
    at: dict[bytes, int] = {}
    for s in (*part["body_a"], *part["body_b"]):
        at.setdefault(s, len(at))
    of, h = windows([s.decode(PACKED) for s in at])
    cut = np.searchsorted(of, np.arange(len(at) + 1))
    sets = [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    sims = [jaccard(sets[at[a]], sets[at[b]]) for a, b in zip(part["body_a"], part["body_b"])]
    return {"t": part["t"], "a": part["a"], "b": part["b"], "sim": sims}


def _grows(df: DataFrame) -> DataFrame:
    """df as a side of a join by sorting both sides, for tables of as many rows as the input has, or as it has edges.

    Spark would judge a scratch table by its compressed files, far less than its rows take, and send it through the driver whole.
    """
    return df.hint("merge")


def _salted(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges with a part number, (t, a, parts) of the centres whose edges fill more than one part)."""
    busy = edges.groupBy("t", "a").agg(F.ceil(F.count("*") / EDGES_A_TASK).cast("int").alias("parts")).where("parts > 1")
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")
    return edges.join(busy, ["t", "a"], "left").withColumn("part", part).drop("parts"), busy


def _with(edges: DataFrame, of: DataFrame, col: str) -> DataFrame:
    """The edges with a column of their two ends. A busy centre's value is sent once to each part of its edges."""
    edges, busy = _salted(edges)
    ends = [of.select("t", F.col("rec_id").alias(x), F.col(col).alias(f"{col}_{x}")) for x in "ab"]
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    centres = ends[0].join(busy, ["t", "a"], "left").withColumn("part", F.explode(parts)).drop("parts")
    return edges.join(_grows(centres), ["t", "a", "part"]).join(_grows(ends[1]), ["t", "b"]).drop("part")


def _exact(edges: DataFrame, bodies: DataFrame) -> DataFrame:
    """(t, a, b, sim) of edges, sim exact. Only the contents that edges name are shuffled to them."""
    named = edges.select("t", F.explode(F.array("a", "b")).alias("rec_id")).distinct()
    own = common.materialize(bodies.join(_grows(named), ["t", "rec_id"], "left_semi").dropDuplicates(["t", "rec_id"]))
    return common.map_batches(_with(edges, own, "body"), _checked, "t int, a long, b long, sim double", rows=1000, text="body_a")


class Stars:
    """What every result starts from: members, checked star edges, and what is needed to check more."""

    def __init__(self, df: DataFrame):
        schema = "tab string, rec_id long, key binary, body binary, bands binary, sketch binary"
        shapes = public_shapes(df.sparkSession)
        rows = common.materialize(common.map_batches(df.where(F.col("text").isNotNull()).select("tab", "rec_id", "text"), lambda part: _rows(part, shapes), schema))
        # a class's copies are folded before the shuffle where they meet in one task
        reps = rows.groupBy("tab", "key").agg(F.min("rec_id").alias("rep"))
        #: (tab, rec_id, rep) of every row.
        self.members = common.materialize(rows.select("tab", "rec_id", "key").join(_grows(reps), ["tab", "key"]).select("tab", "rec_id", "rep").distinct())
        own = self.members.where("rec_id = rep").select("tab", "rec_id")
        # tables are few; a number is less to shuffle than a name
        self.tabs = sorted(r["tab"] for r in self.members.select("tab").distinct().collect())
        nodes = rows.where(F.length("body") > 0).select("tab", "rec_id", "bands", "sketch").join(_grows(own), ["tab", "rec_id"], "left_semi").dropDuplicates(["tab", "rec_id"])
        nodes = common.materialize(nodes.select(self._number().alias("t"), "rec_id", "bands", "sketch"))
        keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.conv(F.hex(F.substr("bands", i * 5 + 1, F.lit(5))), 16, 10).cast("long"))
        #: (t, rec_id, sketch) of the representatives that have letters or digits, and (t, rec_id, body) of all rows.
        self.nodes, self.bodies = nodes.select("t", "rec_id", "sketch"), rows.select(self._number().alias("t"), "rec_id", "body")
        self.edges, self.rounds = self._drawn(nodes.select("t", "rec_id", F.explode(keys).alias("bucket")))

    def _number(self):
        return F.array_position(F.lit(self.tabs), F.col("tab")).cast("int") if self.tabs else F.lit(0)

    def name(self):
        return F.element_at(F.lit(self.tabs), F.col("t")) if self.tabs else F.lit(None).cast("string")

    def likely(self, edges: DataFrame) -> DataFrame:
        """(t, a, b, likely). Both ends meet their sketches in one join; edges are fewer than rows."""
        ends = edges.select("t", "a", "b", F.explode(F.array("a", "b")).alias("rec_id")).join(_grows(self.nodes), ["t", "rec_id"])
        # a is the lesser end
        pairs = ends.groupBy("t", "a", "b").agg(F.min_by("sketch", "rec_id").alias("sketch_a"), F.max_by("sketch", "rec_id").alias("sketch_b"))
        return common.map_batches(pairs, _near, "t int, a long, b long, likely boolean", rows=20_000)

    def _drawn(self, held: DataFrame) -> tuple[DataFrame, int]:
        """(t, a, b, sim) of the star edges whose sketches are alike, whatever their similarity, and the rounds it took.

        A bucket's least row is its first centre; rows whose sketch is unlike it stay for the next round, in which the bucket has
        GROWTH times as many centres. A row leaves a bucket with the first round that ties it to a centre or makes it one.
        """
        checked, written, rounds, n = None, [], 0, 1
        while True:
            if n == 1:
                centres = held.groupBy("t", "bucket").agg(F.min("rec_id").alias("a"), F.count("*").alias("n")).where("n > 1").select("t", "bucket", "a")
            else:
                w = Window.partitionBy("t", "bucket").orderBy("rec_id")
                centres = held.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).select("t", "bucket", F.col("rec_id").alias("a"))
            stars = common.materialize(held.join(_grows(centres), ["t", "bucket"]).where("rec_id > a").select("t", "bucket", "a", F.col("rec_id").alias("b")))
            written.append(stars)
            if checked is not None and not stars.limit(1).count():
                break
            rounds += 1
            edges = stars.select("t", "a", "b").distinct()
            if checked is not None:
                edges = edges.join(_grows(checked), ["t", "a", "b"], "left_anti")
            fresh = common.materialize(self.likely(edges))
            checked = fresh if checked is None else checked.unionByName(fresh)
            tied = stars.join(_grows(checked), ["t", "a", "b"]).groupBy("t", "bucket", F.col("b").alias("rec_id")).agg(F.bool_or("likely").alias("tied"))
            # every row but the last centre has an edge to one, so the bucket's last centres are among the tails of edges
            held = tied.where("NOT tied").select("t", "bucket", "rec_id").join(_grows(stars.select("t", "bucket", F.col("a").alias("rec_id"))), ["t", "bucket", "rec_id"], "left_anti")
            held = common.materialize(held)
            written += [fresh, held]
            n *= GROWTH
        edges = common.materialize(_exact(checked.where("likely").select("t", "a", "b"), self.bodies))
        common.drop(*written)
        return edges, rounds

    def links(self, threshold: float) -> DataFrame:
        """(tab, a, b, sim) of all pairs of representatives of at least the threshold: as many rows as there are such pairs."""
        ties = self.edges.select("t", F.col("a").alias("mid"), F.col("b").alias("end"), "sim").unionByName(self.edges.select("t", F.col("b").alias("mid"), F.col("a").alias("end"), "sim"))
        # rows of one centre meet in parts of it, so that a busy centre is no single task
        parts = ties.groupBy("t", "mid").agg(F.ceil(F.count("*") / EDGES_A_TASK).cast("int").alias("parts")).where("parts > 1")
        left = ties.select("t", "mid", F.col("end").alias("a"), F.col("sim").alias("sim_a")).join(parts, ["t", "mid"], "left")
        left = left.withColumn("part", F.pmod(F.xxhash64("a"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        right = ties.select("t", "mid", F.col("end").alias("b"), F.col("sim").alias("sim_b")).join(parts, ["t", "mid"], "left")
        right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        # the similarity of two ends differs from a common neighbour's by no more than one of them falls short of it
        able = (F.abs(F.col("sim_a") - F.col("sim_b")) <= 1 - threshold + 1e-9) & (F.col("sim_a") + F.col("sim_b") > 0)
        paths = left.join(_grows(right), ["t", "mid", "part"]).where((F.col("a") < F.col("b")) & able).select("t", "a", "b").distinct()
        more = common.materialize(paths.join(_grows(self.edges.select("t", "a", "b")), ["t", "a", "b"], "left_anti"))
        more = common.materialize(self.likely(more).where("likely").select("t", "a", "b"))
        links = self.edges.unionByName(_exact(more, self.bodies)).where(F.col("sim") >= threshold)
        return common.materialize(links).select(self.name().alias("tab"), "a", "b", "sim")

    def classes(self, threshold: float) -> DataFrame:
        """(tab, rec_id, rep, class_id): class_id is the least representative that star edges of the threshold lead to. Linear in the rows."""
        edges = self.edges.where(F.col("sim") >= threshold).select("t", "a", "b")
        least = common.materialize(connected(edges))
        cls = least.select(self.name().alias("tab"), F.col("rec_id").alias("rep"), "class_id")
        return self.members.join(_grows(cls), ["tab", "rep"], "left").select("tab", "rec_id", "rep", F.coalesce("class_id", "rep").alias("class_id"))


def connected(edges: DataFrame) -> DataFrame:
    """(t, rec_id, class_id) of the nodes of edges (t, a, b): class_id is the least node of a node's component.

    Every node points to the least node it knows of, and to what that one points to, until nothing changes; paths halve each round.
    """
    both = common.materialize(edges.select("t", F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select("t", F.col("b").alias("x"), F.col("a").alias("y"))).distinct())
    to = common.materialize(both.groupBy("t", "x").agg(F.least(F.col("x"), F.min("y")).alias("c")))
    while True:
        # the least of what the neighbours point to
        near = both.join(_grows(to.select("t", F.col("x").alias("y"), F.col("c").alias("cy"))), ["t", "y"]).groupBy("t", "x").agg(F.min("cy").alias("m"))
        low = to.join(_grows(near), ["t", "x"]).select("t", "x", F.least("c", "m").alias("c"), F.col("c").alias("was"))
        # and what a node's own target points to
        jump = to.select("t", F.col("x").alias("c"), F.col("c").alias("cc"))
        new = common.materialize(low.join(_grows(jump), ["t", "c"], "left").select("t", "x", F.least("c", F.coalesce("cc", "c")).alias("c"), "was"))
        changed = new.where("c <> was").limit(1).count()
        common.drop(to)
        to = new.drop("was")
        if not changed:
            common.drop(both)
            return to.select("t", F.col("x").alias("rec_id"), F.col("c").alias("class_id"))


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, links) of df's (tab, rec_id, text) rows.

    members (tab, rec_id, rep): every row of non-null text with its class's least id; a class is the rows of equal content.
    links (tab, a, b, sim): pairs of representatives a < b of one table with similarity >= threshold.
    Null texts are in neither. Texts without letters or digits have a class by their form and no links. Repeated rows of one
    id and content collapse; an id is expected to name one text of its table. Empty input gives two empty frames.
    """
    stars = Stars(df)
    return stars.members, stars.links(threshold)


def version_classes(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(tab, rec_id, rep, class_id) of df's (tab, rec_id, text) rows of non-null text: rep is the least id of equal content, class_id
    the least id that star edges of the threshold lead to. Edges are linear in the rows: n revised copies of a text have n edges,
    not n * n. Rows and cases otherwise as in near_duplicates.
    """
    return Stars(df).classes(threshold)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, id_a, id_b): the pairs of rows at or above the threshold, copies unfolded."""
    members, links = near_duplicates(common.texts(spark, sf_dir).where(F.col("text").rlike(r"(?U)\S")))
    a = members.select("tab", F.col("rep").alias("a"), F.col("rec_id").alias("x"))
    b = members.select("tab", F.col("rep").alias("b"), F.col("rec_id").alias("y"))
    across = links.join(_grows(a), ["tab", "a"]).join(_grows(b), ["tab", "b"]).select("tab", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    copied = members.where("rec_id <> rep").select("tab", F.col("rep").alias("a")).distinct()
    same = a.join(_grows(copied), ["tab", "a"], "left_semi").join(_grows(b.withColumnRenamed("b", "a")), ["tab", "a"]).where("x < y").select("tab", F.col("x").alias("id_a"), F.col("y").alias("id_b"))
    return across.unionByName(same)


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id, rep, class_id): every row with its class of equal content and its class of versions. Linear in the rows."""
    return version_classes(common.texts(spark, sf_dir))


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes}
