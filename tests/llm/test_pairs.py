import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from loomtext.llm import common
from loomtext.llm import lookalike as L
from loomtext.llm import neardup as N
from loomtext.llm import neighbours as K


def frame(spark, rows):
    return spark.createDataFrame([("t", i, x, "clash", "clash") for i, x in rows], "tab string, rec_id long, text string, key string, body string")


def sentence(rng, n=60):
    return "".join(rng.choice("肝肾心脾肺胃病痛炎症治疗药量血压温度检查观察") for _ in range(n))


# ---------------------------------------------------------------- look-alikes

SAME = [
    ("ＡＢＣ，１２３", "ABC,123"),
    ("café", "café"),
    ("ﬁn ﬂow", "fin flow"),
    ("⽤⾎", "用血"),
    ("a​b­c️", "abc"),
    ("  a 　  b ", "a b"),
    ("сор", "cop"),
    ("Bитaл", "Витал"),
    ("Αlрhа", "Alpha"),
    ("ЕСG", "ECG"),
    ("a‐b", "a-b"),
    ("不", "不"),
]
OTHER = [("x²", "x2"), ("①", "1"), ("½", "1/2"), ("A", "a"), ("a\nb", "a b"), ("™", "TM"), ("Ⓐ", "A"), ("H₂O", "H2O"), ("mg", "µg"), ("Витал", "Vital")]


def test_same_form():
    for a, b in SAME:
        assert L.one_form(a) == L.one_form(b), (a, b, L.one_form(a), L.one_form(b))
        assert L.one_form(L.one_form(a)) == L.one_form(a)
    for a, b in OTHER:
        assert L.one_form(a) != L.one_form(b), (a, b)


def test_public_shapes(spark):
    shapes = L.public_shapes(spark)
    form = lambda t: L.one_form(t, shapes)
    for a, b in (*SAME, ("ɡoogle", "google"), ("ɑpple", "apple"), ("αpple", "apple"), ("ⲟpen", "open"), ("ꓐook", "Book"), ("νυ", "vu"), ("Ꮪale", "Sale"), ("ｇооɡle", "google"), ("По", "Πο")):
        assert form(a) == form(b), (a, b, form(a), form(b))
        assert form(form(a)) == form(a)
    for a, b in (*OTHER, ("ı", "i"), ("ſ", "f"), ("𝐀", "A"), ("ᴀ", "A"), ("I", "l"), ("O", "0"), ("rn", "m")):
        assert form(a) != form(b), (a, b)
    for t in ("Это русский текст и только.", "Ελληνικά γράμματα", "العربية هنا", "עברית", "漢字と仮名ロ口", "straße", "naïve café"):
        assert form(t) == t, (t, form(t))
    # it works the same where it was sent to
    import pickle

    again = pickle.loads(pickle.dumps(shapes))
    assert L.one_form("Bитaл ɡoogle", again) == form("Bитaл ɡoogle") == "Витал google"


def test_consistent_spelling_is_chosen():
    assert L.one_form("Bитaл") == "Витал" and L.one_form("сор") == "cop" and L.one_form("Витал") == "Витал"
    assert L.one_form(None) is None and L.one_form("") == "" and L.one_form(" ​") == ""


def test_form_column(spark):
    df = spark.createDataFrame([("Ａ", "old"), (None, "x"), ("", "y")], "text string, form string")
    assert [r["form"] for r in L.normalize_lookalikes(df).orderBy("form").collect()] == [None, "", "A"]


def test_found_rows(spark, tmp_path):
    site = [(1, "Ａ b"), (2, "A b"), (3, "A b"), (4, None), (5, " "), (6, "　"), (7, "C"), (8, "A​ b")]
    spark.createDataFrame(site, "id long, raw_text string").write.parquet(f"{tmp_path}/site_documents.parquet")
    spark.createDataFrame([(1, "A b"), (2, "x")], "id long, chunk_text string").write.parquet(f"{tmp_path}/chunks.parquet")
    got = {tuple(r) for r in L.p7_found(spark, str(tmp_path)).collect()}
    assert got == {("site_documents", a, b) for a, b in ((1, 2), (1, 3), (1, 8), (2, 8), (3, 8))}
    cls = {(r["tab"], r["rec_id"]): r["class_id"] for r in L.p7_classes(spark, str(tmp_path)).collect()}
    assert cls[("site_documents", 8)] == 1 and cls[("chunks", 1)] == 1 and len(cls) == 9
    spark.createDataFrame([], "id long, raw_text string").write.mode("overwrite").parquet(f"{tmp_path}/site_documents.parquet")
    assert L.p7_found(spark, str(tmp_path)).count() == 0


# ---------------------------------------------------------------- near duplicates


def brute(rows):
    sets = {i: {c[k : k + 5] for k in range(max(1, len(c) - 4))} for i, x in rows if x is not None and (c := N.content(x))}
    out = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n / (len(sets[a]) + len(sets[b]) - n) >= N.THRESHOLD:
            out.add((a, b))
    return out


def pairs(members, links):
    groups = {}
    for r in members.collect():
        groups.setdefault(r["rep"], []).append(r["rec_id"])
    out = {tuple(sorted(p)) for ids in groups.values() for p in itertools.combinations(ids, 2)}
    for r in links.collect():
        out |= {tuple(sorted(p)) for p in itertools.product(groups[r["a"]], groups[r["b"]])}
    return out


def test_similarity_is_exact():
    rng = random.Random(5)
    for _ in range(50):
        a = sentence(rng, 80)
        b = a[:40] + sentence(rng, 3) + a[40:]
        x, y = ({t[k : k + 5] for k in range(len(t) - 4)} for t in (a, b))
        assert abs(N.similarity(a, b) - len(x & y) / len(x | y)) < 1e-12
    assert N.similarity("ＡＢＣＤＥ！", "abcde") == 1.0


def test_versions_are_found(spark):
    rng = random.Random(7)
    rows = []
    for g in range(40):
        base = sentence(rng, rng.choice((40, 90, 300)))
        rows.append(base)
        for _ in range(rng.randrange(0, 4)):
            cut = rng.randrange(len(base))
            rows.append(rng.choice((base, base[:cut] + sentence(rng, 2) + base[cut:], base[: len(base) // 2] + "！ " + base[len(base) // 2 :])))
    rows = list(enumerate(rows)) + [(900, None), (901, ""), (902, "……"), (903, "……"), (904, "ab"), (905, "AB"), (906, "x" * 50_000)]
    got = pairs(*N.near_duplicates(frame(spark, rows)))
    assert brute(rows) <= got and got - brute(rows) <= {(902, 903)}


def test_hot_group_of_copies_is_linear(spark):
    rng = random.Random(8)
    hot = sentence(rng, 100)
    rows = [(i, hot if i % 3 == 0 else sentence(rng, 100)) for i in range(1500)] + [(5000, hot[:50] + "新" + hot[50:])]
    members, links = N.near_duplicates(frame(spark, rows))
    assert members.count() == len(rows) and members.where("rep = 0").count() == 500
    assert [(r["a"], r["b"]) for r in links.collect()] == [(0, 5000)]


def test_near_duplicates_of_nothing(spark):
    members, links = N.near_duplicates(frame(spark, [(1, "x")]).where("false"))
    assert members.count() == 0 and links.count() == 0
    members, links = N.near_duplicates(frame(spark, [(1, None)]))
    assert members.count() == 0 and links.count() == 0


def test_paths_complete_the_pairs(spark):
    # all members lie near the first; the pairs among them come over it
    rng = random.Random(9)
    base = sentence(rng, 400)
    rows = [(i, base[: 20 * i] + "甲乙丙"[i % 3] + base[20 * i :]) for i in range(1, 12)]
    assert pairs(*N.near_duplicates(frame(spark, rows))) == brute(rows)


def test_many_revised_copies_have_linear_edges(spark):
    rng = random.Random(11)
    base = sentence(rng, 300)
    rows = [(i, base[: i % 290] + f"{i:05d}" + base[i % 290 :]) for i in range(20_000)]
    df = frame(spark, rows + [(90_000, sentence(rng, 300)), (90_001, None)]).repartition(4)
    stars = N.Stars(df)
    assert stars.edges.count() < 6 * len(rows)
    got = {r["rec_id"]: r["class_id"] for r in stars.classes(N.THRESHOLD).collect()}
    assert len(got) == len(rows) + 1 and {got[i] for i in range(20_000)} == {0} and got[90_000] == 90_000


def test_no_bucket_keeps_unlike_rows(spark):
    # many unlike families behind one opening: they share buckets, and every family is found
    rng = random.Random(12)
    opening = sentence(rng, 150)
    rows = []
    for g in range(60):
        base = opening + sentence(rng, 80)
        rows += [(10 * g, base), (10 * g + 1, base[:170] + "新" + base[170:])]
    got = pairs(*N.near_duplicates(frame(spark, rows)))
    assert got == brute(rows)


def test_connected(spark):
    edges = [(1, a, a + 1) for a in range(40)] + [(1, 100, 200), (2, 5, 7)]
    got = {(r["t"], r["rec_id"]): r["class_id"] for r in N.connected(spark.createDataFrame(edges, "t int, a long, b long")).collect()}
    assert got == {(1, i): 0 for i in range(41)} | {(1, 100): 100, (1, 200): 100, (2, 5): 5, (2, 7): 5}


def broadcast_rows(spark, run):
    """Rows that every broadcast of the queries in run() had."""
    bus = spark.sparkContext._jsc.sc().listenerBus()
    store = spark._jsparkSession.sharedState().statusStore()

    def items(seq):
        return [seq.apply(i) for i in range(seq.size())]

    bus.waitUntilEmpty(30_000)
    before = {e.executionId() for e in items(store.executionsList())}
    run()
    bus.waitUntilEmpty(30_000)
    out = []
    for e in items(store.executionsList()):
        if e.executionId() in before:
            continue
        values = store.executionMetrics(e.executionId())
        for node in items(store.planGraph(e.executionId()).allNodes()):
            if node.name().startswith("BroadcastExchange"):
                got = [values.get(m.accumulatorId()) for m in items(node.metrics()) if m.name() == "number of output rows"]
                out += [int(x.get().replace(",", "")) for x in got if x.isDefined()]
    return out


def test_growing_tables_are_not_broadcast(spark):
    # scratch tables are small as files: their rows would pass through the driver, however many they are
    rng = random.Random(13)
    rows = []
    for g in range(200):
        base = sentence(rng, 120)
        rows += [(10 * g, base), (10 * g + 1, base), (10 * g + 2, base[:60] + "新" + base[60:]), (10 * g + 3, base[:90] + "旧" + base[90:])]
    got = {}

    def run():
        members, links = N.near_duplicates(frame(spark, rows))
        got["pairs"] = pairs(members, links)
        got["classes"] = N.version_classes(frame(spark, rows)).collect()

    sent = broadcast_rows(spark, run)
    assert got["pairs"] == brute(rows) and all(r["class_id"] == r["rec_id"] // 10 * 10 for r in got["classes"])
    assert max(sent, default=0) <= len(rows) // 100


def test_pairs_are_unfolded_without_broadcasts(spark, small):
    # what the query joins after the classes: members and links
    sent = broadcast_rows(spark, lambda: N.p1_found(spark, small).collect())
    assert max(sent, default=0) <= 1


def test_signatures_estimate_similarity():
    rng = random.Random(10)
    a = sentence(rng, 600)
    b = a[:500] + sentence(rng, 100)
    s = N.signatures([N.content(a), N.content(b)])
    assert abs((s[0] == s[1]).mean() - N.similarity(a, b)) < 0.15 and (s < (1 << 33)).all()


# ---------------------------------------------------------------- nearest vectors


def vectors(spark, x, more=()):
    rows = [(int(i), [float(v) for v in e]) for i, e in enumerate(x)] + list(more)
    return spark.createDataFrame(rows, "rec_id long, embedding array<float>").withColumn("vec", F.lit("clash"))


def brute_nearest(x, k, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return {(i, int(j)) for i in range(len(x)) for j in np.argsort(-s[i], kind="stable")[:k] if s[i, j] >= least}


def test_recall_of_the_curves(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(300, 64))
    x = np.concatenate([centres + rng.normal(scale=0.15, size=centres.shape) for _ in range(4)])
    got = {(r["rec_id"], r["other"]) for r in K.nearest(vectors(spark, x), min_similarity=0.9).collect()}
    want = brute_nearest(x, 5, 0.9)
    assert len(want) > 2000 and len(got & want) >= 0.95 * len(want) and not got - want


def test_dense_group_larger_than_a_window(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=64)
    x = np.array([K.unit(list(v)) for v in np.concatenate([centre + rng.normal(scale=0.2, size=(4000, 64)), rng.normal(size=(1000, 64))])])
    got = {(r["rec_id"], r["other"]) for r in K.nearest(vectors(spark, x), min_similarity=0.9).collect()}
    assert got == brute_nearest(x.astype(float), 5, 0.9) and len(got) == 20_000


def recall_of(spark, x, **how):
    u = np.array([K.unit(list(v)) for v in x])
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = np.argpartition(-s, 5, axis=1)[:, :5]
    got = {}
    for r in K.nearest(vectors(spark, u), **how).collect():
        got.setdefault(r["rec_id"], set()).add(r["other"])
    return sum(len(set(want[i].tolist()) & got.get(i, set())) for i in range(len(u))) / (5 * len(u))


def test_windows_without_a_least_similarity(spark):
    # nothing to go by but the windows: even vectors, beyond what is compared exactly
    x = np.random.default_rng(5).normal(size=(12_000, 64)) * np.linspace(1.5, 0.5, 64)
    assert recall_of(spark, x) >= 0.9


def test_windows_tell_a_dense_group_apart(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=64)
    for scale in (0.2, 0.01):
        x = np.concatenate([centre + rng.normal(scale=scale, size=(4000, 64)), rng.normal(size=(8000, 64))])
        assert recall_of(spark, x) >= 0.9


def test_neighbours_without_a_least_similarity(spark):
    x = np.array([K.unit(list(v)) for v in np.random.default_rng(4).normal(size=(5000, 64))])
    got = {}
    for r in K.nearest(vectors(spark, x), min_similarity=None).collect():
        got.setdefault(r["rec_id"], []).append((r["rank"], r["other"]))
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    assert {i: [o for _, o in sorted(v)] for i, v in got.items()} == {i: np.argsort(-s[i])[:5].tolist() for i in range(5000)}


def test_every_usable_embedding_has_neighbours(spark, small):
    per = K.p5_neighbours(spark, small).groupBy("rec_id").count().collect()
    usable = K._chunks(spark, small).collect()
    assert {r["rec_id"] for r in per} == {r["rec_id"] for r in usable if K.unit(r["embedding"]) is not None} and {r["count"] for r in per} == {5}


def test_hilbert_is_a_walk_through_all_cells():
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        order = cells[np.argsort(K.hilbert(cells, bits))]
        assert sorted(K.hilbert(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_unusable_and_copied_vectors(spark):
    one = [1.0] + [0.0] * 63
    near = [1.0, 0.1] + [0.0] * 62
    more = [(100 + i, one) for i in range(8)] + [(200, near), (201, None), (202, [0.0] * 64), (203, [2.0]), (204, one + [9.0] * 10), (205, [float("nan")] * 64), (206, [])]
    got = {}
    for r in K.nearest(vectors(spark, np.zeros((0, 64)), more)).collect():
        got.setdefault(r["rec_id"], []).append((r["rank"], r["other"]))
    lists = {k: [o for _, o in sorted(v)] for k, v in got.items()}
    copies = [100, 101, 102, 103, 104, 105, 106, 107, 203, 204]
    assert set(lists) == {*copies, 200}
    for i in copies:
        assert lists[i] == [c for c in copies if c != i][:5]
    assert lists[200] == copies[:5]
    assert K.nearest(vectors(spark, np.zeros((0, 64)), [(1, None)])).count() == 0


def test_common_batches(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(50)] + [(99, None)], "i int, text string")
    sizes = common.map_batches(df, lambda p: {"n": [len(p["i"])]}, "n long", rows=7, chars=100).agg(F.sum("n"), F.max("n")).first()
    assert sizes[0] == 51 and sizes[1] <= 7
