import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.config import EmbeddingConfig
from loomtext.operators import embed as E

TEXTS = ["病因 治疗", "治疗 方案", "病因 分析 报告", "drug dose", "drug study dose", "study report", "治疗 drug"] * 3


def test_fit_has_the_exact_singular_values(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [("",), (None,)], "text string")
    m = E.fit_lsa(df, config=EmbeddingConfig(dim=6, components=4))
    from loomtext.functions import text as T

    lists = [r[0] for r in df.where("text IS NOT NULL").select(T.terms(F.col("text"))).collect()]
    d, c, w = m.rows(lists)
    x = np.zeros((len(lists), len(m.idf)))
    x[d, c] = w
    values = np.linalg.svd(x, compute_uv=False)[:4]
    got = np.linalg.norm(x @ m.components, axis=0)
    assert np.allclose(np.sort(got)[::-1], values, rtol=1e-6)
    v = np.array([r[0] for r in df.select(m.embed(F.col("text"))).collect()])
    norms = np.linalg.norm(v, axis=1)
    assert v.shape == (len(TEXTS) + 2, 6) and np.allclose(norms[:-2], 1, atol=1e-5) and (norms[-2:] == 0).all()
    assert (v[:, 4:] == 0).all()


def test_components_never_meet_the_driver(spark, monkeypatch):
    import pickle

    from loomtext.operators import latent as L

    monkeypatch.setattr(L, "SLAB", 64)
    monkeypatch.setattr(L, "BLOCK", 7)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) if x < 5000) for _ in range(80)]
    m, packed = E.fit_packed(df := spark.createDataFrame(list(enumerate(texts)), "id long, text string"), config=EmbeddingConfig(dim=75), keep=("id",))
    # the matrix of features x components is in files, in rows and columns that a task holds by themselves
    assert len(m.blocks.slabs) > 5 and len(m.blocks.parts) == 11
    assert len(pickle.dumps(m)) < m.components.nbytes / 4
    got = {r["id"]: r["embedding"] for r in m.embed_packed(packed).collect()}
    again = {r["id"]: r["v"] for r in df.select("id", m.embed(F.col("text")).alias("v")).collect()}
    v = np.array([got[i] for i in range(80)])
    assert np.allclose(v, [again[i] for i in range(80)], atol=1e-5)
    d, c, w = m.rows([t.split() for t in texts])
    x = np.zeros((80, len(m.idf)))
    x[d, c] = w
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    want = u[:, :75] * s[:75]
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(v @ v.T, want @ want.T, atol=1e-4)


def test_a_half_replaced_matrix_is_made_anew(spark, monkeypatch):
    from loomtext.operators import latent as L

    made, real = [], L._decompose

    def lost(spark, uri, *rest):
        made.append(uri)
        if len(made) == 1:
            raise RuntimeError("HalfReplacedError: lost")
        return real(spark, uri, *rest)

    monkeypatch.setattr(L, "_decompose", lost)
    m = E.fit_lsa(spark.createDataFrame([(t,) for t in TEXTS], "text string"), config=EmbeddingConfig(dim=3))
    assert len(set(made)) == 2 and m.components.shape[1] == 3
    q = L.Blocks(m.blocks.uri, 10, 2, 5)
    q.write(0, 0, np.ones((5, 2)))
    assert q.there([(0, 0)]) and not q.there([(1, 0)])
    with pytest.raises(L.HalfReplacedError):
        q.there([(0, 0), (1, 0)])


def test_model_survives_saving(spark, tmp_path):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    m = E.fit_lsa(df, config=EmbeddingConfig(dim=4, components=3))
    m.save(spark, str(tmp_path))
    n = E.LsaModel.load(spark, str(tmp_path))
    assert n.version == m.version and np.allclose(n.embed_query(spark, "病因 drug"), m.embed_query(spark, "病因 drug"))


def test_tiny_corpora(spark):
    for texts in ([], ["病"], ["a", "a"]):
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        m = E.fit_lsa(df, config=EmbeddingConfig(dim=3))
        assert len(m.embed_query(spark, "病 a")) == 3


def test_max_features(spark):
    df = spark.createDataFrame([("b a a c",), ("a b",)], "text string")
    assert set(E.fit_lsa(df, config=EmbeddingConfig(dim=2, max_features=2)).vocabulary) == {"a", "b"}


def test_term_weights_by_either_way(spark, monkeypatch):
    import math

    docs = {1: "a b b", 2: "a c", 3: "a", 4: "", 5: "病因 病"}
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs.items()] + [(6, None, "clash")], "id long, text string, term string")
    got = {}
    for most in (300_000, 0):
        monkeypatch.setattr(E, "BROADCAST_TERMS", most)
        monkeypatch.setattr(E, "FREQUENT", 2)
        got[most] = {(r["id"], r["term"]): r["weight"] for r in E.term_weights(df, "id").collect()}
    assert got[0].keys() == got[300_000].keys() and all(abs(got[0][k] - v) < 1e-12 for k, v in got[300_000].items())
    idf = lambda n: math.log(7 / (1 + n)) + 1
    a, b = idf(3), (1 + math.log(2)) * idf(1)
    assert abs(got[0][1, "b"] - b / math.hypot(a, b)) < 1e-12 and got[0][3, "a"] == 1.0 and not any(i in (4, 6) for i, _ in got[0])
    freq = {r["term"]: (r["df"], r["tf"]) for r in E.document_frequencies(df).collect()}
    assert freq["a"] == (3, 3) and freq["b"] == (1, 2) and freq["病"] == (1, 2)


def test_auto_takes_what_works(monkeypatch):
    c = EmbeddingConfig(backend="auto", dim=2, options={"url": "x", "post": lambda body: {"data": [{"index": 0, "embedding": [1.0, 2.0, 3.0]}]}})
    assert E.backend_name("auto", c) == "http" and E.learned_width(c) == 3

    def refuse(body):
        raise OSError("nobody there")

    with pytest.warns(UserWarning):
        assert E.backend_name("auto", EmbeddingConfig(backend="auto", options={"url": "x", "post": refuse})) == "tfidf"


def test_backends(spark):
    assert E.backend_name("LSA") == E.backend_name("auto") == "tfidf" and E.backend_name("sbert") == "sentence-transformers"
    with pytest.raises(KeyError):
        E.backend_name("nothing")
    E.register_backend("length", lambda c: lambda texts, q: np.array([[len(t), 1.0] for t in texts]))
    c = EmbeddingConfig(backend="length", dim=3, batch_size=2)
    got = spark.createDataFrame([("abc",), (None,), ("abcd",)], "t string").select(E.embed_with(F.col("t"), c)).collect()
    assert np.allclose(got[0][0], np.array([3, 1, 0]) / 10**0.5) and np.allclose(got[1][0], [0, 1, 0])
    with pytest.raises(RuntimeError):
        E.encode_checked(lambda t, q: np.zeros((1, 2)), ["a", "b"], c)
    assert E.encode_checked(lambda t, q: np.zeros((1, 2)), [], c).shape == (0, 3)


def test_http_backend():
    calls = []

    def post(body):
        calls.append(body)
        if len(calls) == 1:
            return {}  # tried again
        return {"data": [{"index": i, "embedding": [float(i), 1.0]} for i in reversed(range(len(body["input"])))]}

    c = EmbeddingConfig(backend="http", model_name="m", dim=2, normalize=False, options={"url": "x", "post": post, "wait": 0})
    assert E.encode_checked(E.BACKENDS["http"](c), ["a", "b"], c).tolist() == [[0, 1], [1, 1]]
    assert calls[0] == {"model": "m", "input": ["a", "b"], "dimensions": 2} and len(calls) == 2
    with pytest.raises(ValueError):
        E.BACKENDS["http"](EmbeddingConfig(backend="http"))


def test_term_weights_have_unit_rows(spark):
    df = spark.createDataFrame([(1, "病因 a a"), (2, "b"), (3, ""), (4, None)], "id int, text string")
    w = E.term_weights(df, "id").groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert {r["id"] for r in w} == {1, 2} and all(abs(r["n"] - 1) < 1e-9 for r in w)


def test_too_many_queries_are_refused(spark, monkeypatch):
    from loomtext.operators import search as Q

    monkeypatch.setattr(Q, "MOST_QUERIES", 2)
    rows = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "id long, embedding array<double>")
    with pytest.raises(ValueError):
        Q.top_k_batch(rows.withColumnRenamed("id", "query_id"), rows, 1, 2)
    assert Q.top_k_batch(rows.where("id < 2").withColumnRenamed("id", "query_id"), rows, 1, 2).count() == 2
