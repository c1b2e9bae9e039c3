"""Embeddings: a TF-IDF and latent-space model fitted in Spark, and a registry for other backends.

Term weights are (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), rows at unit length. The latent space is a randomized singular value
decomposition (Halko, Martinsson and Tropp 2011) with power iterations, whose basis lies in the shared folder (`latent`). What meets
the driver are the vocabulary and matrices of components x components. The model is JSON and Parquet, never a pickle.
"""

from __future__ import annotations

import json
import time
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..config import EmbeddingConfig
from ..functions import text as T
from ..scratch import drop, folder, materialize
from . import latent as L

OVERSAMPLE, POWER_ITERATIONS, SEED = 10, 5, 42
#: Terms whose idf is broadcast in any case (some 20 MB), and beyond that: those that one row in so many has.
BROADCAST_TERMS, FREQUENT = 300_000, 1000
#: Rows whose terms are counted at a time.
COUNTED_ROWS = 2048


def _counted(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """(keep..., terms, tfs): each row's distinct terms and how often it has them. No shuffle: a document is one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, COUNTED_ROWS) for whole in batches for a in range(0, whole.num_rows, COUNTED_ROWS)):
            lists = batch.column("_terms")
            flat = lists.flatten().dictionary_encode()
            row = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
            n = max(1, len(flat.dictionary))
            pair, tf = np.unique(row * n + flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(lists) + 1) * n).astype(np.int32)
            terms = flat.dictionary.take(pa.array(pair % n)) if len(pair) else pa.array([], pa.string())
            made = (pa.ListArray.from_arrays(pa.array(ends), x) for x in (terms, pa.array(tf.astype(np.int64))))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], [*keep, "terms", "tfs"])

    rows = df.where(F.col(text).isNotNull()).select(*keep, T.terms(F.col(text)).alias("_terms"))
    kinds = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return rows.mapInArrow(run, f"{kinds}terms array<string>, tfs array<bigint>")


def _frequencies(counted: DataFrame) -> DataFrame:
    return counted.select(F.inline(F.arrays_zip("terms", "tfs"))).groupBy(F.col("terms").alias("term")).agg(F.count("*").alias("df"), F.sum("tfs").alias("tf"))


def document_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(term, df, tf): documents with the term, and its occurrences. One scan, one shuffle of a document's distinct terms, added up before it."""
    return _frequencies(_counted(df, text))


def term_weights(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term, weight): sublinear tf x smoothed idf, at unit length for each row. Rows of null text and rows without terms have none.

    Texts are read once. The idf of terms that at least one row in FREQUENT has is broadcast: there are no more of them than FREQUENT
    times the distinct terms of a row. Only occurrences of rarer terms are shuffled to their idf, so no key is hot; and rows' norms
    are added up before they are shuffled.
    """
    counted = materialize(_counted(df.withColumn("_row", F.monotonically_increasing_id()), text, "_row", key))
    n = df.count()
    idf = materialize(_frequencies(counted).select("term", "df", (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1).alias("idf")))
    each = counted.select("_row", key, F.inline(F.arrays_zip("terms", "tfs"))).withColumnRenamed("terms", "term")
    # all of them where they are few anyway
    least = 0 if idf.count() <= BROADCAST_TERMS else max(1, n // FREQUENT)
    common = each.join(F.broadcast(idf.where(F.col("df") >= least)), "term")
    rare = each.join(idf.where(F.col("df") < least), "term") if least else None
    w = (common if rare is None else common.unionByName(rare)).select("_row", key, "term", ((1 + F.log("tfs")) * F.col("idf")).alias("w"))
    norms = w.groupBy("_row").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(norms, "_row").select(key, "term", (F.col("w") / F.col("norm")).alias("weight"))


def _entries(lists: pa.Array, tfs: pa.Array | None, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, count) of the known terms of lists, ascending. Without tfs each occurrence counts."""
    flat = lists.flatten().cast(pa.string()).dictionary_encode()
    row = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
    known = np.asarray(pc.fill_null(pc.index_in(flat.dictionary, value_set=vocabulary), -1)).astype(np.int64)
    column = known[np.asarray(flat.indices)] if len(known) else np.zeros(0, np.int64)
    keep = column >= 0
    n = max(1, len(vocabulary))
    pair = row[keep] * n + column[keep]
    if tfs is None:
        pair, tf = np.unique(pair, return_counts=True)
    else:
        order = np.argsort(pair)
        pair, tf = pair[order], np.asarray(tfs.flatten())[keep][order]
    return pair // n, pair % n, tf


@dataclass
class LsaModel:
    """Vocabulary (term to column), idf by column, blocks of the components (features x k); `version` names the space its vectors live in.

    Columns go from frequent terms to rare ones. The components lie in the shared folder, `dense` of their rows belong to terms that are many rows' own.
    """

    vocabulary: dict[str, int]
    idf: np.ndarray
    blocks: L.Blocks
    dim: int
    normalize: bool = True
    version: str = ""
    dense: int = 0

    @property
    def components(self) -> np.ndarray:
        """All of them at once; nothing here needs that."""
        return self.blocks.whole() if self.blocks.rows else np.zeros((0, self.blocks.columns))

    def rows(self, lists: list[list[str] | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, column, weight) of the known terms, rows at unit length."""
        d, c, tf = _entries(pa.array(lists, pa.list_(pa.string())), None, pa.array(list(self.vocabulary), pa.string()))
        return d, c, L.weights(d, c, tf, self.idf, len(lists))

    def _finished(self, y: np.ndarray) -> np.ndarray:
        m = min(y.shape[1], self.dim)
        out = np.zeros((len(y), self.dim), np.float32)
        out[:, :m] = y[:, :m]
        if self.normalize:
            n = np.linalg.norm(out, axis=1, keepdims=True)
            n[n == 0] = 1.0
            out /= n
        return out

    def vectors(self, lists: pa.Array) -> np.ndarray:
        known, out = pa.array(list(self.vocabulary), pa.string()), []
        for a in range(0, len(lists), L.ROWS):
            part = lists[a : a + L.ROWS]
            d, c, tf = _entries(part, None, known)
            out.append(self._finished(L.products(d, c, L.weights(d, c, tf, self.idf, len(part)), len(part), self.blocks, self.dense)))
        return np.concatenate(out) if out else np.zeros((0, self.dim), np.float32)

    def save(self, spark: SparkSession, path: str) -> None:
        q, terms, idf = self.blocks, list(self.vocabulary), self.idf

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    a, b = q.slabs[i]
                    x = q.slab(i)
                    component = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, q.columns), pa.int32()), pa.array(x.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(terms[a:b]), pa.array(np.arange(a, b), pa.int32()), pa.array(idf[a:b]), component], ["term", "column", "idf", "component"])

        n = len(q.slabs)
        spark.range(0, n, 1, max(1, n)).mapInArrow(run, "term string, column int, idf double, component array<float>").write.mode("overwrite").parquet(f"{path}/terms")
        meta = {"backend": "tfidf", "dim": self.dim, "normalize": self.normalize, "version": self.version, "components": q.columns, "dense": self.dense}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LsaModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        table = spark.read.parquet(f"{path}/terms")
        t = table.select("term", "column", "idf").orderBy("column").toArrow()
        q = L.Blocks(folder(spark), t.num_rows, meta["components"])

        def put(t: pa.Table) -> pa.Table:
            t = t.sort_by("column")
            x = np.asarray(t.column("component").combine_chunks().flatten(), np.float32).reshape(-1, q.columns)
            slab = t.column("column")[0].as_py() // q.height
            for j, (a, b) in enumerate(q.parts):
                q.write(slab, j, x[:, a:b])
            return pa.table({"slab": pa.array([slab], pa.int32())})

        slab = F.floor(F.col("column") / q.height).alias("slab")
        table.select("column", "component").groupBy(slab).applyInArrow(put, "slab int").collect()
        return cls(dict(zip(t.column("term").to_pylist(), range(t.num_rows))), t.column("idf").to_numpy(), q, meta["dim"], meta["normalize"], meta["version"], meta.get("dense", 0))

    def embed(self, text: Column) -> Column:
        """Vectors of a text column; null and unknown texts give zeros."""
        model = self

        @arrow_udf("array<float>")
        def run(x: pa.Array) -> pa.Array:
            return _lists(model.vectors(x))

        return run(T.terms(F.coalesce(text, F.lit(""))))

    def embed_packed(self, packed: DataFrame) -> DataFrame:
        """(kept columns, embedding) of the rows that fit_packed gave beside the model; texts aren't read again."""
        model, keep = self, [c for c in packed.columns if c not in L.PACKED_NAMES]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for d, c, w, n, kept in L.grouped(batches, model.idf, keep):
                y = model._finished(L.products(d, c, w, n, model.blocks, model.dense))
                for a in range(0, n, 1024):
                    yield pa.RecordBatch.from_arrays([*(x[a : a + 1024] for x in kept), _lists(y[a : a + 1024])], [*keep, "embedding"])

        kinds = "".join(f"`{c}` {packed.schema[c].dataType.elementType.simpleString()}, " for c in keep)
        return packed.mapInArrow(run, f"{kinds}embedding array<float>")

    def embed_query(self, spark: SparkSession, text: str) -> list[float]:
        row = spark.createDataFrame([(text,)], "t string").select(T.terms(F.col("t"))).first()
        return self.vectors(pa.array([row[0]], pa.list_(pa.string())))[0].tolist()


def _lists(v: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, v.shape[1]), pa.int32()), pa.array(v.ravel()))


def fit_lsa(df: DataFrame, text: str = "text", config: EmbeddingConfig | None = None, power_iterations: int = POWER_ITERATIONS) -> LsaModel:
    """A model of df's texts: the max_features most frequent terms (ties by the term), min(components or dim, rows - 1, features - 1) components, one at least."""
    model, packed = fit_packed(df, text, config, power_iterations)
    drop(packed)
    return model


def fit_packed(df: DataFrame, text: str = "text", config: EmbeddingConfig | None = None, power_iterations: int = POWER_ITERATIONS, keep: tuple[str, ...] = ()) -> tuple[LsaModel, DataFrame]:
    """fit_lsa's model, and the rows of text as term counts with the columns to keep, for embed_packed. Texts are read once."""
    c = config or EmbeddingConfig()
    spark = df.sparkSession
    counted = materialize(_counted(df, text, *keep))
    n = counted.count()
    vocab = _frequencies(counted).orderBy(F.desc("tf"), "term").limit(c.max_features).toArrow()
    terms = vocab.column("term").to_pylist()
    m = len(terms)
    dfs = vocab.column("df").to_numpy() if terms else np.zeros(0)
    idf = np.log((1 + n) / (1 + dfs)) + 1
    packed = materialize(_packed(counted, terms, keep))
    drop(counted)
    k = max(1, min(c.components or c.dim, n - 1, m - 1))
    dense = L.dense_terms(dfs, n)
    q = L.Blocks("", 0, k)
    if terms:
        q = L.decompose(spark, packed, packed._scratch_path, idf, dense, k, min(m, k + OVERSAMPLE), power_iterations + 1, SEED)
    return LsaModel({t: i for i, t in enumerate(terms)}, idf, q, c.dim, c.normalize, f"lsa-{int(time.time() * 1000):x}", dense), packed


def _packed(counted: DataFrame, terms: list[str], keep: tuple[str, ...]) -> DataFrame:
    """Rows of term counts in packs, with the kept columns as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in (whole.slice(a, L.PACK_ROWS) for whole in batches for a in range(0, whole.num_rows, L.PACK_ROWS)):
            for a, b, row in L.packs(*_entries(batch.column("terms"), batch.column("tfs"), known), batch.num_rows):
                kept = [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column(x)[a:b]) for x in keep]
                cells = [pa.array([row[x]], pa.binary() if isinstance(row[x], bytes) else pa.int32()) for x in L.PACKED_NAMES]
                yield pa.RecordBatch.from_arrays([*kept, *cells], [*keep, *L.PACKED_NAMES])

    kinds = "".join(f"`{c}` array<{counted.schema[c].dataType.simpleString()}>, " for c in keep)
    return counted.mapInArrow(run, kinds + L.PACKED)


# ---------------------------------------------------------------- other backends

Encode = Callable[[list[str], bool], np.ndarray]
BACKENDS: dict[str, Callable[[EmbeddingConfig], Encode]] = {}
ALIASES = {"lsa": "tfidf", "bow": "tfidf", "st": "sentence-transformers", "sbert": "sentence-transformers", "semantic": "sentence-transformers", "api": "http"}


def register_backend(name: str, make: Callable[[EmbeddingConfig], Encode]) -> None:
    """make(config) is called once in every Python worker and gives encode(texts, is_query) -> matrix."""
    BACKENDS[name] = make


def backend_name(name: str, config: EmbeddingConfig | None = None) -> str:
    """The backend behind a name or alias.

    'auto' takes the first that works: the service if an address is configured and answers, the local model if one is named and its
    library is there, else the fitted model, which needs nothing from outside.
    """
    n = ALIASES.get(name.lower(), name.lower())
    if n == "auto":
        for other in ("http",) * bool(config and config.options.get("url")) + ("sentence-transformers",) * bool(config and config.model_name):
            try:
                if len(BACKENDS[other](config)(["a"], False)) == 1:
                    return other
            except Exception as e:  # whatever keeps it from answering
                warnings.warn(f"embedding backend {other} does not work here: {e}", stacklevel=2)
        return "tfidf"
    if n == "tfidf":
        return "tfidf"
    if n not in BACKENDS:
        raise KeyError(f"unknown embedding backend {name!r}; there are: tfidf, {', '.join(sorted(BACKENDS))}")
    return n


def learned_width(config: EmbeddingConfig) -> int:
    """How many values a plugged-in backend's vectors have, by asking it for one."""
    return int(np.asarray(BACKENDS[backend_name(config.backend, config)](config)(["a"], False)).shape[1])


def _fit_width(v: np.ndarray, dim: int, normalize: bool) -> np.ndarray:
    out = np.zeros((len(v), dim), np.float32)
    out[:, : min(dim, v.shape[1])] = v[:, :dim]
    if normalize:
        n = np.linalg.norm(out, axis=1, keepdims=True)
        n[n == 0] = 1.0
        out /= n
    return out


def encode_checked(encode: Encode, texts: list[str], config: EmbeddingConfig, is_query: bool = False) -> np.ndarray:
    """Batches of batch_size; a batch with another number of vectors than texts raises. Padded or cut to dim, then normalized."""
    if not texts:
        return np.zeros((0, config.dim), np.float32)
    out = []
    for a in range(0, len(texts), max(1, config.batch_size)):
        part = texts[a : a + max(1, config.batch_size)]
        v = np.asarray(encode(part, is_query), float)
        if len(v) != len(part):
            raise RuntimeError(f"the backend gave {len(v)} vectors for {len(part)} texts")
        out.append(_fit_width(v, config.dim, config.normalize))
    return np.concatenate(out)


def embed_with(text: Column, config: EmbeddingConfig, is_query: bool = False) -> Column:
    """Vectors by a registered backend, which is made once a worker."""
    make = BACKENDS[backend_name(config.backend, config)]

    @arrow_udf("array<float>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = make(config)
        for x in parts:
            v = encode_checked(encode, [s or "" for s in x.to_pylist()], config, is_query)
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, config.dim), pa.int32()), pa.array(v.ravel()))

    return run(text)


def _http(config: EmbeddingConfig) -> Encode:
    """An embedding service: POST {model, input, dimensions}, answers {data: [{index, embedding}]}. Options: url, key, timeout, post (for tests)."""
    import urllib.error
    import urllib.request

    o = config.options
    if not o.get("url"):
        raise ValueError("the http backend needs options['url']")

    def post(body: dict) -> dict:
        request = urllib.request.Request(o["url"], json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {o.get('key', '')}"})
        with urllib.request.urlopen(request, timeout=o.get("timeout", 60)) as r:
            return json.loads(r.read())

    send = o.get("post", post)

    def encode(texts: list[str], is_query: bool) -> np.ndarray:
        body = {"model": config.model_name, "input": texts} | ({"dimensions": config.dim} if config.dim else {})
        for attempt in range(4):
            try:
                data = sorted(send(body)["data"], key=lambda x: x["index"])
                return np.array([x["embedding"] for x in data])
            except urllib.error.HTTPError as e:
                if e.code != 429 and e.code < 500 or attempt == 3:
                    raise
            except (KeyError, ValueError):
                if attempt == 3:
                    raise
            time.sleep(o.get("wait", 1.5) * (attempt + 1))
        raise RuntimeError("not reached")

    return encode


def _sentence_transformers(config: EmbeddingConfig) -> Encode:
    """A local model, if its library is installed; queries get the configured instruction in front."""
    from sentence_transformers import SentenceTransformer

    try:
        model = SentenceTransformer(config.model_name, device=config.options.get("device", "cpu"))
    except (RuntimeError, AssertionError):
        # a device that isn't there
        model = SentenceTransformer(config.model_name, device="cpu")

    def encode(texts: list[str], is_query: bool) -> np.ndarray:
        given = [config.query_instruction + t for t in texts] if is_query and config.query_instruction else texts
        return model.encode(given, normalize_embeddings=config.normalize, show_progress_bar=False)

    return encode


register_backend("http", _http)
register_backend("sentence-transformers", _sentence_transformers)
