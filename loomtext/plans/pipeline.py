"""The two plans: ingest and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import embed as E
from ..operators.search import search_chunks
from ..operators.store import Store, load
from ..sources.raw import read_sites


def embed_missing(store: Store, config: Config) -> str | None:
    """Vectors for the stored chunks; the version of the space they are in.

    The fitted model is fitted on the whole corpus and every chunk is embedded anew under a new version: vectors of two fits can't
    be compared. A plugged-in backend embeds only chunks that have no vector yet.
    """
    e = config.embedding
    rows = store.chunks().select("document_id", "chunk_index", "source", "chunk_text")
    if not rows.limit(1).count():
        return None
    if E.backend_name(e.backend, e) == "tfidf":
        model = E.fit_lsa(rows, "chunk_text", e)
        model.save(store.spark, f"{store.path}/model/{model.version}")
        version, vector = model.version, model.embed(F.col("chunk_text"))
    else:
        version = f"{E.backend_name(e.backend, e)}-{e.model_name}-{e.dim}-{e.normalize}"
        rows = rows.join(store.embeddings(version).select("document_id", "chunk_index"), ["document_id", "chunk_index"], "left_anti")
        vector = E.embed_with(F.col("chunk_text"), e)
    store.append("embeddings", rows.select("document_id", "chunk_index", vector.alias("embedding"), F.lit(version).alias("version"), "source"), "version", "source")
    return version


def run(
    spark: SparkSession,
    raw: DataFrame | None = None,
    sites: list[str] | None = None,
    max_pages: int | None = None,
    recreate: bool = False,
    config: Config | None = None,
) -> dict:
    """Ingest: fetched or given raw documents into the store, then vectors. {documents, chunks, embedding, embedding_dim, langs}.

    Without anything new the store and its model stay as they are. `recreate` empties the store first.
    """
    c = config or Config()
    backend = E.backend_name(c.embedding.backend, c.embedding)
    store = Store(spark, c.warehouse)
    if recreate:
        store.drop()
    rows = raw if raw is not None else read_sites(spark, sites, max_pages)
    if raw is not None and sites:
        rows = rows.where(F.col("source").isin(list(sites)))
    stats = load(store, rows, c)
    out = {"documents": stats["documents"], "chunks": stats["chunks"], "embedding": backend, "embedding_dim": c.embedding.dim, "langs": stats["langs"]}
    if stats["documents"]:
        version = embed_missing(store, c)
        store.set_state({"backend": backend, "model_name": c.embedding.model_name, "dim": c.embedding.dim, "normalize": c.embedding.normalize, "version": version})
        store.keep_version(version or "")
    return out


def search(spark: SparkSession, query: str, k: int = 5, sites: list[str] | None = None, config: Config | None = None) -> DataFrame:
    """(source, url, title, chunk_index, text, similarity) of the k chunks most similar to a text, in the stored space."""
    c = config or Config()
    store = Store(spark, c.warehouse)
    state = store.state()
    version = state.get("version") or ""
    if state.get("backend", "tfidf") == "tfidf":
        vector = E.LsaModel.load(spark, f"{store.path}/model/{version}").embed_query(spark, query) if version else []
    else:
        vector = E.encode_checked(E.BACKENDS[state["backend"]](c.embedding), [query], c.embedding, True)[0].tolist()
    return search_chunks(store.documents(), store.chunks(), vector, k, sites, store.embeddings(version))
