"""Cosine top-k over chunks: one query, or a set of queries in blocks, with an optional index."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..scratch import materialize

#: Queries compared at a time: a block's matrix is what every task gets.
QUERY_BLOCK = 4096
#: More queries than this go in several calls: each block is a scan of its own, and its matrix is made on the driver.
MOST_QUERIES = 64 * QUERY_BLOCK
#: Rows that the index's cells are fitted on, cells, and rounds of fitting.
INDEX_SAMPLE, INDEX_ROUNDS, SEED = 20_000, 12, 7


def top_k(df: DataFrame, query: list[float], k: int = 5, tie: tuple[str, ...] = ("id",), embedding: str = "embedding") -> DataFrame:
    """The k rows most similar to the query, with `similarity` (4 digits); ties by the columns of `tie`.

    Rows with a null embedding are left out, zero vectors have similarity 0.
    """
    sim = df.where(F.col(embedding).isNotNull()).withColumn("similarity", V.cosine_to(F.col(embedding), list(query)))
    return sim.orderBy(F.desc("similarity"), *tie).limit(k).withColumn("similarity", F.round("similarity", 4))


def search_chunks(documents: DataFrame, chunks: DataFrame, query: list[float], k: int = 5, sources: list[str] | None = None, vectors: DataFrame | None = None) -> DataFrame:
    """(source, url, title, chunk_index, text, similarity) of the k chunks most similar to the query.

    vectors (document_id, chunk_index, embedding, source, and id if chunks have one) if they aren't in `chunks`. No sources: all of them. A chunk of no document is
    no hit. Sources go to the scans of all tables that have them; similarities come first, so that what is joined are ids and
    numbers, and texts and titles are read for the k hits only. Rows of one document and index are hits of their own.
    """
    docs = documents.select(F.col("id").alias("document_id"), "source", F.col("source_url").alias("url"), "title")
    found = chunks if vectors is None else vectors
    if sources:
        own = F.col("source").isin(list(sources))
        docs = docs.where(own)
        # a chunk lies where its document does
        found, chunks = (x.where(own) if "source" in x.columns else x for x in (found, chunks))
    # chunks loaded twice have ids of their own
    key = ["document_id", "chunk_index", *(["id"] if "id" in found.columns and "id" in chunks.columns else [])]
    near = found.where(F.col("embedding").isNotNull()).select(*key, V.cosine_to(F.col("embedding"), list(query)).alias("similarity"))
    best = near.join(docs.select("document_id"), "document_id", "left_semi").orderBy(F.desc("similarity"), *key).limit(k)
    hits = chunks.select(*key, F.col("chunk_text").alias("text")).join(F.broadcast(best), key)  # k rows
    hits = docs.join(F.broadcast(hits), "document_id")
    return hits.orderBy(F.desc("similarity"), *key).limit(k).withColumn("similarity", F.round("similarity", 4)).select("source", "url", "title", "chunk_index", "text", "similarity")


def _matrix(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.float64)
    for i, v in enumerate(column.to_pylist()):
        if v:
            m = min(width, len(v))
            out[i, :m] = [x or 0.0 for x in v[:m]]
    n = np.linalg.norm(out, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return out / n


def top_k_batch(queries: DataFrame, df: DataFrame, k: int, width: int, query_id: str = "query_id", row_id: str = "id", embedding: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, id, similarity): for every row of queries (query_id, embedding) the k most similar rows of df, exactly.

    Queries go out in blocks of a fixed number; each task multiplies its rows with a block and keeps k of its rows for each query, so
    that what is shuffled is queries x tasks x k. Null embeddings are neither queries nor rows. More than MOST_QUERIES queries are
    refused with a ValueError: ask in parts.
    """
    q = queries.where(F.col(embedding).isNotNull()).select(F.col(query_id).cast("long").alias("q"), F.col(embedding).cast("array<double>").alias("e"))
    rows = df.where(F.col(embedding).isNotNull()).select(F.col(row_id).cast("long").alias("i"), F.col(embedding).cast("array<double>").alias("e"))
    n_queries = q.count()
    if n_queries > MOST_QUERIES:
        raise ValueError(f"{n_queries} queries at once; ask for {MOST_QUERIES} at most")
    blocks = -(-n_queries // block)
    found = []
    for n in range(blocks):
        t = q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == n).orderBy("q").toArrow()
        if not t.num_rows:
            continue
        qi, qm = t.column("q").to_numpy(), _matrix(t.column("e"), width)

        def run(batches, qi=qi, qm=qm):
            best_s, best_i = np.full((len(qi), 0), -2.0), np.zeros((len(qi), 0), np.int64)
            for batch in batches:
                s = np.round(qm @ _matrix(batch.column("e"), width).T, 12)
                s = np.concatenate((best_s, s), 1)
                ids = np.concatenate((best_i, np.broadcast_to(batch.column("i").to_numpy(), (len(qi), batch.num_rows))), 1)
                order = np.lexsort((ids, -s), axis=1)[:, :k]
                best_s, best_i = np.take_along_axis(s, order, 1), np.take_along_axis(ids, order, 1)
            if best_i.size:
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(qi, best_i.shape[1])), pa.array(best_i.ravel()), pa.array(best_s.ravel())], ["q", "i", "s"])

        found.append(rows.mapInArrow(run, "q long, i long, s double"))
    if not found:
        return df.sparkSession.createDataFrame([], f"{query_id} long, rank int, {row_id} long, similarity double")
    near = reduce(DataFrame.unionByName, found)
    w = Window.partitionBy("q").orderBy(F.desc("s"), "i")
    best = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select(F.col("q").alias(query_id), "rank", F.col("i").alias(row_id), F.round("s", 4).alias("similarity"))


class CellIndex:
    """Vectors by the nearest of a number of centres; a search looks at the rows of the nearest cells only.

    Centres are fitted on at most INDEX_SAMPLE rows, every row is indexed. Similarities are exact, which rows are looked at is not.
    """

    def __init__(self, rows: DataFrame, centres: np.ndarray):
        self.rows, self.centres = rows, centres

    @classmethod
    def build(cls, df: DataFrame, width: int, cells: int | None = None, row_id: str = "id", embedding: str = "embedding") -> CellIndex:
        rows = df.where(F.col(embedding).isNotNull()).select(F.col(row_id).cast("long").alias("i"), F.col(embedding).cast("array<double>").alias("e"))
        picked = [r[0] for r in rows.select("i").orderBy(F.xxhash64("i"), "i").limit(INDEX_SAMPLE).collect()]
        if not picked:
            return cls(rows.withColumn("cell", F.lit(0)), np.zeros((1, width)))
        limit = rows.select(F.xxhash64("i").alias("h"), "i").where(F.col("i") == picked[-1]).first()["h"]
        x = _matrix(rows.where(F.xxhash64("i") <= limit).select("e").toArrow().column("e"), width)
        cells = cells or max(1, int(np.sqrt(len(x))))
        c = x[np.random.default_rng(SEED).choice(len(x), min(cells, len(x)), replace=False)]
        for _ in range(INDEX_ROUNDS):
            near = (x @ c.T).argmax(1)
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            n = np.linalg.norm(total, axis=1, keepdims=True)
            c = np.where(n > 0, total / np.where(n > 0, n, 1), c)

        def assign(batches):
            for batch in batches:
                cell = (_matrix(batch.column("e"), width) @ c.T).argmax(1)
                yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("e"), pa.array(cell.astype(np.int32))], ["i", "e", "cell"])

        return cls(materialize(rows.mapInArrow(assign, "i long, e array<double>, cell int")), c)

    def search(self, queries: DataFrame, k: int, probe: int, query_id: str = "query_id", row_id: str = "id", embedding: str = "embedding") -> DataFrame:
        """(query_id, rank, id, similarity) as top_k_batch, from the `probe` cells nearest to each query."""
        c, width = self.centres, self.centres.shape[1]

        def cells(batches):
            for batch in batches:
                m = _matrix(batch.column("e"), width)
                near = np.argsort(-(m @ c.T), axis=1, kind="stable")[:, :probe]
                p = near.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("q").to_numpy(), p)), batch.column("e").take(pa.array(np.repeat(np.arange(batch.num_rows), p))), pa.array(near.ravel().astype(np.int32))],
                    ["q", "qe", "cell"],
                )

        q = queries.where(F.col(embedding).isNotNull()).select(F.col(query_id).cast("long").alias("q"), F.col(embedding).cast("array<double>").alias("e"))
        near = q.mapInArrow(cells, "q long, qe array<double>, cell int")
        pairs = near.join(self.rows, "cell").select("q", "i", F.round(V.cosine(F.col("qe"), F.col("e")), 12).alias("s"))
        w = Window.partitionBy("q").orderBy(F.desc("s"), "i")
        best = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        return best.select(F.col("q").alias(query_id), "rank", F.col("i").alias(row_id), F.round("s", 4).alias("similarity"))
