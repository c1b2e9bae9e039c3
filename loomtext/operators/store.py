"""Document and chunk tables in a warehouse folder, loaded idempotently.

Ids of documents are hashes of their address, made again under another salt where two addresses have one; a chunk's key is its
document and its index (its id, a hash of both, is for display). All tables are partitioned by source and sorted by document. A load
writes chunks, documents and then its batch into a small table of commits; rows of other batches are not read, so what a
broken load left is invisible and is written anew by the next one. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ChunkConfig, Config
from ..functions import text as T
from ..scratch import materialize
from . import sample
from .chunk import chunks
from .extract import clean_raw

DOCUMENTS = "id long, source_name string, source_url string, title string, page_number int, lang string, doc_metadata string, raw_text string, created_at timestamp, batch string, source string"
CHUNKS = "id long, document_id long, chunk_index int, chunk_text string, char_length int, token_count int, created_at timestamp, batch string, source string"
COMMITS = "batch string"
EMBEDDINGS = "document_id long, chunk_index int, embedding array<float>, version string, source string"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@dataclass
class Store:
    spark: SparkSession
    path: str

    def _read(self, name: str, schema: str) -> DataFrame:
        p = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(p) if _exists(self.spark, p) else self.spark.createDataFrame([], schema)

    def drop(self) -> None:
        """Both tables, the vectors and the models."""
        for name in ("commits", "chunks", "documents", "embeddings", "model"):
            _delete(self.spark, f"{self.path}/{name}")

    def _committed(self, name: str, schema: str) -> DataFrame:
        # a row a load: Spark sees its size and spares the shuffle
        return self._read(name, schema).join(self._read("commits", COMMITS), "batch", "left_semi")

    def documents(self) -> DataFrame:
        return self._committed("documents", DOCUMENTS)

    def chunks(self) -> DataFrame:
        return self._committed("chunks", CHUNKS)

    def commit(self, batch: str) -> None:
        self.spark.createDataFrame([(batch,)], COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")

    def embeddings(self, version: str) -> DataFrame:
        return self._read("embeddings", EMBEDDINGS).where(F.col("version") == version)

    def append(self, name: str, df: DataFrame, *by: str) -> None:
        df.write.mode("append").partitionBy(*by).parquet(f"{self.path}/{name}")

    def keep_version(self, version: str) -> None:
        """Vectors and models of other versions go."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder, keep in (("embeddings", (f"version={version}",)), ("model", (version, "state"))):
            p = hadoop(f"{self.path}/{folder}")
            fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for f in fs.listStatus(p) if fs.exists(p) else ():
                if f.isDirectory() and f.getPath().getName() not in keep:
                    fs.delete(f.getPath(), True)

    def has(self, source: str, source_url: str) -> bool:
        return bool(self.documents().where((F.col("source") == source) & (F.col("source_url") == source_url)).limit(1).count())

    def set_state(self, state: dict) -> None:
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/model/state")

    def state(self) -> dict:
        p = f"{self.path}/model/state"
        return json.loads(self.spark.read.text(p).first()[0]) if _exists(self.spark, p) else {}


def prepare(raw: DataFrame, stored: DataFrame, config: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, records) of raw documents that are long enough, not stored, and each once.

    candidates (source, source_url, lang, ...) are counted by language; records are those with a chunk at least. A null source or
    source_url counts as ''. Of raw documents with one address the first by its text is kept.
    """
    c = config or Config()
    keys = ["source", "source_url"]
    rows = raw.withColumns({k: F.coalesce(k, F.lit("")) for k in (*keys, "source_name")}).withColumn("text", clean_raw(F.col("raw"), F.col("content_kind"))).drop("raw", "content_kind")
    # the text is made once, in Python, and read several times
    rows = materialize(rows.where(F.length("text") >= c.min_text))
    rows = sample.one_per_key(sample.new_rows(rows, stored, keys), keys, ["text", "title"])
    rows = rows.withColumn("lang", T.resolve_lang(F.col("lang"), F.col("text"))).withColumn("chunks", chunks(F.col("text"), c.chunk))
    rows = materialize(rows)
    return rows.drop("chunks"), rows.where(F.size("chunks") > 0)


def with_chunk_count(meta, n):
    """The metadata JSON with "chunks": n, if it says nothing about chunks yet; null metadata is {}."""
    m = F.coalesce(meta, F.lit("{}"))
    body = F.regexp_replace(m, r"(?s)^\s*\{|\}\s*\z", "")
    added = F.concat(F.lit("{"), body, F.when(F.trim(body) == "", "").otherwise(", "), F.lit('"chunks": '), n.cast("string"), F.lit("}"))
    return F.when(F.get_json_object(m, "$.chunks").isNotNull(), m).otherwise(added)


def with_ids(records: DataFrame, taken: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """records with `id`, different for each (source, source_url) and from the ids of `taken`.

    Of addresses with one hash the least keeps it, the others are hashed again under the round's number, until none clash.
    """
    keys, done, rest, n = ["source", "source_url"], None, records.select("source", "source_url").distinct(), 0
    while True:
        own = rest.withColumn("id", hashed(*keys, F.lit(n)) if n else hashed(*keys))
        first = own.groupBy("id").agg(F.min(F.struct(*keys)).alias("x")).select("id", "x.*")
        used = taken.select("id") if done is None else taken.select("id").unionByName(done.select("id"))
        free = materialize(first.join(used, "id", "left_anti"))
        done = free if done is None else done.unionByName(free)
        rest = rest.join(free.select(*keys), keys, "left_anti")
        if not rest.limit(1).count():
            return records.join(done, keys)
        n += 1


def load(store: Store, raw: DataFrame, config: Config | None = None) -> dict:
    """Adds what is new: {documents, chunks, langs, batch}. A second load of the same rows adds nothing."""
    candidates, records = prepare(raw, store.documents(), config)
    langs = {r["lang"]: r["count"] for r in candidates.groupBy("lang").count().collect()}
    totals = records.agg(F.count("*").alias("d"), F.coalesce(F.sum(F.size("chunks")), F.lit(0)).alias("c")).first()
    batch = uuid.uuid4().hex
    stats = {"documents": totals["d"], "chunks": totals["c"], "langs": langs, "batch": batch}
    if not totals["d"]:
        return stats
    docs = with_ids(records, store.documents().select("id")).select(
        "id",
        "source_name", "source_url", "title", "page_number", "lang",
        with_chunk_count(F.col("doc_metadata"), F.size("chunks")).alias("doc_metadata"),
        F.col("text").alias("raw_text"),
        F.current_timestamp().alias("created_at"),
        F.lit(batch).alias("batch"),
        "source", "chunks",
    )
    rows = docs.select("id", "source", F.inline("chunks"))
    store.append(
        "chunks",
        rows.select(
            F.xxhash64("id", "chunk_index").alias("id"), F.col("id").alias("document_id"), "chunk_index", "chunk_text", "char_length", "token_count",
            F.current_timestamp().alias("created_at"), F.lit(batch).alias("batch"), "source",
        ).sortWithinPartitions("source", "document_id", "chunk_index"),
        "source",
    )
    store.append("documents", docs.drop("chunks").sortWithinPartitions("source", "id"), "source")
    store.commit(batch)
    return stats


def orphans(documents: DataFrame, chunk_rows: DataFrame) -> DataFrame:
    """Chunks whose document is missing: what a foreign key would have refused."""
    return chunk_rows.join(documents.select(F.col("id").alias("document_id")), "document_id", "left_anti")


def chunk_stats(chunk_rows: DataFrame) -> DataFrame:
    """(document_id, chunks, tokens, characters)."""
    return chunk_rows.groupBy("document_id").agg(F.count("*").alias("chunks"), F.sum("token_count").alias("tokens"), F.sum("char_length").alias("characters"))


__all__ = ["CHUNKS", "ChunkConfig", "DOCUMENTS", "Store", "chunk_stats", "load", "orphans", "prepare", "with_chunk_count", "with_ids"]
