"""The core's queries by name, and the SQL that says the same. Every query runs over its whole tables."""

from __future__ import annotations

import tempfile
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import ChunkConfig, Config, EmbeddingConfig
from .functions import text as T
from .functions import urls as U
from .functions import vectors as V
from .operators import chunk as C
from .operators import embed as E
from .operators import extract as X
from .operators import sample as S
from .operators import search as Q
from .operators import store as St
from .plans import pipeline
from .scratch import materialize, shared_dir
from .sources import raw as R

WIDTH = 64
LINK = r'href="(/[^"#?]+)"'
#: The layout of the test pages: what holds the article in any of them.
PAGE_SPEC = X.ExtractSpec(
    main=("article", "main", "[role=main]", "#content", ".list_left", ".entry", "body"),
    drop_tags=("script", "style", "noscript", "nav", "footer", "aside"),
    min_chars=120,
    metadata=lambda url, title: {"article_title": title or "", "topic_slug": url.rstrip("/").rsplit("/", 1)[-1]},
)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ------------------------------------------------------------------ search


def _query_vector(spark: SparkSession, d: str) -> list[float]:
    row = _t(spark, d, "embeddings").where("vec_id = 0 AND embedding IS NOT NULL").first()
    return [float(x) for x in row["embedding"]] if row else [0.0] * WIDTH


def topk_single(spark: SparkSession, d: str) -> DataFrame:
    return Q.top_k(_t(spark, d, "embeddings"), _query_vector(spark, d), 5, ("vec_id",)).select("vec_id", "label", "similarity")


def topk_filtered(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "embeddings").where(F.col("label").isin(1, 3, 5))
    return Q.top_k(rows, _query_vector(spark, d), 5, ("vec_id",)).select("vec_id", "label", "similarity")


def topk_batched(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "embeddings")
    queries = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return Q.top_k_batch(queries, rows, 5, WIDTH, row_id="vec_id")


def topk_indexed(spark: SparkSession, d: str) -> DataFrame:
    """As topk_batched, through the cell index; approximate. These vectors have no clusters, so most cells have to be looked at for a recall of 0.9."""
    rows = _t(spark, d, "embeddings")
    queries = rows.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    index = Q.CellIndex.build(rows, WIDTH, row_id="vec_id")
    return index.search(queries, 5, max(1, len(index.centres) * 2 // 3), row_id="vec_id")


def _stored(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    chunks = _t(spark, d, "chunks").where("embedding IS NOT NULL").withColumn("embedding", V.fit_width(F.col("embedding"), WIDTH))
    return _t(spark, d, "site_documents"), chunks


def search_chunks(spark: SparkSession, d: str) -> DataFrame:
    docs, chunks = _stored(spark, d)
    return Q.search_chunks(docs, chunks, _query_vector(spark, d), 10)


def search_chunks_filtered(spark: SparkSession, d: str) -> DataFrame:
    docs, chunks = _stored(spark, d)
    return Q.search_chunks(docs, chunks, _query_vector(spark, d), 10, ["qinglan", "hemu", "wellspring"])


_COSINE = "list_cosine_similarity({}::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0))"
_WIDE = "list_resize(c.embedding::DOUBLE[], 64, 0.0::DOUBLE)"
_SEARCH = f"""
SELECT source, url, title, chunk_index, text, similarity FROM (
  SELECT *, round(s, 4) AS similarity FROM (
    SELECT d.source, d.source_url AS url, d.title, c.chunk_index, c.chunk_text AS text, c.document_id,
           CASE WHEN list_sum(list_transform({_WIDE}, lambda x: x * x)) = 0 THEN 0.0 ELSE {_COSINE.format(_WIDE)} END AS s
    FROM chunks c JOIN site_documents d ON d.id = c.document_id WHERE c.embedding IS NOT NULL %s)
  ORDER BY s DESC, document_id, chunk_index LIMIT 10)"""

# ------------------------------------------------------------------ vectors


def l2_norm(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "chunks").where("embedding IS NOT NULL").select("id", F.round(V.l2_norm(F.col("embedding")), 6).alias("norm"))


def l2_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Element by element, so that a comparison sees every value."""
    v = _t(spark, d, "chunks").where("embedding IS NOT NULL").select("id", F.posexplode(V.l2_normalize(F.col("embedding"))).alias("pos", "value"))
    return v.select("id", F.col("pos").cast("int").alias("pos"), F.round("value", 6).alias("value"))


def fit_width(spark: SparkSession, d: str) -> DataFrame:
    v = V.fit_width(F.col("embedding"), 70)
    total = F.aggregate(v, F.lit(0.0), lambda a, x: a + x)
    return _t(spark, d, "chunks").where("embedding IS NOT NULL").select("id", F.size(v).cast("long").alias("width"), F.round(total, 6).alias("total"), F.round(F.get(v, F.lit(63)), 6).alias("v63"))


# ------------------------------------------------------------------ text

_S = r"[\s\p{Z}\x{85}]"
_BAD = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def _sql_clean(x: str) -> str:
    t = f"regexp_replace(coalesce({x}, ''), '{_BAD}', '', 'g')"
    t = rf"regexp_replace({t}, '\r\n?', chr(10), 'g')"
    t = rf"regexp_replace({t}, '[ \t\x{{a0}}\x{{2007}}\x{{202f}}]+', ' ', 'g')"
    t = rf"regexp_replace({t}, '{_S}*\n{_S}*', chr(10), 'g')"
    return f"regexp_replace(regexp_replace({t}, '^{_S}+', ''), '{_S}+$', '')"


def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", T.clean_text(F.col("text"), unescape=False).alias("text"))


def dedupe_lines(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "site_documents").where("raw_text IS NOT NULL").select("id", T.dedupe_lines(F.col("raw_text")).alias("text"))


def clean_plain(spark: SparkSession, d: str) -> DataFrame:
    """What ingest does with fetched plain text, HTML references included."""
    return _t(spark, d, "raw_docs").where("content_kind = 'text'").select("raw_id", T.clean_plain(F.col("raw")).alias("text"))


def strip_boilerplate(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "site_documents").where("raw_text IS NOT NULL").select("id", T.strip_boilerplate(F.col("raw_text"), None, unescape=False).alias("text"))


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.size(T.paragraphs(F.col("text"))).cast("long").alias("n"), F.array_join(T.paragraphs(F.col("text")), "|").alias("joined"))


def detect_lang(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select("doc_id", T.detect_lang(F.col("text")).alias("lang"))


def lang_counts(spark: SparkSession, d: str) -> DataFrame:
    lang = T.resolve_lang(F.col("lang"), F.col("raw_text"))
    return _t(spark, d, "site_documents").groupBy(lang.alias("lang")).agg(F.count("*").alias("n"))


def token_count(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.token_count(F.col("text")).cast("long").alias("n"))


def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    s = F.filter(F.transform(T.sentences(F.col("text")), T.strip), lambda x: x != "")
    return _t(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.size(s).cast("long").alias("n"), F.array_join(s, "|").alias("joined"))


def min_doc_filter(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").where(F.length(T.clean_text(F.col("text"), unescape=False)) >= 120).select("doc_id")


_CJK = r"[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]"


def _sql_plain(x: str) -> str:
    """Cleaned, without lines equal to the line before, cleaned again. The plain texts' references are the usual six."""
    def unescaped(y: str) -> str:
        for a, b in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&nbsp;", "chr(160)"), ("&amp;", "'&'")):
            y = f"replace({y}, '{a}', {b})"
        return _sql_clean(y)

    lines = f"string_split({unescaped(x)}, chr(10))"
    kept = f"array_to_string(list_transform(list_filter(range(1, len({lines}) + 1), lambda i: i = 1 OR ({lines})[i] <> ({lines})[i - 1]), lambda i: ({lines})[i]), chr(10))"
    return unescaped(kept)


def _sql_lang(x: str) -> str:
    head = f"left(coalesce({x}, ''), 2000)"
    return f"CASE WHEN {head} = '' THEN 'unknown' WHEN len(regexp_extract_all({head}, '{_CJK}')) / greatest(1, length(regexp_replace({head}, '{_S}+', '', 'g')))::DOUBLE > 0.2 THEN 'zh' ELSE 'en' END"


_TOKENS = r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}]|[a-zA-Z0-9]+(?:[''’\-][a-zA-Z0-9]+)*|[^\s\p{Z}\x{0b}\x{85}]"
_STRIP = f"regexp_replace(regexp_replace(%s, '^{_S}+', ''), '{_S}+$', '')"
_BOIL = ("(?is)(cookie|privacy|terms of use|all rights reserved|©|©️)[^\\n]{0,120}", "(?i)(本网站|版权所有|保留所有权利|使用条款|隐私政策|免责声明)[^\\n]*", "(?i)(微信|公众号|扫码|关注我们|订阅我们|下载应用)[^\\n]*")


def _sql_boil(x: str) -> str:
    for p in _BOIL:
        x = f"regexp_replace({x}, '{p}', ' ', 'g')"
    return _sql_clean(x)


_MARKS = "。！？!?.;；"
_W = r"[\s\p{Z}\x{85}\x{0b}\x{1c}-\x{1f}]"
#: Sentences are tiles of the text; those of more than 512 tokens are cut at every 512th token. `ps` are the tokens before each span: a
#: chunk takes as many spans as fit, and the next begins with as many of its last ones as the overlap allows.
_CHUNKS = rf"""
WITH RECURSIVE t AS (SELECT doc_id, text, regexp_extract_all(text, '[^{_MARKS}\n]*[{_MARKS}]{_W}*|[^{_MARKS}\n]+\n*|\n+') AS tiles FROM documents WHERE text <> ''),
s AS (SELECT doc_id, i, list_sum(list_transform(tiles[1 : i - 1], lambda x: length(x)))::BIGINT AS begins,
        regexp_extract(tiles[i], '^(?:[^{_MARKS}\n]*[{_MARKS}]|[^{_MARKS}\n]+)') AS sentence FROM t, LATERAL unnest(range(1, len(tiles) + 1)) AS u(i)),
w AS (SELECT doc_id, i, coalesce(begins, 0) AS begins, length(sentence) AS size, regexp_extract_all(sentence, '{_W}*(?:{_TOKENS})') AS w FROM s WHERE sentence <> ''),
c AS (SELECT doc_id, i, k, CASE WHEN k = 0 THEN begins ELSE begins + list_sum(list_transform(w[1 : k], lambda x: length(x))) + length(w[k + 1]) - length(regexp_replace(w[k + 1], '^{_W}+', '')) END AS a,
        begins + size AS ends, least(512, len(w) - k) AS n FROM w, LATERAL unnest(range(0, len(w), 512)) AS u(k)),
b AS (SELECT doc_id, i, k, a, n, coalesce(lead(a) OVER (PARTITION BY doc_id, i ORDER BY k), ends) AS z FROM c),
p AS (SELECT doc_id, list(a ORDER BY i, k) AS st, list(z ORDER BY i, k) AS en, list(n ORDER BY i, k) AS n, count(*) AS m FROM b GROUP BY doc_id),
q AS (SELECT doc_id, st, en, m, n, list_prepend(0, list_transform(range(1, m + 1), lambda j: list_sum(n[1 : j])::BIGINT)) AS ps FROM p),
r AS (
  SELECT doc_id, 0::BIGINT AS f, list_max(list_filter(range(1, m + 1), lambda j: ps[j + 1] <= 512)) AS e FROM q
  UNION ALL
  SELECT doc_id, f, list_max(list_filter(range(f + 1, m + 1), lambda j: ps[j + 1] - ps[f + 1] <= 512)) FROM (
    SELECT q.doc_id, q.m, q.ps, CASE WHEN ps[e + 1] - ps[k + 1] + n[e + 1] > 512 THEN e ELSE k END AS f FROM (
      SELECT r.doc_id AS id, r.e, list_min(list_filter(range(r.f + 1, r.e + 1), lambda j: x.ps[r.e + 1] - x.ps[j + 1] <= 100)) AS k FROM r JOIN q x ON x.doc_id = r.doc_id WHERE r.e < x.m) y
    JOIN q ON q.doc_id = y.id)),
o AS (SELECT r.doc_id, r.f, ps[r.e + 1] - ps[r.f + 1] AS n, regexp_replace(regexp_replace(substring(text, CAST(st[r.f + 1] + 1 AS BIGINT), CAST(en[r.e] - st[r.f + 1] AS BIGINT)), '^{_W}+', ''), '{_W}+$', '') AS chunk_text
      FROM r JOIN q USING (doc_id) JOIN t USING (doc_id))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY f) - 1 AS INTEGER) AS chunk_index, chunk_text, CAST(length(chunk_text) AS INTEGER) AS char_length, CAST(n AS INTEGER) AS token_count
FROM o WHERE length(chunk_text) >= 80"""

# ------------------------------------------------------------------ terms


def tfidf_terms(spark: SparkSession, d: str) -> DataFrame:
    t = T.terms(F.col("chunk_text"))
    return _t(spark, d, "chunks").where("chunk_text IS NOT NULL").select("id", F.size(t).cast("long").alias("n"), F.array_join(t, " ").alias("terms"))


def doc_freq(spark: SparkSession, d: str) -> DataFrame:
    return E.document_frequencies(_t(spark, d, "chunks"), "chunk_text")


def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "chunks").where("chunk_text IS NOT NULL")
    return E.term_weights(rows, "id", "chunk_text").select("id", "term", F.round("weight", 6).alias("weight"))


_I = r"^[\x{3400}-\x{9fff}\x{f900}-\x{faff}]$"
_TERMS = rf"""
w AS (SELECT id, regexp_extract_all(lower(chunk_text), '[a-zA-Z0-9]+(?:[''’\-][a-zA-Z0-9]+)*|[\x{{3400}}-\x{{9fff}}\x{{f900}}-\x{{faff}}]') AS w FROM chunks WHERE chunk_text IS NOT NULL),
t AS (SELECT id, flatten(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i < len(w) AND regexp_matches(w[i], '{_I}') AND regexp_matches(w[i + 1], '{_I}') THEN [w[i], w[i] || w[i + 1]] ELSE [w[i]] END)) AS terms FROM w)"""

# ------------------------------------------------------------------ rows


def equidistant_sample(spark: SparkSession, d: str) -> DataFrame:
    return S.equidistant(_t(spark, d, "raw_docs").select("raw_id", "source"), 7, "source", ["raw_id"])


def source_cap(spark: SparkSession, d: str) -> DataFrame:
    """Each source's first documents, as many as the registry allows, of the least length it demands."""
    sources = _t(spark, d, "sources").select("source", "page_cap", "min_chars")
    rows = _t(spark, d, "site_documents").select("id", "source", F.length("raw_text").alias("n")).join(sources, "source")
    long = rows.where(F.col("n") >= F.coalesce("min_chars", F.lit(0)))
    return S.positions(long, "source", ["id"]).where(F.col("_pos") < F.col("page_cap")).select("id", "source")


def new_documents(spark: SparkSession, d: str) -> DataFrame:
    return S.new_rows(_t(spark, d, "raw_docs"), _t(spark, d, "site_documents"), ["source", "source_url"]).select("raw_id")


def one_per_url(spark: SparkSession, d: str) -> DataFrame:
    return S.one_per_key(_t(spark, d, "site_documents").select("source", "source_url", "id"), ["source", "source_url"], ["id"])


def merge_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages fetched several times as the parts of one document, in the order of their keys."""
    rows = _t(spark, d, "raw_docs").where("content_kind = 'text' AND raw IS NOT NULL").select("raw_id", F.col("source_url").alias("doc_key"), "source", "source_url", F.col("raw").alias("text"))
    parts = S.positions(rows, "doc_key", ["raw_id"]).withColumn("part", F.col("_pos").cast("int"))
    return X.merge_pages(parts).select("source", "doc_key", "raw", F.size("sub_pages").cast("long").alias("n_sub"))


def link_extract(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_docs").where("content_kind = 'html'").select("raw_id", F.posexplode(U.links(F.col("raw"), LINK)).alias("pos", "link")).select("raw_id", F.col("pos").cast("long").alias("pos"), "link")


def url_parts(spark: SparkSession, d: str) -> DataFrame:
    u = F.col("source_url")
    return _t(spark, d, "raw_docs").select("raw_id", U.host(u).alias("host"), U.last_segment(u).alias("slug"), U.depth(u).cast("long").alias("depth"), F.array_join(U.path_parts(u), "|").alias("parts"))


def metadata_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of each document, put into its metadata where that says nothing about them."""
    n = _t(spark, d, "chunks").groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias("n"))
    meta = St.with_chunk_count(F.col("doc_metadata"), F.col("n"))
    return _t(spark, d, "site_documents").join(n, "id").select("id", F.get_json_object(meta, "$.chunks").cast("long").alias("chunks"))


def chunk_orphans(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "site_documents").where("raw_text IS NOT NULL")
    return St.orphans(docs, _t(spark, d, "chunks")).groupBy("document_id").agg(F.count("*").alias("n"))


def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    return St.chunk_stats(_t(spark, d, "chunks"))


# ------------------------------------------------------------------ pages, chunks, models, store


def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "raw_docs").select("raw_id", X.clean_raw(F.col("raw"), F.col("content_kind")).alias("text"))


def extract_pages(spark: SparkSession, d: str) -> DataFrame:
    pages = _t(spark, d, "raw_docs").where("content_kind = 'html'").select("raw_id", F.lit("page").alias("source"), "source_url", F.col("raw").alias("html"))
    return X.extract(pages, {"page": PAGE_SPEC}).select("raw_id", "title", "raw", "doc_metadata")


def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    return C.chunk_documents(_t(spark, d, "documents").select("doc_id", "text"), "text", ChunkConfig(512, 100, 80))


def chunk_totals(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of all chunks without overlap and floor: as many as the documents have."""
    c = C.chunk_documents(_t(spark, d, "documents").select("doc_id", "text"), "text", ChunkConfig(overlap=0, min_chunk=0))
    return c.groupBy("doc_id").agg(F.sum("token_count").alias("n"))


def _lsa(spark: SparkSession, d: str) -> tuple[E.LsaModel, DataFrame]:
    rows = _t(spark, d, "chunks").where("chunk_text IS NOT NULL").select("id", "document_id", "chunk_index", "chunk_text")
    return E.fit_lsa(rows, "chunk_text", EmbeddingConfig()), rows


def lsa_embed(spark: SparkSession, d: str) -> DataFrame:
    model, packed = E.fit_packed(_t(spark, d, "chunks"), "chunk_text", EmbeddingConfig(), keep=("id",))
    return model.embed_packed(packed)


def lsa_search(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "chunks").where("chunk_text IS NOT NULL").select("id", "document_id", "chunk_index", "chunk_text")
    model, packed = E.fit_packed(rows, "chunk_text", EmbeddingConfig(), keep=("id", "document_id", "chunk_index"))
    vector = model.embed_query(spark, "慢性肾结石的临床表现")
    return Q.search_chunks(_t(spark, d, "site_documents"), rows, vector, 5, vectors=model.embed_packed(packed))


def _load(spark: SparkSession, d: str, times: int) -> list[dict]:
    raw = R.from_texts(_t(spark, d, "documents"))
    with tempfile.TemporaryDirectory() as own:
        # nothing from the environment: a query gives one result
        config = replace(Config(), warehouse=_warehouse(spark, own), chunk=ChunkConfig(512, 100, 80), min_text=120)
        store = St.Store(spark, config.warehouse)
        got = [St.load(store, raw, config) for _ in range(times)]
        store.drop()
    return got


def _warehouse(spark: SparkSession, own: str) -> str:
    import uuid

    named = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared_dir(spark)}/store-{uuid.uuid4().hex}" if named or not spark.sparkContext.master.startswith("local") else f"file://{own}/store"


def ingest_stats(spark: SparkSession, d: str) -> DataFrame:
    """Documents by language as a load counts them."""
    langs = _load(spark, d, 1)[0]["langs"]
    return spark.createDataFrame(sorted(langs.items()), "lang string, n long")


def ingest_idempotent(spark: SparkSession, d: str) -> DataFrame:
    first, second = _load(spark, d, 2)
    return spark.createDataFrame([(first["documents"], second["documents"], second["chunks"])], "first long, second long, second_chunks long")


_QUERIES = (
    topk_single, topk_filtered, topk_batched, topk_indexed, search_chunks, search_chunks_filtered,
    l2_norm, l2_normalize, fit_width,
    clean_text, dedupe_lines, clean_plain, strip_boilerplate, paragraphs, detect_lang, lang_counts, token_count, sentence_split, min_doc_filter,
    tfidf_terms, doc_freq, tfidf_weights,
    equidistant_sample, source_cap, new_documents, one_per_url, merge_pages, link_extract, url_parts, metadata_chunks, chunk_orphans, chunk_stats,
    html_to_text, extract_pages, chunk_documents, chunk_totals, lsa_embed, lsa_search, ingest_stats, ingest_idempotent,
)

_FIRST = "SELECT min(id) AS id, source, source_url FROM site_documents GROUP BY source, source_url"
_SQL = {
    "topk_single": f"SELECT vec_id, label, round(s, 4) AS similarity FROM (SELECT vec_id, label, {_COSINE.format('embedding')} AS s FROM embeddings ORDER BY s DESC, vec_id LIMIT 5)",
    "topk_filtered": f"SELECT vec_id, label, round(s, 4) AS similarity FROM (SELECT vec_id, label, {_COSINE.format('embedding')} AS s FROM embeddings WHERE label IN (1, 3, 5) ORDER BY s DESC, vec_id LIMIT 5)",
    "topk_batched": """SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(s, 4) AS similarity FROM (
  SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS s,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(s, 12) DESC, e.vec_id) AS rank
  FROM embeddings q JOIN embeddings e ON q.vec_id % 100 = 0) WHERE rank <= 5""",
    "search_chunks": _SEARCH % "",
    "search_chunks_filtered": _SEARCH % "AND d.source IN ('qinglan', 'hemu', 'wellspring')",
    "l2_norm": "SELECT id, round(sqrt(coalesce(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 0)), 6) AS norm FROM chunks WHERE embedding IS NOT NULL",
    "l2_normalize": """SELECT id, CAST(i - 1 AS INTEGER) AS pos, round(e[i] / CASE WHEN n = 0 THEN 1 ELSE n END, 6) AS value FROM (
  SELECT id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM chunks WHERE embedding IS NOT NULL), LATERAL unnest(range(1, len(e) + 1)) AS t(i)""",
    "fit_width": "SELECT id, len(e) AS width, round(list_sum(e), 6) AS total, round(e[64], 6) AS v63 FROM (SELECT id, list_resize(embedding::DOUBLE[], 70, 0.0::DOUBLE) AS e FROM chunks WHERE embedding IS NOT NULL)",
    "clean_text": f"SELECT doc_id, {_sql_clean('text')} AS text FROM documents",
    "clean_plain": f"SELECT raw_id, {_sql_plain("coalesce(raw, '')")} AS text FROM raw_docs WHERE content_kind = 'text'",
    "dedupe_lines": "SELECT id, array_to_string(list_transform(list_filter(range(1, len(p) + 1), lambda i: i = 1 OR p[i] <> p[i - 1]), lambda i: p[i]), chr(10)) AS text FROM (SELECT id, string_split(raw_text, chr(10)) AS p FROM site_documents WHERE raw_text IS NOT NULL)",
    "strip_boilerplate": f"SELECT id, {_sql_boil('raw_text')} AS text FROM site_documents WHERE raw_text IS NOT NULL",
    "paragraphs": rf"""SELECT doc_id, len(p) AS n, array_to_string(p, '|') AS joined FROM (
  SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\n{_S}*\n'), lambda x: {_STRIP % 'x'}), lambda x: x <> '') AS p FROM documents WHERE text IS NOT NULL)""",
    "detect_lang": f"SELECT doc_id, {_sql_lang('text')} AS lang FROM documents",
    "lang_counts": f"SELECT coalesce(nullif(lang, ''), {_sql_lang('raw_text')}) AS lang, count(*) AS n FROM site_documents GROUP BY 1",
    "token_count": f"SELECT doc_id, len(regexp_extract_all(text, '{_TOKENS}')) AS n FROM documents WHERE text IS NOT NULL",
    "sentence_split": rf"""SELECT doc_id, len(s) AS n, array_to_string(s, '|') AS joined FROM (
  SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^。！？!?.;；\n]*[。！？!?.;；]|[^。！？!?.;；\n]+'), lambda x: {_STRIP % 'x'}), lambda x: x <> '') AS s FROM documents WHERE text IS NOT NULL)""",
    "min_doc_filter": f"SELECT doc_id FROM documents WHERE length({_sql_clean('text')}) >= 120",
    "tfidf_terms": f"WITH {_TERMS} SELECT id, len(terms) AS n, array_to_string(terms, ' ') AS terms FROM t",
    "doc_freq": f"WITH {_TERMS}, u AS (SELECT id, unnest(terms) AS term FROM t) SELECT term, count(DISTINCT id) AS df, count(*) AS tf FROM u GROUP BY term",
    "tfidf_weights": f"""WITH {_TERMS}, u AS (SELECT id, unnest(terms) AS term FROM t), c AS (SELECT id, term, count(*) AS tf FROM u GROUP BY ALL),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM chunks WHERE chunk_text IS NOT NULL)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM c GROUP BY term),
x AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM c JOIN i USING (term)), n AS (SELECT id, sqrt(sum(w * w)) AS n FROM x GROUP BY id)
SELECT id, term, round(w / n, 6) AS weight FROM x JOIN n USING (id)""",
    "equidistant_sample": """WITH p AS (SELECT raw_id, source, row_number() OVER (PARTITION BY source ORDER BY raw_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM raw_docs)
SELECT raw_id, source FROM p WHERE n <= 7 OR list_contains(list_transform(range(0, 7), lambda i: floor(i * (n / 7.0::DOUBLE))), pos::DOUBLE)""",
    "source_cap": """SELECT id, source FROM (SELECT d.id, d.source, s.page_cap, row_number() OVER (PARTITION BY d.source ORDER BY d.id) AS r
FROM site_documents d JOIN sources s USING (source) WHERE length(d.raw_text) >= coalesce(s.min_chars, 0)) WHERE r <= page_cap""",
    "new_documents": "SELECT raw_id FROM raw_docs r WHERE NOT EXISTS (SELECT 1 FROM site_documents d WHERE d.source = r.source AND d.source_url = r.source_url)",
    "one_per_url": f"SELECT source, source_url, id FROM ({_FIRST})",
    "merge_pages": """WITH p AS (SELECT raw_id, source, source_url AS doc_key, raw, row_number() OVER (PARTITION BY source_url ORDER BY raw_id) - 1 AS part FROM raw_docs WHERE content_kind = 'text' AND raw IS NOT NULL)
SELECT source, doc_key, coalesce(string_agg(raw, chr(10) || chr(10) ORDER BY part) FILTER (raw <> ''), '') AS raw, count(*) FILTER (part > 0) AS n_sub FROM p WHERE part = 0 OR length(raw) > 120 GROUP BY source, doc_key""",
    "link_extract": f"""WITH l AS (SELECT raw_id, regexp_extract_all(raw, '{LINK}', 1) AS l FROM raw_docs WHERE content_kind = 'html'),
u AS (SELECT raw_id, l[i] AS link, min(i) AS first FROM l, LATERAL unnest(range(1, len(l) + 1)) AS t(i) GROUP BY ALL)
SELECT raw_id, row_number() OVER (PARTITION BY raw_id ORDER BY first) - 1 AS pos, link FROM u""",
    "url_parts": r"""SELECT raw_id, regexp_extract(source_url, '^[a-z][a-z0-9+.\-]*://([^/?#]*)', 1) AS host, string_split(source_url, '/')[-1] AS slug, len(string_split(source_url, '/')) - 1 AS depth,
replace(regexp_replace(regexp_replace(regexp_replace(source_url, '^[a-z][a-z0-9+.\-]*://[^/]*', ''), '[?#].*$', ''), '^/+|/+$', '', 'g'), '/', '|') AS parts FROM raw_docs""",
    "metadata_chunks": "SELECT d.id, CAST(coalesce(json_extract_string(d.doc_metadata, '$.chunks'), n::VARCHAR) AS BIGINT) AS chunks FROM site_documents d JOIN (SELECT document_id AS id, count(*) AS n FROM chunks GROUP BY 1) USING (id)",
    "chunk_orphans": "SELECT document_id, count(*) AS n FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM site_documents d WHERE d.id = c.document_id AND d.raw_text IS NOT NULL) GROUP BY 1",
    "chunk_stats": "SELECT document_id, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens, CAST(sum(char_length) AS BIGINT) AS characters FROM chunks GROUP BY 1",
    "chunk_documents": _CHUNKS,
    "chunk_totals": f"SELECT doc_id, len(regexp_extract_all(text, '{_TOKENS}')) AS n FROM documents WHERE len(regexp_extract_all(coalesce(text, ''), '{_TOKENS}')) > 0",
    "ingest_stats": f"WITH t AS (SELECT {_sql_clean('text')} AS t FROM documents) SELECT {_sql_lang('t')} AS lang, count(*) AS n FROM t WHERE length(t) >= 120 GROUP BY 1",
    "ingest_idempotent": f"SELECT count(*) AS first, 0::BIGINT AS second, 0::BIGINT AS second_chunks FROM documents WHERE length({_sql_clean('text')}) >= 120",
}


def entry(spark: SparkSession) -> DataFrame:
    return topk_filtered(spark, "/root/testdata/sf0.001")


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


__all__ = ["entry", "materialize", "oracle_sql", "pipeline", "queries"]
