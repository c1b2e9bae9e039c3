import json
import os

import pytest
from pyspark.sql import functions as F

from loomtext.config import ChunkConfig, Config, EmbeddingConfig
from loomtext.operators import store as St
from loomtext.plans import pipeline
from loomtext.sources.raw import RAW_SCHEMA

LONG = "慢性肾结石的病因与治疗方案。" * 20
OTHER = "The onset of fever calls for a blood count and rest. " * 10


def raw(spark, rows):
    return spark.createDataFrame([(s, s, u, t, m, x, k, None, lang) for s, u, t, m, x, k, lang in rows], RAW_SCHEMA)


ROWS = [
    ("a", "u1", "t1", '{"x": 1}', LONG, "text", None),
    ("b", "u1", "t2", None, OTHER, "text", "fr"),
    ("a", "u2", None, '{"chunks": 7}', f"<article><p>{LONG}</p></article>", "html", ""),
    ("a", "u3", None, "{}", "太短", "text", None),
    ("a", "u1", "again", "{}", LONG + "x", "text", None),
    (None, None, None, None, None, None, None),
]


@pytest.fixture()
def config(tmp_path):
    return Config(warehouse=f"file://{tmp_path}/w", chunk=ChunkConfig(size=50, overlap=10, min_chunk=20), embedding=EmbeddingConfig(dim=8, components=4))


def test_load_twice(spark, config):
    store = St.Store(spark, config.warehouse)
    assert store.documents().count() == 0 and store.chunks().count() == 0
    first = St.load(store, raw(spark, ROWS), config)
    assert first["documents"] == 3 and first["langs"] == {"zh": 2, "fr": 1}
    assert store.chunks().count() == first["chunks"] > 3
    assert St.load(store, raw(spark, ROWS), config)["documents"] == 0
    meta = {(r["source"], r["source_url"]): json.loads(r["doc_metadata"]) for r in store.documents().collect()}
    assert meta[("a", "u2")] == {"chunks": 7} and meta[("a", "u1")]["x"] == 1 and meta[("a", "u1")]["chunks"] > 1 and set(meta[("b", "u1")]) == {"chunks"}
    assert store.has("b", "u1") and not store.has("b", "u2")
    assert St.orphans(store.documents(), store.chunks()).count() == 0


def test_a_load_that_broke_off_is_loaded_again(spark, config):
    store = St.Store(spark, config.warehouse)
    St.load(store, raw(spark, ROWS), config)
    St._delete(spark, f"{config.warehouse}/commits")
    assert store.chunks().count() == 0 == store.documents().count()
    got = St.load(store, raw(spark, ROWS), config)
    assert store.chunks().count() == got["chunks"] and store.documents().count() == got["documents"] == 3


def test_clashing_ids(spark):
    rows = spark.createDataFrame([("s", f"u{i}", i) for i in range(40)], "source string, source_url string, n int")
    taken = spark.createDataFrame([(3,), (5,)], "id long")
    few = lambda *c: F.pmod(F.xxhash64(*c), F.lit(61))
    got = St.with_ids(rows, taken, few).collect()
    assert len(got) == 40 == len({r["id"] for r in got}) and not {3, 5} & {r["id"] for r in got}
    # without a clash the id is the address's hash
    plain = St.with_ids(rows, taken).withColumn("h", F.xxhash64("source", "source_url")).where("id <> h").count()
    assert plain == 0 and St.with_ids(rows.where("false"), taken).count() == 0


def test_search_reads_what_it_needs(spark, config, capsys):
    from loomtext.operators.search import search_chunks

    pipeline.run(spark, raw(spark, ROWS), config=config)
    store = St.Store(spark, config.warehouse)
    vectors = store.embeddings(store.state()["version"])
    df = search_chunks(store.documents(), store.chunks(), [1.0] * 8, 2, ["a"], vectors)
    assert df.count() == 2 and {r["source"] for r in df.collect()} == {"a"}
    capsys.readouterr()
    df.explain("formatted")
    parts = capsys.readouterr().out.split("\n\n")
    scans = [x for x in parts if "ReadSchema" in x and "embedding:array" in x]
    assert scans and all("source" in next(y for y in x.split("\n") if "PartitionFilters" in y) for x in scans)
    # neither texts nor vectors are shuffled
    assert not any(") Exchange" in x and ("chunk_text" in x or "embedding" in x) for x in parts)


def test_scratch_needs_a_shared_folder(spark):
    from loomtext import scratch

    class Elsewhere:
        conf = type("c", (), {"get": staticmethod(lambda name, default=None: default)})
        sparkContext = type("s", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        scratch.shared_dir(Elsewhere)


def test_run_and_search(spark, config):
    out = pipeline.run(spark, raw(spark, ROWS), config=config)
    assert out["documents"] == 3 and out["embedding"] == "tfidf"
    hit = pipeline.search(spark, "肾结石的治疗", 2, config=config).collect()
    assert len(hit) == 2 and hit[0]["source"] == "a" and hit[0]["similarity"] > 0.5
    assert {r["source"] for r in pipeline.search(spark, "fever", 50, ["b"], config=config).collect()} == {"b"}
    state = St.Store(spark, config.warehouse).state()
    again = pipeline.run(spark, raw(spark, ROWS), config=config)
    assert again["documents"] == 0 and St.Store(spark, config.warehouse).state() == state
    more = pipeline.run(spark, raw(spark, [("c", "u9", None, "{}", "新的一段关于心肌炎的文字。" * 20, "text", None)]), config=config)
    assert more["documents"] == 1 and St.Store(spark, config.warehouse).state()["version"] != state["version"]
    assert pipeline.search(spark, "心肌炎", 1, config=config).first()["source"] == "c"
    assert spark.read.parquet(f"{config.warehouse}/embeddings").select("version").distinct().count() == 1
    assert pipeline.run(spark, raw(spark, ROWS[:1]), recreate=True, config=config)["documents"] == 1
    assert St.Store(spark, config.warehouse).documents().count() == 1


def test_empty_run(spark, config):
    assert pipeline.run(spark, raw(spark, []), config=config)["documents"] == 0
    assert pipeline.search(spark, "x", config=config).count() == 0


def test_streaming_ingest(spark, config, tmp_path):
    from loomtext.streaming import ingest

    folder = str(tmp_path / "in")
    raw(spark, ROWS).write.parquet(folder)
    for _ in range(2):
        ingest.start_ingest(ingest.read_stream(spark, folder), config, str(tmp_path / "cp")).awaitTermination()
        raw(spark, ROWS).write.mode("append").parquet(folder)
    assert St.Store(spark, config.warehouse).documents().count() == 3


def test_chunk_count_in_metadata(spark):
    df = spark.createDataFrame([(None,), ("{}",), ('{"a": {"b": 1}}',), ('{"chunks": 2}',)], "m string").select(St.with_chunk_count(F.col("m"), F.lit(5)))
    assert [json.loads(r[0]) for r in df.collect()] == [{"chunks": 5}, {"chunks": 5}, {"a": {"b": 1}, "chunks": 5}, {"chunks": 2}]


def test_command_line():
    from loomtext.__main__ import parser

    a = parser().parse_args(["search", "--query", "q", "--sites", "x", "y"])
    assert a.k == 5 and a.sites == ["x", "y"] and parser().parse_args(["ingest", "--recreate"]).recreate


def test_settings(monkeypatch, tmp_path):
    from loomtext import config as G

    (tmp_path / ".env").write_text("# c\nCHUNK_SIZE='77'\nEMBED_DIM=9\n")
    monkeypatch.setenv("EMBED_DIM", "5")
    monkeypatch.delenv("CHUNK_SIZE", raising=False)
    G.load_dotenv(tmp_path / ".env")
    assert G.ChunkConfig().size == 77 and G.EmbeddingConfig().dim == 5
    # set by the file, not by monkeypatch, which would put it back
    os.environ.pop("CHUNK_SIZE")
