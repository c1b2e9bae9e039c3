import random
import re

from pyspark.sql import functions as F

from loomtext.config import ChunkConfig
from loomtext.operators import chunk as C

TOKEN = C._TOKEN


def check(text, size, overlap):
    spans = C.chunk_spans(text, size, overlap)
    ids = [m.start() for m in TOKEN.finditer(text)]
    seen = 0
    for a, b in spans:
        own = [i for i, p in enumerate(ids) if a <= p < b]
        assert own and len(own) <= size
        assert own[0] <= seen and own[-1] >= seen, "in order, with something new"
        seen = own[-1] + 1
    assert seen == len(ids)
    return spans


def test_invariants_on_random_texts():
    random.seed(3)
    for _ in range(200):
        text = "".join(random.choice(["病", "因", "。", "a", "b1", " ", "\n", ".", "don't", "；"]) for _ in range(random.randrange(0, 300)))
        for size, overlap in ((20, 5), (7, 7), (50, 0)):
            check(text, size, overlap)


def test_overlap_is_whole_sentences():
    text = "甲乙丙。" * 10
    spans = C.chunk_spans(text, 12, 5)
    assert [text[a:b] for a, b in spans][:2] == ["甲乙丙。" * 3] * 2
    assert spans[1][0] == 8


def test_overlap_of_the_size_or_more_is_a_quarter():
    text = "甲。" * 40
    assert C.chunk_spans(text, 20, 20) == C.chunk_spans(text, 20, 5)


def test_long_sentence_is_cut():
    assert [C.count(("字" * 1200)[a:b]) for a, b in C.chunk_spans("字" * 1200, 512, 100)] == [512, 512, 176]


def test_short_chunks_go_and_the_rest_is_numbered():
    got = C.chunk_text("字" * 600, ChunkConfig(size=512, overlap=0, min_chunk=100))
    assert [(c["chunk_index"], c["token_count"], c["char_length"]) for c in got] == [(0, 512, 512)]
    assert C.chunk_text("", ChunkConfig()) == [] and C.chunk_text(None) == [] and C.chunk_text("   ") == []


def test_rows(spark):
    df = spark.createDataFrame([(1, "字" * 600, "x"), (2, None, "y"), (3, "", "z")], "id int, text string, chunk_text string")
    got = C.chunk_documents(df, "text", ChunkConfig(size=512, overlap=100, min_chunk=0)).orderBy("chunk_index").collect()
    assert [(r["id"], r["chunk_index"], r["token_count"]) for r in got] == [(1, 0, 512), (1, 1, 88)]
    assert C.chunk_documents(df.where("false")).count() == 0


def test_tokens_as_the_column_function(spark, small):
    from loomtext.functions import text as T

    rows = spark.read.parquet(f"{small}/documents.parquet").where("text IS NOT NULL").select("text", T.token_count(F.col("text")).alias("n")).collect()
    assert all(C.count(r["text"]) == r["n"] for r in rows)
    assert re.findall(TOKEN, "a-b--c") == ["a-b", "-", "-", "c"]
