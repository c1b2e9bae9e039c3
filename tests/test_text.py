import html
import re

import pytest
from pyspark.sql import functions as F

from loomtext.functions import bytes as B
from loomtext.functions import text as T
from loomtext.functions import urls as U


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


CLEAN = {
    None: "",
    "": "",
    "a&amp;lt;b": "a&lt;b",
    "a\x00b\x1fc\x7f": "abc",
    "a\r\nb\rc": "a\nb\nc",
    "  a \t b  ": "a b",
    "　行首\n\n \n行尾　": "行首\n行尾",
    "a  b c": "a b c",
}


@pytest.mark.parametrize("given", CLEAN)
def test_clean_text(spark, given):
    assert one(spark, T.clean_text, given) == CLEAN[given]


def reference_clean(t):
    t = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", html.unescape(t or "")).replace("\r\n", "\n").replace("\r", "\n")
    lines = (re.sub("[ \t   ]+", " ", x).strip() for x in t.split("\n"))
    return "\n".join(x for x in lines if x)


def test_clean_text_as_in_python(spark, small):
    rows = spark.read.parquet(f"{small}/raw_docs.parquet").where("content_kind = 'text'").select("raw", T.clean_text(F.col("raw")).alias("t")).collect()
    rows += spark.read.parquet(f"{small}/documents.parquet").select(F.col("text").alias("raw"), T.clean_text(F.col("text")).alias("t")).collect()
    assert rows and all(r["t"] == reference_clean(r["raw"]) for r in rows)


def test_pipeline_cleaning_unescapes_twice(spark):
    assert one(spark, T.clean_plain, "&amp;lt;") == "<"


@pytest.mark.parametrize("given,want", [("a\na\nb\na", "a\nb\na"), ("a", "a"), ("", ""), (None, None), ("x\nx\nx", "x"), ("a\nab\nb", "a\nab\nb"), ("\n\na", "\na")])
def test_dedupe_lines(spark, given, want):
    assert one(spark, T.dedupe_lines, given) == want


@pytest.mark.parametrize(
    "given,want",
    [
        (None, "unknown"),
        ("", "unknown"),
        ("   ", "en"),
        ("病病abcdefgh", "en"),  # exactly a fifth
        ("病病病abcdefg", "zh"),
        ("ひらがな", "zh"),
        ("a" * 2000 + "病" * 5000, "en"),  # only the beginning counts
    ],
)
def test_detect_lang(spark, given, want):
    assert one(spark, T.detect_lang, given) == want


def test_resolve_lang(spark):
    rows = spark.createDataFrame([("de", "病病病"), ("", "病病病"), (None, "abc")], "l string, t string")
    assert [r[0] for r in rows.select(T.resolve_lang(F.col("l"), F.col("t"))).collect()] == ["de", "zh", "en"]


def test_tokens(spark):
    assert one(spark, T.tokens, "2型糖尿病 don't é。") == ["2", "型", "糖", "尿", "病", "don't", "é", "。"]
    assert one(spark, T.token_count, "a　b") == 2
    assert one(spark, T.token_count, "") == 0 and one(spark, T.token_count, None) is None


def test_sentences(spark):
    assert one(spark, T.sentences, "甲。乙！丙；3.5 mg.\n\n丁") == ["甲。", "乙！", "丙；", "3.", "5 mg.", "丁"]


def test_terms_pair_across_punctuation(spark):
    assert one(spark, T.terms, "病。因 Don't é") == ["病", "病因", "因", "don't"]
    assert one(spark, T.terms, "") == [] and one(spark, T.terms, "!") == []


def test_strip_boilerplate(spark):
    assert one(spark, T.strip_boilerplate, "正文\n版权所有 某站\nWe use COOKIES here") == "正文\nWe use"
    assert one(spark, lambda c: T.strip_boilerplate(c, 2), "正文内容") == "正文"


def test_paragraphs(spark):
    assert one(spark, T.paragraphs, " a\n \nb\n\n\nc ") == ["a", "b", "c"]


def test_urls(spark):
    u = "https://h.example/a/b/c.html?x=1#y"
    assert one(spark, U.host, u) == "h.example"
    assert one(spark, U.path_parts, u) == ["a", "b", "c.html"]
    assert one(spark, lambda c: U.join_url("https://h.example/d/", c), "/x") == "https://h.example/x"
    assert one(spark, lambda c: U.join_url("https://h.example/d/", c), "x") == "https://h.example/d/x"
    assert one(spark, lambda c: U.join_url("https://h.example/d/", c), u) == u
    assert one(spark, U.quote, "糖 尿") == "%E7%B3%96%20%E5%B0%BF"
    assert one(spark, lambda c: U.links(c, r'href="(/[^"]+)"'), '<a href="/b"><a href="/a"><a href="/b">') == ["/b", "/a"]


def test_bytes(spark):
    import gzip

    bodies = [gzip.compress("﻿压缩".encode()), "﻿明文".encode(), "百日咳".encode("gbk"), b"\x1f\x8bbroken", None, b""]
    df = spark.createDataFrame([(b,) for b in bodies], "b binary")
    assert [r[0] for r in df.select(B.body_text(F.col("b"))).collect()][:2] == ["压缩", "明文"]
    assert [r[0] for r in df.select(B.body_text(F.col("b"))).collect()][3:] == ["", None, ""]
    assert df.select(B.gbk_text(F.col("b"))).collect()[2][0] == "百日咳"
