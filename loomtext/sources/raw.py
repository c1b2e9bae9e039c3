"""Raw documents as DataFrames: from sites (a Python data source), page tables and files."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..config import CrawlConfig
from ..functions import urls
from ..functions.bytes import body_text
from .sites import crawl, get_sites

RAW_SCHEMA = "source string, source_name string, source_url string, title string, doc_metadata string, raw string, content_kind string, page_number int, lang string"
_COLUMNS = [x.split()[0] for x in RAW_SCHEMA.split(", ")]


class _SitePartition(InputPartition):
    def __init__(self, key: str):
        self.key = key


class _SiteReader(DataSourceReader):
    def __init__(self, options: dict):
        self.sites = [x for x in options.get("sites", "").split(",") if x]
        self.max_pages = int(options.get("max_pages", "0")) or None
        keys = {k.lower(): k for k in CrawlConfig.__dataclass_fields__}
        kinds = {"delay": float, "timeout": int, "max_retries": int, "max_pages": int, "respect_robots": lambda x: x.lower() == "true"}
        given = {keys[k]: kinds.get(keys[k], str)(v) for k, v in options.items() if k in keys and k != "max_pages"}
        self.config = CrawlConfig(**given)

    def partitions(self):
        # a site is one partition, so its requests keep their pace
        return [_SitePartition(s.key) for s in get_sites(self.sites or None)]

    def read(self, partition: _SitePartition) -> Iterator[tuple]:
        for d in crawl(get_sites([partition.key])[0], self.config, self.max_pages):
            yield tuple(json.dumps(d[c], ensure_ascii=False) if c == "doc_metadata" else d[c] for c in _COLUMNS)


class SitesDataSource(DataSource):
    """spark.read.format("loomtext_sites").option("sites", "a,b").option("max_pages", 5).load()"""

    @classmethod
    def name(cls) -> str:
        return "loomtext_sites"

    def schema(self) -> str:
        return RAW_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _SiteReader({k.lower(): v for k, v in self.options.items()})


def read_sites(spark: SparkSession, sites: list[str] | None = None, max_pages: int | None = None) -> DataFrame:
    spark.dataSource.register(SitesDataSource)
    return spark.read.format("loomtext_sites").option("sites", ",".join(sites or [])).option("max_pages", str(max_pages or 0)).load()


def from_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Raw documents of a table of fetched pages; the source is the host."""
    return pages.select(
        urls.host(F.col(url)).alias("source"),
        urls.host(F.col(url)).alias("source_name"),
        F.col(url).alias("source_url"),
        F.nullif(F.regexp_extract(html, r"(?is)<h1[^>]*>([^<]*)</h1>", 1), F.lit("")).alias("title"),
        F.lit("{}").alias("doc_metadata"),
        F.col(html).alias("raw"),
        F.lit("html").alias("content_kind"),
        F.lit(None).cast("int").alias("page_number"),
        F.lit(None).cast("string").alias("lang"),
    )


def from_texts(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Raw documents of a table of plain texts; the address is source/key."""
    return df.select(
        F.col(source).alias("source"),
        F.col(source).alias("source_name"),
        F.concat_ws("/", source, F.col(key).cast("string")).alias("source_url"),
        F.lit(None).cast("string").alias("title"),
        F.lit("{}").alias("doc_metadata"),
        F.col(text).alias("raw"),
        F.lit("text").alias("content_kind"),
        F.lit(None).cast("int").alias("page_number"),
        F.lit(None).cast("string").alias("lang"),
    )


def from_files(spark: SparkSession, path: str, encoding: str = "utf-8-sig") -> DataFrame:
    """(path, body) of files, unpacked by their first bytes and decoded."""
    return spark.read.format("binaryFile").load(path).select("path", body_text(F.col("content"), encoding).alias("body"))


def sitemap_urls(body, contains: str | None = None, min_slashes: int = 0):
    """Array of a sitemap's addresses in order, those that contain a part and have so many slashes."""
    found = F.regexp_extract_all(body, F.lit(r"<loc>([^<]+)</loc>"), F.lit(1))
    keep = lambda u: (F.lit(True) if contains is None else F.contains(u, F.lit(contains))) & (F.size(F.split(u, "/")) - 1 >= min_slashes)
    return F.filter(found, keep)
