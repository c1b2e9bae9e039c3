"""Links and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def links(page: Column, pattern: str) -> Column:
    """Group 1 of every match of a pattern in page order, each once; null for null."""
    return F.array_distinct(F.regexp_extract_all(page, F.lit(pattern), F.lit(1)))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def path_parts(url: Column) -> Column:
    """Parts of the path without host, query and outer slashes."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z][a-z0-9+.\-]*://[^/]*", ""), r"[?#].*$", "")
    return F.split(F.regexp_replace(path, r"^/+|/+$", ""), "/")


def depth(url: Column) -> Column:
    """Number of slashes."""
    return F.size(F.split(url, "/")) - 1


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1)


def join_url(base: str, path: Column) -> Column:
    """An absolute path behind a host, an absolute address as it is, anything else below the base."""
    root = "/".join(base.split("/")[:3])
    below = base if base.endswith("/") else base.rsplit("/", 1)[0] + "/" if base.count("/") > 2 else base + "/"
    return F.when(path.rlike(r"^[a-z][a-z0-9+.\-]*://"), path).when(path.startswith("/"), F.concat(F.lit(root), path)).otherwise(F.concat(F.lit(below), path))


def quote(text: Column) -> Column:
    """Percent-encoded as in a path: a space is %20."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
