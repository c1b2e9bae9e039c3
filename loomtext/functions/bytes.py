"""Bytes that Spark's decode() refuses or does not know: GBK pages and gzip bodies."""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

GZIP_MAGIC = b"\x1f\x8b"


def decode_body(data: bytes | None, encoding: str = "utf-8-sig", errors: str = "ignore") -> str | None:
    """Text of a body; it is unpacked if its first two bytes are gzip's, whatever the headers said. Broken gzip gives ''."""
    if data is None:
        return None
    if data.startswith(GZIP_MAGIC):
        try:
            data = gzip.decompress(data)
        except (OSError, EOFError, zlib.error):
            return ""
    return data.decode(encoding, errors)


def body_text(data: Column, encoding: str = "utf-8-sig", errors: str = "ignore") -> Column:
    @arrow_udf("string")
    def run(x: pa.Array) -> pa.Array:
        return pa.array([decode_body(b, encoding, errors) for b in x.to_pylist()], pa.string())

    return run(data)


def gbk_text(data: Column) -> Column:
    """GBK bytes as text; bytes that are none become U+FFFD."""
    return body_text(data, "gb18030", "replace")
