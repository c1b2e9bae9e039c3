"""Sentence-aware overlapping chunks.

The packing rule: sentences are packed greedily up to `size` tokens; one longer than that is cut between tokens; the next chunk
starts with the longest run of whole sentences at the end of the last one that has at most `overlap` tokens, unless that and the
next sentence would not fit. Every chunk has something new, and the chunks cover every token in order.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..config import ChunkConfig

_TOKEN = re.compile(r"[㐀-鿿豈-﫿]|[a-zA-Z0-9]+(?:['’\-][a-zA-Z0-9]+)*|[^\s]")
_END = re.compile(r"(?<=[。！？!?\.;；])\s*|\n+")

CHUNK_TYPE = "array<struct<chunk_index:int,chunk_text:string,char_length:int,token_count:int>>"


def count(text: str) -> int:
    return sum(1 for _ in _TOKEN.finditer(text))


def _spans(text: str, starts: list[int], size: int) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the sentences; those beyond the size in runs of `size` tokens. No token crosses a sentence end."""
    out, at, first = [], 0, 0
    ends = [(m.start(), m.end()) for m in _END.finditer(text)] + [(len(text), len(text))]
    for a, b in ends:
        if a > at:
            last = bisect_left(starts, a, first)
            n = last - first
            for k in range(0, n, size):
                end = starts[first + k + size] if k + size < n else a
                out.append((starts[first + k] if k else at, end, min(size, n - k)))
            first = last
        at = max(at, b)
    return out


def _packed(spans: list[tuple[int, int, int]], size: int, overlap: int) -> list[tuple[int, int]]:
    if overlap >= size:
        overlap = max(0, size // 4)
    out: list[tuple[int, int]] = []
    first = i = total = 0
    while i < len(spans):
        n = spans[i][2]
        if total + n <= size or i == first:
            total += n
            i += 1
            continue
        out.append((spans[first][0], spans[i - 1][1]))
        k, kept = i, 0
        while k > first + 1 and kept + spans[k - 1][2] <= overlap:
            k -= 1
            kept += spans[k][2]
        if kept + n > size:
            k, kept = i, 0
        first, total = k, kept
        if k < i:
            total += n
            i += 1
    if first < len(spans):
        out.append((spans[first][0], spans[-1][1]))
    return out


def _starts(text: str) -> list[int]:
    return [m.start() for m in _TOKEN.finditer(text)]


def chunk_spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    return _packed(_spans(text, _starts(text), size), size, overlap)


def chunk_text(text: str | None, config: ChunkConfig | None = None) -> list[dict]:
    """The chunks of one text: index, text, characters, tokens. Chunks below min_chunk characters go and the rest is numbered anew."""
    c = config or ChunkConfig()
    if not text:
        return []
    rows: list[dict] = []
    starts = _starts(text)
    for a, b in _packed(_spans(text, starts, c.size), c.size, c.overlap):
        t = text[a:b].strip()
        if t and len(t) >= c.min_chunk:
            rows.append({"chunk_index": len(rows), "chunk_text": t, "char_length": len(t), "token_count": bisect_left(starts, b) - bisect_left(starts, a)})
    return rows


def chunks(text: Column, config: ChunkConfig | None = None) -> Column:
    """Array of chunks; empty for null and empty texts."""
    c = config or ChunkConfig()
    kind = pa.list_(pa.struct([("chunk_index", pa.int32()), ("chunk_text", pa.string()), ("char_length", pa.int32()), ("token_count", pa.int32())]))

    @arrow_udf(CHUNK_TYPE)
    def run(x: pa.Array) -> pa.Array:
        return pa.array([chunk_text(s, c) for s in x.to_pylist()], kind)

    return run(text)


def chunk_documents(df: DataFrame, text: str = "text", config: ChunkConfig | None = None) -> DataFrame:
    """df without `text`, a row for each chunk. A column of df named like a chunk's gives way to it; documents without chunks have no rows."""
    keep = [c for c in df.columns if c not in (text, "chunk_index", "chunk_text", "char_length", "token_count", "_chunks")]
    return df.withColumn("_chunks", chunks(F.col(text), config)).select(*keep, F.inline("_chunks"))
