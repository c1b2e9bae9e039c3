"""Problem 4: lines that a source repeats across its documents.

Content-defined chunking: a rolling hash over the normalized line cuts it where the hash's low bits are zero, so equal lines have
equal chunks wherever they stand; a newline is a boundary too, because whole lines are to be removed. Distinct documents
are counted for each chunk and source; a line can only be repeated excessively if its chunks are, so its longest chunk picks
the candidates, and an exact count of their lines follows.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import common
from .neardup import _mix

WINDOW = 4
#: Low bits of the rolling hash that must be zero: chunks are 16 characters long on average.
BITS = 4
LEAST_ROWS, LEAST_SHARE = 5, 0.1

_SPACE = re.compile(r"[^\S\n]+")
_EDGE = re.compile(r"(?m)^ +| +$")
_DIGITS = re.compile(r"[0-9]+")
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def normalize_lines(text: str) -> list[str]:
    """The text's lines, trimmed, with one space for each run of whitespace and 0 for each run of digits."""
    return _EDGE.sub("", _DIGITS.sub("0", _SPACE.sub(" ", text))).split("\n")


def chunks(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of non-empty lines: (line of each chunk, chunk hash, chunk length, hash of each line)."""
    if not lines:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none.astype(np.uint64)
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes)
    newline = codes == 10
    mixed = _mix(codes + np.uint64(1))
    power = np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, _R))))
    inverse = np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, _R_INVERSE))))
    total = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(mixed * power[:n])))
    of = lambda start, end: _mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    ends = np.flatnonzero(newline)
    starts = np.concatenate(([0], ends[:-1] + 1))
    # the rolling hash of the WINDOW characters up to each place, none of them a newline
    cut = np.zeros(n, bool)
    if n >= WINDOW:
        m = n - WINDOW + 1
        roll = _mix((total[WINDOW:] - total[:m]) * inverse[:m])
        inside = np.ones(m, bool)
        for k in range(WINDOW):
            inside &= ~newline[k : k + m]
        cut[WINDOW - 1 :] = inside & (roll & np.uint64((1 << BITS) - 1) == 0)
    # a cut at the line's end is the newline's
    cut[:-1] &= ~newline[1:]
    begins = np.unique(np.concatenate((starts, np.flatnonzero(cut) + 1)))
    line = np.searchsorted(starts, begins, side="right") - 1
    stops = np.minimum(np.concatenate((begins[1:], [n])), ends[line])
    return line, of(begins, stops), stops - begins, of(starts, ends)


def _key(source: str | None) -> int:
    return int.from_bytes(blake2b(("" if source is None else "=" + source).encode(), digest_size=8).digest(), "little", signed=True)


def _flat(part: dict):
    """Documents of each line, line numbers, and chunks() of the lines that aren't empty."""
    doc, number, lines = [], [], []
    for i, text in enumerate(part["text"]):
        for k, line in enumerate(normalize_lines(text), 1):
            if line:
                doc.append(i)
                number.append(k)
                lines.append(line)
    keys = {s: _key(s) for s in set(part["source"])}
    src = np.array([keys[s] for s in part["source"]], np.int64)
    return np.array(doc, np.int64), np.array(number, np.int64), src, chunks(lines)


def _first(*columns: np.ndarray) -> np.ndarray:
    """Where a combination of values occurs for the first time."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for c in columns:
            x = c[order]
            new[1:] |= x[1:] != x[:-1]
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def _chunk_counts(part: dict) -> dict:
    """Documents of the slice by source and chunk: repeats within the slice meet before the shuffle."""
    doc, _, src, (line, h, _, _) = _flat(part)
    d, h = doc[line] if len(line) else doc, h.view(np.int64)
    once = _first(d, h)
    s, h = src[d[once]], h[once]
    order = np.lexsort((h, s))
    s, h = s[order], h[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(s)), bool), (s[1:] != s[:-1]) | (h[1:] != h[:-1]))))
    return {"src": pa.array(s[new]), "chunk": pa.array(h[new]), "n": pa.array(np.diff(np.append(new, len(s))).astype(np.int64))}


def _lines(part: dict) -> dict:
    """Each line with its longest chunk, and whether it is the document's first of that content."""
    doc, number, src, (line, h, size, whole) = _flat(part)
    ids = np.array(part["id"], np.int64)
    if not len(doc):
        empty = pa.array([], pa.int64())
        return {"id": empty, "line_no": empty, "src": empty, "chunk": empty, "line": empty, "first": empty}
    longest = np.lexsort((h, size, line))
    longest = longest[np.append(np.flatnonzero(np.diff(line[longest])), len(line) - 1)]
    whole = whole.view(np.int64)
    return {"id": pa.array(ids[doc]), "line_no": pa.array(number), "src": pa.array(src[doc]), "chunk": pa.array(h[longest].view(np.int64)), "line": pa.array(whole), "first": pa.array(_first(doc, whole).astype(np.int64))}


def repeated_lines(df: DataFrame, least_rows: int = LEAST_ROWS, least_share: float = LEAST_SHARE) -> DataFrame:
    """(id, line_no) of the lines of df's (id, source, text) that occur in at least `least_rows` rows and `least_share` of a source's rows.

    Rows of null text are neither counted nor listed; a null source is a source of its own; empty lines never count. Lines
    are numbered from 1 between newlines. A row counts once for a line however often it holds it. Repeated ids count as rows.
    """
    rows = df.where(F.col("text").isNotNull()).select(F.col("id").cast("long").alias("id"), "source", "text")
    keys = lambda part: {"src": [_key(s) for s in part["source"]], "rows": part["rows"]}
    per_source = common.map_batches(rows.groupBy("source").agg(F.count("*").alias("rows")), keys, "src long, rows long")
    enough = (F.col("n") >= least_rows) & (F.col("n") >= least_share * F.col("rows"))
    counts = common.map_batches(rows.select("source", "text"), _chunk_counts, "src long, chunk long, n long")
    hot = counts.groupBy("src", "chunk").agg(F.sum("n").alias("n")).where(F.col("n") >= least_rows)
    hot = common.materialize(hot.join(per_source, "src").where(enough).select("src", "chunk"))
    lines = common.map_batches(rows, _lines, "id long, line_no long, src long, chunk long, line long, first long")
    likely = common.materialize(lines.join(hot, ["src", "chunk"], "left_semi").select("id", "line_no", "src", "line", "first"))
    exact = likely.groupBy("src", "line").agg(F.sum("first").alias("n")).join(per_source, "src").where(enough)
    return likely.join(exact, ["src", "line"], "left_semi").select("id", F.col("line_no").cast("int").alias("line_no"))


def without_lines(df: DataFrame, lines: DataFrame) -> DataFrame:
    """df's (id, text) with the (id, line_no) lines cut out. Null texts stay null; other columns are left out."""
    def cut(text: str | None, gone) -> str | None:
        if text is None or not gone:
            return text
        drop = set(gone)
        return "\n".join(x for k, x in enumerate(text.split("\n"), 1) if k not in drop)

    @arrow_udf("string")
    def kept(text: pa.Array, gone: pa.Array) -> pa.Array:
        return pa.array([cut(t, g) for t, g in zip(text.to_pylist(), gone.to_pylist())], pa.string())

    per = lines.groupBy("id").agg(F.collect_set("line_no").alias("gone"))  # no more than a document's lines
    return df.select("id", "text").join(per, "id", "left").select("id", kept("text", "gone").alias("text"))


def _site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common.table(spark, sf_dir, "site_documents").select("id", "source", F.col("raw_text").alias("text"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, line_no) of the repeated lines of site_documents.raw_text."""
    return repeated_lines(_site(spark, sf_dir))


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text): every raw_text without its source's repeated lines."""
    site = _site(spark, sf_dir)
    return without_lines(site, repeated_lines(site))


_REPEATED = r"""
WITH l AS (
  SELECT id, source, i AS line_no,
         regexp_replace(trim(regexp_replace(p[i], '[\s\p{Z}\x{85}\x{1c}-\x{1f}]+', ' ', 'g')), '[0-9]+', '0', 'g') AS line
  FROM (SELECT id, source, string_split(raw_text, chr(10)) AS p FROM site_documents WHERE raw_text IS NOT NULL),
       LATERAL unnest(range(1, len(p) + 1)) AS t(i)
), c AS (SELECT source, line, count(DISTINCT id) AS n FROM l WHERE line <> '' GROUP BY ALL),
r AS (SELECT source, count(*) AS n_rows FROM site_documents WHERE raw_text IS NOT NULL GROUP BY ALL),
f AS (SELECT l.id, CAST(l.line_no AS INTEGER) AS line_no
FROM l JOIN c ON l.source = c.source AND l.line = c.line JOIN r ON l.source = r.source
WHERE c.n >= 5 AND c.n >= 0.1 * r.n_rows)
"""
SQL = {
    "p4_found": _REPEATED + "SELECT id, line_no FROM f",
    "p4_clean": _REPEATED + """, g AS (SELECT id, list(line_no) AS gone FROM f GROUP BY id)
SELECT d.id, array_to_string(list_transform(list_filter(range(1, len(p) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: p[i]), chr(10)) AS text
FROM (SELECT id, string_split(raw_text, chr(10)) AS p FROM site_documents) d LEFT JOIN g USING (id)""",
}
QUERIES = {"p4_found": p4_found, "p4_clean": p4_clean}
