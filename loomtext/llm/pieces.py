"""Problem 6: oversized texts cut at natural boundaries into overlapping pieces.

Dynamic programming over boundary positions: a piece ends at a line or sentence end where it can, at a clause, a space or
between two tokens only inside a stretch too long without; it costs the penalty of its cut and the square of what it falls
short of the limit, and starts at the earliest natural boundary within the allowed overlap before its predecessor's end.
Token positions come from one vectorized classification of the characters, not from a regex walk.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LIMIT, OVERLAP = 512, 100
#: What a cut costs after a line, a sentence, a clause, a space, and elsewhere.
LINE, SENTENCE, CLAUSE, SPACE, ANYWHERE = 0.0, 0.5, 3.0, 6.0, 9.0
#: What a piece costs by itself, and at most for being short.
PIECE, SHORT = 2.0, 4.0

# Sentence and clause ends, closing marks that may follow them.
_SENTENCE = "。！？!?;；…."
_CLAUSE = "，,、：:"
_CLOSING = "”’\"』」）)】》»"


@lru_cache(1)
def _spaces() -> np.ndarray:
    table = np.zeros(0x3001, bool)
    table[[o for o in range(0x3001) if chr(o).isspace()]] = True
    return table


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _is_space(codes: np.ndarray) -> np.ndarray:
    return _spaces()[np.minimum(codes, 0x3000)] & (codes <= 0x3000)


def token_starts(codes: np.ndarray) -> np.ndarray:
    """Where the tokens start: ideographs and other signs one by one, ASCII words whole, with inner apostrophes and hyphens."""
    if not len(codes):
        return np.zeros(0, np.int64)
    word = (codes < 0x7B) & ((codes >= 0x61) | ((codes >= 0x41) & (codes <= 0x5A)) | ((codes >= 0x30) & (codes <= 0x39)))
    joint = (codes == 0x27) | (codes == 0x2019) | (codes == 0x2D)
    inner = np.zeros(len(codes), bool)
    inner[1:-1] = joint[1:-1] & word[:-2] & word[2:]
    whole = word | inner
    start = ~_is_space(codes) & ~inner
    start[1:] &= ~(word[1:] & whole[:-1])
    return np.flatnonzero(start)


def count_tokens(text: str | None) -> int:
    """Tokens by the project's rule, 0 for null and empty texts."""
    return len(token_starts(_codes(text))) if text else 0


def _in(codes: np.ndarray, chars: str) -> np.ndarray:
    return np.isin(codes, np.array([ord(c) for c in chars], np.uint32))


def boundaries(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The penalty of a cut before each token."""
    n = len(starts)
    cost = np.full(n, ANYWHERE)
    if n < 2:
        return cost
    before, here = starts[:-1], starts[1:]
    first = codes[before]
    spaced = _is_space(codes[here - 1])
    cost[1:][spaced] = SPACE
    cost[1:][_in(first, _CLAUSE)] = CLAUSE
    # a full stop inside a number or a name ends nothing
    ends = _in(first, _SENTENCE) & ((first != 0x2E) | spaced)
    closed = np.zeros(n - 1, bool)
    closed[1:] = _in(first[1:], _CLOSING) & _in(codes[before[:-1]], _SENTENCE)
    # not between a sentence end and the mark that closes it
    cost[1:][(ends & ~_in(codes[here], _CLOSING)) | closed] = SENTENCE
    lines = np.cumsum(codes == 0x0A)
    cost[1:][lines[here] > lines[before]] = LINE
    return cost


def _positions(cost: np.ndarray, gap: int) -> np.ndarray:
    """Places to cut, in tokens: natural ones, and lesser ones only inside gaps that would not fit a piece."""
    n = len(cost)
    at = np.concatenate(([0], np.flatnonzero(cost <= SENTENCE), [n]))
    for level in (CLAUSE, SPACE, None):
        at = np.unique(at)
        wide = np.flatnonzero(np.diff(at) > gap)
        if not len(wide):
            break
        more = [at]
        for i in wide:
            a, b = int(at[i]), int(at[i + 1])
            more.append(np.arange(a, b, max(1, gap // 8)) if level is None else a + np.flatnonzero(cost[a:b] <= level))
        at = np.concatenate(more)
    return np.unique(at)


def cuts(cost: np.ndarray, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(first token, end) of the pieces of a text of len(cost) tokens."""
    n = len(cost)
    if n <= limit:
        return [(0, n)]
    at = _positions(cost, limit - overlap)
    natural = at[np.concatenate(([True], cost[at[1:-1]] <= SENTENCE, [True]))]
    # where the piece after a cut at each place starts
    i = np.searchsorted(natural, at - overlap)
    begin = np.where((i < len(natural)) & (natural[np.minimum(i, len(natural) - 1)] < at), natural[np.minimum(i, len(natural) - 1)], at)
    begin[0] = 0
    m = len(at)
    best, last = np.full(m, np.inf), np.zeros(m, np.int64)
    best[0] = 0.0
    cut = np.append(cost[at[1:-1]], 0.0)
    low = 0
    for j in range(1, m):
        while at[j] - begin[low] > limit:
            low += 1
        size = at[j] - begin[low:j]
        total = best[low:j] + SHORT * (1 - size / limit) ** 2
        total[size > limit] = np.inf
        k = int(total.argmin())
        best[j], last[j] = total[k] + cut[j - 1] + PIECE, low + k
    out, j = [], m - 1
    while j:
        out.append((int(begin[last[j]]), int(at[j])))
        j = int(last[j])
    return out[::-1]


def split_text(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """(start, end, tokens, tokens shared with the predecessor) of each piece, in characters; spaces go with what they follow.

    A null text has no pieces, one within the limit (an empty one too) is one piece. An overlap that is negative or leaves no room
    for anything new is refused.
    """
    if not 0 <= overlap < limit:
        raise ValueError(f"an overlap of {overlap} does not go with pieces of {limit}")
    if text is None:
        return []
    if len(text) <= limit:
        return [(0, len(text), count_tokens(text), 0)]
    codes = _codes(text)
    starts = token_starts(codes)
    if len(starts) <= limit:
        return [(0, len(text), len(starts), 0)]
    spans = cuts(boundaries(codes, starts), limit, overlap)
    where = np.append(starts, len(text))
    where[0] = 0
    out, end = [], 0
    for a, b in spans:
        out.append((int(where[a]), int(where[b]), b - a, end - a if end > a else 0))
        end = b
    return out


def split_oversized(df: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(tab, rec_id, piece, start, end, n_tokens, n_shared, text) for df's (tab, rec_id, text): all pieces of all texts.

    Pieces are numbered from 0; start and end are character positions. Null texts have no rows, empty ones one empty piece;
    repeated rows are cut alike, each on its own. An overlap that is negative or not below the limit raises ValueError.
    """
    if not 0 <= overlap < limit:
        raise ValueError(f"an overlap of {overlap} does not go with pieces of {limit}")

    def cut(part: dict) -> dict:
        out: dict[str, list] = {k: [] for k in ("tab", "rec_id", "piece", "start", "end", "n_tokens", "n_shared", "text")}
        for tab, rec, text in zip(part["tab"], part["rec_id"], part["text"]):
            for k, (a, b, n, shared) in enumerate(split_text(text, limit, overlap)):
                for name, x in zip(out, (tab, rec, k, a, b, n, shared, text[a:b])):
                    out[name].append(x)
        return out

    return common.map_batches(df.select("tab", "rec_id", "text"), cut, "tab string, rec_id long, piece int, start int, end int, n_tokens int, n_shared int, text string", rows=500)


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of site_documents and chunks in pieces."""
    return split_oversized(common.texts(spark, sf_dir))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id) of the texts that had to be cut. A text of no more characters than the limit has no more tokens and is not even sent to Python."""
    long = common.texts(spark, sf_dir).where(F.length("text") > LIMIT)
    return split_oversized(long).where("piece = 1").select("tab", "rec_id")


def p6_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id, fits, overlaps, text): whether all pieces of a text and their overlaps are within the limits, and the text that the pieces make up without what they share."""
    pieces = p6_pieces(spark, sf_dir)
    per = pieces.groupBy("tab", "rec_id").agg(F.max("n_tokens").alias("n"), F.max("n_shared").alias("shared"), F.sort_array(F.collect_list(F.struct("piece", "start", "end", "text"))).alias("p"))
    # a piece's own part starts where its predecessor ends
    own = F.transform("p", lambda x, i: F.when(i == 0, x["text"]).otherwise(F.substring(x["text"], F.get("p", i - 1)["end"] - x["start"] + 1, F.length(x["text"]))))
    return per.select("tab", "rec_id", (F.col("n") <= LIMIT).alias("fits"), (F.col("shared") <= OVERLAP).alias("overlaps"), F.array_join(own, "").alias("text"))


_COUNT = r"""len(regexp_extract_all({}, '[\x{{3400}}-\x{{9fff}}\x{{f900}}-\x{{faff}}]|[a-zA-Z0-9]+(?:[''’\-][a-zA-Z0-9]+)*|[^\s\p{{Z}}\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}]'))"""
SQL = {
    "p6_found": f"""
SELECT 'site_documents' AS tab, id AS rec_id FROM site_documents WHERE {_COUNT.format("raw_text")} > 512
UNION ALL SELECT 'chunks', id FROM chunks WHERE {_COUNT.format("chunk_text")} > 512""",
    "p6_rebuilt": """
SELECT 'site_documents' AS tab, id AS rec_id, true AS fits, true AS overlaps, raw_text AS text FROM site_documents WHERE raw_text IS NOT NULL
UNION ALL SELECT 'chunks', id, true, true, chunk_text FROM chunks WHERE chunk_text IS NOT NULL""",
}
QUERIES = {"p6_found": p6_found, "p6_pieces": p6_pieces, "p6_rebuilt": p6_rebuilt}
