"""Text functions as Column expressions: all of them run in the JVM but HTML unescaping."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# What a token is (ideographs one by one, words whole, any other sign by itself), where sentences end, which
# characters count as Chinese or Japanese, and the phrases of consent and copyright boilerplate.
TOKEN = r"(?U)[\x{3400}-\x{9fff}\x{f900}-\x{faff}]|[a-zA-Z0-9]+(?:['’\-][a-zA-Z0-9]+)*|[^\s]"
WORD = r"[a-zA-Z0-9]+(?:['’\-][a-zA-Z0-9]+)*|[\x{3400}-\x{9fff}\x{f900}-\x{faff}]"
SENTENCE_END = r"(?U)(?<=[。！？!?\.;；])\s*|\n+"
CJK = r"[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]"
BOILERPLATE = (
    r"(?iud)(cookie|privacy|terms of use|all rights reserved|©|©️).{0,120}",
    r"(?iu)(本网站|版权所有|保留所有权利|使用条款|隐私政策|免责声明)[^\n]*",
    r"(?iu)(微信|公众号|扫码|关注我们|订阅我们|下载应用)[^\n]*",
)
ZH_SHARE = 0.20
LANG_PREFIX = 2000


def html_unescape(text: Column) -> Column:
    """HTML references to characters; the one text function that has no built-in. Null stays null."""

    @arrow_udf("string")
    def run(x: pa.Array) -> pa.Array:
        return pa.array([html.unescape(s) if s and "&" in s else s for s in x.to_pylist()], pa.string())

    return run(text)


def strip(text: Column) -> Column:
    """Unicode whitespace off both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def clean_text(text: Column, unescape: bool = True) -> Column:
    """Unescape, drop control characters, unify line ends, one space for runs of spaces, trim lines and drop empty ones.

    Null and empty texts give ''.
    """
    t = F.coalesce(text, F.lit(""))
    if unescape:
        t = html_unescape(t)
    t = F.regexp_replace(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t\x{a0}\x{2007}\x{202f}]+", " ")
    return strip(F.regexp_replace(t, r"(?U)\s*\n\s*", "\n"))


def dedupe_lines(text: Column) -> Column:
    """Without lines equal to the line before."""
    return F.regexp_replace(text, r"(?md)^([^\n]*)(?:\n\1$)+", "$1")


def clean_plain(text: Column, unescape: bool = True) -> Column:
    """What the pipeline does with fetched plain text: clean, dedupe lines, clean again."""
    return clean_text(dedupe_lines(clean_text(text, unescape)), unescape)


def strip_boilerplate(text: Column, max_len: int | None = None, unescape: bool = True) -> Column:
    """Consent and copyright phrases out, cleaned, cut to max_len characters if given (0 and None: not cut)."""
    for pattern in BOILERPLATE:
        text = F.regexp_replace(text, pattern, " ")
    text = clean_text(text, unescape)
    return F.left(text, F.lit(max_len)) if max_len else text


def paragraphs(text: Column) -> Column:
    """Array of the parts between blank lines, trimmed, without empty ones; null for null."""
    return F.filter(F.transform(F.split(text, r"(?U)\n\s*\n"), strip), lambda p: p != "")


def detect_lang(text: Column) -> Column:
    """'zh' if more than a fifth of the first 2,000 characters (spaces apart) are ideographs or kana, else 'en'; 'unknown' for empty and null."""
    head = F.left(F.coalesce(text, F.lit("")), F.lit(LANG_PREFIX))
    cjk = F.regexp_count(head, F.lit(CJK))
    solid = F.greatest(F.lit(1), F.length(F.regexp_replace(head, r"(?U)\s+", "")))
    return F.when(head == "", "unknown").when(cjk / solid > ZH_SHARE, "zh").otherwise("en")


def resolve_lang(lang: Column, text: Column) -> Column:
    """The given language, or the detected one where none is given."""
    return F.coalesce(F.nullif(lang, F.lit("")), detect_lang(text))


def token_count(text: Column) -> Column:
    """Number of tokens; null for null."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("int")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def sentences(text: Column) -> Column:
    """Array of sentences: cut after every end mark (with the spaces behind it) and at line ends, without empty ones."""
    return F.filter(F.split(text, SENTENCE_END), lambda s: s != "")


def terms(text: Column) -> Column:
    """Terms for TF-IDF: lower-case words and ideographs, and after an ideograph that another follows, the pair of them."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    # a word is ASCII, so anything from the first ideograph on is one
    first = F.lit("\u3400")
    pair = lambda a, b: F.when((a >= first) & (b >= first), F.array(a, F.concat(a, b))).otherwise(F.array(a))
    # pairs come from shifted arrays, so the words are not looked up one by one
    following = lambda w: F.concat(F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), F.array_repeat(F.lit(""), F.when(F.size(w) > 0, 1).otherwise(0)))
    # bound to a variable, so that the words are found once
    return F.get(F.transform(F.array(words), lambda w: F.flatten(F.zip_with(w, following(w), pair))), F.lit(0))


def nth_line(text: Column, n: int) -> Column:
    return F.get(F.split(text, "\n"), F.lit(n))
