"""Problem 8: the whole corpus encoded by a public byte-level tokenizer.

Global distinct-word shuffle: texts are cut into pre-tokens, each distinct pre-token of the corpus is encoded once, and its ids
are joined back. Positions travel as one compact sequence a document, of indexes into the distinct words of its block (a
bounded run of documents), so that what is shuffled and joined are a block's distinct words, never its occurrences; a word
that every document holds, a comma say, is one row a block. Blocks are bounded in rows and characters, so none grows hot.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "byte_bpe_50k"
BLOCK_ROWS, BLOCK_CHARS = 2000, 1_500_000


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(4)
def encoder(path: str):
    import tiktoken

    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(1)
def _pretokens():
    import regex

    return regex.compile(PATTERN).findall


_SEQS = "block long, doc_id long, seq binary, words array<string>"
_SEQS_ARROW = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.binary()), ("words", pa.list_(pa.string()))])


def _cut(batches):
    """A row for each document (its word indexes) and one for each block (its distinct words in index order)."""
    findall, first, n = _pretokens(), TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for part in common._slices(batch, BLOCK_ROWS, BLOCK_CHARS, "text"):
            at: dict[str, int] = {}
            index = lambda w: at.setdefault(w, len(at))
            seqs = [np.fromiter(map(index, findall(t)), np.int32).tobytes() if t else b"" for t in part.column("text").to_pylist()]
            ids, block = part.column("doc_id").to_pylist(), first + n
            n += 1
            # short indexes, where the block has no more words
            kind = np.uint16 if len(at) < 1 << 16 else np.int32
            seqs = [np.frombuffer(s, np.int32).astype(kind).tobytes() for s in seqs]
            rows = len(ids) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * rows, pa.int64()), pa.array([*ids, None], pa.int64()), pa.array([*seqs, None], pa.binary()), pa.array([None] * len(ids) + [list(at)], _SEQS_ARROW.field("words").type)],
                schema=_SEQS_ARROW,
            )


def _joined(path: str, counts: bool):
    """The code of each distinct word: its ids, or only their number."""

    def run(batches):
        encode = encoder(path).encode_ordinary_batch
        for batch in batches:
            words = batch.column("word")
            codes = encode(words.to_pylist(), num_threads=1)
            if counts:
                yield pa.RecordBatch.from_arrays([words, pa.array(list(map(len, codes)), pa.int32())], ["word", "n"])
            else:
                yield pa.RecordBatch.from_arrays([words, pa.array(codes, pa.list_(pa.int32()))], ["word", "ids"])

    return run


def _sequences(docs: pa.Table, n_words: int):
    kind = np.uint16 if n_words < 1 << 16 else np.int32
    raw = docs.column("seq").to_pylist()
    seqs = [np.frombuffer(s, kind) for s in raw]
    return np.array([len(s) for s in seqs], np.int64), np.concatenate(seqs).astype(np.int64) if seqs else np.zeros(0, np.int64)


def _assemble(docs: pa.Table, words: pa.Table) -> pa.Table:
    """A block's documents from its words' ids."""
    ids = docs.column("doc_id").combine_chunks()
    order = np.argsort(words.column("at").to_numpy())
    codes = words.column("ids").combine_chunks()
    codes = codes if isinstance(codes, pa.ListArray) else codes.chunk(0) if codes.num_chunks else pa.array([], pa.list_(pa.int32()))
    sizes = np.asarray(pc.list_value_length(codes), np.int64)[order] if len(codes) else np.zeros(0, np.int64)
    n, seq = _sequences(docs, len(order))
    flat = codes.take(pa.array(order)).flatten().to_numpy(zero_copy_only=False) if len(codes) else np.zeros(0, np.int32)
    start = np.concatenate(([0], np.cumsum(sizes)))[:-1] if len(sizes) else np.zeros(0, np.int64)
    per = sizes[seq] if len(seq) else np.zeros(0, np.int64)
    ends = np.cumsum(per)
    # position of each id of the result in the words' ids
    pick = np.repeat(start[seq] - (ends - per), per) + np.arange(int(ends[-1]) if len(ends) else 0)
    tokens = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n)))]
    lists = pa.ListArray.from_arrays(pa.array(tokens, pa.int32()), pa.array(flat[pick], pa.int32()))
    return pa.table({"doc_id": ids, "ids": lists})


def _count(docs: pa.Table, words: pa.Table) -> pa.Table:
    """A block's documents' numbers of tokens."""
    at = words.column("at").to_numpy()
    sizes = np.zeros(len(at), np.int64)
    sizes[at] = words.column("n").to_numpy()
    n, seq = _sequences(docs, len(at))
    total = np.concatenate(([0], np.cumsum(sizes[seq])))
    edges = np.concatenate(([0], np.cumsum(n)))
    return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": pa.array(np.diff(total[edges]), pa.int64())})


def _by_words(df: DataFrame, vocabulary: str, counts: bool) -> DataFrame:
    path = common.tokenizer_file(f"{vocabulary}.tiktoken")
    parts = common.materialize(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut, _SEQS))
    words = parts.where("words IS NOT NULL").select(F.col("block").alias("of"), F.posexplode("words").alias("at", "word"))
    codes = words.select("word").distinct().mapInArrow(_joined(path, counts), f"word string, {'n int' if counts else 'ids array<int>'}")
    coded = words.join(codes, "word").drop("word")
    docs = parts.where("words IS NULL").select("block", "doc_id", "seq")
    # the key comes back with the columns of either side
    pair = docs.groupBy("block").cogroup(coded.groupBy("of"))
    return pair.applyInArrow(_count if counts else _assemble, f"doc_id long, {'n_tokens long' if counts else 'ids array<int>'}")


def encode_corpus(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) for each row of df's (doc_id, text), without special tokens.

    Null and empty texts have an empty list. Rows are kept one for one, repeated and null ids included; other columns are
    left out. A text's special-token strings are ordinary text.
    """
    return _by_words(df, vocabulary, False)


def count_tokens(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens): the length of what encode_corpus gives, 0 for null and empty texts."""
    return _by_words(df, vocabulary, True)


def decode_ids(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """df's (doc_id, ids) as (doc_id, text), by the token-byte table, which has a fixed size. Null ids give null, empty ones ''.

    Bytes that are no UTF-8 (ids cut inside a character) come back as U+FFFD.
    """
    path = common.tokenizer_file(f"{vocabulary}.tiktoken")

    def run(batches):
        tokens = pa.array([b for b, _ in sorted(ranks(path).items(), key=lambda x: x[1])], pa.binary())
        for batch in batches:
            ids = batch.column("ids")
            lists = pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values), mask=ids.is_null()) if ids.null_count else pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values))
            joined = pc.binary_join(lists, b"").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([None if b is None else b.decode("utf-8", "replace") for b in joined], pa.string())], ["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    return encode_corpus(common.table(spark, sf_dir, "documents"))


def p8_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): every document decoded from its ids, which has to be its very text (null counts as empty)."""
    return decode_ids(p8_ids(spark, sf_dir))


QUERIES = {"p8_ids": p8_ids, "p8_roundtrip": p8_roundtrip}
SQL = {"p8_roundtrip": "SELECT doc_id, coalesce(text, '') AS text FROM documents"}
