"""Shared plumbing of the llm operators: tables in, scratch tables out, Arrow batches in between."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import drop, materialize, release, shared_dir  # noqa: F401

#: (table, id column, text column) of the two tables most text problems speak of.
TEXT_TABLES = (("site_documents", "id", "raw_text"), ("chunks", "id", "chunk_text"))



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tab, rec_id, text) of site_documents.raw_text and chunks.chunk_text, null texts left out."""
    parts = [
        table(spark, sf_dir, tab)
        .where(F.col(col).isNotNull())
        .select(F.lit(tab).alias("tab"), F.col(key).cast("long").alias("rec_id"), F.col(col).alias("text"))
        for tab, key, col in TEXT_TABLES
    ]
    return parts[0].unionByName(parts[1])


def map_batches(
    df: DataFrame,
    f: Callable[[dict[str, list]], dict[str, Iterable]],
    schema: str,
    rows: int = 2000,
    chars: int = 1_500_000,
    text: str = "text",
) -> DataFrame:
    """mapInArrow with f over dicts of columns, in slices of at most `rows` rows and about `chars` characters of column `text`."""
    types = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, rows, chars, text):
                out = f(part.to_pydict())
                yield pa.RecordBatch.from_arrays([_array(out[x.name], x.type) for x in types], schema=types)

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values
    return pa.array(values, type=kind)


def _slices(batch: pa.RecordBatch, rows: int, chars: int, text: str) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 0:
        return
    if text not in batch.schema.names:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(text))), 0).to_pylist()
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and (i - at >= rows or total + n > chars):
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    yield batch.slice(at)


def _arrow_schema(schema: str) -> pa.Schema:
    return to_arrow(T._parse_datatype_string(schema))


def to_arrow(struct: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([pa.field(x.name, to_arrow_type(x.dataType)) for x in struct.fields])


def big_partitions(spark: SparkSession, least: int = 12) -> int:
    """Shuffle partitions as the session has them, never fewer than its cores."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies: $LOOMTEXT_TOKENIZERS or /opt/tokenizers."""
    return os.path.join(os.environ.get("LOOMTEXT_TOKENIZERS", "/opt/tokenizers"), name)
