"""Chunks of documents that ask shards of the hash space about their keys.

Corpus-wide questions (how often does this n-gram occur, does this window occur in another document) are asked in
three steps. The documents are written once as a table bucketed by chunk, without a shuffle. Every chunk sends its
sorted distinct keys, packed and cut by shard, so a key that stands in every document is one entry per chunk. A shard
meets all entries of its part of the hash space, and answers each chunk in the order of the chunk's own keys, so an
answer needs no keys. Chunks and shards have a bounded size; their number grows with the input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sliceward.llm.packed import SECOND
from sliceward.sources.stored import scratch_name, settle

#: Bytes of text in a chunk. It bounds the memory of a task.
CHUNK_BYTES = 8 << 20
#: Spark's own limit for the buckets of a table.
MOST_BUCKETS = 100_000
ROUTED = "chunk int, shard int, keys binary, extra binary"
ANSWER = "chunk int, shard int, answer binary"


@dataclass(frozen=True)
class Chunked:
    """docs: columns __chunk, __id, __text and, if carried, __rest; n: shards and, about, chunks; table: where docs lie."""

    docs: DataFrame
    n: int
    table: str = ""


def key_of(docs: DataFrame) -> Column:
    """doc_id; a row without one gets an id above 2**62 from its text, so that equal texts have equal ids."""
    made = F.lit(1 << 62) + F.xxhash64(F.col("text")).bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col("doc_id").cast("long"), made)


def text_digest() -> Column:
    """Tells texts of one doc_id apart."""
    return F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))


def chunked(docs: DataFrame, carry: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Chunked:
    """Write the documents bucketed by chunk. A chunk is a part of one input partition, so nothing is shuffled.

    carry: keep the other columns of a row in the struct __rest.
    """
    sizes = docs.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("text")).alias("b"))
    most, parts = sizes.agg(F.max("b"), F.max("p")).first()
    pieces, parts = max(1, math.ceil((most or 0) / chunk_bytes)), (parts or 0) + 1
    n = min(MOST_BUCKETS, pieces * parts)
    piece = F.pmod(F.xxhash64("doc_id", "text"), F.lit(pieces))
    rest = [F.struct(*rest_of(docs).fieldNames()).alias("__rest")] if carry else []
    rows = docs.select(
        (F.spark_partition_id() * pieces + piece).cast("int").alias("__chunk"),
        key_of(docs).alias("__id"),
        F.col("text").alias("__text"),
        *rest,
    )
    name = scratch_name(docs.sparkSession, "chunks")
    rows.write.format("parquet").option("compression", "zstd").bucketBy(n, "__chunk").saveAsTable(name)
    return Chunked(docs.sparkSession.table(name), n, name)


def rest_of(docs: DataFrame) -> StructType:
    """The columns besides the text."""
    return StructType([f for f in docs.schema.fields if f.name != "text"])


def ask(chunks: Chunked, asking, answering, told: DataFrame | None = None) -> DataFrame:
    """Answers of the shards to the chunks' keys, stored.

    asking(table of a chunk, its answers so far or None) gives a ROUTED table; answering(ROUTED table of a shard) an
    ANSWER table.
    """
    if told is None:
        sent = chunks.docs.groupBy("__chunk").applyInArrow(lambda rows: asking(rows, None), ROUTED)
    else:
        sent = both(chunks, told, asking, ROUTED)
    return settle(sent.groupBy("shard").applyInArrow(answering, ANSWER), "answers")


def both(chunks: Chunked, told: DataFrame, work, schema) -> DataFrame:
    """work(table of a chunk, its answers) for every chunk. The documents are not shuffled."""
    empty = pa.schema([("chunk", pa.int32()), ("shard", pa.int32()), ("answer", pa.binary())])

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return work(rows, answers if answers.num_columns else empty.empty_table())

    return chunks.docs.groupBy("__chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, schema)


def together(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second.withColumn("shard", F.col("shard") + F.lit(SECOND)))


def result_schema(columns: list[tuple], rest: StructType | None = None) -> StructType:
    """doc_id, these columns and, if given, the other columns of the input as the struct rest."""
    fields = [StructField("doc_id", LongType()), *(StructField(*c) for c in columns)]
    return StructType(fields + ([StructField("rest", rest)] if rest is not None else []))


def beside_tasks(rows: DataFrame, most: int) -> DataFrame:
    """Stored rows for a broadcast join if they are at most so many, else for whatever join Spark chooses."""
    stored = settle(rows, "bounded")
    return F.broadcast(stored) if stored.count() <= most else stored
