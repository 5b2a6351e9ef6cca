"""Texts kept by chunk, so that several passes read them in place.

A chunk is a few megabytes of texts of one input split. The table is
bucketed by chunk: whatever is grouped by chunk afterwards (flags, row
numbers, requests for texts) is shuffled to the texts, never the texts
themselves. A text's key is its chunk and its place in it, which are fixed
once the table is written, so retries and later jobs agree on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from copse.llm import text as X
from copse.llm.scratch import Steps, shuffle_parts

CHUNK_BYTES = 4 << 20
#: Bits of a text's key that hold its place (a chunk counts 16 bytes for each text besides its length).
PLACE_BITS = 20

SIDE = "chunk long, kind int, k int, data binary"
COPY, SAMPLE, PREFIX = 0, 1, 2


def key() -> Column:
    """A text's key, from its chunk and place."""
    return F.shiftleft("chunk", PLACE_BITS) + F.col("i")


def chunk_of(text_key: str | Column) -> Column:
    return F.shiftright(text_key, PLACE_BITS)


def keep_texts(docs: DataFrame, steps: Steps, doc_id: str, text: str, whole: bool = False) -> DataFrame:
    """The texts with chunk and place, bucketed by chunk; with ``whole``, the
    other columns too, in the struct ``rest``."""
    thin = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.md5(docs[text]).alias("md5"))
    if whole:
        rest = F.struct(*[docs[c] for c in docs.columns if c != text] or [F.lit(None).alias("none")])
        thin = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.md5(docs[text]).alias("md5"), rest.alias("rest"))
    schema = T.StructType([*T.StructType.fromDDL("chunk long, i int").fields, *thin.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, no, size, i = TaskContext.get().partitionId() << 22, 0, 0, 0
        for b in batches:
            n = [len(x or b"") + 16 for x in b.column(1).cast(pa.binary()).to_pylist()]
            chunk, place = [], []
            for k in n:
                if size and size + k > CHUNK_BYTES:
                    no, size, i = no + 1, 0, 0
                chunk.append(base + no)
                place.append(i)
                size, i = size + k, i + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk, pa.int64()), pa.array(place, pa.int32()), *b.columns], schema.names)

    spark, name = docs.sparkSession, f"copse_texts_{uuid.uuid4().hex}"
    thin.mapInArrow(run, schema).write.option("path", steps.path("texts")).option("compression", "zstd") \
        .bucketBy(shuffle_parts(spark), "chunk").saveAsTable(name)
    return spark.table(name)


def pick(store: DataFrame, wanted: DataFrame, key: str, docs: DataFrame, text: str) -> DataFrame:
    """The rows that the column ``key`` of ``wanted`` names, with the columns of
    ``docs``, from a store of ``whole`` rows. Keys are shuffled to the rows."""
    asked = wanted.select(chunk_of(F.col(key)).alias("chunk"),
                          F.col(key).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int").alias("i"))
    schema = T.StructType([store.schema["text"], store.schema["rest"]])

    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        return rows.filter(pc.is_in(rows["i"], asks["i"].combine_chunks())).select(["text", "rest"])

    found = store.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(run, schema)
    return found.select(*[F.col("text") if c == text else F.col("rest").getField(c) for c in docs.columns]).toDF(*docs.columns)


def per_chunk(store: DataFrame, side: DataFrame, schema: str | T.StructType, fn) -> DataFrame:
    """``fn(rows, copies, bits by kind)`` for each chunk; ``rows`` in place order."""

    def run(rows: pa.Table, notes: pa.Table) -> pa.Table:
        rows = rows.sort_by("i").combine_chunks()
        copies, bits = {}, {SAMPLE: {}, PREFIX: {}}
        for n in notes.to_pylist():
            (copies if n["kind"] == COPY else bits[n["kind"]])[n["k"]] = n["data"]
        return fn(rows, copies, bits)

    return store.groupBy("chunk").cogroup(side.groupBy("chunk")).applyInArrow(run, schema)


def with_texts(store: DataFrame, wanted: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``wanted`` and the text (binary) that its column ``key``
    names. Requests are shuffled to the texts."""
    asked = wanted.select(*columns, chunk_of(F.col(key)).alias("chunk"),
                          F.col(key).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int").alias("place"))
    schema = T.StructType([asked.schema[c] for c in columns] + [T.StructField("text", T.BinaryType())])

    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        texts = dict(zip(rows["i"].to_pylist(), X.batch_bytes(rows["text"])))
        return pa.table([*(asks[c] for c in columns), pa.array([texts[p] for p in asks["place"].to_pylist()], pa.binary())],
                        schema.names)

    return store.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(run, schema)
