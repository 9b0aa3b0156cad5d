"""Line dedup: drop lines whose normalised form occurs in many documents.

Method: explode the normalised lines, hash them, count the distinct documents
of each hash, drop the lines at or over the threshold, reassemble by position.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import settle, small_batches

_BLANK = b" \t\n\x0b\x0c\r"


def _hash_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, high, low = [0], [], []
            for text in batch.column(2).to_pylist():
                for line in (text or "").encode().lower().split(b"\n"):
                    key = line.strip(_BLANK)
                    if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
                        h = xxhash.xxh3_128_intdigest(key)
                        high.append(h >> 64)
                        low.append(h & 0xFFFFFFFFFFFFFFFF)
                    else:
                        high.append(0)
                        low.append(0)
                offsets.append(len(high))
            as_long = lambda xs: pa.array(np.array(xs, dtype=np.uint64).view(np.int64))
            keys = pa.StructArray.from_arrays([as_long(high), as_long(low)], ["a", "b"])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), keys)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "row_hash", "keys"])

    return run


@F.pandas_udf(T.StringType())
def _without_lines(text: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for t, d in zip(text, dropped):
        t = t or ""
        if d is not None and len(d):
            gone = set(d)
            t = "\n".join(line for i, line in enumerate(t.split("\n")) if i not in gone)
        out.append(t)
    return pd.Series(out, dtype=object)


def line_dedup(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
    text_col: str = "text", salts: int = 32,
) -> DataFrame:
    """Returns ``id, n_lines, n_dropped, kept_text``, one row per input row.

    A line's key is the line with ASCII blanks stripped at both ends and A-Z
    lower-cased. Keys of ``min_chars`` code points or more that occur in
    ``min_docs`` documents or more lose all their lines, in every document.

    Defined cases: every input row is one document (repeated rows count
    separately); a null text is one empty line; empty keys are never dropped
    when ``min_chars`` >= 1; a document that loses all lines has the empty
    text; an empty table gives an empty result; null ids are kept; extra
    columns are ignored. Keys are compared by a 128-bit hash.

    A line in a third of all documents is spread over ``salts`` join keys; only
    16 bytes per line are shuffled before the hits meet their documents.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).alias("text"))
    id_type = base.schema["id"].dataType
    key = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("row_hash", T.LongType()), T.StructField("keys", T.ArrayType(key))])
    hashed = settle(base.mapInArrow(_hash_lines(min_chars), schema), "line-keys")

    one = hashed.select(F.explode(F.array_distinct("keys")).alias("k")).select("k.a", "k.b")
    filled = (F.col("a") != 0) | (F.col("b") != 0)
    frequent = one.where(filled).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    frequent = frequent.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    lines = (
        hashed.select("id", "row_hash", F.posexplode("keys").alias("pos", "k"))
        .select("id", "row_hash", "pos", "k.a", "k.b").where(filled)
        .withColumn("salt", F.pmod(F.xxhash64("id", "row_hash"), F.lit(salts)).cast("int"))
    )
    hits = lines.join(frequent, ["a", "b", "salt"], "left_semi")
    per_row = hits.groupBy(F.col("id").alias("hit_id"), F.col("row_hash").alias("hit_hash")).agg(
        F.collect_set("pos").alias("dropped"))
    joined = base.join(
        per_row, base["id"].eqNullSafe(per_row["hit_id"]) & (base["row_hash"] == per_row["hit_hash"]), "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    return joined.select(
        F.col("id").alias(id_col),
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), text).otherwise(_without_lines("text", "dropped")).alias("kept_text"),
    )
