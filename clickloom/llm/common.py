"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Name of a column that exists only inside one operator.
_SCRATCH = "__llm_scratch"


def byte_texts(texts: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text; nulls stay."""
    return texts.cast(pa.binary()).to_pylist()


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` parts at exactly these six bytes."""
    return text.split()


def add_fields(df: DataFrame, value: Column, names: Sequence[str]) -> DataFrame:
    """Add the named fields of a struct column; an input column of the same name is replaced."""
    added = df.withColumn(_SCRATCH, value)
    return added.withColumns({n: F.col(_SCRATCH)[n] for n in names}).drop(_SCRATCH)


def text_udf(schema: T.StructType, per_text: Callable[[list[bytes | None]], list[dict]]):
    """Arrow UDF that turns a batch of texts, as UTF-8 bytes, into rows of ``schema``."""
    layout = pa.struct([(f.name, _ARROW[f.dataType.typeName()]) for f in schema.fields])

    @F.arrow_udf(schema)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(per_text(byte_texts(texts)), layout)

    return run


_ARROW = {
    "long": pa.int64(),
    "integer": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts
