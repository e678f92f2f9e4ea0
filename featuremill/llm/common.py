"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.session import scratch_path

#: Entries a worker keeps in a memo table before it starts afresh (bounds its memory).
MEMO_LIMIT = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly two columns, (id, text without nulls): further columns of ``df``, whatever
    their names, cannot clash with what an operator adds."""
    return df.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))


def by_place(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named c0, c1, ... by their places, so that whatever an operator adds
    clashes with none, and the new name of each; ``toDF(*df.columns)`` on them undoes it."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` on every Arrow batch (at most 10,000 rows and about 64 MB by Spark's settings)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: later stages read the
    written files, so a lost executor costs a re-read and not the work before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_bytes(path: str) -> bytes:
    """A model file's content, read on the driver and shipped by broadcast (a vocabulary
    file has a fixed size, here under 2 MB), so executors need no copy of the file."""
    with open(path, "rb") as f:
        return f.read()


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def single_threaded_tokenizers() -> None:
    """A task owns one core; the tokenizer library must not start threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
