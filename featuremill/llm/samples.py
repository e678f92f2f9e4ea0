"""Bounded samples of labelled rows, for the classifiers that are fitted on the driver.

A sample is drawn from the different (id, text) rows that have a label, by a hash of both, so
it is the same in every run and bounded in rows: rows that share an id are different draws,
and copies of one row are one. Only ids and hashes are joined and counted; texts stay where
they are until a task has turned the drawn ones into numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.llm.common import whole_text


def hashed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, text) of the rows that have an id."""
    text = whole_text(text_col)
    return (df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
            .where("doc_id is not null"))


def labelled_rows(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, text_hash, label): the different rows of ``hashed_rows`` that have a label in
    ``known`` (doc_id, label; one row an id)."""
    own = rows.select("doc_id", "text_hash").distinct()
    return own.join(known.select(F.col("doc_id").alias("known_id"), "label"),
                    F.col("doc_id") == F.col("known_id")).select("doc_id", "text_hash", "label")


def drawn(total: int, rows: int, salt: str) -> Column:
    """Whether a row is among about ``rows`` of ``total`` rows."""
    if total <= rows:
        return F.lit(True)
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text_hash", F.lit(salt)), 1)
    return place < F.lit(int(2 ** 63 * (rows / total)))


def texts_of(rows: DataFrame, chosen: DataFrame, most: int) -> DataFrame:
    """``rows`` of ``hashed_rows`` joined with the columns of ``chosen`` (doc_id, text_hash, ...), of
    which at most ``most`` rows are taken: the bound of the broadcast side."""
    few = (chosen.limit(most).withColumnRenamed("doc_id", "chosen_id").withColumnRenamed("text_hash", "chosen_hash"))
    return (rows.join(F.broadcast(few), (F.col("doc_id") == F.col("chosen_id"))
                      & (F.col("text_hash") == F.col("chosen_hash")))
            .drop("chosen_id", "chosen_hash"))
