"""Signed feature hashing: feature vectors of a declared width, whatever values the text columns hold.

A formula collects every distinct text value to the driver and its vector grows with them. Here
each (column, value) goes to one of ``width`` slots by an md5 hash and adds +1 or -1 there, so
nothing is fitted, the width is the same on every table, and values that share a slot cancel in
the mean. Numeric columns come first, one position each, so the vector has
``len(numbers) + width`` entries. md5 gives the same slots in any SQL engine.

Which value a slot stands for is found by one grouped count of the values
(``slot_names``): the most frequent one, and how many share the slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed positions of a vector. The vector is dense, so the width is meant for thousands at most.
WIDTH = 128


def feature_text(column: str) -> Column:
    """``column=value``; a missing value is the column's name alone."""
    return F.concat(F.lit(column), F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit("")))


def _hex(digest: Column, at: int, digits: int) -> Column:
    return F.conv(F.substring(digest, at, digits), 16, 10).cast("bigint")


def slot_and_sign(text: Column, width: int) -> Column:
    """(slot, sign) of a feature's text: the first eight digits of its md5 modulo the width, and
    +1 or -1 by the ninth."""
    digest = F.md5(text)
    return F.struct((_hex(digest, 1, 8) % width).cast("int").alias("slot"),
                    F.when(_hex(digest, 9, 1) % 2 == 0, 1.0).otherwise(-1.0).alias("sign"))


@dataclass(frozen=True)
class HashedFeatures:
    """The vector's layout: numeric columns, then ``width`` slots for the text columns."""
    numbers: tuple
    texts: tuple
    width: int = WIDTH

    @classmethod
    def of(cls, table: DataFrame, target: str, exclude=(), width: int = WIDTH) -> "HashedFeatures":
        """All columns of ``table`` but the target and ``exclude``: texts are hashed, the rest are numbers."""
        own = [f for f in table.schema.fields if f.name not in {target, *exclude}]
        text = [f.name for f in own if f.dataType.simpleString() == "string"]
        return cls(tuple(f.name for f in own if f.name not in text), tuple(text), width)

    def names(self) -> list[str]:
        return [*self.numbers, *(f"slot_{i}" for i in range(self.width))]

    def transform(self, df: DataFrame, target: str, keep=()) -> DataFrame:
        """``keep``, features and label of every row; a missing number is 0."""
        numbers = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in self.numbers]
        parts = F.array(*[slot_and_sign(feature_text(c), self.width) for c in self.texts])
        slots = F.transform(F.sequence(F.lit(0), F.lit(self.width - 1)), lambda slot: F.aggregate(
            "_parts", F.lit(0.0), lambda sum_, p: sum_ + F.when(p["slot"] == slot, p["sign"]).otherwise(0.0)))
        if not self.texts:
            slots = F.array_repeat(F.lit(0.0), self.width)
        attrs = {"ml_attr": {"attrs": {"numeric": [{"idx": i, "name": n} for i, n in enumerate(self.names())]},
                             "num_attrs": len(self.numbers) + self.width}}
        # the slots are worked out once a row, before the loop over positions
        parted = df.withColumn("_parts", parts) if self.texts else df
        vector = array_to_vector(F.concat(F.array(*numbers) if numbers else F.array().cast("array<double>"), slots))
        return parted.select(*[F.col(f"`{c}`") for c in keep], vector.alias("features", metadata=attrs),
                             F.col(f"`{target}`").cast("double").alias("label"))

    def slot_names(self, df: DataFrame) -> DataFrame:
        """(slot, name, sign, count, values) of the slots that ``df`` uses: the most frequent feature of
        the slot (the first by name among equals), its sign and count, and how many values share it."""
        told = df.select(F.explode(F.array(*[feature_text(c) for c in self.texts])).alias("name"))
        counts = (told.groupBy("name").agg(F.count(F.lit(1)).alias("count"))
                  .withColumn("at", slot_and_sign(F.col("name"), self.width)))
        return (counts.groupBy("at.slot")
                .agg(F.min(F.struct((-F.col("count")).alias("less"), "name", F.col("at.sign").alias("sign"))).alias("top"),
                     F.count(F.lit(1)).alias("values"))
                .select("slot", "top.name", F.col("top.sign").cast("int").alias("sign"),
                        (-F.col("top.less")).alias("count"), "values"))


def named_weights(weights, layout: HashedFeatures, names: DataFrame) -> DataFrame:
    """(idx, feature, weight) of a linear model or an importance vector over the layout: slots under
    their clearest feature's name, slots that no row uses left out."""
    spark = names.sparkSession
    rows = [(i, n, float(w)) for i, (n, w) in enumerate(zip(layout.names(), weights))]
    own = spark.createDataFrame(rows, "idx int, feature string, weight double")
    slot = F.col("idx") - len(layout.numbers)
    told = names.select(F.col("slot").alias("of_slot"), "name", "sign")
    joined = own.join(told, slot == F.col("of_slot"), "left").where("of_slot is not null or idx < " + str(len(layout.numbers)))
    return joined.select("idx", F.coalesce("name", "feature").alias("feature"),
                         (F.col("weight") * F.coalesce("sign", F.lit(1))).alias("weight"))
