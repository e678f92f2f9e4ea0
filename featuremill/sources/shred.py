"""JSON lines of unknown shape: parsed once into VARIANT, a schema by aggregate, typed columns.

Schema inference by the JSON reader takes the widest type that any line has, so one odd line
turns a numeric column into text. Here every line becomes a VARIANT; one aggregate counts the
types that each path has, the majority decides a path's type, and lines are then shredded to
typed columns. A line that is no JSON object, or that holds another type where the schema has
decided, goes to the quarantine with its text and the reason, so every line read is either
typed or quarantined, and none is changed silently.

Only (path, type, count) rows reach the driver, for the ``most`` paths that most lines have. A
line with paths beyond those is typed and keeps its whole text in ``rest``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths that become columns at most.
MOST = 1000


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """(line, v): every line that is not blank, and its VARIANT (null where it is no JSON)."""
    lines = spark.read.text(path).select(F.col("value").alias("line")).where(F.trim("line") != "")
    return lines.withColumn("v", F.try_parse_json("line"))


def _family(told: Column) -> Column:
    """object, array, text, boolean, integer, number, none, other: the kind of a VARIANT of the schema ``told``."""
    return (F.when(told.startswith("OBJECT"), "object").when(told.startswith("ARRAY"), "array")
            .when(told == "STRING", "text").when(told == "BOOLEAN", "boolean").when(told == "BIGINT", "integer")
            .when(told.startswith("DECIMAL") | told.isin("DOUBLE", "FLOAT"), "number")
            .when(told.isNull() | (told == "VOID"), "none").otherwise("other"))


#: What the schemas of a family begin with, for a test much shorter than ``_family``: a test of every path on
#: every line stays below the size up to which the JVM compiles a method.
_BEGIN = {"object": ("OBJECT",), "array": ("ARRAY",), "text": ("STRING",), "boolean": ("BOOLEAN",), "integer": ("BIGINT",),
          "number": ("DECIMAL", "DOUBLE", "FLOAT"), "none": ("VOID",)}


def _fits(told: Column, families: tuple) -> Column:
    """Whether ``_family(told)`` is one of ``families``; null for a missing value."""
    if "other" in families:
        return _family(told).isin(*families)
    return told.rlike("^(" + "|".join(b for f in families for b in _BEGIN[f]) + ")")


def _members(value: Column) -> Column:
    """The members of an object; null for anything else."""
    return value.try_cast("map<string,variant>")


#: Spark type of a path's family, and the families that fit it (a missing value always does).
TYPES = {"text": ("string", ("text",)), "boolean": ("boolean", ("boolean",)), "integer": ("bigint", ("integer",)),
         "number": ("double", ("number", "integer")), "array": ("string", ("array",)), "object": (None, ("object",)),
         "other": ("string", ("other",))}


@dataclass(frozen=True)
class Shape:
    """The decided schema: (path, family) in order of path."""
    paths: tuple

    def name(self, path: tuple) -> str:
        return "_".join(path)

    @staticmethod
    def at(path: tuple) -> str:
        """The path in the syntax of ``variant_get``."""
        return "$" + "".join(f"['{p}']" if '"' in p else f'["{p}"]' for p in path)

    def _typed(self) -> list[tuple]:
        return [(path, TYPES[family][0]) for path, family in self.paths if TYPES[family][0] is not None]

    def names(self) -> list[str]:
        """The names of ``columns``."""
        out = [self.name(path) for path, _ in self._typed()]
        for i, name in enumerate(out):
            if name in out[:i]:
                raise ValueError(f"two paths are named {name!r}")
        return out

    def columns(self) -> list[Column]:
        return [F.try_variant_get("v", self.at(path), kind).alias(name)
                for (path, kind), name in zip(self._typed(), self.names())]

    def told(self) -> dict[str, Column]:
        """What ``reason`` and ``beyond`` look at, each worked out once a line: its members, and the schema of
        the value at each path (null where the line has no such path)."""
        return {"_members": _members(F.col("v"))} | {
            f"_told_{i}": F.schema_of_variant(F.try_variant_get("v", self.at(path), "variant"))
            for i, (path, _) in enumerate(self.paths)}

    def reason(self) -> Column:
        """Why a line does not fit: the first path with another type; null if it fits."""
        out = F.when(F.col("v").isNull(), "no JSON").when(F.col("_members").isNull(), "no object")
        for i, (path, family) in enumerate(self.paths):
            own = _fits(F.col(f"_told_{i}"), (*TYPES[family][1], "none"))
            out = out.when(~own, F.lit(f"{self.name(path)} is not {family}"))
        return out

    def beyond(self) -> Column:
        """Whether a line has a path that the schema leaves out: more members, with those of its objects, than
        paths of the schema that it has."""
        members = F.aggregate(F.map_values("_members"), F.size("_members"),
                              lambda n, x: n + F.coalesce(F.array_size(F.map_keys(_members(x))), F.lit(0)))
        known = F.filter(F.array(*[F.col(f"_told_{i}").isNotNull() for i in range(len(self.paths))]), lambda k: k)
        return members > (F.size(known) if self.paths else F.lit(0))


def infer_shape(variants: DataFrame, most: int = MOST) -> Shape:
    """The schema of ``read_variants``' result: per path the family of most lines (the first by name
    among equals; integers count as numbers where numbers occur too), for the ``most`` paths found in
    most lines."""
    # the members of every line, and below them the members of those that are objects; the counts of (member, schema)
    # pairs are few rows, so families and paths are worked out on these
    tvf = variants.sparkSession.tvf
    outer = (variants.select(F.when(F.schema_of_variant("v").startswith("OBJECT"), F.col("v")).alias("v"))
             .lateralJoin(tvf.variant_explode(F.col("v").outer()))
             .select("key", "value", F.schema_of_variant("value").alias("_schema")))
    inside = outer.withColumn("_inside", F.when(F.col("_schema").startswith("OBJECT"), F.col("value")))
    pairs = (inside.lateralJoin(tvf.variant_explode_outer(F.col("_inside").outer()).toDF("_pos", "_key", "_value"))
             .groupBy("key", F.substring_index("_schema", "<", 1).alias("told"), F.col("_key").alias("inner"),
                      F.substring_index(F.schema_of_variant("_value"), "<", 1).alias("inner_told"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("_pos"), F.lit(0)) == 0).alias("first")))
    path = F.array(
        F.struct(F.array("key").alias("path"), _family(F.col("told")).alias("family"), F.col("first").alias("n")),
        F.struct(F.array("key", "inner").alias("path"),
                 F.when(F.col("inner").isNull(), "none").otherwise(_family(F.col("inner_told"))).alias("family"), "n"))
    counts = (pairs.select(F.inline(path)).where("family <> 'none'")
              .groupBy("path", "family").agg(F.sum("n").alias("n")))
    per_path = (counts.groupBy("path").agg(F.sum("n").alias("lines"),
                                           F.collect_list(F.struct("family", "n")).alias("families"))
                .orderBy(F.col("lines").desc(), "path").limit(most).collect())
    decided = []
    for r in per_path:
        n = {f.family: f.n for f in r.families}
        if "number" in n:
            n["number"] += n.pop("integer", 0)
        decided.append((tuple(r.path), min(n, key=lambda f: (-n[f], f))))
    return Shape(tuple(sorted(decided)))


def shred_lines(variants: DataFrame, shape: Shape) -> DataFrame:
    """Every line in one pass: ``line``, ``reason`` (null where it fits) and ``typed``, a struct of the columns and
    ``rest``, all null where the line does not fit."""
    told = (variants.withColumns(shape.told())
            # a generator: no filter on the reason is moved below it, where each use of ``v`` would parse the line again
            .select("*", F.explode(F.array(shape.reason())).alias("reason")))
    fits, columns = F.col("reason").isNull(), [*shape.columns(), F.when(shape.beyond(), F.col("line")).alias("rest")]
    names = [*shape.names(), "rest"]
    return told.select("line", "reason", F.struct(*[F.when(fits, c).alias(n) for n, c in zip(names, columns)]).alias("typed"))


def shred(variants: DataFrame, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """(typed, quarantined): the lines that fit as typed columns and ``rest`` (the whole line where it has
    paths that are no column), and the others as (line, reason). Each reads the lines; ``shred_lines`` has both."""
    lines = shred_lines(variants, shape)
    return lines.where("reason is null").select("typed.*"), lines.where("reason is not null").select("line", "reason")
