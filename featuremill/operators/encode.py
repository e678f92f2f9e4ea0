"""Feature encoding: CASE-based 0/1 columns built in one projection per spec.

Every encoder returns ``{name: Column}`` (``*_columns`` functions) so that callers can put
many encoders into a single ``withColumns`` / ``select`` -- one Project node, however many
outputs. The ``DataFrame`` wrappers add the columns and drop their inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.functions.columns import sanitize_name
from featuremill.functions.predicates import contains_token, isin_any
from featuremill.operators.skew import salted_left_join, written


def _flag(cond: Column) -> Column:
    """1 where ``cond`` is true, 0 where it is false or null."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _require(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"encoder input columns not present: {missing}")


def _add(df: DataFrame, cols: dict, drop=()) -> DataFrame:
    dup = set(cols) & (set(df.columns) - set(drop))
    if dup:
        raise ValueError(f"encoder would overwrite existing columns {sorted(dup)}")
    return df.withColumns(cols).drop(*drop) if drop else df.withColumns(cols)


# -- split ------------------------------------------------------------------------------

def split_columns(c: str, sep: str = ",", k: int = 5, prefix: str = "cat",
                  trim: bool = True) -> dict:
    """The first ``k`` elements of a delimited string (``sep`` is a regex); missing -> null."""
    arr = F.split(F.col(c), sep)
    out = {}
    for i in range(k):
        e = F.get(arr, i)
        out[f"{prefix}{i + 1}"] = F.trim(e) if trim else e
    return out


def split_to_columns(df: DataFrame, c: str, sep: str = ",", k: int = 5, prefix: str = "cat",
                     trim: bool = True, drop: bool = True) -> DataFrame:
    _require(df, [c])
    return _add(df, split_columns(c, sep, k, prefix, trim), [c] if drop else ())


def category_flag(df: DataFrame, c: str, values, out: str, sep: str = ",", k: int = 5,
                  trim: bool = True, drop: bool = True) -> DataFrame:
    """1 if any of the first ``k`` list elements is in ``values`` (split + isin, no
    intermediate columns kept)."""
    _require(df, [c])
    parts = list(split_columns(c, sep, k, "_p", trim).values())
    return _add(df, {out: _flag(isin_any(parts, values))}, [c] if drop else ())


# -- token groups -----------------------------------------------------------------------

@dataclass(frozen=True)
class TokenGroup:
    """Output ``out`` is 1 when the input is one of ``tokens`` (or null, if ``null_in``)."""
    out: str
    tokens: tuple = ()
    null_in: bool = False


def quoted_variants(*words: str) -> tuple:
    """A token as the source may spell it: ``u'x'`` and ``'x'``."""
    return tuple(v for w in words for v in (f"u'{w}'", f"'{w}'"))


def one_hot_columns(c: str, groups) -> dict:
    col = F.col(c)
    out = {}
    for g in groups:
        cond = col.isin(list(g.tokens)) if g.tokens else F.lit(False)
        if g.null_in:
            cond = cond | col.isNull()
        out[g.out] = _flag(cond)
    return out


def one_hot_tokens(df: DataFrame, c: str, groups, drop: bool = True) -> DataFrame:
    _require(df, [c])
    return _add(df, one_hot_columns(c, groups), [c] if drop else ())


# -- flags ------------------------------------------------------------------------------

def true_flag_columns(c: str, out: str, token: str = "True", null_out: str | None = None) -> dict:
    """``out`` = 1 when the text equals ``token``; ``null_out`` = 1 when it is missing."""
    cols = {}
    if null_out:
        cols[null_out] = _flag(F.col(c).isNull())
    cols[out] = _flag(F.col(c) == token)
    return cols


def true_flag(df: DataFrame, c: str, out: str, token: str = "True", null_out: str | None = None,
              drop: bool = True) -> DataFrame:
    _require(df, [c])
    return _add(df, true_flag_columns(c, out, token, null_out), [c] if drop else ())


def contains_flag(df: DataFrame, c: str, out: str, token: str = "True",
                  drop: bool = True) -> DataFrame:
    """1 when the text holds ``token`` anywhere (dict-like attribute texts)."""
    _require(df, [c])
    return _add(df, {out: _flag(contains_token(c, token))}, [c] if drop else ())


def any_present(df: DataFrame, cols, out: str) -> DataFrame:
    """1 when any of ``cols`` is not null."""
    _require(df, cols)
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNotNull()
    return _add(df, {out: _flag(cond)})


def sentinel_class_columns(c: str, suffix: str, sentinel: str = "0:0-0:0") -> dict:
    """Three exclusive classes: missing / equal to ``sentinel`` / any other text."""
    col = F.col(c)
    return {
        f"miss_sched_{suffix}": _flag(col.isNull()),
        f"24h_{suffix}": _flag(col == sentinel),
        f"other_sched_{suffix}": _flag(col.isNotNull() & (col != sentinel)),
    }


def sentinel_class(df: DataFrame, cols: dict, sentinel: str = "0:0-0:0",
                   drop: bool = True) -> DataFrame:
    """``cols`` maps input column -> suffix (e.g. ``{"hours_Monday": "Monday"}``)."""
    _require(df, cols)
    out = {}
    for c, suffix in cols.items():
        out.update(sentinel_class_columns(c, suffix, sentinel))
    return _add(df, out, list(cols) if drop else ())


# -- frequent values -------------------------------------------------------------

@dataclass(frozen=True)
class FrequentOneHotSpec:
    """The declared values of ``column``, in sorted order."""
    column: str
    values: tuple
    prefix: str
    others: str

    def names(self) -> list:
        return [self.prefix + sanitize_name(v) for v in self.values]

    def columns(self) -> dict:
        col = F.col(self.column)
        out = {self.others: _flag(col.isNull() | ~col.isin(list(self.values)))
               if self.values else F.lit(1)}
        for name, v in zip(self.names(), self.values):
            out[name] = _flag(col == v)
        return out

    def apply(self, df: DataFrame, drop: bool = True) -> DataFrame:
        _require(df, [self.column])
        return _add(df, self.columns(), [self.column] if drop else ())


def frequent_values(df: DataFrame, c: str, min_count: int, count_of: str | None = None) -> DataFrame:
    """Values of ``c`` seen more than ``min_count`` times (null excluded), one row each."""
    n = F.count(count_of) if count_of else F.count(F.lit(1))
    return (df.where(F.col(c).isNotNull()).groupBy(c).agg(n.alias("count"))
            .where(F.col("count") > min_count))


def frequent_one_hot_spec(c: str, values, prefix: str | None = None,
                          others: str | None = None) -> FrequentOneHotSpec:
    """The wide layout for a vocabulary that the caller declares (for example from
    ``frequent_values``): its columns are the same on every table and at every size."""
    prefix = prefix if prefix is not None else f"{c}_"
    spec = FrequentOneHotSpec(c, tuple(sorted(str(v) for v in values)), prefix,
                              others or f"{prefix}others")
    names = [*spec.names(), spec.others]
    if len(set(names)) != len(names):
        raise ValueError(f"values of {c!r} collide after sanitising: {names}")
    return spec


# -- label and fill ---------------------------------------------------------------------

def label_target(df: DataFrame, c: str, out: str = "target", true_tokens=("TRUE",),
                 drop: bool = True) -> DataFrame:
    """1 when the label text is one of ``true_tokens`` (case-sensitive), else 0."""
    _require(df, [c])
    cols = {out: _flag(F.col(c).isin(list(true_tokens)))}
    return df.withColumns(cols).drop(c) if drop and c != out else df.withColumns(cols)


def fill_defaults(df: DataFrame, number=0, text: str = "0") -> DataFrame:
    """Nulls in numeric columns -> ``number``; in string columns -> ``text``. Boolean,
    date and timestamp columns keep their nulls."""
    return df.fillna(number).fillna(text)


# -- frequent values as one category column (no driver collect) ----------------------------

@dataclass(frozen=True)
class FrequentCategorySpec:
    """Fitted spec: the frequent values of ``column`` live in a Parquet table under the
    shared scratch folder; ``apply`` joins it, so nothing passes through the driver and
    there is no cap on the number of values. The output is one column holding the value
    or ``others`` -- Spark ML's formula turns it into a sparse one-hot vector. ``hot``: the
    values that hold a large share of the fitted rows (fewer than 1,000), with that share, so
    ``apply`` starts no job."""
    column: str
    table: str
    out: str
    others: str = "others"
    salt_from: tuple = ()
    hot: tuple = ()

    def apply(self, df: DataFrame, drop: bool = True) -> DataFrame:
        _require(df, [self.column])
        spark = df.sparkSession
        vals = spark.read.schema("value string").parquet(self.table).select(F.col("value").alias("_fv"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = spark.createDataFrame([(v, min(tasks, max(2, -int(-share * tasks // 1)))) for v, share in self.hot],
                                    "_fv_key string, _spread int")
        # rows of a hot value, and rows without one, are spread over many tasks
        keyed = df.withColumn("_fv_key", F.col(self.column).cast("string"))
        out = salted_left_join(keyed, vals, "_fv_key", list(self.salt_from or df.columns),
                               right_key="_fv", hot=hot)
        out = (out.withColumn(self.out, F.coalesce(F.col("_fv"), F.lit(self.others)))
               .drop("_fv", "_fv_key"))
        return out.drop(self.column) if drop and self.out != self.column else out


def fit_frequent_category(df: DataFrame, c: str, min_count: int, path: str,
                          count_of: str | None = None, out: str | None = None,
                          others: str = "others", max_hot: int = 1000) -> FrequentCategorySpec:
    """Writes the values of ``c`` seen more than ``min_count`` times to ``path``. The counts of all
    values are written first, once: the frequent and the hot values both come from them."""
    n = F.count(count_of) if count_of else F.count(F.lit(1))
    counts = written(df.groupBy(F.col(c).cast("string").alias("value"))
                     .agg(n.alias("count"), F.count(F.lit(1)).alias("rows")), "value-counts")
    known = counts.where("value is not null")
    known.where(F.col("count") > min_count).select("value").write.mode("overwrite").parquet(path)
    total = counts.agg(F.sum("rows")).first()[0] or 0
    hot = known.where(F.col("rows") * max_hot > F.lit(total)).select("value", "rows").collect()
    return FrequentCategorySpec(c, path, out or f"{c}_group", others, (count_of,) if count_of else (),
                                tuple(sorted((r.value, r.rows / total) for r in hot)))
