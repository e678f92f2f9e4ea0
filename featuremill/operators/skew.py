"""Joins that stay balanced when one key holds a large share of the rows.

A hash-partitioned join sends every row of a key to one task, so a key holding a third of
the rows is a third of the work in a single task. AQE splits such a partition only for a
sort-merge join whose two inputs are both shuffles; a join whose input is already
partitioned by the key (the output of an earlier join on the same key) is not split. The
join here salts explicitly instead:

* hot keys hold more than ``1 / max_hot`` of the rows. Since the shares add up to one, fewer
  than ``max_hot`` keys qualify: the table is bounded by construction, and both join sides
  broadcast it as literal rows. Where an aggregate by the key is there anyway, it is written
  with its row counts and they tell the hot keys (``hot_of_counts``), at no further read.
  Otherwise a mergeable frequent-items sketch finds them (``sketched``): one read of the key
  columns, a bounded sketch per task, and not one key is shuffled. ``hot_keys`` recounts the
  sketch's candidates, and only them, exactly.
* each hot key gets a spread: about its share of the ``tasks`` the join runs on (a key
  with a third of the rows, on 40,000 shuffle partitions, is cut into ~13,334 parts), so
  the parts are the size of an ordinary partition whatever the data size. Left rows of a
  hot key take a salt from a hash of other columns (deterministic: a retried task sends
  each row to the same place, which a random salt would not); right rows of a hot key are
  repeated once per salt value, at most ``tasks + max_hot`` rows in all. Left rows with a
  null key match nothing and are hashed over all ``tasks``, so a mass of missing keys
  does not meet in one task either.
* the join runs on ``(key, salt)``; every other key keeps salt 0 and a single copy. Its two
  inputs are both shuffles, so AQE can still split a moderately skewed key below the
  ``1 / max_hot`` line.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.session import scratch_path

SALT, R_SALT = "_salt", "_salt_r"


def _names(key) -> list:
    return [key] if isinstance(key, str) else list(key)


def _tasks(df: DataFrame, tasks: int | None) -> int:
    return tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: The sketch tracks so many times ``max_hot`` keys, which holds its error well below 1 / max_hot.
TRACKED = 16
#: Tasks whose sketches are merged in one place.
SKETCH_TASKS = 200


def _key_hash(keys) -> Column:
    return F.xxhash64(*[F.col(c) for c in keys])


def _spread(rows: Column, tasks: int, total: int) -> Column:
    """A key's share of the tasks, at least 2."""
    share = F.ceil(rows * F.lit(tasks) / F.lit(max(1, total)))
    return F.least(F.lit(tasks), F.greatest(F.lit(2), share)).cast("int").alias("_spread")


def sketched(df: DataFrame, key, max_hot: int = 1000) -> tuple[int, dict[int, int]]:
    """(rows of ``df``, {hash of a key: about its rows}) in one read: every key that holds more than
    ``1 / max_hot`` of the rows is there, with a few below. Keys with a null are left out."""
    keys = _names(key)
    whole = reduce(and_, [F.col(c).isNotNull() for c in keys])
    # the tasks' sketches are merged by ``SKETCH_TASKS``, so no task merges more, however many there are;
    # a key's counts are then summed over the groups that list it (one unlisted is within the error)
    own = df.select(_key_hash(keys).alias("_key"), whole.alias("_whole"),
                    F.floor(F.spark_partition_id() / F.lit(SKETCH_TASKS)).alias("_group"))
    top = F.expr(f"approx_top_k(_key, {2 * max_hot}, {TRACKED * max_hot}) FILTER (WHERE _whole)")
    rows = F.struct(F.lit(None).cast("long").alias("item"), F.col("_n").alias("count"))  # all rows of a group
    found = (own.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"), top.alias("_top"))
             .select(F.explode(F.concat(F.array(rows), F.coalesce("_top", F.array().cast(
                 "array<struct<item:bigint,count:bigint>>")))).alias("_i"))
             .groupBy("_i.item").agg(F.sum("_i.count").alias("count"))
             .orderBy(F.col("count").desc(), F.col("item").asc_nulls_first()).limit(2 * max_hot + 1).collect())
    n = sum(r["count"] for r in found if r.item is None)
    # the sketch may be wrong by 3.5 rows in every ``TRACKED * max_hot``
    slack = 3.5 / (TRACKED * max_hot)
    return n, {r.item: r["count"] for r in found if r.item is not None and r["count"] >= n * (1 / max_hot - slack)}


def hot_hashes(df: DataFrame, key, max_hot: int = 1000, tasks: int | None = None) -> DataFrame:
    """``_key`` (the hash of a hot key) and ``_spread`` as literal rows, by the sketch alone. A key
    just below the line may be among them: it only decides how a join deals out its rows."""
    tasks = _tasks(df, tasks)
    n, found = sketched(df, key, max_hot)
    rows = [(h, min(tasks, max(2, -(-c * tasks // max(1, n))))) for h, c in sorted(found.items())]
    return df.sparkSession.createDataFrame(rows, "_key long, _spread int")


def hot_keys(df: DataFrame, key, max_hot: int = 1000, tasks: int | None = None) -> DataFrame:
    """Values of ``key`` (a column name or a list of them) holding more than
    ``1 / max_hot`` of the rows of ``df`` (fewer than ``max_hot`` rows), each with
    ``_spread``: its share of ``tasks`` (default: the shuffle partitions), at least 2. Only the
    sketch's candidates are counted and shuffled."""
    keys = _names(key)
    tasks = _tasks(df, tasks)
    n, found = sketched(df, keys, max_hot)
    few = df.sparkSession.createDataFrame([(h,) for h in sorted(found)], "_key long")
    counts = (df.select(*keys, _key_hash(keys).alias("_key")).join(F.broadcast(few), "_key")
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    return (counts.where(F.col("_rows") * F.lit(max_hot) > F.lit(n))
            .select(*keys, _spread(F.col("_rows"), tasks, n)))


def hot_of_counts(counts: DataFrame, key, rows: str = "_rows", max_hot: int = 1000,
                  tasks: int | None = None) -> DataFrame:
    """``hot_keys`` as literal rows, from a table that has the number of rows of every key (one row
    a key, a null key included); write it first, it is read for the total and for the keys."""
    tasks = _tasks(counts, tasks)
    n = counts.agg(F.sum(rows)).first()[0] or 0
    return held(counts.where(F.col(rows) * F.lit(max_hot) > F.lit(n))
                .select(*_names(key), _spread(F.col(rows), tasks, n)))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held(hot: DataFrame) -> DataFrame:
    """A hot-key table as literal rows: both sides of a join then use it without counting
    the keys again (fewer than ``max_hot`` rows, by construction of ``hot_keys``)."""
    return hot.sparkSession.createDataFrame(hot.collect(), hot.schema)


def salt_sides(left: DataFrame, right: DataFrame, key, salt_from, spread: int | None = None,
               max_hot: int = 1000, hot: DataFrame | None = None, right_key=None):
    """The two inputs of a salted equi-join: ``left`` with ``_salt`` and ``right`` with
    ``_salt_r``; join them on the keys and ``_salt = _salt_r`` (for SQL over views).
    ``spread``: the tasks the join runs on (default: the shuffle partitions)."""
    lk = _names(key)
    rk = lk if right_key is None else _names(right_key)
    tasks = _tasks(left, spread)
    if hot is None:  # by the sketch: keyed by their hash
        hot = hot_hashes(left.select(*lk), lk, max_hot, tasks)
        left, right = left.withColumn("_key", _key_hash(lk)), right.withColumn("_key", _key_hash(rk))
        on, right_on = ["_key"], ["_key"]
    else:
        on, right_on = lk, rk
    hot = hot.select(*on, "_spread")
    h = F.xxhash64(*[F.col(c) for c in salt_from])
    salt = (F.when(reduce(or_, [F.col(c).isNull() for c in lk]), F.pmod(h, F.lit(tasks)))
            .when(F.col("_spread").isNotNull(), F.pmod(h, F.col("_spread")))
            .otherwise(F.lit(0)))
    salted = (left.join(F.broadcast(hot), on, "left")
              .withColumn(SALT, salt.cast("int")).drop("_spread", "_key"))
    copies = F.when(F.col("_spread").isNotNull(),
                    F.sequence(F.lit(0), F.col("_spread") - 1)).otherwise(F.array(F.lit(0)))
    repeated = (right.join(F.broadcast(hot.toDF(*right_on, "_spread")), right_on, "left")
                .withColumn(R_SALT, F.explode(copies)).drop("_spread", "_key"))
    return salted, repeated


def salted_left_join(left: DataFrame, right: DataFrame, key, salt_from,
                     spread: int | None = None, max_hot: int = 1000,
                     hot: DataFrame | None = None, right_key=None) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``key`` (a name or a list), with hot and null keys of
    ``left`` spread over many tasks. Without ``right_key`` the keys are joined by name
    (one copy in the output, as a USING join); with it, ``left.key[i] = right.right_key[i]``
    and both sides' columns are kept.

    The result is the plain left join's, row for row: a left row carries one salt and meets
    every right row of its key exactly once (each is repeated once per salt). ``salt_from``
    names left columns that vary within a key (the other half of a pair, a row id).
    ``right`` should be the smaller side: its hot keys' rows are repeated. ``hot``: the
    keys to spread (a ``hot_keys`` table); by default the sketched hot keys of ``left``. ``spread``:
    the tasks the join runs on (default: the shuffle partitions; 1 = a plain join).
    """
    lk = _names(key)
    rk = lk if right_key is None else _names(right_key)
    if spread == 1:
        if right_key is None:
            return left.join(right, lk, "left")
        cond = reduce(and_, [left[a] == right[b] for a, b in zip(lk, rk)])
        return left.join(right, cond, "left")
    salted, repeated = salt_sides(left, right, lk, salt_from, spread, max_hot, hot, right_key)
    if right_key is None:
        return (salted.join(repeated.withColumnRenamed(R_SALT, SALT), [*lk, SALT], "left")
                .drop(SALT))
    cond = reduce(and_, [salted[a] == repeated[b] for a, b in zip(lk, rk)]
                  + [salted[SALT] == repeated[R_SALT]])
    return salted.join(repeated, cond, "left").drop(SALT, R_SALT)
