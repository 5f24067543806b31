"""Left outer equi joins that stay balanced when a few keys hold most rows.

Heavy hitters are looked for first, then the plan is chosen. Each side's key
column is run through a frequent-items sketch (``approx_top_k``: a Misra-Gries
style state of ``TRACKED`` items per task, merged), so finding them shuffles
sketches, not keys. No hot key: plain joins, which AQE may still split. With
hot keys, their short list (at most ``TRACKED`` per side, the proven bound of
its broadcast) gives each a grid of salts: a key with many left rows spreads
them over ``a`` salts and copies its right rows to each; a key with many rows
in a joined side spreads those over ``b`` salts and copies its left rows. Each
(left row, right row) pair meets in exactly one cell. Joins of a star on one
key share the grid, so every side is shuffled once, on (key, salt).

A left row's copies that meet nothing in their cell are dropped where the side
is spread (a sketched key has rows there); a key whose side isn't spread keeps
its unmatched rows. Copies never outnumber the output rows they make, but for
salts that happen to stay empty. Counts of the sketch only steer the balance;
results don't depend on them.

Salts come from a hash of the row and its input partition's number, not from
random numbers, so a recomputed partition (after an executor loss) gets the
same salts, and equal rows of different partitions spread as well.
"""

from __future__ import annotations

import math

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUTO = "auto"
TRACKED = 1024  # items of a sketch: any key with more than about 1 / 250 of a side's rows is among them
FLOOR = 1 << 14  # keys with fewer rows are never worth salting by themselves
CELLS = 8  # cells per task that a key's rows are spread over: small ones pack evenly
ROWS_PER_SORT = 500_000  # rows that one task of a global sort is meant to hold


def _estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, as it decides on broadcasts; None where it can't be asked."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, Py4JError):
        return None


def _broadcast_bound(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        return int(text)
    except ValueError:  # with a unit
        return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def will_broadcast(df: DataFrame) -> bool:
    """Whether Spark, by its own size check, would broadcast this side: such joins have no hot tasks."""
    size = _estimated_bytes(df)
    return size is not None and size <= _broadcast_bound(df)


def heavy_hitters(df: DataFrame, key: str, tracked: int = TRACKED) -> tuple[int, list[tuple]]:
    """(rows with a key, [(key, estimated rows)]) by a sketch; estimates never fall below the true counts by design."""
    r = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {tracked}, {tracked})").alias("top")).first()
    return int(r["n"]), [(t["item"], int(t["count"])) for t in (r["top"] or []) if t["item"] is not None]


def hot_keys(df: DataFrame, key: str, threshold: int, rows_per_task: int | None = None) -> DataFrame:
    """Exactly the keys with more than ``threshold`` rows, each with its salt count ``_b`` (one shuffle of the keys)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > threshold)
              .select(key, F.ceil(F.col("_n") / F.lit(rows_per_task or threshold)).cast("int").alias("_b")))


def salted_keys(sides: list[tuple[DataFrame, str]], threshold: int | None = None, rows_per_task: int | None = None) -> list[tuple]:
    """(key, salts of each side) of every key that a sketch finds hot on some side; empty if none is.

    Without a ``threshold``, a key is hot when it has more rows than a task's
    mean, and its rows are cut into cells of an eighth of that.
    """
    found: dict = {}
    for i, (df, key) in enumerate(sides):
        rows, top = heavy_hitters(df, key)
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        limit = threshold if threshold is not None else max(FLOOR, rows // tasks)
        per_cell = (rows_per_task or threshold) if threshold is not None else max(FLOOR // CELLS, rows // (CELLS * tasks))
        for value, n in top:
            if n > limit:
                found.setdefault(value, [1] * len(sides))[i] = -(-n // max(1, per_cell))
    return [(value, *salts) for value, salts in found.items()]


def _row_salt(df: DataFrame, salts) -> F.Column:
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), salts)


def star_join(left: DataFrame, sides: list[DataFrame], key: str, threshold: int | str | None = None,
              rows_per_task: int | None = None, keys_of: DataFrame | None = None) -> DataFrame:
    """``left`` left-joined with every side on one key, hot keys of any side salted.

    ``threshold``: rows from which on a key is hot, ``AUTO`` to go by a task's
    mean, None for plain joins. ``keys_of``: a frame that shows how often the
    left keys occur, where ``left`` itself is costly to read twice.
    """
    columns = [key] + [c for c in left.columns if c != key] + [c for s in sides for c in s.columns if c != key]
    hot = []
    if threshold is not None and not (threshold == AUTO and all(will_broadcast(s) for s in sides)):
        hot = salted_keys([(left if keys_of is None else keys_of, key), *((s, key) for s in sides)],
                       None if threshold == AUTO else threshold, rows_per_task)
    if not hot:
        for side in sides:
            left = left.join(side, key, "left")
        return left.select(*columns)
    count = len(sides)
    names = ["_a", *(f"_b{i}" for i in range(count))]
    key_type = left.schema[key].dataType.simpleString()
    # At most TRACKED rows per side: the bound that this broadcast rests on.
    grid = F.broadcast(left.sparkSession.createDataFrame(hot, f"`{key}` {key_type}, " + ", ".join(f"{n} bigint" for n in names)))
    one = {n: f"coalesce({n}, 1L)" for n in names}
    cells = " * ".join(one[n] for n in names[1:])  # salts of all joined sides together

    lf = left.join(grid, key, "left").withColumn("_i", _row_salt(left, F.expr(one["_a"]))) \
        .withColumn("_j", F.explode(F.expr(f"sequence(0L, {cells} - 1)"))) \
        .withColumn("_s", F.expr(f"_i * ({cells}) + _j")).drop("_i", "_j", "_a")
    for k, side in enumerate(sides):
        later = " * ".join(one[n] for n in names[2 + k:]) or "1L"  # salts of the sides after this one
        mine = one[f"_b{k}"]
        r = side.join(grid, key, "left").withColumn("_own", _row_salt(side, F.expr(mine))) \
            .withColumn("_x", F.explode(F.expr(f"sequence(0L, {one['_a']} * (({cells}) div {mine}) - 1)"))) \
            .withColumn("_rest", F.expr(f"_x % (({cells}) div {mine})")) \
            .withColumn("_s", F.expr(f"(_x div (({cells}) div {mine})) * ({cells}) + (_rest div ({later})) * (({later}) * {mine}) + _own * ({later}) + _rest % ({later})")) \
            .withColumn(f"_m{k}", F.lit(True)).drop("_own", "_x", "_rest", *names)
        lf = lf.join(r, [key, "_s"], "left").where(F.expr(f"{mine} = 1 OR _m{k}"))
    return lf.select(*columns)


def left_join(left: DataFrame, right: DataFrame, key: str, threshold: int | str | None = None,
              rows_per_task: int | None = None, keys_of: DataFrame | None = None) -> DataFrame:
    """``left.join(right, key, "left")``; with ``threshold`` (rows, or ``AUTO``) hot keys of either side are salted."""
    return star_join(left, [right], key, threshold, rows_per_task, keys_of)


def joined_rows(left: DataFrame, sides: list[DataFrame], key: str) -> tuple[int, float]:
    """(rows of ``left``, rows of its left joins with every side), from counts by key: no row is joined for it."""
    keys = left.select(F.col(key).alias("_k"), F.lit(0).alias("_of"))
    for i, side in enumerate(sides, 1):
        keys = keys.union(side.where(F.col(key).isNotNull()).select(key, F.lit(i)))
    counts = keys.groupBy("_k").agg(*[F.count_if(F.col("_of") == i).alias(f"_n{i}") for i in range(len(sides) + 1)])
    made = F.col("_n0").cast("double")
    for i in range(1, len(sides) + 1):
        made = made * F.greatest(F.col(f"_n{i}"), F.lit(1))
    r = counts.agg(F.coalesce(F.sum("_n0"), F.lit(0)).alias("l"), F.coalesce(F.sum(made), F.lit(0.0)).alias("m")).first()
    return int(r["l"]), float(r["m"])


def sorted_rows(df: DataFrame, order: list, rows: float) -> DataFrame:
    """``df.orderBy(*order)``, in as many ranges as its expected ``rows`` need.

    A plain sort has the session's number of partitions however much there is
    to sort, so its tasks grow with the data; where that number is too small,
    the ranges are made explicitly.
    """
    ranges = math.ceil(rows / ROWS_PER_SORT)
    if ranges <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.orderBy(*order)
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
