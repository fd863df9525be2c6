"""Relational operators that Spark has no single call for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order (state nulls' place in it)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def newest(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The row of each key with the largest label, without the label.

    One aggregation that combines on the map side: rows of a hot key never meet
    unreduced in a task.
    """
    rest = [c for c in df.columns if c not in (*keys, label)]
    picked = df.groupBy(*keys).agg(F.max(F.struct(F.col(label), *[F.col(c) for c in rest])).alias("_r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns if c != label])


def current_vintage(df: DataFrame, column: str = "vintage") -> DataFrame:
    """Rows of the latest vintage alone."""
    last = df.agg(F.max(column).alias("_last"))
    return df.join(F.broadcast(last), F.col(column) == F.col("_last")).drop("_last")


def _number(column: str, kind: str) -> Column:
    """A number in the order of a day, an instant or a number."""
    if kind == "date":
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("double")
    return (F.unix_micros(F.col(column).cast("timestamp")) / 1e6) if kind.startswith("timestamp") else F.col(column).cast("double")


#: Rows up to which a table is broadcast, or put in order by one task.
FEW = 100_000


def few(df: DataFrame, rows: int = FEW) -> bool:
    """Does the table have so few rows? No more than that many are counted."""
    return df.limit(rows + 1).count() <= rows


def bounded(df: DataFrame, rows: int = FEW) -> DataFrame:
    """The table, marked for broadcasting if it has so few rows; Spark joins by other means beyond."""
    return F.broadcast(df) if few(df, rows) else df


def as_of(left: DataFrame, right: DataFrame, at: str, since: str, value: str, out: str, stretches: int = 256) -> DataFrame:
    """``out``: the value of the right row with the latest ``since`` up to ``at``; of the earliest one if none.

    Of right rows with one ``since`` the largest value counts; moments may
    repeat and may be null (then the earliest value is borrowed). Moments and
    right rows are united in time. If they are few, one task puts them in order;
    else they are dealt into stretches, each scanned by itself, and a stretch
    starts with the last value of those before. No pair of a moment and an older
    row is made.
    """
    kind, right = left.schema[at].dataType.simpleString(), right.where(F.col(since).isNotNull())
    first = right.agg(F.min(F.struct(since, value))[value].alias("_first"))
    marks = right.groupBy(F.col(since).alias("_t")).agg(F.max(value).alias("_v"), F.lit(None).cast(kind).alias("_at"))
    moments = left.where(F.col(at).isNotNull()).select(F.col(at).alias("_t"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.col(at).alias("_at")).distinct()
    both = marks.unionByName(moments)
    order = ["_t", F.col("_at").asc_nulls_first()]
    if few(both):
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        seen = both.withColumn("_known", F.last("_v", ignorenulls=True).over(w)).where("_at is not null")
    else:
        both = both.withColumn("_n", _number("_t", kind))
        span = both.agg(F.min("_n").alias("_lo"), F.greatest(F.max("_n") - F.min("_n"), F.lit(1e-9)).alias("_width"))
        both = both.crossJoin(F.broadcast(span)).withColumn("_b", F.floor((F.col("_n") - F.col("_lo")) / F.col("_width") * stretches))
        w = Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        ends = both.where("_v is not null").groupBy("_b").agg(F.max_by("_v", "_t").alias("_end"))
        before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row for each stretch
        carried = left.sparkSession.range(stretches + 1).withColumnRenamed("id", "_b").join(ends, "_b", "left").select("_b", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
        seen = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_at is not null")
        seen = seen.join(F.broadcast(carried), "_b").withColumn("_known", F.coalesce("_v", "_carried"))
    found = seen.select(F.col("_at").alias(at), "_known")
    joined = left.join(found, at, "left").crossJoin(F.broadcast(first))
    return joined.select(*left.columns, F.coalesce("_known", "_first").alias(out), F.col("_known").isNull().alias(f"{out}_borrowed"))


def known_unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str = "measure", value: str = "value") -> DataFrame:
    """A row for each known value."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def weighted_quantiles(df: DataFrame, keys: list[str], value: str, weight: str, shares: dict[str, float]) -> DataFrame:
    """The mean, and the smallest values whose cumulative weight reaches each share.

    Weights are summed by value first, so only distinct values are put in order.
    """
    w = Window.partitionBy(*keys)
    ordered = w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.groupBy(*keys, value).agg(F.sum(weight).alias(weight))
    cumulative = df.withColumn("_below", F.sum(weight).over(ordered)).withColumn("_total", F.sum(weight).over(w))
    quantiles = [F.min(F.when(F.col("_below") >= s * F.col("_total"), F.col(value))).alias(n) for n, s in shares.items()]
    return cumulative.groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("mean"), *quantiles)


def flagged_by(df: DataFrame, keys_of: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Does the key occur in the other table? An existence join; never null."""
    marked = keys_of.select(*on).distinct().withColumn(flag, F.lit(True))
    return df.join(marked, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def grid_band_join(left: DataFrame, right: DataFrame, axes: list[tuple[str, str, float]]) -> DataFrame:
    """Pairs that are within a reach on every axis (left column, right column, reach).

    Cells as wide as the reach make it an equi-join: each right row is sent to
    its own cell and the neighbours, and the exact test follows.
    """
    cell = lambda c, r: F.floor(F.col(c) / r).cast("long")
    near = right
    for i, (_, b, reach) in enumerate(axes):
        near = near.withColumn(f"_c{i}", F.explode(F.sequence(cell(b, reach) - 1, cell(b, reach) + 1)))
    own = left
    for i, (a, _, reach) in enumerate(axes):
        own = own.withColumn(f"_c{i}", cell(a, reach))
    cells = [f"_c{i}" for i in range(len(axes))]
    exact = [F.abs(F.col(a) - F.col(b)) <= reach for a, b, reach in axes]
    joined = own.join(near, cells)
    for test in exact:
        joined = joined.where(test)
    return joined.drop(*cells)


def nearest_one(left: DataFrame, right: DataFrame, key: list[str], distance: Column, columns: list[str]) -> DataFrame:
    """Of each left row, the columns of the right row at the least distance (ties: least columns).

    ``right`` is a reference table of few rows: every row of it meets every left
    row. It is broadcast if it has as few as it should.
    """
    pairs = left.crossJoin(bounded(right)).withColumn("_d", distance)
    best = pairs.groupBy(*key).agg(F.min(F.struct("_d", *columns)).alias("_b"))
    return left.join(best.select(*key, F.col("_b._d").alias("distance"), *[F.col(f"_b.{c}").alias(c) for c in columns]), key, "left")


def previous(df: DataFrame, keys: list[str], stretch: str, at: str, tie: str, out: str) -> DataFrame:
    """``out``: the ``at`` of the row before, of the rows of a key in order; null for the first.

    ``stretch`` is a column that grows with ``at`` and cuts a key's rows into
    stretches. Each is put in order by itself, and begins with the last moment of
    the stretch before, so no task holds all rows of a key.
    """
    within = Window.partitionBy(*keys, stretch).orderBy(at, tie)
    ends = df.groupBy(*keys, stretch).agg(F.max(at).alias("_end"))
    carried = ends.select(*keys, stretch, F.lag("_end").over(Window.partitionBy(*keys).orderBy(stretch)).alias("_before"))
    joined = df.withColumn("_own", F.lag(at).over(within)).join(carried, [*keys, stretch])
    return joined.withColumn(out, F.coalesce("_own", "_before")).drop("_own", "_before")


def expand_days(df: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """A row for each day of an inclusive range."""
    return df.withColumn(day, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))))


def replaced(df: DataFrame, **columns: Column) -> DataFrame:
    """The same columns in the same order, some computed anew."""
    return df.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in df.columns])


def as_text(df: DataFrame) -> DataFrame:
    """Instants as text, so that none crosses into Python with a zone of its own."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])
