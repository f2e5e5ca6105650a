"""Group and order helpers that hold when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinara.storage import stage


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row of each key.

    The rank filter is applied before the shuffle as well (window group limit), so a task ships one row per key it saw
    and a hot key arrives as one row per map task. ``order`` must end in a unique column.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def drop_copies(df: DataFrame, keys: list[str | Column], order: list[Column], unique: str) -> DataFrame:
    """First row of each key of a written table with wide rows, such as whole texts; ``unique`` numbers the rows.

    Only keys and order columns are shuffled and sorted. The numbers of the other rows are written, so their size is known: Spark
    sends few of them to every task, and the wide rows then stay where they are.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.col(unique)))
    copies = df.withColumn("_rank", rank).filter("_rank > 1").select(unique)
    return df.join(stage(copies, "copies"), unique, "left_anti")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, unique: str, salts: int = 32) -> DataFrame:
    """First ``n`` rows of each group, in two rounds: per salted part of a group, then per group.

    No task ever sorts a whole group; the second round sees at most ``salts * n`` rows of it.
    """
    part = F.pmod(F.xxhash64(F.col(unique)), F.lit(salts))
    for by in ([*keys, "_part"], keys):
        df = df.withColumn("_part", part)
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        df = df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank", "_part")
    return df


def global_rank(df: DataFrame, order: list[str], rank: str = "rank", partitions: int | None = None) -> DataFrame:
    """Exact 1-based rank over the whole frame without a single-task sort.

    Rows are range-partitioned on ``order`` and written; the rank is the row number inside a range plus the sizes of the
    ranges before it. ``order`` must end in a unique column, so no range can be dominated by one value. The offsets table
    has one row per range.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_range")
        .withColumn(rank, F.col("_inside") + F.col("_before"))
        .drop("_range", "_inside", "_before")
    )


PIVOT_STEPS = tuple(1 << i for i in range(11, -1, -1))
PIVOTS = sum(PIVOT_STEPS)
#: Points of the sketch at which a part is cut, as one constant, and the sketch's accuracy.
POINTS = ",".join(str(i / (PIVOTS + 1)) for i in range(1, PIVOTS + 1))
ACCURACY = 20_000


def order_number(value: Column, kind: str) -> Column:
    """A double that never falls while the value rises; equal for close values, infinite for null (nulls come last)."""
    if kind == "string":
        number = F.conv(F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("double")
    elif kind.startswith("timestamp"):
        number = F.unix_micros(value.cast("timestamp")).cast("double")
    elif kind == "date":
        number = F.unix_date(value).cast("double")
    else:
        number = value.cast("double")
    return F.coalesce(number, F.lit(float("inf")))


def select_ranks(rows: DataFrame, asks: DataFrame) -> DataFrame:
    """The values at given ranks (from 1) without sorting the rows: one row with the array ``found`` of (target, tag, value, left).

    ``rows`` has tag and value. ``asks`` is one row with the array ``asks`` of (target, tag, rank), a handful; a rank counts among
    the rows with that tag. ``left`` is the place among the rows of equal value. Three scans, each of which takes the one row of
    the scan before as a subquery: quantiles of a sketch cut each tag into cells; the cells are counted; those that hold a wanted
    rank are counted by value and sorted. Where the cuts lie changes the cost, not the result. A cell has about 1 in 4096 rows,
    some millions of ten thousand million, and a value that is everywhere is one row of its cell. Nulls come last.
    """
    number = order_number(F.col("value"), rows.schema["value"].dataType.simpleString())
    points = F.split(F.lit(POINTS), ",").cast("array<double>")
    steps = F.array(*[F.lit(s) for s in PIVOT_STEPS])
    rows = rows.select("tag", "value", number.alias("x"))
    first = lambda found: F.get(found, F.lit(0))
    before = lambda by, *order: F.coalesce(F.sum("n").over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    asked = rows.withColumn("asks", asks.scalar()).filter(F.exists("asks", lambda a: a.tag.eqNullSafe(F.col("tag"))))
    sketched = asked.groupBy("tag").agg(F.percentile_approx("x", points, ACCURACY).alias("pivots"), F.any_value("asks").alias("asks"))
    cuts = sketched.agg(F.struct(F.any_value("asks").alias("asks"), F.collect_list(F.struct("tag", "pivots")).alias("cuts")).alias("s"))

    cut = rows.withColumn("s", cuts.scalar()).withColumn("pivots", first(F.filter("s.cuts", lambda c: c.tag.eqNullSafe(F.col("tag")))).pivots)
    cell = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.col("x") >= F.get("pivots", at + step - 1), step).otherwise(0))
    cut = cut.filter("pivots IS NOT NULL").withColumn("cell", cell)
    edges = [F.get("pivots", F.col("cell") - 1).alias("low"), F.get("pivots", "cell").alias("high")]
    counted = cut.select("tag", "cell", *edges, "s.asks").groupBy("tag", "cell", "low", "high").agg(F.count("*").alias("n"), F.any_value("asks").alias("asks"))
    placed = counted.withColumn("before", before("tag", "cell"))
    here = F.filter("asks", lambda a: a.tag.eqNullSafe(F.col("tag")) & (a["rank"] > F.col("before")) & (a["rank"] <= F.col("before") + F.col("n")))
    held = placed.select("tag", "low", "high", "before", F.explode(here).alias("a"))
    hits = held.agg(F.collect_list(F.struct("a.target", "tag", (F.col("a.rank") - F.col("before")).alias("rank"), "low", "high")).alias("hits"))

    mine = lambda h: h.tag.eqNullSafe(F.col("tag")) & F.coalesce(F.col("x") >= h.low, F.lit(True)) & F.coalesce(F.col("x") < h.high, F.lit(True))
    kept = rows.withColumn("hits", hits.scalar()).withColumn("h", F.explode(F.filter("hits", mine))).drop("hits")
    values = kept.groupBy("h.target", "tag", "h.rank", "value").agg(F.count("*").alias("n"))
    values = values.withColumn("left", F.col("rank") - before("target", F.col("value").asc_nulls_last()))
    at_rank = values.filter((F.col("left") > 0) & (F.col("left") <= F.col("n")))
    return at_rank.agg(F.array_sort(F.collect_list(F.struct("target", "tag", "value", "left"))).alias("found"))


def boundary_rows(df: DataFrame, key: Column, unique: str, ranks: dict[str, Column], **sizes: Column) -> DataFrame:
    """One row: for each name the struct (key, unique) of the row at its rank in the order of key, then unique; null if there is
    no such rank. Ranks are expressions over ``sizes``, aggregates of the frame."""
    ask = lambda i, rank: F.struct(F.lit(i).alias("target"), F.lit(0).alias("tag"), rank.cast("bigint").alias("rank"))
    asks = df.agg(*[c.alias(n) for n, c in sizes.items()]).select(F.array(*[ask(i, r) for i, r in enumerate(ranks.values())]).alias("asks"))
    slim = df.select(key.alias("key"), F.col(unique).alias("unique"))
    keys = select_ranks(slim.select(F.lit(0).alias("tag"), F.col("key").alias("value")), asks)
    # Among the rows of equal key the unique column decides.
    ties = keys.select(F.transform("found", lambda f: F.struct(f.target.alias("target"), f.value.alias("tag"), f.left.alias("rank"))).alias("asks"))
    rows = select_ranks(slim.select(F.col("key").alias("tag"), F.col("unique").alias("value")), ties)
    at = lambda i: F.filter("found", lambda f: f.target == i)
    return rows.select(*[
        F.get(F.transform(at(i), lambda f: F.struct(f.tag.alias("key"), f.value.alias("unique"))), F.lit(0)).alias(name) for i, name in enumerate(ranks)
    ])


def up_to(key: Column, unique: str, bound: Column) -> Column:
    """Whether a row stands at or before a boundary row; nulls come last. Null without a boundary."""
    own = F.struct(key.isNull().alias("last"), key.alias("key"), F.col(unique).alias("unique"))
    at = F.struct(bound["key"].isNull().alias("last"), bound["key"].alias("key"), bound["unique"].alias("unique"))
    return F.when(bound.isNotNull(), own <= at)


def quantiles(df: DataFrame, value: str, points: dict[str, float]) -> DataFrame:
    """One row with exact interpolated quantiles of a numeric column, named by ``points``; nulls are left out."""
    rows = df.select(F.lit(0).alias("tag"), F.col(value).alias("value")).filter(F.col("value").isNotNull())
    size = rows.agg(F.count("*").alias("n"))
    position = lambda point: (F.col("n") - 1) * F.lit(point) + 1
    ranks = [edge(position(point)) for point in points.values() for edge in (F.floor, F.ceil)]
    asks = [F.struct(F.lit(i).alias("target"), F.lit(0).alias("tag"), r.cast("bigint").alias("rank")) for i, r in enumerate(ranks)]
    found = select_ranks(rows, size.select(F.array(*asks).alias("asks"))).withColumn("n", size.scalar())
    at = lambda i: F.get(F.filter("found", lambda f: f.target == i), F.lit(0)).value.cast("double")
    share = lambda point: position(point) - F.floor(position(point))
    return found.select(*[(at(2 * i) + (at(2 * i + 1) - at(2 * i)) * share(point)).alias(name) for i, (name, point) in enumerate(points.items())])
