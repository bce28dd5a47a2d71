"""Exact quantiles without gathering the values in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], buckets: int = 256) -> DataFrame:
    """One row with an exact, linearly interpolated quantile per name in `probs`.

    Values are counted per distinct value (map-side first, so a hot value is one row),
    cut into value ranges of about equal size, and only the few ranges that hold a
    wanted rank are sorted, each in its own task. `percentile` would keep every
    distinct value in one aggregation buffer.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    cuts = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = counts.agg(F.percentile_approx("v", cuts, 4 * buckets).alias("b")).scalar()
    # Never null, or Spark would test the bucket of every row below the counting.
    bucket = F.coalesce(F.size(F.filter("bounds", lambda b: b < F.col("v"))), F.lit(0))
    ranged = counts.withColumn("bounds", bounds).select("v", "n", bucket.alias("bucket"))

    # At most `buckets` rows from here on.
    in_order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    sizes = ranged.groupBy("bucket").agg(F.sum("n").alias("size")).select(
        "bucket",
        "size",
        F.coalesce(F.sum("size").over(in_order), F.lit(0)).alias("before"),
        F.sum("size").over(everything).alias("total"),
    )
    ranks: dict[str, tuple[Column, Column]] = {}
    for name, p in probs.items():
        position = (F.col("total") - 1) * F.lit(p)
        ranks[name] = (F.floor(position), F.ceil(position))
    holds = F.lit(False)
    for pair in ranks.values():
        for rank in pair:
            holds = holds | ((rank >= F.col("before")) & (rank < F.col("before") + F.col("size")))
    wanted = sizes.where(holds)

    so_far = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.join(F.broadcast(wanted), "bucket").withColumn(
        "first", F.col("before") + F.coalesce(F.sum("n").over(so_far), F.lit(0))
    )

    def at(rank: Column) -> Column:
        hit = (rank >= F.col("first")) & (rank < F.col("first") + F.col("n"))
        return F.max(F.when(hit, F.col("v")))

    picked = ranked.agg(
        F.max("total").alias("total"),
        *[at(lo).alias(f"{name}_lo") for name, (lo, _) in ranks.items()],
        *[at(hi).alias(f"{name}_hi") for name, (_, hi) in ranks.items()],
    )
    out = []
    for name, p in probs.items():
        position = (F.col("total") - 1) * F.lit(p)
        t = position - F.floor(position)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        # Interpolate from the nearer end, so that both ends are hit exactly.
        q = F.when(t < 0.5, lo + (hi - lo) * t).otherwise(hi - (hi - lo) * (1 - t))
        out.append(q.alias(name))
    return picked.select(*out)


def iqr_fence(df: DataFrame, value: str, width: float = 1.5) -> DataFrame:
    """One row: q1, q3 and the fence [q1 - width * iqr, q3 + width * iqr]."""
    iqr = F.col("q3") - F.col("q1")
    return exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}).select(
        "q1",
        "q3",
        (F.col("q1") - width * iqr).alias("lower"),
        (F.col("q3") + width * iqr).alias("upper"),
    )
