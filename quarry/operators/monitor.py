"""Model monitoring.

Everything is a grouped aggregate: confusion counts, per-window errors and
binned distributions are computed with map-side partial aggregation; only
the tiny per-window / per-bin results are combined afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPS = 1e-4  # fixed value: floor for empty PSI bins


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def attach_actuals(pred: DataFrame, actuals: DataFrame, pred_keys: list[str], actual_keys: list[str], y: str) -> DataFrame:
    """Left-join actuals onto predictions on renamed compound keys."""
    a = actuals.select(*[F.col(k).alias(f"__a_{i}") for i, k in enumerate(actual_keys)], F.col(y))
    cond = None
    for i, k in enumerate(pred_keys):
        c = pred[k] == a[f"__a_{i}"]
        cond = c if cond is None else cond & c
    out = pred.join(a, cond, "left")
    return out.drop(*[f"__a_{i}" for i in range(len(actual_keys))])


def monitor_baseline(df: DataFrame, key: str, ts: str, y: str, pred_name: str) -> DataFrame:
    """Baseline rows where the actual is copied as the prediction."""
    return df.select(key, ts, F.col(y).alias(pred_name), F.col(y))


def weighted_prf(df: DataFrame, y: str, yhat: str, by=None) -> DataFrame:
    """M4 (and M21 with ``by`` = a day column): support-weighted precision,
    recall and F1, a class's score being 0 where undefined.

    One pass: every row emits two class events - its actual class (support,
    and a true positive when the prediction agrees) and its predicted class -
    and one grouped sum (map-side partial) gives support, predicted and tp
    per (group, class).  The per-class arithmetic then runs on
    groups x classes rows.
    """
    keys = _cols(by) if by else []
    ct = df.schema[y].dataType
    ev = df.select(
        *keys,
        F.explode(
            F.array(
                F.struct(
                    F.col(y).cast(ct).alias("c"),
                    F.lit(1).alias("s"),
                    F.lit(0).alias("pr"),
                    (F.col(y) == F.col(yhat)).cast("int").alias("tp"),
                ),
                F.struct(F.col(yhat).cast(ct).alias("c"), F.lit(0).alias("s"), F.lit(1).alias("pr"), F.lit(0).alias("tp")),
            )
        ).alias("e"),
    )
    per = ev.groupBy(*keys, F.col("e.c").alias("c")).agg(
        F.sum("e.s").alias("support"), F.sum("e.pr").alias("predicted"), F.sum("e.tp").alias("tp")
    )
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    pr = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", F.when(pr > 0, 2 * F.col("precision") * F.col("recall") / pr).otherwise(F.lit(0.0)))
    tot = F.sum("support")
    return per.groupBy(*keys).agg(
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
        tot.alias("n"),
    )


def bin_expr(col: str, lo, hi, bins: int):
    """Bin index in [0, bins-1] on edges [lo, hi]; values outside the
    baseline range fall in the edge bins; a constant baseline column puts
    everything in bin 0."""
    width = hi - lo
    raw = F.floor((F.col(col) - lo) / width * bins)
    return F.when(width <= 0, F.lit(0)).otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))).cast("int")


def psi(baseline: DataFrame, current: DataFrame, col: str, bins: int = 10, by=None, edges: str = "width") -> DataFrame:
    """Population stability index of ``col`` per group ``by``.

    PSI = sum_b (p_b - q_b) * ln(p_b / q_b), with p = current share and
    q = baseline share per bin, both floored at EPS.  Equal-width edges come
    from the baseline only, as two scalar subqueries (no join); nulls are
    ignored.  Each group is expanded to all ``bins`` bins by a generator,
    so a bin empty on either side still contributes.
    """
    keys = _cols(by) if by else []
    base = baseline.filter(F.col(col).isNotNull())
    if edges == "quantile":
        # bins-1 cut points at the baseline's i/bins quantiles (a bounded
        # sketch, no global sort); bin = number of cut points <= value
        probs = [i / bins for i in range(1, bins)]
        cuts = base.agg(F.percentile_approx(col, probs, 10000)).scalar()
        bexpr = lambda: sum(  # noqa: E731 - bins-1 comparisons, no higher-order function
            ((cuts.getItem(i) <= F.col(col)).cast("int") for i in range(bins - 1)), F.lit(0)
        ).cast("int")
    else:
        lo = base.agg(F.min(col)).scalar()
        hi = base.agg(F.max(col)).scalar()
        bexpr = lambda: bin_expr(col, lo, hi, bins)
    bq = base.groupBy(bexpr().alias("bin")).agg(F.count(F.lit(1)).alias("qn"))
    q = bq.select("bin", (F.col("qn") / F.sum("qn").over(Window.partitionBy())).alias("q"))
    cur = current.filter(F.col(col).isNotNull())
    pc = cur.groupBy(*keys, bexpr().alias("bin")).agg(F.count(F.lit(1)).alias("pn"))
    pc = pc.withColumn("p", F.col("pn") / F.sum("pn").over(Window.partitionBy(*keys)))
    grid = pc.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    # q has at most ``bins`` rows: bounded, safe to broadcast.
    full = grid.join(pc.drop("pn"), [*keys, "bin"], "left").join(F.broadcast(q), "bin", "left")
    p = F.greatest(F.coalesce(F.col("p"), F.lit(0.0)), F.lit(EPS))
    qq = F.greatest(F.coalesce(F.col("q"), F.lit(0.0)), F.lit(EPS))
    return full.groupBy(*keys).agg(F.sum((p - qq) * F.log(p / qq)).alias("psi"))


def daily_psi(df: DataFrame, ts: str, col: str, baseline_end: str, bins: int = 10) -> DataFrame:
    """M20 per day against the days before ``baseline_end``, on equal-width
    edges of those days: (day, psi).

    The table is read twice, for the edges (one row) and for the counts per
    day and bin; the baseline's shares are sums of the same counts, written
    once.
    """
    from quarry.session import scratch_path
    from quarry.sources.sinks import materialize

    spark = df.sparkSession
    x = df.select(F.to_date(ts).alias("day"), F.col(col).alias("v")).filter(F.col("v").isNotNull())
    before = F.col("day") < F.lit(baseline_end).cast("date")
    edges = x.filter(before).agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi"))).scalar()
    counts = x.groupBy("day", bin_expr("v", edges["lo"], edges["hi"], bins).alias("bin")).agg(F.count(F.lit(1)).alias("k"))
    counts = materialize(counts, scratch_path(spark, "psi-counts"))  # days x bins rows
    base = counts.filter(before).groupBy("bin").agg(F.sum("k").alias("k"))
    q = base.select("bin", (F.col("k") / F.sum("k").over(Window.partitionBy())).alias("q"))
    p = counts.withColumn("p", F.col("k") / F.sum("k").over(Window.partitionBy("day"))).drop("k")
    grid = counts.select("day").distinct().select("day", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(p, ["day", "bin"], "left").join(F.broadcast(q), "bin", "left")
    p_, q_ = (F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(EPS)) for c in ("p", "q"))
    return full.groupBy("day").agg(F.sum((p_ - q_) * F.log(p_ / q_)).alias("psi"))


def monitor_performance(df: DataFrame, ts: str, y: str, yhat: str, by=None) -> DataFrame:
    """Regression error per 1-day tumbling window (and group).

    The day window of a zone-less timestamp is its date, so the window is
    ``to_date(ts)``: independent of the session time zone.
    """
    keys = _cols(by) if by else []
    err = F.col(y) - F.col(yhat)
    den = F.abs(F.col(y)) + F.abs(F.col(yhat))
    return (
        df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
        .groupBy(F.to_date(F.col(ts)).alias("day"), *keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.avg(F.when(den == 0, F.lit(0.0)).otherwise(F.abs(err) / den)).alias("smape"),
        )
    )
