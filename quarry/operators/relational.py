"""Relational operators: joins, ranks, aggregates (J1, J12, W1, W2, W4, W7,
A8, A12, A15-A18, O3, P13, P17).

Broadcast policy: a side is wrapped in ``F.broadcast`` only when its size
is bounded by construction (region/nation, a calendar, a lexicon, a literal
parameter table).  Every other join is left to Catalyst + AQE, which
measures the real shuffle size at run time and switches to a broadcast
only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the
join stays a sort-merge join, so the decision is always size-checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _cols(x):
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def unmatched(queries: DataFrame, matches: DataFrame, on) -> DataFrame:
    """Rows of ``queries`` with no row in ``matches`` (left anti)."""
    return queries.join(matches, on=on, how="left_anti")


def first_n(df: DataFrame, key, order, n: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per key.

    ``row_number() <= n`` lets Catalyst insert a WindowGroupLimit before the
    shuffle, so a hot key sends at most ``n`` rows per map partition.  Give a
    unique tie-breaker in ``order`` for deterministic results.
    """
    rc = rank_col or "__rn"
    w = Window.partitionBy(*_cols(key)).orderBy(*_cols(order))
    out = df.withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n)
    return out if rank_col else out.drop(rc)


def latest_per_key(df: DataFrame, key, ts: str, tiebreak=None) -> DataFrame:
    """The newest row per key, as an aggregate (no sort of the group).

    ``max_by(struct(*), (ts, tiebreak))`` is a hash aggregate with a
    map-side partial, so a key holding a third of the rows costs one
    partial per map task instead of a giant sorted window partition.
    Without ``tiebreak``, rows at the same latest ``ts`` are ordered by their
    remaining values.
    """
    keys = _cols(key)
    rest = [c for c in df.columns if c not in keys]
    # rows at the same latest instant: the explicit tie-break, else the
    # row's own values (largest wins) - deterministic either way, the same
    # rule as the as-of join
    ties = _cols(tiebreak) or [c for c in rest if c != ts]
    order = F.struct(F.col(ts), *[F.col(c) for c in ties])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def nth_value_cols(df: DataFrame, key, order, value: str, n: int, prefix: str = "value_") -> DataFrame:
    """``MAX(CASE WHEN rank = i THEN value END)`` for i in 1..n."""
    ranked = first_n(df, key, order, n, rank_col="__rank")
    return ranked.groupBy(*_cols(key)).agg(
        *[F.max(F.when(F.col("__rank") == i, F.col(value))).alias(f"{prefix}{i}") for i in range(1, n + 1)]
    )


def surrogate_key(df: DataFrame, order: list[str], name: str = "row_id", partitions: int | None = None) -> DataFrame:
    """Global ``ROW_NUMBER() OVER (ORDER BY order)`` without a
    one-partition window.

    Range-partition and sort by the (unique) order key, count rows per
    partition (one small row per partition, broadcast), and add the running
    offset of earlier partitions to the in-partition position.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("__mid", F.monotonically_increasing_id())
        .withColumn("__pid", F.shiftright(F.col("__mid"), 33))
        .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    offsets = counts.withColumn(
        "__off",
        F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
    ).select("__pid", F.coalesce("__off", F.lit(0)).alias("__off"))
    # ``offsets`` has one row per partition: bounded by the partition count.
    return (
        ranged.join(F.broadcast(offsets), "__pid")
        .withColumn(name, F.col("__off") + F.col("__pos") + 1)
        .drop("__mid", "__pid", "__pos", "__off")
    )


def topk(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """O3: global ORDER BY + LIMIT (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def holdout_tail(df: DataFrame, key, ts: str, h: int) -> tuple[DataFrame, DataFrame]:
    """Last ``h`` rows per key as validation, the rest as training."""
    w = Window.partitionBy(*_cols(key)).orderBy(F.col(ts).desc())
    r = df.withColumn("__rd", F.row_number().over(w))
    return r.filter(F.col("__rd") > h).drop("__rd"), r.filter(F.col("__rd") <= h).drop("__rd")


def split_history_future(df: DataFrame, y: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a known target vs rows still to be predicted."""
    return df.filter(F.col(y).isNotNull()), df.filter(F.col(y).isNull())


def sample_by_rate(df: DataFrame, key_cols: list[str], rate: Column | str, seed: str = "") -> DataFrame:
    """Keep a row when ``hash(key) mod 100 < rate`` (rate in percent).

    Deterministic (re-running a lost task keeps the same rows) and the
    hash ``conv(substr(md5(k),1,8),16,10)`` is reproducible in SQL.
    """
    from quarry.functions.scalar import hash_int

    parts = [F.lit(seed)] + [F.col(c) for c in key_cols] if seed else [F.col(c) for c in key_cols]
    r = F.col(rate) if isinstance(rate, str) else rate
    return df.filter(F.pmod(hash_int(*parts), F.lit(100)) < r)


def coverage(df: DataFrame, col: str) -> DataFrame:
    """COUNT(*) vs COUNT(col)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.col(col)).alias("n_non_null"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long correlation matrix ``(col_a, col_b, r)`` in one pass."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) as (col_a, col_b, r)")


def box_summary(df: DataFrame, by, col: str, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Five-number summary + mean per category.

    ``exact``: quartiles from ``hist_quantiles`` (exact, skew-safe, sized by
    the distinct values); otherwise ``percentile_approx`` sketches (bounded
    memory per group whatever the cardinality, rank error 1/accuracy).
    The mean is sum / count.
    """
    if not exact:
        keys = _cols(by)
        qs = F.percentile_approx(col, [0.0, 0.25, 0.5, 0.75, 1.0], accuracy)
        out = df.groupBy(*keys).agg(qs.alias("__q"), (F.sum(col) / F.count(col)).alias("mean"), F.count(col).alias("n"))
        return out.select(
            *keys, "n",
            *[F.col("__q")[i].alias(nm) for i, nm in enumerate(["min", "q1", "median", "q3", "max"])],
            "mean",
        )
    q = hist_quantiles(df, col, by, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})
    m = df.groupBy(*_cols(by)).agg((F.sum(col) / F.count(col)).alias("mean"))
    return q.join(m, _cols(by))


def histogram(df: DataFrame, by, col: str, lo, hi, bins: int) -> DataFrame:
    """Equal-width histogram per category.

    ``lo``/``hi`` are numbers or scalar columns (e.g. ``df.agg(min).scalar()``);
    values outside [lo, hi] land in the edge bins 0 and bins-1.
    """
    lo = F.lit(lo) if isinstance(lo, (int, float)) else lo
    hi = F.lit(hi) if isinstance(hi, (int, float)) else hi
    width = hi - lo
    raw = F.floor((F.col(col) - lo) / width * bins)
    b = F.when(width <= 0, F.lit(0)).otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))).cast("int")
    return df.filter(F.col(col).isNotNull()).groupBy(*_cols(by), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def discrete_summary(df: DataFrame, value: str, by=None) -> DataFrame:
    """Exact count, sum, min, max and median of a *discrete* column.

    An exact median in one aggregate buffers every value of a group in one
    task.  When the column takes few distinct values (day gaps, counts,
    ratings) the values are first reduced to a histogram ``(value, n)`` with
    a map-side partial aggregate; the median is then read off the running
    count of the histogram, whose size is the number of distinct values,
    not the number of rows.
    """
    keys = _cols(by)
    hist = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("__cum", F.sum("__n").over(w)).withColumn(
        "__tot", F.sum("__n").over(Window.partitionBy(*keys))
    )
    lo = F.floor((F.col("__tot") + 1) / 2)  # 1-based middle positions
    hi = F.floor(F.col("__tot") / 2) + 1
    covers = lambda pos: (F.col("__cum") - F.col("__n") < pos) & (F.col("__cum") >= pos)
    out = hist.groupBy(*keys).agg(
        F.sum("__n").alias("n"),
        F.sum(F.col(value) * F.col("__n")).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        ((F.max(F.when(covers(lo), F.col(value))) + F.max(F.when(covers(hi), F.col(value)))) / 2.0).alias(
            "median"
        ),
    )
    return out


def hist_quantiles(df: DataFrame, value: str, by, qs: dict[str, float]) -> DataFrame:
    """Exact quantiles (linear interpolation, as ``percentile``) per group,
    computed from a ``(group, value, count)`` histogram.

    A plain exact percentile buffers every value of a group in one task; here
    the rows are first reduced to distinct values with a map-side partial
    aggregate, so a category holding a third of the table costs one row per
    distinct value.  Position of quantile q (0-based) is (n - 1) * q.
    """
    keys = _cols(by)
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("__cum", F.sum("__n").over(w)).withColumn("__tot", F.sum("__n").over(Window.partitionBy(*keys)))
    aggs = [F.sum("__n").alias("n")]
    for name, q in qs.items():
        h = (F.col("__tot") - 1).cast("double") * q
        lo, hi = F.floor(h), F.ceil(h)
        cover = lambda p: (F.col("__cum") - F.col("__n") <= p) & (p < F.col("__cum"))
        aggs += [
            F.max(F.when(cover(lo), F.col(value))).alias(f"__{name}_lo"),
            F.max(F.when(cover(hi), F.col(value))).alias(f"__{name}_hi"),
            F.max(h - lo).alias(f"__{name}_f"),
        ]
    out = hist.groupBy(*keys).agg(*aggs)
    for name in qs:
        lo, hi, fr = F.col(f"__{name}_lo"), F.col(f"__{name}_hi"), F.col(f"__{name}_f")
        out = out.withColumn(name, lo + fr * (hi - lo)).drop(f"__{name}_lo", f"__{name}_hi", f"__{name}_f")
    return out


def exact_quantiles(df: DataFrame, value: str, by, qs: dict[str, float], rows_per_task: int = 4_000_000, bins: int = 1000) -> DataFrame:
    """The quantiles of ``hist_quantiles`` where a group may hold any number of distinct values.

    Groups of at most ``rows_per_task`` rows are read off their histograms.  A
    larger group is never sorted: a mergeable sketch of it gives up to ``bins``
    cuts, counts per bin (complete before the shuffle but for one row per bin
    and task) tell which bin holds each wanted place, and only the rows of
    those bins are read a second time and ordered, a bin per task.  The
    sketch decides how the work is dealt, never the result.  Null values count
    nowhere; a null group is a group.
    """
    from quarry.session import scratch_path
    from quarry.sources.sinks import materialize

    keys, spark = _cols(by), df.sparkSession
    d = df.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("__k"), F.col(value).alias("__v"))
    sizes = materialize(d.groupBy("__k").agg(F.count(F.lit(1)).alias("__tot")), scratch_path(spark, "quantile-sizes"))
    hot = sizes.filter(F.col("__tot") > rows_per_task)
    if hot.isEmpty():
        return hist_quantiles(df, value, by, qs)
    small = hist_quantiles(d.join(hot, "__k", "left_anti"), "__v", "__k", qs)
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = d.join(hot, "__k").groupBy("__k").agg(F.array_distinct(F.percentile_approx("__v", shares, 10 * bins)).alias("__cuts"))
    cuts = materialize(cuts, scratch_path(spark, "quantile-cuts"))
    binned = d.join(cuts, "__k").select("__k", "__v", F.size(F.filter("__cuts", lambda c: c < F.col("__v"))).alias("__b"))
    order = Window.partitionBy("__k").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    counts = binned.groupBy("__k", "__b").agg(F.count(F.lit(1)).alias("__c")).withColumn("__before", F.sum("__c").over(order) - F.col("__c")).join(hot, "__k")
    places = []
    for name, q in qs.items():
        h = (F.col("__tot") - 1).cast("double") * q
        places += [F.struct(F.lit(f"{name}_{side}").alias("name"), place.cast("long").alias("at")) for side, place in (("lo", F.floor(h)), ("hi", F.ceil(h)))]
    wanted = counts.withColumn("__p", F.explode(F.array(*places))).filter((F.col("__before") <= F.col("__p.at")) & (F.col("__p.at") < F.col("__before") + F.col("__c")))
    wanted = materialize(wanted.select("__k", "__b", F.col("__p.name").alias("__name"), (F.col("__p.at") - F.col("__before")).alias("__at")), scratch_path(spark, "quantile-places"))
    read = binned.join(wanted.select("__k", "__b").distinct(), ["__k", "__b"]).groupBy("__k", "__b", "__v").agg(F.count(F.lit(1)).alias("__n"))
    within = Window.partitionBy("__k", "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    found = read.withColumn("__cum", F.sum("__n").over(within)).join(wanted, ["__k", "__b"])
    found = found.filter((F.col("__cum") - F.col("__n") <= F.col("__at")) & (F.col("__at") < F.col("__cum")))
    one = found.groupBy("__k").agg(*[F.max(F.when(F.col("__name") == f"{n}_{side}", F.col("__v"))).alias(f"__{n}_{side}") for n in qs for side in ("lo", "hi")]).join(hot, "__k")
    out = one.select("__k", F.col("__tot").alias("n"), *[_between(f"__{n}", F.col("__tot"), q).alias(n) for n, q in qs.items()])
    return small.unionByName(out).select(*[F.col(f"__k.{k}").alias(k) for k in keys], "n", *qs)


def _between(name: str, total: Column, q: float) -> Column:
    """Linear interpolation between the two places around a quantile."""
    h = (total - 1).cast("double") * q
    lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
    return lo + (h - F.floor(h)) * (hi - lo)
