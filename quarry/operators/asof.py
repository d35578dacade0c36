"""Point-in-time (as-of) join, J6 / J7 / F6.

For every spine row: the latest feature row of the same key with
``feature_ts <= spine_ts`` (a feature at the same instant counts).  A null key
or a null time matches nothing, on either side and in every mode.

Plan: union spine and feature rows, order by (ts, side, feature) within the
key and take ``last(feature_struct, ignorenulls)`` over the running frame.
One shuffle on the key, no range explosion, no pairs.  Features travel as
one struct, so the latest row wins as a whole (a NULL field in it stays
NULL instead of borrowing an older value).  Two features of one key at one
instant are ordered by their own values, so the pick is deterministic.

Skew, a segmented scan: the time line of a key is cut into segments, the
window runs within (key, segment), and the last feature before a segment is
carried into it by a prefix scan over one row per (key, segment).  Segments
are

* ``segment_rows``: cut where the data are dense.  A first pass counts the rows
  of each key; keys of more rows than that are cut at quantiles of their own
  times, so a key holding all rows is spread over as many tasks as it needs,
  however its rows lie in time.  Without such a key the plan is the plain one.
* ``time_bucket``: calendar units (e.g. ``"month"``), without the first pass.

All modes give the same result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.session import scratch_path
from quarry.sources.sinks import materialize

MOST_SEGMENTS = 1000  # of one key
NULL_SEGMENTS = 64  # rows that match nothing are spread over so many


def _keys(k):
    return [k] if isinstance(k, str) else list(k)


def _all_set(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def time_cuts(rows: DataFrame, keys: list[str], ts: str, segment_rows: int) -> DataFrame | None:
    """``(keys, __cuts)``: ascending times at which the keys of more than ``segment_rows`` rows are cut; None without such keys.

    Two aggregates that are complete before the shuffle but for one row per
    key and task; the result holds at most one row per ``segment_rows`` rows.
    It is written, so that every use of it sees the same cuts.
    """
    spark = rows.sparkSession
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > segment_rows)
    counts = materialize(counts, scratch_path(spark, "asof-hot-keys"))
    most = counts.agg(F.max("__n")).first()[0]
    if most is None:
        return None
    parts = min(MOST_SEGMENTS, -(-most // segment_rows))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    hot = rows.join(counts, keys)
    at = F.percentile_approx(F.col(ts).cast("timestamp").cast("double"), shares, max(10_000, 10 * parts))
    cuts = hot.groupBy(*keys).agg(F.array_distinct(at).alias("__cuts"))
    return materialize(cuts, scratch_path(spark, "asof-cuts"))


def cuts_before(cuts: str, at: str) -> Column:
    """How many of at most MOST_SEGMENTS ascending cuts are smaller than ``at``: a bisection, so its steps grow with the logarithm of the cuts."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_SEGMENTS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda n, step: n + F.when(F.get(F.col(cuts), n + step - 1) < F.col(at), step).otherwise(0))


def asof_join(
    spine: DataFrame,
    features: DataFrame,
    keys,
    spine_ts: str,
    feature_ts: str | None,
    cols: list[str] | None = None,
    tolerance: str | None = None,
    time_bucket: str | None = None,
    prefix: str = "",
    keep_feature_ts: str | None = None,
    segment_rows: int | None = None,
) -> DataFrame:
    """Left as-of join of ``features`` onto ``spine``.

    * ``feature_ts=None`` (J7): static features, plain left equi-join.
    * ``tolerance``: an interval such as ``"7 days"``; older matches -> NULL.
    * ``keep_feature_ts``: name under which to emit the matched feature
      timestamp (not emitted by default).
    * ``segment_rows`` / ``time_bucket``: how the time line of a key is cut.
    Duplicate spine rows are kept; the output has exactly the spine's rows.
    """
    keys = _keys(keys)
    if feature_ts is None:
        fcols = cols or [c for c in features.columns if c not in keys]
        _no_clash(spine, prefix, fcols)
        f = features.select(*keys, *[F.col(c).alias(prefix + c) for c in fcols])
        return spine.join(f, on=keys, how="left")
    view = {"df": features, "timestamp_col": feature_ts, "cols": cols, "prefix": prefix, "tolerance": tolerance, "keep_feature_ts": keep_feature_ts}
    return asof_join_many(spine, [view], keys, spine_ts, time_bucket, segment_rows)


def _no_clash(spine: DataFrame, prefix: str, fcols: list[str]) -> None:
    clash = [prefix + c for c in fcols if prefix + c in spine.columns]
    if clash:
        raise ValueError(f"asof_join: feature columns clash with spine: {clash}; pass prefix=")


def asof_join_many(spine: DataFrame, views: list[dict], keys, spine_ts: str, time_bucket: str | None = None, segment_rows: int | None = None) -> DataFrame:
    """J6 for several timestamped views on the same keys in ONE shuffle.

    Spine rows and every view's rows go into one union; view i carries its
    row as struct column ``__f<i>`` (NULL elsewhere), and one window over the
    key computes ``last(__f<i>, ignorenulls)`` for every i.  Same semantics
    as folding ``asof_join`` over the views, one exchange instead of one per
    view.  Each view is ``{"df", "timestamp_col", "cols"?, "prefix"?,
    "tolerance"?, "keep_feature_ts"?}``.
    """
    keys = _keys(keys)
    specs = []
    for i, v in enumerate(views):
        ts = v["timestamp_col"]
        cols = v.get("cols") or [c for c in v["df"].columns if c not in keys and c != ts]
        _no_clash(spine, v.get("prefix", ""), cols)
        specs.append((i, v["df"].filter(_all_set([*keys, ts])), ts, cols, v))
    numbers = [i for i, *_ in specs]
    u = spine.select(
        *[F.col(k) for k in keys],
        F.col(spine_ts).alias("__ts"),
        F.lit(1).alias("__side"),
        F.struct(*[F.col(c) for c in spine.columns]).alias("__s"),
    )
    for i, df, ts, cols, _ in specs:
        f = df.select(
            *[F.col(k) for k in keys],
            F.col(ts).alias("__ts"),
            F.lit(0).alias("__side"),
            F.struct(F.col(ts).alias("__fts"), *[F.col(c) for c in cols]).alias(f"__f{i}"),
        )
        u = u.unionByName(f, allowMissingColumns=True)

    segment = None
    if segment_rows is not None:
        times = reduce(DataFrame.unionByName, [spine.select(*keys, F.col(spine_ts).alias("__ts")), *[df.select(*keys, F.col(ts).alias("__ts")) for _, df, ts, _, _ in specs]])
        cuts = time_cuts(times.filter(_all_set([*keys, "__ts"])), keys, "__ts", segment_rows)
        if cuts is not None:
            u = u.join(cuts, keys, "left").withColumn("__at", F.col("__ts").cast("timestamp").cast("double"))
            segment = F.when(F.col("__cuts").isNull() | F.col("__at").isNull(), F.lit(0)).otherwise(cuts_before("__cuts", "__at"))
    elif time_bucket is not None:
        segment = F.date_trunc(time_bucket, F.col("__ts"))

    order = ["__ts", "__side", *[f"__f{i}" for i in numbers]]
    last = {i: F.last(f"__f{i}", ignorenulls=True) for i in numbers}
    if segment is None:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        m = u.select("__side", "__s", "__ts", *[last[i].over(w).alias(f"__m{i}") for i in numbers]).filter(F.col("__side") == 1)
    else:
        m = _segmented(u.withColumn("__b", segment), keys, numbers, order)

    # a spine row without key or time matches nothing
    known = _all_set(["__ts", *[f"__s.{k}" for k in keys]])
    out = [F.col(f"__s.{c}").alias(c) for c in spine.columns]
    for i, _, _, cols, v in specs:
        ok = known
        if v.get("tolerance"):
            ok = ok & (F.col(f"__m{i}.__fts") >= F.col("__ts") - F.expr(f"INTERVAL {v['tolerance']}"))
        m = m.withColumn(f"__m{i}", F.when(ok, F.col(f"__m{i}")))
        out += [F.col(f"__m{i}.{c}").alias(v.get("prefix", "") + c) for c in cols]
        if v.get("keep_feature_ts"):
            out.append(F.col(f"__m{i}.__fts").alias(v["keep_feature_ts"]))
    return m.select(*out)


def _segmented(u: DataFrame, keys: list[str], numbers: list[int], order: list[str]) -> DataFrame:
    """Spine rows with the last feature of each view: within their segment, or else carried from the segments before it."""
    # rows that match nothing need no order: they are spread by their time and a hash of the row
    lost = ~_all_set([*keys, "__ts"])
    u = u.withColumn("__spread", F.when(lost, F.pmod(F.xxhash64("__ts", "__s"), F.lit(NULL_SEGMENTS))).otherwise(F.lit(-1)))
    w = Window.partitionBy(*keys, "__b", "__spread").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = u.select(*keys, "__b", "__side", "__s", "__ts", *[F.last(f"__f{i}", ignorenulls=True).over(w).alias(f"__l{i}") for i in numbers])
    local = local.filter(F.col("__side") == 1)
    # the last feature of every (key, segment) ...
    ends = u.filter(F.col("__side") == 0).groupBy(*keys, "__b").agg(*[F.max(F.when(F.col(f"__f{i}").isNotNull(), F.struct("__ts", f"__f{i}"))).alias(f"__e{i}") for i in numbers])
    ends = ends.select(*keys, "__b", F.lit(1).alias("__bs"), *[F.col(f"__e{i}.__f{i}").alias(f"__e{i}") for i in numbers])
    # ... carried to every spine segment from strictly earlier ones; Catalyst prunes the first branch to the
    # spine's keys and times, so the wide spine rows are shuffled once
    need = u.filter((F.col("__side") == 1) & _all_set([*keys, "__b"])).select(*keys, "__b").distinct().withColumn("__bs", F.lit(0))
    scan = Window.partitionBy(*keys).orderBy("__b", "__bs").rowsBetween(Window.unboundedPreceding, 0)
    both = need.unionByName(ends, allowMissingColumns=True)
    carry = both.select(*keys, "__b", "__bs", *[F.last(f"__e{i}", ignorenulls=True).over(scan).alias(f"__c{i}") for i in numbers]).filter(F.col("__bs") == 0).drop("__bs")
    m = local.join(carry, on=[*keys, "__b"], how="left")
    return m.select("__s", "__ts", *[F.coalesce(f"__l{i}", f"__c{i}").alias(f"__m{i}") for i in numbers])


def retrieve(spine: DataFrame, views: list[dict], spine_ts: str) -> DataFrame:
    """point-in-time features from several views.

    Timestamped views sharing the same keys and segments are resolved
    together by ``asof_join_many`` in one shuffle; static views are plain
    left joins.
    """
    out = spine
    groups: dict[tuple, list[dict]] = {}
    for v in views:
        if v.get("timestamp_col"):
            groups.setdefault((tuple(_keys(v["keys"])), v.get("time_bucket"), v.get("segment_rows")), []).append(v)
    for (keys, bucket, rows), vs in groups.items():
        out = asof_join_many(out, vs, list(keys), spine_ts, bucket, rows)
    for v in views:
        if not v.get("timestamp_col"):
            out = asof_join(out, v["df"], v["keys"], spine_ts, None, cols=v.get("cols"), prefix=v.get("prefix", ""))
    return out
