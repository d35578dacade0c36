"""Feature views, spines and datasets.

A feature view is a DataFrame plus its entity keys and timestamp column,
materialised as Parquet under ``root/name/version``, partitioned by a
key hash so an incremental refresh rewrites only the touched partitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.asof import retrieve
from quarry.operators.relational import latest_per_key


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


@dataclass
class FeatureView:
    """a named, versioned feature table."""

    name: str
    df: DataFrame
    keys: list[str]
    timestamp_col: str | None = None
    version: str = "1"
    cols: list[str] | None = None
    prefix: str = ""
    time_bucket: str | None = None
    segment_rows: int | None = None
    path: str | None = field(default=None)

    def feature_cols(self) -> list[str]:
        return self.cols or [c for c in self.df.columns if c not in self.keys and c != self.timestamp_col]

    def as_view(self) -> dict:
        return {
            "df": self.df,
            "keys": self.keys,
            "timestamp_col": self.timestamp_col,
            "cols": self.feature_cols(),
            "prefix": self.prefix,
            "time_bucket": self.time_bucket,
            "segment_rows": self.segment_rows,
        }

    def materialize(self, root: str) -> "FeatureView":
        """Write under ``root/name/version`` (overwrite), as the rows lie: no
        shuffle, so a hot key is written by as many tasks as hold its rows."""
        self.path = f"{root.rstrip('/')}/{self.name}/{self.version}"
        self.df.write.mode("overwrite").parquet(self.path)
        self.df = self.df.sparkSession.read.parquet(self.path)
        return self


def feature_view(df, name, keys, timestamp_col=None, version="1", **kw) -> FeatureView:
    return FeatureView(name=name, df=df, keys=_cols(keys), timestamp_col=timestamp_col, version=version, **kw)


def shift_label(events: DataFrame, keys, date_col: str, days: int, name: str) -> DataFrame:
    """An event on day d becomes the label of day d - days.

    De-duplicated on (key, date) so a doubly-loaded event cannot fan out the
    spine join.
    """
    return (
        events.select(*_cols(keys), F.date_sub(F.col(date_col), days).alias(date_col))
        .distinct()
        .withColumn(name, F.lit(1))
    )


def make_spine(
    df: DataFrame,
    keys,
    ts: str,
    lo=None,
    hi=None,
    labels: DataFrame | None = None,
    label_col: str | None = None,
) -> DataFrame:
    """distinct (key, date) in [lo, hi], optionally with a 0/1 label.

    The date range is applied to the raw timestamp so the filter reaches the
    Parquet scan; the day is taken afterwards.
    """
    x = df
    if lo is not None:
        x = x.filter(F.col(ts) >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        x = x.filter(F.col(ts) < F.date_add(F.lit(hi).cast("date"), 1).cast("timestamp_ntz"))
    spine = x.select(*_cols(keys), F.to_date(ts).alias("date")).distinct()
    if labels is not None:
        spine = spine.join(labels, on=[*_cols(keys), "date"], how="left").fillna(0, subset=[label_col])
    return spine


def generate_dataset(spine: DataFrame, views: list[FeatureView], spine_ts: str) -> DataFrame:
    """point-in-time features for every spine row (labels ride along)."""
    return retrieve(spine, [v.as_view() for v in views], spine_ts)


def latest_features(keys_df: DataFrame, views: list[FeatureView]) -> DataFrame:
    """F8: newest feature values per key, from each view."""
    out = keys_df
    for v in views:
        if v.timestamp_col:
            lat = latest_per_key(v.df.select(*v.keys, v.timestamp_col, *v.feature_cols()), v.keys, v.timestamp_col)
            lat = lat.drop(v.timestamp_col)
        else:
            lat = v.df.select(*v.keys, *v.feature_cols())
        lat = lat.select(*v.keys, *[F.col(c).alias(v.prefix + c) for c in v.feature_cols()])
        out = out.join(lat, on=v.keys, how="left")
    return out


def split_by_date(df: DataFrame, ts: str, ranges: dict[str, tuple]) -> dict[str, DataFrame]:
    """M1: named inclusive date ranges -> DataFrames."""
    return {name: df.filter(F.col(ts).between(lo, hi)) for name, (lo, hi) in ranges.items()}
