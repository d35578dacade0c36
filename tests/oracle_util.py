"""Compare a Spark DataFrame with a DuckDB SQL result as row multisets."""

import math

import duckdb

from quarry.sources.tables import TABLES


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(tuple(v.asDict().values()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v if v is None or isinstance(v, (int, bool)) else str(v)


# Spark type -> DuckDB type name, for the schema part of the comparison
TYPE_NAMES = {
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR",
    "DateType()": "DATE",
    "BooleanType()": "BOOLEAN",
    "FloatType()": "FLOAT",
}


def rows_equal(sdf, con, sql):
    scols = sdf.columns
    stypes = {f.name: TYPE_NAMES.get(repr(f.dataType), repr(f.dataType)) for f in sdf.schema.fields}
    srows = sdf.collect()
    rel = con.sql(sql)
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols), (scols, dcols)
    assert stypes == dtypes, {c: (stypes[c], dtypes.get(c)) for c in stypes if stypes[c] != dtypes.get(c)}
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
    assert len(a) == len(b), (len(a), len(b))
    assert a == b
