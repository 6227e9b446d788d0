from __future__ import annotations

from datetime import date, datetime, timedelta

AS_OF = date(2024, 1, 31)
SNAPSHOT = "station_id BIGINT, product_id BIGINT, price DOUBLE, source STRING, show_in_report STRING, date_upd DATE"
TABLE = (
    "station_id BIGINT, product_id BIGINT, price DOUBLE, source STRING, show_in_report STRING, "
    "updated_at TIMESTAMP, updated_by_id BIGINT"
)


def ago(days: int) -> date:
    return AS_OF - timedelta(days=days)


def at(days: int, hour: int = 10) -> datetime:
    return datetime(2024, 1, 31, hour) - timedelta(days=days)


def snapshot(spark, rows):
    """Rows (station, product, price, source, flag, age in days)."""
    return spark.createDataFrame([(s, p, c, src, f, ago(a)) for s, p, c, src, f, a in rows], SNAPSHOT)


def table(spark, rows):
    """Rows (station, product, price, source, flag, age in days)."""
    return spark.createDataFrame([(s, p, c, src, f, at(a), 0) for s, p, c, src, f, a in rows], TABLE)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
