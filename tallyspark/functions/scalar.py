"""Scalar column expressions. All are built-in Spark expressions, none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import schemas as S

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: ColumnOrName) -> Column:
    """md5 over the key parts; a NULL part still yields a key, distinct from an empty text."""
    # The separator and the stand-in for NULL.
    separator, null_part = "-", "_dbt_utils_surrogate_key_null_"
    texts = [F.coalesce(_col(p).cast("string"), F.lit(null_part)) for p in parts]
    return F.md5(F.concat_ws(separator, *texts))


def guarded_divide(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient, or NULL when the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def div0(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Quotient, 0 when the denominator is 0, NULL when either side is NULL."""
    n, d = _col(numerator), _col(denominator)
    return F.when(n.isNotNull() & (d == 0), F.lit(0)).otherwise(F.try_divide(n, d))


def percent_change(now: ColumnOrName, before: ColumnOrName, digits: int = 1) -> Column:
    """Relative change in percent; 0 against a zero base, NULL against an unknown one."""
    return F.round(div0((_col(now) - _col(before)) * 100, before), digits)


def month_start(d: ColumnOrName) -> Column:
    return F.trunc(_col(d), "MM")


def month_end(d: ColumnOrName) -> Column:
    return F.last_day(_col(d))


def open_ended(*candidates: ColumnOrName) -> Column:
    """First known bound, or the far-future date standing for "still valid"."""
    return F.coalesce(*[_col(c) for c in candidates], F.lit(date.fromisoformat(S.OPEN_END)))


def fill_forward(value: ColumnOrName, partition: Sequence[str], order: str) -> Column:
    """Last known value up to and including this row."""
    w = Window.partitionBy(*partition).orderBy(order)
    return F.last(_col(value), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def fill_backward(value: ColumnOrName, partition: Sequence[str], order: str) -> Column:
    """First known value from this row on."""
    w = Window.partitionBy(*partition).orderBy(order)
    return F.first(_col(value), ignorenulls=True).over(
        w.rowsBetween(Window.currentRow, Window.unboundedFollowing))


def as_of_date(run_date: date | str | None = None) -> Column:
    """The pinned run date, or today."""
    return F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")


def as_of_timestamp(run_date: datetime | date | str | None = None) -> Column:
    """The pinned run moment, or now, as a timestamp without zone."""
    now = F.current_timestamp() if run_date is None else F.lit(str(run_date))
    return now.cast("timestamp_ntz")


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(F.lit(days))


def padded_id(prefix: str, number: ColumnOrName, width: int) -> Column:
    """Identifier such as INV-0000123."""
    return F.format_string(f"{prefix}-%0{width}d", _col(number))


def query_tag(project: str, target: str, invocation_id: str, schema: str | None = None,
              model: str | None = None, app: str = "dbt") -> Column:
    """The JSON text a pipeline step puts on its queries; absent parts are left out."""
    parts = {"app": app, "project": project, "target": target, "invocation_id": invocation_id,
             "schema": schema, "model": model}
    return F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in parts.items() if v is not None]))


def latest(df: DataFrame, column: str, value=None) -> DataFrame:
    """Rows carrying the greatest value of ``column``.

    Where it is known, ``value`` makes this a plain comparison that chooses partitions; otherwise
    ``df`` is evaluated a second time to find it.
    """
    if value is not None:
        return df.where(F.col(column) == F.lit(value))
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())
