"""Which periods a run restated, and by how much."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import as_of_timestamp, latest
from tallyspark.operators.reconcile import KEY, MEASURES, Facts, affected_keys

RESTATED = (*MEASURES, "recognized_net_of_credits_usd")


def restatement_log(facts: Facts, run_id: str, run_started_at: datetime | str | None = None,
                    as_of: date | str | None = None, lookback_days: int = S.LOOKBACK_DAYS,
                    keys: DataFrame | None = None) -> DataFrame:
    """Log rows of one run: every key that received data within the lookback.

    ``keys`` takes these keys from a table, where they were written before.
    """
    if keys is None:
        keys = affected_keys(facts, as_of, lookback_days)
    return keys.select(
        as_of_timestamp(run_started_at).alias("run_started_at"),
        F.lit(run_id).alias("run_id"), *KEY)


def restated_periods(log: DataFrame) -> DataFrame:
    """Log rows of the latest run."""
    return latest(log, "run_started_at")


def restatement_diff(before: DataFrame, after: DataFrame, keys: DataFrame | None = None,
                     measures: Sequence[str] = RESTATED) -> DataFrame:
    """Before, after and delta of each measure, for keys whose figures really changed.

    ``keys`` limits the comparison to given periods, such as those of a logged run. A key missing
    on one side counts as zero there.
    """
    def side(df: DataFrame, prefix: str) -> DataFrame:
        if keys is not None:
            df = df.join(keys.select(*KEY).distinct(), list(KEY), "left_semi")
        return df.select(*KEY, *[F.col(m).alias(f"{prefix}_{m}") for m in measures])

    both = side(before, "before").join(side(after, "after"), list(KEY), "full_outer")
    zero = F.lit(0)
    columns = []
    for m in measures:
        old, new = F.coalesce(f"before_{m}", zero), F.coalesce(f"after_{m}", zero)
        columns += [old.alias(f"before_{m}"), new.alias(f"after_{m}"), (new - old).alias(f"delta_{m}")]
    changed = F.lit(False)
    for m in measures:
        changed = changed | (F.col(f"delta_{m}") != 0)
    return both.select(*KEY, *columns).where(changed)
