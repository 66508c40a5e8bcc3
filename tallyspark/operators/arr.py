"""Point-in-time annual recurring revenue and its month-over-month split.

The contract months are generated from the version rows themselves: each version expands into the
month ends at which it is in force. Work and shuffles before the expansion are at version grain, and
no range join is needed. The months without a version in force come from the contract's own row:
versions cover months and are in force in months, both sets are bits of whole numbers that one
aggregation joins by "or", and what is covered and not in force is reported as zero. This holds
however validities overlap, and takes no sort of a contract's versions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import schemas as S
from tallyspark.functions.scalar import guarded_divide, month_end
from tallyspark.operators.fx import rate_on


#: Months in one whole number.
WORD = 62


def _month_number(d: Column, first: date) -> Column:
    """Months since that of ``first``."""
    return (F.year(d) - first.year) * 12 + F.month(d) - first.month


def _bits(low: Column, high: Column, word: int) -> Column:
    """The bits of months ``low`` to ``high`` that lie in the given word, as a whole number."""
    at = F.greatest(low - word * WORD, F.lit(0))
    upto = F.least(high - word * WORD, F.lit(WORD - 1))
    ones = F.call_function("shiftleft", F.lit(1).cast("long"), upto - at + 1) - 1
    return F.when(at <= upto, F.call_function("shiftleft", ones, at)).otherwise(
        F.lit(0).cast("long"))


def contract_spans(versions: DataFrame, accounts: DataFrame, month_spine: DataFrame,
                   open_churn: str = "drop") -> DataFrame:
    """First and last reported month per contract, with the attributes of its account.

    A contract is reported from its first start to the month of its churn, or to the end of the
    spine. ``open_churn="drop"`` reports nothing for a contract whose churn has no closed month
    end yet; ``"keep"`` reports it up to the last closed month. ``month_spine`` holds consecutive
    month ends, as ``month_end_spine`` builds them; its two ends are fetched. ``zero_months`` are
    the months in which no version is in force, as bits from the first month of the spine on.
    """
    first, last = month_spine.agg(F.min("month_end_date"), F.max("month_end_date")).first()
    first, last = first or date(1970, 1, 31), last or date(1969, 12, 31)
    first_spine, last_spine = F.lit(first), F.lit(last)
    months = (last.year - first.year) * 12 + last.month - first.month + 1
    start, end = F.col("effective_start_date"), F.col("effective_end_date_exclusive")
    in_force = F.coalesce(~F.col("is_churn_version"), F.lit(False))
    starts, ends = _month_number(start, first), _month_number(end, first)
    # The last version also covers the months after its end, up to the last reported month.
    opens = F.when(start.isNotNull(), F.when(
        F.col("is_last_version"), F.least(starts, ends)).otherwise(starts))
    closes = F.when(F.col("is_last_version"), F.lit(months)).otherwise(ends - 1)
    words = range(-(-months // WORD))
    covered = [F.bit_or(_bits(opens, closes, k)).alias(f"_covered_{k}") for k in words]
    active = [F.bit_or(F.when(in_force, _bits(starts, ends - 1, k))).alias(f"_active_{k}")
              for k in words]
    bounds = versions.groupBy("contract_id", "account_id").agg(
        F.min(start).alias("_first_start"),
        F.max(F.when(F.col("is_churn_version"), start)).alias("_churn_date"), *covered, *active)
    churn_month = F.greatest(month_end("_churn_date"), first_spine)
    closed_churn = F.when(churn_month <= last_spine, churn_month)
    if open_churn == "keep":
        closed_churn = F.coalesce(closed_churn, last_spine)
    elif open_churn != "drop":
        raise ValueError(f"open_churn must be 'drop' or 'keep', not {open_churn!r}")
    places = accounts.select("account_id", "region", "legal_entity", "segment")
    # One row per contract and account naming it, so these partitions hold a row or two.
    same_contract = Window.partitionBy("contract_id")

    def joined(name: str) -> Column:
        return F.coalesce(F.bit_or(name).over(same_contract), F.lit(0).cast("long"))

    zero = [joined(f"_covered_{k}").bitwiseAND(F.bitwise_not(joined(f"_active_{k}")))
            for k in words]
    return (
        bounds.join(places, "account_id", "left")
        .select(
            "contract_id", "account_id", "region", "legal_entity", "segment",
            F.greatest(month_end("_first_start"), first_spine).alias("first_month"),
            F.when(F.col("_churn_date").isNotNull(), closed_churn).otherwise(last_spine)
            .alias("last_month"),
            (F.array(*zero) if zero else F.array().cast("array<bigint>")).alias("zero_months"),
            F.lit(first).alias("spine_start"))
        .where("first_month <= last_month")
        .withColumn("opens_contract", F.row_number().over(
            same_contract.orderBy("first_month", "account_id")) == 1)
    )


_PLACE = ("contract_id", "account_id", "region", "legal_entity", "segment")
_ATTRIBUTES = ("version_number", "arr_amount", "currency", "seats", "plan_tier", "amendment_type",
               "is_backdated", "co_termination_group")


def _months(low: Column, high: Column) -> Column:
    """The first days of the months from that of ``low`` to that of ``high``."""
    return F.when(low <= high, F.sequence(
        F.trunc(low, "MM"), F.trunc(high, "MM"), F.make_ym_interval(F.lit(0), F.lit(1))))


def _pieces(versions: DataFrame, spans: DataFrame) -> DataFrame:
    """The months in which a version is in force, for each that has any, and those of each
    contract in which none is."""
    start, end = F.col("effective_start_date"), F.col("effective_end_date_exclusive")
    # The last month end before an exclusive end is that of the month before it.
    in_force = _months(F.when(start.isNotNull(), F.greatest(month_end(start), F.col("first_month"))),
                       F.least(F.date_sub(F.trunc(end, "MM"), 1), F.col("last_month")))
    reported = (
        versions.where("NOT is_churn_version").drop("account_id", "region", "legal_entity")
        .join(spans, "contract_id")
        .select(*_PLACE, *_ATTRIBUTES, in_force.alias("_months")))

    def is_zero(month: Column) -> Column:
        number = F.months_between(month, F.trunc("spine_start", "MM")).cast("int")
        word = F.get("zero_months", (number / WORD).cast("int"))
        return F.call_function("shiftright", word, number % WORD).bitwiseAND(
            F.lit(1).cast("long")) == 1

    zero = (
        spans.where(F.exists("zero_months", lambda w: w != 0))
        .select(*_PLACE, F.filter(_months(F.col("first_month"), F.col("last_month")), is_zero)
                .alias("_months")))
    return reported.unionByName(zero, allowMissingColumns=True).where(F.size("_months") > 0)


def _expand(versions: DataFrame, spans: DataFrame, partitions: int | None = None) -> DataFrame:
    """(contract, month) rows: one for each version in force, and one where none is."""
    pieces = _pieces(versions, spans)
    if partitions:
        pieces = pieces.repartition(partitions, "contract_id")
    return pieces.select(*_PLACE, *_ATTRIBUTES, F.explode("_months").alias("_month")).select(
        month_end("_month").alias("month_end_date"), *_PLACE, *_ATTRIBUTES)


def newest_month(versions: DataFrame, spans: DataFrame) -> date | None:
    """The last month end with a contract month: one value, fetched."""
    return _pieces(versions, spans).agg(
        month_end(F.max(F.array_max("_months")))).first()[0]


def in_month(spans: DataFrame, month: date | None) -> DataFrame:
    """Spans cut to one month end, for those who want the contract months of no other."""
    only = F.lit(month).cast("date")
    return spans.where(only.between(F.col("first_month"), F.col("last_month"))).withColumns(
        {"first_month": only, "last_month": only})


def contract_arr_monthly(versions: DataFrame, accounts: DataFrame, month_spine: DataFrame,
                         fx: DataFrame, open_churn: str = "drop",
                         spans: DataFrame | None = None,
                         partitions: int | None = None) -> DataFrame:
    """One row per contract and month end, in local currency and USD; the churn month is zero.

    ``spans`` takes ``contract_spans`` of the same inputs from a table, where it was written. With
    ``partitions`` the versions are dealt by contract into that many before they expand into
    months, so that a window over a contract needs no shuffle of the months.
    """
    if spans is None:
        spans = contract_spans(versions, accounts, month_spine, open_churn)
    rows = _expand(versions, spans, partitions)
    local = F.coalesce("arr_amount", F.lit(0).cast(S.MONEY))
    with_rate = rate_on(rows, fx, "month_end_date",
                        F.coalesce("currency", F.lit(S.BASE_CURRENCY)), "fx_rate_at_month_end")
    return with_rate.select(
        "month_end_date", "contract_id", "account_id", "region", "legal_entity", "segment",
        "version_number", local.alias("arr_local"), "currency", "seats", "plan_tier",
        "amendment_type", "is_backdated", "co_termination_group", "fx_rate_at_month_end",
        F.round(guarded_divide(local, "fx_rate_at_month_end"), 2).cast(S.MONEY).alias("arr_usd"))


def account_arr_monthly(contract_arr: DataFrame) -> DataFrame:
    """Account totals per month, the previous total, and whether the account ever had any.

    The windows run over one row per account and month, so no partition exceeds the spine.
    """
    totals = contract_arr.groupBy("month_end_date", "account_id", "region", "legal_entity").agg(
        F.sum("arr_usd").alias("account_arr_usd"))
    history = Window.partitionBy("account_id").orderBy("month_end_date")
    earlier = history.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return totals.select(
        "*",
        F.coalesce(F.lag("account_arr_usd").over(history), zero).alias("prior_account_arr_usd"),
        (F.coalesce(F.max("account_arr_usd").over(earlier), zero) > 0)
        .alias("account_ever_had_arr_before"))


#: Versions that a task expands into months.
VERSIONS_A_TASK = 50_000
PRIOR = ("contract_month_seq", "_prior_month", "_prior_usd")


def with_prior_month(contract_arr: DataFrame) -> DataFrame:
    """Each contract month's place in its contract's life, and the month before it."""
    life = Window.partitionBy("contract_id").orderBy("month_end_date", "account_id")
    return contract_arr.select(
        "*", F.row_number().over(life).alias("contract_month_seq"),
        F.lag("month_end_date").over(life).alias("_prior_month"),
        F.lag("arr_usd").over(life).alias("_prior_usd"))


def split_change(contract_arr: DataFrame, fx: DataFrame) -> DataFrame:
    """Splits each month's change of a contract into a real and an FX part.

    The real part values the current local amount at the previous month's rate of its current
    currency and compares it with what was reported; the rest is rate movement. The first month
    of a contract is real throughout. Where the months come with ``with_prior_month`` already,
    nothing is shuffled.
    """
    known = set(PRIOR) <= set(contract_arr.columns)
    seen = (contract_arr if known else with_prior_month(contract_arr)).select(
        "month_end_date", "contract_id", "account_id", "region", "legal_entity", "segment",
        "currency", "arr_local", "arr_usd", *PRIOR)
    revalued = rate_on(seen, fx, "_prior_month",
                       F.coalesce("currency", F.lit(S.BASE_CURRENCY)), "_prior_rate")
    # The quotient feeds both parts; as a column of its own it is computed once.
    revalued = revalued.withColumn("_at_prior_rate", guarded_divide("arr_local", "_prior_rate"))
    prior_usd = F.coalesce("_prior_usd", F.lit(0).cast(S.MONEY))
    first = F.col("_prior_month").isNull()
    return revalued.select(
        "month_end_date", "contract_id", "account_id", "region", "legal_entity", "segment",
        "currency", "arr_local", "arr_usd", "contract_month_seq",
        prior_usd.alias("prior_arr_usd_filled"),
        F.when(first, F.col("arr_usd"))
        .otherwise(F.round(F.col("_at_prior_rate") - prior_usd, 2))
        .cast(S.MONEY).alias("real_component_usd"),
        F.when(first, F.lit(0))
        .otherwise(F.round(F.col("arr_usd") - F.col("_at_prior_rate"), 2))
        .cast(S.MONEY).alias("fx_component_usd"))


HISTORY = ("prior_account_arr_usd", "account_ever_had_arr_before")


def arr_bridge_monthly(contract_arr: DataFrame, account_arr: DataFrame,
                       fx: DataFrame) -> DataFrame:
    """The split change of every contract month with the history of its account that month."""
    split = split_change(contract_arr, fx)
    history = account_arr.select("account_id", "month_end_date", *HISTORY)
    return split.join(history, ["account_id", "month_end_date"], "left").select(
        *split.columns, *HISTORY)


def openings(account_arr: DataFrame, spans: DataFrame) -> DataFrame:
    """The account history of the first month of each contract."""
    return (
        spans.where("opens_contract")
        .select("contract_id", "account_id", F.col("first_month").alias("month_end_date"))
        .join(account_arr.select("account_id", "month_end_date", *HISTORY),
              ["account_id", "month_end_date"])
        .select("contract_id", *HISTORY))


def opening_bridge(contract_arr: DataFrame, opening: DataFrame, fx: DataFrame) -> DataFrame:
    """The split change, with the account history (``openings``, from a table) in the first month
    of each contract, and NULL in later ones.

    Movement types look at the account only in that month, so the other months stay where they
    are. A contract whose account has several histories has all its months once for each.
    """
    split = split_change(contract_arr, fx)
    is_first = F.col("contract_month_seq") == 1
    first = split.where(is_first).join(opening, "contract_id", "left")
    later = split.where(~is_first)
    more = opening.groupBy("contract_id").agg((F.count("*") - 1).alias("_more")).where("_more > 0")
    if not more.isEmpty():
        again = later.join(more, "contract_id").select(
            *split.columns, F.explode(F.sequence(F.lit(1).cast("long"), "_more")).alias("_time"))
        later = later.unionByName(again.drop("_time"))
    return first.unionByName(later, allowMissingColumns=True)


def account_arr_in_month(contract_arr: DataFrame, spans: DataFrame) -> DataFrame:
    """The account totals of the account waterfall, from the contract months of one month.

    As there, a contract whose account comes with several regions or entities counts once for
    each; ``spans`` tell.
    """
    places = spans.where("account_id IS NOT NULL").groupBy("account_id").agg(
        F.count_distinct(F.struct("region", "legal_entity")).alias("_times")).where("_times > 1")
    times, amount = F.lit(1).cast("long"), F.col("arr_usd")
    if not places.isEmpty():
        of_contract = spans.where("opens_contract").select("contract_id", "account_id").join(
            places, "account_id").select("contract_id", "_times")
        contract_arr = contract_arr.join(of_contract, "contract_id", "left").withColumn(
            "_time", F.explode(F.sequence(times, F.coalesce("_times", times))))
    return contract_arr.groupBy(
        "month_end_date", "account_id", "region", "legal_entity", "segment").agg(
            F.sum(amount).alias("account_arr_usd"))
