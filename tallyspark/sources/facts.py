"""Fact tables of the reconciliation, laid out by month, with owned ledger lines.

A journal line names an invoice, the reconciliation needs its account. The account is found once,
when the line lands, by a join of the batch; later runs read it from the line. Every table has a
folder for each batch, and in it one for each month of the fact's date, so a run that needs some
months reads their folders only, and a batch that lands again after a failure replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark import schemas as S
from tallyspark.functions.scalar import month_start
from tallyspark.session import shuffles_dropped, stage_table, staging_area
from tallyspark.sources.files import subfolders
from tallyspark.sources.tables import BATCH, empty_like, read_table

MONTH = "_month"
#: The date that decides the month of each fact.
FACT_DATE = {"invoices": "invoice_date", "credit_memos": "issue_date", "payments": "payment_date",
             "gl_journal_entries": "posting_date"}
LEDGER = "gl_journal_entries"
_UNOWNED = "unowned_lines"


def own_lines(lines: DataFrame, invoices: DataFrame) -> DataFrame:
    """Journal lines with the ``account_id`` of their invoice; NULL where it is not known."""
    owners = invoices.select("invoice_id", "account_id")
    return lines.join(owners, "invoice_id", "left").select(*lines.columns, "account_id")


def by_month(df: DataFrame, table: str) -> DataFrame:
    """The fact with its month, which the table is partitioned by."""
    return df.withColumn(MONTH, month_start(FACT_DATE[table]))


#: Rows of a slice, as long as MOST_SLICES are enough: each slice reads its table once more.
SLICE_ROWS = 2_000_000
MOST_SLICES = 4


def slices(df: DataFrame, key: str) -> list[Callable[[DataFrame], DataFrame]]:
    """Filters that cut ``df``, and tables that are joined with it by ``key``, into slices with
    all rows of a key each. A row is in exactly one of them."""
    n = min(MOST_SLICES, max(1, -(-df.count() // SLICE_ROWS)))
    if n == 1:
        return [lambda table: table]
    place = F.pmod(F.xxhash64(key), F.lit(n))
    return [lambda table, i=i: table.where(place == i) for i in range(n)]


class FactTables:
    """The four fact tables under one folder, landed batch by batch.

    Batch names sort in the order of landing. Lines whose invoice has not landed are kept aside and
    tried again with the invoices of each later batch; until then they are read with a NULL account.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self.spark = spark
        self.root = root
        self.schemas = {name: schemas[name] for name in FACT_DATE}

    def _schema(self, table: str) -> T.StructType:
        owned = table in (LEDGER, _UNOWNED)
        fields = list(self.schemas[LEDGER if owned else table].fields)
        if owned:
            fields.append(T.StructField("account_id", T.StringType()))
        return T.StructType([*fields, T.StructField(BATCH, T.StringType()),
                             T.StructField(MONTH, T.DateType())])

    def _read(self, table: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/{table}", self._schema(table))

    def _write(self, df: DataFrame, table: str, batch: str) -> None:
        """Load times are sorted within a file, so that a lookback skips most of its row groups."""
        rows = by_month(df, table if table in FACT_DATE else LEDGER).withColumn(BATCH, F.lit(batch))
        with shuffles_dropped(self.spark):
            (rows.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, S.LOADED_AT)
             .write.mode("overwrite").option("partitionOverwriteMode", "static")
             .option("compression", "zstd")
             .partitionBy(MONTH).parquet(f"{self.root}/{table}/{BATCH}={batch}"))

    def _unowned(self, before: str | None = None) -> DataFrame:
        """Unowned lines as the newest batch, or the newest one before a batch, left them. A batch
        that left none has a folder as well, without rows."""
        names = [n.partition("=")[2] for n in subfolders(self.spark, f"{self.root}/{_UNOWNED}")]
        newest = max((n for n in names if before is None or n < before), default=None)
        return self._read(_UNOWNED).where(F.col(BATCH).eqNullSafe(F.lit(newest)))

    def land(self, batch: str, facts: Mapping[str, DataFrame]) -> None:
        """Land one batch of any of the tables. The same batch landed again replaces itself."""
        for table in ("invoices", "credit_memos", "payments"):
            if table in facts:
                self._write(facts[table].select(*self.schemas[table].fieldNames()), table, batch)
        columns = self.schemas[LEDGER].fieldNames()
        new = facts[LEDGER].select(*columns) if LEDGER in facts else empty_like(
            self.spark, self.schemas[LEDGER])
        before = self._read("invoices").where(F.col(BATCH) < batch).select(
            "invoice_id", "account_id")
        fresh = self._read("invoices").where(F.col(BATCH) == batch).select(
            "invoice_id", "account_id")
        # The batch's ids cut the older invoices before they meet its lines.
        named = new.select("invoice_id").distinct()
        known = before.join(named, "invoice_id", "left_semi").unionByName(fresh)
        waiting = self._unowned(before=batch).select(*columns)
        lines = own_lines(new, known).unionByName(own_lines(waiting, fresh))
        with staging_area(self.spark):
            lines = stage_table(lines, "owned_lines")
            self._write(lines.where("account_id IS NOT NULL"), LEDGER, batch)
            self._write(lines.where("account_id IS NULL"), _UNOWNED, batch)

    def read(self, table: str) -> DataFrame:
        """A table's rows with their month; the ledger with its owners."""
        rows = self._read(table)
        if table == LEDGER:
            rows = rows.unionByName(self._unowned())
        return rows.drop(BATCH)
