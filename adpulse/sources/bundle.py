"""A bundle of lazy DataFrames: raw tables, the audit's clean tables, params.

Nothing here holds data on the driver. ``as_of`` is a date filter per table
that Catalyst pushes into the scan (A5).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.params import DEFAULTS, AnalysisParams

TABLES = ("campaigns", "customers", "transactions", "ab_test")

# The date column of each engine table.
DATE_COLUMN = {
    "campaigns": "date",
    "customers": "acquisition_date",
    "transactions": "transaction_date",
    "ab_test": "date",
}


@dataclass
class Bundle:
    raw: dict[str, DataFrame]
    params: AnalysisParams = DEFAULTS
    cursor: date | None = None
    _audit: object | None = field(default=None, repr=False)

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.raw.values())).sparkSession

    @property
    def audit(self):
        """The audit result (report + clean tables), built once per bundle."""
        if self._audit is None:
            from adpulse.operators.quality import audit
            self._audit = audit(self.raw, self.params)
        return self._audit

    def _clean(self, name: str) -> DataFrame | None:
        df = self.audit.clean.get(name)
        if df is None or self.cursor is None:
            return df
        return df.filter(F.col(DATE_COLUMN[name]) <= F.lit(self.cursor))

    @property
    def campaigns(self) -> DataFrame | None:
        return self._clean("campaigns")

    @property
    def customers(self) -> DataFrame | None:
        return self._clean("customers")

    @property
    def transactions(self) -> DataFrame | None:
        return self._clean("transactions")

    @property
    def ab_test(self) -> DataFrame | None:
        return self._clean("ab_test")

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in TABLES if self.raw.get(n) is not None}

    def as_of(self, cursor) -> "Bundle":
        """A5: everything visible on or before ``cursor``; the audit still
        describes the source data, not the slice."""
        if isinstance(cursor, str):
            cursor = date.fromisoformat(cursor)
        return Bundle(raw=self.raw, params=self.params, cursor=cursor, _audit=self.audit)

    def with_params(self, params: AnalysisParams) -> "Bundle":
        return Bundle(raw=self.raw, params=params, cursor=self.cursor)


def load_bundle(spark: SparkSession, sf_dir: str, params: AnalysisParams = DEFAULTS,
                tables=TABLES) -> Bundle:
    """Bundle over the fixture views derived from the parquet tables."""
    from adpulse.sources.fixtures import BUILDERS
    return Bundle(raw={n: BUILDERS[n](spark, sf_dir) for n in tables}, params=params)
