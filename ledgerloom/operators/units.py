"""Business units side by side: one row per unit and a total row.

Every summary takes the comparative income accounts (one row per account).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.months import year_column
from ledgerloom.functions.totals import with_totals
from ledgerloom.model import Model


def _by_unit(m: Model, accounts: DataFrame, years: list[int]) -> DataFrame:
    """Year totals of each unit; a unit without such accounts shows 0."""
    columns = [year_column(y) for y in years]
    sums = accounts.groupBy("zid").agg(*[F.sum(c).alias(c) for c in columns])
    units = m.tenant.join(sums, "zid", "left").select(
        "zid", "name", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])
    return with_totals(units, ["zid", "name"], [], columns, "name", "Total")


def _cost_accounts(m: Model) -> DataFrame:
    return m.tenant_config.select("zid", F.col("cogs_account").alias("xacc"))


def _groups(m: Model, *kinds: str) -> DataFrame:
    """Account groups of some kinds, matched at hierarchy level 2."""
    return m.account_group.filter(F.col("kind").isin(*kinds)).select(F.col("xgroup").alias("xhrc2"))


def tenant_income(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    return _by_unit(m, pl.filter(F.col("xacctype") == "Income"), years)


def tenant_cogs(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    """The cost-of-goods account, whose code differs by unit."""
    return _by_unit(m, pl.join(_cost_accounts(m), ["zid", "xacc"], "left_semi"), years)


def tenant_expense(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    """Expenditure without the unit's own cost-of-goods account."""
    spent = pl.filter(F.col("xacctype") == "Expenditure")
    return _by_unit(m, spent.join(_cost_accounts(m), ["zid", "xacc"], "left_anti"), years)


def tenant_profit(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    return _by_unit(m, pl, years)


def tenant_ebitda(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    """Profit before tax, interest and depreciation."""
    below = _groups(m, "tax", "interest", "depreciation")
    return _by_unit(m, pl.join(below, "xhrc2", "left_anti"), years)


def tenant_tax(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    return _by_unit(m, pl.join(_groups(m, "tax"), "xhrc2", "left_semi"), years)


def tenant_interest(m: Model, pl: DataFrame, years: list[int]) -> DataFrame:
    return _by_unit(m, pl.join(_groups(m, "interest"), "xhrc2", "left_semi"), years)
