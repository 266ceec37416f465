"""General ledger: activity, positions, monthly statements, comparative accounts.

Voucher lines meet their header once, on (unit, voucher); everything after that
works on sums by account and period, a few rows per account.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, doc_is, lookup, signed_value
from ledgerloom.functions.months import (
    Month,
    month_columns,
    pivot_months,
    pivot_years,
    year_column,
)
from ledgerloom.functions.totals import with_totals
from ledgerloom.model import Model
from ledgerloom.sources.periods import PeriodLedger

SIDES = {"pl": ("Income", "Expenditure"), "bs": ("Asset", "Liability")}

# Cash flow section of the account groups at level 3.
CASH_SECTIONS = {
    "Operating": ["Operating Cash Flow", "Free Cash Flow"],
    "Operating Investment": ["Operating Cash Flow", "Free Cash Flow"],
    "Investing": ["Investing Cash Flow", "Free Cash Flow"],
    "Financing": ["Financing Cash Flow"],
}


def gl_entries(m: Model, start: date | None = None, end: date | None = None,
               projects: DataFrame | None = None, opening: bool = True) -> DataFrame:
    """Voucher lines, of some (unit, project) pairs, with the date and period of their voucher."""
    headers, lines = m.glheader, m.gldetail
    if start is not None:
        headers = headers.filter(F.col("xdate") >= day(start))
    if end is not None:
        headers = headers.filter(F.col("xdate") <= day(end))
    if not opening:
        headers = headers.filter("xper <> 0")
    if projects is not None:
        lines = lines.join(projects.select("zid", "xproj").distinct(), ["zid", "xproj"], "left_semi")
    return lines.join(headers, ["zid", "xvoucher"])


def unit_projects(m: Model, project: str | None = None) -> DataFrame:
    """(unit, project, cash account): all projects of the units, or one of them."""
    return m.tenant_project if project is None else m.tenant_project.filter(F.col("xproj") == project)


def _by_period(entries: DataFrame, *keys: str) -> DataFrame:
    return entries.groupBy("zid", *keys, "xyear", "xper").agg(F.sum("xprime").alias("amount"))


def cash_vouchers_activity(m: Model, a: date, b: date, project: str | None = None) -> DataFrame:
    """All lines of the vouchers that touch a cash account of the unit's project."""
    projects = unit_projects(m, project)
    # a voucher has one header, so the window on its lines below bounds these too
    touching = (m.gldetail.join(projects, ["zid", "xproj", "xacc"], "left_semi")
                .select("zid", "xvoucher").distinct())
    moved = gl_entries(m, a, b, projects, opening=False).join(touching, ["zid", "xvoucher"], "left_semi")
    accounts = m.glmst.select("zid", "xacc")
    return _by_period(moved, "xacc").join(accounts, ["zid", "xacc"], "left_semi")


def monthly_cash_flow(m: Model, a: date, b: date, months: list[Month], project: str | None = None) -> DataFrame:
    """Cash activity by account and month with a row per cash flow section."""
    names = month_columns(months)
    wide = pivot_months(cash_vouchers_activity(m, a, b, project), ["zid", "xacc"], months)
    named = wide.join(m.glmst.select("zid", "xacc", "xdesc", "xhrc3", "xacctype"), ["zid", "xacc"], "left")
    head = ["xacc", "xdesc", "xhrc3", "xacctype"]
    sections = lookup(F.col("xhrc3"), CASH_SECTIONS)
    none = F.lit(None).cast("string")
    section_rows = F.transform(sections, lambda x: F.struct(
        none.alias("xacc"), none.alias("xdesc"), x.alias("xhrc3"), none.alias("xacctype")))
    own = F.array(F.struct(*head))
    # each account stands for itself and for the sections it belongs to
    rows = F.when(sections.isNull(), own).otherwise(F.concat(own, section_rows))
    return (named.select("zid", F.inline(rows), *names)
            .groupBy("zid", *head).agg(*[F.sum(n).alias(n) for n in names]))


def monthly_pl(m: Model, a: date, b: date, months: list[Month], project: str | None = None) -> DataFrame:
    """Income and expenditure by account and month with a Profit/Loss row per unit."""
    names = month_columns(months)
    accounts = gl_master(m, "pl").select("zid", "xacc", "xdesc", "xacctype")
    wide = pivot_months(_by_period(gl_entries(m, a, b, unit_projects(m, project)), "xacc"), ["zid", "xacc"], months)
    return with_totals(wide.join(accounts, ["zid", "xacc"]), ["zid", "xacc", "xdesc", "xacctype"],
                       ["zid"], names, "xacc", "Profit/Loss")


def _period_totals(rows: DataFrame, keys: list[str], label: str, text: str) -> DataFrame:
    """One row per key and month that has movements, with a total row per unit and month."""
    return with_totals(rows, [*keys, "xyear", "xper"], ["zid", "xyear", "xper"], ["amount"], label, text)


def _partner_months(m: Model, partners: DataFrame, b: date, project: str | None) -> DataFrame:
    """Movements of some partners by month, from the first in the books to ``b``; others are not grouped."""
    entries = gl_entries(m, end=b, projects=unit_projects(m, project)).filter(~doc_is("OB--", "xvoucher"))
    own = entries.join(partners.select("zid", "xsub"), ["zid", "xsub"], "left_semi")
    return _by_period(own, "xsub").join(partners, ["zid", "xsub"])


def monthly_payables(m: Model, b: date, project: str | None = None) -> DataFrame:
    """Payables by supplier and month, with a total row per unit and month.

    ``functions.months.show_months`` lays the months out as columns.
    """
    suppliers = m.casup.select("zid", F.col("xsup").alias("xsub"), "xshort")
    return _period_totals(_partner_months(m, suppliers, b, project), ["zid", "xsub", "xshort"],
                          "xshort", "Monthly Payable")


def monthly_receivables(m: Model, b: date, project: str | None = None) -> DataFrame:
    """Receivables by customer, place and month, with a total row per unit and month."""
    customers = m.cacus.select("zid", F.col("xcus").alias("xsub"), "xshort", "xadd2", "xcity", "xstate")
    return _period_totals(_partner_months(m, customers, b, project),
                          ["zid", "xsub", "xshort", "xadd2", "xcity", "xstate"], "xstate", "Monthly Receivable")


def monthly_inventory_value(m: Model, b: date) -> DataFrame:
    """Stock value moved by item group and month, with a total row per unit and month."""
    moved = (m.imtrn.filter(F.col("xdate") <= day(b)).groupBy("zid", "xitem", "xyear", "xper")
             .agg(F.sum(signed_value()).alias("amount")))
    grouped = moved.join(m.caitem.select("zid", "xitem", "xgitem"), ["zid", "xitem"])
    return _period_totals(grouped, ["zid", "xgitem"], "xgitem", "Monthly Inventory")


def monthly_inventory_value_of(m: Model, kept: PeriodLedger, b: date) -> DataFrame:
    """``monthly_inventory_value`` from sums by period (zid, xitem; ``value``) and the rows of ``b``'s own month."""
    month = b.year * 100 + b.month
    whole = kept.by_period(month - 1).select("zid", "xitem", "period", "value")
    tail = (kept.rows().where((F.col("period") == month) & (F.col("xdate") <= day(b)))
            .groupBy("zid", "xitem", "period").agg(F.sum(signed_value()).cast("decimal(38,2)").alias("value")))
    moved = whole.unionByName(tail).selectExpr(
        "zid", "xitem", "cast(floor(period / 100) AS int) AS xyear", "cast(period % 100 AS int) AS xper", "value AS amount")
    grouped = moved.join(m.caitem.select("zid", "xitem", "xgitem"), ["zid", "xitem"])
    return _period_totals(grouped, ["zid", "xgitem"], "xgitem", "Monthly Inventory")


def gl_position_of(m: Model, kept: PeriodLedger, years: list[int], m1: int, m2: int) -> DataFrame:
    """Cumulative ``gl_position`` from sums by period (zid, xacc; ``amount``)."""
    per = F.col("period") % 100
    sums = (kept.by_period(max(years) * 100 + m2).where((per >= m1) & (per <= m2))
            .select("zid", "xacc", F.floor(F.col("period") / 100).cast("int").alias("year"), "amount"))
    return (_of_side(m, sums, "bs").select("zid", "xacc", F.explode(years_reached(years)).alias("year"), "amount")
            .groupBy("zid", "xacc", "year").agg(F.sum("amount").alias("amount")))


def gl_master(m: Model, side: str = "pl") -> DataFrame:
    """Accounts of one side; an account of no class counts for both."""
    other = SIDES["bs" if side == "pl" else "pl"]
    return m.glmst.filter(F.col("xacctype").isNull() | ~F.col("xacctype").isin(*other)).select(
        "zid", "xacc", "xacctype", "xdesc", "xhrc1", "xhrc2", "xhrc3", "xhrc4")


def account_year_sums(m: Model, last_year: int, m1: int, m2: int, project: str | None = None) -> DataFrame:
    """Sums by account and year up to month m2: ``within`` counts the months
    from m1, ``upto`` also those before it and the opening period."""
    headers = m.glheader.filter((F.col("xper") <= m2) & (F.col("xyear") <= last_year))
    if project is not None:
        m = m.replace(gldetail=m.gldetail.filter(F.col("xproj") == project))
    return (gl_entries(m.replace(glheader=headers))
            .groupBy("zid", "xacc", F.col("xyear").alias("year"))
            .agg(F.sum(F.when(F.col("xper") >= m1, F.col("xprime"))).alias("within"),
                 F.sum("xprime").alias("upto")))


def years_reached(years: list[int]) -> Column:
    """Statement years that a year's movements count for: its own and every later one."""
    return F.filter(F.array(*[F.lit(y) for y in years]), lambda y: y >= F.col("year"))


def _of_side(m: Model, sums: DataFrame, side: str) -> DataFrame:
    accounts = m.glmst.filter(F.col("xacctype").isin(*SIDES[side])).select("zid", "xacc")
    return sums.join(accounts, ["zid", "xacc"], "left_semi")


def gl_activity(m: Model, years: list[int], m1: int, m2: int, project: str | None = None) -> DataFrame:
    """Income and expenditure by account and year within the months m1..m2."""
    sums = _of_side(m, account_year_sums(m, max(years), m1, m2, project), "pl")
    return (sums.filter(F.col("year").isin(*years) & F.col("within").isNotNull())
            .select("zid", "xacc", "year", F.col("within").alias("amount")))


def gl_position(m: Model, years: list[int], m1: int, m2: int, mode: str = "cumulative",
                project: str | None = None) -> DataFrame:
    """Assets and liabilities by account at each year.

    ``year``: movements of that year up to month m2, opening period included.
    ``cumulative``: all years up to it, months m1..m2 of each.
    """
    sums = _of_side(m, account_year_sums(m, max(years), m1, m2, project), "bs")
    if mode == "year":
        return (sums.filter(F.col("year").isin(*years))
                .select("zid", "xacc", "year", F.col("upto").alias("amount")))
    return (sums.filter(F.col("within").isNotNull())
            .select("zid", "xacc", F.explode(years_reached(years)).alias("year"), "within")
            .groupBy("zid", "xacc", "year").agg(F.sum("within").alias("amount")))


def account_amounts(m: Model, years: list[int], m1: int, m2: int, mode: str) -> DataFrame:
    """Both sides in one pass over the ledger: activity of income and
    expenditure accounts, position of the others, rounded per account and year."""
    accounts = m.glmst.select("zid", "xacc", "xacctype", "xhrc4")
    sums = account_year_sums(m, max(years), m1, m2).join(accounts, ["zid", "xacc"])
    own_year = F.filter(F.array(*[F.lit(y) for y in years]), lambda y: y == F.col("year"))
    pl = F.col("xacctype").isin(*SIDES["pl"])
    if mode == "year":
        reached, amount = own_year, F.when(pl, F.col("within")).otherwise(F.col("upto"))
    else:
        reached, amount = F.when(pl, own_year).otherwise(years_reached(years)), F.col("within")
    keys = ["zid", "xacc", "xacctype", "xhrc4"]
    return (sums.select(*keys, F.explode(reached).alias("year"), amount.alias("amount"))
            .groupBy(*keys, "year").agg(F.round(F.sum("amount"), 1).alias("amount")))


def comparative(m: Model, side: str, years: list[int], m1: int, m2: int, mode: str = "cumulative",
                project: str | None = None) -> DataFrame:
    """All accounts of a side with one 0-filled column per year and their statement line."""
    if side == "pl":
        sums = gl_activity(m, years, m1, m2, project)
    else:
        sums = gl_position(m, years, m1, m2, mode, project)
    lines = m.account_group.filter((F.col("side") == side) & F.col("line").isNotNull()).select(
        F.col("xgroup").alias("xhrc4"), "line")
    wide = pivot_years(sums, ["zid", "xacc"], years)
    columns = [year_column(y) for y in years]
    accounts = gl_master(m, side)
    return accounts.join(wide, ["zid", "xacc"], "left").join(lines, "xhrc4", "left").select(
        *accounts.columns, "line",
        *[F.round(F.coalesce(c, F.lit(0)), 1).alias(c) for c in columns])


def level_summary(cmp: DataFrame, level: int, years: list[int], total: str = "Profit/Loss") -> DataFrame:
    """Sums by account class (1), first (2), second (3) or fourth (4) hierarchy level."""
    group = {1: "xacctype", 2: "xhrc1", 3: "xhrc2", 4: "xhrc4"}[level]
    columns = [year_column(y) for y in years]
    sums = cmp.groupBy("zid", F.col(group).alias("line")).agg(*[F.sum(c).alias(c) for c in columns])
    return with_totals(sums, ["zid", "line"], ["zid"], columns, "line", total)
