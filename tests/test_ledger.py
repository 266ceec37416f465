import pyspark.sql.functions as F
import pytest
from conftest import d, n, rows

from ledgerloom.functions.months import months_between, show_months
from ledgerloom.model import Model
from ledgerloom.operators import ledger, statements, units
from ledgerloom.plans import statement_lines as L
from ledgerloom.schemas import TABLES

YEARS = [2023, 2024]
GROUPS = {**{g: ("Income" if g in ("08-Revenue", "14-Purchase Return", "15-Sales Return") else "Expenditure")
             for g in L.INCOME_LABELS},
          **{g: ("Asset" if g[:2] in ("01", "02", "03") or g == "ACCOUNTS RECEIVABLE" else "Liability")
             for g in L.BALANCE_LABELS}}


def books(spark, table, entries, groups=None, **more):
    """entries: (voucher, year, period, account group, amount)."""
    groups = groups or sorted({e[3] for e in entries})
    accounts = [dict(zid=1, xacc=f"A{i}", xdesc=g, xacctype=GROUPS.get(g, "Expenditure"), xhrc1="h1", xhrc2=g,
                     xhrc3="Operating", xhrc4=g) for i, g in enumerate(groups)]
    number = {g: f"A{i}" for i, g in enumerate(groups)}
    heads = {e[0]: e for e in entries}
    frames = {
        "tenant": table("tenant", dict(zid=1, name="one")),
        "tenant_config": table("tenant_config", dict(zid=1, cogs_account="A0")),
        "tenant_project": table("tenant_project", dict(zid=1, xproj="P", xacc="A0")),
        "account_group": spark.createDataFrame(L.DEFAULT_GROUPS, TABLES["account_group"]),
        "glmst": table("glmst", *accounts),
        "glheader": table("glheader", *[
            dict(zid=1, xvoucher=v, xdate=d(f"{e[1]}-{max(e[2], 1):02d}-15"), xyear=e[1], xper=e[2])
            for v, e in heads.items()]),
        "gldetail": table("gldetail", *[
            dict(zid=1, xvoucher=v, xacc=number[g], xproj="P", xsub=g, xprime=n(a)) for v, _, _, g, a in entries]),
        **more}
    return Model(spark, {}).replace(**frames)


BALANCED = [
    ("JV--1", 2023, 1, "0101-CASH & CASH EQUIVALENT", 100), ("JV--1", 2023, 1, "13-Owners Equity", -100),
    ("JV--2", 2023, 2, "0101-CASH & CASH EQUIVALENT", 50), ("JV--2", 2023, 2, "08-Revenue", -50),
    ("JV--3", 2023, 3, "04-Cost of Goods Sold", 20), ("JV--3", 2023, 3, "0106-STOCK IN HAND", -20),
    ("JV--4", 2024, 1, "0103-ACCOUNTS RECEIVABLE", 80), ("JV--4", 2024, 1, "08-Revenue", -80),
    ("JV--5", 2024, 2, "0636-Depreciation", 10), ("JV--5", 2024, 2, "0303-Furniture & Fixture", -10),
    ("JV--6", 2024, 3, "0629-VAT & Tax Expenses", 5), ("JV--6", 2024, 3, "0903-Accounts Payable", -5),
]


def report(df, key="line"):
    return {r[key]: tuple(r[f"y{y}"] for y in YEARS) for r in df.collect()}


def test_income_statement_lines(spark, table):
    got = report(statements.income_statement(books(spark, table, BALANCED), YEARS, 1, 12))
    assert got[L.REVENUE] == (n(-50), n(-80)) and got[L.COST] == (n(20), n(0))
    assert got[L.GROSS] == (n(-30), n(-80)) and got[L.EBIT] == (n(-30), n(-70)) == got[L.EBT]
    assert got[L.NET_INCOME] == (n(-30), n(-65))
    # a line without any account is 0, not missing
    assert got[L.INTEREST] == (n(0), n(0)) and set(got) == set(L.INCOME_LINES)


def test_discounts_and_unlabelled_accounts_reach_net_income_only(spark, table):
    entries = [("JV--1", 2024, 1, "0701-MRP-Discount", 7), ("JV--2", 2024, 1, "99-Nowhere", 2)]
    got = report(statements.income_statement(books(spark, table, entries), YEARS, 1, 12))
    assert got[L.EBIT] == (n(0), n(0)) and got[L.NET_INCOME] == (n(0), n(9))


def test_balance_check_is_zero_per_year_movement(spark, table):
    got = report(statements.balance_sheet(books(spark, table, BALANCED), YEARS, 1, 12, mode="year"))
    assert got[L.CHECK] == (n(0), n(0))
    assert got[L.CURRENT_ASSETS] == (n(130), n(80)) and got[L.RETAINED] == (n(-30), n(-65))
    assert got["01-1-Assets"] == (None, None)


def test_cumulative_position_adds_earlier_years(spark, table):
    m = books(spark, table, BALANCED)
    got = report(statements.balance_sheet(m, YEARS, 1, 12))
    assert got[L.CASH] == (n(150), n(150)) and got[L.EQUITY] == (n(-100), n(-100))
    # the month range applies within every year
    assert report(statements.balance_sheet(m, YEARS, 2, 12))[L.EQUITY] == (n(0), n(0))


def test_opening_period_counts_in_year_mode_only(spark, table):
    entries = [("OB--1", 2024, 0, "0101-CASH & CASH EQUIVALENT", 40)]
    m = books(spark, table, entries)
    assert rows(ledger.gl_position(m, YEARS, 1, 12, mode="year"), "amount") == [(n(40),)]
    assert rows(ledger.gl_position(m, YEARS, 1, 12)) == []


@pytest.mark.parametrize("layout", ["detailed", "grouped"])
def test_cash_flow_closes(spark, table, layout):
    got = report(statements.cash_flow_statement(books(spark, table, BALANCED), YEARS, 1, 12, layout=layout))
    opening, change, ending = got[L.OPENING_CASH], got[L.CHANGE], got[L.ENDING_CASH]
    assert [o + c for o, c in zip(opening, change)] == list(ending)
    assert opening == (n(0), n(150)) and got["12-Total Investing Cashflow"] == (n(0), n(-10))
    assert got["08"] == (None, None) and got["11-Other investing cash flows"] == (n(0), n(0))
    if layout == "grouped":
        assert got["04-Increase/Decrease in Current Asset"] == (n(0), n(80))
        assert "16-1-Increase/Decrease in Retained Earning" not in got


def test_ratios_stand_alone(spark, table):
    entries = [e for e in BALANCED if not (e[1] == 2023 and e[0] == "JV--2")]
    got = report(statements.financial_ratios(books(spark, table, entries), YEARS, 1, 12), "ratio")
    assert len(got) == 36 and len(L.RATIOS) == 36
    assert got["Net Profit Ratio"][0] is None and got["Net Profit Ratio"][1] == -(-65 * 100 / -80)
    assert got["ROE"] == (-(20 / -100), -(-65 / -100))


def test_cash_vouchers_take_all_their_lines(spark, table):
    entries = [("JV--1", 2024, 1, "0101-CASH & CASH EQUIVALENT", 9), ("JV--1", 2024, 1, "08-Revenue", -9),
               ("JV--2", 2024, 1, "08-Revenue", -5), ("OB--1", 2024, 0, "0101-CASH & CASH EQUIVALENT", 3)]
    groups = ["0101-CASH & CASH EQUIVALENT", "08-Revenue"]
    m = books(spark, table, entries, groups)
    window = (d("2024-01-01"), d("2024-12-31"))
    assert rows(ledger.cash_vouchers_activity(m, *window), "xacc", "amount") == [("A0", n(9)), ("A1", n(-9))]
    flow = ledger.monthly_cash_flow(m, *window, months_between(d("2024-01-01"), d("2024-03-01")))
    by_section = {r.xhrc3: r["2024/1"] for r in flow.filter("xacc is null").collect()}
    assert by_section == {"Operating Cash Flow": 0, "Free Cash Flow": 0}
    pl = ledger.monthly_pl(m, *window, months_between(d("2024-01-01"), d("2024-02-01")))
    assert rows(pl, "xacc", "2024/1", "2024/2") == [("A1", n(-14), n(0)), ("Profit/Loss", n(-14), n(0))]


def test_payables_skip_opening_vouchers_and_list_every_month(spark, table):
    entries = [("JV--1", 2023, 5, "S", 3), ("JV--3", 2024, 7, "S", 1), ("JV--2", 2024, 2, "S", 6), ("OB--1", 2024, 0, "S", 100)]
    m = books(spark, table, entries, casup=table("casup", dict(zid=1, xsup="S", xshort="sup")))
    long = ledger.monthly_payables(m, d("2024-12-31"))
    assert [r[2:] for r in rows(long, "xsub", "xshort", "xyear", "xper", "amount")] == [
        (2023, 5, n(3)), (2024, 2, n(6)), (2024, 7, n(1))] * 2
    wide = show_months(long, ["zid", "xsub", "xshort"], d("2024-12-31"))
    assert wide.columns[3:] == [f"{y}/{p}" for y in (2023, 2024) for p in range(5 if y == 2023 else 1, 13)] + ["other"]
    assert rows(wide, "xsub", "xshort", "other", "2023/5", "2024/1", "2024/2") == [
        ("S", "sup", n(0), n(3), n(0), n(6)), (None, "Monthly Payable", n(0), n(3), n(0), n(6))]


def test_units_have_projects_and_cash_accounts_of_their_own(spark, table):
    groups = ["0101-CASH & CASH EQUIVALENT", "0102-BANK BALANCE", "08-Revenue"]
    entries = [("JV--1", 2024, 1, groups[0], 9), ("JV--1", 2024, 1, groups[2], -9),
               ("JV--2", 2024, 1, groups[1], 4), ("JV--2", 2024, 1, groups[2], -4), ("JV--3", 2024, 1, groups[2], -1)]
    m = books(spark, table, entries, groups)
    other = m.gldetail.selectExpr("2 AS zid", "xvoucher", "xacc", "'Q' AS xproj", "xsub", "xprime")
    two = m.replace(
        gldetail=m.gldetail.union(other), glheader=m.glheader.union(m.glheader.selectExpr("2", "xvoucher", "xdate", "xyear", "xper")),
        glmst=m.glmst.union(m.glmst.selectExpr("2", *m.glmst.columns[1:])),
        tenant_project=table("tenant_project", dict(zid=1, xproj="P", xacc="A0"), dict(zid=1, xproj="P", xacc="A1"),
                             dict(zid=2, xproj="Q", xacc="A1"), dict(zid=2, xproj="P", xacc="A0")))
    got = ledger.cash_vouchers_activity(two, d("2024-01-01"), d("2024-12-31"))
    assert rows(got, "zid", "xacc", "amount") == [
        (1, "A0", n(9)), (1, "A1", n(4)), (1, "A2", n(-13)), (2, "A1", n(4)), (2, "A2", n(-4))]


def test_groups_of_the_books_own_table_reach_their_lines(spark, table):
    group = "0629- Somewhere VAT & Tax Expenses"
    entries = [("JV--1", 2024, 1, group, 5), ("JV--2", 2024, 1, "08-Revenue", -20)]
    own = spark.createDataFrame([*L.DEFAULT_GROUPS, ("pl", group, L.TAX, "tax")], TABLES["account_group"])
    m = books(spark, table, entries, account_group=own)
    assert report(statements.income_statement(m, YEARS, 1, 12))[L.TAX] == (n(0), n(5))
    ratios = {r.ratio: r.y2024 for r in statements.financial_ratios(m, YEARS, 1, 12).collect()}
    assert ratios["Tax Ratio"] == 25
    pl = ledger.comparative(m, "pl", YEARS, 1, 12)
    assert {r.line for r in pl.filter(F.col("xhrc4") == group).collect()} == {L.TAX}
    last = lambda df: {r.name: r.y2024 for r in df.collect()}["one"]
    assert last(units.tenant_tax(m, pl, YEARS)) == 5 and last(units.tenant_ebitda(m, pl, YEARS)) == -20


def test_statement_report_holds_all_parts_with_reversed_signs(spark, table):
    m = books(spark, table, BALANCED)
    got = {(r.part, r.line): (r.y2023, r.y2024) for r in statements.statement_report(m, YEARS, 1, 12).collect()}
    assert got["income", L.REVENUE] == (50, 80) and got["balance", "01-1-Assets"] == (0, 0)
    assert got["ratios", "Gross Profit Ratio"] == (-60, -100) and {p for p, _ in got} == {"income", "balance", "cash flow", "ratios"}


def test_unit_summaries_use_the_units_own_cost_account(spark, table):
    groups = ["04-Cost of Goods Sold", "0636-Depreciation", "0630-Bank Interest & Charges", "08-Revenue"]
    entries = [("JV--1", 2024, 1, g, a) for g, a in zip(groups, (10, 2, 3, -40))]
    m = books(spark, table, entries, groups)
    pl = ledger.comparative(m, "pl", YEARS, 1, 12)
    last = lambda df: {r.name: r.y2024 for r in df.collect()}
    assert last(units.tenant_cogs(m, pl, YEARS)) == {"one": 10, "Total": 10}
    assert last(units.tenant_expense(m, pl, YEARS)) == {"one": 5, "Total": 5}
    assert last(units.tenant_interest(m, pl, YEARS)) == {"one": 3, "Total": 3}
    assert last(units.tenant_ebitda(m, pl, YEARS)) == {"one": -30, "Total": -30}
    assert last(units.tenant_tax(m, pl, YEARS)) == {"one": 0, "Total": 0}
    assert last(units.tenant_income(m, pl, YEARS)) == {"one": -40, "Total": -40}
    assert last(units.tenant_profit(m, pl, YEARS)) == {"one": -25, "Total": -25}


def test_levels_add_up_to_their_total(sample):
    cmp = ledger.comparative(sample, "pl", [2000, 2001], 1, 12)
    for level in (1, 2, 3, 4):
        df = ledger.level_summary(cmp, level, [2000, 2001])
        total = df.filter("line = 'Profit/Loss'").agg(F.sum("y2001")).first()[0]
        parts = df.filter("line <> 'Profit/Loss'").agg(F.sum("y2001")).first()[0]
        assert total == parts
