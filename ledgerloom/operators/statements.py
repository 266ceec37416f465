"""Income statement, balance sheet, cash flow statement and ratios.

The facts stay long, ``(zid, line, year, amount)``: each account amount is
copied to its line and to every subtotal it enters, then summed.  All lines
exist for all units and years, so a missing account is 0 and never shifts a
year.  The frames hold a few hundred rows whatever the size of the ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import literal, lookup
from ledgerloom.functions.months import pivot_years, year_column
from ledgerloom.model import Model
from ledgerloom.operators.ledger import account_amounts
from ledgerloom.plans import statement_lines as L

AMOUNT = "decimal(38,1)"
INCOME, BALANCE = "income", "balance"


def _grid(m: Model, statement: str, lines: list[str], years: list[int], amount: int | None) -> DataFrame:
    """One row per unit, line and year."""
    return (m.tenant.selectExpr("zid", f"explode({literal(lines)}) AS line")
            .selectExpr("zid", f"{literal(statement)} AS statement", "line",
                        f"explode({literal(years)}) AS year", f"cast({literal(amount)} AS {AMOUNT}) AS amount"))


def _targets(subtotals: dict[str, list[str]], statement: str, always: list[tuple[str, str]]) -> Column:
    """Lines that an account enters: that of its group, the subtotals of that line, and ``always``."""
    line = F.col("line")
    totals = {k: [{"statement": statement, "line": x} for x in above] for k, above in subtotals.items()}
    kind = "array<struct<statement:string,line:string>>"
    nothing = F.array().cast(kind)
    own = F.when(line.isNull(), nothing).otherwise(F.array(F.struct(F.lit(statement).alias("statement"), line.alias("line"))))
    everywhere = F.expr(literal([{"statement": s, "line": x} for s, x in always])).cast(kind) if always else nothing
    return F.concat(own, F.coalesce(lookup(line, totals).cast(kind), nothing), everywhere)


def statement_facts(m: Model, years: list[int], m1: int, m2: int, mode: str = "cumulative") -> DataFrame:
    """Income statement and balance sheet lines from one pass over the ledger.

    Net income is the sum of all income and expenditure accounts, whether or
    not their group has a line; it is also the retained earnings of the year.
    The balance sheet is rounded to whole units.
    """
    side = F.when(F.col("xacctype").isin("Income", "Expenditure"), "pl").otherwise("bs")
    accounts = account_amounts(m, years, m1, m2, mode).withColumn("side", side).join(
        m.account_group.select("side", F.col("xgroup").alias("xhrc4"), "line"), ["side", "xhrc4"], "left")
    income = _targets(L.INCOME_SUBTOTALS, INCOME,
                      [(INCOME, L.NET_INCOME), (BALANCE, L.RETAINED), (BALANCE, L.CHECK)])
    balance = _targets(L.BALANCE_SUBTOTALS, BALANCE, [])
    entered = F.when(F.col("xacctype").isin("Income", "Expenditure"), income).otherwise(balance)
    rows = accounts.select("zid", F.inline(entered), "year", "amount")
    for statement, lines in ((INCOME, L.INCOME_LINES), (BALANCE, L.BALANCE_LINES)):
        rows = rows.unionByName(_grid(m, statement, lines, years, 0))
    total = F.sum("amount")
    return rows.groupBy("zid", "statement", "line", "year").agg(
        F.when(F.col("statement") == BALANCE, F.round(total, 0).cast(AMOUNT))
        .otherwise(total.cast(AMOUNT)).alias("amount"))


def cash_flow_lines(m: Model, years: list[int], m1: int, m2: int, mode: str, layout: str) -> DataFrame:
    """Indirect cash flow from the changes of the balance sheet; the first year changes nothing."""
    rows = L.CASH_FLOW_ROWS[layout]
    by_line = Window.partitionBy("zid", "statement", "line").orderBy("year")
    facts = statement_facts(m, years, m1, m2, mode).withColumn("before", F.lag("amount").over(by_line))
    change = F.coalesce(F.col("amount") - F.col("before"), F.lit(0))
    earned = {L.NET_INCOME: "02-Net Income", L.DEPRECIATION: "03-Depreciation and amortization"}

    def effects(*pairs: tuple[str | Column, Column]) -> Column:
        return F.array(*[
            F.struct((F.lit(line) if isinstance(line, str) else line).alias("line"),
                     amount.cast(AMOUNT).alias("amount")) for line, amount in pairs])

    line, amount, before = F.col("line"), F.col("amount"), F.col("before")
    of_income = effects((lookup(line, earned), amount), (L.OPERATING_TOTAL, amount))
    of_cash = effects((L.OPENING_CASH, before), (L.ENDING_CASH, before))
    of_balance = effects((lookup(line, {k: v[0] for k, v in rows.items()}), change),
                         (lookup(line, {k: v[1] for k, v in rows.items()}), change),
                         (L.CHANGE, -change), (L.ENDING_CASH, -change))
    in_income = F.col("statement") == INCOME
    effect = (F.when(in_income & line.isin(*earned), of_income)
              .when(~in_income & (line == L.CASH), of_cash)
              .when(~in_income & line.isin(*rows), of_balance))
    every = sorted({*[r for pair in rows.values() for r in pair], *earned.values(),
                    *L.CASH_FLOW_ZERO, L.OPENING_CASH, L.CHANGE, L.ENDING_CASH})
    moved = facts.select("zid", "year", effect.alias("effect")).filter("effect is not null").select(
        "zid", F.inline("effect"), "year")
    return (moved.unionByName(_grid(m, "", every, years, 0).drop("statement"))
            .groupBy("zid", "line", "year").agg(F.sum("amount").cast(AMOUNT).alias("amount")))


def _report(m: Model, lines: DataFrame, headings: list[str], years: list[int]) -> DataFrame:
    lines = lines.select("zid", "line", "year", "amount")
    if headings:
        lines = lines.unionByName(_grid(m, "", headings, years, None).drop("statement"))
    return pivot_years(lines, ["zid", "line"], years)


def _of(m: Model, statement: str, years: list[int], m1: int, m2: int, mode: str) -> DataFrame:
    return statement_facts(m, years, m1, m2, mode).filter(F.col("statement") == statement)


def income_statement(m: Model, years: list[int], m1: int, m2: int) -> DataFrame:
    return _report(m, _of(m, INCOME, years, m1, m2, "year"), [], years)


def balance_sheet(m: Model, years: list[int], m1: int, m2: int, mode: str = "cumulative") -> DataFrame:
    return _report(m, _of(m, BALANCE, years, m1, m2, mode), L.BALANCE_HEADINGS, years)


def cash_flow_statement(m: Model, years: list[int], m1: int, m2: int, mode: str = "cumulative",
                        layout: str = "detailed") -> DataFrame:
    return _report(m, cash_flow_lines(m, years, m1, m2, mode, layout), L.CASH_FLOW_HEADINGS, years)


def financial_ratios(m: Model, years: list[int], m1: int, m2: int, mode: str = "cumulative") -> DataFrame:
    """All ratios with reversed sign, one row per unit and ratio.

    Each ratio stands on its own: a zero denominator makes that one NULL.
    """
    both = statement_facts(m, years, m1, m2, mode)
    used = sorted({line.lstrip("-") for _, _, n, d in L.RATIOS for line in [*n, *d]})
    name = {line: f"l{i}" for i, line in enumerate(used)}
    wide = both.groupBy("zid", "year").agg(*[
        F.expr(f"sum(amount) FILTER (WHERE line = {literal(line)}) AS {name[line]}") for line in used])

    def added(lines: list[str]) -> str:
        return " + ".join(f"(-{name[x[1:]]})" if x.startswith("-") else name[x] for x in lines)

    # subtracting from 0 instead of negating keeps a zero ratio free of a sign
    cells = ", ".join(
        f"named_struct('ratio_no', {i}, 'ratio', {literal(title)}, 'amount', 0D - try_divide("
        f"cast(({added(num)}) * {factor} AS double), cast({added(den)} AS double)))"
        for i, (title, factor, num, den) in enumerate(L.RATIOS, start=1))
    long = wide.selectExpr("zid", "year", f"inline(array({cells}))")
    return long.groupBy("zid", "ratio_no", "ratio").agg(*[
        F.max(F.when(F.col("year") == y, F.col("amount"))).alias(year_column(y)) for y in years])


def statement_report(m: Model, years: list[int], m1: int, m2: int, mode: str = "cumulative",
                     layout: str = "detailed") -> DataFrame:
    """Income statement, balance sheet, cash flow and ratios of every unit in one frame.

    Signs are reversed, so income shows positive; amounts have three digits;
    headings and ratios without a denominator show 0.
    """
    amounts = [("income", income_statement(m, years, m1, m2)), ("balance", balance_sheet(m, years, m1, m2, mode)),
               ("cash flow", cash_flow_statement(m, years, m1, m2, mode, layout))]
    ratios = financial_ratios(m, years, m1, m2, mode).withColumnRenamed("ratio", "line")
    columns = [year_column(y) for y in years]

    def shown(part: DataFrame, number: int, name: str, sign: int) -> DataFrame:
        return part.select("zid", F.lit(number).alias("part_no"), F.lit(name).alias("part"), "line", *[
            F.round(F.coalesce(F.col(c).cast("decimal(30,9)") * sign, F.lit(0)), 3).alias(c) for c in columns])

    report = shown(ratios, len(amounts) + 1, "ratios", 1)  # ratios are reversed already
    for number, (name, part) in enumerate(amounts, start=1):
        report = report.unionByName(shown(part, number, name, -1))
    return report
