"""SQL of the ledger, statement and unit reports."""

from ledgerloom.plans.params import DEFAULT as P

# Statement line of each account group, written out here so that the reports are held against them.
INCOME_LABELS = {
    "04-Cost of Goods Sold": "02-1-Cost of Revenue",
    "0401-DIRECT EXPENSES": "07-1-Other Operating Expenses, Total",
    "0401-PURCHASE": "07-1-Other Operating Expenses, Total",
    "0501-OTHERS DIRECT EXPENSES": "07-1-Other Operating Expenses, Total",
    "0601-OTHERS DIRECT EXPENSES": "07-1-Other Operating Expenses, Total",
    "0631- Development Expenses": "07-1-Other Operating Expenses, Total",
    "06-Office & Administrative Expenses": "03-1-Office & Administrative Expenses",
    "0625-Property Tax & Others": "09-1-Income Tax & VAT",
    "0629-VAT & Tax Expenses": "09-1-Income Tax & VAT",
    "0630- Bank Interest & Charges": "08-1-Interest Expense",
    "0630-Bank Interest & Charges": "08-1-Interest Expense",
    "0631-Other Expenses": "07-1-Other Operating Expenses, Total",
    "0633-Interest-Loan": "08-1-Interest Expense",
    "0636-Depreciation": "05-1-Depreciation/Amortization",
    "07-Sales & Distribution Expenses": "04-1-Sales & Distribution Expenses",
    "SALES & DISTRIBUTION EXPENSES": "04-1-Sales & Distribution Expenses",
    "0701-MRP-Discount": "04-2-MRP Discount",
    "0702-Discount-Expense": "04-3-Discount Expense",
    "08-Revenue": "01-1-Revenue",
    "14-Purchase Return": "06-1-Unusual Expenses (Income)",
    "15-Sales Return": "06-1-Unusual Expenses (Income)",
    "": "06-1-Unusual Expenses (Income)",
    "0629- Unit VAT & Tax Expenses": "09-1-Income Tax & VAT",
}
BALANCE_LABELS = {
    "0101-CASH & CASH EQUIVALENT": "01-3-Cash",
    "0102-BANK BALANCE": "01-3-Cash",
    "0103-ACCOUNTS RECEIVABLE": "02-1-Accounts Receivable",
    "ACCOUNTS RECEIVABLE": "02-1-Accounts Receivable",
    "0104-PREPAID EXPENSES": "04-1-Prepaid Expenses",
    "0105-ADVANCE ACCOUNTS": "04-1-Prepaid Expenses",
    "0106-STOCK IN HAND": "03-1-Inventories",
    "02-OTHER ASSET": "05-1-Other Assets",
    "0201-DEFFERED CAPITAL EXPENDITURE": "05-1-Other Assets",
    "0203-LOAN TO OTHERS CONCERN": "05-1-Other Assets",
    "0204-SECURITY DEPOSIT": "05-1-Other Assets",
    "0205-LOAN TO OTHERS CONCERN": "05-1-Other Assets",
    "0206-Other Investment": "05-1-Other Assets",
    "0301-Lab Equipment": "06-1-Property, Plant & Equipment",
    "0301-Office Equipment": "06-1-Property, Plant & Equipment",
    "0302-Corporate Office Equipments": "06-1-Property, Plant & Equipment",
    "0303-Furniture & Fixture": "06-1-Property, Plant & Equipment",
    "0303-Lab Decoration": "06-1-Property, Plant & Equipment",
    "0304-Trading Vehicles": "06-1-Property, Plant & Equipment",
    "0305-Private Vehicles": "06-1-Property, Plant & Equipment",
    "0305-Plants & Machinery": "06-1-Property, Plant & Equipment",
    "0306- Plants & Machinery": "06-1-Property, Plant & Equipment",
    "0307-Intangible Asset": "07-1-Goodwill & Intangible Asset",
    "0308-Land & Building": "06-1-Property, Plant & Equipment",
    "0901-Accrued Expenses": "09-1-Accrued Liabilities",
    "0902-Income Tax Payable": "09-1-Accrued Liabilities",
    "0903-Accounts Payable": "08-1-Accounts Payable",
    "0904-Money Agent Liability": "10-1-Other Short Term Liabilities",
    "0904-Reconciliation Liability": "10-1-Other Short Term Liabilities",
    "0905-C & F Liability": "10-1-Other Short Term Liabilities",
    "0906-Others Liability": "10-1-Other Short Term Liabilities",
    "INTERNATIONAL PURCHASE TAX & COMMISSION": "10-1-Other Short Term Liabilities",
    "1001-Short Term Bank Loan": "11-1-Debt",
    "1002-Short Term Loan": "11-1-Debt",
    "11-Reserve & Fund": "12-1-Other Long Term Liabilities",
    "1202-Long Term Bank Loan": "11-1-Debt",
    "13-Owners Equity": "13-1-Total Shareholders Equity",
}

A, B = f"DATE '{P.ledger_start}'", f"DATE '{P.ledger_end}'"
YEARS = list(P.years)
M1, M2 = P.first_month, P.last_month
YEAR_COLUMNS = " ".join(f"y{y}:d" for y in YEARS)
IN_YEARS = ", ".join(str(y) for y in YEARS)
YEAR_LIST = "(VALUES " + ", ".join(f"({y})" for y in YEARS) + ") AS y(year)"


def month_columns(months) -> str:
    return " ".join(f"{y}/{p}:d" for y, p in months) + " other:d"


def month_sums(months, value: str = "amount") -> str:
    cells = [f'coalesce(sum({value}) FILTER (WHERE xyear = {y} AND xper = {p}), 0) AS "{y}/{p}"' for y, p in months]
    listed = ", ".join(str(y * 100 + p) for y, p in months)
    cells.append(f"coalesce(sum({value}) FILTER (WHERE xyear * 100 + xper NOT IN ({listed})), 0) AS other")
    return ", ".join(cells)


LINES = """SELECT d.zid, d.xvoucher, d.xacc, d.xproj, d.xsub, d.xprime, h.xdate, h.xyear, h.xper
    FROM gldetail d JOIN glheader h ON h.zid = d.zid AND h.xvoucher = d.xvoucher"""

OWN_PROJECT = "(l.zid, l.xproj) IN (SELECT (zid, xproj) FROM tenant_project)"

CASH = f"""SELECT l.zid, l.xacc, l.xyear, l.xper, sum(l.xprime) AS amount FROM ({LINES}) l
    WHERE {OWN_PROJECT} AND l.xper <> 0 AND l.xdate BETWEEN {A} AND {B}
    AND EXISTS (SELECT 1 FROM ({LINES}) c JOIN tenant_project t ON t.zid = c.zid AND t.xproj = c.xproj AND t.xacc = c.xacc
        WHERE c.zid = l.zid AND c.xvoucher = l.xvoucher AND c.xper <> 0 AND c.xdate BETWEEN {A} AND {B})
    AND EXISTS (SELECT 1 FROM glmst g WHERE g.zid = l.zid AND g.xacc = l.xacc)
    GROUP BY 1, 2, 3, 4"""


def cash_section(name: str, groups: str) -> str:
    return f"""SELECT c.zid, NULL AS xacc, NULL AS xdesc, '{name}' AS xhrc3, NULL AS xacctype, {month_sums(P.months)}
        FROM cash c JOIN glmst g ON g.zid = c.zid AND g.xacc = c.xacc WHERE g.xhrc3 IN ({groups}) GROUP BY c.zid"""


CASH_FLOW = f"""WITH cash AS ({CASH})
    SELECT c.zid, c.xacc, g.xdesc, g.xhrc3, g.xacctype, {month_sums(P.months)}
    FROM cash c JOIN glmst g ON g.zid = c.zid AND g.xacc = c.xacc GROUP BY 1, 2, 3, 4, 5
    UNION ALL {cash_section('Operating Cash Flow', "'Operating', 'Operating Investment'")}
    UNION ALL {cash_section('Investing Cash Flow', "'Investing'")}
    UNION ALL {cash_section('Financing Cash Flow', "'Financing'")}
    UNION ALL {cash_section('Free Cash Flow', "'Operating', 'Operating Investment', 'Investing'")}"""

MONTHLY_PL = f"""WITH pl AS (SELECT l.zid, l.xacc, g.xdesc, g.xacctype, l.xyear, l.xper, l.xprime AS amount
        FROM ({LINES}) l JOIN glmst g ON g.zid = l.zid AND g.xacc = l.xacc
        WHERE g.xacctype IN ('Income', 'Expenditure') AND {OWN_PROJECT} AND l.xdate BETWEEN {A} AND {B})
    SELECT zid, xacc, xdesc, xacctype, {month_sums(P.pl_months)} FROM pl GROUP BY 1, 2, 3, 4
    UNION ALL SELECT zid, 'Profit/Loss', NULL, NULL, {month_sums(P.pl_months)} FROM pl GROUP BY 1"""


def partners(table: str, key: str, columns: list[str], label: str, text: str) -> str:
    named = ", ".join(f"p.{c}" for c in columns)
    total = ", ".join(f"'{text}' AS {c}" if c == label else f"NULL AS {c}" for c in columns)
    return f"""WITH owed AS (SELECT l.zid, l.xsub, {named}, l.xyear, l.xper, l.xprime AS amount
            FROM ({LINES}) l JOIN {table} p ON p.zid = l.zid AND p.{key} = l.xsub
            WHERE {OWN_PROJECT} AND l.xvoucher NOT LIKE 'OB--%' AND l.xdate <= {B})
        SELECT zid, xsub, {', '.join(columns)}, xyear, xper, sum(amount) AS amount FROM owed GROUP BY ALL
        UNION ALL SELECT zid, NULL, {total}, xyear, xper, sum(amount) FROM owed GROUP BY zid, xyear, xper"""


STOCK_VALUE = f"""WITH moved AS (SELECT i.zid, c.xgitem, i.xyear, i.xper, i.xval * i.xsign AS amount
        FROM imtrn i JOIN caitem c ON c.zid = i.zid AND c.xitem = i.xitem WHERE i.xdate <= {B})
    SELECT zid, xgitem, xyear, xper, sum(amount) AS amount FROM moved GROUP BY 1, 2, 3, 4
    UNION ALL SELECT zid, 'Monthly Inventory', xyear, xper, sum(amount) FROM moved GROUP BY 1, 3, 4"""


def activity(project: str = "TRUE") -> str:
    return f"""SELECT l.zid, l.xacc, l.xyear AS year, sum(l.xprime) AS amount FROM ({LINES}) l
        JOIN glmst g ON g.zid = l.zid AND g.xacc = l.xacc
        WHERE g.xacctype IN ('Income', 'Expenditure') AND l.xyear IN ({IN_YEARS}) AND l.xper BETWEEN {M1} AND {M2}
        AND {project} GROUP BY 1, 2, 3"""


def position(mode: str = "cumulative", project: str = "TRUE") -> str:
    window = ("l.xyear = y.year AND l.xper <= " + str(M2) if mode == "year"
              else f"l.xyear <= y.year AND l.xper BETWEEN {M1} AND {M2}")
    return f"""SELECT l.zid, l.xacc, y.year, sum(l.xprime) AS amount FROM ({LINES}) l
        JOIN glmst g ON g.zid = l.zid AND g.xacc = l.xacc JOIN {YEAR_LIST} ON {window}
        WHERE g.xacctype IN ('Asset', 'Liability') AND {project} GROUP BY 1, 2, 3"""


def labels(mapping: dict) -> str:
    rows = ", ".join(f"('{group}', '{line}')" for group, line in mapping.items())
    return f"(VALUES {rows}) AS n(xhrc4, line)"


def comparative(side: str, sums: str) -> str:
    hidden, mapping = (("'Asset', 'Liability'", INCOME_LABELS) if side == "pl"
                       else ("'Income', 'Expenditure'", BALANCE_LABELS))
    cells = ", ".join(f"round(coalesce(max(s.amount) FILTER (WHERE s.year = {y}), 0), 1) AS y{y}" for y in YEARS)
    return f"""SELECT g.zid, g.xacc, g.xacctype, g.xdesc, g.xhrc1, g.xhrc2, g.xhrc3, g.xhrc4, n.line, {cells}
        FROM glmst g LEFT JOIN {labels(mapping)} ON n.xhrc4 = g.xhrc4
        LEFT JOIN ({sums}) s ON s.zid = g.zid AND s.xacc = g.xacc
        WHERE g.xacctype NOT IN ({hidden}) GROUP BY ALL"""


PL, BS = comparative("pl", activity()), comparative("bs", position())
year_sums = ", ".join(f"sum(y{y}) AS y{y}" for y in YEARS)
ACCOUNT_COLUMNS = "zid:i xacc:s xacctype:s xdesc:s xhrc1:s xhrc2:s xhrc3:s xhrc4:s"
CMP_COLUMNS = f"{ACCOUNT_COLUMNS} line:s {YEAR_COLUMNS}"


def level(source: str, column: str, total: str) -> str:
    return f"""WITH cmp AS ({source}) SELECT zid, {column} AS line, {year_sums} FROM cmp GROUP BY 1, 2
        UNION ALL SELECT zid, '{total}', {year_sums} FROM cmp GROUP BY 1"""


# --- statements: one row per unit and year with a column per line, then formulas ---

def long(source: str) -> str:
    return " UNION ALL ".join(f"SELECT zid, line, {y} AS year, y{y} AS amount FROM {source}" for y in YEARS)


def line(prefix: str) -> str:
    return f"CAST(coalesce(sum(amount) FILTER (WHERE line LIKE '{prefix}%'), 0) AS DECIMAL(30,1))"


INCOME_NAMES = {
    "rev": "01-1-Revenue", "cogs": "02-1-Cost of Revenue", "oae": "03-1-Office & Administrative Expenses",
    "sd": "04-1-Sales & Distribution Expenses", "mrp": "04-2-MRP Discount", "disc": "04-3-Discount Expense",
    "dep": "05-1-Depreciation/Amortization", "unusual": "06-1-Unusual Expenses (Income)",
    "oper": "07-1-Other Operating Expenses, Total", "inter": "08-1-Interest Expense", "tax": "09-1-Income Tax & VAT",
    "gross": "02-2-Gross Profit", "ebit": "07-2-EBIT", "ebt": "08-2-EBT", "ni": "10-1-Net Income",
}
BALANCE_NAMES = {
    "cash": "01-3-Cash", "ar": "02-1-Accounts Receivable", "inv": "03-1-Inventories", "prepaid": "04-1-Prepaid Expenses",
    "oth": "05-1-Other Assets", "ppe": "06-1-Property, Plant & Equipment", "good": "07-1-Goodwill & Intangible Asset",
    "ap": "08-1-Accounts Payable", "accr": "09-1-Accrued Liabilities", "st": "10-1-Other Short Term Liabilities",
    "debt": "11-1-Debt", "lt": "12-1-Other Long Term Liabilities", "eq": "13-1-Total Shareholders Equity",
    "tca": "04-2-Total Current Assets", "nca": "07-2-Total Non-Current Assets",
    "tcl": "11-2-Total Current Liabilities", "ncl": "12-2-Total Non-Current Liabilities",
    "re": "13-2-Retained Earnings", "chk": "13-3-Balance Check",
}
_income_base = ", ".join(f"{line(INCOME_NAMES[k])} AS {k}" for k in list(INCOME_NAMES)[:11])
_balance_base = ", ".join(f"{line(BALANCE_NAMES[k])} AS {k}" for k in list(BALANCE_NAMES)[:13])

STATEMENTS = f"""pl AS ({PL}), bs AS ({BS}), grid AS (SELECT t.zid, y.year FROM tenant t CROSS JOIN {YEAR_LIST}),
    pl_long AS ({long('pl')}), bs_long AS ({long('bs')}),
    i0 AS (SELECT zid, year, {_income_base}, CAST(sum(amount) AS DECIMAL(30,1)) AS ni FROM pl_long GROUP BY 1, 2),
    i1 AS (SELECT *, rev + cogs AS gross FROM i0),
    i2 AS (SELECT *, gross + oae + sd + dep + unusual + oper AS ebit FROM i1),
    inc AS (SELECT *, ebit + inter AS ebt FROM i2),
    b0 AS (SELECT zid, year, {_balance_base} FROM bs_long GROUP BY 1, 2),
    b1 AS (SELECT b0.*, cash + ar + inv + prepaid AS tca, oth + ppe + good AS nca, ap + accr + st + debt AS tcl,
        lt AS ncl, inc.ni AS re FROM b0 JOIN inc ON inc.zid = b0.zid AND inc.year = b0.year),
    b2 AS (SELECT *, tca + nca + tcl + ncl + eq + re AS chk FROM b1),
    bal AS (SELECT zid, year, {', '.join(f'CAST(round({k}, 0) AS DECIMAL(30,1)) AS {k}' for k in BALANCE_NAMES)} FROM b2)"""


def rows(source: str, names: dict) -> str:
    return " UNION ALL ".join(f"SELECT zid, year, '{v}' AS line, CAST({k} AS DECIMAL(38,1)) AS amount FROM {source}" for k, v in names.items())


def headings(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT zid, year, '{n}' AS line, NULL AS amount FROM grid" for n in names)


wide_years = ", ".join(f"max(amount) FILTER (WHERE year = {y}) AS y{y}" for y in YEARS)
STATEMENT_COLUMNS = f"zid:i line:s {YEAR_COLUMNS}"

CASH_FLOW_BASE = f"""{STATEMENTS}, d AS (SELECT b.zid, b.year, i.ni, i.dep,
        {', '.join(f'coalesce(b.{k} - p.{k}, 0) AS {k}' for k in ('ar', 'inv', 'prepaid', 'ap', 'accr', 'st', 'nca', 'debt', 'eq', 're', 'ncl'))},
        coalesce(p.cash, 0) AS opening
        FROM bal b JOIN inc i ON i.zid = b.zid AND i.year = b.year
        LEFT JOIN bal p ON p.zid = b.zid AND p.year = b.year - 1),
    t AS (SELECT *, ni + dep + ar + inv + prepaid + ap + accr + st AS operating, debt + eq + re + ncl AS financing, 0 AS none FROM d),
    cf AS (SELECT *, -(operating + nca + financing - ni - dep) AS change, ar + inv + prepaid AS cur_assets,
        ap + accr + st AS cur_liabilities, eq + re AS equity_all FROM t),
    cash_flow AS (SELECT *, opening + change AS ending FROM cf)"""

_common = {"ni": "02-Net Income", "dep": "03-Depreciation and amortization",
           "operating": "07-Total Operating Cashflow", "nca": "10-Capital asset acquisitions/disposal",
           "debt": "15-Increase/Decrease in Debt", "ncl": "17-Other financing cash flows",
           "financing": "18-Total Financing Cashflow", "opening": "20-Year Opening Cash",
           "change": "21-Change in Cash", "ending": "22-Year Ending Cash"}
_extra = ("SELECT zid, year, '12-Total Investing Cashflow' AS line, nca AS amount FROM cash_flow UNION ALL "
          "SELECT zid, year, '06-Other operating cash flow adjustments', 0 FROM cash_flow UNION ALL "
          "SELECT zid, year, '11-Other investing cash flows', 0 FROM cash_flow UNION ALL "
          + headings(["01-Operating Activities", "08", "09-Investing Cashflow", "13", "14-Financing Cashflow", "19"]))
DETAILED = {**_common, "ar": "04-1-Accounts Receivable", "inv": "04-2-Inventories", "prepaid": "04-3-Prepaid Expenses",
            "ap": "05-1-Accounts Payable", "accr": "05-2-Accrued Liabilities", "st": "05-3-Other Short Term Liabilities",
            "eq": "16-Increase/Decrease in Equity", "re": "16-1-Increase/Decrease in Retained Earning"}
GROUPED = {**_common, "cur_assets": "04-Increase/Decrease in Current Asset",
           "cur_liabilities": "05-Increase/Decrease in Current Liabilities", "equity_all": "16-Increase/Decrease in Equity"}


def cash_flow(names: dict) -> str:
    return f"""WITH {CASH_FLOW_BASE}, rep AS ({rows('cash_flow', names)} UNION ALL {_extra})
        SELECT zid, line, {wide_years} FROM rep GROUP BY 1, 2"""


RATIOS = [
    ("COGS Ratio", "cogs * 100", "rev"), ("Gross Profit Ratio", "gross * 100", "rev"),
    ("Operating Profit", "ebit * 100", "rev"), ("Net Profit Ratio", "ni * 100", "rev"),
    ("Tax Coverage", "tax * 100", "ebt"), ("Interest Coverage", "inter * 100", "ebit"),
    ("OAE Ratio", "oae * 100", "rev"), ("S&D Ratio", "sd * 100", "rev"), ("Depreciation Ratio", "dep * 100", "rev"),
    ("Unusual Expense Ratio", "unusual * 100", "rev"), ("Other Operating Ratio", "oper * 100", "rev"),
    ("Interest Ratio", "inter * 100", "rev"), ("Tax Ratio", "tax * 100", "rev"),
    ("Quick Ratio", "tca", "tcl"), ("Current Ratio", "tca", "tcl"),
    ("Total Asset Turnover Ratio", "rev", "tca + nca"), ("Net Asset Turnover Ratio", "rev", "tca + nca + tcl + ncl"),
    ("Inventory Turnover", "cogs", "inv"), ("Inventory Days", "inv * 365", "cogs"),
    ("Accounts Receivable Turnover", "rev", "ar"), ("Accounts Receivable Days", "ar * 365", "rev"),
    ("Accounts Payable Turnover", "cogs", "ap"), ("Accounts Payable Days", "ap * 365", "cogs"),
    ("PP&E Ratio", "ppe", "rev"), ("Working Capital Turnover", "rev", "ar + inv + ap"),
    ("Cash Turnover", "rev", "cash"), ("Debt/Equity", "debt + st + lt", "eq"),
    ("Debt/Capital", "debt + st + lt", "eq - (debt + st + lt)"), ("Debt/TNW", "debt + st + lt", "nca - good"),
    ("Total Liabilities/Equity", "tcl + ncl", "eq - (debt + st + lt)"), ("Total Assets to Equity", "tca + nca", "eq"),
    ("Debt/EBITDA", "debt + st + lt", "ebit + dep"), ("Capital Structure Impact", "ebt", "ebit"),
    ("Acid Test", "tca - inv", "tcl"), ("ROE", "ni", "eq"), ("ROA", "ni", "tca + nca"),
]
_ratio_rows = " UNION ALL ".join(
    f"SELECT zid, year, {i} AS ratio_no, '{name}' AS ratio, "
    f"CAST(0 AS DOUBLE) - (CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE)) AS amount FROM both_sides"
    for i, (name, num, den) in enumerate(RATIOS, start=1))


def units(where: str) -> str:
    cells = ", ".join(f"coalesce(sum(p.y{y}), 0) AS y{y}" for y in YEARS)
    return f"""WITH pl AS ({PL}), u AS (SELECT t.zid, t.name, {cells} FROM tenant t JOIN tenant_config c ON c.zid = t.zid
            LEFT JOIN pl p ON p.zid = t.zid AND {where} GROUP BY 1, 2)
        SELECT * FROM u UNION ALL SELECT NULL, 'Total', {year_sums} FROM u"""


TAX = "'0629- Unit VAT & Tax Expenses', '0604-City Corporation Tax', '0625-Property Tax & Others', '0629-VAT & Tax Expenses'"
INTEREST = ("'0630- Bank Interest & Charges', '0630-Bank Interest & Charges', '0633-Interest-Loan', "
            "'0633-Interest on Loan'")
UNIT_COLUMNS = f"zid:i name:s {YEAR_COLUMNS}"
PARTNER_MONTHS = "xyear:i xper:i amount:d"
IN_PROJECT = f"l.xproj = '{P.project}'"
MASTER = "SELECT zid, xacc, xacctype, xdesc, xhrc1, xhrc2, xhrc3, xhrc4 FROM glmst WHERE xacctype NOT IN "
SUM_COLUMNS = "zid:i xacc:s year:i amount:d"

_report_parts = [
    (1, "income", rows("inc", INCOME_NAMES)),
    (2, "balance", rows("bal", BALANCE_NAMES) + " UNION ALL " + headings(
        ["01-1-Assets", "01-2-Current Assets", "04-3-Non-Current Assets", "07-3-Current Liabilities",
         "11-4-Non-Current Liabilities"])),
    (3, "cash flow", rows("cash_flow", DETAILED) + " UNION ALL " + _extra),
    (4, "ratios", "SELECT zid, year, ratio AS line, -amount AS amount FROM r"),
]
_all_parts = " UNION ALL ".join(
    f"SELECT zid, {i} AS part_no, '{name}' AS part, line, year, CAST(amount AS DECIMAL(30,9)) AS amount FROM ({sql})"
    for i, name, sql in _report_parts)
STATEMENT_REPORT = f"""WITH {CASH_FLOW_BASE}, both_sides AS (SELECT inc.*, bal.* EXCLUDE (zid, year) FROM inc
        JOIN bal ON bal.zid = inc.zid AND bal.year = inc.year), r AS ({_ratio_rows}), every AS ({_all_parts})
    SELECT zid, part_no, part, line, {', '.join(
        f"round(coalesce(-max(amount) FILTER (WHERE year = {y}), 0), 3) AS y{y}" for y in YEARS)}
    FROM every GROUP BY 1, 2, 3, 4"""

QUERIES = {
    "statement_report": (STATEMENT_REPORT, f"zid:i part_no:i part:s line:s {YEAR_COLUMNS}"),
    "cash_vouchers_activity": (CASH, "zid:i xacc:s xyear:i xper:i amount:d"),
    "monthly_cash_flow": (CASH_FLOW, f"zid:i xacc:s xdesc:s xhrc3:s xacctype:s {month_columns(P.months)}"),
    "monthly_pl": (MONTHLY_PL, f"zid:i xacc:s xdesc:s xacctype:s {month_columns(P.pl_months)}"),
    "monthly_payables": (partners("casup", "xsup", ["xshort"], "xshort", "Monthly Payable"),
                         f"zid:i xsub:s xshort:s {PARTNER_MONTHS}"),
    "monthly_receivables": (
        partners("cacus", "xcus", ["xshort", "xadd2", "xcity", "xstate"], "xstate", "Monthly Receivable"),
        f"zid:i xsub:s xshort:s xadd2:s xcity:s xstate:s {PARTNER_MONTHS}"),
    "monthly_inventory_value": (STOCK_VALUE, f"zid:i xgitem:s {PARTNER_MONTHS}"),
    "gl_master": (MASTER + "('Asset', 'Liability')", ACCOUNT_COLUMNS),
    "gl_master_balance": (MASTER + "('Income', 'Expenditure')", ACCOUNT_COLUMNS),
    "gl_activity": (activity(), SUM_COLUMNS),
    "gl_position": (position(), SUM_COLUMNS),
    "gl_position_of_year": (position("year"), SUM_COLUMNS),
    "comparative_pl": (PL, CMP_COLUMNS),
    "comparative_bs": (BS, CMP_COLUMNS),
    "comparative_project": (comparative("pl", activity(IN_PROJECT)), CMP_COLUMNS),
    "comparative_project_bs": (comparative("bs", position(project=IN_PROJECT)), CMP_COLUMNS),
    "level_summary": (level(PL, "xhrc2", "Profit/Loss"), STATEMENT_COLUMNS),
    "level_summary_class": (level(PL, "xacctype", "Profit/Loss"), STATEMENT_COLUMNS),
    "level_summary_balance": (level(BS, "xhrc4", "Balance"), STATEMENT_COLUMNS),
    "income_statement": (
        f"WITH {STATEMENTS}, rep AS ({rows('inc', INCOME_NAMES)}) SELECT zid, line, {wide_years} FROM rep GROUP BY 1, 2",
        STATEMENT_COLUMNS),
    "balance_sheet": (
        f"""WITH {STATEMENTS}, rep AS ({rows('bal', BALANCE_NAMES)} UNION ALL
            {headings(['01-1-Assets', '01-2-Current Assets', '04-3-Non-Current Assets', '07-3-Current Liabilities',
                       '11-4-Non-Current Liabilities'])})
            SELECT zid, line, {wide_years} FROM rep GROUP BY 1, 2""",
        STATEMENT_COLUMNS),
    "cash_flow_statement": (cash_flow(DETAILED), STATEMENT_COLUMNS),
    "cash_flow_statement_grouped": (cash_flow(GROUPED), STATEMENT_COLUMNS),
    "financial_ratios": (
        f"""WITH {STATEMENTS}, both_sides AS (SELECT inc.*, bal.* EXCLUDE (zid, year) FROM inc
            JOIN bal ON bal.zid = inc.zid AND bal.year = inc.year), r AS ({_ratio_rows})
            SELECT zid, ratio_no, ratio, {wide_years} FROM r GROUP BY 1, 2, 3""",
        f"zid:i ratio_no:i ratio:s {YEAR_COLUMNS}"),
    "tenant_income": (units("p.xacctype = 'Income'"), UNIT_COLUMNS),
    "tenant_cogs": (units("p.xacc = c.cogs_account"), UNIT_COLUMNS),
    "tenant_expense": (units("p.xacctype = 'Expenditure' AND p.xacc <> c.cogs_account"), UNIT_COLUMNS),
    "tenant_profit": (units("TRUE"), UNIT_COLUMNS),
    "tenant_ebitda": (units(f"p.xhrc2 NOT IN ({TAX}, {INTEREST}, '0636-Depreciation')"), UNIT_COLUMNS),
    "tenant_tax": (units(f"p.xhrc2 IN ({TAX})"), UNIT_COLUMNS),
    "tenant_interest": (units(f"p.xhrc2 IN ({INTEREST})"), UNIT_COLUMNS),
}

for _kept, _anew in {"monthly_inventory_value_periods": "monthly_inventory_value", "gl_position_periods": "gl_position"}.items():
    QUERIES[_kept] = QUERIES[_anew]
