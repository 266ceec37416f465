"""Statement labels, subtotals, cash flow rows and ratios as data."""

from __future__ import annotations

# Income statement line of each account group.
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
}

# Balance sheet line of each account group.
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

# Names of the statement lines.
REVENUE = "01-1-Revenue"
COST = "02-1-Cost of Revenue"
GROSS = "02-2-Gross Profit"
OFFICE = "03-1-Office & Administrative Expenses"
SELLING = "04-1-Sales & Distribution Expenses"
DEPRECIATION = "05-1-Depreciation/Amortization"
UNUSUAL = "06-1-Unusual Expenses (Income)"
OPERATING = "07-1-Other Operating Expenses, Total"
EBIT = "07-2-EBIT"
INTEREST = "08-1-Interest Expense"
EBT = "08-2-EBT"
TAX = "09-1-Income Tax & VAT"
NET_INCOME = "10-1-Net Income"

CASH = "01-3-Cash"
RECEIVABLE = "02-1-Accounts Receivable"
INVENTORY = "03-1-Inventories"
PREPAID = "04-1-Prepaid Expenses"
CURRENT_ASSETS = "04-2-Total Current Assets"
OTHER_ASSETS = "05-1-Other Assets"
PLANT = "06-1-Property, Plant & Equipment"
GOODWILL = "07-1-Goodwill & Intangible Asset"
FIXED_ASSETS = "07-2-Total Non-Current Assets"
PAYABLE = "08-1-Accounts Payable"
ACCRUED = "09-1-Accrued Liabilities"
SHORT_TERM = "10-1-Other Short Term Liabilities"
DEBT = "11-1-Debt"
CURRENT_LIABILITIES = "11-2-Total Current Liabilities"
LONG_TERM = "12-1-Other Long Term Liabilities"
LONG_LIABILITIES = "12-2-Total Non-Current Liabilities"
EQUITY = "13-1-Total Shareholders Equity"
RETAINED = "13-2-Retained Earnings"
CHECK = "13-3-Balance Check"

_TO_EBIT = [EBIT, EBT]

# Subtotals that each income line enters.  Discounts and tax reach net income
# only, which is the sum of all accounts, labelled or not.
INCOME_SUBTOTALS = {
    REVENUE: [GROSS, *_TO_EBIT],
    COST: [GROSS, *_TO_EBIT],
    OFFICE: _TO_EBIT,
    SELLING: _TO_EBIT,
    DEPRECIATION: _TO_EBIT,
    UNUSUAL: _TO_EBIT,
    OPERATING: _TO_EBIT,
    INTEREST: [EBT],
}

BALANCE_SUBTOTALS = {
    CASH: [CURRENT_ASSETS, CHECK],
    RECEIVABLE: [CURRENT_ASSETS, CHECK],
    INVENTORY: [CURRENT_ASSETS, CHECK],
    PREPAID: [CURRENT_ASSETS, CHECK],
    OTHER_ASSETS: [FIXED_ASSETS, CHECK],
    PLANT: [FIXED_ASSETS, CHECK],
    GOODWILL: [FIXED_ASSETS, CHECK],
    PAYABLE: [CURRENT_LIABILITIES, CHECK],
    ACCRUED: [CURRENT_LIABILITIES, CHECK],
    SHORT_TERM: [CURRENT_LIABILITIES, CHECK],
    DEBT: [CURRENT_LIABILITIES, CHECK],
    LONG_TERM: [LONG_LIABILITIES, CHECK],
    EQUITY: [CHECK],
}

INCOME_LINES = sorted({*INCOME_LABELS.values(), GROSS, EBIT, EBT, NET_INCOME})
BALANCE_LINES = sorted({*BALANCE_LABELS.values(), CURRENT_ASSETS, FIXED_ASSETS,
                        CURRENT_LIABILITIES, LONG_LIABILITIES, RETAINED, CHECK})

# Heading rows of the statements; they have no amounts.
BALANCE_HEADINGS = [
    "01-1-Assets",
    "01-2-Current Assets",
    "04-3-Non-Current Assets",
    "07-3-Current Liabilities",
    "11-4-Non-Current Liabilities",
]
CASH_FLOW_HEADINGS = ["01-Operating Activities", "08", "09-Investing Cashflow", "13",
                      "14-Financing Cashflow", "19"]

# Totals of the cash flow statement.
OPERATING_TOTAL = "07-Total Operating Cashflow"
INVESTING_TOTAL = "12-Total Investing Cashflow"
FINANCING_TOTAL = "18-Total Financing Cashflow"
OPENING_CASH = "20-Year Opening Cash"
CHANGE = "21-Change in Cash"
ENDING_CASH = "22-Year Ending Cash"

# Rows without a source stay 0.
CASH_FLOW_ZERO = ["06-Other operating cash flow adjustments", "11-Other investing cash flows"]

# Row that shows each change of a balance line, by layout; the total it belongs to follows.
CASH_FLOW_ROWS = {
    "detailed": {
        RECEIVABLE: ("04-1-Accounts Receivable", OPERATING_TOTAL),
        INVENTORY: ("04-2-Inventories", OPERATING_TOTAL),
        PREPAID: ("04-3-Prepaid Expenses", OPERATING_TOTAL),
        PAYABLE: ("05-1-Accounts Payable", OPERATING_TOTAL),
        ACCRUED: ("05-2-Accrued Liabilities", OPERATING_TOTAL),
        SHORT_TERM: ("05-3-Other Short Term Liabilities", OPERATING_TOTAL),
        FIXED_ASSETS: ("10-Capital asset acquisitions/disposal", INVESTING_TOTAL),
        DEBT: ("15-Increase/Decrease in Debt", FINANCING_TOTAL),
        EQUITY: ("16-Increase/Decrease in Equity", FINANCING_TOTAL),
        RETAINED: ("16-1-Increase/Decrease in Retained Earning", FINANCING_TOTAL),
        LONG_LIABILITIES: ("17-Other financing cash flows", FINANCING_TOTAL),
    },
    "grouped": {
        RECEIVABLE: ("04-Increase/Decrease in Current Asset", OPERATING_TOTAL),
        INVENTORY: ("04-Increase/Decrease in Current Asset", OPERATING_TOTAL),
        PREPAID: ("04-Increase/Decrease in Current Asset", OPERATING_TOTAL),
        PAYABLE: ("05-Increase/Decrease in Current Liabilities", OPERATING_TOTAL),
        ACCRUED: ("05-Increase/Decrease in Current Liabilities", OPERATING_TOTAL),
        SHORT_TERM: ("05-Increase/Decrease in Current Liabilities", OPERATING_TOTAL),
        FIXED_ASSETS: ("10-Capital asset acquisitions/disposal", INVESTING_TOTAL),
        DEBT: ("15-Increase/Decrease in Debt", FINANCING_TOTAL),
        EQUITY: ("16-Increase/Decrease in Equity", FINANCING_TOTAL),
        RETAINED: ("16-Increase/Decrease in Equity", FINANCING_TOTAL),
        LONG_LIABILITIES: ("17-Other financing cash flows", FINANCING_TOTAL),
    },
}

DAYS = 365
ASSETS = [CURRENT_ASSETS, FIXED_ASSETS]
LIABILITIES = [CURRENT_LIABILITIES, LONG_LIABILITIES]
ALL_DEBT = [DEBT, SHORT_TERM, LONG_TERM]
MINUS_DEBT = ["-" + line for line in ALL_DEBT]

# Ratios as name, factor, lines added in the numerator, lines added in the
# denominator.  A leading "-" subtracts a line.
RATIOS = [
    ("COGS Ratio", 100, [COST], [REVENUE]),
    ("Gross Profit Ratio", 100, [GROSS], [REVENUE]),
    ("Operating Profit", 100, [EBIT], [REVENUE]),
    ("Net Profit Ratio", 100, [NET_INCOME], [REVENUE]),
    ("Tax Coverage", 100, [TAX], [EBT]),
    ("Interest Coverage", 100, [INTEREST], [EBIT]),
    ("OAE Ratio", 100, [OFFICE], [REVENUE]),
    ("S&D Ratio", 100, [SELLING], [REVENUE]),
    ("Depreciation Ratio", 100, [DEPRECIATION], [REVENUE]),
    ("Unusual Expense Ratio", 100, [UNUSUAL], [REVENUE]),
    ("Other Operating Ratio", 100, [OPERATING], [REVENUE]),
    ("Interest Ratio", 100, [INTEREST], [REVENUE]),
    ("Tax Ratio", 100, [TAX], [REVENUE]),
    ("Quick Ratio", 1, [CURRENT_ASSETS], [CURRENT_LIABILITIES]),
    ("Current Ratio", 1, [CURRENT_ASSETS], [CURRENT_LIABILITIES]),
    ("Total Asset Turnover Ratio", 1, [REVENUE], ASSETS),
    ("Net Asset Turnover Ratio", 1, [REVENUE], ASSETS + LIABILITIES),
    ("Inventory Turnover", 1, [COST], [INVENTORY]),
    ("Inventory Days", DAYS, [INVENTORY], [COST]),
    ("Accounts Receivable Turnover", 1, [REVENUE], [RECEIVABLE]),
    ("Accounts Receivable Days", DAYS, [RECEIVABLE], [REVENUE]),
    ("Accounts Payable Turnover", 1, [COST], [PAYABLE]),
    ("Accounts Payable Days", DAYS, [PAYABLE], [COST]),
    ("PP&E Ratio", 1, [PLANT], [REVENUE]),
    ("Working Capital Turnover", 1, [REVENUE], [RECEIVABLE, INVENTORY, PAYABLE]),
    ("Cash Turnover", 1, [REVENUE], [CASH]),
    ("Debt/Equity", 1, ALL_DEBT, [EQUITY]),
    ("Debt/Capital", 1, ALL_DEBT, [EQUITY, *MINUS_DEBT]),
    ("Debt/TNW", 1, ALL_DEBT, [FIXED_ASSETS, "-" + GOODWILL]),
    ("Total Liabilities/Equity", 1, LIABILITIES, [EQUITY, *MINUS_DEBT]),
    ("Total Assets to Equity", 1, ASSETS, [EQUITY]),
    ("Debt/EBITDA", 1, ALL_DEBT, [EBIT, DEPRECIATION]),
    ("Capital Structure Impact", 1, [EBT], [EBIT]),
    ("Acid Test", 1, [CURRENT_ASSETS, "-" + INVENTORY], [CURRENT_LIABILITIES]),
    ("ROE", 1, [NET_INCOME], [EQUITY]),
    ("ROA", 1, [NET_INCOME], ASSETS),
]

# Account groups at hierarchy level 2 that the unit summaries single out.
TAX_GROUPS = [
    "0604-City Corporation Tax",
    "0625-Property Tax & Others",
    "0629-VAT & Tax Expenses",
]
INTEREST_GROUPS = [
    "0630- Bank Interest & Charges",
    "0630-Bank Interest & Charges",
    "0633-Interest-Loan",
    "0633-Interest on Loan",
]
DEPRECIATION_GROUPS = ["0636-Depreciation"]

_KINDS = {g: kind for kind, groups in (("tax", TAX_GROUPS), ("interest", INTEREST_GROUPS),
                                       ("depreciation", DEPRECIATION_GROUPS)) for g in groups}

# Rows of the table account_group, (side, group, line, kind), for books with these groups only.
# Books with groups of their own bring a table of their own.
DEFAULT_GROUPS = [
    *[("pl", g, INCOME_LABELS.get(g), _KINDS.get(g)) for g in [*INCOME_LABELS, *[k for k in _KINDS if k not in INCOME_LABELS]]],
    *[("bs", g, line, None) for g, line in BALANCE_LABELS.items()],
]
