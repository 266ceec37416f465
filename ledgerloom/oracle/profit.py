"""SQL of the profit reports; document lines are joined pair by pair here."""

from ledgerloom.oracle.stock import AS_OF
from ledgerloom.plans.params import DEFAULT as P

A, B = (f"DATE '{d}'" for d in P.profit_window)
FIRST = "DATE '1995-01-01'"


def pairs(lines: str, doc: str, amounts: str, headers: str, header: str, text: str, a: str, b: str) -> str:
    """Movements joined with document lines, then with header and item."""
    return f"""SELECT p.*, c.xdesc, c.xgitem FROM (WITH paired AS MATERIALIZED (
            SELECT i.zid, i.xdocnum, i.xitem, i.xqty * i.xsign AS qty, i.xval * i.xsign AS totalvalue, {amounts}
            FROM (SELECT * FROM imtrn WHERE contains(xdocnum, '{text}') AND xdate BETWEEN {a} AND {b}) i
            JOIN {lines} d ON d.zid = i.zid AND d.{doc} = i.xdocnum AND d.xitem = i.xitem) SELECT * FROM paired) p
        JOIN caitem c ON c.zid = p.zid AND c.xitem = p.xitem
        JOIN {headers} o ON o.zid = p.zid AND o.{header} = p.xdocnum"""


def sales(a: str, b: str) -> str:
    return pairs("opodt", "xordernum", "d.xlineamt, d.xdtwotax - d.xdtdisc AS xdtwotax", "opord", "xordernum",
                 "CO--", a, b)


def transfers(a: str, b: str) -> str:
    return pairs("imtdt", "ximtor", "d.xdtwotax AS xlineamt", "imtor", "ximtor", "TO--", a, b)


def returns(a: str, b: str) -> str:
    return f"""SELECT i.zid, i.xitem, sum(d.xrate * i.xqty) AS totamt
        FROM imtrn i JOIN imtemptdt d ON d.zid = i.zid AND d.ximtrnnum = i.xdocnum AND d.xitem = i.xitem
        JOIN imtemptrn h ON h.zid = i.zid AND h.ximtmptrn = i.xdocnum
        WHERE contains(i.xdocnum, 'SRE-') AND i.xdate BETWEEN {a} AND {b} GROUP BY 1, 2"""


ITEMS = f"""SELECT s.zid, s.xitem, s.xdesc, s.xgitem, s.totalvalue, s.xlineamt - coalesce(r.totamt, 0) AS final_sales,
    s.xlineamt - coalesce(r.totamt, 0) + s.totalvalue AS gross_profit
    FROM (SELECT zid, xitem, xdesc, xgitem, round(sum(totalvalue), 1) AS totalvalue, round(sum(xlineamt), 1) AS xlineamt
          FROM (SELECT zid, xitem, xdesc, xgitem, totalvalue, xlineamt FROM ({sales(A, B)}) WHERE zid <> 100002
                UNION ALL SELECT zid, xitem, xdesc, xgitem, totalvalue, xlineamt FROM ({transfers(A, B)}) WHERE zid = 100002)
          GROUP BY 1, 2, 3, 4) s
    LEFT JOIN (SELECT zid, xitem, round(totamt, 1) AS totamt FROM ({returns(A, B)})) r ON r.zid = s.zid AND r.xitem = s.xitem"""

LEDGER = f"""SELECT d.zid, g.xacctype, sum(d.xprime) AS amount FROM gldetail d
    JOIN glheader h ON h.zid = d.zid AND h.xvoucher = d.xvoucher
    JOIN glmst g ON g.zid = d.zid AND g.xacc = d.xacc JOIN tenant_config c ON c.zid = d.zid
    WHERE g.xacctype IN ('Income', 'Expenditure') AND g.xacc <> c.cogs_account AND h.xdate BETWEEN {A} AND {B}
    GROUP BY 1, 2"""

_sums = "sum(totalvalue) AS totalvalue, sum(final_sales) AS final_sales, sum(gross_profit) AS gross_profit"

QUERIES = {
    "sales_cogs": (
        f"""SELECT zid, xdocnum, xitem, count(*) AS n_pairs, sum(qty) AS qty, sum(totalvalue) AS totalvalue,
            sum(xlineamt) AS xlineamt, sum(xdtwotax) AS xdtwotax FROM ({sales(FIRST, AS_OF)}) GROUP BY 1, 2, 3""",
        "zid:i xdocnum:s xitem:s n_pairs:i qty:d totalvalue:d xlineamt:d xdtwotax:d"),
    "transfer_cogs": (
        f"""SELECT zid, xdocnum, xitem, count(*) AS n_pairs, sum(qty) AS qty, sum(totalvalue) AS totalvalue,
            sum(xlineamt) AS xlineamt FROM ({transfers(FIRST, AS_OF)}) GROUP BY 1, 2, 3""",
        "zid:i xdocnum:s xitem:s n_pairs:i qty:d totalvalue:d xlineamt:d"),
    "sales_returns": (returns(FIRST, AS_OF), "zid:i xitem:s totamt:d"),
    "item_profit": (
        f"""SELECT zid, xitem, xdesc, xgitem, totalvalue, final_sales, gross_profit FROM ({ITEMS})
            UNION ALL SELECT zid, NULL, 'Total_Item_Profit', NULL, {_sums} FROM ({ITEMS}) GROUP BY 1""",
        "zid:i xitem:s xdesc:s xgitem:s totalvalue:d final_sales:d gross_profit:d"),
    "gl_income_expenditure": (LEDGER, "zid:i xacctype:s amount:d"),
    "business_profit_summary": (
        f"""SELECT t.zid, t.name, round(coalesce(i.totalvalue, 0), 1) AS totalvalue,
            round(coalesce(i.final_sales, 0), 1) AS final_sales, round(coalesce(i.gross_profit, 0), 1) AS gross_profit, round(coalesce(a.amount, 0), 1) AS income_gl,
            round(coalesce(e.amount, 0), 1) AS expenditure_gl, round(coalesce(i.gross_profit, 0) - coalesce(e.amount, 0), 1) AS net
            FROM tenant t LEFT JOIN (SELECT zid, {_sums} FROM ({ITEMS}) GROUP BY 1) i ON i.zid = t.zid
            LEFT JOIN (SELECT * FROM ({LEDGER}) WHERE xacctype = 'Income') a ON a.zid = t.zid
            LEFT JOIN (SELECT * FROM ({LEDGER}) WHERE xacctype = 'Expenditure') e ON e.zid = t.zid""",
        "zid:i name:s totalvalue:d final_sales:d gross_profit:d income_gl:d expenditure_gl:d net:d"),
    "group_profit_ratio": (
        f"""SELECT *, CAST(gross_profit * -100 AS DOUBLE) / CAST(nullif(totalvalue, 0) AS DOUBLE) AS profit_ratio
            FROM (SELECT zid, xgitem, {_sums} FROM ({ITEMS}) GROUP BY 1, 2)""",
        "zid:i xgitem:s totalvalue:d final_sales:d gross_profit:d profit_ratio:d"),
}
