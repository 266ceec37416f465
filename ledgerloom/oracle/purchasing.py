"""SQL of the purchasing, supplier and shipment reports."""

from datetime import timedelta

from ledgerloom.oracle.stock import AS_OF, YEAR_AGO, balance, halves_away, newest, rate
from ledgerloom.oracle.views import code
from ledgerloom.plans.params import DEFAULT as P

LINE_SKU = code("'IT-'", "l.l_partkey", 6)
CHECK = f"DATE '{P.check_day}'"
CHECK_EVE = f"DATE '{P.check_day - timedelta(days=1)}'"
MONTH_AGO = f"DATE '{P.back(30)}'"
TWO_MONTHS_AGO = f"DATE '{P.back(60)}'"


def received(test: str) -> str:
    return f"""SELECT d.zid, g.xgrnnum, g.xdate, d.xitem, d.xqtyord, d.xrate
        FROM poord o JOIN poodt d ON d.zid = o.zid AND d.xpornum = o.xpornum
        JOIN pogrn g ON g.zid = o.zid AND g.xpornum = o.xpornum
        WHERE o.zid = 100002 AND o.xpornum LIKE 'IP--%' AND o.xstatuspor = '5-Received' AND o.xdate {test} {YEAR_AGO}"""


ITEMS = f"SELECT DISTINCT zid, xgrnnum, xdate, xitem FROM ({received('>')})"


def moved_since(zid: int, prefix: str, sign: int) -> str:
    """Movements of one type since the receipt, by a plain range join."""
    return f"""(SELECT r.xitem, r.xdate, sum(i.xqty * i.xsign * {sign}) AS q FROM received_days r
        JOIN imtrn i ON i.xitem = r.xitem AND i.xdate >= r.xdate
        WHERE i.zid = {zid} AND i.xdocnum LIKE '{prefix}%' AND i.xdate <= {AS_OF} GROUP BY 1, 2)"""


def ordered_since(zid: int) -> str:
    return f"""(SELECT r.xitem, r.xdate, sum(d.xqtyord) AS q FROM received_days r
        JOIN poodt d ON d.xitem = r.xitem JOIN poord o ON o.zid = d.zid AND o.xpornum = d.xpornum AND o.xdate >= r.xdate
        JOIN pogrn g ON g.zid = o.zid AND g.xpornum = o.xpornum
        WHERE d.zid = {zid} AND o.xdate <= {AS_OF} GROUP BY 1, 2)"""


def stock_of(zid: int) -> str:
    return f"(SELECT xitem, sum(xqty * xsign) AS q FROM imtrn WHERE zid = {zid} AND xdate <= {AS_OF} GROUP BY 1)"


SINCE = {
    "transfer": moved_since(100002, "TO--", -1),
    "creturn": moved_since(100002, "SRE-", 1),
    "greturn": moved_since(100001, "SRE-", 1),
    "ereturn": moved_since(100003, "SRE-", 1),
    "gpreturn": moved_since(100001, "PRE-", -1),
    "epreturn": moved_since(100003, "PRE-", -1),
    "gsales": moved_since(100001, "CO--", -1),
    "esales": moved_since(100003, "CO--", -1),
    "gpurchase": ordered_since(100001),
    "epurchase": ordered_since(100003),
}
STOCKS = {"cstock": stock_of(100002), "gstock": stock_of(100001), "estock": stock_of(100003)}

_measures = ", ".join(f"coalesce({n}.q, 0) AS {n}" for n in [*SINCE, *STOCKS])
_joins = " ".join(
    [f"LEFT JOIN {sql} {n} ON {n}.xitem = l.xitem AND {n}.xdate = l.xdate" for n, sql in SINCE.items()]
    + [f"LEFT JOIN {sql} {n} ON {n}.xitem = l.xitem" for n, sql in STOCKS.items()]
    + [f"LEFT JOIN caitem {p} ON {p}.xitem = l.xitem AND {p}.zid = {z}"
       for p, z in (("cp", 100002), ("gp", 100001), ("ep", 100003))])

TRACKING = f"""WITH po_lines AS ({received('>')}),
    received_days AS (SELECT DISTINCT xitem, xdate FROM po_lines),
    base AS (SELECT l.xgrnnum, l.xdate AS cpdate, l.xitem, l.xqtyord AS cpqty, l.xrate AS cprate, cp.xdesc, cp.xgitem,
        coalesce(cp.xstdprice, 0) AS cprice, coalesce(gp.xstdprice, 0) AS gprice, coalesce(ep.xstdprice, 0) AS eprice,
        {_measures} FROM po_lines l {_joins}),
    margins AS (SELECT *, CAST((gprice - cprice) * 100 AS DOUBLE) / CAST(nullif(cprate, 0) AS DOUBLE) AS price_check,
        gprice - eprice AS store_price_check, cpqty - transfer - cstock + creturn AS central_check,
        gpurchase - gpreturn - gsales + greturn - gstock AS store_check,
        epurchase - epreturn - esales + ereturn - estock AS ecommerce_check,
        (cprice - cprate) * cpqty AS total_cpgp, (gprice - cprice) * cpqty AS total_rgp,
        (cprice - cprate) * transfer AS total_cgp, (gprice - cprice) * gsales AS total_ggp,
        (eprice - cprice) * esales AS total_egp FROM base)
    SELECT *, total_cpgp + total_rgp AS total_pgp, total_cgp + total_ggp + total_egp AS total_gp,
        CAST((total_cgp + total_ggp + total_egp) * 100 AS DOUBLE) / CAST(nullif(total_cpgp + total_rgp, 0) AS DOUBLE) AS gp_percent
    FROM margins"""

_numbers = [*SINCE, *STOCKS, "cprice", "gprice", "eprice", "price_check", "store_price_check", "central_check",
            "store_check", "ecommerce_check", "total_cpgp", "total_rgp", "total_cgp", "total_ggp", "total_egp",
            "total_pgp", "total_gp", "gp_percent"]
TRACKING_COLUMNS = ("xgrnnum:s cpdate:t xitem:s cpqty:d cprate:d xdesc:s xgitem:s "
                    + " ".join(f"{n}:d" for n in _numbers))

ERRORS = " UNION ALL ".join(
    f"SELECT xgrnnum, xitem, cpdate, cpqty, cprate, '{n}' AS check_name, {n} AS residual FROM tracked WHERE {n} <> 0"
    for n in ("store_price_check", "central_check", "store_check", "ecommerce_check"))

SUMMARY = " UNION ALL ".join(
    f"SELECT xgrnnum, '{subject}' AS subject, CAST({value} AS DOUBLE) AS result FROM tracked GROUP BY xgrnnum"
    for subject, value in [
        ("Total Possible Gross Profit", "round(sum(total_pgp), 2)"),
        ("Running Gross Profit", "round(sum(total_gp), 2)"),
        ("% of Gross Profit",
         "coalesce(CAST(sum(total_gp) * 100 AS DOUBLE) / CAST(nullif(sum(total_pgp), 0) AS DOUBLE), 0)"),
        ("Total Possible Gross Profit Central", "round(sum(total_cpgp), 2)"),
        ("Central Running Gross Profit", "round(sum(total_cgp), 2)"),
        ("Total Possible Retail Gross Profit", "round(sum(total_rgp), 2)"),
        ("Store Running Gross Profit", "round(sum(total_ggp), 2)"),
        ("E-commerce Running Gross Profit", "round(sum(total_egp), 2)"),
        ("Retail Running Gross Profit", "round(sum(total_ggp) + sum(total_egp), 2)"),
    ])

PROFILE = f"""SELECT c.xitem, c.xdesc, c.xgitem, s.xsup, coalesce(b.inventory, 0) AS central_stock,
    l.xdate AS last_purchase_date, coalesce(l.xqty, 0) AS last_purchase_qty, coalesce({rate('l.xval', 'l.xqty')}, 0) AS purchase_rate
    FROM (SELECT * FROM caitem WHERE zid = 100002) c
    LEFT JOIN (SELECT * FROM ({balance()}) WHERE zid = 100002) b ON b.xitem = c.xitem
    LEFT JOIN (SELECT * FROM ({newest("xdocnum LIKE 'GRN-%' AND zid = 100002")})) l ON l.xitem = c.xitem
    LEFT JOIN (SELECT DISTINCT d.xitem, g.xsup FROM pogdt d JOIN pogrn g ON g.zid = d.zid AND g.xgrnnum = d.xgrnnum
               WHERE d.zid = 100002) s ON s.xitem = c.xitem"""
PROFILE_COLUMNS = ("xitem:s xdesc:s xgitem:s xsup:s central_stock:d last_purchase_date:t "
                   "last_purchase_qty:d purchase_rate:d")


def with_store(test: str, since: str, extra: str) -> str:
    return f"""SELECT p.*, coalesce(b.inventory, 0) AS store_stock, coalesce(b.xstdprice, 0) AS sales_price,
        coalesce(q.sold, 0) AS store_sale, p.central_stock + coalesce(b.inventory, 0) AS total_stock, {extra}
        FROM ({PROFILE}) p
        LEFT JOIN (SELECT * FROM ({balance()}) WHERE zid = 100001) b ON b.xitem = p.xitem
        LEFT JOIN (SELECT xitem, sum(xqty * xsign) AS sold FROM imtrn WHERE zid = 100001
                   AND starts_with(xdocnum, 'CO-') AND xdate > {since} GROUP BY 1) q ON q.xitem = p.xitem
        WHERE p.xsup {test} (SELECT xsup FROM credit_suppliers)"""


CREDIT = with_store("IN", TWO_MONTHS_AGO,
                    "(SELECT max(g.xdate) FROM pogrn g WHERE g.zid = 100002 AND g.xsup = p.xsup) AS last_supplier_date")
REST = with_store("NOT IN", MONTH_AGO, f"{MONTH_AGO} AS sales_since")
STORE_COLUMNS = PROFILE_COLUMNS + " store_stock:d sales_price:d store_sale:d total_stock:d"


def financials(detail: str, extra: str = "") -> str:
    return f"""SELECT *, total_sales - inventory_sale_value AS difference FROM (
        SELECT xsup, round(sum(CAST(total_stock AS DECIMAL(16,2)) * CAST(purchase_rate AS DECIMAL(21,10))), 2) AS inventory_purchase_value,
        round(sum(total_stock * sales_price), 2) AS inventory_sale_value,
        round(sum(-store_sale * sales_price), 2) AS total_sales {extra} FROM ({detail}) GROUP BY 1)"""


VALUE_COLUMNS = "xsup:s inventory_purchase_value:d inventory_sale_value:d total_sales:d difference:d"

_mean_rate = f"""CAST({halves_away("sum(CAST(line_rate * 10000000000 AS HUGEINT))", "count(line_rate)")}
    AS DECIMAL(28,0)) * CAST(0.0000000001 AS DECIMAL(10,10))"""


def sales_of_purchase(unit: str) -> str:
    return f"""WITH rated AS (SELECT *, {rate('xval', 'xqty')} AS line_rate FROM imtrn),
        bought AS (SELECT zid, xitem, xdate, sum(xqty * xsign) AS purchase_qty, {_mean_rate} AS purchase_rate
            FROM rated WHERE xdocnum LIKE 'GRN-%' AND xdate > {MONTH_AGO} AND {unit} GROUP BY 1, 2, 3),
        detail AS (SELECT b.*, c.xdesc, c.xgitem, c.xstdprice AS sales_rate,
            CAST(b.purchase_qty AS DECIMAL(16,2)) * CAST(b.purchase_rate AS DECIMAL(21,10)) AS purchase_value,
            (SELECT sum(i.xqty * i.xsign) FROM imtrn i WHERE i.zid = b.zid AND i.xitem = b.xitem) AS stock,
            coalesce((SELECT sum(i.xqty * i.xsign) FROM imtrn i WHERE i.zid = b.zid AND i.xitem = b.xitem
                      AND i.xdocnum LIKE 'CO-%' AND i.xdate > {MONTH_AGO}), 0) AS sales_qty
            FROM bought b JOIN caitem c ON c.zid = b.zid AND c.xitem = b.xitem),
        valued AS (SELECT *, -sales_qty * sales_rate AS sales_value FROM detail),
        sold AS (SELECT zid, sum(sales_value) AS sales_total FROM (SELECT DISTINCT zid, xitem, sales_value FROM valued) GROUP BY 1),
        paid AS (SELECT zid, sum(purchase_value) AS purchase_total FROM valued GROUP BY 1)
        SELECT v.*, p.purchase_total, s.sales_total FROM valued v JOIN paid p ON p.zid = v.zid JOIN sold s ON s.zid = v.zid"""


RECEIPTS = f"""SELECT g.zid, g.xdate, g.xgrnnum, d.xitem, c.xdesc, d.xqty AS today_grn_qty
    FROM pogrn g JOIN pogdt d ON d.zid = g.zid AND d.xgrnnum = g.xgrnnum
    JOIN caitem c ON c.zid = d.zid AND c.xitem = d.xitem WHERE g.xdate = {CHECK}"""
SOLD_TODAY = f"""SELECT d.zid, d.xitem, sum(d.xqtyord) AS today_sales_qty FROM opord o
    JOIN opodt d ON d.zid = o.zid AND d.xordernum = o.xordernum WHERE o.xdate = {CHECK} GROUP BY 1, 2"""
RECEIPT_COLUMNS = "zid:i xdate:t xgrnnum:s xitem:s xdesc:s today_grn_qty:d"


def closing(day: str) -> str:
    return f"(SELECT zid, xitem, sum(xqty * xsign) AS q FROM imtrn WHERE xdate <= {day} GROUP BY 1, 2)"


QUERIES = {
    "purchase_receipts": (received(">="), "zid:i xgrnnum:s xdate:t xitem:s xqtyord:d xrate:d"),
    "purchase_summary": (
        f"""SELECT d.zid, d.xitem, sum(d.xqtyord) AS ordered_qty,
            CAST(sum(d.xrate) AS DOUBLE) / count(*) AS mean_rate
            FROM poord o JOIN poodt d ON d.zid = o.zid AND d.xpornum = o.xpornum
            JOIN pogrn g ON g.zid = o.zid AND g.xpornum = o.xpornum
            WHERE o.xdate >= {YEAR_AGO} AND d.xitem IN (SELECT xitem FROM ({ITEMS})) GROUP BY 1, 2""",
        "zid:i xitem:s ordered_qty:d mean_rate:d"),
    "shipment_items": (ITEMS, "zid:i xgrnnum:s xdate:t xitem:s"),
    "shipment_receipts": (
        f"SELECT zid, xgrnnum, min(xdate) AS first_date, count(*) AS n_items FROM ({ITEMS}) GROUP BY 1, 2",
        "zid:i xgrnnum:s first_date:t n_items:i"),
    "shipment_tracking": (TRACKING, TRACKING_COLUMNS),
    "shipment_errors": (f"SELECT * FROM (WITH tracked AS ({TRACKING}) {ERRORS})",
                        "xgrnnum:s xitem:s cpdate:t cpqty:d cprate:d check_name:s residual:d"),
    "shipment_summary": (f"SELECT * FROM (WITH tracked AS ({TRACKING}) {SUMMARY})",
                         "xgrnnum:s subject:s result:d"),
    "shipment_zero_stock": (f"SELECT xgrnnum, xitem, xdesc, gstock FROM ({TRACKING}) WHERE gstock <= 0",
                            "xgrnnum:s xitem:s xdesc:s gstock:d"),
    "last_supplier_for_orders": (
        f"""SELECT {LINE_SKU} AS item_code,
            w.id AS order_id, w.date_created, w.status,
            coalesce(p.xsup, 'no-order-yet') AS supplier_code, coalesce(p.xshort, 'no-order-yet') AS supplier_name,
            coalesce(p.xphone, 'no-order-yet') AS supplier_mobile, p.xdate AS last_purchase_date,
            coalesce(p.xpornum, 'no-order-yet') AS last_po_number, p.xrate AS last_purchase_price
            FROM lineitem l JOIN web_orders w ON w.id = l.l_orderkey
            LEFT JOIN (SELECT * FROM (SELECT d.xitem, o.xdate, o.xpornum, o.xsup, s.xshort, s.xphone, d.xrate,
                  row_number() OVER (PARTITION BY d.xitem ORDER BY o.xdate DESC, o.xpornum DESC, d.xrate DESC, o.xsup DESC) AS rn
                FROM poodt d JOIN poord o ON o.zid = d.zid AND o.xpornum = d.xpornum
                JOIN casup s ON s.zid = o.zid AND s.xsup = o.xsup WHERE d.zid = 100002) t WHERE rn = 1) p
            ON p.xitem = {LINE_SKU}""",
        "item_code:s order_id:i date_created:t status:s supplier_code:s supplier_name:s supplier_mobile:s "
        "last_purchase_date:t last_po_number:s last_purchase_price:d"),
    "supplier_item_profile": (PROFILE, PROFILE_COLUMNS),
    "credit_supplier_detail": (CREDIT, STORE_COLUMNS + " last_supplier_date:t"),
    "rest_supplier_detail": (REST, STORE_COLUMNS + " sales_since:t"),
    "credit_supplier_financials": (financials(CREDIT, ", max(last_supplier_date) AS purchase_date"),
                                   VALUE_COLUMNS + " purchase_date:t"),
    "rest_supplier_financials": (financials(REST), VALUE_COLUMNS),
    "supplier_last_receipt": ("SELECT zid, xsup, max(xdate) AS last_receipt FROM pogrn GROUP BY 1, 2",
                              "zid:i xsup:s last_receipt:t"),
    "sales_of_purchase": (
        sales_of_purchase("zid = 100001"),
        "zid:i xitem:s xdesc:s xgitem:s xdate:t purchase_qty:d purchase_rate:d purchase_value:d stock:d "
        "sales_qty:d sales_rate:d sales_value:d purchase_total:d sales_total:d"),
    "sales_of_purchase_summary": (
        f"""SELECT DISTINCT zid, purchase_total AS total_purchase, sales_total AS total_sales,
            CAST(sales_total * -100 AS DOUBLE) / CAST(nullif(purchase_total, 0) AS DOUBLE) AS sales_percent
            FROM ({sales_of_purchase('TRUE')})""",
        "zid:i total_purchase:d total_sales:d sales_percent:d"),
    "receipts_of_day": (RECEIPTS, RECEIPT_COLUMNS),
    "sales_qty_of_day": (SOLD_TODAY, "zid:i xitem:s today_sales_qty:d"),
    "receipt_inventory_check": (
        f"""SELECT r.*, p.q AS item_inserted_inv, p.n AS inv_rows, coalesce(s.today_sales_qty, 0) AS today_sales_qty,
            CASE WHEN t.q IS NOT NULL THEN coalesce(y.q, 0) END AS yesterday_stock, t.q AS today_stock
            FROM (SELECT zid, xdate, xgrnnum, xitem, xdesc, sum(today_grn_qty) AS today_grn_qty
                  FROM ({RECEIPTS}) GROUP BY 1, 2, 3, 4, 5) r
            LEFT JOIN ({SOLD_TODAY}) s ON s.zid = r.zid AND s.xitem = r.xitem
            LEFT JOIN {closing(CHECK_EVE)} y ON y.zid = r.zid AND y.xitem = r.xitem
            LEFT JOIN {closing(CHECK)} t ON t.zid = r.zid AND t.xitem = r.xitem
            LEFT JOIN (SELECT zid, xdocnum, xitem, sum(xqty) AS q, count(*) AS n FROM imtrn GROUP BY 1, 2, 3) p
            ON p.zid = r.zid AND p.xdocnum = r.xgrnnum AND p.xitem = r.xitem""",
        RECEIPT_COLUMNS + " item_inserted_inv:d inv_rows:i today_sales_qty:d yesterday_stock:d today_stock:d"),
}

_PLACED = """SELECT *, sum(units) OVER (PARTITION BY zid, xitem, side ORDER BY xdate, xdocnum, xline, xsup, xqty, xval
        ROWS UNBOUNDED PRECEDING) AS upto FROM (SELECT *, CASE WHEN xqty * xsign > 0 THEN 'in' ELSE 'out' END AS side,
        abs(xqty * xsign) AS units FROM imtrn WHERE xqty * xsign <> 0)"""

# Overlap of the units that came with those that went; what is beyond the other side's total is left or missing.
_MATCHED = f"""SELECT i.zid, i.xitem, i.xdocnum AS came, i.xdate AS came_on, o.xdocnum AS went, o.xdate AS went_on,
        least(i.upto, o.upto) - greatest(i.upto - i.units, o.upto - o.units) AS units
        FROM (SELECT * FROM ({_PLACED}) WHERE side = 'in') i JOIN (SELECT * FROM ({_PLACED}) WHERE side = 'out') o
        ON o.zid = i.zid AND o.xitem = i.xitem AND o.upto > i.upto - i.units AND i.upto > o.upto - o.units"""


def _beyond(side: str) -> str:
    other = "out" if side == "in" else "in"
    return f"""SELECT a.*, least(a.units, a.upto - coalesce(t.total, 0)) AS rest FROM ({_PLACED}) a
        LEFT JOIN (SELECT zid, xitem, sum(units) AS total FROM ({_PLACED}) WHERE side = '{other}' GROUP BY 1, 2) t
        ON t.zid = a.zid AND t.xitem = a.xitem WHERE a.side = '{side}' AND a.upto > coalesce(t.total, 0)"""


QUERIES["receipt_sales"] = (
    f"""SELECT r.zid, r.xitem, r.xdocnum AS xgrnnum, r.xdate AS received_on, r.received, coalesce(m.sold, 0) AS sold,
        coalesce(m.gone, 0) AS gone, coalesce(l.rest, 0) AS "left", coalesce(m.unit_days, 0) AS unit_days
        FROM (SELECT zid, xitem, xdocnum, xdate, sum(units) AS received FROM ({_PLACED})
              WHERE side = 'in' AND xdocnum LIKE 'GRN-%' GROUP BY ALL) r
        LEFT JOIN (SELECT zid, xitem, came, came_on, coalesce(sum(units) FILTER (WHERE went LIKE 'CO--%'), 0) AS sold,
              coalesce(sum(units) FILTER (WHERE went NOT LIKE 'CO--%'), 0) AS gone,
              coalesce(sum(units * date_diff('day', came_on, went_on)) FILTER (WHERE went LIKE 'CO--%'), 0) AS unit_days
              FROM ({_MATCHED}) GROUP BY ALL) m ON m.zid = r.zid AND m.xitem = r.xitem AND m.came = r.xdocnum AND m.came_on = r.xdate
        LEFT JOIN (SELECT zid, xitem, xdocnum, xdate, sum(rest) AS rest FROM ({_beyond('in')}) GROUP BY ALL) l
              ON l.zid = r.zid AND l.xitem = r.xitem AND l.xdocnum = r.xdocnum AND l.xdate = r.xdate""",
    "zid:i xitem:s xgrnnum:s received_on:t received:d sold:d gone:d left:d unit_days:d")
QUERIES["stock_layers"] = (
    f"""SELECT zid, xitem, xdate AS since, FALSE AS missing, sum(rest) AS units FROM ({_beyond('in')}) GROUP BY ALL
        UNION ALL SELECT zid, xitem, xdate, TRUE, -sum(rest) FROM ({_beyond('out')}) GROUP BY ALL""",
    "zid:i xitem:s since:t missing:b units:d")
