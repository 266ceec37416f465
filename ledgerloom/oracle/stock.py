"""SQL of the stock, counting, catalog and price reports."""

from ledgerloom.oracle.views import MORE_COLUMNS
from ledgerloom.plans.params import DEFAULT as P

AS_OF = f"DATE '{P.as_of}'"
DAY_BEFORE = f"DATE '{P.back(1)}'"
YEAR_AGO = f"DATE '{P.back(365)}'"


def halves_away(num: str, den: str) -> str:
    """Whole quotient of two whole numbers, halves rounded away from zero."""
    sign = f"CASE WHEN ({num} < 0) <> ({den} < 0) THEN -1 ELSE 1 END"
    return f"{sign} * ((2 * abs({num}) + abs({den})) // (2 * abs({den})))"


def rate(num: str, den: str) -> str:
    """num / den of two decimals with 2 digits, rounded half up to 10 digits, exactly."""
    a, b = f"CAST({num} * 100 AS HUGEINT)", f"CAST({den} * 100 AS HUGEINT)"
    return (f"CAST(CASE WHEN {den} <> 0 THEN {halves_away(f'({a} * 10000000000)', b)} END AS DECIMAL(28,0))"
            " * CAST(0.0000000001 AS DECIMAL(10,10))")


def newest(where: str = "TRUE") -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY zid, xitem
        ORDER BY xdate DESC, xdocnum DESC, xline DESC, xsup DESC, xqty DESC, xval DESC) AS rn
        FROM imtrn WHERE {where}) t WHERE rn = 1"""


def balance(where: str = "TRUE") -> str:
    return f"""SELECT i.zid, i.xitem, c.xdesc, c.xgitem, c.xbrand, c.xstdprice,
        sum(i.xqty * i.xsign) AS inventory, max(i.xdate) AS last_date
        FROM imtrn i JOIN caitem c ON i.zid = c.zid AND i.xitem = c.xitem WHERE {where}
        GROUP BY ALL"""


def branches(where: str = "TRUE") -> str:
    return f"""SELECT c.xitem AS sku, c.xdesc AS name, trunc(c.inventory) AS central,
        trunc(coalesce(s.inventory, 0)) AS store, trunc(coalesce(e.inventory, 0)) AS ecommerce,
        trunc(c.inventory) + trunc(coalesce(s.inventory, 0)) + trunc(coalesce(e.inventory, 0)) AS sum_of_stock
        FROM (SELECT * FROM ({balance(where)}) WHERE zid = 100002) c
        LEFT JOIN (SELECT * FROM ({balance(where)}) WHERE zid = 100001) s ON s.xitem = c.xitem
        LEFT JOIN (SELECT * FROM ({balance(where)}) WHERE zid = 100003) e ON e.xitem = c.xitem"""


CHANGES = f"""SELECT a.*, b.sum_of_stock AS previous
    FROM ({branches(f'xdate <= {AS_OF}')}) a LEFT JOIN ({branches(f'xdate <= {DAY_BEFORE}')}) b ON a.sku = b.sku
    WHERE b.sum_of_stock IS NULL OR a.sum_of_stock <> b.sum_of_stock"""

SYNC = f"""SELECT p.id, s.sum_of_stock AS stock_quantity, TRUE AS manage_stock
    FROM web_products p JOIN ({branches()}) s ON p.sku = s.sku WHERE p.sku <> '' AND p.id > 0"""

POOL = f"""SELECT zid, xitem, xwh, stockqty, stockvalue, xdesc, xgitem FROM (
    SELECT s.*, c.xdesc, c.xgitem, row_number() OVER (PARTITION BY s.zid ORDER BY stockvalue DESC, s.xitem, s.xwh) AS rn
    FROM (SELECT zid, xitem, xwh, sum(xqty * xsign) AS stockqty, sum(xval * xsign) AS stockvalue
          FROM imtrn GROUP BY 1, 2, 3) s
    JOIN caitem c ON c.zid = s.zid AND c.xitem = s.xitem
    WHERE NOT EXISTS (SELECT 1 FROM count_history h WHERE h.zid = s.zid AND h.xitem = s.xitem
                      AND h.quarter_start = DATE '2001-04-01')) t
    WHERE rn <= {P.pool}"""


def bits(*cols: str) -> str:
    text = " || '|' || ".join([f"'{P.seed}'", *[f"cast({c} AS varchar)" for c in cols]])
    return f"cast('0x' || substr(md5({text}), 1, 8) AS bigint)"


CHOSEN = f"""SELECT zid FROM (SELECT DISTINCT zid FROM ({POOL}))
    ORDER BY {bits("'unit'", 'zid')}, zid LIMIT {P.units}"""

PICKS = f"""SELECT zid, xitem, xwh, stockqty, stockvalue, xdesc, xgitem FROM (
    SELECT *, row_number() OVER (PARTITION BY zid ORDER BY
        CASE WHEN stockvalue > 0 THEN -ln((h + 1) / 4294967297.0::DOUBLE) / cast(stockvalue AS double) END ASC NULLS LAST,
        h, xitem, xwh) AS pick
    FROM (SELECT *, {bits('zid', 'xitem', 'xwh')} AS h FROM ({POOL}) pool_rows
          WHERE zid IN ({CHOSEN})) hashed) ranked WHERE pick <= {P.picks}"""

ATTRIBUTES = " UNION ".join(
    f"SELECT zid, '{kind}' AS xtype, {c} AS xcode FROM catalog_sheet WHERE {c} IS NOT NULL"
    for c, kind in [("xeccrange", "Measurement Unit 1"), ("xrandom", "Measurement Unit 2"),
                    ("xnameonly", "Measurement Unit 3"), ("xbrand", "Brand"), ("xcolor", "Color"),
                    ("xmaterial", "Material")])

IN_CENTRAL = "EXISTS (SELECT 1 FROM caitem c WHERE c.zid = s.zid AND c.xitem = s.xitem)"
SHEET_COLUMNS = " ".join(["zid:i xitem:s xdesc:s xgitem:s xstdprice:d xbrand:s row_id:i",
                          *[f"{c}:{'d' if c == 'xstdcost' else 's'}" for c in MORE_COLUMNS]])

# What a sheet may change on an existing item.
CHANGED = ["xdesc", "xbrand", "xstdprice", "xlong", "xstdcost", "xduty", "xorigin", "xsup", "xwtunit", "xunitwt",
           "xitemnew", "xitemold", "xdrawing", "xeccnum", "xunitlen", "xl", "xw", "xh", "xalias", "xcolor", "xmaterial",
           "xeccrange", "xscode", "xrandom", "xresponse", "xnameonly", "xslot"]

CODED = f"""SELECT n.*, n.xitem AS prefix, n.xitem || cast(n.rn + coalesce(m.largest, 0) AS varchar) AS new_code
    FROM (SELECT s.*, row_number() OVER (PARTITION BY s.xitem ORDER BY s.row_id) AS rn
          FROM catalog_sheet s WHERE NOT {IN_CENTRAL}) n
    LEFT JOIN (SELECT p.xitem AS prefix, max(CAST(split_part(c.xitem, '-', 2) AS BIGINT)) AS largest
               FROM (SELECT DISTINCT xitem FROM catalog_sheet) p
               JOIN caitem c ON c.zid = 100002 AND starts_with(c.xitem, p.xitem)
               WHERE regexp_matches(split_part(c.xitem, '-', 2), '^[0-9]+$') GROUP BY 1) m ON m.prefix = n.xitem"""


def compare(zid: int) -> str:
    return f"""SELECT p.id, p.sku AS xitem, TRY_CAST(nullif(p.regular_price, '') AS DECIMAL(18,2)) AS web_price, c.xstdprice AS erp_price,
        coalesce(TRY_CAST(nullif(p.regular_price, '') AS DECIMAL(18,2)) < c.xstdprice, FALSE) AS web_below_erp,
        coalesce(TRY_CAST(nullif(p.regular_price, '') AS DECIMAL(18,2)) > c.xstdprice, FALSE) AS web_above_erp
        FROM web_products p JOIN caitem c ON c.xitem = p.sku AND c.zid = {zid} WHERE p.sku <> ''"""


BALANCE_COLUMNS = "zid:i xitem:s xdesc:s xgitem:s xbrand:s xstdprice:d inventory:d last_date:t"
MOVE_COLUMNS = "zid:i xitem:s xdate:t xdocnum:s xqty:d xval:d xsign:i"
BRANCH_COLUMNS = "sku:s name:s central:i store:i ecommerce:i sum_of_stock:i"
POOL_COLUMNS = "zid:i xitem:s xwh:s stockqty:d stockvalue:d xdesc:s xgitem:s"


def kind_total(prefix: str) -> str:
    return f"coalesce(sum(xqty * xsign) FILTER (WHERE xdocnum LIKE '{prefix}%'), 0)"


QUERIES = {
    "inventory_balance": (balance(), BALANCE_COLUMNS),
    "last_movement": (newest(), MOVE_COLUMNS),
    "last_receipt_movement": (newest("xdocnum LIKE 'GRN-%'"), MOVE_COLUMNS),
    "inventory_report": (
        f"""SELECT b.zid, b.xitem, b.xdesc, b.xgitem, b.xstdprice, b.inventory, l.xqty, l.xval,
            {rate('l.xval', 'l.xqty')} AS xrate
            FROM (SELECT * FROM ({balance()}) WHERE zid = 100002) b
            LEFT JOIN (SELECT * FROM ({newest()}) WHERE zid = 100001) l ON l.xitem = b.xitem""",
        "zid:i xitem:s xdesc:s xgitem:s xstdprice:d inventory:d xqty:d xval:d xrate:d"),
    "inventory_value_by_warehouse": (
        f"SELECT zid, xwh, sum(xval * xsign) AS value FROM imtrn WHERE xdate <= {AS_OF} GROUP BY 1, 2",
        "zid:i xwh:s value:d"),
    "inventory_value_totals": (
        f"""SELECT t.zid, t.name, round(coalesce(sum(i.xval * i.xsign) FILTER (WHERE contains(i.xwh, c.warehouse_text)), 0), 2) AS value
            FROM imtrn i JOIN tenant_config c ON c.zid = i.zid JOIN tenant t ON t.zid = i.zid
            WHERE i.xdate <= {AS_OF} GROUP BY 1, 2""",
        "zid:i name:s value:d"),
    "stock_as_of": (
        f"""SELECT zid, xitem, sum(xqty * xsign) AS stock FROM imtrn WHERE xdate <= {AS_OF}
            AND xitem IN (SELECT d.xitem FROM poodt d JOIN poord o ON o.zid = d.zid AND o.xpornum = d.xpornum
                          WHERE d.zid = 100002 AND o.xdate > {YEAR_AGO}) GROUP BY 1, 2""",
        "zid:i xitem:s stock:d"),
    "movement_total": (
        f"""SELECT zid, xitem, {kind_total('CO--')} AS sales, {kind_total('TO--')} AS transfers,
            {kind_total('SRE-')} AS sales_returns, {kind_total('PRE-')} AS purchase_returns FROM imtrn
            WHERE xdate >= {YEAR_AGO} AND substr(xdocnum, 1, 4) IN ('CO--', 'TO--', 'SRE-', 'PRE-') GROUP BY 1, 2""",
        "zid:i xitem:s sales:d transfers:d sales_returns:d purchase_returns:d"),
    "day_over_day_stock": (
        f"""SELECT coalesce(y.zid, t.zid) AS zid, coalesce(y.xitem, t.xitem) AS xitem,
            coalesce(y.q, 0) AS yesterday_stock, coalesce(t.q, 0) AS today_stock
            FROM (SELECT zid, xitem, sum(xqty * xsign) AS q FROM imtrn WHERE xdate <= {DAY_BEFORE} GROUP BY 1, 2) y
            FULL JOIN (SELECT zid, xitem, sum(xqty * xsign) AS q FROM imtrn WHERE xdate <= {AS_OF} GROUP BY 1, 2) t
            ON y.zid = t.zid AND y.xitem = t.xitem""",
        "zid:i xitem:s yesterday_stock:d today_stock:d"),
    "multi_branch_stock": (branches(), BRANCH_COLUMNS),
    "stock_changes": (CHANGES, BRANCH_COLUMNS + " previous:i"),
    "negative_movements": (
        f"""SELECT b.zid, b.xitem, b.xdesc, b.inventory, b.last_date, l.xqty, l.xval
            FROM ({balance()}) b JOIN ({newest()}) l ON l.zid = b.zid AND l.xitem = b.xitem WHERE l.xqty < 0""",
        "zid:i xitem:s xdesc:s inventory:d last_date:t xqty:d xval:d"),
    "negative_balances": (f"SELECT * FROM ({balance()}) WHERE inventory < 0",
                          "zid:i xitem:s xdesc:s inventory:d last_date:t"),
    "shipping_class": (
        f"""SELECT p.id, CASE WHEN s.sku IS NULL OR s.sum_of_stock <= 0 THEN 'nothouse'
              WHEN s.store + s.ecommerce > 0 THEN 'inhouse' ELSE 'nearby' END AS shipping_class
            FROM web_products p LEFT JOIN ({branches(f'xdate <= {AS_OF}')}) s ON s.sku = p.sku
            WHERE p.shipping_class = '' OR p.sku IN (SELECT sku FROM ({CHANGES}))""",
        "id:i shipping_class:s"),
    "stock_quantity_sync": (SYNC, "id:i stock_quantity:i manage_stock:b"),
    "stock_quantity_sync_nonzero": (f"SELECT * FROM ({SYNC}) WHERE stock_quantity <> 0",
                                    "id:i stock_quantity:i manage_stock:b"),
    "update_batches": (
        f"""SELECT (rn - 1) // {P.batch_size} AS batch, count(*) AS n_rows, min(id) AS first_id, max(id) AS last_id,
            '{{"update":[' || string_agg('{{"id":' || id || ',"stock_quantity":' || cast(stock_quantity AS bigint)
              || ',"manage_stock":true}}', ',' ORDER BY rn) || ']}}' AS payload
            FROM (SELECT *, row_number() OVER (ORDER BY id) AS rn FROM ({SYNC})) GROUP BY 1""",
        "batch:i n_rows:i first_id:i last_id:i payload:s"),
    "count_pool": (POOL, POOL_COLUMNS),
    "count_picks": (PICKS, POOL_COLUMNS),
    "count_history": (
        f"""SELECT quarter_start, zid, xitem FROM count_history WHERE quarter_start = DATE '2001-04-01'
            UNION SELECT DATE '2001-04-01', zid, xitem FROM ({PICKS})""",
        "quarter_start:t zid:i xitem:s"),
    "choose_units": (CHOSEN, "zid:i"),
    "working_days": (
        f"""SELECT DISTINCT xdate, dayname(xdate) AS weekday FROM imtrn WHERE dayname(xdate) <> 'Friday'
            AND xdate NOT IN ({', '.join(f"DATE '{h}'" for h in P.holidays)})""",
        "xdate:t weekday:s"),
    "attribute_codes": (ATTRIBUTES, "zid:i xtype:s xcode:s"),
    "missing_codes": (
        f"""SELECT a.* FROM ({ATTRIBUTES}) a WHERE NOT EXISTS (SELECT 1 FROM xcodes x
            WHERE x.zid = a.zid AND x.xtype = a.xtype AND x.xcode = a.xcode)""",
        "zid:i xtype:s xcode:s"),
    "catalog_existing": (f"SELECT s.* FROM catalog_sheet s WHERE {IN_CENTRAL}", SHEET_COLUMNS),
    "catalog_new": (f"SELECT s.* FROM catalog_sheet s WHERE NOT {IN_CENTRAL}", SHEET_COLUMNS),
    "generate_item_codes": (CODED, "zid:i row_id:i prefix:s new_code:s"),
    "new_item_defaults": (
        f"""SELECT c.*, TIMESTAMP '2001-06-30 09:00:00' AS ztime, 'Auto' AS xcatful, 'Stock-N-Sell' AS xtypestk,
            'Central' AS xwh, 1 AS xcfiss, 1 AS xcfpck, 1 AS xcfsta FROM ({CODED}) c""",
        SHEET_COLUMNS + " prefix:s new_code:s ztime:T xcatful:s xtypestk:s xwh:s xcfiss:i xcfpck:i xcfsta:i"),
    "catalog_upsert": (
        f"""SELECT c.zid, c.xitem, c.xgitem, c.ztime, c.xcatful, c.xtypestk, c.xwh, c.xcfiss, c.xcfpck, c.xcfsta,
              {', '.join(f'CASE WHEN s.xitem IS NULL THEN c.{x} ELSE s.{x} END AS {x}' for x in CHANGED)},
              {', '.join(f'c.{x}' for x in MORE_COLUMNS if x not in CHANGED)},
              CASE WHEN s.xitem IS NULL THEN 'kept' ELSE 'updated' END AS action
            FROM caitem c LEFT JOIN catalog_sheet s ON s.zid = c.zid AND s.xitem = c.xitem
            UNION ALL BY NAME SELECT zid, new_code AS xitem, xgitem, TIMESTAMP '2001-06-30 09:00:00' AS ztime, 'Auto' AS xcatful,
              'Stock-N-Sell' AS xtypestk, 'Central' AS xwh, 1 AS xcfiss, 1 AS xcfpck, 1 AS xcfsta,
              {', '.join(CHANGED)}, {', '.join(x for x in MORE_COLUMNS if x not in CHANGED)}, 'inserted' AS action FROM ({CODED})""",
        SHEET_COLUMNS.replace(" row_id:i", "") + " ztime:T xcatful:s xtypestk:s xwh:s xcfiss:i xcfpck:i xcfsta:i action:s"),
    "price_compare": (compare(100003), "id:i xitem:s web_price:d erp_price:d web_below_erp:b web_above_erp:b"),
    "price_compare_landed": (compare(100003), "id:i xitem:s web_price:d erp_price:d web_below_erp:b web_above_erp:b"),
    "erp_price_updates": (
        f"SELECT xitem, erp_price AS current_price, web_price AS target_price FROM ({compare(100003)}) WHERE web_below_erp",
        "xitem:s current_price:d target_price:d"),
    "web_price_updates": (
        f"SELECT id, trunc(erp_price) AS regular_price FROM ({compare(100001)}) WHERE web_below_erp",
        "id:i regular_price:i"),
    "store_cheaper": (
        f"SELECT id, xitem, web_price, erp_price AS store_price FROM ({compare(100001)}) WHERE web_above_erp",
        "id:i xitem:s web_price:d store_price:d"),
    "stream_stock_balance": (
        "SELECT zid, xitem, sum(xqty * xsign) AS inventory FROM imtrn GROUP BY 1, 2", "zid:i xitem:s inventory:d"),
    "stream_stock_changes": (
        f"""SELECT n.zid, n.xitem, n.q AS inventory, o.q AS previous
            FROM (SELECT zid, xitem, sum(xqty * xsign) AS q FROM imtrn GROUP BY 1, 2) n
            LEFT JOIN (SELECT zid, xitem, sum(xqty * xsign) AS q FROM imtrn WHERE xdate <= {AS_OF} GROUP BY 1, 2) o
            ON o.zid = n.zid AND o.xitem = n.xitem WHERE o.q IS NULL OR o.q <> n.q""",
        "zid:i xitem:s inventory:d previous:d"),
}

# Reports that keep something between runs, or store tables another way, give the same rows as those that compute them anew.
for _kept, _anew in {"stock_as_of_periods": "stock_as_of", "day_over_day_stock_periods": "day_over_day_stock",
                     "stock_changes_by_history": "stock_changes", "inventory_balance_laid_out": "inventory_balance",
                     "inventory_value_published": "inventory_value_by_warehouse"}.items():
    QUERIES[_kept] = QUERIES[_anew]

QUERIES["stock_intervals"] = (
    """SELECT zid, xitem, sum(change) OVER (PARTITION BY zid, xitem ORDER BY xdate) AS inventory, xdate AS valid_from,
        lead(xdate) OVER (PARTITION BY zid, xitem ORDER BY xdate) AS valid_to
        FROM (SELECT zid, xitem, xdate, sum(xqty * xsign) AS change FROM imtrn GROUP BY 1, 2, 3 HAVING sum(xqty * xsign) <> 0)""",
    "zid:i xitem:s inventory:d valid_from:t valid_to:t")
