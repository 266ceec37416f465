"""The ERP tables over the star-schema sample, as plain SQL."""

UNIT = "cast(100001 + {key} % 3 AS int)"


def code(prefix: str, key: str, width: int) -> str:
    text = f"cast({key} AS varchar)"
    return f"concat({prefix}, lpad({text}, cast(greatest({width}, length({text})) AS int), '0'))"


ITEM = code("'IT-'", "p_partkey", 6)
SUPPLIER = code("'SUP-'", "l_suppkey", 6)
VOUCHER = code("CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'OB--' ELSE 'JV--' END",
               "o_orderkey", 7)
OPENING = "o_orderstatus = 'P' AND o_orderkey % 4 = 0"

# Item columns beyond the six that the reports use, in the order of the sheet.
MORE_COLUMNS = [
    "xlong", "xstdcost", "xunitsel", "xunitstk", "xunitalt", "xunitiss", "xunitpck", "xunitsta", "xduty", "xorigin",
    "xsup", "xwtunit", "xunitwt", "xitemnew", "xitemold", "xeccrange", "xrandom", "xnameonly", "xdrawing", "xeccnum",
    "xscode", "xresponse", "xslot", "xunitlen", "xl", "xw", "xh", "xalias", "xcolor", "xmaterial", "xremark",
]


def more_columns(state: str, shift: int, without: tuple[str, ...] = ()) -> str:
    cells = []
    for place, c in enumerate(MORE_COLUMNS):
        value = "cast(p_size AS decimal(18,2))" if c == "xstdcost" else f"'{state} {c} ' || cast(p_size AS varchar)"
        if c not in without:
            cells.append(f"CASE WHEN (p_size + {place + shift}) % 3 <> 0 THEN {value} END AS {c}")
    return ", ".join(cells)


VIEWS = {
    "tenant": "SELECT * FROM (VALUES (100001, 'store'), (100002, 'central'), (100003, 'ecommerce')) AS t(zid, name)",
    "tenant_config": """SELECT * FROM (VALUES (100001, '04010001', 'Main'), (100002, '4010001', 'Main'),
        (100003, '4010001', 'Annex')) AS t(zid, cogs_account, warehouse_text)""",
    "tenant_project": """SELECT * FROM (VALUES (100001, 'BUILDING', '04010002'), (100001, 'BUILDING', '04010007'),
        (100002, 'MACHINERY', '4010002'), (100003, 'FURNITURE', '4010002'), (100003, 'FURNITURE', '4010012'))
        AS t(zid, xproj, xacc)""",
    "caitem": f"""SELECT t.zid, {ITEM} AS xitem, p_name AS xdesc, p_type AS xgitem, p_brand AS xbrand,
        cast(p_retailprice AS decimal(18,2)) + cast(CASE WHEN t.zid = 100001 THEN p_partkey % 7
          WHEN t.zid = 100003 THEN p_partkey % 5 ELSE 0 END AS decimal(18,2)) AS xstdprice,
        {more_columns('old', 0)}, TIMESTAMP '1990-01-01 00:00:00' AS ztime, 'Manual' AS xcatful,
        'Stock-N-Sell' AS xtypestk, 'Main' AS xwh, 2 AS xcfiss, 2 AS xcfpck, 2 AS xcfsta
        FROM part CROSS JOIN tenant t""",
    "imtrn": f"""SELECT {UNIT.format(key='l_orderkey')} AS zid, {code("'IT-'", 'l_partkey', 6)} AS xitem,
        cast(l_shipdate AS date) AS xdate, {code('doc', 'l_orderkey', 7)} AS xdocnum,
        cast(l_linenumber AS int) AS xline, {SUPPLIER} AS xsup,
        CASE WHEN doc IN ('GRN-', 'SRE-') THEN 1 ELSE -1 END AS xsign,
        cast(CASE WHEN l_orderkey % 31 = 0 AND l_linenumber = 1 THEN -l_quantity ELSE l_quantity END AS decimal(18,2)) AS xqty, cast(l_extendedprice AS decimal(18,2)) AS xval,
        cast(l_discount AS decimal(4,2)) AS xdisc,
        CASE l_suppkey % 2 WHEN 0 THEN 'Main ' ELSE 'Annex ' END || cast(l_orderkey % 3 AS varchar) AS xwh,
        cast(year(l_shipdate) AS int) AS xyear, cast(month(l_shipdate) AS int) AS xper
        FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'PRE-'
                WHEN l_returnflag = 'R' THEN 'SRE-' WHEN l_linestatus = 'F' THEN 'GRN-'
                WHEN l_returnflag = 'A' THEN 'TO--' ELSE 'CO--' END AS doc FROM lineitem) s""",
    "pogdt": "SELECT zid, xdocnum AS xgrnnum, xitem, xqty FROM imtrn WHERE xdocnum LIKE 'GRN-%'",
    "pogrn": """SELECT zid, xdocnum AS xgrnnum, concat('IP--', substr(xdocnum, 5)) AS xpornum,
        max(xsup) AS xsup, min(xdate) AS xdate FROM imtrn WHERE xdocnum LIKE 'GRN-%' GROUP BY 1, 2, 3""",
    "poord": "SELECT zid, xpornum, xsup, xdate, '5-Received' AS xstatuspor FROM pogrn",
    "poodt": """SELECT zid, concat('IP--', substr(xdocnum, 5)) AS xpornum, xitem, xqty AS xqtyord,
        cast(xval * 0.04 AS decimal(18,2)) AS xrate FROM imtrn WHERE xdocnum LIKE 'GRN-%'""",
    "opodt": """SELECT zid, xdocnum AS xordernum, xitem, xqty AS xqtyord,
        cast(xval * (1 + xdisc) AS decimal(18,2)) AS xlineamt, cast(xval * (1 + xdisc) AS decimal(18,2)) AS xdtwotax,
        cast(xval * xdisc AS decimal(18,2)) AS xdtdisc FROM imtrn WHERE xdocnum LIKE 'CO--%'""",
    "opord": """SELECT zid, xdocnum AS xordernum, min(xdate) AS xdate FROM imtrn
        WHERE xdocnum LIKE 'CO--%' GROUP BY 1, 2""",
    "imtdt": """SELECT zid, xdocnum AS ximtor, xitem, cast(xval * (1 + xdisc) AS decimal(18,2)) AS xdtwotax
        FROM imtrn WHERE xdocnum LIKE 'TO--%'""",
    "imtor": "SELECT DISTINCT zid, ximtor FROM imtdt",
    "imtemptdt": """SELECT zid, xdocnum AS ximtrnnum, xitem, cast(xval * 0.04 AS decimal(18,2)) AS xrate
        FROM imtrn WHERE xdocnum LIKE 'SRE-%'""",
    "imtemptrn": "SELECT DISTINCT zid, ximtrnnum AS ximtmptrn FROM imtemptdt",
    "casup": f"""SELECT t.zid, {code("'SUP-'", 's_suppkey', 6)} AS xsup, s_name AS xshort,
        concat('0', cast(s_suppkey AS varchar)) AS xphone FROM supplier CROSS JOIN tenant t""",
    "credit_suppliers": f"SELECT {code(chr(39) + 'SUP-' + chr(39), 's_suppkey', 6)} AS xsup FROM supplier WHERE s_acctbal > 0",
    "cacus": f"""SELECT t.zid, {code("'CUS-'", 'c_custkey', 6)} AS xcus, c_name AS xshort, c_mktsegment AS xadd2,
        n_name AS xcity, r_name AS xstate FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey CROSS JOIN tenant t""",
    "coa_label": """SELECT * FROM (VALUES (0,'Income','08-Revenue'),(1,'Expenditure','04-Cost of Goods Sold'),
        (2,'Asset','0101-CASH & CASH EQUIVALENT'),(3,'Liability','0903-Accounts Payable'),
        (4,'Expenditure','0636-Depreciation'),(5,'Income','08-Revenue'),
        (6,'Expenditure','06-Office & Administrative Expenses'),(7,'Asset','0103-ACCOUNTS RECEIVABLE'),
        (8,'Liability','0901-Accrued Expenses'),(9,'Expenditure','0630-Bank Interest & Charges'),
        (10,'Income','15-Sales Return'),(11,'Expenditure','07-Sales & Distribution Expenses'),
        (12,'Asset','0106-STOCK IN HAND'),(13,'Liability','0906-Others Liability'),
        (14,'Expenditure','0629-VAT & Tax Expenses'),(15,'Income','14-Purchase Return'),
        (16,'Expenditure','0631-Other Expenses'),(17,'Asset','0104-PREPAID EXPENSES'),
        (18,'Liability','1001-Short Term Bank Loan'),(19,'Expenditure','0702-Discount-Expense'),
        (20,'Income','08-Revenue'),(21,'Expenditure','0629- Unit VAT & Tax Expenses'),(22,'Asset','0303-Furniture & Fixture'),
        (23,'Liability','13-Owners Equity'),(24,'Expenditure','0701-MRP-Discount')) AS t(n, xacctype, xhrc4)""",
    "glmst": """SELECT t.zid, concat(CASE WHEN t.zid = 100001 THEN '0' ELSE '' END, cast(4010000 + n_nationkey AS varchar)) AS xacc,
        n_name AS xdesc, l.xacctype, concat('H1-', l.xacctype) AS xhrc1, l.xhrc4 AS xhrc2,
        CASE r_name WHEN 'AFRICA' THEN 'Operating' WHEN 'AMERICA' THEN 'Operating Investment'
          WHEN 'ASIA' THEN 'Investing' ELSE 'Financing' END AS xhrc3, l.xhrc4
        FROM nation JOIN region ON n_regionkey = r_regionkey JOIN coa_label l ON l.n = n_nationkey CROSS JOIN tenant t""",
    "glheader": f"""SELECT {UNIT.format(key='o_orderkey')} AS zid, {VOUCHER} AS xvoucher,
        cast(o_orderdate AS date) AS xdate, cast(year(o_orderdate) AS int) AS xyear,
        cast(CASE WHEN {OPENING} THEN 0 ELSE month(o_orderdate) END AS int) AS xper FROM orders""",
    "gldetail": f"""SELECT {UNIT.format(key='o_orderkey')} AS zid, {VOUCHER} AS xvoucher,
        concat(CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE '' END, cast(4010000 + (l_partkey + l_suppkey) % 25 AS varchar)) AS xacc,
        CASE o_custkey % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
          WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS xproj,
        CASE WHEN l_linestatus = 'F' THEN {SUPPLIER} ELSE {code("'CUS-'", 'o_custkey', 6)} END AS xsub,
        cast(l_extendedprice AS decimal(18,2)) * CASE WHEN (l_partkey + l_suppkey) % 25 % 5 IN (0, 3) THEN -1 ELSE 1 END AS xprime
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "web_orders": """SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 'processing' WHEN 1 THEN 'order-confirmed'
          WHEN 2 THEN 'will-ecourier' WHEN 3 THEN 'will-sundarban' WHEN 4 THEN 'consundorban'
          WHEN 5 THEN 'on-the-way-to-del' WHEN 6 THEN 'order-cancelled' ELSE 'completed' END AS status,
        o_orderdate AS date_created,
        CASE WHEN o_orderkey % 8 = 7 AND o_orderkey % 5 <> 0
          THEN cast(o_orderdate AS date) + cast(o_orderkey % 12 AS int) END AS date_completed,
        cast(o_totalprice AS decimal(18,2)) AS total,
        CASE WHEN o_orderkey % 9 = 0 THEN 'call before ' || cast(o_orderkey % 24 AS varchar) END AS customer_note FROM orders""",
    "web_products": f"""SELECT p_partkey AS id, CASE WHEN p_partkey % 53 = 0 THEN '' ELSE {ITEM} END AS sku,
        CASE WHEN p_partkey % 17 = 0 THEN '' ELSE cast(cast(p_retailprice AS decimal(18,2))
          + cast(p_partkey % 4 AS decimal(18,2)) AS varchar) END AS regular_price,
        CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'inhouse' ELSE 'nearby' END AS shipping_class FROM part""",
    "catalog_sheet": f"""SELECT 100002 AS zid, CASE WHEN p_partkey % 2 = 0 THEN {ITEM}
          WHEN p_partkey % 3 = 0 THEN 'IT-' ELSE 'NB-' END AS xitem,
        concat('new ', p_name) AS xdesc, p_type AS xgitem, cast(p_retailprice AS decimal(18,2)) + 1 AS xstdprice,
        concat('U', cast(p_size % 5 AS varchar)) AS xeccrange,
        CASE WHEN p_size % 3 = 0 THEN concat('V', cast(p_size AS varchar)) END AS xrandom, 'N1' AS xnameonly,
        p_brand AS xbrand, split_part(p_name, ' ', 1) AS xcolor, p_type AS xmaterial,
        {more_columns('new', 1, ('xeccrange', 'xrandom', 'xnameonly', 'xcolor', 'xmaterial'))}, p_partkey AS row_id FROM part""",
    "xcodes": """SELECT DISTINCT 100002 AS zid, 'Brand' AS xtype, p_brand AS xcode FROM part WHERE p_size < 2
        UNION SELECT DISTINCT 100002, 'Material', p_type FROM part WHERE p_type <> 'PROMO'""",
    "count_history": f"""SELECT t.zid, {ITEM} AS xitem, date '2001-04-01' AS quarter_start
        FROM part CROSS JOIN tenant t WHERE p_size <= 5""",
}
