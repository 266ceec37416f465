"""ERP tables derived from a star-schema sample (orders, lines, parts, partners).

One line item is one stock movement; its document type follows from the return
flag and the line status.  The mapping only projects, joins on keys and
aggregates by document, so filters on dates and keys reach the parquet scan;
``imtrn_of`` does the same for a document type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import constant_table, literal, lookup
from ledgerloom.plans.statement_lines import DEFAULT_GROUPS, TAX
from ledgerloom.schemas import INSERT_DEFAULTS, ITEM_COLUMNS, MONEY
from ledgerloom.streaming.keyed import Files

# Business units.
UNITS = [(100001, "store"), (100002, "central"), (100003, "ecommerce")]

# Cost account of each unit, text that marks its stock rooms.
UNIT_CONFIG = [
    (100001, "04010001", "Main"),
    (100002, "4010001", "Main"),
    (100003, "4010001", "Annex"),
]

# Project of each unit and its cash accounts.
UNIT_PROJECTS = [
    (100001, "BUILDING", "04010002"),
    (100001, "BUILDING", "04010007"),
    (100002, "MACHINERY", "4010002"),
    (100003, "FURNITURE", "4010002"),
    (100003, "FURNITURE", "4010012"),
]

# Projects that vouchers belong to.
PROJECTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# A group that only this sample has; others come with the statement layout.
OWN_GROUP = "0629- Unit VAT & Tax Expenses"

# Class and statement group of the 25 accounts, by account number.
ACCOUNTS = [
    (0, "Income", "08-Revenue"),
    (1, "Expenditure", "04-Cost of Goods Sold"),
    (2, "Asset", "0101-CASH & CASH EQUIVALENT"),
    (3, "Liability", "0903-Accounts Payable"),
    (4, "Expenditure", "0636-Depreciation"),
    (5, "Income", "08-Revenue"),
    (6, "Expenditure", "06-Office & Administrative Expenses"),
    (7, "Asset", "0103-ACCOUNTS RECEIVABLE"),
    (8, "Liability", "0901-Accrued Expenses"),
    (9, "Expenditure", "0630-Bank Interest & Charges"),
    (10, "Income", "15-Sales Return"),
    (11, "Expenditure", "07-Sales & Distribution Expenses"),
    (12, "Asset", "0106-STOCK IN HAND"),
    (13, "Liability", "0906-Others Liability"),
    (14, "Expenditure", "0629-VAT & Tax Expenses"),
    (15, "Income", "14-Purchase Return"),
    (16, "Expenditure", "0631-Other Expenses"),
    (17, "Asset", "0104-PREPAID EXPENSES"),
    (18, "Liability", "1001-Short Term Bank Loan"),
    (19, "Expenditure", "0702-Discount-Expense"),
    (20, "Income", "08-Revenue"),
    (21, "Expenditure", OWN_GROUP),
    (22, "Asset", "0303-Furniture & Fixture"),
    (23, "Liability", "13-Owners Equity"),
    (24, "Expenditure", "0701-MRP-Discount"),
]

# Status of an order by its key.
WEB_STATUS = {
    0: "processing",
    1: "order-confirmed",
    2: "will-ecourier",
    3: "will-sundarban",
    4: "consundorban",
    5: "on-the-way-to-del",
    6: "order-cancelled",
    7: "completed",
}

SUP, CUS = "'SUP-'", "'CUS-'"


def code(prefix: str, key: str, width: int) -> str:
    """Zero-padded code; a longer key is kept whole, never cut."""
    text = f"cast({key} AS string)"
    return f"concat({prefix}, lpad({text}, greatest({width}, length({text})), '0'))"


def unit_of(order_key: str) -> str:
    return f"cast(100001 + {order_key} % 3 AS int)"


ITEM = code("'IT-'", "p_partkey", 6)
LINE_ITEM = code("'IT-'", "l_partkey", 6)
LINE_SUPPLIER = code("'SUP-'", "l_suppkey", 6)
RETURNED, SHIPPED = "l_returnflag = 'R'", "l_linestatus = 'F'"

# Line items of each document type, in stored columns that a scan can filter.
TYPES = {
    "PRE-": f"{RETURNED} AND {SHIPPED}",
    "SRE-": f"{RETURNED} AND NOT {SHIPPED}",
    "GRN-": f"NOT {RETURNED} AND {SHIPPED}",
    "TO--": f"NOT {RETURNED} AND NOT {SHIPPED} AND l_returnflag = 'A'",
    "CO--": f"NOT {RETURNED} AND NOT {SHIPPED} AND l_returnflag <> 'A'",
}
DOC = (f"CASE WHEN {RETURNED} AND {SHIPPED} THEN 'PRE-' WHEN {RETURNED} THEN 'SRE-' WHEN {SHIPPED} THEN 'GRN-' "
       "WHEN l_returnflag = 'A' THEN 'TO--' ELSE 'CO--' END")
# Some lines correct an earlier one: their quantity is negative.
CORRECTED = "l_orderkey % 31 = 0 AND l_linenumber = 1"
OPENING = "o_orderstatus = 'P' AND o_orderkey % 4 = 0"
ACCOUNT = "(l_partkey + l_suppkey) % 25"
VOUCHER = code(f"CASE WHEN {OPENING} THEN 'OB--' ELSE 'JV--' END", "o_orderkey", 7)


def account(number: str, leading_zero: str) -> str:
    return f"concat(CASE WHEN {leading_zero} THEN '0' ELSE '' END, cast(4010000 + {number} AS string))"


def share(factor: str) -> str:
    return f"cast(xval * {factor} AS {MONEY})"


def in_every_unit(df: DataFrame) -> DataFrame:
    """Master rows that exist in all units."""
    return df.selectExpr("*", f"explode({literal([z for z, _ in UNITS])}) AS zid")


def movements(lineitem: DataFrame) -> DataFrame:
    """Stock movements of line items; also works on a stream."""
    return lineitem.selectExpr(
        f"{unit_of('l_orderkey')} AS zid", f"{LINE_ITEM} AS xitem", "cast(l_shipdate AS date) AS xdate",
        f"{code(DOC, 'l_orderkey', 7)} AS xdocnum", "cast(l_linenumber AS int) AS xline",
        f"{LINE_SUPPLIER} AS xsup", f"CASE WHEN {DOC} IN ('GRN-', 'SRE-') THEN 1 ELSE -1 END AS xsign",
        f"cast(CASE WHEN {CORRECTED} THEN -l_quantity ELSE l_quantity END AS {MONEY}) AS xqty", f"cast(l_extendedprice AS {MONEY}) AS xval",
        "cast(l_discount AS decimal(4,2)) AS xdisc",
        "concat(CASE WHEN l_suppkey % 2 = 0 THEN 'Main ' ELSE 'Annex ' END, cast(l_orderkey % 3 AS string)) AS xwh",
        "year(l_shipdate) AS xyear", "month(l_shipdate) AS xper")


# Attributes that the sheet derives from the part by expressions of their own.
SHEET_OWN = ["xeccrange", "xrandom", "xnameonly", "xcolor", "xmaterial"]


def more_attributes(state: str) -> dict[str, str]:
    """Remaining columns of an item: text of the column and the part, missing for every third size.

    The sheet (state "new") misses other parts than the master, so an update empties some.
    """
    own = ["zid", "xitem", "xdesc", "xgitem", "xbrand", "xstdprice"]
    out = {}
    for place, (column, kind) in enumerate((c, k) for c, k in ITEM_COLUMNS.items() if c not in own and c not in INSERT_DEFAULTS):
        value = f"cast(p_size AS {MONEY})" if kind == MONEY else f"concat('{state} {column} ', cast(p_size AS string))"
        out[column] = f"CASE WHEN (p_size + {place + (state == 'new')}) % 3 <> 0 THEN {value} END"
    return out


def table_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the tables that grow with the books."""
    files = Files(spark)
    return sum(files.size(f"{folder}/{name}.parquet") for name in ("part", "orders", "lineitem"))


class Star:
    """The mapping; one method per ERP table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._files: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._files[name]

    def tenant(self) -> DataFrame:
        return constant_table(self.spark, "zid int, name string", UNITS)

    def tenant_config(self) -> DataFrame:
        return constant_table(
            self.spark,
            "zid int, cogs_account string, warehouse_text string",
            UNIT_CONFIG)

    def tenant_project(self) -> DataFrame:
        return constant_table(self.spark, "zid int, xproj string, xacc string", UNIT_PROJECTS)

    def account_group(self) -> DataFrame:
        return constant_table(self.spark, "side string, xgroup string, line string, kind string",
                              [*DEFAULT_GROUPS, ("pl", OWN_GROUP, TAX, "tax")])

    def imtrn(self) -> DataFrame:
        return movements(self.read("lineitem"))

    def imtrn_of(self, prefix: str) -> DataFrame:
        """Movements of one document type; its test reaches the scan as stored columns."""
        return movements(self.read("lineitem").filter(TYPES[prefix]))

    def _lines(self, prefix: str, *columns: str) -> DataFrame:
        return movements(self.read("lineitem").filter(TYPES[prefix])).selectExpr("zid", *columns)

    def caitem(self) -> DataFrame:
        markup = "CASE zid WHEN 100001 THEN p_partkey % 7 WHEN 100003 THEN p_partkey % 5 ELSE 0 END"
        return in_every_unit(self.read("part")).selectExpr(
            "zid", f"{ITEM} AS xitem", "p_name AS xdesc", "p_type AS xgitem", "p_brand AS xbrand",
            f"cast(cast(p_retailprice AS {MONEY}) + cast({markup} AS {MONEY}) AS decimal(19,2)) AS xstdprice",
            *[f"{value} AS {c}" for c, value in more_attributes("old").items()],
            "timestamp_ntz '1990-01-01 00:00:00' AS ztime", "'Manual' AS xcatful", "'Stock-N-Sell' AS xtypestk",
            "'Main' AS xwh", "2 AS xcfiss", "2 AS xcfpck", "2 AS xcfsta")

    def pogdt(self) -> DataFrame:
        return self._lines("GRN-", "xdocnum AS xgrnnum", "xitem", "xqty")

    def pogrn(self) -> DataFrame:
        return (self._lines("GRN-", "xdocnum AS xgrnnum", "xsup", "xdate").groupBy("zid", "xgrnnum")
                .agg(F.max("xsup").alias("xsup"), F.min("xdate").alias("xdate"))
                .selectExpr("*", "concat('IP--', substr(xgrnnum, 5)) AS xpornum"))

    def poord(self) -> DataFrame:
        return self.pogrn().selectExpr("zid", "xpornum", "xsup", "xdate", "'5-Received' AS xstatuspor")

    def poodt(self) -> DataFrame:
        return self._lines("GRN-", "concat('IP--', substr(xdocnum, 5)) AS xpornum", "xitem",
                           "xqty AS xqtyord", f"{share('0.04')} AS xrate")

    def opodt(self) -> DataFrame:
        return self._lines("CO--", "xdocnum AS xordernum", "xitem", "xqty AS xqtyord",
                           f"{share('(1 + xdisc)')} AS xlineamt", f"{share('(1 + xdisc)')} AS xdtwotax",
                           f"{share('xdisc')} AS xdtdisc")

    def opord(self) -> DataFrame:
        return (self._lines("CO--", "xdocnum AS xordernum", "xdate").groupBy("zid", "xordernum")
                .agg(F.min("xdate").alias("xdate")))

    def imtdt(self) -> DataFrame:
        return self._lines("TO--", "xdocnum AS ximtor", "xitem", f"{share('(1 + xdisc)')} AS xdtwotax")

    def imtor(self) -> DataFrame:
        return self.imtdt().select("zid", "ximtor").distinct()

    def imtemptdt(self) -> DataFrame:
        return self._lines("SRE-", "xdocnum AS ximtrnnum", "xitem", f"{share('0.04')} AS xrate")

    def imtemptrn(self) -> DataFrame:
        return self.imtemptdt().selectExpr("zid", "ximtrnnum AS ximtmptrn").distinct()

    def casup(self) -> DataFrame:
        return in_every_unit(self.read("supplier")).selectExpr(
            "zid", f"{code(SUP, 's_suppkey', 6)} AS xsup", "s_name AS xshort",
            "concat('0', cast(s_suppkey AS string)) AS xphone")

    def credit_suppliers(self) -> DataFrame:
        """Suppliers that deliver on credit: the ones with a positive balance."""
        return self.read("supplier").filter("s_acctbal > 0").selectExpr(f"{code(SUP, 's_suppkey', 6)} AS xsup")

    def _places(self) -> DataFrame:
        # nation has 25 rows and region 5 at every scale
        return self.read("nation").join(
            F.broadcast(self.read("region")), F.col("n_regionkey") == F.col("r_regionkey"))

    def cacus(self) -> DataFrame:
        placed = self.read("customer").join(
            F.broadcast(self._places()), F.col("c_nationkey") == F.col("n_nationkey"))
        return in_every_unit(placed).selectExpr(
            "zid", f"{code(CUS, 'c_custkey', 6)} AS xcus", "c_name AS xshort", "c_mktsegment AS xadd2",
            "n_name AS xcity", "r_name AS xstate")

    def glmst(self) -> DataFrame:
        named = in_every_unit(self._places()).withColumns({
            "xacctype": lookup(F.col("n_nationkey"), {n: t for n, t, _ in ACCOUNTS}),
            "xhrc4": lookup(F.col("n_nationkey"), {n: g for n, _, g in ACCOUNTS}),
        })
        return named.selectExpr(
            "zid", f"{account('n_nationkey', 'zid = 100001')} AS xacc", "n_name AS xdesc", "xacctype",
            "concat('H1-', xacctype) AS xhrc1", "xhrc4 AS xhrc2",
            "CASE r_name WHEN 'AFRICA' THEN 'Operating' WHEN 'AMERICA' THEN 'Operating Investment' "
            "WHEN 'ASIA' THEN 'Investing' ELSE 'Financing' END AS xhrc3", "xhrc4")

    def glheader(self) -> DataFrame:
        return self.read("orders").selectExpr(
            f"{unit_of('o_orderkey')} AS zid", f"{VOUCHER} AS xvoucher", "cast(o_orderdate AS date) AS xdate",
            "year(o_orderdate) AS xyear", f"CASE WHEN {OPENING} THEN 0 ELSE month(o_orderdate) END AS xper")

    def gldetail(self) -> DataFrame:
        lines = self.read("lineitem").join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        partner = f"CASE WHEN {SHIPPED} THEN {LINE_SUPPLIER} ELSE {code(CUS, 'o_custkey', 6)} END"
        sign = f"CASE WHEN {ACCOUNT} % 5 IN (0, 3) THEN -1 ELSE 1 END"
        return lines.selectExpr(
            f"{unit_of('o_orderkey')} AS zid", f"{VOUCHER} AS xvoucher",
            f"{account(ACCOUNT, 'o_orderkey % 3 = 0')} AS xacc",
            f"element_at({literal(PROJECTS)}, cast(o_custkey % {len(PROJECTS)} AS int) + 1) AS xproj",
            f"{partner} AS xsub", f"cast(l_extendedprice AS {MONEY}) * {sign} AS xprime")

    def web_orders(self) -> DataFrame:
        return self._web_orders(self.read("orders"))

    def _web_orders(self, orders: DataFrame, *more: str) -> DataFrame:
        named = orders.withColumn(
            "status", lookup(F.expr("cast(o_orderkey % 8 AS int)"), WEB_STATUS))
        done = ("CASE WHEN o_orderkey % 8 = 7 AND o_orderkey % 5 <> 0 "
                "THEN date_add(cast(o_orderdate AS date), cast(o_orderkey % 12 AS int)) END")
        return named.selectExpr(
            "o_orderkey AS id", "status", "o_orderdate AS date_created", f"{done} AS date_completed",
            f"coalesce({done}, date_add(cast(o_orderdate AS date), 1)) AS date_modified",
            f"cast(o_totalprice AS {MONEY}) AS total",
            "CASE WHEN o_orderkey % 9 = 0 THEN concat('call before ', o_orderkey % 24) END AS customer_note", *more)

    def web_order_documents(self) -> DataFrame:
        """Nested order documents of several lines.  A page carries the lines of four
        line numbers and one part class of an order, so no task gathers all lines of a large one."""
        lines = self.read("lineitem").selectExpr(
            "l_orderkey AS id", "l_linenumber AS line", "concat(floor((l_linenumber - 1) / 4), '/', l_partkey % 4) AS page",
            f"named_struct('id', l_partkey, 'name', cast(NULL AS string), 'sku', {LINE_ITEM}) AS item")
        pages = lines.groupBy("id", "page").agg(
            F.sort_array(F.collect_list(F.struct("line", "item"))).alias("lines")).selectExpr(
            "id", "lines.item AS line_items")
        return pages.join(self.web_orders(), "id")

    def order_documents(self) -> DataFrame:
        """Orders as the shop sends them: text fields, dates as ISO text."""
        text = lambda c: f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss\") AS {c}"
        return self.web_orders().selectExpr(
            "id", "status", text("date_created"), text("date_modified"), text("date_completed"),
            "cast(total AS string) AS total", "customer_note")

    def document_lines(self) -> DataFrame:
        """The nested documents as JSON lines whose form has drifted: totals as numbers, a key
        that is new, and some that cannot be read (cut short, no number for an id, no date)."""
        text = lambda c: f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss\")"
        sent = self.web_order_documents().selectExpr(
            "id", "total", f"""concat('{{"id":', CASE WHEN id % 103 = 0 THEN concat('"A', id, '"') ELSE cast(id AS string) END,
                ',"status":"', status, '","date_created":"', CASE WHEN id % 107 = 0 THEN 'soon' ELSE {text('date_created')} END, '"',
                ',"total":', CASE WHEN id % 11 = 0 THEN cast(total AS string) ELSE concat('"', cast(total AS string), '"') END,
                CASE WHEN id % 7 = 0 THEN concat(',"coupon":{{"code":"C', id % 10, '"}}') ELSE '' END,
                ',"line_items":', to_json(line_items), '}}') AS value""")
        return sent.selectExpr("CASE WHEN id % 101 = 0 THEN left(value, length(value) - 5) ELSE value END AS value")

    def _stream(self, name: str) -> DataFrame:
        """The files of a table as a stream; nothing is copied.

        A path without a pattern has to be a folder, and the table may be one file.
        """
        return self.spark.readStream.schema(self.read(name).schema).option("maxFilesPerTrigger", 4).parquet(
            f"{self.folder}/{name}.parque[t]")

    def movement_stream(self) -> DataFrame:
        return movements(self._stream("lineitem"))

    def order_stream(self) -> DataFrame:
        """Changes as polling lands them: each order when created, then when last changed."""
        text = lambda c: f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss\")"
        orders = self._stream("orders").withColumn("landed_at", F.col("_metadata.file_modification_time")).withColumn(
            "landed_file", F.col("_metadata.file_name"))
        known = self._web_orders(orders, "landed_at", "landed_file")
        both = (f"array(named_struct('status', 'processing', 'date_modified', {text('date_created')}, 'row', 0L), "
                f"named_struct('status', status, 'date_modified', {text('date_modified')}, 'row', 1L))")
        return known.selectExpr("id", "date_created", "total", "landed_at", "landed_file", f"explode({both}) AS c").selectExpr(
            "id", "c.date_modified", "c.status", f"{text('date_created')} AS date_created", "cast(total AS string) AS total",
            "named_struct('at', landed_at, 'file', landed_file, 'row', c.row) AS landed")

    def web_products(self) -> DataFrame:
        price = f"cast(p_retailprice AS {MONEY}) + cast(p_partkey % 4 AS {MONEY})"
        return self.read("part").selectExpr(
            "p_partkey AS id", f"CASE WHEN p_partkey % 53 = 0 THEN '' ELSE {ITEM} END AS sku",
            f"CASE WHEN p_partkey % 17 = 0 THEN '' ELSE cast({price} AS string) END AS regular_price",
            "CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'inhouse' ELSE 'nearby' END AS shipping_class")

    def catalog_sheet(self) -> DataFrame:
        """A sheet with every part: known codes to update, bare prefixes to number."""
        return self.read("part").selectExpr(
            "100002 AS zid",
            f"CASE WHEN p_partkey % 2 = 0 THEN {ITEM} WHEN p_partkey % 3 = 0 THEN 'IT-' ELSE 'NB-' END AS xitem",
            "concat('new ', p_name) AS xdesc", "p_type AS xgitem",
            f"cast(cast(p_retailprice AS {MONEY}) + 1 AS decimal(19,2)) AS xstdprice",
            "concat('U', cast(p_size % 5 AS string)) AS xeccrange",
            "CASE WHEN p_size % 3 = 0 THEN concat('V', cast(p_size AS string)) END AS xrandom",
            "'N1' AS xnameonly", "p_brand AS xbrand", "split_part(p_name, ' ', 1) AS xcolor",
            "p_type AS xmaterial",
            *[f"{value} AS {c}" for c, value in more_attributes("new").items() if c not in SHEET_OWN], "p_partkey AS row_id")

    def xcodes(self) -> DataFrame:
        part = self.read("part")
        brands = part.filter("p_size < 2").selectExpr("'Brand' AS xtype", "p_brand AS xcode")
        materials = part.filter("p_type <> 'PROMO'").selectExpr("'Material' AS xtype", "p_type AS xcode")
        return brands.union(materials).distinct().selectExpr("100002 AS zid", "xtype", "xcode")

    def count_history(self) -> DataFrame:
        """Items counted before: the small ones."""
        return in_every_unit(self.read("part").filter("p_size <= 5")).selectExpr(
            "DATE '2001-04-01' AS quarter_start", "zid", f"{ITEM} AS xitem")
