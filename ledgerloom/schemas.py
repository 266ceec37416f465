"""Column types of the source tables and landed documents."""

from __future__ import annotations

MONEY = "decimal(18,2)"

# The 37 columns of the catalog sheet, display header to code.
SHEET_HEADERS = {
    "Business ID": "zid",
    "Item Code": "xitem",
    "Description": "xdesc",
    "Long Description": "xlong",
    "Standard Cost": "xstdcost",
    "Standard Price": "xstdprice",
    "Selling Unit": "xunitsel",
    "Stocking Unit": "xunitstk",
    "Alternative Unit": "xunitalt",
    "Issue Unit": "xunitiss",
    "Packing Unit": "xunitpck",
    "Statistical Unit": "xunitsta",
    "Item Group": "xgitem",
    "Local/Import": "xduty",
    "Country of Origin": "xorigin",
    "Supplier Number": "xsup",
    "Weight": "xwtunit",
    "Weight Unit": "xunitwt",
    "Power": "xitemnew",
    "Voltage": "xitemold",
    "Measurement Unit 1": "xeccrange",
    "Measurement Unit 2": "xrandom",
    "Measurement Unit 3": "xnameonly",
    "Design": "xdrawing",
    "RPM": "xeccnum",
    "Measurement-1": "xscode",
    "Measurement-2": "xresponse",
    "Measurement-3": "xslot",
    "Unit of Length": "xunitlen",
    "Length": "xl",
    "Width": "xw",
    "Height": "xh",
    "Brand": "xbrand",
    "Model": "xalias",
    "Color": "xcolor",
    "Material": "xmaterial",
    "Remarks": "xremark",
}

SHEET_TYPES = {"zid": "int", "xstdcost": MONEY, "xstdprice": MONEY}

# Columns of an item that only an insert fills.
INSERT_DEFAULTS = {"ztime": "timestamp_ntz", "xcatful": "string", "xtypestk": "string", "xwh": "string",
                   "xcfiss": "int", "xcfpck": "int", "xcfsta": "int"}

# The item master: all columns of the sheet and those that an insert fills.
ITEM_COLUMNS = {**{c: SHEET_TYPES.get(c, "string") for c in SHEET_HEADERS.values()}, **INSERT_DEFAULTS}

TABLES = {
    "tenant": "zid int, name string",
    "caitem": ", ".join(f"{c} {kind}" for c, kind in ITEM_COLUMNS.items()),
    "xcodes": "zid int, xtype string, xcode string",
    "imtrn": f"zid int, xitem string, xdate date, xdocnum string, xline int, xsup string, xsign int, "
             f"xqty {MONEY}, xval {MONEY}, xwh string, xyear int, xper int",
    "pogrn": "zid int, xgrnnum string, xpornum string, xsup string, xdate date",
    "pogdt": f"zid int, xgrnnum string, xitem string, xqty {MONEY}",
    "poord": "zid int, xpornum string, xsup string, xdate date, xstatuspor string",
    "poodt": f"zid int, xpornum string, xitem string, xqtyord {MONEY}, xrate {MONEY}",
    "opord": "zid int, xordernum string, xdate date",
    "opodt": f"zid int, xordernum string, xitem string, xqtyord {MONEY}, xlineamt {MONEY}, "
             f"xdtwotax {MONEY}, xdtdisc {MONEY}",
    "imtor": "zid int, ximtor string",
    "imtdt": f"zid int, ximtor string, xitem string, xdtwotax {MONEY}",
    "imtemptrn": "zid int, ximtmptrn string",
    "imtemptdt": f"zid int, ximtrnnum string, xitem string, xrate {MONEY}",
    "casup": "zid int, xsup string, xshort string, xphone string",
    "cacus": "zid int, xcus string, xshort string, xadd2 string, xcity string, xstate string",
    "glmst": "zid int, xacc string, xdesc string, xacctype string, xhrc1 string, xhrc2 string, "
             "xhrc3 string, xhrc4 string",
    "glheader": "zid int, xvoucher string, xdate date, xyear int, xper int",
    "gldetail": f"zid int, xvoucher string, xacc string, xproj string, xsub string, xprime {MONEY}",
    "count_history": "quarter_start date, zid int, xitem string",
    "tenant_config": "zid int, cogs_account string, warehouse_text string",
    # Projects of a unit, and the cash accounts of each.
    "tenant_project": "zid int, xproj string, xacc string",
    # Statement line and kind (tax, interest, depreciation) of an account group; side pl or bs.
    "account_group": "side string, xgroup string, line string, kind string",
}

WEB_ORDER = (
    "id bigint, status string, date_created string, date_modified string, date_completed string, "
    "total string, customer_note string, "
    "line_items array<struct<id: bigint, name: string, sku: string>>"
)

WEB_PRODUCT = (
    "id bigint, sku string, regular_price string, shipping_class string, "
    "categories array<struct<id: bigint, name: string>>, "
    "meta_data array<struct<key: string, value: string>>"
)

STOCK_SNAPSHOT = (
    "sku string, name string, central bigint, store bigint, ecommerce bigint, sum_of_stock bigint"
)
