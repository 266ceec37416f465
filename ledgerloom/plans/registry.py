"""Every report under its key, run over a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.model import CENTRAL, ECOMMERCE, STORE, Model
from ledgerloom.operators import (
    catalog,
    counting,
    fifo,
    ledger,
    orders,
    pricing,
    profit,
    purchasing,
    shipments,
    statements,
    stock,
    suppliers,
    units,
)
from ledgerloom.plans.params import DEFAULT as P
from ledgerloom.session import sized_session
from ledgerloom.sources import controls, documents, history, layout
from ledgerloom.sources.pages import land_pages, read_pages
from ledgerloom.sources.periods import PeriodLedger
from ledgerloom.sources.shared import new_folder
from ledgerloom.sources.sinks import update_batches
from ledgerloom.sources.star import table_bytes
from ledgerloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
YEARS = list(P.years)
SPAN = (YEARS, P.first_month, P.last_month)
LOADED_AT = datetime(2001, 6, 30, 9, 0, 0)
#: Buckets of small tables; larger ones have more, so that a bucket stays as large.
LAID_BUCKETS = 8
WINDOW = P.profit_window
LEDGER = (P.ledger_start, P.ledger_end)


def present(df: DataFrame) -> DataFrame:
    """Plain report columns: money as double, counts as bigint, dates as ISO text."""
    def plain(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            return column.cast("double").alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return column.cast("bigint").alias(name)
        if kind == "date":
            return F.date_format(column, "yyyy-MM-dd").alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name)
        return column.alias(name)

    return df.select(*[plain(n, k) for n, k in df.dtypes])


def query(fn: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
    """Register a report under the name of its function."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        own = sized_session(spark, table_bytes(spark, folder))
        return present(fn(Model.from_star(own, folder)))

    QUERIES[fn.__name__] = run
    return fn


# --- stock and movements ---------------------------------------------------

@query
def inventory_balance(m):
    return stock.inventory_balance(m)


@query
def inventory_balance_laid_out(m):
    """The same balance from movements and items in buckets of their key: no shuffle."""
    folder = new_folder(m.spark, "layout")
    prefix = f"laid_{uuid.uuid4().hex}_"
    tables = ["imtrn", "caitem"]
    layout.write_layout(m, folder, layout.buckets_for(m, tables, LAID_BUCKETS), tables, prefix)
    return stock.inventory_balance(layout.open_layout(m.spark, folder, m, prefix))


@query
def inventory_value_published(m):
    """Value by warehouse as it was published: it shows only if it adds up to the movements it was made from."""
    until = m.imtrn.filter(F.col("xdate") <= F.lit(str(P.as_of)).cast("date"))
    ledger_rows = controls.Controlled(until, {"value": "sum(xval * xsign)"})
    path = new_folder(m.spark, "published")
    report = stock.inventory_value_by_warehouse(m.replace(imtrn=ledger_rows.rows), P.as_of)
    controls.publish(report, path, {"value": "sum(value)"}, ledger_rows)
    return controls.read_published(m.spark, path)


@query
def last_movement(m):
    return stock.last_movement(m)


@query
def last_receipt_movement(m):
    return stock.last_movement(m, "GRN-")


@query
def inventory_report(m):
    return stock.inventory_report(m)


@query
def inventory_value_by_warehouse(m):
    return stock.inventory_value_by_warehouse(m, P.as_of)


@query
def inventory_value_totals(m):
    return stock.inventory_value_totals(m, P.as_of)


@query
def stock_as_of(m):
    return stock.stock_as_of(m, P.as_of, received_since(m))


def received_since(m: Model) -> DataFrame:
    """Items of the import orders of the last year."""
    return purchasing.shipment_items(m, P.back(365)).select("xitem")


@query
def movement_total(m):
    return stock.movement_totals(m, P.back(365))


@query
def day_over_day_stock(m):
    return stock.day_over_day_stock(m, P.as_of)


@query
def multi_branch_stock(m):
    return stock.multi_branch_stock(m)


def _two_days(m: Model) -> tuple[DataFrame, DataFrame]:
    return stock.multi_branch_stock(m, P.as_of), stock.multi_branch_stock(m, P.back(1))


@query
def stock_changes(m):
    return stock.stock_changes(*_two_days(m))


#: Every so many line items of the sample arrive late, dated back into months that are closed.
LATE = 50


def _by_period(m: Model, name: str, rows: DataFrame, late: str, keys: list[str], measures: dict[str, str]) -> PeriodLedger:
    """The ledger in two batches: what came in time, and what came late for any month."""
    kept = PeriodLedger(m.spark, new_folder(m.spark, name), keys, measures)
    kept.add(rows.filter(f"NOT ({late})"), 0)
    kept.add(rows.filter(late), 1)
    return kept


def _movement_periods(m: Model) -> PeriodLedger:
    rows = m.imtrn.select("zid", "xitem", "xdate", "xdocnum", "xyear", "xper", "xqty", "xval", "xsign")
    return _by_period(m, "movements", rows, f"crc32(xdocnum) % {LATE} = 0", stock.KEY,
                      {"qty": "xqty * xsign", "value": "xval * xsign"})


@query
def stock_as_of_periods(m):
    """Stock as of a day from sums of closed periods and one month of movements."""
    balances = _movement_periods(m).as_of(P.as_of)
    return stock.only_items(balances, received_since(m)).select("zid", "xitem", F.col("qty").alias("stock"))


@query
def day_over_day_stock_periods(m):
    kept = _movement_periods(m)
    today, before = kept.as_of(P.as_of), kept.as_of(P.back(1))
    return today.withColumnRenamed("qty", "today_stock").join(before.withColumnRenamed("qty", "yesterday_stock"), stock.KEY, "left").select(
        *stock.KEY, F.coalesce("yesterday_stock", F.lit(0)).cast("decimal(38,2)").alias("yesterday_stock"), "today_stock")


@query
def stock_intervals(m):
    """Every balance an item ever had, with the days it held."""
    return history.stock_intervals(m.imtrn)


@query
def stock_changes_by_history(m):
    """The same changes, both days looked up in the validity intervals."""
    kept = history.History(m.spark, new_folder(m.spark, "stock-history"), "zid int, xitem string", "inventory decimal(38,2)")
    kept.load(history.stock_intervals(m.imtrn), P.as_of)
    today, before = (stock.multi_branch_stock(m, balances=kept.as_of(d)) for d in (P.as_of, P.back(1)))
    return stock.stock_changes(today, before)


@query
def negative_movements(m):
    return stock.negative_movements(m)


@query
def negative_balances(m):
    return stock.negative_movements(m, on="balance")


@query
def shipping_class(m):
    return stock.shipping_class(m.web_products, *_two_days(m))


@query
def stock_quantity_sync(m):
    return stock.stock_quantity_sync(m.web_products, stock.multi_branch_stock(m))


@query
def stock_quantity_sync_nonzero(m):
    return stock.stock_quantity_sync(m.web_products, stock.multi_branch_stock(m), drop_zero=True)


@query
def update_batches_of_stock(m):
    changes = stock.stock_quantity_sync(m.web_products, stock.multi_branch_stock(m))
    return update_batches(changes, P.batch_size)


QUERIES["update_batches"] = QUERIES.pop("update_batches_of_stock")


# --- purchasing, shipments, suppliers --------------------------------------

@query
def purchase_receipts(m):
    return purchasing.purchase_receipts(m, P.back(365))


@query
def purchase_summary(m):
    return purchasing.purchase_summary(m, P.back(365), received_since(m))


@query
def shipment_items(m):
    return purchasing.shipment_items(m, P.back(365))


@query
def shipment_receipts(m):
    return purchasing.shipment_receipts(m, P.back(365))


def _tracking(m: Model) -> DataFrame:
    return shipments.shipment_tracking(m, P.as_of, P.back(365))


@query
def shipment_tracking(m):
    return _tracking(m)


@query
def shipment_errors(m):
    return shipments.shipment_errors(_tracking(m))


@query
def shipment_summary(m):
    return shipments.shipment_summary(_tracking(m))


@query
def shipment_zero_stock(m):
    return shipments.shipment_zero_stock(_tracking(m))


@query
def last_supplier_for_orders(m):
    return purchasing.last_supplier_for_orders(m, orders.order_lines(m.web_order_documents))


@query
def supplier_item_profile(m):
    return suppliers.supplier_item_profile(m)


@query
def credit_supplier_detail(m):
    return suppliers.credit_supplier_detail(m, m.credit_suppliers, P.as_of)


@query
def rest_supplier_detail(m):
    return suppliers.rest_supplier_detail(m, m.credit_suppliers, P.as_of)


@query
def credit_supplier_financials(m):
    return suppliers.credit_supplier_financials(
        suppliers.credit_supplier_detail(m, m.credit_suppliers, P.as_of))


@query
def rest_supplier_financials(m):
    return suppliers.rest_supplier_financials(
        suppliers.rest_supplier_detail(m, m.credit_suppliers, P.as_of))


@query
def supplier_last_receipt(m):
    return purchasing.supplier_last_receipt(m, None)


@query
def sales_of_purchase(m):
    return purchasing.sales_of_purchase(m, P.back(30))


@query
def sales_of_purchase_summary(m):
    return purchasing.sales_of_purchase_summary(m, P.back(30), None)


@query
def receipt_sales(m):
    """Which receipts were sold, first in, first out; every unit counts once."""
    return fifo.receipt_sales(m.imtrn)


@query
def stock_layers(m):
    return fifo.stock_layers(m.imtrn)


@query
def receipts_of_day(m):
    return purchasing.receipts_of_day(m, P.check_day, None)


@query
def sales_qty_of_day(m):
    return purchasing.sales_qty_of_day(m, P.check_day, zid=None)


@query
def receipt_inventory_check(m):
    return purchasing.receipt_inventory_check(m, P.check_day, None)


# --- cycle counting ---------------------------------------------------------

def _pool(m: Model) -> DataFrame:
    counted = m.count_history.filter(F.col("quarter_start") == F.lit("2001-04-01").cast("date"))
    return counting.count_pool(m, counted, P.pool)


@query
def count_pool(m):
    return _pool(m)


def _picks(m: Model) -> DataFrame:
    """Picks of the units that are chosen to count."""
    pool = _pool(m)
    return counting.count_picks(pool, P.picks, P.seed, counting.choose_units(pool, P.units, P.seed))


@query
def count_picks(m):
    return _picks(m)


@query
def count_history(m):
    return counting.count_history(m.count_history, _picks(m), P.as_of)


@query
def choose_units(m):
    return counting.choose_units(_pool(m), P.units, P.seed)


@query
def working_days(m):
    return counting.working_days(m.imtrn, holidays=list(P.holidays))


# --- catalog ----------------------------------------------------------------

def _central_items(m: Model) -> DataFrame:
    return m.caitem.filter(F.col("zid") == CENTRAL)


@query
def attribute_codes(m):
    return catalog.attribute_codes(m.catalog_sheet)


@query
def missing_codes(m):
    return catalog.missing_codes(m.catalog_sheet, m.xcodes)


@query
def catalog_existing(m):
    return catalog.catalog_existing(m.catalog_sheet, _central_items(m))


@query
def catalog_new(m):
    return catalog.catalog_new(m.catalog_sheet, _central_items(m))


def _coded(m: Model) -> DataFrame:
    items = _central_items(m)
    return catalog.generate_item_codes(catalog.catalog_new(m.catalog_sheet, items), items)


@query
def generate_item_codes(m):
    return _coded(m).select("zid", "row_id", "prefix", "new_code")


@query
def new_item_defaults(m):
    return catalog.new_item_defaults(_coded(m), "Central", LOADED_AT)


@query
def catalog_upsert(m):
    return catalog.catalog_upsert(m.caitem, m.catalog_sheet, warehouse="Central", ts=LOADED_AT)


# --- prices -----------------------------------------------------------------

@query
def price_compare(m):
    return pricing.price_compare(m.web_products, m.caitem, ECOMMERCE)


@query
def erp_price_updates(m):
    return pricing.erp_price_updates(m.web_products, m.caitem)


@query
def web_price_updates(m):
    return pricing.web_price_updates(m.web_products, m.caitem, STORE)


@query
def store_cheaper(m):
    return pricing.store_cheaper(m.web_products, m.caitem, STORE)


# --- web orders ---------------------------------------------------------------

@query
def orders_in_scope(m):
    return orders.orders_in_scope(m.web_orders, P.as_of)


#: Documents of a page of the sample; the shop sends 100, which would be many small files here.
LANDED_PAGE = 2_000


def _landed(docs: DataFrame, date: str = "date_created") -> str:
    folder = new_folder(docs.sparkSession, "landed")
    land_pages(docs, folder, 0, date, LANDED_PAGE)
    return folder


@query
def orders_in_scope_landed(m):
    """The same orders from landed pages; those before the longest look-back are not opened."""
    folder = _landed(m.order_documents)
    docs = read_pages(m.spark, folder, after=str(P.back(orders.ALL_DAYS)))
    return orders.orders_in_scope(orders.typed(docs), P.as_of)


@query
def recent_orders_landed(m):
    """Orders of the last days from landed pages; few pages reach into them."""
    since = str(P.back(orders.RECENT_DAYS))
    docs = read_pages(m.spark, _landed(m.order_documents), after=since)
    return orders.typed(docs).filter(F.col("date_created") <= F.lit(str(P.as_of)).cast("timestamp_ntz"))


@query
def price_compare_landed(m):
    """Prices from landed product pages against the item master."""
    return pricing.price_compare(read_pages(m.spark, _landed(m.web_products), "product"), m.caitem, ECOMMERCE)


@query
def order_age(m):
    return orders.order_age(m.web_orders, P.as_of)


@query
def order_status_label(m):
    return orders.order_status_label(m.web_orders)


@query
def order_sections(m):
    return orders.order_sections(m.web_orders, P.as_of)


@query
def order_section_detail(m):
    return orders.order_section_detail(m.web_orders, P.as_of)


@query
def order_sections_complete(m):
    return orders.order_sections_complete(m.web_orders, P.as_of)


@query
def order_lines(m):
    return orders.order_lines(m.web_order_documents)


def _documents(m: Model) -> str:
    folder = new_folder(m.spark, "documents")
    documents.land_documents(m.document_lines, folder, 0, documents.ORDER)
    return folder


@query
def order_lines_landed(m):
    """Order lines of documents whose form has drifted; those that cannot be read are set aside."""
    return orders.order_lines(documents.read_documents(m.spark, _documents(m), documents.ORDER))


@query
def order_rejects(m):
    """Documents that were set aside, by reason."""
    return documents.read_rejects(m.spark, _documents(m)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def order_unknown_keys(m):
    """What the documents hold beyond the known fields."""
    kept = documents.read_documents(m.spark, _documents(m), documents.ORDER)
    return kept.where("more IS NOT NULL").groupBy("more").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("total").cast("decimal(18,2)")).alias("total"))


# --- profit -------------------------------------------------------------------

@query
def sales_cogs(m):
    return profit.sales_cogs(m, date(1995, 1, 1), P.as_of)


@query
def transfer_cogs(m):
    return profit.transfer_cogs(m, date(1995, 1, 1), P.as_of)


@query
def sales_returns(m):
    return profit.sales_returns(m, date(1995, 1, 1), P.as_of)


@query
def item_profit(m):
    return profit.item_profit(m, *WINDOW)


@query
def gl_income_expenditure(m):
    return profit.gl_income_expenditure(m, *WINDOW)


@query
def business_profit_summary(m):
    return profit.business_profit_summary(m, *WINDOW)


@query
def group_profit_ratio(m):
    return profit.group_profit_ratio(m, *WINDOW)


# --- ledger and statements ------------------------------------------------------

@query
def cash_vouchers_activity(m):
    return ledger.cash_vouchers_activity(m, *LEDGER)


@query
def monthly_cash_flow(m):
    return ledger.monthly_cash_flow(m, *LEDGER, P.months)


@query
def monthly_pl(m):
    return ledger.monthly_pl(m, *LEDGER, P.pl_months)


@query
def monthly_payables(m):
    return ledger.monthly_payables(m, P.ledger_end)


@query
def monthly_receivables(m):
    return ledger.monthly_receivables(m, P.ledger_end)


@query
def monthly_inventory_value(m):
    return ledger.monthly_inventory_value(m, P.ledger_end)


@query
def monthly_inventory_value_periods(m):
    """The same values from the sums of closed periods and the last month's movements."""
    return ledger.monthly_inventory_value_of(m, _movement_periods(m), P.ledger_end)


@query
def gl_position_periods(m):
    """Assets and liabilities from the sums of periods alone; no voucher is read."""
    entries = ledger.gl_entries(m).select("zid", "xacc", "xvoucher", "xyear", "xper", "xprime")
    kept = _by_period(m, "vouchers", entries, f"crc32(xvoucher) % {LATE} = 0", ["zid", "xacc"], {"amount": "xprime"})
    return ledger.gl_position_of(m, kept, *SPAN)


@query
def gl_master(m):
    return ledger.gl_master(m, "pl")


@query
def gl_master_balance(m):
    return ledger.gl_master(m, "bs")


@query
def gl_activity(m):
    return ledger.gl_activity(m, *SPAN)


@query
def gl_position(m):
    return ledger.gl_position(m, *SPAN)


@query
def gl_position_of_year(m):
    return ledger.gl_position(m, *SPAN, mode="year")


def _pl(m: Model) -> DataFrame:
    return ledger.comparative(m, "pl", *SPAN)


@query
def comparative_pl(m):
    return _pl(m)


@query
def comparative_bs(m):
    return ledger.comparative(m, "bs", *SPAN)


@query
def comparative_project(m):
    return ledger.comparative(m, "pl", *SPAN, project=P.project)


@query
def comparative_project_bs(m):
    return ledger.comparative(m, "bs", *SPAN, project=P.project)


@query
def level_summary(m):
    return ledger.level_summary(_pl(m), 3, YEARS)


@query
def level_summary_class(m):
    return ledger.level_summary(_pl(m), 1, YEARS)


@query
def level_summary_balance(m):
    return ledger.level_summary(ledger.comparative(m, "bs", *SPAN), 4, YEARS, "Balance")


@query
def income_statement(m):
    return statements.income_statement(m, *SPAN)


@query
def balance_sheet(m):
    return statements.balance_sheet(m, *SPAN)


@query
def cash_flow_statement(m):
    return statements.cash_flow_statement(m, *SPAN)


@query
def cash_flow_statement_grouped(m):
    return statements.cash_flow_statement(m, *SPAN, layout="grouped")


@query
def financial_ratios(m):
    return statements.financial_ratios(m, *SPAN)


@query
def statement_report(m):
    return statements.statement_report(m, *SPAN)


@query
def tenant_income(m):
    return units.tenant_income(m, _pl(m), YEARS)


@query
def tenant_cogs(m):
    return units.tenant_cogs(m, _pl(m), YEARS)


@query
def tenant_expense(m):
    return units.tenant_expense(m, _pl(m), YEARS)


@query
def tenant_profit(m):
    return units.tenant_profit(m, _pl(m), YEARS)


@query
def tenant_ebitda(m):
    return units.tenant_ebitda(m, _pl(m), YEARS)


@query
def tenant_tax(m):
    return units.tenant_tax(m, _pl(m), YEARS)


@query
def tenant_interest(m):
    return units.tenant_interest(m, _pl(m), YEARS)


# --- streams ------------------------------------------------------------------

@query
def stream_order_status(m):
    base = new_folder(m.spark, "order-status")
    state, checkpoint = jobs.OrderState(m.spark, f"{base}/state"), f"{base}/checkpoint"
    jobs.stream_order_status(m.order_stream, state, checkpoint).awaitTermination()
    return state.state(jobs.last_batch(m.spark, checkpoint)).select("id", "status", "date_modified")


@query
def stream_stock_balance(m):
    base = new_folder(m.spark, "stock-balance")
    log, checkpoint = jobs.balance_log(m.spark, f"{base}/log"), f"{base}/checkpoint"
    jobs.stream_stock_balance(m.movement_stream, log, checkpoint).awaitTermination()
    return log.state(jobs.last_batch(m.spark, checkpoint)).select("zid", "xitem", "inventory")


@query
def stream_stock_changes(m):
    """Items whose balance the movements after a day changed, against that day's snapshot."""
    base = new_folder(m.spark, "stock-changes")
    state, checkpoint = jobs.BalanceState(m.spark, f"{base}/state"), f"{base}/checkpoint"
    day = F.lit(str(P.as_of)).cast("date")
    before = jobs.running_balances(m.imtrn.filter(F.col("xdate") <= day))
    jobs.stream_stock_changes(m.movement_stream.filter(F.col("xdate") > day), state, checkpoint, before).awaitTermination()
    return jobs.changed_since(state, jobs.last_batch(m.spark, checkpoint))
