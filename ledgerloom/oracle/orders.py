"""SQL of the web order reports."""

from ledgerloom.oracle.stock import AS_OF
from ledgerloom.oracle.views import code
from ledgerloom.plans.params import DEFAULT as P

LINE_SKU = code("'IT-'", "l.l_partkey", 6)
SHORT, LONG = f"DATE '{P.back(5)}'", f"DATE '{P.back(6000)}'"

# position, status, label
SECTIONS = """(VALUES (1, 'processing', 'processing'), (2, 'order-confirmed', 'order-confirmed'),
    (3, 'will-ecourier', 'Redx Done'), (4, 'will-sundarban', 'Sundarban order confirmed'),
    (5, 'consundorban', 'Sundarban courier done'), (6, 'on-the-way-to-del', 'Out for delivery in Dhaka'),
    (7, 'order-cancelled', 'Cancelled by Customer'), (8, 'completed', 'Order Completed')) AS d(section, status, label)"""

SCOPE = f"""SELECT * FROM web_orders WHERE cast(date_created AS date) <= {AS_OF} AND (
    (status IN ('order-cancelled', 'completed') AND date_created > {SHORT})
    OR (status IN ('processing', 'order-confirmed', 'will-ecourier', 'will-sundarban', 'consundorban',
        'on-the-way-to-del') AND date_created > {LONG}))"""


def age(source: str) -> str:
    days = f"""date_diff('day', cast(date_created AS date),
        CASE WHEN status = 'completed' AND date_completed IS NOT NULL THEN cast(date_completed AS date) ELSE {AS_OF} END)"""
    return f"""SELECT id, status, date_created, date_completed, total, customer_note, {days} AS days_for_order,
        CASE WHEN status = 'completed' THEN 'completed within ' || {days} || ' days'
        ELSE {days} || ' days pass after created' END AS days_pass_order FROM ({source})"""


def section_totals(join: str) -> str:
    return f"""SELECT d.section, d.label, count(o.id) AS n_orders, sum(o.total) AS total,
        min(cast(o.date_created AS date)) AS oldest FROM {SECTIONS} {join} JOIN ({SCOPE}) o ON o.status = d.status GROUP BY 1, 2"""


ORDER_COLUMNS = "id:i status:s date_created:T date_completed:t total:d customer_note:s"
AGE_COLUMNS = "id:i status:s date_created:t date_completed:t total:d customer_note:s days_for_order:i days_pass_order:s"
MODIFIED = "coalesce(date_completed, cast(date_created AS date) + 1)"

# Documents carry the lines of four line numbers and one part class; every damage of the sample goes by the order's id.
SENT = """SELECT DISTINCT l_orderkey AS id, (l_linenumber - 1) // 4 AS part, l_partkey % 4 AS class FROM lineitem"""
UNREAD = """CASE WHEN id % 101 = 0 THEN 'not JSON' WHEN id % 103 = 0 AND id % 107 = 0
    THEN 'id: not bigint; date_created: not timestamp_ntz' WHEN id % 103 = 0 THEN 'id: not bigint'
    WHEN id % 107 = 0 THEN 'date_created: not timestamp_ntz' END"""

QUERIES = {
    "order_lines_landed": (
        f"""SELECT w.id AS order_id, w.status, w.date_created, l.l_partkey AS product_id, {LINE_SKU} AS sku
            FROM lineitem l JOIN web_orders w ON w.id = l.l_orderkey WHERE w.id % 101 <> 0 AND w.id % 103 <> 0 AND w.id % 107 <> 0""",
        "order_id:i status:s date_created:t product_id:i sku:s"),
    "order_rejects": (f"SELECT {UNREAD} AS reason, count(*) AS n FROM ({SENT}) WHERE {UNREAD} IS NOT NULL GROUP BY 1", "reason:s n:i"),
    "order_unknown_keys": (
        f"""SELECT '{{"coupon":{{"code":"C' || cast(s.id % 10 AS varchar) || '"}}}}' AS more, count(*) AS n, sum(w.total) AS total
            FROM ({SENT}) s JOIN web_orders w ON w.id = s.id
            WHERE s.id % 7 = 0 AND s.id % 101 <> 0 AND s.id % 103 <> 0 AND s.id % 107 <> 0 GROUP BY 1""",
        "more:s n:i total:d"),
    "orders_in_scope": (f"SELECT *, {MODIFIED} AS date_modified FROM ({SCOPE})", ORDER_COLUMNS + " date_modified:t"),
    "orders_in_scope_landed": (f"SELECT *, {MODIFIED} AS date_modified FROM ({SCOPE})", ORDER_COLUMNS + " date_modified:t"),
    "recent_orders_landed": (
        f"SELECT *, {MODIFIED} AS date_modified FROM web_orders WHERE date_created >= {SHORT} AND date_created <= {AS_OF}",
        ORDER_COLUMNS + " date_modified:t"),
    "order_age": (age("SELECT * FROM web_orders"), AGE_COLUMNS),
    "order_status_label": (
        f"""SELECT w.*, {MODIFIED} AS date_modified, d.label AS now_status
            FROM web_orders w JOIN {SECTIONS} ON d.status = w.status""",
        ORDER_COLUMNS + " date_modified:t now_status:s"),
    "order_sections": (section_totals(""), "section:i label:s n_orders:i total:d oldest:t"),
    "order_section_detail": (
        f"""SELECT a.*, d.label AS now_status, d.section FROM ({age(SCOPE)}) a JOIN {SECTIONS} ON d.status = a.status""",
        AGE_COLUMNS + " now_status:s section:i"),
    "order_sections_complete": (
        f"""SELECT section, label, n_orders, coalesce(total, 0) AS total, oldest,
            CASE WHEN n_orders = 0 THEN 'no orders' END AS note FROM ({section_totals('LEFT')})""",
        "section:i label:s n_orders:i total:d oldest:t note:s"),
    "order_lines": (
        f"""SELECT w.id AS order_id, w.status, w.date_created, l.l_partkey AS product_id,
            {LINE_SKU} AS sku
            FROM lineitem l JOIN web_orders w ON w.id = l.l_orderkey""",
        "order_id:i status:s date_created:t product_id:i sku:s"),
    "stream_order_status": (
        f"SELECT id, status, strftime(cast({MODIFIED} AS timestamp), '%Y-%m-%dT%H:%M:%S') AS date_modified FROM web_orders",
        "id:i status:s date_modified:s"),
}
