"""The same queries in SQL for DuckDB, written row by row without pre-aggregation."""

from __future__ import annotations

import re

from checks import fixture
from tallybook import fixed
from tallybook.operators.row_checks import ITEM_PRICE_REJECT_COLUMNS, SELLER_REJECT_COLUMNS

SC_COLUMNS = (
    "booking_period, oms_id_sales_order_item, order_nr, id_supplier, short_code, supplier_name, "
    "id_transaction_type, transaction_type, CAST(transaction_value AS DOUBLE) AS transaction_value, "
    "comment"
)
EXTRACT_COLUMNS = (
    "id_transaction, oms_id_sales_order_item, order_nr, id_supplier, short_code, supplier_name, "
    "transaction_type, id_transaction_type, CAST(transaction_value AS DOUBLE) AS transaction_value, "
    "id_transaction_statement, statement_start_date, statement_end_date, comment, booking_period"
)
ITEM_COLUMNS = (
    SC_COLUMNS + ", item_status, payment_method, shipment_provider_name, "
    "CAST(paid_price AS DOUBLE) AS paid_price, ledger_map_key"
)
PRICE_COLUMNS = (
    SC_COLUMNS + ", item_status, payment_method, shipment_provider_name, "
    "CAST(paid_price AS DOUBLE) AS paid_price, CAST(voucher AS DOUBLE) AS voucher, "
    "ledger, subledger, beneficiary_code"
)

EXPORT_COLUMNS = (
    "oms_id_sales_order_item, order_nr, id_supplier, short_code, supplier_name, transaction_type, "
    "CAST(transaction_value AS DOUBLE) AS transaction_value, comment, item_status, payment_method, "
    "shipment_provider_name, CAST(paid_price AS DOUBLE) AS paid_price, "
    "CAST(voucher AS DOUBLE) AS voucher, ledger, subledger, beneficiary_code"
)


def _blank_number(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR {column} = 0 THEN '{column}: cannot be blank' END"
    )


def _blank_text(column: str, label: str | None = None) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR {column} = '' "
        f"THEN '{label or column}: cannot be blank' END"
    )


_ORDER_NR = r"""CASE WHEN order_nr IS NULL OR order_nr = '' THEN 'order_nr: cannot be blank'
    WHEN NOT regexp_matches(order_nr, '\A[-+]?(0|[1-9][0-9]*)\z')
    THEN 'order_nr: must be an integer number' END"""


def _error(*messages: str) -> str:
    text = f"concat_ws('; ', {', '.join(messages)})"
    return f"CASE WHEN {text} <> '' THEN {text} || '.' END AS error"


_SELLER_ERROR = _error(
    _blank_number("id_supplier"),
    _blank_number("id_transaction"),
    _blank_number("id_transaction_statement"),
    _blank_number("id_transaction_type"),
    _blank_number("oms_id_sales_order_item"),
    _ORDER_NR,
    _blank_text("short_code"),
    "CASE WHEN statement_end_date IS NULL THEN 'statement_end_date: cannot be blank' END",
    "CASE WHEN statement_start_date IS NULL THEN 'statement_start_date: cannot be blank' END",
    _blank_text("transaction_type"),
    _blank_number("transaction_value"),
)
_ITEM_ERROR = _error(
    _blank_number("id_supplier"),
    _blank_text("item_status"),
    _blank_number("oms_id_sales_order_item"),
    _ORDER_NR,
    _blank_number("paid_price"),
    _blank_text("payment_method"),
    _blank_text("shipment_provider_name"),
    _blank_text("short_code"),
    _blank_text("transaction_type"),
    _blank_number("transaction_value"),
)


# Items of the seller side with the number of their order, as one relation.
_PLACED = """
    SELECT id_sales_order_item AS item, src_id,
           (SELECT max(order_nr) FROM seller_order WHERE id_sales_order = fk_sales_order) AS number
    FROM seller_order_item"""


def _extract(days: str = "true") -> str:
    """Each transaction of the days with what its four references name, or nothing."""
    return f"""
    SELECT id_transaction, placed.src_id AS oms_id_sales_order_item, placed.number AS order_nr,
           id_seller AS id_supplier, short_code, seller.name AS supplier_name,
           statement_group.name AS transaction_type,
           id_tre2_account_statement_group AS id_transaction_type,
           value AS transaction_value, id_transaction_statement,
           CAST(start_date AS VARCHAR) AS statement_start_date,
           CAST(end_date AS VARCHAR) AS statement_end_date,
           description AS comment, strftime(created_at, '%Y-%m-01') AS booking_period
    FROM (SELECT * FROM txn WHERE {days}) booked
    LEFT JOIN ({_PLACED}) placed ON ref = placed.item
    LEFT JOIN seller ON id_seller = fk_seller
    LEFT JOIN statement_group
           ON id_tre2_account_statement_group = fk_tre2_account_statement_group
    LEFT JOIN statement ON id_transaction_statement = fk_transaction_statement"""


_MONTH = "created_at >= DATE '1996-12-01' AND created_at < DATE '1997-01-01'"

# The least provider id of an item's packages; NULL if it has none.
_SHIPPED_BY = """
    SELECT box.fk_sales_order_item AS item, min(sent.fk_shipment_provider) AS provider_ref
    FROM package_item box, dispatching sent
    WHERE box.fk_package = sent.fk_package GROUP BY item"""

# What is known of an item apart from its packages; doubled rows are ranked.
_ORDERED = """
    SELECT id_sales_order_item AS item, paid_price,
           (SELECT max(name) FROM item_status
            WHERE id_sales_order_item_status = fk_sales_order_item_status) AS item_status,
           (SELECT max(payment_method) FROM order_head
            WHERE id_sales_order = fk_sales_order) AS payment_method
    FROM order_item"""

_OMS = f"""
    SELECT item AS oms_id_sales_order_item, first.item_status, first.payment_method,
           shipment_provider_name, first.paid_price
    FROM (SELECT item, min_by(struct_pack(item_status := item_status,
                 payment_method := payment_method, paid_price := paid_price), rank) AS first
          FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY
                       item_status NULLS LAST, payment_method NULLS LAST, paid_price NULLS LAST)
                       AS rank FROM ({_ORDERED}) every_row)
          GROUP BY item) ordered
    LEFT JOIN ({_SHIPPED_BY}) shipped USING (item)
    LEFT JOIN provider ON provider_ref = id_shipment_provider
    WHERE EXISTS (SELECT 1 FROM sc WHERE sc.oms_id_sales_order_item = item)"""

_FLAT_SC = """
    SELECT CAST(CAST(date_trunc('month', created_at) AS DATE) AS VARCHAR) AS booking_period, r.*
    FROM flat_raw r
    WHERE short_code NOT IN (SELECT short_code FROM retail)
      AND id_supplier <> 0 AND transaction_value <> 0 AND oms_id_sales_order_item <> 0"""

_FLAT_OMS = """
    SELECT * EXCLUDE (n) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY oms_id_sales_order_item
            ORDER BY item_status, payment_method, shipment_provider_name, paid_price) AS n
        FROM flat_orders) ranked WHERE n = 1"""

# Steps of a booking run after the extract.
_STEPS = {
    "no_retail": """
        SELECT e.* FROM extract e
        WHERE NOT EXISTS (SELECT 1 FROM retail r WHERE r.short_code = e.short_code)""",
    "sc_checked": f"SELECT *, {_SELLER_ERROR} FROM no_retail",
    "sc": "SELECT * FROM sc_checked WHERE error IS NULL",
    "oms": _OMS,
    "lmap": """
        SELECT concat(transaction_type, '-', item_status, '-', payment_method, '-',
                      shipment_provider_name) AS ledger_map_key, ledger, subledger
        FROM ledger_rows""",
    "item_prices": """
        SELECT sc.* , oms.item_status, oms.payment_method, oms.shipment_provider_name,
               oms.paid_price,
               sc.transaction_type || '-' || oms.item_status || '-' || oms.payment_method || '-'
                   || oms.shipment_provider_name AS ledger_map_key
        FROM sc LEFT JOIN oms ON oms.oms_id_sales_order_item = sc.oms_id_sales_order_item
        WHERE sc.id_transaction_type IN (17, 18)""",
    "item_checked": f"SELECT * EXCLUDE (error), {_ITEM_ERROR} FROM item_prices",
    "item_valid": "SELECT * FROM item_checked WHERE error IS NULL",
    "ipc": """
        SELECT v.*, v.transaction_value - v.paid_price AS voucher, m.ledger, m.subledger,
               b.beneficiary_code
        FROM item_valid v
        LEFT JOIN lmap m ON m.ledger_map_key = v.ledger_map_key
        LEFT JOIN benef b ON b.short_code = v.short_code
        WHERE v.id_transaction_type = 17""",
    "ipt": """
        SELECT v.* REPLACE (v.paid_price * -1 AS paid_price),
               v.transaction_value + v.paid_price AS voucher, m.ledger, m.subledger,
               b.beneficiary_code
        FROM item_valid v
        LEFT JOIN lmap m ON m.ledger_map_key = v.ledger_map_key
        LEFT JOIN benef b ON b.short_code = v.short_code
        WHERE v.id_transaction_type = 18""",
    "comm": """
        SELECT sc.*, b.beneficiary_code
        FROM sc LEFT JOIN benef b ON b.short_code = sc.short_code
        WHERE sc.id_transaction_type IN (78, 77, 2, 19)""",
    "p_voucher": """
        SELECT booking_period, CAST(62002 AS BIGINT) AS account_code,
               CAST(NULL AS BIGINT) AS account_free, CAST(sum(voucher) AS DOUBLE) AS amount
        FROM (SELECT booking_period, voucher FROM ipc
              UNION ALL SELECT booking_period, voucher FROM ipt) v
        GROUP BY booking_period""",
    "p_ipc": f"""
        SELECT booking_period, CAST(ledger AS BIGINT) AS account_code,
               CAST(subledger AS BIGINT) AS account_free,
               CAST(sum(paid_price) AS DOUBLE) AS amount
        FROM ipc WHERE ledger IN {fixed.LEDGERS_BOOKED_BY_SUBLEDGER}
        GROUP BY booking_period, ledger, subledger""",
    "p_ipt": f"""
        SELECT booking_period, CAST(ledger AS BIGINT) AS account_code,
               CAST(subledger AS BIGINT) AS account_free,
               CAST(sum(paid_price) AS DOUBLE) AS amount
        FROM ipt WHERE ledger IN {fixed.LEDGERS_BOOKED_BY_SUBLEDGER}
        GROUP BY booking_period, ledger, subledger""",
    "p_vat": """
        SELECT booking_period, CAST(32021 AS BIGINT) AS account_code,
               CAST(NULL AS BIGINT) AS account_free,
               CAST(sum(transaction_value) AS DOUBLE) * -1 * 100 / 109 * 0.09 AS amount
        FROM comm GROUP BY booking_period""",
    "p_revenue": """
        SELECT booking_period, CAST(62001 AS BIGINT) AS account_code,
               CAST(beneficiary_code AS BIGINT) AS account_free,
               CAST(sum(transaction_value) AS DOUBLE) * -1 * 100 / 109 AS amount
        FROM comm GROUP BY booking_period, beneficiary_code""",
    # The other side of everything that was sold or charged: the whole values, by seller.
    "p_total": """
        SELECT booking_period, CAST(31002 AS BIGINT) AS account_code,
               CAST(beneficiary_code AS BIGINT) AS account_free,
               (CAST(coalesce(sum(transaction_value) FILTER (WHERE is_price), 0) AS DOUBLE)
                + CAST(coalesce(sum(transaction_value) FILTER (WHERE NOT is_price), 0) AS DOUBLE)
                  * -1 * 100 / 109
                + CAST(coalesce(sum(transaction_value) FILTER (WHERE NOT is_price), 0) AS DOUBLE)
                  * -1 * 100 / 109 * 0.09) * -1 AS amount
        FROM (SELECT booking_period, short_code, transaction_value, true AS is_price
              FROM item_valid
              UNION ALL SELECT booking_period, short_code, transaction_value, false FROM comm) sold
        LEFT JOIN benef USING (short_code)
        GROUP BY booking_period, beneficiary_code""",
    "template": """
        SELECT 'voucher' AS posting, * FROM p_voucher
        UNION ALL SELECT 'ipc_paid_price', * FROM p_ipc
        UNION ALL SELECT 'ipt_paid_price', * FROM p_ipt
        UNION ALL SELECT 'commission_vat', * FROM p_vat
        UNION ALL SELECT 'commission_revenue', * FROM p_revenue
        UNION ALL SELECT 'total', * FROM p_total""",
}


def _sql(select: str, steps: dict[str, str]) -> str:
    """``select`` preceded by the steps and fixture views it needs."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_]+", text)):
            if word in steps and word not in wanted:
                wanted.add(word)
                visit(steps[word])

    visit(select)
    chain = {name: sql for name, sql in steps.items() if name in wanted}
    views = fixture.needed_views(" ".join([*chain.values(), select]))
    parts = [f"{name} AS ({sql})" for name, sql in (views | chain).items()]
    return f"WITH {', '.join(parts)} {select}".format(**{t: t for t in fixture.GIVEN})


WHOLE = {"extract": _extract()} | _STEPS
ONE_MONTH = {"extract": _extract(_MONTH)} | _STEPS
FLAT = {
    "sc": _FLAT_SC,
    "oms": _FLAT_OMS,
} | {k: v for k, v in _STEPS.items() if k not in ("no_retail", "sc_checked", "sc", "oms")}
# The flat rows carry no error column to leave out.
FLAT["item_checked"] = f"SELECT *, {_ITEM_ERROR} FROM item_prices"

_BUCKET = (
    "CASE "
    + " ".join(
        f"WHEN id_transaction_type IN ({', '.join(map(str, ids))}) THEN '{name}'"
        for name, ids in fixed.BUCKETS.items()
    )
    + " END"
)
_ROUTED = f"SELECT {SC_COLUMNS}, {_BUCKET} AS bucket FROM sc WHERE {_BUCKET} IS NOT NULL"
_LINES = "SELECT booking_period, account_code, account_free, amount FROM"


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _upload_error(*fields: tuple[str, str, list[tuple[str, str]], bool]) -> str:
    """Fields as (label, column, [(failing condition, message)], required), in label order."""
    messages = []
    for label, column, checks, required in fields:
        cases = []
        if required:
            cases.append(f"WHEN {column} IS NULL OR {column} = '' THEN '{label}: cannot be blank'")
        cases += [f"WHEN {column} <> '' AND {bad} THEN '{label}: {text}'" for bad, text in checks]
        messages.append(f"CASE {' '.join(cases)} END")
    return _error(*messages)


def _unlike(column: str, pattern: str) -> str:
    """Braces are doubled for the later str.format."""
    escaped = pattern.replace("{", "{{").replace("}", "}}")
    return f"NOT regexp_matches({column}, '{escaped}')"


_SHORT_CODE = (
    "ShortCode",
    "short_code",
    [
        (
            _unlike("short_code", fixed.SHORT_CODE_FORMAT),
            "must be in a valid format",
        )
    ],
    True,
)


def _not_integer(column: str) -> tuple[str, str]:
    return (
        rf"NOT regexp_matches({column}, '\A[-+]?(0|[1-9][0-9]*)\z')",
        "must be an integer number",
    )


def _not_in(column: str, values) -> tuple[str, str]:
    return (f"{column} NOT IN ({_listed(values)})", "must be a valid value")


_BENEFICIARY_ERROR = _upload_error(
    (
        "BeneficiaryCode",
        "beneficiary_code",
        [
            _not_integer("beneficiary_code"),
            (
                _unlike("beneficiary_code", fixed.BENEFICIARY_CODE_FORMAT),
                "must be in a valid format",
            ),
        ],
        True,
    ),
    _SHORT_CODE,
)
_LEDGER_ERROR = _upload_error(
    ("ItemStatus", "item_status", [_not_in("item_status", fixed.ITEM_STATUSES)], True),
    ("Ledger", "ledger", [_not_integer("ledger"), _not_in("ledger", fixed.LEDGERS)], True),
    ("PaymentMethod", "payment_method", [_not_in("payment_method", fixed.PAYMENT_METHODS)], True),
    (
        "ShipmentProviderName",
        "shipment_provider_name",
        [_not_in("shipment_provider_name", fixed.SHIPMENT_PROVIDERS)],
        True,
    ),
    (
        "Subledger",
        "subledger",
        [_not_integer("subledger"), _not_in("subledger", fixed.SUBLEDGERS)],
        False,
    ),
    (
        "TransactionType",
        "transaction_type",
        [_not_in("transaction_type", fixed.LEDGER_MAP_TYPES)],
        True,
    ),
)


def _append(rows: str, stored: str, keys: tuple[str, ...], codes: tuple[str, ...]) -> str:
    partition = ", ".join(f"u.{k}" for k in keys)
    same = " AND ".join(f"s.{k} = u.{k}" for k in keys)
    typed = "".join(f", TRY_CAST(u.{c} AS BIGINT) AS {c}" for c in codes)
    overflow = " OR ".join(
        f"(u.{c} <> '' AND TRY_CAST(u.{c} AS BIGINT) IS NULL)" for c in codes
    ) or "false"
    return f"""
    SELECT {partition}{typed},
           CASE WHEN EXISTS (SELECT 1 FROM {stored} s WHERE {same}) THEN 'key is already stored'
                WHEN coalesce({overflow}, false) THEN 'number is out of range'
                WHEN row_number() OVER (PARTITION BY {partition}, coalesce({overflow}, false)
                                        ORDER BY u.row_no) > 1
                THEN 'key occurs earlier in the upload' END AS error,
           u.row_no
    FROM {rows} u"""


_PARTS = ("transaction_type", "item_status", "payment_method", "shipment_provider_name")

_UPLOAD_COLUMNS = {
    "up_beneficiary": ("short_code", "beneficiary_code"),
    "up_retail": ("short_code",),
    "up_ledger": (*_PARTS, "ledger", "subledger"),
}
_UPLOAD_ERRORS = {
    "beneficiary": _BENEFICIARY_ERROR,
    "retail": _upload_error(_SHORT_CODE),
    "ledger": _LEDGER_ERROR,
}
_UPLOAD_NAMES = {"beneficiary": "benef_code_map", "retail": "retail_supplier", "ledger": "ledger_map"}


def _csv(view: str) -> str:
    columns = ", ".join(f"nullif({c}, '') AS {c}" for c in _UPLOAD_COLUMNS[view])
    return f"SELECT CAST(row_no AS VARCHAR) AS line, {columns} FROM {view}"


def _log(view: str) -> str:
    line = ", ".join(f"coalesce({c}, '')" for c in _UPLOAD_COLUMNS[f"up_{view}"])
    return f"""
        SELECT '{_UPLOAD_NAMES[view]}' AS upload, error, concat_ws('|', {line}) AS line
        FROM (SELECT *, {_UPLOAD_ERRORS[view]} FROM up_{view}) WHERE error IS NOT NULL"""


def _gate(view: str, error: str) -> str:
    return f"""
        SELECT '{view}' AS upload, count(*) AS rows, count(error) AS invalid_rows,
               count(error) = 0 AS accepted FROM (SELECT *, {error} FROM {view})"""


_SELECTS: dict[str, str] = {
    "sc_extract": f"SELECT {EXTRACT_COLUMNS} FROM extract",
    "oms_extract": """
        SELECT oms_id_sales_order_item, item_status, payment_method, shipment_provider_name,
               CAST(paid_price AS DOUBLE) AS paid_price FROM oms""",
    "ledger_map_read": """
        SELECT concat(transaction_type, '-', item_status, '-', payment_method, '-',
                      shipment_provider_name) AS ledger_map_key, ledger, subledger
        FROM ledger_rows_raw""",
    "beneficiary_map_read": "SELECT short_code, beneficiary_code FROM benef",
    "retail_list_read": "SELECT short_code FROM retail",
    "ledger_map_key": "SELECT oms_id_sales_order_item, ledger_map_key FROM item_prices",
    "duplicate_map_keys": """
        SELECT short_code, count(*) AS rows FROM benef_doubled
        GROUP BY short_code HAVING count(*) > 1""",
    "retail_filter": f"SELECT {EXTRACT_COLUMNS} FROM no_retail",
    "sc_valid": f"SELECT {EXTRACT_COLUMNS} FROM sc",
    "sc_invalid": f"SELECT {EXTRACT_COLUMNS}, error FROM sc_checked WHERE error IS NOT NULL",
    "type_routing": _ROUTED,
    "bucket_comment": _ROUTED + " AND comment IS NOT NULL",
    "unique_item_ids": "SELECT DISTINCT oms_id_sales_order_item FROM sc",
    "item_price_credit_oms": f"""
        SELECT {ITEM_COLUMNS} FROM item_prices WHERE id_transaction_type = 17""",
    "item_price_oms": f"SELECT {ITEM_COLUMNS} FROM item_prices WHERE id_transaction_type = 18",
    "item_price_and_credit": f"""
        SELECT {ITEM_COLUMNS} FROM item_prices WHERE id_transaction_type = 17
        UNION ALL
        SELECT {ITEM_COLUMNS} FROM item_prices WHERE id_transaction_type = 18""",
    "scoms_valid": f"SELECT {ITEM_COLUMNS} FROM item_valid",
    "scoms_invalid": f"SELECT {ITEM_COLUMNS}, error FROM item_checked WHERE error IS NOT NULL",
    "item_price_credit_valid": f"""
        SELECT {ITEM_COLUMNS} FROM item_valid WHERE id_transaction_type = 17""",
    "item_price_valid": f"SELECT {ITEM_COLUMNS} FROM item_valid WHERE id_transaction_type = 18",
    "missing_beneficiary": f"""
        SELECT {SC_COLUMNS} FROM sc
        WHERE NOT EXISTS (SELECT 1 FROM benef_gaps b WHERE b.short_code = sc.short_code)""",
    "missing_ledger_key": f"""
        SELECT DISTINCT {', '.join(_PARTS)} FROM item_valid v
        WHERE NOT EXISTS (
            SELECT 1 FROM ledger_rows_gaps m
            WHERE concat(m.transaction_type, '-', m.item_status, '-', m.payment_method, '-',
                         m.shipment_provider_name) = v.ledger_map_key)""",
    "ipc_final": f"SELECT {PRICE_COLUMNS} FROM ipc",
    "ipt_final": f"SELECT {PRICE_COLUMNS} FROM ipt",
    "commission_final": """
        SELECT booking_period, oms_id_sales_order_item, order_nr, id_supplier, short_code,
               supplier_name, transaction_type,
               CAST(transaction_value AS DOUBLE) AS transaction_value,
               CAST(transaction_value AS DOUBLE) * -1 * 100 / 109 AS commission_revenue,
               CAST(transaction_value AS DOUBLE) * -1 * 100 / 109 * 0.09 AS commission_vat,
               comment, beneficiary_code
        FROM comm""",
    "voucher_ledger_amount": f"{_LINES} p_voucher",
    "ipc_paid_price_ledger_amount": f"{_LINES} p_ipc",
    "ipt_paid_price_ledger_amount": f"{_LINES} p_ipt",
    "commission_vat_ledger_amount": f"{_LINES} p_vat",
    "commission_revenue_ledger_amount": f"{_LINES} p_revenue",
    "total_ledger_amount": f"{_LINES} p_total",
    "posting_template": "SELECT * FROM template",
    "zero_balance": """
        SELECT booking_period, count(*) AS lines,
               abs(sum(amount)) <= sum(abs(amount)) * 1e-9 AS balanced
        FROM template GROUP BY booking_period""",
    "step_counts": """
        SELECT 'extracted' AS step, count(*) AS rows FROM extract
        UNION ALL SELECT 'without_retail', count(*) FROM no_retail
        UNION ALL SELECT 'seller_rows_valid', count(*) FROM sc
        UNION ALL SELECT 'seller_rows_invalid', count(*) FROM sc_checked WHERE error IS NOT NULL
        UNION ALL SELECT 'missing_beneficiary', count(*) FROM sc
            WHERE NOT EXISTS (SELECT 1 FROM benef b WHERE b.short_code = sc.short_code)
        UNION ALL SELECT 'item_prices', count(*) FROM item_prices
        UNION ALL SELECT 'item_prices_valid', count(*) FROM item_valid
        UNION ALL SELECT 'item_prices_invalid', count(*) FROM item_checked
            WHERE error IS NOT NULL
        UNION ALL SELECT 'beneficiary_map', count(*) FROM benef
        UNION ALL SELECT 'orders', count(*) FROM oms
        UNION ALL SELECT 'ledger_map', count(*) FROM lmap
        UNION ALL SELECT 'missing_ledger_keys', count(DISTINCT ledger_map_key) FROM item_valid v
            WHERE NOT EXISTS (SELECT 1 FROM lmap m WHERE m.ledger_map_key = v.ledger_map_key)""",
    "rejected_seller_rows": f"""
        SELECT error, {', '.join(SELLER_REJECT_COLUMNS[1:6])},
               CAST(transaction_value AS DOUBLE) AS transaction_value,
               statement_start_date, statement_end_date
        FROM sc_checked WHERE error IS NOT NULL""",
    "rejected_item_price_rows": f"""
        SELECT error, {', '.join(ITEM_PRICE_REJECT_COLUMNS[1:6])},
               CAST(transaction_value AS DOUBLE) AS transaction_value, item_status,
               payment_method, shipment_provider_name, CAST(paid_price AS DOUBLE) AS paid_price
        FROM item_checked WHERE error IS NOT NULL""",
    "missing_short_codes_log": """
        SELECT short_code FROM sc WHERE short_code NOT IN (SELECT short_code FROM benef_gaps)""",
    "missing_ledger_keys_log": f"""
        SELECT DISTINCT {', '.join(_PARTS)}, CAST(0 AS BIGINT) AS ledger,
               CAST(0 AS BIGINT) AS subledger
        FROM item_valid ANTI JOIN ledger_rows_gaps USING ({', '.join(_PARTS)})""",
    "template_rows": """
        SELECT booking_period, CAST(account_code AS VARCHAR) AS account_code,
               coalesce(CAST(account_free AS VARCHAR), '') AS account_free, amount
        FROM template""",
    "upload_beneficiary": f"""
        SELECT row_no, short_code, beneficiary_code, {_BENEFICIARY_ERROR} FROM up_beneficiary""",
    "upload_retail": f"SELECT row_no, short_code, {_upload_error(_SHORT_CODE)} FROM up_retail",
    "upload_ledger_map": f"""
        SELECT row_no, {', '.join(_PARTS)}, ledger, subledger, {_LEDGER_ERROR} FROM up_ledger""",
    "append_beneficiary": _append(
        "ok_beneficiary", "benef", ("short_code",), ("beneficiary_code",)
    ),
    "append_retail": _append("ok_retail", "retail", ("short_code",), ()),
    "append_ledger_map": _append("ok_ledger", "ledger_rows_gaps", _PARTS, ("ledger", "subledger")),
    "csv_beneficiary": _csv("up_beneficiary"),
    "csv_retail": _csv("up_retail"),
    "csv_ledger_map": _csv("up_ledger"),
    "upload_log": " UNION ALL ".join(map(_log, _UPLOAD_ERRORS)),
    "upload_gate": " UNION ALL ".join(
        _gate(f"{state}_{view}", error)
        for view, error in _UPLOAD_ERRORS.items()
        for state in ("up", "ok")
    ),
    "run_gates": """
        SELECT 'missing_beneficiary_codes' AS gate, count(*) AS rows, count(*) > 0 AS stops FROM sc
        WHERE short_code NOT IN (SELECT short_code FROM benef_gaps)
        UNION ALL SELECT 'missing_ledger_keys', count(DISTINCT v.ledger_map_key), count(*) > 0
        FROM item_valid v WHERE NOT EXISTS (
            SELECT 1 FROM ledger_rows_gaps m
            WHERE concat(m.transaction_type, '-', m.item_status, '-', m.payment_method, '-',
                         m.shipment_provider_name) = v.ledger_map_key)
        UNION ALL SELECT 'invalid_seller_rows', count(*), false
        FROM sc_checked WHERE error IS NOT NULL
        UNION ALL SELECT 'invalid_item_price_rows', count(*), false
        FROM item_checked WHERE error IS NOT NULL""",
    "export_ipc_final": f"SELECT {EXPORT_COLUMNS} FROM ipc",
    "export_ipt_final": f"SELECT {EXPORT_COLUMNS} FROM ipt",
    "shipped_ledger_keys": f"""
        SELECT DISTINCT concat(item_status || '-', payment_method || '-', shipment_provider_name)
                   AS ledger_map_key
        FROM ({_ORDERED}) ordered, package_item box, dispatching sent, provider
        WHERE box.fk_sales_order_item = item AND sent.fk_package = box.fk_package
          AND id_shipment_provider = sent.fk_shipment_provider
          AND item_status IS NOT NULL AND payment_method IS NOT NULL
          AND shipment_provider_name IS NOT NULL
          AND EXISTS (SELECT 1 FROM sc WHERE sc.oms_id_sales_order_item = item)
          AND EXISTS (SELECT 1 FROM status_history WHERE fk_sales_order_item = item
                      AND fk_sales_order_item_status = {fixed.SHIPPED_STATUS}
                      AND created_at IS NOT NULL)
        UNION
        -- An item with a part that is not known has no key.
        SELECT NULL FROM ({_ORDERED}) ordered
        LEFT JOIN package_item box ON box.fk_sales_order_item = item
        LEFT JOIN dispatching sent USING (fk_package)
        LEFT JOIN provider ON id_shipment_provider = sent.fk_shipment_provider
        WHERE (item_status || payment_method || shipment_provider_name) IS NULL
          AND EXISTS (SELECT 1 FROM sc WHERE sc.oms_id_sales_order_item = item)
          AND EXISTS (SELECT 1 FROM status_history WHERE fk_sales_order_item = item
                      AND fk_sales_order_item_status = {fixed.SHIPPED_STATUS}
                      AND created_at IS NOT NULL)""",
    "previous_month_window": """
        SELECT CAST(as_of AS VARCHAR) AS as_of,
               CAST(CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) AS VARCHAR)
                   AS period_start,
               CAST(CAST(date_trunc('month', as_of) AS DATE) AS VARCHAR) AS period_end
        FROM (SELECT DISTINCT CAST(created_at AS DATE) AS as_of FROM txn) days""",
} | {
    f"bucket_{name}": f"""
        SELECT {SC_COLUMNS} FROM sc
        WHERE id_transaction_type IN ({', '.join(map(str, ids))})"""
    for name, ids in fixed.BUCKETS.items()
}

ORACLE_SQL: dict[str, str] = {
    name: _sql(select, WHOLE) for name, select in _SELECTS.items()
} | {
    "sc_extract_month": _sql(f"SELECT {EXTRACT_COLUMNS} FROM extract", ONE_MONTH),
    "posting_template_month": _sql("SELECT * FROM template", ONE_MONTH),
    "posting_template_flat": _sql("SELECT * FROM template", FLAT),
}
