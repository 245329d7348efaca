"""Source tables of the booking jobs, derived from the given parquet tables.

Both engines build them from the same SQL text, so any difference between their results
comes from the operators. Conditions such as ``% 40 = 3`` put gaps, blanks and bad texts
into the derived tables for the checks to find; every row of the given tables takes part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallybook import fixed

GIVEN = ("lineitem", "orders", "supplier", "customer")


def _values(rows, columns: str) -> str:
    def literal(v):
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


_PRICE_NAMES = {fixed.ITEM_PRICE: "Item Price", fixed.ITEM_PRICE_CREDIT: "Item Price Credit"}


def _types():
    """(number, type id, name, sign); item prices are twice as frequent, credits positive.

    Only the names of the two price types matter, as ledger maps use them.
    """
    number = 0
    for bucket, ids in fixed.BUCKETS.items():
        for kind in ids * (2 if ids[0] in _PRICE_NAMES else 1):
            name = _PRICE_NAMES.get(kind, f"{bucket.replace('_', ' ')} no. {kind}")
            yield number, kind, name, 1 if bucket.endswith("credit") else -1
            number += 1


TYPES = list(_types())
STATUSES = [fixed.ITEM_STATUSES[i] for i in (0, 1, 8, 11, 5, 4)]
PAYMENTS = [
    (priority, fixed.PAYMENT_METHODS[i])
    for priority, i in (
        ("1-URGENT", 0),
        ("2-HIGH", 1),
        ("3-MEDIUM", 2),
        ("4-NOT SPECIFIED", 3),
        ("5-LOW", 6),
    )
]
PROVIDERS = [fixed.SHIPMENT_PROVIDERS[i] for i in (0, 2, 4, 6, 10)]
LEDGERS = [int(x) for x in fixed.LEDGERS]
SUBLEDGERS = [4000000001, 4000000002, 4000000003, None, 4000000006]


def _ledger_map_rows(providers):
    for kind, (s, status), (p, (_, method)), (v, provider) in product(
        ("Item Price Credit", "Item Price"),
        enumerate(STATUSES),
        enumerate(PAYMENTS),
        enumerate(PROVIDERS),
    ):
        if provider in providers:
            yield kind, status, method, provider, LEDGERS[(s + p) % 5], SUBLEDGERS[v]


_MAP_COLUMNS = (
    "transaction_type, item_status, payment_method, shipment_provider_name, ledger, subledger"
)


def code(key: str) -> str:
    return f"concat('IR', lpad(CAST({key} AS STRING), 5, '0'))"


_LEDGER_CASE = "CASE {0} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(LEDGERS)) + " END"
_SUBLEDGER_CASE = (
    "CASE {0} "
    + " ".join(f"WHEN {i} THEN {'NULL' if v is None else v}" for i, v in enumerate(SUBLEDGERS))
    + " END"
)

# name -> SQL over the given tables and the views before it.
VIEWS: dict[str, str] = {
    "d_type": _values(TYPES, "ix, id, name, sgn"),
    "d_status": _values(list(enumerate(STATUSES)), "ix, name"),
    "d_pay": _values([(p, i, n) for i, (p, n) in enumerate(PAYMENTS)], "prio, ix, name"),
    "d_prov": _values(list(enumerate(PROVIDERS)), "ix, name"),
    "line": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag,
               l_linestatus, l_shipdate,
               l_orderkey * 10 + l_linenumber AS item,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS ext,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS paid,
               CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END * 2
                   + CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS status_ix
        FROM {lineitem}""",
    # Seller side.
    "txn": """
        SELECT item AS id_transaction,
               CAST(CASE WHEN l_quantity = 50 THEN 0 ELSE d.sgn * ext END AS DECIMAL(18,4)) AS value,
               CASE WHEN l_quantity < 5 THEN concat('note ', l_returnflag) END AS description,
               l_shipdate AS created_at,
               item AS ref,
               CAST(d.id AS BIGINT) AS fk_tre2_account_statement_group,
               l_suppkey AS fk_seller,
               CAST(EXTRACT(year FROM l_shipdate) * 100 + EXTRACT(month FROM l_shipdate) AS BIGINT)
                   AS fk_transaction_statement
        FROM line JOIN d_type d ON d.ix = l_partkey % 16""",
    "statement_group": """
        SELECT DISTINCT CAST(id AS BIGINT) AS id_tre2_account_statement_group, name
        FROM d_type""",
    "seller": f"""
        SELECT s_suppkey AS id_seller,
               CASE WHEN s_suppkey % 50 <> 9 THEN {code('s_suppkey')} END AS short_code,
               s_name AS name
        FROM {{supplier}}""",
    "seller_order": """
        SELECT o_orderkey AS id_sales_order,
               CASE WHEN o_orderkey % 97 = 5 THEN concat('A', CAST(o_orderkey AS STRING))
                    ELSE CAST(o_orderkey AS STRING) END AS order_nr
        FROM {orders}""",
    "seller_order_item": """
        SELECT DISTINCT item AS id_sales_order_item, item AS src_id, l_orderkey AS fk_sales_order
        FROM line WHERE l_linenumber <> 6""",
    "statement": """
        SELECT DISTINCT
               CAST(EXTRACT(year FROM l_shipdate) * 100 + EXTRACT(month FROM l_shipdate) AS BIGINT)
                   AS id_transaction_statement,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS start_date,
               last_day(CAST(l_shipdate AS DATE)) AS end_date
        FROM line WHERE EXTRACT(month FROM l_shipdate) <> 2""",
    # Order side.
    "order_item": """
        SELECT item AS id_sales_order_item, l_orderkey AS fk_sales_order,
               CAST(min(status_ix) AS BIGINT) AS fk_sales_order_item_status,
               CASE WHEN min(l_quantity) = 1 THEN CAST(0 AS DECIMAL(18,4)) ELSE min(paid) END
                   AS paid_price
        FROM line WHERE l_linenumber <> 7
        GROUP BY item, l_orderkey""",
    "order_head": """
        SELECT o_orderkey AS id_sales_order, p.name AS payment_method
        FROM {orders} JOIN d_pay p ON p.prio = o_orderpriority""",
    "package_item": """
        SELECT item AS fk_sales_order_item, l_partkey AS fk_package
        FROM line WHERE l_partkey % 40 <> 3""",
    "dispatching": """
        SELECT DISTINCT l_partkey AS fk_package, l_partkey % 5 AS fk_shipment_provider
        FROM line""",
    "provider": """
        SELECT CAST(ix AS BIGINT) AS id_shipment_provider, name AS shipment_provider_name
        FROM d_prov""",
    "item_status": """
        SELECT CAST(ix AS BIGINT) AS id_sales_order_item_status, name FROM d_status""",
    "status_history": """
        SELECT item AS fk_sales_order_item,
               CAST(CASE WHEN l_linestatus = 'F' THEN 5 ELSE 1 END AS BIGINT)
                   AS fk_sales_order_item_status,
               CASE WHEN l_returnflag <> 'A' THEN l_shipdate END AS created_at
        FROM line""",
    # Reference maps.
    "benef": f"""
        SELECT {code('s_suppkey')} AS short_code, 3000000000 + s_suppkey AS beneficiary_code
        FROM {{supplier}}""",
    "benef_gaps": f"""
        SELECT {code('s_suppkey')} AS short_code, 3000000000 + s_suppkey AS beneficiary_code
        FROM {{supplier}} WHERE s_suppkey % 10 <> 7""",
    "benef_doubled": f"""
        SELECT {code('s_suppkey')} AS short_code, 3000000000 + s_suppkey AS beneficiary_code
        FROM {{supplier}}
        UNION ALL
        SELECT {code('c_custkey')} AS short_code, 3100000000 + c_custkey AS beneficiary_code
        FROM {{customer}}""",
    "retail": f"""
        SELECT {code('s_suppkey')} AS short_code FROM {{supplier}} WHERE s_nationkey % 5 = 0""",
    "ledger_rows": _values(_ledger_map_rows(PROVIDERS), _MAP_COLUMNS),
    "ledger_rows_gaps": _values(
        _ledger_map_rows([p for p in PROVIDERS if p != "TPG"]), _MAP_COLUMNS
    ),
    # A ledger map as the data would need it, with some parts left empty.
    "ledger_rows_raw": f"""
        SELECT DISTINCT d.name AS transaction_type, s.name AS item_status,
               CASE WHEN p.ix <> 3 THEN p.name END AS payment_method,
               CASE WHEN v.ix <> 3 THEN v.name END AS shipment_provider_name,
               CAST({_LEDGER_CASE.format('(s.ix + p.ix) % 5')} AS BIGINT) AS ledger,
               CAST({_SUBLEDGER_CASE.format('v.ix')} AS BIGINT) AS subledger
        FROM line
        JOIN {{orders}} ON o_orderkey = l_orderkey
        JOIN d_type d ON d.ix = l_partkey % 16
        JOIN d_status s ON s.ix = status_ix
        JOIN d_pay p ON p.prio = o_orderpriority
        JOIN d_prov v ON v.ix = l_partkey % 5""",
    # Joined sources without gaps in the statements, for the postings alone.
    "flat_raw": f"""
        SELECT item AS oms_id_sales_order_item, CAST(l_orderkey AS STRING) AS order_nr,
               l_suppkey AS id_supplier, {code('l_suppkey')} AS short_code,
               s_name AS supplier_name, CAST(d.id AS BIGINT) AS id_transaction_type,
               d.name AS transaction_type,
               CAST(d.sgn * ext AS DECIMAL(18,4)) AS transaction_value,
               CASE WHEN l_quantity < 5 THEN concat('note ', l_returnflag) END AS comment,
               l_shipdate AS created_at
        FROM line
        JOIN {{supplier}} ON s_suppkey = l_suppkey
        JOIN d_type d ON d.ix = l_partkey % 16""",
    "flat_orders": """
        SELECT item AS oms_id_sales_order_item, s.name AS item_status, p.name AS payment_method,
               v.name AS shipment_provider_name,
               CASE WHEN l_quantity = 1 THEN CAST(0 AS DECIMAL(18,4)) ELSE paid END AS paid_price
        FROM line
        JOIN {orders} ON o_orderkey = l_orderkey
        JOIN d_pay p ON p.prio = o_orderpriority
        JOIN d_prov v ON v.ix = l_partkey % 5
        JOIN d_status s ON s.ix = status_ix
        WHERE l_linenumber <> 7""",
    # Upload rows as text, some of them wrong.
    "up_beneficiary": f"""
        SELECT c_custkey AS row_no,
               CASE WHEN c_custkey % 11 = 3 THEN lower({code('c_custkey')})
                    WHEN c_custkey % 13 = 4 THEN ''
                    WHEN c_custkey % 17 = 5 THEN concat({code('c_custkey')}, chr(10))
                    WHEN c_custkey % 19 = 6 THEN NULL
                    ELSE {code('c_custkey')} END AS short_code,
               CASE WHEN c_custkey % 7 = 1 THEN concat('0', CAST(c_custkey AS STRING))
                    WHEN c_custkey % 7 = 2 THEN CAST(2000000000 + c_custkey AS STRING)
                    WHEN c_custkey % 23 = 5 THEN ''
                    WHEN c_custkey % 29 = 7 THEN concat('3', c_mktsegment)
                    WHEN c_custkey % 31 = 8 THEN concat(CAST(3000000000 + c_custkey AS STRING), '99')
                    ELSE CAST(3000000000 + c_custkey AS STRING) END AS beneficiary_code
        FROM {{customer}}""",
    "up_retail": f"""
        SELECT c_custkey AS row_no,
               CASE WHEN c_custkey % 5 = 2 THEN concat('IR', c_mktsegment)
                    WHEN c_custkey % 13 = 4 THEN ''
                    ELSE {code('c_custkey')} END AS short_code
        FROM {{customer}}""",
    "up_ledger": f"""
        SELECT item AS row_no,
               CASE WHEN l_quantity = 7 THEN lower(d.name) ELSE d.name END AS transaction_type,
               CASE WHEN l_quantity = 9 THEN '' ELSE s.name END AS item_status,
               CASE WHEN l_quantity = 11 THEN o_orderpriority ELSE p.name END AS payment_method,
               CASE WHEN l_quantity = 13 THEN NULL ELSE v.name END AS shipment_provider_name,
               CASE WHEN l_quantity = 17 THEN '1e4'
                    WHEN l_quantity = 19 THEN ''
                    WHEN l_quantity = 21 THEN '013004'
                    WHEN l_quantity = 22 THEN '31006'
                    ELSE CAST({_LEDGER_CASE.format('(s.ix + p.ix) % 5')} AS STRING) END AS ledger,
               CASE WHEN l_quantity = 23 THEN 'x'
                    WHEN l_quantity = 25 THEN '4000000005'
                    WHEN l_quantity = 27 THEN ''
                    ELSE CAST({_SUBLEDGER_CASE.format('v.ix')} AS STRING) END AS subledger
        FROM line
        JOIN {{orders}} ON o_orderkey = l_orderkey
        JOIN d_type d ON d.ix = l_partkey % 16
        JOIN d_status s ON s.ix = status_ix
        JOIN d_pay p ON p.prio = o_orderpriority
        JOIN d_prov v ON v.ix = l_partkey % 5""",
    # Valid upload rows whose keys repeat, in row order.
    "ok_beneficiary": f"""
        SELECT o_orderkey AS row_no, {code('o_custkey')} AS short_code,
               CASE WHEN o_orderkey % 41 = 9 THEN concat(CAST(3000000000 + o_custkey AS STRING),
                                                        '0000000000')
                    ELSE CAST(3000000000 + o_custkey AS STRING) END AS beneficiary_code
        FROM {{orders}}""",
    "ok_retail": f"""
        SELECT o_orderkey AS row_no, {code('o_custkey')} AS short_code FROM {{orders}}""",
    "ok_ledger": f"""
        SELECT item * 10000 + l_partkey % 10000 AS row_no, d.name AS transaction_type,
               s.name AS item_status, p.name AS payment_method,
               v.name AS shipment_provider_name,
               min(CAST({_LEDGER_CASE.format('(s.ix + p.ix) % 5')} AS STRING)) AS ledger,
               min(CAST({_SUBLEDGER_CASE.format('v.ix')} AS STRING)) AS subledger
        FROM line
        JOIN {{orders}} ON o_orderkey = l_orderkey
        JOIN d_type d ON d.ix = l_partkey % 16
        JOIN d_status s ON s.ix = status_ix
        JOIN d_pay p ON p.prio = o_orderpriority
        JOIN d_prov v ON v.ix = l_partkey % 5
        WHERE d.id IN (17, 18)
        GROUP BY 1, 2, 3, 4, 5""",
}

# Source table of the jobs -> view.
SOURCE_VIEWS = {
    "transaction": "txn",
    "tre2_account_statement_group": "statement_group",
    "seller": "seller",
    "sales_order_item": "seller_order_item",
    "sales_order": "seller_order",
    "transaction_statement": "statement",
    "ims_sales_order_item": "order_item",
    "ims_sales_order": "order_head",
    "oms_package_item": "package_item",
    "oms_package_dispatching": "dispatching",
    "oms_shipment_provider": "provider",
    "ims_sales_order_item_status": "item_status",
    "ims_sales_order_item_status_history": "status_history",
    "beneficiary_code_map": "benef",
    "retail_short_code": "retail",
    "ledger_map": "ledger_rows",
}


def needed_views(text: str) -> dict[str, str]:
    """Views that ``text`` builds on, in order of definition."""
    wanted: set[str] = set()

    def visit(sql: str) -> None:
        for word in set(re.findall(r"[a-z_]+", sql)):
            if word in VIEWS and word not in wanted:
                wanted.add(word)
                visit(VIEWS[word])

    visit(text)
    return {name: sql for name, sql in VIEWS.items() if name in wanted}


def with_views(query: str) -> str:
    """``query`` preceded by the views it needs."""
    body = ", ".join(f"{name} AS ({sql})" for name, sql in needed_views(query).items())
    return f"WITH {body} {query}" if body else query


class Sources:
    """The fixture views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._schemas: dict[str, StructType] = {}

    def given(self, table: str) -> DataFrame:
        """A new scan each time, as of separate tables; the schema is looked up once."""
        path = f"{self.sf_dir}/{table}.parquet"
        if table not in self._schemas:
            self._schemas[table] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[table]).parquet(path)

    def view(self, name: str) -> DataFrame:
        text = with_views(f"SELECT * FROM {name}")
        tables = {t: self.given(t) for t in GIVEN if "{" + t + "}" in text}
        return self.spark.sql(text, **tables)

    def source_tables(self) -> SourceTables:
        return SourceTables(self)


class SourceTables(Mapping):
    """Source tables by name; a table that a query never asks for is never planned."""

    def __init__(self, sources: Sources) -> None:
        self._sources = sources
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._sources.view(SOURCE_VIEWS[table])
        return self._built[table]

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCE_VIEWS)

    def __len__(self) -> int:
        return len(SOURCE_VIEWS)
