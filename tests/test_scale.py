"""Properties that keep the jobs fast on large and skewed data, read from their plans."""

from __future__ import annotations

import contextlib
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.fixture import Sources
from tallybook.functions.joins import first_per_key, lookup
from tallybook.functions.keys import LEDGER_KEY_PARTS
from tallybook.functions.periods import Period
from tallybook.operators import matching, postings, routing
from tallybook.sources import maps
from tallybook.sources.orders import order_extract
from tallybook.sources.readers import Location, read_folder, read_table
from tallybook.sources.schemas import STAGED_COLUMNS
from tallybook.sources.seller import seller_extract
from tallybook.session import shuffle_partitions
from tests.conftest import SF
from tests.tables import source_tables


@contextlib.contextmanager
def settings(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LEDGERS = "ledger_map_key string, ledger bigint, subledger bigint"
SHUFFLED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The derived tables as parquet files, as a real run reads them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    tables = Sources(spark, SF).source_tables()
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    return read_folder(spark, folder, tables)


def scan_of(plan: str, table: str) -> str:
    return next(line for line in plan.splitlines() if f"/{table}]" in line and "FileScan" in line)


def test_month_and_columns_reach_the_scan(spark, written):
    with settings(spark, spark__sql__maxMetadataStringLength="10000"):
        plan = plan_of(seller_extract(written, Period.month(1996, 12)))
        scan = scan_of(plan, "transaction")
        assert "GreaterThanOrEqual(created_at,1996-12-01" in scan
        assert "LessThan(created_at,1997-01-01" in scan
        assert "id_sales_order:bigint,order_nr:string>" in scan_of(plan, "sales_order")
        bucket = plan_of(routing.bucket(written_sc(written), "storage_fee"))
        assert "id_tre2_account_statement_group,13)" in scan_of(
            bucket, "tre2_account_statement_group"
        )


def written_sc(tables):
    return seller_extract(tables).select(*STAGED_COLUMNS)


def test_retail_rows_are_gone_before_the_order_joins(spark, written):
    retail = maps.read_retail_list(written["retail_short_code"])
    with settings(spark, **SHUFFLED):
        rows = seller_extract(written, retail=retail)
        lines = plan_of(rows).splitlines()
        same = matching.without_retail(seller_extract(written), retail)
        assert rows.exceptAll(same).isEmpty()
        assert same.exceptAll(rows).isEmpty()
    gone = next(i for i, line in enumerate(lines) if "Filter isnull(is_retail" in line)
    orders = next(i for i, line in enumerate(lines) if "Join [ref_probe" in line)
    assert gone > orders  # deeper in the tree, so earlier in the run


def test_wide_rows_meet_items_once_and_only_named_items_are_joined(spark, written):
    with settings(spark, **SHUFFLED):
        plan = plan_of(seller_extract(written, Period.month(1996, 12)))
    assert re.search(r"Join \[id_sales_order_item#\w+\], \[id_sales_order_item#\w+\], LeftSemi", plan)
    # Orders join the items, so the transactions are not shuffled by order.
    assert not re.search(r"hashpartitioning\(fk_sales_order_probe.*\n.*transaction_value", plan)
    placed = next(line for line in plan.splitlines() if "Join [fk_sales_order_probe" in line)
    facts = next(line for line in plan.splitlines() if "Join [ref_probe" in line)
    assert len(placed) - len(placed.lstrip(" :+-")) > len(facts) - len(facts.lstrip(" :+-"))


def test_the_chain_of_order_tables_is_planned_once(spark, written):
    """Each order table is read once, also where ids occur twice and a list of wanted ids is given."""
    with settings(spark, **SHUFFLED, spark__sql__maxMetadataStringLength="10000"):
        ids = spark.range(50).selectExpr("id AS oms_id_sales_order_item")
        for wanted in (None, ids):
            scans = [x for x in plan_of(order_extract(written, wanted)).splitlines() if "FileScan" in x]
            tables = [re.search(r"/(\w+)\]", x).group(1) for x in scans]
            assert sorted(tables) == sorted(set(tables)) and "ims_sales_order_item" in tables


def test_all_periods_read_the_items_without_a_list_of_them(spark, written):
    with settings(spark, **SHUFFLED):
        plan = plan_of(seller_extract(written))
    assert "LeftSemi" not in plan and "Join [ref_probe" in plan


def test_rows_of_a_category_are_picked_before_the_item_join(spark, written):
    with settings(spark, **SHUFFLED):
        lines = plan_of(routing.bucket(written_sc(written), "item_price")).splitlines()
    types = next(line for line in lines if "Join [fk_type_probe" in line)
    items = next(line for line in lines if "Join [ref_probe" in line)
    assert len(types) - len(types.lstrip(" :+-")) > len(items) - len(items.lstrip(" :+-"))


def test_order_extract_picks_most_items_late_with_the_same_rows(spark, written):
    ids = spark.createDataFrame([(i,) for i in (11, 12, 13, 13, 14, 99, None)], "oms_id_sales_order_item bigint")
    for tables, wanted in ((source_tables(spark), ids), (written, matching.unique_item_ids(written_sc(written)).limit(500))):
        early, late = order_extract(tables, wanted), order_extract(tables, wanted, most=True)
        assert sorted(map(repr, early.collect())) == sorted(map(repr, late.collect()))


@pytest.mark.parametrize(
    "name, most",
    [("missing_ledger_keys_log", 1), ("ipc_paid_price_ledger_amount", 1), ("total_ledger_amount", 2), ("run_gates", 3)],
)
def test_how_often_a_query_takes_the_transactions_through_the_extract(spark, name, most):
    from __spark_entry__ import queries

    with settings(spark, **SHUFFLED):
        assert plan_of(queries()[name](spark, SF)).count("Join [ref_probe") <= most


def test_seller_gates_count_as_the_tables_they_stand_for(spark):
    rows = [("a", None), ("a", None), ("a", "bad"), ("b", None), (None, None), (None, "bad"), ("c", "bad")]
    checked = spark.createDataFrame(rows, "short_code string, error string")
    codes = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("c", 4)], "short_code string, code int")
    missing = matching.missing_beneficiary(checked.where("error IS NULL"), codes).count()
    assert tuple(matching.seller_gate_counts(checked, codes).first()) == (missing, 3) == (2, 3)
    assert tuple(matching.seller_gate_counts(checked.where("false"), codes).first()) == (0, 0)


def test_missing_keys_are_spread_over_the_partitions(spark):
    facts = spark.range(20_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("key")
    )
    dim = spark.range(20_000).select(F.col("id").alias("dim_id"), F.lit("x").alias("name"))
    with settings(
        spark, **SHUFFLED, spark__sql__adaptive__coalescePartitions__enabled="false"
    ):
        joined = lookup(facts, dim, "key", "dim_id", "id")
        sizes = [
            r["count"]
            for r in joined.where("key IS NULL")
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        ]
    assert len(sizes) == 8
    assert max(sizes) < 2 * min(sizes)
    assert joined.where("name IS NOT NULL").count() == 6667
    assert joined.columns == ["id", "key", "name"]


def test_missing_keys_never_match_whatever_the_ids(spark):
    facts = spark.createDataFrame([(1, None), (2, 5)], "id bigint, key bigint")
    scattered = facts.select(F.bitwise_not(F.shiftrightunsigned(F.xxhash64("id"), 1)).alias("d"))
    dim = scattered.union(spark.createDataFrame([(5,)], "d bigint")).withColumn("hit", F.lit(1))
    joined = lookup(facts, dim, "key", "d", "id").orderBy("id").collect()
    assert [r["hit"] for r in joined] == [None, 1]


def test_a_hot_item_is_split_in_the_row_level_join(spark):
    """A third of all rows share one item: its partition is read by several tasks."""
    n = 60_000
    sc = spark.range(n, numPartitions=8).select(
        F.lit(date(2018, 4, 1)).alias("booking_period"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias(
            "oms_id_sales_order_item"
        ),
        F.lit("1").alias("order_nr"),
        F.lit(1).alias("id_supplier"),
        F.lit("IR00001").alias("short_code"),
        F.lit("One").alias("supplier_name"),
        F.lit(17).cast("bigint").alias("id_transaction_type"),
        F.lit("Item Price Credit").alias("transaction_type"),
        F.lit(Decimal("2.0000")).cast("decimal(18,4)").alias("transaction_value"),
        F.sha2(F.col("id").cast("string"), 256).alias("comment"),
    )
    oms = spark.range(n + 100).select(
        F.col("id").alias("oms_id_sales_order_item"),
        F.lit("closed").alias("item_status"),
        F.lit("SEP").alias("payment_method"),
        F.lit("NA").alias("shipment_provider_name"),
        F.lit(Decimal("1.0000")).cast("decimal(18,4)").alias("paid_price"),
    )
    with settings(
        spark,
        **SHUFFLED,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        matched = matching.match_orders(sc, oms)
        counted = matched.select(F.sha2("comment", 256).alias("c"), "paid_price")
        rows = counted.collect()
        assert "skew=true" in plan_of(counted)
    assert len(rows) == n
    assert all(r["paid_price"] is not None for r in rows)


def test_postings_sum_before_they_shuffle(spark):
    """One task sends one row per group, however many rows share the hot item or seller."""
    prices = spark.range(90_000, numPartitions=4).select(
        F.lit(date(2018, 4, 1)).alias("booking_period"),
        F.lit("IR00001").alias("short_code"),
        F.when(F.col("id") % 3 == 0, 17).otherwise(18).cast("bigint").alias("id_transaction_type"),
        *[F.when(F.col("id") >= 0, "x").alias(c) for c in LEDGER_KEY_PARTS],
        F.lit(Decimal("1.0900")).cast("decimal(18,4)").alias("transaction_value"),
        F.lit(Decimal("1.0000")).cast("decimal(18,4)").alias("paid_price"),
    )
    ledgers = spark.createDataFrame([("x-x-x-x", 13004, None)], LEDGERS)
    sellers = spark.createDataFrame([("IR00001", 3000000001)], "short_code string, beneficiary_code bigint")
    booked = postings.book_item_prices(prices, ledgers, sellers)
    lines = plan_of(booked).splitlines()
    assert any("partial_sum(" in line for line in lines)
    ledger_join = next(i for i, line in enumerate(lines) if "Join [ledger_map_key" in line)
    final_sum = next(i for i, line in enumerate(lines) if "HashAggregate(" in line)
    assert ledger_join < final_sum  # the maps meet sums, not rows
    got = {(r["kind"], r["ledger"], str(r["value"])) for r in booked.collect()}
    assert got == {(17, 13004, "32700.0000"), (18, 13004, "65400.0000")}


def test_one_wrong_cent_is_seen_in_any_turnover(spark):
    def sums(off):
        goods = Decimal("1000000000000.0000")
        lines = [("voucher", goods / 4, 0), ("ipc_paid_price", goods * 3 / 4 + off, 0), ("total", goods, 0)]
        lines += [(p, 0, 7) for p in ("commission_vat", "commission_revenue", "total")]
        rows = [(date(2018, 4, 1), p, 1, i, Decimal(g), Decimal(c)) for i, (p, g, c) in enumerate(lines)]
        return spark.createDataFrame(
            rows,
            "booking_period date, posting string, account_code bigint, account_free bigint, "
            "goods decimal(38,4), commission decimal(38,4)",
        )

    assert postings.balance(sums(Decimal(0))).first()["balanced"] is True
    assert postings.balance(sums(Decimal("0.01"))).first()["balanced"] is False


def test_same_result_whichever_join_spark_picks(spark):
    from __spark_entry__ import queries

    def rows(df):
        return sorted(
            (r["booking_period"], r["posting"], r["account_code"], str(r["account_free"]),
             r["amount"])
            for r in df.collect()
        )

    flagship = queries()["posting_template"]
    usual = rows(flagship(spark, SF))
    with settings(spark, **SHUFFLED):
        assert rows(flagship(spark, SF)) == usual
    with settings(spark, spark__sql__adaptive__enabled="false"):
        assert rows(flagship(spark, SF)) == usual


def test_first_per_key_puts_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (1, "b", None), (1, "b", 2), (2, None, None)], "k int, a string, b int"
    )
    got = {tuple(r) for r in first_per_key(df, "k", ["a", "b"]).collect()}
    assert got == {(1, "b", 2), (2, None, None)}


def test_maps_carry_no_hint_and_no_null_keys(spark, tmp_path):
    rows = [("a", 1), ("b", 2), *[(None, i) for i in range(2000)]]
    codes = spark.createDataFrame(rows, "short_code string, code int")
    checked = maps.checked_map(codes, ["short_code"], str(tmp_path / "map"), str(tmp_path / "log"))
    assert "ResolvedHint" not in checked._jdf.queryExecution().analyzed().toString()
    assert {tuple(r) for r in checked.collect()} == {("a", 1), ("b", 2)}


def test_every_doubled_key_is_logged(spark, tmp_path):
    codes = spark.range(2000).selectExpr("concat('c', id % 1000) AS short_code", "id AS code")
    with pytest.raises(maps.DuplicateKeys) as refused:
        maps.checked_map(codes, ["short_code"], str(tmp_path / "map"), str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(refused.value.log).count() == 1000


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_source_formats(spark, tmp_path, fmt):
    df = source_tables(spark)["transaction"]
    df.write.format(fmt).option("header", True).save(str(tmp_path / fmt))
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"} if fmt == "json" else {}
    back = read_table(spark, "transaction", Location(str(tmp_path / fmt), fmt, options))
    assert back.schema.simpleString() == df.schema.simpleString()
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}
    assert back.where(F.col("created_at") == datetime(2018, 5, 1)).count() == 1


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(10**6) == 200
    assert shuffle_partitions(10**12) == 7451
    assert shuffle_partitions(10**14) == 745_059
