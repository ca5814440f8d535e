"""Ledger extracts derived from the shared test tables.

The reference's own sample data is a few hundred generated rows; here both
ledgers are derived, row for row, from the ``orders`` table (and from
``lineitem`` where naturally repeated keys are wanted), so the work grows
with the input. Every rule below is a deterministic function of the source
row; the modulus tests pick which scenario (missing, shifted amount, dirty
field) a row plays, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CASH, RADA

INGESTED_AT = "2026-01-05 01:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c: Column, width: int) -> Column:
    """Zero-padded to at least ``width`` digits; longer numbers keep all of theirs."""
    digits = c.cast("string")
    return F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0"))


def _ledger_columns(key: Column, cust: Column, odate: Column, priority: Column) -> dict[str, Column]:
    settle = odate.cast("date")
    value = F.date_sub(settle, (key % 3).cast("int"))
    return {
        "account_number": F.concat(F.lit("ACC"), _pad(cust, 8)),
        "trade_reference": F.concat(F.lit("TRD"), _pad(key, 7)),
        "swift_bic": F.concat(F.lit("SWF"), _pad(cust % 1000, 3), F.lit("ZAJJ")),
        "transaction_date": value.cast("string"),
        "value_date": value.cast("string"),
        "settlement_date": settle.cast("string"),
        "currency": (F.when(key % 4 == 0, "ZAR").when(key % 4 == 1, "USD")
                     .when(key % 4 == 2, "EUR").otherwise("GBP")),
        "debit_credit": F.when(key % 2 == 0, "D").otherwise("C"),
        "narrative": priority,
    }


def rada_amount(key: Column, price: Column) -> Column:
    """RADA amount: ~1/23 shifted by 2..50 either way (a break), ~1/23 by 0.50 (inside tolerance)."""
    sign = F.when(key % 3 == 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    shift = F.lit(2.0) + (key % 97).cast("double") * F.lit(0.5)
    return (F.when(key % 23 == 3, price + sign * shift)
            .when(key % 23 == 4, price + F.lit(0.5))
            .otherwise(price))


def _ledger(orders: DataFrame, ledger_id: str, id_prefix: str, amount: Column, status: str,
            *extra: Column) -> DataFrame:
    k = F.col("o_orderkey")
    cols = _ledger_columns(k, F.col("o_custkey"), F.col("o_orderdate"), F.col("o_orderpriority"))
    return orders.select(
        F.concat(F.lit(id_prefix), _pad(k, 8)).alias(ledger_id),
        cols["account_number"].alias("account_number"),
        cols["trade_reference"].alias("trade_reference"),
        cols["swift_bic"].alias("swift_bic"),
        cols["transaction_date"].alias("transaction_date"),
        cols["value_date"].alias("value_date"),
        cols["settlement_date"].alias("settlement_date"),
        cols["currency"].alias("currency"),
        amount.alias("amount"),
        cols["debit_credit"].alias("debit_credit"),
        cols["narrative"].alias("narrative"),
        F.lit(status).alias("status"),
        F.to_timestamp(F.lit(INGESTED_AT)).alias("_ingested_ts"),
        *extra,
    )


def cash_bronze(spark: SparkSession, sf_dir: str, *, whole: bool = False) -> DataFrame:
    """Cash extract: every order except those with key % 17 = 7 (missing in
    cash, which is what matching looks for); ``whole=True``: every order."""
    orders = read_table(spark, sf_dir, "orders")
    if not whole:
        orders = orders.filter(F.col("o_orderkey") % 17 != 7)
    return _ledger(orders, CASH.id_col, "CSH", F.col("o_totalprice"), CASH.settled_status)


def rada_bronze(spark: SparkSession, sf_dir: str, *, earlier: bool = False, whole: bool = False) -> DataFrame:
    """RADA extract: every order except key % 19 = 5 (missing in RADA);
    ``whole=True``: every order.

    ``earlier=True`` gives the extract of an earlier day, which also lacked
    the orders with key % 13 = 9 (they arrived later, which clears them).
    """
    k = F.col("o_orderkey")
    orders = read_table(spark, sf_dir, "orders")
    if not whole:
        orders = orders.filter(k % 19 != 5)
    if earlier:
        orders = orders.filter(k % 13 != 9)
    return _ledger(orders, RADA.id_col, "RADA", rada_amount(k, F.col("o_totalprice")), RADA.settled_status)


def rada_field_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The RADA extract with one field wrong, by o_orderkey % 29: 1 account of the
    next customer, 2 trade reference with a suffix, 3 settled a day later, 4 currency JPY,
    5 the other debit/credit code, 6 two fields at once (account and currency)."""
    k = F.col("o_orderkey")
    rada = _ledger(read_table(spark, sf_dir, "orders").filter(k % 19 != 5), RADA.id_col, "RADA",
                   rada_amount(k, F.col("o_totalprice")), RADA.settled_status, (k % 29).alias("_fault"),
                   F.concat(F.lit("ACC"), _pad(F.col("o_custkey") + 1, 8)).alias("_next"))
    m = F.col("_fault")
    return rada.withColumns({
        "account_number": F.when(m.isin(1, 6), F.col("_next")).otherwise(F.col("account_number")),
        "trade_reference": F.when(m == 2, F.concat("trade_reference", F.lit("-1"))).otherwise(F.col("trade_reference")),
        "settlement_date": F.when(m == 3, F.date_add(F.col("settlement_date").cast("date"), 1).cast("string"))
        .otherwise(F.col("settlement_date")),
        "currency": F.when(m.isin(4, 6), F.lit("JPY")).otherwise(F.col("currency")),
        "debit_credit": F.when(m == 5, F.when(F.col("debit_credit") == "D", "C").otherwise("D"))
        .otherwise(F.col("debit_credit")),
    }).drop("_fault", "_next")


def dirty_cash_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cash extract as raw text with faults, chosen by o_orderkey % 50:

    11 negative amount; 12 debit_credit 'X'; 13 settlement date dd/MM/yyyy;
    14 debit_credit missing; 15 lower-case account padded with blanks
    (repairable); 16 row delivered twice, the copy later and re-narrated;
    17 blank-only account; 18 amount 'abc'; 19 amount 'NaN';
    20 lower-case debit_credit 'd'/'c' (repairable).
    """
    orders = read_table(spark, sf_dir, "orders")
    base = _ledger(orders, CASH.id_col, "CSH", F.col("o_totalprice"), CASH.settled_status,
                   (F.col("o_orderkey") % 50).alias("_fault"))
    m = F.col("_fault")
    amount_text = F.col("amount").cast("string")
    dirty = base.select(
        F.col(CASH.id_col),
        (F.when(m == 15, F.concat(F.lit("  "), F.lower("account_number"), F.lit(" ")))
         .when(m == 17, F.lit("   ")).otherwise(F.col("account_number"))).alias("account_number"),
        "trade_reference", "swift_bic", "transaction_date", "value_date",
        (F.when(m == 13, F.date_format(F.col("settlement_date").cast("date"), "dd/MM/yyyy"))
         .otherwise(F.col("settlement_date"))).alias("settlement_date"),
        "currency",
        (F.when(m == 11, F.concat(F.lit("-"), amount_text)).when(m == 18, F.lit("abc"))
         .when(m == 19, F.lit("NaN")).otherwise(amount_text)).alias("amount"),
        (F.when(m == 12, F.lit("X")).when(m == 14, F.lit(None).cast("string"))
         .when(m == 20, F.lower("debit_credit")).otherwise(F.col("debit_credit"))).alias("debit_credit"),
        "narrative", "status", "_ingested_ts", m,
    )
    resent = (dirty.filter(m == 16)
              .withColumn("narrative", F.lit("RESENT"))
              .withColumn("_ingested_ts", F.col("_ingested_ts") + F.expr("INTERVAL 1 HOUR")))
    return dirty.unionByName(resent).drop("_fault")


def dirty_cash_days(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The dirty cash extract over three landing days: ids that end in an even
    digit, the other ids, and the copies that are sent again."""
    rows = dirty_cash_bronze(spark, sf_dir)
    odd = F.substring(CASH.id_col, -1, 1).isin("1", "3", "5", "7", "9")
    again = F.col("narrative") == "RESENT"
    return [rows.filter(~again & ~odd), rows.filter(~again & odd), rows.filter(again)]


def evolving_cash_days(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The whole cash extract as text over three landing days, by o_orderkey % 3:
    the plain columns; a channel column more; that column first and the others in
    reverse. The amount is 'abc' where o_orderkey % 50 = 18."""
    k = F.col("o_orderkey")
    cash = _ledger(read_table(spark, sf_dir, "orders"), CASH.id_col, "CSH",
                   F.when(k % 50 == 18, F.lit("abc")).otherwise(F.col("o_totalprice").cast("string")),
                   CASH.settled_status, (k % 3).alias("_day"), F.concat(F.lit("CH"), (k % 5).cast("string")).alias("channel"))
    cash = cash.drop("_ingested_ts")
    plain = [c for c in cash.columns if c not in ("_day", "channel")]
    return [cash.filter("_day = 0").select(*plain), cash.filter("_day = 1").select(*plain, "channel"),
            cash.filter("_day = 2").select("channel", *reversed(plain))]


def _lineitem_ledger(lineitem: DataFrame, ledger_id: str, prefix: str, account: Column,
                     trade: Column, group: Column, amount: Column) -> DataFrame:
    ok = F.col("l_orderkey")
    rid = F.concat_ws("-", F.lit(prefix), ok.cast("string"), F.col("l_linenumber").cast("string"),
                      F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    settle = F.date_add(F.lit("2026-01-01").cast("date"), (group % 28).cast("int"))
    return lineitem.select(
        rid.alias(ledger_id),
        account.alias("account_number"),
        trade.alias("trade_reference"),
        F.lit(None).cast("string").alias("swift_bic"),
        settle.cast("string").alias("transaction_date"),
        settle.cast("string").alias("value_date"),
        settle.cast("string").alias("settlement_date"),
        (F.when(group % 4 == 0, "ZAR").when(group % 4 == 1, "USD").when(group % 4 == 2, "EUR")
         .otherwise("GBP")).alias("currency"),
        amount.alias("amount"),
        F.when(group % 2 == 0, "D").otherwise("C").alias("debit_credit"),
        F.lit(None).cast("string").alias("narrative"),
        F.lit("SETTLED" if prefix == "CSH" else "CONFIRMED").alias("status"),
        F.to_timestamp(F.lit(INGESTED_AT)).alias("_ingested_ts"),
    )


def lineitem_rada_amount(li_price: Column, partkey: Column) -> Column:
    return F.when(partkey % 7 == 1, li_price + F.lit(5.0)).otherwise(li_price)


def repeated_key_ledgers(spark: SparkSession, sf_dir: str, *, skewed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cash/RADA pairs whose business keys repeat.

    Default: keyed by (order, line number), which is not unique in
    ``lineitem``. ``skewed=True``: keyed by return flag only, so each of the
    three keys holds about a third of all rows.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if skewed:
        account = F.concat(F.lit("ACC"), F.col("l_returnflag"))
        trade = F.lit("TRD0000000")
        group = F.lit(0)
    else:
        account = F.concat(F.lit("ACC"), _pad(F.col("l_orderkey"), 8))
        trade = F.concat(F.lit("TRD"), _pad(F.col("l_linenumber"), 7))
        group = F.col("l_orderkey")
    price = F.col("l_extendedprice")
    cash = _lineitem_ledger(li, CASH.id_col, "CSH", account, trade, group, price)
    rada = _lineitem_ledger(li.filter(F.col("l_partkey") % 11 != 3), RADA.id_col, "RADA", account, trade,
                            group, lineitem_rada_amount(price, F.col("l_partkey")))
    return cash, rada


def rada_minor_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole RADA extract with amounts in minor units (whole cents, as text)."""
    rada = rada_bronze(spark, sf_dir, whole=True)
    return rada.withColumn("amount", F.round(F.col("amount") * F.lit(100.0)).cast("bigint").cast("string"))
