import pytest
from ledger_helpers import SF001, ledger_rows
from pyspark.sql import functions as F

from ledgermatch.config import ReconConfig
from ledgermatch.functions.keys import prepare_for_matching
from ledgermatch.operators import match


def _classify(spark, cash_rows, rada_rows, cfg=ReconConfig()):
    cash = prepare_for_matching(ledger_rows(spark, "cash_id", cash_rows), "cash_id")
    rada = prepare_for_matching(ledger_rows(spark, "rada_id", rada_rows), "rada_id")
    return match.classify(cash, rada, cfg)


def _one(spark, cash_amount, rada_amount):
    cash = [("C1", "ACC1", "TRD1", "2026-05-05", "ZAR", cash_amount, "D")] if cash_amount is not None else []
    rada = [("R1", "ACC1", "TRD1", "2026-05-05", "ZAR", rada_amount, "D")] if rada_amount is not None else []
    rows = _classify(spark, cash, rada).collect()
    assert len(rows) == 1
    return rows[0]


# the classification table of the original tests, on real Spark frames
@pytest.mark.parametrize("cash,rada,status", [
    (100000.00, 100000.00, "MATCHED"),
    (100000.00, 100000.50, "MATCHED"),
    (100000.00, 100050.00, "AMOUNT_MISMATCH"),
    (50000.0, None, "UNMATCHED"),
    (None, 75000.0, "NEW"),
    (100000.00, 100001.00, "MATCHED"),          # tolerance is inclusive
    (100000.00, 100001.01, "AMOUNT_MISMATCH"),
    (1.20, 2.20, "MATCHED"),                    # also where doubles cannot tell
    (2.20, 1.20, "MATCHED"),
])
def test_classification_table(spark, cash, rada, status):
    assert _one(spark, cash, rada)["recon_status"] == status


def test_projection_per_class(spark):
    m = _one(spark, 100.0, 100.5)
    assert m["rada_amount"] == 100.5 and m["amount_variance"] == -0.5 and m["swift_bic"] == "SWFT"
    mm = _one(spark, 100.0, 150.0)
    assert mm["swift_bic"] is None and mm["mismatch_reason"] == "AMOUNT"
    u = _one(spark, 100.0, None)
    assert u["rada_id"] is None and u["rada_amount"] is None and u["amount_variance"] is None
    n = _one(spark, None, 75.0)
    assert n["amount"] == 75.0 and n["cash_id"] is None and n["account_number"] is None
    assert n["mismatch_reason"] == "MISSING_IN_CASH"


def test_self_match_one_row(spark):
    row = [("K1", "A1", "T1", "2024-01-01", "ZAR", 100.0, "D")]
    assert _classify(spark, row, row).filter("recon_status = 'MATCHED'").count() == 1


def test_unknown_amount_on_pair_is_mismatch(spark):
    assert _one(spark, 100.0, float("nan"))["recon_status"] == "AMOUNT_MISMATCH"
    k = ("ACC1", "TRD1", "2026-05-05", "ZAR")
    rows = _classify(spark, [("C1", *k, None, "D")], [("R1", *k, 5.0, "D")]).collect()
    assert [r["recon_status"] for r in rows] == ["AMOUNT_MISMATCH"]


def test_repeated_keys_pair_one_to_one(spark):
    """3 cash and 2 RADA records on one key: 3 output rows, each record once,
    paired in amount order."""
    k = ("ACC1", "TRD1", "2026-05-05", "ZAR", "D")
    cash = [("C1", *k[:4], 300.0, "D"), ("C2", *k[:4], 100.0, "D"), ("C3", *k[:4], 200.0, "D")]
    rada = [("R1", *k[:4], 200.4, "D"), ("R2", *k[:4], 100.0, "D")]
    rows = {(r["cash_id"], r["rada_id"], r["recon_status"]) for r in _classify(spark, cash, rada).collect()}
    assert rows == {("C2", "R2", "MATCHED"), ("C3", "R1", "MATCHED"), ("C1", None, "UNMATCHED")}


def test_equal_amounts_are_paired_first(spark):
    """An absent record must not shift the others: the equal amounts pair."""
    k = ("ACC1", "TRD1", "2026-05-05", "ZAR")
    cash = [("C1", *k, 100.0, "D"), ("C2", *k, 200.0, "D"), ("C3", *k, 300.2, "D"), ("C4", *k, 900.0, "D")]
    rada = [("R1", *k, 200.0, "D"), ("R2", *k, 299.9, "D"), ("R3", *k, 950.0, "D")]
    rows = {(r["cash_id"], r["rada_id"], r["recon_status"]) for r in _classify(spark, cash, rada).collect()}
    assert {("C2", "R1", "MATCHED"), ("C3", "R2", "MATCHED")} <= rows
    assert sum(status == "AMOUNT_MISMATCH" for _, _, status in rows) == 1
    assert sum(status == "UNMATCHED" for _, _, status in rows) == 1 and len(rows) == 4


def test_skewed_keys_make_the_most_pairs(spark):
    """Three keys with a third of all rows each: as many MATCHED as a sweep over the whole key
    in memory finds (46,702 pairs of equal amounts exist; a few of these make way), every record in exactly one row."""
    from collections import defaultdict
    from decimal import Decimal

    from ledgermatch.sources import fixtures as fx

    cash, rada = fx.repeated_key_ledgers(spark, SF001, skewed=True)
    c, r = prepare_for_matching(cash, "cash_id"), prepare_for_matching(rada, "rada_id")
    out = match.classify(c, r).checkpoint()
    amounts = defaultdict(lambda: ([], []))
    for side, ledger in enumerate((c, r)):
        for key, amount in ledger.select("business_key", "amount").collect():
            amounts[key][side].append(Decimal(str(amount)))
    most = 0
    for xs, ys in amounts.values():
        xs, ys, i, j = sorted(xs), sorted(ys), 0, 0
        while i < len(xs) and j < len(ys):
            near = abs(xs[i] - ys[j]) <= 1
            most += near
            i, j = i + (near or xs[i] < ys[j]), j + (near or ys[j] < xs[i])
    assert out.filter("recon_status = 'MATCHED'").count() == most > 46_702
    for ledger, column in ((c, "cash_id"), (r, "rada_id")):
        seen = out.filter(F.col(column).isNotNull())
        assert seen.count() == seen.select(column).distinct().count() == ledger.count()


def test_no_pair_within_the_tolerance_is_left(spark):
    """On three keys with all rows, no cash and RADA amount that could match are both left over."""
    from ledgermatch.sources import fixtures as fx

    cash, rada = fx.repeated_key_ledgers(spark, SF001, skewed=True)
    out = match.classify(prepare_for_matching(cash, "cash_id"), prepare_for_matching(rada, "rada_id"))
    left = out.filter("recon_status <> 'MATCHED'").select("business_key", "recon_status", "amount", "rada_amount").checkpoint()
    c = left.filter("recon_status <> 'NEW'").select("business_key", F.col("amount").alias("x"))
    r = left.filter("recon_status <> 'UNMATCHED'").select("business_key", F.coalesce("rada_amount", "amount").alias("y"))
    near = F.explode(F.sequence(F.floor("y") - 1, F.floor("y") + 1))
    assert c.count() > 1000 and r.count() > 1000
    assert c.withColumn("b", F.floor("x")).join(r.withColumn("b", near), ["business_key", "b"]).filter(
        "abs(cast(x as decimal(38,6)) - cast(y as decimal(38,6))) <= 1").count() == 0


@pytest.mark.parametrize("ids", [("c0", "d0", "r0", "s0"), ("c1", "d1", "r1", "s1"), ("d", "c", "s", "r")])
def test_pairs_do_not_depend_on_identifiers(spark, ids):
    k = ("ACC1", "TRD1", "2026-05-05", "ZAR")
    cash = [(ids[0], *k, 1000.40, "D"), (ids[1], *k, 1010.40, "D")]
    rada = [(ids[2], *k, 1001.20, "D"), (ids[3], *k, 1011.20, "D")]
    rows = {(r["cash_id"], r["rada_id"], r["recon_status"]) for r in _classify(spark, cash, rada).collect()}
    assert rows == {(ids[0], ids[2], "MATCHED"), (ids[1], ids[3], "MATCHED")}


def test_a_key_does_not_depend_on_other_keys(spark):
    """Unknown amounts come last in a key, whatever other keys hold."""
    k = ("TRD1", "2026-05-05", "ZAR")
    cash = [("C1", "A", *k, float("inf"), "D"), ("C2", "A", *k, 5.0, "D")]
    rada = [("R1", "A", *k, 5.5, "D")]
    other = [("C3", "B", *k, 1.0, "D"), ("C4", "B", *k, 9.0, "D")], [("R2", "B", *k, 70.0, "D"), ("R3", "B", *k, 80.0, "D")]
    want = {("C2", "R1", "MATCHED"), ("C1", None, "UNMATCHED")}
    for more_cash, more_rada in (([], []), other):
        rows = {(r["cash_id"], r["rada_id"], r["recon_status"]) for r in
                _classify(spark, cash + more_cash, rada + more_rada).collect()}
        assert want <= rows and len(rows) == 2 + len(more_rada)


def test_runs_go_on_across_buckets(spark):
    """A run of amounts a tolerance apart, much longer than a bucket, shifted by half a tolerance."""
    n = 2500
    row = [F.lit(x).alias(c) for c, x in (("business_key", "k"), ("account_number", "a"), ("trade_reference", "t"),
           ("currency", "ZAR"), ("swift_bic", "s"), ("debit_credit", "D"), ("status", "S"))]
    base = spark.range(n).select(F.col("id").cast("string").alias("i"), *row, F.col("id").cast("double").alias("amount"),
                                 F.lit("2026-01-01").cast("date").alias("settlement_date"))
    out = match.classify(base.withColumnRenamed("i", "cash_id"), base.withColumnRenamed("i", "rada_id").withColumn(
        "amount", F.col("amount") + 1.0)).collect()
    assert len(out) == n and all(r["recon_status"] == "MATCHED" for r in out)
    assert {r["amount"] - r["rada_amount"] for r in out} == {-1.0}


def test_one_amount_of_one_key_repeated_very_often(spark):
    """Numbers run on across slices: n cash and m RADA records of one amount give min(n, m) pairs."""
    ids = spark.range(3000).select(F.col("id").cast("string").alias("i"))
    row = [F.lit(x).alias(n) for n, x in (("business_key", "k"), ("account_number", "a"), ("trade_reference", "t"),
           ("currency", "ZAR"), ("swift_bic", "s"), ("debit_credit", "D"), ("status", "S"))]
    frame = ids.select("i", *row, F.lit("2026-01-01").cast("date").alias("settlement_date"), F.lit(5.0).alias("amount"))
    out = match.classify(frame.withColumnRenamed("i", "cash_id"), frame.filter("cast(i as int) % 3 > 0")
                         .withColumnRenamed("i", "rada_id"))
    assert {r["recon_status"]: r["count"] for r in out.groupBy("recon_status").count().collect()} == {
        "MATCHED": 2000, "UNMATCHED": 1000}


def test_statuses_partition_every_record(spark):
    """Each input record appears in exactly one output row."""
    from ledgermatch.plans import queries as Q

    c = Q.keyed_cash(spark, SF001)
    r = Q.keyed_rada(spark, SF001)
    out = match.classify(c, r)
    assert out.filter("cash_id IS NOT NULL").select("cash_id").distinct().count() == c.count()
    assert out.filter("rada_id IS NOT NULL").select("rada_id").distinct().count() == r.count()
    assert out.filter("cash_id IS NOT NULL").count() == c.count()


def test_reconcile_views_share_one_materialized_match(spark):
    from ledgermatch.plans import queries as Q

    c, r = Q.keyed_cash(spark, SF001), Q.keyed_rada(spark, SF001)
    views = match.reconcile(c, r)
    for v in views:   # read from the checkpoint: no exchange left in the view's plan
        assert "Exchange" not in v._jdf.queryExecution().executedPlan().toString()
    full = match.classify(c, r)
    for v, f in zip(views, (match.matched, match.unmatched, match.new, match.amount_mismatched)):
        assert v.exceptAll(f(full)).count() == 0 and f(full).exceptAll(v).count() == 0
