import glob

from ledger_helpers import SF0001

from ledgermatch.config import ReconConfig
from ledgermatch.operators import gold as gold_ops
from ledgermatch.operators.cleared import detect_cleared
from ledgermatch.plans import queries as Q
from ledgermatch.sinks import tables


def test_first_run_clears_nothing(spark):
    current = Q.classified(spark, SF0001)
    cleared, still = detect_cleared(current, None, Q.RUN_DATE)
    assert cleared.count() == 0
    assert still.count() == current.filter("recon_status = 'UNMATCHED'").count()


def test_cleared_against_earlier_run(spark):
    current = Q.classified(spark, SF0001)
    prev = Q.previous_gold(spark, SF0001)
    cleared, _ = detect_cleared(current, prev, Q.RUN_DATE)
    prev_open = prev.filter("recon_status = 'UNMATCHED'").count()
    now_open = current.filter("recon_status = 'UNMATCHED'").count()
    assert cleared.count() == prev_open - now_open > 0
    # a snapshot newer than the lookback window is not visible
    too_recent, _ = detect_cleared(current, prev, "2026-01-03")
    assert too_recent.count() == 0
    # requiring a match today keeps only keys that matched
    strict, _ = detect_cleared(current, prev, Q.RUN_DATE, ReconConfig(cleared_requires_match=True))
    assert 0 < strict.count() <= cleared.count()


def test_replace_groups(spark):
    t = spark.createDataFrame([("k1", 1, "old"), ("k2", 1, "old"), ("k1", 2, "keep")],
                              "business_key string, _run_date int, v string")
    s = spark.createDataFrame([("k1", 1, "new"), ("k1", 1, "new2"), ("k3", 1, "new")],
                              "business_key string, _run_date int, v string")
    out = sorted(tuple(r) for r in gold_ops.replace_groups(t, s).collect())
    assert out == [("k1", 1, "new"), ("k1", 1, "new2"), ("k1", 2, "keep"), ("k2", 1, "old"), ("k3", 1, "new")]


def test_upsert_is_idempotent(spark, workdir):
    path = f"{workdir}/gold"
    prev = Q.previous_gold(spark, SF0001)
    cur = Q.current_gold(spark, SF0001)
    tables.upsert_gold(spark, prev, path, [Q.PREV_RUN_DATE])
    tables.upsert_gold(spark, cur, path, [Q.RUN_DATE], cluster_by=("recon_status", "settlement_date", "currency"))
    first = spark.read.parquet(path).count()
    tables.upsert_gold(spark, cur, path, [Q.RUN_DATE], cluster_by=("recon_status", "settlement_date", "currency"))
    stored = spark.read.parquet(path)
    assert stored.count() == first == prev.count() + cur.count()
    assert stored.select(*cur.columns).exceptAll(prev.unionByName(cur)).count() == 0


def test_kpi_row_always_present(spark):
    from ledgermatch.operators import kpis

    gold = Q.gold_history(spark, SF0001)
    r = kpis.kpi_daily(gold, "2030-01-01").first()
    assert (r["total_records"], r["match_rate_pct"], r["unmatched_exposure"], r["avg_amount_variance"]) == \
        (0, 0.0, 0.0, 0.0)
    day = kpis.kpi_daily(gold, Q.RUN_DATE).first()
    assert day["total_records"] == day["matched"] + day["unmatched"] + day["new"] + day["cleared"] + \
        day["amount_mismatch"]


def test_cleared_in_one_pass_equals_standalone(spark):
    from pyspark.sql import functions as F

    from ledgermatch.operators import match
    from ledgermatch.operators.cleared import snapshot_open_keys

    prev = spark.read.parquet(Q.stored_previous(spark, SF0001))
    c, r = Q.keyed_cash(spark, SF0001), Q.keyed_rada(spark, SF0001)
    plain = match.classify(c, r).checkpoint()
    standalone, _ = detect_cleared(plain, prev, Q.RUN_DATE)
    folded = match.classify(c, r, previous_open=snapshot_open_keys(prev, Q.RUN_DATE, 5)).checkpoint()
    got = folded.filter(F.col("recon_status") == "CLEARED").select("business_key", "recon_status")
    assert got.exceptAll(standalone).count() == 0 and standalone.exceptAll(got).count() == 0
    assert folded.filter(F.col("recon_status") != "CLEARED").exceptAll(plain).count() == 0


def test_partition_named_for_replacement_is_emptied(spark, workdir):
    rows = spark.createDataFrame([(1, "2026-01-01"), (2, "2026-01-02")], "v int, d string").selectExpr(
        "v", "cast(d as date) as _run_date")
    tables.overwrite_partitions(rows, f"{workdir}/t")
    tables.overwrite_partitions(rows.limit(0), f"{workdir}/t", replace=["2026-01-01", "2026-01-03"])
    assert [r["v"] for r in spark.read.parquet(f"{workdir}/t").collect()] == [2]


def test_optimize_layout_gives_files_disjoint_status_ranges(spark, workdir):
    """After the clustering rewrite, files cover contiguous, non-overlapping
    ranges of the first clustering column, so a status filter skips files."""
    from pyspark.sql import functions as F

    path = f"{workdir}/gold"
    cur = Q.current_gold(spark, SF0001)
    tables.upsert_gold(spark, cur, path, [Q.RUN_DATE], cluster_by=("recon_status", "settlement_date", "currency"))
    tables.optimize_layout(spark, path, [Q.RUN_DATE], ("recon_status", "settlement_date", "currency"))
    stored = spark.read.parquet(path)
    assert stored.count() == cur.count()
    ranges = (stored.groupBy(F.input_file_name().alias("f"))
              .agg(F.min("recon_status").alias("lo"), F.max("recon_status").alias("hi"))
              .orderBy("lo", "hi").collect())
    for a, b in zip(ranges, ranges[1:]):
        assert a["hi"] <= b["lo"]          # ranges do not interleave


def test_z_order_lets_a_filter_on_any_column_skip_files(spark, workdir):
    """A filter on the currency alone, the settlement date alone or the status alone opens under half of the files."""
    import pyarrow.parquet as pq

    path = f"{workdir}/gold"
    cur = Q.current_gold(spark, SF0001).filter("settlement_date is not null")
    tables.upsert_gold(spark, cur, path, [Q.RUN_DATE])
    cols = ("recon_status", "settlement_date", "currency")
    tables.optimize_layout(spark, path, [Q.RUN_DATE], cols, z_order=True, files=48)
    stored = spark.read.parquet(path)
    assert stored.count() == cur.count()
    files = sorted(glob.glob(f"{path}/_run_date={Q.RUN_DATE}/*.parquet"))
    assert len(files) > 20
    mean = {}
    for col in cols:
        spans = []
        for f in files:
            meta = pq.ParquetFile(f).metadata
            at = meta.schema.names.index(col)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            spans.append((min(s.min for s in stats), max(s.max for s in stats)))
        values = [(r[0], r[1]) for r in stored.groupBy(col).count().collect()]
        opened = [(n, sum(lo <= v <= hi for lo, hi in spans) / len(files)) for v, n in values]
        mean[col] = sum(share for _, share in opened) / len(opened)
    assert mean["currency"] < 0.5 and mean["settlement_date"] < 0.5 and mean["recon_status"] < 0.5, mean


def test_z_codes_follow_the_ranks(spark):
    """Nulls first, texts by their first bytes, few values over the high bits; two columns interleaved."""
    from ledgermatch.functions.zorder import quantiles, z_code

    df = spark.createDataFrame([(i, None if i == 0 else "ab"[i % 2] + "x") for i in range(64)], "n int, s string")
    bounds = quantiles(df, ["n", "s"], bits=2)
    codes = {r["n"]: r["z"] for r in df.withColumn("z", z_code(df, bounds, 2)).select("n", "z").collect()}
    def bits(n, s):  # ranks 0 .. 3 of n, 0 or 2 of s, highest bits first
        return (n >> 1) << 3 | (s >> 1) << 2 | (n & 1) << 1 | (s & 1)
    for i in range(1, 64):
        rank = sum(m <= i for m in bounds["n"])
        assert codes[i] == bits(rank, 2 * (i % 2)), i
    assert codes[0] == 0 and len(bounds["n"]) == 3 and len(bounds["s"]) == 1
