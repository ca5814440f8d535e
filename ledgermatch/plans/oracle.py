"""Independent SQL statements of the registered queries, for DuckDB.

Each statement recomputes its query from the raw tables (``orders``,
``lineitem``) with plain SQL: the fixture derivation, standardisation,
keys, one-to-one pairing, classification and the aggregates. The Spark
code and these statements share only the fixed values (labels, patterns,
run dates), not code.
"""

from __future__ import annotations

from .queries import LATER_RUN_TS, PREV_RUN_DATE, PREV_RUN_TS, RUN_DATE, RUN_TS, THIRD_RUN_DATE

TOL = "1.0"
LOOKBACK = 5

_CURRENCY = "CASE {k} % 4 WHEN 0 THEN 'ZAR' WHEN 1 THEN 'USD' WHEN 2 THEN 'EUR' ELSE 'GBP' END"
_DC = "CASE WHEN {k} % 2 = 0 THEN 'D' ELSE 'C' END"


def _orders_ledger(id_col: str, prefix: str, amount: str, status: str, where: str, amount_text: bool = False,
                   extra: str = "") -> str:
    amt = f"CAST({amount} AS VARCHAR)" if amount_text else amount
    return f"""
    SELECT '{prefix}' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS {id_col},
           'ACC' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(8, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS account_number,
           'TRD' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0') AS trade_reference,
           'SWF' || lpad(CAST(o_custkey % 1000 AS VARCHAR), CAST(greatest(3, length(CAST(o_custkey % 1000 AS VARCHAR))) AS INTEGER), '0') || 'ZAJJ' AS swift_bic,
           CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 3 AS INTEGER) AS VARCHAR) AS transaction_date,
           CAST(CAST(o_orderdate AS DATE) - CAST(o_orderkey % 3 AS INTEGER) AS VARCHAR) AS value_date,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS settlement_date,
           {_CURRENCY.format(k='o_orderkey')} AS currency,
           {amt} AS amount,
           {_DC.format(k='o_orderkey')} AS debit_credit,
           o_orderpriority AS narrative,
           '{status}' AS status,
           TIMESTAMP '2026-01-05 01:00:00' AS _ingested_ts{extra}
    FROM orders WHERE {where}"""


_RADA_AMOUNT = """CASE WHEN o_orderkey % 23 = 3 THEN o_totalprice
        + (CASE WHEN o_orderkey % 3 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END)
        * (CAST(2 AS DOUBLE) + CAST(o_orderkey % 97 AS DOUBLE) * CAST(0.5 AS DOUBLE))
      WHEN o_orderkey % 23 = 4 THEN o_totalprice + CAST(0.5 AS DOUBLE)
      ELSE o_totalprice END"""

CASH_WHOLE = _orders_ledger("cash_id", "CSH", "o_totalprice", "SETTLED", "TRUE")
RADA_WHOLE = _orders_ledger("rada_id", "RADA", _RADA_AMOUNT, "CONFIRMED", "TRUE")
CASH_BRONZE = _orders_ledger("cash_id", "CSH", "o_totalprice", "SETTLED", "o_orderkey % 17 <> 7")
RADA_BRONZE = _orders_ledger("rada_id", "RADA", _RADA_AMOUNT, "CONFIRMED", "o_orderkey % 19 <> 5")
RADA_BRONZE_EARLIER = _orders_ledger("rada_id", "RADA", _RADA_AMOUNT, "CONFIRMED",
                                     "o_orderkey % 19 <> 5 AND o_orderkey % 13 <> 9")

DIRTY_BASE = _orders_ledger("cash_id", "CSH", "o_totalprice", "SETTLED", "TRUE", amount_text=True,
                            extra=", o_orderkey % 50 AS fault")
DIRTY_FAULTS = """
    SELECT cash_id,
           CASE WHEN fault = 15 THEN '  ' || lower(account_number) || ' '
                WHEN fault = 17 THEN '   ' ELSE account_number END AS account_number,
           trade_reference, swift_bic, transaction_date, value_date,
           CASE WHEN fault = 13 THEN strftime(CAST(settlement_date AS DATE), '%d/%m/%Y')
                ELSE settlement_date END AS settlement_date,
           currency,
           CASE WHEN fault = 11 THEN '-' || amount WHEN fault = 18 THEN 'abc'
                WHEN fault = 19 THEN 'NaN' ELSE amount END AS amount,
           CASE WHEN fault = 12 THEN 'X' WHEN fault = 14 THEN NULL
                WHEN fault = 20 THEN lower(debit_credit) ELSE debit_credit END AS debit_credit,
           narrative, status, _ingested_ts, fault
    FROM dirty_base"""
DIRTY = """
    SELECT * EXCLUDE (fault) FROM dirty_faults
    UNION ALL BY NAME
    SELECT * EXCLUDE (fault, narrative, _ingested_ts),
           'RESENT' AS narrative, _ingested_ts + INTERVAL 1 HOUR AS _ingested_ts
    FROM dirty_faults WHERE fault = 16"""

EVOLVING = _orders_ledger("cash_id", "CSH", "o_totalprice", "SETTLED", "TRUE", extra=""",
           o_orderkey % 3 AS day, o_orderkey % 50 = 18 AS bad, 'CH' || CAST(o_orderkey % 5 AS VARCHAR) AS channel""")
EVOLVING_LINE = ("cash_id, account_number, trade_reference, swift_bic, transaction_date, value_date, settlement_date, "
                 "currency, 'abc', debit_credit, narrative, status")
EVOLVING_REVERSED = ", ".join(reversed(EVOLVING_LINE.split(", ")))

LEDGER_COLS = ("account_number, trade_reference, swift_bic, transaction_date, value_date, settlement_date, "
               "currency, amount, debit_credit, narrative, status")


def _normalise(src: str, id_col: str) -> str:
    return f"""
    SELECT {id_col},
           upper(trim(account_number)) AS account_number,
           upper(trim(trade_reference)) AS trade_reference,
           upper(trim(swift_bic)) AS swift_bic,
           CAST(try_strptime(CAST(transaction_date AS VARCHAR), '%Y-%m-%d') AS DATE) AS transaction_date,
           CAST(try_strptime(CAST(value_date AS VARCHAR), '%Y-%m-%d') AS DATE) AS value_date,
           CAST(try_strptime(CAST(settlement_date AS VARCHAR), '%Y-%m-%d') AS DATE) AS settlement_date,
           upper(trim(currency)) AS currency,
           TRY_CAST(amount AS DOUBLE) AS amount,
           upper(trim(debit_credit)) AS debit_credit,
           narrative, status, _ingested_ts
    FROM {src}"""


def _flagged(src: str, id_col: str) -> str:
    return f"""
    SELECT *, coalesce({id_col} IS NOT NULL
           AND account_number IS NOT NULL AND length(account_number) > 0
           AND trade_reference IS NOT NULL AND length(trade_reference) > 0
           AND currency IS NOT NULL AND length(currency) > 0
           AND settlement_date IS NOT NULL
           AND amount IS NOT NULL AND NOT isnan(amount) AND amount >= 0
           AND debit_credit IN ('D', 'C'), FALSE) AS ok
    FROM {src}"""


_DEDUP_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in ["_ingested_ts"] + LEDGER_COLS.split(", "))


def _dedup(src: str, id_col: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {id_col} ORDER BY {_DEDUP_ORDER}) AS rn
      FROM {src} WHERE ok) WHERE rn = 1"""


_KEY = ("sha256(concat_ws('|', coalesce(account_number, 'NULL'), coalesce(trade_reference, 'NULL'), "
        "coalesce(CAST(settlement_date AS VARCHAR), 'NULL'), coalesce(currency, 'NULL'), "
        "coalesce(debit_credit, 'NULL')))")
_KEY_INPUT = ("concat_ws('|', coalesce(account_number, 'NULL'), coalesce(trade_reference, 'NULL'), "
              "coalesce(CAST(settlement_date AS VARCHAR), 'NULL'), coalesce(currency, 'NULL'), "
              "coalesce(debit_credit, 'NULL'))")


def _keyed(src: str, id_col: str) -> str:
    return f"""
    SELECT {_KEY} AS business_key, {_KEY_INPUT} AS key_input, {id_col}, account_number, trade_reference,
           swift_bic, settlement_date, value_date, currency, amount, debit_credit, narrative, status
    FROM {src}"""


_PAYLOAD = "account_number, trade_reference, settlement_date, currency, swift_bic, debit_credit"


def _classified(cash: str, rada: str) -> list[tuple[str, str]]:
    """CTEs ending in ``{cash}_{rada}_cls``. Keys without a choice are joined. In
    the others the sweep goes up each run of amounts (neighbours at most the tolerance
    apart) and pairs a record with the oldest of the other side that waits within the
    tolerance, once over all records (v = 1) and once over those that no equal
    amount takes (v = 2); a run keeps equal amounts first (v = 2) unless that loses
    pairs. The rest of a key pairs by rank."""
    p = f"{cash}_{rada}"
    return [
        (f"{p}_rows", f"""
    SELECT business_key, 0 AS side, cash_id AS rid, amount AS amt, CAST(amount AS DECIMAL(38,6)) AS x FROM {cash}
    UNION ALL SELECT business_key, 1, rada_id, amount, CAST(amount AS DECIMAL(38,6)) FROM {rada}"""),
        (f"{p}_many", f"""
    SELECT business_key FROM {p}_rows GROUP BY business_key
    HAVING count(*) FILTER (WHERE side = 0) > 0 AND count(*) FILTER (WHERE side = 1) > 0 AND count(*) > 2"""),
        (f"{p}_num", f"""
    SELECT *, row_number() OVER (PARTITION BY business_key, side, x ORDER BY substr(md5(rid), 1, 2), rid) AS k
    FROM {p}_rows WHERE business_key IN (SELECT business_key FROM {p}_many)"""),
        (f"{p}_amounts", f"""
    SELECT business_key, x, count(*) FILTER (WHERE side = 0) AS nc, count(*) FILTER (WHERE side = 1) AS nr
    FROM {p}_num GROUP BY business_key, x"""),
        (f"{p}_runs", f"""
    SELECT *, sum(opens) OVER (ORDER BY business_key, x) AS run FROM (
      SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY business_key ORDER BY x) <= {TOL} THEN 0 ELSE 1 END AS opens
      FROM {p}_amounts)"""),
        (f"{p}_lists", f"""
    SELECT v, run, business_key, list({{'side': side, 'x': x, 'k': k, 'pend': [{{'x': x, 'k': k}}],
      'met': CAST([] AS STRUCT(cx DECIMAL(38,6), ck BIGINT, rx DECIMAL(38,6), rk BIGINT)[])}} ORDER BY x, k) AS records
    FROM {p}_num JOIN {p}_runs USING (business_key, x), (VALUES (1), (2)) AS variants(v)
    WHERE v = 1 OR k > least(nc, nr) GROUP BY v, run, business_key"""),
        # the records of one side that wait, oldest first, and the pairs so far
        (f"{p}_walk", f"""
    SELECT v, run, business_key, list_reduce(records, lambda acc, e: CASE
      WHEN acc.side <> e.side AND len(list_filter(acc.pend, lambda q: q.x >= e.x - {TOL})) > 0 THEN
        {{'side': acc.side, 'x': e.x, 'k': e.k, 'pend': list_filter(acc.pend, lambda q: q.x >= e.x - {TOL})[2:],
          'met': list_append(acc.met, {{
            'cx': CASE WHEN e.side = 0 THEN e.x ELSE list_filter(acc.pend, lambda q: q.x >= e.x - {TOL})[1].x END,
            'ck': CASE WHEN e.side = 0 THEN e.k ELSE list_filter(acc.pend, lambda q: q.x >= e.x - {TOL})[1].k END,
            'rx': CASE WHEN e.side = 1 THEN e.x ELSE list_filter(acc.pend, lambda q: q.x >= e.x - {TOL})[1].x END,
            'rk': CASE WHEN e.side = 1 THEN e.k ELSE list_filter(acc.pend, lambda q: q.x >= e.x - {TOL})[1].k END}})}}
      ELSE {{'side': e.side, 'x': e.x, 'k': e.k, 'pend': CASE WHEN acc.side = e.side
          THEN list_concat(list_filter(acc.pend, lambda q: q.x >= e.x - {TOL}), e.pend) ELSE e.pend END, 'met': acc.met}}
      END).met AS met FROM {p}_lists"""),
        (f"{p}_met", f"SELECT v, run, business_key, unnest(met, recursive := true) FROM {p}_walk"),
        (f"{p}_choice", f"""
    SELECT run, CASE WHEN eq + coalesce(n2, 0) = coalesce(n1, 0) THEN 2 ELSE 1 END AS v
    FROM (SELECT run, sum(least(nc, nr)) AS eq FROM {p}_runs GROUP BY run)
    LEFT JOIN (SELECT run, count(*) FILTER (WHERE v = 1) AS n1, count(*) FILTER (WHERE v = 2) AS n2
               FROM {p}_met GROUP BY run) USING (run)"""),
        (f"{p}_close", f"""
    SELECT business_key, cx, ck, rx, rk FROM {p}_met JOIN {p}_choice USING (run, v)
    UNION ALL
    SELECT business_key, x, k, x, k FROM {p}_num JOIN {p}_runs USING (business_key, x) JOIN {p}_choice USING (run)
    WHERE v = 2 AND side = 0 AND k <= least(nc, nr)"""),
        (f"{p}_c", f"SELECT * FROM {p}_num WHERE side = 0"),
        (f"{p}_r", f"SELECT * FROM {p}_num WHERE side = 1"),
        (f"{p}_left", f"""
    SELECT *, row_number() OVER (PARTITION BY business_key, side ORDER BY x NULLS LAST, k) AS i FROM (
      SELECT * FROM {p}_c ANTI JOIN {p}_close cl ON cl.business_key = {p}_c.business_key AND cl.cx = x AND cl.ck = k
      UNION ALL
      SELECT * FROM {p}_r ANTI JOIN {p}_close cl ON cl.business_key = {p}_r.business_key AND cl.rx = x AND cl.rk = k)"""),
        (f"{p}_pairs", f"""
    SELECT c.business_key, c.rid AS cash_id, r.rid AS rada_id, c.amt AS ca, r.amt AS ra
    FROM {p}_close cl JOIN {p}_c c ON c.business_key = cl.business_key AND c.x = cl.cx AND c.k = cl.ck
                      JOIN {p}_r r ON r.business_key = cl.business_key AND r.x = cl.rx AND r.k = cl.rk
    UNION ALL
    SELECT coalesce(c.business_key, r.business_key), c.rid, r.rid, c.amt, r.amt
    FROM (SELECT * FROM {p}_left WHERE side = 0) c FULL JOIN (SELECT * FROM {p}_left WHERE side = 1) r
      ON c.business_key = r.business_key AND c.i = r.i
    UNION ALL
    SELECT coalesce(c.business_key, r.business_key), c.rid, r.rid, c.amt, r.amt
    FROM (SELECT * FROM {p}_rows WHERE side = 0 AND business_key NOT IN (SELECT business_key FROM {p}_many)) c
    FULL JOIN (SELECT * FROM {p}_rows WHERE side = 1 AND business_key NOT IN (SELECT business_key FROM {p}_many)) r
      ON c.business_key = r.business_key"""),
        (f"{p}_lab", f"""
    SELECT q.business_key, q.cash_id, q.rada_id, ca, ra, {_PAYLOAD},
           CASE WHEN q.cash_id IS NULL THEN 'NEW' WHEN q.rada_id IS NULL THEN 'UNMATCHED'
                WHEN abs(CAST(ca AS DECIMAL(38,6)) - CAST(ra AS DECIMAL(38,6))) <= {TOL} THEN 'MATCHED'
                ELSE 'AMOUNT_MISMATCH' END AS recon_status
    FROM {p}_pairs q LEFT JOIN {cash} USING (cash_id)"""),
        (f"{p}_cls", f"""
    SELECT business_key, cash_id, rada_id, account_number, trade_reference, settlement_date, currency,
           CASE WHEN cash_id IS NOT NULL THEN ca ELSE ra END AS amount,
           CASE WHEN cash_id IS NOT NULL THEN ra END AS rada_amount,
           CASE WHEN cash_id IS NOT NULL AND rada_id IS NOT NULL
                THEN CAST(CAST(ca AS DECIMAL(38,6)) - CAST(ra AS DECIMAL(38,6)) AS DOUBLE) END AS amount_variance,
           CASE WHEN recon_status <> 'AMOUNT_MISMATCH' THEN swift_bic END AS swift_bic,
           debit_credit, recon_status,
           CASE recon_status WHEN 'AMOUNT_MISMATCH' THEN 'AMOUNT' WHEN 'UNMATCHED' THEN 'MISSING_IN_RADA'
                WHEN 'NEW' THEN 'MISSING_IN_CASH' END AS mismatch_reason
    FROM {p}_lab"""),
    ]


# the whole extracts: silver and keyed ledgers
WHOLE_CTES: list[tuple[str, str]] = [
    ("cash_w", CASH_WHOLE), ("rada_w", RADA_WHOLE),
    ("cash_norm_w", _normalise("cash_w", "cash_id")), ("rada_norm_w", _normalise("rada_w", "rada_id")),
    ("cash_flag_w", _flagged("cash_norm_w", "cash_id")), ("rada_flag_w", _flagged("rada_norm_w", "rada_id")),
    ("cash_silver_w", _dedup("cash_flag_w", "cash_id")), ("rada_silver_w", _dedup("rada_flag_w", "rada_id")),
    ("cash_keyed_w", _keyed("cash_silver_w", "cash_id")), ("rada_keyed_w", _keyed("rada_silver_w", "rada_id")),
]
# silver and keyed ledgers from the clean extracts
BASE_CTES: list[tuple[str, str]] = [
    ("cash_bronze", CASH_BRONZE),
    ("rada_bronze", RADA_BRONZE),
    ("rada_bronze_e", RADA_BRONZE_EARLIER),
    ("cash_norm", _normalise("cash_bronze", "cash_id")),
    ("rada_norm", _normalise("rada_bronze", "rada_id")),
    ("rada_norm_e", _normalise("rada_bronze_e", "rada_id")),
    ("cash_flag", _flagged("cash_norm", "cash_id")),
    ("rada_flag", _flagged("rada_norm", "rada_id")),
    ("rada_flag_e", _flagged("rada_norm_e", "rada_id")),
    ("cash_silver", _dedup("cash_flag", "cash_id")),
    ("rada_silver", _dedup("rada_flag", "rada_id")),
    ("rada_silver_e", _dedup("rada_flag_e", "rada_id")),
    ("cash_keyed", _keyed("cash_silver", "cash_id")),
    ("rada_keyed", _keyed("rada_silver", "rada_id")),
    ("rada_keyed_e", _keyed("rada_silver_e", "rada_id")),
    *_classified("cash_keyed", "rada_keyed"),
    *_classified("cash_keyed", "rada_keyed_e"),
]
CUR = "cash_keyed_rada_keyed_cls"
PREV = "cash_keyed_rada_keyed_e_cls"

GOLD_COLS = ("business_key, cash_id, rada_id, account_number, trade_reference, settlement_date, currency, "
             "amount, rada_amount, amount_variance, swift_bic, debit_credit, recon_status, mismatch_reason")

GOLD_CTES: list[tuple[str, str]] = BASE_CTES + [
    ("prev_gold", f"""
    SELECT {GOLD_COLS}, TIMESTAMP '{PREV_RUN_TS}' AS _run_ts, DATE '{PREV_RUN_DATE}' AS _run_date FROM {PREV}"""),
    ("prev_open", f"""
    SELECT DISTINCT business_key FROM prev_gold
    WHERE recon_status = 'UNMATCHED' AND _run_date = (SELECT max(_run_date) FROM prev_gold
      WHERE _run_date < DATE '{RUN_DATE}' - {LOOKBACK})"""),
    ("cleared", f"""
    SELECT business_key, 'CLEARED' AS recon_status FROM prev_open
    WHERE business_key NOT IN (SELECT business_key FROM {CUR} WHERE recon_status = 'UNMATCHED')"""),
    ("cur_gold", f"""
    SELECT {GOLD_COLS}, TIMESTAMP '{RUN_TS}' AS _run_ts, DATE '{RUN_DATE}' AS _run_date FROM {CUR}
    UNION ALL
    SELECT business_key, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, recon_status, NULL,
           TIMESTAMP '{RUN_TS}', DATE '{RUN_DATE}' FROM cleared"""),
    ("gold", "SELECT * FROM prev_gold UNION ALL SELECT * FROM cur_gold"),
    ("gold_day", f"SELECT * FROM gold WHERE _run_date = DATE '{RUN_DATE}'"),
]

DIRTY_CTES: list[tuple[str, str]] = [
    ("dirty_base", DIRTY_BASE),
    ("dirty_faults", DIRTY_FAULTS),
    ("dirty", DIRTY),
    ("dirty_norm", _normalise("dirty", "cash_id")),
    ("dirty_flag", _flagged("dirty_norm", "cash_id")),
    ("dirty_clean", _dedup("dirty_flag", "cash_id")),
]


def _lineitem_ledger(id_col: str, prefix: str, account: str, trade: str, group: str, amount: str,
                     where: str) -> str:
    settle = f"CAST(DATE '2026-01-01' + CAST({group} % 28 AS INTEGER) AS VARCHAR)"
    return f"""
    SELECT concat_ws('-', '{prefix}', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS {id_col},
           {account} AS account_number, {trade} AS trade_reference, CAST(NULL AS VARCHAR) AS swift_bic,
           {settle} AS transaction_date, {settle} AS value_date, {settle} AS settlement_date,
           {_CURRENCY.format(k=group)} AS currency, {amount} AS amount, {_DC.format(k=group)} AS debit_credit,
           CAST(NULL AS VARCHAR) AS narrative, 'X' AS status
    FROM lineitem WHERE {where}"""


def _repeated_ctes(skewed: bool) -> list[tuple[str, str]]:
    if skewed:
        account, trade, group = "'ACC' || l_returnflag", "'TRD0000000'", "0"
    else:
        account = "'ACC' || lpad(CAST(l_orderkey AS VARCHAR), CAST(greatest(8, length(CAST(l_orderkey AS VARCHAR))) AS INTEGER), '0')"
        trade = "'TRD' || lpad(CAST(l_linenumber AS VARCHAR), CAST(greatest(7, length(CAST(l_linenumber AS VARCHAR))) AS INTEGER), '0')"
        group = "l_orderkey"
    rada_amt = ("CASE WHEN l_partkey % 7 = 1 THEN l_extendedprice + CAST(5.0 AS DOUBLE) "
                "ELSE l_extendedprice END")
    cash = _lineitem_ledger("cash_id", "CSH", account, trade, group, "l_extendedprice", "TRUE")
    rada = _lineitem_ledger("rada_id", "RADA", account, trade, group, rada_amt, "l_partkey % 11 <> 3")
    return [("li_cash", cash), ("li_rada", rada),
            ("li_cash_k", f"SELECT {_KEY} AS business_key, * FROM li_cash"),
            ("li_rada_k", f"SELECT {_KEY} AS business_key, * FROM li_rada"),
            *_classified("li_cash_k", "li_rada_k")]


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS MATERIALIZED ({sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{final}"


_KEY_PARTS = ("account_number", "trade_reference", "settlement_date", "currency", "debit_credit")


def _four_of_five(src: str, id_col: str) -> str:
    """Each record under each key field that may differ."""
    return "\nUNION ALL".join(f"""
    SELECT '{f}:' || sha256(concat_ws('|', {', '.join(f"coalesce(CAST({g} AS VARCHAR), 'NULL')" for g in _KEY_PARTS if g != f)}))
           AS business_key, {id_col}, amount, CAST({f} AS VARCHAR) AS value FROM {src}""" for f in _KEY_PARTS)


def _mutual_best(rounds: int) -> list[tuple[str, str]]:
    """Candidates that are the best of both their records, round by round."""
    out, order = [], "ORDER BY gap, place, cash_id, rada_id"
    for i in range(rounds):
        out += [(f"fb_t{i}", f"""
    SELECT * EXCLUDE (c, r) FROM (SELECT *, row_number() OVER (PARTITION BY cash_id {order}) AS c,
      row_number() OVER (PARTITION BY rada_id {order}) AS r FROM fb_e{i}) WHERE c = 1 AND r = 1"""),
                (f"fb_e{i + 1}", f"""
    SELECT * FROM fb_e{i} WHERE cash_id NOT IN (SELECT cash_id FROM fb_t{i}) AND rada_id NOT IN (SELECT rada_id FROM fb_t{i})""")]
    return out


_FAULT_FIELDS = ", o_orderkey % 29 AS fault, 'ACC' || lpad(CAST(o_custkey + 1 AS VARCHAR), CAST(greatest(8, length(CAST(o_custkey + 1 AS VARCHAR))) AS INTEGER), '0') AS next_account"
FIELD_BREAK_CTES: list[tuple[str, str]] = [
    *[c for c in BASE_CTES if c[0] in ("cash_bronze", "cash_norm", "cash_flag", "cash_silver", "cash_keyed")],
    ("rada_f", _orders_ledger("rada_id", "RADA", _RADA_AMOUNT, "CONFIRMED", "o_orderkey % 19 <> 5", extra=_FAULT_FIELDS)),
    ("rada_bronze_f", """
    SELECT * EXCLUDE (fault, next_account) REPLACE (
      CASE WHEN fault IN (1, 6) THEN next_account ELSE account_number END AS account_number,
      CASE WHEN fault = 2 THEN trade_reference || '-1' ELSE trade_reference END AS trade_reference,
      CASE WHEN fault = 3 THEN CAST(CAST(settlement_date AS DATE) + 1 AS VARCHAR) ELSE settlement_date END AS settlement_date,
      CASE WHEN fault IN (4, 6) THEN 'JPY' ELSE currency END AS currency,
      CASE WHEN fault = 5 THEN CASE debit_credit WHEN 'D' THEN 'C' ELSE 'D' END ELSE debit_credit END AS debit_credit)
    FROM rada_f"""),
    ("rada_norm_f", _normalise("rada_bronze_f", "rada_id")), ("rada_flag_f", _flagged("rada_norm_f", "rada_id")),
    ("rada_silver_f", _dedup("rada_flag_f", "rada_id")), ("rada_keyed_f", _keyed("rada_silver_f", "rada_id")),
    *_classified("cash_keyed", "rada_keyed_f"),
    ("open_cash", "SELECT * FROM cash_silver WHERE cash_id IN (SELECT cash_id FROM cash_keyed_rada_keyed_f_cls WHERE recon_status = 'UNMATCHED')"),
    ("open_rada", "SELECT * FROM rada_silver_f WHERE rada_id IN (SELECT rada_id FROM cash_keyed_rada_keyed_f_cls WHERE recon_status = 'NEW')"),
    ("fb_cash", _four_of_five("open_cash", "cash_id")), ("fb_rada", _four_of_five("open_rada", "rada_id")),
    *_classified("fb_cash", "fb_rada")[:-2],  # the pairs alone
    ("fb_e0", f"""
    SELECT q.cash_id, q.rada_id, split_part(q.business_key, ':', 1) AS field, c.value AS cash_value, r.value AS rada_value,
           q.ca AS amount, q.ra AS rada_amount, abs(CAST(ca AS DECIMAL(38,6)) - CAST(ra AS DECIMAL(38,6))) AS gap,
           list_position([{', '.join(f"'{f}'" for f in _KEY_PARTS)}], split_part(q.business_key, ':', 1)) AS place
    FROM fb_cash_fb_rada_pairs q JOIN fb_cash c ON c.business_key = q.business_key AND c.cash_id = q.cash_id
                                 JOIN fb_rada r ON r.business_key = q.business_key AND r.rada_id = q.rada_id
    WHERE abs(CAST(ca AS DECIMAL(38,6)) - CAST(ra AS DECIMAL(38,6))) <= {TOL} AND c.value IS DISTINCT FROM r.value"""),
    *_mutual_best(6),
]
_BREAK = "cash_id, rada_id, field, cash_value, rada_value, amount, rada_amount"
FIELD_BREAKS = _with(FIELD_BREAK_CTES, "\nUNION ALL ".join(f"SELECT {_BREAK} FROM fb_t{i}" for i in range(6)) + """
UNION ALL SELECT cash_id, rada_id, 'amount', CAST(CAST(amount AS DECIMAL(38,6)) AS VARCHAR),
  CAST(CAST(rada_amount AS DECIMAL(38,6)) AS VARCHAR), amount, rada_amount
FROM cash_keyed_rada_keyed_f_cls WHERE recon_status = 'AMOUNT_MISMATCH'""")

# gaps and islands over the runs; the third run sees the second's ledgers
OPEN_ITEM_AGEING = _with(BASE_CTES + [
    ("opened", "\nUNION ALL".join(f"""
    SELECT business_key, DATE '{day}' AS run_date, {number} AS run FROM {src}
    WHERE recon_status IN ('UNMATCHED', 'NEW', 'AMOUNT_MISMATCH')"""
        for number, (day, src) in enumerate(((PREV_RUN_DATE, PREV), (RUN_DATE, CUR), (THIRD_RUN_DATE, CUR)), 1))),
    ("open_runs", "SELECT business_key, run_date, run, count(*) AS open_records FROM opened GROUP BY ALL"),
    ("islands", "SELECT *, run - row_number() OVER (PARTITION BY business_key ORDER BY run) AS island FROM open_runs"),
    ("spans", """
    SELECT business_key, min(run_date) AS first_open, count(*) AS runs_open, max(run) AS last_run,
           arg_max(open_records, run) AS open_records FROM islands GROUP BY business_key, island"""),
], f"""SELECT business_key, open_records, first_open, runs_open, CAST(DATE '{THIRD_RUN_DATE}' - first_open AS INTEGER) AS days_open,
       CASE WHEN DATE '{THIRD_RUN_DATE}' - first_open >= 30 THEN '30 days and more'
            WHEN DATE '{THIRD_RUN_DATE}' - first_open >= 14 THEN '14 to 29 days'
            WHEN DATE '{THIRD_RUN_DATE}' - first_open >= 7 THEN '7 to 13 days' ELSE 'under 7 days' END AS age_class
FROM spans WHERE last_run = 3""")

LEDGER_OUT = "cash_id, " + LEDGER_COLS

_KPI_SELECT = """
    count(*) AS total_records,
    count(*) FILTER (WHERE recon_status = 'MATCHED') AS matched,
    count(*) FILTER (WHERE recon_status = 'UNMATCHED') AS unmatched,
    count(*) FILTER (WHERE recon_status = 'NEW') AS new,
    count(*) FILTER (WHERE recon_status = 'CLEARED') AS cleared,
    count(*) FILTER (WHERE recon_status = 'AMOUNT_MISMATCH') AS amount_mismatch,
    round(coalesce(CAST(sum(CAST(amount AS DECIMAL(38,6))) FILTER (WHERE recon_status = 'UNMATCHED') AS DOUBLE),
                   0.0), 2) AS unmatched_exposure,
    CAST(sum(CAST(abs(amount_variance) AS DECIMAL(38,6)))
         FILTER (WHERE recon_status IN ('MATCHED', 'AMOUNT_MISMATCH')) AS DOUBLE) AS var_sum,
    count(CAST(abs(amount_variance) AS DECIMAL(38,6)))
         FILTER (WHERE recon_status IN ('MATCHED', 'AMOUNT_MISMATCH')) AS var_n"""


def _kpi_finish(src: str, run_date: str) -> str:
    return f"""SELECT {run_date} AS run_date, total_records, matched, unmatched, new, cleared, amount_mismatch,
       CASE WHEN total_records > 0
            THEN round(CAST(matched AS DOUBLE) / CAST(total_records AS DOUBLE) * CAST(100 AS DOUBLE), 2)
            ELSE 0.0 END AS match_rate_pct,
       unmatched_exposure,
       CASE WHEN var_n > 0 THEN round(var_sum / CAST(var_n AS DOUBLE), 4) ELSE 0.0 END AS avg_amount_variance
FROM {src}"""


KPI_DAILY = _with(GOLD_CTES + [("k", f"SELECT {_KPI_SELECT} FROM gold_day")], _kpi_finish("k", f"DATE '{RUN_DATE}'"))
KPI_TREND_CTES = GOLD_CTES + [("k", f"SELECT _run_date, {_KPI_SELECT} FROM gold GROUP BY _run_date")]
KPI_TREND = _with(KPI_TREND_CTES, _kpi_finish("k", "_run_date") + " ORDER BY run_date")

EXCEPTIONS = ("SELECT business_key, cash_id, rada_id, currency, amount, rada_amount, amount_variance, "
              "recon_status, mismatch_reason FROM gold_day WHERE recon_status IN ('UNMATCHED', 'NEW', 'AMOUNT_MISMATCH')")

_STATUS_COUNTS = """
    SELECT s.recon_status, count(g.recon_status) AS records
    FROM (VALUES ('MATCHED'), ('UNMATCHED'), ('NEW'), ('CLEARED'), ('AMOUNT_MISMATCH')) AS s(recon_status)
    LEFT JOIN gold_day g ON g.recon_status = s.recon_status
    GROUP BY s.recon_status"""


def _dq_rows(src: str, table: str, id_col: str, which: tuple[str, ...]) -> str:
    """DQ check rows for one table from its metrics CTE ``{src}``."""
    parts = {
        "completeness": f"""
    SELECT 'completeness' AS check_name, '{table}' AS "table",
           CASE WHEN (CASE WHEN total > 0 THEN round(CAST(complete AS DOUBLE) / CAST(total AS DOUBLE), 4) ELSE 0.0 END) >= 0.98
                THEN 'PASS' ELSE 'FAIL' END AS status,
           CASE WHEN total > 0 THEN round(CAST(complete AS DOUBLE) / CAST(total AS DOUBLE), 4) ELSE 0.0 END AS metric_value,
           CAST(0.98 AS DOUBLE) AS threshold,
           format('{{:,}}/{{:,}} rows complete', CAST(complete AS BIGINT), CAST(total AS BIGINT)) AS detail
    FROM {src}""",
        "duplicate_rate": f"""
    SELECT 'duplicate_rate' AS check_name, '{table}' AS "table",
           CASE WHEN (CASE WHEN total > 0 THEN round(CAST(total - uniq AS DOUBLE) / CAST(total AS DOUBLE), 4) ELSE 0.0 END) <= 0.005
                THEN 'PASS' ELSE 'FAIL' END AS status,
           CASE WHEN total > 0 THEN round(CAST(total - uniq AS DOUBLE) / CAST(total AS DOUBLE), 4) ELSE 0.0 END AS metric_value,
           CAST(0.005 AS DOUBLE) AS threshold,
           format('{id_col} repeated in {{:,}} of {{:,}} rows', CAST(total - uniq AS BIGINT), CAST(total AS BIGINT)) AS detail
    FROM {src}""",
        "negative_amounts": f"""
    SELECT 'negative_amounts' AS check_name, '{table}' AS "table",
           CASE WHEN negative = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
           CASE WHEN total > 0 THEN round(CAST(negative AS DOUBLE) / CAST(total AS DOUBLE), 4) ELSE 0.0 END AS metric_value,
           CAST(0.0 AS DOUBLE) AS threshold,
           format('{{:,}} amounts below zero', CAST(negative AS BIGINT)) AS detail
    FROM {src}""",
    }
    return "\nUNION ALL".join(parts[w] for w in which)


def _dq_metrics(src: str, id_col: str) -> str:
    return f"""
    SELECT count(*) AS total,
           count(*) FILTER (WHERE {id_col} IS NOT NULL AND account_number IS NOT NULL
                AND trade_reference IS NOT NULL AND settlement_date IS NOT NULL AND currency IS NOT NULL
                AND amount IS NOT NULL AND NOT isnan(amount)) AS complete,
           count(DISTINCT {id_col}) + max(CASE WHEN {id_col} IS NULL THEN 1 ELSE 0 END) AS uniq,
           count(*) FILTER (WHERE amount < 0) AS negative
    FROM {src}"""


BRONZE_CASH = "bronze.cash_transactions"


def _schema_ok(table: str, metrics: str) -> str:
    return f"""SELECT 'schema_enforcement' AS check_name, '{table}' AS "table", 'PASS' AS status,
        CAST(0.0 AS DOUBLE) AS metric_value, CAST(0.0 AS DOUBLE) AS threshold,
        format('rows read: {{:,}}', CAST(total AS BIGINT)) AS detail FROM {metrics}"""


_UNMATCHED_COLS = ("business_key, cash_id, account_number, trade_reference, settlement_date, currency, amount, "
                   "swift_bic, debit_credit, recon_status")
_MATCHED_COLS = ("business_key, cash_id, rada_id, account_number, trade_reference, settlement_date, currency, "
                 "amount, rada_amount, amount_variance, swift_bic, debit_credit, recon_status")
_MISMATCH_COLS = _MATCHED_COLS.replace(" swift_bic,", "")
GOLD_OUT = GOLD_COLS + ", _run_date"


def _typed_dirty_ctes() -> list[tuple[str, str]]:
    return DIRTY_CTES + [("m", _dq_metrics("dirty_norm", "cash_id"))]


def _dq_all(metrics: str, table: str, id_col: str) -> str:
    checks = _dq_rows(metrics, table, id_col, ("completeness", "duplicate_rate", "negative_amounts"))
    return f"{checks}\nUNION ALL {_schema_ok(table, metrics)}"


_LANDING_DAY = "CASE WHEN CAST(right(cash_id, 1) AS INTEGER) % 2 = 1 THEN 'day2' ELSE 'day1' END"


def _sum_money(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(38,6))) AS DOUBLE)"


ORACLE: dict[str, str] = {
    "silver_clean": _with(DIRTY_CTES, f"SELECT {LEDGER_OUT} FROM dirty_clean"),
    # by days or at once, the survivors are the same
    "silver_incremental": _with(DIRTY_CTES, f"SELECT {LEDGER_OUT} FROM dirty_clean"),
    "recon_incremental": _with(BASE_CTES, f"SELECT * FROM {CUR}"),
    "silver_quarantine": _with(DIRTY_CTES, f"""SELECT {LEDGER_OUT},
        'mandatory_field_or_value_check_failed' AS _rejection_reason FROM dirty_flag WHERE NOT ok"""),
    "silver_dedup": _with(DIRTY_CTES, f"""SELECT {LEDGER_OUT} FROM dirty_clean WHERE cash_id IN (
        SELECT cash_id FROM dirty_flag WHERE ok GROUP BY cash_id HAVING count(*) > 1)"""),
    "silver_counts": _with(DIRTY_CTES, """SELECT count(*) AS input_rows,
        count(*) FILTER (WHERE ok) AS accepted_rows, count(*) FILTER (WHERE NOT ok) AS quarantine_rows,
        count(DISTINCT CASE WHEN ok THEN cash_id END) AS clean_rows FROM dirty_flag"""),
    "keyed_cash": _with(WHOLE_CTES, "SELECT * FROM cash_keyed_w"),
    "keyed_rada": _with(WHOLE_CTES, "SELECT * FROM rada_keyed_w"),
    "recon_classified": _with(BASE_CTES, f"SELECT * FROM {CUR}"),
    "recon_matched": _with(BASE_CTES, f"SELECT {_MATCHED_COLS} FROM {CUR} WHERE recon_status = 'MATCHED'"),
    "recon_unmatched": _with(BASE_CTES, f"SELECT {_UNMATCHED_COLS} FROM {CUR} WHERE recon_status = 'UNMATCHED'"),
    "recon_new": _with(BASE_CTES, f"SELECT business_key, rada_id, amount, recon_status FROM {CUR} "
                                  "WHERE recon_status = 'NEW'"),
    "recon_amount_mismatch": _with(BASE_CTES, f"SELECT {_MISMATCH_COLS} FROM {CUR} "
                                              "WHERE recon_status = 'AMOUNT_MISMATCH'"),
    "recon_repeated_keys": _with(_repeated_ctes(False), "SELECT * FROM li_cash_k_li_rada_k_cls"),
    "recon_skewed_keys": _with(_repeated_ctes(True), "SELECT * FROM li_cash_k_li_rada_k_cls"),
    "recon_field_breaks": FIELD_BREAKS,
    "open_item_ageing": OPEN_ITEM_AGEING,
    "recon_cleared": _with(GOLD_CTES, "SELECT * FROM cleared"),
    "recon_still_unmatched": _with(GOLD_CTES, f"""SELECT {_UNMATCHED_COLS} FROM {CUR}
        WHERE recon_status = 'UNMATCHED' AND business_key NOT IN (SELECT business_key FROM cleared)"""),
    "gold_union": _with(GOLD_CTES, f"SELECT {GOLD_OUT} FROM cur_gold"),
    "gold_upsert": _with(GOLD_CTES + [
        ("attempt", f"SELECT {GOLD_COLS}, TIMESTAMP '{RUN_TS}' AS _run_ts, DATE '{RUN_DATE}' AS _run_date "
                    f"FROM {PREV}"),
        ("target", "SELECT * FROM prev_gold UNION ALL SELECT * FROM attempt")],
        f"""SELECT {GOLD_OUT} FROM target t WHERE NOT EXISTS (
              SELECT 1 FROM cur_gold s WHERE s.business_key = t.business_key AND s._run_date = t._run_date)
            UNION ALL SELECT {GOLD_OUT} FROM cur_gold"""),
    "status_counts": _with(GOLD_CTES, _STATUS_COUNTS),
    "kpi_daily": KPI_DAILY,
    "kpi_currency_breakdown": _with(GOLD_CTES, f"""SELECT currency, recon_status, count(*) AS count,
        round({_sum_money('amount')}, 2) AS total_amount, DATE '{RUN_DATE}' AS _run_date
        FROM gold_day GROUP BY currency, recon_status"""),
    "kpi_trend": KPI_TREND,
    "run_summary": _with(GOLD_CTES + [
        ("sc", "SELECT * FROM cash_flag"), ("sr", "SELECT * FROM rada_flag"),
        ("st", _STATUS_COUNTS)], """
        SELECT 'cash_input_rows' AS step, count(*) AS rows FROM sc
        UNION ALL SELECT 'cash_accepted_rows', count(*) FILTER (WHERE ok) FROM sc
        UNION ALL SELECT 'cash_quarantine_rows', count(*) FILTER (WHERE NOT ok) FROM sc
        UNION ALL SELECT 'cash_clean_rows', count(DISTINCT CASE WHEN ok THEN cash_id END) FROM sc
        UNION ALL SELECT 'rada_input_rows', count(*) FROM sr
        UNION ALL SELECT 'rada_accepted_rows', count(*) FILTER (WHERE ok) FROM sr
        UNION ALL SELECT 'rada_quarantine_rows', count(*) FILTER (WHERE NOT ok) FROM sr
        UNION ALL SELECT 'rada_clean_rows', count(DISTINCT CASE WHEN ok THEN rada_id END) FROM sr
        UNION ALL SELECT lower(recon_status), records FROM st"""),
    "report_exposure_by_currency": _with(GOLD_CTES, f"""SELECT currency,
        round({_sum_money('amount')}, 2) AS exposure, count(*) AS records
        FROM gold_day WHERE recon_status = 'UNMATCHED' GROUP BY currency ORDER BY exposure DESC, currency"""),
    "report_top_mismatch": _with(GOLD_CTES, """SELECT cash_id, rada_id, account_number, trade_reference,
        settlement_date, currency, amount, rada_amount, amount_variance FROM gold_day
        WHERE recon_status = 'AMOUNT_MISMATCH'
        ORDER BY abs(amount_variance) DESC, business_key, cash_id, rada_id LIMIT 50"""),
    "dq_completeness": _with(_typed_dirty_ctes(), _dq_rows("m", BRONZE_CASH, "cash_id", ("completeness",))),
    "dq_duplicate_rate": _with(_typed_dirty_ctes(), _dq_rows("m", BRONZE_CASH, "cash_id", ("duplicate_rate",))),
    "dq_negative_amounts": _with(_typed_dirty_ctes(),
                                 _dq_rows("m", BRONZE_CASH, "cash_id", ("negative_amounts",))),
    "dq_schema": _with(DIRTY_CTES, f"""SELECT 'schema_enforcement' AS check_name, '{BRONZE_CASH}' AS "table",
        'FAIL' AS status, CAST(2.0 AS DOUBLE) AS metric_value, CAST(0.0 AS DOUBLE) AS threshold,
        format('rows read: {{:,}}; settlement_date is not date, does not convert: {{:,}}; amount is not double, '
               || 'does not convert: {{:,}}', count(*),
               count(*) FILTER (WHERE settlement_date IS NOT NULL AND TRY_CAST(settlement_date AS DATE) IS NULL),
               count(*) FILTER (WHERE amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL)) AS detail
        FROM dirty"""),
    "dq_suite": _with(_typed_dirty_ctes() + WHOLE_CTES + [("mr", _dq_metrics("rada_silver_w", "rada_id"))],
                      _dq_all("m", BRONZE_CASH, "cash_id") + "\nUNION ALL " + _dq_all(
                          "mr", "silver.rada_transactions", "rada_id")),
    "dq_stored": _with(WHOLE_CTES + [("mc", _dq_metrics("cash_silver_w", "cash_id")),
                                     ("mr", _dq_metrics("rada_silver_w", "rada_id"))], f"""
        SELECT *, TIMESTAMP '{RUN_TS}' AS run_ts, DATE '{RUN_DATE}' AS _run_date FROM (
        {_dq_all("mc", "cash", "cash_id")} UNION ALL {_dq_all("mr", "rada", "rada_id")})"""),
    "kpi_breakdown_stored": _with(GOLD_CTES, f"""SELECT currency, recon_status, count(*) AS count,
        round({_sum_money('amount')}, 2) AS total_amount, DATE '{RUN_DATE}' AS _run_date
        FROM gold_day GROUP BY currency, recon_status"""),
    "recon_cleared_three_runs": _with(GOLD_CTES, f"SELECT DATE '{RUN_DATE}' AS _run_date, business_key FROM cleared"),
    "validate_schema_rada": _with([("rada_w", RADA_WHOLE)], """SELECT 'bronze.rada_transactions' AS "table",
        count(*) AS row_count, '' AS missing_mandatory_columns, TRUE AS schema_valid FROM rada_w"""),
    "silver_by_name": _with(WHOLE_CTES, f"SELECT {LEDGER_OUT} FROM cash_silver_w"),
    "silver_stamped": _with(WHOLE_CTES, f"SELECT cash_id, TIMESTAMP '{RUN_TS}' AS _standardised_ts FROM cash_silver_w"),
    "quarantine_stored": _with(DIRTY_CTES, f"""SELECT 'twice' AS runs, {LEDGER_OUT},
        'mandatory_field_or_value_check_failed' AS _rejection_reason, DATE '{RUN_DATE}' AS _batch_date
        FROM dirty_flag WHERE NOT ok"""),
    "run_audit": _with(DIRTY_CTES, f"""SELECT DATE '{RUN_DATE}' AS run_date, run_ts, count(*) AS input_rows,
        count(*) FILTER (WHERE ok) AS accepted_rows, count(*) FILTER (WHERE NOT ok) AS quarantine_rows,
        count(DISTINCT CASE WHEN ok THEN cash_id END) AS clean_rows
        FROM dirty_flag, (VALUES (TIMESTAMP '{RUN_TS}'), (TIMESTAMP '{LATER_RUN_TS}')) AS t(run_ts) GROUP BY run_ts"""),
    "ingest_lineage": _with([("cash_w", CASH_WHOLE)], f"""SELECT cash_id, {_LANDING_DAY} AS batch, TRUE AS same_day
        FROM cash_w"""),
    "ingest_counts": _with([("cash_w", CASH_WHOLE)], f"""SELECT {_LANDING_DAY} AS batch, count(*) AS rows
        FROM cash_w GROUP BY 1"""),
    "measure_matched_rate": _with(KPI_TREND_CTES, """SELECT CASE WHEN sum(matched) + sum(unmatched) > 0
        THEN CAST(sum(matched) AS DOUBLE) / CAST(sum(matched) + sum(unmatched) AS DOUBLE) ELSE 0.0 END
        AS matched_rate FROM k"""),
    "measure_exception_flag": _with(GOLD_CTES, f"""SELECT *,
        CASE WHEN coalesce(trim(mismatch_reason), '') <> '' THEN 1 ELSE 0 END AS exception_flag
        FROM ({EXCEPTIONS})"""),
    "measure_total_variance": _with(WHOLE_CTES, f"""SELECT
        (SELECT {_sum_money('amount')} FROM cash_silver_w) AS total_cash,
        (SELECT {_sum_money('amount')} FROM rada_silver_w) AS total_rada,
        CAST((SELECT sum(CAST(amount AS DECIMAL(38,6))) FROM cash_silver_w)
             - (SELECT sum(CAST(amount AS DECIMAL(38,6))) FROM rada_silver_w) AS DOUBLE) AS total_variance"""),
    "validate_schema": _with([("cash_w", CASH_WHOLE)], f"""SELECT '{BRONZE_CASH}' AS "table",
        count(*) AS row_count, '' AS missing_mandatory_columns, TRUE AS schema_valid FROM cash_w"""),
    "ingest_stream": _with([("cash_w", CASH_WHOLE)], f"SELECT {LEDGER_OUT} FROM cash_w"),
    "ingest_evolving": _with([("evolving", EVOLVING)], f"""SELECT {LEDGER_OUT.replace("amount", "CASE WHEN bad THEN NULL ELSE amount END AS amount")},
        CASE WHEN day > 0 THEN channel END AS channel, 'day' || CAST(day + 1 AS VARCHAR) AS day FROM evolving"""),
    "quarantine_rescued": _with([("evolving", EVOLVING)], f"""SELECT cash_id, CAST(NULL AS DOUBLE) AS amount,
        'mandatory_field_or_value_check_failed' AS _rejection_reason,
        concat_ws(',', {EVOLVING_LINE}) AS rescued_line FROM evolving WHERE bad AND day = 0
        UNION ALL SELECT cash_id, NULL, 'mandatory_field_or_value_check_failed', concat_ws(',', {EVOLVING_LINE}, channel)
        FROM evolving WHERE bad AND day = 1
        UNION ALL SELECT cash_id, NULL, 'mandatory_field_or_value_check_failed', concat_ws(',', channel, {EVOLVING_REVERSED})
        FROM evolving WHERE bad AND day = 2"""),
    # the extract carries whole cents, so the expected amount is cents / 100
    "ingest_rada_fixed_width": _with(WHOLE_CTES, "SELECT rada_id, " + LEDGER_COLS.replace(
        "amount,", "CAST(CAST(round(amount * CAST(100 AS DOUBLE)) AS BIGINT) AS DOUBLE) / CAST(100 AS DOUBLE) "
                   "AS amount,") + " FROM rada_silver_w"),
    "gold_clustered": _with(GOLD_CTES, f"SELECT {GOLD_OUT} FROM cur_gold"),
    "gold_z_ordered": _with(GOLD_CTES, f"SELECT {GOLD_OUT} FROM cur_gold"),
    "export_kpi": KPI_DAILY,
    "daily_run_kpis": KPI_TREND,
    "export_exceptions": _with(GOLD_CTES, EXCEPTIONS),
}
