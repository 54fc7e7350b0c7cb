"""Independent SQL for the queries, on the driver's tables.

Written from the definitions, with plain window functions and joins; nothing here
shares an expression with the Spark side.
"""

from __future__ import annotations

# The fact view over events; {label} joins the labels.
_FACTS = """
facts AS (
  SELECT e.event_id AS transaction_id, e.ts, e.value AS amount, e.event_type AS use_chip,
         e.k AS merchant_id, p.n_name AS merchant_city,
         CASE WHEN p.n_regionkey = 0 THEN NULL
              WHEN p.n_regionkey IN (1, 2) THEN 'N' || CAST(p.n_nationkey % 10 AS VARCHAR)
              ELSE p.n_name END AS merchant_state,
         CAST(e.k * 100 AS DOUBLE) AS zip, e.k % 30 + 5000 AS mcc,
         CASE WHEN e.user_id % 7 = 0 THEN 'Bad PIN' END AS errors,
         'Trade ' || m.n_name AS mcc_desc, e.user_id AS client_id, e.user_id AS card_id,
         CAST(c.c_custkey % 70 + 18 AS INTEGER) AS current_age,
         CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' WHEN c.c_custkey % 2 = 1 THEN 'Female' END AS gender,
         CAST(c.c_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(c.c_nationkey * -2.5 AS DOUBLE) AS longitude,
         c.c_acctbal AS per_capita_income, CAST(c.c_custkey * 10 AS DOUBLE) AS yearly_income,
         CAST(c.c_custkey % 5000 AS DOUBLE) AS total_debt,
         CAST(c.c_custkey % 551 + 300 AS INTEGER) AS credit_score,
         CAST(c.c_custkey % 5 + 1 AS INTEGER) AS num_credit_cards,
         c.c_mktsegment AS card_brand, r.r_name AS card_type,
         CASE WHEN c.c_custkey IS NULL THEN NULL WHEN c.c_custkey % 3 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
         CAST(c.c_custkey % 3 + 1 AS INTEGER) AS num_cards_issued, c.c_acctbal AS credit_limit,
         CAST(o.opened AS DATE) AS acct_open_date,
         CAST(c.c_custkey % 20 + 2000 AS INTEGER) AS year_pin_last_changed,
         CASE WHEN c.c_custkey IS NULL THEN NULL WHEN c.c_custkey % 50 = 0 THEN 'Yes' ELSE 'No' END
           AS card_on_dark_web,
         {label}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  LEFT JOIN nation p ON e.k % 25 = p.n_nationkey
  LEFT JOIN nation m ON e.k % 30 = m.n_nationkey
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  LEFT JOIN region r ON cn.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS opened FROM orders GROUP BY 1) o
         ON o.o_custkey = c.c_custkey
  LEFT JOIN labels l ON e.event_id = l.doc_id
)"""

SPARSE = "WITH" + _FACTS.format(label="CAST(l.toxic AS INTEGER) AS is_fraud")
DENSE = "WITH" + _FACTS.format(
    label="CASE WHEN e.event_type = 'signup' THEN NULL WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS is_fraud"
)

_ORDER_FACTS = """
ord AS (
  SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS TIMESTAMP) AS ts, o_custkey AS card_id,
         o_totalprice AS amount, o_orderpriority AS use_chip,
         CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN 0 END AS is_fraud
  FROM orders
)"""
ORDERS = "WITH" + _ORDER_FACTS

ITEMS = """
WITH items AS (
  SELECT l_extendedprice AS amount, l_suppkey AS merchant_id, n_name AS merchant_city,
         p_type AS mcc_desc, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS is_fraud
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
)"""

_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"

_WINDOWED = f"""
windowed AS (
  SELECT *,
         count(*) OVER card AS cnt, avg(amount) OVER card AS pavg,
         CASE WHEN max(amount) OVER card = min(amount) OVER card THEN 0 ELSE stddev_pop(amount) OVER card END AS pstd,
         max(amount) OVER card AS pmax,
         lag(ts) OVER (PARTITION BY card_id ORDER BY ts, transaction_id) AS prev,
         count(*) OVER (PARTITION BY card_id, merchant_id ORDER BY ts, transaction_id {_BEFORE}) AS pair_cnt,
         count(*) OVER (PARTITION BY merchant_id ORDER BY ts, transaction_id {_BEFORE}) AS merchant_cnt
  FROM base WINDOW card AS (PARTITION BY card_id ORDER BY ts, transaction_id {_BEFORE})
)"""

_FEATURE_COLUMNS = """
  transaction_id, ts, is_fraud, round(amount, 8) AS amount,
  CAST(extract(hour FROM ts) AS BIGINT) AS txn_hour, CAST(extract(dow FROM ts) AS BIGINT) AS txn_dow,
  CAST(extract(month FROM ts) AS BIGINT) AS txn_month,
  CASE WHEN extract(dow FROM ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN extract(hour FROM ts) <= 5 THEN 1 ELSE 0 END AS is_night,
  use_chip, errors, merchant_state, mcc, mcc_desc, card_brand, card_type, has_chip, card_on_dark_web,
  current_age, gender, credit_score, num_credit_cards, round(per_capita_income, 8) AS per_capita_income,
  round(yearly_income, 8) AS yearly_income, round(total_debt, 8) AS total_debt,
  round(credit_limit, 8) AS credit_limit,
  round(CASE WHEN credit_limit <> 0 THEN amount / credit_limit END, 8) AS amount_to_limit,
  cnt AS card_prior_txn_count, pair_cnt AS card_merchant_prior_count, merchant_cnt AS merchant_prior_count,
  round(coalesce(pavg, 0), 8) AS card_prior_avg_amount, round(coalesce(pstd, 0), 8) AS card_prior_std_amount,
  round(coalesce(pmax, amount), 8) AS card_prior_max_amount,
  round((epoch_us(ts) - epoch_us(prev)) / 1e6, 8) AS sec_since_prev_txn,
  round(amount - pavg, 8) AS amount_dev_from_prior_avg,
  round(CASE WHEN pstd > 0 THEN (amount - pavg) / pstd END, 8) AS amount_z,
  CASE WHEN prev IS NULL THEN 1 ELSE 0 END AS is_first_txn,
  CAST(year(ts) - year(acct_open_date) AS BIGINT) AS card_age_years
"""


def _features(facts: str, base: str = "SELECT * FROM facts") -> str:
    return f"{facts}, base AS ({base}), {_WINDOWED} SELECT {_FEATURE_COLUMNS} FROM windowed"


_EXACT_SECONDS = "round((epoch_us(ts) - epoch_us(prev)) / 1e6, 8)"

FEATURES = _features(SPARSE)

_FACT_VIEW = f"{SPARSE} SELECT * REPLACE (round(amount, 6) AS amount) FROM facts"

_CARD_HISTORY = """
SELECT transaction_id, card_id, cnt AS card_prior_txn_count, {avg} AS card_prior_avg_amount,
       {std} AS card_prior_std_amount, {max} AS card_prior_max_amount, prev AS card_prev_ts{more}
FROM windowed"""

_ORDER_HISTORY = (
    f"{ORDERS}, base AS (SELECT *, 1 AS merchant_id FROM ord), {_WINDOWED}"
    + _CARD_HISTORY.format(avg="round(pavg, 6)", std="round(pstd, 6)", max="round(pmax, 6)", more="")
)


def _rate(facts: str, table: str, key: str, name: str, tail: str = "", where: str = "TRUE") -> str:
    return f"""{facts} SELECT {key} AS {name}, count(*) AS n, round(avg(is_fraud), 6) AS fraud_rate
        FROM {table} WHERE is_fraud IS NOT NULL AND {where} GROUP BY 1 {tail}"""


def _place(name: str, condition: str) -> str:
    return _rate(
        DENSE,
        "facts",
        "merchant_state",
        name,
        f"HAVING count(*) > 100 ORDER BY avg(is_fraud) DESC, n DESC, {name} LIMIT 15",
        condition,
    )


def _histogram(rows: str) -> str:
    """Rows (label, x); 60 equal bins over the range of each label."""
    return f"""{rows},
    spans AS (SELECT label, min(x) AS lo, max(x) AS hi, count(*) AS total FROM hist GROUP BY 1),
    binned AS (
      SELECT h.label, s.lo, s.hi, s.total,
             CASE WHEN s.hi = s.lo THEN 0
                  ELSE least(59, CAST(floor((h.x - s.lo) / ((s.hi - s.lo) / 60)) AS BIGINT)) END AS bin
      FROM hist h JOIN spans s ON h.label = s.label)
    SELECT CASE label WHEN 0 THEN 'legitimate' ELSE 'fraud' END AS class, CAST(bin AS BIGINT) AS bin,
           round(lo + bin * ((hi - lo) / 60), 6) AS bin_start, count(*) AS n,
           round(count(*) / (total * ((hi - lo) / 60)), 6) AS density
    FROM binned GROUP BY label, bin, lo, hi, total"""


_SCORES = {
    "": "o_totalprice / 500000",
    "_ties": "round(o_totalprice / 50000)",
}


def _scored(score: str) -> str:
    return f"""WITH scored AS (
      SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS ts, CAST(o_orderstatus = 'P' AS INTEGER) AS y,
             {score} AS score FROM orders),
    size AS (SELECT count(*) AS n, sum(y) AS p FROM scored),
    ranked AS (
      SELECT *, row_number() OVER (ORDER BY score DESC, id) AS flagged,
             sum(y) OVER (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS tp FROM scored, size),
    costed AS (SELECT *, (p - tp) * 200.0 + (flagged - tp) * 5.0 AS cost FROM ranked),
    best AS (SELECT * FROM costed ORDER BY cost, flagged LIMIT 1),
    grouped AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY 1),
    steps AS (
      SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             row_number() OVER (ORDER BY score DESC) AS place, count(*) OVER () AS places
      FROM grouped, size)"""


_AP = "(SELECT sum(CAST(pos AS DOUBLE) / p * (CAST(tp AS DOUBLE) / (tp + fp))) FROM steps)"
_AUC = """(SELECT sum(CAST(neg AS DOUBLE) * (tp - pos + pos / 2.0)) / CAST(max(p * (n - p)) AS DOUBLE)
           FROM steps)"""


def _recall(target: float) -> str:
    return f"""(
      WITH line AS (
        SELECT 0 AS place, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y
        UNION ALL SELECT place, CAST(fp AS DOUBLE) / (n - p), CAST(tp AS DOUBLE) / p FROM steps),
      here AS (SELECT * FROM line WHERE x <= {target} ORDER BY place DESC LIMIT 1),
      after AS (SELECT line.* FROM line, here WHERE line.place = here.place + 1)
      SELECT coalesce(h.y + ({target}::DOUBLE - h.x) * (a.y - h.y) / (a.x - h.x), h.y)
      FROM here h LEFT JOIN after a ON TRUE)"""


def _precision(fraction: float) -> str:
    return f"""(SELECT avg(y) FROM ranked
                WHERE flagged <= greatest(1, CAST(floor(n * CAST({fraction} AS DOUBLE)) AS BIGINT)))"""


_RECALLS = ", ".join(
    f"round({_recall(t)}, 8) AS recall_at_fpr_{name}"
    for t, name in ((0.001, "0_001"), (0.005, "0_005"), (0.01, "0_010"), (0.05, "0_050"))
)
_PRECISIONS = ", ".join(
    f"round({_precision(f)}, 8) AS precision_at_top_{name}pct" for f, name in ((0.001, "0_1"), (0.01, "1"))
)
_EVALUATION = f"""SELECT round({_AP}, 8) AS pr_auc, round({_AUC}, 8) AS roc_auc,
    round(best.score, 8) AS best_threshold, round(CAST(best.cost AS DOUBLE), 8) AS total_cost,
    round(CAST(best.cost AS DOUBLE) / best.n, 8) AS cost_per_txn, best.n AS n, CAST(best.p AS BIGINT) AS n_pos,
    {_RECALLS}, {_PRECISIONS} FROM best"""


def _thinned(table: str, total: str, columns: str) -> str:
    """300 evenly spaced rows of ``table`` by its 0-based ``i``."""
    return f"""picks AS (
      SELECT CASE WHEN g = least(300, m) - 1 THEN m - 1
                  ELSE CAST(floor(g * (CAST(m - 1 AS DOUBLE) / (least(300, m) - 1))) AS BIGINT) END AS i
      FROM (SELECT {total} AS m FROM {table}) t, generate_series(0, 299) s(g) WHERE g < least(300, m))
    SELECT {columns} FROM {table} WHERE i IN (SELECT i FROM picks)"""


_RANKING = {
    "average_precision": f"SELECT round({_AP}, 8) AS average_precision",
    "roc_auc": f"SELECT round({_AUC}, 8) AS roc_auc",
    "recall_at_fpr": f"SELECT {_RECALLS}",
    "precision_at_k": f"SELECT {_PRECISIONS}",
    "cost_threshold": """SELECT round(score, 8) AS threshold, round(CAST(cost AS DOUBLE), 8) AS total_cost,
        flagged, round(CAST(cost AS DOUBLE) / n, 8) AS cost_per_txn FROM best""",
    "evaluate_ranking": _EVALUATION,
    "pr_curve": """, points AS (
        SELECT places - place AS i, score AS threshold, CAST(tp AS DOUBLE) / p AS recall,
               CAST(tp AS DOUBLE) / (tp + fp) AS precision FROM steps
        UNION ALL SELECT max(places), NULL, 0.0, 1.0 FROM steps),
        """
    + _thinned(
        "points",
        "count(*)",
        "round(threshold, 8) AS threshold, round(recall, 8) AS recall, round(precision, 8) AS precision",
    ),
    "roc_curve": """, corners AS (
        SELECT *, row_number() OVER (ORDER BY place) AS i FROM (
          SELECT *, lead(pos) OVER (ORDER BY place) AS npos, lead(neg) OVER (ORDER BY place) AS nneg FROM steps)
        WHERE place = 1 OR place = places OR npos <> pos OR nneg <> neg),
        points AS (
          SELECT i, score AS threshold, CAST(fp AS DOUBLE) / (n - p) AS fpr, CAST(tp AS DOUBLE) / p AS tpr
          FROM corners UNION ALL SELECT 0, NULL, 0.0, 0.0),
        """
    + _thinned(
        "points", "count(*)", "round(threshold, 8) AS threshold, round(fpr, 8) AS fpr, round(tpr, 8) AS tpr"
    ),
    "cost_curve": """, points AS (SELECT *, flagged - 1 AS i FROM costed), """
    + _thinned(
        "points",
        "count(*)",
        """'curve' AS point, flagged, round(CAST(flagged AS DOUBLE) / n, 8) AS flagged_frac,
           round(score, 8) AS threshold, round(CAST(cost AS DOUBLE) / n, 8) AS cost_per_txn""",
    )
    + """ UNION ALL SELECT 'optimal', flagged, round(CAST(flagged AS DOUBLE) / n, 8), round(score, 8),
          round(CAST(cost AS DOUBLE) / n, 8) FROM best""",
    "decile_lift": """, parts AS (SELECT *, ntile(10) OVER (ORDER BY score DESC, id) AS decile FROM ranked),
        sums AS (SELECT decile, count(*) AS k, sum(y) AS f, max(p) AS p, max(n) AS n FROM parts GROUP BY 1)
        SELECT CAST(decile AS INTEGER) AS decile, k AS n, CAST(f AS BIGINT) AS frauds,
               round(CAST(f AS DOUBLE) / k, 8) AS fraud_rate,
               round((CAST(f AS DOUBLE) / k) / (CAST(p AS DOUBLE) / n), 8) AS lift,
               round(CAST(sum(f) OVER (ORDER BY decile) AS DOUBLE) / p, 8) AS cumulative_recall FROM sums""",
    "budget_scan": """, budgets AS (
          SELECT CAST(g AS INTEGER) AS step, n, p,
                 greatest(1, CAST(floor(n * (CASE WHEN g = 60 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0.0005 AS DOUBLE)
                   + (g - 1) * ((CAST(0.1 AS DOUBLE) - CAST(0.0005 AS DOUBLE)) / 59) END)) AS BIGINT)) AS k
          FROM size, generate_series(1, 60) s(g))
        SELECT step, round(CAST(k AS DOUBLE) / b.n, 8) AS budget, round(CAST(tp AS DOUBLE) / b.p, 8) AS recall,
               round(CAST(tp AS DOUBLE) / k, 8) AS precision,
               round((CAST(tp AS DOUBLE) / k) / (CAST(b.p AS DOUBLE) / b.n), 8) AS lift
        FROM budgets b JOIN ranked r ON r.flagged = b.k""",
    "confusion_matrix": """, cells AS (
          SELECT count(*) FILTER (score >= 0.9 AND y = 1) AS tp, count(*) FILTER (score >= 0.9 AND y = 0) AS fp,
                 count(*) FILTER (score < 0.9 AND y = 1) AS fn, count(*) FILTER (score < 0.9 AND y = 0) AS tn
          FROM scored)
        SELECT *, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 8) AS precision,
               round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 8) AS recall,
               round(CASE WHEN fp + tn = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / (fp + tn) END, 8) AS fpr,
               round(CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn), 8) AS flagged_frac FROM cells""",
    "top_risk": """SELECT id AS transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, y AS is_fraud,
        round(score, 8) AS score FROM ranked WHERE flagged <= 500""",
}

_BY_KEY = "(o_orderkey * 7919 % 10007) / 10007.0::DOUBLE"
_COMPARED = """SELECT {name} AS model, {ap} AS pr_auc, {auc} AS roc_auc, {r1} AS r1, {r2} AS r2, {r3} AS r3,
    {top} AS top, n, p, CAST(cost AS DOUBLE) AS cost FROM best"""


def _compared(name: str, score: str) -> str:
    return _scored(score) + " " + _COMPARED.format(
        name=f"'{name}'", ap=_AP, auc=_AUC, r1=_recall(0.001), r2=_recall(0.01), r3=_recall(0.05),
        top=_precision(0.001),
    )


_MODELS = f"""
WITH models AS (
  SELECT * FROM ({_compared("by_price", _SCORES[""])}) UNION ALL SELECT * FROM ({_compared("by_key", _BY_KEY)}))"""

_MATRIX_ZEROS = [
    "current_age", "credit_score", "num_credit_cards", "per_capita_income", "yearly_income", "total_debt",
    "credit_limit", "amount_to_limit", "sec_since_prev_txn", "amount_dev_from_prior_avg", "amount_z",
    "card_age_years",
]
_MATRIX_PLAIN = [
    "amount", "txn_hour", "txn_dow", "txn_month", "is_weekend", "is_night", "card_prior_txn_count",
    "card_merchant_prior_count", "card_prior_avg_amount", "card_prior_std_amount", "card_prior_max_amount",
    "is_first_txn", "merchant_prior_count",
]
_CATEGORIES = [
    "use_chip", "errors", "merchant_state", "mcc", "mcc_desc", "card_brand", "card_type", "has_chip",
    "card_on_dark_web", "gender",
]

_LOF = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (
  SELECT a.vec_id AS id, b.vec_id AS other, list_distance(a.x, b.x) AS d FROM v a, v b WHERE a.vec_id <> b.vec_id),
near AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, other) <= 20),
kd AS (SELECT id, max(d) AS kd FROM near GROUP BY 1),
lrd AS (SELECT n.id, 1.0 / (avg(greatest(n.d, kd.kd)) + 1e-10) AS lrd
        FROM near n JOIN kd ON kd.id = n.other GROUP BY 1)
SELECT n.id AS vec_id, round(avg(o.lrd) / any_value(own.lrd), 6) AS anomaly_score
FROM near n JOIN lrd o ON o.id = n.other JOIN lrd own ON own.id = n.id GROUP BY 1"""

_SPLIT = """
cut AS (
  SELECT max(CASE WHEN i = CAST(floor(m * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN ts END) AS train_end,
         max(CASE WHEN i = CAST(floor(m * (CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE))) AS BIGINT) THEN ts END)
           AS valid_end
  FROM (SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS i, count(*) OVER () AS m
        FROM {table} WHERE is_fraud IS NOT NULL)),
parts AS (
  SELECT t.*, CASE WHEN ts <= train_end THEN 'train' WHEN ts <= valid_end THEN 'valid' ELSE 'test' END AS split,
         train_end, valid_end
  FROM {table} t, cut WHERE is_fraud IS NOT NULL)"""

ORACLES: dict[str, str] = {
    "money_parse": "SELECT c_custkey AS id, round(c_acctbal, 6) AS amount FROM customer",
    "try_date": """
        WITH t AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m')
            WHEN 3 THEN strftime(o_orderdate, '%Y') WHEN 4 THEN strftime(o_orderdate, '%m/%Y') END AS text FROM orders)
        SELECT o_orderkey, text, try_cast(text AS DATE) AS parsed FROM t""",
    "csv_roundtrip": f"""{SPARSE} SELECT transaction_id AS id, ts AS date, client_id, card_id,
        '$' || CAST(amount AS VARCHAR) AS amount, use_chip, merchant_id, merchant_city, merchant_state, zip, mcc,
        errors FROM facts""",
    "label_parse": """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
        FROM events WHERE event_type <> 'signup'""",
    "mcc_lookup": """SELECT CAST(n_nationkey + 5000 AS BIGINT) AS mcc, 'Trade ' || n_name AS mcc_desc
        FROM nation""",
    "enrich_facts": _FACT_VIEW,
    "enrich_large_dimensions": _FACT_VIEW,
    "prepare": _FACT_VIEW,
    "label_coverage": f"""{SPARSE} SELECT count(is_fraud) AS labeled, count(*) - count(is_fraud) AS unlabeled,
        min(ts) AS date_min, max(ts) AS date_max FROM facts""",
    "summary": f"""{SPARSE} SELECT count(*) AS transactions, (SELECT count(*) FROM customer) AS users,
        (SELECT count(*) FROM customer) AS cards, count(*) FILTER (is_fraud = 1) AS frauds,
        round(count(*) FILTER (is_fraud = 1) / count(*), 6) AS fraud_rate,
        round(count(*) FILTER (is_fraud = 1) / count(is_fraud), 6) AS labeled_fraud_rate FROM facts""",
    "calendar_features": """
        WITH t AS (SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders
                   UNION ALL SELECT event_id, ts FROM events)
        SELECT transaction_id, ts, CAST(hour(ts) AS BIGINT) AS txn_hour, CAST(dayofweek(ts) AS BIGINT) AS txn_dow,
               CAST(month(ts) AS BIGINT) AS txn_month, CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend,
               CAST(hour(ts) BETWEEN 0 AND 5 AS INTEGER) AS is_night FROM t""",
    "card_history": f"{SPARSE}, base AS (SELECT * FROM facts), {_WINDOWED}"
    + _CARD_HISTORY.format(
        avg="round(coalesce(pavg, 0), 8)", std="round(coalesce(pstd, 0), 8)",
        max="round(coalesce(pmax, amount), 8)",
        more=f", {_EXACT_SECONDS} AS sec_since_prev_txn, CAST(prev IS NULL AS INTEGER) AS is_first_txn",
    ),
    "card_history_ties": _ORDER_HISTORY,
    "card_history_split": _ORDER_HISTORY,
    "merchant_novelty": f"""{SPARSE}, base AS (SELECT * FROM facts), {_WINDOWED}
        SELECT transaction_id, card_id, merchant_id, merchant_cnt AS merchant_prior_count,
               pair_cnt AS card_merchant_prior_count FROM windowed""",
    "amount_z": f"""{SPARSE}, base AS (SELECT * FROM facts), {_WINDOWED}
        SELECT transaction_id, round(amount, 8) AS amount, round(amount - pavg, 8) AS amount_dev_from_prior_avg,
               round(CASE WHEN pstd > 0 THEN (amount - pavg) / pstd END, 8) AS amount_z FROM windowed""",
    "amount_to_limit": f"""{SPARSE} SELECT transaction_id, round(amount, 6) AS amount,
        round(credit_limit, 6) AS credit_limit, round(amount / nullif(credit_limit, 0), 6) AS amount_to_limit
        FROM facts""",
    "card_age": f"""{SPARSE} SELECT transaction_id, acct_open_date,
        CAST(year(ts) - year(acct_open_date) AS BIGINT) AS card_age_years FROM facts""",
    "causal_features": FEATURES,
    "causal_features_split": FEATURES,
    "features_write": FEATURES,
    "features_sample": _features(SPARSE, "SELECT * FROM facts ORDER BY ts, transaction_id LIMIT 1000"),
    "rate_by_hour": _rate(DENSE, "facts", "CAST(hour(ts) AS BIGINT)", "hour"),
    "rate_by_dow": f"""SELECT *, list_extract(['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'], CAST(dow + 1 AS INTEGER))
        AS day FROM ({_rate(DENSE, "facts", "CAST(dayofweek(ts) AS BIGINT)", "dow")})""",
    "rate_by_time_flags": f"""{DENSE}, f AS (SELECT CAST(hour(ts) < 6 AS INTEGER) AS is_night,
          CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS is_weekend, is_fraud FROM facts WHERE is_fraud IS NOT NULL)
        SELECT is_night, is_weekend, count(*) AS n, round(avg(is_fraud), 6) AS fraud_rate,
          CASE is_night WHEN 1 THEN 'night' ELSE 'day' END || ' · ' ||
          CASE is_weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS label FROM f GROUP BY 1, 2""",
    "rate_by_brand": _rate(DENSE, "facts", "card_brand", "card_brand"),
    "rate_by_card_type": _rate(DENSE, "facts", "card_type", "card_type"),
    "rate_by_state": _place("state", "length(merchant_state) = 2"),
    "rate_by_country": _place("country", "length(merchant_state) > 2"),
    "rate_by_region": _rate(
        DENSE,
        "facts",
        """CASE WHEN merchant_state IS NULL THEN 'unknown' WHEN length(merchant_state) = 2 THEN 'US state'
           ELSE 'international' END""",
        "region",
    ),
    "rate_by_credit_band": f"""{DENSE} SELECT CAST(round((credit_score - 300) / 69.0) AS INTEGER) AS bucket,
        min(credit_score) AS lo, max(credit_score) AS hi, count(*) AS n, round(avg(is_fraud), 6) AS fraud_rate,
        CAST(min(credit_score) AS VARCHAR) || '–' || CAST(max(credit_score) AS VARCHAR) AS "range"
        FROM facts WHERE is_fraud IS NOT NULL AND credit_score IS NOT NULL GROUP BY 1""",
    "rate_by_month": _rate(ORDERS, "ord", "CAST(date_trunc('month', ts) AS TIMESTAMP)", "month"),
    "rate_by_year": _rate(ORDERS, "ord", "CAST(year(ts) AS BIGINT)", "year"),
    "rate_by_channel": _rate(ORDERS, "ord", "use_chip", "use_chip"),
    "rate_cuts": " UNION ALL ".join(
        f"""SELECT '{name}' AS cut, CAST(k AS VARCHAR) AS value, count(*) AS n, round(avg(is_fraud), 6) AS fraud_rate
            FROM ({ORDERS} SELECT {key} AS k, is_fraud FROM ord WHERE is_fraud IS NOT NULL) GROUP BY k"""
        for name, key in (("dow", "dayofweek(ts)"), ("year", "year(ts)"), ("use_chip", "use_chip"))
    ),
    "category_by_volume": _rate(ITEMS, "items", "mcc_desc", "mcc_desc", "ORDER BY n DESC, mcc_desc LIMIT 15"),
    "category_by_frauds": f"""{ITEMS} SELECT mcc_desc, count(*) AS frauds FROM items WHERE is_fraud = 1
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "top_merchants": f"""{ITEMS} SELECT merchant_id, min(merchant_city) AS city, min(mcc_desc) AS category,
        count(*) AS frauds, min(merchant_city) || ' · ' || left(min(mcc_desc), 22) AS label
        FROM items WHERE is_fraud = 1 GROUP BY 1 ORDER BY frauds DESC, 1 LIMIT 15""",
    "amount_stats": f"""{ITEMS} SELECT is_fraud, count(*) AS n, round(avg(amount), 6) AS mean,
        round(quantile_cont(amount, 0.5), 6) AS median, round(quantile_cont(amount, 0.25), 6) AS q25,
        round(quantile_cont(amount, 0.75), 6) AS q75, round(quantile_cont(amount, 0.95), 6) AS q95,
        CASE is_fraud WHEN 0 THEN 'legitimate' ELSE 'fraud' END AS class
        FROM items WHERE is_fraud IS NOT NULL GROUP BY 1""",
    "amount_histogram": _histogram(
        DENSE + """, hist AS (SELECT is_fraud AS label, amount AS x FROM facts
                   WHERE is_fraud IS NOT NULL AND amount > 0 AND amount < 2000)"""
    ),
    "score_histogram": _histogram(_scored(_SCORES[""]) + ", hist AS (SELECT y AS label, score AS x FROM scored)"),
    "sample_fixed_n": f"""{ORDERS} SELECT * REPLACE (round(amount, 6) AS amount) FROM ord
        ORDER BY md5(CAST(transaction_id AS VARCHAR)) LIMIT 1000""",
    "sample_then_filter": f"""{ORDERS} SELECT * REPLACE (round(amount, 6) AS amount) FROM
        (SELECT * FROM ord ORDER BY md5(CAST(transaction_id AS VARCHAR)) LIMIT 1000) WHERE is_fraud IS NOT NULL""",
    "stratified_subsample": f"""{ORDERS}, r AS (SELECT * REPLACE (round(amount, 6) AS amount) FROM ord)
        SELECT * FROM r WHERE is_fraud = 1 UNION ALL
        (SELECT * FROM r WHERE is_fraud = 0 ORDER BY md5(CAST(transaction_id AS VARCHAR)) LIMIT 1000)""",
    "time_split": f"""{ORDERS}, {_SPLIT.format(table="ord")}
        SELECT transaction_id, ts, is_fraud, split FROM parts""",
    "split_summary": f"""{DENSE}, {_SPLIT.format(table="facts")}
        SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'valid') AS valid,
          count(*) FILTER (split = 'test') AS test, round(avg(CASE WHEN split = 'test' THEN is_fraud END), 6)
          AS test_base_rate, CAST(0.7 AS DOUBLE) AS train_frac, CAST(0.15 AS DOUBLE) AS valid_frac,
          CAST(0.15 AS DOUBLE) AS test_frac, CAST(max(train_end) AS VARCHAR) AS train_end,
          CAST(max(valid_end) AS VARCHAR) AS valid_end FROM parts""",
    "top_risk_view": _scored(_SCORES[""])
    + """ SELECT id AS "Transaction ID", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "Timestamp",
        CASE y WHEN 0 THEN 'No' ELSE 'Yes' END AS "Actually fraud", round(score, 8) AS "Risk score"
        FROM ranked WHERE flagged <= 25""",
    "model_comparison": f"""{_MODELS} SELECT model, round(pr_auc, 8) AS pr_auc, round(roc_auc, 8) AS roc_auc,
        round(r1, 8) AS recall_at_fpr_0_1pct, round(r2, 8) AS recall_at_fpr_1pct, round(r3, 8) AS recall_at_fpr_5pct,
        round(top, 8) AS precision_at_top_0_1pct, round(top / (CAST(p AS DOUBLE) / n), 8) AS lift_at_top_0_1pct,
        cost AS total_cost, round(cost / n, 8) AS cost_per_txn,
        (SELECT cost FROM models WHERE model = 'by_key') - cost AS savings, CAST(p * 200 AS DOUBLE) AS do_nothing_cost
        FROM models""",
    "metrics_long": f"""{_MODELS} SELECT model, 'roc_auc' AS metric, round(roc_auc, 8) AS value FROM models
        UNION ALL SELECT model, 'pr_auc', round(pr_auc, 8) FROM models""",
    "model_matrix": "SELECT transaction_id, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MATRIX_PLAIN)
    + ", "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in _MATRIX_ZEROS)
    + f" FROM ({FEATURES})",
    "detector_matrix": f"""SELECT transaction_id, amount,
        CASE WHEN credit_limit BETWEEN 0 AND 9000 THEN credit_limit ELSE 0 END AS credit_limit,
        coalesce(sec_since_prev_txn, 0) AS sec_since_prev_txn, coalesce(amount_z, 0) AS amount_z,
        coalesce(CAST(card_age_years AS DOUBLE), 0) AS card_age_years FROM ({FEATURES})""",
    "tree_matrix": f"""SELECT transaction_id, amount, 0.0::DOUBLE AS amount_missing,
        coalesce(sec_since_prev_txn, 0) AS sec_since_prev_txn,
        CAST(sec_since_prev_txn IS NULL AS DOUBLE) AS sec_since_prev_txn_missing,
        coalesce(amount_z, 0) AS amount_z, CAST(amount_z IS NULL AS DOUBLE) AS amount_z_missing,
        coalesce(CAST(card_age_years AS DOUBLE), 0) AS card_age_years,
        CAST(card_age_years IS NULL AS DOUBLE) AS card_age_years_missing FROM ({FEATURES})""",
    "tree_scores": f"""WITH f AS (SELECT *, dense_rank() OVER (ORDER BY coalesce(CAST(use_chip AS VARCHAR), '__missing__')) - 1 AS code
          FROM ({_features(DENSE)})), t AS (SELECT transaction_id, ts, is_fraud,
          CASE WHEN coalesce(amount, 0) <= 60 THEN -0.5 WHEN coalesce(amount_z, 0) <= 0.5 THEN 0.25 ELSE 0.75 END AS one,
          CASE WHEN sec_since_prev_txn IS NULL THEN 0.125 WHEN sec_since_prev_txn <= 90000 THEN -0.25 ELSE 0.5 END AS two,
          CASE WHEN code IN (0, 2) THEN 1.0 ELSE -1.0 END AS three FROM f)
        SELECT transaction_id, ts, is_fraud, round(1 / (1 + exp(-CAST(-2 + one + two + three AS DOUBLE))), 8) AS score FROM t""",
    "category_encode": "SELECT transaction_id, "
    + ", ".join(
        f"dense_rank() OVER (ORDER BY coalesce(CAST({c} AS VARCHAR), '__missing__')) - 1 AS {c}_code"
        for c in _CATEGORIES
    )
    + f" FROM ({FEATURES})",
    "standardize": "WITH w AS (SELECT vec_id, "
    + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i:02d}" for i in range(64))
    + " FROM embeddings) SELECT vec_id, "
    + ", ".join(
        f"""round((x{i:02d} - avg(x{i:02d}) OVER ()) / coalesce(nullif(stddev_pop(x{i:02d}) OVER (), 0), 1), 6)
            AS x{i:02d}"""
        for i in range(64)
    )
    + " FROM w",
    "lof": _LOF,
}

for _suffix, _score in _SCORES.items():
    for _name, _sql in _RANKING.items():
        ORACLES[_name + _suffix] = f"{_scored(_score)} {_sql}"
