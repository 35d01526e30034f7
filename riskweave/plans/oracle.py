"""SQL with the same results as the registered queries, over the same tables."""

from __future__ import annotations

from riskweave import schemas as S
from riskweave.plans import orders as O
from riskweave.plans.oracle_models import model_sql

LINES = """
lines AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS qty, sum(l_extendedprice) AS price,
         avg(l_discount) AS discount, avg(l_tax) AS tax,
         max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS open_lines,
         max(CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END) AS bulk,
         max(CASE WHEN l_discount >= CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END) AS deep_discount,
         max(CASE WHEN l_tax >= CAST(0.07 AS DOUBLE) THEN 1 ELSE 0 END) AS high_tax,
         avg(CASE WHEN l_returnflag = 'R' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS returned
  FROM lineitem GROUP BY l_orderkey),
features AS (
  SELECT o_orderkey AS order_id, o_totalprice AS totalprice, c_acctbal AS acctbal, n_lines, qty, price, discount, tax,
         o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS segment, c_nationkey AS nation,
         open_lines, bulk, deep_discount, high_tax,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS urgent,
         CASE WHEN c_acctbal >= 8000 THEN 1 ELSE 0 END AS rich,
         CASE WHEN returned >= 0.5 THEN 1 ELSE 0 END AS target
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON l_orderkey = o_orderkey)"""

STAR = LINES + """,
keyed AS (
  SELECT row_number() OVER (ORDER BY order_id) AS k, *,
         (coalesce(open_lines, 0) + coalesce(bulk, 0) + coalesce(deep_discount, 0) + coalesce(high_tax, 0)
          + coalesce(urgent, 0)) / CAST(5 AS DOUBLE) AS risk_score
  FROM features),
order_fact AS (SELECT k AS fact_id, k AS party_id, k AS detail_id, k AS value_id, target, risk_score FROM keyed),
dim_party AS (SELECT k AS party_id, segment, nation, acctbal FROM keyed),
dim_order AS (SELECT k AS detail_id, status, priority FROM keyed),
dim_value AS (SELECT k AS value_id, totalprice, qty, price FROM keyed)"""

RECORDS = """
records AS (
  SELECT l_suppkey AS subject, l_extendedprice AS amount, l_extendedprice / 1000 AS amount_k,
         l_extendedprice / 1000 / ((l_quantity / 10) * (l_quantity / 10)) AS density, l_quantity AS quantity,
         l_discount AS discount, CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS status,
         CAST(NULL AS INT) AS priority, CAST(NULL AS INT) AS channel,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 0 WHEN 'R' THEN 1 END AS target
  FROM lineitem
  UNION ALL
  SELECT o_custkey, o_totalprice, o_totalprice / 1000, NULL, NULL, NULL,
         CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END,
         CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 1 END,
         NULL, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END
  FROM orders
  UNION ALL
  SELECT user_id, value, NULL, NULL, NULL, NULL, NULL, NULL,
         CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END
  FROM events)"""


def _rnd(cols: list[str], digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


def _modes(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1) AS fill" for c in cols)


def _records_out(source: str) -> str:
    return f"SELECT {', '.join(O.RECORD_COLUMNS)} FROM {source}"


def _describe(table: str, cols: list[str], digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), {digits}) AS mean, "
        f"round(stddev_samp({c}), {digits}) AS std, round(min({c}), {digits}) AS min, "
        f"round(quantile_cont({c}, 0.25), {digits}) AS q25, round(quantile_cont({c}, 0.5), {digits}) AS q50, "
        f"round(quantile_cont({c}, 0.75), {digits}) AS q75, round(max({c}), {digits}) AS max FROM {table}" for c in cols)


def _zscore(cols: list[str], table: str, keep: str) -> str:
    z = ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM {table})) / (SELECT stddev_pop({c}) FROM {table}), 6) + 0 AS {c}" for c in cols)
    return f"SELECT {keep}, {z} FROM {table}"


def _anova(table: str, cols: list[str], label: str) -> str:
    return " UNION ALL ".join(f"""
      SELECT '{c}' AS feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS f_score
      FROM (SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) AS v, (SELECT avg({c}) FROM {table}) AS g
            FROM {table} GROUP BY {label})""" for c in cols)


def _pairs(cols: list[str], fn: str, digits: int, scale: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS row, '{b}' AS col, round({fn}({a}, {b}){scale}, {digits}) + 0 AS value FROM lineitem"
        for i, a in enumerate(cols) for b in cols[i:])


def _split(source: str, key: str, n_test: str = "ceil(CAST(0.2 AS DOUBLE) * n)") -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5(CAST({key} AS VARCHAR)), {key}) AS rn, count(*) OVER () AS n FROM {source}),
marked AS (SELECT *, rn <= {n_test} AS is_test FROM ranked)"""


def _binary(pred: str, label: str, name: str) -> str:
    return f"""
  SELECT '{name}' AS model, avg(CASE WHEN {label} = {pred} THEN 1.0 ELSE 0.0 END) AS accuracy,
         coalesce(CAST(sum({label} * {pred}) AS DOUBLE) / nullif(sum({pred}), 0), 0) AS precision,
         coalesce(CAST(sum({label} * {pred}) AS DOUBLE) / nullif(sum({label}), 0), 0) AS recall,
         coalesce(CAST(2 * sum({label} * {pred}) AS DOUBLE) / nullif(sum({label}) + sum({pred}), 0), 0) AS f1
  FROM preds"""


PREDS = """
preds AS (
  SELECT quality, toxic, CAST(n_chars >= 500 AS INT) AS long, CAST(n_chars >= 3000 AS INT) AS very_long,
         CAST(lang = 'en' AS INT) AS english
  FROM labels JOIN documents USING (doc_id))"""
RULE_METRICS = PREDS + ", scores AS (" + " UNION ALL ".join(
    _binary(m, "quality", m) for m in ("long", "very_long", "english")) + ")"

CLASS_REPORT = f"""
WITH {PREDS},
classes AS (SELECT 0 AS c UNION ALL SELECT 1),
per AS (
  SELECT c, (SELECT count(*) FROM preds WHERE quality = c) AS support,
         (SELECT count(*) FROM preds WHERE english = c) AS predicted,
         (SELECT count(*) FROM preds WHERE quality = c AND english = c) AS hit
  FROM classes),
rates AS (
  SELECT CASE c WHEN 0 THEN 'Poor' ELSE 'Good' END AS class, coalesce(CAST(hit AS DOUBLE) / nullif(predicted, 0), 0) AS precision,
         coalesce(CAST(hit AS DOUBLE) / nullif(support, 0), 0) AS recall,
         coalesce(CAST(2 * hit AS DOUBLE) / nullif(predicted + support, 0), 0) AS f1, support, hit FROM per),
report AS (
  SELECT class, precision, recall, f1, support FROM rates
  UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support) FROM rates
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rates
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM rates)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM report"""

ORDER_LINES = LINES + ", rows_ AS (SELECT order_id, " + ", ".join(
    f"coalesce({c}, (SELECT avg({c}) FROM features)) AS {c}" for c in ("qty", "price", "n_lines")) + " FROM features)"
IMPUTED = LINES + ", filled AS (SELECT order_id, target, " + ", ".join(
    f"coalesce({c}, (SELECT avg({c}) FROM features)) AS {c}" for c in O.NUMERIC) + " FROM features)"
REGRESS_SIMPLE = f"""
WITH {ORDER_LINES}, {_split('rows_', 'order_id')},
fit AS (SELECT regr_slope(price, qty) AS slope, regr_intercept(price, qty) AS intercept FROM marked WHERE NOT is_test),
test AS (SELECT price, intercept + slope * qty AS p, slope, intercept FROM marked, fit WHERE is_test)
SELECT round(max(slope), 4) AS slope, round(max(intercept), 3) AS intercept,
       round(sqrt(avg((price - p) * (price - p))), 3) AS rmse,
       round(1 - avg((price - p) * (price - p)) / var_pop(price), 6) AS r2 FROM test"""
REGRESS_MULTI = f"""
WITH {ORDER_LINES}, {_split('rows_', 'order_id')},
s AS (
  SELECT covar_pop(qty, price) AS c1, covar_pop(n_lines, price) AS c2, covar_pop(qty, n_lines) AS c12, var_pop(qty) AS v1,
         var_pop(n_lines) AS v2, avg(qty) AS m1, avg(n_lines) AS m2, avg(price) AS my FROM marked WHERE NOT is_test),
b AS (SELECT (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, * FROM s),
fit AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM b),
test AS (SELECT price, b0 + b1 * qty + b2 * n_lines AS p, b0, b1, b2 FROM marked, fit WHERE is_test)
SELECT round(max(b1), 3) AS b_qty, round(max(b2), 2) AS b_lines, round(max(b0), 2) AS intercept,
       round(sqrt(avg((price - p) * (price - p))), 3) AS rmse,
       round(1 - avg((price - p) * (price - p)) / var_pop(price), 6) AS r2 FROM test"""

PCA = ORDER_LINES + """,
xy AS (SELECT order_id, qty AS x, n_lines * 10 AS y FROM rows_),
cov AS (SELECT var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c, avg(x) AS mx, avg(y) AS my FROM xy),
eig AS (SELECT *, (a + c + sqrt((a - c) * (a - c) + 4 * b * b)) / 2 AS e1, (a + c - sqrt((a - c) * (a - c) + 4 * b * b)) / 2 AS e2 FROM cov),
vec AS (SELECT *, b AS x1, e1 - a AS y1, b AS x2, e2 - a AS y2 FROM eig),
unit AS (
  SELECT *, sqrt(x1 * x1 + y1 * y1) * (CASE WHEN abs(x1) >= abs(y1) THEN sign(x1) ELSE sign(y1) END) AS n1,
         sqrt(x2 * x2 + y2 * y2) * (CASE WHEN abs(x2) >= abs(y2) THEN sign(x2) ELSE sign(y2) END) AS n2 FROM vec)"""

NEAREST = """
cells AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
means AS (SELECT label, i, avg(v) AS m FROM cells GROUP BY label, i),
rank AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM embeddings)),
dist AS (
  SELECT c.vec_id, k.cluster, sum((c.v - m.m) * (c.v - m.m)) AS d
  FROM cells c JOIN means m ON c.i = m.i JOIN rank k ON k.label = m.label GROUP BY c.vec_id, k.cluster),
nearest AS (SELECT vec_id, CAST(arg_min(cluster, d) AS INT) AS cluster, min(d) AS d FROM dist GROUP BY vec_id)"""

CLUSTER_LABELS = f"""
WITH {LINES},
rates AS (SELECT status, count(*) AS n, avg(target) AS rate FROM features WHERE status IS NOT NULL GROUP BY status),
ranked AS (SELECT *, row_number() OVER (ORDER BY rate, status) - 1 AS ord FROM rates)
SELECT CAST(ord AS INT) AS ord, CASE ord WHEN 0 THEN 'Low Risk' WHEN 1 THEN 'Medium Risk' ELSE 'High Risk' END AS risk_label,
       n AS row_count, round_even(rate, 3) AS outcome_rate, round(rate * 100, 4) AS outcome_percent FROM ranked"""


def _mask(sub: str, items: list[str]) -> str:
    """Comma-separated sorted names of the bits of ``sub``."""
    names = sorted(enumerate(items), key=lambda p: p[1])
    return "concat_ws(',', " + ", ".join(f"CASE WHEN ({sub} & {1 << i}) <> 0 THEN '{v}' END" for i, v in names) + ")"


def _itemsets(with_masks: str, items: list[str], support: float) -> str:
    return f"""
{with_masks},
subs AS (SELECT CAST(range AS INT) AS sub FROM range(1, {1 << len(items)})),
freq AS (
  SELECT sub, count(*) AS freq, count(*) / CAST((SELECT count(*) FROM masks) AS DOUBLE) AS support
  FROM subs JOIN masks ON (mask & sub) = sub GROUP BY sub),
found AS (SELECT * FROM freq WHERE support >= CAST({support} AS DOUBLE))"""


def _itemset_out(items: list[str]) -> str:
    return f"SELECT {_mask('sub', items)} AS items, freq, CAST(bit_count(sub) AS INT) AS n_items, round(support, 6) AS support FROM found"


def _rules(items: list[str], confidence: float) -> str:
    return f""",
rules AS (
  SELECT {_mask('a.sub', items)} AS antecedents, {_mask('c.sub', items)} AS consequents, f.support AS support,
         f.support / a.support AS confidence, f.support / a.support / c.support AS lift
  FROM found f JOIN found a ON (f.sub & a.sub) = a.sub AND a.sub <> f.sub JOIN found c ON c.sub = xor(f.sub, a.sub)
  WHERE f.support / a.support >= CAST({confidence} AS DOUBLE))
SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM rules"""


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
_PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _bit_case(col: str, items: list[str]) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{v}' THEN {1 << i}" for i, v in enumerate(items)) + " ELSE 0 END"


EVENT_MASKS = f"masks AS (SELECT bit_or({_bit_case('event_type', _EVENT_TYPES)}) AS mask FROM events GROUP BY user_id, CAST(ts AS DATE))"
PART_MASKS = f"""masks AS (SELECT bit_or({_bit_case('p_type', _PART_TYPES)}) AS mask
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)"""
FLAG_MASKS = LINES + ", masks AS (SELECT " + " + ".join(
    f"CASE WHEN {c} <> 0 THEN {1 << i} ELSE 0 END" for i, c in enumerate(O.RULE_ITEMS)
) + " AS mask FROM features WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in O.RULE_ITEMS) + ")"
FLAG_ITEMSETS = _itemsets(FLAG_MASKS, O.RULE_ITEMS, 0.1)

SCORE_EVENT = "round_even(least(value / 500.0, 1.0) * 100.0, 1)"
BAND_RIGHT = "CASE " + " ".join(
    f"WHEN s > {lo} AND s <= {hi} THEN '{b}'" for lo, hi, b in zip(S.SCORE_EDGES, S.SCORE_EDGES[1:], S.SCORE_BANDS)) + " END"


def _band_left(p: str, labels: list[str]) -> str:
    return f"CASE WHEN {p} IS NULL THEN NULL WHEN {p} < CAST(0.33 AS DOUBLE) THEN '{labels[0]}' WHEN {p} < CAST(0.66 AS DOUBLE) THEN '{labels[1]}' ELSE '{labels[2]}' END"


SCORE = f"""
parts AS (
  SELECT o_orderkey,
    CAST(0.9 AS DOUBLE) * (o_totalprice - (SELECT avg(o_totalprice) FROM orders)) / (SELECT stddev_pop(o_totalprice) FROM orders) AS c0,
    CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(0.5 AS DOUBLE) ELSE 0 END AS c1,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(-0.25 AS DOUBLE) ELSE 0 END AS c2,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(0.125 AS DOUBLE) ELSE 0 END AS c3,
    CASE WHEN o_orderpriority = '5-LOW' THEN CAST(-0.75 AS DOUBLE) ELSE 0 END AS c4,
    CASE WHEN o_orderstatus = 'O' THEN CAST(0.3 AS DOUBLE) ELSE 0 END AS c5,
    CASE WHEN o_orderstatus = 'P' THEN CAST(-0.6 AS DOUBLE) ELSE 0 END AS c6
  FROM orders),
probs AS (SELECT *, 1 / (1 + exp(-(CAST(-0.2 AS DOUBLE) + c0 + c1 + c2 + c3 + c4 + c5 + c6))) AS p FROM parts)"""
SCORE_OUT = f"""
WITH {SCORE}
SELECT o_orderkey, round(p, 6) AS probability, round_even(p * 100, 1) AS risk_score,
       {_band_left('p', S.PROBABILITY_BANDS)} AS risk_band, {_band_left('p', S.VERDICTS)} AS verdict FROM probs"""
_SCORE_FEATURES = ["o_totalprice", "o_orderpriority_2-HIGH", "o_orderpriority_3-MEDIUM", "o_orderpriority_4-NOT SPECIFIED",
                   "o_orderpriority_5-LOW", "o_orderstatus_O", "o_orderstatus_P"]
TOP_CONTRIB = f"""
WITH {SCORE},
cells AS (""" + " UNION ALL ".join(
    f"SELECT o_orderkey, {i} AS i, '{f}' AS feature, c{i} AS v FROM parts" for i, f in enumerate(_SCORE_FEATURES)) + """),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC, i) AS up,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY v, i) AS down FROM cells WHERE v IS NOT NULL)
SELECT o_orderkey, string_agg(feature, ',' ORDER BY up) FILTER (WHERE up <= 5) AS top_up,
       string_agg(feature, ',' ORDER BY down) FILTER (WHERE down <= 3) AS top_down,
       round(max(v), 6) + 0 AS largest, round(min(v), 6) + 0 AS smallest FROM ranked GROUP BY o_orderkey"""
ADVICE = f"""
WITH {SCORE}
SELECT o_orderkey, CASE WHEN p >= CAST(0.33 AS DOUBLE) THEN 6 ELSE 4 END AS n_lines,
       CASE WHEN p >= CAST(0.33 AS DOUBLE) THEN '{' '.join(S.ADVICE_AT_RISK)} ' ELSE '' END || '{' '.join(S.ADVICE_GENERAL)}' AS advice
FROM probs"""

SPLIT_STRATIFIED = """
WITH counts AS (SELECT o_orderstatus AS c, count(*) AS n FROM orders GROUP BY o_orderstatus),
total AS (SELECT sum(n) AS t, sum(n) - ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS train FROM counts),
exact AS (SELECT c, n, train, CAST(train AS DOUBLE) * n / t AS e FROM counts, total),
placed AS (SELECT *, row_number() OVER (ORDER BY e - floor(e) DESC, c NULLS FIRST) AS pos, train - sum(floor(e)) OVER () AS spare FROM exact),
quota AS (SELECT c, n - floor(e) - CASE WHEN pos <= spare THEN 1 ELSE 0 END AS q FROM placed),
ranked AS (
  SELECT o_orderkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus, rn <= q AS is_test FROM ranked JOIN quota ON c IS NOT DISTINCT FROM o_orderstatus"""

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_FILLED = "filled AS (SELECT subject, " + ", ".join(
    [f"coalesce({c}, (SELECT round(avg({c}), 7) FROM base)) AS {c}" for c in O.RECORD_MEANS]
    + [f"coalesce({c}, (SELECT fill FROM modes WHERE feature = '{c}')) AS {c}" for c in O.RECORD_MODES]
) + ", target FROM base)"

ORACLE: dict[str, str] = {
    "source_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS row_count FROM {t}" for t in ("lineitem", "orders", "events")),
    "csv_scan": "SELECT o_orderpriority, o_totalprice, o_orderkey, CAST(o_custkey AS INT) AS o_custkey FROM orders",
    "feature_table_roundtrip": f"""WITH {LINES} SELECT order_id, {_rnd(O.NUMERIC, 8)}, status, priority, segment, nation,
        open_lines, bulk, deep_discount, high_tax, urgent, rich, target FROM features""",
    "scaler_roundtrip": _zscore(["o_totalprice"], "orders", "o_orderkey"),
    "integrate_sources": f"WITH {RECORDS} {_records_out('records')}",
    "dedup_rows": "SELECT DISTINCT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate) FROM lineitem",
    "dedup_documents": "SELECT DISTINCT * FROM documents",
    "dedup_stats": f"""WITH {RECORDS} SELECT b AS rows_before, a AS rows_after, b - a AS rows_removed
        FROM (SELECT (SELECT count(*) FROM records) AS b, (SELECT count(*) FROM (SELECT DISTINCT * FROM records)) AS a)""",
    "null_audit": f"WITH {RECORDS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS null_count FROM records" for c in O.RECORD_COLUMNS),
    "null_total_after_impute": f"""WITH {RECORDS}, base AS (SELECT * FROM records), modes AS ({_modes('base', O.RECORD_MODES)}),
        {_FILLED} SELECT CAST({' + '.join(f'count(*) - count({c})' for c in O.RECORD_COLUMNS)} AS BIGINT) AS null_cells FROM filled""",
    "impute_mean": f"WITH {RECORDS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 7) AS fill FROM records" for c in O.RECORD_MEANS),
    "impute_mode": f"WITH {RECORDS} {_modes('records', O.RECORD_MODES)}",
    "impute_rows": f"""WITH {RECORDS}, base AS (SELECT DISTINCT * FROM records), modes AS ({_modes('base', O.RECORD_MODES)}),
        {_FILLED} {_records_out('filled')}""",
    "describe_numeric": _describe("lineitem", _MEASURES, 7),
    "one_hot_drop_first": "SELECT o_orderkey, " + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, values in (
            ("o_orderpriority", ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]), ("o_orderstatus", ["O", "P"]))
        for v in values) + " FROM orders",
    "zscore": _zscore(_MEASURES, "lineitem", "l_orderkey, l_linenumber"),
    "anova_f": _anova("lineitem", _MEASURES, "l_returnflag"),
    "select_k_best": f"""WITH {IMPUTED}, base AS (SELECT * FROM filled),
        scores AS ({_anova('base', O.NUMERIC, 'target')}) SELECT feature FROM scores ORDER BY f_score DESC, feature LIMIT 3""",
    "star_fact": f"WITH {STAR} SELECT * FROM order_fact",
    "dim_party": f"WITH {STAR} SELECT * FROM dim_party",
    "dim_order": f"WITH {STAR} SELECT * FROM dim_order",
    "dim_value": f"WITH {STAR} SELECT value_id, {_rnd(['totalprice', 'qty', 'price'], 4)} FROM dim_value",
    "star_counts": f"WITH {STAR} " + " UNION ALL ".join(
        f"SELECT '{t}' AS source, count(*) AS row_count FROM {t}" for t in ("order_fact", "dim_party", "dim_order", "dim_value")),
    "olap_by_segment": f"WITH {STAR} SELECT segment, round(avg(risk_score), 4) AS avg_risk_score, count(*) AS order_count, "
        "CAST(sum(target) AS BIGINT) AS returned_count FROM order_fact JOIN dim_party USING (party_id) GROUP BY segment",
    "olap_by_status": f"WITH {STAR} SELECT status, round(avg(target), 4) AS return_rate, count(*) AS order_count "
        "FROM order_fact JOIN dim_order USING (detail_id) GROUP BY status",
    "olap_by_priority": f"WITH {STAR} SELECT priority, round(avg(target), 4) AS return_rate, count(*) AS order_count "
        "FROM order_fact JOIN dim_order USING (detail_id) GROUP BY priority",
    "split_stratified": SPLIT_STRATIFIED,
    "split_plain": f"WITH {_split('orders', 'o_orderkey')} SELECT o_orderkey, is_test FROM marked",
    "class_balance": f"WITH {LINES} SELECT target, count(*) AS row_count FROM features GROUP BY target",
    "classify_metrics": f"WITH {RULE_METRICS} SELECT model, {_rnd(['accuracy', 'precision', 'recall', 'f1'], 6)} FROM scores",
    "class_report": CLASS_REPORT,
    "best_model": f"""WITH {RULE_METRICS}
        SELECT (SELECT model FROM scores ORDER BY f1 DESC, model LIMIT 1) AS best_f1_model, round(max(f1), 6) AS best_f1,
               (SELECT model FROM scores ORDER BY accuracy DESC, model LIMIT 1) AS best_accuracy_model,
               round(max(accuracy), 6) AS best_accuracy FROM scores""",
    "regress_simple": REGRESS_SIMPLE,
    "regress_multi": REGRESS_MULTI,
    "regress_gram": _pairs(_MEASURES, "covar_pop", 2, " * count(*)"),
    "pca_cov": _pairs(_MEASURES, "covar_samp", 4),
    "pca_2d": f"""WITH {PCA} SELECT order_id, round(((x - mx) * x1 + (y - my) * y1) / n1, 4) + 0 AS pc1,
        round(((x - mx) * x2 + (y - my) * y2) / n2, 4) + 0 AS pc2 FROM xy, unit""",
    "pca_variance": f"""WITH {PCA} SELECT 'pc1' AS component, round(e1 / (e1 + e2), 6) AS explained_ratio FROM eig
        UNION ALL SELECT 'pc2', round(e2 / (e1 + e2), 6) FROM eig""",
    "kmeans_assign": f"WITH {NEAREST} SELECT vec_id, cluster, round(d, 6) AS sq_dist FROM nearest",
    "kmeans_step": f"WITH {NEAREST} SELECT cluster, count(*) AS row_count, round(sum(d), 6) AS wcss FROM nearest GROUP BY cluster",
    "cluster_labels": CLUSTER_LABELS,
    "high_risk_rows": f"""WITH {LINES}, rates AS (SELECT status, avg(target) AS rate FROM features WHERE status IS NOT NULL GROUP BY status)
        SELECT order_id, status, 'High Risk' AS risk_label FROM features
        WHERE status = (SELECT status FROM rates ORDER BY rate DESC, status DESC LIMIT 1)""",
    "itemsets_events": f"WITH {_itemsets(EVENT_MASKS, _EVENT_TYPES, 0.1)} {_itemset_out(_EVENT_TYPES)}",
    "itemsets_growth": f"WITH {_itemsets(EVENT_MASKS, _EVENT_TYPES, 0.1)} {_itemset_out(_EVENT_TYPES)}",
    "rules_events": f"WITH {_itemsets(EVENT_MASKS, _EVENT_TYPES, 0.0005)} {_rules(_EVENT_TYPES, 0.01)}",
    "itemsets_parts": f"WITH {_itemsets(PART_MASKS, _PART_TYPES, 0.1)} {_itemset_out(_PART_TYPES)}",
    "itemsets_flags": f"WITH {FLAG_ITEMSETS} {_itemset_out(O.RULE_ITEMS)}",
    "rules_flags": f"WITH {FLAG_ITEMSETS} {_rules(O.RULE_ITEMS, 0.6)}",
    "rules_top10": f"WITH {FLAG_ITEMSETS} {_rules(O.RULE_ITEMS, 0.6)} ORDER BY round(rules.lift, 9) DESC, "
        "round(rules.confidence, 9) DESC, round(rules.support, 9) DESC, antecedents, consequents LIMIT 10",
    "risk_bands_right": f"WITH scored AS (SELECT event_id, {SCORE_EVENT} AS s FROM events) "
        f"SELECT event_id, s AS predicted_risk_score, {BAND_RIGHT} AS risk_band FROM scored",
    "risk_bands_left": f"WITH scored AS (SELECT event_id, least(value / 500.0, 1.0) AS p FROM events) "
        f"SELECT event_id, {_band_left('p', S.PROBABILITY_BANDS)} AS risk_band, {_band_left('p', S.VERDICTS)} AS verdict FROM scored",
    "band_summary": f"""WITH scored AS (SELECT {SCORE_EVENT} AS s, CAST(event_type = 'error' AS INT) AS outcome FROM events),
        banded AS (SELECT {BAND_RIGHT} AS risk_band, outcome FROM scored), bands AS ("""
        + " UNION ALL ".join(f"SELECT {i} AS ord, '{b}' AS risk_band" for i, b in enumerate(S.SCORE_BANDS))
        + """) SELECT ord, bands.risk_band, count(banded.risk_band) AS row_count, round(avg(outcome), 6) AS outcome_rate
        FROM bands LEFT JOIN banded ON banded.risk_band = bands.risk_band GROUP BY ord, bands.risk_band""",
    "rounding_modes": "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half_even, "
        "round(l_quantity / 2, 0) AS half_away FROM lineitem",
    "validate_inputs": """WITH checked AS (SELECT l_orderkey, l_linenumber, concat_ws('; ',
          CASE WHEN (l_quantity BETWEEN 5 AND 45) IS NOT TRUE THEN 'l_quantity: no number in 5-45' END,
          CASE WHEN (l_linenumber BETWEEN 1 AND 6) IS NOT TRUE THEN 'l_linenumber: no whole number in 1-6' END,
          CASE WHEN (l_extendedprice BETWEEN 1000 AND 90000) IS NOT TRUE THEN 'l_extendedprice: no number in 1000-90000' END,
          CASE WHEN (lower(trim(l_returnflag)) IN ('y', 'yes', '1', 'n', 'no', '0')) IS NOT TRUE THEN 'l_returnflag: not yes or no' END
        ) AS rejected FROM lineitem) SELECT *, rejected = '' AS accepted FROM checked""",
    "yes_no_tokens": """SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'signup' THEN 1 WHEN 'view' THEN 0
        WHEN 'purchase' THEN 0 END AS flag, event_id % 3 + 1 AS menu_code FROM events""",
    "drift_flags": """WITH z AS (SELECT event_id, (value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events) AS z
        FROM events) SELECT event_id, 'value' AS feature, round(z, 6) AS z FROM z WHERE abs(z) > 6""",
    "align_columns": "SELECT CAST(0 AS DOUBLE) AS o_totalprice, o_orderkey, 0 AS unseen FROM orders",
    "score_fixed": SCORE_OUT,
    "score_reloaded": SCORE_OUT,
    "stream_score": SCORE_OUT,
    "top_contrib": TOP_CONTRIB,
    "advice_lines": ADVICE,
    "outlier_threshold": """WITH q AS (SELECT quantile_cont(value, 0.95) AS t FROM events)
        SELECT round(max(t), 6) AS threshold, count(*) FILTER (WHERE value <= t) AS kept,
               count(*) FILTER (WHERE value > t) AS removed FROM events, q""",
    "preview_head": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "run_summary": f"""WITH {RULE_METRICS}, {LINES}
        SELECT count(*) AS row_count, count(*) FILTER (WHERE target = 0) AS kept_orders,
               count(*) FILTER (WHERE target = 1) AS returned_orders,
               (SELECT model FROM scores ORDER BY f1 DESC, model LIMIT 1) AS best_f1_model,
               (SELECT round(max(f1), 6) FROM scores) AS best_f1 FROM features""",
}


# --- fitted models ----------------------------------------------------------------------

_FLAG_SPLIT = LINES + """,
flags AS (SELECT order_id, CAST(coalesce(n_lines, 0) >= 4 AS INT) AS target, """ + ", ".join(f"coalesce({c}, 0) AS {c}" for c in O.FLAGS) + """ FROM features),
counts AS (SELECT target AS c, count(*) AS n FROM flags GROUP BY target),
total AS (SELECT sum(n) AS t, sum(n) - ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS train FROM counts),
exact AS (SELECT c, n, train, CAST(train AS DOUBLE) * n / t AS e FROM counts, total),
placed AS (SELECT *, row_number() OVER (ORDER BY e - floor(e) DESC, c) AS pos, train - sum(floor(e)) OVER () AS spare FROM exact),
quota AS (SELECT c, n - floor(e) - CASE WHEN pos <= spare THEN 1 ELSE 0 END AS q FROM placed),
marked AS (
  SELECT f.*, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(order_id AS VARCHAR)), order_id) <= q AS is_test
  FROM flags f JOIN quota ON c = target)"""


def _stump(names: list[str], prefix: str = "") -> str:
    """Best single flag by gini, and every test row with the share of ones on its side."""
    sides = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS pos, {c} AS side, count(*) AS n, sum(target) AS ones FROM marked WHERE NOT is_test GROUP BY {c}"
        for i, c in enumerate(names))
    side = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in names) + " END"
    return f"""
{prefix}sides AS ({sides}),
{prefix}gains AS (SELECT feature, pos, sum(n * 2 * (ones / n) * (1 - ones / n)) AS impurity FROM {prefix}sides GROUP BY feature, pos HAVING count(*) > 1),
{prefix}best AS (SELECT feature FROM {prefix}gains ORDER BY impurity, pos LIMIT 1),
{prefix}scored AS (
  SELECT order_id, target, s.ones / s.n AS p FROM marked m, {prefix}best b JOIN {prefix}sides s USING (feature)
  WHERE is_test AND s.side = ({side}))"""


def _stump_metrics(name: str, prefix: str = "") -> str:
    return f"""
  SELECT '{name}' AS model, avg(CASE WHEN target = y THEN 1.0 ELSE 0.0 END) AS accuracy,
         coalesce(CAST(sum(target * y) AS DOUBLE) / nullif(sum(y), 0), 0) AS precision,
         coalesce(CAST(sum(target * y) AS DOUBLE) / nullif(sum(target), 0), 0) AS recall,
         coalesce(CAST(2 * sum(target * y) AS DOUBLE) / nullif(sum(target) + sum(y), 0), 0) AS f1
  FROM (SELECT target, CAST(p > 0.5 AS INT) AS y FROM {prefix}scored)"""


_ONE = ("open_lines", "bulk", "urgent")
_COMPARED = f"WITH {_FLAG_SPLIT}, " + ", ".join(_stump([c], f"{c}_") for c in _ONE) + ", compared AS (" + " UNION ALL ".join(
    _stump_metrics(c, f"{c}_") for c in _ONE) + ")"
_BEST_STUMP = """(SELECT model FROM compared ORDER BY accuracy DESC, model LIMIT 1) AS best_accuracy_model,
    (SELECT round(max(accuracy), 6) FROM compared) AS best_accuracy"""
_SLOPES = f"WITH {IMPUTED}, slopes AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, regr_slope(target, {c}) AS s FROM filled" for c in O.NUMERIC) + ")"


def _lloyd(start: str, steps: int, prefix: str = "") -> str:
    """Passes from ``start`` (cluster, i, v) over ``cells``; the last assignment is ``{prefix}near``."""
    out, centers = [], start
    for step in range(steps + 1):
        near = f"{prefix}n{step}" if step < steps else f"{prefix}near"
        out.append(f"""{near} AS (
  SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT vec_id, cluster, sum((c.v - k.v) * (c.v - k.v)) AS d FROM cells c JOIN {centers} k USING (i) GROUP BY vec_id, cluster) GROUP BY vec_id)""")
        if step < steps:
            centers = f"{prefix}c{step + 1}"
            out.append(f"{centers} AS (SELECT cluster, i, avg(v) AS v FROM {near} JOIN cells USING (vec_id) GROUP BY cluster, i)")
    return ",\n".join(out)


_CELLS = """
cells AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
classes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS cluster FROM (SELECT DISTINCT label FROM embeddings)),
starts AS (SELECT cluster, i, avg(v) AS v FROM cells JOIN classes USING (label) GROUP BY cluster, i)"""
_ELBOW = f"WITH {_CELLS}, " + ", ".join(
    f"s{k} AS (SELECT * FROM starts WHERE cluster < {k}), " + _lloyd(f"s{k}", 4, f"k{k}_") for k in range(2, 6)) + ", costs AS (" + " UNION ALL ".join(
    f"SELECT {k} AS k, sum(d) AS wcss FROM k{k}_near" for k in range(2, 6)) + ")"

ORACLE |= {
    "classify_stump": f"WITH {_FLAG_SPLIT}, {_stump(O.FLAGS)}, m AS ({_stump_metrics('Stump')}) "
    f"SELECT model, {_rnd(['accuracy', 'precision', 'recall', 'f1'], 6)} FROM m",
    "stump_importance": f"WITH {_FLAG_SPLIT}, {_stump(O.FLAGS)} SELECT feature, importance FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST((SELECT count(*) FROM best WHERE feature = '{c}') AS DOUBLE) AS importance" for c in O.FLAGS)
    + ") ORDER BY importance DESC, feature LIMIT 3",
    "stump_risk": f"""WITH {_FLAG_SPLIT}, {_stump(O.FLAGS)}, t AS (SELECT order_id, round_even(p * 100, 1) AS s, target FROM scored)
        SELECT order_id, s AS predicted_risk_score, {BAND_RIGHT} AS risk_band, CAST(target AS INT) AS actual_target FROM t""",
    "compare_stumps": f"{_COMPARED} SELECT {_BEST_STUMP}",
    "top_slopes_positive": f"{_SLOPES} SELECT feature FROM slopes ORDER BY s DESC, feature LIMIT 2",
    "top_slopes_negative": f"{_SLOPES} SELECT feature FROM slopes ORDER BY s, feature LIMIT 2",
    "kmeans_lloyd": f"""WITH {_CELLS}, {_lloyd('starts', 4)},
rates AS (SELECT cluster, avg(CAST(label % 2 = 0 AS INT)) AS rate FROM near JOIN embeddings USING (vec_id) GROUP BY cluster),
ranks AS (SELECT cluster, row_number() OVER (ORDER BY rate, cluster) AS risk_rank, count(*) OVER () AS n FROM rates)
SELECT CAST(cluster AS INT) AS cluster, CAST(i AS VARCHAR) AS feature, round(v, 6) + 0 AS value, CAST(risk_rank AS INT) AS risk_rank,
  CASE CAST(floor((risk_rank - 1) * 2 / greatest(n - 1, 1) + CAST(0.5 AS DOUBLE)) AS INT) WHEN 0 THEN 'Low Risk' WHEN 1 THEN 'Medium Risk' ELSE 'High Risk' END AS risk_label
FROM c4 JOIN ranks USING (cluster)""",
    "elbow_lloyd": f"""{_ELBOW} SELECT k, round(wcss, 6) AS wcss, round(wcss / (SELECT wcss FROM costs WHERE k = 2), 6) AS ratio_to_first FROM costs""",
    "iforest_fixed": """WITH b AS (
  SELECT o_orderkey AS order_id,
    (CASE WHEN o_totalprice <= 100000 THEN CASE WHEN c_acctbal <= 0 THEN CAST(2 AS DOUBLE) ELSE CAST(4.25 AS DOUBLE) END ELSE CAST(1.5 AS DOUBLE) END
     + CASE WHEN c_acctbal <= 5000 THEN CAST(3.5 AS DOUBLE) WHEN o_totalprice <= 250000 THEN CAST(2.75 AS DOUBLE) ELSE CAST(2 AS DOUBLE) END) / 2 AS path
  FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT order_id, pow(2, -path / (2 * (ln(CAST(255 AS DOUBLE)) + CAST(0.5772156649015329 AS DOUBLE)) - CAST(2 * 255 AS DOUBLE) / 256)) AS a FROM b)
SELECT order_id, round(a, 6) AS score FROM s WHERE round(a, 9) <= round((SELECT quantile_cont(a, 0.9) FROM s), 9)""",
    "pca_reduced": """WITH t AS (SELECT (4 * CAST(count(*) AS DOUBLE)) / (count(*) - 1) AS trace,
  corr(l_quantity, l_extendedprice) * count(*) / (count(*) - 1) AS c FROM lineitem)
SELECT component, CAST(0 AS DOUBLE) AS residual, CAST(1 AS DOUBLE) AS length, round(trace, 5) AS trace, round(c, 5) + 0 AS corr
FROM t, (SELECT unnest(['pc1', 'pc2']) AS component)""",
    "dedup_copies": "SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem",
    "olap_stored": f"WITH {STAR} " + " UNION ALL ".join(
        f"SELECT '{by}' AS level, CAST({by} AS VARCHAR) AS value, round(avg(target), 4) AS return_rate, count(*) AS order_count, "
        f"round(avg(risk_score), 4) AS avg_risk_score FROM keyed GROUP BY {by}" for by in ("segment", "nation", "status", "priority")),
    "one_hot_sparse": "SELECT o_orderkey, o_custkey, nullif(dense_rank() OVER (ORDER BY o_custkey) - 1, 0) - 1 AS o_custkey_index, "
    "(SELECT count(DISTINCT o_custkey) - 1 FROM orders) AS o_custkey_size FROM orders",
    "csv_mixed": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "csv_bom": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "star_defaults": f"""WITH {LINES} SELECT row_number() OVER (ORDER BY order_id) AS flags_id, CAST(coalesce(open_lines, 0) AS INT) AS open_lines,
        CAST(coalesce(bulk, 0) AS INT) AS bulk, CAST(coalesce(high_tax, 0) AS INT) AS high_tax FROM features""",
    "run_quality": f"""{_COMPARED}, reg AS ({REGRESS_SIMPLE})
        SELECT (SELECT count(*) FROM orders) AS row_count, {_BEST_STUMP}, (SELECT rmse FROM reg) AS rmse, (SELECT r2 FROM reg) AS r2""",
}



def _wide_sets(least: float, longest: int = 7) -> str:
    """CTEs up to ``found`` (items, freq, support): frequent sets by joins of baskets with their items, level by level."""
    out = [f"""
rows_ AS (
  SELECT DISTINCT l_orderkey AS b, unnest([p_brand, l_returnflag, 'month ' || month(l_shipdate)]) AS item
  FROM lineitem JOIN part ON l_partkey = p_partkey),
total AS (SELECT CAST(count(DISTINCT b) AS DOUBLE) AS n FROM rows_),
f1 AS (SELECT [item] AS items, count(*) AS freq FROM rows_ GROUP BY item HAVING count(*) / (SELECT n FROM total) >= CAST({least} AS DOUBLE)),
h1 AS (SELECT b, [item] AS items FROM rows_ WHERE [item] IN (SELECT items FROM f1))"""]
    for k in range(2, longest + 1):
        out.append(f"""
g{k} AS (SELECT h.b, list_append(h.items, o.items[1]) AS items FROM h{k - 1} h JOIN h1 o ON o.b = h.b AND o.items[1] > h.items[-1]),
f{k} AS (SELECT items, count(*) AS freq FROM g{k} GROUP BY items HAVING count(*) / (SELECT n FROM total) >= CAST({least} AS DOUBLE)),
h{k} AS (SELECT g{k}.* FROM g{k} SEMI JOIN f{k} USING (items))""")
    every = " UNION ALL ".join(f"SELECT * FROM f{k}" for k in range(1, longest + 1))
    return ",".join(out) + f""",
found AS (SELECT items, freq, freq / (SELECT n FROM total) AS support FROM ({every}))"""


ORACLE |= {
    "itemsets_wide": f"WITH {_wide_sets(0.04)} SELECT array_to_string(items, ',') AS items, freq, len(items)::INT AS n_items, round_even(support, 6) AS support FROM found",
    "rules_wide": f"""WITH {_wide_sets(0.04)},
masks AS (SELECT items, support, unnest(range(1, (1 << len(items)) - 1)) AS m FROM found WHERE len(items) > 1),
sides AS (SELECT support, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS a, list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 0) AS c FROM masks)
SELECT array_to_string(s.a, ',') AS antecedents, array_to_string(s.c, ',') AS consequents, round_even(s.support, 6) AS support,
  round_even(s.support / x.support, 6) AS confidence, round_even(s.support / x.support / y.support, 6) AS lift
FROM sides s JOIN found x ON x.items = s.a JOIN found y ON y.items = s.c WHERE s.support / x.support >= 0.5::DOUBLE""",
    "rules_none": """SELECT '' AS antecedents, '' AS consequents, 0::DOUBLE AS support, 0::DOUBLE AS confidence, 0::DOUBLE AS lift
WHERE (SELECT max(n) / sum(1) FROM (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)) < 0""",
}


def _shares(cells: str, steps: int = 4000) -> str:
    """Explained shares of two components of a covariance matrix, rows (i, j, v), by power iteration and deflation."""
    def walk(name: str, m: str) -> str:
        return f"""
{name} AS (
  SELECT 0 AS step, m, list_transform(m, lambda r, i: 1 + i::DOUBLE / 7) AS v FROM {m}
  UNION ALL
  SELECT step + 1, m, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w)))
  FROM (SELECT step, m, list_transform(m, lambda r: list_inner_product(r, v)) AS w FROM {name} WHERE step < {steps})),
{name}_end AS (SELECT m, v, list_inner_product(v, list_transform(m, lambda r: list_inner_product(r, v))) AS e FROM {name} WHERE step = {steps})"""

    return f"""lines_ AS (SELECT i, list(v ORDER BY j) AS r FROM ({cells}) GROUP BY i), matrix AS (SELECT list(r ORDER BY i) AS m FROM lines_),
trace AS (SELECT sum(r[i + 1]) AS t FROM lines_),{walk('a', 'matrix')},
rest AS (SELECT list_transform(m, lambda r, i: list_transform(r, lambda x, j: x - e * v[i] * v[j])) AS m FROM a_end),{walk('b', 'rest')}
SELECT 'pc1' AS component, round((SELECT e FROM a_end) / t, 6) AS explained_ratio FROM trace
UNION ALL SELECT 'pc2', round((SELECT e FROM b_end) / t, 6) FROM trace"""


_CORRELATIONS = " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, {f'corr({a}, {b})' if i != j else 'any_value(1::DOUBLE)'} AS v FROM filled" for i, a in enumerate(O.NUMERIC) for j, b in enumerate(O.NUMERIC))
ORACLE |= {
    "pca_measures": f"WITH RECURSIVE {IMPUTED}, {_shares(_CORRELATIONS)}",
    "pca_embeddings": "WITH RECURSIVE cells AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), "
    + _shares("SELECT x.i AS i, y.i AS j, covar_samp(x.v, y.v) AS v FROM cells x JOIN cells y USING (vec_id) GROUP BY x.i, y.i"),
    "mode_many": f"SELECT feature, CAST(fill AS BIGINT) AS fill FROM ({_modes('lineitem', ['l_partkey', 'l_suppkey', 'l_orderkey'])})",
}
ORACLE |= model_sql(LINES, {"trees": 6, "max_depth": 3})
