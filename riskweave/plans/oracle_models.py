"""SQL that fits the models of the registered queries again: trees, forests and logistic regression."""

from __future__ import annotations

from riskweave.operators import forest as R
from riskweave.plans import orders as O

DUMMIES = {
    "status": ["O", "P"], "priority": ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "segment": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}
COLUMNS = [*O.NUMERIC, *O.FLAGS, *[f"{c}_{v}" for c, values in DUMMIES.items() for v in values]]


def _mode(c: str) -> str:
    return f"(SELECT {c} FROM features WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def tree_rows(lines: str) -> str:
    """CTEs up to ``marked``: imputed, rounded and encoded orders with their side of the split by target."""
    measures = [f"round_even(coalesce({c}, (SELECT avg({c}) FROM features)), 6) AS {c}" for c in O.NUMERIC]
    flags = [f"coalesce({c}, {_mode(c)}) AS {c}" for c in O.FLAGS]
    dummies = [f"""CAST(coalesce({c} = '{v}', false) AS INT) AS "{c}_{v}\"""" for c, values in DUMMIES.items() for v in values]
    return f"""{lines},
flat AS (SELECT order_id, target, {', '.join([*measures, *flags, *dummies])} FROM features),
counts AS (SELECT target AS c, count(*) AS n FROM flat GROUP BY target),
total AS (SELECT sum(n) AS t, sum(n) - ceil(CAST(0.2 AS DOUBLE) * sum(n)) AS train FROM counts),
exact AS (SELECT c, n, train, CAST(train AS DOUBLE) * n / t AS e FROM counts, total),
placed AS (SELECT *, row_number() OVER (ORDER BY e - floor(e) DESC, c) AS pos, train - sum(floor(e)) OVER () AS spare FROM exact),
quota AS (SELECT c, n - floor(e) - CASE WHEN pos <= spare THEN 1 ELSE 0 END AS q FROM placed),
marked AS (
  SELECT f.*, row_number() OVER (PARTITION BY target ORDER BY md5(CAST(order_id AS VARCHAR)), order_id) <= q AS is_test
  FROM flat f JOIN quota ON c = target)"""


def _drawn(a: str, b: str, bits: int = 32) -> str:
    """The number that ``forest.draw`` (of 32 bits) or ``forest.draw64`` takes from two whole numbers."""
    big = "18446744073709551616::UHUGEINT"

    def mixed(z: str) -> str:
        return f"((xor(({z})::UBIGINT, ({z})::UBIGINT >> 32)::UHUGEINT * {R.MIX_FACTOR}::UHUGEINT) % {big})"

    start = f"((({a})::UHUGEINT * {R.KEY_FACTOR}::UHUGEINT % {big} + ({b})::UHUGEINT * {R.TREE_FACTOR}::UHUGEINT % {big}) % {big})"
    return f"({mixed(mixed(start))} // {2 ** (64 - bits)})::UBIGINT"


def grown(source: str, key: str, label: str, columns: list[str], trees: int, depth: int, bins: int, usable: int, bagged: bool,
          seed: int = R.SEED, cells: int = R.CELLS) -> str:
    """CTEs up to ``nodes`` (tree, node, f, code, n0, n1; NULL f: leaf), ``cuts`` and ``paths`` of trees fitted to the rows of ``source``
    that are no test rows. Crowded cells are counted again once, which is enough for columns without long tails."""
    long = " UNION ALL ".join(f"""SELECT {key} AS k, {i} AS f, CAST("{c}" AS DOUBLE) AS v, is_test FROM {source}""" for i, c in enumerate(columns))
    weight = " + ".join(f"CAST(u >= {t} AS INT)" for t in R.POISSON) if bagged else "1"
    drawn = _drawn("k", f"{seed * 1000 + 1} + tree")
    out = [f"""long AS ({long}),
ends AS (SELECT f, min(v) AS lo, max(v) AS hi FROM long WHERE NOT is_test GROUP BY f),
cells0 AS (
  SELECT f, CASE WHEN hi > lo THEN least(floor((v - lo) / (hi - lo) * {cells}), {cells - 1}) ELSE 0 END AS cell, count(*) AS n, min(v) AS lowest, max(v) AS most
  FROM long JOIN ends USING (f) WHERE NOT is_test GROUP BY ALL),
sized AS (SELECT *, sum(n) OVER (PARTITION BY f) AS t FROM cells0),
crowded AS (SELECT * FROM sized WHERE n * {bins} > 2 * t AND lowest < most),
cells AS (
  SELECT f, n, most, t FROM sized WHERE NOT (n * {bins} > 2 * t AND lowest < most)
  UNION ALL
  SELECT f, count(*), max(v), any_value(t) FROM (
    SELECT c.f, c.cell, t, v, least(floor((v - lowest) / (most - lowest) * {cells}), {cells - 1}) AS part
    FROM crowded c JOIN long l ON l.f = c.f AND v BETWEEN lowest AND most WHERE NOT is_test) GROUP BY f, cell, part),
upto AS (SELECT f, most, t, sum(n) OVER (PARTITION BY f ORDER BY most) AS u FROM cells),
steps AS (SELECT *, (u * {bins}) // t AS step, lag((u * {bins}) // t, 1, 0) OVER (PARTITION BY f ORDER BY most) AS before FROM upto),
cuts AS (SELECT f, most AS cut, row_number() OVER (PARTITION BY f ORDER BY most) - 1 AS code FROM steps WHERE step > before AND u < t),
codes AS MATERIALIZED (
  SELECT k, l.f, count(cut) AS code FROM long l LEFT JOIN cuts c ON c.f = l.f AND c.cut < l.v WHERE NOT is_test GROUP BY k, l.f),
rows0 AS (
  SELECT k, tree, y, CAST({weight} AS BIGINT) AS w, 1::BIGINT AS node
  FROM (SELECT {key} AS k, {label} AS y, tree, {drawn if bagged else '0'} AS u FROM (SELECT {key}, {label}, {key} AS k FROM {source} WHERE NOT is_test),
        (SELECT unnest(range({trees})) AS tree)))"""]
    for d in range(depth):
        order = _drawn(f"(node << 16) + f", f"{seed * 1000 + 1} + tree")
        out.append(f"""
sums{d} AS (
  SELECT tree, node, f, code, sum(w * (1 - y))::DOUBLE AS a, sum(w * y)::DOUBLE AS b FROM rows{d} JOIN codes USING (k) WHERE w > 0 GROUP BY ALL),
sides{d} AS (
  SELECT tree, node, f, code, sum(a) OVER s AS l0, sum(b) OVER s AS l1, sum(a) OVER p AS n0, sum(b) OVER p AS n1 FROM sums{d}
  WINDOW s AS (PARTITION BY tree, node, f ORDER BY code), p AS (PARTITION BY tree, node, f)),
able{d} AS (
  SELECT *, dense_rank() OVER (PARTITION BY tree, node ORDER BY {order if usable < len(columns) else 'f'}, f) AS place
  FROM sides{d} WHERE n0 > 0 AND n1 > 0 AND l0 + l1 < n0 + n1),
best{d} AS (
  SELECT tree, node, f, code FROM able{d} WHERE place <= {usable}
  QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY
    (l0 * l0 + l1 * l1) / (l0 + l1) + ((n0 - l0) * (n0 - l0) + (n1 - l1) * (n1 - l1)) / (n0 + n1 - l0 - l1) DESC, f, code) = 1),
rows{d + 1} AS (
  SELECT k, tree, y, w, 2 * node + CAST(c.code > best{d}.code AS INT) AS node
  FROM rows{d} JOIN best{d} USING (tree, node) JOIN codes c USING (k, f) WHERE w > 0)""")
    every = " UNION ALL ".join(f"SELECT tree, node, sum(w * (1 - y)) AS n0, sum(w * y) AS n1 FROM rows{d} GROUP BY tree, node" for d in range(depth + 1))
    best = " UNION ALL ".join(f"SELECT * FROM best{d}" for d in range(depth))
    out.append(f"""
nodes AS (SELECT tree, node, f, code, n0, n1 FROM ({every}) LEFT JOIN ({best}) USING (tree, node))""")
    return ",".join(out)


def node_table(columns: list[str]) -> str:
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(columns))
    return f"""SELECT tree::INT AS tree, node, CASE n.f {names} END AS feature, round(c.cut, 6) AS cut, n0::BIGINT AS n0, n1::BIGINT AS n1
FROM nodes n LEFT JOIN cuts c ON c.f = n.f AND c.code = n.code"""


def predicted(depth: int, trees: int) -> str:
    """CTEs ``scored`` (k, p) of the test rows by ``nodes`` and ``cuts``."""
    out = [f"at0 AS (SELECT DISTINCT k, tree, 1::BIGINT AS node FROM long, (SELECT unnest(range({trees})) AS tree) WHERE is_test)"]
    for d in range(depth):
        out.append(f"""
at{d + 1} AS (
  SELECT a.k, a.tree, CASE WHEN n.f IS NULL THEN a.node ELSE 2 * a.node + CAST(l.v > c.cut AS INT) END AS node
  FROM at{d} a JOIN nodes n USING (tree, node) LEFT JOIN cuts c ON c.f = n.f AND c.code = n.code LEFT JOIN long l ON l.k = a.k AND l.f = n.f)""")
    out.append(f"""
scored AS (SELECT k, avg(n1 / (n0 + n1)) AS p FROM at{depth} JOIN nodes USING (tree, node) GROUP BY k)""")
    return ",".join(out)


def quality(name: str, rows: str) -> str:
    """Metrics of ``rows`` (target, y)."""
    share = lambda a, b: f"round(coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0), 6)"
    return f"""SELECT '{name}' AS model, {share('sum(CAST(target = y AS INT))', 'count(*)')} AS accuracy, {share('sum(target * y)', 'sum(y)')} AS precision,
  {share('sum(target * y)', 'sum(target)')} AS recall, {share('2 * sum(target * y)', 'sum(target) + sum(y)')} AS f1 FROM ({rows})"""


def newton(source: str, columns: list[str], label: str, steps: int = 8) -> str:
    """CTEs up to ``beta``: weights (w1, w2, w0) of two columns and an intercept, by Newton steps with penalty 1 and Cramer's rule."""
    a, b = columns
    out = [f"beta0 AS (SELECT 0::DOUBLE AS w1, 0::DOUBLE AS w2, ln(avg({label}) / (1 - avg({label}))) AS w0 FROM {source})"]
    for d in range(steps):
        det = lambda m: (f"({m[0]} * ({m[4]} * {m[8]} - {m[5]} * {m[7]}) - {m[1]} * ({m[3]} * {m[8]} - {m[5]} * {m[6]})"  # noqa: E731
                         f" + {m[2]} * ({m[3]} * {m[7]} - {m[4]} * {m[6]}))")
        m = ["h11", "h12", "h10", "h12", "h22", "h20", "h10", "h20", "h00"]
        column = lambda j: [f"g{'120'[i // 3]}" if i % 3 == j else c for i, c in enumerate(m)]
        out.append(f"""
at{d} AS (SELECT {a} AS x1, {b} AS x2, {label} AS y, w1, w2, w0, 1 / (1 + exp(-(w0 + w1 * {a} + w2 * {b}))) AS p FROM {source}, beta{d}),
sum{d} AS (
  SELECT any_value(w1) AS w1, any_value(w2) AS w2, any_value(w0) AS w0,
    sum((p - y) * x1) + any_value(w1) AS g1, sum((p - y) * x2) + any_value(w2) AS g2, sum(p - y) AS g0,
    sum(p * (1 - p) * x1 * x1) + 1 AS h11, sum(p * (1 - p) * x1 * x2) AS h12, sum(p * (1 - p) * x1) AS h10,
    sum(p * (1 - p) * x2 * x2) + 1 AS h22, sum(p * (1 - p) * x2) AS h20, sum(p * (1 - p)) AS h00 FROM at{d}),
beta{d + 1} AS (SELECT w1 - {det(column(0))} / {det(m)} AS w1, w2 - {det(column(1))} / {det(m)} AS w2, w0 - {det(column(2))} / {det(m)} AS w0 FROM sum{d})""")
    out.append(f"\nbeta AS (SELECT * FROM beta{steps})")
    return ",".join(out)


def isolation(columns: list[str], source: str, key: str, depth: int, trees: int, psi: int, seed: int) -> str:
    """Rows (key, score) by isolation trees that are grown again: bottom draws as samples, drawn columns and cuts."""
    path = lambda n: f"CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1::DOUBLE ELSE 2 * (ln(({n} - 1)::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1)::DOUBLE / {n} END"
    b = f"{seed * 1000 + 1} + tree"
    long = " UNION ALL ".join(f"SELECT {key} AS k, {i} AS f, CAST({c} AS DOUBLE) AS v FROM {source}" for i, c in enumerate(columns))
    out = [f"""long AS MATERIALIZED ({long}), trees AS (SELECT unnest(range({trees})) AS tree),
s0 AS (SELECT {key} AS k, tree, 1::BIGINT AS node FROM {source}, trees
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {_drawn(key, b, 64)}, {key}) <= {psi}),
a0 AS (SELECT {key} AS k, tree, 1::BIGINT AS node, NULL::DOUBLE AS path FROM {source}, trees)"""]
    for d in range(depth):
        out.append(f"""
e{d} AS (
  SELECT tree, node, f, lo, hi, row_number() OVER (PARTITION BY tree, node ORDER BY f) - 1 AS pos, count(*) OVER (PARTITION BY tree, node) AS able
  FROM (SELECT tree, node, f, min(v) AS lo, max(v) AS hi FROM s{d} JOIN long USING (k) GROUP BY ALL HAVING max(v) > min(v))),
c{d} AS (
  SELECT tree, node, f, CASE WHEN cut >= hi THEN lo ELSE cut END AS cut
  FROM (SELECT *, lo + (hi - lo) * ({_drawn('(node << 16) + 1', b)}::DOUBLE / 4294967296) AS cut FROM e{d} WHERE pos = {_drawn('node << 16', b)} % able)),
n{d} AS (SELECT tree, node, count(*) AS n FROM s{d} GROUP BY tree, node),
s{d + 1} AS (SELECT k, tree, 2 * node + CAST(v > cut AS INT) AS node FROM s{d} JOIN c{d} USING (tree, node) JOIN long USING (k, f)),
a{d + 1} AS (
  SELECT a.k, a.tree, CASE WHEN cut IS NULL THEN a.node ELSE 2 * a.node + CAST(v > cut AS INT) END AS node,
    CASE WHEN path IS NOT NULL THEN path WHEN cut IS NULL THEN {d} + {path('n')} END AS path
  FROM a{d} a LEFT JOIN c{d} c ON c.tree = a.tree AND c.node = a.node LEFT JOIN long l ON l.k = a.k AND l.f = c.f
  LEFT JOIN n{d} n ON n.tree = a.tree AND n.node = a.node)""")
    out.append(f"""
last AS (SELECT tree, node, {depth} + {path('count(*)')} AS end_ FROM s{depth} GROUP BY tree, node)""")
    return ",".join(out) + f"""
SELECT k AS {key}, round(pow(2::DOUBLE, -avg(coalesce(path, end_)) / ({path(psi)})), 6) AS score
FROM a{depth} LEFT JOIN last USING (tree, node) GROUP BY k"""


def model_sql(lines: str, small: dict[str, int]) -> dict[str, str]:
    rows = tree_rows(lines)
    one = "WITH " + rows + ",\n" + grown("marked", "order_id", "target", COLUMNS, 1, 5, 128, len(COLUMNS), False)
    many = "WITH " + rows + ",\n" + grown(
        "marked", "order_id", "target", COLUMNS, small["trees"], small["max_depth"], 64, int(len(COLUMNS) ** 0.5), True)
    gains = """inner_ AS (
  SELECT n.f, (n.n0 + n.n1 - (n.n0 * n.n0 + n.n1 * n.n1)::DOUBLE / (n.n0 + n.n1)) - (a.n0 + a.n1 - (a.n0 * a.n0 + a.n1 * a.n1)::DOUBLE / (a.n0 + a.n1))
    - (b.n0 + b.n1 - (b.n0 * b.n0 + b.n1 * b.n1)::DOUBLE / (b.n0 + b.n1)) AS g
  FROM nodes n JOIN nodes a ON a.node = 2 * n.node JOIN nodes b ON b.node = 2 * n.node + 1 WHERE n.f IS NOT NULL)"""
    names = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature" for i, c in enumerate(COLUMNS))
    tested = "SELECT target, CAST(p > 0.5 AS INT) AS y FROM scored JOIN marked ON order_id = k"
    slopes = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST(0 AS DOUBLE) AS gradient" for c in [*COLUMNS, "intercept"])
    return {
        "decision_tree_nodes": f"{one} {node_table(COLUMNS)}",
        "dt_importance": f"{one}, {gains} SELECT feature, round(coalesce((SELECT sum(g) FROM inner_ i WHERE i.f = m.f), 0) / (SELECT sum(g) FROM inner_), 6) AS importance FROM ({names}) m",
        "classify_dt": f"{one}, {predicted(5, 1)} {quality('Decision Tree', tested)}",
        "forest_nodes": f"{many} {node_table(COLUMNS)}",
        "forest_risk": f"{many}, {predicted(small['max_depth'], small['trees'])} SELECT k AS order_id, round(p, 6) AS probability, CAST(p > 0.5 AS INT) AS prediction FROM scored",
        "iforest_grown": "WITH o AS (SELECT o_orderkey, o_totalprice, coalesce(c_acctbal, 0) AS c_acctbal, o_custkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey), "
        + isolation(["o_totalprice", "c_acctbal", "o_custkey"], "o", "o_orderkey", 2, 12, 100, 7),
        "regress_normal": " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CAST(0 AS DOUBLE) AS residual" for c in [*COLUMNS, "intercept"] if c != "totalprice"),
        "logistic_gradient": slopes,
        "logistic_weights": f"""WITH {rows}, train AS (SELECT n_lines / 4 AS lines, qty / 100 AS quantity, target FROM marked WHERE NOT is_test),
{newton('train', ['lines', 'quantity'], 'target')}
SELECT unnest(['lines', 'quantity', 'intercept']) AS feature, unnest([round(w1, 6), round(w2, 6), round(w0, 6)]) AS weight FROM beta""",
    }
