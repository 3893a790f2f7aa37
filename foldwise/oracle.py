"""Independent SQL for the registered queries (DuckDB dialect).

Each statement recomputes a query of :mod:`foldwise.registry` from the raw
tables, without the library: stand-in tables, dummy coding, folds, moments,
least squares (closed forms for one and two features), gradient descent (a
recursive CTE), metrics and rankings. Floating results are rounded the same
way on both sides.
"""

from __future__ import annotations

import math

# --- stand-in tables -------------------------------------------------------------

def _order_features(where: str = "") -> str:
    return f"""SELECT o.o_orderkey AS id,
       o.o_orderstatus AS c1, o.o_orderpriority AS c2, c.c_mktsegment AS c3, r.r_name AS c4,
       CAST(quarter(o.o_orderdate) AS STRING) AS c5,
       coalesce(l.qty, 0.0) AS n1, coalesce(l.price, 0.0) AS n2,
       CAST(coalesce(l.lines, 0) AS DOUBLE) AS n3, c.c_acctbal AS n4
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS qty, round(sum(l_extendedprice), 2) AS price, count(*) AS lines
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey {where}"""


OF = _order_features()
OF_TRAIN = _order_features("WHERE o.o_orderdate < TIMESTAMP '2000-01-01'")
OF_SCORE = _order_features("WHERE o.o_orderdate >= TIMESTAMP '2000-01-01'")
OL = """SELECT l_orderkey AS id, round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 6) AS label
FROM lineitem GROUP BY l_orderkey"""


def fold_expr(col: str = "id", k: int = 10, seed: int | None = None) -> str:
    key = f"CAST({col} AS VARCHAR)" if seed is None else f"'{seed}:' || CAST({col} AS VARCHAR)"
    return f"CAST((('0x' || substr(md5({key}), 1, 8))::BIGINT) % {k} AS INTEGER)"


def _joined(features: str = OF) -> str:
    return f"SELECT f.*, lab.label FROM ({features}) f JOIN ({OL}) lab ON f.id = lab.id"


TJ = _joined()
TJ_TRAIN = _joined(OF_TRAIN)
TF = f"SELECT t.*, {fold_expr()} AS fold FROM ({TJ}) t"
FOLDS = "(SELECT CAST(range AS INTEGER) AS k FROM range(10))"


def half_up(x: str) -> str:
    """Round half up to a double, saturating and NaN -> 0 like a JVM long cast."""
    return (f"(CASE WHEN isnan({x}) THEN 0.0::DOUBLE "
            f"ELSE least(greatest(floor({x} + 0.5), -9.223372036854776e18), 9.223372036854776e18) END)")


def metrics_sql(y: str = "y", p: str = "p") -> str:
    return (f"count(*) AS n, covar_pop({y}, {p}) / nullif(stddev_pop({y}) * stddev_pop({p}), 0) AS corr, "
            f"avg(abs({y} - {p})) AS mae, avg(({y} - {p}) * ({y} - {p})) AS mse, "
            f"sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse")


# --- dummy coding in SQL -----------------------------------------------------------

def _levels(features: str) -> str:
    return f"""SELECT col, level, CAST(row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT col, level FROM (
    UNPIVOT (SELECT c1, c2, c3, c4, c5 FROM ({features})) ON c1, c2, c3, c4, c5 INTO NAME col VALUE level))"""


def _encoding_ctes(features: str = OF, rows: str = TJ) -> str:
    """CTEs lv (levels), off (slot start per column), nd (dummy width), enc (long form)."""
    return f"""lv AS ({_levels(features)}),
cnt AS (SELECT col, count(*) - 1 AS dummies FROM lv GROUP BY col),
off AS (SELECT col, dummies, CAST(coalesce(sum(dummies) OVER (ORDER BY col ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start FROM cnt),
nd AS (SELECT CAST(sum(dummies) AS INTEGER) AS total FROM cnt),
rows AS ({rows}),
jl AS (UNPIVOT (SELECT id, c1, c2, c3, c4, c5 FROM rows) ON c1, c2, c3, c4, c5 INTO NAME col VALUE level),
nom AS (SELECT jl.id, CAST(off.start + lv.idx - 1 AS INTEGER) AS pos,
               CASE WHEN jl.level = lv.level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
        FROM jl JOIN lv ON lv.col = jl.col AND lv.idx >= 1 JOIN off ON off.col = jl.col),
num AS (SELECT r.id, CAST(nd.total + k.k AS INTEGER) AS pos,
               CASE k.k WHEN 0 THEN r.n1 WHEN 1 THEN r.n2 WHEN 2 THEN r.n3 ELSE r.n4 END AS value
        FROM rows r, nd, (VALUES (0), (1), (2), (3)) k(k)),
enc AS (SELECT * FROM nom UNION ALL SELECT * FROM num)"""


# fixed linear predictions on the joined orders (no fit needed)
P0 = "0.99 * n2"
TP = f"SELECT id, label AS y, {half_up(P0)} AS p, {fold_expr()} AS fold FROM ({TJ}) t"

# line-level values (no sums, so both engines compute them bit for bit)
LINE = """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge,
       l_extendedprice AS price FROM lineitem"""

# fixed grid of linear predictions a*n2 + b*n1 (a outer, b inner)
GRID_A = [0.95, 1.0, 1.05]
GRID_B = [100.0, 1000.0, 3000.0]
_GRID_VALUES = ", ".join(f"({g}, {a}, {b})" for g, (a, b) in
                         enumerate((a, b) for a in GRID_A for b in GRID_B))
GRID = f"(SELECT grid_pos, a::DOUBLE AS a, b::DOUBLE AS b FROM (VALUES {_GRID_VALUES}) g(grid_pos, a, b))"
_GRID_PRED = f"""t AS ({TF}),
gp AS (SELECT CAST(g.grid_pos AS INTEGER) AS grid_pos, g.a, g.b, t.fold, t.label AS y,
              {half_up('g.a * t.n2 + g.b * t.n1')} AS p FROM t, {GRID} g)"""


def _sgd_chain(moments: str, iterations: int, step: float, keys: str = "") -> str:
    """Recursive CTE ``it(keys, i, w, b, done)`` of full-batch descent on (z, 1).

    ``moments`` yields ``keys..., n, sz, szz, sy, szy``. Weights start at 0 and
    the intercept at 1.0; stop once the step is below 0.001 * max(norm, 1)
    from the second iteration on.
    """
    kcols = [k.strip() for k in keys.split(",") if k.strip()]
    ksel = "".join(f"{k}, " for k in kcols)
    kjoin = " AND ".join(f"mm.{k} = it.{k}" for k in kcols) or "TRUE"
    return f"""it({ksel}i, w, b, done) AS (
    SELECT {ksel}0, 0.0::DOUBLE, 1.0::DOUBLE, false FROM ({moments}) mm0
    UNION ALL
    SELECT {ksel}i, nw, nb,
           i >= 2 AND sqrt((nw - w) * (nw - w) + (nb - b) * (nb - b))
                      < 0.001 * greatest(sqrt(nw * nw + nb * nb), 1.0)
    FROM (SELECT {''.join(f'it.{k}, ' for k in kcols)}it.i + 1 AS i, it.w, it.b,
                 it.w - ({step} / sqrt(it.i + 1)) * ((mm.szz * it.w + mm.sz * it.b) - mm.szy) / mm.n AS nw,
                 it.b - ({step} / sqrt(it.i + 1)) * ((mm.sz * it.w + mm.n * it.b) - mm.sy) / mm.n AS nb
          FROM it JOIN ({moments}) mm ON {kjoin}
          WHERE it.i < {iterations} AND NOT it.done) s
)"""


def _cg_chain(system: str = "sys", max_iter: int = 400) -> str:
    """Recursive CTE ``cg`` solving ``A x = b`` for every row ``(k, A, b)`` of ``system``.

    Conjugate gradients from x = 0 on symmetric positive definite systems,
    until the squared residual falls below 1e-30 of its start.
    """
    return f"""cg(k, it, x, r, p, rs, rs0, done) AS (
    SELECT k, 0, list_transform(b, lambda e: 0.0::DOUBLE), b, b, list_dot_product(b, b),
           list_dot_product(b, b), false FROM {system}
    UNION ALL
    SELECT k, it, x2, r2, list_transform(list_zip(r2, p), lambda q: q[1] + (rs2 / rs) * q[2]), rs2, rs0,
           rs2 <= 1e-30 * rs0 OR it >= {max_iter}
    FROM (SELECT k, it, p, rs, rs0, x2, r2, list_dot_product(r2, r2) AS rs2
          FROM (SELECT k, it, p, rs, rs0,
                       list_transform(list_zip(x, p), lambda q: q[1] + alpha * q[2]) AS x2,
                       list_transform(list_zip(r, ap), lambda q: q[1] - alpha * q[2]) AS r2
                FROM (SELECT cg.k, cg.it + 1 AS it, cg.x, cg.r, cg.p, cg.rs, cg.rs0, ap,
                             cg.rs / list_dot_product(cg.p, ap) AS alpha
                      FROM (SELECT cg.*, list_transform({system}.A, lambda row: list_dot_product(row, cg.p)) AS ap
                            FROM cg JOIN {system} ON {system}.k = cg.k WHERE NOT cg.done) cg) s1) s2) s3
),
sol AS (SELECT cg.k, cg.x FROM cg JOIN (SELECT k, max(it) AS it FROM cg GROUP BY k) l
        ON l.k = cg.k AND l.it = cg.it)"""


# least squares on all encoded features: per fold k (and -1, all rows) the coefficients ``coef``
# over z, the intercept ``icpt``, and the unfinished predictions ``cvp`` and ``trp``
def _ls_ctes(features: str = OF, rows: str = TJ) -> str:
    return f"""WITH RECURSIVE {_encoding_ctes(features, rows)},
st AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM enc GROUP BY pos),
zf AS (SELECT e.id, e.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END AS z,
              {fold_expr('e.id')} AS fold FROM enc e JOIN st ON st.pos = e.pos),
lab AS (SELECT id, label AS y, {fold_expr()} AS fold FROM rows),
pg AS (SELECT a.fold, a.pos AS i, b.pos AS j, sum(a.z * b.z) AS g FROM zf a JOIN zf b ON a.id = b.id GROUP BY 1, 2, 3),
ps AS (SELECT fold, pos AS i, sum(z) AS sz FROM zf GROUP BY 1, 2),
py AS (SELECT zf.fold, zf.pos AS i, sum(zf.z * lab.y) AS szy FROM zf JOIN lab ON lab.id = zf.id GROUP BY 1, 2),
pn AS (SELECT fold, count(*)::DOUBLE AS n, sum(y) AS sy FROM lab GROUP BY fold),
keys AS (SELECT k FROM {FOLDS} UNION ALL SELECT -1),
tg AS (SELECT keys.k, pg.i, pg.j, sum(pg.g) AS g FROM keys JOIN pg ON pg.fold <> keys.k GROUP BY 1, 2, 3),
ts AS (SELECT keys.k, ps.i, sum(ps.sz) AS sz FROM keys JOIN ps ON ps.fold <> keys.k GROUP BY 1, 2),
ty AS (SELECT keys.k, py.i, sum(py.szy) AS szy FROM keys JOIN py ON py.fold <> keys.k GROUP BY 1, 2),
tn AS (SELECT keys.k, sum(pn.n) AS n, sum(pn.sy) AS sy FROM keys JOIN pn ON pn.fold <> keys.k GROUP BY 1),
cm AS (SELECT tg.k, tg.i, tg.j, tg.g - a.sz * b.sz / tn.n
              + CASE WHEN tg.i = tg.j THEN 1e-8 * (tg.g - a.sz * a.sz / tn.n) / (tn.n - 1) ELSE 0.0 END AS c
       FROM tg JOIN ts a ON a.k = tg.k AND a.i = tg.i JOIN ts b ON b.k = tg.k AND b.i = tg.j
       JOIN tn ON tn.k = tg.k),
cvec AS (SELECT ty.k, ty.i, ty.szy - ts.sz * tn.sy / tn.n AS c
         FROM ty JOIN ts ON ts.k = ty.k AND ts.i = ty.i JOIN tn ON tn.k = ty.k),
sys AS (SELECT m.k, m.A, v.b
        FROM (SELECT k, list(r ORDER BY i) AS A FROM (SELECT k, i, list(c ORDER BY j) AS r FROM cm GROUP BY k, i) x
              GROUP BY k) m
        JOIN (SELECT k, list(c ORDER BY i) AS b FROM cvec GROUP BY k) v ON v.k = m.k),
{_cg_chain()},
coef AS (SELECT sol.k, CAST(generate_subscripts(sol.x, 1) - 1 AS INTEGER) AS i, unnest(sol.x) AS a FROM sol),
icpt AS (SELECT coef.k, tn.sy / tn.n - sum(coef.a * ts.sz / tn.n) AS b0
         FROM coef JOIN ts ON ts.k = coef.k AND ts.i = coef.i JOIN tn ON tn.k = coef.k GROUP BY coef.k, tn.sy, tn.n),
cvp AS (SELECT zf.id, zf.fold AS k, sum(coef.a * zf.z) AS s FROM zf JOIN coef ON coef.k = zf.fold AND coef.i = zf.pos
        GROUP BY zf.id, zf.fold),
trp AS (SELECT zf.id, -1 AS k, sum(coef.a * zf.z) AS s FROM zf JOIN coef ON coef.k = -1 AND coef.i = zf.pos
        GROUP BY zf.id),
"""


_LS_ALL = _ls_ctes()
_LS_PRED = f"""{_LS_ALL}pr AS (SELECT p.k, p.id, lab.fold, lab.y, icpt.b0 + p.s AS raw, {half_up('icpt.b0 + p.s')} AS p
       FROM (SELECT * FROM cvp UNION ALL SELECT * FROM trp) p JOIN icpt ON icpt.k = p.k JOIN lab ON lab.id = p.id)"""
# coefficients of the fit on all rows in raw units
_LS_COEF = f"""{_LS_ALL}raw AS (SELECT coef.i AS pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0 ELSE coef.a / st.s END AS c, st.m
        FROM coef JOIN st ON st.pos = coef.i WHERE coef.k = -1),
names AS (SELECT CAST(off.start + lv.idx - 1 AS INTEGER) AS pos, lv.col || '=' || lv.level AS feature
          FROM lv JOIN off ON off.col = lv.col WHERE lv.idx >= 1
          UNION ALL SELECT CAST(nd.total + k.k AS INTEGER), 'n' || CAST(k.k + 1 AS VARCHAR)
          FROM nd, (VALUES (0), (1), (2), (3)) k(k))
SELECT names.feature, round(raw.c, 4) AS coefficient FROM raw JOIN names ON names.pos = raw.pos
UNION ALL SELECT '(intercept)', round((SELECT b0 FROM icpt WHERE k = -1) - sum(c * m), 2) FROM raw"""
# gradient descent on all encoded features: the systems ``sys`` (k, G, h, n), rows ``zf`` and ``lab``
_SGD_ALL = f"""WITH RECURSIVE {_encoding_ctes()},
st AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM enc GROUP BY pos),
dim AS (SELECT total + 4 AS d FROM nd),
zf AS (SELECT e.id, e.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END AS z,
              {fold_expr('e.id')} AS fold FROM enc e JOIN st ON st.pos = e.pos
       UNION ALL SELECT id, (SELECT d FROM dim), 1.0::DOUBLE, {fold_expr()} FROM rows),
lab AS (SELECT id, label AS y, {fold_expr()} AS fold FROM rows),
pg AS (SELECT a.fold, a.pos AS i, b.pos AS j, sum(a.z * b.z) AS g FROM zf a JOIN zf b ON a.id = b.id GROUP BY 1, 2, 3),
py AS (SELECT zf.fold, zf.pos AS i, sum(zf.z * lab.y) AS h FROM zf JOIN lab ON lab.id = zf.id GROUP BY 1, 2),
pn AS (SELECT fold, count(*)::DOUBLE AS n FROM lab GROUP BY fold),
keys AS (SELECT k FROM {FOLDS} UNION ALL SELECT -1),
tg AS (SELECT keys.k, pg.i, pg.j, sum(pg.g) AS g FROM keys JOIN pg ON pg.fold <> keys.k GROUP BY 1, 2, 3),
ty AS (SELECT keys.k, py.i, sum(py.h) AS h FROM keys JOIN py ON py.fold <> keys.k GROUP BY 1, 2),
tn AS (SELECT keys.k, sum(pn.n) AS n FROM keys JOIN pn ON pn.fold <> keys.k GROUP BY 1),
sys AS (SELECT m.k, m.G, v.h, tn.n
        FROM (SELECT k, list(r ORDER BY i) AS G FROM (SELECT k, i, list(g ORDER BY j) AS r FROM tg GROUP BY k, i) x
              GROUP BY k) m
        JOIN (SELECT k, list(h ORDER BY i) AS h FROM ty GROUP BY k) v ON v.k = m.k
        JOIN tn ON tn.k = m.k),
"""


# --- regression trees ----------------------------------------------------------------

def _tree_ctes(depth: int) -> str:
    """CTEs that grow one tree per fold key k (rows outside fold k; -1: all rows) on the dummies
    and n3: ``n0 .. n{depth}`` hold every row's node at each level (heap numbers)."""
    parts = [f"""{_encoding_ctes()},
lab AS (SELECT id, label AS y, {fold_expr()} AS fold FROM rows),
te AS (SELECT id, pos, value FROM enc, nd WHERE pos < nd.total OR pos = nd.total + 2),
n0 AS (SELECT k.k, lab.id, 1 AS node FROM lab, (SELECT k FROM {FOLDS} UNION ALL SELECT -1) k)"""]
    for d in range(depth):
        parts.append(f"""v{d} AS (SELECT n.k, n.node, e.pos, e.value, count(*)::DOUBLE AS c, sum(lab.y) AS s
       FROM n{d} n JOIN lab ON lab.id = n.id JOIN te e ON e.id = n.id WHERE lab.fold <> n.k GROUP BY 1, 2, 3, 4),
g{d} AS (SELECT k, node, pos, (value + lead(value) OVER w) / 2 AS thr,
              sum(c) OVER (w ROWS UNBOUNDED PRECEDING) AS nl, sum(s) OVER (w ROWS UNBOUNDED PRECEDING) AS sl,
              sum(c) OVER (PARTITION BY k, node, pos) AS nn, sum(s) OVER (PARTITION BY k, node, pos) AS ss
       FROM v{d} WINDOW w AS (PARTITION BY k, node, pos ORDER BY value)),
h{d} AS (SELECT k, node, pos, thr, nl * (nn - nl) * (sl / nl - (ss - sl) / (nn - nl)) * (sl / nl - (ss - sl) / (nn - nl)) AS gain
       FROM g{d} WHERE thr IS NOT NULL),
b{d} AS (SELECT k, node, pos, thr FROM (SELECT *, row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, pos, thr) AS rn
       FROM h{d} WHERE gain > 0) x WHERE rn = 1),
n{d + 1} AS (SELECT n.k, n.id, CASE WHEN b.node IS NULL THEN n.node WHEN e.value <= b.thr THEN 2 * n.node
                              ELSE 2 * n.node + 1 END AS node
       FROM n{d} n LEFT JOIN b{d} b ON b.k = n.k AND b.node = n.node
       LEFT JOIN te e ON e.id = n.id AND e.pos = b.pos)""")
    for d in range(1, depth + 1):
        parts.append(f"""a{d} AS (SELECT n.k, n.node, avg(lab.y) AS p FROM n{d} n JOIN lab ON lab.id = n.id
       WHERE lab.fold <> n.k GROUP BY 1, 2),
p{d} AS (SELECT n.k, lab.fold, lab.y, {half_up(f'a{d}.p')} AS p FROM n{d} n JOIN lab ON lab.id = n.id
       JOIN a{d} ON a{d}.k = n.k AND a{d}.node = n.node WHERE n.k = -1 OR n.k = lab.fold)""")
    return ",\n".join(parts)


def _tree_report(depth: int) -> str:
    return f"""WITH {_tree_ctes(depth)},
pf AS (SELECT fold, {metrics_sql()} FROM p{depth} WHERE k >= 0 GROUP BY fold),
tr AS (SELECT {metrics_sql()} FROM p{depth} WHERE k = -1)
SELECT 'cv' AS stage, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse FROM pf
UNION ALL SELECT 'training', round(corr, 8), round(mae, 4), round(rmse, 4) FROM tr"""


# A Poisson draw of mean 1 from 32 bits: the number of values of its distribution function passed.
_POISSON = " + ".join(f"(h >= {int(2**32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)))})::INTEGER"
                      for k in range(12))


def _bagged_report(depth: int, trees: int, seed: int) -> str:
    """CV and training metrics of the mean of ``trees`` weighted trees per fold key k, grown on the dummies
    and n3; candidate thresholds lie midway between the values of the whole bag."""
    parts = [f"""{_encoding_ctes()},
lab AS (SELECT id, label AS y, {fold_expr()} AS fold FROM rows),
te AS (SELECT id, pos, value FROM enc, nd WHERE pos < nd.total OR pos = nd.total + 2),
bag AS (SELECT id, t, ({_POISSON})::DOUBLE AS w FROM (
  SELECT id, t, ('0x' || substr(md5('{seed}:' || t || ':' || id), 1, 8))::BIGINT AS h
  FROM lab, (SELECT unnest(range({trees})) AS t))),
n0 AS (SELECT k.k, bag.t, lab.id, CASE WHEN lab.fold <> k.k THEN bag.w ELSE 0 END AS w, lab.y, 1 AS node
       FROM lab JOIN bag ON bag.id = lab.id, (SELECT k FROM {FOLDS} UNION ALL SELECT -1) k
       WHERE lab.fold = k.k OR k.k = -1 OR bag.w > 0),
gv AS (SELECT k, t, pos, value, lead(value) OVER (PARTITION BY k, t, pos ORDER BY value) AS nxt
       FROM (SELECT DISTINCT n.k, n.t, e.pos, e.value FROM n0 n JOIN te e ON e.id = n.id WHERE n.w > 0) x)"""]
    for d in range(depth):
        parts.append(f"""v{d} AS (SELECT n.k, n.t, n.node, e.pos, e.value, sum(n.w) AS c, sum(n.w * n.y) AS s
       FROM n{d} n JOIN te e ON e.id = n.id WHERE n.w > 0 GROUP BY 1, 2, 3, 4, 5),
g{d} AS (SELECT k, t, node, pos, value, sum(c) OVER (w ROWS UNBOUNDED PRECEDING) AS nl,
              sum(s) OVER (w ROWS UNBOUNDED PRECEDING) AS sl,
              sum(c) OVER (PARTITION BY k, t, node, pos) AS nn, sum(s) OVER (PARTITION BY k, t, node, pos) AS ss
       FROM v{d} WINDOW w AS (PARTITION BY k, t, node, pos ORDER BY value)),
h{d} AS (SELECT g.k, g.t, g.node, g.pos, (gv.value + gv.nxt) / 2 AS thr,
              nl * (nn - nl) * (sl / nl - (ss - sl) / (nn - nl)) * (sl / nl - (ss - sl) / (nn - nl)) AS gain
       FROM g{d} g JOIN gv ON gv.k = g.k AND gv.t = g.t AND gv.pos = g.pos AND gv.value = g.value
       WHERE gv.nxt IS NOT NULL AND nn > nl),
b{d} AS (SELECT k, t, node, pos, thr FROM h{d} WHERE gain > 0
       QUALIFY row_number() OVER (PARTITION BY k, t, node ORDER BY gain DESC, pos, thr) = 1),
n{d + 1} AS (SELECT n.k, n.t, n.id, n.w, n.y, CASE WHEN b.node IS NULL THEN n.node WHEN e.value <= b.thr THEN 2 * n.node
                              ELSE 2 * n.node + 1 END AS node
       FROM n{d} n LEFT JOIN b{d} b ON b.k = n.k AND b.t = n.t AND b.node = n.node
       LEFT JOIN te e ON e.id = n.id AND e.pos = b.pos)""")
    parts.append(f"""leaf AS (SELECT k, t, node, sum(w * y) / sum(w) AS p FROM n{depth} WHERE w > 0 GROUP BY 1, 2, 3),
pr AS (SELECT n.k, n.id, any_value(n.y) AS y, {half_up('avg(leaf.p)')} AS p
       FROM n{depth} n JOIN leaf ON leaf.k = n.k AND leaf.t = n.t AND leaf.node = n.node JOIN lab ON lab.id = n.id
       WHERE n.k = -1 OR n.k = lab.fold GROUP BY n.k, n.id),
pf AS (SELECT k, {metrics_sql()} FROM pr WHERE k >= 0 GROUP BY k),
tr AS (SELECT {metrics_sql()} FROM pr WHERE k = -1)
SELECT 'cv' AS stage, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse FROM pf
UNION ALL SELECT 'training', round(corr, 8), round(mae, 4), round(rmse, 4) FROM tr""")
    return "WITH " + ",\n".join(parts)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # ---- sources and sinks ----
    q["s1_feature_csv_scan"] = f"""SELECT CAST(id AS VARCHAR) AS id, c1, c2, c3, c4, c5,
       n1, round(n2, 4) AS n2, n3, n4 FROM ({OF}) f"""
    q["s2_label_csv_scan"] = f"SELECT CAST(id AS VARCHAR) AS id, round(label, 6) AS label FROM ({OL}) l"
    q["s3_header_per_file"] = f"SELECT count(*) AS n, count(DISTINCT id) AS ids FROM ({OF}) f"
    q["s4_training_table"] = f"""WITH {_encoding_ctes()},
agg AS (SELECT id, CAST(count(*) AS INTEGER) AS width, sum(value) FILTER (WHERE pos < (SELECT total FROM nd)) AS ones
        FROM enc GROUP BY id)
SELECT r.id, round(r.label, 6) AS label, a.width, a.ones, round(r.n2, 4) AS n2
FROM rows r JOIN agg a ON a.id = r.id"""
    q["s5_scoring_table"] = f"""WITH {_encoding_ctes(OF_TRAIN, OF_SCORE)},
unseen AS (SELECT jl.id, CAST(sum(CASE WHEN lv.level IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS unseen_levels
           FROM jl LEFT JOIN lv ON lv.col = jl.col AND lv.level = jl.level GROUP BY jl.id)
SELECT e.id, e.pos, round(e.value, 4) AS value, u.unseen_levels FROM enc e JOIN unseen u ON u.id = e.id"""
    q["s6_combined_table"] = f"""SELECT c1, c2, c3, c4, c5, n1, round(n2, 4) AS n2, n3, n4, round(label, 6) AS label
FROM ({TJ}) t"""
    # rows since the cutoff under the least squares of those before it: ``scored(id, raw, unseen_levels)``
    scored = f"""{_ls_ctes(OF_TRAIN, TJ_TRAIN)}raw AS (
  SELECT coef.i AS pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0 ELSE coef.a / st.s END AS c, st.m
  FROM coef JOIN st ON st.pos = coef.i WHERE coef.k = -1),
sc AS ({OF_SCORE}),
lev AS (UNPIVOT (SELECT id, c1, c2, c3, c4, c5 FROM sc) ON c1, c2, c3, c4, c5 INTO NAME col VALUE level),
seen AS (SELECT lev.id, lv.idx, off.start FROM lev LEFT JOIN lv ON lv.col = lev.col AND lv.level = lev.level
         LEFT JOIN off ON off.col = lev.col),
dums AS (SELECT seen.id, coalesce(sum(raw.c), 0.0) AS s, CAST(sum(CASE WHEN seen.idx IS NULL THEN 1 ELSE 0 END) AS INTEGER) AS unseen_levels
         FROM seen LEFT JOIN raw ON seen.idx >= 1 AND raw.pos = seen.start + seen.idx - 1 GROUP BY seen.id),
w AS (SELECT (SELECT c FROM raw WHERE pos = nd.total) AS w1, (SELECT c FROM raw WHERE pos = nd.total + 1) AS w2,
             (SELECT c FROM raw WHERE pos = nd.total + 2) AS w3, (SELECT c FROM raw WHERE pos = nd.total + 3) AS w4,
             (SELECT b0 FROM icpt WHERE k = -1) - (SELECT sum(c * m) FROM raw) AS b FROM nd),
scored AS (SELECT sc.id, w.b + dums.s + w1 * n1 + w2 * n2 + w3 * n3 + w4 * n4 AS raw, dums.unseen_levels
           FROM sc JOIN dums ON dums.id = sc.id, w)"""
    q["s7_prediction_sink"] = f"""{scored}
SELECT CAST(id AS VARCHAR) || ',' || CAST({half_up('raw')} AS VARCHAR) AS value FROM scored"""
    q["s8_model_sink"] = f"""{_LS_COEF}"""
    q["s9_first_rows"] = f"""SELECT id, c1, c2, c3, c4, c5, n1, round(n2, 4) AS n2, n3, n4, round(label, 6) AS label
FROM ({TJ}) t ORDER BY id LIMIT 10"""
    q["s10_fold_rows"] = f"""WITH t AS ({TF}),
s AS (SELECT k.k AS cv_fold, CASE WHEN t.fold = k.k THEN 'validation' ELSE 'train' END AS side, t.id
      FROM t, {FOLDS} k),
r AS (SELECT cv_fold, side, id, CAST(row_number() OVER (PARTITION BY cv_fold, side ORDER BY id) AS INTEGER) AS rn FROM s)
SELECT cv_fold, side, rn, id FROM r WHERE rn <= 10"""
    q["s11_training_predictions"] = f"""{_LS_PRED}
SELECT id, p AS prediction FROM pr WHERE k = -1"""
    q["s12_model_coefficients"] = f"""{_LS_COEF}"""
    q["s13_result_report"] = f"""{_LS_PRED},
pf AS (SELECT fold, {metrics_sql()} FROM pr WHERE k >= 0 GROUP BY fold),
tr AS (SELECT {metrics_sql()} FROM pr WHERE k = -1)
SELECT 'cv' AS stage, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse FROM pf
UNION ALL SELECT 'training', round(corr, 8), round(mae, 4), round(rmse, 4) FROM tr"""

    # ---- projections ----
    line = "CAST(id AS VARCHAR) || ',' || c1 || ',' || c2 || ',' || c3 || ',' || c4 || ',' || c5"
    q["p1_id_and_rest"] = f"""WITH l AS (SELECT string_split({line} || ',' || CAST(n1 AS VARCHAR), ',') AS parts FROM ({OF}) f)
SELECT parts[1] AS id, CAST(len(parts) - 1 AS INTEGER) AS n_rest, parts[2] AS first_rest, parts[6] AS fifth_rest FROM l"""
    q["p2_nominal_column"] = f"SELECT id, c3 FROM ({OF}) f"
    q["p3_ids_only"] = f"SELECT id FROM ({TJ}) t"
    q["p4_drop_id"] = f"SELECT c1, c2, c3, c4, c5, n1, round(n2, 4) AS n2, n3, n4 FROM ({OF}) f"
    q["p5_label_last"] = f"""SELECT c1, c2, c3, c4, c5, n1, round(n2, 4) AS n2, n3, n4, round(label, 6) AS label
FROM ({TJ}) t"""
    q["p6_unlabelled_rows"] = f"SELECT id, 0.0::DOUBLE AS label FROM ({OF_SCORE}) f"
    q["p7_labeled_point"] = f"""WITH {_encoding_ctes()}
SELECT r.id, round(r.label, 6) AS label, CAST(count(*) AS INTEGER) AS width, round(sum(e.value), 4) AS total
FROM rows r JOIN enc e ON e.id = r.id GROUP BY r.id, r.label"""
    q["p8_fold_filter"] = f"""WITH t AS ({TF})
SELECT k.k AS cv_fold, CASE WHEN t.fold = k.k THEN 'validation' ELSE 'train' END AS side,
       count(*) AS n, round(sum(t.n1), 4) AS qty
FROM t, {FOLDS} k GROUP BY 1, 2"""
    q["p9_column_roles"] = f"""WITH {_encoding_ctes()}
SELECT col AS column_name, 'nominal' AS role, start AS slot_start, CAST(dummies AS INTEGER) AS slots FROM off
UNION ALL
SELECT 'n' || CAST(k.k + 1 AS VARCHAR), 'numeric', CAST(nd.total + k.k AS INTEGER), 1
FROM nd, (VALUES (0), (1), (2), (3)) k(k)"""

    # ---- encoding ----
    q["e1_distinct_levels"] = f"SELECT col, level FROM ({_levels(OF)}) lv"
    q["e2_level_counts"] = f"""SELECT col, count(*) AS levels, count(*) - 1 AS dummies FROM ({_levels(OF)}) lv GROUP BY col"""
    q["e3_level_index"] = _levels(OF)
    q["e4_dummy_width"] = f"""WITH lv AS ({_levels(OF)})
SELECT CAST(count(*) - count(DISTINCT col) AS INTEGER) AS dummy_width,
       CAST(count(*) - count(DISTINCT col) + 4 AS INTEGER) AS width FROM lv"""
    q["e5_dummy_coding"] = f"""WITH {_encoding_ctes()}
SELECT jl.id, jl.col || '=' || lv.level AS feature, CASE WHEN jl.level = lv.level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM jl JOIN lv ON lv.col = jl.col AND lv.idx >= 1"""
    q["e6_numeric_passthrough"] = f"SELECT id, n1, round(n2, 4) AS n2, n3, n4 FROM ({TJ}) t"
    q["e7_flatten"] = f"""WITH {_encoding_ctes()}
SELECT id, pos, round(value, 4) AS value FROM enc"""
    q["e8_nominal_to_binary"] = f"""WITH lv AS ({_levels(OF)}),
cnt AS (SELECT col, count(*) AS levels FROM lv GROUP BY col),
jl AS (UNPIVOT (SELECT id, c1, c2, c3, c4, c5 FROM ({TJ})) ON c1, c2, c3, c4, c5 INTO NAME col VALUE level)
SELECT jl.id, jl.col || '=' || lv.level AS feature, CASE WHEN jl.level = lv.level THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM jl JOIN cnt ON cnt.col = jl.col JOIN lv ON lv.col = jl.col
WHERE cnt.levels > 2 OR lv.idx = 1"""
    q["e9_scaler_fit"] = f"""WITH {_encoding_ctes()}
SELECT pos, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM enc GROUP BY pos"""
    q["e10_scaler_transform"] = f"""WITH {_encoding_ctes()},
st AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM enc GROUP BY pos)
SELECT e.id, e.pos, round(CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END, 6) AS z
FROM enc e JOIN st ON st.pos = e.pos"""

    q["e11_scaling_switch"] = f"""WITH {_encoding_ctes()},
st AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM enc GROUP BY pos),
z AS (SELECT e.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END AS x
      FROM enc e JOIN st ON st.pos = e.pos)
SELECT false AS scaled, pos, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd FROM enc GROUP BY pos
UNION ALL
SELECT true AS scaled, pos, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS sd FROM z GROUP BY pos"""

    # ---- joins ----
    q["j1_label_join"] = f"""SELECT (SELECT count(*) FROM ({OF}) a) AS n_features,
       (SELECT count(*) FROM ({OL}) b) AS n_labels,
       (SELECT count(*) FROM ({TJ}) c) AS n_joined"""
    q["j2_level_lookup"] = f"""WITH {_encoding_ctes(OF, OF)}
SELECT jl.id, jl.col, jl.level, lv.idx FROM jl JOIN lv ON lv.col = jl.col AND lv.level = jl.level"""
    q["j4_param_grid"] = f"""WITH {_GRID_PRED}
SELECT grid_pos, a, b, count(*) AS n, round(avg(abs(y - p)), 4) AS mae FROM gp GROUP BY grid_pos, a, b"""
    q["j5_grid_by_fold"] = f"""WITH {_GRID_PRED}
SELECT grid_pos, fold, count(*) AS n, round(avg(abs(y - p)), 4) AS mae,
       round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM gp GROUP BY grid_pos, fold"""

    # ---- aggregates ----
    q["a1_row_count"] = f"SELECT count(*) AS n FROM ({TJ}) t"
    q["a2_mse"] = f"SELECT fold, round(avg((y - p) * (y - p)), 2) AS mse FROM ({TP}) t GROUP BY fold"
    q["a3_rmse"] = f"SELECT fold, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse FROM ({TP}) t GROUP BY fold"
    q["a4_mae"] = f"SELECT fold, round(avg(abs(y - p)), 4) AS mae FROM ({TP}) t GROUP BY fold"
    q["a5_pearson"] = f"""SELECT fold, round(covar_pop(y, p) / nullif(stddev_pop(y) * stddev_pop(p), 0), 8) AS corr
FROM ({TP}) t GROUP BY fold"""
    q["a6_macro_average"] = f"""WITH pf AS (SELECT fold, {metrics_sql()} FROM ({TP}) t GROUP BY fold)
SELECT CAST(count(*) AS INTEGER) AS folds, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae,
       round(avg(rmse), 4) AS rmse FROM pf"""
    q["a7_pooled_metrics"] = f"""SELECT n, round(corr, 8) AS corr, round(mae, 4) AS mae, round(rmse, 4) AS rmse
FROM (SELECT {metrics_sql()} FROM ({TP}) t) s"""
    q["a8_metrics_one_pass"] = f"""SELECT fold, n, round(corr, 8) AS corr, round(mae, 4) AS mae, round(mse, 2) AS mse,
       round(rmse, 4) AS rmse FROM (SELECT fold, {metrics_sql()} FROM ({TP}) t GROUP BY fold) s"""
    q["a9_fold_moments"] = f"""WITH {_encoding_ctes()},
st AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM enc GROUP BY pos),
z AS (SELECT e.id, e.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END AS z
      FROM enc e JOIN st ON st.pos = e.pos
      UNION ALL SELECT id, (SELECT total + 4 FROM nd), 1.0::DOUBLE FROM rows),
zf AS (SELECT z.*, {fold_expr()} AS fold FROM z)
SELECT a.fold, a.pos AS i, b.pos AS j, round(sum(a.z * b.z), 6) AS value
FROM zf a JOIN zf b ON a.id = b.id AND a.pos <= b.pos GROUP BY a.fold, a.pos, b.pos"""

    # ---- folds ----
    q["k1_fold_assignment"] = f"SELECT id, {fold_expr()} AS fold FROM ({TJ}) t"
    q["k2_fold_pairs"] = f"""WITH t AS ({TF})
SELECT k.k AS cv_fold, CASE WHEN t.fold = k.k THEN 'validation' ELSE 'train' END AS side, count(*) AS n
FROM t, {FOLDS} k GROUP BY 1, 2"""
    q["k3_union_all"] = f"SELECT count(*) AS n, count(DISTINCT id) AS ids, round(sum(n1), 4) AS qty FROM ({TJ}) t"
    q["k4_seeded_folds"] = f"SELECT id, {fold_expr('id', 10, 1)} AS fold FROM ({TJ}) t"
    q["k5_distinct"] = f"SELECT DISTINCT c1, c2 FROM ({OF}) f"

    # ---- top-k ----
    q["t1_take_first"] = f"SELECT id, round(label, 6) AS label FROM ({TJ}) t ORDER BY label DESC, id LIMIT 10"
    _pt = f"""WITH {_GRID_PRED},
pf AS (SELECT grid_pos, a, b, fold, {metrics_sql()} FROM gp GROUP BY grid_pos, a, b, fold),
pt AS (SELECT grid_pos, a, b, avg(corr) AS corr, avg(mae) AS mae, avg(rmse) AS rmse FROM pf GROUP BY grid_pos, a, b)"""
    q["t2_best_point"] = f"""{_pt}
SELECT grid_pos, a, b, round(corr, 8) AS corr FROM pt ORDER BY corr DESC NULLS LAST, grid_pos LIMIT 1"""
    q["t3_ranked_points"] = f"""{_pt}
SELECT CAST(row_number() OVER (ORDER BY corr DESC NULLS LAST, grid_pos) AS INTEGER) AS rank,
       grid_pos, round(corr, 8) AS corr, round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM pt"""

    # ---- scalar functions ----
    q["f1_string_split"] = f"""WITH l AS (SELECT id, string_split({line} || ',' || CAST(n1 AS VARCHAR) || ',' || CAST(n4 AS VARCHAR), ',') AS parts
           FROM ({OF}) f),
e AS (SELECT id, unnest(parts) AS field, generate_subscripts(parts, 1) - 1 AS pos FROM l)
SELECT id, CAST(pos AS INTEGER) AS pos, CASE WHEN pos <= 5 THEN field END AS text,
       CASE WHEN pos > 5 THEN CAST(field AS DOUBLE) END AS num FROM e"""
    q["f2_string_to_double"] = """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price,
       CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) AS qty FROM lineitem"""
    q["f3_concat"] = f"""SELECT id, CAST(id AS VARCHAR) || ',' || CAST({half_up(P0)} AS VARCHAR) AS line FROM ({TJ}) t"""
    q["f4_power"] = f"""SELECT l_orderkey, l_linenumber, round(pow(charge - {half_up('0.99 * price')}, 2), 4) AS sq_err
FROM ({LINE}) l"""
    q["f5_sqrt"] = f"SELECT l_orderkey, l_linenumber, round(sqrt(charge), 6) AS root FROM ({LINE}) l"
    q["f6_abs"] = f"""SELECT l_orderkey, l_linenumber, round(abs(charge - {half_up('0.99 * price')}), 6) AS abs_err
FROM ({LINE}) l"""
    q["f7_round_half_up"] = f"""SELECT l_orderkey, l_linenumber, l_linenumber - 3.5::DOUBLE AS x,
       {half_up('l_linenumber - 3.5::DOUBLE')} AS half_up, {half_up('charge / 100')} AS charge_units
FROM ({LINE}) l"""
    q["f8_array_ops"] = f"""WITH l AS (SELECT string_split({line}, ',') AS parts FROM ({OF}) f)
SELECT parts[1] AS id, parts[2] AS first_rest, CAST(len(parts) - 1 AS INTEGER) AS rest_len,
       CAST(len(parts) - 1 + 1 AS INTEGER) AS flat_len FROM l"""
    q["f9_map_lookup"] = f"""WITH lv AS ({_levels(OF)})
SELECT f.id, f.c2, lv.idx FROM ({OF}) f JOIN lv ON lv.col = 'c2' AND lv.level = f.c2"""
    q["f10_int_ranges"] = f"""SELECT id, CAST(unnest(range(1, CAST(n3 AS BIGINT) + 1)) AS INTEGER) AS line_no
FROM ({OF}) f"""

    # ---- models ----
    q["m1_sgd_one_feature"] = f"""WITH RECURSIVE
t AS (SELECT label AS y, (n2 - avg(n2) OVER ()) / stddev_samp(n2) OVER () AS z FROM ({TJ}) s),
mom AS (SELECT count(*)::DOUBLE AS n, sum(z) AS sz, sum(z * z) AS szz, sum(y) AS sy, sum(z * y) AS szy FROM t),
{_sgd_chain('SELECT * FROM mom', 200, 1.0)}
SELECT feature, coefficient FROM (
  SELECT '(intercept)' AS feature, round(b, 4) AS coefficient, i FROM it
  UNION ALL SELECT 'z(n2)', round(w, 4), i FROM it) s
WHERE i = (SELECT max(i) FROM it)"""
    q["m2_least_squares_two"] = f"""WITH t AS (SELECT n1 AS x1, n2 AS x2, label AS y FROM ({TJ}) s),
c AS (SELECT covar_pop(x1, x1) AS s11, covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12,
             covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM t),
w AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS w1,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS w2, m1, m2, my FROM c)
SELECT '(intercept)' AS feature, round(my - w1 * m1 - w2 * m2, 4) AS coefficient FROM w
UNION ALL SELECT 'n1', round(w1, 6) FROM w
UNION ALL SELECT 'n2', round(w2, 8) FROM w"""
    q["m6_best_split"] = f"""WITH t AS (SELECT label, n1, n2, n3, n4 FROM ({TJ}) s),
lo AS (UNPIVOT t ON n1, n2, n3, n4 INTO NAME feature VALUE value),
st AS (SELECT feature, value, count(*) AS n, sum(label) AS s FROM lo GROUP BY feature, value),
cu AS (SELECT feature, value, lead(value) OVER w AS nxt,
              sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nl,
              sum(s) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sl,
              sum(n) OVER (PARTITION BY feature) AS nn, sum(s) OVER (PARTITION BY feature) AS ss
       FROM st WINDOW w AS (PARTITION BY feature ORDER BY value)),
g AS (SELECT feature, (value + nxt) / 2 AS threshold, CAST(nl AS BIGINT) AS n_left,
             CAST(nn - nl AS BIGINT) AS n_right,
             nl * (nn - nl) / (nn * nn) * (sl / nl - (ss - sl) / (nn - nl)) * (sl / nl - (ss - sl) / (nn - nl)) AS gain
      FROM cu WHERE nxt IS NOT NULL),
v AS (SELECT feature, var_pop(label) AS var FROM lo GROUP BY feature),
b AS (SELECT g.*, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) AS rn FROM g)
SELECT b.feature, round(b.threshold, 4) AS threshold, b.n_left, b.n_right, round(b.gain / v.var, 8) AS gain_ratio
FROM b JOIN v ON v.feature = b.feature WHERE rn = 1"""
    q["m4_tree_exact"] = q["m5_forest_exact"] = _tree_report(3)
    levels = "\nUNION ALL ".join(
        f"SELECT {d - 1} AS grid_pos, {d} AS max_depth, fold, {metrics_sql()} FROM p{d} WHERE k >= 0 GROUP BY fold"
        for d in (1, 2, 3))
    q["m11_tree_grid_exact"] = f"""WITH {_tree_ctes(3)},
pf AS ({levels})
SELECT CAST(grid_pos AS INTEGER) AS grid_pos, CAST(max_depth AS INTEGER) AS max_depth, round(avg(corr), 8) AS corr,
       round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse FROM pf GROUP BY 1, 2"""
    penalty = """list_transform(list_zip(it.w, sys.G, sys.h), lambda p: p[1] * (1 - t * l2)
                     - t * (list_dot_product(p[2], it.w) - p[3]) / sys.n)"""

    def descent(points: str, keys: str) -> str:
        """``it(g, k, i, w, done)``: penalised descent, 200 iterations of step 1.0."""
        return f"""{_SGD_ALL}pts AS (SELECT * FROM (VALUES {points}) v(g, penalty, reg, l1, l2)),
it(g, k, i, w, done) AS (
    SELECT pts.g, sys.k, 0, list_transform(range(dim.d + 1),
                                    lambda q: CASE WHEN q = dim.d THEN 1.0 ELSE 0.0 END::DOUBLE), false
    FROM sys, dim, pts WHERE {keys}
    UNION ALL
    SELECT g, k, i, nw,
           i >= 2 AND sqrt(list_sum(list_transform(list_zip(nw, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))
                      < 0.001 * greatest(sqrt(list_dot_product(nw, nw)), 1.0)
    FROM (SELECT g, k, i, w, list_transform(u, lambda x: sign(x) * greatest(abs(x) - t * l1, 0.0)) AS nw
          FROM (SELECT it.g, it.k, it.i, it.w, it.t, pts.l1, {penalty} AS u
                FROM (SELECT g, k, i + 1 AS i, w, 1.0 / sqrt(i + 1) AS t FROM it WHERE i < 200 AND NOT done) it
                JOIN sys ON sys.k = it.k JOIN pts ON pts.g = it.g) s) s2
),
fin AS (SELECT it.g, it.k, it.w FROM it JOIN (SELECT g, k, max(i) AS i FROM it GROUP BY g, k) l
        ON l.g = it.g AND l.k = it.k AND l.i = it.i),
wl AS (SELECT g, k, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS wv FROM fin)"""

    for name, l1, l2 in (("m3_ridge_descent", 0.0, 0.1), ("m3_lasso_descent", 2000.0, 0.0)):
        q[name] = f"""{descent(f"(0, '', 0.0, {l1}::DOUBLE, {l2}::DOUBLE)", "sys.k = -1")},
raw AS (SELECT wl.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0 ELSE wl.wv / st.s END AS c, st.m
        FROM wl JOIN st ON st.pos = wl.pos),
names AS (SELECT CAST(off.start + lv.idx - 1 AS INTEGER) AS pos, lv.col || '=' || lv.level AS feature
          FROM lv JOIN off ON off.col = lv.col WHERE lv.idx >= 1
          UNION ALL SELECT CAST(nd.total + k.k AS INTEGER), 'n' || CAST(k.k + 1 AS VARCHAR)
          FROM nd, (VALUES (0), (1), (2), (3)) k(k))
SELECT names.feature, round(raw.c, 4) AS coefficient FROM raw JOIN names ON names.pos = raw.pos
UNION ALL
SELECT '(intercept)', round((SELECT wv FROM wl, dim WHERE pos = dim.d) - sum(c * m), 4) FROM raw"""
    grid = [("none", 0.0), ("l1", 10.0), ("l1", 100.0), ("l1", 1000.0), ("l1", 10000.0),
            ("l2", 0.001), ("l2", 0.01), ("l2", 0.1), ("l2", 0.5)]
    points = ", ".join(f"({g}, '{p}', {x}::DOUBLE, {x if p == 'l1' else 0.0}::DOUBLE, {x if p == 'l2' else 0.0}::DOUBLE)"
                       for g, (p, x) in enumerate(grid))
    q["m3_penalty_grid"] = f"""{descent(points, "sys.k >= 0")},
cvp AS (SELECT wl.g, zf.id, zf.fold, sum(wl.wv * zf.z) AS raw FROM zf JOIN wl ON wl.k = zf.fold AND wl.pos = zf.pos
        GROUP BY 1, 2, 3),
pr AS (SELECT p.g, p.fold, lab.y, {half_up('p.raw')} AS p FROM cvp p JOIN lab ON lab.id = p.id),
fm AS (SELECT g, fold, {metrics_sql()} FROM pr GROUP BY g, fold)
SELECT CAST(g AS INTEGER) AS grid_pos, pts.penalty, pts.reg, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae,
       round(avg(rmse), 4) AS rmse FROM fm JOIN pts USING (g) GROUP BY g, pts.penalty, pts.reg"""
    q["k4_balanced_folds"] = f"""SELECT id, CAST((row_number() OVER (ORDER BY md5('1:' || id), id::VARCHAR) - 1) % 10 AS INTEGER) AS fold
FROM ({TJ}) t"""
    q["k4_balanced_fold_sizes"] = """SELECT CAST(k AS INTEGER) AS fold, (n // 10 + CASE WHEN k < n % 10 THEN 1 ELSE 0 END)::BIGINT AS n
FROM (SELECT count(*) AS n FROM lineitem), (SELECT unnest(range(10)) AS k)"""
    q["m5_bagged_exact"] = _bagged_report(3, 5, 42)
    levels = "\nUNION ALL ".join(
        f"SELECT {3 * t + d - 4} AS grid_pos, {t} AS num_trees, {d} AS max_depth, fold, {metrics_sql()} "
        f"FROM p{d} WHERE k >= 0 GROUP BY fold" for t in (1, 2, 3) for d in (1, 2, 3))
    q["m12_forest_grid_exact"] = f"""WITH {_tree_ctes(3)},
pf AS ({levels})
SELECT grid_pos, num_trees, max_depth, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae,
       round(avg(rmse), 4) AS rmse FROM pf GROUP BY 1, 2, 3"""
    q["m7_linear_predict"] = f"""{_LS_PRED}
SELECT id, round(raw, 1) AS raw_prediction FROM pr WHERE k = -1"""
    q["m8_rounded_prediction"] = f"""{_LS_PRED}
SELECT id, round(y, 6) AS label, p AS prediction FROM pr WHERE k = -1"""
    q["m9_cv_one_point"] = f"""{_LS_PRED}
SELECT fold, n, round(corr, 8) AS corr, round(mae, 4) AS mae, round(rmse, 4) AS rmse
FROM (SELECT fold, {metrics_sql()} FROM pr WHERE k >= 0 GROUP BY fold) s"""
    its = ", ".join(f"({i})" for i in range(100, 1000, 100))
    steps = ", ".join(f"({s!r}::DOUBLE)" for s in [1e-4, 1e-3, 1e-2, 1e-1, 1.0])
    q["m10_linear_grid"] = f"""{_SGD_ALL}st5 AS (SELECT step FROM (VALUES {steps}) v(step)),
it(k, step, i, w, done) AS (
    SELECT sys.k, st5.step, 0, list_transform(range(dim.d + 1),
                                    lambda q: CASE WHEN q = dim.d THEN 1.0 ELSE 0.0 END::DOUBLE), false
    FROM sys, dim, st5 WHERE sys.k >= 0
    UNION ALL
    SELECT k, step, i, nw,
           i >= 2 AND sqrt(list_sum(list_transform(list_zip(nw, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))
                      < 0.001 * greatest(sqrt(list_dot_product(nw, nw)), 1.0)
    FROM (SELECT it.k, it.step, it.i + 1 AS i, it.w,
                 list_transform(list_zip(it.w, sys.G, sys.h),
                                lambda p: p[1] - (it.step / sqrt(it.i + 1)) * (list_dot_product(p[2], it.w) - p[3]) / sys.n) AS nw
          FROM it JOIN sys ON sys.k = it.k WHERE it.i < 900 AND NOT it.done) s
),
last AS (SELECT step, k, max(i) AS imax FROM it GROUP BY step, k),
pts AS (SELECT CAST(row_number() OVER (ORDER BY ic.iterations, st5.step) - 1 AS INTEGER) AS grid_pos,
               CAST(ic.iterations AS INTEGER) AS iterations, st5.step
        FROM (VALUES {its}) ic(iterations), st5),
wl AS (SELECT pts.grid_pos, it.k, CAST(generate_subscripts(it.w, 1) - 1 AS INTEGER) AS pos, unnest(it.w) AS wv
       FROM pts JOIN last ON last.step = pts.step
       JOIN it ON it.step = pts.step AND it.k = last.k AND it.i = least(pts.iterations, last.imax)),
cvp AS (SELECT wl.grid_pos, zf.id, zf.fold, sum(wl.wv * zf.z) AS raw FROM zf JOIN wl ON wl.k = zf.fold AND wl.pos = zf.pos
        GROUP BY 1, 2, 3),
pr AS (SELECT p.grid_pos, p.fold, lab.y, {half_up('p.raw')} AS p FROM cvp p JOIN lab ON lab.id = p.id),
fm AS (SELECT grid_pos, fold, {metrics_sql()} FROM pr GROUP BY grid_pos, fold)
SELECT grid_pos, pts.iterations, pts.step, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae,
       round(avg(rmse), 4) AS rmse FROM fm JOIN pts USING (grid_pos) GROUP BY grid_pos, pts.iterations, pts.step"""
    q["m13_refit_sgd"] = f"""WITH RECURSIVE {_encoding_ctes()},
st AS (SELECT pos, avg(value) AS m, stddev_samp(value) AS s FROM enc GROUP BY pos),
z AS (SELECT e.id, e.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END AS z
      FROM enc e JOIN st ON st.pos = e.pos
      UNION ALL SELECT id, (SELECT total + 4 FROM nd), 1.0::DOUBLE FROM rows),
dim AS (SELECT max(pos) + 1 AS d FROM z),
gp AS (SELECT a.pos AS i, b.pos AS j, sum(a.z * b.z) AS g FROM z a JOIN z b ON a.id = b.id GROUP BY a.pos, b.pos),
gm AS (SELECT list(r ORDER BY i) AS G FROM (SELECT i, list(g ORDER BY j) AS r FROM gp GROUP BY i) x),
hv AS (SELECT list(h ORDER BY i) AS h FROM (SELECT z.pos AS i, sum(z.z * r.label) AS h
                                            FROM z JOIN rows r ON r.id = z.id GROUP BY z.pos) x),
nn AS (SELECT count(*)::DOUBLE AS n FROM rows),
it(i, w, done) AS (
    SELECT 0, list_transform(range(d), lambda k: CASE WHEN k = d - 1 THEN 1.0 ELSE 0.0 END::DOUBLE), false FROM dim
    UNION ALL
    SELECT i, nw,
           i >= 2 AND sqrt(list_sum(list_transform(list_zip(nw, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))
                      < 0.001 * greatest(sqrt(list_dot_product(nw, nw)), 1.0)
    FROM (SELECT it.i + 1 AS i, it.w,
                 list_transform(list_zip(it.w, gm.G, hv.h),
                                lambda p: p[1] - (1.0 / sqrt(it.i + 1)) * (list_dot_product(p[2], it.w) - p[3]) / nn.n) AS nw
          FROM it, gm, hv, nn WHERE it.i < 200 AND NOT it.done) s
),
fin AS (SELECT w FROM it ORDER BY i DESC LIMIT 1),
wz AS (SELECT CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS wv FROM fin),
raw AS (SELECT wz.pos, CASE WHEN st.s = 0 OR st.s IS NULL THEN 0.0 ELSE wz.wv / st.s END AS c, st.m
        FROM wz JOIN st ON st.pos = wz.pos),
names AS (SELECT CAST(off.start + lv.idx - 1 AS INTEGER) AS pos, lv.col || '=' || lv.level AS feature
          FROM lv JOIN off ON off.col = lv.col WHERE lv.idx >= 1
          UNION ALL SELECT CAST(nd.total + k.k AS INTEGER), 'n' || CAST(k.k + 1 AS VARCHAR)
          FROM nd, (VALUES (0), (1), (2), (3)) k(k))
SELECT names.feature, round(raw.c, 4) AS coefficient FROM raw JOIN names ON names.pos = raw.pos
UNION ALL
SELECT '(intercept)', round((SELECT wv FROM wz WHERE pos = (SELECT d - 1 FROM dim)) - sum(c * m), 4) FROM raw"""
    q["flagship_least_squares_cv"] = f"""{_LS_ALL}pr AS (SELECT p.k, lab.fold, lab.y, {half_up('icpt.b0 + p.s')} AS p
       FROM (SELECT * FROM cvp UNION ALL SELECT * FROM trp) p JOIN icpt ON icpt.k = p.k JOIN lab ON lab.id = p.id),
pf AS (SELECT fold, {metrics_sql()} FROM pr WHERE k >= 0 GROUP BY fold),
tr AS (SELECT {metrics_sql()} FROM pr WHERE k = -1)
SELECT 'cv' AS stage, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse FROM pf
UNION ALL SELECT 'training', round(corr, 8), round(mae, 4), round(rmse, 4) FROM tr"""
    q["m3_ridge_regression"] = f"""WITH RECURSIVE {_encoding_ctes()},
st AS (SELECT pos, avg(value) AS m, stddev_pop(value) AS s FROM enc GROUP BY pos),
ys AS (SELECT avg(label) AS ym, stddev_pop(label) AS ysd, count(*)::DOUBLE AS n FROM rows),
zc AS (SELECT e.id, e.pos, CASE WHEN st.s = 0 THEN 0.0::DOUBLE ELSE (e.value - st.m) / st.s END AS z
       FROM enc e JOIN st ON st.pos = e.pos),
cm AS (SELECT a.pos AS i, b.pos AS j,
              sum(a.z * b.z) / (SELECT n FROM ys) + CASE WHEN a.pos = b.pos THEN 0.1 / (SELECT ysd FROM ys) ELSE 0.0 END AS c
       FROM zc a JOIN zc b ON a.id = b.id GROUP BY a.pos, b.pos),
cvec AS (SELECT zc.pos AS i, sum(zc.z * (r.label - ys.ym)) / (ys.n * ys.ysd) AS c
         FROM zc JOIN rows r ON r.id = zc.id, ys GROUP BY zc.pos, ys.n, ys.ysd),
sys AS (SELECT 0 AS k, (SELECT list(r ORDER BY i) FROM (SELECT i, list(c ORDER BY j) AS r FROM cm GROUP BY i) x) AS A,
               (SELECT list(c ORDER BY i) FROM cvec) AS b),
{_cg_chain()},
coef AS (SELECT CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS pos, unnest(x) AS xv FROM sol),
raw AS (SELECT coef.pos, CASE WHEN st.s = 0 THEN 0.0 ELSE coef.xv * ys.ysd / st.s END AS c, st.m
        FROM coef JOIN st ON st.pos = coef.pos, ys),
names AS (SELECT CAST(off.start + lv.idx - 1 AS INTEGER) AS pos, lv.col || '=' || lv.level AS feature
          FROM lv JOIN off ON off.col = lv.col WHERE lv.idx >= 1
          UNION ALL SELECT CAST(nd.total + k.k AS INTEGER), 'n' || CAST(k.k + 1 AS VARCHAR)
          FROM nd, (VALUES (0), (1), (2), (3)) k(k))
SELECT names.feature, round(raw.c, 4) AS coefficient FROM raw JOIN names ON names.pos = raw.pos
UNION ALL SELECT '(intercept)', round((SELECT ym FROM ys) - sum(c * m), 4) FROM raw"""
    q["m9_sgd_cv_all_features"] = f"""{_SGD_ALL}it(k, i, w, done) AS (
    SELECT sys.k, 0, list_transform(range(dim.d + 1),
                                    lambda q: CASE WHEN q = dim.d THEN 1.0 ELSE 0.0 END::DOUBLE), false
    FROM sys, dim
    UNION ALL
    SELECT k, i, nw,
           i >= 2 AND sqrt(list_sum(list_transform(list_zip(nw, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))
                      < 0.001 * greatest(sqrt(list_dot_product(nw, nw)), 1.0)
    FROM (SELECT it.k, it.i + 1 AS i, it.w,
                 list_transform(list_zip(it.w, sys.G, sys.h),
                                lambda p: p[1] - (1.0 / sqrt(it.i + 1)) * (list_dot_product(p[2], it.w) - p[3]) / sys.n) AS nw
          FROM it JOIN sys ON sys.k = it.k WHERE it.i < 200 AND NOT it.done) s
),
fin AS (SELECT it.k, it.w FROM it JOIN (SELECT k, max(i) AS i FROM it GROUP BY k) l ON l.k = it.k AND l.i = it.i),
wl AS (SELECT k, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS wv FROM fin),
cvp AS (SELECT zf.id, zf.fold AS k, sum(wl.wv * zf.z) AS raw FROM zf JOIN wl ON wl.k = zf.fold AND wl.pos = zf.pos
        GROUP BY zf.id, zf.fold),
trp AS (SELECT zf.id, -1 AS k, sum(wl.wv * zf.z) AS raw FROM zf JOIN wl ON wl.k = -1 AND wl.pos = zf.pos GROUP BY zf.id),
pr AS (SELECT p.k, lab.fold, lab.y, {half_up('p.raw')} AS p
       FROM (SELECT * FROM cvp UNION ALL SELECT * FROM trp) p JOIN lab ON lab.id = p.id),
pf AS (SELECT fold, {metrics_sql()} FROM pr WHERE k >= 0 GROUP BY fold),
tr AS (SELECT {metrics_sql()} FROM pr WHERE k = -1)
SELECT 'cv' AS stage, round(avg(corr), 8) AS corr, round(avg(mae), 4) AS mae, round(avg(rmse), 4) AS rmse FROM pf
UNION ALL SELECT 'training', round(corr, 8), round(mae, 4), round(rmse, 4) FROM tr"""
    q["m14_training_error"] = f"""{_LS_PRED}
SELECT n, round(corr, 8) AS corr, round(mae, 4) AS mae, round(rmse, 4) AS rmse
FROM (SELECT {metrics_sql()} FROM pr WHERE k = -1) s"""
    q["m15_score_table"] = f"""{scored}
SELECT id, {half_up('raw')} AS prediction, unseen_levels FROM scored"""
    q["m16_pooled_cv_least_squares"] = f"""{_LS_PRED}
SELECT n, round(corr, 8) AS corr, round(mae, 4) AS mae, round(rmse, 4) AS rmse
FROM (SELECT {metrics_sql('y', 'raw')} FROM pr WHERE k >= 0) s"""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
    lines = """SELECT l_orderkey::VARCHAR AS l_orderkey, l_partkey::VARCHAR AS l_partkey, l_suppkey::VARCHAR AS l_suppkey,
  l_returnflag FROM lineitem"""
    ranks = " UNION ALL ".join(
        f"SELECT '{c}' AS col, {c} AS level, row_number() OVER (ORDER BY {c}) - 1 AS idx, n FROM "
        f"(SELECT {c}, count(*) AS n FROM li GROUP BY {c})" for c in keys)
    q["e3_wide_level_index"] = f"WITH li AS ({lines}) {ranks}"
    codes = ", ".join(f"sum(k{i}.idx)::BIGINT AS code_{i}" for i in range(4))
    lookups = " ".join(f"JOIN rk k{i} ON k{i}.col = '{c}' AND k{i}.level = li.{c}" for i, c in enumerate(keys))
    q["j2_wide_lookup"] = f"""WITH li AS ({lines}), rk AS ({ranks})
SELECT li.l_orderkey::BIGINT AS l_orderkey, count(*) AS n, {codes} FROM li {lookups} GROUP BY li.l_orderkey"""
    slots = ", ".join(f"max(CASE WHEN jl.col = 'c{i}' THEN CASE WHEN lv.idx = 0 THEN -1 ELSE off.start + lv.idx - 1 END END)::BIGINT AS c{i}"
                      for i in range(1, 6))
    q["e5_coded_design"] = f"""WITH {_encoding_ctes()}
SELECT jl.id, {slots}, any_value(round(r.n2, 4)) AS n2 FROM jl JOIN lv ON lv.col = jl.col AND lv.level = jl.level
JOIN off ON off.col = jl.col JOIN rows r ON r.id = jl.id GROUP BY jl.id"""
    q["a9_coded_moments"] = f"""WITH {_encoding_ctes()},
one AS (SELECT n.id, n.pos::BIGINT AS pos, {fold_expr('n.id')} AS fold FROM nom n WHERE n.value = 1.0)
SELECT fold, pos AS a, (-1)::BIGINT AS b, count(*) AS n, round(sum(r.n2), 2) AS sum_n2, round(sum(r.label), 6) AS sum_label
FROM one JOIN rows r ON r.id = one.id GROUP BY fold, pos
UNION ALL
SELECT x.fold, x.pos, y.pos, count(*), NULL, NULL FROM one x JOIN one y ON x.id = y.id AND x.pos < y.pos GROUP BY 1, 2, 3"""
    q["m2_wide_least_squares"] = _LS_COEF
    q["m16_wide_cv_least_squares"] = q["m16_pooled_cv_least_squares"]
    q["j1_bucketed_join"] = f"SELECT id, c1, n1, round(n2, 4) AS n2, round(label, 6) AS label FROM ({TJ}) t"
    q["c1_reused_table"] = f"""SELECT fold, count(*) AS n, round(sum(n2), 2) AS n2, round(sum(label), 2) AS label
FROM ({TF}) t GROUP BY fold"""
    # DuckDB rounds a tiny negative to -0.0 where Spark's decimal rounding gives 0.0
    return {k: v.replace("round(", "0.0 + round(") for k, v in q.items()}
