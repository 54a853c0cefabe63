"""DuckDB SQL for the correctness oracle (``__spark_entry__.oracle_sql``).

Written independently of the Spark code: plain joins, window functions and recursive
CTEs over the driver's tables. Distances are summed left to right with ``list_reduce``
so threshold tests agree with the Spark expressions bit for bit.
"""

from __future__ import annotations


def dist(a: str, b: str) -> str:
    return (f"sqrt(list_reduce(list_transform(list_zip({a}, {b}), lambda t: (t[1] - t[2]) * (t[1] - t[2])), "
            f"lambda p, q: p + q))")


# ---------------------------------------------------------------- retail

RETAIL = """
SELECT o.o_orderkey AS transaction_id, l.l_partkey AS product_id,
       CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS quantity,
       o.o_custkey AS customer_id, n.n_name AS country
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


def retail_pairs(country: str | None) -> str:
    cond = f" AND country = '{country}'" if country else ""
    return (f"SELECT DISTINCT product_id, customer_id FROM ({RETAIL}) r "
            f"WHERE quantity > 0 AND customer_id IS NOT NULL AND product_id IS NOT NULL{cond}")


def retail_popularity(country: str | None) -> str:
    return (f"SELECT product_id, count(*) AS popularity FROM ({retail_pairs(country)}) p GROUP BY product_id")


def retail_top(country: str | None, h: int) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY popularity DESC, product_id) AS INTEGER) AS rank, "
            f"product_id, popularity FROM ({retail_popularity(country)}) q "
            f"ORDER BY popularity DESC, product_id LIMIT {h}")


def retail_listing(country: str | None) -> str:
    return (f"SELECT row_number() OVER (ORDER BY pid) AS position, pid AS product_id, popularity FROM ("
            f"SELECT CAST(product_id AS VARCHAR) AS pid, popularity FROM ({retail_popularity(country)}) q) s")


def retail_report(country: str | None, h: int) -> str:
    head = (f"SELECT 'rows' AS section, 1::BIGINT AS position, NULL::VARCHAR AS product_id, count(*) AS value FROM ({RETAIL}) a "
            f"UNION ALL SELECT 'pairs', 1, NULL, count(*) FROM ({retail_pairs(country)}) b")
    if h:
        return head + f" UNION ALL SELECT 'top', rank, CAST(product_id AS VARCHAR), popularity FROM ({retail_top(country, h)}) c"
    return head + "".join(f" UNION ALL SELECT '{s}', position, product_id, popularity FROM ({retail_listing(country)}) d_{s}"
                          for s in ("popularity", "popularity_two_stage"))


def retail_rejects(country: str) -> str:
    """Strict faults of the rendered text: every 50th product has no number for a quantity, every
    41st order no customer, every 77th customer a row that ends before the country."""
    return f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(product_id AS VARCHAR) AS product_id, short AS bad_country,
       NOT short AND country = '{country}' AND bad_q AS bad_quantity,
       NOT short AND country = '{country}' AND NOT bad_q AND quantity > 0 AND bad_c AS bad_customer
FROM (SELECT *, customer_id % 77 = 0 AS short, product_id % 50 = 0 AS bad_q, transaction_id % 41 = 0 AS bad_c FROM ({RETAIL}) r) s
WHERE short OR (country = '{country}' AND (bad_q OR (quantity > 0 AND bad_c)))
"""


# ---------------------------------------------------------------- points

POINTS1 = "SELECT c_custkey AS point_id, [c_acctbal] AS x FROM customer"
POINTS64 = "SELECT vec_id AS point_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"
POINTS2 = "SELECT p_partkey AS point_id, [CAST(p_size AS DOUBLE), CAST(p_retailprice AS DOUBLE)] AS x FROM part"

LABEL_CENTERS = ("SELECT CAST(label AS INTEGER) AS step, arg_min(CAST(embedding AS DOUBLE[]), vec_id) AS x "
                 "FROM embeddings GROUP BY label")


def nearest(points: str, centers: str) -> str:
    cx = f"(SELECT list(x ORDER BY step) FROM ({centers}) c)"
    return f"""
SELECT point_id, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS nearest, round(list_min(ds), 9) AS distance
FROM (SELECT point_id, list_transform({cx}, lambda cc: {dist('x', 'cc')}) AS ds FROM ({points}) p) s
"""


def objective(points: str, centers: str, z: int | str) -> str:
    cx = f"(SELECT list(x ORDER BY step) FROM ({centers}) c)"
    return f"""
SELECT round(d, 9) AS objective FROM (
  SELECT list_min(list_transform({cx}, lambda cc: {dist('x', 'cc')})) AS d FROM ({points}) p)
ORDER BY d DESC LIMIT 1 OFFSET {z}
"""


def fft_ctes(points: str, parts: int, m: int) -> str:
    """CTEs ``pts`` (part by point_id mod parts), ``fin`` (per part: ids, cxs) and ``cs``
    (the weighted coreset: part, pos, point_id, x, weight, rho)."""
    md = f"list_min(list_transform(cxs, lambda cc: {dist('x', 'cc')}))"
    return f"""
pts AS (SELECT point_id, x, CAST(point_id % {parts} AS INTEGER) AS part FROM ({points}) src),
trav(step, part, ids, cxs) AS (
  SELECT 0, part, [min(point_id)], [arg_min(x, point_id)] FROM pts GROUP BY part
  UNION ALL
  SELECT step + 1, part,
         CASE WHEN nid IS NULL THEN ids ELSE list_append(ids, nid) END,
         CASE WHEN nid IS NULL THEN cxs ELSE list_append(cxs, nx) END
  FROM (
    SELECT step, part, any_value(ids) AS ids, any_value(cxs) AS cxs,
           first(point_id ORDER BY md DESC, point_id) FILTER (WHERE md > 0) AS nid,
           first(x ORDER BY md DESC, point_id) FILTER (WHERE md > 0) AS nx
    FROM (SELECT t.step, t.part, t.ids, t.cxs, p.point_id, p.x, {md.replace('(x,', '(p.x,').replace('cxs', 't.cxs')} AS md
          FROM trav t JOIN pts p ON p.part = t.part WHERE t.step < {m} - 1) s
    GROUP BY step, part)
),
fin AS (SELECT part, ids, cxs FROM trav WHERE step = {m} - 1),
asg AS (SELECT part, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS pos, list_min(ds) AS d
        FROM (SELECT p.part, list_transform(f.cxs, lambda cc: {dist('p.x', 'cc')}) AS ds
              FROM pts p JOIN fin f ON p.part = f.part) a),
wts AS (SELECT part, pos, count(*) AS weight, max(d) AS rho FROM asg GROUP BY part, pos),
cs AS (SELECT f.part, CAST(i - 1 AS INTEGER) AS pos, f.ids[i] AS point_id, f.cxs[i] AS x, w.weight, w.rho
       FROM fin f, generate_series(1, len(f.ids)) AS g(i)
       JOIN wts w ON w.part = f.part AND w.pos = i - 1)
"""


def fft_coreset(points: str, parts: int, m: int) -> str:
    return (f"WITH RECURSIVE {fft_ctes(points, parts, m)} "
            f"SELECT part, pos, point_id, weight, round(rho, 9) AS rho FROM cs")


def coreset_weighted(m: int) -> str:
    """Weighted set (idx, point_id, x, w) from the ``cs`` CTE, ordered by (part, pos)."""
    return f"SELECT CAST(part * {m} + pos AS BIGINT) AS idx, point_id, x, weight AS w FROM cs"


def greedy_ctes(weighted: str, k: int, z: int, alpha: float) -> str:
    """CTEs for the weighted greedy over ``weighted`` (idx, point_id, x, w).

    ``sched(g, r)``: every radius guess; ``st(step, g, j, unc, c)``: coverage state per
    guess and step (all guesses in parallel; a guess stops at k centers or no uncovered
    weight); ``res``: accepted guess with r_initial, r_final; ``cen``: its centers.
    """
    m = k + z + 1
    ball = 1 + 2 * alpha
    cover = 3 + 4 * alpha
    return f"""
gw AS ({weighted}),
gp AS (SELECT CAST(row_number() OVER (ORDER BY idx) - 1 AS INTEGER) AS pos, idx, point_id, x, w FROM gw),
pd AS (SELECT a.pos AS i, b.pos AS j, {dist('a.x', 'b.x')} AS d FROM gp a, gp b),
hd AS (SELECT min(d) AS dmin, min(d) FILTER (WHERE d > 0) AS dpos FROM pd WHERE i < j AND j < {m}),
fr AS (SELECT max(d) AS dmax, min(d) FILTER (WHERE d > 0) AS dpos0 FROM pd WHERE i = 0),
base AS (SELECT coalesce(hd.dmin, 0) = 0 AS zero_first,
                CASE WHEN coalesce(hd.dmin, 0) > 0 THEN hd.dmin / 2 ELSE coalesce(hd.dpos / 2, fr.dpos0 / 2) END AS rs,
                2 * fr.dmax AS bound FROM hd, fr),
ex AS (SELECT e FROM base, generate_series(0, 2000) AS s(e) WHERE base.rs IS NOT NULL),
emax AS (SELECT min(ex.e) AS e FROM ex, base WHERE {cover} * (base.rs * pow(2, ex.e)) >= base.bound),
sched AS (
  SELECT 0 AS g, 0.0::DOUBLE AS r FROM base WHERE zero_first
  UNION ALL
  SELECT CAST(ex.e + CASE WHEN zero_first THEN 1 ELSE 0 END AS INTEGER) AS g, rs * pow(2, ex.e) AS r
  FROM ex, base, emax WHERE ex.e <= emax.e),
st(step, g, j, unc, c) AS (
  SELECT 0, s.g, p.pos, TRUE, CAST(NULL AS INTEGER) FROM sched s, gp p
  UNION ALL
  SELECT cur.step + 1, cur.g, cur.j, cur.unc AND NOT (pc.d <= {cover} * sc.r), best.c
  FROM st cur
  JOIN (
    SELECT g, first(i ORDER BY bw DESC, i) AS c FROM (
      SELECT s2.g, q.i, sum(p2.w) AS bw
      FROM (SELECT st2.*, sum(CASE WHEN st2.unc THEN gp2.w ELSE 0 END) OVER (PARTITION BY st2.g) AS wz
            FROM st st2 JOIN gp gp2 ON gp2.pos = st2.j) s2
      JOIN sched s3 ON s3.g = s2.g
      JOIN pd q ON q.j = s2.j
      JOIN gp p2 ON p2.pos = s2.j
      WHERE s2.unc AND s2.wz > 0 AND s2.step < {k} AND q.d <= {ball} * s3.r
      GROUP BY s2.g, q.i) b
    GROUP BY g) best ON best.g = cur.g
  JOIN sched sc ON sc.g = cur.g
  JOIN pd pc ON pc.i = best.c AND pc.j = cur.j
),
lastst AS (SELECT g, max(step) AS last FROM st GROUP BY g),
wz AS (SELECT st.g, sum(CASE WHEN st.unc THEN gp.w ELSE 0 END) AS wz
       FROM st JOIN lastst l ON l.g = st.g AND l.last = st.step JOIN gp ON gp.pos = st.j GROUP BY st.g),
res AS (SELECT min(wz.g) AS g FROM wz WHERE wz.wz <= {z}),
rinfo AS (SELECT res.g AS g, (SELECT r FROM sched WHERE g = 0) AS r_initial, s.r AS r_final,
                 CAST(res.g + 1 AS INTEGER) AS guesses FROM res JOIN sched s ON s.g = res.g),
cen AS (SELECT DISTINCT CAST(st.step - 1 AS INTEGER) AS step, st.c FROM st JOIN res ON st.g = res.g WHERE st.step > 0)
"""


def greedy_centers(prefix_ctes: str, weighted: str, k: int, z: int, alpha: float) -> str:
    ctes = (prefix_ctes + ",\n" if prefix_ctes else "") + greedy_ctes(weighted, k, z, alpha)
    return f"""WITH RECURSIVE {ctes}
SELECT cen.step, gp.point_id, round(rinfo.r_initial, 9) AS r_initial, round(rinfo.r_final, 9) AS r_final, rinfo.guesses
FROM cen JOIN gp ON gp.pos = cen.c, rinfo
"""


def parse_points_sql() -> str:
    text = f"SELECT point_id, CAST(x[1] AS VARCHAR) || ',' || CAST(x[2] AS VARCHAR) AS value FROM ({POINTS2}) p"
    return (f"SELECT point_id, list_transform(string_split(regexp_replace(value, ',+$', ''), ','), "
            f"lambda t: TRY_CAST(trim(t) AS DOUBLE)) AS x FROM ({text}) t WHERE length(trim(value)) > 0")


def _head_ctes(weighted: str, m: int) -> str:
    return f"""
hw AS ({weighted}),
hp AS (SELECT CAST(row_number() OVER (ORDER BY idx) - 1 AS INTEGER) AS pos, idx, point_id, x, w FROM hw),
hpairs AS (SELECT {dist('a.x', 'b.x')} AS d FROM hp a JOIN hp b ON a.pos < b.pos WHERE b.pos < {m})
"""


def initial_radius_sql(prefix_ctes: str, weighted: str, m: int) -> str:
    return f"""WITH RECURSIVE {prefix_ctes}, {_head_ctes(weighted, m)}
SELECT round(min(d) / 2, 9) AS r0, round(min(d) FILTER (WHERE d > 0) / 2, 9) AS r0_positive,
       CAST((SELECT least(count(*), {m}) FROM hp) AS INTEGER) AS head_size
FROM hpairs
"""


def ball_weights_sql(prefix_ctes: str, weighted: str, m: int, factor: float) -> str:
    return f"""WITH RECURSIVE {prefix_ctes}, {_head_ctes(weighted, m)},
rad AS (SELECT {factor} * (min(d) / 2) AS r FROM hpairs)
SELECT a.point_id, CAST(sum(b.w) AS BIGINT) AS ball_weight
FROM hp a JOIN hp b ON {dist('a.x', 'b.x')} <= (SELECT r FROM rad)
GROUP BY a.point_id
"""


def summary_sql(points: str, prefix_ctes: str, weighted: str, k: int, z: int, parts: int, alpha: float) -> str:
    cover = 3 + 4 * alpha
    ctes = prefix_ctes + ",\n" + greedy_ctes(weighted, k, z, alpha)
    return f"""WITH RECURSIVE {ctes},
cx AS (SELECT list(gp.x ORDER BY cen.step) AS cxs, count(*) AS nc FROM cen JOIN gp ON gp.pos = cen.c),
obj AS (SELECT d FROM (SELECT list_min(list_transform(cx.cxs, lambda cc: {dist('p.x', 'cc')})) AS d
                       FROM ({points}) p, cx) s ORDER BY d DESC LIMIT 1 OFFSET {z}),
cst AS (SELECT count(*) AS coreset_size, sum(weight) AS coreset_weight, max(rho) AS rho FROM cs)
SELECT CAST((SELECT count(*) FROM ({points}) q) AS BIGINT) AS n, {k} AS k, {z} AS z, {parts} AS num_parts,
       cst.coreset_size, CAST(cst.coreset_weight AS BIGINT) AS coreset_weight,
       round(rinfo.r_initial, 9) AS r_initial, round(rinfo.r_final, 9) AS r_final, rinfo.guesses,
       cx.nc AS num_centers, round(obj.d, 9) AS objective, round(cst.rho, 9) AS rho,
       round({cover} * rinfo.r_final + cst.rho, 9) AS bound
FROM rinfo, cx, obj, cst
"""
