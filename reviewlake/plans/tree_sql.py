"""The classification tree as SQL: candidate thresholds, five levels of splits, merged leaves.

Grows the same tree as a depth-limited Gini tree over ``wt`` (event_id, is_test,
label, f, weight), one level a step, from the training rows alone; test rows
walk along. It follows the published rules of the tree learner: at most 31
thresholds a feature (all midpoints, or at equal strides of the rows), the
largest gain, ties to the lower feature and threshold, a split only for a gain
above 0, and sibling leaves of one class merged.
"""

from __future__ import annotations

BINS = 32


def _splits() -> str:
    """``cut`` (f, thr): the candidate thresholds of each feature."""
    grow = "abs(a.cur - a.goal) < abs(a.cur + x.c - a.goal)"
    return f"""seen AS (SELECT f, weight AS v, count(*)::DOUBLE AS c FROM wt WHERE NOT is_test AND weight <> 0 GROUP BY ALL),
vals AS (SELECT * FROM seen UNION ALL
         SELECT f, 0.0, m.m - sum(c) FROM seen, m GROUP BY f, m.m HAVING m.m - sum(c) > 0),
lists AS (SELECT f, count(*) AS n, list({{'v': v, 'c': c, 'cur': c, 'goal': m.m / {BINS}.0, 'thr': []::DOUBLE[]}} ORDER BY v) AS l, m.m / {BINS}.0 AS stride
          FROM vals, m GROUP BY f, m.m),
cut AS MATERIALIZED (
  SELECT f, unnest(list_transform(range(1, n), lambda i: (l[i].v + l[i + 1].v) / 2.0)) AS thr FROM lists WHERE n <= {BINS}
  UNION ALL
  SELECT f, unnest(list_reduce(l, lambda a, x: {{'v': x.v, 'c': x.c, 'cur': a.cur + x.c,
      'goal': CASE WHEN {grow} THEN a.goal + x.goal ELSE a.goal END,
      'thr': CASE WHEN {grow} THEN list_append(a.thr, (a.v + x.v) / 2.0) ELSE a.thr END}}).thr) FROM lists WHERE n > {BINS})"""


def _gini(a: str, b: str) -> str:
    n = f"({a} + {b})"
    return f"(1.0 - ({a} / {n}) * ({a} / {n}) - ({b} / {n}) * ({b} / {n}))"


def tree_ctes(depth: int = 5) -> str:
    """CTEs after ``used``, ``wt`` and ``m``: ``node`` (node, f, thr, n0, n1, gain) and ``tree_scored``
    (event_id, label, prediction, probability) of the test rows; nodes are numbered 1, 2n, 2n + 1."""
    steps = [_splits(), "at0 AS MATERIALIZED (SELECT event_id, is_test, label, 1::BIGINT AS node FROM used)"]
    for d in range(depth):
        lo = 2 ** d
        steps.append(f"""st{d} AS MATERIALIZED (
  SELECT node, count(*) FILTER (label = 0)::DOUBLE AS n0, count(*) FILTER (label = 1)::DOUBLE AS n1
  FROM at{d} WHERE NOT is_test AND node >= {lo} GROUP BY node)""")
        steps.append(f"""best{d} AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, {_gini('n0', 'n1')} - (l0 + l1) / (n0 + n1) * {_gini('l0', 'l1')} - (r0 + r1) / (n0 + n1) * {_gini('r0', 'r1')} AS gain
    FROM (SELECT st{d}.node, n0, n1, r.f, r.thr, n0 - r0 AS l0, n1 - r1 AS l1, r0, r1 FROM st{d} JOIN (
            SELECT w.node, w.f, cut.thr, sum(c0) AS r0, sum(c1) AS r1 FROM (
              SELECT at{d}.node, wt.f, wt.weight, count(*) FILTER (wt.label = 0)::DOUBLE AS c0, count(*) FILTER (wt.label = 1)::DOUBLE AS c1
              FROM wt JOIN at{d} USING (event_id) WHERE NOT wt.is_test AND at{d}.node >= {lo} GROUP BY ALL) w
            JOIN cut ON cut.f = w.f AND w.weight > cut.thr GROUP BY ALL) r USING (node)) s
    WHERE l0 + l1 >= 1 AND r0 + r1 >= 1) g
  WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, thr) = 1)""")
        steps.append(f"""at{d + 1} AS MATERIALIZED (
  SELECT a.event_id, a.is_test, a.label, CASE WHEN b.node IS NULL THEN a.node
         WHEN coalesce(w.weight, 0.0) <= b.thr THEN 2 * a.node ELSE 2 * a.node + 1 END AS node
  FROM at{d} a LEFT JOIN best{d} b ON b.node = a.node LEFT JOIN wt w ON w.event_id = a.event_id AND w.f = b.f)""")
    splits = " UNION ALL ".join(f"SELECT node, f, thr, gain FROM best{d}" for d in range(depth))
    counts = " UNION ALL ".join([f"SELECT * FROM st{d}" for d in range(depth)] + [
        f"SELECT node, count(*) FILTER (label = 0)::DOUBLE, count(*) FILTER (label = 1)::DOUBLE "
        f"FROM at{depth} WHERE NOT is_test AND node >= {2 ** depth} GROUP BY node"])
    steps.append(f"""node AS MATERIALIZED (
  SELECT c.node, s.f, s.thr, s.gain, c.n0, c.n1, CASE WHEN c.n1 > c.n0 THEN 1.0 ELSE 0.0 END AS pred
  FROM ({counts}) c LEFT JOIN ({splits}) s USING (node))""")
    # from the bottom up: a split whose children are leaves of one class is a leaf itself
    steps.append(f"leaf{depth} AS (SELECT node, pred, TRUE AS leaf FROM node WHERE node >= {2 ** depth})")
    for d in reversed(range(depth)):
        steps.append(f"""leaf{d} AS MATERIALIZED (
  SELECT n.node, n.pred, n.f IS NULL OR (a.leaf AND b.leaf AND a.pred = b.pred) AS leaf
  FROM node n LEFT JOIN leaf{d + 1} a ON a.node = 2 * n.node LEFT JOIN leaf{d + 1} b ON b.node = 2 * n.node + 1
  WHERE n.node >= {2 ** d} AND n.node < {2 ** (d + 1)})""")
    leaves = " UNION ALL ".join(f"SELECT * FROM leaf{d}" for d in range(depth + 1))
    steps.append(f"""leaves AS MATERIALIZED (SELECT node FROM ({leaves}) x WHERE leaf),
walked AS (SELECT a.event_id, a.label, min(l.node) AS node FROM (
    SELECT event_id, label, unnest(list_transform(range(0, {depth + 1}), lambda k: node >> k::BIGINT)) AS up
    FROM at{depth} WHERE is_test) a JOIN leaves l ON l.node = a.up GROUP BY ALL),
tree_scored AS MATERIALIZED (
  SELECT w.event_id, w.label, n.pred AS prediction, n.n1 / (n.n0 + n.n1) AS probability FROM walked w JOIN node n USING (node))""")
    return ",\n".join(steps)
