"""The same answers in ANSI SQL, for an independent engine to check."""

from __future__ import annotations

from ledgerlens import schema as S
from ledgerlens.plans.catalogue import FITTED, GLOBE, PLANE, SAMPLE, SPACE

FEATURES = S.MODEL_FEATURES


def _word(seed: str) -> str:
    return f"('0x' || substr(md5('{seed}|' || event_id::varchar), 1, 8))::bigint"


_TRAIN = f"{_word('42')}::double / 4294967296.0::double < 0.8::double"

_V = ",\n    ".join(f"m.embedding[{i}]::double AS V{i}" for i in range(1, 29))

TXN = f"""
txn_wide AS MATERIALIZED (
  SELECT e.event_id, {_word('42')} % 1000 AS b,
    (cast(floor(epoch(e.ts)) AS bigint) - (SELECT min(cast(floor(epoch(ts)) AS bigint)) FROM events))::double AS Time,
    {_V},
    e.value::double AS Amount
  FROM events e JOIN embeddings m ON m.vec_id = e.event_id % (SELECT count(*) FROM embeddings)
),
txn AS MATERIALIZED (
  SELECT *, (CASE WHEN (V3 + V7 > 0.25::double AND Amount > 20.0::double) <> (b < 5) THEN 1 ELSE 0 END)::int AS Class
  FROM txn_wide
)"""


def _with(*parts: str, tail: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + tail


def _r(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0::double AS {name}"


def _ratios(source: str, extra: str = "") -> str:
    """Counts and guarded ratios of a relation with tp, fp, fn, tn."""
    return f"""
SELECT tp, fp, fn, tn, total, {_r('p', 'precision')}, {_r('r', 'recall')},
  {_r('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0::double END', 'f1')},
  {_r('CASE WHEN total > 0 THEN (tp + tn)::double / total ELSE 0.0::double END', 'accuracy')} {extra}
FROM (
  SELECT *, tp + fp + fn + tn AS total,
    CASE WHEN tp + fp > 0 THEN tp::double / (tp + fp) ELSE 0.0::double END AS p,
    CASE WHEN tp + fn > 0 THEN tp::double / (tp + fn) ELSE 0.0::double END AS r
  FROM {source}
)"""


_COUNTS = """count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 1 AND label = 0) AS fp,
  count(*) FILTER (prediction = 0 AND label = 1) AS fn, count(*) FILTER (prediction = 0 AND label = 0) AS tn"""

_WEIGHTED = """(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::double * tp / (2 * tp + fp + fn) ELSE 0 END * (tp + fn)
  + CASE WHEN 2 * tn + fp + fn > 0 THEN 2.0::double * tn / (2 * tn + fp + fn) ELSE 0 END * (tn + fp)) / total"""

_RULE = """rule AS (
  SELECT (V3 + V7 > 0.2::double AND Amount > 15.0::double)::int AS prediction, Class AS label FROM txn
)"""

# One row per event and feature.
_LONG = f"long AS MATERIALIZED (UNPIVOT (SELECT event_id, b, Class, {', '.join(FEATURES)} FROM txn) ON {', '.join(FEATURES)} INTO NAME feature VALUE v)"

_MINMAX = [
    _LONG,
    "span AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM long GROUP BY feature)",
    """mm AS MATERIALIZED (
  SELECT event_id, b, Class AS label, feature,
    CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0.5::double END AS v
  FROM long JOIN span USING (feature)
)""",
]

_UNDER = f"""share AS (
  SELECT least(1.0::double, count(*) FILTER (label = 1)::double / count(*) FILTER (label = 0)) AS f FROM pool
),
kept AS (
  SELECT event_id, label FROM pool, share
  WHERE label = 1 OR {_word('undersample')}::double / 4294967296.0::double < f
)"""

_BAYES = _MINMAX + [
    f"pool AS (SELECT event_id, Class AS label FROM txn WHERE {_TRAIN})",
    _UNDER,
    "n_class AS (SELECT label, count(*) AS n FROM kept GROUP BY label)",
    "s AS (SELECT mm.label, feature, sum(v) AS s FROM mm JOIN kept USING (event_id) GROUP BY mm.label, feature)",
    f"""theta AS (
  SELECT label, feature, ln(n + 1.0::double) - ln((SELECT sum(n) FROM n_class) + 2.0::double) AS log_prior,
    ln(s + 1.0::double) - ln(sum(s) OVER (PARTITION BY label) + {len(FEATURES)}.0::double) AS log_likelihood
  FROM s JOIN n_class USING (label)
)""",
]

_SCORES = _BAYES + [
    f"""joint AS (
  SELECT event_id, mm.label AS label, theta.label AS c, sum(v * log_likelihood) + min(log_prior) AS l
  FROM mm JOIN theta USING (feature) WHERE NOT ({_TRAIN}) GROUP BY ALL
)""",
    """scores AS MATERIALIZED (
  SELECT one.event_id, one.label::double AS label, 1.0::double / (1.0::double + exp(zero.l - one.l)) AS p1
  FROM joint one JOIN joint zero USING (event_id) WHERE one.c = 1 AND zero.c = 0
)""",
    """sweep AS MATERIALIZED (
  SELECT t, count(*) FILTER (p1 >= t AND label = 1) AS tp, count(*) FILTER (p1 >= t AND label = 0) AS fp,
    count(*) FILTER (p1 < t AND label = 1) AS fn, count(*) FILTER (p1 < t AND label = 0) AS tn
  FROM scores, (SELECT i / 100.0::double AS t FROM range(1, 100) r(i)) GROUP BY t
)""",
    """f1s AS (
  SELECT t, CASE WHEN tp > 0 THEN 2.0::double * p * r / (p + r) ELSE 0.0::double END AS f1
  FROM (SELECT t, tp, tp::double / nullif(tp + fp, 0) AS p, tp::double / nullif(tp + fn, 0) AS r FROM sweep)
)""",
    """best AS (
  SELECT coalesce((SELECT t FROM f1s WHERE f1 > 0 ORDER BY f1 DESC, t LIMIT 1), 0.5::double) AS t,
    coalesce((SELECT max(f1) FROM f1s), 0.0::double) AS f1
)""",
]


def _clusters(
    points: str, coords: list[str], eps: float, min_pts: int, reach: str, apart: float | None = None, within: str | None = None
) -> list[str]:
    """Brute-force DBSCAN of the relation `points` (id, coordinates).

    The join is narrowed to points that differ by at most `apart` in `reach`; `within` tells near pairs if not the coordinates.
    """
    square = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in coords)
    apart = eps * 1.001 if apart is None else apart
    within = within or f"{square} <= {eps}::double * {eps}::double"
    return [
        f"points AS MATERIALIZED ({points})",
        f"""near AS MATERIALIZED (
  SELECT a.id AS a, b.id AS b FROM points a JOIN points b
    ON b.{reach} BETWEEN a.{reach} - {apart} AND a.{reach} + {apart}
  WHERE {within}
)""",
        f"core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {min_pts})",
        """links AS MATERIALIZED (
  SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)
)""",
        # Every round takes the smallest label among the neighbours' labels and their labels.
        """rounds AS (
  SELECT id, id AS l, 0 AS i FROM core
  UNION ALL
  SELECT x.id, least(x.l, y.l, z.l), x.i + 1
  FROM rounds x
  JOIN (SELECT links.a, min(r.l) AS l FROM links JOIN rounds r ON r.id = links.b GROUP BY links.a) y ON y.a = x.id
  JOIN rounds z ON z.id = y.l
  WHERE x.i < 300
)""",
        "labelled AS MATERIALIZED (SELECT id, l FROM rounds WHERE i = 300)",
        """clusters AS MATERIALIZED (
  SELECT id AS point, l AS component, true AS is_core FROM labelled
  UNION ALL
  SELECT near.a, min(l), false FROM near JOIN labelled ON labelled.id = near.b
  WHERE near.a NOT IN (SELECT id FROM core) GROUP BY near.a
)""",
    ]


_PLANE_POINTS = "SELECT event_id AS id, user_id / 150.0::double AS x, value / 500.0::double AS y FROM events"
_PLANE = _clusters(_PLANE_POINTS, ["x", "y"], PLANE["eps"], PLANE["min_pts"], "x")
_GLOBE_POINTS = """SELECT event_id AS id, user_id / 1.25::double - 60 AS lat, value / 500.0::double * 360 - 180 AS lon FROM events"""
_KM = """2 * 6371.0088::double * asin(sqrt(least(1.0::double, pow(sin((radians(a.lat) - radians(b.lat)) / 2), 2)
  + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin((radians(a.lon) - radians(b.lon)) / 2), 2))))"""
_GLOBE = _clusters(
    _GLOBE_POINTS, ["lat", "lon"], GLOBE["eps"], GLOBE["min_pts"], "lat", 1.0, f"{_KM} <= {GLOBE['eps']}::double"
)
_SPACE_POINTS = f"SELECT event_id AS id, {', '.join(FEATURES)} FROM txn"
_SPACE = _clusters(_SPACE_POINTS, FEATURES, SPACE["eps"], SPACE["min_pts"], "Amount")

_ANOMALY = """anomaly AS (
  SELECT event_id AS id, Class AS label, component, (component IS NULL)::int AS prediction
  FROM txn LEFT JOIN clusters ON point = event_id
)"""

_BOX = f"""
SELECT feature, out AS outliers, {_r('q1', 'q1')}, {_r('q2', 'median')}, {_r('q3', 'q3')},
  {_r('least(lo, q1)', 'whisker_low')}, {_r('greatest(hi, q3)', 'whisker_high')}
FROM (
  SELECT feature, any_value(q1) AS q1, any_value(q2) AS q2, any_value(q3) AS q3,
    min(v) FILTER (v >= q1 - 1.5::double * (q3 - q1)) AS lo, max(v) FILTER (v <= q3 + 1.5::double * (q3 - q1)) AS hi,
    count(*) FILTER (v < q1 - 1.5::double * (q3 - q1) OR v > q3 + 1.5::double * (q3 - q1)) AS out
  FROM long JOIN (
    SELECT feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
    FROM long GROUP BY feature
  ) USING (feature)
  WHERE feature NOT IN ('V28', 'Amount') GROUP BY feature
)"""

_EDGE = "lo + i * ((hi - lo) / 10.0::double)"

_LEVEL = [
    _LONG,
    "span AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM long GROUP BY feature)",
    """bins AS (
  SELECT feature, len(list_filter(range(1, 16), lambda k: lo + (hi - lo) * k / 16.0::double < v))::int AS bin,
    0.5::double - Class AS g, 0.25::double AS h
  FROM long JOIN span USING (feature)
)""",
    "sums AS (SELECT feature, bin, sum(g) AS g, sum(h) AS h FROM bins GROUP BY feature, bin)",
    """sides AS (
  SELECT feature, bin, sum(g) OVER upto AS gl, sum(h) OVER upto AS hl,
    sum(g) OVER (PARTITION BY feature) AS g, sum(h) OVER (PARTITION BY feature) AS h
  FROM sums WINDOW upto AS (PARTITION BY feature ORDER BY bin ROWS UNBOUNDED PRECEDING)
)""",
]

_LEVELS = """levels AS MATERIALIZED (
  SELECT l.feature, l.Class AS c,
    CASE WHEN lo = hi THEN 0 ELSE least(floor((v - lo) * 16.0::double / (hi - lo)), 15) END::double AS level
  FROM long l JOIN (SELECT feature, min(v) AS lo, max(v) AS hi FROM long GROUP BY feature) s USING (feature)
),
tried AS (
  SELECT feature, (level + lead(level) OVER w) / 2 AS cut, n_all, p_all, n_below, p_below, n_all - n_below AS n_above, p_all - p_below AS p_above
  FROM (
    SELECT feature, level, sum(n) OVER (PARTITION BY feature) AS n_all, sum(p) OVER (PARTITION BY feature) AS p_all,
      sum(n) OVER (PARTITION BY feature ORDER BY level) AS n_below, sum(p) OVER (PARTITION BY feature ORDER BY level) AS p_below
    FROM (SELECT feature, level, count(*)::double AS n, sum(c)::double AS p FROM levels GROUP BY feature, level)
  ) WINDOW w AS (PARTITION BY feature ORDER BY level)
),
shares AS (SELECT *, p_all / n_all AS a, p_below / n_below AS b, p_above / n_above AS d FROM tried WHERE cut IS NOT NULL),
gains AS (
  SELECT 'gini' AS impurity, feature, cut, n_below, n_above,
    2 * a * (1 - a) - n_below / n_all * 2 * b * (1 - b) - n_above / n_all * 2 * d * (1 - d) AS gain FROM shares
  UNION ALL
  SELECT 'entropy', feature, cut, n_below, n_above, bits(a) - n_below / n_all * bits(b) - n_above / n_all * bits(d) FROM shares
),
cuts AS (
  SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY impurity, feature ORDER BY round(gain, 12) DESC, cut) = 1
)"""
for _p in "abd":
    _LEVELS = _LEVELS.replace(
        f"bits({_p})",
        f"(CASE WHEN {_p} > 0 THEN -{_p} * log2({_p}) ELSE 0 END + CASE WHEN {_p} < 1 THEN -(1 - {_p}) * log2(1 - {_p}) ELSE 0 END)",
    )

# Newton's method for two features and an intercept; the 3 x 3 system is solved by Cramer's rule.
_NEWTON = f"""points AS MATERIALIZED (SELECT {FITTED[0]} AS x, {FITTED[1]} AS y, Class::double AS c FROM txn),
newton AS (
  SELECT 0 AS k, 0.0::double AS w0, 0.0::double AS w1, 0.0::double AS w2
  UNION ALL
  SELECT k + 1,
    w0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
    w1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
    w2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
  FROM (
    SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
    FROM (
      SELECT k, w0, w1, w2, sum(c - p) AS g0, sum((c - p) * x) AS g1, sum((c - p) * y) AS g2, sum(q) AS h00, sum(q * x) AS h01,
        sum(q * y) AS h02, sum(q * x * x) AS h11, sum(q * x * y) AS h12, sum(q * y * y) AS h22
      FROM (
        SELECT *, p * (1 - p) AS q
        FROM (SELECT *, 1.0::double / (1 + exp(-(w0 + w1 * x + w2 * y))) AS p FROM newton CROSS JOIN points WHERE k < 15)
      ) GROUP BY k, w0, w1, w2
    )
  )
)"""


def _leading(name: str, matrix: str) -> str:
    """The leading unit eigenvector (i, v) of a relation (i, j, x): squared often, all columns of the matrix point along it."""
    return f"""{name}_powers AS (
  SELECT 0 AS k, i, j, x FROM {matrix}
  UNION ALL
  SELECT k + 1, i, j, x / sum(CASE WHEN i = j THEN x END) OVER ()
  FROM (
    SELECT a.k, a.i, b.j, sum(a.x * b.x) AS x FROM {name}_powers a JOIN {name}_powers b ON a.j = b.i WHERE a.k < 40 GROUP BY a.k, a.i, b.j
  )
),
{name} AS (
  SELECT i, x / sqrt(sum(x * x) OVER ()) * sign(first_value(x) OVER (ORDER BY abs(x) DESC)) AS v
  FROM {name}_powers p
  WHERE k = 40 AND j = (SELECT i FROM {name}_powers WHERE k = 40 AND i = j ORDER BY x DESC LIMIT 1)
)"""


_PCA = [
    "sample AS MATERIALIZED (SELECT * FROM txn ORDER BY md5('42|' || event_id::varchar), event_id LIMIT 20000)",
    f"""centred AS MATERIALIZED (
  SELECT event_id, Class, feature AS i, v - avg(v) OVER (PARTITION BY feature) AS v
  FROM (UNPIVOT (SELECT event_id, Class, {', '.join(FEATURES)} FROM sample) ON {', '.join(FEATURES)} INTO NAME feature VALUE v)
)""",
    """matrix AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(a.v * b.v) / (SELECT count(*) - 1 FROM sample) AS x
  FROM centred a JOIN centred b USING (event_id) GROUP BY a.i, b.i
)""",
    _leading("first", "matrix"),
    """rest AS MATERIALIZED (
  SELECT m.i, m.j, m.x - (SELECT sum(m.x * a.v * b.v) FROM matrix m JOIN first a ON a.i = m.i JOIN first b ON b.i = m.j) * a.v * b.v AS x
  FROM matrix m JOIN first a ON a.i = m.i JOIN first b ON b.i = m.j
)""",
    _leading("second", "rest"),
]

ORACLE: dict[str, str] = {
    "scan_csv": _with(TXN, tail="SELECT * EXCLUDE (b) FROM txn"),
    "scan_csv_text": _with(TXN, tail="SELECT * EXCLUDE (b) FROM txn"),
    "scan_parquet": "SELECT * FROM events",
    "parquet_roundtrip": _with(TXN, tail="SELECT * FROM txn"),
    "feature_array": _with(TXN, tail=f"SELECT event_id AS id, {', '.join(f'{c} AS v{i}' for i, c in enumerate(FEATURES))} FROM txn"),
    "label_projection": _with(TXN, tail="SELECT event_id, Class::double AS label FROM txn"),
    "threshold_predict": """SELECT event_id,
  CASE WHEN value / 500.0::double >= 0.1::double THEN 1.0::double ELSE 0.0::double END AS at_least,
  CASE WHEN value / 500.0::double > 0.1::double THEN 1.0::double ELSE 0.0::double END AS above FROM events""",
    "class_filter": _with(TXN, tail="SELECT event_id, Amount, Class FROM txn WHERE Class = 1"),
    "row_index": _with(
        TXN, tail="SELECT event_id, Class, row_number() OVER (ORDER BY event_id) - 1 AS row_index FROM txn"
    ),
    "eps_neighbors": _with(*_PLANE[:2], tail="SELECT a AS id, count(*) AS neighbours FROM near GROUP BY a"),
    "haversine_neighbors": _with(*_GLOBE[:2], tail="SELECT a AS id, count(*) AS neighbours FROM near GROUP BY a"),
    "haversine_clusters": _with(*_GLOBE, recursive=True, tail="SELECT * FROM clusters"),
    "row_counts": _with(
        TXN,
        tail="""SELECT count(*) AS total, count(*) FILTER (Class = 1) AS positives,
  count(*) FILTER (Class = 0) AS negatives FROM txn""",
    ),
    "class_distribution": _with(TXN, tail="SELECT Class::varchar AS Class, count(*) AS count FROM txn GROUP BY 1"),
    "hourly_class_counts": _with(
        TXN, tail="SELECT floor(Time / 3600)::int AS Hour, Class, count(*) AS count FROM txn GROUP BY 1, 2"
    ),
    "amount_histogram": f"""
WITH span AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
edges AS (SELECT i, {_EDGE} AS low, {_EDGE.replace('i *', '(i + 1) *')} AS high FROM span, range(0, 10) r(i))
SELECT (i + 1)::int AS bin, count(value) AS count, {_r('low', 'low')}, {_r('high', 'high')}
FROM edges LEFT JOIN events ON value >= low AND (value < high OR i = 9) GROUP BY i, low, high""",
    "boxplot_stats": _with(TXN, _LONG, tail=_BOX),
    "correlation_matrix": _with(
        TXN,
        _LONG,
        tail=f"""SELECT x.feature AS a, y.feature AS b, {_r('corr(x.v, y.v)', 'r')}
FROM long x JOIN long y USING (event_id)
WHERE x.feature NOT IN ('V28', 'Amount') AND y.feature NOT IN ('V28', 'Amount') GROUP BY 1, 2""",
    ),
    "train_test_split": _with(
        TXN, tail=f"SELECT event_id, Class, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS part FROM txn"
    ),
    "bernoulli_sample": _with(
        TXN,
        tail=f"SELECT event_id, Class FROM txn WHERE {_word('42')}::double / 4294967296.0::double < 0.3::double",
    ),
    "sample_exact_n": _with(
        TXN,
        tail=f"SELECT event_id, Class FROM txn ORDER BY md5('42|' || event_id::varchar), event_id LIMIT {SAMPLE}",
    ),
    "tree_root_cut": _with(
        TXN,
        _LONG,
        _LEVELS,
        tail=f"SELECT impurity, feature, cut, {_r('gain', 'gain')}, n_below::bigint AS below, n_above::bigint AS above FROM cuts",
    ),
    "decision_tree_root": _with(
        TXN,
        "pool AS (SELECT event_id, Class AS label FROM txn)",
        _UNDER,
        _LONG.replace("FROM txn)", "FROM txn SEMI JOIN kept USING (event_id))"),
        _LEVELS,
        tail=f"SELECT feature, cut, {_r('gain', 'gain')} FROM cuts WHERE impurity = 'gini' ORDER BY cuts.gain DESC LIMIT 1",
    ),
    "logistic_regression_fit": _with(
        TXN,
        _NEWTON,
        tail=f"""SELECT parameter, round(value, 3) + 0.0::double AS value FROM (
  UNPIVOT (SELECT w0 AS intercept, w1 AS {FITTED[0]}, w2 AS {FITTED[1]} FROM newton WHERE k = 15)
  ON intercept, {FITTED[0]}, {FITTED[1]} INTO NAME parameter VALUE value
)""",
        recursive=True,
    ),
    "pca_2d": _with(
        TXN,
        *_PCA,
        tail="""SELECT event_id, Class, round(sum(c.v * a.v), 3) + 0.0::double AS pc1, round(sum(c.v * b.v), 3) + 0.0::double AS pc2
FROM centred c JOIN first a USING (i) JOIN second b USING (i) GROUP BY event_id, Class""",
        recursive=True,
    ),
    "fold_assignment": f"SELECT event_id, ({_word('fold')} % 3)::int AS fold FROM events",
    "undersample": _with(
        TXN, "pool AS (SELECT event_id, Class AS label FROM txn)", _UNDER, tail="SELECT event_id, label FROM kept"
    ),
    "undersample_by_union": _with(
        TXN, "pool AS (SELECT event_id, Class AS label FROM txn)", _UNDER, tail="SELECT event_id, label FROM kept"
    ),
    "standard_scale": _with(
        TXN,
        tail="SELECT event_id, "
        + ", ".join(_r(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()", c) for c in FEATURES)
        + " FROM txn",
    ),
    "minmax_scale": _with(
        TXN,
        tail="SELECT event_id, "
        + ", ".join(_r(f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())", c) for c in FEATURES)
        + " FROM txn",
    ),
    "naive_bayes_params": _with(
        TXN,
        *_BAYES,
        tail=f"""SELECT label::int AS label, feature, {_r('log_prior', 'log_prior')},
  {_r('log_likelihood', 'log_likelihood')} FROM theta""",
    ),
    "naive_bayes_scores": _with(TXN, *_SCORES, tail=f"SELECT event_id, label, {_r('p1', 'p1')} FROM scores"),
    "threshold_sweep": _with(TXN, *_SCORES, tail=_ratios("sweep", f", {_r('t', 't')}")),
    "best_threshold": _with(TXN, *_SCORES, tail=f"SELECT {_r('t', 'threshold')}, {_r('f1', 'f1')} FROM best"),
    "naive_bayes_report": _with(
        TXN,
        *_SCORES,
        tail=_ratios(
            "(SELECT sweep.* FROM sweep JOIN best USING (t))",
            f", {_r('t', 'threshold')}, {_r(_WEIGHTED, 'weighted_f1')}",
        ),
    ),
    "binary_metrics": _with(TXN, _RULE, tail=_ratios(f"(SELECT {_COUNTS} FROM rule)")),
    "weighted_f1": _with(
        TXN,
        _RULE,
        tail=f"""SELECT {_r(_WEIGHTED, 'weighted_f1')}
FROM (SELECT *, tp + fp + fn + tn AS total FROM (SELECT {_COUNTS} FROM rule))""",
    ),
    "boost_histogram_level": _with(
        TXN,
        *_LEVEL,
        tail=f"""SELECT feature, bin, {_r(
            '0.5::double * (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1))', 'gain')}
FROM sides WHERE hl >= 1 AND h - hl >= 1""",
    ),
    "dbscan_core_points": _with(*_PLANE[:3], tail="SELECT id AS point FROM core"),
    "dbscan_clusters": _with(*_PLANE, recursive=True, tail="SELECT * FROM clusters"),
    "dbscan_noise": _with(
        *_PLANE[:3],
        tail="""SELECT id AS point FROM points WHERE id NOT IN (
  SELECT a FROM near WHERE b IN (SELECT id FROM core))""",
    ),
    "dbscan_transactions": _with(TXN, *_SPACE, recursive=True, tail="SELECT * FROM clusters"),
    "label_cluster_join": _with(TXN, *_PLANE, _ANOMALY, recursive=True, tail="SELECT * FROM anomaly"),
    "dbscan_anomaly_metrics": _with(
        TXN, *_SPACE, _ANOMALY, recursive=True, tail=_ratios(f"(SELECT {_COUNTS} FROM anomaly)")
    ),
}
