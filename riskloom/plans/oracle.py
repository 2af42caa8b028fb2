"""SQL twins of the queries, written independently of the DataFrame code.

Level lists are stated here, while the DataFrame code learns them from the data.
"""

from __future__ import annotations

from itertools import combinations

APPS = """
SELECT o.o_orderkey AS application_id,
       CAST(19 + o.o_custkey % 57 AS INT) AS age,
       CASE WHEN o.o_custkey % 3 = 0 THEN 'female' ELSE 'male' END AS sex,
       CAST(o.o_custkey % 4 AS INT) AS job,
       o.o_orderstatus AS housing,
       NULLIF(c.c_mktsegment, 'BUILDING') AS saving_accounts,
       NULLIF(o.o_orderpriority, '5-LOW') AS checking_account,
       o.o_totalprice AS credit_amount,
       CAST(6 * EXTRACT(MONTH FROM o.o_orderdate) AS INT) AS duration,
       r.r_name AS purpose,
       CASE WHEN o.o_totalprice / (6 * EXTRACT(MONTH FROM o.o_orderdate)) > 9000
              OR (c.c_mktsegment = 'BUILDING' AND o.o_custkey % 57 < 12)
            THEN 'bad' ELSE 'good' END AS risk
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

APP_COLUMNS = ["age", "sex", "job", "housing", "saving_accounts", "checking_account", "credit_amount", "duration", "purpose", "risk"]
GAPPED = ("saving_accounts", "checking_account")
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]

# Fixed values of the test tables: sorted levels per column, first one included.
LEVELS = {
    "purpose": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "sex": ["female", "male"],
    "housing": ["F", "O", "P"],
    "saving_accounts": ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY", "no_inf"],
    "risk": ["bad", "good"],
    "checking_account": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "no_inf"],
    "age_cat": ["Adult", "Senior", "Student", "Young"],
}
PREFIX = {
    "purpose": "Purpose",
    "sex": "Sex",
    "housing": "Housing",
    "saving_accounts": "Savings",
    "checking_account": "Check",
    "age_cat": "Age_cat",
}


def case(column: str, level: str, name: str) -> str:
    return f"""CASE WHEN {column} = '{level}' THEN 1 ELSE 0 END AS "{name}\""""


READY = f"""
SELECT * REPLACE (COALESCE(saving_accounts, 'no_inf') AS saving_accounts,
                  COALESCE(checking_account, 'no_inf') AS checking_account),
       CASE WHEN age > 18 AND age <= 25 THEN 'Student' WHEN age > 25 AND age <= 35 THEN 'Young'
            WHEN age > 35 AND age <= 60 THEN 'Adult' WHEN age > 60 AND age <= 120 THEN 'Senior' END AS age_cat
FROM ({APPS})
"""

_DUMMIES = [(c, level, f"{p}_{level}") for c, p in PREFIX.items() for level in LEVELS[c][1:]]
CURATED = f"""
SELECT application_id, age, job, credit_amount, duration,
       {", ".join(case(*d) for d in _DUMMIES)},
       CASE WHEN risk = 'bad' THEN 1 ELSE 0 END AS "Risk_bad"
FROM ({READY})
"""

FEATURES = ["age", "job", "credit_amount", "duration"] + [name for _, _, name in _DUMMIES]


def bucket(row_id: str = "application_id") -> str:
    return f"CAST(concat('0x', substr(md5(concat({row_id}, ':42')), 1, 8)) AS BIGINT) % 10000"


MODEL = f"""
SELECT * REPLACE (CASE WHEN credit_amount > 0 THEN ln(credit_amount) END AS credit_amount),
       CAST("Risk_bad" AS DOUBLE) AS label,
       CASE WHEN {bucket()} < 2500 THEN 'test' ELSE 'train' END AS split
FROM ({CURATED})
"""

_AS_DOUBLE = ", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in FEATURES)
_ALL_FEATURES = ", ".join(f'"{f}"' for f in FEATURES)


def cells(source: str, keys: str = "application_id, label") -> str:
    """One row per (row, feature)."""
    return f"SELECT * FROM (SELECT {keys}, {_AS_DOUBLE} FROM {source}) UNPIVOT (value FOR feature IN ({_ALL_FEATURES}))"


GNB = f"""
WITH m AS MATERIALIZED ({MODEL}), cell AS MATERIALIZED ({cells("m", "application_id, label, split")}),
prior AS (SELECT label, count(*) / (SELECT count(*) FROM m WHERE split = 'train') AS prior
          FROM m WHERE split = 'train' GROUP BY label),
extra AS (SELECT 1e-9 * max(v) AS e FROM
          (SELECT var_pop(value) AS v FROM cell WHERE split = 'train' GROUP BY feature)),
par AS (SELECT label, feature, prior, avg(value) AS mean, var_pop(value) + any_value(e) AS variance
        FROM cell JOIN prior USING (label), extra WHERE split = 'train' GROUP BY label, feature, prior),
ll AS (SELECT application_id, c.label AS truth, split, p.label, any_value(ln(prior))
         + sum(-0.5 * ln(2 * pi() * variance) - (value - mean) * (value - mean) / (2 * variance)) AS s
       FROM cell c JOIN par p USING (feature) GROUP BY ALL),
scored AS (SELECT application_id, truth AS label, split,
           CASE WHEN max(s) FILTER (WHERE label = 1) > max(s) FILTER (WHERE label = 0) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
           1 / (1 + exp(max(s) FILTER (WHERE label = 0) - max(s) FILTER (WHERE label = 1))) AS probability
           FROM ll GROUP BY application_id, truth, split)
"""


def gnb_crossed(k: int, order: str, eps: str) -> str:
    """Out-of-fold naive Bayes; ``order`` is the window of the fold's ntile."""
    return f"""
WITH m AS MATERIALIZED (SELECT *, ntile({k}) OVER ({order}) - 1 AS fold FROM ({MODEL}) WHERE split = 'train'),
cell AS MATERIALIZED ({cells("m", "application_id, label, fold")}),
held AS (SELECT DISTINCT fold AS held FROM m), eps AS ({eps}),
prior AS (SELECT held, label, count(*) / sum(count(*)) OVER (PARTITION BY held) AS prior
          FROM m, held WHERE fold <> held GROUP BY held, label),
extra AS (SELECT held, max(v) AS v FROM
          (SELECT held, var_pop(value) AS v FROM cell, held WHERE fold <> held GROUP BY held, feature) GROUP BY held),
par AS (SELECT grid_index, params, held, label, feature, any_value(prior) AS prior, avg(value) AS mean,
               var_pop(value) + any_value(eps * v) AS variance
        FROM cell JOIN held ON fold <> held JOIN prior USING (held, label) JOIN extra USING (held), eps
        GROUP BY grid_index, params, held, label, feature),
ll AS (SELECT grid_index, params, application_id, fold, c.label AS truth, p.label, any_value(ln(prior))
         + sum(-0.5 * ln(2 * pi() * variance) - (value - mean) * (value - mean) / (2 * variance)) AS s
       FROM cell c JOIN par p ON c.feature = p.feature AND c.fold = p.held
       GROUP BY grid_index, params, application_id, fold, c.label, p.label),
scored AS (SELECT grid_index, params, application_id, fold, truth AS label,
           CASE WHEN max(s) FILTER (WHERE label = 1) > max(s) FILTER (WHERE label = 0) THEN 1 ELSE 0 END AS prediction
           FROM ll GROUP BY grid_index, params, application_id, fold, truth),
per_fold AS (SELECT grid_index, params, fold, count(*) FILTER (WHERE label = 1 AND prediction = 1)
             / count(*) FILTER (WHERE label = 1) AS value FROM scored GROUP BY grid_index, params, fold)
"""


_ONE_EPS = "SELECT 0 AS grid_index, '' AS params, 1e-9 AS eps"
_GRID_EPS = """SELECT * FROM (VALUES (0, 'smoothing=1e-09', 1e-9), (1, 'smoothing=1e-05', 1e-5),
 (2, 'smoothing=0.001', 1e-3), (3, 'smoothing=0.1', 1e-1)) t(grid_index, params, eps)"""
_GRID = (
    gnb_crossed(5, "PARTITION BY label ORDER BY application_id", _GRID_EPS)
    + """, grid AS (SELECT grid_index, params, avg(value) AS mean_score, stddev_pop(value) AS std_score
        FROM per_fold GROUP BY grid_index, params)"""
)

# Two-feature discriminant in closed form: x = age, y = ln(amount).
_LDA_STATS = """
  sum(n) - 2 AS dof, sum(sxx) / (sum(n) - 2) AS vxx, sum(syy) / (sum(n) - 2) AS vyy, sum(sxy) / (sum(n) - 2) AS vxy,
  max(mx) FILTER (WHERE label = 0) AS x0, max(my) FILTER (WHERE label = 0) AS y0,
  max(mx) FILTER (WHERE label = 1) AS x1, max(my) FILTER (WHERE label = 1) AS y1,
  ln((max(n) FILTER (WHERE label = 1)) / (max(n) FILTER (WHERE label = 0))) AS odds"""
_LDA_CLASS = """count(*) AS n, avg(age) AS mx, avg(credit_amount) AS my, var_pop(age) * count(*) AS sxx,
  var_pop(credit_amount) * count(*) AS syy, covar_pop(age, credit_amount) * count(*) AS sxy"""
_LDA_MARGIN = """(
   ((x1 - x0) * vyy - (y1 - y0) * vxy) / (vxx * vyy - vxy * vxy) * (age - (x0 + x1) / 2)
 + ((y1 - y0) * vxx - (x1 - x0) * vxy) / (vxx * vyy - vxy * vxy) * (credit_amount - (y0 + y1) / 2) + odds)"""

LDA_CV = f"""
WITH m AS MATERIALIZED (SELECT *, ntile(10) OVER (ORDER BY application_id) - 1 AS fold FROM ({MODEL}) WHERE split = 'train'),
held AS (SELECT DISTINCT fold AS held FROM m),
per_class AS (SELECT held, label, {_LDA_CLASS} FROM m JOIN held ON fold <> held GROUP BY held, label),
par AS (SELECT held, {_LDA_STATS} FROM per_class GROUP BY held),
lda AS (SELECT fold, label, CASE WHEN {_LDA_MARGIN} > 0 THEN 1 ELSE 0 END AS prediction
        FROM m JOIN par ON fold = held),
lda_fold AS (SELECT fold, count(*) FILTER (WHERE label = 1 AND prediction = 1)
             / count(*) FILTER (WHERE label = 1) AS value FROM lda GROUP BY fold)
"""

# Naive Bayes on the same two features, for the ranking.
NB2_CV = LDA_CV + """,
nb_class AS (SELECT held, label, count(*) AS n, avg(age) AS ma, var_pop(age) AS va, avg(credit_amount) AS mc,
             var_pop(credit_amount) AS vc FROM m JOIN held ON fold <> held GROUP BY held, label),
nb_extra AS (SELECT held, 1e-9 * greatest(var_pop(age), var_pop(credit_amount)) AS e
             FROM m JOIN held ON fold <> held GROUP BY held),
nb_s AS (SELECT application_id, fold, m.label AS truth, c.label,
         ln(n) - 0.5 * ln(va + e) - 0.5 * ln(vc + e) - (age - ma) * (age - ma) / (2 * (va + e))
         - (credit_amount - mc) * (credit_amount - mc) / (2 * (vc + e)) AS s
         FROM m JOIN nb_class c ON m.fold = c.held JOIN nb_extra x ON m.fold = x.held),
nb AS (SELECT fold, truth AS label, CASE WHEN max(s) FILTER (WHERE label = 1) > max(s) FILTER (WHERE label = 0)
       THEN 1 ELSE 0 END AS prediction FROM nb_s GROUP BY application_id, fold, truth),
nb_fold AS (SELECT fold, count(*) FILTER (WHERE label = 1 AND prediction = 1)
            / count(*) FILTER (WHERE label = 1) AS value FROM nb GROUP BY fold)
"""

NEWTON_STEPS = 14


def newton() -> str:
    """CTEs ``fitted`` (held, w) and, from ``m`` (held out: ``fold``) and ``held``, their Newton steps.

    Each step adds up the weighted Gram matrix, of which Gauss-Jordan elimination, a stage
    per column, leaves the step in the last column.
    """
    q = len(FEATURES) + 1
    x = ["1.0"] + [f'"{f}"' for f in FEATURES]
    margin = " + ".join(f"w[{i + 1}] * {v}" for i, v in enumerate(x))
    sums = ", ".join(f"sum(c * {x[i]} * {x[j]}) AS h_{i}_{j}" for i in range(q) for j in range(i, q))
    slopes = ", ".join(f"sum((p - label) * {x[i]}) + {'0' if i == 0 else f'any_value(w)[{i + 1}]'} AS g_{i}" for i in range(q))
    cell = lambda i, j: f"h_{min(i, j)}_{max(i, j)}" + (" + 1" if i == j and i > 0 else "")
    rows = ", ".join("[" + ", ".join([*[cell(i, j) for j in range(q)], f"g_{i}"]) + "]" for i in range(q))
    stage = f"SELECT held, step, w, [{rows}] AS a FROM gram_here"
    for k in range(1, q + 1):
        stage = f"""SELECT held, step, w, list_transform(a, lambda r, i: CASE WHEN i = {k} THEN r
            ELSE list_transform(r, lambda v, j: v - r[{k}] * a[{k}][j] / a[{k}][{k}]) END) AS a FROM ({stage})"""
    gram = f"""SELECT held, step, any_value(w) AS w, {sums}, {slopes} FROM
        (SELECT *, p * (1 - p) AS c FROM (SELECT m.*, n.held, n.step, n.w, 1 / (1 + exp(-({margin}))) AS p
         FROM newton n JOIN m ON m.fold IS DISTINCT FROM n.held WHERE n.step < {NEWTON_STEPS})) GROUP BY held, step"""
    stage = stage.replace("gram_here", f"({gram})")
    return f"""newton AS (SELECT held, 0 AS step, list_transform(range({q}), lambda i: 0.0::DOUBLE) AS w FROM held
    UNION ALL SELECT held, step + 1, list_transform(w, lambda v, i: v - a[i][{q + 1}] / a[i][i]) FROM ({stage})),
fitted AS (SELECT held, w FROM newton WHERE step = {NEWTON_STEPS})"""


_X = "[" + ", ".join(f'CAST("{f}" AS DOUBLE)' for f in FEATURES) + "]"
_P = len(FEATURES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _symmetric(cell) -> str:
    return "[" + ", ".join("[" + ", ".join(cell(min(i, j), max(i, j)) for j in range(_P)) + "]" for i in range(_P)) + "]"


def discriminant() -> str:
    """CTEs from ``m`` and ``held``: ``lda`` (held, w, k), the weights and constant of each margin."""
    means = ", ".join(f'avg("{f}") AS u_{i}' for i, f in enumerate(FEATURES))
    scatter = ", ".join(f'covar_pop("{FEATURES[i]}", "{FEATURES[j]}") * count(*) AS c_{i}_{j}' for i, j in _PAIRS)
    gap = lambda i: f"max(u_{i}) FILTER (WHERE label = 1) - max(u_{i}) FILTER (WHERE label = 0)"
    middle = lambda i: f"max(u_{i}) FILTER (WHERE label = 1) + max(u_{i}) FILTER (WHERE label = 0)"
    within = lambda i, j: f"sum(c_{min(i, j)}_{max(i, j)}) / (sum(n) - 2)"
    rows = "[" + ", ".join("[" + ", ".join([*[within(i, j) for j in range(_P)], gap(i)]) + "]" for i in range(_P)) + "]"
    stage = f"""SELECT held, ln((max(n) FILTER (WHERE label = 1)) / (max(n) FILTER (WHERE label = 0))) AS odds,
      [{", ".join(middle(i) for i in range(_P))}] AS mid, {rows} AS a FROM per_class GROUP BY held"""
    for k in range(1, _P + 1):
        stage = f"""SELECT held, odds, mid, list_transform(a, lambda r, i: CASE WHEN i = {k} THEN r
            ELSE list_transform(r, lambda v, j: v - r[{k}] * a[{k}][j] / a[{k}][{k}]) END) AS a FROM ({stage})"""
    return f"""per_class AS (SELECT held, label, count(*) AS n, {means}, {scatter}
    FROM m JOIN held ON m.fold IS DISTINCT FROM held GROUP BY held, label),
solved AS (SELECT held, odds, mid, list_transform(a, lambda r, i: r[{_P + 1}] / r[i]) AS w FROM ({stage})),
lda AS (SELECT held, w, odds - list_dot_product(mid, w) / 2 AS k FROM solved)"""


def union_bayes() -> str:
    """CTEs from ``m``, ``held`` and ``asked`` (rows with ``held``): ``union_s`` (application_id, held, label, s0, s1).

    Two principal axes by power iteration beside the six best features by F, then naive Bayes.
    """
    means = ", ".join(f'avg("{f}")' for f in FEATURES)
    cov = ", ".join(f'covar_pop("{FEATURES[i]}", "{FEATURES[j]}") AS c_{i}_{j}' for i, j in _PAIRS)

    def power(name: str, source: str) -> str:
        return f"""{name}_steps AS (SELECT held, 0 AS step, c, list_transform(range({_P}), lambda i: 1.0::DOUBLE) AS v FROM {source}
 UNION ALL SELECT held, step + 1, c, list_transform(y, lambda e: e / sqrt(list_dot_product(y, y))) FROM
 (SELECT held, step, c, list_transform(c, lambda r: list_dot_product(r, v)) AS y FROM {name}_steps WHERE step < 250)),
{name} AS (SELECT held, c, v, sqrt(list_dot_product(list_transform(c, lambda r: list_dot_product(r, v)), list_transform(c, lambda r: list_dot_product(r, v)))) AS size
 FROM {name}_steps WHERE step = 250)"""

    return f"""spread AS (SELECT held, [{means}] AS mu, {cov} FROM m JOIN held ON m.fold IS DISTINCT FROM held GROUP BY held),
whole AS (SELECT held, mu, {_symmetric(lambda i, j: f"c_{i}_{j}")} AS c FROM spread),
{power("axis1", "whole")},
rest AS (SELECT held, list_transform(c, lambda r, i: list_transform(r, lambda e, j: e - size * v[i] * v[j])) AS c FROM axis1),
{power("axis2", "rest")},
axes AS (SELECT w.held, mu, a.v AS v1, b.v AS v2 FROM whole w JOIN axis1 a ON a.held = w.held JOIN axis2 b ON b.held = w.held),
long AS (SELECT held, label, unnest(range(1, {_P + 1})) AS i, unnest({_X}) AS x FROM m JOIN held ON m.fold IS DISTINCT FROM held),
by_class AS (SELECT held, i, label, count(*) AS n, avg(x) AS mean, var_pop(x) * count(*) AS ss FROM long GROUP BY held, i, label),
scores AS (SELECT held, i, (sum(n * (mean - centre) ** 2) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))) AS f FROM by_class
 JOIN (SELECT held, i, sum(n * mean) / sum(n) AS centre FROM by_class GROUP BY held, i) USING (held, i) GROUP BY held, i),
chosen AS (SELECT held, i FROM scores QUALIFY row_number() OVER (PARTITION BY held ORDER BY f DESC, i) <= 6),
learned AS (SELECT application_id, held, label, {_X} AS x FROM m JOIN held ON m.fold IS DISTINCT FROM held),
inputs AS (SELECT 'train' AS kind, * FROM learned UNION ALL SELECT 'asked', application_id, held, label, {_X} FROM asked),
placed AS (SELECT kind, application_id, held, label, x, list_dot_product(x, v1) - list_dot_product(mu, v1) AS z1, list_dot_product(x, v2) - list_dot_product(mu, v2) AS z2
 FROM inputs JOIN axes USING (held)),
cell AS MATERIALIZED (SELECT kind, application_id, held, label, -1 AS i, z1 AS value FROM placed UNION ALL SELECT kind, application_id, held, label, -2, z2 FROM placed
 UNION ALL SELECT kind, application_id, p.held, label, c.i, x[c.i] FROM placed p JOIN chosen c ON c.held = p.held),
extra AS (SELECT held, 1e-9 * max(v) AS e FROM (SELECT held, var_pop(value) AS v FROM cell WHERE kind = 'train' GROUP BY held, i) GROUP BY held),
prior AS (SELECT held, label, count(*) / sum(count(*)) OVER (PARTITION BY held) AS prior FROM learned GROUP BY held, label),
par AS (SELECT c.held, c.label, i, any_value(prior) AS prior, avg(value) AS mean, var_pop(value) + any_value(e) AS variance
 FROM cell c JOIN prior p ON p.held = c.held AND p.label = c.label JOIN extra x ON x.held = c.held WHERE kind = 'train' GROUP BY c.held, c.label, i),
ll AS (SELECT application_id, c.held, c.label AS truth, p.label, any_value(ln(prior)) + sum(-0.5 * ln(2 * pi() * variance) - (value - mean) ** 2 / (2 * variance)) AS s
 FROM cell c JOIN par p ON p.held = c.held AND p.i = c.i WHERE kind = 'asked' GROUP BY application_id, c.held, c.label, p.label),
union_s AS (SELECT application_id, held, truth AS label, max(s) FILTER (WHERE label = 0) AS s0, max(s) FILTER (WHERE label = 1) AS s1
 FROM ll GROUP BY application_id, held, truth)"""


STUMP_FEATURES = [f for f in FEATURES if f != "credit_amount"]


def stump() -> str:
    """The best single split by Gini impurity over thresholds midway between values; test rows with their side's share of 1."""
    long = " UNION ALL ".join(
        f"""SELECT application_id, label, split, {i} AS i, CAST("{f}" AS DOUBLE) AS x FROM a""" for i, f in enumerate(STUMP_FEATURES)
    )
    return f"""WITH a AS MATERIALIZED ({MODEL}), l AS MATERIALIZED ({long}),
v AS (SELECT i, x, count(*) AS n, sum(label) AS pos FROM l WHERE split = 'train' GROUP BY i, x),
c AS (SELECT i, (x + lead(x) OVER w) / 2 AS cut, sum(n) OVER w AS ln, sum(pos) OVER w AS lp, sum(n) OVER (PARTITION BY i) AS tn,
      sum(pos) OVER (PARTITION BY i) AS tp FROM v WINDOW w AS (PARTITION BY i ORDER BY x)),
b AS (SELECT *, lp / ln AS left_share, (tp - lp) / (tn - ln) AS right_share FROM c WHERE cut IS NOT NULL
      ORDER BY round(lp * (1 - lp / ln) + (tp - lp) * (1 - (tp - lp) / (tn - ln)), 6), i, cut LIMIT 1),
s AS (SELECT application_id, label, CASE WHEN x <= cut THEN left_share ELSE right_share END AS share FROM l JOIN b USING (i) WHERE split = 'test')
"""


_LR_MARGIN = " + ".join(["w[1]"] + [f'w[{i + 2}] * "{f}"' for i, f in enumerate(FEATURES)])

_TENFOLD = f"""m AS MATERIALIZED (SELECT *, ntile(10) OVER (ORDER BY application_id) - 1 AS fold FROM ({MODEL}) WHERE split = 'train'),
held AS (SELECT DISTINCT fold AS held FROM m)"""
TEXTS = ("sex", "housing", "saving_accounts", "checking_account", "purpose", "risk")
CUSTOMER_LEVELS = """SELECT DISTINCT 'c_name' AS "column", c_name AS level FROM customer
 UNION ALL SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM customer"""

RULED = f"""
SELECT application_id, CASE WHEN risk = 'bad' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       credit_amount / duration AS score,
       CASE WHEN credit_amount / duration > 6000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
FROM ({APPS})
"""


def report(source: str) -> str:
    return f"""
per_class AS (SELECT c.class, count(*) FILTER (WHERE label = c.class) AS support,
   count(*) FILTER (WHERE prediction = c.class) AS picked,
   count(*) FILTER (WHERE label = c.class AND prediction = c.class) AS tp
   FROM {source}, (VALUES (0), (1)) c(class) GROUP BY c.class),
scores AS (SELECT CAST(class AS VARCHAR) AS "row", CASE WHEN picked = 0 THEN 0 ELSE tp / picked END AS precision,
   tp / support AS recall, 2 * tp / (picked + support) AS f1, support, tp FROM per_class)
SELECT "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
   round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
   round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
"""


def roc(drop: bool, rows: str = f"({RULED})", head: str = "WITH") -> str:
    keep = "WHERE i = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg" if drop else ""
    return f"""
{head} g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
           FROM {rows} GROUP BY score),
c AS (SELECT score, pos, neg, row_number() OVER w AS i, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn,
      lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
      sum(pos) OVER () AS ap, sum(neg) OVER () AS an FROM g WINDOW w AS (ORDER BY score DESC))
SELECT round(CAST(cn / an AS DOUBLE), 6) AS fpr, round(CAST(cp / ap AS DOUBLE), 6) AS tpr, round(score, 6) AS threshold
FROM c {keep}
UNION ALL SELECT 0, 0, round(max(score) + 1, 6) FROM g
"""


_D2 = " + ".join(f'(q."{f}" - t."{f}") * (q."{f}" - t."{f}")' for f in FEATURES)


def knn(queries: str, points: str, condition: str = "TRUE", keys: str = "") -> str:
    """Brute force over all pairs: fine for a check at small scale."""
    return f"""
near AS (SELECT q.application_id, q.label AS truth {keys},
         min_by(t.label, ({_D2}, t.application_id), 5) AS labels
         FROM {queries} q JOIN {points} t ON {condition} GROUP BY ALL),
voted AS (SELECT * EXCLUDE (truth, labels), truth AS label,
          CASE WHEN list_sum(labels) >= 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM near)
"""


_NUM = ["age", "job", "credit_amount", "duration"]
_TEXT = ["sex", "housing", "saving_accounts", "checking_account", "purpose", "risk"]


def tall(columns: list[str], source: str, kind: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS {kind}) AS value FROM {source}""" for c in columns
    )


def numbers(then: str, columns: list[str] = _NUM, source: str = "a", apps: str = APPS) -> str:
    return f"WITH a AS ({apps}), v AS ({tall(columns, source, 'DOUBLE')}) {then}"


_QUANTILES = """SELECT "column", round(q[1], 6) AS q05, round(q[2], 6) AS q25, round(q[3], 6) AS q50, round(q[4], 6) AS q75,
 round(q[5], 6) AS q95, round(q[4] - q[2], 6) AS iqr
 FROM (SELECT "column", quantile_cont(value, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM v GROUP BY "column")"""


def pairs(columns: list[str], expression: str, name: str, source: str) -> str:
    """One SELECT per column pair; ``{a}`` and ``{b}`` stand for the columns."""
    return " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round({expression.format(a=a, b=b)}, 6) AS {name} FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


def _overview(source: str, columns: list[str]) -> str:
    gaps = " + ".join(f"({c} IS NULL)::INT" for c in columns)
    w, names = len(columns), ", ".join(columns)
    return f"""WITH a AS ({source})
SELECT count(*) AS n_rows, CAST({w} AS BIGINT) AS n_columns, CAST(sum({gaps}) AS BIGINT) AS n_missing_cells,
 round(sum({gaps}) / (count(*) * {w}), 6) AS missing_share,
 count(*) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM a)) AS n_duplicate_rows FROM a"""


_KINDS = {**{c: "numeric" for c in ["application_id", *_NUM]}, **{c: "categorical" for c in _TEXT}}
_SUMMARY = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CASE WHEN count(DISTINCT {c}) <= 1 THEN 'constant'
 WHEN count(DISTINCT {c}) = count(*) THEN 'unique' ELSE '{kind}' END AS kind, count(*) AS n_rows,
 count(*) - count({c}) AS n_null, (count(*) - count({c})) / count(*) AS null_share,
 count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) / count({c}) AS distinct_share FROM a"""
    for c, kind in _KINDS.items()
)

_CRAMER = " UNION ALL ".join(
    f"""SELECT '{a}' AS left_column, '{b}' AS right_column, {a} AS a, {b} AS b, count(*) AS n FROM p
 WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"""
    for i, a in enumerate(_TEXT)
    for b in _TEXT[i + 1 :]
)

RAW_TEXTS = f"""
SELECT * REPLACE (CASE WHEN housing = 'P' THEN 'unknown' ELSE CAST(age AS VARCHAR) END AS age,
                  COALESCE(checking_account, 'own') AS housing) FROM ({APPS})
"""
_BROKEN = "(age = 'unknown' OR length(housing) > 6)"

DATED = """
SELECT a.*, CAST(strftime(date_trunc('year', o.o_orderdate), '%Y%m%d') AS BIGINT) AS batch_nr,
       credit_amount / duration > 6000 AS picked
FROM ({apps}) a JOIN orders o ON o.o_orderkey = a.application_id
""".format(apps=APPS)
SUMMARY = f"""
SELECT batch_nr, purpose, count(*) AS n_rows, count(*) FILTER (WHERE picked) AS n_bad,
 round(avg(CASE WHEN picked THEN 1.0 ELSE 0.0 END), 6) AS bad_share, round(sum(credit_amount), 2) AS credit_amount
FROM ({DATED}) GROUP BY batch_nr, purpose
"""

ORACLE: dict[str, str] = {
    "applicants": APPS,
    "fill_missing": f"SELECT * EXCLUDE (age_cat) FROM ({READY})",
    "curated_features": CURATED,
    "encode_all_strings": "SELECT application_id, age, job, credit_amount, duration, "
    + ", ".join(
        case(c, level, f"{c}_{level}")
        for c in ("sex", "housing", "saving_accounts", "checking_account", "purpose", "risk")
        for level in LEVELS[c][1:]
    )
    + f" FROM ({READY})",
    "encode_null_level": "SELECT application_id, "
    + ", ".join(
        [case(c, level, f"{c}_{level}") for c in TEXTS for level in [v for v in LEVELS[c] if v != "no_inf"][1:]]
        + [f"CAST({c} IS NULL AS INT) AS {c}_nan" for c in TEXTS]
    )
    + f" FROM ({APPS})",
    "level_positions": f"""SELECT "column", CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY level) - 1 AS INT) AS position, level
 FROM ({CUSTOMER_LEVELS})""",
    "sparse_indicators": f"""WITH l AS (SELECT "column", level, dense_rank() OVER (PARTITION BY "column" ORDER BY level) - 1 AS place FROM ({CUSTOMER_LEVELS})),
 w AS (SELECT max(place) FILTER ("column" = 'c_name') AS names, max(place) FILTER ("column" = 'c_mktsegment') AS segments FROM l)
 SELECT c_custkey, CAST(names + segments AS INT) AS size, concat_ws(',', CASE WHEN n.place > 0 THEN n.place - 1 END, CASE WHEN s.place > 0 THEN names + s.place - 1 END) AS ones
 FROM customer JOIN l n ON n."column" = 'c_name' AND n.level = c_name JOIN l s ON s."column" = 'c_mktsegment' AND s.level = c_mktsegment, w""",
    "age_bands": f"SELECT age_cat, count(*) AS n, min(age) AS min_age, max(age) AS max_age FROM ({READY}) GROUP BY age_cat",
    "warehouse_projection": f"""SELECT age, sex, job, housing, saving_accounts AS saving_account,
 checking_account AS check_account, duration, purpose FROM ({APPS})""",
    "drop_originals": f"SELECT application_id, age, job, credit_amount, duration FROM ({APPS})",
    "log_amount": f"SELECT application_id, round(CASE WHEN credit_amount > 0 THEN ln(credit_amount) END, 6) AS credit_amount FROM ({APPS})",
    "log_rejects": """SELECT count(*) AS n_rows, count(*) FILTER (WHERE c_acctbal <= 0) AS n_not_positive,
 count(*) FILTER (WHERE c_acctbal IS NULL) AS n_null FROM customer""",
    "string_columns": f"WITH a AS ({APPS}) "
    + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS n_filled FROM a""" for c in _TEXT),
    "design_matrix": f"""SELECT application_id, label, {len(FEATURES)} AS n_features,
 round({" + ".join(f'"{f}"' for f in FEATURES)}, 6) AS feature_sum FROM ({MODEL}) WHERE credit_amount IS NOT NULL""",
    "skipped_rows": "SELECT count(*) AS n_rows, count(*) FILTER (WHERE c_acctbal <= 0) AS n_skipped FROM customer",
    "attach_features": f"""SELECT a.application_id, a.risk, i.n_lines, i.quantity FROM ({APPS}) a JOIN
 (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey) i
 ON a.application_id = i.l_orderkey""",
    "conform_valid": f"SELECT * REPLACE (CAST(age AS INT) AS age) FROM ({RAW_TEXTS}) WHERE NOT {_BROKEN}",
    "conform_quarantine": f"""SELECT *, concat_ws(',', CASE WHEN age = 'unknown' THEN 'age:not_numeric' END,
 CASE WHEN length(housing) > 6 THEN 'housing:longer_than_6' END) AS violations FROM ({RAW_TEXTS}) WHERE {_BROKEN}""",
    "conform_violations": f"""SELECT 'age:not_numeric' AS violation, count(*) AS n_rows FROM ({RAW_TEXTS}) WHERE age = 'unknown'
 UNION ALL SELECT 'housing:longer_than_6', count(*) FROM ({RAW_TEXTS}) WHERE length(housing) > 6""",
    "train_test_split": f"""SELECT application_id, CASE WHEN {bucket()} < 2500 THEN 'test' ELSE 'train' END AS split FROM ({APPS})""",
    "kfold_contiguous": f"SELECT application_id, CAST(ntile(10) OVER (ORDER BY application_id) - 1 AS INT) AS fold FROM ({APPS})",
    "kfold_stratified": f"""SELECT application_id, risk,
 CAST(ntile(5) OVER (PARTITION BY risk ORDER BY application_id) - 1 AS INT) AS fold FROM ({APPS})""",
    "fold_sizes": f"""SELECT fold, count(*) AS n_rows FROM (SELECT CAST(ntile(10) OVER (ORDER BY application_id) - 1 AS INT) AS fold
 FROM ({APPS}) WHERE {bucket()} >= 2500) GROUP BY fold""",
    "confusion_matrix": f"""WITH r AS ({RULED}) SELECT l.c AS label, p.c AS prediction,
 (SELECT count(*) FROM r WHERE label = l.c AND prediction = p.c) AS n
 FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) l(c), (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) p(c)""",
    "accuracy": f"SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM ({RULED})",
    "recall": f"SELECT round(avg(prediction), 6) AS recall FROM ({RULED}) WHERE label = 1",
    "fbeta2": f"""WITH s AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
 count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE prediction = 1) AS q FROM ({RULED}))
 SELECT round(5 * (tp / q) * (tp / p) / (4 * (tp / q) + tp / p), 6) AS fbeta2 FROM s""",
    "classification_report": f"WITH r AS ({RULED}), {report('r')}",
    "roc_points": roc(True),
    "roc_points_all": roc(False),
    "gnb_params": GNB + "SELECT label, feature, round(prior, 6) AS prior, round(mean, 6) AS mean, round(variance, 6) AS variance FROM par",
    "gnb_scores": GNB + "SELECT application_id, label, prediction, round(probability, 6) AS probability FROM scored WHERE split = 'test'",
    "gnb_training_score": GNB
    + "SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored WHERE split = 'train'",
    "gnb_report": GNB + ", r AS (SELECT * FROM scored WHERE split = 'test'), " + report("r"),
    "gnb_cv_recall": gnb_crossed(10, "ORDER BY application_id", _ONE_EPS)
    + "SELECT 'NB' AS model, CAST(fold AS INT) AS fold, 'recall' AS metric, round(value, 6) AS value FROM per_fold",
    "gnb_grid": _GRID
    + "SELECT grid_index, params, round(mean_score, 6) AS mean_score, round(std_score, 6) AS std_score FROM grid",
    "gnb_grid_best": _GRID
    + "SELECT grid_index, params, round(mean_score, 6) AS best_score FROM grid ORDER BY mean_score DESC, grid_index LIMIT 1",
    "lda2_scores": f"""WITH m AS ({MODEL}), per_class AS (SELECT label, {_LDA_CLASS} FROM m WHERE split = 'train' GROUP BY label),
 par AS (SELECT {_LDA_STATS} FROM per_class)
 SELECT application_id, label, CASE WHEN {_LDA_MARGIN} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
 round(1 / (1 + exp(-{_LDA_MARGIN})), 6) AS probability FROM m, par WHERE split = 'test'""",
    "lda2_cv_recall": LDA_CV
    + "SELECT 'LDA' AS model, CAST(fold AS INT) AS fold, 'recall' AS metric, round(value, 6) AS value FROM lda_fold",
    "lda_scored": f"""WITH a AS MATERIALIZED ({MODEL}), m AS MATERIALIZED (SELECT *, 0 AS fold FROM a WHERE split = 'train'),
held AS (SELECT -1 AS held), {discriminant()}
SELECT application_id, label, CASE WHEN s > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(1 / (1 + exp(-s)), 6) AS probability
FROM (SELECT application_id, label, list_dot_product({_X}, w) + k AS s FROM a, lda WHERE split = 'test')""",
    "lda_cv_recall": f"""WITH {_TENFOLD}, {discriminant()}
SELECT 'LDA' AS model, CAST(fold AS INT) AS fold, 'recall' AS metric, round(avg(CASE WHEN list_dot_product({_X}, w) + k > 0 THEN 1 ELSE 0 END), 6) AS value
FROM m JOIN lda ON fold = held WHERE label = 1 GROUP BY fold""",
    "union_scored": f"""WITH RECURSIVE a AS MATERIALIZED ({MODEL}), m AS MATERIALIZED (SELECT *, 0 AS fold FROM a WHERE split = 'train'),
held AS (SELECT -1 AS held), asked AS (SELECT *, -1 AS held FROM a WHERE split = 'test'), {union_bayes()}
SELECT application_id, label, CASE WHEN s1 > s0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(1 / (1 + exp(s0 - s1)), 6) AS probability FROM union_s""",
    "union_cv_accuracy": f"""WITH RECURSIVE {_TENFOLD}, asked AS (SELECT *, fold AS held FROM m), {union_bayes()}
SELECT 'UNION' AS model, CAST(held AS INT) AS fold, 'accuracy' AS metric, round(avg(CASE WHEN (s1 > s0)::INT = label THEN 1 ELSE 0 END), 6) AS value FROM union_s GROUP BY held""",
    "model_ranking_closed": f"""WITH RECURSIVE {_TENFOLD}, {discriminant()}, {newton()},
 r AS (SELECT 'LDA' AS model, fold, avg(CASE WHEN list_dot_product({_X}, w) + k > 0 THEN 1 ELSE 0 END) AS value FROM m JOIN lda ON fold = held WHERE label = 1 GROUP BY fold
       UNION ALL SELECT 'LR', fold, avg(CASE WHEN {_LR_MARGIN} > 0 THEN 1 ELSE 0 END) FROM m JOIN fitted ON fold = held WHERE label = 1 GROUP BY fold
       UNION ALL SELECT 'NB', fold, value FROM ({gnb_crossed(10, "ORDER BY application_id", _ONE_EPS)} SELECT fold, value FROM per_fold))
 SELECT model, round(avg(value), 6) AS mean_score, round(stddev_pop(value), 6) AS std_score FROM r GROUP BY model""",
    "tree_stump": stump() + "SELECT application_id, label, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(share, 6) AS probability FROM s",
    "forest_stump": stump() + "SELECT application_id, label, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(share, 6) AS probability FROM s",
    "boosted_stump": stump()
    + """SELECT application_id, label, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
 round(1 / (1 + exp(-2 * (2 * share - 1))), 6) AS probability FROM s""",
    "lr_scored": f"""WITH RECURSIVE a AS MATERIALIZED ({MODEL}), m AS MATERIALIZED (SELECT *, 0 AS fold FROM a WHERE split = 'train'),
held AS (SELECT -1 AS held), {newton()}
SELECT application_id, label, CASE WHEN s > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, round(1 / (1 + exp(-s)), 6) AS probability
FROM (SELECT application_id, label, {_LR_MARGIN} AS s FROM a, fitted WHERE split = 'test')""",
    "lr_cv_recall": f"""WITH RECURSIVE m AS MATERIALIZED (SELECT *, ntile(10) OVER (ORDER BY application_id) - 1 AS fold FROM ({MODEL}) WHERE split = 'train'),
held AS (SELECT DISTINCT fold AS held FROM m), {newton()}
SELECT 'LR' AS model, CAST(fold AS INT) AS fold, 'recall' AS metric, round(avg(CASE WHEN {_LR_MARGIN} > 0 THEN 1 ELSE 0 END), 6) AS value
FROM m JOIN fitted ON fold = held WHERE label = 1 GROUP BY fold""",
    "closed_form_ranking": NB2_CV
    + """SELECT 'LDA' AS model, round(avg(value), 6) AS mean_score, round(stddev_pop(value), 6) AS std_score FROM lda_fold
 UNION ALL SELECT 'NB', round(avg(value), 6), round(stddev_pop(value), 6) FROM nb_fold""",
    "knn5_predict": f"""WITH m AS MATERIALIZED ({MODEL}), q AS MATERIALIZED (SELECT * FROM m WHERE split = 'test'),
 t AS MATERIALIZED (SELECT * FROM m WHERE split = 'train'), {knn("q", "t")} SELECT * FROM voted""",
    "knn5_cv_recall": f"""WITH m AS MATERIALIZED (SELECT *, CAST(ntile(10) OVER (ORDER BY application_id) - 1 AS INT) AS fold
 FROM ({MODEL}) WHERE split = 'train'), {knn("m", "m", "q.fold <> t.fold", ", q.fold")}
 SELECT 'KNN' AS model, fold, 'recall' AS metric, round(avg(prediction), 6) AS value FROM voted WHERE label = 1 GROUP BY fold""",
    "anova_f": f"""WITH m AS ({MODEL}), cell AS ({cells("(SELECT * FROM m WHERE split = 'train')")}),
 s AS (SELECT feature, label, count(*) AS n, avg(value) AS mean, var_pop(value) * count(*) AS ss FROM cell GROUP BY feature, label),
 w AS (SELECT feature, avg(value) AS centre FROM cell GROUP BY feature)
 SELECT feature, round((sum(n * (mean - centre) * (mean - centre)) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))), 4) AS f_score
 FROM s JOIN w USING (feature) GROUP BY feature""",
    "select_k_best": f"""WITH m AS ({MODEL}), cell AS ({cells("(SELECT * FROM m WHERE split = 'train')")}),
 s AS (SELECT feature, label, count(*) AS n, avg(value) AS mean, var_pop(value) * count(*) AS ss FROM cell GROUP BY feature, label),
 w AS (SELECT feature, avg(value) AS centre FROM cell GROUP BY feature)
 SELECT feature FROM s JOIN w USING (feature) GROUP BY feature
 ORDER BY sum(n * (mean - centre) * (mean - centre)) / sum(ss) DESC, feature LIMIT 6""",
    "pca2_variance": f"""WITH c AS (SELECT var_samp(age) AS a, var_samp(credit_amount) AS d, covar_samp(age, credit_amount) AS b
 FROM ({MODEL}) WHERE split = 'train'),
 e AS (SELECT a + d AS total, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS big FROM c)
 SELECT 0 AS component, round(big, 6) AS variance, round(big / total, 6) AS share FROM e
 UNION ALL SELECT 1, round(total - big, 6), round((total - big) / total, 6) FROM e""",
    "profile_overview": _overview(APPS, _NUM + _TEXT),
    "profile_overview_lines": _overview("SELECT * FROM lineitem", LINE_COLUMNS),
    "profile_columns": f"WITH a AS ({APPS}), s AS ({_SUMMARY}) "
    + """SELECT "column", kind, n_rows, n_null, round(null_share, 6) AS null_share, n_distinct,
 round(distinct_share, 6) AS distinct_share FROM s""",
    "profile_numeric": numbers(
        """SELECT "column", count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
 round(var_samp(value), 2) AS variance, round(min(value), 6) AS min, round(max(value), 6) AS max,
 round(max(value) - min(value), 6) AS "range", round(sum(value), 2) AS sum, round(stddev_samp(value) / avg(value), 6) AS cv,
 count(*) FILTER (WHERE value = 0) AS n_zero, count(*) FILTER (WHERE value < 0) AS n_negative,
 round(mad(value), 6) AS mad FROM v GROUP BY "column\""""
    ),
    "profile_quantiles": numbers(_QUANTILES),
    "profile_quantiles_lines": numbers(
        _QUANTILES, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem", "SELECT 1"
    ),
    "profile_moments": numbers(
        """SELECT "column", round(skewness(value), 6) AS skewness, round(kurtosis(value), 6) AS kurtosis FROM v GROUP BY "column\""""
    ),
    "profile_histogram": numbers(
        """, s AS (SELECT "column", min(value) AS l, max(value) AS h FROM v GROUP BY "column")
 SELECT "column", CAST(least(floor((value - l) / (h - l) * 10) + 1, 10) AS INT) AS bin, count(*) AS n
 FROM v JOIN s USING ("column") GROUP BY "column", bin"""
    ),
    "profile_top_values": f"WITH a AS ({APPS}), v AS ({tall(_TEXT, 'a', 'VARCHAR')}) "
    + """SELECT "column", value, count(*) AS n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS INT) AS rank
 FROM v WHERE value IS NOT NULL GROUP BY "column", value QUALIFY rank <= 5""",
    "profile_extremes": numbers(
        """, c AS (SELECT "column", value, count(*) AS n FROM v GROUP BY "column", value)
 SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) AS INT) AS rank, 'min' AS side FROM c QUALIFY rank <= 5
 UNION ALL SELECT "column", value, n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value DESC) AS INT) AS rank, 'max' FROM c QUALIFY rank <= 5"""
    ),
    "profile_text": f"WITH a AS ({APPS}), v AS ({tall(_TEXT, 'a', 'VARCHAR')}) "
    + """SELECT "column", CAST(min(length(value)) AS INT) AS min_length, CAST(max(length(value)) AS INT) AS max_length,
 round(avg(length(value)), 6) AS mean_length, round(median(length(value)), 6) AS median_length FROM v GROUP BY "column\"""",
    "corr_pearson": f"WITH a AS ({APPS}) " + pairs(_NUM, "corr({a}, {b})", "pearson", "a"),
    "corr_spearman": f"WITH a AS ({APPS}), r AS (SELECT "
    + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in _NUM)
    + " FROM a) "
    + pairs(_NUM, "corr({a}, {b})", "spearman", "r"),
    "cramers_v": f"""WITH p AS ({APPS}), c AS ({_CRAMER}),
 e AS (SELECT left_column, right_column, n, a, b, sum(n) OVER (PARTITION BY left_column, right_column, a) AS ra,
       sum(n) OVER (PARTITION BY left_column, right_column, b) AS cb FROM c),
 s AS (SELECT left_column, right_column, sum(n * n / (ra * cb)) - 1 AS phi, sum(n) AS n, count(DISTINCT a) AS r, count(DISTINCT b) AS k
       FROM e GROUP BY left_column, right_column)
 SELECT left_column, right_column, round(sqrt(phi / (least(r, k) - 1)), 6) AS cramers_v,
  round(sqrt(greatest(0, phi - (k - 1) * (r - 1) / (n - 1))
   / least(r - (r - 1) * (r - 1) / (n - 1) - 1, k - (k - 1) * (k - 1) / (n - 1) - 1)), 6) AS cramers_v_corrected FROM s""",
    "nullity_corr": f"WITH a AS ({APPS}) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS left_column, '{y}' AS right_column, "
        + (f"(SELECT round(corr(({x} IS NULL)::INT, ({y} IS NULL)::INT), 6) FROM a)" if (x, y) == GAPPED else "NULL")
        + " AS nullity_correlation"
        for x, y in combinations(APP_COLUMNS, 2)
    ),
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "duplicates": """SELECT *, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "profile_alerts": f"WITH a AS ({APPS}), s AS ({_SUMMARY}), v AS ({tall(['application_id', *_NUM], 'a', 'DOUBLE')}), "
    + f"t AS ({tall(_TEXT, 'a', 'VARCHAR')}), c AS ({pairs(['application_id', *_NUM], 'corr({a}, {b})', 'r', 'a')}), "
    + """f AS (SELECT "column", 'constant' AS alert, CAST(n_distinct AS DOUBLE) AS value FROM s WHERE kind = 'constant'
 UNION ALL SELECT "column", 'unique', n_distinct FROM s WHERE kind = 'unique'
 UNION ALL SELECT "column", 'missing', null_share FROM s WHERE null_share > 0.05
 UNION ALL SELECT "column", 'high_cardinality', n_distinct FROM s WHERE n_distinct > 50
  AND "column" IN ('sex', 'housing', 'saving_accounts', 'checking_account', 'purpose', 'risk')
 UNION ALL SELECT "column", 'zeros', avg((value = 0)::INT) FROM v GROUP BY "column" HAVING avg((value = 0)::INT) > 0.10
 UNION ALL SELECT "column", 'skewed', skewness(value) FROM v GROUP BY "column" HAVING abs(skewness(value)) > 1
 UNION ALL SELECT concat(left_column, '~', right_column), 'correlated', r FROM c WHERE abs(r) > 0.5
 UNION ALL SELECT "column", 'imbalanced', max(n) / sum(n) FROM
  (SELECT "column", value, count(*) AS n FROM t WHERE value IS NOT NULL GROUP BY "column", value) GROUP BY "column" HAVING max(n) / sum(n) > 0.6)
 SELECT "column", alert, round(value, 6) AS value FROM f""",
    "head_tail": f"""WITH a AS ({APPS}) SELECT *, 'head' AS part FROM (SELECT * FROM a ORDER BY application_id LIMIT 10)
 UNION ALL SELECT *, 'tail' FROM (SELECT * FROM a ORDER BY application_id DESC LIMIT 10)""",
    "lineage_log": f"""WITH r AS MATERIALIZED ({RAW_TEXTS}),
 n AS (SELECT (SELECT count(*) FROM r) AS n_raw, (SELECT count(*) FROM r WHERE NOT {_BROKEN}) AS n_valid,
  (SELECT count(*) FROM r WHERE NOT {_BROKEN} AND {bucket()} >= 2500) AS n_train,
  (SELECT CAST(strftime(max(o_orderdate), '%Y%m%d') AS BIGINT) FROM orders) AS batch_nr)
 SELECT batch_nr, 'raw' AS step, 'orders' AS source, 'raw' AS destination, NULL AS rows_in, n_raw AS rows_out FROM n
 UNION ALL SELECT batch_nr, 'validation', 'raw', 'validation', n_raw, n_valid FROM n
 UNION ALL SELECT batch_nr, 'training', 'validation', 'training', n_valid, n_train FROM n""",
    "data_dictionary": f"WITH a AS ({APPS}), s AS ({_SUMMARY}), "
    + "d AS (SELECT * FROM (VALUES "
    + ", ".join(
        f"('{c}', {i}, '{t}', '{_KINDS[c]}', '{note}')"
        for i, (c, t, note) in enumerate(
            [
                ("application_id", "bigint", "row index of the file"),
                ("age", "int", ""),
                ("sex", "string", ""),
                ("job", "int", ""),
                ("housing", "string", ""),
                ("saving_accounts", "string", ""),
                ("checking_account", "string", ""),
                ("credit_amount", "double", ""),
                ("duration", "int", ""),
                ("purpose", "string", ""),
                ("risk", "string", "good or bad"),
            ]
        )
    )
    + """) t("column", position, data_type, base_kind, comment))
 SELECT d.*, s.kind, s.n_rows, s.n_null, s.n_distinct FROM d JOIN s USING ("column")""",
    "results_summary": SUMMARY,
    "published_summary": SUMMARY,
    "csv_landing": APPS,
    "prefix_scan": APPS,
    "promoted_copy": f"SELECT count(*) AS n_rows, TRUE AS matched FROM ({APPS})",
    "warehouse_load": f"""SELECT age, sex, job, housing, saving_accounts AS saving_account,
 checking_account AS check_account, duration, purpose FROM ({APPS})""",
    "daily_landing": """SELECT CAST(strftime(ts - INTERVAL 7 HOUR, '%Y%m%d') AS BIGINT) AS batch_nr, count(*) AS n_rows,
 round(sum(value), 2) AS value FROM events GROUP BY batch_nr""",
    "gnb_roc": roc(True, "(SELECT label, round(probability, 6) AS score FROM scored WHERE split = 'test')", GNB.rstrip() + ","),
    "batch_published": f"""WITH d AS (
      SELECT application_id, application_id % 97 = 0 AS bad_age, application_id % 103 = 3 AS long_purpose,
             application_id % 89 = 1 AS no_amount, application_id % 101 = 2 AS no_job FROM ({APPS}))
      SELECT application_id, CASE
        WHEN bad_age AND long_purpose THEN 'quarantined age:not_numeric,purpose:longer_than_40'
        WHEN bad_age THEN 'quarantined age:not_numeric' WHEN long_purpose THEN 'quarantined purpose:longer_than_40'
        WHEN no_job AND no_amount THEN 'unscored job,credit_amount' WHEN no_job THEN 'unscored job'
        WHEN no_amount THEN 'unscored credit_amount' ELSE 'scored' END AS outcome FROM d""",
    "dated_landing": f"""SELECT application_id, purpose, credit_amount,
      CASE WHEN application_id % 2 = 0 THEN 20230512 ELSE 20230513 END AS batch_nr FROM ({APPS})""",
    "promoted_partitions": f"""SELECT purpose, count(*) AS n_rows, round(sum(credit_amount + CASE WHEN purpose = 'ASIA' THEN 1 ELSE 0 END), 2) AS credit_amount,
 CASE WHEN purpose = 'ASIA' THEN 2 ELSE 1 END AS n_copies FROM ({APPS}) GROUP BY purpose""",
    "interleaved_scan": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders, (SELECT min(o_custkey) AS low, max(o_custkey) AS high FROM orders)
 WHERE o_custkey BETWEEN low AND low + (high - low) / 20.0 AND o_totalprice BETWEEN 100000 AND 150000""",
    "profile_by_batches": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT year(o_orderdate)) AS n_batches, count(*) AS n_rows, count(*) - count({c}) AS n_null,
 {f'round(avg({c}::DOUBLE), 4)' if numeric else 'NULL::DOUBLE'} AS mean, {f'min({c})::DOUBLE' if numeric else 'NULL::DOUBLE'} AS min,
 {f'max({c})::DOUBLE' if numeric else 'NULL::DOUBLE'} AS max FROM orders"""
        for c, numeric in [("o_orderkey", 1), ("o_custkey", 1), ("o_orderstatus", 0), ("o_totalprice", 1), ("o_orderdate", 0), ("o_orderpriority", 0)]
    ),
    "null_patterns": f"""SELECT concat({", ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in APP_COLUMNS)}) AS gaps, count(*) AS n
 FROM ({APPS}) GROUP BY 1""",
    "lineage_append": f"""SELECT b AS batch_nr, t AS timestamp, s AS step, 'applications' AS source, s AS destination, n AS rows_out
      FROM (VALUES (20230512, '2023-05-12 07:30:00', 'raw', 0), (20230513, '2023-05-13 07:30:00', 'curation', 1)) v(b, t, s, odd)
      JOIN (SELECT application_id % 2 AS odd, count(*) AS n FROM ({APPS}) GROUP BY 1) USING (odd)""",
    "classified_by_bayes": GNB
    + f"SELECT a.*, s.prediction FROM ({APPS}) a JOIN scored s USING (application_id)",
}
# Rows that a stream takes up come out as those of one batch, however they arrive.
ORACLE["stream_published"] = ORACLE["batch_published"]
