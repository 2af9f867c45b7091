"""DuckDB twins of the Spark plans, used as the correctness oracle.

Each query's SQL is assembled from shared CTEs over the driver's raw tables.
"""

from __future__ import annotations

from ..schema import FEATURE_COLS, MANAGER_FEATURE_COLS

TX0 = """tx0 AS (
  SELECT event_id AS row_key,
    CAST(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS BIGINT) AS step,
    CASE event_type WHEN 'click' THEN 'CASH_IN' WHEN 'purchase' THEN 'CASH_OUT'
      WHEN 'signup' THEN 'DEBIT' WHEN 'view' THEN 'PAYMENT' WHEN 'error' THEN 'TRANSFER' END AS type,
    value AS amount,
    'C' || CAST(user_id AS VARCHAR) AS nameOrig,
    CASE WHEN event_id % 4 = 0 THEN value ELSE CAST((event_id * 37) % 1000 AS DOUBLE) END AS oldbalanceOrg,
    CASE WHEN event_type IN ('view', 'signup') THEN 'M' ELSE 'C' END
      || CAST((user_id * 7 + event_id) % 150 AS VARCHAR) AS nameDest,
    CAST((event_id * 53) % 2000 AS DOUBLE) AS oldbalanceDest,
    CASE WHEN event_type IN ('purchase', 'error') AND event_id % 4 = 0 AND event_id % 3 <> 0
      AND value > 60 THEN 1 ELSE 0 END AS isFraud,
    coalesce(event_type IN ('purchase', 'error') AND event_id % 4 = 0, false) AS emptied
  FROM events)"""

TX = TX0 + """,
tx AS (
  SELECT row_key, step, type, amount, nameOrig, oldbalanceOrg,
    greatest(oldbalanceOrg - amount, 0.0) AS newbalanceOrig, nameDest, oldbalanceDest,
    CASE WHEN emptied THEN oldbalanceDest ELSE oldbalanceDest + amount END AS newbalanceDest,
    isFraud,
    CASE WHEN isFraud = 1 AND amount > 200 THEN 1 ELSE 0 END AS isFlaggedFraud
  FROM tx0)"""

TX_DIRTY = TX + """,
txd0 AS (
  SELECT row_key, step, CASE WHEN row_key % 89 = 0 THEN NULL ELSE type END AS type,
    CASE WHEN row_key % 97 = 0 THEN NULL ELSE amount END AS amount,
    nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest,
    isFraud, isFlaggedFraud FROM tx),
tx_dirty AS (
  SELECT * FROM txd0
  UNION ALL SELECT -(row_key * 2 + 1), step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig,
    nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM txd0 WHERE row_key % 50 = 0
  UNION ALL SELECT -(row_key * 2 + 2), step, type, amount, 'X' || nameOrig, oldbalanceOrg, newbalanceOrig,
    nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM txd0 WHERE row_key % 60 = 0)"""

SOURCE_COLS = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig",
               "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"]


def features_cte(src: str = "tx", name: str = "feat") -> str:
    """Alphabetical codes (NULL -> number of codes) and the derived columns."""
    return f"""{name}_codes AS (
  SELECT type, CAST(row_number() OVER (ORDER BY type) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT type FROM {src} WHERE type IS NOT NULL)),
{name} AS (
  SELECT t.row_key, t.step,
    CAST(coalesce(c.code, (SELECT count(*) FROM {name}_codes)) AS INTEGER) AS type_encoded,
    t.amount, t.oldbalanceOrg, t.newbalanceOrig, t.oldbalanceDest, t.newbalanceDest,
    t.newbalanceOrig - t.oldbalanceOrg AS balance_diff_orig,
    t.newbalanceDest - t.oldbalanceDest AS balance_diff_dest,
    CAST(coalesce(t.oldbalanceOrg > 0 AND t.newbalanceOrig = 0, false) AS INTEGER) AS orig_zeroed,
    CAST(coalesce(t.type IN ('CASH_OUT', 'TRANSFER'), false) AS INTEGER) AS suspicious_type,
    abs(t.amount + (t.newbalanceOrig - t.oldbalanceOrg)) AS amount_balance_error,
    t.isFraud
  FROM {src} t LEFT JOIN {name}_codes c ON t.type = c.type)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def cols(names=FEATURE_COLS, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in names)


def long_cte(src: str, names, name: str = "lng", key: str | None = "row_key") -> str:
    parts = []
    for c in names:
        k = f"{key}, " if key else ""
        parts.append(f"SELECT {k}'{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM {src}")
    return f"{name} AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


__all__ = ["TX", "TX_DIRTY", "features_cte", "with_", "cols", "long_cte",
           "FEATURE_COLS", "MANAGER_FEATURE_COLS", "SOURCE_COLS"]


def split_cte(src: str, name: str = "spl", label: str = "isFraud", key: str = "row_key",
              test_size: float = 0.2, seed: int = 42) -> str:
    """Exact stratified split: largest-remainder train quotas (ties: smaller
    class), test = first rows of each class in (md5(key:seed), key) order."""
    return f"""{name}_cc AS (SELECT {label} AS lbl, count(*) AS n_c FROM {src} WHERE {label} IS NOT NULL GROUP BY 1),
{name}_q0 AS (SELECT lbl, n_c, sum(n_c) OVER () AS n,
    CAST(ceil({test_size} * sum(n_c) OVER ()) AS BIGINT) AS n_test FROM {name}_cc),
{name}_q1 AS (SELECT lbl, n_c, n, n_test, ((n - n_test) * n_c) // n AS fl, ((n - n_test) * n_c) % n AS rem
    FROM {name}_q0),
{name}_q2 AS (SELECT lbl, n_c, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, lbl)
    <= (n - n_test) - sum(fl) OVER () THEN 1 ELSE 0 END AS n_train_c FROM {name}_q1),
{name} AS (SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY s.{label}
    ORDER BY md5(concat(s.{key}, ':{seed}')), s.{key}) <= q.n_c - q.n_train_c THEN 'test' ELSE 'train' END AS split
  FROM {src} s JOIN {name}_q2 q ON s.{label} = q.lbl)"""


def take_cte(src: str, name: str, quota_sql: str, label: str = "isFraud", key: str = "row_key",
             seed: int = 42) -> str:
    """First ``quota`` rows per class in digest order; quota_sql may use q.n_c."""
    return f"""{name}_cc AS (SELECT {label} AS lbl, count(*) AS n_c FROM {src} WHERE {label} IS NOT NULL GROUP BY 1),
{name} AS (SELECT s.* FROM (SELECT s.*, row_number() OVER (PARTITION BY s.{label}
    ORDER BY md5(concat(s.{key}, ':{seed}')), s.{key}) AS rn FROM {src} s) s
  JOIN {name}_cc q ON s.{label} = q.lbl WHERE s.rn <= {quota_sql})"""


# F7 rule-based predictions (binary and three-class).
PRED_CTE = """pred AS (SELECT row_key, isFraud AS label, suspicious_type * orig_zeroed AS prediction,
    amount * suspicious_type * orig_zeroed AS score FROM feat)"""


def pred3_cte(risk_sql: str) -> str:
    return f"""pred AS (SELECT row_key, {risk_sql} AS label,
    CAST(CASE WHEN suspicious_type * orig_zeroed = 0 THEN 0 WHEN amount <= 100 THEN 1 ELSE 2 END AS INTEGER)
      AS prediction FROM feat)"""


METRIC_CTES = """lbls AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
conf AS (SELECT a.c AS label, b.c AS prediction,
    (SELECT count(*) FROM pred p WHERE p.label = a.c AND p.prediction = b.c) AS count
  FROM lbls a, lbls b),
pc0 AS (SELECT l.c AS label,
    (SELECT count(*) FROM pred WHERE label = l.c AND prediction = l.c) AS tp,
    (SELECT count(*) FROM pred WHERE prediction = l.c) AS predicted,
    (SELECT count(*) FROM pred WHERE label = l.c) AS support FROM lbls l),
pc1 AS (SELECT label, tp, predicted - tp AS fp, support - tp AS fn,
    coalesce(tp / nullif(predicted, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall,
    support FROM pc0),
pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0 END AS f1 FROM pc1)"""


def avg_sql(metric: str, average: str) -> str:
    if average == "binary":
        return f"(SELECT {metric} FROM pc ORDER BY label DESC LIMIT 1)"
    if average == "macro":
        return f"(SELECT avg({metric}) FROM pc)"
    if average == "weighted":
        return f"(SELECT coalesce(sum({metric} * support) / nullif(sum(support), 0), 0.0) FROM pc)"
    other = {"precision": "fp", "recall": "fn"}[metric]
    return f"(SELECT coalesce(sum(tp) / nullif(sum(tp) + sum({other}), 0), 0.0) FROM pc)"


def f1_sql(average: str, mode: str) -> str:
    if mode == "per_class" and average != "micro":
        return avg_sql("f1", average)
    p, r = avg_sql("precision", average), avg_sql("recall", average)
    return f"(CASE WHEN {p} + {r} > 0 THEN 2 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"


AUC_SQL = """(SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM (
   SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
     AS neg_below
   FROM (SELECT score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
           sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM pred WHERE score IS NOT NULL GROUP BY score)))"""


def u_sql(i: str, tag: str, seed: int = 42) -> str:
    return f"(CAST(('0x' || substr(md5(concat({i}, ':{seed}:{tag}')), 1, 8)) AS BIGINT) / 4294967296.0)"


EMB = """emb AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"""


def knn_ctes(metric: str, k: int = 5) -> str:
    dist = {"euclidean": "list_distance(q.v, t.v)",
            "cosine": "(1.0 - list_dot_product(q.v, t.v) / CASE WHEN sqrt(list_dot_product(q.v, q.v)) * "
                      "sqrt(list_dot_product(t.v, t.v)) = 0 THEN 1e-10 ELSE sqrt(list_dot_product(q.v, q.v)) * "
                      "sqrt(list_dot_product(t.v, t.v)) END)",
            "manhattan": "list_sum(list_transform(list_zip(q.v, t.v), lambda z: abs(z[1] - z[2])))"}[metric]
    return f"""kq AS (SELECT vec_id AS qid, v FROM spl WHERE split = 'test'),
kt AS (SELECT vec_id AS tid, v, label FROM spl WHERE split = 'train'),
kd AS (SELECT q.qid, t.tid, t.label, {dist} AS distance FROM kq q, kt t),
nn AS (SELECT qid, tid, label, distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, tid) AS rank FROM kd) WHERE rank <= {k})"""


def vote_sql(weight: str) -> str:
    return f"""vt AS (SELECT qid, label, sum({weight}) AS vote FROM nnw GROUP BY qid, label),
pr AS (SELECT qid, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY vote DESC, label) AS rn FROM vt) WHERE rn = 1)"""


NNW_EPS = "nnw AS (SELECT *, 1.0 / (distance + 1e-8) AS w FROM nn)"
NNW_UNIFORM = "nnw AS (SELECT *, 1.0 AS w FROM nn)"
NNW_EXACT = """nnw AS (SELECT *, CASE WHEN max(CASE WHEN distance = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) = 1
    THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / distance END AS w FROM nn)"""


def newton_cte(rows: str, n: int, name: str, steps: int, penalty: float = 1.0) -> str:
    """Recursive CTE ``name(g, step, b)``: Newton steps of the penalised logistic
    loss over ``rows(g, y, w, x1 .. xn)`` (xn = 1, the intercept, not penalised), one
    fit per ``g``. The system is solved by eliminating column after column."""
    at = range(1, n + 1)
    pen = {i: penalty if i < n else 0.0 for i in at}
    z = " + ".join(f"x{i} * b[{i}]" for i in at)
    sums = [f"sum(w * (p - y) * x{i}) AS g{i}" for i in at]
    sums += [f"sum(w * p * (1 - p) * x{i} * x{j}) AS h{i}_{j}" for i in at for j in at if i <= j]
    lines = []
    for i in at:
        cells = [f"h{min(i, j)}_{max(i, j)}" + (f" + {pen[i]}" if i == j else "") for j in at]
        lines.append("[" + ", ".join([*cells, f"g{i} + {pen[i]} * b[{i}]"]) + "]")
    system = f"""SELECT g, step, b, [{', '.join(lines)}] AS m FROM (
    SELECT g, any_value(step) AS step, any_value(b) AS b, {', '.join(sums)} FROM (
      SELECT r.*, step, b, 1 / (1 + exp(-({z}))) AS p FROM {name} JOIN {rows} r USING (g) WHERE step < {steps}) GROUP BY g)"""
    for k in at:
        system = f"""SELECT g, step, b, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN r
    ELSE list_transform(r, lambda v, j: v - r[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m FROM ({system})"""
    return f"""{name} AS (
  SELECT DISTINCT g, 0 AS step, [{', '.join(['CAST(0 AS DOUBLE)'] * n)}] AS b FROM {rows}
  UNION ALL
  SELECT g, step + 1, list_transform(b, lambda v, i: v - m[i][{n + 1}] / m[i][i]) FROM ({system}))"""
