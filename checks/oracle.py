"""SQL that gives the same results as the registered queries, for DuckDB.

Written independently of the Spark side: versions by window functions, joins
where Spark aggregates, gamma-function series where Spark sums to a tolerance.
"""

from __future__ import annotations

import re
from types import SimpleNamespace

import numpy as np

from checks.parameters import BG, GG, PARETO

_AS_OF = "DATE '2001-08-01'"


def _half_up(x: str) -> str:
    return f"sign({x}) * floor(abs({x}) * 100 + 0.5) / 100"


def _half_even(x: str, scale: int = 100) -> str:
    return f"round_even(({x}) * {scale}, 0) / {scale}"


_TABLES = {
    "ledger_lines": """
        SELECT l_orderkey * 10 + l_linenumber AS Id,
          CASE WHEN back THEN 1000000000 + l_orderkey * 2 + l_linenumber % 2 ELSE l_orderkey END AS DocumentId,
          CASE WHEN back THEN l_orderkey END AS SalesOrderId,
          CASE WHEN l_partkey % 20 = 0 THEN 'P' ELSE 'I' END || CAST(l_partkey AS VARCHAR) AS ItemId,
          CAST(price * sgn AS DECIMAL(18,4)) AS AmountWithoutVat,
          CAST(price * CAST(l_discount AS DECIMAL(4,2)) * sgn AS DECIMAL(18,4)) AS DiscountAmountWithoutVat,
          l_shipdate AS __ts_ms
        FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
                l_returnflag = 'R' AND l_linenumber <= 2 AS back,
                CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN -1 ELSE 1 END AS sgn
              FROM lineitem)""",
    "ledger_documents": """
        SELECT key AS Id, key AS OrderId, email AS BillToEmail, cur AS CurrencyCode,
          o_orderdate + created * INTERVAL 1 DAY AS CreatedOn,
          o_orderdate + changed * INTERVAL 1 DAY AS __ts_ms
        FROM (
          SELECT o_orderdate, 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
            CASE c_nationkey % 4 WHEN 0 THEN 'DKK' WHEN 1 THEN 'EUR' WHEN 2 THEN 'SEK' ELSE 'USD' END AS cur,
            unnest([{'key': o_orderkey, 'created': 0, 'changed': 0},
                    {'key': CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey END, 'created': 0, 'changed': 3},
                    {'key': 1000000000 + o_orderkey * 2, 'created': 45, 'changed': 45},
                    {'key': 1000000001 + o_orderkey * 2, 'created': 30, 'changed': 30}], recursive := true)
          FROM orders JOIN customer ON o_custkey = c_custkey)
        WHERE key IS NOT NULL""",
    "fx_rates": """
        SELECT CurrencyCode, Date,
          CAST(CASE CurrencyCode WHEN 'DKK' THEN 1.0 WHEN 'EUR' THEN 0.1340 + 0.0001 * month(Date)
               WHEN 'SEK' THEN 1.4500 + 0.0010 * month(Date) ELSE 0.1450 + 0.0002 * month(Date) END
               AS DOUBLE) AS Rate
        FROM (SELECT DISTINCT CurrencyCode, CAST(CreatedOn AS DATE) AS Date FROM ledger_documents)
        WHERE NOT (CurrencyCode = 'USD' AND day(Date) = 13)""",
    "line_versions": """
        SELECT *, min(sec) OVER (PARTITION BY Id) AS oldest, max(sec) OVER (PARTITION BY Id) AS newest
        FROM (SELECT *, floor(epoch(__ts_ms)) AS sec FROM ledger_lines) WHERE Id IS NOT NULL""",
    "document_versions": """
        SELECT *, CAST(CreatedOn AS DATE) AS created,
          min(sec) OVER (PARTITION BY OrderId) AS oldest, max(sec) OVER (PARTITION BY OrderId) AS newest
        FROM (SELECT *, floor(epoch(__ts_ms)) AS sec FROM ledger_documents) WHERE OrderId IS NOT NULL""",
    "sold": """
        SELECT d.OrderId, d.created AS order_date, d.BillToEmail AS userId, d.CurrencyCode,
          CAST(round(sum(l.AmountWithoutVat - l.DiscountAmountWithoutVat), 2) AS DOUBLE) AS order_revenue
        FROM line_versions l JOIN document_versions d ON l.DocumentId = d.Id
        WHERE l.sec = l.oldest AND d.sec = d.oldest AND l.AmountWithoutVat > 0 AND l.ItemId NOT LIKE 'P%'
        GROUP BY ALL""",
    "sold_base": f"""
        SELECT OrderId, order_date, userId, {_half_up('order_revenue / Rate')} AS order_revenue
        FROM sold s LEFT JOIN fx_rates f ON s.CurrencyCode = f.CurrencyCode AND s.order_date = f.Date""",
    "sent_back": """
        SELECT l.SalesOrderId, d.created AS return_date, d.CurrencyCode,
          CAST(round(sum(l.AmountWithoutVat - l.DiscountAmountWithoutVat), 2) AS DOUBLE) AS return_amount
        FROM line_versions l JOIN document_versions d ON l.DocumentId = d.Id
        WHERE l.sec = l.newest AND d.sec = d.newest AND l.AmountWithoutVat < 0 AND l.ItemId NOT LIKE 'P%'
        GROUP BY ALL""",
    "sent_back_base": f"""
        SELECT SalesOrderId, return_date, {_half_up('return_amount / Rate')} AS return_amount
        FROM sent_back s LEFT JOIN fx_rates f ON s.CurrencyCode = f.CurrencyCode AND s.return_date = f.Date""",
    "net": f"""
        SELECT OrderId, userId, order_date, CASE WHEN return_amount IS NULL THEN order_revenue
          ELSE {_half_up('(order_revenue + return_amount)')} END AS order_value
        FROM sold_base LEFT JOIN sent_back_base ON OrderId = SalesOrderId""",
    "net_total": f"""
        SELECT OrderId, userId, order_date, CASE WHEN back IS NULL THEN order_revenue
          ELSE {_half_up('(order_revenue + back)')} END AS order_value
        FROM sold_base LEFT JOIN
          (SELECT SalesOrderId, CAST(sum(CAST(return_amount AS DECIMAL(28,2))) AS DOUBLE) AS back
           FROM sent_back_base GROUP BY SalesOrderId) ON OrderId = SalesOrderId""",
    "counts": f"""
        SELECT userId, count(order_date) AS orders_all_time,
          count(order_date) FILTER (WHERE order_date > {_AS_OF} - INTERVAL 24 MONTH) AS orders_recent
        FROM net WHERE order_value >= 0 GROUP BY userId""",
    "eligible": """
        SELECT userId FROM counts WHERE orders_all_time >= 2 AND orders_recent >= 1 AND userId IS NOT NULL""",
    "touched": f"""
        SELECT DISTINCT BillToEmail AS userId FROM ledger_documents
        WHERE CAST(__ts_ms AS DATE) >= {_AS_OF} - INTERVAL 1 DAY""",
    "train": """
        SELECT userId, order_date, order_value FROM
          (SELECT DISTINCT OrderId, userId, order_date, order_value FROM net WHERE order_value > 0)
        WHERE userId IN (SELECT userId FROM eligible)""",
    "train_daily": "SELECT * FROM train WHERE userId IN (SELECT userId FROM touched)",
    "bought": """
        SELECT CAST(user_id AS VARCHAR) AS userId, CAST(ts AS DATE) AS order_date, value AS order_value
        FROM events WHERE event_type = 'purchase'""",
    "buyers": f"""
        SELECT c_custkey, c_acctbal, spent, n, spent_lately FROM customer JOIN
          (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spent,
             sum(CAST(o_totalprice AS DECIMAL(12,2)))
               FILTER (WHERE CAST(o_orderdate AS DATE) > {_AS_OF} - INTERVAL 6 MONTH) AS spent_lately
           FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "known": """
        SELECT 'c' || CAST(c_custkey AS VARCHAR) AS userId,
          CAST(spent + CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS clv,
          CASE WHEN n > 3 THEN n / 40.0 END AS churn_probability,
          c_acctbal AS predicted_value_next_6_month, CAST(spent AS DOUBLE) AS current_total_revenue
        FROM buyers""",
    "fresh": f"""
        SELECT 'c' || CAST(c_custkey AS VARCHAR) AS userId, CAST(spent + spent_lately AS DOUBLE) AS clv,
          n / 25.0 AS churn_probability, {_half_up('(c_acctbal / 2)')} AS predicted_value_next_6_month,
          CAST(spent AS DOUBLE) AS current_total_revenue
        FROM buyers, generate_series(1, 2) WHERE spent_lately IS NOT NULL""",
    "kept": "SELECT k.* FROM known k LEFT JOIN fresh f ON k.userId = f.userId WHERE f.userId IS NULL",
    "merged": "SELECT * FROM fresh UNION SELECT * FROM kept",
    "files": """
        SELECT DISTINCT CASE WHEN o_orderkey % 7 = 0 THEN 'archive/' ELSE '' END || 'clv_model_'
          || CASE o_orderkey % 3 WHEN 0 THEN 'BGNBD' WHEN 1 THEN 'PARETO' ELSE 'ggf' END || '_'
          || CASE o_orderkey % 11 WHEN 0 THEN 'latest' WHEN 1 THEN '2024-13-01'
             ELSE strftime(o_orderdate, '%Y-%m-%d') END || '.pkl' AS file
        FROM orders""",
    "file_dates": r"""
        SELECT file, TRY_CAST(nullif(regexp_extract(file, '\d{4}-\d{2}-\d{2}'), '') AS DATE) AS date
        FROM files""",
}


def _history(name: str, source: str, unit: str, days: float) -> dict[str, str]:
    return {
        f"{name}_periods": f"""
            SELECT userId, CAST(date_trunc('{unit}', order_date) AS DATE) AS period,
              sum(CAST(order_value AS DECIMAL(30,10))) AS amount FROM {source} GROUP BY 1, 2""",
        f"{name}_rfm": f"""
            SELECT userId, CAST(n - 1 AS DOUBLE) AS frequency, (latest - earliest) / {days} AS recency,
              ((SELECT max(period) FROM {name}_periods) - earliest) / {days} AS T,
              CASE WHEN n > 1 THEN CAST(total - opening AS DOUBLE) / (n - 1) ELSE 0.0 END AS monetary_value,
              CAST(total AS DOUBLE) AS current_total_revenue
            FROM (SELECT userId, count(*) AS n, min(period) AS earliest, max(period) AS latest,
                    sum(amount) AS total, arg_min(amount, period) AS opening
                  FROM {name}_periods GROUP BY userId)""",
        f"{name}_repeat": f"SELECT * FROM {name}_rfm WHERE frequency > 0 AND monetary_value > 0",
    }


# Days per period as floating-point literals, so that DuckDB divides doubles.
_TABLES |= _history("month", "train", "month", "30.436875e0")
_TABLES |= _history("daily", "train_daily", "month", "30.436875e0")
_TABLES |= _history("week", "bought", "week", "7e0")
_TABLES |= _history("day", "bought", "day", "1e0")


def _gauss(a: str, b: str, c: str, z: str, terms: int = 250) -> str:
    """2F1 by its defining series."""
    return (f"list_sum(list_transform(range(0, {terms}), lambda n: exp(lgamma({a} + n) - lgamma({a}) + "
            f"lgamma({b} + n) - lgamma({b}) - lgamma({c} + n) + lgamma({c}) - lgamma(n + 1.0) "
            f"+ n * ln({z}))))")


def bg_alive(m=BG) -> str:
    r, al, a, b = m.r, m.alpha, m.a, m.b
    return (f"(CASE WHEN frequency > 0 THEN 1 / (1 + {a} / ({b} + frequency - 1) "
            f"* (({al} + T) / ({al} + recency)) ** ({r} + frequency)) ELSE 1.0 END)")


def bg_purchases(t: float, m=BG) -> str:
    r, al, a, b = m.r, m.alpha, m.a, m.b
    f = _gauss(f"({r} + frequency)", f"({b} + frequency)", f"({a} + {b} + frequency - 1)",
               f"({t} / ({al} + T + {t}))")
    return (f"(({a} + {b} + frequency - 1) / ({a} - 1) "
            f"* (1 - (({al} + T) / ({al} + T + {t})) ** ({r} + frequency) * {f}) * {bg_alive(m)})")


def pareto_alive() -> str:
    r, al, s, be = PARETO.r, PARETO.alpha, PARETO.s, PARETO.beta
    p = f"({r} + {s} + frequency)"

    def term(t: str) -> str:
        return (f"{_gauss(p, f'({r} + frequency)', f'({p} + 1)', f'(({be} - {al}) / ({be} + {t}))', 120)}"
                f" * (({al} + T) / ({be} + {t})) ** ({r} + frequency)"
                f" * (({be} + T) / ({be} + {t})) ** {s}")

    return f"(1 / (1 + {s} / {p} * ({term('recency')} - {term('T')})))"


def pareto_purchases(t: float) -> str:
    r, al, s, be = PARETO.r, PARETO.alpha, PARETO.s, PARETO.beta
    return (f"(({r} + frequency) * ({be} + T) / (({al} + T) * ({s} - 1)) "
            f"* (1 - (({be} + T) / ({be} + T + {t})) ** ({s} - 1)) * {pareto_alive()})")


def average_value(m=GG) -> str:
    p, q, v = m.p, m.q, m.v
    return (f"(({q} - 1) / ({p} * frequency + {q} - 1) * {p} * {v} / ({q} - 1) "
            f"+ {p} * frequency / ({p} * frequency + {q} - 1) * monetary_value)")


def bg_log_likelihood() -> str:
    r, al, a, b = BG.r, BG.alpha, BG.a, BG.b
    return (f"lgamma({r} + frequency) - lgamma({r}) + {r} * ln({al}) + lgamma({a} + {b}) "
            f"+ lgamma({b} + frequency) - lgamma({b}) - lgamma({a} + {b} + frequency) "
            f"+ ln(({al} + T) ** -({r} + frequency) + CASE WHEN frequency > 0 "
            f"THEN {a} / ({b} + frequency - 1) * ({al} + recency) ** -({r} + frequency) ELSE 0 END)")


def pareto_log_likelihood() -> str:
    r, al, s, be = PARETO.r, PARETO.alpha, PARETO.s, PARETO.beta
    return (f"lgamma({r} + frequency) - lgamma({r}) + {r} * ln({al}) + {s} * ln({be}) "
            f"- ({r} + frequency) * ln({al} + T) - {s} * ln({be} + T) - ln({pareto_alive()})")


def gg_log_likelihood() -> str:
    p, q, v = GG.p, GG.q, GG.v
    px = f"({p} * frequency)"
    return (f"lgamma({px} + {q}) - lgamma({px}) - lgamma({q}) + {q} * ln({v}) + ({px} - 1) * ln(monetary_value) "
            f"+ {px} * ln(frequency) - ({px} + {q}) * ln(frequency * monetary_value + {v})")


def _lifetime(months: int = 6, discount: float = 0.01) -> str:
    purchases = [f"e{i}" for i in range(1, months + 1)]
    before = ["0"] + purchases[:-1]
    return " + ".join(f"({now} - {then}) / {1 + discount} ** {i}"
                      for i, (now, then) in enumerate(zip(purchases, before), 1))


def _scored(source: str, bg=BG, gg=GG) -> str:
    steps = ", ".join(f"{bg_purchases(float(i), bg)} AS e{i}" for i in range(1, 7))
    return f"""
        SELECT userId, current_total_revenue, 1 - {bg_alive(bg)} AS churn, {average_value(gg)} * ({_lifetime()}) AS forecast
        FROM (SELECT *, {steps} FROM {source})"""


def _output(source: str) -> str:
    return f"""
        SELECT userId, {_half_even('current_total_revenue + forecast')} AS clv,
          {_half_even('churn', 10000)} AS churn_probability,
          {_half_even('forecast')} AS predicted_value_next_6_month,
          {_half_even('current_total_revenue')} AS current_total_revenue
        FROM {source}"""


_TABLES |= {
    "month_scored": _scored("month_repeat"), "month_predicted": _output("month_scored"),
    "daily_scored": _scored("daily_repeat"), "daily_predicted": _output("daily_scored"),
    "refreshed": """SELECT * FROM daily_predicted UNION
        SELECT * FROM month_predicted WHERE userId NOT IN (SELECT userId FROM daily_predicted)""",
}


def value_label(source: str) -> str:
    p = [f"(SELECT quantile_disc(clv, {q}) FROM {source})" for q in (0.25, 0.5, 0.75)]
    return (f"CASE WHEN clv < {p[0]} THEN 'Lowest 25% Customers' WHEN clv <= {p[1]} THEN 'Low Medium Value' "
            f"WHEN clv <= {p[2]} THEN 'High Medium Value' WHEN clv > {p[2]} THEN 'Top 25% Customers' ELSE '' END")


RISK_LABEL = ("CASE WHEN churn_probability < 0.25 THEN 'Low Risk' WHEN churn_probability <= 0.7 THEN 'Medium Risk' "
              "WHEN churn_probability > 0.7 THEN 'High Risk' ELSE '' END")


def segmented(source: str) -> str:
    return (f"SELECT *, {value_label(source)} AS clv_segment, {RISK_LABEL} AS churn_probability_segment "
            f"FROM {source}")


# Fits: a damped Newton search as a recursive query.  Slopes come from differences of the objective itself.

_DELTA = 1e-3
_FLOOR = "ln(1e-8)"
_NODES = 24


def _left() -> str:
    """The time when a customer left, integrated by Gauss and Legendre's rule."""
    places, weights = np.polynomial.legendre.leggauss(_NODES)
    terms = []
    for place, weight in zip(places.tolist(), weights.tolist()):
        then = f"tx + (t - tx) * {(1 + place) / 2!r}"
        terms.append(f"{weight!r} * ((alpha + t) / (alpha + {then})) ** (r + x) "
                     f"* ((beta + t) / (beta + {then})) ** s / (beta + {then})")
    return f"(t - tx) / 2 * ({' + '.join(terms)})"


_LIKELIHOODS = {
    "bgnbd": (("r", "alpha", "a", "b"), """
        lgamma(r + x) - lgamma(r) + r * ln(alpha) + lgamma(a + b) + lgamma(b + x) - lgamma(b) - lgamma(a + b + x)
        - (r + x) * ln(alpha + t) + CASE WHEN x > 0
            THEN ln(1 + a / (b + x - 1) * ((alpha + t) / (alpha + tx)) ** (r + x)) ELSE 0 END"""),
    "pareto_nbd": (("r", "alpha", "s", "beta"), f"""
        lgamma(r + x) - lgamma(r) + r * ln(alpha) + s * ln(beta) - (r + x) * ln(alpha + t) - s * ln(beta + t)
        + ln(1 + s * ({_left()}))"""),
    "gamma_gamma": (("p", "q", "v"), """
        lgamma(p * x + q) - lgamma(p * x) - lgamma(q) + q * ln(v) + (p * x - 1) * ln(m) + p * x * ln(x)
        - (p * x + q) * ln(x * m + v)"""),
}


def _stencil(n: int) -> list[list[float]]:
    """Offsets for a fourth-order gradient and a second-order Hessian."""
    def at(*moves: tuple[int, float]) -> list[float]:
        return [sum(size * _DELTA for i, size in moves if i == k) for k in range(n)]

    points = [at()]
    for i in range(n):
        points += [at((i, 1)), at((i, -1)), at((i, 2)), at((i, -2))]
    for i in range(n):
        for j in range(i):
            points += [at((i, 1), (j, 1)), at((i, -1), (j, -1))]
    return points


def fitted(kind: str, penalizer: float = 0.03, source: str = "month_repeat", digits: int = 4) -> str:
    """The parameters that maximise the mean log-likelihood less the penalty, each on a row."""
    return (f"SELECT parameter, round(value, {digits}) AS value, CAST(customers AS BIGINT) AS n_customers, "
            f"round(mean, 4) AS mean_log_likelihood, true AS converged FROM ({_search(kind, penalizer, source)})")


def _search(kind: str, penalizer: float, source: str) -> str:
    names, formula = _LIKELIHOODS[kind]
    n, timed = len(names), kind != "gamma_gamma"
    points = _stencil(n)
    up = [2 + 4 * i for i in range(n)]  # places in the list of values, from 1
    gradient = [f"(8 * (v[{u}] - v[{u + 1}]) - (v[{u + 2}] - v[{u + 3}])) / {12 * _DELTA}" for u in up]
    hessian, mixed = {}, iter(range(2 + 4 * n, len(points) + 1, 2))
    for i in range(n):
        hessian[i, i] = f"(v[{up[i]}] + v[{up[i] + 1}] - 2 * v[1]) / {_DELTA ** 2}"
    for i in range(n):
        for j in range(i):
            k, (a, b) = next(mixed), (up[i], up[j])
            hessian[i, j] = hessian[j, i] = (f"(v[{k}] + v[{k + 1}] - v[{a}] - v[{a + 1}] - v[{b}] - v[{b + 1}] "
                                             f"+ 2 * v[1]) / {2 * _DELTA ** 2}")
    # What is at the floor and pulled below it stays there.
    held = [f"(spot[{i + 1}] <= {_FLOOR} + 1e-9 AND g[{i + 1}] > 0)" for i in range(n)]
    cells = ", ".join(
        f"CASE WHEN {held[i]} OR {held[j]} THEN {1.0 if i == j else 0.0} ELSE h[{i * n + j + 1}]"
        + (f" + mu * (abs(h[{i * n + j + 1}]) + 1e-12)" if i == j else "") + f" END AS m{i}{j}"
        for i in range(n) for j in range(n))
    sides = ", ".join(f"CASE WHEN {held[i]} THEN 0.0 ELSE -g[{i + 1}] END AS y{i}" for i in range(n))
    solving = f"SELECT *, {cells}, {sides} FROM judged"
    for k in range(n):  # elimination, a column at a time
        lower = ", ".join([f"m{i}{j} - m{i}{k} / m{k}{k} * m{k}{j} AS m{i}{j}"
                           for i in range(k + 1, n) for j in range(k + 1, n)]
                          + [f"y{i} - m{i}{k} / m{k}{k} * y{k} AS y{i}" for i in range(k + 1, n)])
        if lower:
            solving = f"SELECT * REPLACE ({lower}) FROM ({solving})"
    for k in reversed(range(n)):
        known = "".join(f" - m{k}{j} * z{j}" for j in range(k + 1, n))
        solving = f"SELECT *, (y{k}{known}) / m{k}{k} AS z{k} FROM ({solving})"
    step = ", ".join(f"greatest({_FLOOR}, spot[{i + 1}] + greatest(-2, least(2, coalesce(nullif(z{i}, 'nan'), 0))))"
                     for i in range(n))
    params = ", ".join(f"exp(cand[{i + 1}] + off[{i + 1}]) AS {name}" for i, name in enumerate(names))
    penalty = " + ".join(f"exp(2 * (any_value(cand[{i + 1}]) + any_value(off[{i + 1}])))" for i in range(n))
    apart = "greatest(" + ", ".join(f"abs(cand[{i + 1}] - spot[{i + 1}])" for i in range(n)) + ")"
    scale = f"(SELECT 10.0 / max(T) FROM {source})" if timed else "1.0"
    rates = {"alpha", "beta"}
    values = " UNION ALL ".join(
        f"SELECT '{name}' AS parameter, exp(spot[{i + 1}])" + (f" / {scale}" if name in rates else "")
        + " AS value, customers, mean FROM last" for i, name in enumerate(names))
    return f"""
        WITH RECURSIVE
          hist AS MATERIALIZED (SELECT frequency AS x, recency * {scale} AS tx, T * {scale} AS t,
              monetary_value AS m, count(*) AS w FROM {source} GROUP BY ALL),
          points AS MATERIALIZED (SELECT unnest({list(range(len(points)))}) AS id, unnest({points}::DOUBLE[][]) AS off),
          size AS MATERIALIZED (SELECT sum(w) AS customers FROM hist),
          search(i, spot, f, g, h, mu, cand) AS (
            SELECT 0, {[0.0] * n}::DOUBLE[], 'inf'::DOUBLE, {[0.0] * n}::DOUBLE[], {[0.0] * n * n}::DOUBLE[],
              0.01::DOUBLE, {[0.0] * n}::DOUBLE[]
            UNION ALL
            (WITH tried AS (
                SELECT id, any_value(s.i) AS i, any_value(spot) AS spot, any_value(f) AS f, any_value(g) AS g,
                  any_value(h) AS h, any_value(mu) AS mu, any_value(cand) AS cand,
                  {penalizer} * ({penalty}) - sum(w * ({formula})) / any_value(customers) AS value
                FROM (SELECT *, {params} FROM search, points, hist, size WHERE i = 0 OR (i < 90 AND {apart} > 1e-10)) s GROUP BY id),
              valued AS (SELECT any_value(i) AS i, any_value(spot) AS spot, any_value(f) AS f, any_value(g) AS g,
                  any_value(h) AS h, any_value(mu) AS mu, any_value(cand) AS cand, list(value ORDER BY id) AS v
                FROM tried HAVING count(*) > 0),
              judged AS (SELECT i + 1 AS i,
                  CASE WHEN better THEN cand ELSE spot END AS spot, CASE WHEN better THEN v[1] ELSE f END AS f,
                  CASE WHEN better THEN [{', '.join(gradient)}] ELSE g END AS g,
                  CASE WHEN better THEN [{', '.join(hessian[i, j] for i in range(n) for j in range(n))}] ELSE h END AS h,
                  CASE WHEN better THEN mu / 8 ELSE mu * 4 END AS mu
                FROM (SELECT *, coalesce(v[1] < f, false) AS better FROM valued))
             SELECT i, spot, f, g, h, mu, [{step}] FROM ({solving}))),
          last AS (SELECT spot, customers, {{mean}} AS mean FROM search, size ORDER BY i DESC LIMIT 1)
        {values}""".replace("{mean}", f"{penalizer} * ({' + '.join(f'exp(2 * spot[{i + 1}])' for i in range(n))}) - f"
                            + (f" + (SELECT sum(w * x) FROM hist) / customers * ln({scale})" if timed else ""))


def _as_columns(kind: str) -> str:
    """The fitted parameters as one row, named fit_..."""
    return "SELECT " + ", ".join(f"max(value) FILTER (WHERE parameter = '{n}') AS fit_{n}"
                                 for n in _LIKELIHOODS[kind][0]) + f" FROM ({_search(kind, 0.03, 'month_repeat')})"


def _fit_names(kind: str) -> SimpleNamespace:
    return SimpleNamespace(**{n: f"fit_{n}" for n in _LIKELIHOODS[kind][0]})


_TABLES |= {
    "fitted_purchases": _as_columns("bgnbd"), "fitted_values": _as_columns("gamma_gamma"),
    "weekly_input": "SELECT * FROM month_repeat, fitted_purchases, fitted_values",
    "weekly_scored": _scored("weekly_input", _fit_names("bgnbd"), _fit_names("gamma_gamma")),
    "weekly_predicted": _output("weekly_scored"),
}


def query(select: str) -> str:
    """A SELECT preceded by the named tables it uses, directly or through others."""
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in _TABLES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(_TABLES[name])
                needed[name] = None

    visit(select)
    tables = ",\n".join(f"{name} AS ({_TABLES[name]})" for name in needed)
    return f"WITH {tables}\n{select}" if needed else select
