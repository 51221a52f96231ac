"""DuckDB oracle text for the drift tables (same definitions as operators.drift)."""

from __future__ import annotations

import math

from cohortwatch.functions.stats import ERFC_COEFFS, SERIES_TERMS
from cohortwatch.operators import drift as D


def _long(src: str, numeric, categorical, group: str | None) -> str:
    g = f"CAST({group} AS VARCHAR)" if group else "''"
    parts = [f"SELECT {g} AS g, '{c}' AS column_name, 'num' AS kind, CAST({c} AS DOUBLE) + 0.0 AS vnum, "
             f"CAST(NULL AS VARCHAR) AS vtxt FROM {src} WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)) "
             f"AND NOT isinf(CAST({c} AS DOUBLE))" for c in numeric]
    parts += [f"SELECT {g} AS g, '{c}' AS column_name, 'cat' AS kind, CAST(NULL AS DOUBLE) AS vnum, "
              f"CAST({c} AS VARCHAR) AS vtxt FROM {src} WHERE {c} IS NOT NULL" for c in categorical]
    return " UNION ALL ".join(parts)


def erfc_sql(x: str) -> str:
    z = f"abs({x})"
    t = f"(1.0 / (1.0 + 0.5 * {z}))"
    poly = f"{ERFC_COEFFS[-1]}"
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = f"({c} + {t} * {poly})"
    ans = f"({t} * exp(-{z} * {z} + {poly}))"
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def ks_p_sql(d: str, n1: str, n2: str) -> str:
    lam = f"(sqrt(CAST({n1} AS DOUBLE) * {n2} / ({n1} + {n2})) * {d})"
    alt = " + ".join(f"CAST({(-1.0) ** (k - 1)} AS DOUBLE) * exp(-CAST({2.0 * k * k} AS DOUBLE) * {lam} * {lam})" for k in range(1, SERIES_TERMS + 1))
    small = " + ".join(f"exp(-CAST({(2 * k - 1) ** 2 * math.pi ** 2!r} AS DOUBLE) / (8.0 * {lam} * {lam}))"
                       for k in range(1, SERIES_TERMS + 1))
    q = (f"(CASE WHEN {lam} <= 0 THEN 1.0 WHEN {lam} < 1.18 THEN 1.0 - CAST({math.sqrt(2 * math.pi)!r} AS DOUBLE) / {lam} * ({small}) "
         f"ELSE 2.0 * ({alt}) END)")
    return f"LEAST(GREATEST({q}, 0.0), 1.0)"


def chi2_p_sql(x: str, df: str) -> str:
    h = f"({x} / 2.0)"
    even = (f"exp(-{h}) * list_sum(list_transform(range(0, CAST(GREATEST({df} // 2, 1) AS BIGINT)), "
            f"lambda i: exp(i * ln({h}) - lgamma(i + 1))))")
    odd = (f"{erfc_sql(f'sqrt({h})')} + exp(-{h}) * COALESCE(list_sum(list_transform("
           f"range(1, CAST(({df} - 1) // 2 AS BIGINT) + 1), lambda i: exp((i - 0.5) * ln({h}) - lgamma(i + 0.5)))), 0)")
    q = (f"(CASE WHEN {x} IS NULL OR {df} IS NULL THEN NULL WHEN isinf({x}) THEN 0.0 WHEN {x} <= 0 THEN 1.0 "
         f"WHEN {df} % 2 = 0 THEN {even} ELSE {odd} END)")
    return f"LEAST(GREATEST({q}, 0.0), 1.0)"


def drift_ctes(ref: str, cur: str, numeric, categorical, group: str | None = None) -> dict[str, str]:
    """CTEs ending in `dt`: the per-(g, column) drift table."""
    listed = ", ".join([f"('{c}', 'num')" for c in numeric] + [f"('{c}', 'cat')" for c in categorical])
    every = f"SELECT DISTINCT CAST({group} AS VARCHAR) AS g FROM {cur} WHERE {group} IS NOT NULL" if group else "SELECT '' AS g"
    return {
        "expected": f"SELECT g, column_name, kind FROM ({every}), (VALUES {listed}) AS listed(column_name, kind)",
        "ref_long": _long(ref, numeric, categorical, None),
        "cur_long": _long(cur, numeric, categorical, group),
        "ref_counts": "SELECT column_name, kind, vnum, vtxt, count(*) AS n_r FROM ref_long GROUP BY ALL",
        "cur_counts": "SELECT g, column_name, kind, vnum, vtxt, count(*) AS n_c FROM cur_long GROUP BY ALL",
        "grid": """SELECT g, column_name, kind, vnum, vtxt, sum(n_r) AS n_r, sum(n_c) AS n_c FROM (
            SELECT gr.g, r.column_name, r.kind, r.vnum, r.vtxt, r.n_r, 0 AS n_c
            FROM ref_counts r JOIN expected gr ON r.column_name = gr.column_name
            UNION ALL SELECT g, column_name, kind, vnum, vtxt, 0, n_c FROM cur_counts) GROUP BY ALL""",
        "totals": """SELECT e.g, e.column_name, e.kind, CAST(COALESCE(sum(n_r), 0) AS BIGINT) AS n_ref,
            CAST(COALESCE(sum(n_c), 0) AS BIGINT) AS n_cur, count(v.g) AS n_values
            FROM expected e LEFT JOIN grid v ON v.g = e.g AND v.column_name = e.column_name GROUP BY ALL""",
        "std": "SELECT column_name, stddev_pop(vnum) AS std_ref FROM ref_long WHERE kind = 'num' GROUP BY ALL",
        "scan": """SELECT g, column_name, vnum, sum(n_r) OVER w AS cr, sum(n_c) OVER w AS cc,
            lead(vnum) OVER (PARTITION BY g, column_name ORDER BY vnum) AS nv
            FROM grid WHERE kind = 'num'
            WINDOW w AS (PARTITION BY g, column_name ORDER BY vnum ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        "num": f"""SELECT s.g, s.column_name, max(abs(cr / nullif(t.n_ref, 0) - cc / nullif(t.n_cur, 0))) AS ks_d,
            sum(abs(cr / nullif(t.n_ref, 0) - cc / nullif(t.n_cur, 0)) * COALESCE(nv - vnum, 0)) / GREATEST(max(st.std_ref), {D.STD_FLOOR})
              AS w1_norm
            FROM scan s JOIN totals t ON s.g = t.g AND s.column_name = t.column_name
            LEFT JOIN std st ON s.column_name = st.column_name GROUP BY s.g, s.column_name""",
        "cat": """SELECT g, column_name,
            sqrt(GREATEST(sum(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END
                              + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END) / 2.0, 0)) AS js,
            sum(CASE WHEN e > 0 THEN (n_c - e) * (n_c - e) / e ELSE 'inf'::DOUBLE END) AS chi2,
            count(*) - 1 AS chi2_df,
            CASE WHEN max(kind) = 'num' THEN arg_min(n_r, vnum) ELSE arg_min(n_r, vtxt) END AS kr,
            CASE WHEN max(kind) = 'num' THEN arg_min(n_c, vnum) ELSE arg_min(n_c, vtxt) END AS kc,
            max(n_ref) AS nr, max(n_cur) AS nc,
            count(*) FILTER (WHERE n_r > 0) AS ur, count(*) FILTER (WHERE n_c > 0) AS uc, count(*) AS u
            FROM (SELECT gr.*, t.n_ref, t.n_cur, gr.n_r / nullif(t.n_ref, 0) AS p, gr.n_c / nullif(t.n_cur, 0) AS q,
                         (gr.n_r / nullif(t.n_ref, 0) + gr.n_c / nullif(t.n_cur, 0)) / 2.0 AS m, gr.n_r * (t.n_cur / nullif(t.n_ref, 0)) AS e
                  FROM grid gr JOIN totals t ON gr.g = t.g AND gr.column_name = t.column_name)
            GROUP BY g, column_name""",
        "catz": """SELECT *, CASE WHEN u = 1 AND ur = 1 AND uc = 1 THEN 0.0 ELSE
              (kr / nullif(nr, 0) - kc / nullif(nc, 0)) / nullif(sqrt(((kr + kc) / (nr + nc)) * (1 - (kr + kc) / (nr + nc)) * (1.0 / nullif(nr, 0) + 1.0 / nullif(nc, 0))), 0)
              END AS z, (u = 1 AND ur = 1 AND uc = 1) AS same FROM cat""",
        "sel": f"""SELECT t.*, c.js, c.chi2, c.chi2_df, c.z, c.same, n.ks_d, n.w1_norm,
            CASE WHEN t.n_ref <= {D.SMALL_REFERENCE_ROWS} THEN
                   CASE WHEN t.kind = 'num' AND t.n_values > {D.FEW_VALUES} THEN 'ks'
                        WHEN t.n_values > {D.BINARY_VALUES} THEN 'chisquare' ELSE 'z' END
                 ELSE CASE WHEN t.kind = 'num' AND t.n_values > {D.FEW_VALUES} THEN 'wasserstein'
                           ELSE 'jensenshannon' END END AS test
            FROM totals t LEFT JOIN catz c ON t.g = c.g AND t.column_name = c.column_name
            LEFT JOIN num n ON t.g = n.g AND t.column_name = n.column_name""",
        "ps": f"""SELECT *,
            CASE WHEN kind = 'num' AND ks_d IS NOT NULL THEN {ks_p_sql('ks_d', 'n_ref', 'n_cur')} END AS ks_p,
            CASE WHEN kind = 'cat' OR n_values <= {D.FEW_VALUES} THEN {chi2_p_sql('chi2', 'chi2_df')} END AS chi2_p,
            CASE WHEN n_values <= {D.BINARY_VALUES} THEN
              (CASE WHEN same THEN 1.0 ELSE {erfc_sql(f'abs(z) / {math.sqrt(2.0)}')} END) END AS z_p FROM sel""",
        "pv": """SELECT *,
            CASE test WHEN 'ks' THEN ks_d WHEN 'chisquare' THEN chi2 WHEN 'z' THEN z
                      WHEN 'wasserstein' THEN w1_norm ELSE js END AS statistic,
            CASE test WHEN 'ks' THEN ks_p WHEN 'chisquare' THEN chi2_p WHEN 'z' THEN z_p END AS p_value FROM ps""",
        "dt": f"""SELECT *, COALESCE(p_value, statistic) AS score,
            (n_ref > 0 AND n_cur = 0) OR COALESCE(CASE WHEN test IN ('ks', 'chisquare', 'z') THEN p_value < {D.P_VALUE_THRESHOLD}
                          ELSE statistic >= {D.DISTANCE_THRESHOLD} END, false) AS drifted FROM pv""",
    }


def verdict_sql(table: str = "dt") -> str:
    return f"""SELECT g, count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
        count(*) FILTER (WHERE drifted) * 1.0 / count(*) AS drift_share,
        count(*) FILTER (WHERE drifted) * 1.0 / count(*) >= {D.DATASET_DRIFT_SHARE} AS dataset_drift,
        COALESCE(string_agg(CASE WHEN drifted THEN column_name END, ', ' ORDER BY column_name), '') AS drifted_columns
        FROM {table} GROUP BY g"""
