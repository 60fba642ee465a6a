"""SQL expressions of the twins that engines lack: tails of distributions, adjusted p-values."""

from __future__ import annotations


def normal_two_sided(z: str) -> str:
    """P(|Z| >= |z|) by the series of the error function, all of whose terms are positive."""
    t = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    series = f"list_sum(list_transform(range(0, 100), lambda i_: exp(-{t} * {t} + (2 * i_ + 1) * ln({t}) - lgamma(i_ + 1.5))))"
    return f"(CASE WHEN {z} IS NULL THEN NULL WHEN {t} = 0 THEN 1.0 WHEN {t} > 5.8 THEN 0.0 ELSE greatest(0, 1 - {series}) END)"


def student_two_sided(t: str, df: str, steps: int = 400) -> str:
    """P(|T| >= |t|) by Simpson's rule over the angle whose tangent is t / sqrt(df)."""
    top = f"atan(abs({t}) / sqrt({df}))"
    weight = f"CASE WHEN i_ = 0 OR i_ = {steps} THEN 1 WHEN i_ % 2 = 1 THEN 4 ELSE 2 END"
    area = f"{top} / {3 * steps} * list_sum(list_transform(range(0, {steps + 1}), lambda i_: ({weight}) * pow(cos({top} * i_ / {steps}.0), {df} - 1)))"
    scale = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi())"
    return f"(CASE WHEN {t} IS NULL OR {df} IS NULL OR {df} <= 0 THEN NULL ELSE greatest(0, 1 - 2 * {scale} * {area}) END)"


def hypergeometric_upper(k: str, u: str, m: str, n: str) -> str:
    """P(X >= k) for n draws of m among u, added up term by term."""
    log = f"lgamma({m} + 1) - lgamma(i_ + 1) - lgamma({m} - i_ + 1) + lgamma({u} - {m} + 1) - lgamma({n} - i_ + 1) - lgamma({u} - {m} - {n} + i_ + 1) - lgamma({u} + 1) + lgamma({n} + 1) + lgamma({u} - {n} + 1)"
    return f"least(1, coalesce(list_sum(list_transform(range(greatest({k}, {n} + {m} - {u}), least({n}, {m}) + 1), lambda i_: exp({log}))), 0))"


def adjusted(table: str, groups: str, p: str) -> str:
    """``table`` with ``q``: step-up adjusted ``p`` within ``groups``; a null p stays null."""
    return (
        f"(SELECT *, CASE WHEN {p} IS NOT NULL THEN least(1, min({p} * m_ / k_) OVER (PARTITION BY {groups} ORDER BY {p} DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS q FROM"
        f" (SELECT *, count({p}) OVER (PARTITION BY {groups}) AS m_, count({p}) OVER (PARTITION BY {groups} ORDER BY {p} NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k_ FROM {table}))"
    )


def differential_expression(values: str, cells: str, control: str, method: str = "wilcoxon") -> str:
    """CTEs ending in ``de`` (perturbation, gene, score, logfoldchange, pval, pct_nz_group,
    pct_nz_reference, pval_adj as q, rank) from ``values`` (cell_barcode, gene, value) and
    ``cells`` (cell_barcode, perturbation)."""
    step = "round(v.value * 1073741824) / 1073741824"
    score, p = ("z", normal_two_sided("z")) if method == "wilcoxon" else ("t", student_two_sided("t", "df"))
    return f"""size AS (SELECT perturbation, count(*)::DOUBLE AS n1 FROM {cells} GROUP BY 1), size0 AS (SELECT n1 AS n0 FROM size WHERE perturbation = '{control}'),
obs AS (SELECT gene, perturbation, CASE WHEN {step} > 0 THEN {step} ELSE v.value END AS value FROM {values} v JOIN {cells} USING (cell_barcode) WHERE v.value > 0),
hist AS (SELECT gene, perturbation, value, count(*)::DOUBLE AS n, (count(*) FILTER (perturbation = '{control}'))::DOUBLE AS c FROM obs GROUP BY ALL),
ranked AS (SELECT *, sum(c) OVER (PARTITION BY gene, value) AS ceq, sum(c) OVER (PARTITION BY gene ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM hist),
per AS (SELECT gene, perturbation, sum(n) AS nz, sum(n * (upto - ceq + ceq / 2)) AS wins, sum(n * value) AS s, sum(n * value * value) AS ss FROM ranked GROUP BY ALL),
whole AS (SELECT g.gene, size.perturbation, n1, n0, coalesce(a.nz, 0) AS nz, coalesce(a.wins, 0) AS wins, coalesce(a.s, 0) AS s, coalesce(a.ss, 0) AS ss, coalesce(b.nz, 0) AS nz0, coalesce(b.s, 0) AS s0, coalesce(b.ss, 0) AS ss0
  FROM (SELECT DISTINCT gene FROM per) g CROSS JOIN size CROSS JOIN size0 LEFT JOIN per a ON a.gene = g.gene AND a.perturbation = size.perturbation LEFT JOIN per b ON b.gene = g.gene AND b.perturbation = '{control}' WHERE size.perturbation <> '{control}'),
stat AS (SELECT *, wins + nz * (n0 - nz0) + (n1 - nz) * (n0 - nz0) / 2 AS u, greatest((ss - s * s / n1) / nullif(n1 - 1, 0), 0) / n1 AS e1, greatest((ss0 - s0 * s0 / n0) / nullif(n0 - 1, 0), 0) / n0 AS e0 FROM whole),
test AS (SELECT *, (u - n1 * n0 / 2) / sqrt(n1 * n0 * (n1 + n0 + 1) / 12) AS z, (s / n1 - s0 / n0) / nullif(sqrt(e1 + e0), 0) AS t, (e1 + e0) * (e1 + e0) / nullif(e1 * e1 / (n1 - 1) + e0 * e0 / (n0 - 1), 0) AS df,
  log2((exp(s / n1) - 1 + 1e-9) / (exp(s0 / n0) - 1 + 1e-9)) AS logfoldchange FROM stat),
tail AS (SELECT perturbation, gene, {score} AS score, logfoldchange, {p} AS pval, nz / n1 AS pct_nz_group, nz0 / n0 AS pct_nz_reference FROM test),
de AS (SELECT *, row_number() OVER (PARTITION BY perturbation ORDER BY score DESC NULLS LAST, gene)::INTEGER AS rank FROM {adjusted("tail", "perturbation", "pval")})"""


def global_de(control: str, top: int, method: str = "wilcoxon", min_cells: int = 30, target: float = 10_000) -> str:
    """CTEs from ``cells`` and ``counts`` up to ``de`` as ``global_de`` computes it."""
    return f"""kept AS (SELECT cell_barcode, perturbation FROM cells WHERE cell_barcode IS NOT NULL AND (perturbation = '{control}' OR perturbation IN (SELECT perturbation FROM cells GROUP BY 1 HAVING count(*) >= {min_cells}))),
vals AS (SELECT cell_barcode, gene, ln(1 + value * {target:.1f} / sum(value) OVER (PARTITION BY cell_barcode)) AS value FROM counts WHERE cell_barcode IN (SELECT cell_barcode FROM kept)),
{differential_expression("vals", "kept", control, method)}"""
