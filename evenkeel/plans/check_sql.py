"""SQL that computes the registered queries in another engine, from the tables.

Each statement is written from the definition of its query, by plain and often
slower means: windows over whole features, enumerated threshold pairs, a log-gamma
series for tail probabilities.
"""

from __future__ import annotations

from collections.abc import Sequence

FAIR = ("demographic_parity", "equal_opportunity", "equal_odds")
AS_OF = "2022-12-17"

_PAY = "CASE o_orderstatus WHEN 'F' THEN -1 WHEN 'P' THEN 0 ELSE CAST(1 + o_orderkey % 9 AS INTEGER) END"
_PAID = "CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'P' THEN o_totalprice / 2 ELSE 0.0::DOUBLE END"


def _months(prefix: str, expression: str) -> str:
    return ",\n    ".join(
        f"max(CASE WHEN k = {i} THEN {expression} END) AS {prefix}{i}" for i in range(1, 7)
    )


_AMOUNTS = ", ".join(
    [f"BILL_AMT{i}" for i in range(1, 7)] + [f"PAY_AMT{i}" for i in range(1, 7)]
)
_UNMET = " + ".join(f"CASE WHEN PAY_{i} > 0 THEN 1 ELSE 0 END" for i in range(1, 7))
_MET = " + ".join(f"CASE WHEN PAY_{i} <= 0 THEN 1 ELSE 0 END" for i in range(1, 7))

CREDIT = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k
  FROM orders
),
history AS (
  SELECT o_custkey,
    {_months("PAY_", _PAY)},
    {_months("BILL_AMT", "o_totalprice")},
    {_months("PAY_AMT", _PAID)}
  FROM ranked WHERE k <= 6 GROUP BY o_custkey
),
counted AS (
  SELECT *, {_UNMET} AS unmet, {_MET} AS met
  FROM customer LEFT JOIN history ON c_custkey = o_custkey
),
raw AS (
  SELECT c_custkey AS USER_ID, c_acctbal AS LIMIT_BAL,
    CAST(1 + c_custkey % 2 AS INTEGER) AS SEX,
    CAST(1 + c_custkey % 6 AS INTEGER) AS EDUCATION,
    CAST(c_nationkey % 4 AS INTEGER) AS MARRIAGE,
    CAST(21 + c_custkey % 50 AS INTEGER) AS AGE,
    PAY_1, PAY_2, PAY_3, PAY_4, PAY_5, PAY_6, {_AMOUNTS}, unmet, met,
    CASE WHEN (unmet >= 3 AND c_custkey % 10 < 8) OR c_custkey % 10 = 9 THEN 1 ELSE 0 END AS "default",
    CAST(least(100, 15 * unmet + c_custkey % 7) AS INTEGER) AS score,
    CASE WHEN least(100, 15 * unmet + c_custkey % 7) >= 40 THEN 1 ELSE 0 END AS prediction,
    DATE '2022-01-01' + CAST(c_custkey % 365 AS INTEGER) AS monitoring_date,
    c_mktsegment AS segment
  FROM counted
),
credit AS (
  SELECT * REPLACE (CASE WHEN MARRIAGE IN (0, 3) THEN 1 ELSE MARRIAGE END AS MARRIAGE) FROM raw
)"""

_REF = "monitoring_date > DATE '2022-01-01' AND monitoring_date < DATE '2022-06-30'"
_PROD = "monitoring_date > DATE '2022-07-01' AND monitoring_date < DATE '2022-12-31'"
_SIGNED = (
    f"DATE '{AS_OF}' AS \"date\", 'fairness' AS project_name, 'credit_scoring' AS model_name"
)


def _credit(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([CREDIT, *more]) + "\n" + body


# --- fairness ----------------------------------------------------------------

_ROWS = """
sided AS (
  SELECT segment, 'SEX' AS protected_var, SEX = 1 AS is_privileged, "default" = 1 AS y,
    prediction = 1 AS yhat FROM credit
  UNION ALL
  SELECT segment, 'MARRIAGE', MARRIAGE = 1, "default" = 1, prediction = 1 FROM credit
)"""
_LANG_ROWS = """
sided AS (
  SELECT 'x' AS segment, 'lang' AS protected_var, lang = 'en' AS is_privileged, quality = 1 AS y,
    n_chars >= 500 AS yhat FROM labels JOIN documents USING (doc_id)
)"""


def _confusion(by: str = "") -> str:
    keys = f"{by} AS model_run_id, " if by else ""
    group = f"{by}, " if by else ""
    return f"""
confusion AS (
  SELECT {keys}protected_var, is_privileged,
    count(*) FILTER (y AND yhat) AS tp, count(*) FILTER (NOT y AND yhat) AS fp,
    count(*) FILTER (NOT y AND NOT yhat) AS tn, count(*) FILTER (y AND NOT yhat) AS fn
  FROM sided GROUP BY {group}protected_var, is_privileged
)"""


_GAPS = """
rates AS (
  SELECT model_run_id, protected_var, is_privileged,
    (tp + fp) / nullif(tp + fp + tn + fn, 0)::DOUBLE AS sel,
    tp / nullif(tp + fn, 0)::DOUBLE AS tpr, fp / nullif(fp + tn, 0)::DOUBLE AS fpr
  FROM confusion
),
gaps AS (
  SELECT p.model_run_id, p.protected_var, p.sel - u.sel AS demographic_parity,
    p.tpr - u.tpr AS equal_opportunity, ((p.tpr - u.tpr) + (p.fpr - u.fpr)) / 2 AS equal_odds
  FROM rates p JOIN rates u ON p.model_run_id = u.model_run_id AND p.protected_var = u.protected_var
  WHERE p.is_privileged AND NOT u.is_privileged
),
fairness AS (
  SELECT model_run_id, protected_var, metric, parity FROM (
    SELECT model_run_id, protected_var, 'demographic_parity' AS metric, demographic_parity AS parity FROM gaps
    UNION ALL SELECT model_run_id, protected_var, 'equal_opportunity', equal_opportunity FROM gaps
    UNION ALL SELECT model_run_id, protected_var, 'equal_odds', equal_odds FROM gaps)
)"""
_LONG = "SELECT model_run_id, protected_var, metric, round(parity, 6) AS parity FROM fairness"


def _fairness(body: str, by: str = "'run_1'", rows: str = _ROWS, *more: str) -> str:
    return _credit(body, rows, _confusion(by), _GAPS, *more)


def _gate(check: str) -> str:
    return _fairness(
        f"""SELECT model_run_id, protected_var, {check} AS parity_check,
          count(*) AS n_metrics, count(*) FILTER (parity IS NULL) AS n_undefined
        FROM fairness GROUP BY model_run_id, protected_var""",
        "segment",
    )


_ANY = "CASE WHEN coalesce(bool_or(parity <= 0.1), false) THEN 1 ELSE 0 END"
_ALL = "CASE WHEN bool_and(coalesce(abs(parity) <= 0.1, false)) THEN 1 ELSE 0 END"

_PERF = {
    "accuracy": "(tp + tn) / nullif(tp + fp + tn + fn, 0)::DOUBLE",
    "balanced_accuracy": "(tp / nullif(tp + fn, 0)::DOUBLE + tn / nullif(tn + fp, 0)::DOUBLE) / 2",
    "precision": "tp / nullif(tp + fp, 0)::DOUBLE",
    "recall": "tp / nullif(tp + fn, 0)::DOUBLE",
    "f1": "2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE",
    "selection_rate": "(tp + fp) / nullif(tp + fp + tn + fn, 0)::DOUBLE",
}


def _unpivoted(columns: dict[str, str], source: str, keep: str = "") -> str:
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {keep}'{name}' AS metric, {text} AS \"value\" FROM {source}"
        for name, text in columns.items()
    )


_TOTAL = """
total AS (
  SELECT count(*) FILTER (y AND yhat) AS tp, count(*) FILTER (NOT y AND yhat) AS fp,
    count(*) FILTER (NOT y AND NOT yhat) AS tn, count(*) FILTER (y AND NOT yhat) AS fn
  FROM (SELECT "default" = 1 AS y, prediction = 1 AS yhat FROM credit)
)"""

# Poisson draws per confusion cell from md5-based uniforms, in 200 replicates.
_DRAWS = """
cells AS (
  SELECT SEX = 1 AS SEX, MARRIAGE = 1 AS MARRIAGE, "default" = 1 AS y, prediction = 1 AS yhat,
    count(*)::DOUBLE AS rate
  FROM credit GROUP BY ALL
),
modes AS (SELECT *, floor(rate) AS mode, exp(floor(rate) * ln(rate) - rate - lgamma(floor(rate) + 1)) AS peak FROM cells),
tries AS (
  SELECT *, md5(concat_ws('|', '0', r, SEX, MARRIAGE, y, yhat, k)) AS h
  FROM modes, (SELECT unnest(range(1, 201)) AS r), (SELECT unnest(range(1, 301)) AS k)
),
uniforms AS (
  SELECT * EXCLUDE h, CASE WHEN substr(h, 32, 1) < '8' THEN 1 ELSE -1 END AS side,
    (('0x' || substr(h, 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS a,
    (('0x' || substr(h, 9, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS b,
    (('0x' || substr(h, 21, 11))::BIGINT + 0.5::DOUBLE) / 17592186044416.0::DOUBLE AS c
  FROM tries
),
hats AS (
  SELECT *, (CASE WHEN a * (4 + peak) <= 2 + peak THEN b * (1 + peak / 2) ELSE 1 + peak / 2 - ln(b) END) / peak AS far
  FROM uniforms
),
offers AS (SELECT *, mode + side * floor(far + 0.5) AS n FROM hats),
drawn AS (
  SELECT r, SEX, MARRIAGE, y, yhat, arg_min(n, k)::BIGINT AS n FROM offers
  WHERE n >= 0 AND c * least(1, exp(1 + peak / 2 - peak * far))
    <= exp((n - mode) * ln(rate) - lgamma(greatest(n, 0) + 1) + lgamma(mode + 1))
  GROUP BY r, SEX, MARRIAGE, y, yhat
)"""


def _summed(by: str) -> str:
    return f"""{by},
    sum(CASE WHEN y AND yhat THEN n ELSE 0 END)::BIGINT AS tp,
    sum(CASE WHEN NOT y AND yhat THEN n ELSE 0 END)::BIGINT AS fp,
    sum(CASE WHEN NOT y AND NOT yhat THEN n ELSE 0 END)::BIGINT AS tn,
    sum(CASE WHEN y AND NOT yhat THEN n ELSE 0 END)::BIGINT AS fn"""


_BOOT = _credit(
    f"""SELECT metric, round(p."value", 6) AS "value",
      round(quantile_cont(d."value", 0.025), 6) AS ci_low,
      round(quantile_cont(d."value", 0.975), 6) AS ci_high
    FROM ({_unpivoted(_PERF, "total")}) p JOIN ({_unpivoted(_PERF, "resampled", "r")}) d USING (metric)
    GROUP BY metric, p."value\"""",
    _TOTAL,
    _DRAWS,
    f"resampled AS (SELECT {_summed('r')} FROM drawn GROUP BY r)",
)

_FAIR_BOOT = _fairness(
    """SELECT protected_var, metric, round(f.parity, 6) AS "value",
      round(quantile_cont(d.parity, 0.025), 6) AS ci_low,
      round(quantile_cont(d.parity, 0.975), 6) AS ci_high
    FROM fairness f JOIN boot_long d USING (protected_var, metric)
    GROUP BY protected_var, metric, f.parity""",
    "'run_1'",
    _ROWS,
    _DRAWS,
    f"""boot_groups AS (
      SELECT {_summed("r, 'SEX' AS protected_var, SEX AS is_privileged")} FROM drawn GROUP BY r, SEX
      UNION ALL
      SELECT {_summed("r, 'MARRIAGE', MARRIAGE")} FROM drawn GROUP BY r, MARRIAGE)""",
    """boot_rates AS (
      SELECT r, protected_var, is_privileged, (tp + fp) / nullif(tp + fp + tn + fn, 0)::DOUBLE AS sel,
        tp / nullif(tp + fn, 0)::DOUBLE AS tpr, fp / nullif(fp + tn, 0)::DOUBLE AS fpr FROM boot_groups)""",
    """boot_gaps AS (
      SELECT p.r, p.protected_var, p.sel - u.sel AS demographic_parity, p.tpr - u.tpr AS equal_opportunity,
        ((p.tpr - u.tpr) + (p.fpr - u.fpr)) / 2 AS equal_odds
      FROM boot_rates p JOIN boot_rates u ON p.r = u.r AND p.protected_var = u.protected_var
      WHERE p.is_privileged AND NOT u.is_privileged)""",
    """boot_long AS (
      SELECT protected_var, 'demographic_parity' AS metric, demographic_parity AS parity FROM boot_gaps
      UNION ALL SELECT protected_var, 'equal_opportunity', equal_opportunity FROM boot_gaps
      UNION ALL SELECT protected_var, 'equal_odds', equal_odds FROM boot_gaps)""",
)


def _tradeoff(level: str) -> str:
    """All pairs of thresholds, ranked three ways."""
    return _credit(
        """SELECT protected_var, metrics, thresh_1, thresh_2,
          round(((tp1 + tp2) / all_p::DOUBLE + (tn1 + tn2) / all_n::DOUBLE) / 2, 6) AS balanced_accuracy
        FROM best""",
        """scored AS (
          SELECT 'SEX' AS protected_var, SEX = 1 AS side, score, "default" AS y FROM credit
          UNION ALL SELECT 'MARRIAGE', MARRIAGE = 1, score, "default" FROM credit)""",
        """grid AS (SELECT CAST(unnest(range(0, 101)) AS INTEGER) AS th)""",
        """curves AS (
          SELECT protected_var, side, th, count(*) FILTER (y = 1 AND score >= th) AS tp,
            count(*) FILTER (y = 0 AND score >= th) AS fp, count(*) FILTER (y = 0 AND score < th) AS tn,
            count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n
          FROM scored CROSS JOIN grid GROUP BY protected_var, side, th)""",
        f"""levels AS (SELECT *, floor({level} * 1e12 + 0.5)::BIGINT AS level FROM curves)""",
        """pairs AS (
          SELECT a.protected_var, a.th AS thresh_1, b.th AS thresh_2, a.tp AS tp1, b.tp AS tp2,
            a.tn AS tn1, b.tn AS tn2, a.p + b.p AS all_p, a.n + b.n AS all_n,
            (a.tp + b.tp)::HUGEINT * (a.n + b.n) + (a.tn + b.tn)::HUGEINT * (a.p + b.p) AS gain,
            abs(a.level - b.level) AS gap
          FROM levels a JOIN levels b ON a.protected_var = b.protected_var
          WHERE a.side AND NOT b.side)""",
        """best AS (
          SELECT *, 'max_perf_point' AS metrics FROM pairs
          QUALIFY row_number() OVER (PARTITION BY protected_var ORDER BY gain DESC, thresh_1, thresh_2) = 1
          UNION ALL
          SELECT *, 'max_perf_single_th' FROM pairs WHERE thresh_1 = thresh_2
          QUALIFY row_number() OVER (PARTITION BY protected_var ORDER BY gain DESC, thresh_1) = 1
          UNION ALL
          SELECT *, 'max_perf_neutral_fair' FROM pairs
          QUALIFY row_number() OVER (PARTITION BY protected_var ORDER BY gap, gain DESC, thresh_1, thresh_2) = 1)""",
    )


# --- drift -------------------------------------------------------------------


class _Slices:
    """A table with its two windows, as SQL."""

    def __init__(self, source: str, ref: str, prod: str, with_credit: bool = False):
        self.source, self.ref, self.prod, self.with_credit = source, ref, prod, with_credit

    def long(self, features: Sequence[str], kind: str, name: str) -> str:
        parts = " UNION ALL ".join(
            f"SELECT '{f}' AS feature, CAST(\"{f}\" AS {kind}) AS v, {self.ref} AS in_ref, "
            f"{self.prod} AS in_prod FROM {self.source} WHERE ({self.ref}) OR ({self.prod})"
            for f in features
        )
        return f"{name} AS ({parts})"

    def sql(self, body: str, *parts: str) -> str:
        head = [CREDIT] if self.with_credit else []
        return "WITH " + ",\n".join([*head, *parts]) + "\n" + body


def _between(column: str, start: str, end: str) -> str:
    return f"({column} > TIMESTAMP '{start}' AND {column} < TIMESTAMP '{end}')"


_LINEITEM = _Slices(
    "lineitem",
    _between("l_shipdate", "1995-01-01", "1998-06-01"),
    _between("l_shipdate", "1998-06-01", "2001-12-31"),
)
_ORDERS = _Slices(
    "orders",
    _between("o_orderdate", "1994-12-31", "1999-01-01"),
    _between("o_orderdate", "1998-12-31", "2001-12-31"),
)
_EVENTS = _Slices(
    "events", _between("ts", "2023-12-31", "2024-01-16"), _between("ts", "2024-01-16", "2024-02-01")
)
_CREDIT_SLICES = _Slices("credit", f"({_REF})", f"({_PROD})", True)
_L_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_L_CAT = ("l_returnflag", "l_linestatus")

_NUM = """
num_counts AS (
  SELECT feature, v, count(*) FILTER (in_ref) AS a, count(*) FILTER (in_prod) AS b
  FROM num_long WHERE v IS NOT NULL GROUP BY feature, v
),
num_cum AS (
  SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb, lead(v) OVER w AS nv,
    sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb
  FROM num_counts WINDOW w AS (PARTITION BY feature ORDER BY v)
),
num_spread AS (
  SELECT feature, greatest(stddev_pop(v), 0.001) AS sd FROM num_long WHERE in_ref GROUP BY feature
),
num_stats AS (
  SELECT feature, any_value(na)::BIGINT AS n_ref, any_value(nb)::BIGINT AS n_prod,
    max(abs(ca / na::DOUBLE - cb / nb::DOUBLE)) AS ks,
    sum(abs(ca / na::DOUBLE - cb / nb::DOUBLE) * (nv - v)) / any_value(sd) AS w1
  FROM num_cum JOIN num_spread USING (feature) GROUP BY feature
),
num_scaled AS (
  SELECT *, ks * sqrt(n_ref::DOUBLE * n_prod / (n_ref + n_prod)) AS scaled FROM num_stats
),
num_tests AS (
  SELECT *, CASE WHEN scaled < 0.2 THEN 1.0::DOUBLE ELSE greatest(0, least(1, 2 * list_sum(list_transform(range(1, 101),
    lambda k: (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * k * k * scaled * scaled))))) END AS ks_p
  FROM num_scaled
)"""


def _tail(a: str, x: str) -> str:
    """Upper tail of the gamma distribution, one minus its power series."""
    return (
        f"CASE WHEN {x} <= 0 THEN 1.0::DOUBLE ELSE greatest(0, 1 - list_sum(list_transform(range(0, 1500), "
        f"lambda n: exp(({a} + n) * ln({x}) - {x} - lgamma({a} + n + 1))))) END"
    )


_CAT = f"""
cat_counts AS (
  SELECT feature, v, count(*) FILTER (in_ref) AS a, count(*) FILTER (in_prod) AS b
  FROM cat_long WHERE v IS NOT NULL GROUP BY feature, v
),
cat_margins AS (
  SELECT *, sum(a) OVER w AS na, sum(b) OVER w AS nb, count(*) OVER w AS k
  FROM cat_counts WINDOW w AS (PARTITION BY feature)
),
cat_stats AS (
  SELECT feature, any_value(na)::BIGINT AS n_ref, any_value(nb)::BIGINT AS n_prod, any_value(k) AS k,
    sum(pow(a - (a + b) * na / (na + nb)::DOUBLE, 2) / ((a + b) * na / (na + nb)::DOUBLE)
      + pow(b - (a + b) * nb / (na + nb)::DOUBLE, 2) / ((a + b) * nb / (na + nb)::DOUBLE)) AS chi2,
    sqrt(greatest(0, sum(
      CASE WHEN a > 0 THEN a / na::DOUBLE * ln((a / na::DOUBLE) / ((a / na::DOUBLE + b / nb::DOUBLE) / 2)) ELSE 0 END
      + CASE WHEN b > 0 THEN b / nb::DOUBLE * ln((b / nb::DOUBLE) / ((a / na::DOUBLE + b / nb::DOUBLE) / 2)) ELSE 0 END) / 2)) AS js,
    arg_min(abs(a / na::DOUBLE - b / nb::DOUBLE), v) AS gap,
    arg_min((a + b) / (na + nb)::DOUBLE, v) AS pooled
  FROM cat_margins GROUP BY feature
),
cat_z AS (
  SELECT *, CASE WHEN k = 2 THEN gap / sqrt(pooled * (1 - pooled) * (1.0::DOUBLE / n_ref + 1.0::DOUBLE / n_prod)) END AS z
  FROM cat_stats
),
cat_tests AS (
  SELECT *, CASE WHEN k > 1 THEN {_tail("(k - 1) / 2.0::DOUBLE", "(chi2 / 2)")} END AS chi2_p,
    CASE WHEN k = 2 THEN {_tail("0.5::DOUBLE", "(z * z / 2)")} END AS z_p
  FROM cat_z
)"""
_SCORES = """
scores AS (
  SELECT feature, 'num' AS feature_type, 'ks' AS stattest_name, ks_p AS s FROM num_tests
  UNION ALL
  SELECT feature, 'cat', CASE WHEN k = 2 THEN 'z' ELSE 'chi2_homogeneity' END,
    CASE WHEN k = 2 THEN z_p ELSE chi2_p END FROM cat_tests
)"""
_DRIFT_COLUMNS = (
    "feature_type, stattest_name, round(s, 6) AS drift_score, coalesce(s < 0.05, false) AS drift_detected"
)


def _dataset_drift(slices: _Slices, num: Sequence[str], cat: Sequence[str], signed: str = _SIGNED) -> str:
    return slices.sql(
        f"SELECT feature, {_DRIFT_COLUMNS}, {signed} FROM scores",
        slices.long(num, "DOUBLE", "num_long"), _NUM,
        slices.long(cat, "VARCHAR", "cat_long"), _CAT, _SCORES,
    )


_LABEL_COLUMNS = (
    "feature AS target_name, {kind} AS target_type, {test} AS stattest_name, "
    "round({p}, 6) AS drift_score, coalesce({p} < 0.05, false) AS drift_detected"
)
_Z_OR_CHI = "CASE WHEN k = 2 THEN z_p ELSE chi2_p END"


def _edges(slices: _Slices, features: Sequence[str]) -> list[str]:
    return [
        slices.long(features, "DOUBLE", "num_long"),
        "edges AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM num_long GROUP BY feature)",
        """binned AS (
          SELECT feature, least(10, coalesce(CAST(floor((v - lo) / nullif(hi - lo, 0) * 10) AS INTEGER) + 1, 1)) AS bucket,
            lo, hi, in_ref, in_prod FROM num_long JOIN edges USING (feature) WHERE v IS NOT NULL)""",
        """bins AS (
          SELECT feature, bucket, lo + (bucket - 1) * (hi - lo) / 10 AS lower_edge,
            count(*) FILTER (in_ref) AS a, count(*) FILTER (in_prod) AS b
          FROM binned GROUP BY feature, bucket, lo, hi)""",
    ]


def _both(columns: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT feature, {columns}, '{side}' AS dataset, {n} AS n, "
        f"round({n} / nullif(sum({n}) OVER (PARTITION BY feature), 0)::DOUBLE, 6) AS share FROM {source}"
        for side, n in (("ref", "a"), ("prod", "b"))
    )


_CAT_COUNTS = """cat_counts AS (
  SELECT feature, v AS category, count(*) FILTER (in_ref) AS a, count(*) FILTER (in_prod) AS b
  FROM cat_long WHERE v IS NOT NULL GROUP BY feature, v)"""


def _quality(slices: _Slices, num: Sequence[str], cat: Sequence[str]) -> str:
    def side(name: str, flag: str) -> str:
        numbers = ", ".join(
            f"round({text}, 6) AS {column}"
            for column, text in (
                ("min_value", "min(v)"), ("max_value", "max(v)"), ("mean", "avg(v)"),
                ("stddev", "stddev_samp(v)"), ("q25", "quantile_cont(v, 0.25)"),
                ("q50", "quantile_cont(v, 0.5)"), ("q75", "quantile_cont(v, 0.75)"),
                ("top_number", "any_value(t.top)"),
            )
        )
        nulls = ", ".join(
            f"CAST(NULL AS DOUBLE) AS {c}"
            for c in ("min_value", "max_value", "mean", "stddev", "q25", "q50", "q75", "top_number")
        )
        head = (
            f"'{name}' AS dataset, count(*) AS n_rows, count(*) - count(v) AS n_missing, "
            "count(DISTINCT v) AS n_distinct"
        )
        share = "round(any_value(t.n) / count(v)::DOUBLE, 6) AS top_share"

        def top(source: str) -> str:
            return (
                f"(SELECT feature, v AS top, count(*) AS n FROM {source} WHERE {flag} AND v IS NOT NULL "
                "GROUP BY feature, v QUALIFY row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, v) = 1) t"
            )

        return f"""
        SELECT feature, 'num' AS feature_type, {head}, {numbers}, CAST(NULL AS VARCHAR) AS top_category, {share}
        FROM num_long LEFT JOIN {top("num_long")} USING (feature) WHERE {flag} GROUP BY feature
        UNION ALL
        SELECT feature, 'cat', {head}, {nulls}, any_value(t.top) AS top_category, {share}
        FROM cat_long LEFT JOIN {top("cat_long")} USING (feature) WHERE {flag} GROUP BY feature"""

    return slices.sql(
        side("ref", "in_ref") + " UNION ALL " + side("prod", "in_prod"),
        slices.long(num, "DOUBLE", "num_long"), slices.long(cat, "VARCHAR", "cat_long"),
    )


# --- stored tables -----------------------------------------------------------

_CSV_COLUMNS = (
    "USER_ID, LIMIT_BAL, SEX, EDUCATION, MARRIAGE, AGE, PAY_1, PAY_2, PAY_3, PAY_4, PAY_5, PAY_6, "
    f'{_AMOUNTS}, "default"'
)
_STAMPED = "'fairness' AS project_name, 'credit_scoring' AS model_name"


def _monitored(load: bool) -> str:
    def part(where: str, date: str, load_id: str) -> str:
        loaded = f", '{load_id}' AS load_id" if load else ""
        return (
            f"SELECT {_CSV_COLUMNS}, score, prediction, DATE '{date}' AS monitoring_date, "
            f"{_STAMPED}{loaded} FROM credit WHERE {where}"
        )

    return _credit(part(_REF, "2022-03-01", "baseline") + " UNION ALL " + part(_PROD, AS_OF, "second"))


_SPLIT = "CASE WHEN ('0x' || substr(md5(USER_ID::VARCHAR || ':123'), 1, 15))::BIGINT % 100 < 25 THEN 'test' ELSE 'train' END"
_WEIGHTS = {"unmet": 0.9, "met": -0.4, "LIMIT_BAL": -0.2, "AGE": 0.1, "SEX": 0.25}
_FEATURES = [*_AMOUNTS.split(", "), "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "unmet", "met"]
_FEATURE_NAMES = {"unmet": "NUM_PAYM_UNMET", "met": "NUM_PAYM_MET"}


def _registered() -> str:
    first = "monitoring_date <= DATE '2022-06-30'"
    moments = ", ".join(f"avg({c}) AS mean_{c}, stddev_samp({c}) AS scale_{c}" for c in _WEIGHTS)
    terms = " + ".join(f"{w}::DOUBLE * ({c} - mean_{c}) / scale_{c}" for c, w in _WEIGHTS.items())
    return _credit(
        f"""SELECT USER_ID, "default", CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction,
          round(p, 6) AS probability, round(greatest(p, 1 - p), 6) AS confidence,
          CASE WHEN {first} THEN DATE '2022-03-01' ELSE DATE '{AS_OF}' END AS monitoring_date, {_STAMPED},
          CASE WHEN {first} THEN 'baseline' ELSE 'second' END AS load_id FROM scored""",
        f"moments AS (SELECT {moments} FROM credit WHERE {first} AND {_SPLIT} = 'train')",
        f"scored AS (SELECT *, 1 / (1 + exp(-(-0.7::DOUBLE + {terms}))) AS p FROM credit, moments)",
    )


def _certified() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{_FEATURE_NAMES.get(c, c)}', {i}, count(*), round(avg(coalesce({c}, 0)), 6), "
        f"round(stddev_samp(coalesce({c}, 0)), 6), true FROM fitted"
        for i, c in enumerate(_FEATURES, 1)
    )
    return _credit(
        "SELECT '(intercept)' AS feature, 0 AS position, count(*) AS n_rows, CAST(NULL AS DOUBLE) AS mean, "
        f"CAST(NULL AS DOUBLE) AS scale, true AS optimal FROM fitted UNION ALL {rows}",
        f"fitted AS (SELECT * FROM credit WHERE {_SPLIT} = 'train')",
    )


_OUTCOMES = """
outcome_rows AS (
  SELECT USER_ID, 'SEX' AS protected_var, SEX AS g, 'default' AS outcome, "default" AS o FROM {source}
  UNION ALL SELECT USER_ID, 'SEX', SEX, 'prediction', prediction FROM {source}
  UNION ALL SELECT USER_ID, 'MARRIAGE', MARRIAGE, 'default', "default" FROM {source}
  UNION ALL SELECT USER_ID, 'MARRIAGE', MARRIAGE, 'prediction', prediction FROM {source}
),
outcome_counts AS (
  SELECT protected_var, g, outcome, o, count(DISTINCT USER_ID) AS n_users FROM outcome_rows
  WHERE g IS NOT NULL AND o IS NOT NULL GROUP BY ALL
)"""
_OUTCOME_RATES = """SELECT protected_var, CAST(g AS VARCHAR) AS group_value,
  CASE WHEN protected_var = 'SEX' THEN CASE WHEN g = 1 THEN 'MALE' ELSE 'FEMALE' END
    ELSE CASE WHEN g = 1 THEN 'MARRIED' ELSE 'SINGLE' END END AS group_name,
  outcome, o AS outcome_value, n_users,
  round(n_users * 100 / sum(n_users) OVER (PARTITION BY protected_var, g, outcome)::DOUBLE, 6) AS pct_total
FROM outcome_counts"""

_VERSIONS = """
versions AS (
  SELECT 'model_' || o_custkey AS model_name, o_orderkey AS version, o_orderstatus AS stage,
    'run_' || o_orderkey AS run_id, 'silver/' || o_orderpriority AS source_data,
    count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders
)"""
_STAGED = """
staged AS (
  SELECT model_name, version, run_id, stage, source_data FROM versions WHERE n = 1 OR stage = 'F'
  QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC, run_id DESC) = 1
)"""


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    out["recode_marriage"] = _credit(
        "SELECT USER_ID, raw.MARRIAGE AS marriage_raw, credit.MARRIAGE AS MARRIAGE "
        "FROM raw JOIN credit USING (USER_ID)"
    )
    out["payment_features"] = _credit(
        "SELECT USER_ID, unmet AS NUM_PAYM_UNMET, met AS NUM_PAYM_MET FROM credit"
    )
    out["labels_only"] = _credit('SELECT "default" AS label FROM credit')
    out["training_set"] = _credit(
        f"SELECT {_AMOUNTS}, LIMIT_BAL, SEX, EDUCATION, MARRIAGE, AGE, "
        'unmet AS NUM_PAYM_UNMET, met AS NUM_PAYM_MET, "default" FROM credit'
    )
    out["feature_orphans"] = _credit(f"SELECT USER_ID FROM credit WHERE NOT ({_REF})")
    out["lookup_with_gaps"] = _credit(
        f"SELECT USER_ID, LIMIT_BAL, CASE WHEN {_REF} THEN unmet END AS NUM_PAYM_UNMET FROM credit"
    )
    out["key_violations"] = (
        "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1 OR o_custkey IS NULL"
    )
    out["feature_table"] = _credit("SELECT USER_ID, unmet AS NUM_PAYM_UNMET FROM credit")
    out["score_label_join"] = _credit(
        "SELECT USER_ID, PAY_AMT1, PAY_AMT2, PAY_AMT3, PAY_AMT4, PAY_AMT5, PAY_AMT6, prediction, "
        f"\"default\", DATE '{AS_OF}' AS monitoring_date, {_STAMPED} FROM credit"
    )
    out["ref_prod_slice"] = _credit(
        f"SELECT USER_ID, monitoring_date, ({_REF}) AS in_ref, ({_PROD}) AS in_prod "
        f"FROM credit WHERE ({_REF}) OR ({_PROD})"
    )
    out["union_sources"] = (
        "SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key, "
        "c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL "
        "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"
    )
    out["outcome_rates"] = _credit(_OUTCOME_RATES, _OUTCOMES.format(source="credit"))
    out["outcome_rates_production"] = _credit(
        _OUTCOME_RATES,
        f"production AS (SELECT * FROM credit WHERE {_PROD})",
        _OUTCOMES.format(source="production"),
    )
    out["batch_row_count"] = _credit(f"SELECT count(*) AS n_rows FROM credit WHERE {_PROD}")
    out["confusion_by_group"] = _credit("SELECT * FROM confusion", _ROWS, _confusion())
    out["confusion_by_language"] = "WITH " + ",".join([_LANG_ROWS, _confusion()]) + " SELECT * FROM confusion"
    out["fairness_long"] = _fairness(_LONG)
    out["fairness_language"] = _fairness(_LONG, "'run_1'", _LANG_ROWS)
    out["fairness_by_run"] = _fairness(_LONG, "segment")
    out["fairness_benefit"] = _fairness(
        _LONG, "'run_1'",
        _ROWS.replace('"default" = 1', '"default" = 0').replace("prediction = 1", "prediction = 0"),
    )
    out["protected_variables"] = _fairness("SELECT DISTINCT protected_var FROM fairness")
    out["parity_gate_any"] = _gate(_ANY)
    out["parity_gate_all"] = _gate(_ALL)
    out["parity_gate_one_run"] = _fairness(
        f"SELECT model_run_id, protected_var, {_ANY} AS parity_check, count(*) AS n_metrics, "
        f"count(*) FILTER (parity IS NULL) AS n_undefined, {_ALL} AS strict_check "
        "FROM fairness GROUP BY model_run_id, protected_var"
    )
    out["fair_conclusion"] = _fairness(
        'SELECT model_run_id, protected_var, metric, round(parity, 6) AS "value", 0.43::DOUBLE AS threshold, '
        "CASE WHEN parity IS NULL THEN 'undefined' WHEN abs(parity) <= 0.43 THEN 'fair' ELSE 'unfair' END AS conclusion "
        "FROM fairness WHERE metric = 'equal_opportunity'",
        "segment",
    )
    out["perf_metrics"] = _credit(
        f'SELECT metric, round("value", 6) AS "value" FROM ({_unpivoted(_PERF, "total")})', _TOTAL
    )
    out["perf_values"] = _credit(
        f"SELECT 'run_1' AS run_id, metric, round(\"value\", 6) AS \"value\" FROM ({_unpivoted(_PERF, 'total')})",
        _TOTAL,
    )
    out["mean_accuracy"] = _credit(
        'SELECT round(avg(CASE WHEN "default" = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy FROM credit'
    )
    out["bootstrap_ci"] = _BOOT
    out["fairness_ci"] = _FAIR_BOOT
    out["tradeoff"] = _tradeoff("(tp / p::DOUBLE)")
    out["tradeoff_parity"] = _tradeoff("((tp + fp) / (p + n)::DOUBLE)")

    out["drift_ks"] = _LINEITEM.sql(
        "SELECT feature, n_ref, n_prod, round(ks, 6) AS ks_statistic, round(ks_p, 6) AS ks_p_value FROM num_tests",
        _LINEITEM.long(_L_NUM, "DOUBLE", "num_long"), _NUM,
    )
    out["drift_chi2"] = _ORDERS.sql(
        "SELECT feature, n_ref, n_prod, round(chi2, 6) AS chi2_statistic, k - 1 AS degrees, "
        "round(chi2_p, 6) AS chi2_p_value FROM cat_tests",
        _ORDERS.long(("o_orderpriority", "o_orderstatus"), "VARCHAR", "cat_long"), _CAT,
    )
    out["drift_z"] = _LINEITEM.sql(
        "SELECT feature, n_ref, n_prod, round(z, 6) AS z_statistic, round(z_p, 6) AS z_p_value FROM cat_tests",
        _LINEITEM.long(("l_linestatus",), "VARCHAR", "cat_long"), _CAT,
    )
    out["drift_distance"] = _LINEITEM.sql(
        "SELECT feature, 'num' AS feature_type, 'wasserstein_norm' AS stattest_name, "
        "round(w1, 6) AS drift_score, w1 >= 0.1 AS drift_detected FROM num_tests UNION ALL "
        "SELECT feature, 'cat', 'js', round(js, 6), js >= 0.1 FROM cat_tests",
        _LINEITEM.long(_L_NUM, "DOUBLE", "num_long"), _NUM,
        _LINEITEM.long(_L_CAT, "VARCHAR", "cat_long"), _CAT,
    )
    credit_cat = ("SEX", "EDUCATION", "MARRIAGE")
    out["dataset_drift"] = _dataset_drift(_CREDIT_SLICES, ("LIMIT_BAL", "AGE"), credit_cat)
    out["monitored_drift"] = out["dataset_drift"]
    out["dataset_drift_orders"] = _dataset_drift(
        _ORDERS, ("o_totalprice",), ("o_orderpriority", "o_orderstatus")
    )
    out["dataset_drift_events"] = _dataset_drift(_EVENTS, ("value",), ("event_type",))
    out["catalog_append"] = _EVENTS.sql(
        f"SELECT feature, {_DRIFT_COLUMNS}, d AS \"date\", {_STAMPED} FROM scores, "
        "(SELECT unnest([DATE '2022-12-17', DATE '2022-12-18']) AS d)",
        _EVENTS.long(("value",), "DOUBLE", "num_long"), _NUM,
        _EVENTS.long(("event_type",), "VARCHAR", "cat_long"), _CAT, _SCORES,
    )
    out["label_drift_cat"] = _CREDIT_SLICES.sql(
        "SELECT "
        + _LABEL_COLUMNS.format(
            kind="'cat'", test="CASE WHEN k = 2 THEN 'z' ELSE 'chi2_homogeneity' END", p=f"({_Z_OR_CHI})"
        )
        + f", {_SIGNED} FROM cat_tests",
        _CREDIT_SLICES.long(("default", "prediction"), "VARCHAR", "cat_long"), _CAT,
    )
    out["label_drift_num"] = _ORDERS.sql(
        "SELECT " + _LABEL_COLUMNS.format(kind="'num'", test="'ks'", p="ks_p") + f", {_SIGNED} FROM num_tests",
        _ORDERS.long(("o_totalprice",), "DOUBLE", "num_long"), _NUM,
    )
    out["drift_histogram"] = _LINEITEM.sql(
        f"SELECT * REPLACE (round(lower_edge, 6) AS lower_edge) FROM ({_both('bucket, lower_edge', 'bins')})",
        *_edges(_LINEITEM, _L_NUM),
    )
    out["category_shares"] = _LINEITEM.sql(
        _both("category", "cat_counts"), _LINEITEM.long(_L_CAT, "VARCHAR", "cat_long"), _CAT_COUNTS
    )
    out["drift_report"] = _CREDIT_SLICES.sql(
        f"SELECT feature, dataset, bucket, n, share FROM ({_both('CAST(bucket AS VARCHAR) AS bucket', 'bins')}) "
        f"UNION ALL SELECT feature, dataset, category, n, share FROM ({_both('category', 'cat_counts')})",
        *_edges(_CREDIT_SLICES, ("LIMIT_BAL", "AGE")),
        _CREDIT_SLICES.long((*credit_cat, "default", "prediction"), "VARCHAR", "cat_long"), _CAT_COUNTS,
    )
    out["quality_profile"] = _quality(_LINEITEM, _L_NUM, _L_CAT)
    out["quality_profile_gaps"] = _quality(_CREDIT_SLICES, ("BILL_AMT6", "PAY_AMT6"), ("PAY_6",))

    out["latest_previous"] = (
        "WITH " + _VERSIONS + " SELECT model_name, version, run_id, CAST(rk AS INTEGER) AS version_rank FROM "
        "(SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC, run_id DESC) AS rk FROM versions) "
        "WHERE rk <= 2"
    )
    out["stage_version"] = (
        "WITH " + ",".join([_VERSIONS, _STAGED]) + " SELECT model_name, version, run_id, stage FROM staged"
    )
    out["run_of_stage"] = (
        "WITH " + ",".join([_VERSIONS, _STAGED])
        + " SELECT run_id, model_name, version, stage, source_data FROM staged"
    )
    out["event_payload"] = (
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
        f"DATE '{AS_OF}' AS run_date FROM events"
    )
    out["deployment_gate"] = _fairness(
        f"""SELECT c_mktsegment AS model_name, CAST(c_custkey AS VARCHAR) AS version, c_name AS "text",
          'hook-' || c_nationkey AS webhook_id, protected_var, parity_check
        FROM customer LEFT JOIN (SELECT model_run_id, protected_var, {_ANY} AS parity_check
          FROM fairness GROUP BY model_run_id, protected_var) ON c_mktsegment = model_run_id""",
        "segment",
    )
    out["metric_doc"] = _fairness(_LONG + " WHERE metric <> 'equal_odds'", "segment")
    out["metric_lookup"] = _fairness(
        "SELECT model_run_id, round(parity, 6) AS parity FROM fairness "
        "WHERE metric = 'equal_opportunity' AND protected_var = 'SEX'",
        "segment",
    )
    out["metric_pairs"] = _fairness("SELECT protected_var, metric, round(parity, 6) AS parity FROM fairness")
    out["json_rows"] = (
        "SELECT n_nationkey, '{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS \"json\" FROM nation"
    )

    out["csv_scan"] = _credit(f"SELECT {_CSV_COLUMNS} FROM raw")
    out["lineage_scan"] = (
        "SELECT c_custkey, c_name, CAST(NULL AS BIGINT) AS s_suppkey, CAST(NULL AS VARCHAR) AS s_name FROM customer "
        "UNION ALL SELECT NULL, NULL, s_suppkey, s_name FROM supplier"
    )
    out["schema_merge_append"] = _credit(
        f"SELECT USER_ID, LIMIT_BAL, CASE WHEN {_PROD} THEN score END AS score FROM credit "
        f"WHERE ({_REF}) OR ({_PROD})"
    )
    out["overwrite_replaces_schema"] = _credit("SELECT USER_ID, AGE, score FROM credit")
    out["latest_snapshot"] = _credit(
        "SELECT USER_ID, MARRIAGE, AGE, CAST(2 AS INTEGER) AS snapshot_id FROM credit"
    )
    out["baseline_and_append"] = _monitored(load=True)
    out["streamed_append"] = _monitored(load=False)
    inner = _quality(_CREDIT_SLICES, ("LIMIT_BAL", "AGE"), (*credit_cat, "default", "prediction"))
    out["saved_quality"] = f"SELECT *, {_SIGNED} FROM ({inner})"
    out["saved_run"] = _fairness(
        "SELECT model_run_id AS run_id, protected_var, metric, round(parity, 6) AS \"value\", "
        "0.43::DOUBLE AS threshold, CASE WHEN parity IS NULL THEN 'undefined' WHEN abs(parity) <= 0.43 THEN 'fair' ELSE 'unfair' END AS conclusion, "
        "'clean/credit' AS source_data FROM fairness WHERE metric = 'equal_opportunity'"
    )
    out["summary_drift"] = out["dataset_drift"]
    out["summary_distance"] = out["label_drift_cat"]
    out["summary_quality"] = out["saved_quality"]
    out["summary_report"] = out["drift_report"].replace("n, share FROM", "n, round(share, 6) AS share FROM")
    out["sampled_windows"] = _credit(
        "SELECT USER_ID, CAST(date_trunc('month', monitoring_date) + INTERVAL 14 DAY AS DATE) AS seen_on, "
        f"{_REF} AS in_ref, {_PROD} AS in_prod FROM credit "
        f"WHERE ({_REF} OR {_PROD}) AND ('0x' || substr(md5(USER_ID::VARCHAR || ':0'), 1, 15))::BIGINT % 1000000 < 300000"
    )
    out["ingested"] = _credit(f"SELECT {_CSV_COLUMNS} FROM credit")
    out["composite_lookup"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_lines, quantity FROM lineitem LEFT JOIN (
  SELECT l_partkey, l_suppkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(20,2))) AS DOUBLE) AS quantity
  FROM lineitem GROUP BY l_partkey, l_suppkey HAVING count(*) > 1) USING (l_partkey, l_suppkey)
"""
    out["stored_training_set"] = out["training_set"]
    out["deployment_stream"] = out["deployment_gate"]
    out["deployment_quarantine"] = (
        "SELECT event_message, CASE WHEN event_message LIKE 'broken%' THEN 'lacks event_id, event_ts, model_name' "
        "ELSE 'lacks event_id, event_ts' END AS reason, count(*) AS n_lines FROM (SELECT CASE WHEN c_custkey % 2 = 0 "
        "THEN 'broken ' || c_name ELSE '{\"model_name\":\"' || c_mktsegment || '\"}' END AS event_message FROM customer) "
        "GROUP BY event_message"
    )
    out["published_newest"] = _credit("SELECT USER_ID, MARRIAGE, AGE FROM credit")
    out["published_pinned"] = _credit("SELECT USER_ID, MARRIAGE, AGE FROM raw")
    out["schema_history"] = (
        "SELECT changes.*, n_rows FROM (VALUES (2::BIGINT, 'SEX', 'missing', 'int', NULL), "
        "(2, 'AGE', 'widened', 'int', 'double'), (3, 'SEX', 'added', NULL, 'int'), (3, 'score', 'added', NULL, 'int'), "
        "(3, 'AGE', 'retyped', 'double', 'int'), (3, 'LIMIT_BAL', 'retyped', 'double', 'int')) "
        "AS changes(\"version\", \"column\", change, old_type, new_type), (SELECT count(*) AS n_rows FROM customer)"
    )
    out["features_as_of"] = """
WITH base AS (
  SELECT c_custkey AS USER_ID, DATE '1995-01-01' + CAST(c_custkey * 37 % 2000 + later AS INTEGER) AS seen_on
  FROM customer, (SELECT unnest([0, 300]) AS later)
), met AS (
  SELECT USER_ID, seen_on, CAST(o_orderdate AS DATE) AS feature_date, o_totalprice, o_orderkey, row_number() OVER (
    PARTITION BY USER_ID, seen_on ORDER BY CAST(o_orderdate AS DATE) DESC, o_totalprice DESC, o_orderkey DESC) AS k
  FROM base LEFT JOIN orders ON o_custkey = USER_ID AND CAST(o_orderdate AS DATE) <= seen_on
)
SELECT USER_ID, seen_on, feature_date, o_totalprice, o_orderkey FROM met WHERE k = 1
"""
    out["saved_metrics"] = (
        f"SELECT protected_var, metric, parity AS \"value\" FROM ({out['fairness_long']}) "
        f"UNION ALL SELECT NULL, metric, \"value\" FROM ({out['perf_values']})"
    )
    out["saved_tradeoff"] = out["tradeoff"]
    out["registered_baseline"] = _registered()
    out["fit_certificate"] = _certified()
    out["train_test_split"] = _credit(f"SELECT USER_ID, {_SPLIT} AS split FROM credit")
    out["trained_monitor"] = _credit(
        f"""SELECT split, DATE '2022-03-01' AS monitoring_date, 'baseline' AS load_id, count(*) AS n_rows,
          sum("default")::BIGINT AS n_default,
          CASE WHEN split = 'train' THEN round(avg("default"), 4) END AS mean_probability, true AS consistent
        FROM (SELECT *, {_SPLIT} AS split FROM credit) GROUP BY split"""
    )
    out["unscored_baseline"] = _credit(
        f"SELECT USER_ID, SEX, \"default\", DATE '2022-03-01' AS monitoring_date, {_STAMPED}, "
        "'baseline' AS load_id FROM credit"
    )
    return out
