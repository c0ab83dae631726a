"""Seasonal statistics as distributed aggregations.

The daily series is a DataFrame (one row per trading day, no gap fill).
The Welch test is one grouped aggregate (count, mean, sample variance per
group) folded to one row; the OLS fit
``daily_revenue ~ 1 + is_q4 + daily_orders`` is one moment aggregate
(means, sample variances and covariances) solved in closed form. Nothing
is collected: the one-row results stay DataFrames.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import formatting as fmt
from tillroll.functions.dates import is_q4
from tillroll.functions.stats import ieee_div, is_finite, two_sided_p, z_critical

ALPHA = 0.05
CONF_LEVEL = 0.95
OLS_TERMS = ("const", "is_q4", "daily_orders")

# The test report's block titles and line templates, in line
# order; {name} is filled from the Welch row (numbers formatted as the
# report does).
REPORT_TITLE_REVENUE = "TEST 1: Daily Revenue (Q4 vs Non-Q4)"
REPORT_TITLE_RATE = "TEST 2: Daily Return Rate (Q4 vs Non-Q4)"
REPORT_LINES = [
    "=== {title} ===",
    "n_q4={n_q4} | n_non_q4={n_non_q4}",
    "mean_q4: {mean_q4}",
    "mean_non_q4: {mean_non_q4}",
    "diff (q4 - non_q4): {diff}",
    "t_stat (Welch): {t_stat}",
    "p_value (Normal approx): {p_value}",
    "significant (alpha={alpha}): {significant}",
    "df_eff (Welch-Satterthwaite): {df_eff}",
    "{level}% CI (diff, Normal approx): [{ci_low}, {ci_high}]",
]


def render_template(template: str, values: dict, lit, concat):
    """Split ``template`` into literal text and {name} slots and join them
    with ``concat``; ``lit`` wraps literal text."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(values[piece])
        elif piece:
            parts.append(lit(piece))
    return concat(parts)


# ---------------------------------------------------------------- series


def daily_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Net revenue per day; a day whose totals are all NULL counts with 0, as
    the source's ``fillna(0)``, so the tests on the series keep it."""
    total = F.sum("total_price")
    per_day = fact.groupBy("date_key").agg(F.coalesce(total, F.lit(0).cast("decimal(14,2)")).alias("revenue"))
    return (per_day.join(dim_date, "date_key")
            .select(F.col("full_date").alias("order_date"), "revenue")
            .orderBy("order_date"))


def daily_return_rate(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """|returned revenue| / gross revenue per day, by quantity sign; days
    without positive gross revenue are left out. Runs on the fact or on the
    day x country rollup (same sums)."""
    if "gross_sales_by_qty" in fact.columns:          # the day x country rollup
        gross, returned = F.sum("gross_sales_by_qty"), F.sum("returns_by_qty")
    else:
        q, tp = F.col("quantity"), F.col("total_price")
        zero = F.lit(0).cast("decimal(14,2)")
        gross = F.sum(F.when(q > 0, tp).otherwise(zero))
        returned = F.sum(F.when(q < 0, tp).otherwise(zero))
    per_day = fact.groupBy("date_key").agg(gross.alias("gross_revenue"),
                                           F.abs(returned).alias("returned_revenue"))
    return (per_day.where(F.col("gross_revenue") > 0)
            .join(dim_date, "date_key")
            .select(F.col("full_date").alias("order_date"),
                    (F.col("returned_revenue").cast("double")
                     / F.col("gross_revenue").cast("double")).alias("return_rate"))
            .orderBy("order_date"))


def q4_daily_dataset(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """order_date, daily_revenue, daily_orders (distinct invoices,
    cancellations included), is_q4. NULL revenue -> 0, as the source's
    ``fillna(0)``. Runs on the fact or on ``marts.invoice_rollup``."""
    per_day = fact.groupBy("date_key").agg(
        F.sum("total_price").alias("daily_revenue"),
        F.count_distinct("invoice").alias("daily_orders"))
    return (per_day.join(dim_date, "date_key")
            .select(F.col("full_date").alias("order_date"),
                    F.coalesce(F.col("daily_revenue").cast("double"), F.lit(0.0)).alias("daily_revenue"),
                    F.col("daily_orders").cast("int").alias("daily_orders"),
                    is_q4(F.month("full_date")).alias("is_q4"))
            .orderBy("order_date"))


# ---------------------------------------------------------------- Welch


def welch_test(series: DataFrame, value_col: str, date_col: str = "order_date",
               name: str = "", conf_level: float = CONF_LEVEL, alpha: float = ALPHA) -> DataFrame:
    """Welch two-sample test of Q4 (Oct-Dec) against the other months.

    Normal approximation for p and the CI (no t distribution), as in the
    source. Fewer than 2 observations in a group raises; se = 0 gives
    NaN t / p and significance 'NA'.
    """
    z = z_critical(conf_level)
    v = F.col(value_col).cast("double")
    g = series.where(v.isNotNull() & ~F.isnan(v)).select(
        is_q4(F.month(F.col(date_col))).alias("_q4"), v.alias("_v"))
    per = g.groupBy("_q4").agg(F.count(F.lit(1)).alias("_n"), F.avg("_v").alias("_m"),
                               F.var_samp("_v").alias("_var"))

    def pick(flag, c):
        return F.max(F.when(F.col("_q4") == flag, F.col(c)))

    one = per.agg(
        F.coalesce(pick(1, "_n"), F.lit(0)).alias("n_q4"),
        F.coalesce(pick(0, "_n"), F.lit(0)).alias("n_non_q4"),
        pick(1, "_m").alias("mean_q4"), pick(0, "_m").alias("mean_non_q4"),
        pick(1, "_var").alias("_v1"), pick(0, "_var").alias("_v2"))
    # a series with no rows at all still yields one row (global aggregate)
    n1, n2 = F.col("n_q4"), F.col("n_non_q4")
    v1, v2 = F.col("_v1"), F.col("_v2")
    a, b = v1 / n1, v2 / n2
    se = F.sqrt(a + b)
    diff = F.col("mean_q4") - F.col("mean_non_q4")
    t = F.when(se > 0, diff / se).otherwise(F.lit(float("nan")))
    # the guard is folded into an output column so it is always evaluated
    checked = one.withColumn(
        "n_q4",
        F.when((n1 < 2) | (n2 < 2),
               F.raise_error(F.lit(f"{name or value_col}: need at least 2 observations per group")))
        .otherwise(n1))
    out = (checked
           .withColumn("diff", diff)
           .withColumn("_se", se)
           .withColumn("t_stat", t)
           .withColumn("p_value", two_sided_p(F.col("t_stat")))
           .withColumn("significant",
                       F.when(is_finite(F.col("p_value")),
                              F.when(F.col("p_value") < alpha, F.lit("True")).otherwise(F.lit("False")))
                       .otherwise(F.lit("NA")))
           .withColumn("df_eff", ieee_div((a + b) * (a + b),
                                          v1 * v1 / (n1 * n1 * (n1 - 1)) + v2 * v2 / (n2 * n2 * (n2 - 1))))
           .withColumn("ci_low", F.col("diff") - F.lit(z) * F.col("_se"))
           .withColumn("ci_high", F.col("diff") + F.lit(z) * F.col("_se")))
    return out.select(F.lit(name).alias("test"), F.col("n_q4").cast("long").alias("n_q4"),
                      F.col("n_non_q4").cast("long").alias("n_non_q4"),
                      "mean_q4", "mean_non_q4", "diff", "t_stat", "p_value", "significant",
                      "df_eff", "ci_low", "ci_high",
                      F.lit(float(conf_level)).alias("conf_level"))


def round_welch(df: DataFrame, decimals: int) -> DataFrame:
    """Round the Welch row for comparison / display: values to ``decimals``,
    t to 4, p to 6, df to 4."""
    return df.select(
        "test", "n_q4", "n_non_q4",
        *[F.round(c, decimals).alias(c) for c in ("mean_q4", "mean_non_q4", "diff")],
        F.round("t_stat", 4).alias("t_stat"), F.round("p_value", 6).alias("p_value"),
        "significant", F.round("df_eff", 4).alias("df_eff"),
        *[F.round(c, decimals).alias(c) for c in ("ci_low", "ci_high")])


# ---------------------------------------------------------------- OLS


def ols_moments(dataset: DataFrame, y: str = "daily_revenue", q: str = "is_q4",
                o: str = "daily_orders") -> DataFrame:
    """One pass: n, means, sample variances and covariances."""
    Y, Q, O = (F.col(c).cast("double") for c in (y, q, o))
    d = dataset.where(Y.isNotNull() & Q.isNotNull() & O.isNotNull())
    return d.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(Y).alias("my"), F.avg(Q).alias("mq"), F.avg(O).alias("mo"),
        F.var_samp(Q).alias("sqq"), F.var_samp(O).alias("soo"), F.var_samp(Y).alias("syy"),
        F.covar_samp(Q, O).alias("sqo"), F.covar_samp(Q, Y).alias("sqy"),
        F.covar_samp(O, Y).alias("soy"))


def _ols_solution(moments: DataFrame) -> DataFrame:
    k = len(OLS_TERMS)
    c = F.col
    n = c("n").cast("double")
    D = c("sqq") * c("soo") - c("sqo") * c("sqo")
    guard = (F.when(c("n") <= k, F.raise_error(F.concat(F.lit("Not enough observations: n="),
                                                         c("n").cast("string"), F.lit(f", k={k}"))))
             .when(D.isNull() | (D == 0), F.raise_error(F.lit("singular design: X'X is not invertible"))))
    b1 = (c("soo") * c("sqy") - c("sqo") * c("soy")) / D
    b2 = (c("sqq") * c("soy") - c("sqo") * c("sqy")) / D
    return (moments
            .withColumn("_guard", guard)
            .withColumn("_D", D)
            .withColumn("b1", b1).withColumn("b2", b2)
            .withColumn("b0", c("my") - c("b1") * c("mq") - c("b2") * c("mo"))
            .withColumn("r2", F.when(c("syy") > 0, (c("b1") * c("sqy") + c("b2") * c("soy")) / c("syy"))
                        .otherwise(F.lit(float("nan"))))
            .withColumn("adj_r2", F.lit(1.0) - (F.lit(1.0) - c("r2")) * (n - 1) / (n - k))
            .withColumn("_sse", (n - 1) * c("syy") - (n - 1) * (c("b1") * c("sqy") + c("b2") * c("soy")))
            .withColumn("_s2", c("_sse") / (n - k))
            .withColumn("se1", F.sqrt(c("_s2") * c("soo") / ((n - 1) * c("_D"))))
            .withColumn("se2", F.sqrt(c("_s2") * c("sqq") / ((n - 1) * c("_D"))))
            .withColumn("se0", F.sqrt(c("_s2") * (F.lit(1.0) / n
                        + (c("mq") * c("mq") * c("soo") - F.lit(2.0) * c("mq") * c("mo") * c("sqo")
                           + c("mo") * c("mo") * c("sqq")) / ((n - 1) * c("_D")))))
            .where(c("_guard").isNull()))


def ols_q4(dataset: DataFrame) -> DataFrame:
    """term, coef, se, t, p (normal approximation), one row per term."""
    sol = _ols_solution(ols_moments(dataset))
    rows = F.array(*[
        F.struct(F.lit(i).alias("term_no"), F.lit(term).alias("term"),
                 F.col(f"b{i}").alias("coef"), F.col(f"se{i}").alias("se"))
        for i, term in enumerate(OLS_TERMS)])
    long = sol.select(F.inline(rows))
    t = ieee_div(F.col("coef"), F.col("se"))
    return (long.withColumn("t", t)
            .withColumn("p", two_sided_p(F.col("t")))
            .orderBy("term_no")
            .select("term", "coef", "se", "t", "p"))


def ols_q4_fit(dataset: DataFrame) -> DataFrame:
    sol = _ols_solution(ols_moments(dataset))
    return sol.select(F.col("n").cast("long").alias("n"), "r2", "adj_r2")


# ---------------------------------------------------------------- report


def welch_report_lines(welch: DataFrame, title: str, decimals: int) -> DataFrame:
    """The ten text lines of one test block, in order (line_no 1..10)."""
    def g(c):
        return fmt.fmt_grouped(F.col(c), decimals)
    values = {
        "title": F.lit(title),
        "n_q4": F.col("n_q4").cast("string"), "n_non_q4": F.col("n_non_q4").cast("string"),
        "mean_q4": g("mean_q4"), "mean_non_q4": g("mean_non_q4"), "diff": g("diff"),
        "t_stat": fmt.fmt_fixed(F.col("t_stat"), 4),
        "p_value": fmt.fmt_general6(F.col("p_value")),
        "alpha": F.lit(str(ALPHA)), "significant": F.col("significant"),
        "df_eff": fmt.fmt_fixed(F.col("df_eff"), 2),
        "level": (F.col("conf_level") * 100).cast("int").cast("string"),
        "ci_low": g("ci_low"), "ci_high": g("ci_high"),
    }
    lines = F.array(*[render_template(t, values, F.lit, lambda p: F.concat(*p)) for t in REPORT_LINES])
    return welch.select(F.posexplode(lines).alias("pos", "line")) \
        .select((F.col("pos") + 1).cast("int").alias("line_no"), "line")


def q4_report(revenue_series: DataFrame, rate_series: DataFrame) -> DataFrame:
    """Both test blocks separated by an empty line: (line_no, line)."""
    t1, t2 = REPORT_TITLE_REVENUE, REPORT_TITLE_RATE
    b1 = welch_report_lines(welch_test(revenue_series, "revenue", name=t1), t1, 2)
    b2 = welch_report_lines(welch_test(rate_series, "return_rate", name=t2), t2, 4)
    blank = b1.where(F.col("line_no") == 1).select(F.lit(11).alias("line_no"), F.lit("").alias("line"))
    return (b1.unionByName(blank)
            .unionByName(b2.select((F.col("line_no") + 11).cast("int").alias("line_no"), "line"))
            .orderBy("line_no"))


# ---------------------------------------------------------------- general OLS


def ols_general(dataset: DataFrame, features: list[str], label: str = "daily_revenue") -> DataFrame:
    """OLS with any number of regressors on MLlib's normal-equation solver
    (X'X and X'y are aggregated over the cluster; only the k x k system is
    solved on the driver). Same output as ``ols_q4``: term, coef, se, t and
    a two-sided normal-approximation p."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    cols = [F.col(c).cast("double").alias(c) for c in features + [label]]
    d = dataset.select(*cols).na.drop()
    vec = VectorAssembler(inputCols=features, outputCol="_x").transform(d)
    model = LinearRegression(featuresCol="_x", labelCol=label, solver="normal", regParam=0.0,
                             elasticNetParam=0.0, fitIntercept=True, standardization=False).fit(vec)
    s = model.summary
    coef = [float(model.intercept)] + [float(c) for c in model.coefficients]
    # MLlib lists the intercept last in its standard errors
    se_all = list(s.coefficientStandardErrors)
    se = [float(se_all[-1])] + [float(x) for x in se_all[:-1]]
    spark = dataset.sparkSession
    rows = [(i, t, b, e) for i, (t, b, e) in enumerate(zip(["const"] + features, coef, se))]
    out = spark.createDataFrame(rows, "term_no int, term string, coef double, se double")
    t = ieee_div(F.col("coef"), F.col("se"))
    return (out.withColumn("t", t).withColumn("p", two_sided_p(F.col("t")))
            .orderBy("term_no").select("term", "coef", "se", "t", "p"))
