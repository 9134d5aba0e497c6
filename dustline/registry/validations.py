"""Scores, bins, ensembles, intervals over out-of-fold predictions."""

from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions.metrics import SCORE_NAMES, scores
from dustline.functions.quantiles import conformal_quantile, exact_quantiles
from dustline.operators import learning, validation as V
from dustline.registry import feeds as X
from dustline.registry.core import CATALOGUE, query
from dustline.registry.feeds import r, scores_sql, sr
from dustline.session import written

BASE = X.with_(X.STATIONS, X.PREDICTIONS)
LEARN = P.LEARNERS
SUBSETS = """subs AS (SELECT p.*, s.subset FROM predictions p, LATERAL (SELECT unnest(list_filter(['all', CASE WHEN country = 'GH' THEN 'ghana' END, CASE WHEN country = 'GH' AND is_reference THEN 'ghana_reference' END,
  CASE WHEN is_reference THEN 'reference_all' END, CASE WHEN country = 'GH' AND lat > 8 THEN 'ghana_north(>8N)' END, CASE WHEN country = 'GH' AND lat <= 8 THEN 'ghana_south(<=8N)' END,
  CASE WHEN month(date) IN (12,1,2) THEN 'harmattan(DJF)' END, CASE WHEN month(date) NOT IN (12,1,2) THEN 'non_harmattan' END], lambda x: x IS NOT NULL)) AS subset) s)"""


def flags():
    return V.subset_flags(F.col("country"), F.col("is_reference"), F.col("lat"), F.col("date"))


def rounded(*keys):
    return [*keys, "n", *[r(c) for c in SCORE_NAMES]]


@query("E13", BASE + f"SELECT fold, {scores_sql('pm25', 'cams_pm25')} FROM predictions GROUP BY fold")
def prediction_scores(spark, sf):
    return X.predictions(spark, sf).groupBy("fold").agg(*scores(F.col("pm25"), F.col("cams_pm25"))).select(*rounded("fold"))


@query("E15", BASE + f"SELECT site_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n, {sr('CASE WHEN count(*) >= 10 THEN avg(pm25) END','mean_obs')}, {sr('CASE WHEN count(*) >= 10 THEN avg(cams_pm25 - pm25) END','bias')}, {sr('CASE WHEN count(*) >= 10 THEN corr(cams_pm25, pm25) END','r')} FROM predictions GROUP BY ALL")
def small_group_scores(spark, sf):
    g = X.predictions(spark, sf).groupBy("site_id", F.year("date").alias("year"), F.month("date").alias("month")).agg(*scores(F.col("pm25"), F.col("cams_pm25"), min_rows=10))
    return g.select("site_id", "year", "month", "n", r("mean_obs"), r("mb", alias="bias"), r("r"))


LONG = "long_ AS (SELECT scheme, country, is_reference, lat, date, pm25, subset, m.* FROM (SELECT s.*, CASE fold % 2 WHEN 0 THEN 'cluster' ELSE 'random' END AS scheme FROM subs s), LATERAL (VALUES ('cams_raw', cams_pm25), ('lgbm', exp(lgbm)), ('catboost', exp(catboost)), ('stack', exp((lgbm + xgb_ratio) / 2))) m(model, pred))"


@query("E16 C11 T13", BASE.rstrip() + f",\n{SUBSETS}, {LONG} SELECT scheme, model, subset, {scores_sql('pm25', 'pred')} FROM long_ GROUP BY ALL HAVING count(*) >= 30")
def scheme_model_subset_scores(spark, sf):
    p = X.predictions(spark, sf).withColumn("scheme", F.when(F.col("fold") % 2 == 0, "cluster").otherwise("random"))
    preds = [F.struct(F.lit(n).alias("model"), c.alias("pred")) for n, c in (
        ("cams_raw", F.col("cams_pm25")), ("lgbm", F.exp("lgbm")), ("catboost", F.exp("catboost")), ("stack", F.exp((F.col("lgbm") + F.col("xgb_ratio")) / 2)))]
    tall = V.explode_subsets(p, flags()).select("scheme", "subset", "pm25", F.explode(F.array(*preds)).alias("m")).select("scheme", "subset", "pm25", "m.model", "m.pred")
    return V.score_table(tall, ["scheme", "model", "subset"], "pm25", "pred").select(*rounded("scheme", "model", "subset"))


@query("N7 E16", BASE.rstrip() + f",\n{SUBSETS} SELECT subset, " + ", ".join(f"round(1 - (sum(power({m} - y, 2)) FILTER (fold % 2 = {k})) / ((var_pop(y) FILTER (fold % 2 = {k})) * (count(*) FILTER (fold % 2 = {k}))) + {X.NUDGE}, 4) + 0.0 AS {s}_{m}" for m in ('lgbm', 'catboost') for k, s in ((0, 'cluster'), (1, 'random'))) + " FROM subs GROUP BY subset")
def score_summary_pivot(spark, sf):
    p = V.explode_subsets(X.predictions(spark, sf).withColumn("scheme", F.when(F.col("fold") % 2 == 0, "cluster").otherwise("random")), flags())
    agg = []
    for m in ("lgbm", "catboost"):
        e = F.col(m) - F.col("y")
        agg.append((1 - F.sum(e * e) / (F.var_pop("y") * F.count("y"))).alias(m))
    t = p.groupBy("subset").pivot("scheme", ["cluster", "random"]).agg(*agg)
    return t.select("subset", *[r(f"{s}_{m}") for m in ("lgbm", "catboost") for s in ("cluster", "random")])


@query("E17 N14", BASE + f"SELECT site_id, any_value(country) AS country, any_value(network) AS network, {scores_sql('pm25', 'exp(lgbm)')} FROM predictions GROUP BY site_id HAVING count(*) >= 30")
def per_site_scores(spark, sf):
    g = X.predictions(spark, sf).groupBy("site_id").agg(F.first("country").alias("country"), F.first("network").alias("network"), *scores(F.col("pm25"), F.exp("lgbm"))).where("n >= 30")
    return g.select(*rounded("site_id", "country", "network"))


DIST = "(row_id * 7919 % 10007) / 10007.0::DOUBLE * 700"


@query("E19 E18", BASE + f""", b AS (SELECT least({DIST}, 600.0) AS x, abs(y - lgbm) AS e FROM predictions),
c AS (SELECT e, CASE WHEN x <= 0 THEN NULL WHEN x <= 5 THEN 0 WHEN x <= 15 THEN 1 WHEN x <= 30 THEN 2 WHEN x <= 60 THEN 3 WHEN x <= 120 THEN 4 WHEN x <= 250 THEN 5 ELSE 6 END AS bin FROM b)
SELECT bin, {sr('(exp(quantile_cont(e, 0.5)) - 1) * 100','median_pct')}, {sr('(exp(quantile_cont(e, 0.9)) - 1) * 100','p90_pct')} FROM c WHERE bin IS NOT NULL GROUP BY bin""")
def error_by_monitor_distance(spark, sf):
    p = X.predictions(spark, sf)
    km = F.pmod(F.col("row_id") * 7919, F.lit(10007)) / 10007.0 * 700
    return V.error_by_distance(p, km, F.abs(F.col("y") - F.col("lgbm"))).select("bin", r("median_pct"), r("p90_pct"))


@query("E20", BASE + "SELECT fold, CAST(floor((least(greatest(log10(pm25 + 0.13), log10(2.0)), log10(400.0) - 1e-9) - log10(2.0)) / (log10(400.0) - log10(2.0)) * 40) AS INTEGER) AS i, CAST(floor((least(greatest(log10(cams_pm25), log10(2.0)), log10(400.0) - 1e-9) - log10(2.0)) / (log10(400.0) - log10(2.0)) * 40) AS INTEGER) AS j, count(*) AS n FROM predictions GROUP BY ALL")
def log_density_bins(spark, sf):
    return V.log_histogram(X.predictions(spark, sf), F.col("pm25") + 0.13, F.col("cams_pm25"), keys=["fold"])


@query("M5 F9 E8 E9", BASE + f""", c AS (SELECT country AS cluster, count(DISTINCT site_id) AS k FROM predictions GROUP BY 1)
SELECT site_id, count(*) AS n, {sr('sum(w)','w_sum')}, {sr('sum(w * pm25) / sum(w)','weighted_mean')} FROM (SELECT site_id, pm25, 1 / sqrt(k) * ((0.04::DOUBLE + 0.01) / (0.04::DOUBLE + cal_sigma_log * cal_sigma_log)) AS w FROM predictions JOIN c ON country = cluster) GROUP BY site_id""")
def sample_weight_sums(spark, sf):
    p = learning.sample_weights(X.predictions(spark, sf), cluster="country")
    g = p.groupBy("site_id").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w_sum"), (F.sum(F.col("weight") * F.col("pm25")) / F.sum("weight")).alias("weighted_mean"))
    return g.select("site_id", "n", r("w_sum"), r("weighted_mean"))


_MEAN = "(" + " + ".join(f"CASE WHEN mask & {1 << k} <> 0 THEN {n} ELSE 0 END" for k, n in enumerate(LEARN)) + ") / bit_count(mask)"


@query("M9 K2 G2", BASE + f""", t AS (SELECT mask, fold, pm25, exp({_MEAN}) AS p FROM predictions, (SELECT CAST(unnest(range(1, 16)) AS INTEGER) AS mask)),
s AS (SELECT mask, avg(r2) AS mean_r2 FROM (SELECT mask, fold, 1 - sum((p - pm25) * (p - pm25)) / (var_pop(pm25) * count(*)) AS r2 FROM t GROUP BY ALL) GROUP BY mask)
SELECT mask, {sr('mean_r2','mean_r2')} FROM s ORDER BY s.mean_r2 DESC LIMIT 5""")
def ensemble_candidates(spark, sf):
    ranked = V.rank_subsets(X.predictions(spark, sf), "pm25", LEARN, ["fold"]).orderBy(F.col("mean_r2").desc(), "mask").limit(5)
    return ranked.select("mask", r("mean_r2"))


ENSEMBLE = "ens AS (SELECT scheme, dom, CAST(mask AS VARCHAR) AS candidate, pm25, exp(" + _MEAN + ") AS p FROM sch, (SELECT CAST(unnest(range(1, 16)) AS INTEGER) AS mask) UNION ALL SELECT scheme, dom, 'stack', pm25, exp(0.25 * lgbm + 0.75 * catboost) FROM sch)"


@query("M9 G2", BASE.rstrip() + f""",
sch AS (SELECT p.*, d.dom, CASE fold % 3 WHEN 0 THEN 'cluster' WHEN 1 THEN 'site' ELSE 'temporal' END AS scheme FROM predictions p, LATERAL (SELECT unnest(CASE WHEN country = 'GH' THEN ['all', 'home'] ELSE ['all'] END) AS dom) d),
{ENSEMBLE}, r AS (SELECT candidate, avg(r2) AS mean_r2 FROM (SELECT scheme, dom, candidate, 1 - sum((p - pm25) * (p - pm25)) / (var_pop(pm25) * count(*)) AS r2 FROM ens GROUP BY ALL) GROUP BY candidate)
SELECT candidate, {sr('mean_r2','mean_r2')}, mean_r2 = max(mean_r2) OVER () AS chosen FROM r""")
def ensemble_choice(spark, sf):
    """Subsets and a weighted stack over three schemes by two domains, with the chosen one."""
    p = X.predictions(spark, sf).withColumns({"scheme": F.element_at(F.array(*map(F.lit, ("cluster", "site", "temporal"))), (F.col("fold") % 3 + 1).cast("int")),
                                             "stack": 0.25 * F.col("lgbm") + 0.75 * F.col("catboost")})
    c = V.ensemble_choice(p, "pm25", LEARN, "scheme", F.col("country") == "GH", "stack")
    return c.select("candidate", r("mean_r2"), "chosen")


@query("M10 G2", BASE + """SELECT country, max_by(lam, [r2, -lam]) AS lam FROM (SELECT country, CAST(lam AS DOUBLE) AS lam, round(1 - sum(power(exp(catboost + lam * (lgbm - y)) - pm25, 2)) / (var_pop(pm25) * count(*)), 10) AS r2
 FROM predictions, (VALUES (0.0), (0.1), (0.2), (0.3), (0.5), (0.75), (1.0)) l(lam) GROUP BY ALL) GROUP BY country""")
def chosen_correction_strength(spark, sf):
    """Strength of the correction with the best R2, the smaller one among equals."""
    p = X.predictions(spark, sf).withColumn("rk", F.col("lgbm") - F.col("y"))
    scan = V.lambda_scan(p, "pm25", "catboost", "rk", ["country"])
    return scan.groupBy("country").agg(F.max_by("lam", F.struct(F.round("r2", 10), -F.col("lam"))).alias("lam"))


@query("M10", BASE + f"SELECT country, CAST(lam AS DOUBLE) AS lam, {sr('1 - sum(power(exp(catboost + lam * (lgbm - y)) - pm25, 2)) / (var_pop(pm25) * count(*))','r2')} FROM predictions, (VALUES (0.0), (0.1), (0.2), (0.3), (0.5), (0.75), (1.0)) l(lam) GROUP BY ALL")
def correction_strength_scan(spark, sf):
    p = X.predictions(spark, sf).withColumn("rk", F.col("lgbm") - F.col("y"))
    return V.lambda_scan(p, "pm25", "catboost", "rk", ["country"]).select("country", "lam", r("r2"))


@query("M11 E9", BASE + f"SELECT country, {sr('sum(exp(y - lgbm) * cal_sigma_log) / sum(cal_sigma_log)','smear')} FROM predictions GROUP BY country")
def smearing_factor(spark, sf):
    g = X.predictions(spark, sf).groupBy("country").agg(learning.smearing(F.col("y") - F.col("lgbm"), F.col("cal_sigma_log")).alias("smear"))
    return g.select("country", r("smear"))


@query("M13 K4", BASE + """, q AS (SELECT fold, s, row_number() OVER (PARTITION BY fold ORDER BY s) AS rn, count(*) OVER (PARTITION BY fold) AS n FROM (SELECT fold, abs(y - lgbm) / (cal_sigma_log + 0.05) AS s FROM predictions))
SELECT fold, round(max(s) FILTER (rn = least(CAST(ceil((n + 1) * 0.9::DOUBLE) AS BIGINT), n)), 8) AS q90, round(max(s) FILTER (rn = least(CAST(ceil((n + 1) * 0.6799999999999999::DOUBLE) AS BIGINT), n)), 8) AS q68 FROM q GROUP BY fold""")
def conformal_quantiles(spark, sf):
    p = X.predictions(spark, sf)
    q = conformal_quantile(p, ["fold"], F.abs(F.col("y") - F.col("lgbm")) / (F.col("cal_sigma_log") + 0.05), {"q90": 0.1, "q68": 0.32})
    return q.select("fold", F.round("q90", 8).alias("q90"), F.round("q68", 8).alias("q68"))


@query("M14 E16 M13", BASE.rstrip() + f",\n{SUBSETS}, sc AS (SELECT *, abs(y - lgbm) / (cal_sigma_log + 0.05) AS score, cal_sigma_log + 0.05 AS sigma FROM subs),\n" + """u AS (SELECT fold, score FROM sc WHERE subset = 'all'), oth AS (SELECT f.fold, u.score FROM (SELECT DISTINCT fold FROM u) f JOIN u ON u.fold <> f.fold),
rk AS (SELECT fold, score, row_number() OVER (PARTITION BY fold ORDER BY score) AS rn, count(*) OVER (PARTITION BY fold) AS n FROM oth),
q AS (SELECT fold, a.nominal, max(score) FILTER (rn = least(CAST(ceil((n + 1) * a.nominal) AS BIGINT), n)) AS q FROM rk, (VALUES (0.9::DOUBLE), (0.68::DOUBLE)) a(nominal) GROUP BY ALL)
""" + f"SELECT nominal, subset, {sr('avg(CAST(score <= q AS INTEGER))','coverage')}, count(*) AS n, {sr('quantile_cont(exp(lgbm + q * sigma) - exp(lgbm - q * sigma), 0.5)','median_width')} FROM sc JOIN q USING (fold) GROUP BY ALL HAVING count(*) >= 30")
def nested_interval_coverage(spark, sf):
    sigma = F.col("cal_sigma_log") + 0.05
    p = X.predictions(spark, sf).withColumns({"sigma": sigma, "score": F.abs(F.col("y") - F.col("lgbm")) / sigma, "logpred": F.col("lgbm")})
    c = V.nested_coverage(p, {0.1: "90", 0.32: "68"}, flags())
    return c.select("nominal", "subset", r("coverage"), "n", r("median_width"))


NESTED_SQL = CATALOGUE["nested_interval_coverage"].sql


@query("N13 M14", f"SELECT round(100 * coverage, 1) AS covered_pct, nominal, n, median_width FROM ({NESTED_SQL}) WHERE subset = 'all' AND nominal = 0.9")
def coverage_headline(spark, sf):
    """Share of held-out rows inside their 90 % interval, over all rows."""
    c = nested_interval_coverage(spark, sf).where("subset = 'all' and nominal = 0.9")
    return c.select(F.round(F.col("coverage") * 100, 1).alias("covered_pct"), "nominal", "n", "median_width")


@query("E29 N6 K6", BASE + f"SELECT site_id, CAST(month(date) AS INTEGER) AS month, count(*) AS n, {sr('avg(pm25)','obs')}, {sr('avg(cams_pm25)','cams')}, {sr('quantile_cont(cams_pm25 / pm25, 0.5)','ratio')} FROM predictions WHERE is_reference GROUP BY ALL")
def reference_site_bias(spark, sf):
    p = X.predictions(spark, sf).where("is_reference").withColumn("month", F.month("date"))
    g = p.groupBy("site_id", "month").agg(F.count(F.lit(1)).alias("n"), F.avg("pm25").alias("obs"), F.avg("cams_pm25").alias("cams"))
    q = exact_quantiles(p, ["site_id", "month"], F.col("cams_pm25") / F.col("pm25"), {"ratio": 0.5})
    return g.join(q, ["site_id", "month"]).select("site_id", "month", "n", r("obs"), r("cams"), r("ratio"))


@query("N13", BASE + f"SELECT {sr('1 - sqrt(avg(power(exp(lgbm) - pm25, 2))) / sqrt(avg(power(cams_pm25 - pm25, 2)))','rmse_gain')}, {sr('greatest(' + ', '.join(f'1 - sum(power({m} - y, 2)) / (var_pop(y) * count(*))' for m in LEARN) + ')','best_r2')}, count(*) AS n FROM predictions")
def headline_gain(spark, sf):
    p = X.predictions(spark, sf)
    e, b = F.exp("lgbm") - F.col("pm25"), F.col("cams_pm25") - F.col("pm25")
    r2 = [1 - F.sum((F.col(m) - F.col("y")) * (F.col(m) - F.col("y"))) / (F.var_pop("y") * F.count("y")) for m in LEARN]
    g = p.agg((1 - F.sqrt(F.avg(e * e)) / F.sqrt(F.avg(b * b))).alias("rmse_gain"), F.greatest(*r2).alias("best_r2"), F.count(F.lit(1)).alias("n"))
    return g.select(r("rmse_gain"), r("best_r2"), "n")


@query("N2 M2", X.with_(X.SITE_DAYS) + f""", m AS (SELECT CAST(month(date) % 6 AS INTEGER) AS fold, site_id % 10 AS variable, rh AS x, pm25 AS y FROM site_days),
f AS (SELECT fold, variable, (SELECT regr_slope(y, x) FROM m b WHERE b.variable = a.variable AND b.fold <> a.fold) AS b, (SELECT regr_intercept(y, x) FROM m b WHERE b.variable = a.variable AND b.fold <> a.fold) AS a FROM (SELECT DISTINCT fold, variable FROM m) a)
SELECT fold, variable, {sr('b','b',6)}, {sr('a','a',4)} FROM f""")
def fold_excluded_lines(spark, sf):
    d = X.site_days(spark, sf).select((F.month("date") % 6).alias("fold"), F.pmod("site_id", F.lit(10)).alias("variable"), F.col("rh").alias("x"), F.col("pm25").alias("y"))
    return V.fold_excluded_line(d, ["variable"], "x", "y").select("fold", "variable", r("b", 6), r("a", 4))


SCHEMES = ("cluster", "random")


def bundle(spark, sf):
    """(scheme, body): score rows, density cells and interval coverage of each scheme as one document."""
    p = X.predictions(spark, sf).withColumn("scheme", F.when(F.col("fold") % 2 == 0, SCHEMES[0]).otherwise(SCHEMES[1]))
    sigma = F.col("cal_sigma_log") + 0.05
    p = written(p.withColumns({"sigma": sigma, "score": F.abs(F.col("y") - F.col("lgbm")) / sigma, "logpred": F.col("lgbm")}), "bundle-rows")
    listed = lambda df, name, *cols: df.groupBy("scheme").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    metrics = listed(scheme_model_subset_scores(spark, sf), "metrics", "model", "subset", "n", "r2", "rmse")
    density = listed(V.log_histogram(p, F.col("pm25"), F.col("cams_pm25"), keys=["scheme"]), "density", "i", "j", "n")
    covered = V.nested_coverage(p, {0.1: "90", 0.32: "68"}, flags(), schemes=("scheme", SCHEMES))
    coverage = listed(covered, "coverage", "nominal", "subset", "n", r("coverage"))
    whole = metrics.join(density, "scheme", "left").join(coverage, "scheme", "left")
    return whole.select("scheme", F.to_json(F.struct("metrics", "density", "coverage"), {"ignoreNullFields": "false"}).alias("body"))


_DENSITY = "floor((least(greatest(log10({0}), log10(2.0)), log10(400.0) - 1e-9) - log10(2.0)) / (log10(400.0) - log10(2.0)) * 40)"
_COVERED = " UNION ALL ".join(
    f"SELECT '{name}' AS scheme, 'coverage' AS part, CAST(nominal AS VARCHAR) || '|' || subset AS item, n, coverage AS value FROM ("
    + NESTED_SQL.replace("FROM predictions p, LATERAL", f"FROM (SELECT * FROM predictions WHERE fold % 2 = {k}) p, LATERAL") + ")" for k, name in enumerate(SCHEMES))


@query("B17 B19", f"""SELECT scheme, 'metrics' AS part, model || '|' || subset AS item, n, r2 AS value FROM ({CATALOGUE["scheme_model_subset_scores"].sql})
UNION ALL SELECT * FROM (WITH {BASE.strip()[4:]} SELECT CASE fold % 2 WHEN 0 THEN 'cluster' ELSE 'random' END AS scheme, 'density' AS part, CAST({_DENSITY.format('pm25')} AS INTEGER) || '|' || CAST({_DENSITY.format('cams_pm25')} AS INTEGER) AS item, count(*) AS n, NULL::DOUBLE AS value
  FROM predictions WHERE pm25 > 0 AND cams_pm25 > 0 GROUP BY ALL)
UNION ALL {_COVERED}""")
def validation_bundle(spark, sf):
    """The documents of ``bundle``, read back from their JSON as rows."""
    kind = "metrics array<struct<model:string,subset:string,n:bigint,r2:double>>, density array<struct<i:int,j:int,n:bigint>>, coverage array<struct<nominal:double,subset:string,n:bigint,coverage:double>>"
    b = bundle(spark, sf).select("scheme", F.from_json("body", kind).alias("b"))

    def part(name, item, value):
        x = b.select("scheme", F.explode(f"b.{name}").alias("x"))
        return x.select("scheme", F.lit(name).alias("part"), F.concat_ws("|", *[F.col(f"x.{c}").cast("string") for c in item]).alias("item"), F.col("x.n").alias("n"), value.alias("value"))

    return (part("metrics", ("model", "subset"), F.col("x.r2")).unionByName(part("density", ("i", "j"), F.lit(None).cast("double")))
            .unionByName(part("coverage", ("nominal", "subset"), F.col("x.coverage"))))


@query("M8 D2", None)
def stacked_predictions(spark, sf):
    """Nested non-negative stacking; the fold's own rows never enter its weights."""
    p = learning.sample_weights(X.predictions(spark, sf), cluster="country")
    s = learning.nested_stack(p)
    return s.groupBy("fold").agg(*scores(F.col("y"), F.col("stack"))).select(*rounded("fold"))
