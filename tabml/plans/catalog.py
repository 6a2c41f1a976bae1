"""Registered queries: one Spark callable and (when SQL can say it) one
DuckDB oracle per operator of the inventory.

Every query reads whole tables (or planted fixtures over them).  Doubles are
rounded to 6 decimals on both sides; every computed column is aliased to the
same name on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabml.operators import knn, metrics, prep, roles, split, target
from tabml.plans import fixtures as fx
from tabml.plans import oracle as sq

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(c, name=None):
    return F.round(F.col(c) if isinstance(c, str) else c, 6).alias(name or c)


# ----------------------------------------------------------------- splits and folds

@query("split_random", f"""WITH {sq.split_random('SELECT o_orderkey FROM orders', 'o_orderkey')}
SELECT o_orderkey, is_test FROM s""")
def q_split_random(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey")
    return split.train_test_split(o, ["o_orderkey"], 0.2, 42).select("o_orderkey", "is_test")


@query("split_stratified", f"""WITH {sq.split_stratified('SELECT o_orderkey, o_orderstatus FROM orders', 'o_orderkey', 'o_orderstatus')}
SELECT o_orderkey, o_orderstatus, is_test FROM s""")
def q_split_stratified(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.train_test_split(o, ["o_orderkey"], 0.2, 42, stratify="o_orderstatus")


@query("kfold", f"""WITH {sq.kfold('SELECT o_orderkey FROM orders', 'o_orderkey')}
SELECT o_orderkey, fold FROM f""")
def q_kfold(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey")
    return split.kfold(o, ["o_orderkey"], 5, 42)


@query("kfold_stratified", f"""WITH {sq.kfold_stratified('SELECT o_orderkey, o_orderstatus FROM orders', 'o_orderkey', 'o_orderstatus')}
SELECT o_orderkey, o_orderstatus, fold FROM f""")
def q_kfold_stratified(spark, sf):
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.kfold(o, ["o_orderkey"], 5, 42, stratify="o_orderstatus")


# ----------------------------------------------------------------- KNN on embeddings

_EMB = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings"


def _emb_split(spark, sf):
    e = fx.table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    return split.train_test_split(e, ["vec_id"], 0.2, 42, stratify="label")


def _emb_neighbours(spark, sf, k=5, p=2, **kw):
    s = _emb_split(spark, sf)
    tr, te = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    return s, knn.neighbors(tr, te, "vec_id", "x", "label", k=k, p=p, **kw)


def _knn_sql(weights="uniform", p=2, k=5, tail="SELECT qk AS vec_id, prediction FROM pred"):
    return f"""WITH {sq.split_stratified(_EMB, 'vec_id', 'label')},
{sq.knn_neighbours('s', 'vec_id', 'x', 'label', k, p)},
{sq.knn_weights(weights)},
{sq.knn_vote()}
{tail}"""


@query("knn_classify", _knn_sql())
def q_knn_classify(spark, sf):
    _, nb = _emb_neighbours(spark, sf)
    return knn.vote(nb, "vec_id", 5)


@query("knn_classify_blocked", _knn_sql())
def q_knn_classify_blocked(spark, sf):
    """The same query through the blocked cogroup join (no broadcast, small blocks)."""
    _, nb = _emb_neighbours(spark, sf, block_rows=64, broadcast_bytes=0)
    return knn.vote(nb, "vec_id", 5)


@query("knn_classify_weighted", _knn_sql("distance"))
def q_knn_classify_weighted(spark, sf):
    _, nb = _emb_neighbours(spark, sf)
    return knn.vote(nb, "vec_id", 5, "distance")


@query("knn_manhattan", _knn_sql(p=1))
def q_knn_manhattan(spark, sf):
    _, nb = _emb_neighbours(spark, sf, p=1)
    return knn.vote(nb, "vec_id", 5)


@query("knn_proba", f"""WITH {sq.split_stratified(_EMB, 'vec_id', 'label')},
{sq.knn_neighbours('s', 'vec_id', 'x', 'label', 5, 2)},
{sq.knn_weights('distance')},
_v AS (SELECT qk, y, sum(w) AS w FROM wnb GROUP BY qk, y)
SELECT qk AS vec_id, y AS class, round(w / sum(w) OVER (PARTITION BY qk), 6) AS probability FROM _v""")
def q_knn_proba(spark, sf):
    _, nb = _emb_neighbours(spark, sf)
    return knn.proba(nb, "vec_id", 5, "distance").select("vec_id", "class", r6("probability"))


@query("knn_neighbours", f"""WITH {sq.split_stratified(_EMB, 'vec_id', 'label')},
{sq.knn_neighbours('s', 'vec_id', 'x', 'label', 11, 2)}
SELECT qk AS vec_id, CAST(rk AS INTEGER) AS nn_rank, tk AS nn_key, round(dist, 6) AS dist FROM nb""")
def q_knn_neighbours(spark, sf):
    _, nb = _emb_neighbours(spark, sf, k=11)
    return nb.select("vec_id", "nn_rank", "nn_key", r6("dist"))


_REPORT_COLS = "class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support"


@query("classification_report", _knn_sql(tail=f""",
_j AS (SELECT s.label AS y, pred.prediction AS yhat FROM s JOIN pred ON s.vec_id = pred.qk),
{sq.report('_j')}
SELECT {_REPORT_COLS} FROM rep"""))
def q_classification_report(spark, sf):
    s, nb = _emb_neighbours(spark, sf)
    pred = knn.vote(nb, "vec_id", 5)
    rep = metrics.classification_report(s.join(pred, "vec_id"), "label", "prediction")
    return rep.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


# ----------------------------------------------------------------- metrics on planted predictions (P8, P9)

def _p8(spark, sf):
    return fx.fixture(spark, sf, fx.P8, "orders")


def _p9(spark, sf):
    return fx.fixture(spark, sf, fx.P9, "orders")


@query("confusion_matrix", f"""WITH p AS ({fx.P8}),
_pc AS (SELECT y, yhat, count(*) AS n FROM p GROUP BY 1, 2),
_cl AS (SELECT y AS c FROM _pc UNION SELECT yhat FROM _pc)
SELECT a.c AS y, b.c AS yhat, CAST(coalesce(_pc.n, 0) AS BIGINT) AS n
FROM _cl a CROSS JOIN _cl b LEFT JOIN _pc ON _pc.y = a.c AND _pc.yhat = b.c""")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_p8(spark, sf), "y", "yhat")


@query("confusion_normalized", f"""WITH p AS ({fx.P8}),
_pc AS (SELECT y, yhat, count(*) AS n FROM p GROUP BY 1, 2),
_cl AS (SELECT y AS c FROM _pc UNION SELECT yhat FROM _pc),
g AS (SELECT a.c AS y, b.c AS yhat, coalesce(_pc.n, 0) AS n
      FROM _cl a CROSS JOIN _cl b LEFT JOIN _pc ON _pc.y = a.c AND _pc.yhat = b.c)
SELECT y, yhat, CAST(n AS BIGINT) AS n,
  round(CASE WHEN sum(n) OVER (PARTITION BY y) > 0 THEN n / sum(n) OVER (PARTITION BY y) ELSE 0.0 END, 6) AS share
FROM g""")
def q_confusion_normalized(spark, sf):
    cm = metrics.confusion_matrix(_p8(spark, sf), "y", "yhat", normalize=True)
    return cm.select("y", "yhat", "n", r6("share"))


@query("classification_report_p8", f"""WITH p AS ({fx.P8}),
{sq.report('p')}
SELECT {_REPORT_COLS} FROM rep""")
def q_report_p8(spark, sf):
    rep = metrics.classification_report(_p8(spark, sf), "y", "yhat")
    return rep.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


@query("scores_classification", f"""WITH p AS ({fx.P8}),
{sq.report('p')}
SELECT round(max(CASE WHEN class = 'accuracy' THEN f1 END), 6) AS accuracy,
       round(max(CASE WHEN class = 'weighted avg' THEN f1 END), 6) AS f1_weighted,
       round(max(CASE WHEN class = 'macro avg' THEN f1 END), 6) AS f1_macro,
       round(max(CASE WHEN class = 'weighted avg' THEN precision END), 6) AS precision_weighted,
       round(max(CASE WHEN class = 'weighted avg' THEN recall END), 6) AS recall_weighted
FROM rep""")
def q_scores_classification(spark, sf):
    s = metrics.classification_scores(_p8(spark, sf), "y", "yhat")
    return s.select(*[r6(c) for c in ("accuracy", "f1_weighted", "f1_macro", "precision_weighted",
                                      "recall_weighted")])


@query("eval_classifier", f"""WITH p AS ({fx.P8}),
{sq.split_random('SELECT * FROM p', 'o_orderkey')},
_tr AS (SELECT * FROM s WHERE NOT is_test), _te AS (SELECT * FROM s WHERE is_test)
SELECT 'y' AS target, split, metric, round(value, 6) AS value FROM (
  SELECT 'test' AS split, 'accuracy' AS metric, avg(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END) AS value FROM _te
  UNION ALL SELECT 'train', 'accuracy', avg(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END) FROM _tr
  UNION ALL SELECT split, 'f1_weighted', sum(n * CASE WHEN tp > 0 THEN 2.0 * tp / (n + m) ELSE 0.0 END) / sum(n) FROM (
    SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, c, count(*) FILTER (y = c) AS n, count(*) FILTER (yhat = c) AS m,
           count(*) FILTER (y = c AND yhat = c) AS tp
    FROM s, (SELECT y AS c FROM s UNION SELECT yhat FROM s) GROUP BY ALL) GROUP BY split)""")
def q_eval_classifier(spark, sf):
    s = split.train_test_split(_p8(spark, sf), ["o_orderkey"], 0.2, 42)
    ev = metrics.eval_classifier(s, "y", "yhat", split_col="is_test")
    return ev.select("target", "split", "metric", r6("value"))


_REG_SQL = """round(CASE WHEN var_pop(y) * count(*) > 0 THEN 1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*))
                  WHEN sum((yhat - y) * (yhat - y)) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2,
       round(avg((yhat - y) * (yhat - y)), 6) AS mse, round(avg(abs(yhat - y)), 6) AS mae"""


@query("scores_regression", f"""WITH p AS ({fx.P9}) SELECT {_REG_SQL} FROM p""")
def q_scores_regression(spark, sf):
    s = metrics.regression_scores(_p9(spark, sf), "y", "yhat")
    return s.select(r6("r2"), r6("mse"), r6("mae"))


@query("eval_regressor", f"""WITH p AS ({fx.P9}),
{sq.split_random('SELECT * FROM p', 'o_orderkey')},
u AS (SELECT 'test' AS split, {_REG_SQL} FROM s WHERE is_test
      UNION ALL SELECT 'train', {_REG_SQL} FROM s WHERE NOT is_test)
SELECT 'y' AS target, split, metric, value FROM u
UNPIVOT (value FOR metric IN (r2, mse, mae))""")
def q_eval_regressor(spark, sf):
    s = split.train_test_split(_p9(spark, sf), ["o_orderkey"], 0.2, 42)
    ev = metrics.eval_regressor(s, "y", "yhat", split_col="is_test")
    return ev.select("target", "split", "metric", r6("value"))


# ----------------------------------------------------------------- label maps (P1, P3)

@query("label_encode", f"""WITH p AS ({fx.P1})
SELECT p_partkey, y, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS y_code FROM p""")
def q_label_encode(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    m = target.fit_label_map(p, "y")
    return target.encode_labels(p, m, suffix="_code").select("p_partkey", "y", "y_code")


@query("label_encode_multi", f"""WITH p AS ({fx.P3})
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY y1) - 1 AS INTEGER) AS y1, y2 FROM p""")
def q_label_encode_multi(spark, sf):
    p = fx.fixture(spark, sf, fx.P3, "part")
    m = target.fit_label_map(p, ["y1", "y2"])  # y2 is numeric: left as is
    return target.encode_labels(p, m).select("p_partkey", "y1", "y2")


@query("label_decode", f"""WITH p AS ({fx.P1}),
c AS (SELECT p_partkey, y, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS code FROM p)
SELECT p_partkey, code, y AS label FROM c""")
def q_label_decode(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    m = target.fit_label_map(p, "y")
    enc = target.encode_labels(p, m, suffix="_code").select("p_partkey", F.col("y_code").alias("code"))
    return target.decode_labels(enc.withColumn("label", F.col("code")), m, {"label": "y"})


# ----------------------------------------------------------------- imputers and encoders (P4, P5)

@query("impute_median", f"""WITH p AS ({fx.P4})
SELECT p_partkey, CAST(coalesce(CAST(p_size AS DOUBLE), (SELECT median(p_size) FROM p)) AS DOUBLE) AS p_size FROM p""")
def q_impute_median(spark, sf):
    p = fx.fixture(spark, sf, fx.P4, "part")
    med = prep.fit_median(p, ["p_size"])
    return prep.impute(p.select("p_partkey", F.col("p_size").cast("double")), med)


@query("impute_mode", f"""WITH p AS ({fx.P4}),
m AS (SELECT p_type FROM p WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1)
SELECT p_partkey, coalesce(p.p_type, (SELECT p_type FROM m)) AS p_type FROM p""")
def q_impute_mode(spark, sf):
    p = fx.fixture(spark, sf, fx.P4, "part")
    mode = prep.fit_mode(p, ["p_type"])
    return prep.impute(p.select("p_partkey", "p_type"), mode)


@query("one_hot", f"""WITH fit AS ({fx.P5_FIT}), a AS ({fx.P5_ALL}),
c AS (SELECT DISTINCT p_type AS v FROM fit)
SELECT a.p_partkey, 'p_type_' || c.v AS feature, CAST(CASE WHEN a.p_type = c.v THEN 1 ELSE 0 END AS DOUBLE) AS value
FROM a, c""")
def q_one_hot(spark, sf):
    fit = fx.fixture(spark, sf, fx.P5_FIT, "part")
    allp = fx.fixture(spark, sf, fx.P5_ALL, "part")
    cats = prep.fit_categories(fit, "p_type")
    wide = allp.select("p_partkey", *prep.one_hot_exprs("p_type", "p_type", cats))
    names = [f"p_type_{v}" for v in cats]
    return wide.select("p_partkey", F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").alias("value")) for n in names])).alias("e")
    ).select("p_partkey", "e.feature", "e.value")


@query("ordinal_encode", f"""WITH fit AS ({fx.P5_FIT}), a AS ({fx.P5_ALL}),
c AS (SELECT p_type AS v, CAST(row_number() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT p_type FROM fit))
SELECT a.p_partkey, coalesce(c.code, -1.0) AS p_type FROM a LEFT JOIN c ON a.p_type = c.v""")
def q_ordinal_encode(spark, sf):
    fit = fx.fixture(spark, sf, fx.P5_FIT, "part")
    allp = fx.fixture(spark, sf, fx.P5_ALL, "part")
    cats = prep.fit_categories(fit, "p_type")
    return allp.select("p_partkey", prep.ordinal_expr("p_type", cats).alias("p_type"))


# ----------------------------------------------------------------- scalers and covariance

def _scaled(spark, sf, kind):
    fit = fx.fixture(spark, sf, fx.P5_FIT, "part")
    allp = fx.fixture(spark, sf, fx.P5_ALL, "part")
    cols = ["p_size", "const"]
    center, scale = prep.fit_scaler(fit.select(*[F.col(c).cast("double") for c in cols]), cols, kind)
    return allp.select("p_partkey", *[
        F.round((F.col(c) - F.lit(m)) / F.lit(s), 6).alias(c) for c, m, s in zip(cols, center, scale)])


def _scale_sql(center: str, scale: str) -> str:
    parts = []
    for c in ("p_size", "const"):
        ce, sc = center.format(c=c), scale.format(c=c)
        parts.append(f"round((a.{c} - ({ce})) / (CASE WHEN abs({sc}) < 2.220446049250313e-15 THEN 1.0 ELSE {sc} END), 6) AS {c}")
    return f"WITH fit AS ({fx.P5_FIT}), a AS ({fx.P5_ALL}) SELECT a.p_partkey, {', '.join(parts)} FROM a"


@query("scale_standard", _scale_sql("SELECT avg({c}) FROM fit", "(SELECT stddev_pop({c}) FROM fit)"))
def q_scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query("scale_minmax", _scale_sql("SELECT min({c}) FROM fit", "(SELECT CAST(max({c}) - min({c}) AS DOUBLE) FROM fit)"))
def q_scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query("scale_robust", _scale_sql(
    "SELECT quantile_cont({c}, 0.5) FROM fit",
    "(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM fit)"))
def q_scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


_COV_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sig10(x: float) -> float:
    """Round to 10 significant digits (both sides), the meaningful precision
    of a float covariance of large values."""
    import math
    return 0.0 if x == 0 else round(x, 9 - int(math.floor(math.log10(abs(x)))))


@query("covariance", "SELECT x, y, CASE WHEN cov = 0 THEN 0.0 ELSE round(cov, CAST(9 - floor(log10(abs(cov))) AS INTEGER)) END AS cov FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, covar_pop({a}, {b}) AS cov FROM lineitem"
    for a in _COV_COLS for b in _COV_COLS) + ")")
def q_covariance(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    cov = prep.covariance(li, _COV_COLS)
    rows = [(a, b, _sig10(float(cov[i, j]))) for i, a in enumerate(_COV_COLS) for j, b in enumerate(_COV_COLS)]
    return spark.createDataFrame(rows, "x string, y string, cov double")


# ----------------------------------------------------------------- roles

@query("column_roles", """SELECT CAST(ordinal_position - 1 AS INTEGER) AS pos, column_name AS name,
  CASE WHEN data_type IN ('VARCHAR', 'BOOLEAN') THEN 'categorical'
       WHEN data_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'FLOAT', 'DOUBLE') OR data_type LIKE 'DECIMAL%' THEN 'numeric'
       ELSE 'unsupported' END AS role
FROM information_schema.columns WHERE table_name = 'part'""")
def q_column_roles(spark, sf):
    return roles.infer_roles(fx.table(spark, sf, "part")).select("pos", "name", "role")


@query("select_xy", f"""WITH p AS ({fx.P1}) SELECT p_size, p_retailprice, p_type, y FROM p""")
def q_select_xy(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    r = roles.ColumnRoles.resolve(p, " y ", [" p_size", "p_retailprice ", "", "p_type"])
    return r.select(p)


@query("select_all_but_target", f"""WITH p AS ({fx.P1}) SELECT p_size, p_retailprice, p_type, p_brand, y FROM p""")
def q_select_all_but_target(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    r = roles.ColumnRoles.resolve(p, "y", None, key="p_partkey")
    return r.select(p)


@query("xy_shape", f"""WITH p AS ({fx.P3}) SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_features, CAST(2 AS BIGINT) AS n_targets FROM p""")
def q_xy_shape(spark, sf):
    p = fx.fixture(spark, sf, fx.P3, "part")
    r = roles.ColumnRoles.resolve(p, ["y1", "r1"], ["p_size", "p_retailprice", "p_type"])
    return roles.validate(p, r)


@query("align_columns", """SELECT p_partkey, p_type, p_size, p_retailprice FROM part""")
def q_align_columns(spark, sf):
    p = fx.table(spark, sf, "part")
    return roles.align(p, ["p_type", "p_size", "p_retailprice"], keep=["p_partkey"])


# ----------------------------------------------------------------- curves (P8: yb, score)

from tabml.operators import curves, diagnostics, trees  # noqa: E402

_CUM = f"""p AS ({fx.P8}),
_a AS (SELECT CAST(score AS DOUBLE) AS threshold, sum(yb) AS tp, sum(1 - yb) AS fp FROM p GROUP BY 1),
_t AS (SELECT CAST(sum(tp) AS DOUBLE) AS P, CAST(sum(fp) AS DOUBLE) AS N FROM _a),
c AS (SELECT threshold, tp, fp, sum(tp) OVER (ORDER BY threshold DESC) AS cum_tp,
             sum(fp) OVER (ORDER BY threshold DESC) AS cum_fp, P, N FROM _a, _t)"""


@query("roc_curve", f"""WITH {_CUM},
k AS (SELECT *, lead(tp) OVER (ORDER BY threshold DESC) AS ntp, lead(fp) OVER (ORDER BY threshold DESC) AS nfp,
             row_number() OVER (ORDER BY threshold DESC) AS rn FROM c)
SELECT threshold, round(cum_fp / N, 6) AS fpr, round(cum_tp / P, 6) AS tpr FROM k
WHERE rn = 1 OR ntp IS NULL OR ntp <> tp OR nfp <> fp
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_curve(spark, sf):
    return curves.roc_curve(_p8(spark, sf), "yb", "score").select("threshold", r6("fpr"), r6("tpr"))


@query("roc_curve_all_points", f"""WITH {_CUM}
SELECT threshold, round(cum_fp / N, 6) AS fpr, round(cum_tp / P, 6) AS tpr FROM c
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_curve_all_points(spark, sf):
    return curves.roc_curve(_p8(spark, sf), "yb", "score", drop_intermediate=False).select(
        "threshold", r6("fpr"), r6("tpr"))


@query("roc_auc", f"""WITH {_CUM}
SELECT round(sum(fp / N * (2 * cum_tp - tp) / (2 * P)), 6) AS auc FROM c""")
def q_roc_auc(spark, sf):
    return curves.roc_auc(_p8(spark, sf), "yb", "score").select(r6("auc"))


@query("pr_curve", f"""WITH {_CUM}
SELECT threshold, round(cum_tp / P, 6) AS recall, round(cum_tp / (cum_tp + cum_fp), 6) AS precision FROM c
UNION ALL SELECT NULL, 0.0, 1.0""")
def q_pr_curve(spark, sf):
    return curves.pr_curve(_p8(spark, sf), "yb", "score").select("threshold", r6("recall"), r6("precision"))


@query("pr_auc", f"""WITH {_CUM},
d AS (SELECT *, cum_tp - tp AS ptp, cum_tp - tp + cum_fp - fp AS pall FROM c)
SELECT round(sum(tp / P * (cum_tp / (cum_tp + cum_fp) + CASE WHEN pall > 0 THEN ptp / pall ELSE 1.0 END) / 2), 6) AS auc FROM d""")
def q_pr_auc(spark, sf):
    return curves.pr_auc(_p8(spark, sf), "yb", "score").select(r6("auc"))


def _hist_sql(src: str, grp: str, val: str, bins: int = 30) -> str:
    """CTE chain ending in relation ``h`` (grp, bin, lo, hi, n)."""
    return f"""_x AS (SELECT {grp} AS grp, CAST({val} AS DOUBLE) AS v FROM {src}),
_r AS (SELECT grp, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo0,
              CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi0 FROM _x GROUP BY grp),
_c AS (SELECT _x.grp, least({bins - 1}, CAST(floor((v - lo0) * (CAST({bins} AS DOUBLE) / (hi0 - lo0))) AS INTEGER)) AS bin,
              count(*) AS n FROM _x JOIN _r USING (grp) GROUP BY 1, 2),
_g AS (SELECT grp, lo0, hi0, CAST(b.i AS INTEGER) AS bin FROM _r, range({bins}) b(i)),
h AS (SELECT _g.grp, _g.bin, round(lo0 + bin * ((hi0 - lo0) / CAST({bins} AS DOUBLE)), 6) AS lo,
             round(CASE WHEN bin = {bins - 1} THEN hi0 ELSE lo0 + (bin + 1) * ((hi0 - lo0) / CAST({bins} AS DOUBLE)) END, 6) AS hi,
             CAST(coalesce(_c.n, 0) AS BIGINT) AS n FROM _g LEFT JOIN _c USING (grp, bin))"""


@query("score_histogram", f"""WITH p AS ({fx.P8}), {_hist_sql('p', 'y', 'score')}
SELECT grp AS class, bin, lo, hi, n FROM h""")
def q_score_histogram(spark, sf):
    h = curves.score_histogram(_p8(spark, sf), "y", "score")
    return h.select("class", "bin", r6("lo"), r6("hi"), "n")


# ----------------------------------------------------------------- residual diagnostics (P9)

@query("residual_stats", f"""WITH p AS ({fx.P9})
SELECT 'y' AS target, round(avg(y - yhat), 6) AS mean, round(stddev_pop(y - yhat), 6) AS std,
       round(avg(abs(y - yhat)), 6) AS mae, count(*) AS n FROM p""")
def q_residual_stats(spark, sf):
    s = diagnostics.residual_stats(_p9(spark, sf), "y", "yhat")
    return s.select("target", r6("mean"), r6("std"), r6("mae"), "n")


@query("residual_points", f"""WITH p AS ({fx.P9})
SELECT o_orderkey, round(y, 6) AS y, round(yhat, 6) AS yhat, round(y - yhat, 6) AS residual FROM p
ORDER BY md5(concat_ws(':', '42', CAST(o_orderkey AS VARCHAR))) LIMIT 5000""")
def q_residual_points(spark, sf):
    pts = diagnostics.residual_points(_p9(spark, sf), "y", "yhat", "o_orderkey", 5000, 42)
    return pts.select("o_orderkey", r6("y"), r6("yhat"), r6("residual"))


@query("residual_histogram", f"""WITH p AS ({fx.P9}), _rr AS (SELECT 'all' AS g, y - yhat AS residual FROM p),
{_hist_sql('_rr', 'g', 'residual')}
SELECT bin, lo, hi, n FROM h""")
def q_residual_histogram(spark, sf):
    h = diagnostics.residual_histogram(_p9(spark, sf), "y", "yhat")
    return h.select("bin", r6("lo"), r6("hi"), "n")


@query("diagonal_bounds", f"""WITH p AS ({fx.P9})
SELECT round(least(min(y), min(yhat)), 6) AS lo, round(greatest(max(y), max(yhat)), 6) AS hi FROM p""")
def q_diagonal_bounds(spark, sf):
    return diagnostics.diagonal_bounds(_p9(spark, sf), "y", "yhat").select(r6("lo"), r6("hi"))


# ----------------------------------------------------------------- trees (P7 stumps: exact in SQL)

def _stump(spark, sf, task: str, criterion: str, target_sql: str):
    p = fx.fixture(spark, sf, fx.P7, "lineitem").select(
        F.array("l_discount", "l_tax").alias("features"), F.expr(target_sql).cast("double").alias("t"))
    m = trees.TreeModel("tree", task, criterion=criterion, max_depth=1).fit(p, "t")
    from tabml.session import checkpoint_dir
    import uuid
    nodes = trees.tree_nodes(m.model, f"{checkpoint_dir(spark)}/stump-{uuid.uuid4().hex}", 0, 1)
    root = nodes.where("depth = 0").select("feature", "threshold", "gain", "left", "right")
    kids = nodes.where("depth = 1").select("id", "count", "prediction")
    l, r = kids.alias("l"), kids.alias("r")
    return (root.join(l, F.col("left") == F.col("l.id")).join(r, F.col("right") == F.col("r.id"))
                .select("feature", r6("threshold"), r6("gain"),
                        F.col("l.count").alias("left_n"), F.col("r.count").alias("right_n"),
                        r6(F.col("l.prediction"), "left_pred"), r6(F.col("r.prediction"), "right_pred")))


def _stump_sql(impurity: str, target_sql: str) -> str:
    if impurity == "gini":
        imp = lambda n, s: f"(1 - ({s}/{n})*({s}/{n}) - (({n}-{s})/{n})*(({n}-{s})/{n}))"
        pred = lambda n, s, q: f"CAST(CASE WHEN {s} > {n} - {s} THEN 1 ELSE 0 END AS DOUBLE)"
    elif impurity == "entropy":
        def ent(p):
            return f"(CASE WHEN {p} > 0 THEN -({p}) * ln({p}) / ln(2) ELSE 0 END)"
        imp = lambda n, s: f"({ent(f'{s}/{n}')} + {ent(f'({n}-{s})/{n}')})"
        pred = lambda n, s, q: f"CAST(CASE WHEN {s} > {n} - {s} THEN 1 ELSE 0 END AS DOUBLE)"
    else:
        imp = lambda n, s, q=None: f"(({q})/{n} - ({s}/{n})*({s}/{n}))"
        pred = lambda n, s, q: f"{s}/{n}"
    def I(n, s, q):  # noqa: E743
        return imp(n, s, q) if impurity == "variance" else imp(n, s)
    return f"""WITH p AS ({fx.P7}), pt AS (SELECT l_discount, l_tax, CAST({target_sql} AS DOUBLE) AS t FROM p),
feat AS (SELECT 0 AS feature, l_discount AS v, t FROM pt UNION ALL SELECT 1, l_tax, t FROM pt),
vc AS (SELECT feature, v, count(*) AS n, sum(t) AS s, sum(t * t) AS q FROM feat GROUP BY 1, 2),
cand AS (SELECT feature, (v + lead(v) OVER (PARTITION BY feature ORDER BY v)) / 2 AS thr,
                CAST(sum(n) OVER (PARTITION BY feature ORDER BY v) AS DOUBLE) AS nl,
                sum(s) OVER (PARTITION BY feature ORDER BY v) AS sl, sum(q) OVER (PARTITION BY feature ORDER BY v) AS ql FROM vc),
tot AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(t) AS s, sum(t * t) AS q FROM pt),
g AS (SELECT feature, thr, nl, sl, ql, tot.n - nl AS nr, tot.s - sl AS sr, tot.q - ql AS qr, tot.n AS n, tot.s AS st, tot.q AS qt
      FROM cand, tot WHERE thr IS NOT NULL),
sc AS (SELECT *, {I('n', 'st', 'qt')} - (nl / n) * {I('nl', 'sl', 'ql')} - (nr / n) * {I('nr', 'sr', 'qr')} AS gain FROM g),
best AS (SELECT * FROM sc ORDER BY gain DESC, feature, thr LIMIT 1)
SELECT CAST(feature AS INTEGER) AS feature, round(thr, 6) AS threshold, round(gain, 6) AS gain,
       CAST(nl AS BIGINT) AS left_n, CAST(nr AS BIGINT) AS right_n,
       round({pred('nl', 'sl', 'ql')}, 6) AS left_pred, round({pred('nr', 'sr', 'qr')}, 6) AS right_pred FROM best"""


@query("tree_stump_gini", _stump_sql("gini", "y"))
def q_tree_stump_gini(spark, sf):
    return _stump(spark, sf, "classification", "gini", "y")


@query("tree_stump_entropy", _stump_sql("entropy", "y"))
def q_tree_stump_entropy(spark, sf):
    return _stump(spark, sf, "classification", "entropy", "y")


@query("tree_stump_variance", _stump_sql("variance", "l_linenumber"))
def q_tree_stump_variance(spark, sf):
    return _stump(spark, sf, "regression", "squared_error", "l_linenumber")


@query("class_weights", """WITH c AS (SELECT quality, count(*) AS n_class FROM labels GROUP BY 1),
t AS (SELECT sum(n_class) AS n, count(*) AS k FROM c)
SELECT quality, n_class, round(CAST(n AS DOUBLE) / (k * n_class), 6) AS weight FROM c, t""")
def q_class_weights(spark, sf):
    w = trees.class_weight_table(fx.table(spark, sf, "labels"), "quality")
    return w.select("quality", "n_class", r6("weight"))


# ----------------------------------------------------------------- grid search (KNN, shared neighbour lists)

from tabml.operators import tuning  # noqa: E402

_CV_GRID = {"scaler": ["standard", "minmax", None], "n_neighbors": [3, 5], "weights": ["uniform", "distance"],
            "p": [2], "algorithm": ["auto"]}


def _cv_sql(scalers: list[str], cands: list[tuple[int, str]], kmax: int) -> str:
    """Oracle of the KNN grid search: stratified split, stratified folds of the
    training rows, per-fold scaling fitted on the other folds, exact k-NN."""
    eps = "2.220446049250313e-15"
    parts = []
    if "standard" in scalers:
        parts.append(f"""SELECT 'standard' AS scaler, l.vec_id, st.g,
               list((l.v - st.c) / (CASE WHEN abs(st.sd) < {eps} THEN 1.0 ELSE st.sd END) ORDER BY l.j) AS xs
        FROM _long l JOIN _st st ON st.j = l.j GROUP BY 1, 2, 3""")
    if "minmax" in scalers:
        parts.append(f"""SELECT 'minmax' AS scaler, l.vec_id, st.g,
               list((l.v - st.mn) / (CASE WHEN abs(st.mx - st.mn) < {eps} THEN 1.0 ELSE st.mx - st.mn END) ORDER BY l.j) AS xs
        FROM _long l JOIN _st st ON st.j = l.j GROUP BY 1, 2, 3""")
    if "none" in scalers:
        parts.append("SELECT 'none' AS scaler, f.vec_id, gg.i AS g, f.x AS xs FROM f, range(5) gg(i)")
    values = ", ".join(f"({k}, '{w}')" for k, w in cands)
    return f"""WITH {sq.split_stratified(_EMB, 'vec_id', 'label')},
_tr AS (SELECT vec_id, label, x FROM s WHERE NOT is_test),
{sq.kfold_stratified('SELECT * FROM _tr', 'vec_id', 'label')},
_long AS (SELECT vec_id, fold, unnest(range(1, len(x) + 1)) AS j, unnest(x) AS v FROM f),
_st AS (SELECT gg.i AS g, j, avg(v) AS c, stddev_pop(v) AS sd, min(v) AS mn, max(v) AS mx FROM _long, range(5) gg(i)
        WHERE _long.fold <> gg.i GROUP BY 1, 2),
_sx AS ({" UNION ALL ".join(parts)}),
_cq AS (SELECT sx.*, f.label FROM _sx sx JOIN f ON f.vec_id = sx.vec_id AND f.fold = sx.g),
_ct AS (SELECT sx.*, f.label FROM _sx sx JOIN f ON f.vec_id = sx.vec_id AND f.fold <> sx.g),
_d AS (SELECT q.scaler, q.g, q.vec_id AS qk, t.vec_id AS tk, t.label AS y, q.label AS ytrue,
              {sq.dist_expr('q.xs', 't.xs', 2)} AS dist FROM _cq q JOIN _ct t ON q.scaler = t.scaler AND q.g = t.g),
_nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scaler, g, qk ORDER BY dist, tk) AS rk FROM _d)
        WHERE rk <= {kmax}),
_cand AS (SELECT * FROM (VALUES {values}) v(k, weights)),
_cn AS (SELECT _nb.*, _cand.k, _cand.weights FROM _nb JOIN _cand ON _nb.rk <= _cand.k),
_z AS (SELECT *, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY scaler, g, qk, k, weights) AS z FROM _cn),
_w AS (SELECT *, CASE WHEN weights = 'uniform' THEN 1.0 WHEN z = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END
                      ELSE 1.0 / dist END AS w FROM _z),
_v AS (SELECT scaler, g, qk, k, weights, ytrue, y, sum(w) AS sw FROM _w GROUP BY ALL),
_p AS (SELECT scaler, g, qk, k, weights, any_value(ytrue) AS ytrue, arg_min(y, (-sw, y)) AS pred
       FROM _v GROUP BY scaler, g, qk, k, weights),
_sc AS (SELECT scaler, k, weights, g, avg(CASE WHEN pred = ytrue THEN 1.0 ELSE 0.0 END) AS score FROM _p GROUP BY ALL),
_r AS (SELECT scaler, k, weights, avg(score) AS m, stddev_pop(score) AS sd FROM _sc GROUP BY ALL)
SELECT scaler, CAST(2 AS DOUBLE) AS p, CAST(k AS INTEGER) AS n_neighbors, weights, 'auto' AS algorithm,
       round(m, 6) AS mean_test_score, round(sd, 6) AS std_test_score,
       CAST(rank() OVER (ORDER BY round(m, 10) DESC) AS INTEGER) AS rank_test_score FROM _r"""


_CV_SQL = _cv_sql(["standard", "minmax", "none"], [(3, "uniform"), (3, "distance"), (5, "uniform"), (5, "distance")], 5)


@query("cv_knn", _CV_SQL)
def q_cv_knn(spark, sf):
    s = _emb_split(spark, sf)
    rep = tuning.knn_grid_search(s.where(~F.col("is_test")), "vec_id", "x", "label", "classification",
                                 folds=5, seed=42, grid=_CV_GRID, scoring="accuracy")
    return rep.select("scaler", "p", "n_neighbors", "weights", "algorithm", r6("mean_test_score"),
                      r6("std_test_score"), "rank_test_score")


_P3_NULLS = """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size END AS p_size, p_retailprice,
       CASE WHEN p_size <= 25 THEN 'small' ELSE 'large' END AS y1, CASE WHEN p_retailprice < 950 THEN 0 ELSE 1 END AS y2
FROM part"""


@query("cv_multi_target", f"""WITH p AS ({_P3_NULLS}), {sq.split_random('SELECT * FROM p', 'p_partkey')},
_tr AS (SELECT * EXCLUDE (is_test) FROM s WHERE NOT is_test),
{sq.kfold('SELECT * FROM _tr', 'p_partkey')},
_fill AS (SELECT gg.i AS g, median(p_size) AS ps, median(p_retailprice) AS pr FROM f, range(5) gg(i) WHERE f.fold <> gg.i GROUP BY 1),
_x AS (SELECT f.p_partkey, f.fold, g, [CAST(coalesce(p_size, ps) AS DOUBLE), CAST(coalesce(p_retailprice, pr) AS DOUBLE)] AS x FROM f, _fill),
_long AS (SELECT p_partkey, fold, g, unnest(range(1, 3)) AS j, unnest(x) AS v FROM _x),
_st AS (SELECT g, j, avg(v) AS c, stddev_pop(v) AS sd FROM _long WHERE fold <> g GROUP BY 1, 2),
_sx AS (SELECT p_partkey, any_value(fold) AS fold, l.g, list((v - c) / sd ORDER BY l.j) AS xs
        FROM _long l JOIN _st USING (g, j) GROUP BY p_partkey, l.g),
_d AS (SELECT a.g, a.p_partkey AS qk, b.p_partkey AS tk, {sq.dist_expr('a.xs', 'b.xs')} AS dist
       FROM _sx a JOIN _sx b ON a.g = b.g AND a.fold = a.g AND b.fold <> b.g),
_nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g, qk ORDER BY dist, tk) AS rk FROM _d) WHERE rk <= 7),
_n AS (SELECT _nb.g, qk, tk, k, CASE WHEN weights = 'uniform' THEN 1.0 WHEN min(dist) OVER (PARTITION BY g, qk) = 0
              THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END AS w, weights
       FROM _nb JOIN (VALUES (3, 'uniform'), (7, 'uniform'), (3, 'distance'), (7, 'distance')) c(k, weights) ON rk <= k),
_l AS (SELECT p_partkey, 'y1' AS t, y1 AS y FROM f UNION ALL SELECT p_partkey, 'y2', CAST(y2 AS VARCHAR) FROM f),
_v AS (SELECT g, qk, k, weights, t, y, sum(w) AS sw FROM _n JOIN _l ON _l.p_partkey = tk GROUP BY ALL),
_p AS (SELECT g, qk, k, weights, t, arg_min(y, (-sw, y)) AS pred FROM _v GROUP BY ALL),
_s AS (SELECT g, k, weights, _p.t AS t, avg(CASE WHEN pred = y THEN 1.0 ELSE 0.0 END) AS a FROM _p JOIN _l ON _l.p_partkey = qk AND _l.t = _p.t
       GROUP BY g, k, weights, _p.t),
_f AS (SELECT g, k, weights, avg(a) AS score FROM _s GROUP BY ALL),
_r AS (SELECT k, weights, avg(score) AS m, stddev_pop(score) AS sd FROM _f GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS n_neighbors, weights, round(m, 6) AS mean_test_score, round(sd, 6) AS std_test_score,
       CAST(rank() OVER (ORDER BY round(m, 10) DESC) AS INTEGER) AS rank_test_score FROM _r""")
def q_cv_multi_target(spark, sf):
    """KNN grid search over two targets at once, through raw columns with nulls:
    per-fold imputing and scaling, unstratified folds, mean over the targets."""
    s = split.train_test_split(fx.fixture(spark, sf, _P3_NULLS, "part"), ["p_partkey"], 0.2, 42)
    rep = tuning.knn_grid_search(s.where(~F.col("is_test")), "p_partkey", ["p_size", "p_retailprice"], ["y1", "y2"],
                                 folds=5, seed=42, scoring="accuracy",
                                 grid={"scaler": ["standard"], "n_neighbors": [3, 7], "weights": ["uniform", "distance"],
                                       "p": [2], "algorithm": ["auto"]})
    return rep.select("n_neighbors", "weights", r6("mean_test_score"), r6("std_test_score"), "rank_test_score")


_SMALL = "SELECT vec_id, label, list_transform(embedding, lambda e: CAST(e AS DOUBLE) * 1e-9) AS x FROM embeddings"


@query("knn_small_scale", f"""WITH {sq.split_random(_SMALL, 'vec_id')},
{sq.knn_neighbours('s', 'vec_id', 'x', 'label', 5)}
SELECT qk AS vec_id, CAST(rk AS INTEGER) AS nn_rank, tk AS nn_key, round(dist * 1e9, 6) AS dist_1e9 FROM nb""")
def q_knn_small_scale(spark, sf):
    """Nearest neighbours of embeddings shrunk to 1e-9: order and distances keep their digits."""
    e = fx.table(spark, sf, "embeddings").select("vec_id", "label", F.transform(
        F.col("embedding").cast("array<double>"), lambda v: v * F.lit(1e-9)).alias("x"))
    s = split.train_test_split(e, ["vec_id"], 0.2, 42)
    nb = knn.neighbors(s.where(~F.col("is_test")), s.where(F.col("is_test")), "vec_id", "x", "label", k=5)
    return nb.select("vec_id", F.col("nn_rank").cast("int").alias("nn_rank"), "nn_key", F.round(F.col("dist") * 1e9, 6).alias("dist_1e9"))


_P9_NULLS = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE y END AS y,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE yhat END AS yhat FROM ({fx.P9}) _p"""


@query("scores_nulls", f"""WITH a AS ({_P9_NULLS}), p AS (SELECT * FROM a WHERE y IS NOT NULL AND yhat IS NOT NULL)
SELECT {_REG_SQL}, count(*) AS n, (SELECT count(*) FROM a) - count(*) AS dropped FROM p""")
def q_scores_nulls(spark, sf):
    """Regression scores where targets and predictions are missing: the same rows in every figure."""
    s = metrics.regression_scores(fx.fixture(spark, sf, _P9_NULLS, "orders"), "y", "yhat")
    return s.select(r6("r2"), r6("mse"), r6("mae"), "n", "dropped")


_F1_FOLDS = """SELECT o_orderkey % 5 AS fold, CASE WHEN o_orderkey % 5 = 3 THEN 0 WHEN o_orderkey % 5 = 4 THEN 1
            ELSE CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END END AS y,
       CASE WHEN o_orderkey % 10 < 6 THEN CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END ELSE 0 END AS yhat FROM orders"""


@query("scores_f1_binary", f"""WITH p AS ({_F1_FOLDS})
SELECT fold, round(CASE WHEN count(*) FILTER (y = 1 AND yhat = 1) > 0
  THEN 2.0 * count(*) FILTER (y = 1 AND yhat = 1) / (count(*) FILTER (y = 1) + count(*) FILTER (yhat = 1)) ELSE 0.0 END, 6) AS score
FROM p GROUP BY fold""")
def q_scores_f1_binary(spark, sf):
    """Binary F1 per fold, two of the folds holding one class only."""
    p = fx.fixture(spark, sf, _F1_FOLDS, "orders")
    return metrics.score_by(p, "y", "yhat", "f1", ["fold"], metrics.positive_label(p, "y")).select("fold", r6("score"))


# ----------------------------------------------------------------- preprocessing matrix and names (P1)

_P1_FEATS = ["p_size", "p_retailprice", "p_type"]


@query("preprocess_matrix", f"""WITH p AS ({fx.P1}), {sq.std_matrix('p', 'p', 'p_partkey', ['p_size', 'p_retailprice'], 'p_type')}
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS idx, round(xs[i], 6) AS value
FROM mx, range(1, len(xs) + 1) t(i)""")
def q_preprocess_matrix(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    pm = prep.Preprocess(scaler="standard").fit(p, _P1_FEATS)
    x = pm.transform(p, keep=["p_partkey"])
    return x.select("p_partkey", F.posexplode("features").alias("idx", "value")).select(
        "p_partkey", "idx", r6("value"))


@query("feature_names", f"""WITH p AS ({fx.P1})
SELECT 0 AS idx, 'p_size' AS name UNION ALL SELECT 1, 'p_retailprice'
UNION ALL SELECT CAST(1 + row_number() OVER (ORDER BY v) AS INTEGER), 'p_type_' || v FROM (SELECT DISTINCT p_type AS v FROM p)""")
def q_feature_names(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    names = prep.Preprocess().fit(p, _P1_FEATS).feature_names()
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


# ----------------------------------------------------------------- KNN with preprocessing (P2, P3)

@query("knn_regress", f"""WITH p AS ({fx.P2}), {sq.split_random('SELECT * FROM p', 'p_partkey')},
_fit AS (SELECT * FROM s WHERE NOT is_test),
{sq.std_matrix('s', '_fit', 'p_partkey', ['p_size', 'p_retailprice'], 'p_type')},
_x AS (SELECT s.p_partkey, s.y, s.is_test, mx.xs FROM s JOIN mx USING (p_partkey)),
_d AS (SELECT a.p_partkey AS qk, b.p_partkey AS tk, b.y AS y, {sq.dist_expr('a.xs', 'b.xs')} AS dist
       FROM _x a JOIN _x b ON a.is_test AND NOT b.is_test),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY dist, tk) AS rk FROM _d) WHERE rk <= 5)
SELECT qk AS p_partkey, round(avg(y), 6) AS prediction FROM nb GROUP BY qk""")
def q_knn_regress(spark, sf):
    p = fx.fixture(spark, sf, fx.P2, "part")
    s = split.train_test_split(p, ["p_partkey"], 0.2, 42)
    pm = prep.Preprocess(scaler="standard").fit(s.where(~F.col("is_test")), _P1_FEATS)
    x = pm.transform(s, keep=["p_partkey", "is_test", "y"])
    nb = knn.neighbors(x.where(~F.col("is_test")), x.where(F.col("is_test")), "p_partkey", "features", "y", k=5)
    return knn.regress(nb, "p_partkey", 5).select("p_partkey", r6("prediction"))


@query("knn_multi_target", f"""WITH p AS ({fx.P3}), {sq.split_random('SELECT * FROM p', 'p_partkey')},
_x AS (SELECT p_partkey, y1, y2, is_test, list_value(CAST(p_size AS DOUBLE), p_retailprice) AS xs FROM s),
_d AS (SELECT a.p_partkey AS qk, b.p_partkey AS tk, b.y1, b.y2, {sq.dist_expr('a.xs', 'b.xs')} AS dist
       FROM _x a JOIN _x b ON a.is_test AND NOT b.is_test),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY dist, tk) AS rk FROM _d) WHERE rk <= 5),
v1 AS (SELECT qk, y1 AS y, count(*) AS w FROM nb GROUP BY 1, 2),
v2 AS (SELECT qk, y2 AS y, count(*) AS w FROM nb GROUP BY 1, 2)
SELECT qk AS p_partkey, 'y1' AS target, arg_min(y, (-w, y)) AS prediction FROM v1 GROUP BY qk
UNION ALL SELECT qk, 'y2', CAST(arg_min(y, (-w, y)) AS VARCHAR) FROM v2 GROUP BY qk""")
def q_knn_multi_target(spark, sf):
    p = fx.fixture(spark, sf, fx.P3, "part")
    s = split.train_test_split(p, ["p_partkey"], 0.2, 42).withColumn(
        "x", F.array(F.col("p_size").cast("double"), F.col("p_retailprice")))
    tr, te = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    nb = knn.neighbors(tr, te, "p_partkey", "x", None, k=5)
    labels = tr.select(F.col("p_partkey").alias("nn_key"), "y1", "y2")
    nbl = nb.drop("nn_label").join(labels, "nn_key")
    outs = []
    for t in ("y1", "y2"):
        pr = knn.vote(nbl.select("p_partkey", "nn_rank", "dist", F.col(t).alias("nn_label")), "p_partkey", 5)
        outs.append(pr.select("p_partkey", F.lit(t).alias("target"), F.col("prediction").cast("string")))
    return outs[0].unionByName(outs[1])


# ----------------------------------------------------------------- profile, multi-target scores, CV without a grid

from tabml.sources import io as tio  # noqa: E402

_PROFILE_COLS = [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True),
                 ("c_mktsegment", False)]


@query("profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct",
       {f'round(CAST(min({c}) AS DOUBLE), 6)' if num else 'CAST(NULL AS DOUBLE)'} AS min,
       {f'round(CAST(max({c}) AS DOUBLE), 6)' if num else 'CAST(NULL AS DOUBLE)'} AS max,
       {f'round(avg({c}), 6)' if num else 'CAST(NULL AS DOUBLE)'} AS mean,
       {f'round(stddev_samp({c}), 6)' if num else 'CAST(NULL AS DOUBLE)'} AS std FROM customer"""
    for c, num in _PROFILE_COLS) + ")")
def q_profile(spark, sf):
    df = tio.read_table(spark, f"{sf}/customer.parquet")
    return tio.profile(df, exact_distinct=True).select("column", "n", "nulls", "distinct", r6("min"), r6("max"), r6("mean"), r6("std"))


_P8_TWO = f"""SELECT o_orderkey, y, yhat, CAST(yb AS STRING) AS yb, CASE WHEN score >= 0.5 THEN '1' ELSE '0' END AS ybhat
FROM ({fx.P8}) q"""


@query("scores_multi", f"""WITH p AS ({_P8_TWO}),
_a AS (SELECT 'y' AS target, y AS t, yhat AS h FROM p UNION ALL SELECT 'yb', yb, ybhat FROM p),
_pc AS (SELECT target, t, h, count(*) AS n FROM _a GROUP BY 1, 2, 3),
_cl AS (SELECT target, t AS c FROM _pc UNION SELECT target, h FROM _pc),
_pcl AS (SELECT _cl.target, _cl.c,
          coalesce((SELECT sum(n) FROM _pc WHERE _pc.target = _cl.target AND _pc.t = _cl.c AND _pc.h = _cl.c), 0) AS tp,
          coalesce((SELECT sum(n) FROM _pc WHERE _pc.target = _cl.target AND _pc.t = _cl.c), 0) AS support,
          coalesce((SELECT sum(n) FROM _pc WHERE _pc.target = _cl.target AND _pc.h = _cl.c), 0) AS predicted FROM _cl),
_pr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM _pcl),
_f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM _pr),
_s AS (SELECT target, sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1_weighted FROM _f GROUP BY target),
_l AS (SELECT target, 'accuracy' AS metric, accuracy AS value FROM _s UNION ALL SELECT target, 'f1_weighted', f1_weighted FROM _s)
SELECT target, 'all' AS split, metric, round(value, 6) AS value FROM _l
UNION ALL SELECT 'mean', 'all', metric, round(avg(value), 6) FROM _l GROUP BY metric""")
def q_scores_multi(spark, sf):
    p = fx.fixture(spark, sf, _P8_TWO, "orders")
    e1 = metrics.eval_classifier(p, "y", "yhat", target="y")
    e2 = metrics.eval_classifier(p, "yb", "ybhat", target="yb")
    return metrics.eval_multi(e1.unionByName(e2)).select("target", "split", "metric", r6("value"))


# ----------------------------------------------------------------- model fits without an SQL oracle (invariants in tests/)

from tabml.operators import score as score_op  # noqa: E402
from tabml.operators import svm as svm_op  # noqa: E402
from tabml.plans.train import train as train_entry  # noqa: E402


def _p1_split(spark, sf, stratify=True):
    p = fx.fixture(spark, sf, fx.P1, "part")
    s = split.train_test_split(p, ["p_partkey"], 0.2, 42, stratify="y" if stratify else None)
    pm = prep.Preprocess(cat_encoder="ordinal").fit(s.where(~F.col("is_test")), _P1_FEATS)
    return pm, pm.transform(s, keep=["p_partkey", "is_test", "y"])


def _tree_pred(spark, sf, kind, task):
    if task == "classification":
        _, x = _p1_split(spark, sf)
        params = dict(max_depth=3) if kind == "tree" else dict(max_depth=5, n_estimators=100)
    else:
        p = fx.fixture(spark, sf, fx.P2, "part")
        s = split.train_test_split(p, ["p_partkey"], 0.2, 42)
        pm = prep.Preprocess(cat_encoder="ordinal").fit(s.where(~F.col("is_test")), _P1_FEATS)
        x = pm.transform(s, keep=["p_partkey", "is_test", "y"])
        params = dict(max_depth=8) if kind == "tree" else dict(max_depth=8, n_estimators=100)
    m = trees.TreeModel(kind, task, **params).fit(x.where(~F.col("is_test")), "y")
    return m, m.predict(x.where(F.col("is_test"))).select("p_partkey", "y", "prediction")


@query("tree_classify")
def q_tree_classify(spark, sf):
    return _tree_pred(spark, sf, "tree", "classification")[1]


@query("forest_classify")
def q_forest_classify(spark, sf):
    return _tree_pred(spark, sf, "forest", "classification")[1]


@query("tree_regress")
def q_tree_regress(spark, sf):
    return _tree_pred(spark, sf, "tree", "regression")[1]


@query("forest_regress")
def q_forest_regress(spark, sf):
    return _tree_pred(spark, sf, "forest", "regression")[1]


@query("feature_importance")
def q_feature_importance(spark, sf):
    pm, x = _p1_split(spark, sf)
    m = trees.TreeModel("tree", "classification", max_depth=3).fit(x.where(~F.col("is_test")), "y")
    return trees.feature_importance(m.model, pm.feature_names())


@query("tree_nodes")
def q_tree_nodes(spark, sf):
    import uuid
    from tabml.session import checkpoint_dir
    _, x = _p1_split(spark, sf)
    m = trees.TreeModel("forest", "classification", max_depth=5).fit(x.where(~F.col("is_test")), "y")
    return trees.tree_nodes(m.model, f"{checkpoint_dir(spark)}/nodes-{uuid.uuid4().hex}", tree_index=1, max_depth=3)


@query("pca_two", """WITH m AS (SELECT avg(l_quantity) AS ma, stddev_pop(l_quantity) AS sa, avg(l_extendedprice) AS mb, stddev_pop(l_extendedprice) AS sb FROM lineitem),
z AS (SELECT l_orderkey, l_linenumber, (l_quantity - ma) / sa AS a, (l_extendedprice - mb) / sb AS b FROM lineitem, m)
SELECT l_orderkey, l_linenumber, round(abs(a + CASE WHEN r < 0 THEN -b ELSE b END) / sqrt(2), 5) AS pc0,
       round(abs(a - CASE WHEN r < 0 THEN -b ELSE b END) / sqrt(2), 5) AS pc1
FROM z, (SELECT corr(l_quantity, l_extendedprice) AS r FROM lineitem)""")
def q_pca_two(spark, sf):
    """PCA of two standardised columns, whose components have a closed form (up to their sign)."""
    li = fx.table(spark, sf, "lineitem")
    pm = prep.Preprocess(scaler="standard", pca=2).fit(li, ["l_quantity", "l_extendedprice"])
    x = pm.transform(li, keep=["l_orderkey", "l_linenumber"])
    return x.select("l_orderkey", "l_linenumber", *[F.round(F.abs(F.col("features")[i]), 5).alias(f"pc{i}") for i in range(2)])


@query("pca")
def q_pca(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    pm = prep.Preprocess(scaler="standard", pca=2).fit(li, _COV_COLS)
    x = pm.transform(li, keep=["l_orderkey", "l_linenumber"])
    return x.select("l_orderkey", "l_linenumber", F.col("features")[0].alias("pc0"), F.col("features")[1].alias("pc1"))


def _p6(spark, sf):
    p6 = fx.fixture(spark, sf, fx.P6_SPARK, "embeddings").select(
        "vec_id", F.col("y").cast("string").alias("y"), F.col("embedding").cast("array<double>").alias("x"))
    return split.train_test_split(p6, ["vec_id"], 0.2, 42, stratify="y")


def _svc(spark, sf, kernel, probability=False):
    s = _p6(spark, sf)
    m = svm_op.SVC(C=1.0, kernel=kernel, probability=probability).fit(s.where(~F.col("is_test")), "y", "x",
                                                                      key="vec_id")
    return m, s


@query("svc_linear")
def q_svc_linear(spark, sf):
    m, s = _svc(spark, sf, "linear")
    return m.predict(s.where(F.col("is_test"))).select("vec_id", "y", "prediction")


@query("svc_rbf")
def q_svc_rbf(spark, sf):
    m, s = _svc(spark, sf, "rbf")
    return m.predict(s.where(F.col("is_test"))).select("vec_id", "y", "prediction")


@query("svc_proba")
def q_svc_proba(spark, sf):
    m, s = _svc(spark, sf, "linear", probability=True)
    return m.predict(s.where(F.col("is_test"))).select("vec_id", "y", "prediction",
                                                       F.col("probability")[1].alias("p_true"))


@query("svm_insight")
def q_svm_insight(spark, sf):
    m, s = _svc(spark, sf, "linear")
    return svm_op.svm_insight(m, s.where(~F.col("is_test")), "vec_id")


def _svr(spark, sf, kernel):
    p = fx.fixture(spark, sf, fx.P2, "part")
    s = split.train_test_split(p, ["p_partkey"], 0.2, 42)
    pm = prep.Preprocess(scaler="standard").fit(s.where(~F.col("is_test")), _P1_FEATS)
    x = pm.transform(s, keep=["p_partkey", "is_test", "y"])
    m = svm_op.SVR(C=10.0, epsilon=0.1, kernel=kernel).fit(x.where(~F.col("is_test")), "y", key="p_partkey")
    return m.predict(x.where(F.col("is_test"))).select("p_partkey", "y", "prediction")


@query("svr_linear")
def q_svr_linear(spark, sf):
    return _svr(spark, sf, "linear")


@query("svr_rbf")
def q_svr_rbf(spark, sf):
    return _svr(spark, sf, "rbf")


@query("svr_objective", f"""WITH {sq.tube_scan("SELECT CAST(p_size AS DOUBLE) / 10 AS z, CAST(p_retailprice AS DOUBLE) / 10 + p_partkey * 37 % 11 AS y FROM part", 1.0, 0.5)}
SELECT (SELECT count(*) FROM d) AS n, round(f / (SELECT count(*) FROM d), 6) AS objective_per_row, round(w, 4) AS coef, true AS converged
FROM best""")
def q_svr_objective(spark, sf):
    """The optimum of the absolute epsilon-insensitive loss on one feature: the
    oracle scans the coefficient, with the best intercept (a median) for each."""
    d = fx.table(spark, sf, "part").select(
        "p_partkey", F.array(F.col("p_size").cast("double") / 10).alias("z"),
        (F.col("p_retailprice").cast("double") / 10 + F.col("p_partkey") * 37 % 11).alias("y"))
    m = svm_op.SVR(C=1.0, epsilon=0.5, kernel="linear", tol=1e-9).fit(d, "y", "z")
    n = d.count()
    row = (n, round(float(m.objective_) / n, 6), round(float(m.coef_[0]), 4), m.converged_)
    return spark.createDataFrame([row], "n long, objective_per_row double, coef double, converged boolean")


@query("svc_proba_coupled")
def q_svc_proba_coupled(spark, sf):
    """Pairwise coupled probabilities of three classes, held-out rows."""
    s = split.train_test_split(fx.fixture(spark, sf, fx.P1, "part"), ["p_partkey"], 0.2, 42, stratify="y")
    pm = prep.Preprocess(scaler="standard").fit(s.where(~F.col("is_test")), _P1_FEATS)
    x = pm.transform(s, keep=["p_partkey", "is_test", "y"])
    m = svm_op.SVC(C=1.0, kernel="linear", probability=True).fit(x.where(~F.col("is_test")), "y", key="p_partkey")
    return m.predict(x.where(F.col("is_test"))).select(
        "p_partkey", "y", "prediction", *[F.col("probability")[i].alias(f"p_{c}") for i, c in enumerate(m.classes_)])


@query("save_load_roundtrip", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM part")
def q_save_load_roundtrip(spark, sf):
    """Predictions of a saved-then-loaded bundle against the in-memory one:
    one row with the number of rows and of disagreements (expected 0)."""
    import uuid
    from tabml.session import checkpoint_dir
    from tabml.sources import store
    p = fx.fixture(spark, sf, fx.P1, "part")
    r = train_entry(p, "p_partkey", "y", _P1_FEATS, "tree_classifier", max_depth=3)
    path = f"{checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    store.save_model(r.bundle, path)
    b = store.load_model(path)
    a = score_op.predict(r.bundle, p).select("p_partkey", F.col("pred_y").alias("a"))
    c = score_op.predict(b, p).select("p_partkey", F.col("pred_y").alias("b"))
    return a.join(c, "p_partkey").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum((F.col("a") != F.col("b")).cast("long")).alias("mismatches"))


@query("list_datasets")
def q_list_datasets(spark, sf):
    return tio.list_datasets(spark, sf, "*.parquet").select("path", "size")


@query("cv_tree")
def q_cv_tree(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    s = split.train_test_split(p, ["p_partkey"], 0.2, 42, stratify="y")

    def make(**params):
        return trees.TreeModel("tree", "classification", **params)
    rep = tuning.fold_grid_search(s.where(~F.col("is_test")), "p_partkey", _P1_FEATS, "y", make,
                                  {"criterion": ["gini", "entropy"], "max_depth": [2, 3]}, "classification",
                                  folds=3, seed=42, prep_params={"cat_encoder": "ordinal"})
    return rep.select("params", "mean_test_score", "std_test_score", "rank_test_score")


# ----------------------------------------------------------------- train entry, batch scoring, preview (KNN, exact)

_KNN_PIPE = f"""p AS ({fx.P1}),
_lab AS (SELECT y AS label, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT y FROM p)),
e AS (SELECT p.p_partkey, p.p_size, p.p_retailprice, p.p_type, _lab.code AS y FROM p JOIN _lab ON p.y = _lab.label),
{sq.split_stratified('SELECT * FROM e', 'p_partkey', 'y')},
_fit AS (SELECT * FROM s WHERE NOT is_test),
{sq.std_matrix('s', '_fit', 'p_partkey', ['p_size', 'p_retailprice'], 'p_type')},
_x AS (SELECT s.p_partkey, s.y, s.is_test, mx.xs FROM s JOIN mx USING (p_partkey)),
_d AS (SELECT a.p_partkey AS qk, a.is_test, a.y AS ytrue, b.p_partkey AS tk, b.y AS y,
              {sq.dist_expr('a.xs', 'b.xs')} AS dist FROM _x a JOIN _x b ON NOT b.is_test),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY dist, tk) AS rk FROM _d) WHERE rk <= 5),
_v AS (SELECT qk, is_test, ytrue, y, count(*) AS w FROM nb GROUP BY ALL),
_p AS (SELECT qk, any_value(is_test) AS is_test, any_value(ytrue) AS t, arg_min(y, (-w, y)) AS h FROM _v GROUP BY qk)"""


def _train_knn(spark, sf):
    p = fx.fixture(spark, sf, fx.P1, "part")
    return train_entry(p, "p_partkey", "y", _P1_FEATS, "knn_classifier", scaler="standard")


@query("train_summary", f"""WITH {_KNN_PIPE},
{sq.scores_by('_p', "CASE WHEN is_test THEN 'test' ELSE 'train' END")}
SELECT 'y' AS target, g AS split, 'accuracy' AS metric, round(accuracy, 6) AS value FROM _sc
UNION ALL SELECT 'y', g, 'f1_weighted', round(f1_weighted, 6) FROM _sc""")
def q_train_summary(spark, sf):
    r = _train_knn(spark, sf)
    return r.evaluation.select("target", "split", "metric", r6("value"))


_BATCH_SQL = f"""WITH {_KNN_PIPE}
SELECT _p.qk AS p_partkey, _lab.label AS pred_y FROM _p JOIN _lab ON _p.h = _lab.code"""


def _batch(spark, sf):
    import uuid
    from tabml.session import checkpoint_dir
    from tabml.sources import store
    r = _train_knn(spark, sf)
    path = f"{checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    store.save_model(r.bundle, path)
    b = store.load_model(path)
    return score_op.predict(b, fx.table(spark, sf, "part")).select("p_partkey", "pred_y")


@query("batch_score", _BATCH_SQL)
def q_batch_score(spark, sf):
    return _batch(spark, sf)


@query("prediction_preview", f"""SELECT * FROM ({_BATCH_SQL}) ORDER BY p_partkey LIMIT 10""")
def q_prediction_preview(spark, sf):
    return roles.preview(_batch(spark, sf), "p_partkey", 10)


# ----------------------------------------------------------------- streaming scoring

from tabml.streaming import score as stream_score  # noqa: E402


@query("stream_score", _BATCH_SQL)
def q_stream_score(spark, sf):
    """The part table read as a file stream, scored micro-batch by micro-batch
    (foreachBatch) with the trained KNN bundle; the parquet sink is read back."""
    import uuid
    from tabml.session import checkpoint_dir
    r = _train_knn(spark, sf)
    part = fx.table(spark, sf, "part")
    stream = (spark.readStream.schema(part.schema).option("pathGlobFilter", "part.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf))
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = stream_score.score_stream(r.bundle, stream, f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("p_partkey", "pred_y")


@query("cv_no_grid", _cv_sql(["none"], [(5, "uniform")], 5))
def q_cv_no_grid(spark, sf):
    """Cross-validation of one fixed candidate (no grid): the same report."""
    s = _emb_split(spark, sf)
    rep = tuning.knn_grid_search(s.where(~F.col("is_test")), "vec_id", "x", "label", "classification",
                                 folds=5, seed=42, scoring="accuracy",
                                 grid={"scaler": [None], "n_neighbors": [5], "weights": ["uniform"], "p": [2],
                                       "algorithm": ["auto"]})
    return rep.select("scaler", "p", "n_neighbors", "weights", "algorithm", r6("mean_test_score"),
                      r6("std_test_score"), "rank_test_score")


# ----------------------------------------------------------------- multi-target train entry, load profile, store listing, sinks

_P3_FEATS = ["p_size", "p_retailprice"]


@query("eval_multi_target", f"""WITH p AS ({fx.P3}),
_lab AS (SELECT y1 AS label, CAST(dense_rank() OVER (ORDER BY y1) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT y1 FROM p)),
e AS (SELECT p.p_partkey, p.p_size, p.p_retailprice, _lab.code AS y1, p.y2 FROM p JOIN _lab ON p.y1 = _lab.label),
{sq.split_random('SELECT * FROM e', 'p_partkey')},
_x AS (SELECT p_partkey, y1, y2, is_test, list_value(CAST(p_size AS DOUBLE), p_retailprice) AS xs FROM s),
_d AS (SELECT a.p_partkey AS qk, a.is_test, a.y1 AS t1, a.y2 AS t2, b.p_partkey AS tk, b.y1, b.y2,
              {sq.dist_expr('a.xs', 'b.xs')} AS dist FROM _x a JOIN _x b ON NOT b.is_test),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY dist, tk) AS rk FROM _d) WHERE rk <= 5),
_v1 AS (SELECT qk, is_test, t1 AS t, y1 AS y, count(*) AS w FROM nb GROUP BY ALL),
_v2 AS (SELECT qk, is_test, t2 AS t, y2 AS y, count(*) AS w FROM nb GROUP BY ALL),
_pp AS (SELECT 'y1' AS target, qk, any_value(is_test) AS is_test, any_value(t) AS t, arg_min(y, (-w, y)) AS h FROM _v1 GROUP BY qk
        UNION ALL SELECT 'y2', qk, any_value(is_test), any_value(t), arg_min(y, (-w, y)) FROM _v2 GROUP BY qk),
_pq AS (SELECT target || '|' || CASE WHEN is_test THEN 'test' ELSE 'train' END AS grp, t, h FROM _pp),
{sq.scores_by('_pq', 'grp')},
_l AS (SELECT split_part(g, '|', 1) AS target, split_part(g, '|', 2) AS split, 'accuracy' AS metric, accuracy AS value FROM _sc
       UNION ALL SELECT split_part(g, '|', 1), split_part(g, '|', 2), 'f1_weighted', f1_weighted FROM _sc)
SELECT target, split, metric, round(value, 6) AS value FROM _l
UNION ALL SELECT 'mean', split, metric, round(avg(value), 6) FROM _l GROUP BY split, metric""")
def q_eval_multi_target(spark, sf):
    p = fx.fixture(spark, sf, fx.P3, "part")
    r = train_entry(p, "p_partkey", ["y1", "y2"], _P3_FEATS, "knn_classifier")
    return r.evaluation.select("target", "split", "metric", r6("value"))


@query("load_profile", """SELECT count(*) AS n_rows,
  count(*) - count(o_orderstatus) AS null_status, count(DISTINCT o_orderstatus) AS distinct_status,
  count(DISTINCT o_custkey) AS distinct_custkey FROM orders""")
def q_load_profile(spark, sf):
    df = tio.read_table(spark, f"{sf}/orders.parquet")
    pr = tio.profile(df, ["o_orderstatus", "o_custkey"], exact_distinct=True)
    return pr.agg(
        F.max("n").alias("n_rows"),
        F.max(F.when(F.col("column") == "o_orderstatus", F.col("nulls"))).alias("null_status"),
        F.max(F.when(F.col("column") == "o_orderstatus", F.col("distinct"))).alias("distinct_status"),
        F.max(F.when(F.col("column") == "o_custkey", F.col("distinct"))).alias("distinct_custkey"))


@query("list_models", "SELECT * FROM (VALUES (1, '1-forest_classifier', 'forest_classifier'), (2, '0-tree_classifier', 'tree_classifier')) v(position, folder, model_name)")
def q_list_models(spark, sf):
    """Two bundles trained and saved under one root, listed newest first."""
    import uuid
    from tabml.session import checkpoint_dir
    from tabml.sources import store
    root = f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    p = fx.fixture(spark, sf, fx.P1, "part")
    for i, model in enumerate(["tree_classifier", "forest_classifier"]):
        r = train_entry(p, "p_partkey", "y", _P1_FEATS, model, max_depth=3)
        store.save_model(r.bundle, f"{root}/{i}-{model}")
    newest = F.row_number().over(Window.orderBy(F.desc("saved_at")))  # a row per saved model
    return store.list_models(spark, root).select(newest.alias("position"), F.element_at(F.split("path", "/"), -1).alias("folder"), "model_name")


@query("report_sinks", f"""SELECT 'evaluation' AS sink, split || ' ' || metric AS name, value FROM (WITH {_KNN_PIPE},
{sq.scores_by('_p', "CASE WHEN is_test THEN 'test' ELSE 'train' END")}
SELECT g AS split, 'accuracy' AS metric, round(accuracy, 6) AS value FROM _sc UNION ALL SELECT g, 'f1_weighted', round(f1_weighted, 6) FROM _sc)
UNION ALL SELECT * FROM (SELECT 'cv_report', 'mean_test_score', mean_test_score FROM ({_CV_SQL}) ORDER BY mean_test_score DESC LIMIT 5)""")
def q_report_sinks(spark, sf):
    """An evaluation (JSON, partitioned by model) and a search's report (top 5,
    CSV) written through the sinks and read back, row by row."""
    import uuid
    from tabml.session import checkpoint_dir
    from tabml.sources import store
    base = f"{checkpoint_dir(spark)}/reports-{uuid.uuid4().hex}"
    store.write_evaluation(_train_knn(spark, sf).evaluation, f"{base}/evaluation", "json", "knn_classifier")
    cv = spark.read.option("header", "true").csv(store.write_cv_report(q_cv_knn(spark, sf), base))
    ev = spark.read.json(f"{base}/evaluation")
    return ev.select(F.lit("evaluation").alias("sink"), F.concat_ws(" ", "split", "metric").alias("name"), r6("value")).unionAll(
        cv.select(F.lit("cv_report"), F.lit("mean_test_score"), F.col("mean_test_score").cast("double")))


@query("insight_sink")
def q_insight_sink(spark, sf):
    """A tree search's report, a tree's evaluation and an SVM insight written
    through the sinks and read back, value by value."""
    import uuid
    from tabml.session import checkpoint_dir
    from tabml.sources import store
    base = f"{checkpoint_dir(spark)}/reports-{uuid.uuid4().hex}"
    rep = q_cv_tree(spark, sf)
    cv_path = store.write_cv_report(rep, base)
    p = fx.fixture(spark, sf, fx.P1, "part")
    r = train_entry(p, "p_partkey", "y", _P1_FEATS, "tree_classifier", max_depth=3)
    for _ in range(2):  # a run written again replaces itself
        store.write_evaluation(r.evaluation, f"{base}/evaluation", "json", "tree_classifier", run="1")
    store.write_insight(q_svm_insight(spark, sf), f"{base}/insight")
    cv = spark.read.option("header", "true").csv(cv_path)
    ev = spark.read.json(f"{base}/evaluation")
    ins = spark.read.json(f"{base}/insight")
    return (ev.select(F.lit("evaluation").alias("sink"), F.concat_ws(" ", "split", "metric").alias("name"), r6("value"))
              .unionAll(cv.select(F.lit("cv_report"), F.col("params"), r6(F.col("mean_test_score").cast("double"), "value")))
              .unionAll(ins.select(F.lit("insight"), F.concat(F.lit("n_support "), F.col("label").cast("string")),
                                   F.col("n_support").cast("double"))))


@query("roc_curve_labels", """WITH _a AS (SELECT CAST(doc_id AS DOUBLE) AS threshold, sum(quality) AS tp, sum(1 - quality) AS fp
            FROM labels GROUP BY 1),
_t AS (SELECT CAST(sum(tp) AS DOUBLE) AS P, CAST(sum(fp) AS DOUBLE) AS N FROM _a),
c AS (SELECT threshold, tp, fp, sum(tp) OVER (ORDER BY threshold DESC) AS cum_tp,
             sum(fp) OVER (ORDER BY threshold DESC) AS cum_fp, P, N FROM _a, _t),
k AS (SELECT *, lead(tp) OVER (ORDER BY threshold DESC) AS ntp, lead(fp) OVER (ORDER BY threshold DESC) AS nfp,
             row_number() OVER (ORDER BY threshold DESC) AS rn FROM c)
SELECT threshold, round(cum_fp / N, 6) AS fpr, round(cum_tp / P, 6) AS tpr FROM k
WHERE rn = 1 OR ntp IS NULL OR ntp <> tp OR nfp <> fp
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""")
def q_roc_curve_labels(spark, sf):
    """ROC of the quality label scored by the document id: runs of equal labels
    make collinear points, which the curve drops."""
    lab = fx.table(spark, sf, "labels").select("quality", F.col("doc_id").cast("double").alias("score"))
    return curves.roc_curve(lab, "quality", "score").select("threshold", r6("fpr"), r6("tpr"))


# ----------------------------------------------------------------- lineitem fits (the sizes of the baseline probes)

_LI_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lineitem_split(spark, sf):
    """Whole lineitem: four numeric features, the P7 target (planted by the same
    rule) and l_returnflag (3 classes); split 80/20 on the row key."""
    li = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", *_LI_FEATS,
        ((F.col("l_discount") > 0.045) != (F.col("l_linenumber") == 1)).cast("int").alias("y"))
    li = li.withColumn("features", F.array(*[F.col(c).cast("double") for c in _LI_FEATS]))
    # (l_orderkey, l_linenumber) is not unique in this table; the key adds part and supplier
    return split.train_test_split(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 0.2, 42)


@query("tree_lineitem")
def q_tree_lineitem(spark, sf):
    """Decision tree, depth 5, four features: trained on 80% of lineitem, scored on the other 20%."""
    s = _lineitem_split(spark, sf)
    m = trees.TreeModel("tree", "classification", max_depth=5).fit(s.where(~F.col("is_test")), "y")
    return m.predict(s.where(F.col("is_test"))).select("l_orderkey", "l_linenumber", "y", "prediction")


_LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _int_sql(c: str) -> str:
    """A row key's part for an integer that isn't negative."""
    return f"'18' || lpad(to_hex(CAST({c} AS BIGINT)), 15, '0')"


def _text_sql(c: str) -> str:
    return f"'1' || hex(encode(CAST({c} AS VARCHAR)))"


def _stump_train_sql(src: str) -> str:
    """CTEs ending in ``pr``: rows of ``src`` (which has rk) with is_test and the prediction of
    the best Gini stump of the training rows."""
    scan = _stump_sql("gini", "y").split("FROM p),", 1)[1].split("SELECT CAST(feature")[0]
    return f"""{sq.split_stratified(src, 'rk', 'y')},
pt AS (SELECT l_discount, l_tax, CAST(y AS DOUBLE) AS t FROM s WHERE NOT is_test),{scan},
pr AS (SELECT s.*, CAST(CASE WHEN CASE WHEN feature = 0 THEN l_discount ELSE l_tax END <= thr THEN 2 * sl > nl ELSE 2 * sr > nr END AS INTEGER) AS h
       FROM s, best)"""


@query("train_composite_key", f"""WITH {_stump_train_sql(
    f"SELECT *, concat_ws('/', {', '.join(map(_int_sql, _LI_KEY))}) AS rk FROM (SELECT li.l_orderkey, li.l_linenumber, li.l_partkey, li.l_suppkey, l_discount, l_tax, "
    "CAST((l_discount > 0.045) <> (l_linenumber = 1) AS INT) AS y FROM lineitem li)")}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, is_test, y, h AS pred_y FROM pr""")
def q_train_composite_key(spark, sf):
    """Train entry on whole lineitem, whose rows four columns identify together."""
    li = fx.table(spark, sf, "lineitem").select(
        *_LI_KEY, "l_discount", "l_tax", ((F.col("l_discount") > 0.045) != (F.col("l_linenumber") == 1)).cast("int").alias("y"))
    r = train_entry(li, _LI_KEY, "y", ["l_discount", "l_tax"], "tree_classifier", max_depth=1)
    return r.predictions.select(*_LI_KEY, "is_test", "y", "pred_y")


@query("train_without_key", f"""WITH {_stump_train_sql(
    f"SELECT l_discount, l_tax, y, sha256(concat_ws('/', {_text_sql('l_discount')}, {_text_sql('l_tax')}, {_int_sql('y')})) || '/' || "
    f"{_int_sql('row_number() OVER (PARTITION BY l_discount, l_tax, y) - 1')} AS rk FROM ({fx.P7})")},
{sq.scores_by('pr', "CASE WHEN is_test THEN 'test' ELSE 'train' END", 'y', 'h')}
SELECT 'y' AS target, g AS split, 'accuracy' AS metric, round(accuracy, 6) AS value FROM _sc
UNION ALL SELECT 'y', g, 'f1_weighted', round(f1_weighted, 6) FROM _sc""")
def q_train_without_key(spark, sf):
    """Train entry on lineitem without its key columns: equal rows are numbered, and
    a row's place in the split follows from its values and its number."""
    rows = fx.fixture(spark, sf, fx.P7, "lineitem").select("l_discount", "l_tax", "y")
    r = train_entry(rows, None, "y", ["l_discount", "l_tax"], "tree_classifier", max_depth=1)
    return r.evaluation.select("target", "split", "metric", r6("value"))


@query("forest_lineitem")
def q_forest_lineitem(spark, sf):
    """Random forest, 100 trees, depth 5: trained on 80% of lineitem, scored on the other 20%."""
    s = _lineitem_split(spark, sf)
    m = trees.TreeModel("forest", "classification", max_depth=5, n_estimators=100).fit(s.where(~F.col("is_test")), "y")
    return m.predict(s.where(F.col("is_test"))).select("l_orderkey", "l_linenumber", "y", "prediction")


@query("svc_ovo_lineitem")
def q_svc_ovo_lineitem(spark, sf):
    """One-vs-one linear SVC (the library's multi-class scheme), three classes
    (l_returnflag), machines run until they converge: trained on 80% of lineitem,
    scored on the other 20%."""
    s = _lineitem_split(spark, sf)
    pm = prep.Preprocess(scaler="standard").fit(s.where(~F.col("is_test")), _LI_FEATS)
    x = pm.transform(s, keep=["l_orderkey", "l_linenumber", "l_returnflag", "is_test"])
    m = svm_op.SVC(C=1.0, kernel="linear").fit(x.where(~F.col("is_test")), "l_returnflag")
    return m.predict(x.where(F.col("is_test"))).select("l_orderkey", "l_linenumber", "l_returnflag", "prediction")


@query("svc_ovr_lineitem")
def q_svc_ovr_lineitem(spark, sf):
    """One-vs-rest linear SVC, three classes (l_returnflag), run until it converges:
    trained on 80% of lineitem, scored on the other 20%."""
    s = _lineitem_split(spark, sf)
    pm = prep.Preprocess(scaler="standard").fit(s.where(~F.col("is_test")), _LI_FEATS)
    x = pm.transform(s, keep=["l_orderkey", "l_linenumber", "l_returnflag", "is_test"])
    m = svm_op.SVC(C=1.0, kernel="linear", multiclass="ovr").fit(x.where(~F.col("is_test")),
                                                                             "l_returnflag")
    return m.predict(x.where(F.col("is_test"))).select("l_orderkey", "l_linenumber", "l_returnflag", "prediction")


@query("prediction_proba_preview", f"""WITH {_KNN_PIPE},
_first AS (SELECT qk FROM _p ORDER BY qk LIMIT 10),
_cnt AS (SELECT qk, y, count(*) AS w FROM nb WHERE qk IN (SELECT qk FROM _first) GROUP BY qk, y)
SELECT f.qk AS p_partkey, pl.label AS pred_y, l.label AS class,
       round(coalesce(c.w, 0) / 5.0, 6) AS probability
FROM _first f JOIN _p ON _p.qk = f.qk JOIN _lab pl ON pl.code = _p.h
CROSS JOIN _lab l LEFT JOIN _cnt c ON c.qk = f.qk AND c.y = l.code""")
def q_prediction_proba_preview(spark, sf):
    """First 10 rows (by key) of the batch scoring with class probabilities,
    one row per class (the reference's prediction + probability preview)."""
    r = _train_knn(spark, sf)
    pred = score_op.predict(r.bundle, fx.table(spark, sf, "part"), proba=True)
    first = roles.preview(pred, "p_partkey", 10)
    classes = target.class_names(r.bundle.label_maps, "y")
    return first.select("p_partkey", "pred_y", F.posexplode("proba_y").alias("i", "probability")).select(
        "p_partkey", "pred_y", F.element_at(F.array(*[F.lit(c) for c in classes]), F.col("i") + 1).alias("class"),
        r6("probability"))


@query("cv_knn_pca")
def q_cv_knn_pca(spark, sf):
    """KNN grid search with PCA on (component counts 2, 3, 5 fitted per fold
    on the scaled rows of the other folds), one neighbour join for all."""
    s = _emb_split(spark, sf)
    rep = tuning.knn_grid_search(s.where(~F.col("is_test")), "vec_id", "x", "label", "classification",
                                 folds=5, seed=42, scoring="accuracy",
                                 grid={"scaler": ["standard"], "pca": [2, 3, 5], "n_neighbors": [5, 11],
                                       "weights": ["uniform"], "p": [2], "algorithm": ["auto"]})
    return rep.select("scaler", "pca", "n_neighbors", r6("mean_test_score"), r6("std_test_score"),
                      "rank_test_score")


_STUMP_FEATURES = ["l_discount", "l_tax"]


@query("feature_importance_stump", "WITH st AS (" + _stump_sql("gini", "y").split(
    "\nSELECT CAST(feature AS INTEGER) AS feature")[0] + """
SELECT feature AS f FROM best)
SELECT v.name AS feature, CAST(CASE WHEN v.idx = (SELECT f FROM st) THEN 1 ELSE 0 END AS DOUBLE) AS importance,
       CAST(CASE WHEN v.idx = (SELECT f FROM st) THEN 100 ELSE 0 END AS DOUBLE) AS importance_ratio
FROM (VALUES (0, 'l_discount'), (1, 'l_tax')) v(idx, name)""")
def q_feature_importance_stump(spark, sf):
    """Importances of the depth-1 gini tree on P7: the split feature carries all of it."""
    p = fx.fixture(spark, sf, fx.P7, "lineitem").select(
        F.array(*_STUMP_FEATURES).alias("features"), F.col("y").cast("double").alias("t"))
    m = trees.TreeModel("tree", "classification", criterion="gini", max_depth=1).fit(p, "t")
    return trees.feature_importance(m.model, _STUMP_FEATURES).select(
        "feature", r6("importance"), r6("importance_ratio"))
