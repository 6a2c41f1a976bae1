"""DuckDB SQL building blocks for the oracle queries.

Written as plain set-based SQL (global windows are fine for an oracle on a
small scale factor); the Spark side computes the same results with the
library's distributed operators.
"""

from __future__ import annotations


def hashed(src: str, key: str, seed: int = 42) -> str:
    return f"SELECT *, md5(concat_ws(':', '{seed}', CAST({key} AS VARCHAR))) AS _h FROM ({src}) _src"


def split_stratified(src: str, key: str, cls: str, test: float = 0.2, seed: int = 42) -> str:
    """CTEs ending in relation ``s`` = src columns + is_test."""
    return f"""_hh AS ({hashed(src, key, seed)}),
_c AS (SELECT {cls} AS _cls, count(*) AS _n FROM _hh GROUP BY 1),
_t AS (SELECT sum(_n) AS _tot, CAST(ceil(CAST({test} AS DOUBLE) * sum(_n)) AS BIGINT) AS _nt FROM _c),
_q AS (SELECT _c._cls, _c._n, _c._n / _t._tot * (_t._tot - _t._nt) AS _cont, _t._tot - _t._nt AS _ntr FROM _c, _t),
_q1 AS (SELECT *, floor(_cont) AS _fl FROM _q),
_q2 AS (SELECT *, row_number() OVER (ORDER BY _cont - _fl DESC, _cls) AS _rr, _ntr - sum(_fl) OVER () AS _need FROM _q1),
_q3 AS (SELECT _cls, _n - (_fl + CASE WHEN _rr <= _need THEN 1 ELSE 0 END) AS _tq FROM _q2),
s AS (SELECT _hh.* EXCLUDE (_h), row_number() OVER (PARTITION BY _hh.{cls} ORDER BY _hh._h) <= _q3._tq AS is_test
      FROM _hh JOIN _q3 ON _hh.{cls} = _q3._cls)"""


def split_random(src: str, key: str, test: float = 0.2, seed: int = 42) -> str:
    return f"""_hh AS ({hashed(src, key, seed)}),
_t AS (SELECT CAST(ceil(CAST({test} AS DOUBLE) * count(*)) AS BIGINT) AS _nt FROM _hh),
s AS (SELECT _hh.* EXCLUDE (_h), row_number() OVER (ORDER BY _hh._h) <= _t._nt AS is_test FROM _hh, _t)"""


def kfold(src: str, key: str, k: int = 5, seed: int = 42) -> str:
    """CTEs ending in relation ``f`` = src columns + fold."""
    return f"""_kh AS ({hashed(src, key, seed)}),
_kr AS (SELECT *, row_number() OVER (ORDER BY _h) - 1 AS _r, count(*) OVER () AS _n FROM _kh),
f AS (SELECT _kr.* EXCLUDE (_h, _r, _n),
        CAST(CASE WHEN _r < (_n % {k}) * (_n // {k} + 1) THEN _r // (_n // {k} + 1)
             ELSE (_n % {k}) + (_r - (_n % {k}) * (_n // {k} + 1)) // (_n // {k}) END AS INTEGER) AS fold
      FROM _kr)"""


def kfold_stratified(src: str, key: str, cls: str, k: int = 5, seed: int = 42) -> str:
    return f"""_kh AS ({hashed(src, key, seed)}),
_kc AS (SELECT {cls} AS _cls, count(*) AS _n FROM _kh GROUP BY 1),
_ko AS (SELECT _cls, _n, coalesce(sum(_n) OVER (ORDER BY _cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _off FROM _kc),
_kf AS (SELECT _cls, t.i AS fold,
        (CASE WHEN _off + _n > t.i THEN (_off + _n - t.i + {k} - 1) // {k} ELSE 0 END)
        - (CASE WHEN _off > t.i THEN (_off - t.i + {k} - 1) // {k} ELSE 0 END) AS _sz
       FROM _ko, range({k}) t(i)),
_ke AS (SELECT _cls, fold, _sz, sum(_sz) OVER (PARTITION BY _cls ORDER BY fold) AS _end FROM _kf),
_kr AS (SELECT *, row_number() OVER (PARTITION BY {cls} ORDER BY _h) AS _rn FROM _kh),
f AS (SELECT _kr.* EXCLUDE (_h, _rn), CAST(_ke.fold AS INTEGER) AS fold FROM _kr JOIN _ke
      ON _kr.{cls} = _ke._cls AND _kr._rn > _ke._end - _ke._sz AND _kr._rn <= _ke._end)"""


def dist_expr(a: str, b: str, p: int = 2) -> str:
    """A distance at 10 significant digits."""
    if p == 2:
        d = f"sqrt(list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"
    else:
        d = f"list_sum(list_transform(list_zip({a}, {b}), lambda z: abs(z[1] - z[2])))"
    unit = "pow(10::DOUBLE, 9 - floor(log10(d)))"
    return f"list_transform([{d}], lambda d: CASE WHEN d > 0 THEN round(d * {unit}) / {unit} ELSE d END)[1]"


def knn_neighbours(split_rel: str, key: str, x: str, y: str, k: int, p: int = 2) -> str:
    """CTE ``nb`` (qk, tk, y, dist, rk) from a relation with is_test."""
    return f"""_d AS (SELECT a.{key} AS qk, b.{key} AS tk, b.{y} AS y, {dist_expr('a.' + x, 'b.' + x, p)} AS dist
       FROM {split_rel} a JOIN {split_rel} b ON a.is_test AND NOT b.is_test),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY dist, tk) AS rk FROM _d) WHERE rk <= {k})"""


def knn_weights(weights: str) -> str:
    """CTE ``wnb`` with column w from ``nb``."""
    if weights == "uniform":
        return "wnb AS (SELECT *, CAST(1 AS DOUBLE) AS w FROM nb)"
    return """_z AS (SELECT qk, max(CASE WHEN dist = 0 THEN 1 ELSE 0 END) AS z FROM nb GROUP BY qk),
wnb AS (SELECT nb.*, CASE WHEN _z.z = 1 THEN CASE WHEN dist = 0 THEN 1.0 ELSE 0.0 END ELSE 1.0 / dist END AS w
        FROM nb JOIN _z USING (qk))"""


def knn_vote() -> str:
    """CTE ``pred`` (qk, prediction) from ``wnb``."""
    return """_v AS (SELECT qk, y, sum(w) AS w FROM wnb GROUP BY qk, y),
pred AS (SELECT qk, arg_min(y, (-w, y)) AS prediction FROM _v GROUP BY qk)"""


def report(src: str, y: str = "y", yhat: str = "yhat") -> str:
    """CTE ``rep`` = classification report rows from relation ``src``."""
    return f"""_pc AS (SELECT {y} AS y, {yhat} AS yhat, count(*) AS n FROM {src} GROUP BY 1, 2),
_cl AS (SELECT y AS c FROM _pc UNION SELECT yhat FROM _pc),
_pcl AS (SELECT _cl.c,
        coalesce((SELECT sum(n) FROM _pc WHERE _pc.y = _cl.c AND _pc.yhat = _cl.c), 0) AS tp,
        coalesce((SELECT sum(n) FROM _pc WHERE _pc.y = _cl.c), 0) AS support,
        coalesce((SELECT sum(n) FROM _pc WHERE _pc.yhat = _cl.c), 0) AS predicted FROM _cl),
_prf0 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
          CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM _pcl),
_prf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM _prf0),
_tot AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
         sum(precision * support) AS wp, sum(recall * support) AS wr, sum(f1 * support) AS wf FROM _prf),
rep AS (
  SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM _prf
  UNION ALL SELECT 'accuracy', tp / n, tp / n, tp / n, CAST(n AS BIGINT) FROM _tot
  UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM _tot
  UNION ALL SELECT 'weighted avg', wp / n, wr / n, wf / n, CAST(n AS BIGINT) FROM _tot)"""


def rounded(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


_EPS = "2.220446049250313e-15"


def std_matrix(src: str, fit: str, key: str, num: list[str], cat: str | None, scale: bool = True) -> str:
    """CTEs ending in ``mx`` (key, xs): numeric columns then the one-hot block of
    ``cat`` (sorted categories of ``fit``), each standard-scaled with the
    population statistics of ``fit`` when ``scale``."""
    sel_n = ", ".join(f"avg({c}) AS _m{i}, stddev_pop({c}) AS _s{i}" for i, c in enumerate(num))

    def sc(expr, m, s):
        if not scale:
            return expr
        return f"(({expr}) - {m}) / (CASE WHEN abs({s}) < {_EPS} THEN 1.0 ELSE {s} END)"
    nums = ", ".join(sc(f"CAST(a.{c} AS DOUBLE)", f"_m{i}", f"_s{i}") for i, c in enumerate(num))
    cat_part = ""
    ctes = f"_nst AS (SELECT {sel_n} FROM {fit})"
    if cat:
        ctes += f""",
_cats AS (SELECT v, CAST(row_number() OVER (ORDER BY v) AS INTEGER) AS ci FROM (SELECT DISTINCT {cat} AS v FROM {fit})),
_ist AS (SELECT c.ci, c.v, avg(CASE WHEN r.{cat} = c.v THEN 1.0 ELSE 0.0 END) AS m,
                stddev_pop(CASE WHEN r.{cat} = c.v THEN 1.0 ELSE 0.0 END) AS sd FROM {fit} r, _cats c GROUP BY c.ci, c.v)"""
        one = sc(f"CASE WHEN a.{cat} = i.v THEN 1.0 ELSE 0.0 END", "i.m", "i.sd")
        cat_part = f" || (SELECT list({one} ORDER BY i.ci) FROM _ist i)"
    return f"""{ctes},
mx AS (SELECT a.{key}, list_value({nums}){cat_part} AS xs FROM {src} a, _nst)"""


def scores_by(src: str, by: str, t: str = "t", h: str = "h") -> str:
    """CTE ``_sc`` (by, accuracy, f1_weighted) from relation ``src``."""
    return f"""_spc AS (SELECT {by} AS g, {t} AS t, {h} AS h, count(*) AS n FROM {src} GROUP BY ALL),
_scl AS (SELECT g, t AS c FROM _spc UNION SELECT g, h FROM _spc),
_spl AS (SELECT _scl.g, _scl.c,
          coalesce((SELECT sum(n) FROM _spc WHERE _spc.g = _scl.g AND _spc.t = _scl.c AND _spc.h = _scl.c), 0) AS tp,
          coalesce((SELECT sum(n) FROM _spc WHERE _spc.g = _scl.g AND _spc.t = _scl.c), 0) AS support,
          coalesce((SELECT sum(n) FROM _spc WHERE _spc.g = _scl.g AND _spc.h = _scl.c), 0) AS predicted FROM _scl),
_spr AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr,
                CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM _spl),
_sf AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM _spr),
_sc AS (SELECT g, sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1_weighted FROM _sf GROUP BY g)"""


def tube_scan(src: str, C: float, eps: float, half_width: float = 100.0, levels: int = 11) -> str:
    """CTEs ending in relation ``best`` (w, f): the least of w^2 / 2 + C * sum(max(0, |y - w z - b| - eps))
    over w and b for ``src`` (z, y). Each level measures 21 values of w around the best
    of the last; the best b for a w is the median of all residuals plus and minus eps."""
    out, at, step = [f"d AS ({src})"], "0.0", half_width / 10
    for k in range(levels):
        out.append(f"""g{k} AS (SELECT {at} + (i - 10) * CAST({step!r} AS DOUBLE) AS w FROM range(21) t(i)),
m{k} AS (SELECT w, median(y - w * z + e) AS b FROM d, g{k}, (SELECT unnest([CAST({eps} AS DOUBLE), CAST({-eps} AS DOUBLE)]) AS e) GROUP BY w),
o{k} AS (SELECT w, w * w / 2 + {C} * sum(greatest(abs(y - w * z - b) - {eps}, 0)) AS f FROM d, m{k} GROUP BY w, b)""")
        at, step = f"(SELECT arg_min(w, f) FROM o{k})", step / 10
    return ",\n".join([*out, f"best AS (SELECT arg_min(w, f) AS w, min(f) AS f FROM o{levels - 1})"])
