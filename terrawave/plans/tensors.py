"""Queries of reweighted rows, tensors between channel pairs, their flags, and delays."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from terrawave.operators import robust, tensor
from terrawave.plans.base import DAILY, q6, r6, sql, table
from terrawave.plans.catalog import query
from terrawave.plans.transfer import _BANDS, WIN, _bands, _spec_sql, spectrum

_SIX = ["hx", "hy", "ex", "ey", "rx", "ry"]
_X, _R = ("hx", "hy"), ("rx", "ry")
_B = ("b1_re", "b1_im", "b2_re", "b2_im")


def _mul(a: tuple[str, str], b: tuple[str, str]) -> tuple[str, str]:
    return f"({a[0]} * {b[0]} - {a[1]} * {b[1]})", f"({a[0]} * {b[1]} + {a[1]} * {b[0]})"


def _sub(a: tuple[str, str], b: tuple[str, str]) -> tuple[str, str]:
    return f"({a[0]} - {b[0]})", f"({a[1]} - {b[1]})"


def _power(a: tuple[str, str]) -> str:
    return f"({a[0]} * {a[0]} + {a[1]} * {a[1]})"


def _div(a: tuple[str, str], b: tuple[str, str]) -> tuple[str, str]:
    p = _mul(a, (b[0], f"(-{b[1]})"))
    return f"({p[0]} / nullif({_power(b)}, 0))", f"({p[1]} / nullif({_power(b)}, 0))"


def _v(name: str, of: str = "{}") -> tuple[str, str]:
    return of.format(f"{name}_re"), of.format(f"{name}_im")


def _sums_of(w: str, tag: str = "") -> str:
    out = []
    for i, r in enumerate(_R):
        for name, c in (("m1", "hx"), ("m2", "hy"), ("c", "y")):
            p = _mul((f"{r}_re", f"(-{r}_im)"), _v(c))
            out += [f"sum({w} * {p[0]}) AS {tag}{name}_{i}_re", f"sum({w} * {p[1]}) AS {tag}{name}_{i}_im"]
    return ", ".join(out)


def _det(of: str = "{}") -> tuple[str, str]:
    return _sub(_mul(_v("m1_0", of), _v("m2_1", of)), _mul(_v("m2_0", of), _v("m1_1", of)))


def _solution(of: str = "{}", names=("d_re", "d_im")) -> list[str]:
    """The parts of b1, b2, with the determinant in columns of these names."""
    b1 = _div(_sub(_mul(_v("m2_1", of), _v("c_0", of)), _mul(_v("m2_0", of), _v("c_1", of))), names)
    b2 = _div(_sub(_mul(_v("m1_0", of), _v("c_1", of)), _mul(_v("m1_1", of), _v("c_0", of))), names)
    return [*b1, *b2]


def _solved(source: str, keys: str, extra: str = "") -> str:
    d = _det()
    return f"SELECT *, {', '.join(f'{v} AS s{i}' for i, v in enumerate(_solution()))} FROM (SELECT *, {d[0]} AS d_re, {d[1]} AS d_im FROM ({source}))"


_LONG = "lo AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT *, '{n}' AS output, {c}_re AS y_re, {c}_im AS y_im FROM spec" for n, c in (("ex", "ex"), ("ey", "ey"))) + ")"


def _round(i: int) -> str:
    left = _sub(_v("y"), ("(%s + %s)" % (_mul(_v("hx"), _v("b1"))[0], _mul(_v("hy"), _v("b2"))[0]), "(%s + %s)" % (_mul(_v("hx"), _v("b1"))[1], _mul(_v("hy"), _v("b2"))[1])))
    close = " AND ".join(f"sqrt({_power((f'(s{2 * j} - b{j + 1}_re)', f'(s{2 * j + 1} - b{j + 1}_im)'))}) <= 1e-5 * sqrt({_power(_v(f'b{j + 1}'))})" for j in range(2))
    olds = ", ".join(f"any_value({c}) AS {c}" for c in _B)
    return f"""f{i} AS MATERIALIZED (SELECT lo.*, {", ".join(f"b.{c}" for c in _B)}, b.done, sqrt({_power(left)}) AS r FROM lo JOIN b{i - 1} b ON lo.site = b.site AND lo.h = b.h AND lo.output = b.output),
g{i} AS MATERIALIZED (SELECT site, h, output, 1.4826 * median(r) + 1e-30 AS s FROM f{i} GROUP BY 1, 2, 3),
w{i} AS MATERIALIZED (SELECT f.*, least(1.0::DOUBLE, 1.5 * g.s / greatest(r, 1e-30)) AS wt FROM f{i} f JOIN g{i} g ON f.site = g.site AND f.h = g.h AND f.output = g.output),
b{i} AS MATERIALIZED (SELECT site, h, output, n, {", ".join(f"CASE WHEN done THEN {c} ELSE s{j} END AS {c}" for j, c in enumerate(_B))}, done OR coalesce({close}, FALSE) AS done FROM (
  {_solved(f"SELECT site, h, output, count(*) AS n, bool_or(done) AS done, {olds}, {_sums_of('wt')} FROM w{i} GROUP BY 1, 2, 3", "")}))"""


@query("huber_impedance", sql(DAILY, _spec_sql(_SIX), _LONG, f"b0 AS MATERIALIZED (SELECT site, h, output, n, {', '.join(f's{j} AS {c}' for j, c in enumerate(_B))}, FALSE AS done FROM ({_solved(f'SELECT site, h, output, count(*) AS n, {_sums_of("1")} FROM lo GROUP BY 1, 2, 3', '')}))", *(_round(i) for i in range(1, 13)), f"SELECT site, CAST(h AS INTEGER) AS h, output, n, {', '.join(q6(c, c) for c in _B)} FROM b12"))
def huber_impedance(spark, sf_dir):
    """Huber-weighted remote-reference rows of both electric channels, by harmonic, of up to twelve rounds."""
    long = robust.outputs_long(spectrum(spark, sf_dir, _SIX), {"ex": "ex", "ey": "ey"})
    out = robust.huber(long, ["site", "h", "output"], "y", _X, _R)
    return out.select("site", "h", "output", "n", *(r6(c, c) for c in _B))


def _sliced(spark, sf_dir):
    spec = spectrum(spark, sf_dir, _SIX).join(_bands(spark), "h")
    last = F.max("w").over(Window.partitionBy("site"))
    return spec.withColumn("slice", tensor.slice_of(F.col("w"), last + 1, 10)).withColumn("f", F.col("h") / WIN)


def _coherence(tag: str, c: str, power: str, s: str) -> str:
    c0, c1 = _v(f"{tag}{c}_0"), _v(f"{tag}{c}_1")
    mixed = _mul(_mul(c0, _v(f"{s}s")), (c1[0], f"(-{c1[1]})"))[0]
    return f"(({s}r1 * {_power(c0)} + {s}r0 * {_power(c1)} - 2 * {mixed}) / nullif({s}r0 * {s}r1 - {_power(_v(s + 's'))}, 0) / nullif({power}, 0))"


_S = _mul(_v("rx"), ("ry_re", "(-ry_im)"))
_MORE = f"sum({_S[0]}) AS s_re, sum({_S[1]}) AS s_im, " + ", ".join(f"sum({_power(_v(c))}) AS {n}" for n, c in (("r0", "rx"), ("r1", "ry"), ("y", "y"), ("x0", "hx"), ("x1", "hy"))) + ", count(*) AS n"
_NAMES = [f"{n}_{i}_{p}" for n in ("m1", "m2", "c") for i in range(2) for p in ("re", "im")]
_ALL = [*_NAMES, "s_re", "s_im", "r0", "r1", "y", "x0", "x1", "n"]
_EL = [(f"t_{o}{e}", o, f"b{j}") for o in "xy" for j, e in ((1, "x"), (2, "y"))]
_PICK = ", ".join(f"max(CASE WHEN output = 'e{o}' THEN {b}_{p} END) AS {t}_{p}" for t, o, b in _EL for p in ("re", "im"))
_DET2 = _sub(_mul(_v("t_xx"), _v("t_yy")), _mul(_v("t_xy"), _v("t_yx")))
_TURN = _div(_v("e"), _v("det"))
_TENSOR = (
    DAILY,
    _spec_sql(_SIX),
    _BANDS,
    "sl AS (SELECT site, least(10 - 1, w * 10 // (max(w) OVER (PARTITION BY site) + 1)) AS slice, w FROM (SELECT DISTINCT site, w FROM spec))",
    _LONG.replace("FROM spec", "FROM spec JOIN bands USING (h) JOIN sl USING (site, w)"),
    f"su AS MATERIALIZED (SELECT site, band, output, slice, {_sums_of('1')}, {_MORE} FROM lo GROUP BY 1, 2, 3, 4)",
    f"wh AS MATERIALIZED (SELECT site, band, output, {', '.join(f'sum({c}) AS {c}' for c in _ALL)} FROM su GROUP BY 1, 2, 3)",
    f"z AS MATERIALIZED (SELECT site, band, output, n, {', '.join(f's{j} AS {c}' for j, c in enumerate(_B))}, {_coherence('', 'c', 'y', '')} AS co, {_coherence('', 'm1', 'x0', '')} AS ci0, {_coherence('', 'm2', 'x1', '')} AS ci1 FROM ({_solved('SELECT * FROM wh', '')}))",
    f"t AS (SELECT site, band, CAST(max(n) AS BIGINT) AS n, {_PICK}, " + ", ".join(f"max(CASE WHEN output = 'e{o}' THEN co END) AS coh_out_{o}" for o in "xy") + ", max(CASE WHEN output = 'ex' THEN ci0 END) AS coh_in_x, max(CASE WHEN output = 'ex' THEN ci1 END) AS coh_in_y FROM z GROUP BY 1, 2)",
    f"td AS MATERIALIZED (SELECT *, {_DET2[0]} AS det_re, {_DET2[1]} AS det_im FROM t)",
    f"le AS (SELECT su.site, su.band, su.output, su.slice, {', '.join(f'wh.{c} - su.{c} AS {c}' for c in _NAMES)} FROM su JOIN wh ON su.site = wh.site AND su.band = wh.band AND su.output = wh.output WHERE wh.n - su.n >= 8)",
    f"lb AS (SELECT site, band, output, slice, {', '.join(f's{j} AS {c}' for j, c in enumerate(_B))} FROM ({_solved('SELECT * FROM le', '')}))",
    f"lp AS (SELECT site, band, slice, {_PICK} FROM lb GROUP BY 1, 2, 3)",
    f"ld AS (SELECT lp.*, det_re, det_im, {_DET2[0]} AS e_re, {_DET2[1]} AS e_im FROM (SELECT * FROM lp) lp JOIN (SELECT site AS s2, band AS b2, det_re, det_im FROM td) ON site = s2 AND band = b2)",
    f"lt AS (SELECT *, sqrt({_power(_v('e'))}) AS ab, degrees(atan2({_TURN[1]}, {_TURN[0]})) / 2 AS tu FROM ld)",
    "lv AS (SELECT site, band, count(*) AS g, " + ", ".join(f"sum(pow({t}_re - m_{t}_re, 2) + pow({t}_im - m_{t}_im, 2)) AS v_{t}" for t, _, _ in _EL) + ", sum(pow(ab - m_ab, 2)) AS v_ab, sum(pow(tu - m_tu, 2)) AS v_tu FROM (SELECT *, " + ", ".join(f"avg({c}) OVER (PARTITION BY site, band) AS m_{c}" for c in [f"{t}_{p}" for t, _, _ in _EL for p in ("re", "im")] + ["ab", "tu"]) + " FROM lt) GROUP BY 1, 2)",
    f"ch AS (SELECT site, band, output, h, {_sums_of('1')} FROM lo GROUP BY 1, 2, 3, 4)",
    f"cw AS (SELECT site, band, output, h, sqrt(sqrt({_power(_det())})) AS c FROM ch)",
    f"fw AS (SELECT site, band, avg(f) AS f_weighted FROM (SELECT site, band, output, sum(h / {WIN}.0 * c) / sum(c) AS f FROM cw GROUP BY 1, 2, 3) GROUP BY 1, 2)",
    "te AS (SELECT td.*, g AS n_groups, " + ", ".join(f"sqrt((g - 1) / g::DOUBLE * v_{t}) AS {t}_err" for t, _, _ in _EL) + ", sqrt((g - 1) / g::DOUBLE * v_ab) AS abs_det_err, sqrt((g - 1) / g::DOUBLE * v_tu) AS half_arg_err, degrees(atan2(det_im, det_re)) / 2 AS half_arg, f_weighted FROM td JOIN lv ON td.site = lv.site AND td.band = lv.band JOIN fw ON td.site = fw.site AND td.band = fw.band)",
)
_OUT = [f"{t}_{p}" for t, _, _ in _EL for p in ("re", "im", "err")] + ["det_re", "det_im", "abs_det_err", "half_arg", "half_arg_err", "coh_out_x", "coh_out_y", "coh_in_x", "coh_in_y", "f_weighted"]


def _tensor(spark, sf_dir):
    return tensor.tensor(_sliced(spark, sf_dir), ["site", "band"], ("ex", "ey"), _X, _R, method="ls")


@query("tensor_estimate", sql(*_TENSOR, f"SELECT site, CAST(band AS INTEGER) AS band, n, n_groups, {', '.join(q6(c, c) for c in _OUT)} FROM te"))
def tensor_estimate(spark, sf_dir):
    """Tensor from magnetic to electric channels by band, with errors from ten slices of the record."""
    return _tensor(spark, sf_dir).select("site", "band", "n", "n_groups", *(r6(c, c) for c in _OUT))


@query("band_flags", sql(*_TENSOR, f"SELECT site, CAST(band AS INTEGER) AS band, t_xx_re IS NULL AS not_estimated, n_groups < 5 AS few_groups, coh_out_x < 0.1 OR coh_out_y < 0.1 AS low_coherence, {_power(_mul(_v('t_xy'), _v('t_yx')))} > {_power(_mul(_v('t_xx'), _v('t_yy')))} AS off_diagonal, det_re < 0 AS re_det_negative, {q6('greatest(sqrt(pow(t_xx_re - 1, 2) + pow(t_xx_im, 2)), sqrt(pow(t_xy_re, 2) + pow(t_xy_im, 2)), sqrt(pow(t_yx_re, 2) + pow(t_yx_im, 2)), sqrt(pow(t_yy_re - 1, 2) + pow(t_yy_im, 2)))', 'from_identity')} FROM te"))
def band_flags(spark, sf_dir):
    """What speaks against each band's tensor."""
    out = tensor.flags(_tensor(spark, sf_dir))
    return out.select("site", "band", "not_estimated", "few_groups", "low_coherence", "off_diagonal", "re_det_negative", r6(tensor.from_identity(out), "from_identity"))


_DELAY_BANDS = "bd AS (SELECT CAST(l_suppkey AS BIGINT) AS site, l_quantity / 5 AS f, 40 - 360 * l_quantity / 5 * (l_suppkey % 7 - 3) * 0.011 + avg(l_discount * 100 - 5) AS p, 0.5 + avg(l_tax * 10) AS s FROM lineitem GROUP BY l_suppkey, l_quantity)"
_K = "(2 * pi() / 180)"
_DELAY = (
    _DELAY_BANDS,
    "ke AS MATERIALIZED (SELECT site, max(f) AS top, 1 / (360 * max(f)) AS step, sum(1 / (s * s)) AS w, count(*) AS n FROM bd GROUP BY 1)",
    f"pa AS (SELECT k.site, i, any_value(step) AS step, sqrt(pow(sum(cos({_K} * 360 * f * i * step) / (s * s)), 2) + pow(sum(sin({_K} * 360 * f * i * step) / (s * s)), 2)) / any_value(w) AS r FROM (SELECT *, unnest(range(0, CAST(ceil(0.25 / step) AS BIGINT) + 1)) AS i FROM ke) k JOIN bd ON bd.site = k.site GROUP BY 1, 2)",
    "pb AS (SELECT *, lead(r) OVER (PARTITION BY site ORDER BY i) AS nx, max(CASE WHEN r < 0.98 THEN 1 ELSE 0 END) OVER (PARTITION BY site ORDER BY i) AS lf FROM pa)",
    "pc AS (SELECT *, max(CASE WHEN lf = 1 AND r >= 0.98 THEN 1 ELSE 0 END) OVER (PARTITION BY site ORDER BY i) AS bk FROM pb)",
    "al AS (SELECT site, min(i * step) AS alias FROM pc WHERE bk = 1 AND NOT coalesce(nx > r, FALSE) GROUP BY 1)",
    "wi AS MATERIALIZED (SELECT ke.*, alias, CAST(ceil(least(0.25, coalesce(alias / 2, 0.25)) / step) AS BIGINT) AS m FROM ke LEFT JOIN al ON ke.site = al.site)",
    f"sc AS (SELECT k.site, i, any_value(step) AS step, any_value(m) AS m, any_value(alias) AS alias, sum(cos({_K} * (p + 360 * f * i * step)) / (s * s)) / any_value(w) AS re, sum(sin({_K} * (p + 360 * f * i * step)) / (s * s)) / any_value(w) AS im FROM (SELECT *, unnest(range(-m, m + 1)) AS i FROM wi) k JOIN bd ON bd.site = k.site GROUP BY 1, 2)",
    "pk AS (SELECT *, coalesce(r >= lag(r) OVER (PARTITION BY site ORDER BY i), TRUE) AND coalesce(r >= lead(r) OVER (PARTITION BY site ORDER BY i), TRUE) AS peak FROM (SELECT *, sqrt(re * re + im * im) AS r FROM sc))",
    "bs AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY abs(i), i) AS rn FROM (SELECT *, max(r) OVER (PARTITION BY site) AS mx FROM pk WHERE peak) WHERE r >= 0.98 * mx) WHERE rn = 1)",
    f"ex AS (SELECT site, sum(exp(-0.5 * pow({_K} * s, 2)) / (s * s)) / sum(1 / (s * s)) AS expected FROM bd GROUP BY 1)",
    "rs AS (SELECT bs.*, expected, CASE WHEN abs(i) = m THEN 'bound' WHEN r < 0.97 THEN 'no line' WHEN expected < 0.97 THEN 'errors' END AS reason FROM bs JOIN ex ON bs.site = ex.site)",
    f"pl AS (SELECT bd.site, f, s, p + 180 * round_even((atan2(im, re) / {_K} - 360 * f * i * step - p) / 180, 0) AS p FROM bd JOIN rs ON bd.site = rs.site WHERE reason IS NULL)",
    "mn AS (SELECT site, count(*) AS n, sum(1 / (s * s)) AS w, sum(f / (s * s)) / sum(1 / (s * s)) AS mf, sum(p / (s * s)) / sum(1 / (s * s)) AS mp FROM pl GROUP BY 1)",
    "ln AS (SELECT pl.site, any_value(n) AS n, any_value(w) AS w, any_value(mf) AS mf, any_value(mp) AS mp, sum(pow(f - mf, 2) / (s * s)) AS xx, sum((f - mf) * (p - mp) / (s * s)) / sum(pow(f - mf, 2) / (s * s)) AS b FROM pl JOIN mn ON pl.site = mn.site GROUP BY 1)",
    "cs AS (SELECT pl.site, sum(pow(p - (mp - b * mf) - b * f, 2) / (s * s)) AS chi FROM pl JOIN ln ON pl.site = ln.site GROUP BY 1)",
    "ft AS (SELECT ln.*, mp - b * mf AS a, chi, sqrt(greatest(1, chi / (n - 2))) AS sc FROM ln JOIN cs ON ln.site = cs.site)",
)


@query("delay_scan", sql(*_DELAY, f"SELECT rs.site, {q6('i * step', 'tau')}, {q6('r', 'resultant')}, {q6('expected', 'expected')}, {q6('alias', 'alias')}, reason, {q6('-b / 360', 'delay')}, {q6('sc / sqrt(xx) / 360', 'delay_err')}, {q6('a - 180 * ceil(a / 180 - 0.5)', 'intercept')}, {q6('sc * sqrt(1 / w + mf * mf / xx)', 'intercept_err')}, {q6('chi / (n - 2)', 'chi2')} FROM rs LEFT JOIN ft ON rs.site = ft.site"))
def delay_scan(spark, sf_dir):
    """Delays that put the phases of each site's bands on a line."""
    f = F.col("l_quantity") / 5
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("long").alias("site"), f.alias("f")).agg(F.avg(F.col("l_discount") * 100 - 5).alias("d"), (0.5 + F.avg(F.col("l_tax") * 10)).alias("sd"))
    b = b.withColumn("phase", 40 - 360 * F.col("f") * (F.col("site") % 7 - 3) * 0.011 + F.col("d"))
    out = tensor.delay_scan(b, ["site"], tolerance=0.25)
    return out.select("site", *(r6(c, c) for c in ("tau", "resultant", "expected", "alias")), "reason", *(r6(c, c) for c in ("delay", "delay_err", "intercept", "intercept_err", "chi2")))
