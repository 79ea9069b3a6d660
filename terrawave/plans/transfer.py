"""Windows, spectra, cross-powers and transfer functions of the daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrawave.operators import estimate, spectra
from terrawave.plans.base import DAILY, HOURLY, daily, hourly, q6, r6, sql
from terrawave.plans.catalog import query

WIN, HOP, FIRST, LAST, COUNT = 128, 64, 4, 60, 8
BANDS = spectra.log_bands(WIN, FIRST, LAST, COUNT)
CHANNELS = ["hx", "hy", "hz", "ex", "ey", "rx", "ry"]
_BANDS = "bands(band, h) AS (VALUES " + ", ".join(f"({b}, {h})" for b, lo, hi in BANDS for h in range(FIRST, LAST + 1) if lo <= h / WIN < hi) + ")"


def spectrum(spark, sf_dir, channels=CHANNELS):
    wins = spectra.windows(daily(spark, sf_dir), ["site"], channels, WIN, HOP)
    return spectra.spectra(wins, ["site"], channels, FIRST, LAST)


def _bands(spark):
    return spectra.harmonics(spark, BANDS, WIN)


def _spec_sql(channels) -> str:
    return f"""placed AS (SELECT d.*, w.w, d.k - w.w * {HOP} AS n FROM daily d, LATERAL (SELECT unnest(range(CAST(ceil((d.k - {WIN - 1}) / {HOP}.0) AS BIGINT), d.k // {HOP} + 1)) AS w) w WHERE d.k >= 0),
whole AS (SELECT site, w, {", ".join(f"avg({c}) AS m_{c}" for c in channels)} FROM placed GROUP BY site, w HAVING count(*) = {WIN}),
tapered AS (SELECT p.site, p.w, p.n, {", ".join(f"(p.{c} - m.m_{c}) * (0.5 - 0.5 * cos(2 * pi() * p.n / {WIN})) AS {c}" for c in channels)} FROM placed p JOIN whole m ON p.site = m.site AND p.w = m.w),
spec AS (SELECT site, w, h, {", ".join(f"sum({c} * cos(2 * pi() * h * n / {WIN})) AS {c}_re, -sum({c} * sin(2 * pi() * h * n / {WIN})) AS {c}_im" for c in channels)} FROM tapered, (SELECT unnest(range({FIRST}, {LAST + 1})) AS h) GROUP BY site, w, h)"""


def _sums_sql(pairs, by="site") -> str:
    parts = ", ".join(f"sum({a}_re * {b}_re + {a}_im * {b}_im) AS {a}_{b}_re, sum({a}_im * {b}_re - {a}_re * {b}_im) AS {a}_{b}_im" for a, b in pairs)
    return f"sums AS (SELECT {by}, band, count(*) AS n, {parts} FROM spec JOIN bands USING (h) GROUP BY {by}, band)"


def _z_sql(source: str, prefix: str = "", minus: str = "") -> str:
    """zxx_re ... as expressions over <e r*> and <h r*>."""

    def v(a, r, p):
        return f"({prefix}{a}_{r}_{p}{f' - {minus}{a}_{r}_{p}' if minus else ''})"

    det = (f"({v('hx','rx','re')}*{v('hy','ry','re')}-{v('hx','rx','im')}*{v('hy','ry','im')}-{v('hx','ry','re')}*{v('hy','rx','re')}+{v('hx','ry','im')}*{v('hy','rx','im')})",
           f"({v('hx','rx','re')}*{v('hy','ry','im')}+{v('hx','rx','im')}*{v('hy','ry','re')}-{v('hx','ry','re')}*{v('hy','rx','im')}-{v('hx','ry','im')}*{v('hy','rx','re')})")
    out = []
    for e, row in (("ex", "x"), ("ey", "y")):
        # e h^-1 det: first column e_x h_yy - e_y h_yx, second -e_x h_xy + e_y h_xx
        for col, ((a1, s1, b1), (a2, s2, b2)) in {"x": (("rx", 1, ("hy", "ry")), ("ry", -1, ("hy", "rx"))), "y": (("rx", -1, ("hx", "ry")), ("ry", 1, ("hx", "rx")))}.items():
            re = f"({s1}*({v(e,a1,'re')}*{v(*b1,'re')}-{v(e,a1,'im')}*{v(*b1,'im')})+({s2})*({v(e,a2,'re')}*{v(*b2,'re')}-{v(e,a2,'im')}*{v(*b2,'im')}))"
            im = f"({s1}*({v(e,a1,'re')}*{v(*b1,'im')}+{v(e,a1,'im')}*{v(*b1,'re')})+({s2})*({v(e,a2,'re')}*{v(*b2,'im')}+{v(e,a2,'im')}*{v(*b2,'re')}))"
            size = f"nullif({det[0]}*{det[0]}+{det[1]}*{det[1]}, 0)"
            out.append((f"z{row}{col}_re", f"({re}*{det[0]}+{im}*{det[1]})/{size}"))
            out.append((f"z{row}{col}_im", f"({im}*{det[0]}-{re}*{det[1]})/{size}"))
    return out


_ZS = [n for n, _ in _z_sql("")]


@query("rr_impedance", sql(DAILY, _BANDS, _spec_sql(CHANNELS), _sums_sql(estimate.PAIRS), "SELECT site, CAST(band AS INTEGER) AS band, CAST(n AS BIGINT) AS n, " + ", ".join(q6(e, n) for n, e in _z_sql("")) + " FROM sums"))
def rr_impedance(spark, sf_dir):
    """Remote-reference impedance by band: windows, transforms, cross-powers, 2x2 solve."""
    sums = spectra.band_sums(spectrum(spark, sf_dir), _bands(spark), ["site"], estimate.PAIRS)
    return sums.select("site", "band", "n", *(r6(c, n) for n, c in estimate.impedance(sums, ["site"])))


@query("rr_phase_resistivity", sql(DAILY, _BANDS, _spec_sql(CHANNELS), _sums_sql(estimate.PAIRS), "z AS (SELECT site, band, " + ", ".join(f"{e} AS {n}" for n, e in _z_sql("")) + " FROM sums)", "SELECT site, CAST(band AS INTEGER) AS band, " + ", ".join(f"{q6(f'0.2 * period * ({z}_re * {z}_re + {z}_im * {z}_im)', f'rho_{z[1:]}')}, {q6(f'degrees(atan2({z}_im, {z}_re))', f'phase_{z[1:]}')}" for z in ("zxx", "zxy", "zyx", "zyy")) + " FROM (SELECT z.*, CASE band " + " ".join(f"WHEN {b} THEN {(lo * hi) ** -0.5!r}::DOUBLE" for b, lo, hi in BANDS) + " END AS period FROM z)"))
def rr_phase_resistivity(spark, sf_dir):
    """Apparent resistivity and phase of the impedance."""
    sums = spectra.band_sums(spectrum(spark, sf_dir), _bands(spark), ["site"], estimate.PAIRS)
    z = estimate.remote_reference(sums, ["site", "band"])
    period = F.element_at(F.array(*(F.lit((lo * hi) ** -0.5) for _, lo, hi in BANDS)), F.col("band") + 1)
    out = []
    for e in estimate.ELEMENTS:
        re, im = F.col(f"z{e}_re"), F.col(f"z{e}_im")
        out += [r6(0.2 * period * (re * re + im * im), f"rho_{e}"), r6(F.degrees(F.atan2(im, re)), f"phase_{e}")]
    return z.select("site", "band", *out)


_CO = [("ex", "hx"), ("ey", "hy"), ("hx", "rx"), ("hy", "ry"), ("ex", "ex"), ("ey", "ey"), ("hx", "hx"), ("hy", "hy"), ("rx", "rx"), ("ry", "ry")]


@query("band_coherence", sql(DAILY, _BANDS, _spec_sql(CHANNELS), _sums_sql(_CO), "SELECT site, CAST(band AS INTEGER) AS band, " + ", ".join(q6(f"least(1.0::DOUBLE, ({a}_{b}_re * {a}_{b}_re + {a}_{b}_im * {a}_{b}_im) / nullif({a}_{a}_re * {b}_{b}_re, 0))", f"coh_{a}{b}") for a, b in _CO[:4]) + " FROM sums"))
def band_coherence(spark, sf_dir):
    """Squared coherence of channel pairs by band."""
    sums = spectra.band_sums(spectrum(spark, sf_dir), _bands(spark), ["site"], _CO)
    return sums.select("site", "band", *(r6(estimate.coherence(sums, a, b), f"coh_{a}{b}") for a, b in _CO[:4]))


@query("window_band_power", sql(DAILY, _BANDS, _spec_sql(["hx", "ex"]), "SELECT site, CAST(w AS BIGINT) AS w, CAST(band AS INTEGER) AS band, " + q6("10 * log10(sum(hx_re * hx_re + hx_im * hx_im))", "hx_db") + ", " + q6("10 * log10(sum(ex_re * ex_re + ex_im * ex_im))", "ex_db") + " FROM spec JOIN bands USING (h) GROUP BY site, w, band"))
def window_band_power(spark, sf_dir):
    """Power in dB by window and band."""
    sums = spectra.band_sums(spectrum(spark, sf_dir, ["hx", "ex"]), _bands(spark), ["site", "w"], [("hx", "hx"), ("ex", "ex")])
    return sums.select("site", "w", "band", r6(10 * F.log10("hx_hx_re"), "hx_db"), r6(10 * F.log10("ex_ex_re"), "ex_db"))


_GROUPS = "g AS (SELECT *, w // 4 AS grp FROM spec)"
_SUM_G = _sums_sql(estimate.PAIRS, "site, grp").replace("FROM spec", "FROM g")
_T = [f"{a}_{r}_{p}" for a, r in estimate.PAIRS for p in ("re", "im")]
_JACK = f"""total AS (SELECT site, band, sum(n) AS tn, count(*) AS tg, {", ".join(f"sum({c}) AS t_{c}" for c in _T)} FROM sums GROUP BY site, band),
rows AS (SELECT s.site, s.band, t.tg, t.tn / s.n AS h, {", ".join(f"t.t_{c}, s.{c}" for c in _T)} FROM sums s JOIN total t ON s.site = t.site AND s.band = t.band),
zs AS (SELECT site, band, tg, h, {", ".join(f"{e} AS {n}" for n, e in _z_sql("", "t_"))}, {", ".join(f"{e} AS o_{n}" for n, e in _z_sql("", "t_", " "))} FROM rows),
ps AS (SELECT *, {", ".join(f"h * {n} - (h - 1) * o_{n} AS p_{n}" for n in _ZS)} FROM zs),
ms AS (SELECT site, band, {", ".join(f"sum(p_{n} / h) AS m_{n}" for n in _ZS)} FROM ps GROUP BY site, band)"""


@query("jackknife_errors", sql(DAILY, _BANDS, _spec_sql(CHANNELS), _GROUPS, _SUM_G, _JACK, "SELECT p.site, CAST(p.band AS INTEGER) AS band, CAST(max(tg) AS BIGINT) AS groups, " + ", ".join(q6(f"max({n})", n) for n in _ZS) + ", " + ", ".join(q6(f"CASE WHEN max(tg) >= 5 THEN sqrt(sum((pow(p_z{e}_re - m_z{e}_re, 2) + pow(p_z{e}_im - m_z{e}_im, 2)) / nullif(h - 1, 0)) / max(tg)) END", f"z{e}_err") for e in estimate.ELEMENTS) + " FROM ps p JOIN ms m ON p.site = m.site AND p.band = m.band GROUP BY p.site, p.band"))
def jackknife_errors(spark, sf_dir):
    """Impedance with grouped jackknife errors."""
    spec = spectrum(spark, sf_dir).withColumn("grp", F.floor(F.col("w") / 4))
    groups = spectra.band_sums(spec, _bands(spark), ["site", "grp"], estimate.PAIRS)
    out = estimate.jackknife(groups, ["site", "band"])
    return out.select("site", "band", "groups", *(r6(n) for n in ()), *(r6(n, n) for n in _ZS), *(r6(f"z{e}_err", f"z{e}_err") for e in estimate.ELEMENTS))


@query("window_counts", sql(HOURLY, """w AS (SELECT h.site, h.channel, w.w, count(*) AS n FROM hourly h, LATERAL (SELECT unnest(range(CAST(ceil((h.k - 5) / 3.0) AS BIGINT), h.k // 3 + 1)) AS w) w GROUP BY 1, 2, 3),
u AS (SELECT site, channel, count(*) AS used FROM w WHERE n = 6 GROUP BY 1, 2),
e AS (SELECT site, channel, min(k) AS lo, max(k) AS hi FROM hourly GROUP BY 1, 2)""", "SELECT e.site, e.channel, CAST(greatest(0, floor((hi - 5) / 3.0) - ceil(lo / 3.0) + 1) AS BIGINT) AS possible, CAST(coalesce(used, 0) AS BIGINT) AS used FROM e LEFT JOIN u ON e.site = u.site AND e.channel = u.channel"))
def window_counts(spark, sf_dir):
    """Windows of a gappy series: possible and used."""
    return spectra.window_counts(hourly(spark, sf_dir), ["site", "channel"], 6, 3)
