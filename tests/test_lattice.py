"""Grids on the first source's lattice against loops."""

import math
import random

import pytest

from terrawave.operators import lattice


def _merge(ps):
    out, last = [], None
    for p in sorted(set(ps)):
        if last is None or math.log10(p) - math.log10(last) > lattice.SAME:
            out.append(p)
        last = p
    return out


def _on(p, others, d=lattice.SAME):
    return any(abs(math.log10(p) - math.log10(q)) <= d for q in others)


def _plain(rows):
    first = min((r for r in rows if r[2] == "xy"), key=lambda r: r[1])[0]
    ref = [r[3] for r in rows if r[0] == first and r[2] == "xy"]
    lo, hi = math.log10(min(ref)) - lattice.SAME, math.log10(max(ref)) + lattice.SAME
    on, found = {first}, list(ref)
    for s in {r[0] for r in rows}:
        ps = {r[3] for r in rows if r[0] == s}
        inside = [p for p in ps if lo <= math.log10(p) <= hi]
        if s != first and inside and 2 * sum(_on(p, ref) for p in inside) >= len(inside):
            on.add(s)
            found += [p for p in ps if p not in inside]
    lat = _merge(found)
    good = [r for r in rows if r[4] and r[5]]
    union = _merge([r[3] for r in good])
    kept = [p for p in union if _on(p, lat)]
    for s, m, k in {(r[0], r[2], r[1]) for r in rows if r[0] not in on}:
        mine = sorted((r for r in rows if (r[0], r[2], r[1]) == (s, m, k) and r[5]), key=lambda r: r[3])
        for p in lat:
            if _on(p, [r[3] for r in mine if r[4]]) or any(a[4] and b[4] and a[3] < p < b[3] for a, b in zip(mine, mine[1:], strict=False)):
                kept.append(p)
    kept = _merge(kept)
    rest = [p for p in union if not _on(p, lat) and not any(abs(math.log10(p) - math.log10(q)) < lattice.CLOSE for q in kept)]
    grid = _merge(kept + rest)
    gone = {(r[0], r[3]) for r in good if not _on(r[3], grid)}
    pairs = {(a, b) for a, b in zip(grid, grid[1:], strict=False) if math.log10(b) - math.log10(a) < lattice.CLOSE}
    return {(p, not _on(p, union)) for p in grid}, gone, pairs


@pytest.mark.parametrize("seed", range(4))
def test_grids_equal_loops(spark, seed):
    r = random.Random(seed)
    base = [10 ** (i / 8) for i in range(-4, 14)]
    rows = []
    for rank, s in enumerate(["p0", "p1", "p2", "p3"]):
        shift = 1 if s in ("p0", "p1") else 10 ** r.uniform(0.005, 0.1)
        own = [p * shift * (1 + r.choice([0, 0, 1e-6])) for p in base[rank * 2 : rank * 2 + 12]]
        for mode in ("xy", "yx"):
            rows += [(s, rank, mode, p, r.random() < 0.8, own[1] <= p <= own[-2] or r.random() < 0.5) for p in own if not (s == "p0" and mode == "yx")]
    df = spark.createDataFrame([("a", *x) for x in rows], "site string, source string, rank int, mode string, period double, usable boolean, inside boolean")
    grid, gone, pairs = lattice.first_lattice(df, ["site"])
    want = _plain(rows)
    assert {(v["period"], v["added"]) for v in grid.collect()} == want[0]
    assert {(v["source"], v["period"]) for v in gone.collect()} == want[1]
    assert {(v["period"], v["next"]) for v in pairs.collect()} == want[2]
