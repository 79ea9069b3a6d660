"""A site's declared list of filters, applied in its order to all channels at once. Sites that share a list share the plan."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrawave.operators import bursts, glitches, mains, masking, recursive
from terrawave.operators.blocks import ends
from terrawave.session import small, stash

KINDS = ("replace", "notch", "mains", "hp", "lp", "cp", "burst", "template", "flip")
ELECTRIC, MAGNETIC = ("ex", "ey"), ("hx", "hy", "hz")


def list_hash(filters: list[dict] | None) -> str:
    """First eight hex digits of the SHA-1 of the list as JSON with sorted keys; another order is another list."""
    return hashlib.sha1(json.dumps(list(filters or []), sort_keys=True).encode()).hexdigest()[:8]


def cycles_subtracted(rows: DataFrame, keys: list[str], x: str, period: float, window: int, k: str = "k", least: int = 5) -> DataFrame:
    """keys, k, x less the median cycle, about its own median, of each window of so many samples from the key's first one; a window of fewer than `least` cycles stays. The period, in samples, may be a fraction: cycle j starts at the sample nearest j periods into the window."""
    length = round(period)
    at = rows.join(small(ends(rows, keys, k)), keys).select(*keys, F.col(k).alias("_k"), F.col(x).cast("double").alias("_x"), (F.col(k) - F.col("lo")).alias("_i"), (F.col("hi") - F.col("lo")).alias("_n"))
    at = at.withColumn("_w", F.floor(F.col("_i") / window)).withColumn("_at", F.pmod("_i", F.lit(window))).withColumn("_size", F.least(F.lit(window), F.col("_n") - F.col("_w") * window))
    near = F.floor(F.col("_at") / period)
    tries = F.array(*(F.struct((near + d).alias("j"), (F.col("_at") - F.rint((near + d) * period).cast("long")).alias("p")) for d in (-1, 0, 1)))
    fits = lambda t: (t["j"] >= 0) & (t["j"] < F.floor(F.col("_size") / period)) & (t["p"] >= 0) & (t["p"] < length) & (F.rint(t["j"] * period) + F.col("_w") * window + length <= F.col("_n"))
    enough = F.floor(F.col("_size") / period) >= least
    dealt = at.select(*keys, "_w", "_k", "_x", F.explode(F.when(enough, F.filter(tries, fits)).otherwise(F.array().cast(at.select(tries.alias("t")).schema["t"].dataType))).alias("_t")).select(*keys, "_w", "_k", "_x", "_t.p")
    middle = stash(dealt.groupBy(*keys, "_w", "p").agg(F.percentile("_x", F.lit(0.5)).alias("_m")), "middle")
    level = middle.groupBy(*keys, "_w").agg(F.percentile("_m", F.lit(0.5)).alias("_z"))
    taken = dealt.join(middle.join(level, [*keys, "_w"]).hint("merge"), [*keys, "_w", "p"]).groupBy(*keys, "_k").agg(F.sum(F.col("_m") - F.col("_z")).alias("_less"))
    return at.select(*keys, "_k", "_x").join(taken, [*keys, "_k"], "left").select(*keys, F.col("_k").alias(k), (F.col("_x") - F.coalesce("_less", F.lit(0.0))).alias(x))


def replaced(rows: DataFrame, keys: list[str], donor: DataFrame, channels: list[str], k: str = "k", x: str = "x") -> DataFrame:
    """rows with the channels' samples taken from donor(keys, channel, k, x), where it has that channel of the key; instants that the donor lacks are missing then."""
    lent = donor.where(F.col("channel").isin(channels)).select(*keys, "channel", k, F.col(x).alias("_x"))
    has = lent.select(*keys, "channel").distinct().withColumn("_has", F.lit(True))
    both = rows.join(lent, [*keys, "channel", k], "left").join(small(has), [*keys, "channel"], "left")
    return both.select(*keys, "channel", k, F.when(F.col("_has"), F.col("_x")).otherwise(F.col(x)).alias(x))


def applied(rows: DataFrame, keys: list[str], rate: float, filters: list[dict], donors: dict[str, DataFrame] | None = None, k: str = "k", x: str = "x") -> DataFrame:
    """keys, channel, k, x after the filters, each a dict of one kind and its options (`channels` is all by default); what replaces comes first wherever it stands. Keys are runs without gaps, rows(keys, channel, k, x)."""
    for spec in filters:
        if len(spec) != 1 or next(iter(spec)) not in KINDS:
            raise ValueError(f"a filter is a dict of one kind of {KINDS}, not {spec}")
    now = rows.select(*keys, "channel", k, F.col(x).cast("double").alias(x))
    by = [*keys, "channel"]
    ordered = [s for s in filters if "replace" in s] + [s for s in filters if "replace" not in s]
    for spec in ordered:
        kind, opts = next(iter(spec.items()))
        opts = dict(opts or {})
        chosen = opts.pop("channels", None)
        if kind == "replace":
            site = opts["site"]
            now = replaced(now, keys, (donors or {})[site], list(chosen or [opts["channel"]]), k, x) if site in (donors or {}) else now
            continue
        if kind == "template" and chosen is None:
            chosen = MAGNETIC
        if kind == "flip" and not chosen:
            raise ValueError("flip needs its channels")
        mine = now.where(F.col("channel").isin(list(chosen))) if chosen is not None else now
        rest = now.where(~F.col("channel").isin(list(chosen))) if chosen is not None else None
        if kind == "notch":
            done = recursive.notched(mine, by, x, rate, k=k, **({**opts, "extra": tuple(opts.get("extra", ()))}))
        elif kind == "mains":
            done = mains.subtracted(mine, by, x, rate, k=k, **opts)
        elif kind in ("hp", "lp"):
            if "cutoff_hz" not in opts:
                raise ValueError(f"{kind} needs a cutoff_hz")
            done = recursive.filtered(mine, by, x, rate, opts["cutoff_hz"], "high" if kind == "hp" else "low", int(opts.get("order", 4)), k=k)
        elif kind == "cp":
            done = cycles_subtracted(mine, by, x, opts.get("period_s", 12.0) * rate, round(opts.get("window_minutes", 10.0) * 60 * rate), k)
        elif kind == "burst":
            sizes = bursts.samples_of(rate, opts.get("min_len_s", 0.05))
            refs = now.where(F.col("channel").isin(list(opts.get("reference") or ELECTRIC)))
            hot = bursts.any_louder([bursts.burst_ratio(refs, by, x, **sizes, k=k)], keys, opts.get("threshold", 12.0), k)
            spans = stash(masking.bursts(hot, keys, F.col("loud"), sizes["width"], round(opts.get("pad_s", 0.1) * rate), k).withColumnsRenamed({"a": "a2", "b": "b2"}), "bursts")
            level = bursts.with_level(mine, by, x, sizes["size"], "_level", k)
            done = masking.spans_filled(level, spans.join(mine.select(*by).distinct(), keys), by, x, "_level", round(opts.get("taper_s", 0.05) * rate), 1 << 14, k).drop("_level")
        elif kind == "template":
            names = {"min_significance": "least"}
            done = glitches.subtracted(mine, keys, rate, x=x, k=k, **{names.get(n, n): v for n, v in opts.items() if n != "estimate"})
        else:
            done = mine.withColumn(x, -F.col(x))
        parts = [done.select(*by, k, x)] + ([rest.select(*by, k, x)] if rest is not None else [])
        # Written, so that a filter's work is not done again by those after it.
        now = stash(reduce(DataFrame.unionByName, parts), kind)
    return now
