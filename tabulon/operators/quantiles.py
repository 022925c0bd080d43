"""Exact and approximate quantiles of many columns.

``method='linear'``  exact, linear interpolation between order statistics (the definition
                     of ``percentile`` / ``quantile_cont``),
``method='lower'``   exact inverted-CDF quantile (``quantile_disc`` / a lossless
                     ``percentile_approx``),
``method='approx'``  Greenwald-Khanna sketch via ``approxQuantile`` (one pass, bounded memory,
                     rank error ``rel_err``).

The exact methods never gather a column (or its distinct values) into one task or the driver. They
run a distributed selection: one job gets count / min / max of every column; then each round bins
the rows that can still hold a wanted order statistic into about ``bins`` bins per probe
(``groupBy(probe, bin).agg(count, min, max)`` with map-side partial aggregation, so the driver
receives at most probes x bins small rows whatever the bins hold), keeps only the bin of the wanted
rank, and stops when that bin holds a single value. The ends of a range fall in different bins, so
every round makes progress.

* Integral columns are binned in exact decimal arithmetic and never pass through a double: the
  range shrinks by ``bins`` a round, 64 bits take six rounds at most.
* Floating columns are binned linearly; a probe whose rows hardly thinned out in a round (values of
  many magnitudes) is binned by sign and power of two once, after which linear bins thin them out.
  +/-Inf have bins of their own. Ranges wider than the largest double are halved first.
* NULL and NaN are ignored, as in ``approxQuantile``.

Every round first filters to the candidate ranges with literals of the column's type, which Parquet
receives as pushed filters.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.columns import is_float_type

DEFAULT_BINS = 2048
_INF = "CAST('Infinity' AS DOUBLE)"


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _lit(x: float) -> str:
    """Exact double literal in Spark SQL text (round-trip repr + D suffix)."""
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return _INF if x > 0 else f"(-{_INF})"
    return f"({repr(float(x))}D)"


def _is_integral(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.IntegralType)


def _typed(df: DataFrame, c: str, x) -> str:
    """Literal in the column's own type (range ends are data values), so that the comparison needs
    no cast and reaches the Parquet reader as a pushed filter."""
    if _is_integral(df, c):
        return f"CAST('{int(x)}' AS {df.schema[c].dataType.simpleString()})"
    return _lit(x)


def _value(df: DataFrame, c: str) -> str:
    """The column as it is compared: integral columns as BIGINT, all others as DOUBLE."""
    return f"CAST({_q(c)} AS {'BIGINT' if _is_integral(df, c) else 'DOUBLE'})"


def _valid_sql(df: DataFrame, c: str) -> str:
    if is_float_type(df.schema[c].dataType):
        return f"({_q(c)} IS NOT NULL AND NOT isnan({_q(c)}))"
    return f"({_q(c)} IS NOT NULL)"


def _ranks(n: int, p: float, method: str) -> list[int]:
    if method == "linear":
        h = (n - 1) * p
        return sorted({int(math.floor(h)), int(math.ceil(h))})
    return [max(int(math.ceil(n * p)) - 1, 0)]


def _integral_bin(x: str, lo: int, hi: int, bins: int) -> str:
    """Exact: (x - lo) * bins div (hi - lo + 1)."""
    shifted = f"(CAST({x} AS DECIMAL(20,0)) - CAST('{lo}' AS DECIMAL(20,0)))"
    return f"CAST(({shifted} * {bins}) div CAST('{hi - lo + 1}' AS DECIMAL(20,0)) AS INT)"


def _floating_bin(x: str, lo: float | None, hi: float | None, bins: int, by_power: bool) -> str:
    """Monotone in x: -Inf and +Inf at the ends, finite values in between, linearly over the finite
    range [lo, hi] or by sign and power of two."""
    if lo is None or lo == hi:
        finite = "0"
    elif by_power:
        power = f"CAST(floor(log2(abs({x}))) AS INT) + 1100"
        finite = f"CASE WHEN {x} = 0 THEN 0 WHEN {x} < 0 THEN -({power}) ELSE {power} END"
    else:
        half = "" if math.isfinite(hi - lo) else " / 2"
        low, width = (lo, hi - lo) if not half else (lo / 2, hi / 2 - lo / 2)
        finite = (f"least(greatest(floor(({x}{half} - {_lit(low)}) / {_lit(width)} * {bins}.0D), 0), "
                  f"{bins - 1})")
    return (f"CAST(CASE WHEN {x} = -{_INF} THEN {-(1 << 20)} WHEN {x} = {_INF} THEN {1 << 20} "
            f"ELSE {finite} END AS INT)")


def _binned(df: DataFrame, probes: dict[int, tuple], bins: int) -> dict[int, list]:
    """One job for probes over columns of one kind: {probe: [(bin, n, min, max, finite min, finite
    max)]}, ascending."""
    entries, ranges = [], []
    for j, (c, lo, hi, flo, fhi, by_power) in probes.items():
        x = _value(df, c)
        inside = f"{_q(c)} >= {_typed(df, c, lo)} AND {_q(c)} <= {_typed(df, c, hi)}"
        place = (_integral_bin(x, lo, hi, bins) if _is_integral(df, c)
                 else _floating_bin(x, flo, fhi, bins, by_power))
        ranges.append(f"({inside})")
        entries.append(f"CASE WHEN {inside} THEN named_struct('p', {j}, 'b', {place}, 'x', {x}) END")
    # a plain OR of column ranges: Parquet skips row groups whose min/max miss every range; plain
    # explode + filter: a higher-order filter() is interpreted, not codegen'd
    rows = (df.filter(" OR ".join(ranges)).select(F.expr(f"explode(array({', '.join(entries)})) AS e"))
            .filter("e IS NOT NULL").selectExpr("e.p", "e.b", "e.x").groupBy("p", "b")
            .agg(F.expr("count(1) AS n"), F.expr("min(x) AS lo"), F.expr("max(x) AS hi"),
                 F.expr(f"min(CASE WHEN abs(CAST(x AS DOUBLE)) != {_INF} THEN x END) AS flo"),
                 F.expr(f"max(CASE WHEN abs(CAST(x AS DOUBLE)) != {_INF} THEN x END) AS fhi")).collect())
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r["p"], []).append((r["b"], r["n"], r["lo"], r["hi"], r["flo"], r["fhi"]))
    return {j: sorted(v, key=lambda t: t[0]) for j, v in out.items()}


def order_statistics(df: DataFrame, wanted: dict[str, set[int]], counts: dict[str, int],
                     bounds: dict[str, tuple], bins: int = DEFAULT_BINS) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks (ascending, NULL/NaN excluded) for each column, distributed: ints for
    integral columns, else floats.

    ``bounds[c]`` = (min, max, finite min, finite max) of the valid values."""
    result: dict[tuple[str, int], float] = {}
    state = {}  # (column, rank) -> (range, rows below it, rows in it, bin by power of two)
    for c, ranks in wanted.items():
        for r in ranks:
            if bounds[c][0] == bounds[c][1]:
                result[(c, r)] = bounds[c][0]
            else:
                state[(c, r)] = (bounds[c], 0, counts[c], False)
    while state:
        probes: dict[tuple, int] = {}
        for (c, _), (span, _, _, by_power) in state.items():
            probes.setdefault((c, *span, by_power), len(probes))
        hist: dict[int, list] = {}
        for integral in (False, True):
            some = {j: key for key, j in probes.items() if _is_integral(df, key[0]) == integral}
            if some:
                hist |= _binned(df, some, bins)
        following = {}
        for (c, r), (span, below, n, by_power) in state.items():
            local = r - below
            for _, count, *inner in hist[probes[(c, *span, by_power)]]:
                if local < count:
                    if inner[0] == inner[1]:
                        result[(c, r)] = inner[0]
                    else:
                        crowded = count > n // 2 and not by_power
                        following[(c, r)] = (tuple(inner), r - local, count, crowded)
                    break
                local -= count
        state = following
    return result


def column_summary(df: DataFrame, cols: list[str]):
    """Count of valid values and (min, max, finite min, finite max) per column, all in one job."""
    aggs = []
    for i, c in enumerate(cols):
        x = f"CASE WHEN {_valid_sql(df, c)} THEN {_value(df, c)} END"
        fx = f"CASE WHEN {_valid_sql(df, c)} AND abs(CAST({_q(c)} AS DOUBLE)) != {_INF} THEN {_value(df, c)} END"
        aggs += [F.expr(f"count({x}) AS n{i}"), F.expr(f"min({x}) AS lo{i}"), F.expr(f"max({x}) AS hi{i}"),
                 F.expr(f"min({fx}) AS flo{i}"), F.expr(f"max({fx}) AS fhi{i}")]
    row = df.agg(*aggs).collect()[0]
    counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    bounds = {c: tuple(row[f"{k}{i}"] for k in ("lo", "hi", "flo", "fhi")) for i, c in enumerate(cols)}
    return counts, bounds


def interpolate(lo, hi, fraction: float) -> float:
    """Between two order statistics; equal ones (also infinite) and fraction 0 give the lower one."""
    if fraction == 0 or lo == hi:
        return float(lo)
    if math.isfinite(lo) and math.isfinite(hi) and not math.isfinite(float(hi) - float(lo)):
        return float(lo) * (1 - fraction) + float(hi) * fraction
    return float(lo) + float(hi - lo) * fraction


def exact_values(df: DataFrame, cols: list[str], probs: list[float]) -> dict[tuple[str, float], float | None]:
    """Inverted-CDF quantiles as the data's own values (ints for integral columns)."""
    counts, bounds = column_summary(df, cols)
    wanted = {c: {_ranks(counts[c], p, "lower")[0] for p in probs} for c in cols if counts[c]}
    stats = order_statistics(df, wanted, counts, bounds)
    return {(c, p): stats[(c, _ranks(counts[c], p, "lower")[0])] if counts[c] else None
            for c in cols for p in probs}


def quantile_values(df: DataFrame, cols: list[str], probs: list[float], method: str = "linear",
                    rel_err: float = 1e-4) -> dict[tuple[str, float], float | None]:
    """{(column, prob): value as double}; None for a column without valid values."""
    if method == "approx":
        clean = df.select([F.col(c).cast("double").alias(c) for c in cols])
        res = clean.approxQuantile(cols, probs, rel_err)
        return {(c, p): (vals[i] if vals else None)
                for c, vals in zip(cols, res) for i, p in enumerate(probs)}
    if method == "lower":
        found = exact_values(df, cols, probs)
        return {k: None if v is None else float(v) for k, v in found.items()}
    if method != "linear":
        raise ValueError(f"unknown quantile method {method!r}")
    counts, bounds = column_summary(df, cols)
    wanted = {c: {r for p in probs for r in _ranks(counts[c], p, method)} for c in cols if counts[c]}
    stats = order_statistics(df, wanted, counts, bounds)
    out = {}
    for c in cols:
        for p in probs:
            h = (counts[c] - 1) * p
            out[(c, p)] = interpolate(stats[(c, math.floor(h))], stats[(c, math.ceil(h))],
                                      h - math.floor(h)) if counts[c] else None
    return out


def quantiles(df: DataFrame, cols: list[str], probs: list[float], method: str = "linear",
              rel_err: float = 1e-4) -> DataFrame:
    """Long table (column, prob, value)."""
    vals = quantile_values(df, cols, probs, method, rel_err)
    return df.sparkSession.createDataFrame([(c, float(p), vals[(c, p)]) for c in cols for p in probs],
                                           "column string, prob double, value double")


def integral_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Long table (column, prob, value BIGINT) of inverted-CDF quantiles of integral columns, exact
    over the whole range of the type."""
    vals = exact_values(df, cols, probs)
    return df.sparkSession.createDataFrame([(c, float(p), vals[(c, p)]) for c in cols for p in probs],
                                           "column string, prob double, value long")
