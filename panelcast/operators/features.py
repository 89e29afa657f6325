"""Lag, rolling, trend and spike features of every series.

All windows share one series window, so the whole feature set costs one shuffle by
series key and one sort.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcast.config import FeatureSpec, PanelSpec
from panelcast.functions.columns import ratio_or_null, safe_ratio
from panelcast.functions.rolling import expanding_mean
from panelcast.operators.panel import by_series, series_window, stretch_rows


def add_lags(df: DataFrame, features: FeatureSpec = FeatureSpec(), spec: PanelSpec = PanelSpec()) -> DataFrame:
    """``lag_k``: the measure ``k`` rows earlier."""
    series = series_window(spec)
    return df.withColumns({f"lag_{k}": F.lag(spec.value, k).over(series) for k in features.lags})


def _joined_windows(series: WindowSpec, shorter: int, n: int) -> dict[str, Column]:
    """Count, sum and squared deviations of the ``n`` rows before each row from those of ``shorter`` rows."""

    def parts(name: str) -> list[Column]:
        column = F.col(f"_{name}_{shorter}")
        return [column] + [F.lag(column, i).over(series) for i in range(shorter, n, shorter)]

    def total(columns: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a + b, columns)

    sums = parts("sum")
    mean = total(sums) / n
    between = [(part / shorter - mean) * (part / shorter - mean) * shorter for part in sums]
    return {f"_count_{n}": total(parts("count")), f"_sum_{n}": total(sums), f"_m2_{n}": total(parts("m2") + between)}


def _squares(values: Sequence[Column], mean: Column) -> Column:
    """Squared deviations of ``values`` from their mean, added up in their order."""
    return reduce(lambda a, b: a + b, [F.pow(v - mean, F.lit(2.0)) for v in values])


def add_rolling(df: DataFrame, features: FeatureSpec = FeatureSpec(), spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rolling mean, standard deviation and coefficient of variation over the rows before each row.

    A window that is a whole multiple of the next shorter one is put together from that one's
    values at earlier rows (counts, sums, and squared deviations from the mean), so only the
    shortest window adds up rows.
    """
    series, value, long = series_window(spec), F.col(spec.value), features.long_window
    # one count per frame guards both its mean and its deviation
    names, shorter = [], None
    for n in sorted(features.windows):
        if shorter is not None and n % shorter == 0:
            df = df.withColumns(_joined_windows(series, shorter, n))
        else:
            frame = series.rowsBetween(-n, -1)
            before = {f"_before_{n}_{k}": F.lag(value, k).over(series) for k in range(n, 0, -1)}
            df = df.withColumns({f"_count_{n}": F.count(value).over(frame), f"_sum_{n}": F.sum(value).over(frame), **before})
            df = df.withColumn(f"_m2_{n}", _squares([F.col(name) for name in before], F.col(f"_sum_{n}") / n)).drop(*before)
        names += [f"_count_{n}", f"_sum_{n}", f"_m2_{n}"]
        shorter = n
    full = {}
    for n in features.windows:
        complete = F.col(f"_count_{n}") == n
        full[f"rolling_mean_{n}"] = F.when(complete, F.col(f"_sum_{n}") / n)
        # a sample of one has no deviation
        full[f"rolling_std_{n}"] = F.when(complete & F.lit(n > 1), F.sqrt(F.col(f"_m2_{n}") / max(n - 1, 1)))
    variation = safe_ratio(F.col(f"rolling_std_{long}"), F.col(f"rolling_mean_{long}"), features.epsilon)
    return df.withColumns(full).drop(*names).withColumn(f"rolling_cv_{long}", variation)


def add_trend(
    df: DataFrame,
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
    variant: str = "difference",
) -> DataFrame:
    """Momentum of the shorter means against the longest, trend, and level against last year.

    ``difference`` (the effective definition): momentum is a difference, trend and yearly
    level are ratios with epsilon.  ``ratio`` (the first definition): momentum is a ratio,
    trend a difference, the yearly level uses the day's own measure; zero divisors give null.
    """
    long, eps = features.long_window, features.epsilon
    shorter = [n for n in features.windows if n != long]
    level, last_year = F.col(f"rolling_mean_{long}"), F.col(f"lag_{max(features.lags)}")
    mean = lambda n: F.col(f"rolling_mean_{n}")
    if variant == "difference":
        columns = {f"momentum_{n}_{long}": mean(n) - level for n in shorter}
        columns[f"trend_{shorter[0]}_{long}"] = safe_ratio(mean(shorter[0]), level, eps)
        columns["yearly_ratio"] = safe_ratio(level, last_year, eps)
    elif variant == "ratio":
        columns = {f"momentum_{n}_{long}": ratio_or_null(mean(n), level) for n in shorter}
        columns[f"trend_{shorter[0]}_{long}"] = mean(shorter[0]) - level
        columns["yearly_ratio"] = ratio_or_null(F.col(spec.value), last_year)
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return df.withColumns(columns)


def add_spikes(df: DataFrame, features: FeatureSpec = FeatureSpec(), spec: PanelSpec = PanelSpec()) -> DataFrame:
    """``is_spike_day`` against the day's own past, and the share of earlier spike days.

    During warm-up the flag is 0, and those zeros count in the rate.
    """
    long = features.long_window
    limit = F.col(f"rolling_mean_{long}") + F.lit(features.spike_sigmas) * F.col(f"rolling_std_{long}")
    spike = F.coalesce(F.col(spec.value) > limit, F.lit(False)).cast("int")
    rate = expanding_mean(F.col("is_spike_day"), series_window(spec), features.spike_min_days)
    return df.withColumn("is_spike_day", spike).withColumn("historical_spike_rate", rate)


def add_features(
    df: DataFrame,
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
    variant: str = "difference",
) -> DataFrame:
    """All features of a panel with one row per (series, day)."""
    df = add_rolling(add_lags(df, features, spec), features, spec)
    return add_spikes(add_trend(df, features, spec, variant), features, spec)


def _by_day(spec: PanelSpec) -> WindowSpec:
    """Rows of one series in the order of their day's number, for frames that count days."""
    return Window.partitionBy(*spec.keys).orderBy(F.unix_date(spec.date).cast("long"))


def _with_dips(
    folded: DataFrame, end: dt.date, zero_columns: Sequence[str], features: FeatureSpec, spec: PanelSpec
) -> DataFrame:
    """``folded`` with those missing days as zeros that could be spike days.

    Zero exceeds the limit of a day only if its window's mean is negative, so only days within a
    long window after a negative measure can be meant; without negative measures no row is added.
    """
    day, long = F.col(spec.date), features.long_window
    lowest = F.min(spec.value).over(_by_day(spec).rangeBetween(1 - long, 0))
    after = F.coalesce(F.date_sub(F.lead(day).over(_by_day(spec)), 1), F.lit(end))
    reach = folded.withColumns({"_from": day, "_to": F.when(lowest < 0, F.least(after, F.date_add(day, long))).otherwise(day)})
    # two rows of one day go back to the caller's check as they are
    reach = reach.withColumn("_to", F.greatest("_from", "_to"))
    return stretch_rows(reach, folded, zero_columns, spec=spec)


def add_spike_counts(
    folded: DataFrame, start: dt.date, features: FeatureSpec = FeatureSpec(), spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """``_spike`` and ``_spikes`` (this day's included) of rows whose missing days since ``start`` count as zeros.

    A window over days holds the rows that there are; the zeros between them enter its mean and
    its deviation by their number.
    """
    day, value, n = F.col(spec.date), F.col(spec.value), features.long_window
    frame = _by_day(spec).rangeBetween(-n, -1)
    raw = {
        "_rows": F.count(F.lit(1)).over(frame),
        "_count": F.count(value).over(frame),
        "_sum": F.sum(value).over(frame),
        "_var": F.var_pop(value).over(frame),
    }
    count = F.col("_count")
    mean = F.coalesce(F.col("_sum"), F.lit(0.0)) / n
    own_mean = F.when(count > 0, F.col("_sum") / F.greatest(count, F.lit(1)))
    m2 = F.coalesce(F.col("_var") * count + own_mean * own_mean * count * (n - count) / n, F.lit(0.0))
    complete = (F.date_diff(day, F.lit(start)) >= n) & (F.col("_rows") == count) & F.lit(n > 1)
    limit = mean + F.lit(features.spike_sigmas) * F.sqrt(m2 / max(n - 1, 1))
    spike = F.coalesce(complete & (value > limit), F.lit(False)).cast("int")
    return (
        folded.withColumns(raw)
        .withColumn("_spike", spike)
        .withColumn("_spikes", F.sum("_spike").over(_by_day(spec).rowsBetween(Window.unboundedPreceding, 0)))
        .drop(*raw)
    )


def value_of_day(day: Column) -> Column:
    """The measures of a day near an origin, of rows from ``origin_features``; null outside of the calendar."""
    return F.when(day.between(F.col("_first"), F.col("_last")), F.coalesce(F.try_element_at("_days", day), F.col("_zero")))


def _runs(days: set[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """First and last days of the runs of consecutive ``days``."""
    one = dt.timedelta(days=1)
    firsts, lasts = sorted(d for d in days if d - one not in days), sorted(d for d in days if d + one not in days)
    return list(zip(firsts, lasts))


def _window_of_days(rows: DataFrame, n: int, complete: Column, spec: PanelSpec) -> DataFrame:
    """Mean and deviation of the ``n`` days before each origin from the rows that there are, the days between as zeros."""
    value = lambda e: e.getField(spec.value).cast("double")
    day = F.col(spec.date)
    inside = F.filter("_rows", lambda e: e.getField(spec.date).between(F.date_sub(day, n), F.date_sub(day, 1)))
    rows = rows.withColumn("_rows", inside)
    total = F.aggregate("_rows", F.lit(0.0), lambda a, e: a + F.coalesce(value(e), F.lit(0.0)))
    known = complete & ~F.exists("_rows", lambda e: value(e).isNull())
    mean, deviation = F.col(f"rolling_mean_{n}"), f"rolling_std_{n}"
    rows = rows.withColumn(f"rolling_mean_{n}", F.when(known, total / n))
    squares = F.aggregate("_rows", F.lit(0.0), lambda a, e: a + (value(e) - mean) * (value(e) - mean))
    m2 = squares + (n - F.size("_rows")) * mean * mean
    # a sample of one has no deviation
    return rows.withColumn(deviation, F.when(F.lit(n > 1), F.sqrt(m2 / max(n - 1, 1))))


def origin_features(
    folded: DataFrame,
    start: dt.date,
    end: dt.date,
    origins: Sequence[dt.date],
    ahead: int,
    zero_columns: Sequence[str] = ("sales",),
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """``calendar_features`` of a few days, the ``origins``, without filling the calendar.

    Each series keeps its rows of the days that windows, lags and up to ``ahead`` horizons of the
    origins read; a day among them that has no row counts as zeros.  They travel with the origin
    as the map ``_days`` (``value_of_day``), so the work grows with the rows that there are and
    with the origins, not with the calendar.  Means and deviations are doubles.
    """
    day, n_long = F.col(spec.date), features.long_window
    inside = sorted({o for o in origins if start <= o <= end})
    steps = {*range(-n_long, ahead + 1)} | {h - k for k in features.lags for h in range(min(ahead, k) + 1)}
    wanted = reduce(lambda a, b: a | b, [day.between(F.lit(a), F.lit(b)) for a, b in _runs({o + dt.timedelta(days=i) for o in inside for i in steps})], F.lit(False))
    measures = [c for c in folded.columns if c not in (*spec.keys, spec.date)]
    rows = by_series(folded.where(day.between(F.lit(start), F.lit(end))), spec)
    repeated = F.raise_error(F.concat(F.lit("a series has several rows for "), day.cast("string"))).cast("date")
    rows = rows.withColumn(spec.date, F.when(F.lag(day).over(_by_day(spec)) == day, repeated).otherwise(day))
    own = F.struct(spec.date, *measures)
    # days that are added for the spikes are zeros as any missing day is
    counted = add_spike_counts(_with_dips(rows, end, zero_columns, features, spec), start, features, spec)
    before = {f"_before_{i}": F.max(F.when(day < F.lit(o), F.col("_spikes"))) for i, o in enumerate(inside)}
    near = F.collect_list(F.when(wanted, own)).alias("_rows")
    series = counted.groupBy(*spec.keys).agg(near, *[c.alias(name) for name, c in before.items()])
    kept = F.transform("_rows", lambda e: F.struct(e.getField(spec.date), F.struct(*[e.getField(c).alias(c) for c in measures])))
    series = series.withColumn("_days", F.map_from_entries(kept))
    points = [F.struct(F.lit(o).alias(spec.date), F.coalesce(name, F.lit(0)).alias("_spikes")) for o, name in zip(inside, before)]
    found = series.select(*spec.keys, "_rows", "_days", F.inline(F.array(*points)))

    types = {c: folded.schema[c].dataType for c in measures}
    zero = F.struct(*[F.lit(0 if c in zero_columns else None).cast(types[c]).alias(c) for c in measures])
    found = found.withColumns({"_first": F.lit(start), "_last": F.lit(end), "_zero": zero})
    found = found.withColumn("_own", value_of_day(day)).withColumns({c: F.col("_own").getField(c) for c in measures}).drop("_own")
    found = found.withColumns({f"lag_{k}": value_of_day(F.date_sub(day, k)).getField(spec.value) for k in features.lags})
    earlier = F.date_diff(day, F.lit(start))
    for n in sorted(features.windows, reverse=True):
        found = _window_of_days(found, n, earlier >= n, spec)
    variation = safe_ratio(F.col(f"rolling_std_{n_long}"), F.col(f"rolling_mean_{n_long}"), features.epsilon)
    rate = F.when(earlier >= features.spike_min_days, F.col("_spikes") / F.greatest(earlier, F.lit(1)))
    found = found.withColumns({f"rolling_cv_{n_long}": variation, "historical_spike_rate": rate})
    done = add_trend(found.drop("_rows", "_spikes"), features, spec)
    # a generator's output is not computed again for the conditions on it
    once = F.struct(*[c for c in done.columns if c not in (*spec.keys, "_days", "_first", "_last", "_zero")])
    return done.select(*spec.keys, "_days", "_first", "_last", "_zero", F.inline(F.array(once)))


def _filled(rows: Column, name: str, zero: Column, lead: Column) -> Column:
    """One value for every day of the calendar from a series' rows, each with the number of days up to the next one."""
    own = lambda r: F.concat(F.array(r.getField(name)), F.array_repeat(zero, (r.getField("_reach") - 1).cast("int")))
    return F.flatten(F.concat(F.array(F.array_repeat(zero, lead)), F.transform(rows, own)))


def _window_arrays(values: Column, n: int) -> tuple[Column, Column]:
    """Sum of the ``n`` values before each place of an array, and their squared deviations from the mean."""
    # a lambda's variable is read at no cost, a column's array anew each time
    each = lambda of: F.transform(F.array(values), of)[0]
    before = lambda v, i: [F.get(v, i - k) for k in range(n, 0, -1)]
    add = lambda a, b: a + b
    total = each(lambda v: F.transform(v, lambda x, i: reduce(add, before(v, i))))
    means = F.transform(f"_sum_{n}", lambda t: t / n)
    spread = each(lambda v: F.transform(means, lambda m, i: _squares(before(v, i), m)))
    return total, spread


def series_arrays(
    folded: DataFrame,
    start: dt.date,
    end: dt.date,
    zero_columns: Sequence[str] = ("sales",),
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
    attributes: DataFrame | None = None,
) -> DataFrame:
    """One row per series: ``_all_<measure>`` with a value for every day from ``start`` to ``end``, and what features read.

    Missing days are zero in ``zero_columns`` and null in the others.  ``_spiked`` counts the spike days
    up to each day; ``_sum_n`` and ``_m2_n`` are those of the shortest windows, which the longer
    ones are put together from.  An array is as long as the calendar, whatever the facts.
    ``attributes`` have the series' keys and are joined before the arrays are made, as the list ``_attributes``:
    a series that has several rows of them gets each of its days as often (``array_features``).
    """
    day = F.col(spec.date)
    measures = [c for c in folded.columns if c not in (*spec.keys, spec.date)]
    rows = by_series(folded.where(day.between(F.lit(start), F.lit(end))), spec)
    repeated = F.raise_error(F.concat(F.lit("a series has several rows for "), day.cast("string"))).cast("date")
    rows = rows.withColumn(spec.date, F.when(F.lag(day).over(_by_day(spec)) == day, repeated).otherwise(day))
    counted = add_spike_counts(_with_dips(rows, end, zero_columns, features, spec), start, features, spec)
    after = F.coalesce(F.lead(day).over(_by_day(spec)), F.date_add(F.lit(end), 1))
    counted = counted.withColumn("_reach", F.date_diff(after, day))
    own = F.struct(spec.date, "_reach", "_spikes", *measures)
    series = counted.groupBy(*spec.keys).agg(F.array_sort(F.collect_list(own)).alias("_rows"))
    if attributes is not None:
        own = F.struct(*[c for c in attributes.columns if c not in spec.keys])
        copies = attributes.groupBy(*spec.keys).agg(F.collect_list(own).alias("_attributes"))
        series = series.join(copies, list(spec.keys), "left")
    # days come in the order of their series, as they do from a window
    series = series.sortWithinPartitions(*spec.keys)
    lead = F.date_diff(F.col("_rows")[0].getField(spec.date), F.lit(start))
    spiked = F.transform("_rows", lambda r: F.array_repeat(r.getField("_spikes"), r.getField("_reach")))
    arrays = {
        f"_all_{c}": _filled(F.col("_rows"), c, F.lit(0 if c in zero_columns else None).cast(folded.schema[c].dataType), lead)
        for c in measures
    }
    arrays["_spiked"] = F.flatten(F.concat(F.array(F.array_repeat(F.lit(0).cast("long"), lead)), spiked))
    series = series.withColumns(arrays).drop("_rows")
    for n in [n for n, shorter in _shorter_windows(features).items() if shorter is None]:
        total, spread = _window_arrays(F.col(f"_all_{spec.value}").cast("array<double>"), n)
        series = series.withColumn(f"_sum_{n}", total).withColumn(f"_m2_{n}", spread)
    return series


def _shorter_windows(features: FeatureSpec) -> dict[int, int | None]:
    """For each window the next shorter one if it is a whole multiple of that (``add_rolling``), else none."""
    ordered = sorted(features.windows)
    return {n: s if s is not None and n % s == 0 else None for s, n in zip([None, *ordered], ordered)}


def array_features(
    series: DataFrame,
    start: dt.date,
    days: tuple[dt.date, dt.date],
    measures: Sequence[str],
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """The features of ``days`` from the rows of ``series_arrays``, whose other columns stay beside them.

    A day is a place (``_place``) in its series' arrays, and every value that a feature needs is read by
    its distance.  No row is moved, sorted or kept for a window.
    """
    place, shorter, n_long = F.col("_place"), _shorter_windows(features), features.long_window
    first, last = ((d - start).days for d in days)
    places = F.sequence(F.lit(first), F.lit(last)) if first <= last else F.array().cast("array<int>")
    rows = series.select("*", F.explode(places).alias("_place"))

    def added(columns: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a + b, columns)

    def total(n: int, back: int = 0) -> Column:
        """Sum of the ``n`` days before the day that lies ``back`` days back."""
        part = shorter[n]
        return F.get(f"_sum_{n}", place - back) if part is None else added([total(part, back + i) for i in range(0, n, part)])

    def spread(n: int, back: int = 0) -> Column:
        """Squared deviations of those days."""
        part = shorter[n]
        if part is None:
            return F.get(f"_m2_{n}", place - back)
        mean = total(n, back) / n if back else F.col(f"rolling_mean_{n}")
        between = [F.pow(total(part, back + i) / part - mean, F.lit(2.0)) * part for i in range(0, n, part)]
        return added([spread(part, back + i) for i in range(0, n, part)] + between)

    def once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
        # a generator's output is not computed again for the conditions on it
        return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))

    read = {c: F.get(f"_all_{c}", place) for c in measures}
    read |= {f"lag_{k}": F.get(f"_all_{spec.value}", place - k) for k in features.lags}
    read |= {f"rolling_mean_{n}": total(n) / n for n in features.windows}
    before = F.coalesce(F.get("_spiked", place - 1), F.lit(0))
    read["historical_spike_rate"] = F.when(place >= features.spike_min_days, before / F.greatest(place, F.lit(1)))
    rows = once(rows, read)
    # a sample of one has no deviation
    rows = once(rows, {f"rolling_std_{n}": F.when(F.lit(n > 1), F.sqrt(spread(n) / max(n - 1, 1))) for n in features.windows})
    variation = safe_ratio(F.col(f"rolling_std_{n_long}"), F.col(f"rolling_mean_{n_long}"), features.epsilon)
    rows = rows.withColumns({spec.date: F.date_add(F.lit(start), place), f"rolling_cv_{n_long}": variation})
    rows = add_trend(rows, features, spec)
    return rows.select("*", F.inline_outer("_attributes")).drop("_attributes") if "_attributes" in rows.columns else rows


def calendar_features(
    folded: DataFrame,
    start: dt.date,
    end: dt.date,
    span: tuple[dt.date, dt.date] | None = None,
    ahead: int = 0,
    zero_columns: Sequence[str] = ("sales",),
    features: FeatureSpec = FeatureSpec(),
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """The panel with zeros on missing days and the features of its days: ``add_features`` of ``densify_calendar``.

    With ``span`` there are the days from as many before it as lags and windows reach back to
    ``ahead`` after it.  ``is_spike_day`` itself is left out; means and deviations are doubles.
    """
    measures = [c for c in folded.columns if c not in (*spec.keys, spec.date)]
    days = (start, end)
    if span is not None:
        back = max(*features.lags, *features.windows)
        days = (max(start, span[0] - dt.timedelta(days=back)), min(end, span[1] + dt.timedelta(days=ahead)))
    series = series_arrays(folded, start, end, zero_columns, features, spec)
    rows = array_features(series, start, days, measures, features, spec)
    return rows.select(*folded.columns, *[c for c in rows.columns if c not in folded.columns and not c.startswith("_")])
