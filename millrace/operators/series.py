"""Time-series indicators, signals and newest-row operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.columns import nan_to_null, seconds_between
from millrace.operators.ordered import Series, number_rows, over_series


def rolling_mean(col: str, w: WindowSpec, n: int) -> Column:
    """Mean of the last n rows, null until all n have a value."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(col).over(frame) == n, F.avg(F.col(col).cast("double")).over(frame))


def rolling_std(col: str, w: WindowSpec, n: int) -> Column:
    """Sample deviation of the last n rows, null until all n have a finite value."""
    frame = w.rowsBetween(1 - n, 0)
    finite = F.when(F.abs(col) != F.lit(float("inf")), F.col(col))
    return F.when(F.count(finite).over(frame) == n, F.stddev_samp(finite).over(frame))


def pct_change(col: str, w: WindowSpec) -> Column:
    """Relative change to the row before; the column has its nulls filled forward already. From zero
    it is infinite, and null if the row is zero too."""
    now, before = F.col(col).cast("double"), F.lag(col).over(w).cast("double")
    return F.when((before == 0) & (now != 0), F.signum(now) * float("inf")).otherwise(
        F.try_divide(now, before) - 1)


def stock_indicators(df: DataFrame, *, symbol: str = "symbol", order: list[str], close="close",
                     n: int = 20, **limits: int) -> DataFrame:
    """Moving mean, exponential mean, daily return and its volatility per symbol."""
    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        return (
            d.withColumns({f"sma_{n}": rolling_mean(close, w, n),
                           "daily_return": pct_change("_filled", w)})
            .withColumn("volatility", rolling_std("daily_return", w, n))
        )

    def indicators(series: Series) -> Series:
        return series.last_known(_filled=F.col(close)).rolling(n, build).ewm(close, n, f"ema_{n}")

    return over_series(df, [symbol], order, indicators, **limits).drop("_filled")


def tick_indicators(df: DataFrame, *, symbol: str = "symbol", order: list[str], price="price",
                    volume="volume", **limits: int) -> DataFrame:
    """Running VWAP, momentum, its volatility over 10 and the volume trend over 5 per symbol."""
    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        return (
            d.withColumns({"price_momentum": pct_change("_filled", w),
                           "volume_ma": rolling_mean(volume, w, 5)})
            .withColumn("volatility", rolling_std("price_momentum", w, 10))
            .withColumn("volume_trend", F.try_divide(F.col(volume).cast("double"), F.col("volume_ma")))
        )

    value = F.col(price) * F.col(volume)

    def indicators(series: Series) -> Series:
        return series.scan(known={"_filled": F.col(price)},
                           running={"_pv": value, "_v": F.col(volume)}).rolling(10, build)

    rows = over_series(df, [symbol], order, indicators, **limits)
    vwap = F.try_divide(F.col("_pv").cast("double"), F.col("_v").cast("double"))
    return rows.withColumn("vwap", F.when(value.isNotNull(), vwap)).drop(
        "_filled", "_pv", "_v"
    )


def market_signals(indicators: DataFrame, *, symbol: str = "symbol",
                   order: list[str]) -> DataFrame:
    """Signals of the newest row per symbol as an array of (type, strength, value).

    The volatility limit is mean plus deviation over all rows of the symbol, so everything is one
    grouped aggregate and no task holds a symbol's history.
    """
    newest = F.max_by(
        F.struct(F.col(order[0]).alias("timestamp"), "volume_trend", "volatility",
                 "price_momentum"),
        F.struct(*order),
    )
    grouped = indicators.groupBy(symbol).agg(
        newest.alias("_last"),
        (F.avg("volatility") + F.stddev_samp("volatility")).alias("_limit"),
    )
    last = F.col("_last")

    def signal(when: Column, kind: Column, strength: str, value: Column) -> Column:
        return F.when(when, F.struct(kind.alias("type"), F.lit(strength).alias("strength"),
                                     value.cast("double").alias("value")))

    trend, volatility, momentum = last.volume_trend, last.volatility, last.price_momentum
    kind = F.when(momentum > 0, "MOMENTUM_BULLISH").otherwise("MOMENTUM_BEARISH")
    signals = F.array(
        signal(trend > 2.0, F.lit("VOLUME_SPIKE"), "HIGH", trend),
        signal(volatility > F.col("_limit"), F.lit("HIGH_VOLATILITY"), "MEDIUM", volatility),
        signal(F.abs(momentum) > 0.02, kind, "HIGH", momentum),
    )
    return grouped.select(
        symbol, last.timestamp.alias("timestamp"),
        F.filter(signals, lambda s: s.isNotNull()).alias("signals"),
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key, combined on the map side, so a hot key ships one row per task. Of rows
    equal in `order` the one with the larger rest is taken, unless a column has no order."""
    rest = [c for c in df.columns if c not in keys]
    if any(t in df.schema[c].dataType.simpleString() for c in rest for t in ("map<", "variant")):
        newest = F.max_by(F.struct(*rest), F.struct(*order))
    else:
        # One struct with the order first: no column is held or shuffled twice.
        first = [c for c in dict.fromkeys(order) if c not in keys]
        newest = F.max(F.struct(*first, *[c for c in rest if c not in first]))
    return (
        df.groupBy(*keys).agg(newest.alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
    )


def order_gaps(orders: DataFrame, *, customer: str = "customer_id", date: str = "order_date",
               unique: str = "order_id", **limits: int) -> DataFrame:
    """Days since the customer's order before, null for the first."""
    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        gap = seconds_between(F.col(date), F.lag(date).over(w)) / 86400
        return d.withColumn("days_since_previous", gap)

    return over_series(orders, [customer], [date, unique], lambda s: s.rolling(1, build),
                       **limits)


def first_n(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """First n rows per key. Up to a thousand, Spark limits each key on the map side before the
    shuffle; beyond that the rows are numbered over range partitions."""
    if n > 1000:
        return number_rows(df, keys, order, "_n").where(F.col("_n") <= n).drop("_n")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def ffill_bfill(df: DataFrame, cols: list[str], *, keys: list[str], order: list[str],
                **limits: int) -> DataFrame:
    """Nulls and NaN take the value before them, leading ones the first value after them."""
    df = nan_to_null(df, cols)

    def fills(series: Series) -> Series:
        return series.scan(known={f"_f_{c}": F.col(c) for c in cols},
                           following={f"_b_{c}": F.col(c) for c in cols})

    filled = {c: F.coalesce(f"_f_{c}", f"_b_{c}") for c in cols}
    return over_series(df, keys, order, fills, **limits).withColumns(filled).drop(
        *[f"_{d}_{c}" for d in "fb" for c in cols]
    )


def sort_events(df: DataFrame, order: list[str]) -> DataFrame:
    """Global order over range partitions."""
    return df.orderBy(*order)


def rank_rows(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Exact global position without a one-task sort."""
    return number_rows(df, [], order, name)
