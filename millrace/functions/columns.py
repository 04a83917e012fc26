"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def money(col: str | Column, scale: int = 2) -> Column:
    """Exact decimal, so that sums do not depend on the order of rows."""
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal(18,{scale})")


def mean_of(col: str | Column) -> Column:
    """Mean as exact sum over count; null without values."""
    col = F.col(col) if isinstance(col, str) else col
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds with microsecond fraction; works for both timestamp types."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return micros / F.lit(1e6)


# -- cleaning ---------------------------------------------------------------------------------

def with_audit(df: DataFrame, run_ts=None, name: str = "etl_timestamp") -> DataFrame:
    """Ingestion time; `run_ts` fixes it so that a rerun writes the same rows."""
    return df.withColumn(name, F.current_timestamp() if run_ts is None else F.lit(run_ts))


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast columns; with strict=False a value that does not fit becomes null."""
    return df.withColumns({
        c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()
    })


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna(defaults)


def numerics_to_double(df: DataFrame) -> DataFrame:
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def decimals_to_double(df: DataFrame) -> DataFrame:
    exact = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in exact})


def flatten_struct(df: DataFrame) -> DataFrame:
    """Nested fields as top-level columns named outer_inner."""
    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias("_".join(here))

    return df.select(*leaves(df.schema, ()))


def title_case(col: str | Column) -> Column:
    """First letter of every run of letters upper case, the rest lower case; any other character
    ends a run, so apostrophes, hyphens and digits start a new word."""
    col = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    capped = F.transform(
        runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2))))
    )
    return F.array_join(capped, "")


def celsius_to_fahrenheit(col: str) -> Column:
    return F.col(col) * 9 / 5 + 32


def mps_to_mph(col: str) -> Column:
    return F.col(col) * 2.237


def cut(col: str, edges: list[float], labels: list[str]) -> Column:
    """Label of the bin with lower < x <= upper; `edges` are the inner borders, the outer bins are
    open. Null stays null."""
    value = F.col(col)
    label = F.when(value.isNull() | F.isnan(value.cast("double")), None)
    for edge, name in zip(edges, labels):
        label = label.when(value <= edge, name)
    return label.otherwise(labels[-1])


def quality_flag(humidity: str = "humidity", pressure: str = "pressure") -> Column:
    """The pressure rule wins over the humidity rule; nulls are Good."""
    return (F.when(F.col(pressure) < 870, "Check pressure")
            .when(F.col(humidity) > 100, "Check humidity").otherwise("Good"))


def line_total(price: str = "price", quantity: str = "quantity") -> Column:
    return F.col(price).try_cast("decimal(10,2)") * F.col(quantity).try_cast("int")


def parse_ts(col: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Null where the text does not match."""
    return F.try_to_timestamp(F.col(col), F.lit(fmt))


def to_zone(col: str, zone: str = "America/New_York") -> Column:
    """Wall-clock time in `zone` of a UTC time without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(col).cast("timestamp_ntz"))


def inventory_score(quantity: str, capacity: str, updated: str, as_of) -> Column:
    """Best at half capacity, minus two points per day since the update, kept in 0..100.
    Null when the capacity is zero or an input is null."""
    days = seconds_between(F.lit(as_of), F.col(updated)) / 86400
    share = F.try_divide(F.col(quantity).cast("double"), F.col(capacity).cast("double"))
    score = (1 - F.abs(share - 0.5) * 2) * 100 - days * 2
    return F.when(score.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))


def is_weekend(col: str) -> Column:
    return (F.weekday(F.col(col)) >= 5).cast("int")


def route(key: str | Column, partitions: int) -> Column:
    """Partition of a key from its MD5, so any producer in any language computes the same."""
    key = F.col(key) if isinstance(key, str) else key
    head = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("long"), F.lit(partitions)).cast("int")


# -- filters ----------------------------------------------------------------------------------

def between(col: str, low, high) -> Column:
    return F.col(col).between(F.lit(low), F.lit(high))


def month_filter(col: str, year: int, month: int, mode: str = "range") -> Column:
    """`range` keeps the column bare, so the filter reaches the scan; `function` does not;
    `partition` expects year and month columns."""
    if mode == "partition":
        return (F.col("year") == year) & (F.col("month") == month)
    if mode == "function":
        return (F.year(col) == year) & (F.month(col) == month)
    start = f"{year:04d}-{month:02d}-01"
    end = f"{year + month // 12:04d}-{month % 12 + 1:02d}-01"
    return (F.col(col) >= F.to_date(F.lit(start))) & (F.col(col) < F.to_date(F.lit(end)))


def recent(col: str, days: int, as_of) -> Column:
    """On or after the day `days` before `as_of`."""
    return F.col(col) >= F.date_sub(F.to_date(F.lit(as_of)), days)


def apply_filters(df: DataFrame, *, date: str = "order_date", product: str = "product_id",
                  amount: str = "amount", date_range=None, products=None,
                  amount_range=None) -> DataFrame:
    """Dashboard filters; None means no filter."""
    if date_range:
        df = df.where(between(date, *date_range))
    if products:
        df = df.where(F.col(product).isin(list(products)))
    if amount_range:
        df = df.where(between(amount, *amount_range))
    return df


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN in floating-point columns among `cols` becomes null."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in dict.fromkeys(cols) if c in floats})
