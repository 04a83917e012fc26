"""Ordered work within keys that holds up when one key owns most of the rows.

A window partitioned by key puts all rows of that key in one task. Here every key is cut after about
`block_rows` rows of its order, so a window sees one block. Where to cut is read off a sample of keys
and order columns inside the same plan; keys shorter than a block have no cut, and the plan is the
same for all tables. What a block needs from the blocks before it is a segmented scan: one summary per
block, an aggregate, is scanned along the key and handed to the rows. A table without cuts has no
summaries, and Spark drops those branches when the sample comes back empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 1_000_000
SAMPLE = 100       # sampled rows of a block
CUT_BITS = 24      # a key has fewer than 2**24 cuts
REACH = 300.0

BLOCK = "_block"   # number of the block within its key; null for keys without cuts
LAST = "_final"    # number of the last block of the key
_CUTS = "_cuts"
_HALO = "_halo"


def named(columns) -> list[str]:
    return [f"`{c}`" for c in columns]


def place(order) -> str:
    """A row's place in the order, as SQL."""
    return f"struct({', '.join(named(order))})"


def over(function: str, keys, order, frame: str = "") -> str:
    """A window expression as SQL; frames are in rows."""
    by = f"partition by {', '.join(named(keys))} " if keys else ""
    return f"{function} over ({by}order by {', '.join(named(order))} {frame and 'rows ' + frame})"


def attach(df: DataFrame, summary: DataFrame, names: list[str], changes: dict[str, Column] = {},
           drop: list[str] = []) -> DataFrame:
    """Left join of a summary on possibly null columns; its other columns are added, then those in
    `changes` are set and those in `drop` left out.

    A summary has at most one row per block, that is one for `block_rows` rows of the table, so it
    goes to every task.
    """
    rest = [c for c in summary.columns if c not in names]
    renamed = summary.selectExpr(*[f"`{n}` as `_by_{n}`" for n in names], *rest)
    same = " and ".join(f"`{n}` <=> `_by_{n}`" for n in names) or "true"
    columns = [c for c in dict.fromkeys([*df.columns, *rest, *changes]) if c not in drop]
    return df.join(F.broadcast(renamed), F.expr(same), "left").select(
        *[changes[c].alias(c) if c in changes else f"`{c}`" for c in columns])


def _cuts(df: DataFrame, keys: list[str], order: list[str], block_rows: int) -> DataFrame:
    """Keys of more than a block with the places (in `order`) at which their next blocks start.

    Every n-th row is sampled by a hash of key and order, so that a recomputed task samples the same
    rows, and every m-th of the sampled rows of a key is a cut.
    """
    every = max(1, block_rows // SAMPLE)
    step = max(1, block_rows // every)
    rows = df.selectExpr(*named(keys), f"{place(order)} as _place")
    if every > 1:
        rows = rows.where(f"pmod(xxhash64({', '.join([*named(keys), '_place'])}), {every}) = 0")
    return rows.selectExpr("*", over("row_number()", keys, ["_place"]) + " as _nth").where(
        f"_nth > 1 and _nth % {step} = {1 % step}").groupBy(*named(keys)).agg(
        F.expr(f"array_sort(collect_list(_place)) as {_CUTS}"))


def _block(order: list[str]) -> Column:
    """Number of cuts at or before the row, by binary search; null without cuts."""
    return F.expr(f"""if(size({_CUTS}) > 0, aggregate(
        transform(sequence({CUT_BITS - 1}, 0, -1), b -> shiftleft(1, b)), 0, (at, step) -> if(
            at + step <= size({_CUTS}) and get({_CUTS}, at + step - 1) <= {place(order)},
            at + step, at)), null)""")


@dataclass(frozen=True)
class Series:
    """Rows of `df` seen in `order` within `keys`, in blocks.

    `order` must be unique within a key for a defined result. Rows that are equal in it stay in one
    block. `base` is the input with its blocks: summaries are made from it, so that the plan does not
    repeat what was added on the way.
    """

    df: DataFrame
    base: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    block_rows: int

    @staticmethod
    def of(df: DataFrame, keys: list[str], order: list[str],
           block_rows: int = BLOCK_ROWS) -> Series:
        cuts = _cuts(df, keys, order, block_rows)
        cut = attach(df, cuts, keys, {BLOCK: _block(order), LAST: F.size(_CUTS)}, [_CUTS])
        return Series(cut, cut, tuple(keys), tuple(order), block_rows)

    @property
    def group(self) -> list[str]:
        return [*self.keys, BLOCK]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def rows(self) -> DataFrame:
        return self.df.drop(BLOCK, LAST)

    def select(self, change: Callable[[DataFrame], DataFrame]) -> Series:
        """A row-wise change that keeps keys, order and the columns of the input."""
        return replace(self, df=change(self.df))

    def rolling(self, back: int, build: Callable[[DataFrame, WindowSpec], DataFrame]) -> Series:
        """Columns that look at most `back` rows back.

        A block gets the last `back` rows of the one before it. A block of fewer rows is an error:
        blocks have about `block_rows` rows, which `back` may not exceed.
        """
        if back > self.block_rows:
            raise ValueError("block_rows must be at least the number of rows looked back")
        columns = self.df.columns
        size = over("count(1)", self.group, self.order,
                    "between unbounded preceding and unbounded following")
        place = over("row_number()", self.group, self.order)
        after = f"""cast(if(_size < {back} and {BLOCK} > 0, raise_error(
            'a block is shorter than a look back'), {BLOCK} + 1) as int) as {BLOCK}"""
        tails = self.df.where(f"{BLOCK} < {LAST}").selectExpr(
            "*", f"{place} as _place", f"{size} as _size").where(f"_place > _size - {back}")
        widened = self.df.selectExpr("*", f"false as {_HALO}").union(tails.selectExpr(
            *[after if c == BLOCK else f"`{c}`" for c in columns], "true"))
        return replace(self, df=build(widened, self.window()).where(~F.col(_HALO)).drop(_HALO))

    def running(self, **sums: Column) -> Series:
        """Sums from the start of the series up to and including the row."""
        return self.scan(running=sums)

    def last_known(self, **cols: Column) -> Series:
        """Newest non-null value at or before the row."""
        return self.scan(known=cols)

    def next_known(self, **cols: Column) -> Series:
        """First non-null value at or after the row."""
        return self.scan(following=cols)

    def scan(self, *, running: dict[str, Column] = {}, known: dict[str, Column] = {},
             following: dict[str, Column] = {}, ages: dict[str, Column] = {}) -> Series:
        """Running sums, last and next known values, and the rows since a condition held (before
        the row itself), by new names, all from one summary. They are made of columns of the input.

        Per column there is a window within the block, an aggregate over a block, a scan of those
        over the blocks of a key, and how a row combines its own with what comes in.
        """
        start, end = Window.unboundedPreceding, Window.unboundedFollowing
        window = self.window()
        upto, here = window.rowsBetween(start, 0), F.struct(*self.order)
        before = "between unbounded preceding and 1 preceding"
        own, ends, handed, both = {}, {}, {}, {}

        def scanned(function: str, frame: str = before) -> str:
            return over(function, self.keys, [BLOCK], frame)

        def sum_of(mine: Column, carried: Column) -> Column:
            return F.when(mine.isNull(), carried).otherwise(mine + F.coalesce(carried, F.lit(0)))

        for n, c in running.items():
            own[n], ends[n], handed[n] = F.sum(c).over(upto), F.sum(c), scanned(f"sum(`{n}`)")
            both[n] = sum_of
        for n, c in known.items():
            own[n], handed[n] = F.last(c, True).over(upto), scanned(f"last(`{n}`, true)")
            ends[n], both[n] = F.max_by(c, F.when(c.isNotNull(), here)), F.coalesce
        for n, c in following.items():
            own[n] = F.first(c, True).over(window.rowsBetween(0, end))
            handed[n] = scanned(f"first(`{n}`, true)", "between 1 following and unbounded following")
            ends[n], both[n] = F.min_by(c, F.when(c.isNotNull(), here)), F.coalesce
        df, base = self.df, self.base
        if ages:
            nth = over("row_number()", self.group, self.order)
            df, base = (d.selectExpr("*", f"{nth} as _place") for d in (df, base))
        for n, c in ages.items():
            held = F.when(c, F.col("_place"))
            own[n] = F.col("_place") - F.last(held, True).over(window.rowsBetween(start, -1))
            ends[n] = F.count(F.lit(1)) - F.max(held)  # rows of the block after the last one
            handed[n] = f"{scanned('sum(_rows)')} - {scanned(f'last(_upto - `{n}`, true)')}"
            both[n] = lambda mine, carried: F.coalesce(mine, F.col("_place") + carried)

        local = df.select("*", *[c.alias(n) for n, c in own.items()])
        summary = base.where(F.col(BLOCK).isNotNull()).groupBy(*self.group).agg(
            *[c.alias(n) for n, c in ends.items()], F.count(F.lit(1)).alias("_rows"))
        if ages:
            so_far = scanned("sum(_rows)", "between unbounded preceding and current row")
            summary = summary.selectExpr("*", f"{so_far} as _upto")
        carried = summary.selectExpr(*named(self.group), *[f"{c} as `_in_{n}`"
                                                           for n, c in handed.items()])
        # Adding what comes in would widen a decimal.
        kinds = {n: local.schema[n].dataType for n in running}
        return replace(self, df=attach(local, carried, self.group, {
            n: c.cast(kinds[n]) if n in kinds else c for n, c in (
                (n, join(F.col(n), F.col(f"_in_{n}"))) for n, join in both.items())},
            [f"_in_{n}" for n in own] + ["_place"] * bool(ages)))

    def _decayed(self, name: str, prepare: Callable[[Series], Series], decay: str,
                 value: str) -> Series:
        """y = exp(-decay) * y_before + value along the series, from 0; `prepare` adds both.

        A block maps what comes in to exp(-its whole decay) * in + its own end. These pairs compose,
        so the scan over the blocks of a key is the same recurrence on one row per block.
        """
        local = _recur(prepare(self).df, self.group, self.order, decay, value, name, "_whole")
        cut = prepare(replace(self, df=self.base)).df.where(F.col(BLOCK).isNotNull())
        ends = _recur(cut, self.group, self.order, decay, value, "_y", "_whole")
        blocks = ends.groupBy(*self.group).agg(
            F.expr(f"max_by(_y, {place(self.order)}) as _end"), F.sum(decay).alias(decay))
        scanned = _recur(blocks, list(self.keys), [BLOCK], decay, "_end", "_y", "_all")
        carried = scanned.selectExpr(*named(self.group),
                                     over("lag(_y)", self.keys, [BLOCK]) + " as _in_y")
        arrived = F.expr(f"`{name}` + coalesce(exp(-_whole) * _in_y, 0.0D)")
        return replace(self, df=attach(local, carried, self.group, {name: arrived},
                                       ["_whole", "_in_y"]))

    def ewm(self, value: str, span: int, name: str) -> Series:
        """Exponentially weighted mean, y = (1-a)*y + a*x with a = 2/(span+1), seeded by the first
        value. A null keeps y and lets the old weight decay, so the next value counts for more.

        Written out, y is a decayed sum: a value fades by the share that the next value takes.
        """
        alpha = 2.0 / (span + 1)
        rate = -math.log1p(-alpha) if alpha < 1 else 2 * REACH
        x, gap = f"cast(`{value}` as double)", f"{rate!r}D * _age"
        fade = f"""if({x} is not null and _age is not null, least({2 * REACH}D,
            {gap} + ln(exp(-({gap})) + {alpha!r}D)), 0.0D) as _fade"""
        share = f"""case when {x} is null then 0.0D when _age is null then {x}
            else {alpha!r}D / (exp(-({gap})) + {alpha!r}D) * {x} end as _share"""
        mean = f"if({x} is not null or _age is not null, `{name}`, null) as `{name}`"

        def prepare(series: Series) -> Series:
            return series.scan(ages={"_age": F.col(value).cast("double").isNotNull()}).select(
                lambda d: d.selectExpr("*", fade, share))

        return self._decayed(name, prepare, "_fade", "_share").select(lambda d: d.selectExpr(
            *[mean if c == name else f"`{c}`" for c in d.columns
              if c not in ("_age", "_fade", "_share")]))


def _recur(df: DataFrame, group: list[str], order: tuple[str, ...] | list[str], decay: str,
           value: str, name: str, whole: str) -> DataFrame:
    """y = exp(-decay) * y_before + value within each group, and the decay up to the row.

    A group is cut into stretches over which values fade by exp(-REACH); within one, y is a plain
    running sum with growing weights. Beyond the stretch before its own, a row keeps less than
    exp(-REACH) of anything, which no double shows.
    """
    upto = "between unbounded preceding and current row"
    # Stretches follow the order of rows; naming them first lets the windows share one sort.
    stretch = [*group, "_stretch"]

    def within(function: str) -> str:
        return over(function, stretch, order, upto)

    return (
        df.selectExpr("*", f"{over(f'sum(`{decay}`)', group, order, upto)} as {whole}")
        .selectExpr("*", f"floor({whole} / {REACH}D) as _stretch")
        .selectExpr("*", f"{whole} - {within(f'first({whole})')} as _inner")
        .selectExpr("*", f"exp(-_inner) * {within(f'sum(`{value}` * exp(_inner))')} as _own")
        .selectExpr("*", over("lag(_own)", group, ["_stretch", *order]) + " as _last")
        .selectExpr(*named(df.columns), whole, f"""_own + coalesce(exp(-({within(
            f'first(`{decay}`)')} + _inner)) * {within('first(_last)')}, 0.0D) as `{name}`""")
    )


def over_series(df: DataFrame, keys: list[str], order: list[str],
                build: Callable[[Series], Series], *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of `df` with what `build` adds."""
    return build(Series.of(df, keys, order, block_rows)).rows()


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str = "_row",
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact row numbers 1..n per key in `order`, without collecting a key in one task."""
    return over_series(df, keys, order, lambda s: s.running(**{name: F.lit(1)}),
                       block_rows=block_rows)
