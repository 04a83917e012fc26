"""Feature views, point-in-time retrieval and the latest-value store."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import over_series
from millrace.operators.series import latest_per_key


@dataclass(frozen=True)
class FeatureView:
    """Features of `keys`, valid from `timestamp` for `ttl`; `created` settles equal times."""

    name: str
    keys: tuple[str, ...]
    features: tuple[str, ...]
    ttl: timedelta
    timestamp: str = "event_timestamp"
    created: str = "created"


@dataclass(frozen=True)
class FeatureService:
    """A named list of `view:feature` references."""

    name: str
    refs: tuple[str, ...]


def _by_view(refs: list[str]) -> dict[str, list[str]]:
    wanted: dict[str, list[str]] = {}
    for ref in refs:
        view, feature = ref.split(":")
        wanted.setdefault(view, []).append(feature)
    return wanted


def get_historical_features(entities: DataFrame, refs: list[str] | FeatureService,
                            views: dict[str, tuple[FeatureView, DataFrame]], *,
                            timestamp: str = "event_timestamp", full_names: bool = False,
                            **limits: int) -> DataFrame:
    """Entity rows with, per view, the newest feature row at or before their time; a null key
    matches nothing.

    A newest row older than the view's ttl gives nulls; there is no step back to an older one. All
    views and the entity rows go through one ordered pass per set of keys, so they are shuffled
    once, not once per view.
    """
    refs = list(refs.refs) if isinstance(refs, FeatureService) else list(refs)
    result = entities
    by_keys: dict[tuple[str, ...], list[tuple[str, list[str]]]] = {}
    for name, features in _by_view(refs).items():
        by_keys.setdefault(views[name][0].keys, []).append((name, features))
    for keys, group in by_keys.items():
        result = _one_pass(result, list(keys), group, views, timestamp, full_names, limits)
    return result


def _one_pass(entities, keys, group, views, timestamp, full_names, limits) -> DataFrame:
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyless, entities = entities.where(~known), entities.where(known)
    carried = [c for c in entities.columns if c not in keys]
    shape = entities.select(F.struct(*carried).alias("_e")).schema["_e"].dataType
    kinds = {}
    for name, features in group:
        view, source = views[name]
        kinds[name] = source.select(
            F.struct(F.col(view.timestamp).cast("timestamp").alias("at"), *features).alias("s")
        ).schema["s"].dataType

    def empty(name):
        return F.lit(None).cast(kinds[name]).alias(f"_v_{name}")

    rows = entities.select(
        *keys, F.col(timestamp).cast("timestamp").alias("_ts"), F.lit(1).alias("_side"),
        F.lit(None).cast("timestamp").alias("_made"), F.struct(*carried).alias("_e"),
        *[empty(name) for name, _ in group],
    )
    for name, features in group:
        view, source = views[name]
        payload = F.struct(F.col(view.timestamp).cast("timestamp").alias("at"), *features)
        rows = rows.unionByName(source.where(known).select(
            *keys, F.col(view.timestamp).cast("timestamp").alias("_ts"), F.lit(0).alias("_side"),
            F.col(view.created).cast("timestamp").alias("_made"),
            F.lit(None).cast(shape).alias("_e"),
            *[payload.cast(kinds[n]).alias(f"_v_{n}") if n == name else empty(n)
              for n, _ in group],
        ))
    newest = {f"_n_{name}": F.col(f"_v_{name}") for name, _ in group}
    # Feature rows of equal time and creation are settled by their values.
    values = [F.to_json(F.col(f"_v_{name}")) for name, _ in group]
    rows = rows.withColumn("_value", F.concat_ws(",", *values))
    matched = over_series(rows, keys, ["_ts", "_side", "_made", "_value"],
                          lambda s: s.last_known(**newest), **limits).where("_side = 1")
    columns, empties = [], []
    for name, features in group:
        seen = F.col(f"_n_{name}")
        oldest = F.col("_ts") - F.expr(f"interval {int(views[name][0].ttl.total_seconds())} second")
        columns += [
            F.when(seen["at"] >= oldest, seen[f])
            .alias(f"{name}__{f}" if full_names else f) for f in features
        ]
        empties += [F.lit(None).cast(kinds[name][f].dataType)
                    .alias(f"{name}__{f}" if full_names else f) for f in features]
    return matched.select(*keys, *[F.col("_e")[c].alias(c) for c in carried], *columns).unionByName(
        keyless.select(*keys, *carried, *empties))


def pit_join(entities: DataFrame, features: DataFrame, keys: list[str], cols: list[str],
             ttl: timedelta, *, timestamp: str = "event_timestamp",
             feature_timestamp: str = "event_timestamp", created: str = "created",
             **limits: int) -> DataFrame:
    """Newest feature row at or before each entity row, within the ttl."""
    view = FeatureView("view", tuple(keys), tuple(cols), ttl, feature_timestamp, created)
    return get_historical_features(entities, [f"view:{c}" for c in cols],
                                   {"view": (view, features)}, timestamp=timestamp, **limits)


def materialize_latest(view: FeatureView, source: DataFrame, start, end,
                       store: DataFrame | None = None) -> DataFrame:
    """Latest row per entity after folding the rows of (start, end] into the store."""
    cols = [*view.keys, view.timestamp, view.created, *view.features]
    fresh = source.select(*cols).where(F.col(view.timestamp) <= F.lit(end))
    if start is not None:
        fresh = fresh.where(F.col(view.timestamp) > F.lit(start))
    rows = fresh if store is None else store.select(*cols).unionByName(fresh)
    return latest_per_key(rows, list(view.keys), [view.timestamp, view.created])


def get_latest_features(entities: DataFrame, refs: list[str] | FeatureService,
                        stores: dict[str, tuple[FeatureView, DataFrame]], as_of) -> DataFrame:
    """Latest features for a list of entity keys; absent or expired ones are null."""
    refs = list(refs.refs) if isinstance(refs, FeatureService) else list(refs)
    result = entities
    for name, features in _by_view(refs).items():
        view, store = stores[name]
        oldest = F.lit(as_of).cast("timestamp") - F.expr(
            f"interval {int(view.ttl.total_seconds())} second")
        live = F.col(view.timestamp).cast("timestamp") >= oldest
        latest = store.select(*view.keys, *[F.when(live, F.col(f)).alias(f) for f in features])
        result = result.join(latest, list(view.keys), "left")
    return result
