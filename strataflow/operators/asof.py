"""Point-in-time join: each fact with the version of a dimension valid at the fact's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.config import SkewPolicy
from strataflow.operators import skew
from strataflow.operators.cells import CELL, choose_cells, common_kind, in_cells
from strataflow.operators.history import END, START

BROADCAST_BYTES = 32 << 20
BROADCAST_ROWS = 500_000
FEW_VERSIONS = 128
# Keys with more versions than that whose names alone may go to every task.
BUSY_KEYS = 10_000


def join_as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str] | None = None,
    start: str = START,
    end: str = END,
    policy: SkewPolicy = SkewPolicy(),
    broadcast_rows: int = BROADCAST_ROWS,
    few: int = FEW_VERSIONS,
    cells: bool = False,
) -> DataFrame:
    """All facts, with ``columns`` of the version where ``start <= ts < end``, else NULL.

    Facts and history share the key names; the versions of a key must not overlap, which
    ``scd2`` ensures. NULL keys and times match nothing.

    The history is counted first. Keys with few versions take an equality join that tests those few;
    a history that is small in all goes to every task and the facts are not shuffled. For keys
    with many versions, facts and versions are sorted together by key and time and each fact takes
    the last version before it, so the work stays that of a sort. Only where very many keys
    have many versions do all take that way. With ``cells`` such keys take an equality join on key and cell of
    time instead, in which a fact meets the few versions of its cell: nothing is sorted by time, a busy key's
    rows go to as many tasks as it has cells, and Spark can split a cell that is hot all the same.
    The history is read more than once: give it as a table rather than as a long computation.
    """
    taken = [c for c in history.columns if c not in {*keys, start, end}]
    taken = list(columns) if columns is not None else taken
    clash = sorted(set(taken) & set(facts.columns))
    if clash:
        raise ValueError(f"facts and history both have {', '.join(clash)}")
    versions = history.where(_present([*keys, start])).select(
        *keys, F.struct(start, end, *taken).alias("__version"), F.col(start).alias("__at")
    )
    total, busy = _count(versions, keys, few)
    small = total <= broadcast_rows and skew.estimated_bytes(versions) <= BROADCAST_BYTES
    if busy == 0:
        found = _by_join(facts, versions, keys, ts, start, end, total, small, policy)
    elif busy > BUSY_KEYS and not cells:
        found = _by_scan(facts, versions, keys, ts, policy)
    else:
        names = versions.groupBy(*keys).count().where(F.col("count") > few).select(*keys)
        names = F.broadcast(names) if busy <= BUSY_KEYS else names
        light = _by_join(
            facts.join(names, list(keys), "left_anti").select(*facts.columns),
            versions.join(names, list(keys), "left_anti").select(*versions.columns),
            keys, ts, start, end, total, small, policy,
        )
        busy_facts = facts.join(names, list(keys), "left_semi").select(*facts.columns)
        busy_versions = versions.join(names, list(keys), "left_semi").select(*versions.columns)
        if cells:
            heavy = _by_cells(busy_facts, busy_versions, keys, ts, start, end, few)
        else:
            heavy = _by_scan(busy_facts, busy_versions, keys, ts, policy)
        columns = [*facts.columns, "__version"]
        found = light.select(*columns).unionByName(heavy.select(*columns))
    valid = F.col(f"__version.{end}").isNull() | (F.col(ts) < F.col(f"__version.{end}"))
    return found.select(
        *facts.columns, *[F.when(valid, F.col(f"__version.{c}")).alias(c) for c in taken]
    )


def _present(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for name in columns:
        test &= F.col(f"`{name}`").isNotNull()
    return test


def _count(versions: DataFrame, keys: Sequence[str], few: int) -> tuple[int, int]:
    """The number of versions in all, and of keys that have more than a few; reads the keys only."""
    counts = versions.groupBy(*keys).count()
    row = counts.agg(F.sum("count"), F.count_if(F.col("count") > few)).first()
    return row[0] or 0, row[1] or 0


def _by_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: str,
    end: str,
    total: int,
    small: bool,
    policy: SkewPolicy,
) -> DataFrame:
    plain = versions
    names = {c: f"__k{i}" for i, c in enumerate(keys)}
    versions = versions.drop("__at").withColumnsRenamed(names)
    stops = F.col(f"__version.{end}")
    match = (F.col(f"__version.{start}") <= F.col(ts)) & (stops.isNull() | (F.col(ts) < stops))
    for key, name in names.items():
        match &= F.col(key) == F.col(name)
    if small:
        return facts.join(F.broadcast(versions), match, "left")
    hot = skew.find_hot(facts, keys, policy)
    if not hot:
        return facts.join(versions, match, "left")
    light = facts.where(~skew.is_hot(keys, hot)).join(versions, match, "left")
    heavy = facts.where(skew.is_hot(keys, hot))
    # The versions of the hot keys go to every task if they are small, so that the facts of a hot
    # key (or of no key at all) stay where they are.
    theirs = versions.where(skew.is_hot(list(names.values()), hot))
    share = theirs.count() / max(1, total)
    if share * skew.estimated_bytes(versions) <= BROADCAST_BYTES:
        return light.unionByName(heavy.join(F.broadcast(theirs), match, "left"))
    columns = [*facts.columns, "__version"]
    heavy = _by_scan(heavy, plain.where(skew.is_hot(keys, hot)), keys, ts, policy)
    return light.select(*columns).unionByName(heavy.select(*columns))


def _by_cells(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], ts: str, start: str, end: str, few: int
) -> DataFrame:
    """Of keys that have versions, each fact with the version of its cell that is valid at its time."""
    kind = common_kind(facts.schema[ts].dataType, versions.schema["__at"].dataType)
    begins, stops = F.col(f"__version.{start}"), F.col(f"__version.{end}")
    chosen = choose_cells(versions, keys, begins, stops, kind, few)
    if chosen is None:
        return facts.withColumn("__version", F.lit(None).cast(versions.schema["__version"].dataType))
    names = {c: f"__k{i}" for i, c in enumerate(keys)}
    laid = in_cells(versions.drop("__at"), chosen, begins, stops)
    laid = laid.withColumnsRenamed({**names, CELL: "__its_cell"})
    match = (F.col(CELL) == F.col("__its_cell")) & (begins <= F.col(ts))
    match &= stops.isNull() | (F.col(ts) < stops)
    for key, name in names.items():
        match &= F.col(key) == F.col(name)
    found = facts.withColumn(CELL, chosen.of(F.col(ts))).join(laid, match, "left")
    return found.select(*facts.columns, "__version")


def _by_scan(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], ts: str, policy: SkewPolicy
) -> DataFrame:
    version_type = versions.schema["__version"].dataType
    usable = _present([*keys, ts])
    lost = facts.where(~usable).withColumn("__version", F.lit(None).cast(version_type))
    facts = facts.where(usable)
    # A task holds the rows of a key in memory, so it gets what fits there.
    policy = skew.fitted(policy, T.StructType([*facts.schema.fields, *versions.schema.fields]))
    # Where the size is known to be small this costs nothing; else one pass over the keys.
    hot = skew.find_hot(facts.select(*keys).unionByName(versions.select(*keys)), keys, policy)
    if not hot:
        return _scan(facts, versions, keys, ts).unionByName(lost)
    is_hot = skew.is_hot(keys, hot)
    light = _scan(facts.where(~is_hot), versions.where(~is_hot), keys, ts)
    # Facts of a hot key at the same instant share one look-up; the join back may hold many
    # facts per look-up row, which Spark splits at run time.
    heavy = facts.where(is_hot)
    moments = heavy.select(*keys, ts).distinct()
    lookups = _scan(moments, versions.where(is_hot), keys, ts, policy)
    heavy = heavy.join(lookups, [*keys, ts], "left").select(*facts.columns, "__version")
    return light.unionByName(heavy).unionByName(lost)


def _scan(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    ts: str,
    split: SkewPolicy | None = None,
) -> DataFrame:
    """Facts and versions in one order; each fact takes the last version at or before it."""
    events = facts.withColumns({"__at": F.col(ts), "__side": F.lit(1)}).unionByName(
        versions.withColumn("__side", F.lit(0)), allowMissingColumns=True
    )
    within = list(keys)
    if split is not None:
        cuts = skew.choose_cuts(events, keys, "__at", split)
        events = skew.with_chunk(events, keys, "__at", cuts)
        within.append(skew.CHUNK)
    order = Window.partitionBy(*within).orderBy("__at", "__side")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.last("__version", ignorenulls=True).over(running)
    if split is None:
        events = events.withColumn("__version", latest)
    else:
        stated = F.when(F.col("__side") == 0, F.col("__at"))
        carried = F.last("__final", ignorenulls=True).over(
            skew.across(keys).rowsBetween(Window.unboundedPreceding, -1)
        )
        edges = (
            events.groupBy(*keys, skew.CHUNK)
            .agg(F.max_by("__version", stated).alias("__final"))
            .select(*keys, skew.CHUNK, carried.alias("__edge_version"))
        )
        events = skew.attach(events.withColumn("__version", latest), edges, keys)
        events = events.withColumn("__version", F.coalesce("__version", "__edge_version"))
    return events.where("__side = 1").select(*facts.columns, "__version")
