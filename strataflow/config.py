"""Configuration objects: a new table or a new join is one more entry, not new code."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layers:
    """Where the layers live: a base path, or a catalog and schema for named tables."""

    base: str
    catalog: str | None = None
    schema: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def table(self, layer: str, table: str) -> str | None:
        """The name of a layer's table in the configured schema, if there is one."""
        parts = [self.catalog, self.schema, f"{layer}_{table.lower()}"]
        return ".".join(p for p in parts if p) if self.schema else None

    def checkpoint(self, flow: str) -> str:
        """One checkpoint folder per flow; two flows must never share one."""
        return f"{self.base.rstrip('/')}/_checkpoints/{flow}"

    def state(self, kind: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/_state/{kind}/{table}"

    def use(self, spark: SparkSession) -> None:
        """Make the configured catalog and schema the session's current ones."""
        if self.catalog:
            spark.catalog.setCurrentCatalog(self.catalog)
        if self.schema:
            spark.catalog.setCurrentDatabase(self.schema)


@dataclass(frozen=True)
class SkewPolicy:
    """When and how a key with too many rows for one task is split.

    Inputs estimated below ``check_above_bytes`` are not examined: a task can sort all of it.
    Above that, a key with ``rows_per_task`` rows or more is cut into runs of about that size. What a task holds
    in memory, such as the rows of a point-in-time join by time, also stays near ``bytes_per_task``.
    """

    rows_per_task: int = 20_000_000
    check_above_bytes: int = 1 << 30
    bytes_per_task: int = 256 << 20
    tracked_items: int = 16_384
    max_hot_keys: int = 4_096


@dataclass(frozen=True)
class CdcSpec:
    """How a table of change rows becomes a type 1 (latest) or type 2 (history) table.

    ``bucket_expr`` may replace the default hash bucket by any expression over the keys, such
    as ``stream_id div 100000000``: keys that grow with time then change only the newest buckets.

    ``merge`` says what a micro-batch is merged with. ``"log"`` recomputes the touched buckets from all
    their change rows. ``"table"`` merges the new rows with the table's own rows; a history
    is then also partitioned by the ``period`` (week, month, quarter or year) in which its versions
    end, and only the periods from the oldest new row on are read and rewritten. It needs a date or time
    as sequence. With ``untracked`` columns a late row that falls into a version of several changes has
    that version's changes read from the log. ``"auto"`` is the table where that is given, else the log.

    ``compact_after`` says after how many batches the log is compacted; None: never.

    ``on_broken`` says what becomes of rows that break a rule: ``"drop"`` leaves them out (the stage can
    keep them in quarantine), ``"fail"`` stops the flow before the table is touched.
    """

    table: str
    keys: Sequence[str]
    sequence_by: str
    scd_type: int = 2
    rules: Mapping[str, str] = field(default_factory=dict)
    untracked: Sequence[str] = ()
    buckets: int = 64
    bucket_expr: str | None = None
    merge: str = "auto"
    period: str = "month"
    name: str | None = None
    once: bool = True
    skew: SkewPolicy = field(default_factory=SkewPolicy)
    on_broken: str = "drop"
    compact_after: int | None = 16

    def __post_init__(self) -> None:
        if self.scd_type not in (1, 2):
            raise ValueError(f"{self.table}: scd_type must be 1 or 2")
        if self.merge not in ("auto", "log", "table"):
            raise ValueError(f"{self.table}: merge must be auto, log or table")
        if self.on_broken not in ("drop", "fail"):
            raise ValueError(f"{self.table}: on_broken must be drop or fail")

    def resolved(self, schema: T.StructType) -> CdcSpec:
        """The same with ``merge`` settled for change rows of this schema."""
        if self.merge != "auto":
            return self
        timed = isinstance(
            schema[self.sequence_by].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)
        )
        return replace(self, merge="table" if self.scd_type == 1 or timed else "log")

    @property
    def by_period(self) -> bool:
        return self.merge == "table" and self.scd_type == 2

    @property
    def scheme(self) -> str:
        """What decides the bucket of a key."""
        return repr((list(self.keys), self.buckets, self.bucket_expr))

    @property
    def fingerprint(self) -> str:
        """What the rows and the layout of the table depend on."""
        shape = (self.sequence_by, self.scd_type, sorted(self.rules.items()), sorted(self.untracked))
        return repr((self.scheme, *shape, self.merge, self.period if self.by_period else None))

    @property
    def flow(self) -> str:
        return self.name or self.table


@dataclass(frozen=True)
class IngestSpec:
    """One source table to copy by its change column; ``from_date`` replaces the sentinel."""

    table: str
    cdc_col: str
    schema: str = "dbo"
    from_date: str | None = None
    overlap: str | None = None


@dataclass(frozen=True)
class JoinSpec:
    """One table of a configured join; the first of a list is the base and has no condition.

    ``parent`` names the dimension a snowflaked table hangs off, which is then joined to
    that dimension first. ``unique`` states that at most one row matches.
    """

    table: str
    alias: str
    cols: str | Sequence[str] = ()
    condition: str | None = None
    parent: str | None = None
    unique: bool = False

    @property
    def columns(self) -> list[str]:
        parts = self.cols.split(",") if isinstance(self.cols, str) else self.cols
        return [part.strip() for part in parts if part.strip()]


@dataclass(frozen=True)
class TableSpec:
    """Everything the pipeline knows about one table, from source to gold.

    ``dedupe`` is ``"change"`` (repeated copies of a change go, so history survives),
    ``"key"`` (the first row of a key stays for ever) or ``None``. ``salts=0`` leaves
    out the thinning of copies before their shuffle (see ``stream_dedupe``). ``within`` (such as ``"30 days"``) bounds what is remembered: a row
    is compared with those that silver has from that long before its batch's oldest one on, by way of a small
    filter per day, and there is no state; see ``append_known``. A backlog of bronze files is taken in micro-batches of
    ``bytes_per_batch``, so that a run cut short loses no more than one of them. ``archive`` is a folder
    outside the layer that read bronze files move to, so that the listing stays short; rows that
    are there count as not landed when late rows are looked for.
    """

    ingest: IngestSpec
    cdc: CdcSpec
    clean: Sequence[Callable[[DataFrame], DataFrame]] = ()
    drop: Sequence[str] = ("_rescued_data",)
    dedupe: str | None = None
    salts: int = 16
    within: str | None = None
    bytes_per_batch: int = 1 << 40
    archive: str | None = None

    @property
    def table(self) -> str:
        return self.cdc.table
