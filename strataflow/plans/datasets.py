"""Datasets that are made from others: each says what it reads, and a refresh follows from that."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from strataflow.config import Layers
from strataflow.session import put_marker, read_marker
from strataflow.streaming.sinks import newest_snapshot, write_snapshot

LAYER = "datasets"


@dataclass(frozen=True)
class Dataset:
    """A table made by ``build`` from the tables in ``reads``, which are datasets or sources, in that order.

    ``rules`` must hold for all its rows, else the snapshot before stays. ``keep`` snapshots are kept: at least
    two, so that who reads the one before can go on.
    """

    name: str
    reads: Sequence[str]
    build: Callable[..., DataFrame]
    rules: Mapping[str, str] = field(default_factory=dict)
    keep: int | None = None

    def __post_init__(self) -> None:
        if self.keep is not None and self.keep < 2:
            raise ValueError(f"{self.name}: keep must be 2 or more")


@dataclass(frozen=True)
class Refreshed:
    """What became of a dataset: ``written`` (with its folder), ``failed`` (with the error) or ``skipped``."""

    name: str
    status: str
    folder: str | None = None
    error: str | None = None


class RefreshFailed(RuntimeError):
    """Some datasets could not be made; ``outcomes`` tells of all."""

    def __init__(self, text: str, outcomes: Sequence[Refreshed]):
        super().__init__(text)
        self.outcomes = list(outcomes)


def in_order(datasets: Sequence[Dataset]) -> list[str]:
    """All names, each after those that it reads; a cycle or a name given twice is refused."""
    names = [d.name for d in datasets]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"given twice: {', '.join(twice)}")
    try:
        order = list(TopologicalSorter({d.name: d.reads for d in datasets}).static_order())
    except CycleError as error:
        raise ValueError(f"datasets read each other: {' <- '.join(error.args[1])}") from error
    return [n for n in order if n in names]


def dependents(datasets: Sequence[Dataset], names: Sequence[str]) -> list[str]:
    """``names`` and all that is made from them, over any number of steps, in order."""
    order, reads = in_order(datasets), {d.name: d.reads for d in datasets}
    unknown = sorted({n for n in names} - {*order, *(r for d in datasets for r in d.reads)})
    if unknown:
        raise ValueError(f"no such dataset or source: {', '.join(unknown)}")
    found = set(names)
    for name in order:
        if found & set(reads[name]):
            found.add(name)
    return [n for n in order if n in found]


def _made_from(spark: SparkSession, layers: Layers, name: str, folder: str) -> dict[str, str] | None:
    """The snapshots that a snapshot was made from; None if that isn't known."""
    text = read_marker(spark, f"{layers.state(LAYER, name)}/{folder.rsplit('/', 1)[1]}")
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def stale(spark: SparkSession, datasets: Sequence[Dataset], layers: Layers) -> list[str]:
    """Datasets that were never made, or not from the newest snapshots of what they read, and all made from them.

    After a refresh that failed in part, these are what is left of it. Whether a source has news isn't known here.
    """
    known = {d.name for d in datasets}
    newest = {n: newest_snapshot(spark, layers.path(LAYER, n)) for n in known}

    def old(d: Dataset) -> bool:
        if newest[d.name] is None:
            return True
        made = _made_from(spark, layers, d.name, newest[d.name])
        return made != {r: newest[r].rsplit("/", 1)[1] for r in d.reads if r in known and newest[r]}

    return dependents(datasets, [d.name for d in datasets if old(d)])


def refresh(
    spark: SparkSession,
    datasets: Sequence[Dataset],
    source: Callable[[str], DataFrame],
    layers: Layers,
    only: Sequence[str] | None = None,
    below: bool = True,
    parallel: int = 4,
) -> list[Refreshed]:
    """Make all datasets anew, or those in ``only`` and (``below``) all that is made from them.

    ``only`` may name sources too: what reads them. What a chosen one reads and was never made is made first.
    Each reads the very snapshots that this pass wrote, or else the newest when it begins; datasets that do
    not wait for each other are made at once. If one fails, those made from it are skipped and keep their
    last snapshot, the others go on, and all failures are raised together at the end.
    """
    by_name, order = {d.name: d for d in datasets}, in_order(datasets)
    chosen = set(order)
    if only is not None:
        reached = dependents(datasets, only)
        direct = {n for n in order if n in only or set(by_name[n].reads) & (set(only) - set(order))}
        chosen = set(reached) if below else direct
    folders = {n: newest_snapshot(spark, layers.path(LAYER, n)) for n in order}
    for name in reversed(order):
        if name in chosen:
            chosen |= {r for r in by_name[name].reads if r in by_name and folders[r] is None}

    def make(d: Dataset) -> str:
        inputs = [spark.read.parquet(folders[r]) if r in by_name else source(r) for r in d.reads]
        path = layers.path(LAYER, d.name)
        folder = write_snapshot(d.build(*inputs), path, d.rules or None, d.keep)
        made = {r: folders[r].rsplit("/", 1)[1] for r in d.reads if r in by_name}
        put_marker(spark, f"{layers.state(LAYER, d.name)}/{folder.rsplit('/', 1)[1]}", json.dumps(made))
        return folder

    graph = TopologicalSorter({n: [r for r in by_name[n].reads if r in chosen] for n in order if n in chosen})
    graph.prepare()
    done: dict[str, Refreshed] = {}
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        while graph.is_active():
            for name in graph.get_ready():
                broken = [r for r in by_name[name].reads if r in done and done[r].status != "written"]
                if broken:
                    done[name] = Refreshed(name, "skipped", error=f"{', '.join(broken)} not made")
                    graph.done(name)
                else:
                    running[pool.submit(make, by_name[name])] = name
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name, error = running.pop(future), future.exception()
                if error is None:
                    folders[name] = future.result()
                    done[name] = Refreshed(name, "written", folders[name])
                else:
                    done[name] = Refreshed(name, "failed", error=str(error))
                graph.done(name)
    failed = [d for d in done.values() if d.status == "failed"]
    if failed:
        raise RefreshFailed("; ".join(f"{d.name}: {d.error}" for d in failed), [done[n] for n in order if n in done])
    return [done[n] for n in order if n in done]


def read_dataset(spark: SparkSession, layers: Layers, name: str) -> DataFrame:
    """The newest snapshot of a dataset."""
    folder = newest_snapshot(spark, layers.path(LAYER, name))
    if folder is None:
        raise FileNotFoundError(f"{name} was never made")
    return spark.read.parquet(folder)
