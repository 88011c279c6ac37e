"""Sums kept by the partitions of a gold table."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import rows

from strataflow.config import CdcSpec
from strataflow.plans.ingest import land
from strataflow.session import children, make_folder, put_marker, remove_folder
from strataflow.sources import stream_files
from strataflow.streaming import SumSpec, apply_changes, kept_sums, rebuild, stage, sums

SCHEMA = "k int, kind string, value double, at date"


def spec_of(**options):
    cdc = CdcSpec("t", ["k"], "at", 2, **{"buckets": 4, "period": "month", **options})
    return SumSpec("open", cdc, ["kind"], {"total": ("value", 2)}, "__END_AT IS NULL" if cdc.scd_type == 2 else None)


def flow(spark, layers, spec, part):
    batch = spark.createDataFrame(part, SCHEMA)
    land(batch, layers.path("bronze", "t"))
    source = stream_files(spark, layers.path("bronze", "t"), batch.schema)
    stage(source, spec.cdc, layers)
    apply_changes(spark, spec.cdc, batch.schema, layers)
    return batch.schema


def want(changes):
    latest = {}
    for k, kind, value, at in changes:
        latest[k] = max(latest.get(k, (date.min,)), (at, kind, value), key=lambda v: v[0])
    found = defaultdict(lambda: [None, 0])
    for _, kind, value in latest.values():
        group = found[kind]
        group[1] += 1
        if value is not None:
            group[0] = (group[0] or 0) + Decimal(str(value))
    return sorted(((k, v, n) for k, (v, n) in found.items()), key=lambda r: [(v is not None, v) for v in r])


def data(seed, n=120):
    rnd = random.Random(seed)
    at = {}
    for _ in range(n):
        k, day = rnd.choice([None, *range(30)]), rnd.randrange(200)
        at[k, day] = (k, rnd.choice(["a", "b", None]), rnd.choice([None, 1.25, 2.5, 100.0]), date(2024, 1, 1) + timedelta(day))
    return sorted(at.values(), key=lambda r: r[3])


@pytest.mark.parametrize("seed, options", [(0, {}), (1, {}), (2, {"scd_type": 1}), (3, {"buckets": 1})])
def test_equal_to_sums_from_scratch_after_each_run(spark, layers, seed, options):
    scd = options.pop("scd_type", 2)
    spec = spec_of(**options) if scd == 2 else SumSpec("t", CdcSpec("t", ["k"], "at", 1, buckets=4), ["kind"], {"total": ("value", 2)})
    changes, seen = data(seed), []
    for part in (changes[60:], changes[:30], changes[30:60], changes[:5]):
        seen += part
        schema = flow(spark, layers, spec, part)
        assert rows(kept_sums(spark, spec, layers, schema)) == want(seen)


def test_only_rewritten_partitions_are_read(spark, layers, monkeypatch):
    spec, asked = spec_of(bucket_expr="k div 10", buckets=3), []
    plain = sums._parts_of
    monkeypatch.setattr(sums, "_parts_of", lambda s, g, new: asked.append(new) or plain(s, g, new))
    old = [(k, "a", 1.0, date(2024, m, 1)) for k in range(30) for m in (1, 2, 3)]
    schema = flow(spark, layers, spec, old)
    kept_sums(spark, spec, layers, schema)
    kept_sums(spark, spec, layers, schema)
    assert len(asked) == 1 and len(asked[0]) == 9
    # News of one bucket: its open versions and those that end now, not the closed history.
    flow(spark, layers, spec, [(25, "b", 7.0, date(2024, 6, 1))])
    assert rows(kept_sums(spark, spec, layers, schema)) == [("a", Decimal("29.00"), 29), ("b", Decimal("7.00"), 1)]
    assert len(asked) == 2 and len(asked[1]) < 5
    assert {v["__bucket"] for v in asked[1].values()} == {"2"}
    plan = plain(spec, spark.read.parquet(layers.path("gold", "t")), asked[1])._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "__until" in plan.toString()


def test_a_broken_run_doesn_t_count(spark, layers):
    spec = spec_of()
    changes = data(5)
    schema = flow(spark, layers, spec, changes[:60])
    kept_sums(spark, spec, layers, schema)
    folder = sums._folder(spec, layers)
    (run,) = children(spark, folder)
    remove_folder(spark, f"{folder}/{run}/_done")
    make_folder(spark, f"{folder}/00000099-cut")
    assert rows(kept_sums(spark, spec, layers, schema)) == want(changes[:60])
    assert "00000099-cut" not in children(spark, folder)


def test_runs_are_folded_and_a_broken_fold_counts_once(spark, layers, monkeypatch):
    monkeypatch.setattr(sums, "MOST_RUNS", 2)
    spec, seen, changes = spec_of(buckets=2), [], data(6)
    real = sums.remove_folder
    for n in range(5):
        seen += changes[n * 24 : n * 24 + 24]
        schema = flow(spark, layers, spec, changes[n * 24 : n * 24 + 24])
        if n == 2:  # dies before the old runs are gone
            def die(spark, path):
                if not path.rsplit("/", 1)[1].startswith("__part"):
                    raise KeyboardInterrupt
                real(spark, path)

            monkeypatch.setattr(sums, "remove_folder", die)
            with pytest.raises(KeyboardInterrupt):
                kept_sums(spark, spec, layers, schema)
            monkeypatch.setattr(sums, "remove_folder", real)
        assert rows(kept_sums(spark, spec, layers, schema)) == want(seen)
        assert len(children(spark, sums._folder(spec, layers))) <= 3


def test_rules_and_rebuilds_are_seen(spark, layers):
    spec, changes = spec_of(), data(7)
    schema = flow(spark, layers, spec, changes)
    kept_sums(spark, spec, layers, schema)
    ruled = spec_of(rules={"known": "kind = 'a'"})
    rebuild(spark, ruled.cdc, schema, layers)
    assert rows(kept_sums(spark, ruled, layers, schema)) == want([c for c in changes if c[1] == "a"])


def test_unknown_columns_are_refused(spark, layers):
    spec = spec_of()
    schema = flow(spark, layers, spec, data(8))
    with pytest.raises(ValueError, match="nothing"):
        kept_sums(spark, SumSpec("x", spec.cdc, ["nothing"], {"total": ("value", 2)}), layers, schema)
