"""Left joins built from a configuration list."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.config import JoinSpec


def build(
    spark: SparkSession,
    specs: Sequence[JoinSpec],
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The configured columns of the first entry's table, left joined to each of the others.

    Tables come from ``tables`` or else from the catalog. A condition is SQL over the aliases.
    How each join runs is left to Spark, which knows the sizes at run time: small tables
    are sent to the tasks, and a hot or NULL key's partition is split. It can split only what it
    shuffles for the join, so give dimensions as tables rather than as window computations.

    An entry with a ``parent`` joins on to that dimension before the dimension joins the base, so
    the base is shuffled once for the pair. Its condition must be equalities with the
    parent's columns; then the result is the same. An entry without columns that matches at
    most one row changes nothing and is left out.
    """
    base, *others = specs
    if base.condition:
        raise ValueError(f"{base.alias}: the first entry is the base and takes no condition")
    parents = {s.parent for s in others}
    kept = [s for s in others if s.columns or not s.unique or s.alias in parents]
    aliases = {s.alias for s in specs}
    for spec in kept:
        if not spec.condition:
            raise ValueError(f"{spec.alias}: a join needs a condition")
        if spec.parent and spec.parent not in aliases:
            raise ValueError(f"{spec.alias}: no entry has the alias {spec.parent}")

    def read(spec: JoinSpec) -> DataFrame:
        found = tables[spec.table] if tables and spec.table in tables else spark.read.table(spec.table)
        return found.alias(spec.alias)

    def grown(spec: JoinSpec) -> DataFrame:
        """The entry's table with the tables that hang off it."""
        frame = read(spec)
        for child in kept:
            if child.parent == spec.alias or (child.parent is None and spec is base):
                frame = frame.join(grown(child), F.expr(child.condition), "left")
        return frame

    listed = {s.alias for s in kept} | {base.alias}
    return grown(base).selectExpr(*[c for s in specs if s.alias in listed for c in s.columns])
