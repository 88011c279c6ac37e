"""Show the first rows of a catalog table: ``python -m strataflow --catalog c --schema s --table t``."""

from __future__ import annotations

import argparse

from strataflow.config import Layers
from strataflow.session import build_session
from strataflow.sources import read_table


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Show the first rows of a table")
    parser.add_argument("--catalog", required=True)
    parser.add_argument("--schema", required=True)
    parser.add_argument("--table", required=True)
    parser.add_argument("--rows", type=int, default=5)
    options = parser.parse_args(arguments)
    spark = build_session()
    Layers("", options.catalog, options.schema).use(spark)
    read_table(spark, options.table).show(options.rows)


if __name__ == "__main__":
    main()
