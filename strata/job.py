"""Submit-able ingest job.

``spark-submit --py-files strata.zip strata/job.py --input ... --output ...``
(the zip holds the ``strata`` package), or ``python -m strata.job ...`` where
the package is installed; then the master is ``--master``, the environment's
``SPARK_MASTER``, or local.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from strata.operators.ingest import ingest_json
from strata.session import get_session
from strata.table.versioned import SAVE_MODES

log = logging.getLogger("strata.job")

#: The job's flags and defaults.
TEXT_FLAGS = {
    "input": ("./input/json", "folder of JSON files, on any file system Spark reads"),
    "output": ("./output/table", "where the table lives"),
    "mode": ("overwrite", "what to do with a table that exists"),
    "glob": (None, "only files with such a name"),
    "schema": (None, "columns as DDL text; the input is then read once"),
    "format": ("parquet", "parquet, or delta where it is installed"),
}
SWITCHES = {
    "no-recursive": ("recursive", False, "only the folder itself"),
    "multiline": ("multiline", True, "a file is one document"),
    "no-check-multiline": ("check_multiline", False, "with --multiline: do not look for JSON Lines first"),
    "merge-schema": ("merge_schema", True, "new columns join the table"),
    "overwrite-schema": ("overwrite_schema", True, "with overwrite: columns and partitions are replaced"),
    "skip-unreadable": ("ignore_corrupt_files", True, "read what can be read of damaged files"),
    "no-rebalance": ("rebalance", False, "write partitions as the input is laid out"),
}


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="strata-ingest", description=__doc__.splitlines()[0])
    for name, (default, text) in TEXT_FLAGS.items():
        choices = sorted(set(SAVE_MODES.values())) if name == "mode" else None
        parser.add_argument(f"--{name}", default=default, choices=choices, help=text)
    for name, (target, value, text) in SWITCHES.items():
        parser.add_argument(f"--{name}", dest=target, action="store_const", const=value, default=not value, help=text)
    parser.add_argument("--repartition", type=int, help="writer tasks, rows dealt in turn")
    parser.add_argument("--partition-by", nargs="*", default=["year", "month"], help="table's partition columns")
    parser.add_argument("--master", default=os.environ.get("SPARK_MASTER"), help="outside spark-submit only")
    return parser.parse_args(argv)


def main(argv=None) -> int:
    logging.basicConfig(level=logging.INFO)
    options = vars(parse_args(argv))
    spark = get_session("strata-ingest", master=options.pop("master"))
    source, target = options.pop("input"), options.pop("output")
    result = ingest_json(spark, source, target, **options)
    if result.commit is None:
        log.info("%s: nothing written (mode %s)", target, options["mode"])
    else:
        log.info("%s: version %s from %s, %s rows", target, result.commit.version, source, result.rows_written)
    return 0


if __name__ == "__main__":
    sys.exit(main())
