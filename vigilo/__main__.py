"""Run the layered build: ``python -m vigilo --aact DIR --faers DIR [--layers ...]``.

Takes the session from ``spark-submit`` (or a local one), loads bronze from
the landing folders, then builds silver and gold; one run-log row per table.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from vigilo.operators.joins import SkewSpec
from vigilo.plans.pipeline import Pipeline
from vigilo.sinks.tables import TableStore

LAYERS = ("bronze", "silver", "gold", "measures")


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="vigilo", description=__doc__)
    ap.add_argument("--aact", required=True, help="landing folder of the trial-registry extracts")
    ap.add_argument("--faers", required=True, help="landing folder of the adverse-event extracts")
    ap.add_argument("--layers", nargs="+", choices=LAYERS, default=list(LAYERS[:3]),
                    help="steps to run, in order (measures writes the kpi_* tables)")
    ap.add_argument("--format", default="parquet", help="table format of the session catalog")
    ap.add_argument("--db-prefix", default="pv", help="databases <prefix>_bronze, _silver, _gold, _audit")
    ap.add_argument("--pairs-per-cell", type=int, default=SkewSpec.pairs_per_cell,
                    help="pairs of one report or study above which its joins are split; 0 turns splitting off")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("vigilo").getOrCreate()
    store = TableStore(spark, databases={k: f"{args.db_prefix}_{k}" for k in ("bronze", "silver", "gold", "audit")}, fmt=args.format)
    skew = SkewSpec(pairs_per_cell=args.pairs_per_cell)
    p = Pipeline(spark, {"AACT": args.aact, "FAERS": args.faers}, store=store, skew=skew)
    p.setup()
    written = {layer: getattr(p, layer)() for layer in LAYERS if layer in args.layers}
    print(json.dumps({"run_id": p.log.run_id, "rows_written": written}))
    return written


if __name__ == "__main__":
    main()
