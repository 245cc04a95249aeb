"""Command line: the daily build over the driver tables, marts exported as CSV.

    python -m hirelake.plans.run --sf-dir /root/testdata/sf0.01 --out <shared folder> [--as-of 2001-08-01]

On a cluster, submit it with ``spark-submit`` and the settings of
``hirelake.session.cluster_conf``; ``--out`` must be shared storage.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from ..sources import adapters as ad
from ..sources import sinks
from .pipeline import Inputs, build_all, export_marts


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="hirelake.plans.run")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", default=ad.AS_OF)
    p.add_argument("--no-export", action="store_true")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("hirelake-daily").getOrCreate()
    ensure_checkpoint_dir(spark)
    inputs = Inputs(pages=ad.raw_pages(spark, args.sf_dir), typed=ad.typed_postings(spark, args.sf_dir),
                    country=ad.country_dim(spark, args.sf_dir),
                    skill_dim=ad.brand_skills(spark, args.sf_dir))
    result = build_all(spark, inputs, args.out, args.as_of)
    if args.no_export:
        print(json.dumps({name: sinks.report(df)["rows"] for name, df in result.items()}))
    else:
        print(json.dumps(export_marts(result, f"{args.out}/marts")))


if __name__ == "__main__":
    main()
