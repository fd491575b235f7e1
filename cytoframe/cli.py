"""Command line: plan a run, run it, apply labels, summarise features, merge tables."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cytoframe", description=__doc__)
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name in ("plan", "run"):
        verbs.add_parser(name).add_argument("--config", required=True)
    labels = verbs.add_parser("labels")
    for flag in ("--metadata", "--registry", "--output"):
        labels.add_argument(flag, required=True)
    labels.add_argument("--source", default="plate_scene")
    labels.add_argument("--how", default="left")
    summary = verbs.add_parser("summary")
    summary.add_argument("--features", required=True)
    merge = verbs.add_parser("merge")
    for flag in ("--existing", "--new", "--output"):
        merge.add_argument(flag, required=True)
    args = parser.parse_args(argv)

    from cytoframe.plans import config

    if args.verb == "plan":
        print("\n".join(config.plan(config.load(Path(args.config).read_text()))))
        return 0

    from cytoframe.operators import aggregates, joins
    from cytoframe.operators import labels as L
    from cytoframe.session import session

    spark = session()
    if args.verb == "run":
        from cytoframe.plans import pipeline
        from cytoframe.sources import tiff

        run = config.load(Path(args.config).read_text())
        planes = tiff.read_planes(spark, run.inputs.image_dir, run.inputs.pattern, run.inputs.recursive)
        names = [run.segmentation.phase_channel, *run.crops.channels]
        named = planes.where(F.col("error").isNull()).withColumn("channel", F.coalesce(F.get(F.array(*map(F.lit, names)), F.col("page")), F.col("channel")))
        sources = tiff.list_files(spark, run.inputs.image_dir, run.inputs.pattern, run.inputs.recursive).select("image_id", F.col("path").alias("source_path"))
        registry = L.load_registry(spark, run.labels.registry) if run.labels.registry else None
        print(pipeline.run_all(spark, named, sources, run, registry).count())
    elif args.verb == "labels":
        cells = spark.read.csv(args.metadata, header=True, inferSchema=False)
        out = L.apply_registry(L.with_key(cells, args.source), L.load_registry(spark, args.registry), args.how)
        out.write.mode("overwrite").option("header", True).csv(args.output)
        L.match_report(L.with_key(cells, args.source), L.load_registry(spark, args.registry)).show()
    elif args.verb == "summary":
        aggregates.feature_summary(spark.read.parquet(args.features)).orderBy("feature").show(1000, truncate=False)
    elif args.verb == "merge":
        joins.merge_existing(spark.read.parquet(args.existing), spark.read.parquet(args.new)).write.mode("overwrite").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
