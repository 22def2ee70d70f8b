"""Command line: ``python -m logloom ingest|vectorize|profile|train``.

Run it through ``spark-submit`` on a cluster; the session's own settings apply.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from logloom.functions.formats import FORMATS, MiningConfig
from logloom.operators import profile
from logloom.operators.counts import (
    cell_matrix,
    entity_event_counts,
    entity_totals,
    events_of,
    matrix_columns,
    matrix_density,
    pivot_limit,
    total_summary,
)
from logloom.operators.labels import anomaly_instances, join_labels, label_by_precedence, label_sources
from logloom.operators.models import ModelConfig
from logloom.plans.ingest import ingest, templates
from logloom.plans.train import features_of, train
from logloom.plans.vectorize import block_matrix
from logloom.session import drop_staged
from logloom.sources.ledger import clear
from logloom.sources.labels import read_label_csv, read_label_ids
from logloom.sources.tables import export_cells_csv, export_matrix_csv, read_events, read_or_none, write_table


def _pairs(text: str) -> tuple[str, str]:
    name, label = text.split("=", 1)
    return name, label


def _threshold(text: str) -> float | None:
    return None if text == "off" else float(text)


def _labels(spark: SparkSession, args: argparse.Namespace, events: DataFrame, entity_col: str) -> DataFrame | None:
    if args.labels:
        return read_label_csv(spark, args.labels)
    if not args.source_label:
        return None
    listed = read_label_ids(spark, args.label_ids) if args.label_ids else anomaly_instances(spark)
    sources = spark.createDataFrame(
        [(name, i, label) for i, (name, label) in enumerate(args.source_label)],
        "source string, source_order bigint, source_label string",
    )
    return label_by_precedence(label_sources(events, sources), entity_col, listed)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="logloom")
    parser.add_argument("step", choices=["ingest", "vectorize", "profile", "train"])
    parser.add_argument("--format", choices=sorted(FORMATS), required=True)
    parser.add_argument("--out", required=True, help="folder of all tables of this log family")
    parser.add_argument("--raw", help="folder of the log files")
    parser.add_argument("--sources", nargs="*", help="files below --raw, in this order")
    parser.add_argument("--archive", help="folder read files move to")
    parser.add_argument("--labels", help="CSV of entity id and label")
    parser.add_argument("--label-ids", help="text file that lists anomalous ids")
    parser.add_argument("--source-label", nargs="*", type=_pairs, default=[], help="file=label, in order")
    parser.add_argument("--positive", default="Anomaly")
    parser.add_argument("--folds", type=int, default=10)
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--sim-th", type=float, default=0.4, help="least share of equal tokens of a template")
    parser.add_argument("--depth", type=int, default=4, help="depth of the template tree")
    parser.add_argument("--max-children", type=int, default=100, help="tokens that a tree node keeps")
    parser.add_argument("--no-masks", action="store_true", help="mine the text without masks")
    parser.add_argument("--variance", type=_threshold, default=0.01, help="least variance of a feature, or off")
    parser.add_argument("--correlation", type=_threshold, default=0.95, help="most correlation of a feature, or off")
    parser.add_argument("--clear", nargs="?", const="", help="before ingest forget one source, or all")
    parser.add_argument("--csv", action="store_true", help="also write the matrix as CSV")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("logloom").getOrCreate()
    fmt, out = FORMATS[args.format], args.out.rstrip("/")
    if args.step == "ingest":
        if args.clear is not None:
            clear(spark, f"{out}/ledger", args.clear or None)
        mining = MiningConfig(args.sim_th, args.depth, args.max_children)
        masks = () if args.no_masks else None
        ingest(spark, fmt, args.raw, out, args.sources, mining, args.archive, masks).show(truncate=False)
        table = templates(spark, out)
        write_table(table, f"{out}/templates")
        profile.top_templates(spark.read.parquet(f"{out}/templates")).show(truncate=False)
    elif args.step == "vectorize":
        names = [name for name, _ in args.source_label] or None
        events = read_events(spark, f"{out}/events", names)
        write_table(entity_event_counts(events, fmt.entity_col), f"{out}/counts")
        labels = _labels(spark, args, events, fmt.entity_col)
        if labels is not None:
            write_table(labels, f"{out}/labels")
            labels = spark.read.parquet(f"{out}/labels")
        columns = matrix_columns(spark.read.parquet(f"{out}/templates"))
        counts = spark.read.parquet(f"{out}/counts")
        # A table has a column per event up to a limit, and one array of all cells beyond it.
        narrow = len(columns) <= pivot_limit(spark)
        matrix = block_matrix(counts, columns, labels) if narrow else join_labels(cell_matrix(counts, columns), labels)
        write_table(matrix, f"{out}/matrix")
        matrix = spark.read.parquet(f"{out}/matrix")
        if args.csv and narrow:
            export_matrix_csv(matrix, f"{out}/matrix_csv")
        elif args.csv:
            export_cells_csv(matrix, columns, f"{out}/matrix_csv")
    elif args.step == "profile":
        counts = spark.read.parquet(f"{out}/counts")
        events = events_of(spark.read.parquet(f"{out}/templates")).select("event_id")
        labels = read_or_none(spark, f"{out}/labels")
        tables = {
            "density": matrix_density(counts, events),
            "totals": total_summary(entity_totals(counts)),
            "top_events": profile.top_events(counts, 15),
            "rare_events": profile.rare_events(counts),
            "variance": profile.event_variance(counts, events),
            "correlation": profile.event_correlation(counts, events),
            "missing": profile.missing_profile(spark.read.parquet(f"{out}/matrix")),
            "columns": profile.column_profile(spark.read.parquet(f"{out}/matrix")),
            "low_variance": profile.low_variance(profile.event_variance(counts, events)),
            "correlated": profile.correlated_pairs(profile.event_correlation(counts, events)),
            "top_event_correlation": profile.top_event_correlation(counts),
        }
        if labels is not None:
            labelled = entity_totals(counts).join(labels, "entity_id", "left")
            tables["labels"] = profile.label_distribution(labelled)
            tables["anomaly_rate"] = profile.anomaly_rate(labelled, args.positive)
            tables["top_events_per_label"] = profile.top_events_per_label(counts, labels)
        for name, table in tables.items():
            write_table(table, f"{out}/profile/{name}")
            spark.read.parquet(f"{out}/profile/{name}").show(20, truncate=False)
    else:
        counts = spark.read.parquet(f"{out}/counts")
        events = events_of(spark.read.parquet(f"{out}/templates")).select("event_id")
        labels = spark.read.parquet(f"{out}/labels")
        features, columns = features_of(counts, labels, args.positive, args.variance, args.correlation, events)
        config = ModelConfig(trees=args.trees)
        train(spark, features, columns, f"{out}/model", args.folds, config).show(truncate=False)
    drop_staged(spark)


if __name__ == "__main__":
    main()
