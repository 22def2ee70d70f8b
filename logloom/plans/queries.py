"""Every operator as a query ``(spark, sf_dir) -> DataFrame`` over the analytics tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import text
from logloom.functions.formats import BLOCK_LOG, VM_LOG, LogFormat, MiningConfig
from logloom.operators import counts as C
from logloom.operators import labels as L
from logloom.operators import metrics as M
from logloom.operators import models, profile, selection
from logloom.operators import templates as T
from logloom.operators.folds import stratified_folds
from logloom.operators.parse import explode_entities, parse_lines
from logloom.plans.structure import Structured, signed_events, structure
from logloom.plans.train import features_of
from logloom.plans.vectorize import block_matrix, vm_matrix
from logloom.session import new_dir, stage, stage_at
from logloom.sources import ledger, samples
from logloom.sources.labels import label_ids
from logloom.sources.lines import clean_lines, fingerprints, read_lines
from logloom.sources.tables import read_events
from logloom.streaming import ingest as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Lines of a rendered log file, at any size of the table.
LINES_PER_FILE = 4000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return samples.table(spark, sf, "events")


def _block(spark: SparkSession, sf: str) -> DataFrame:
    return samples.block_lines(_events(spark, sf))


def _vm(spark: SparkSession, sf: str) -> DataFrame:
    return samples.vm_lines(_events(spark, sf))


def _parsed(lines: DataFrame, fmt: LogFormat) -> DataFrame:
    return parse_lines(clean_lines(lines), fmt)


def _structured(spark: SparkSession, sf: str) -> Structured:
    return structure(_block(spark, sf), BLOCK_LOG)


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.entity_event_counts(_structured(spark, sf).events, BLOCK_LOG.entity_col)


def _counted(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Counts, and the events of the template table as matrix columns."""
    found = _structured(spark, sf)
    return C.entity_event_counts(found.events, BLOCK_LOG.entity_col), C.matrix_columns(found.templates)


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return samples.block_labels(_events(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks with total_events and label; some labels are missing."""
    return L.join_labels(C.entity_totals(_counts(spark, sf)), _labels(spark, sf))


def _matrix(spark: SparkSession, sf: str) -> DataFrame:
    counts, columns = _counted(spark, sf)
    return block_matrix(counts, columns, _labels(spark, sf))


def _quantity(spark: SparkSession, sf: str) -> DataFrame:
    # Profiles read the counts several times, as they would read the counts table of a job.
    return stage(samples.quantity_counts(samples.table(spark, sf, "lineitem")), "counts")


def _quantity_events(spark: SparkSession, sf: str) -> DataFrame:
    return samples.quantity_events(samples.table(spark, sf, "lineitem"))


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    return samples.event_scores(_events(spark, sf))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Sources ---------------------------------------------------------------------------------


@query
def scan_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = samples.document_lines(samples.table(spark, sf, "documents"))
    return clean_lines(lines).select("source", "LineId", "value")


def _line_files(spark: SparkSession, sf: str) -> str:
    """Block lines as text files of ``LINES_PER_FILE`` consecutive lines; the folder."""
    folder = new_dir(spark, "raw")
    lines = _block(spark, sf)
    lines = lines.select("value", "LineId", F.floor((F.col("LineId") - 1) / LINES_PER_FILE).alias("part"))
    lines = lines.repartition("part").sortWithinPartitions("part", "LineId")
    lines.select("value", "part").write.partitionBy("part").text(folder)
    return folder


@query
def line_number(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_lines(spark, _line_files(spark, sf), "*.txt")
    part = F.regexp_extract("source", r"part=(\d+)", 1).cast("bigint")
    return lines.select(part.alias("part"), "source_order", "LineId", "value")


@query
def label_ids_from_text(spark: SparkSession, sf: str) -> DataFrame:
    return label_ids(samples.label_text(_events(spark, sf)))


def _source_labels(spark: SparkSession) -> DataFrame:
    rows = [("normal1.log", "Normal"), ("normal2.log", "Normal"), ("abnormal.log", "Anomaly"), ("absent.log", "Normal")]
    return spark.createDataFrame(rows, "source string, source_label string")


@query
def tagged_union(spark: SparkSession, sf: str) -> DataFrame:
    tagged = L.label_sources(_vm(spark, sf), _source_labels(spark))
    return tagged.groupBy("source", "source_label").agg(F.count("*").alias("lines"), F.sum("LineId").alias("line_sum"))


@query
def source_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints(_vm(spark, sf))


def _ledger_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A ledger with one row per event: users as sources, some rows clear their source."""
    return _events(spark, sf).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".log")).alias("source"),
        F.md5(F.col("event_id").cast("string")).alias("fingerprint"),
        F.timestamp_seconds(F.col("event_id") + 1_700_000_000).alias("ingested_at"),
        F.col("event_id").alias("num_lines"),
        (F.col("event_id") % 50).alias("num_templates"),
        (F.col("event_id") % 7 == 3).alias("cleared"),
    )


@query
def ledger_latest(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.latest(_ledger_rows(spark, sf)).drop("ingested_at")


@query
def ingest_plan(spark: SparkSession, sf: str) -> DataFrame:
    users = _events(spark, sf).groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    source = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".log"))
    changed = F.when(F.col("user_id") % 4 == 1, F.lit("changed")).otherwise(F.md5(F.col("event_id").cast("string")))
    present = users.filter("user_id % 3 != 0").select(source.alias("source"), changed.alias("fingerprint"))
    return ledger.plan_ingest(users.select(source.alias("source")), present, ledger.latest(_ledger_rows(spark, sf)))


# Parsing and scalar functions --------------------------------------------------------------


@query
def parse_block_logs(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(_block(spark, sf), BLOCK_LOG).select("LineId", *BLOCK_LOG.fields, "BlockId", "is_parsed")


@query
def parse_vm_logs(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(_vm(spark, sf), VM_LOG).select("source", "LineId", *VM_LOG.fields, "InstanceId", "is_parsed")


@query
def unparsed_lines(spark: SparkSession, sf: str) -> DataFrame:
    events = _parsed(_vm(spark, sf), VM_LOG).filter(~F.col("is_parsed"))
    return events.select("source", "LineId", *VM_LOG.fields, "InstanceId")


@query
def entity_extract_block(spark: SparkSession, sf: str) -> DataFrame:
    return _block(spark, sf).select("LineId", text.first_entity(F.col("value"), BLOCK_LOG).alias("entity_id"))


@query
def entity_extract_all(spark: SparkSession, sf: str) -> DataFrame:
    events = _parsed(_block(spark, sf), BLOCK_LOG)
    # Two blocks per line, to name more than one.
    events = events.withColumn("Content", F.concat("Content", F.lit(" after blk_"), F.col("LineId") % 20))
    return explode_entities(events, BLOCK_LOG).select("LineId", F.col("BlockId").alias("entity_id"))


@query
def entity_extract_instance(spark: SparkSession, sf: str) -> DataFrame:
    return _vm(spark, sf).select("LineId", text.first_entity(F.col("value"), VM_LOG).alias("entity_id"))


@query
def mask_content(spark: SparkSession, sf: str) -> DataFrame:
    events = _parsed(_block(spark, sf), BLOCK_LOG)
    return events.select("LineId", text.mask(F.col("Content"), BLOCK_LOG.masks).alias("masked"))


@query
def binary_target(spark: SparkSession, sf: str) -> DataFrame:
    return L.binary_target(_labelled(spark, sf), "Anomaly").select("entity_id", "label", "target")


@query
def template_preview(spark: SparkSession, sf: str) -> DataFrame:
    lines = clean_lines(samples.document_lines(samples.table(spark, sf, "documents")))
    return lines.select("source", "LineId", text.preview(F.col("value")).alias("preview"))


# Template mining ---------------------------------------------------------------------------


def _signed(spark: SparkSession, sf: str) -> DataFrame:
    return signed_events(_vm(spark, sf), VM_LOG)


@query
def token_shape(spark: SparkSession, sf: str) -> DataFrame:
    words = text.tokens(F.col("signature"))
    keys = F.transform(words, text.head_token)
    return _signed(spark, sf).select(
        "LineId", F.size(words).alias("n_tokens"), F.array_join(keys, " ").alias("leaf_tokens")
    )


@query
def signature_counts(spark: SparkSession, sf: str) -> DataFrame:
    return T.signature_counts(_signed(spark, sf))


@query
def signature_counts_unmasked(spark: SparkSession, sf: str) -> DataFrame:
    return T.signature_counts(signed_events(_vm(spark, sf), VM_LOG, masks=()))


def _document_signatures(spark: SparkSession, sf: str) -> DataFrame:
    lines = samples.document_lines(samples.table(spark, sf, "documents"))
    return stage_at(T.signature_counts(signed_events(lines, BLOCK_LOG)), "signatures", compression="zstd")[0]


@query
def template_leaf(spark: SparkSession, sf: str) -> DataFrame:
    leaves = T.assign_leaves(_document_signatures(spark, sf), MiningConfig(max_children=5))
    return leaves.select("signature", "n_tokens", F.array_join("heads", " ").alias("head"))


@query
def template_table_exact(spark: SparkSession, sf: str) -> DataFrame:
    return structure(_vm(spark, sf), VM_LOG).templates


@query
def line_events(spark: SparkSession, sf: str) -> DataFrame:
    return structure(_vm(spark, sf), VM_LOG).events.select("LineId", "EventId", "EventTemplate")


@query
def template_groups(spark: SparkSession, sf: str) -> DataFrame:
    signatures = _document_signatures(spark, sf)
    _, assignment = T.mine(signatures, MiningConfig())
    return signatures.join(assignment, "signature").select("signature", "lines", "event_no", "EventId")


@query
def template_table(spark: SparkSession, sf: str) -> DataFrame:
    return structure(_vm(spark, sf), VM_LOG, MiningConfig()).templates


@query
def template_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Two of the sources first, then all of them on top of that dictionary."""
    lines = _vm(spark, sf)
    first = structure(lines.filter("source_order < 3"), VM_LOG, MiningConfig())
    return structure(lines, VM_LOG, MiningConfig(), first.dictionary).templates


# Labels ------------------------------------------------------------------------------------


@query
def label_join(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf)


def _tagged_vm(spark: SparkSession, sf: str) -> DataFrame:
    return L.label_sources(_parsed(_vm(spark, sf), VM_LOG), _source_labels(spark))


@query
def label_precedence(spark: SparkSession, sf: str) -> DataFrame:
    return L.label_by_precedence(_tagged_vm(spark, sf), "InstanceId", samples.vm_anomalies(_events(spark, sf)))


@query
def label_default(spark: SparkSession, sf: str) -> DataFrame:
    return L.label_or_default(C.entity_totals(_counts(spark, sf)), _labels(spark, sf))


# Counts and matrix -------------------------------------------------------------------------


@query
def entity_event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _counts(spark, sf)


@query
def occurrence_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return C.occurrence_matrix(*_counted(spark, sf))


@query
def labelled_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _matrix(spark, sf)


@query
def vm_labelled_matrix(spark: SparkSession, sf: str) -> DataFrame:
    result = structure(_vm(spark, sf), VM_LOG)
    columns = C.matrix_columns(result.templates)
    anomalies = samples.vm_anomalies(_events(spark, sf))
    return vm_matrix(result.events, VM_LOG, columns, _source_labels(spark), anomalies)


@query
def dropped_events(spark: SparkSession, sf: str) -> DataFrame:
    return C.dropped_events(_quantity(spark, sf), ["E1", "E2", "E5"])


@query
def entity_totals(spark: SparkSession, sf: str) -> DataFrame:
    return C.entity_totals(_counts(spark, sf))


@query
def matrix_density(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.matrix_density(_quantity(spark, sf), _quantity_events(spark, sf)), "density_pct")


@query
def total_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(C.total_summary(C.entity_totals(_quantity(spark, sf))), "mean_events", "median_events")


# Profiles ----------------------------------------------------------------------------------


@query
def top_events(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.top_events(_quantity(spark, sf), 10), "pct")


@query
def rare_events(spark: SparkSession, sf: str) -> DataFrame:
    return profile.rare_events(_quantity(spark, sf))


@query
def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.label_distribution(_labelled(spark, sf)), "pct")


@query
def class_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.class_ratio(_labelled(spark, sf)), "ratio")


@query
def majority_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.majority_ratio(_labelled(spark, sf)), "ratio")


@query
def anomaly_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.anomaly_rate(_labelled(spark, sf)), "rate_pct")


@query
def entity_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return profile.entity_coverage(_parsed(_vm(spark, sf), VM_LOG), "InstanceId")


@query
def parse_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.parse_stats(structure(_vm(spark, sf), VM_LOG).events)


@query
def top_templates(spark: SparkSession, sf: str) -> DataFrame:
    return profile.top_templates(structure(_vm(spark, sf), VM_LOG).templates)


@query
def events_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return profile.events_by_label(_counts(spark, sf), _labels(spark, sf), ["Normal", "Anomaly"])


@query
def top_events_per_label(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.top_events_per_label(_counts(spark, sf), _labels(spark, sf), 3), "pct")


@query
def missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.missing_profile(_matrix(spark, sf)), "missing_pct")


@query
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(_matrix(spark, sf))


@query
def event_variance(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.event_variance(_quantity(spark, sf), _quantity_events(spark, sf)), "variance")


@query
def low_variance_events(spark: SparkSession, sf: str) -> DataFrame:
    variances = profile.event_variance(_quantity(spark, sf), _quantity_events(spark, sf))
    return _rounded(profile.low_variance(variances, 0.7), "variance")


@query
def event_correlation(spark: SparkSession, sf: str) -> DataFrame:
    pairs = profile.event_correlation(_quantity(spark, sf), _quantity_events(spark, sf))
    return _rounded(pairs, "r").select("event_a", "event_b", "r")


@query
def large_count_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Counts near 10^11 whose differences are small: prices in cents per customer and priority."""
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) + F.lit(10**11)
    counts = samples.table(spark, sf, "orders").groupBy(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("entity_id"),
        F.concat(F.lit("E"), F.substring("o_orderpriority", 1, 1)).alias("event_id"),
    )
    found = profile.event_correlation(stage(counts.agg(cents.alias("n")), "counts"))
    return _rounded(found.select("event_a", "event_b", "r"), "r")


@query
def correlated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = profile.event_correlation(_quantity(spark, sf), _quantity_events(spark, sf))
    return _rounded(profile.correlated_pairs(pairs, symmetric=True), "r")


@query
def top_event_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(profile.top_event_correlation(_quantity(spark, sf), 5), "r").select("event_a", "event_b", "r")


# Feature selection -------------------------------------------------------------------------


@query
def select_variance(spark: SparkSession, sf: str) -> DataFrame:
    return selection.select_by_variance(_quantity(spark, sf), 0.7, _quantity_events(spark, sf))


@query
def select_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return selection.select_features(_quantity(spark, sf), 0.01, 0.95, _quantity_events(spark, sf))


@query
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    counts, columns = _counted(spark, sf)
    matrix = L.join_labels(C.occurrence_matrix(counts, columns), _labels(spark, sf))
    table = selection.feature_table(L.binary_target(matrix, "Anomaly"))
    slots = vector_to_array("features")
    return table.select(
        "entity_id", "target", *[slots[i].cast("bigint").alias(f"x{i + 1}") for i in range(len(columns))]
    )


@query
def feature_table_sparse(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    counts, columns = _counted(spark, sf)
    table = selection.sparse_feature_table(counts, columns, _labels(spark, sf), "Anomaly")
    slots = vector_to_array("features")
    return table.select(
        "entity_id", "target", *[slots[i].cast("bigint").alias(f"x{i + 1}") for i in range(len(columns))]
    )


@query
def cell_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The matrix as one array of cells per entity, as text."""
    matrix = C.cell_matrix(_quantity(spark, sf), [f"E{i}" for i in (1, 2, 5, 9, 12, 77)])
    return matrix.withColumn("cells", F.array_join("cells", ","))


@query
def strong_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """Also pairs that never meet: a part's lines fall into halves by quantity."""
    halves = F.when(F.col("l_quantity") <= 25, "E21").otherwise("E22")
    facts = samples.table(spark, sf, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("entity_id"),
        F.explode(F.array(halves, F.concat(F.lit("E"), (F.col("l_linenumber") + 2).cast("string")))).alias("event_id"),
    )
    counts = stage(facts.groupBy("entity_id", "event_id").agg(F.count("*").alias("n")), "counts")
    found = profile.strong_correlations(counts, 0.05)
    return _rounded(found.select("event_a", "event_b", "r"), "r")


@query
def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    return selection.feature_summary(L.binary_target(_labelled(spark, sf), "Anomaly"))


# Modelling and evaluation ------------------------------------------------------------------


@query
def stratified_folds_query(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_folds(L.binary_target(_labelled(spark, sf), "Anomaly").select("entity_id", "target"))


QUERIES["stratified_folds"] = QUERIES.pop("stratified_folds_query")


@query
def precision_recall(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.precision_recall(_scores(spark, sf), ("model", "fold")), "precision", "recall", "f1")


@query
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(M.roc_auc(_scores(spark, sf), ("model", "fold")), "auc")


@query
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = M.roc_curve(_scores(spark, sf), ("model",))
    curve = curve.withColumn("threshold", F.nullif("threshold", F.lit(float("inf"))))
    return _rounded(curve, "threshold", "fpr", "tpr")


@query
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_matrix(_scores(spark, sf), ("model", "fold"))


@query
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    metrics = [f"{kind}_{name}" for kind in ("mean", "std") for name in ("precision", "recall", "auc")]
    return _rounded(M.cv_summary(M.cv_results(_scores(spark, sf))), *metrics)


@query
def best_model(spark: SparkSession, sf: str) -> DataFrame:
    summary = M.cv_summary(M.cv_results(_scores(spark, sf)))
    return _rounded(M.best_model(summary, list(models.MODELS)), "mean_auc")


def _document_features(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Documents as entities, line lengths as events, low quality as the anomaly."""
    lines = clean_lines(samples.document_lines(samples.table(spark, sf, "documents")))
    # The signature in two steps, each the output of a generator, so that neither runs again where its text is read twice.
    masked = lines.select("source", F.explode(F.array(text.mask(F.col("value"), BLOCK_LOG.masks))).alias("masked"))
    signed = masked.select("source", F.explode(F.array(text.even(F.col("masked")))).alias("signature"))
    words = F.size(text.tokens(F.col("signature")))
    events = signed.select("source", text.event_name(F.floor(words / 6) + 1).alias("EventId"))
    counts = stage(C.entity_event_counts(events, "source"), "counts")
    labels = samples.table(spark, sf, "labels").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("entity_id"),
        F.when(F.col("quality") == 0, "Anomaly").otherwise("Normal").alias("label"),
    )
    labelled = counts.join(labels.select("entity_id"), "entity_id", "left_semi")
    return features_of(labelled, labels)


def _cross_validated(spark: SparkSession, sf: str, names: tuple[str, ...]) -> DataFrame:
    features, _ = _document_features(spark, sf)
    L.require_both_classes(features)
    return models.cross_validate(stratified_folds(features), names)


@query
def cv_logistic(spark: SparkSession, sf: str) -> DataFrame:
    return M.cv_results(_cross_validated(spark, sf, (models.LOGISTIC,)))


@query
def cv_forest(spark: SparkSession, sf: str) -> DataFrame:
    return M.cv_results(_cross_validated(spark, sf, (models.FOREST,)))


@query
def cv_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _cross_validated(spark, sf, models.MODELS)


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    features, columns = _document_features(spark, sf)
    return models.feature_importance(models.FOREST, models.fit_all(models.FOREST, features), features, columns)


# Streaming ---------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = _line_files(spark, sf)
    return streams.parse_stream(streams.stream_lines(spark, folder, "*.txt", files_per_batch=64), BLOCK_LOG)


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    out = new_dir(spark, "stream")
    folder, state = _line_files(spark, sf), new_dir(spark, "stream-state")
    streams.ingest_log_stream(spark, BLOCK_LOG, folder, out, state, pattern="*.txt", files_per_batch=64).awaitTermination()
    part = F.regexp_extract("source", r"part=(\d+)", 1).cast("bigint")
    return read_events(spark, f"{out}/events").withColumn("part", part).drop("source")


@query
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = new_dir(spark, "stream-counts")
    events = _stream(spark, sf)
    streams.count_stream(events, "BlockId", "signature", out, new_dir(spark, "stream-state")).awaitTermination()
    return streams.running_counts(spark, out)
