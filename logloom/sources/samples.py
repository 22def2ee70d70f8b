"""Log lines and event facts derived from the analytics tables, for queries, tests and bench.

Every row of the source table becomes one line, so the volume follows the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUANTITY_STEPS = (0, 2, 4, 8, 12, 20, 28, 36, 44, 48, 49, 50)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as it is stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: object) -> F.Column:
    return F.concat(*[p if isinstance(p, F.Column) else F.lit(p) for p in parts])


def _num(col: F.Column) -> F.Column:
    return col.cast("string")


def _once(col: F.Column) -> F.Column:
    """The column as generator output, so that readers of a line do not render it again."""
    return F.explode(F.array(col))


def block_lines(events: DataFrame) -> DataFrame:
    """Block-log lines: value, source, source_order, LineId. Some lines lack the header."""
    event_id, user = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    block = _text("blk_", F.when(user % 2 == 0, "-").otherwise(""), _num(user))
    host = _text("10.0.0.", _num(user % 256))
    content = (
        F.when(kind == "click", _text("Receiving block ", block, " src: /", host, ":", _num(50000 + event_id % 1000)))
        .when(kind == "view", _text("Served block ", block, " to /", host))
        .when(kind == "purchase", _text("PacketResponder ", _num(event_id % 3), " for block ", block, " terminating"))
        .when(kind == "error", _text("Exception writing ", block, " to mirror"))
        .otherwise("Verification succeeded")
    )
    level = F.when(kind == "error", "WARN").otherwise("INFO")
    header = _text(
        F.date_format("ts", "yyMMdd HHmmss"), " ", _num(event_id % 100), " ", level, " dfs.", kind, ": "
    )
    return events.select(
        _once(F.when(event_id % 97 == 0, content).otherwise(F.concat(header, content))).alias("value"),
        F.lit("block.log").alias("source"),
        F.lit(1).cast("bigint").alias("source_order"),
        (event_id + 1).alias("LineId"),
    )


def vm_lines(events: DataFrame) -> DataFrame:
    """VM-log lines of three sources; one line in eleven lacks the request id."""
    event_id, user = F.col("event_id"), F.col("user_id")
    kind = F.col("event_type")
    order = F.when(user % 5 == 0, 3).otherwise(event_id % 2 + 1)
    source = F.element_at(F.array(F.lit("normal1.log"), F.lit("normal2.log"), F.lit("abnormal.log")), order.cast("int"))
    message = (
        F.when(kind == "click", "VM Started (Lifecycle Event)")
        .when(kind == "view", _text("Took ", _num(event_id % 60), ".", _num(event_id % 100), " seconds to build instance."))
        .when(kind == "purchase", _text("Attempting claim: memory ", _num(event_id % 4096), " MB, disk 20 GB, vcpus 1 CPU"))
        .when(kind == "error", _text("Instance failed to spawn on host 10.1.0.", _num(user % 256)))
        .otherwise("Terminating instance")
    )
    request = F.when(event_id % 11 == 0, "").otherwise(_text("[req-", _num(event_id), "] "))
    content = _text("[instance: vm-", _num(user), "] ", message)
    header = _text(
        source, " ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), " ", _num(event_id % 100), " ",
        F.when(kind == "error", "ERROR").otherwise("INFO"), " nova.", kind, " ", request,
    )
    return events.select(
        _once(F.when(event_id % 97 == 0, content).otherwise(F.concat(header, content))).alias("value"),
        source.alias("source"),
        order.cast("bigint").alias("source_order"),
        (event_id + 1).alias("LineId"),
    )


def document_lines(documents: DataFrame) -> DataFrame:
    """Physical lines of the documents: one source per document, numbered from 1."""
    return documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("source"),
        F.col("doc_id").alias("source_order"),
        F.posexplode(F.split("text", "\n")).alias("pos", "value"),
    ).select("value", "source", "source_order", (F.col("pos") + 1).cast("bigint").alias("LineId"))


def block_labels(events: DataFrame) -> DataFrame:
    """(entity_id, label) of blocks: one in ten Anomaly, one in ten without a row."""
    user = F.col("user_id")
    block = _text("blk_", F.when(user % 2 == 0, "-").otherwise(""), _num(user))
    return (
        events.select("user_id").distinct().filter(user % 10 != 7)
        .select(block.alias("entity_id"), F.when(user % 10 == 3, "Anomaly").otherwise("Normal").alias("label"))
    )


def vm_anomalies(events: DataFrame) -> DataFrame:
    """Ids listed as anomalous."""
    return events.filter(F.col("user_id") % 10 == 3).select(_text("vm-", _num(F.col("user_id"))).alias("entity_id")).distinct()


def label_text(events: DataFrame) -> DataFrame:
    """A label text: prose, blank lines, and one instance id per line, all in ``value``."""
    digest = F.md5(_num(F.col("user_id")))
    parts = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    line = (
        F.when(F.col("user_id") % 10 == 3, F.concat(F.lit("  "), F.concat_ws("-", *parts)))
        .when(F.col("user_id") % 10 == 4, "")
        .otherwise(F.concat(F.lit("Instance "), F.concat_ws("-", *parts), F.lit(" showed no injected anomaly.")))
    )
    return events.select(line.alias("value"))


def quantity_counts(lineitem: DataFrame) -> DataFrame:
    """(entity_id, event_id, n) per part: lines with a quantity above each of twelve steps."""
    # Counted per part first, so that a row is one group and not one for each of its steps.
    cells = [
        F.struct(F.lit(f"E{i}").alias("event_id"), F.count_if(F.col("l_quantity") > step).alias("n"))
        for i, step in enumerate(QUANTITY_STEPS, 1)
    ]
    parts = lineitem.groupBy("l_partkey").agg(F.array(*cells).alias("cells"))
    entity = F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("entity_id")
    return parts.select(entity, F.inline("cells")).filter("n > 0")


def quantity_events(lineitem: DataFrame) -> DataFrame:
    """The event ids of ``quantity_counts``, the last of which never occurs."""
    steps = [(f"E{i}",) for i in range(1, len(QUANTITY_STEPS) + 1)]
    return lineitem.sparkSession.createDataFrame(steps, "event_id string")


def event_scores(events: DataFrame) -> DataFrame:
    """Scores of two models for every event: model, fold, entity_id, target, prediction, score."""
    scored = events.select(
        F.col("event_id").cast("string").alias("entity_id"),
        (F.col("event_id") % 10 + 1).cast("int").alias("fold"),
        (F.col("event_type") == "error").cast("int").alias("target"),
        F.explode(
            F.map_from_arrays(
                F.array(F.lit("Logistic Regression"), F.lit("Random Forest")),
                F.array(F.floor("value") / 100, (F.col("event_id") * 7919 % 1000) / 1000),
            )
        ).alias("model", "score"),
    )
    return scored.withColumn("prediction", (F.col("score") >= 0.25).cast("int"))
