from __future__ import annotations

from pyspark.sql import functions as F

from logloom import BLOCK_LOG, VM_LOG
from logloom.functions import text
from logloom.operators.parse import explode_entities, parse_lines
from logloom.sources.lines import clean_lines

BLOCK_LINE = "081109 203518 143 INFO dfs.DataNode$DataXceiver: Receiving block blk_-160 src: /10.250.19.102:54106"


def _lines(spark, *values):
    rows = [(v, "a.log", 1, i) for i, v in enumerate(values, 1)]
    return spark.createDataFrame(rows, "value string, source string, source_order bigint, LineId bigint")


def _parse(spark, fmt, *values):
    return parse_lines(clean_lines(_lines(spark, *values)), fmt).orderBy("LineId").collect()


def test_block_line(spark):
    (row,) = _parse(spark, BLOCK_LOG, BLOCK_LINE)
    assert (row.Date, row.Time, row.Pid, row.Level) == ("081109", "203518", "143", "INFO")
    assert row.Component == "dfs.DataNode$DataXceiver"
    assert row.BlockId == "blk_-160" and row.is_parsed


def test_masks(spark):
    df = spark.createDataFrame([("Receiving block blk_-160 src: /10.250.19.102:54106",)], "c string")
    assert df.select(text.mask(F.col("c"), BLOCK_LOG.masks)).first()[0] == "Receiving block <BLOCK> src: /<IP><NUM>"


def test_unparsed_keeps_line_and_number(spark):
    rows = _parse(spark, BLOCK_LOG, BLOCK_LINE, "garbage blk_12", "", "   \t ", "no entity")
    assert [r.LineId for r in rows] == [1, 2, 5]
    assert (rows[1].Date, rows[1].Content, rows[1].BlockId, rows[1].is_parsed) == ("", "garbage blk_12", "blk_12", False)
    assert rows[2].BlockId is None


def test_first_and_all_entities(spark):
    line = "081109 203518 143 INFO a.b: Deleting blk_1 blk_2 blk_1"
    events = parse_lines(clean_lines(_lines(spark, line, "none")), BLOCK_LOG)
    assert [r.BlockId for r in events.orderBy("LineId").collect()] == ["blk_1", None]
    every = explode_entities(events, BLOCK_LOG).collect()
    assert sorted((r.BlockId or "") for r in every) == ["", "blk_1", "blk_2"]


def test_vm_request_id_quirk(spark):
    rows = _parse(
        spark,
        VM_LOG,
        "nova-api.log.1 2017-05-16 00:00:00.008 25746 INFO nova.wsgi.server [req-1 - - -] 10.11.10.1 [instance: b9-4] hi",
        "nova-compute.log 2017-05-16 00:00:04.500 2931 INFO nova.manager [instance: b9-4] VM Started",
        "nova-compute.log 2017-05-16 00:00:04.500 2931 INFO nova.manager no request",
    )
    assert (rows[0].RequestId, rows[0].InstanceId) == ("[req-1 - - -]", "b9-4")
    assert (rows[1].RequestId, rows[1].InstanceId, rows[1].Content) == ("[instance: b9-4]", None, "VM Started")
    assert (rows[2].RequestId, rows[2].Content) == ("", "no request")


def test_line_with_separator_takes_the_same_fields(spark):
    plain, marked = _parse(spark, BLOCK_LOG, BLOCK_LINE, BLOCK_LINE.replace("block blk", "block\x01 blk"))
    assert marked.is_parsed and marked.Component == plain.Component
    assert marked.Content == plain.Content.replace("block blk", "block\x01 blk")
    odd = _parse(spark, BLOCK_LOG, "\x01a\x01b\x01c\x01d\x01e\x01f", "\x01")
    assert [r.is_parsed for r in odd] == [False, False]
    assert odd[1].Content == "\x01"


def test_unusual_line_breaks_inside_a_line(spark):
    content = "one" + chr(0x2028) + "two" + chr(0x85) + "three"
    (row,) = _parse(spark, BLOCK_LOG, "081109 203518 143 INFO a.b: " + content)
    assert row.is_parsed and row.Content == content


def test_strip_matches_python(spark):
    spaces = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000)]
    values = [s + "a b" + s + s for s in spaces] + spaces + ["a", "", chr(0x200B) + "x"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r.i: r.s for r in df.select("i", text.clean_line(F.col("v")).alias("s")).collect()}
    assert got == {i: v.strip() for i, v in enumerate(values)}
    kept = {r.i for r in df.filter(~text.is_blank(F.col("v"))).select("i").collect()}
    assert kept == {i for i, v in enumerate(values) if v.strip()}


def test_signature_normalises_white_space(spark):
    values = ["a  b\tc", "a b c", "x" + chr(0xA0) + "y", "k1 v22 word", ""]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    masked = [r[0] for r in df.select(text.signature(F.col("v"), BLOCK_LOG.masks)).collect()]
    assert masked == ["a b c", "a b c", "x y", "k<NUM> v<NUM> word", ""]
    wild = [r[0] for r in df.select(text.signature(F.col("v"), ())).collect()]
    assert wild == ["a b c", "a b c", "x y", "<*> <*> word", ""]
    sizes = [r[0] for r in df.select(F.size(text.tokens(text.signature(F.col("v"), ())))).collect()]
    assert sizes == [3, 3, 2, 3, 0]


def test_preview(spark):
    df = spark.createDataFrame([("a" * 70,), ("b" * 71,)], "t string")
    assert [r[0] for r in df.select(text.preview(F.col("t"))).collect()] == ["a" * 70, "b" * 70 + "..."]


def test_parse_survives_filters_on_parsed_columns(spark):
    events = parse_lines(clean_lines(_lines(spark, BLOCK_LINE, "garbage")), BLOCK_LOG)
    plan = events.filter("is_parsed and BlockId is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert events.filter("is_parsed and BlockId is not null").count() == 1
