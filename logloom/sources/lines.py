"""Text log scan with exact physical line numbers and content fingerprints.

``spark.read.text`` splits big files, so the number of a line is the number of lines in the
earlier splits of its file plus its place in its own split. A first pass measures the splits
(one row each); the place comes from ``monotonically_increasing_id``. The lines themselves are
never shuffled, whatever the number of splits: tasks look their splits up in broadcast pages of numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from logloom.functions.text import clean_line, is_blank
from logloom.session import stage

# Splits per broadcast page, of 32 bytes each; the list of splits that a scan keeps at the driver is longer.
PAGE_SPLITS = 500_000
# ``monotonically_increasing_id`` counts the rows of a task in its low bits.
ROW_MASK = 2**33 - 1

_SPLIT = ("path", "split_start", "split_length")
_BIG = "decimal(38,0)"


def order_key(lines: DataFrame) -> Column:
    """Order of all lines of all sources as one exact number.

    A ``TextSource`` brings it along. Other lines are measured here (two maxima): the number is a long
    when source order and line number fit one, and a decimal that holds any two 62-bit numbers otherwise.
    """
    if "seen_at" in lines.columns:
        return F.col("seen_at")
    order, line = F.col("source_order"), F.col("LineId")
    most_order, most_line = lines.agg(F.max(order), F.max(line)).first()
    bits = max(40, int(most_line or 0).bit_length())
    if int(most_order or 0).bit_length() + bits <= 62:
        return F.shiftleft(order.cast("bigint"), bits) + line.cast("bigint")
    high = order.cast("decimal(19,0)") * F.lit(2**62).cast("decimal(19,0)")
    return (high.cast(_BIG) + line.cast("decimal(19,0)")).cast(_BIG)


def line_hash(value: Column) -> Column:
    """60 bits of a line's digest as a number."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("decimal(20,0)")


def _mark(plain: Column, placed: Column) -> Column:
    return F.concat_ws("-", plain.cast("string"), placed.cast("string")).alias("fingerprint")


def fingerprints(lines: DataFrame) -> DataFrame:
    """(source, num_lines, fingerprint) of physical lines.

    The fingerprint joins two sums over the lines: of their hashes, and of hash times line
    number, so it sees content and order. Sums combine per task, so a source of any size is
    hashed by many tasks.
    """
    digest = line_hash(F.col("value"))
    placed = (digest * F.col("LineId")).cast(_BIG)
    sums = lines.groupBy("source").agg(
        F.count("*").alias("num_lines"), F.sum(digest).alias("plain"), F.sum(placed).alias("placed")
    )
    return sums.select("source", "num_lines", _mark(F.col("plain"), F.col("placed")))


def source_name(path: Column, root: str) -> Column:
    """The name of a file below ``root``; Spark gives paths with some characters escaped."""
    plain = F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.substring_index(plain, root.rstrip("/") + "/", -1)


def scanned(lines: DataFrame) -> DataFrame:
    """value, path and split of a text scan; of a stream, of its micro-batches."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.col("_metadata.file_block_length").alias("split_length"),
    )


def list_files(spark: SparkSession, root: str, pattern: str = "*", racy_seconds: int = 2) -> DataFrame:
    """(source, length, modified_at) of the files below ``root``; no content is read.

    The time is NULL where the file changed within the last ``racy_seconds``: another change could leave it as it is.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    settled = F.col("modificationTime") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(racy_seconds).cast("decimal(18,6)"))
    return files.select(
        source_name(F.col("_metadata.file_path"), root).alias("source"),
        "length",
        F.when(settled, F.col("modificationTime")).alias("modified_at"),
    )


class NumberedScan:
    """The lines of a text scan (``scanned``) over files below ``root``, measured once.

    ``sources`` sets the order of files; by default it is that of their names.
    """

    def __init__(self, files: DataFrame, root: str, sources: list[str] | None = None):
        spark = files.sparkSession
        self._root = root
        self._scan = files.withColumn("row_id", F.monotonically_increasing_id())
        place = F.col("row_id").bitwiseAND(F.lit(ROW_MASK))
        digest = line_hash(F.col("value"))
        measured = self._scan.groupBy(*_SPLIT).agg(
            F.count("*").alias("n"),
            F.min("row_id").alias("first_row"),
            F.sum(digest).cast(_BIG).alias("plain"),
            F.sum((digest * place).cast(_BIG)).cast(_BIG).alias("placed"),
        )
        measured = measured.withColumn("source", source_name(F.col("path"), root))
        before = W.partitionBy("path").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
        self._splits = stage(measured, "splits").withColumn(
            "lines_before", F.coalesce(F.sum("n").over(before), F.lit(0))
        )
        if sources is None:
            # One row per file; only names pass through this window.
            names = self._splits.select("source").distinct()
            self._order = names.withColumn("source_order", F.row_number().over(W.orderBy("source")).cast("bigint"))
        else:
            rows = [(name, i) for i, name in enumerate(sources, 1)]
            self._order = spark.createDataFrame(rows, "source string, source_order bigint")
        self._seed, splits = 0, self._splits.count()
        # Splits are known by a hash; the seed that tells all of them apart is nearly always the first.
        while self._splits.select(self._key()).distinct().count() < splits:
            self._seed += 1
        self._pages = max(1, -(-splits // PAGE_SPLITS))

    def _key(self) -> Column:
        return F.xxhash64(*_SPLIT, F.lit(self._seed)).alias("split_key")

    def fingerprints(self) -> DataFrame:
        """``fingerprints`` of the files, from the measured splits; the text is not read again."""
        place = F.col("first_row").bitwiseAND(F.lit(ROW_MASK))
        # A line's number is its row in the task plus a shift that its whole split shares.
        shift = (F.col("lines_before") + 1 - place).cast("decimal(18,0)")
        placed = (F.col("placed") + (F.col("plain") * shift).cast(_BIG)).cast(_BIG)
        sums = self._splits.groupBy("source").agg(
            F.sum("n").alias("num_lines"), F.sum("plain").cast(_BIG).alias("plain"), F.sum(placed).cast(_BIG).alias("placed")
        )
        return sums.select("source", "num_lines", _mark(F.col("plain"), F.col("placed")))

    def lines(self) -> DataFrame:
        """Physical lines: value, source, source_order, LineId (from 1, blank lines count), seen_at.

        ``seen_at`` is the number of the line over all sources in their order.
        """
        sizes = self._splits.groupBy("source").agg(F.sum("n").alias("size")).join(self._order, "source")
        # One row per file.
        earlier = W.orderBy("source_order").rowsBetween(W.unboundedPreceding, -1)
        sizes = sizes.select("source", "source_order", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("earlier"))
        shift = F.col("lines_before") - F.col("first_row") + 1
        offsets = stage(
            self._splits.join(sizes, "source").select(self._key(), "source_order", "earlier", shift.alias("shift")), "offsets"
        )
        numbered, found = self._scan.withColumn("split_key", self._key()), []
        for page in range(self._pages):
            held = F.struct("source_order", "earlier", "shift").alias(f"page_{page}")
            own = F.pmod(F.col("split_key"), F.lit(self._pages)) == page
            numbered = numbered.join(F.broadcast(offsets.filter(own).select("split_key", held)), "split_key", "left")
            found.append(F.col(f"page_{page}"))
        place = F.coalesce(*found)
        line_id = place["shift"] + F.col("row_id")
        return numbered.select(
            "value",
            source_name(F.col("path"), self._root).alias("source"),
            place["source_order"].alias("source_order"),
            # A scan planned with other split sizes than the first pass must fail, not miscount.
            F.when(place.isNotNull(), line_id)
            .otherwise(F.raise_error(F.lit("file splits changed between the two passes")).cast("bigint"))
            .alias("LineId"),
            (place["earlier"] + line_id).alias("seen_at"),
        )


class TextSource(NumberedScan):
    """Text files below a folder, measured once.

    ``sources`` picks files by their path below ``root`` and sets their order; absent ones are
    skipped and other files are not read. By default all files count, in name order.
    """

    def __init__(self, spark: SparkSession, root: str, pattern: str = "*", sources: list[str] | None = None):
        files = scanned(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root))
        if sources is not None:
            # A filter on the path alone is settled while files are listed.
            files = files.filter(source_name(F.col("path"), root).isin(sources))
        super().__init__(files, root, sources)


def read_lines(spark: SparkSession, root: str, pattern: str = "*", sources: list[str] | None = None) -> DataFrame:
    """The numbered lines of a ``TextSource``."""
    return TextSource(spark, root, pattern, sources).lines()


def clean_lines(lines: DataFrame) -> DataFrame:
    """Strip the lines and leave blank ones out; their numbers stay taken."""
    # Filtering the raw line keeps the cleaning out of the pushed-down predicate.
    return lines.filter(~is_blank(F.col("value"))).withColumn("value", clean_line(F.col("value")))
