"""Secret scan with corpus-wide ownership: who else has this string?

Patterns give candidates with their places. The hash of every candidate value is counted over
the whole corpus by distinct owners and by distinct repositories. A value that several owners
share, or that stands in many repositories of whichever owners, is a copied example; any other that
looks random is taken for a live credential, also if it leaked to a second owner. The counts combine per task, then per (value, owner), then per value, so a value in a third
of all rows is one row per owner when the owners are counted.

Contract: null text counts as empty, a null owner is an owner of its own. Every row gives a row;
repeated rows repeat. Empty tables give empty results. Very long texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.spans import once, spans
from logloom.session import stage

# Kinds in their order, with pattern, group of the value, and least size of the value.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
# Pieces that every value of a kind contains; rows without them are not scanned for the kind.
GATES = {
    "assign": r"""(?i)(?:word|passwd|secret|token|key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
}
# Added by the method: runs of 20 or more characters with a digit wherever in them, kept where they look live.
VALUE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20})[A-Za-z+/_-]*+[0-9][A-Za-z0-9+/_-]*+"
MARK = "[SECRET]"
# From so many owners or repositories on a value is a copied example.
SHARED_OWNERS = 3
SHARED_REPOSITORIES = 10
# A live credential has so many different characters.
LEAST_DISTINCT = 8


def _kind(text: Column, order: int) -> Column:
    name, pattern, group, least = KINDS[order]
    # Short runs can't pass; a run of the least size starts where the whole run starts.
    pattern = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}.get(name, pattern)
    kept = F.filter(spans(text, F.lit(pattern), group), lambda x: F.length(x["value"]) >= least)
    return F.when(text.rlike(GATES[name]), _marked(kept, order)).otherwise(_none())


def _marked(found: Column, order: int) -> Column:
    return F.transform(
        found, lambda x: F.struct(x["start"], F.lit(order).alias("kind"), x["end"], x["value"])
    ).cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")


def _none() -> Column:
    return F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")


def _random_looking(value: Column) -> Column:
    several = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT
    return several & value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def candidates(text: Column) -> Column:
    """All candidate places in order of (start, kind); kind 3 are the added ones outside the others."""
    base = F.concat(*[_kind(text, i) for i in range(len(KINDS))])
    more = F.when(text.rlike(VALUE), _marked(spans(text, F.lit(VALUE)), len(KINDS))).otherwise(_none())
    free = F.filter(
        more,
        lambda x: _random_looking(x["value"]) & ~F.exists(base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])),
    )
    return F.array_sort(F.concat(base, free))


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(x[0]) for x in KINDS], F.lit("value"))
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def _count(order: int) -> Column:
    return F.size(F.filter("found", lambda x: x["kind"] == order)).cast("bigint")


def _ownership(rows: DataFrame) -> DataFrame:
    """(value_hash, n_owners, n_repositories) of every candidate value."""
    held = rows.select("owner", "repository", F.explode(F.array_distinct(F.transform("found", lambda x: F.sha2(x["value"], 256)))).alias("value_hash"))
    by_repository = held.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("value_hash", "owner").agg(F.count("*").alias("n_repositories"))
    return by_owner.groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("n_repositories").alias("n_repositories"))


def _judged(rows: DataFrame, shared_owners: int, shared_repositories: int) -> DataFrame:
    """(row_id, judged) with ``live``, ``shared`` and the counts on every candidate of rows that have any."""
    places = rows.select("row_id", F.explode("found").alias("place")).withColumn("value_hash", F.sha2(F.col("place.value"), 256))
    known = places.join(_ownership(rows), "value_hash")
    shared = (F.col("n_owners") >= shared_owners) | (F.col("n_repositories") >= shared_repositories)
    live = ~shared & _random_looking(F.col("place.value"))
    return known.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("place.start", "place.kind", "place.end", "place.value", live.alias("live"), shared.alias("shared"), "n_owners", "n_repositories"))).alias("judged")
    )


def _scanned(docs: DataFrame, owner: str, repository: str, keep: Column) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        keep.alias("kept"),
        once("found", candidates(text)),
    )


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", shared_owners: int = SHARED_OWNERS, shared_repositories: int = SHARED_REPOSITORIES) -> DataFrame:
    """Per row: the base counts and places, the places with their owners and repositories, and how many look live or shared."""
    rows = stage(_scanned(docs, owner, repository, F.col("doc_id")), "secret-candidates")
    judged = _judged(rows.filter(F.size("found") > 0), shared_owners, shared_repositories)
    all_rows = rows.join(judged, "row_id", "left")
    base = F.filter("found", lambda x: x["kind"] < len(KINDS))
    places = F.coalesce("judged", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string,live:boolean,shared:boolean,n_owners:bigint,n_repositories:bigint>>"))
    spans_kept = F.filter(places, lambda x: (x["kind"] < len(KINDS)) | x["live"])
    return all_rows.select(
        F.col("kept").cast("bigint").alias("doc_id"),
        *[_count(order).alias(f"n_{kind[0]}") for order, kind in enumerate(KINDS)],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans_kept).alias("spans"),
        F.size(F.filter(places, lambda x: x["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter(places, lambda x: x["shared"])).cast("bigint").alias("n_shared"),
        F.transform(spans_kept, lambda x: x["n_owners"]).alias("n_owners"),
        F.transform(spans_kept, lambda x: x["n_repositories"]).alias("n_repositories"),
    )


def redact_live(docs: DataFrame, owner: str = "source", repository: str = "doc_id", shared_owners: int = SHARED_OWNERS, shared_repositories: int = SHARED_REPOSITORIES) -> DataFrame:
    """``docs`` with every live-looking value replaced by ``MARK``; other rows stay as they are.

    Null texts stay null, repeated rows repeat, and an empty table gives an empty one. A column ``n_chars``, if there is one, follows the
    text; all other columns pass, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    suspect = text.rlike("|".join([*GATES.values(), VALUE]).replace("(?i)", "")) | text.rlike(GATES["assign"])
    rows = stage(_scanned(docs.filter(suspect), owner, repository, F.struct(*[F.col(f"`{c}`") for c in docs.columns])), "secret-rows")
    judged = _judged(rows.filter(F.size("found") > 0), shared_owners, shared_repositories)
    live = judged.select("row_id", F.filter("judged", lambda x: x["live"]).alias("live")).filter(F.size("live") > 0)
    longest_first = F.reverse(F.array_sort(F.transform("live", lambda x: F.struct(F.length(x["value"]).alias("n"), x["value"].alias("v")))))
    redacted = F.aggregate(longest_first, F.col("kept")["text"], lambda done, x: F.replace(done, x["v"], F.lit(MARK)))
    joined = rows.join(live, "row_id", "left").select("kept", once("changed", F.coalesce(redacted, F.col("kept")["text"])))
    columns = {c: F.col("kept").getField(c) for c in docs.columns} | {"text": F.col("changed")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.col("changed").isNull(), columns["n_chars"]).otherwise(F.length("changed")).cast(kind)
    changed = joined.select(*[x.alias(c) for c, x in columns.items()])
    return docs.filter(~suspect).unionByName(changed)
