"""Template mining as a Spark job.

Lines shrink to distinct signatures (masked content) in one aggregate; everything after that
works on signatures. Order always means first appearance (``seen_at``), never partition order,
so the result does not depend on partitioning.

Signatures of a leaf that can be similar are found by an index. Of n tokens k must agree; cut into
k - 1 classes of positions, some class holds two of them. So two signatures that share no pair
(position, token, position, token) of a class are not similar, and are never compared.

Dictionary columns: event_no, EventId, EventTemplate, n_tokens, heads, leader, seen_at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from logloom.functions.formats import MiningConfig
from logloom.functions.text import (
    WILDCARD,
    equal_tokens,
    event_name,
    head_token,
    similar,
    tokens,
)
from logloom.operators.leafgroups import grouped_by_leaf
from logloom.operators.ranking import number_rows
from logloom.session import broadcast_if_small, drop_path, drop_shuffles, stage, stage_at

LEAF = ("n_tokens", "heads")
# Type of ``seen_at`` in a dictionary, whatever lines have.
ORDER = "decimal(38,0)"
# Tokens of a leaf that one task settles; beyond that its signatures are compared by the index, round after round.
LEAF_CELLS = 16_000_000
# Signatures that are few enough for joins, which Spark then does without a worker.
FEW = 5000
# Tokens of the leaves that a task settles at once, on average.
BUCKET_CELLS = 500_000
# Signatures whose mining lets go of shuffle files on its way.
LARGE = 200_000
# Leaders of a leaf that are compared one by one, in one row; more of them are looked up by the index.
KNOWN_PACK = 64
# Rounds whose leaders are read side by side before they are merged into one table.
MAX_UNION = 16
# Signatures under an index item that a round compares with the later ones: at first, growth, at most.
FIRST_HEADS, HEADS_GROWTH, MOST_HEADS = 4, 4, 1024


def signature_counts(lines: DataFrame) -> DataFrame:
    """Distinct signatures of lines (signature, seen_at): lines and first appearance."""
    return lines.groupBy("signature").agg(F.count("*").alias("lines"), F.min("seen_at").alias("seen_at"))


def exact_templates(signatures: DataFrame) -> DataFrame:
    """Every signature of a staged table is its own template: EventId by first appearance."""
    return number_rows(signatures, "seen_at", "event_no").select(
        "signature",
        "event_no",
        event_name(F.col("event_no")).alias("EventId"),
        F.col("signature").alias("EventTemplate"),
        F.col("lines").alias("Occurrences"),
    )


def assign_leaves(signatures: DataFrame, config: MiningConfig, known: DataFrame | None = None) -> DataFrame:
    """Add tokens and the leaf key (n_tokens, heads).

    ``heads`` are the leading tokens, digit-bearing ones as wildcards. Per tree node the first
    ``max_children - 1`` tokens by first appearance are kept, later ones share the wildcard.
    Nodes of a ``known`` dictionary keep their tokens.
    """
    keep = config.max_children - 1
    order = signatures.schema["seen_at"].dataType
    leaves = signatures.withColumn("tokens", tokens(F.col("signature"))).withColumn("n_tokens", F.size("tokens"))
    leaves = leaves.withColumn("heads", F.array().cast("array<string>"))
    for level in range(1, config.head_tokens + 1):
        node = ["n_tokens", "heads"]
        leaves = leaves.withColumn("head", head_token(F.get("tokens", F.lit(level - 1))))
        seen = leaves.select(*node, "head", "seen_at")
        if known is not None:
            # Tokens of the dictionary come before all new ones.
            seen = seen.unionByName(
                known.select(
                    "n_tokens",
                    F.slice("heads", 1, level - 1).alias("heads"),
                    F.get("heads", F.lit(level - 1)).alias("head"),
                    (F.col("event_no") - F.lit(2**62)).cast(order).alias("seen_at"),
                )
            )
        first = (
            seen.filter(F.col("head").isNotNull() & (F.col("head") != WILDCARD))
            .groupBy(*node, "head")
            .agg(F.min("seen_at").alias("head_seen"))
        )
        # The rank filter is pushed before the shuffle, so a node with many tokens sends
        # at most `keep` rows per task.
        rank = F.row_number().over(W.partitionBy(*node).orderBy("head_seen"))
        kept = stage(
            first.withColumn("rank", rank).filter(F.col("rank") <= keep).select(*node, "head", F.lit(True).alias("kept")),
            "heads",
        )
        leaves = leaves.join(broadcast_if_small(kept), [*node, "head"], "left")
        folded = F.when(F.col("kept"), F.col("head")).otherwise(WILDCARD)
        leaves = leaves.withColumn(
            "heads", F.when(F.col("n_tokens") < level, F.col("heads")).otherwise(F.array_append("heads", folded))
        ).drop("head", "kept")
    return leaves


def _settle(candidates: Column, config: MiningConfig) -> Column:
    """Leaders among candidates in order of appearance: those similar to no earlier leader."""

    def step(leaders: Column, one: Column) -> Column:
        covered = F.exists(leaders, lambda leader: similar(leader["tokens"], one["tokens"], config.sim_th))
        return F.when(covered, leaders).otherwise(F.array_append(leaders, one))

    empty = F.filter(candidates, lambda _: F.lit(False))
    return F.aggregate(candidates, empty, step)


def _indexed(rows: DataFrame, config: MiningConfig) -> DataFrame:
    """Add ``items``: signatures of a leaf that share none are not similar.

    Literal heads agree within a leaf, so they are taken off the number of tokens that must agree.
    One token that must agree is indexed alone, none at all makes the whole leaf one item.
    """
    n = F.col("n_tokens")
    least = F.ceil(F.lit(config.sim_th) * n - F.lit(1e-9)).cast("int")
    literal = F.size(F.filter("heads", lambda head: head != WILDCARD))
    based = rows.withColumn("_leaf", F.xxhash64(*LEAF)).withColumn("_must", least - literal)

    def free(i: Column) -> Column:
        """The token at a position that may differ within the leaf, null elsewhere."""
        token, head = F.get("tokens", i), F.get("heads", i)
        return F.when((token != WILDCARD) & (head.isNull() | (head == WILDCARD)), token)

    def item(*parts: Column) -> Column:
        return F.xxhash64(F.col("_leaf"), *parts)

    places = F.sequence(F.lit(0), n - 1)
    alone = F.transform(places, lambda i: F.when(free(i).isNotNull(), item(i, free(i))))
    step = F.col("_must") - 1

    def partners(i: Column) -> Column:
        count = F.floor((n - 1 - i) / step).cast("int")
        steps = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))

        def pair(k: Column) -> Column:
            other = i + k * step
            both = free(i).isNotNull() & free(other).isNotNull()
            return F.when(both, item(i, free(i), other, free(other)))

        return F.transform(steps, pair)

    items = (
        F.when(F.col("_must") <= 0, F.array(item(F.lit(-1))))
        .when(F.col("_must") == 1, F.array_compact(alone))
        .otherwise(F.array_compact(F.flatten(F.transform(places, partners))))
    )
    return based.withColumn("items", items).drop("_leaf", "_must")


def _pairs(earlier: DataFrame, later: DataFrame, order: Column) -> DataFrame:
    """(order, seen_at) of the rows of both tables that share an item and where ``order`` holds."""
    return earlier.join(later, "item").filter(order).select("order", "seen_at").distinct()


def _by_index(leaves: DataFrame, config: MiningConfig) -> list[DataFrame]:
    """Leaders of big leaves, in tables.

    Per round an open signature is compared with the first few signatures under its items. One that
    stands among these first under all its items, and is similar to no earlier open one, is a leader;
    all that are similar to it have been found by then, and go. The first few grow from round to round: common
    shapes go while they are few, and after that a leaf of any number of leaders is settled in as many rounds as
    chains of similar signatures are long.
    """
    columns = (*LEAF, "seen_at", "signature", "tokens")
    open_rows, path = stage_at(_indexed(leaves.select(*columns), config), "open")
    limit, parts = FIRST_HEADS, []
    while not open_rows.isEmpty():
        index = open_rows.select("seen_at", F.explode("items").alias("item"))
        # Limited per task before the shuffle, so a common item never meets in one task.
        rank = F.row_number().over(W.partitionBy("item").orderBy("seen_at"))
        heads, heads_path = stage_at(index.withColumn("rank", rank).filter(F.col("rank") <= limit).drop("rank"), "heads")
        pairs = _pairs(heads.withColumnRenamed("seen_at", "order"), index, F.col("order") < F.col("seen_at"))
        first = open_rows.select(F.col("seen_at").alias("order"), *[F.col(c).alias(f"first_{c}") for c in (*LEAF, "tokens")])
        alike = similar(F.col("first_tokens"), F.col("tokens"), config.sim_th)
        for name in LEAF:
            alike = alike & (F.col(name) == F.col(f"first_{name}"))
        found = pairs.join(first, "order").join(open_rows.drop("signature", "items"), "seen_at").filter(alike)
        found = stage(found.select("order", "seen_at"), "similar")
        sure = heads.groupBy("seen_at").agg(F.count("*").alias("n_heads"))
        seen_whole = F.coalesce("n_heads", F.lit(0)) == F.size("items")
        leaders = open_rows.join(sure, "seen_at", "left").filter(seen_whole).join(found.select("seen_at"), "seen_at", "left_anti")
        leaders = stage(leaders.select(*columns), "leaders")
        parts.append(leaders)
        led = leaders.select("seen_at")
        covered = found.join(led.withColumnRenamed("seen_at", "order"), "order", "left_semi").select("seen_at")
        open_rows, written = stage_at(open_rows.join(covered.union(led), "seen_at", "left_anti"), "open")
        # What the round read goes as soon as the next one's rows are written.
        for read in (path, heads_path):
            drop_path(leaves.sparkSession, read)
        path = written
        limit = min(MOST_HEADS, limit * HEADS_GROWTH)
        if len(parts) == MAX_UNION:
            parts = [stage(reduce(DataFrame.unionByName, parts), "leaders")]
    return parts


def find_leaders(leaves: DataFrame, config: MiningConfig) -> DataFrame:
    """Leaders (n_tokens, heads, seen_at, signature, tokens) of staged signatures.

    A leader is similar to no earlier leader of its leaf. Leaves of up to ``batch`` signatures are gone
    through in order, each in one row; bigger ones are settled by the index. A leader covers itself by identity: a
    text of mostly wildcards is not similar to itself.
    """
    sizes = leaves.groupBy(*LEAF).agg(F.count("*").alias("leaf_rows"))
    big = stage(sizes.filter(F.col("leaf_rows") > config.batch).select(*LEAF), "big-leaves")
    parts: list[DataFrame] = []
    small = leaves
    if not big.isEmpty():
        big = broadcast_if_small(big)
        parts = _by_index(leaves.join(big, list(LEAF), "left_semi"), config)
        small = leaves.join(big, list(LEAF), "left_anti")
    row = F.struct("seen_at", "signature", "tokens")
    gathered = small.groupBy(*LEAF).agg(F.array_sort(F.collect_list(row)).alias("head"))
    settled = gathered.select(*LEAF, F.inline(_settle(F.col("head"), config)))
    return reduce(DataFrame.unionByName, [stage(settled, "settled"), *parts])


def group_leaves(leaves: DataFrame, config: MiningConfig) -> tuple[DataFrame, str]:
    """Staged signatures with their ``leader_seen`` and whether they are the leader (``leads``), and the folder.

    A leaf that a task can hold is settled there, many in one task; larger ones, and all if signatures are few, take
    ``find_leaders`` and ``nearest_leader``. Tokens are not kept, as they are the signature once more.
    """
    columns = [c for c in leaves.columns if c != "tokens"]
    cells = F.col("leaf_rows") * F.greatest("n_tokens", F.lit(1))
    sizes = leaves.groupBy(*LEAF).agg(F.count("*").alias("leaf_rows")).withColumn("cells", cells)
    sizes = stage(sizes, "leaf-sizes")
    rows, total = sizes.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("leaf_rows", "cells")]).first()
    larger = sizes.filter(F.col("cells") > LEAF_CELLS).select(*LEAF)
    joined, held, parts = leaves, leaves, []
    if rows > FEW and not larger.isEmpty():
        larger = broadcast_if_small(larger)
        joined = leaves.join(larger, list(LEAF), "left_semi")
        held = leaves.join(larger, list(LEAF), "left_anti")
    if rows <= FEW or joined is not leaves:
        found = find_leaders(joined, config)
        near = nearest_leader(joined, found, config)
        led = broadcast_if_small(found.select("signature", F.lit(True).alias("leads")))
        leads = F.coalesce("leads", F.lit(False)).alias("leads")
        parts.append(near.join(led, "signature", "left").select(*columns, "leader_seen", leads))
    if rows > FEW:
        parts.append(grouped_by_leaf(held.select(*columns), total // BUCKET_CELLS + 1, config.sim_th, WILDCARD))
    grouped, path = stage_at(reduce(DataFrame.unionByName, parts), "grouped", compression="zstd")
    return grouped.withColumn("tokens", tokens(F.col("signature"))), path


def known_leaders(known: DataFrame) -> DataFrame:
    """Leaders of a dictionary in the form of ``find_leaders``; ``seen_at`` is the event number."""
    return known.select(*LEAF, F.col("event_no").alias("seen_at"), F.array_join("leader", " ").alias("signature"), F.col("leader").alias("tokens"))


def nearest_leader(leaves: DataFrame, leaders: DataFrame, config: MiningConfig) -> DataFrame:
    """Most similar leader of the same leaf per signature (ties: the earliest): leader_seen.

    NULL where no leader reaches ``sim_th``. In a leaf of few leaders all are compared in the joined row; those
    of a leaf with many are looked up by the index, and the same signature by itself. ``leaders`` should be staged.
    """

    def short(same: Column, own: Column) -> Column:
        return -F.when(same, F.size("tokens") + 1).otherwise(equal_tokens(own, F.col("tokens")))

    sizes = leaders.groupBy(*LEAF).agg(F.count("*").alias("held"))
    many = stage(sizes.filter(F.col("held") > KNOWN_PACK).select(*LEAF), "many-leaders")
    some_many = not many.isEmpty()
    few = leaders.join(broadcast_if_small(many), list(LEAF), "left_anti") if some_many else leaders
    row = F.struct(F.col("seen_at").alias("order"), "signature", "tokens")
    packs = few.groupBy(*LEAF).agg(F.collect_list(row).alias("leaders"))

    def score(leader: Column) -> Column:
        return F.struct(short(leader["signature"] == F.col("signature"), leader["tokens"]).alias("short"), leader["order"].alias("order"))

    best = F.array_min(F.transform("leaders", score))
    scored = leaves.join(broadcast_if_small(packs), list(LEAF), "left").select(*leaves.columns, best.alias("best"))
    if some_many:
        own = stage(_indexed(leaves.join(broadcast_if_small(many), list(LEAF), "left_semi").select(*LEAF, "seen_at", "signature", "tokens"), config), "own-items")
        led = leaders.join(broadcast_if_small(many), list(LEAF), "left_semi").withColumnRenamed("seen_at", "order")
        led = stage(_indexed(led, config), "leader-items")
        pairs = _pairs(
            led.select("order", F.explode("items").alias("item")), own.select("seen_at", F.explode("items").alias("item")), F.lit(True)
        )
        first = led.select("order", *[F.col(c).alias(f"first_{c}") for c in (*LEAF, "tokens")])
        near = pairs.join(first, "order").join(own.drop("signature", "items"), "seen_at")
        for name in LEAF:
            near = near.filter(F.col(name) == F.col(f"first_{name}"))
        hits = near.select("seen_at", F.struct(short(F.lit(False), F.col("first_tokens")).alias("short"), "order").alias("looked_up"))
        itself = own.join(led.select(*LEAF, "signature", "order"), [*LEAF, "signature"])
        hits = hits.unionByName(itself.select("seen_at", F.struct((-F.size("tokens") - 1).alias("short"), "order").alias("looked_up")))
        hits = hits.groupBy("seen_at").agg(F.min("looked_up").alias("looked_up"))
        scored = scored.join(hits, "seen_at", "left").withColumn("best", F.coalesce("best", "looked_up")).drop("looked_up")
    words = F.greatest(F.size("tokens"), F.lit(1))
    agreed = -F.col("best.short")
    enough = (agreed / words >= config.sim_th) | (agreed > F.size("tokens"))
    return scored.withColumn("leader_seen", F.when(enough, F.col("best.order"))).drop("best")


def template_texts(grouped: DataFrame, key: str) -> DataFrame:
    """Template per group of signatures: a token where all agree, the wildcard elsewhere.

    A signature that is a group by itself is its own template; only those of larger groups are compared by position.
    ``grouped`` is read three times.
    """
    lookup = broadcast_if_small(_several(grouped, key))
    alone = grouped.join(lookup, key, "left_anti").select(key, F.array_join("tokens", " ").alias("EventTemplate"), "seen_at")
    return alone.unionByName(_merged_texts(grouped.join(lookup, key, "left_semi"), key))


def _several(grouped: DataFrame, key: str) -> DataFrame:
    """Groups of more than one signature."""
    return stage(grouped.groupBy(key).agg(F.count("*").alias("held")).filter("held > 1").select(key), "several")


def _merged_texts(members: DataFrame, key: str) -> DataFrame:
    """Template per group by position."""
    positions = members.select(key, "seen_at", F.posexplode_outer("tokens").alias("pos", "token"))
    merged = positions.groupBy(key, "pos").agg(
        F.min("token").alias("low"), F.max("token").alias("high"), F.min("seen_at").alias("seen_at")
    )
    token = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(WILDCARD)
    cells = merged.select(key, "seen_at", F.when(F.col("pos").isNotNull(), F.struct("pos", token.alias("token"))).alias("cell"))
    words = F.transform(F.array_sort(F.collect_list("cell")), lambda cell: cell["token"])
    return cells.groupBy(key).agg(F.array_join(words, " ").alias("EventTemplate"), F.min("seen_at").alias("seen_at"))


def current_dictionary(dictionary: DataFrame) -> DataFrame:
    """The present text of every event of a dictionary that holds earlier texts as well.

    A text only ever gains wildcards, so the one with the most is the latest.
    """
    wild = F.size(F.filter(F.split("EventTemplate", " "), lambda token: token == WILDCARD))
    rest = [c for c in dictionary.columns if c != "event_no"]
    newest = dictionary.groupBy("event_no").agg(F.max_by(F.struct(*rest), wild).alias("row"))
    return newest.select("event_no", "row.*").select(*dictionary.columns)


def refresh_texts(known: DataFrame, matched: DataFrame) -> DataFrame:
    """``known`` with texts that also cover the ``matched`` signatures (event_no, tokens, seen_at)."""
    words = F.when(F.col("n_tokens") > 0, F.split("EventTemplate", " ")).otherwise(F.array().cast("array<string>"))
    old = known.join(matched.select("event_no").distinct(), "event_no", "left_semi")
    members = old.select("event_no", "seen_at", words.alias("tokens")).unionByName(
        matched.withColumn("seen_at", F.col("seen_at").cast(ORDER))
    )
    texts = template_texts(members, "event_no").select("event_no", F.col("EventTemplate").alias("text"))
    joined = known.join(texts, "event_no", "left")
    return joined.withColumn("EventTemplate", F.coalesce("text", "EventTemplate")).drop("text")


def mine(
    signatures: DataFrame, config: MiningConfig, known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Mine templates: ``(dictionary, assignment)``.

    ``assignment`` maps signature to event_no and EventId. With a ``known`` dictionary,
    signatures that match one of its leaders take that event; the rest are mined and their
    numbers follow the highest known one. Known ids never change; the text of an event that got
    new members covers them too. Signatures that are a known leader's own need no leaf: they change neither
    heads nor texts, and where there are no others nothing is mined.
    """
    itself = None
    if known is not None:
        # The same signature stands in the same leaf, as the nodes of a dictionary keep their tokens.
        own = known_leaders(known).groupBy("signature").agg(F.min("seen_at").alias("event_no"))
        looked_up = stage(signatures.join(broadcast_if_small(own), "signature", "left"), "looked-up")
        itself = looked_up.filter("event_no is not null").select("signature", F.col("event_no").cast("bigint").alias("event_no"))
        signatures = looked_up.filter("event_no is null").select(*signatures.columns)
        if signatures.isEmpty():
            dictionary = known.select("event_no", "EventId", "EventTemplate", *LEAF, "leader", F.col("seen_at").cast(ORDER).alias("seen_at"))
            return dictionary, itself.select("signature", "event_no", event_name(F.col("event_no")).alias("EventId"))
    spark = signatures.sparkSession
    leaves, leaves_path = stage_at(assign_leaves(signatures, config, known).drop("tokens"), "leaves", compression="zstd")
    leaves = leaves.withColumn("tokens", tokens(F.col("signature")))
    large = leaves.count() > LARGE
    base = 0
    matched = None
    if known is not None:
        hits = stage(nearest_leader(leaves, stage(known_leaders(known), "known"), config), "matched")
        taken = hits.filter("leader_seen is not null").withColumn("event_no", F.col("leader_seen").cast("bigint"))
        matched = taken.select("signature", "event_no")
        known = refresh_texts(known, taken.select("event_no", "seen_at", "tokens"))
        leaves = hits.filter("leader_seen is null").drop("leader_seen")
        base = known.agg(F.coalesce(F.max("event_no"), F.lit(0))).first()[0]
    if large:
        drop_shuffles(spark)
    grouped, grouped_path = group_leaves(leaves, config)
    drop_path(spark, leaves_path)
    if large:
        drop_shuffles(spark)
    # A group of one has its leader's text, so only those of several are merged, and numbers are found without texts.
    several = broadcast_if_small(_several(grouped, "leader_seen"))
    merged = stage(_merged_texts(grouped.join(several, "leader_seen", "left_semi"), "leader_seen"), "texts")
    first = grouped.filter("leads").select(F.col("seen_at").alias("leader_seen")).distinct()
    first = first.join(merged.select("leader_seen", "seen_at"), "leader_seen", "left")
    first, first_path = stage_at(first.withColumn("seen_at", F.coalesce("seen_at", "leader_seen")), "first-seen")
    numbers = number_rows(first, "seen_at", "event_no").select(
        "leader_seen", (F.col("event_no") + base).alias("event_no"), F.col("seen_at").cast(ORDER).alias("first_seen")
    )
    numbers, numbers_path = stage_at(numbers, "numbers")
    # One table for dictionary and assignment, so that signatures are dealt and kept once.
    numbered = grouped.select("leader_seen", *LEAF, "signature", "leads").join(numbers, "leader_seen")
    numbered = stage_at(numbered, "numbered", compression="zstd")[0]
    for read in (grouped_path, first_path, numbers_path):
        drop_path(spark, read)
    if large:
        drop_shuffles(spark)
    event = event_name(F.col("event_no")).alias("EventId")
    texts = broadcast_if_small(merged.select("leader_seen", F.col("EventTemplate").alias("text")))
    dictionary = numbered.filter("leads").join(texts, "leader_seen", "left").select(
        "event_no", event, F.coalesce("text", "signature").alias("EventTemplate"), *LEAF,
        tokens(F.col("signature")).alias("leader"), F.col("first_seen").alias("seen_at"),
    )
    assignment = numbered.select("signature", "event_no", event)
    if known is not None:
        dictionary = stage(known.select(*dictionary.columns).unionByName(dictionary), "dictionary")
        others = matched.unionByName(itself).select("signature", "event_no", event)
        assignment = stage(assignment.unionByName(others), "assignment")
    return dictionary, assignment


def occurrences(signatures: DataFrame, assignment: DataFrame) -> DataFrame:
    """Lines per event."""
    return (
        signatures.join(assignment, "signature")
        .groupBy("event_no", "EventId")
        .agg(F.sum("lines").alias("Occurrences"))
    )


def template_table(dictionary: DataFrame, counts: DataFrame) -> DataFrame:
    """EventId, EventTemplate, Occurrences; order by ``event_no`` when it is shown."""
    return dictionary.join(counts.select("event_no", "Occurrences"), "event_no", "left").select(
        "event_no", "EventId", "EventTemplate", F.coalesce("Occurrences", F.lit(0)).alias("Occurrences")
    )


def assign_events(lines: DataFrame, assignment: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add EventId and the final EventTemplate to lines that carry their signature.

    The lookup is broadcast up to a row bound; a longer one is joined by shuffle, where
    adaptive execution splits the partition of a hot signature.
    """
    lookup = assignment.join(dictionary.select("event_no", "EventTemplate"), "event_no").drop("event_no")
    return lines.join(broadcast_if_small(lookup), "signature", "left")
