"""Mixing sources to target weights (operator 4), DataFrame functions only.

1. Targets: sources share `share` times all words by weight; a target stops at
   `limit` times its source's words and the excess goes to the others (the
   common level at which that comes out even is found with one running sum).
2. Quotas: the total is cut into blocks of `block` words, and Sainte-Lague
   apportionment (highest quotients w / (2k - 1)) gives each source an integer
   number of blocks. Inside a source the same rule hands its blocks down a tree
   of shards, `FAN` children a node, to shards of about `shard_words` words.
3. Selection: documents of a shard lie in seeded random order, and the quota's
   blocks of `block` words are taken one behind the other from a seeded start, going on at
   the front behind the last word, so each block has its full size and a source
   comes within a block of its target, but for blocks that the others round off. What a document gives is the overlap of its words
   with the chosen blocks. A shard is passed `limit` times at most.

No step ranks more than a bounded number of rows together: a shard is bounded by
its words, a tree node by its children. Only the table of sources, one row for
each, is ordered as a whole.

Quotients near the cut only are listed: with n parties and S seats a divisor
method's multiplier lies between S - n/2 and S + n/2 divided by the sum of the
weights, so all but about 4 n quotients are decided beforehand.

Defined results: a null text and a text without words have size 0 and nothing is
taken; a null source is a source of its own, last in order; rows repeated, under one id
too, are separate documents; with no words at all every target is 0; an empty table gives
an empty result. Other columns are ignored by `mix_sources` and kept by
`mixed_documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import word_array, word_count, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2
BLOCK = 64
SHARD_WORDS = 1 << 15
FAN = 64
SEED = 17


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken; `options` as in `allocate`."""
    return allocate(docs, id_col, source_col, text_col, **options).select(
        F.col("id").alias(id_col), "size", "source_size", "target", "taken"
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options
) -> DataFrame:
    """The mix itself, with the columns of the input: a row for each whole pass over a document and
    one for each part of it, whose words are joined by one space.

    Rows are numbered as they are written first, so rows of one id keep their own allocation.
    """
    numbered = written(
        docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("number")),
        "mix-rows",
    )
    given = allocate(
        numbered.select("number", *(F.col("row")[c].alias(c) for c in (id_col, source_col, text_col))),
        id_col,
        source_col,
        text_col,
        number_col="number",
        **options,
    ).filter("taken > 0")
    given = given.select("number", F.struct("size", "passes", "skip1", "take1", "skip2", "take2").alias("given"))
    text = F.col("row")[text_col]
    words = word_array(text)

    def part(skip: str, take: str) -> Column:
        skip, take = F.col(f"given.{skip}"), F.col(f"given.{take}")
        return F.when(take <= 0, F.array().cast("array<string>")).otherwise(
            F.array(
                F.when(take == F.col("given.size"), text).otherwise(
                    F.array_join(F.slice(words, (skip + 1).cast("int"), take.cast("int")), " ")
                )
            )
        )

    copies = F.concat(
        F.array_repeat(text, F.col("given.passes").cast("int")),
        part("skip1", "take1"),
        part("skip2", "take2"),
    )
    joined = numbered.join(given.hint("merge"), "number").select("row", F.explode(copies).alias("taken_text"))
    return joined.select(
        *(F.col("taken_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns)
    )


def allocate(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: int = LIMIT,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    number_col: str | None = None,
) -> DataFrame:
    """id, number, size, source_size, target, taken, and what is taken of each row: `passes` over it, and
    two parts of `take` words behind `skip` words. `number_col` may tell rows of one id apart."""
    sized = written(
        docs.select(
            F.col(id_col).alias("id"),
            (F.lit(0).cast("long") if number_col is None else F.col(number_col)).alias("number"),
            F.col(source_col).alias("source"),
            source_key(F.col(source_col)).alias("key"),
            word_count(text_col).alias("size"),
            F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))).alias("draw"),
        ),
        "mix-sizes",
    )
    sources = source_targets(sized, weights, share, limit)
    sources = _with_seats(sources, block)
    sources = written(
        sources.withColumn(
            "shards", F.ceil(F.col("source_size") / shard_words).cast("long")
        ).withColumn("shards", F.greatest("shards", F.lit(1))),
        "mix-sources",
    )
    dealt = sized.join(
        F.broadcast(sources.select("key", "shards")) if _few(sources) else sources.select("key", "shards"),
        "key",
    ).withColumn("shard", F.pmod(_number("draw"), F.col("shards")))
    quotas = _shard_quotas(dealt, sources, block)
    order = Window.partitionBy("key", "shard").orderBy(
        "draw", F.col("id").asc_nulls_first(), "size", "number"
    )
    placed = dealt.withColumn(
        "begin",
        F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
    )
    toss = F.pmod(_number(F.md5(F.concat_ws(":", F.lit(seed), "key", "shard"))), F.col("blocks"))
    chosen = (
        quotas.withColumn("blocks", F.greatest(F.expr(f"(words + {block - 1}) div {block}"), F.lit(1)))
        .withColumn("quota", F.least(F.col("seats") * block, F.col("words") * limit))
        .withColumn("cut", F.greatest("words", F.lit(1)))
        .withColumn("passes", F.expr("quota div cut"))
        .withColumn("rest", F.expr("quota % cut"))
        .withColumn("from1", toss * block)
        .withColumn("to1", F.least(F.col("from1") + F.col("rest"), F.col("words")))
        .withColumn("to2", F.greatest(F.col("from1") + F.col("rest") - F.col("words"), F.lit(0)))
        .select("key", "shard", "passes", "from1", "to1", "to2")
    )
    end = F.col("begin") + F.col("size")
    totals = sources.select("key", "source_size", "target")

    def overlap(start: Column, stop: str) -> Column:
        return F.greatest(F.least(end, F.col(stop)) - F.greatest(F.col("begin"), start), F.lit(0))

    return (
        placed.join(chosen, ["key", "shard"])
        .join(F.broadcast(totals) if _few(sources) else totals, "key")
        .withColumn("take1", overlap(F.col("from1"), "to1"))
        .withColumn("take2", overlap(F.lit(0), "to2"))
        .withColumn("skip1", F.greatest(F.col("from1") - F.col("begin"), F.lit(0)))
        .withColumn("skip2", F.lit(0))
        .withColumn("taken", (F.col("passes") * F.col("size") + F.col("take1") + F.col("take2")).cast("long"))
        .select(
            "id", "number", "size", "source_size", "target", "taken", "passes", "skip1", "take1", "skip2", "take2"
        )
    )


def source_key(source: Column) -> Column:
    """Source as a join key that is never null and tells null from any text."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, limit: int) -> DataFrame:
    """One row per source: key, rank, source_size, target."""
    totals = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    ranked = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1),
    )
    before = Window.orderBy("stop", "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        ranked.withColumn("stop", limit * F.col("source_size") / F.col("weight"))
        .withColumn("goal", share * F.sum("source_size").over(everything))
        .withColumn(
            "level",
            (F.col("goal") - F.coalesce(F.sum(limit * F.col("source_size")).over(before), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        )
        # Once a source is not stopped, later levels only fall: the largest is the common one.
        .withColumn(
            "level", F.max(F.when(F.col("level") <= F.col("stop"), F.col("level"))).over(everything)
        )
    )
    return level.select(
        "key",
        "rank",
        "source_size",
        F.least(limit * F.col("source_size"), F.col("weight") * F.coalesce("level", F.lit(0.0)))
        .cast("double")
        .alias("target"),
    )


def _with_seats(sources: DataFrame, block: int) -> DataFrame:
    total = F.sum("target").over(Window.partitionBy())
    parties = sources.withColumn("all_seats", F.floor(total / block + 0.5).cast("long"))
    return apportion(parties.withColumn("root", F.lit(0)), "root", "rank", "target", "all_seats").drop(
        "root", "all_seats"
    )


def apportion(parties: DataFrame, group: str, order: str, weight: str, seats: str) -> DataFrame:
    """Sainte-Lague apportionment of each group's `seats` to its parties by `weight`.

    `group` and `order` name one column each; `order` is unique in a group and
    settles equal quotients. Adds `seats` (long) to each party, replacing that column
    if it is already called so.
    """
    whole = Window.partitionBy(group)
    near = (
        parties.withColumn("_seats", F.col(seats))
        .withColumn("_sum", F.sum(weight).over(whole).cast("double"))
        .withColumn("_half", F.count(F.lit(1)).over(whole) / 2.0)
        .withColumn("_per", F.when(F.col("_sum") > 0, F.col(weight) / F.col("_sum")).otherwise(0.0))
        .withColumn(
            "_sure",
            F.greatest(
                F.floor(F.col("_per") * F.greatest(F.col("_seats") - F.col("_half"), F.lit(0.0)) + 0.5) - 1,
                F.lit(0),
            ).cast("long"),
        )
        .withColumn(
            "_most",
            F.when(
                (F.col("_per") > 0) & (F.col("_seats") > 0),
                F.floor(F.col("_per") * (F.col("_seats") + F.col("_half")) + 0.5).cast("long") + 1,
            ).otherwise(F.lit(0)),
        )
        .withColumn("_open", F.col("_seats") - F.sum("_sure").over(whole))
    )
    quotients = (
        near.filter("_most > _sure")
        .select(group, order, weight, "_open", F.explode(F.expr("sequence(_sure + 1, _most)")).alias("_seat"))
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_seat") - 1))
        .withColumn(
            "_place",
            F.row_number().over(
                Window.partitionBy(group).orderBy(F.desc("_quotient"), F.col(order), F.col("_seat"))
            ),
        )
        .filter("_place <= _open")
        .groupBy(group, order)
        .agg(F.count(F.lit(1)).alias("_won"))
    )
    kept = [c for c in parties.columns if c != "seats"]
    return near.join(quotients, [group, order], "left").select(
        *kept, (F.col("_sure") + F.coalesce("_won", F.lit(0))).cast("long").alias("seats")
    )


def _shard_quotas(dealt: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """Words and seats of each (key, shard), handed down a tree with `FAN` children a node."""
    leaves = written(dealt.groupBy("key", "shard").agg(F.sum("size").alias("words")), "mix-shards")
    most = sources.agg(F.max("shards")).first()[0] or 1
    depth = 1
    while FAN**depth < most:
        depth += 1
    nodes = sources.select(
        F.concat_ws("/", "key", F.lit(0)).alias("parent"), F.col("seats").alias("all_seats")
    )
    for level in reversed(range(depth)):
        step, above = FAN**level, FAN ** (level + 1)
        children = (
            leaves.withColumn("shard", F.expr(f"shard div {step}"))
            .groupBy("key", "shard")
            .agg(F.sum("words").alias("words"))
            .withColumn("parent", F.concat_ws("/", "key", F.expr(f"shard div {above // step}")))
        )
        shared = apportion(children.join(nodes, "parent"), "parent", "shard", "words", "all_seats")
        nodes = shared.select(
            F.concat_ws("/", "key", "shard").alias("parent"), F.col("seats").alias("all_seats")
        )
    return shared.select("key", "shard", "words", "seats")


def _number(digest: str | Column) -> Column:
    """The first 60 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _few(sources: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is small enough to be sent to every executor."""
    return sources.limit(most + 1).count() <= most
