"""Mixing sources to target weights (operator 7).

The mix holds 150 % of all words. Sources share it by weight; a target stops at
twice the source's words, and the excess goes to the others by weight until no
target is above its limit. Whole passes over a source come first; the rest is
one pass over its blocks in permuted order, cut inside the last block.

A multivariate-hypergeometric splitting tree splits each source's quota, the
number of block uses in the mix, among the output shards. At each node the
quotas' units of all sources are ordered by a hash, and the first half goes
left: a source's units on the left are one draw from the multivariate
hypergeometric distribution with the node's quotas, and the children's quotas
add up to the node's. After the last level a node is a shard. The shards then
draw from the source's permuted blocks one after the other, each as many as its
quota says, so their draws are disjoint; a source that is used more than once is
drawn through again. What the mix takes of a document is how often its block was
drawn. A shard's documents are shuffled by a hash inside it.

A source is split into blocks by a hash of its documents, and sizes are summed
per block before the shuffle, so a source with a third of all rows is many
small groups. Windows over a source see one row per block, and the one window
over all sources sees one row per source. Documents are ordered only inside the
single block per source that the target cuts.

Defined results: a NULL text has size 0; a NULL source is a source of its own,
ordered last; repeated rows are documents of their own; an empty table gives an
empty result; other columns pass through, but for those named like a column of
the result. All choices are hashes of the data, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm.common import body_text, given_back, set_aside, stored, word_count

OWN = ["_source", "_none"]
RESULT = ("size", "source_size", "target", "uses", "shards")
HELPERS = (
    *OWN, "_draw", "_slice", "_block", "_full", "_room", "_upto", "_dealt", "_order", "shard",
)


# Slices broadcast at most, some 100 bytes each.
FEW_SLICES = 200_000


@dataclass(frozen=True)
class Plan:
    """``weights`` repeat over the sources in order; ``share`` is the mix's size
    in sizes of the input; no document is used more than ``most`` times. A source
    is hashed into ``slices``, which make up to ``blocks`` blocks over all
    sources; the tree has ``levels``, that is ``2 ** levels`` shards."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    blocks: int = 8192
    slices: int = 1024
    levels: int = 6
    seed: int = 17


def _keyed(docs: DataFrame, plan: Plan) -> DataFrame:
    """Documents with their size and slice. The source is split in a value and a
    NULL flag, which keeps its joins plain equalities. The hash of a document
    gives its slice, and the hash of that its order inside a block."""
    draw = F.xxhash64(F.lit(plan.seed), F.col("doc_id"), body_text())
    return docs.withColumns(
        {
            "size": word_count(body_text()).cast("bigint"),
            "_source": F.coalesce(F.col("source"), F.lit("")),
            "_none": F.col("source").isNull(),
            "_draw": F.xxhash64(draw, F.lit("order")),
            "_slice": F.pmod(draw, F.lit(plan.slices)),
        }
    )


def _over_all() -> Window:
    return Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )


def targets(sources: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Target per source, from one row per source.

    A source is at its limit when ``most * size / weight`` is at most the level
    that the others reach. In order of that ratio the limited sources come
    first, so running sums give each source's level as if it were the first
    that is not limited. The first whose level is below its limit is right, and
    all after it share its level.
    """
    in_order = Window.orderBy("_none", F.encode("_source", "UTF-8"))
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    limit = plan.most * F.col("source_size").cast("double")
    ranked = sources.withColumn(
        "_weight",
        F.get(weights, ((F.row_number().over(in_order) - 1) % len(plan.weights)).cast("int")),
    ).withColumn("_ratio", limit / F.col("_weight"))
    rising = Window.orderBy("_ratio", "_none", F.encode("_source", "UTF-8"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = _over_all()
    wanted = plan.share * F.sum("source_size").over(whole)
    given = F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    spread = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = (wanted - given) / spread
    free = F.struct("_ratio", "_none", "_source", "_level")
    first_free = F.min(F.when(F.col("_ratio") > F.col("_level"), free)).over(whole)["_level"]
    return (
        ranked.withColumn("_level", level)
        .withColumn("_shared", first_free)
        .withColumn(
            "target",
            F.when(F.col("_shared").isNull(), limit).otherwise(
                F.least(limit, F.col("_weight") * F.col("_shared"))
            ),
        )
        .select(*OWN, "source_size", "target")
    )


def _blocks(docs: DataFrame, plan: Plan) -> DataFrame:
    """One row per source and slice, with the source's target, the slice's
    block, its place ``_rank`` in the source's permutation, and ``_quota``, the
    block uses the source has in the mix. The last of them may be a block that
    the target cuts; there ``_room`` is the words it wants (NULL elsewhere).

    A source has one block per ``1 / plan.blocks`` of all words, at least one
    and at most one per slice, so all blocks together are bounded by the plan
    and the number of sources.
    """
    slices = stored(
        _keyed(docs, plan).groupBy(*OWN, "_slice").agg(F.sum("size").alias("slice_size")),
        "mix-slices",
    )
    sources = targets(slices.groupBy(*OWN).agg(F.sum("slice_size").alias("source_size")), plan)
    all_words = F.sum("source_size").over(_over_all())
    share = plan.blocks * F.col("source_size") / F.greatest(all_words, F.lit(1))
    sources = sources.withColumn("_blocks", F.ceil(F.greatest(share, F.lit(1.0))))
    placed = slices.join(sources, OWN).withColumn("_block", F.col("_slice") % F.col("_blocks"))
    permuted = Window.partitionBy(*OWN).orderBy(
        F.xxhash64(F.lit(plan.seed), F.lit("block"), *OWN, F.col("_block")), "_block"
    )
    passes = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    rest = F.col("target") - F.col("_passes") * F.col("source_size")
    before = F.col("_upto") - F.col("block_size")
    full = F.col("_upto") <= rest
    blocks = (
        placed.groupBy(*OWN, "_block", "source_size", "target")
        .agg(F.sum("slice_size").alias("block_size"))
        .withColumn("_passes", passes)
        .withColumn("_rank", F.row_number().over(permuted) - 1)
        .withColumn("_upto", F.sum("block_size").over(permuted))
        .withColumn("_room", F.when(~full & (before < rest), rest - before))
        .withColumn("_drawn", F.col("_passes") + F.when(full | (before < rest), 1).otherwise(0))
        .withColumn("_quota", F.sum("_drawn").over(Window.partitionBy(*OWN)).cast("bigint"))
        .withColumn("_of", F.count(F.lit(1)).over(Window.partitionBy(*OWN)))
        .select(*OWN, "_block", "_rank", "_of", "_quota", "_room")
    )
    return placed.join(blocks, [*OWN, "_block"]).select(
        *OWN, "_slice", "_block", "source_size", "target", "_rank", "_of", "_quota", "_room"
    )


def quotas(sources: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Quota of each source (``_quota``) in each shard (``shard``), by the
    splitting tree. The root's window sees every unit of every quota, whose
    number the plan bounds."""
    units = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_quota"))).alias("_unit")
    rows = sources.filter("_quota > 0").select(*OWN, units).withColumn("shard", F.lit(0))
    for level in range(plan.levels):
        mixed = F.xxhash64(F.lit(plan.seed + level), "shard", *OWN, "_unit")
        order = Window.partitionBy("shard").orderBy(mixed, *OWN, "_unit")
        every = Window.partitionBy("shard")
        left = 2 * F.row_number().over(order) <= F.count(F.lit(1)).over(every)
        rows = rows.withColumn("shard", 2 * F.col("shard") + F.when(left, 0).otherwise(1))
    return rows.groupBy(*OWN, "shard").agg(F.count(F.lit(1)).alias("_quota"))


def draws(blocks: DataFrame, shares: DataFrame) -> DataFrame:
    """The shards that draw each block, in the order of their draws
    (``_dealt``). Shards take their quotas from the permuted blocks of a source
    one after the other, beginning anew after the last block."""
    one_by_one = Window.partitionBy(*OWN).orderBy("shard")
    upto = F.sum("_quota").over(one_by_one)
    drawn = shares.withColumn("_end", upto).select(
        *OWN, "shard", F.explode(F.expr("sequence(_end - _quota, _end - 1)")).alias("_draw")
    )
    drawn = drawn.join(blocks.select(*OWN, "_of").distinct(), OWN)
    drawn = drawn.withColumn("_rank", (F.col("_draw") % F.col("_of")).cast("int"))
    dealt = drawn.join(blocks.select(*OWN, "_rank", "_block"), [*OWN, "_rank"])
    in_order = F.sort_array(F.collect_list(F.struct("_draw", "shard")))
    return (
        dealt.groupBy(*OWN, "_block")
        .agg(in_order.alias("_all"))
        .select(*OWN, "_block", F.col("_all.shard").alias("_dealt"))
    )


def plan_mix(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """The documents with ``size``, ``source_size``, ``target``, ``uses`` (how
    often the mix takes the document) and ``shards`` (the shard of each use)."""
    rows, meanwhile = set_aside(docs, (*RESULT, *HELPERS))
    return given_back(_planned(rows, plan), docs.columns, meanwhile, *RESULT)


def _planned(docs: DataFrame, plan: Plan) -> DataFrame:
    slices = stored(_blocks(docs, plan), "mix-plan")
    blocks = slices.drop("_slice").distinct()
    shares = stored(quotas(blocks.select(*OWN, "_quota").distinct(), plan), "mix-quotas")
    ready = slices.join(draws(blocks, shares), [*OWN, "_block"], "left").select(
        *OWN, "_slice", "_block", "source_size", "target", "_room", "_dealt"
    )
    ready = stored(ready, "mix-draws")
    # One row per slice: unless sources are very many, texts stay where they are.
    if ready.count() <= FEW_SLICES:
        ready = F.broadcast(ready)
    rows = _keyed(docs, plan).join(ready, [*OWN, "_slice"])
    whole = rows.filter(F.col("_room").isNull()).withColumn("_full", F.lit(True))
    inside = Window.partitionBy(*OWN, "_block").orderBy("_draw", "size", "doc_id")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    near = F.col("_upto") - F.col("size") / 2 <= F.col("_room")
    # The last draw of a block that the target cuts is for its first documents.
    cut = (
        rows.filter(F.col("_room").isNotNull())
        .withColumn("_upto", upto)
        .withColumn("_full", near)
        .drop("_upto")
    )
    dealt = F.coalesce("_dealt", F.array().cast("array<int>"))
    shards = F.when(F.col("_full"), dealt).otherwise(
        F.slice(dealt, F.lit(1), F.greatest(F.size(dealt) - 1, F.lit(0)))
    )
    return (
        whole.unionByName(cut)
        .withColumn("shards", shards)
        .withColumn("uses", F.size("shards"))
        .select(*docs.columns, "size", "source_size", "target", "uses", "shards", "_draw")
    )


def mix(docs: DataFrame, plan: Plan = Plan(), shuffled: bool = True) -> DataFrame:
    """The mix: a document once per use, with its ``shard``. ``shuffled`` brings
    a shard's rows together in random order, in its own partition range."""
    own, meanwhile = set_aside(docs, (*RESULT, *HELPERS))
    rows = _planned(own, plan).select(*own.columns, "_draw", F.explode("shards").alias("shard"))
    order = F.xxhash64(F.lit(plan.seed), F.col("shard"), F.col("_draw"))
    if shuffled:
        rows = rows.withColumn("_order", order)
        rows = rows.repartitionByRange("shard", "_order").sortWithinPartitions("shard", "_order")
    return given_back(rows, docs.columns, meanwhile, "shard")
