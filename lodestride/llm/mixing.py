"""Mixing sources to target weights by Pfair scheduling.

Documents of each source, in a seeded random order, form blocks of ``block_docs``. Time is a row
of slots that hold one block each. With share w, the k-th block of a source (from 0) is released
at slot floor(k / w) and due by slot ceil((k + 1) / w); in each slot the earliest deadline among
the released blocks goes first (ties: the source earlier by name). On one processor that order
meets every deadline, so at any slot each source is less than one block away from its share.

Shares are whole parts of PARTS and all arithmetic is in whole numbers, so the bound holds over any
number of slots. Time is cut into frames of FRAME slots, or as many as there are sources. What the schedule has
served at a frame's border follows from the weights alone (floor(w t) blocks of each source, or one more
by deadline where releases leave room), so earliest deadline first runs in each frame by itself, as one SQL
expression, and frames spread over tasks.

When a source runs out, a phase ends, and the others go on at their relative weights from there; no
row is dropped or repeated. Without ``weights``, shares follow the row counts to the power ``alpha``.
With ``weights``, sources that aren't named share ``rest_weight`` in the same way; every source has one
part at least. Up to ``max_sources`` sources share one schedule. More are dealt to groups by hash, level
by level: a group takes its place in the schedule above with the sum of its members' weights, and its
members share its slots. A member is less than one block away from its part of what its group has, and the group less than one
from its share, so the member is less than one block and its part of one (about 1 / ``max_sources``) away from its share.

A null source is a source. Documents with equal ids stay together in any order. An empty table gives
an empty result. Columns of any name may be there: they travel inside one struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DOCS = 16
PARTS = 1_000_000_000
FRAME = 128
MAX_SOURCES = 512
RANK_ROWS = 20_000


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _shares(t: str) -> str:
    """SQL: blocks of each source in the first ``t`` slots of a phase with parts ``w`` of ``d``, earliest deadline first; they sum to ``t``.

    Blocks due by ``t`` are in. Of those released before and due later (one a source, at most), the earliest deadlines
    are in for which slots are left: from the slot ``a`` on, no more than ``t`` - ``a`` blocks released by then.
    """
    base = f"""transform(w, (x, i) -> named_struct('due', if(x > 0, (((x * {t}) div d + 1) * d + x - 1) div x, 0L), 'i', i, 'k', (x * {t}) div d,
        'release', if(x > 0, (((x * {t}) div d) * d) div x, {t}), 'open', x > 0 and (x * {t}) % d > 0))"""
    caps = f"""transform(array_sort(filter(b, x -> x.open)), c -> named_struct('i', c.i, 'at', c.release, 'free',
        {t} - c.release - aggregate(b, 0L, (n, y) -> if(y.release >= c.release, n + y.k - (w[y.i] * c.release + d - 1) div d, n))))"""
    step = """if(exists(acc.caps, y -> y.at <= x.at and y.free <= 0), acc, named_struct('n', acc.n + 1, 'got', concat(acc.got, array(x.i)),
        'caps', transform(acc.caps, y -> if(y.at <= x.at, named_struct('i', y.i, 'at', y.at, 'free', y.free - 1), y))))"""
    greedy = f"aggregate(o, named_struct('n', 0L, 'got', cast(array() as array<int>), 'caps', o), (acc, x) -> if(acc.n >= f, acc, {step})).got"
    chosen = _let("p", greedy, "transform(b, x -> x.k + if(array_contains(p, x.i), 1L, 0L))")
    return _let("b", base, _let("f", f"{t} - aggregate(b, 0L, (n, x) -> n + x.k)", _let("o", caps, chosen)))


def _phases() -> str:
    """SQL: the phases of a group of sources with arrays ``blocks`` and ``parts``: start, n slots, parts w of d, and each source's first block.

    A phase ends with the first source that can't fill its share of one more slot; a closing phase takes the last
    block of the sources for which that holds.
    """
    closing = """named_struct('left', zip_with(zip_with(l, c, (x, y) -> x - y), q, (x, y) -> x - y), 'first', zip_with(zip_with(acc.first, c, (x, y) -> x + y), q, (x, y) -> x + y),
        'slot', acc.slot + n + m, 'phases', concat(acc.phases, array(named_struct('start', acc.slot, 'n', n, 'd', d, 'w', w, 'first', acc.first)),
        if(m > 0, array(named_struct('start', acc.slot + n, 'n', m, 'd', m, 'w', q, 'first', zip_with(acc.first, c, (x, y) -> x + y))), array())))"""
    step = closing
    for name, value in reversed(
        (
            ("l", "acc.left"),
            ("w", "zip_with(l, parts, (x, p) -> if(x > 0, p, 0L))"),
            ("d", "aggregate(w, 0L, (x, y) -> x + y)"),
            ("e", "zip_with(l, w, (x, y) -> if(y > 0, (x * d) div y, null))"),
            ("n", "array_min(filter(e, x -> x is not null))"),
            ("c", _shares("n")),
            ("q", "transform(e, (x, i) -> if(x = n, l[i] - c[i], 0L))"),
            ("m", "aggregate(q, 0L, (x, y) -> x + y)"),
        )
    ):
        step = _let(name, value, step)
    kind = "array<struct<start: bigint, n: bigint, d: bigint, w: array<bigint>, first: array<bigint>>>"
    start = f"named_struct('left', blocks, 'first', transform(blocks, x -> 0L), 'slot', 0L, 'phases', cast(array() as {kind}))"
    return f"aggregate(sequence(1, size(blocks)), {start}, (acc, step) -> if(exists(acc.left, x -> x > 0), {step}, acc)).phases"


def _frame_picks() -> str:
    """SQL: (i, k, slot) of every slot of the frame [t0, t1) of a phase, earliest deadline first."""
    jobs = """flatten(transform(zip_with(a, z, (x, y) -> named_struct('a', x, 'z', y)), (x, i) -> if(x.z > x.a, transform(sequence(x.a, x.z - 1), k -> named_struct(
        'due', least(t1, ((k + 1) * d + w[i] - 1) div w[i]), 'i', i, 'k', k, 'release', greatest(t0, (k * d) div w[i]))), array())))"""
    pick = _let(
        "at",
        "array_position(transform(acc.left, j -> j.release <= t), true)",
        "named_struct('left', concat(slice(acc.left, 1, cast(at as int) - 1), slice(acc.left, cast(at as int) + 1, size(acc.left))), "
        "'done', concat(acc.done, array(named_struct('i', acc.left[cast(at as int) - 1].i, 'k', acc.left[cast(at as int) - 1].k, 'slot', t))))",
    )
    kind = "array<struct<i: int, k: bigint, slot: bigint>>"
    run = f"aggregate(sequence(t0, t1 - 1), named_struct('left', j, 'done', cast(array() as {kind})), (acc, t) -> {pick}).done"
    return _let("a", _shares("t0"), _let("z", _shares("t1"), _let("j", f"array_sort({jobs})", run)))


def _level(members: DataFrame) -> DataFrame:
    """Schedules of all groups of ``members`` (grp, member, blocks, weight): a row per block with grp, member, block, slot, release, due, share."""
    grouped = members.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("member", "blocks", "weight"))).alias("s"), F.sum("weight").alias("total"))
    grouped = grouped.select(
        "grp",
        F.transform("s", lambda x: x["member"]).alias("names"),
        F.transform("s", lambda x: x["blocks"].cast("long")).alias("blocks"),
        F.transform("s", lambda x: F.greatest(F.lit(1), F.round(x["weight"] / F.col("total") * PARTS)).cast("long")).alias("parts"),
    )
    phased = grouped.select("grp", "names", F.explode(F.expr(_phases())).alias("p")).select("grp", "names", "p.*")
    phased = phased.withColumn("frame", F.expr(f"cast(greatest({FRAME}, size(w)) as bigint)"))
    frames = phased.withColumn("t0", F.explode(F.expr("sequence(0L, n - 1, frame)"))).withColumn("t1", F.expr("least(n, t0 + frame)"))
    frames = frames.repartition("grp", "start", "t0")
    picks = frames.select("grp", "names", "start", "d", "w", "first", F.explode(F.expr(_frame_picks())).alias("x"))
    return picks.select(
        "grp",
        F.expr("names[x.i]").alias("member"),
        F.expr("first[x.i] + x.k").alias("block"),
        F.expr("start + x.slot").alias("slot"),
        F.expr("start + (x.k * d) div w[x.i]").alias("release"),
        F.expr("start + ((x.k + 1) * d + w[x.i] - 1) div w[x.i]").alias("due"),
        F.expr("w[x.i] / d").alias("share"),
    )


def schedule(counts: DataFrame, n_sources: int, max_sources: int = MAX_SOURCES) -> DataFrame:
    """A row per block: source_key, block, slot, release, due, share. ``counts`` has source_key, blocks and weight, a row per source.

    release, due and share are of the level at which the source is scheduled.
    """
    levels = 1
    while max_sources**levels < n_sources:
        levels += 1
    # Group of a source at each level, from the top: level 0 is the one group of all.
    path = [F.lit("")]
    for i in range(1, levels):
        path.append(F.pmod(F.xxhash64("source_key"), F.lit(-(-n_sources // max_sources ** (levels - i)))).cast("string"))
    below = None
    for i in range(levels - 1, -1, -1):
        member = F.col("source_key") if i == levels - 1 else F.concat_ws("/", *path[1 : i + 2])
        members = counts.select(F.concat_ws("/", *path[1 : i + 1]).alias("grp"), member.alias("member"), "blocks", "weight")
        level = _level(members.groupBy("grp", "member").agg(F.sum("blocks").alias("blocks"), F.sum("weight").alias("weight")))
        if below is None:
            below = level.withColumnRenamed("member", "source_key")
        else:  # a member's slots are the blocks of its group above
            above = level.select(F.col("member").alias("grp"), F.col("block").alias("inner"), F.col("grp").alias("outer"), F.col("slot").alias("outer_slot"))
            moved = below.withColumn("inner", F.col("slot")).drop("slot").join(above, ["grp", "inner"])
            below = moved.select(F.col("outer").alias("grp"), "source_key", "block", F.col("outer_slot").alias("slot"), "release", "due", "share")
    return below.select("source_key", "block", "slot", "release", "due", "share")


def _weights(counts: DataFrame, weights: dict[str, float] | None, rest_weight: float, alpha: float) -> DataFrame:
    """``counts`` (source_key, n) with the weight of each source."""
    own = F.pow(F.col("n").cast("double"), F.lit(alpha))
    if weights is None:
        return counts.withColumn("weight", own)
    given = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (f"={k}", float(v))]) if weights else F.lit(None).cast("map<string,double>")
    rows = counts.withColumn("given", given[F.col("source_key")]).withColumn("own", F.when(F.col("given").isNull(), own))
    rest = rows.agg(F.sum("own")).scalar()
    return rows.withColumn("weight", F.coalesce("given", F.col("own") / rest * F.lit(float(rest_weight)))).drop("given", "own")


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    rest_weight: float = 0.0,
    alpha: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_docs: int = BLOCK_DOCS,
    max_sources: int = MAX_SOURCES,
    seed: int = 0,
) -> DataFrame:
    """``row`` (a struct of all columns) with mix_source, share, block, pos, slot, release, due and mix_order.

    Read in the order of ``mix_order``, the rows follow the target weights.
    """
    # A key of its own for null; "=" before all other sources.
    source: Column = F.col(f"`{source_col}`").cast("string")
    rows = docs.select(F.struct("*").alias("row"), source.alias("mix_source"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source_key"), F.col(f"`{id_col}`").alias("id"))
    total, n_sources = rows.agg(F.count(F.lit(1)), F.count_distinct("source_key")).first()
    # The rank of a row within its source: a seeded hash bucket of bounded size, then the hash. Rows
    # with one id (or none) would share a bucket, so the source's other buckets take their part.
    buckets = max(1, math.ceil(total / RANK_ROWS))
    spread = F.when(F.col("id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(F.lit(seed), "id"))
    rows = rows.withColumn("bucket", F.pmod(spread, F.lit(buckets)))
    sizes = rows.groupBy("source_key", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("source_key", "bucket", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    counts = sizes.groupBy("source_key").agg(F.sum("n").alias("n"))
    blocks = _weights(counts, weights, rest_weight, alpha).withColumn("blocks", F.ceil(F.col("n") / block_docs).cast("long"))
    # The slots of each bucket's blocks (a few hundred), to meet its rows where the window needs them anyway.
    needed = offsets.select("source_key", "bucket", "offset", F.explode(F.expr(f"sequence(offset div {block_docs}, (offset + n - 1) div {block_docs})")).alias("block"))
    placed = needed.join(schedule(blocks, n_sources, max_sources), ["source_key", "block"])
    placed = placed.groupBy("source_key", "bucket").agg(F.first("offset").alias("offset"), F.sort_array(F.collect_list(F.struct("block", "slot", "release", "due", "share"))).alias("slots"))
    within = Window.partitionBy("source_key", "bucket").orderBy(F.xxhash64(F.lit(seed + 1), "id"), "id")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1).join(placed, ["source_key", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("offset"))
    ranked = ranked.withColumn("block", F.expr(f"rank div {block_docs}")).withColumn("x", F.expr("slots[cast(block - slots[0].block as int)]"))
    return ranked.select(
        "row",
        "mix_source",
        F.col("x.share").alias("share"),
        "block",
        (F.col("rank") % block_docs).alias("pos"),
        F.col("x.slot").alias("slot"),
        F.col("x.release").alias("release"),
        F.col("x.due").alias("due"),
        (F.col("x.slot") * block_docs + F.col("rank") % block_docs).alias("mix_order"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs``, stored in mixed order: partitions are ranges of it, sorted."""
    columns = docs.columns
    rows = mix(docs, **options).select("row", "mix_order")
    rows = rows.repartitionByRange("mix_order").sortWithinPartitions("mix_order")
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
