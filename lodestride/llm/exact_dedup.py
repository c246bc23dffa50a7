"""Exact deduplication by skew-safe combining.

Equal texts meet in three stages, and each stage compares whole texts, not digests alone:

1. local: every task combines the equal texts it has read (Spark's map-side aggregation on
   digest, salt and text), so a copy leaves its task at most once;
2. salted: groups of (digest, salt, text) merge after the shuffle. Only digests with more rows
   than ``split_rows`` have several salts, one for each ``split_rows`` rows, so no group gathers
   more ids than about that, however large the table is;
3. global: for these digests alone, the winners of the salts combine by (digest, text), and the result goes
   back to each salt by (digest, salt, text), so the salts of a digest stay in different tasks.

Each text is shuffled once, and those of large digests twice more for each salt. The list of large digests is broadcast
while it has at most ``max_large`` rows; a longer one is joined by shuffle, each digest's rows spread over SPREAD keys.

Null texts count as empty. Repeated rows (same id and text) are rows of one group and all are
counted; one of them stays. Null ids come before all others. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import checkpointed

SPLIT_ROWS = 8192
MAX_LARGE = 4096
SPREAD = 64


def _salted(base: DataFrame, split_rows: int, max_large: int, id_col: Column) -> tuple[DataFrame, DataFrame | None]:
    """Rows of small digests with salt 0, and rows of large digests (more than ``split_rows`` rows) with their salts."""
    large = base.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > split_rows)
    large = checkpointed(large.select("digest", F.ceil(F.col("n") / split_rows).cast("int").alias("salts")))
    n = large.count()
    if not n:
        return base.withColumn("salt", F.lit(0)), None
    if n <= max_large:
        marked = base.join(F.broadcast(large), "digest", "left")
    else:
        spread = large.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        marked = base.withColumn("spread", F.pmod(F.xxhash64(id_col), F.lit(SPREAD)).cast("int")).join(spread, ["digest", "spread"], "left").drop("spread")
    small = marked.where(F.col("salts").isNull()).withColumn("salt", F.lit(0))
    split = marked.where(F.col("salts").isNotNull())
    split = split.withColumn("salt", F.pmod(F.xxhash64(id_col, F.lit(1)), F.col("salts")).cast("int"))
    return small.drop("salts"), split.drop("salts")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split_rows: int = SPLIT_ROWS, max_large: int = MAX_LARGE) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn("digest", F.sha2("text", 256))
    small, large = _salted(base, split_rows, max_large, F.col("doc_id"))

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("digest", "salt", "text").agg(
            F.collect_list(F.struct("doc_id")).alias("ids"), F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )

    # ``winner``: the group holds the row that stays.
    groups = merged(small).drop("text", "salt").withColumn("winner", F.lit(True))
    if large is not None:
        salted = merged(large)
        # The salt with the largest id (of equal ones, the first) holds the row that stays.
        best = F.max(F.struct(F.struct("keep_id").alias("id"), (-F.col("salt")).alias("salt"))).alias("best")
        winners = salted.groupBy("digest", "text").agg(best, F.sum("group_size").alias("group_size"), F.collect_list("salt").alias("salts"))
        winners = winners.select("digest", F.explode("salts").alias("salt"), "text", F.col("best.id.keep_id").alias("keep_id"), "group_size", (-F.col("best.salt")).alias("at"))
        combined = salted.drop("keep_id", "group_size").join(winners, ["digest", "salt", "text"])
        groups = groups.unionByName(combined.select("digest", "ids", "keep_id", "group_size", (F.col("salt") == F.col("at")).alias("winner")))
    first = F.array_position(F.transform("ids", lambda x: x["doc_id"].eqNullSafe(F.col("keep_id"))), True) - 1
    return groups.withColumn("first", first).select("*", F.posexplode("ids").alias("at", "member")).select(
        F.col("member.doc_id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("winner") & (F.col("at") == F.col("first"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split_rows: int = SPLIT_ROWS, max_large: int = MAX_LARGE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    others = [c for c in docs.columns if c != text_col]
    rest = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text_col}`").isNull().alias("null_text"))
    base = docs.select(F.struct(F.col(f"`{id_col}`").alias("id")).alias("order"), rest.alias("rest"), text.alias("text"))
    base = base.withColumn("digest", F.sha2("text", 256))
    small, large = _salted(base, split_rows, max_large, F.col("order"))
    best = (F.max("order").alias("order"), F.max_by("rest", "order").alias("rest"))
    winners = small.groupBy("digest", "salt", "text").agg(*best).drop("salt")
    if large is not None:
        winners = winners.unionByName(large.groupBy("digest", "salt", "text").agg(*best).groupBy("digest", "text").agg(*best))
    back = F.when(~F.col("rest.null_text"), F.col("text"))
    return winners.select(*[(back if c == text_col else F.col(f"rest.c{others.index(c)}")).alias(c) for c in docs.columns])
