"""Training records as text: a shared line and one line per arm, blocks parted by a blank line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.config import DELTAS, NAMESPACES, OTHER_NAMESPACE
from lodestride.functions.arms import feasible_flags, normalized, propensity_vector


def namespace_of(name: str) -> str:
    """Namespace letter of a feature name: the first that has a part of it."""
    return next((letter for letter, parts in NAMESPACES if any(p in name.lower() for p in parts)), OTHER_NAMESPACE)


def namespace_column(name: Column) -> Column:
    low, out = F.lower(name), None
    for letter, parts in NAMESPACES:
        hit = F.lit(False)
        for p in parts:
            hit = hit | low.contains(p)
        out = F.when(hit, letter) if out is None else out.when(hit, letter)
    return out.otherwise(OTHER_NAMESPACE)


def clean_name(name: str) -> str:
    for c in " :|":
        name = name.replace(c, "_")
    return name


def _features(columns: list[str], single_namespace: str | None) -> Column:
    """Namespaces in order, each with its features that aren't 0 or null."""
    spaces: dict[str, list[str]] = {}
    for c in columns:
        spaces.setdefault(single_namespace or namespace_of(c), []).append(c)
    parts = []
    for letter in sorted(spaces):
        values = F.array(*[F.when(F.col(c).isNotNull() & (F.col(c) != 0), F.concat(F.lit(f"{clean_name(c)}:"), F.format_string("%.6f", F.col(c).cast("double")))) for c in spaces[letter]])
        present = F.filter(values, lambda x: x.isNotNull())
        parts.append(F.when(F.size(present) > 0, F.concat(F.lit(f"|{letter} "), F.array_join(present, " "))))
    return F.concat_ws(" ", *parts)


def cb_adf_records(rows: DataFrame, features: list[str], form: str = "train") -> DataFrame:
    """user_id, session_date and record. Forms:

    train: only the chosen arm is labelled, with index:-reward:propensity; needs arm, reward, multiplier and pi_old.
    legacy: the same, with the probabilities in an array column ``probs`` (null: 1e-6), normalised, and no user id.
    online: all features in one namespace, every arm labelled (cost 0 but for the chosen one); needs arm, reward, probs (null: 0.2).
    prediction: arms by their index, without labels; needs multiplier.
    """
    if form not in ("train", "legacy", "online", "prediction"):
        raise ValueError(f"unknown form {form}")
    if form == "train":
        rows = rows.withColumn("__p", propensity_vector(F.col("multiplier"), F.col("arm"), F.col("pi_old")))
    elif form != "prediction":
        given = F.transform(F.sequence(F.lit(1), F.lit(len(DELTAS))), lambda i: F.coalesce(F.try_element_at("probs", i.cast("int")), F.lit(0.2 if form == "online" else 1e-6)))
        rows = rows.withColumn("__p", given if form == "online" else normalized(given, given))
    rows = rows.withColumn("__f", feasible_flags(F.col("multiplier"))) if form != "online" else rows
    shared = F.concat(F.lit("shared "), _features(features, "f" if form == "online" else None))
    if form == "train":
        uid = F.concat(F.lit("  # uid:"), F.col("user_id").cast("string"))
        shared = F.concat(shared, F.when(F.col("user_id").try_cast("long").isNotNull(), uid).otherwise(""))
    lines = [shared]
    for i, delta in enumerate(DELTAS):
        context = F.lit(f"|a arm:{i}")
        if form != "online":
            flag = F.element_at("__f", i + 1).cast("int").cast("string")
            context = F.concat(F.lit(f"|a arm:{i} delta:{delta:.2f} |c mult:"), F.format_string("%.2f", F.col("multiplier")), F.lit(" feasible:"), flag)
        if form == "prediction":
            label = F.lit(f"{i} ")
        else:
            p = F.format_string("%.6f", F.element_at("__p", i + 1))
            chosen = F.concat(F.lit(f"{i}:"), F.format_string("%.4f", -F.col("reward")), F.lit(":"), p, F.lit(" "))
            label = F.when(F.col("arm") == i, chosen).otherwise(F.concat(F.lit(f"{i}:0:"), p, F.lit(" ")) if form == "online" else F.lit(""))
        lines.append(F.concat(label, context))
    return rows.select("user_id", "session_date", F.concat(F.array_join(F.array(*lines), "\n"), F.lit("\n")).alias("record"))


def parse_cb_adf(records: DataFrame) -> DataFrame:
    """arm, reward, propensity, uid of each block; a block's label is the line that has one, zero rewards included."""
    lines = F.split("record", "\n")
    label = F.filter(lines, lambda x: x.rlike(r"^\d+:-?[0-9.]+:[0-9.]+ "))[0]
    return records.select(
        F.regexp_extract(label, r"^(\d+):", 1).cast("int").alias("arm"),
        (-F.regexp_extract(label, r"^\d+:(-?[0-9.]+):", 1).cast("double")).alias("reward"),
        F.regexp_extract(label, r"^\d+:-?[0-9.]+:([0-9.]+) ", 1).cast("double").alias("propensity"),
        F.nullif(F.regexp_extract(lines[0], r"# uid:(-?\d+)", 1), F.lit("")).cast("long").alias("uid"),
    )


