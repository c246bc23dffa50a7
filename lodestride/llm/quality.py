"""Quality rules as a short-circuit cascade, in DataFrame expressions alone.

A rule is a condition under which a text fails. Rules stand in one CASE expression, so a text that
fails one isn't tried against those after it. Their order comes from a sample: each rule is timed on it
alone, all rules are tried on it together, and the next rule is always the one that rejects the most of what
its predecessors leave, per second of its cost. The order changes what a row costs, never its verdict, so
the sample (at most SAMPLE_ROWS rows of up to SAMPLE_CHARS characters, from the first partitions that have them) decides no result.

Words are maximal runs without ASCII white space; nulls count as empty and fail for lack of words. Repeated
windows of words are found by their hashes (64 bits), and equal hashes are compared by their words. Texts may
have any length, one row at a time in memory. Repeated rows are judged each for itself, empty tables give no
rows, and other columns are left alone whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import few, stored

# Fixed values.
BLANK = " \t\n\x0b\x0c\r"
BLANKS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

SAMPLE_ROWS = 500
SAMPLE_CHARS = 32_768
SAMPLE_SHARE = 16  # one row in so many may be in the sample
REPEATS = 2


@dataclass(frozen=True)
class Rule:
    """``needs``: the measures that the rule reads; ``fails``: its condition, from them by name."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[[dict[str, Column]], Column]


RULES = (
    Rule("few_words", ("n_words",), lambda m: m["n_words"] < LEAST_WORDS),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"]),
    Rule("symbols", ("n_words", "n_symbols"), lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    Rule("word_length", ("n_words", "word_chars"), lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"])),
    Rule("capitals", ("n_letters", "n_capitals"), lambda m: 2 * m["n_capitals"] > m["n_letters"]),
    Rule("letters", ("word_chars", "n_letters"), lambda m: 2 * m["n_letters"] < m["word_chars"]),
)
BASE = ("few_words", "repeated_words")


def _without(column: str, characters: str) -> Column:
    return F.length(F.translate(F.col(column), characters, ""))


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is evaluated once: as the variable of a lambda no optimizer rule writes it out where it is used, which inside a lambda would mean once an element."""
    return F.transform(F.array(value), then)[0]


def _words() -> Column:
    trimmed = F.btrim("text", F.lit(BLANK))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))


def _repeats(words: Column) -> Column:
    """Words in windows that the text has twice or more."""

    def twice(rows: Column, field: str) -> Column:
        near = lambda x, k: F.coalesce(F.get(rows, k)[field] == x[field], F.lit(False))
        return F.filter(rows, lambda x, k: near(x, k - 1) | near(x, k + 1))

    def covered(hashes: Column) -> Column:
        keyed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        likely = _bound(F.sort_array(keyed), lambda s: twice(s, "h"))
        texts = F.transform(likely, lambda x: F.struct(F.slice(words, x["i"] + 1, F.lit(WINDOW)).alias("w"), x["i"].alias("i")))
        places = F.sort_array(F.transform(_bound(F.sort_array(texts), lambda s: twice(s, "w")), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        total = F.aggregate(places, start, lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n")))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total["n"]).otherwise(0)

    starts = F.when(F.size(words) > WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(F.array().cast("array<int>"))
    return _bound(F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])), covered)


def _lines() -> Column:
    return F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")


# Of the column ``text`` and its words.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda words: F.size(words),
    "word_chars": lambda words: _without("text", BLANK),
    "n_symbols": lambda words: F.length("text") - _without("text", SYMBOLS),
    "n_lines": lambda words: F.size(_lines()),
    "n_dup_lines": lambda words: _bound(_lines(), lambda x: F.size(x) - F.size(F.array_distinct(x))),
    "n_repeat_words": _repeats,
    "n_letters": lambda words: F.length("text") - F.length(F.regexp_replace("text", "\\p{L}+", "")),
    "n_capitals": lambda words: F.length("text") - F.length(F.regexp_replace("text", "\\p{Lu}+", "")),
}


def _measured(names: tuple[str, ...]) -> Column:
    return _bound(_words(), lambda words: F.struct(*[MEASURES[m](words).cast("long").alias(m) for m in names]))


def _fails(rule: Rule, words: Column, known: tuple[str, ...] = ()) -> Column:
    """The condition of ``rule``; measures that aren't ``known`` as columns are worked out where CASE comes to the rule."""
    return rule.fails({m: F.col(m) if m in known else MEASURES[m](words).cast("long") for m in rule.needs})


def _greedy(costs: dict[str, float], patterns: list[tuple[frozenset[str], int]]) -> list[str]:
    """Rules by rejections per second among the rows that are left; ``patterns`` counts sampled rows by the rules they fail."""
    order, left = [], dict(patterns)
    while len(order) < len(costs):
        caught = {r: sum(n for failed, n in left.items() if r in failed) for r in costs if r not in order}
        best = max(caught, key=lambda r: (caught[r] / costs[r], -costs[r]))
        order.append(best)
        left = {failed: n for failed, n in left.items() if best not in failed}
    return order


def plan_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, known: tuple[str, ...] = (), text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of ``rules`` in the order of the cascade, from a sample of ``docs``. Without rows, as they are given."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    rows = docs.select(text).where((F.pmod(F.xxhash64("text", F.lit(7)), F.lit(SAMPLE_SHARE)) == 0) & (F.length("text") <= SAMPLE_CHARS))
    sample = few(rows, sample_rows).withColumn("words", _words())
    sample = stored(sample.withColumn("m", _measured(known)).select("text", "words", "m.*") if known else sample)
    words = F.col("words")

    def seconds(condition: Column) -> float:
        took = []
        for _ in range(REPEATS):
            began = time.perf_counter()
            sample.agg(F.count_if(condition)).collect()  # one number
            took.append(time.perf_counter() - began)
        return min(took)

    nothing = seconds(F.length("text") < 0)
    costs = {r.name: max(seconds(_fails(r, words, known)) - nothing, 1e-3) for r in rules}
    failed = F.array_compact(F.array(*[F.when(_fails(r, words, known), r.name) for r in rules])).alias("failed")
    counts = sample.select(failed).groupBy("failed").count().collect()  # at most sample_rows of them
    return _greedy(costs, [(frozenset(x["failed"]), x["count"]) for x in counts])


def _judged(order: list[str], words: Column, known: tuple[str, ...] = (), rules: tuple[Rule, ...] = RULES) -> Column:
    """Name of the first rule in ``order`` that a row fails, or null."""
    by_name = {r.name: r for r in rules}
    chain = F.when(_fails(by_name[order[0]], words, known), order[0])
    for name in order[1:]:
        chain = chain.when(_fails(by_name[name], words, known), name)
    return chain


def measure_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base measures, base_failed, kept and the rule that it failed first (null if kept).

    The base measures are asked of every document, so the cascade reads them as columns; the measures of
    the other rules are worked out only for documents that their predecessors leave.
    """
    known = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    order = plan_order(docs, known=known, text_col=text_col)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text)
    rows = rows.withColumn("m", _measured(known)).select("doc_id", "text", "m.*")
    base = [_fails(r, _words(), known) for r in RULES if r.name in BASE]
    rows = rows.withColumn("failed", _judged(order, _words(), known))
    return rows.select("doc_id", *known, (base[0] | base[1]).alias("base_failed"), F.col("failed").isNull().alias("kept"), "failed")


def good_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that fail no rule; each text is tried until its first failure."""
    order = plan_order(docs, text_col=text_col)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).alias("row"), text.alias("text"))
    return rows.where(_bound(_words(), lambda words: _judged(order, words)).isNull()).select(*[F.col(f"row.{n}").alias(c) for c, n in names.items()])


def _sql() -> str:
    """The result of measure_quality without ``failed``, as DuckDB SQL."""
    word = "[^\\x20\\x09-\\x0D]"
    after = ", ".join(f"lead(w, {k}) OVER (PARTITION BY r ORDER BY i) AS w{k}" for k in range(1, WINDOW))
    window = ", ".join(["w", *[f"w{k}" for k in range(1, WINDOW)]])
    symbols = "".join(f"\\x{ord(c):02x}" for c in SYMBOLS)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
    t AS (SELECT *, regexp_extract_all(text, '{word}+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM d),
    tokens AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM t),
    win AS (SELECT *, {after} FROM tokens),
    twice AS (SELECT r, i FROM win WHERE w{WINDOW - 1} IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, {window}) > 1),
    repeats AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) x(k) GROUP BY r),
    m AS (SELECT doc_id, len(words) AS n_words, len(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
      len(text) - len(regexp_replace(text, '[{symbols}]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
      len(lines) AS n_lines, len(text) - len(regexp_replace(text, '\\p{{L}}', '', 'g')) AS n_letters, len(text) - len(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS n_capitals
      FROM t LEFT JOIN repeats USING (r)),
    b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words
        OR 2 * n_capitals > n_letters OR 2 * n_letters < word_chars) AS kept FROM b"""


SQL = _sql()
