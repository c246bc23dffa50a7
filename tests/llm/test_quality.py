"""Quality rules against a plain count of each measure, and the order of the cascade."""

import random
import re

import duckdb
import pytest

from lodestride.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def plain(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1}
    repeats = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    letters = sum(c.isalpha() for c in text)
    n, chars, symbols = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text)
    base = n < 10 or 100 * len(repeats) > 20 * n
    dup = len(lines) - len(set(lines))
    bad = 10 * symbols > n or 10 * dup > 3 * len(lines) or chars < 2 * n or chars > 20 * n or 2 * sum(c.isupper() for c in text) > letters or 2 * letters < chars
    return n, chars, symbols, dup, len(repeats), base, not (base or bad)


def texts():
    rng = random.Random(5)
    out = ["", None, " \n\t ", "\n\n", "one", "a b c d e f", "x " * 40, "word " * 300, "ÉTÉ été " * 20, "a\x0bb\x0cc\r\nd e", "# * $ % " * 9, "same line here\n" * 4 + "other line of words here now"]
    for _ in range(60):
        words = [rng.choice(["lorem", "ipsum", "dolor", "sit", "Amet", "NON", "#a", "|", "12", "çà"]) for _ in range(rng.randrange(80))]
        out.append("".join(w + rng.choice([" ", "  ", "\n", "\t"]) for w in words))
    long = [f"qwerty{rng.randrange(10**6):x}" for _ in range(20_000)]
    return [*out, " ".join(long + long[100:112] + ["end"]), " ".join(f"word{i}x" for i in range(30))]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(texts())), SCHEMA)


def test_measures_and_verdict_by_plain_counts(spark, rows):
    got = {r["doc_id"]: tuple(r)[1:8] for r in quality.measure_quality(rows).collect()}
    fast = {i: t for i, t in enumerate(texts()) if len(t or "") < 50_000}
    assert {i: got[i] for i in fast} == {i: plain(t) for i, t in fast.items()}
    assert len(got) == len(texts())
    (long,) = [v for i, v in got.items() if i not in fast]
    assert long[0] == 20_013 and long[4] == 24 and long[6]


def test_sql_gives_the_same(rows):
    con = duckdb.connect()
    con.register("documents", rows.toPandas())
    want = {r[0]: r[1:] for r in con.execute(quality.SQL).fetchall()}
    assert {r["doc_id"]: tuple(r)[1:8] for r in quality.measure_quality(rows).collect()} == want


def test_filter_keeps_the_same_rows_with_clashing_columns(spark, rows):
    names = ["words", "hashes", "row", "failed", "n_words", "c0"]
    wide = rows.selectExpr("*", *[f"doc_id AS {n}" for n in names])
    wide = wide.unionByName(wide.where("doc_id > 60"))  # repeated rows are judged each for itself
    kept = quality.good_documents(wide)
    assert kept.columns == wide.columns
    want = sorted(i for i, t in enumerate(texts()) if len(t or "") < 50_000 and plain(t)[6])
    got = [r["doc_id"] for r in kept.collect() if r["doc_id"] != len(texts()) - 2]
    assert sorted(set(got)) == want
    assert all(got.count(i) == 1 + (i > 60) for i in want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.measure_quality(empty).collect() == [] and quality.good_documents(empty).collect() == []


def test_order_is_rejection_per_cost_of_what_is_left():
    few, sym, rep = frozenset({"few", "sym"}), frozenset({"sym"}), frozenset({"rep"})
    # sym rejects 30 for 1, rep 50 for 4; after sym, nothing is left for few, and rep comes before it.
    assert quality._greedy({"few": 1.0, "sym": 1.0, "rep": 4.0}, [(few, 10), (sym, 20), (rep, 50), (frozenset(), 100)]) == ["sym", "rep", "few"]


def test_a_rejected_row_is_not_tried_further(spark):
    """The chain is one CASE: a later rule that would fail the job isn't reached."""
    rows = spark.createDataFrame([(1, "a b")], SCHEMA)
    trap = quality.Rule("trap", ("n_words",), lambda m: quality.F.raise_error("reached").cast("boolean") | (m["n_words"] > 0))
    chain = quality._judged(["few_words", "trap"], quality._words(), (), (*quality.RULES, trap))
    assert rows.select(chain.alias("f")).collect()[0]["f"] == "few_words"


def test_a_filter_on_the_verdict_is_not_written_out_per_word(spark):
    """Filters go below projections; the words must still be split once a row."""
    text = " ".join(f"word{i}" for i in range(20_000))
    rows = spark.createDataFrame([(1, text)], SCHEMA)
    assert quality.measure_quality(rows).where("kept").count() == 0  # half of the characters are digits
    assert quality.good_documents(spark.createDataFrame([(1, " ".join(f"longword{i}" for i in range(20_000)))], SCHEMA)).count() == 1


def test_no_python_in_the_plan(rows):
    plan = quality.measure_quality(rows.sparkSession.createDataFrame(rows.toPandas(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
