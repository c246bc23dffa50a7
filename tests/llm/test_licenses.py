import random
from itertools import combinations

from lodestride.llm import licenses as S


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_winnowing_covers_every_window():
    rng = random.Random(0)
    for n in range(1, 30):
        hashes = [rng.randrange(10) for _ in range(n)]
        kept = set(S.winnow(hashes))
        for i in range(n - S.WINDOW + 1):
            low = min(hashes[i : i + S.WINDOW])
            assert any(i <= k < i + S.WINDOW and hashes[k] == low for k in kept)


def test_alignment_finds_the_common_words():
    rng = random.Random(0)
    template = [f"w{i}" for i in range(30)]
    for _ in range(60):
        copy = [w for w in template if rng.random() > 0.05]
        for _ in range(2):
            copy.insert(rng.randrange(len(copy)), "x")
        text = ["a"] * 10 + copy + ["b"] * 10
        matched, first, last = S.align(template, text, 10, 8)
        assert matched == lcs(template, copy)
        assert text[first] == next(w for w in template if w in copy) and text[last - 1] == [w for w in template if w in copy][-1]


def test_every_template_is_found_with_its_span():
    index = S.index_of()
    for t, (_, notice) in enumerate(S.TEMPLATES):
        text = f"İntro %% words,\n{notice.upper()} and more."
        found = [x for x in S.find_licenses(text, index) if x[0] == t]
        assert len(found) == 1
        _, start, end, matched = found[0]
        assert matched == len(index.words[t]) and S.words_of(text[start:end]) == index.words[t]


def test_edits_and_false_alarms():
    index = S.index_of()
    edited = "This work is hereby licensed under the GNU General Public License, release 3."
    assert [S.TEMPLATES[x[0]][0] for x in S.find_licenses(edited, index)] == ["GPL-3.0"]
    assert S.find_licenses("licensed under the sun, version of the work is public", index) == []
    assert len(S.find_licenses("Released under the MIT License. " * 3, index)) == 3


def test_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "x Released under the MIT License.", 0), (3, "x Released under the MIT License.", 0), (None, "w " * 100_000 + "Licensed under CC BY-NC 4.0.", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = sorted(((r.doc_id or 0, r.license, r.start, r.end, r.coverage) for r in S.scan_licenses(docs).collect()))
    assert got == [(0, "CC-BY-NC-4.0", 200_000, 200_027, 1.0), (3, "MIT", 2, 32, 1.0), (3, "MIT", 2, 32, 1.0)]
    assert S.scan_licenses(docs.limit(0)).count() == 0


def test_whole_query_against_brute_force(spark):
    """Documents and templates with 80 % of the words in order within a window, by dynamic programming over all windows."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lower(text) like '%licen%' or doc_id % 10 = 0").select("doc_id", "text")
    index, want = S.index_of(), set()
    for r in table.collect():
        words = S.words_of(r.text or "")
        for t, template in enumerate(index.words):
            n, need, own = len(template), -(-4 * len(template) // 5), set(template)
            inside = [w in own for w in words]
            for i in range(len(words)):
                if inside[i] and sum(inside[i : i + n + S.band_of(n)]) >= need and lcs(template, words[i : i + n + S.band_of(n)]) >= need:
                    want.add((r.doc_id, t))
                    break
    got = {(r.doc_id, r.template) for r in S.scan_licenses(table).collect()}
    assert got == want and len(want) > 10


def test_every_edit_that_leaves_enough_words_is_found():
    index, rng = S.index_of(), random.Random(1)
    for t, template in enumerate(index.words):
        n = len(template)
        if n > 60:
            continue
        most = n - -(-4 * n // 5)
        sets = list(combinations(range(n), most)) if n <= 8 else [rng.sample(range(n), most) for _ in range(20)]
        for gone in [*sets, range(n)[4::5][:most]]:
            changed = ["other" if i in gone else w for i, w in enumerate(template)]
            left = [w for i, w in enumerate(template) if i not in gone]
            for words in (changed, left):
                found = S.find_licenses(" ".join(["intro", "text", *words, "and", "more"]), index)
                assert any(x[0] == t and x[3] >= n - most for x in found), (words, found)
