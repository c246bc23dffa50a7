import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from lodestride.llm import packing as P


TOKENIZER = Tokenizer.from_file(P.default_tokenizer())


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, P.END_ID]


ODD = ["", "a", " ", "don't  x's <|endoftext|>y ẞΣ\x1cfoo", " bar é é ́ İx ªb", '"ÀÉa!!" ... a_b x%%% Ça\'s naïve-co <|a 12ab/', "Σας ΣΑΣ", "日本語 test", "a\x00b", "x" * 3000]


def test_ids_equal_the_tokenizer():
    rng = random.Random(0)
    texts = ODD + [None] + ["".join(rng.choices("aBé'! \n\t1_%<|>ßİŒΣ́", k=rng.randint(0, 40))) for _ in range(500)]
    texts += ["".join(rng.choices("aZéÖ.,!-\n (", k=rng.randint(0, 60))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([rng.randrange(0x20, 0x260), rng.randrange(1, 0xD800), rng.randrange(0x10000, 0x11000)])) for _ in range(30)) for _ in range(500)]
    got = list(P.encode_all(pa.array(texts), P.Words(P.default_tokenizer())))
    assert len(got) == len(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == ids_of(text), text


def test_no_texts_and_empty_texts():
    words = P.Words(P.default_tokenizer())
    assert list(P.encode_all(pa.array([], pa.string()), words)) == []
    assert [x.tolist() for x in P.encode_all(pa.array([None, "", " "], pa.string()), words)] == [[P.END_ID]] * 3


def test_piece_crc():
    ids = array("I", range(1000, 1333)).tobytes()
    blocks = array("I", [zlib.crc32(ids[i : i + 4 * P.BLOCK]) for i in range(0, len(ids), 4 * P.BLOCK)])
    for start, end in [(0, 333), (0, 320), (64, 333), (96, 128), (320, 333)]:
        assert P.piece_crc(blocks, start, end) == zlib.crc32(ids[4 * start : 4 * end])


def check_pack(sizes):
    pieces = P.pack(sizes)
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for i, start, n, s, offset in pieces:
        assert n > 0 and (start % P.BLOCK == 0)
        of_doc[i].append((start, n))
        of_sequence[s].append((offset, n))
    for i, n in enumerate(sizes):
        at = 0
        for start, length in sorted(of_doc[i]):
            assert start == at
            at += length
        assert at == n
    for parts in of_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= P.CAPACITY
    return len(of_sequence), of_sequence


def test_packing_is_whole_tight_and_balanced():
    rng = random.Random(1)
    for sizes in ([], [1], [4096], [4097], [10_000, 1], [4090] * 30, [2049] * 40, [1] * 5000):
        check_pack(sorted(sizes, reverse=True))
    sizes = sorted((int(rng.lognormvariate(6, 1.2)) + 1 for _ in range(3000)), reverse=True)
    n, sequences = check_pack(sizes)
    assert sum(sizes) / (n * P.CAPACITY) > 0.98
    cost = [sum(k + k * k * P.QUADRATIC for _, k in parts) for parts in sequences.values()]
    assert np.percentile(cost, 75) / np.percentile(cost, 25) < 1.2


def test_documents(spark):
    rows = [(i, f"w{i} " * (i * 37 % 900), "x") for i in range(150)]
    rows += [(900, "long text here " * 9000, "x"), (901, None, "x"), (902, "", "x"), (902, "", "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset string").repartition(4)
    got = P.pack_documents(docs, group_sequences=8).collect()
    texts = {i: t for i, t, _ in rows}
    of_doc, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        of_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(of_doc) == set(texts)
    for i, pieces in of_doc.items():
        ids = ids_of(texts[i])
        covered = sorted((r.start, r.length) for r in pieces)
        if i == 902:
            assert covered == [(0, 1), (0, 1)]
            continue
        assert [a for a, _ in covered] == [0, *np.cumsum([n for _, n in covered])[:-1]] and sum(n for _, n in covered) == len(ids)
        for r in pieces:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= P.CAPACITY
    assert P.pack_documents(docs.limit(0)).count() == 0


def test_other_tokenizers_read_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    words, plain = P.Words(path), Tokenizer.from_file(path)
    assert not words.by_word and P.Words(P.default_tokenizer()).by_word
    texts = ["a b  c", "", " x\n\n y", "don't"]
    for text, got in zip(texts, P.encode_all(pa.array(texts), words)):
        assert got.tolist() == [*plain.encode(text, add_special_tokens=False).ids, P.END_ID]


def test_slices_change_nothing(monkeypatch):
    rng = random.Random(3)
    texts = pa.array(["", *(" ".join(f"w{rng.randrange(3000)} Été," for _ in range(rng.randrange(50))) for _ in range(300)), None])
    want = [x.tolist() for x in P.encode_all(texts, P.Words(P.default_tokenizer()))]
    assert len(want) == len(texts)
    for n in (1, 100, 1000):
        monkeypatch.setattr(P, "SLICE_BYTES", n)
        assert [x.tolist() for x in P.encode_all(texts.slice(0), P.Words(P.default_tokenizer()))] == want
        assert [x.tolist() for x in P.encode_all(texts.slice(50), P.Words(P.default_tokenizer()))] == want[50:]


def test_packing_follows_the_stored_order(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i if i % 7 else None, "word " * rng.randint(200, 900), "n") for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, file string").repartition(3).write.parquet(str(tmp_path / "a"))
    docs = spark.read.parquet(str(tmp_path / "a"))
    order = [(r["text"], r["doc_id"]) for r in docs.selectExpr("*", "_metadata.file_name f", "_metadata.row_index k").orderBy("f", "k").collect()]
    got = [r.asDict() for r in P.pack_in_order(docs, group_sequences=4).collect()]
    total = defaultdict(int)
    for r in got:
        total[r["sequence_id"]] += r["length"]
    assert sum(total.values()) == sum(len(t.split()) + 1 for t, _ in order) and max(total.values()) <= P.CAPACITY
    place = {i: k for k, (_, i) in enumerate(order) if i is not None}
    groups = defaultdict(list)
    for r in got:
        if r["doc_id"] is not None:
            groups[r["sequence_id"] >> 32].append(place[r["doc_id"]])
    assert len(groups) > 5
    cut = [(min(g), max(g)) for _, g in sorted(groups.items())]
    assert all(a[1] < b[0] for a, b in zip(cut, cut[1:]))
    assert P.pack_in_order(docs.limit(0) if False else docs.where("false")).count() == 0


def test_one_id_on_many_rows_is_spread(spark):
    docs = spark.createDataFrame([(7, "word " * 400, 1)] * 200 + [(None, "word " * 300, 2)] * 200, "doc_id long, text string, g int")
    got = P.pack_documents(docs, group_sequences=2).collect()
    assert sum(r.length for r in got) == 200 * 401 + 200 * 301
    assert len({r.sequence_id >> 32 for r in got}) > 5
