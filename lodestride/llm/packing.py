"""Cost-balanced packing of tokenised documents into sequences.

A piece of n tokens costs n + n^2 x QUADRATIC (attention within the piece). Documents are dealt
to groups of about ``group_sequences`` full sequences, and each group is packed
by itself: the documents go in descending length to the sequence with the lowest cost among those with
enough room. Documents longer than a sequence are cut into full sequences first. One that fits
nowhere is cut at a multiple of BLOCK tokens to fill the cheapest sequences with room, so a group
wastes less than BLOCK tokens a sequence and one open sequence.

Groups are either drawn by a hash of the id, or, for documents stored in a meaningful order (pack_in_order), ranges of
that order: then the sequences of a group, and the groups, follow it, and the order decides among documents of equal length.

Texts are tokenised once, in tasks; of the token ids only their number and the CRC-32 of each
block are kept, from which the CRC-32 of any piece follows. With the tokenizer for which that holds
(white space dropped, merges within words alone), the distinct words of some megabytes of texts are tokenised and texts
put together from their ids; with any other, whole texts are tokenised.

Null texts count as empty and hold the end token alone. Every row is packed, repeated ones too; rows without an id, or
with one id on many rows, are spread over groups. An empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestride.llm.common import checkpointed, map_tasks

CAPACITY = 4096
END_ID = 2
BLOCK = 32
QUADRATIC = 1 / 12288  # 4 d n / 24 d^2 for a model of width d = 2048
GROUP_SEQUENCES = 1024
ORDERED_SEQUENCES = 256
SLICE_BYTES = 4 << 20  # of texts whose distinct words are tokenised together
PARTS = 8192  # of words, in one call of the tokenizer
TOKENS_SCHEMA = "doc_id long, n long, crc long, blocks binary"
PIECES_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# Tokens -------------------------------------------------------------------------------------


@lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# How the tokenizer changes and splits texts if words can be tokenised one by one.
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
# Letters and marks of plain words: the tokenizer splits these just between marks and letters, and only changes the case of letters.
# Apostrophes (contractions), digits and all else take the tokenizer's own way.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
MARKS = "!-&(-/:-@[-`{-~"
OTHER, LETTER, MARK, LINE = range(4)
SPECIAL = "<|"  # in each special token
# The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for U+0100 and on.
VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: b for b in VISIBLE} | dict(zip((b for b in range(256) if b not in VISIBLE), range(0x100, 0x200)))


def _ranges(text: str) -> Iterator[int]:
    """Code points of ranges such as A-Z."""
    for first, last in zip(text[::3], text[2::3]):
        yield from range(ord(first), ord(last) + 1)


def take(flat: np.ndarray, bounds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[bounds[i] : bounds[i + 1]] for each i of ``index``, one after another, and their bounds."""
    lengths = (bounds[1:] - bounds[:-1])[index]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return flat[np.repeat(bounds[index] - ends[:-1], lengths) + np.arange(ends[-1])], ends


class Words:
    """Ids of texts, by their distinct words where the tokenizer allows that."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        form = json.loads(self.tokenizer.to_str())
        self.by_word = (form["normalizer"], form["pre_tokenizer"]) == (NORMAL, WORD_SPLIT) and all(SPECIAL in t["content"] for t in form["added_tokens"])
        if self.by_word:
            self.parts, self.line = _part_tokenizer(path)
            self.kind = np.zeros(ord(LETTERS[-1]) + 2, np.uint8)
            self.kind[[*_ranges(LETTERS)]], self.kind[[*_ranges(MARKS)]], self.kind[ord("\n")] = LETTER, MARK, LINE
            self.lower = np.arange(len(self.kind), dtype=np.uint32)
            self.lower[self.kind == LETTER] = [ord(chr(c).lower()) for c in np.flatnonzero(self.kind == LETTER)]
            self.chars = np.array([BYTE_CHARS[b] for b in range(256)], np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` and the bounds of each, as the tokenizer gives them."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter((i for each in ids for i in each), np.uint32), np.cumsum([0, *map(len, ids)])

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As encode, for plain parts of words."""
        ids = [np.empty(0, np.uint32)]
        for i in range(0, len(parts), PARTS):  # the tokenizer takes much memory a character
            lines = np.frombuffer(_joined(parts.slice(i, PARTS)).encode(), np.uint8)
            chars = self.chars[lines].tobytes().decode("utf-32-le")
            ids.append(np.array(self.parts.encode_batch_fast([chars], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(ids)
        ends = np.flatnonzero(ids == self.line)
        return ids[ids != self.line], np.concatenate([[0], ends - np.arange(len(ends))])

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As encode, for distinct words without ASCII white space."""
        lines = _joined(words)
        points = np.frombuffer(lines.encode("utf-32-le"), np.uint32)
        kinds = self.kind[np.minimum(points, len(self.kind) - 1)]
        ends = np.flatnonzero(kinds == LINE)
        starts = np.concatenate([[0], ends[:-1] + 1])
        letter = kinds == LETTER
        first, last = np.flatnonzero(letter & ~np.r_[False, letter[:-1]]), np.flatnonzero(letter & ~np.r_[letter[1:], False])
        # A plain word has one run of letters, marks beside it and no start of a special token.
        runs = np.searchsorted(first, ends) - np.searchsorted(first, starts)
        odd = (kinds == OTHER) | ((points == ord(SPECIAL[0])) & (np.r_[points[1:], 0] == ord(SPECIAL[1])))
        odds = np.concatenate([[0], np.cumsum(odd)])
        plain = (runs == 1) & (odds[ends] == odds[starts])
        other, other_bounds = self.encode(words.filter(pa.array(~plain)).to_pylist())
        # Each plain word becomes three lines: marks, letters, marks.
        run = np.searchsorted(first, starts[plain])
        inside = np.repeat(plain, ends - starts + 1)
        cuts = np.sort(np.concatenate([first[run], last[run] + 1]))
        own = np.cumsum(inside) - inside  # place among characters of plain words
        text = np.insert(self.lower[points[inside]], own[cuts], ord("\n")).tobytes().decode("utf-32-le")
        parts = pc.split_pattern(pa.array([text], pa.large_string()), "\n").flatten()[:-1].dictionary_encode()
        ids, bounds = take(*self._encode_parts(parts.dictionary), parts.indices.to_numpy())
        # Both kinds back to the order of the words.
        place = np.empty(len(words), np.int64)
        place[plain], place[~plain] = np.arange(plain.sum()), plain.sum() + np.arange((~plain).sum())
        return take(np.concatenate([ids, other]), np.concatenate([bounds[::3], bounds[-1] + other_bounds[1:]]), place)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As encode; ``texts`` hold no null."""
        if not self.by_word:
            return self.encode(texts.to_pylist())
        # Only characters that surely are white space to the tokenizer part words here.
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        ids, bounds = take(*self.encode_words(words.dictionary), words.indices.to_numpy())
        offsets = split.offsets.to_numpy()
        return ids, bounds[offsets - offsets[0]]


@lru_cache(2)
def _part_tokenizer(path: str):
    """A tokenizer of lines in the byte-level alphabet, with the merges of the one at ``path``, and its id of a line feed."""
    from tokenizers import Tokenizer

    form, line = json.loads(_tokenizer(path).to_str()), chr(BYTE_CHARS[ord("\n")])
    form |= {"normalizer": None, "post_processor": None, "added_tokens": []}
    form["pre_tokenizer"] = {"type": "Split", "pattern": {"String": line}, "behavior": "Isolated", "invert": False}
    tokenizer = Tokenizer.from_str(json.dumps(form))
    (number,) = tokenizer.encode(line).ids
    return tokenizer, number


def _joined(words: pa.Array) -> str:
    """``words``, each ended by a line feed."""
    if not len(words):
        return ""
    one = pa.ListArray.from_arrays([0, len(words)], words)
    return pc.binary_join(one, pa.scalar("\n", words.type))[0].as_py() + "\n"


def encode_all(texts: pa.Array, words: Words) -> Iterator[np.ndarray]:
    """Ids of each text and the end id, as 32-bit numbers; texts are taken SLICE_BYTES at a time, or one, if that is longer."""
    texts = pc.fill_null(texts, "")
    before = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))])
    i = 0
    while i < len(texts):
        k = max(i + 1, int(np.searchsorted(before, before[i] + SLICE_BYTES, "right")) - 1)
        ids, bounds = words.encode_texts(texts.slice(i, k - i))
        ids = np.insert(ids, bounds[1:], END_ID)
        bounds = bounds + np.arange(len(bounds))
        yield from (ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        i = k


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", kept: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, n, crc, blocks) and ``kept``: number and CRC-32 of each document's ids, and of each block of them."""
    path, kept = path or default_tokenizer(), kept or {}
    names = list(kept)

    def begin():
        words = Words(path)

        def batch(b: pa.RecordBatch) -> pa.RecordBatch:
            n, crc, blocks = [], [], []
            for ids in encode_all(b.column("text"), words):
                n.append(len(ids))
                view = memoryview(ids).cast("B")
                crc.append(zlib.crc32(view))
                blocks.append(array("I", [zlib.crc32(view[i : i + 4 * BLOCK]) for i in range(0, len(view), 4 * BLOCK)]).tobytes())
            columns = [pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(blocks, pa.binary())]
            return pa.RecordBatch.from_arrays([b.column("doc_id"), *columns, *(b.column(k) for k in names)], names=["doc_id", "n", "crc", "blocks", *names])

        return batch

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *[c.alias(k) for k, c in kept.items()])
    more = "".join(f", {k} {rows.schema[k].dataType.simpleString()}" for k in names)
    return map_tasks(rows, begin, TOKENS_SCHEMA + more)


def piece_crc(blocks: array, start: int, end: int) -> int:
    """CRC-32 of the ids start..end of a document; start is a multiple of BLOCK, end one or the document's."""
    zeros, ones, crc, at = bytes(4 * BLOCK), 0xFFFFFFFF, 0, start
    while at < end:
        n = 4 * min(BLOCK, end - at)
        crc = zlib.crc32(zeros[:n], crc ^ ones) ^ ones ^ blocks[at // BLOCK]  # as after n zeros, then the block
        at += BLOCK
    return crc


# Packing ------------------------------------------------------------------------------------


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these sizes (1 at least), largest first."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequences, rest = 0, []
    for i, n in enumerate(sizes):
        at = 0
        while n - at >= capacity:
            pieces.append((i, at, capacity, sequences, 0))
            sequences, at = sequences + 1, at + capacity
        if at < n:
            rest.append((n - at, i, at))
    rest.sort(key=lambda x: (-x[0], x[1]))
    room: dict[int, int] = {}
    cost: list[tuple[float, int]] = []

    def opened() -> None:
        nonlocal sequences
        room[sequences] = capacity
        heapq.heappush(cost, (0.0, sequences))
        sequences += 1

    def put(i: int, at: int, n: int, spent: float, s: int) -> None:
        pieces.append((i, at, n, s, capacity - room[s]))
        room[s] -= n
        if room[s]:
            heapq.heappush(cost, (spent + n + n * n * QUADRATIC, s))

    for _ in range(-(-sum(n for n, _, _ in rest) // capacity)):
        opened()
    for n, i, at in rest:
        while n:
            tried = []
            while cost and room[cost[0][1]] < n:
                tried.append(heapq.heappop(cost))
            if cost:
                put(i, at, n, *heapq.heappop(cost))
                n = 0
            # It fits nowhere: a part goes to the cheapest sequence with room for a block.
            part = next((k for k, (_, s) in enumerate(tried) if room[s] >= BLOCK), None) if n else None
            if part is not None:
                spent, s = tried.pop(part)
                some = room[s] // BLOCK * BLOCK
                put(i, at, some, spent, s)
                n, at = n - some, at + some
            elif n:
                opened()
            for x in tried:
                # Less room than any document left and than a block: closed for good.
                if room[x[1]] >= BLOCK or n == 0:
                    heapq.heappush(cost, x)
    return pieces


def _pack_group(table: pa.Table) -> pa.Table:
    """Pieces of the documents (doc_id, n, crc, blocks) of group g; equal lengths by ``at``, and sequences numbered by the first of it that they hold."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("n", "doc_id", "crc", "blocks", "g", "at"))), key=lambda r: (-r[0], r[5], r[1] is not None, r[1] or 0))
    pieces = pack([r[0] for r in rows])
    first: dict[int, tuple[int, int]] = {}
    for i, start, _, s, _ in pieces:
        first[s] = min(first.get(s, (2**63, 0)), (rows[i][5], start))
    number = {s: k for k, s in enumerate(sorted(first, key=lambda s: (first[s], s)))}
    out = []
    for i, start, length, s, offset in pieces:
        n, doc_id, crc, blocks, g, _ = rows[i]
        if length < n:
            crc = piece_crc(memoryview(blocks).cast("I"), start, start + length)
        out.append((doc_id, start, length, crc, n, (g << 32) + number[s], offset))
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", group_sequences: int = GROUP_SEQUENCES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tokens = checkpointed(token_counts(docs, path, id_col, text_col))
    total, rows, ids = tokens.agg(F.sum("n"), F.count(F.lit(1)), F.approx_count_distinct("doc_id")).first()
    groups = max(1, -(-(total or 0) // (CAPACITY * group_sequences)))
    # Where ids repeat, they can't spread rows evenly; places in the checkpoint do.
    spread = F.xxhash64("doc_id") if rows and ids > 0.8 * rows else F.xxhash64("doc_id", F.monotonically_increasing_id())
    dealt = tokens.withColumn("g", F.pmod(spread, F.lit(groups))).withColumn("at", F.lit(0).cast("long"))
    return dealt.groupBy("g").applyInArrow(_pack_group, PIECES_SCHEMA)


def pack_in_order(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", group_sequences: int = ORDERED_SEQUENCES) -> DataFrame:
    """As pack_documents, along the order in which ``docs`` are stored: sequence_id ascends with it, from group to group and by first documents within one.

    ``docs`` must come from files (as those of mixing.mixed_documents do when they are read again): the order is that of their names and
    of rows in them.
    """
    place = docs.metadataColumn("_metadata")  # not a column of that name that documents may have
    kept = {"file": place["file_name"], "row": place["row_index"]}
    tokens = checkpointed(token_counts(docs, path, id_col, text_col, kept))
    total, rows = tokens.agg(F.sum("n"), F.count(F.lit(1))).first()
    each = max(1, round((rows or 0) * CAPACITY * group_sequences / max(total or 0, 1)))  # documents of a group
    files = tokens.groupBy("file").agg((F.max("row") + 1).alias("rows"))  # one row a file
    files = files.select("file", (F.sum("rows").over(Window.orderBy("file")) - F.col("rows")).alias("before"))
    placed = tokens.join(files, "file").withColumn("at", F.col("before") + F.col("row"))
    dealt = placed.withColumn("g", F.expr(f"at div {each}")).select("doc_id", "n", "crc", "blocks", "g", "at")
    return dealt.groupBy("g").applyInArrow(_pack_group, PIECES_SCHEMA)
