"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Every byte that lies in a string of ``length`` bytes which also starts earlier (in a document with
a smaller id, or earlier in the same one) is removed. Matches never cross documents.

1. Anchors. In each window of ``length`` bytes the ANCHOR-byte string with the smallest hash is
   its anchor, which depends on the window's bytes alone, so equal windows have equal anchors at
   equal places.
2. Contexts. Around each anchor lie all windows that have it. Keys of contexts (the anchor's
   hash and a hash of the whole context, 128 bits) meet within some megabytes, then by anchor. They only choose what is
   compared: a later context with the keys of an earlier one becomes a claim to repeat it, and claims on one
   document that touch are joined to runs. Where an anchor has several contexts, the bytes of the earliest of
   each are fetched and dealt to tasks by the anchor's hash. Those that share no part around the anchor that a common window
   would hold are set aside.
3. Transforms. Strings form shards: the claims of a batch of documents and what they repeat in others, or the
   contexts of a batch of anchors. Each shard sorts the
   rotations of its own strings once; then the shards' transforms are merged by refining their
   interleave: starting from one block, rows in the current order are stably sorted by the symbol (STEP
   bytes) before them (their transform), which yields the order by one symbol more. No suffix is compared
   or sorted again. Where a new block begins during round r, neighbours share fewer than r symbols, so
   after length / STEP rounds the blocks are the repeated intervals of ``length`` bytes. In each, every
   window but the earliest is removed; nothing else removes a byte. Claims are read at whole steps, which cover them
   with few windows; contexts at every byte.
4. Removed windows are merged per document and cut out.

Null texts count as empty; texts shorter than ``length`` stay whole. Null ids come before all
others. Repeated rows (same id and text) are one document and each gets its result; rows with the
same id and different texts are ordered by a hash of the text. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import strings

LENGTH = 100
ANCHOR = 32
STEP = 20  # bytes of a symbol
WORD = 8
SPLITS = 8
CHUNK_BYTES = 4_000_000  # texts whose equal contexts are joined before the shuffle
BLOCK = 32_768  # bytes hashed at a time, for the processor's cache
PLACE_BITS = 17  # of a place in a block
BATCH_BYTES = 40_000  # keeps a batch's arrays in the processor's cache and its symbols in 16 bits
BATCH_ROWS = 64
PROOF_BYTES = 2_000_000  # of claims in a batch
SHARDS = 2


# Anchors ------------------------------------------------------------------------------------


def _hashes(text: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of every ANCHOR-byte string (a power of two)."""
    with np.errstate(over="ignore"):
        h, n, power = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1, np.uint64(0xD6E8FEB86659FD93)
        while n < ANCHOR:
            next_h = h[:-n] * power
            next_h += h[n:]
            h, power, n = next_h, power * power, 2 * n
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x, n = np.minimum(x[:-n], x[n:]), 2 * n
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text number, place, hash, start and end of the context, key of the context) of the anchors of all windows of some texts.

    The key hashes the whole context by the hashes of ANCHOR-byte strings that cover it.
    """
    width, side = length - ANCHOR + 1, length - ANCHOR
    whole = np.frombuffer(b"".join(texts), np.uint8)
    if len(whole) < length:
        none = np.empty(0, np.int64)
        return none, none, none.astype(np.uint64), none, none, none.astype(np.uint64)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    hashes, places = np.empty(len(whole) - ANCHOR + 1, np.uint64), []
    low = np.uint64((1 << PLACE_BITS) - 1)
    for at in range(0, len(whole) - length + 1, BLOCK):
        h = _hashes(whole[at : at + BLOCK + length - 1])
        hashes[at : at + len(h)] = h
        # The place in the low bits makes the smallest key the first smallest hash.
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        found = (_sliding_min(key, width) & low).astype(np.int64) + at
        inside = np.ones(len(found), bool)  # windows inside one text
        for end in ends[np.searchsorted(ends, at, side="right") : np.searchsorted(ends, at + len(found) + length)]:
            inside[max(0, end - length + 1 - at) : max(0, end - at)] = False
        found = found[inside]
        places.append(found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found)
    place = np.concatenate(places)
    place = place[np.r_[True, place[1:] != place[:-1]]] if len(place) else place
    doc = np.searchsorted(ends, place, side="right")
    first = ends[doc] - sizes[doc]
    start, end = np.maximum(first, place - side), np.minimum(ends[doc], place + length)
    with np.errstate(over="ignore"):
        key = (end - start).astype(np.uint64)
        for k in range(0, length + side, ANCHOR):
            key ^= hashes[np.minimum(start + k, end - ANCHOR)]
            key *= np.uint64(0x9FB21C651E98DF25)
            key ^= key >> np.uint64(32)
    return doc, place - first, hashes[place], start - first, end - first, key


def _chunks(sizes: list[int]) -> Iterator[slice]:
    start, n = 0, 0
    for i, size in enumerate(sizes):
        if n and n + size > CHUNK_BYTES:
            yield slice(start, i)
            start, n = i, 0
        n += size
    if n:
        yield slice(start, len(sizes))


# Transforms ---------------------------------------------------------------------------------


def _dense(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].astype(np.int64)


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, number of the STEP bytes from there on, the same for the STEP bytes before) of every rotation.

    The numbers are dense and in the order of the bytes; texts are read as rings.
    """
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    base, size = np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(sizes, sizes)
    place = np.arange(len(flat)) - base

    def ahead(k: int) -> np.ndarray:
        return base + (place + k) % size

    word, n = flat.astype(np.uint64), 1
    while n < WORD:
        word, n = (word << np.uint64(8 * n)) | word[ahead(n)], 2 * n
    rank = _dense(word)
    many = int(rank.max()) + 1
    code = rank
    for k in (WORD, STEP - WORD):  # the last word overlaps the one before
        code = _dense(code * many + rank[ahead(k)])
    return np.repeat(np.arange(len(texts)), sizes), place, code, ahead(STEP)


class Shard:
    """Rotations of some byte strings, sorted by their first ``length`` bytes, with their transform."""

    def __init__(self, text: np.ndarray, place: np.ndarray, code: np.ndarray, ahead: np.ndarray, length: int) -> None:
        digits = [code]
        for _ in range(length // STEP - 1):
            digits.append(digits[-1][ahead])
        order = np.lexsort(digits[::-1])
        self.text, self.place = text[order], place[order]
        before = np.empty_like(code)
        before[ahead] = code  # what stands STEP before each rotation
        self.transform = before[order]


def merge(shards: list[Shard], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all shards (numbered one shard after another) in merged order, and the block of each."""
    sizes = [len(s.place) for s in shards]
    n, codes = sum(sizes), np.concatenate([s.transform for s in shards])
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)  # the interleave
    block = np.zeros(n, np.int32)
    rows, numbers = np.empty(n, np.int32), np.arange(n, dtype=np.int32)
    for _ in range(length // STEP):
        rows[np.argsort(source, kind="stable")] = numbers  # each shard's rows stay in its order
        symbol = codes[rows]
        order = np.argsort(symbol, kind="stable")
        symbol, old = symbol[order], block[order]
        block = np.empty(n, np.int32)
        block[0] = 0
        np.cumsum((symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1]), out=block[1:])
        source = source[order]
    rows[np.argsort(source, kind="stable")] = numbers
    return rows, block


def later_windows(shards: list[Shard], sizes: np.ndarray, order: np.ndarray, length: int, stride: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(text number, place) of every window of the shards' texts that also starts earlier, from their merged transforms.

    ``order`` ranks window starts: that of window p of text i is (order[i, 0], order[i, 1] + stride x p). ``sizes`` are in places.
    """
    rows, block = merge(shards, length)
    text = np.concatenate([s.text for s in shards])[rows]
    place = np.concatenate([s.place for s in shards])[rows]
    inside = place + length // stride <= sizes[text]
    text, place, block = text[inside], place[inside], block[inside]
    start = order[text, 1] + stride * place
    first = np.lexsort((start, order[text, 0], block))
    text, place, block, start = text[first], place[first], block[first], start[first]
    lead = np.r_[True, block[1:] != block[:-1]][: len(block)]
    leader = np.maximum.accumulate(np.where(lead, np.arange(len(block)), 0)) if len(block) else np.zeros(0, np.int64)
    same = (order[text, 0] == order[text[leader], 0]) & (start == start[leader])
    return text[~same], place[~same]


def repeated_windows(texts: list[bytes], order: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """As later_windows, for texts, at every place."""
    text, place, code, ahead = symbols(texts)
    if len(code) <= 1 << 16:
        code = code.astype(np.uint16)  # numpy sorts these by radix
    each = -(-len(texts) // SHARDS)
    cuts = np.searchsorted(text, [*range(0, len(texts), each), len(texts)])
    shards = [Shard(text[i:j], place[i:j], code[i:j], ahead[i:j] - i, length) for i, j in zip(cuts[:-1], cuts[1:])]
    return later_windows(shards, np.array([len(t) for t in texts]), order, length)


def _intervals(doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows as merged intervals (doc number, start, end)."""
    at = np.lexsort((start, doc))
    doc, start = doc[at], start[at]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + length)] if len(doc) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:] - 1, len(doc) - 1] if len(first) else first
    return doc[first], start[first], start[last] + length


# Jobs ---------------------------------------------------------------------------------------


# Rows between the jobs: contexts, or (claim) runs of bytes with the run (of document ``key``, version l_version, from ``anchor`` on) that
# their hashes say they repeat.
ROWS = "hash long, key long, start int, size int, anchor int, doc_id long, version long, l_version long, claim boolean"


def _runs(doc_id: np.ndarray, version: np.ndarray, start: np.ndarray, end: np.ndarray, l_doc: np.ndarray, l_version: np.ndarray, l_start: np.ndarray) -> dict[str, np.ndarray]:
    """Claim rows of copied intervals; those of a document that touch and repeat one document at one distance are joined. Their hash spreads documents over tasks."""
    shift = start.astype(np.int64) - l_start
    at = np.lexsort((start, shift, l_version, l_doc, version, doc_id))
    doc_id, version, start, end, l_doc, l_version, shift = (x[at] for x in (doc_id, version, start.astype(np.int64), end.astype(np.int64), l_doc, l_version, shift))
    other = np.zeros(len(at), bool)
    for x in (doc_id, version, l_doc, l_version, shift):
        other[1:] |= x[1:] != x[:-1]
    # All intervals of a group come after those of the one before on this line.
    line = np.cumsum(other) << 40
    reach = np.maximum.accumulate(line + end) if len(at) else line
    first = np.flatnonzero(np.r_[True, (line + start)[1:] > reach[:-1]][: len(at)])
    last = np.r_[first[1:] - 1, len(at) - 1] if len(first) else first
    start, size = start[first], (reach[last] - line[first]) - start[first]
    return {"hash": version[first] ^ doc_id[first], "key": l_doc[first], "start": start, "size": size, "anchor": start - shift[first], "doc_id": doc_id[first], "version": version[first], "l_version": l_version[first], "claim": np.ones(len(first), bool)}


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    kinds = {"start": pa.int32(), "size": pa.int32(), "anchor": pa.int32(), "claim": pa.bool_()}
    return pa.RecordBatch.from_arrays([pa.array(x).cast(kinds.get(k, pa.int64())) for k, x in columns.items()], names=list(columns))


def _find_contexts(length: int):
    """Contexts of all anchors; of those with equal hashes within some megabytes, the later become claims at once."""

    def over(batches):
        for b in batches:
            texts = [t.encode() for t in strings(b.column("text"))]
            ids, versions = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version"))
            for part in _chunks([len(t) for t in texts]):
                order = np.lexsort((versions[part], ids[part])) + part.start
                doc, place, h, start, end, key = anchors([texts[i] for i in order], length)
                doc_id, version = ids[order][doc], versions[order][doc]
                # Rows stand in the order of documents and places, which a stable sort keeps among equals.
                at = np.argsort(h ^ key, kind="stable")
                same = np.r_[False, (h[at][1:] == h[at][:-1]) & (key[at][1:] == key[at][:-1])] if len(at) else np.empty(0, bool)
                lead = at[np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))]
                # The same place of a repeated row is no copy.
                copy = same & ((doc_id[at] != doc_id[lead]) | (version[at] != version[lead]) | (start[at] != start[lead]))
                c, m = at[copy], lead[copy]
                yield _batch(_runs(doc_id[c], version[c], start[c], end[c], doc_id[m], version[m], start[m]))
                at = np.sort(at[~same])
                none = np.zeros(len(at), np.int64)
                yield _batch({"hash": h[at].view(np.int64), "key": key[at].view(np.int64), "start": start[at], "size": (end - start)[at], "anchor": (place - start)[at], "doc_id": doc_id[at], "version": version[at], "l_version": none, "claim": none > 0})

    return over


def _sort_out(batches):
    """Of rows sorted by hash, key, doc_id, version, start: claims of later contexts with equal hashes on the first one, and the first ones of anchors with several contexts."""
    names = ["hash", "key", "doc_id", "version", "start"]
    last, held = None, None  # last row; the first context of an anchor that has one so far
    for b in batches:
        claim = b.column("claim")
        yield b.filter(claim)
        b = b.filter(pc.invert(claim))
        if not b.num_rows:
            continue
        h, key, doc, version, start = (b.column(c).to_numpy(zero_copy_only=False) for c in names)
        h0, k0 = (np.r_[last[i] if last else x[0], x[:-1]] for i, x in ((0, h), (1, key)))
        same = (h == h0) & (key == k0)
        same[0] &= last is not None
        # Rows of one document version and place are one context, not copies of each other;
        # such rows come from repeated rows of the table.
        run = np.maximum.accumulate(np.where(same, 0, np.arange(len(h)) + 1))
        lead = [np.where(run > 0, x[np.maximum(run - 1, 0)], y) for x, y in zip((doc, version, start), last[2:] if last else (0, 0, 0))]
        later = same & ~((doc == lead[0]) & (version == lead[1]) & (start == lead[2]))
        if later.any():
            size = b.column("size").to_numpy(zero_copy_only=False)
            yield _batch(_runs(doc[later], version[later], start[later], (start + size)[later], *(x[later] for x in lead)))
        first = np.flatnonzero(~same)
        if len(first):
            new = np.r_[last is None or h[first[0]] != last[0], h[first[1:]] != h[first[:-1]]]  # of another anchor than the one before
            if not new[0] and held is not None:
                yield held
            several = ~new | np.r_[~new[1:], False]
            if several.any():
                yield b.take(pa.array(first[several]))
            held = b.take(pa.array(first[-1:])) if new[-1] else None
        last = (h[-1], key[-1], *(x[-1] for x in lead))


def _cut(b: pa.RecordBatch, claims: bool) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes], dict[str, np.ndarray]]]:
    """For some documents at a time: texts, the number of the document of each of its rows in ``found``, and the rows that are claims or not."""
    texts = [t.encode() for t in strings(b.column("text"))]
    for i in range(0, len(texts), 256):
        lists = b.column("found").slice(i, 256)
        owner = np.repeat(np.arange(i, i + len(lists)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        found = {k: pc.struct_field(flat, k).to_numpy(zero_copy_only=False) for k in ("start", "size", "anchor", "hash", "key", "l_version", "claim")}
        picked = found["claim"].astype(bool) == claims
        yield texts, owner[picked], {k: x[picked] for k, x in found.items()}


def _cut_contexts(length: int):
    """The bytes of contexts."""

    def over(batches):
        for b in batches:
            doc_id, version = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version"))
            for texts, owner, found in _cut(b, claims=False):
                start, size = found["start"].astype(np.int64), found["size"].astype(np.int64)
                bytes_ = [texts[j][s : s + n] for j, s, n in zip(owner.tolist(), start.tolist(), size.tolist())]
                columns = [pa.array(found["hash"]), pa.array(bytes_, pa.binary()), *(pa.array(found[k].astype(np.int32)) for k in ("start", "size", "anchor")), pa.array(doc_id[owner]), pa.array(version[owner])]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "context", "start", "size", "anchor", "doc_id", "version"])

    return over


def _cut_claims(batches):
    """The claims of each document, joined where they touch, with their bytes; (l_doc, l_version, l_start) is what they claim to repeat."""
    for b in batches:
        doc_id, version = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version"))
        for texts, owner, found in _cut(b, claims=True):
            start = found["start"].astype(np.int64)
            runs = _runs(owner.astype(np.int64), version[owner], start, start + found["size"], found["key"].astype(np.int64), found["l_version"].astype(np.int64), found["anchor"].astype(np.int64))
            who = runs["doc_id"]
            part = [texts[j][s : s + n] for j, s, n in zip(who.tolist(), runs["start"].tolist(), runs["size"].tolist())]
            columns = [pa.array(doc_id[who]), pa.array(version[who]), pa.array(runs["start"].astype(np.int32)), pa.array(part, pa.binary()), pa.array(runs["key"]), pa.array(runs["l_version"]), pa.array(runs["anchor"].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "start", "part", "l_doc", "l_version", "l_start"])


def _strides(parts: list[bytes], length: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Strings of whole symbols that cover each part, from its start on and, for the rest, at its end: (strings, part number, place in it)."""
    strings_, of, at = [], [], []
    for i, part in enumerate(parts):
        whole = len(part) // STEP * STEP
        for place in (0, *([len(part) - length] if whole < len(part) else [])):
            strings_.append(part[:whole] if place == 0 else part[place:])
            of.append(i)
            at.append(place)
    return strings_, np.array(of, np.int64), np.array(at, np.int64)


def stride_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As symbols, for the places at whole steps alone; texts of whole steps, read as rings."""
    words = np.frombuffer(b"".join(texts), ">u4").reshape(-1, STEP // 4).astype(np.uint64)
    code = _dense(words[:, 0])
    for j in range(1, words.shape[1]):
        code = _dense((code.astype(np.uint64) << np.uint64(32)) | words[:, j])
    sizes = np.array([len(t) // STEP for t in texts])
    base, size = np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(sizes, sizes)
    place = np.arange(len(code)) - base
    return np.repeat(np.arange(len(texts)), sizes), place, code, base + (place + 1) % size


def _prove(length: int):
    """Removed intervals of claims: rows with the bytes of a claim (part) and of what it claims to repeat (other).

    The claims of a batch are one shard and what they repeat is another; both transforms are merged, and windows of a claim
    in a repeated interval with an earlier start are removed. So bytes decide, and hashes only chose what is compared.
    """

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        claims, of, at = _strides([r[3] for r in rows], length)
        others, l_of, l_at = _strides([r[7] for r in rows], length)
        ids = np.array([(r[0], r[1], r[2]) for r in rows] + [(r[4], r[5], r[6]) for r in rows], np.int64)
        _, number = np.unique(ids[:, :2], axis=0, return_inverse=True)  # in the order of documents
        order = np.stack([number.ravel()[np.r_[l_of + len(rows), of]], ids[:, 2][np.r_[l_of + len(rows), of]] + np.r_[l_at, at]], 1)
        text, place, code, ahead = stride_symbols([*others, *claims])
        cut = int(np.searchsorted(text, len(others)))
        shards = [Shard(text[i:j], place[i:j], code[i:j], ahead[i:j] - i, length) for i, j in ((0, cut), (cut, len(text)))]
        text, place = later_windows(shards, np.array([len(t) // STEP for t in (*others, *claims)]), order, length, STEP)
        mine = text >= len(others)
        which, begin, end = _intervals(text[mine] - len(others), place[mine] * STEP, length)
        row, start = of[which], at[which]
        columns = [pa.array(ids[row, 0]), pa.array(ids[row, 1]), *(pa.array((ids[row, 2] + start + x).astype(np.int32)) for x in (begin, end))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "start", "end"])

    def over(batches):
        held, n = [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "version", "start", "part", "l_doc", "l_version", "l_start", "other"))):
                if len(row[3]) >= length and len(row[3]) == len(row[7]):
                    held.append(row)
                    n += len(row[3])
                if n >= PROOF_BYTES:
                    yield solve(held)
                    held, n = [], 0
        if held:
            yield solve(held)

    return over


def shared_parts(hashes: list[int], contexts: list[bytes], places: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, end) of the part of each context that holds all windows that another one of the same anchor may have; (0, 0) if none.

    A window has between 0 and length - ANCHOR bytes before the anchor. In each of SPLITS ranges of that
    number, all windows hold a common part around the anchor, so two contexts that share a window share
    such a part.
    """
    side = length - ANCHOR
    step = -(-(side + 1) // SPLITS)
    least, most = [side + 1] * len(contexts), [-1] * len(contexts)
    for before in range(0, side + 1, step):
        last = min(before + step - 1, side)
        after = ANCHOR + side - last
        parts = [(h, c[p - before : p + after]) if p >= before and p + after <= len(c) else None for h, c, p in zip(hashes, contexts, places)]
        times = Counter(parts)
        for i, part in enumerate(parts):
            if part is not None and times[part] > 1:
                least[i], most[i] = min(least[i], before), last
    return [(max(0, p - m), min(len(c), p + length - n)) if m >= 0 else (0, 0) for c, p, n, m in zip(contexts, places, least, most)]


def _resolve(length: int):
    """Removed intervals from distinct contexts sorted by hash."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        contexts = table.column("context").to_pylist()
        parts = shared_parts(table.column("hash").to_pylist(), contexts, table.column("anchor").to_pylist(), length)
        # A part may be shorter than a window where a context ends early.
        kept = [i for i, (a, b) in enumerate(parts) if b - a >= length]
        contexts = [contexts[i][parts[i][0] : parts[i][1]] for i in kept]
        skipped = np.array([parts[i][0] for i in kept], np.int64)
        table = table.take(pa.array(kept, pa.int64()))
        if not table.num_rows:
            return pa.RecordBatch.from_arrays([pa.array([], k) for k in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], names=["doc_id", "version", "start", "end"])
        doc, version, start = (table.column(c).to_numpy() for c in ("doc_id", "version", "start"))
        start = start + skipped
        at = np.lexsort((version, doc))
        number = np.empty(len(at), np.int64)
        number[at] = np.cumsum(np.r_[False, (doc[at][1:] != doc[at][:-1]) | (version[at][1:] != version[at][:-1])])
        text, place = repeated_windows(contexts, np.stack([number, start], 1), length)
        which, begin, end = _intervals(text, place, length)
        columns = [pa.array(doc[which]), pa.array(version[which]), pa.array((start[which] + begin).astype(np.int32)), pa.array((start[which] + end).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "start", "end"])

    def over(batches):
        held, n = [], 0  # whole anchors, but for the last one
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(i, BATCH_ROWS)
                held.append(b)
                n += b.column("context").nbytes
                if n < BATCH_BYTES:
                    continue
                h = b.column("hash").to_numpy()
                cut = int(np.flatnonzero(h != h[-1])[-1] + 1) if h[0] != h[-1] else 0
                if not cut and len(held) > 1 and held[-2].column("hash")[-1].as_py() != h[0]:
                    yield solve(held[:-1])
                elif cut:
                    yield solve([*held[:-1], b.slice(0, cut)])
                else:
                    continue
                held = [b.slice(cut)]
                n = held[0].column("context").nbytes
        if held:
            yield solve(held)

    return over


def _cut_out(b: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for text, found in zip(strings(b.column("text")), b.column("found").to_pylist()):
        data, spans = text.encode(), []
        for f in sorted(found or [], key=lambda f: f["start"]):
            if spans and f["start"] <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], f["end"])
            else:
                spans.append([f["start"], f["end"]])
        kept, at = hashlib.sha256(), 0
        for start, end in spans:
            kept.update(data[at:start])
            at = end
        kept.update(data[at:])
        rows.append((len(data), sum(e - s for s, e in spans), len(spans), kept.hexdigest()))
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([b.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256. ``length`` is a multiple of STEP, over ANCHOR."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    least = F.lit(-(2**63)).cast("long")
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{id_col}`").cast("long"), least).alias("doc_id"), text.alias("text"))
    base = base.withColumn("version", F.xxhash64("text"))
    long = base.where(F.octet_length("text") >= length)
    rows = long.select("doc_id", "version", "text").mapInArrow(_find_contexts(length), ROWS)
    rows = rows.repartition("hash").sortWithinPartitions("hash", "key", "doc_id", "version", "start").mapInArrow(_sort_out, ROWS)
    key = F.when(F.col("claim"), F.col("key")).alias("key")
    marks = rows.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "size", "anchor", "hash", key, "l_version", "claim")).alias("found"))
    # The texts are shuffled by document once: all joins read the same exchange, so all of them use each of its columns and
    # none filters its rows. Repeated rows are one text.
    placed = base.repartition("doc_id", "version")
    single = placed.groupBy("doc_id", "version").agg(F.first("text").alias("text"), F.first("id").alias("id"))
    marked = single.join(marks, ["doc_id", "version"])
    contexts = marked.mapInArrow(_cut_contexts(length), "hash long, context binary, start int, size int, anchor int, doc_id long, version long")
    contexts = contexts.repartition("hash").sortWithinPartitions("hash")
    claims = marked.mapInArrow(_cut_claims, "doc_id long, version long, start int, part binary, l_doc long, l_version long, l_start int")
    leaders = single.select(F.col("doc_id").alias("l_doc"), F.col("version").alias("l_version"), F.encode("text", "UTF-8").alias("l_text"), F.col("id").alias("l_id"))
    other = F.substring(F.col("l_text"), F.col("l_start") + 1, F.octet_length("part"))
    claims = claims.join(leaders, ["l_doc", "l_version"]).select("doc_id", "version", "start", "part", "l_doc", "l_version", "l_start", other.alias("other"), "l_id")
    found = "doc_id long, version long, start int, `end` int"
    removed = contexts.mapInArrow(_resolve(length), found).unionByName(claims.mapInArrow(_prove(length), found))
    per_doc = removed.groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    joined = placed.join(per_doc, ["doc_id", "version"], "left").select("id", "text", "found")

    def cut(batches):
        for b in batches:
            yield _cut_out(b)

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
