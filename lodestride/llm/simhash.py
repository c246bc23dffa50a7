"""SimHash near-duplicates with a generalised pigeonhole index.

Fingerprints are 64-bit votes of word-shingle hashes. Documents with equal fingerprints form one
class first; the search for links of at most ``radius`` differing bits runs over distinct
fingerprints. Their bits are grouped into partitions, correlated bits together (correlations and
value counts come from a bounded sample of fingerprints, ``SAMPLE``, used for planning alone).
With m partitions, thresholds t_i >= -1 with sum radius - m + 1 suffice: a pair within the radius
agrees up to t_i bits in some partition i. Each fingerprint gets its own thresholds, by dynamic
programming over the estimated number of candidates of each partition and threshold, and probes
all partition values within them. Every candidate pair is verified by its true distance.

Rows that share a partition value form a bucket. A bucket of up to ``max_bucket`` fingerprints is
linked in one task; for larger ones the pigeonhole is applied again to the bits outside the
partition, so the group splits until it is small, and no pair within the radius is lost. That guarantee
doesn't hold for pairs that are compared by all lanes: there a larger bucket is dealt into blocks, and each
two blocks are compared in a task of about ``max_bucket`` rows, so no pair of the bucket is lost. Within
a bucket of more than a few members pairs aren't listed: two fingerprints are within two bits just when they share a
neighbour at one bit, so members meet by sorting their one-bit neighbours.
Only a spanning set of the links leaves a task.

Texts of null count as empty; a text without words has fingerprint zero and is linked like any
other. Texts with fewer words than a shingle count as one shingle. Repeated rows stay rows of
their own. Rows with a null id keep a null component id unless their class has another id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import checkpointed, map_batches, strings
from lodestride.llm.components import components

SEED = 42
SAMPLE = 32_768
PARTITIONS = 3
MAX_BUCKET = 50_000
LANES = 8
REACH = 102  # of LANES x 64 bits: three deviations above what a similarity of 0.8 gives
SIMILARITY = 0.8  # Jaccard, of the distinct shingle hashes
BLOCK_BYTES = 32 << 20  # shingle hashes compared in one task


# Fingerprints -------------------------------------------------------------------------------


def shingle_hashes(text: str, words_per_shingle: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of each shingle, in order; none for a text without words."""
    words = text.encode().lower().split()  # bytes: lower-cases A-Z alone, splits at \x20 and \x09-\x0D
    n = words_per_shingle
    shingles = map(b" ".join, zip(*(words[i:] for i in range(n)))) if len(words) > n else [b" ".join(words)] if words else []
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.dtype("<u8"))


def lane_fingerprints(text: str, words_per_shingle: int = 3, lanes: int = 1) -> np.ndarray:
    """64-bit votes of the shingles' hashes, and in further lanes of remixed hashes; a bit needs over half of all shingles."""
    return _votes(shingle_hashes(text, words_per_shingle), lanes)


def _votes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    votes = np.zeros((lanes, 64), np.int64)
    for i in range(0, len(hashes), 65_536):  # bounds the unpacked bits of very long texts
        h = hashes[i : i + 65_536]
        for lane in range(lanes):
            if lane:
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                h ^= h >> np.uint64(32)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            for j in range(0, len(bits), 255):  # sums of bytes
                votes[lane] += bits[j : j + 255].sum(0, dtype=np.uint8)
    return np.packbits(2 * votes > len(hashes), axis=1, bitorder="little").view("<u8")[:, 0]


def fingerprint(text: str, words_per_shingle: int = 3) -> int:
    return int(lane_fingerprints(text, words_per_shingle)[0])


def _set_key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _set_prints(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int, lanes: int) -> DataFrame:
    """(doc_id, fp, wide, key, size) of the distinct shingle hashes: votes of the first and of all lanes, 128-bit hash of the set, its size."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for t in strings(b.column("text")):
            hashes = np.unique(shingle_hashes(t, words_per_shingle))
            lane = _votes(hashes, lanes)
            found.append((lane[:1].view(np.int64)[0], lane.tobytes(), _set_key(hashes), len(hashes)))
        fp, wide, key, size = zip(*found) if found else ((), (), (), ())
        columns = [b.column("doc_id"), pa.array(fp, pa.int64()), pa.array(wide, pa.binary()), pa.array(key, pa.binary()), pa.array(size, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "fp", "wide", "key", "size"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, batch, "doc_id long, fp long, wide binary, key binary, size long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, lanes: int = 1) -> DataFrame:
    """(doc_id, fp, wide): the fingerprint as the signed long with its 64 bits, and those of all lanes as bytes (null for one lane)."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [lane_fingerprints(t, words_per_shingle, lanes) for t in strings(b.column("text"))]
        first = np.array([f[0] for f in found], np.uint64).view(np.int64)
        wide = pa.array([f.tobytes() if lanes > 1 else None for f in found], pa.binary())
        return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(first), wide], names=["doc_id", "fp", "wide"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, batch, "doc_id long, fp long, wide binary")


# Planning -----------------------------------------------------------------------------------


def group_bits(sample: np.ndarray, bits: list[int], m: int) -> list[list[int]]:
    """``bits`` in ``m`` groups of even size, each seeded apart and grown by correlation."""
    size = -(-len(bits) // m)
    x = (sample[:, None] >> np.array(bits, np.uint64)) & np.uint64(1)
    x = x.astype(np.float64) - x.mean(0) if len(sample) else np.zeros((1, len(bits)))
    scale = np.sqrt((x * x).sum(0))
    scale[scale == 0] = 1
    corr = np.abs((x.T @ x) / scale[:, None] / scale)
    left, groups = list(range(len(bits))), []
    while left:
        group = [left.pop(int(np.argmax(corr[np.ix_(left, left)].sum(0))))]
        while left and len(group) < size:
            group.append(left.pop(int(np.argmax(corr[np.ix_(left, group)].sum(1)))))
        groups.append(sorted(bits[i] for i in group))
    return groups


def allocate(costs: np.ndarray, radius: int) -> np.ndarray:
    """Thresholds (rows x m) with least total cost; costs[row, i, t + 1] is that of threshold t.

    Dynamic programming over partitions; thresholds sum to radius - m + 1.
    """
    rows, m, width = costs.shape
    units = radius + 1  # of t_i + 1
    best = np.full((rows, units + 1), np.inf)
    best[:, 0] = 0
    choice = np.zeros((m, rows, units + 1), np.int8)
    for i in range(m):
        new = np.full_like(best, np.inf)
        for u in range(units + 1):
            for t in range(min(u, width - 1) + 1):
                cost = best[:, u - t] + costs[:, i, t]
                better = cost < new[:, u]
                new[better, u] = cost[better]
                choice[i, better, u] = t
        best = new
    out, u = np.zeros((rows, m), np.int8), np.full(rows, units)
    for i in range(m - 1, -1, -1):
        t = choice[i, np.arange(rows), u]
        out[:, i] = t - 1
        u = u - t
    return out


class Plan:
    """Bit partitions and the sampled value counts that the cost estimates use."""

    def __init__(self, sample: np.ndarray, total: int, bits: list[int], m: int, radius: int) -> None:
        self.radius, self.scale = radius, max(1.0, total / max(1, len(sample)))
        self.parts = group_bits(sample, bits, m)
        self.masks = [np.uint64(sum(1 << b for b in p)) for p in self.parts]
        self.known = [np.unique(sample & mask, return_counts=True) for mask in self.masks]

    def _count(self, i: int, values: np.ndarray) -> np.ndarray:
        keys, n = self.known[i]
        if not len(keys):
            return np.zeros(values.shape)
        at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        return np.where(keys[at] == values, n[at], 0) * self.scale

    def ball(self, i: int, values: np.ndarray, t: int) -> np.ndarray:
        """Partition values within exactly ``t`` bits of each value: rows x count."""
        flips = [np.uint64(0)]
        for _ in range(t):
            flips = sorted({f | (np.uint64(1) << np.uint64(b)) for f in flips for b in self.parts[i] if not int(f) >> b & 1})
        return (values & self.masks[i])[:, None] ^ np.array(flips, np.uint64)[None, :]

    def thresholds(self, fps: np.ndarray) -> np.ndarray:
        """Of each fingerprint and partition: estimated candidates plus the rows of the probes."""
        costs = np.zeros((len(fps), len(self.parts), self.radius + 2))
        for i in range(len(self.parts)):
            total = np.zeros(len(fps))
            for t in range(self.radius + 1):
                if t < 2:
                    around = self.ball(i, fps, t)
                    total = total + self._count(i, around).sum(1) + around.shape[1]
                else:  # not counted value by value: as the last shell, times its growth
                    total = total + (costs[:, i, t] - costs[:, i, t - 1]) * len(self.parts[i]) / t
                costs[:, i, t + 1] = total
        return allocate(costs, self.radius)

    def probes(self, fps: np.ndarray, index_only: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(partition, row numbers, partition values): the index entry of every fingerprint and its probes."""
        t = np.zeros((len(fps), len(self.parts)), np.int8) if index_only else self.thresholds(fps)
        for i, mask in enumerate(self.masks):
            yield i, np.arange(len(fps)), fps & mask
            for d in range(1, self.radius + 1):
                rows = np.flatnonzero(t[:, i] >= d)
                if len(rows):
                    around = self.ball(i, fps[rows], d)
                    yield i, np.repeat(rows, around.shape[1]), around.ravel()


# Linking ------------------------------------------------------------------------------------


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each one's component in the graph (a, b) over 0..n-1."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        root = new
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits, row by row, of fingerprints or of rows of lanes."""
    bits = np.bitwise_count(a ^ b)
    return bits if bits.ndim == 1 else bits.sum(-1, dtype=np.int32)


def _spread(fps: np.ndarray, radius: int) -> np.ndarray:
    """As link_bucket, by spreading from one row after another to rows not reached yet: a tight group takes few steps."""
    root, left = np.arange(len(fps)), np.arange(len(fps))
    while len(left):
        first, todo, left = left[0], [left[:1]], left[1:]
        while todo and len(left):
            rows = todo.pop()
            for row in rows:
                near = _distance(fps[left], fps[row]) <= radius
                if near.any():
                    todo.append(left[near])
                    root[left[near]] = first
                    left = left[~near]
                if not len(left):
                    break
    return root


def link_bucket(fps: np.ndarray, radius: int) -> np.ndarray:
    """Component (as the row number of its first member) of the graph of pairs within ``radius``."""
    n = len(fps)
    if n > 64 and (radius != 2 or fps.ndim > 1):
        return _spread(fps, radius)
    if n <= 64:
        left, right = [], []
        for k in range(1, n):
            near = np.flatnonzero(_distance(fps[k:], fps[:-k]) <= radius)
            left.append(near)
            right.append(near + k)
        return _roots(n, np.concatenate(left), np.concatenate(right)) if left else np.arange(n)
    flips = np.concatenate([[np.uint64(0)], np.uint64(1) << np.arange(64, dtype=np.uint64)])
    around = (fps[:, None] ^ flips[None, :]).ravel()
    order = np.argsort(around, kind="stable")
    same = np.flatnonzero(around[order[1:]] == around[order[:-1]])
    return _roots(n, order[same] // 65, order[same + 1] // 65)


def _link_sorted(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) between class ids from rows sorted by bucket (part, value).

    The distance is that of ``fp``, a long or the bytes of all lanes.
    """

    def bits(column: pa.Array) -> np.ndarray:
        if not pa.types.is_binary(column.type):
            return column.to_numpy(zero_copy_only=False).view(np.uint64)
        return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), -1)

    def groups(part: np.ndarray, value: np.ndarray, fp: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1])])
        sizes = np.diff(np.r_[starts, len(part)])
        a, b = [], []
        small = np.repeat(sizes <= 64, sizes)
        number = np.repeat(np.arange(len(starts)), sizes)
        for k in range(1, min(64, int(sizes.max()))):
            near = np.flatnonzero((number[k:] == number[:-k]) & small[k:])
            near = near[_distance(fp[near + k], fp[near]) <= radius]
            a.append(near)
            b.append(near + k)
        # Of the pairs, a spanning set of each group goes on.
        if a and sum(map(len, a)):
            root = _roots(len(fp), np.concatenate(a), np.concatenate(b))
            moved = np.flatnonzero(root != np.arange(len(root)))
            a, b = [node[root[moved]]], [node[moved]]
        else:
            a, b = [], []
        for g in np.flatnonzero(sizes > 64):
            rows = slice(starts[g], starts[g] + sizes[g])
            root = link_bucket(fp[rows], radius)
            moved = np.flatnonzero(root != np.arange(len(root)))
            a.append(node[rows][root[moved]])
            b.append(node[rows][moved])
        empty = np.empty(0, np.int64)
        a, b = np.concatenate([empty, *a]), np.concatenate([empty, *b])
        pairs = np.unique(np.stack([a, b], 1)[a != b], axis=0)  # classes may have a node in common
        a, b = pairs[:, 0], pairs[:, 1]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part, value, node = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("part", "value", "node"))
        columns = (part, value, bits(batch.column("fp")), node)
        last = (columns[0][-1], columns[1][-1])
        if held and (held[0][0][0], held[0][1][0]) == last:
            held.append(columns)
            continue
        columns = tuple(map(np.concatenate, zip(*held, columns))) if held else columns
        cut = int(np.flatnonzero((columns[0] != last[0]) | (columns[1] != last[1]))[-1] + 1) if (columns[0][0], columns[1][0]) != last else 0
        if cut:
            yield groups(*(c[:cut] for c in columns))
        held = [tuple(c[cut:] for c in columns)]
    if held:
        yield groups(*map(np.concatenate, zip(*held)))


def _entries(rows: DataFrame, plan: Plan, index_only: bool) -> DataFrame:
    """(part, i, value, fp, node, wide) rows of every index entry and probe; ``part`` is of the bucket above and partition i."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, fp, node = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("bucket", "fp", "node"))
            for i, at, value in plan.probes(fp.view(np.uint64), index_only):
                part = bucket[at] * np.int64(31) + np.int64(i)
                columns = [part, np.full(len(at), i, np.int32), value.view(np.int64), fp[at], node[at]]
                wide = batch.column("wide").take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), wide], names=["part", "i", "value", "fp", "node", "wide"])

    return rows.mapInArrow(over, "part long, i int, value long, fp long, node long, wide binary")


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    picked = rows.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(n).toPandas()
    return picked["fp"].to_numpy(np.int64).view(np.uint64)


def links(classes: DataFrame, radius: int = 2, m: int = PARTITIONS, sample: int = SAMPLE, max_bucket: int = MAX_BUCKET, index_only: bool = False, reach: int | None = None) -> DataFrame:
    """Edges (a, b) that connect all (fp, node) rows within ``radius`` bits of each other.

    ``index_only``: only the pairs that agree in a whole partition. With ``reach``, classes have columns
    lane and wide too: candidates are found in each lane, and linked if all lanes differ in ``reach`` bits or fewer.
    """
    compared = F.col("fp" if reach is None else "wide").alias("fp")

    def level(rows: DataFrame, bits: list[int]) -> DataFrame:
        plan = Plan(_sample(rows, sample), rows.count(), bits, m, radius)
        entries = _entries(rows, plan, index_only)
        deeper = []
        # Distinct fingerprints that may differ in few bits are few, so the last level needs no split.
        if len(bits) >= 16:
            sizes = entries.groupBy("part", "value", "i").agg(F.count(F.lit(1)).alias("n"))
            large = checkpointed(sizes.where(F.col("n") > max_bucket))
            parts = [r.i for r in large.select("i").distinct().collect()]  # at most m
            members = entries.join(large.drop("n", "i"), ["part", "value"])
            for i in parts if reach is None else []:
                inside = members.where(F.col("i") == i).select(F.xxhash64("part", "value").alias("bucket"), "fp", "node", "wide").distinct()
                # Members agree (nearly) on the bits of partition i; the others split them.
                deeper.append(level(checkpointed(inside), [b for b in bits if b not in plan.parts[i]]))
            if parts:
                entries = entries.join(large.select("part", "value"), ["part", "value"], "left_anti")
            if parts and reach is not None:  # other bits of the lane would lose pairs: each two blocks are compared
                dealt = _block_pairs(members.join(large.drop("i"), ["part", "value"]), F.ceil(2 * F.col("n") / max_bucket).cast("int"), "wide")
                dealt = dealt.withColumn("part", -1 - F.col("part")).withColumn("value", F.xxhash64("value", "low", "high"))
                entries = entries.unionByName(dealt.select(entries.columns))
        sorted_entries = entries.select("part", "value", compared, "node").repartition("part", "value").sortWithinPartitions("part", "value", "node")
        found = sorted_entries.mapInArrow(lambda batches: _link_sorted(batches, radius if reach is None else reach), "a long, b long")
        for more in deeper:
            found = found.union(more)
        return found

    if reach is None:
        classes = classes.withColumn("lane", F.lit(0)).withColumn("wide", F.lit(None).cast("binary"))
    return level(classes.select(F.col("lane").cast("long").alias("bucket"), "fp", "node", "wide"), list(range(64)))


def _by_lane(classes: DataFrame, first: int, last: int) -> DataFrame:
    """(lane, fp, node, wide) of lanes ``first`` to ``last`` - 1."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(b.column("wide").to_pylist()), "<i8").reshape(b.num_rows, -1)[:, first:last]
        at = pa.array(np.repeat(np.arange(b.num_rows), last - first))
        lane = np.tile(np.arange(first, last), b.num_rows)
        return pa.RecordBatch.from_arrays([pa.array(lane), pa.array(rows.ravel()), b.column("node").take(at), b.column("wide").take(at)], names=["lane", "fp", "node", "wide"])

    return map_batches(classes.where("node is not null").select("node", "wide"), batch, "lane long, fp long, node long, wide binary")


def link_sets(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Component (as the row number of its first member) of the graph of sets with a Jaccard similarity of ``similarity`` or more.

    Overlaps come from lists of the sets of each element; one set after another spreads to those not reached yet.
    """
    sizes = np.array([len(x) for x in sets])
    elements, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(at, kind="stable")]
    ends = np.cumsum(np.bincount(at, minlength=len(elements)))
    starts, rows = np.r_[0, ends[:-1]], np.split(at, np.cumsum(sizes)[:-1])
    root, left = np.arange(len(sets)), np.ones(len(sets), bool)
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first], todo = False, [first]
        while todo and left.any():
            row = todo.pop()
            length = ends[rows[row]] - starts[rows[row]]
            places = np.repeat(starts[rows[row]] - (np.cumsum(length) - length), length) + np.arange(length.sum())
            common = np.bincount(owner[places], minlength=len(sets))
            near = np.flatnonzero(left & (common >= similarity * (sizes + sizes[row] - common) - 1e-9))
            root[near], left[near] = first, False
            todo.extend(near)
    return root


def _similar(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str, words_per_shingle: int, similarity: float, block_bytes: int) -> DataFrame:
    """Edges (a, b) that connect all members (key, node, group, size) of a group whose sets are similar, by their true Jaccard.

    A group of more than ``block_bytes`` of hashes is dealt into blocks, and each two blocks are compared in a task.
    """

    def hashed(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(shingle_hashes(t, words_per_shingle)) for t in strings(b.column("text"))]
        same = [i for i, (x, key) in enumerate(zip(found, b.column("key").to_pylist())) if _set_key(x) == key]
        hashes = pa.array([found[i].tobytes() for i in same], pa.binary())
        picked = [b.column(n).take(pa.array(same, pa.int64())) for n in ("group", "blocks", "node")]
        return pa.RecordBatch.from_arrays([*picked, hashes], names=["group", "blocks", "node", "hashes"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            node, root = np.array(nodes), link_sets(sets, similarity)
            moved = np.flatnonzero(node[root] != node)
            return pa.RecordBatch.from_arrays([pa.array(node[root[moved]]), pa.array(node[moved])], names=["a", "b"])

        now, nodes, sets = None, [], []
        for batch in batches:
            for *group, node, hashes in zip(*(batch.column(n).to_pylist() for n in ("group", "low", "high", "node", "hashes"))):
                if group != now:
                    if len(nodes) > 1:
                        yield edges(nodes, sets)
                    now, nodes, sets = group, [], []
                nodes.append(node)
                sets.append(np.frombuffer(hashes, "<u8"))
        if len(nodes) > 1:
            yield edges(nodes, sets)

    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n"), (F.sum("size") * 8).alias("bytes")).where("n > 1")
    blocks = F.when(F.col("bytes") > block_bytes, F.ceil(2 * F.col("bytes") / block_bytes)).otherwise(1).cast("int").alias("blocks")
    members = groups.join(sizes.select("group", blocks), "group").select("key", "node", "group", "blocks")
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text")).join(members, "node")
    rows = map_batches(texts, hashed, "group long, blocks int, node long, hashes binary")
    dealt = _block_pairs(rows, F.col("blocks"), "node")
    ordered = dealt.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "node")
    return ordered.select("group", "low", "high", "node", "hashes").mapInArrow(linked, "a long, b long")


def _block_pairs(rows: DataFrame, blocks: Column, by: str) -> DataFrame:
    """Each row once for every pair of blocks (low, high) with its own (by a hash of ``by``); (0, 0) where there is one block."""
    own = F.pmod(F.xxhash64(by), blocks).cast("int")
    other = F.when(blocks > 1, F.array_except(F.sequence(F.lit(0), blocks - 1), F.array(F.col("__own")))).otherwise(F.array(F.lit(0)))
    pairs = rows.withColumn("__own", own).withColumn("__other", F.explode(other))
    return pairs.withColumn("low", F.least("__own", "__other")).withColumn("high", F.greatest("__own", "__other")).drop("__own", "__other")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 5, lanes: int = LANES, reach: int = REACH, m: int = 5, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As near_duplicates, for a wide radius: links at a Jaccard similarity of at least ``similarity`` of the distinct shingle hashes.

    Of 8 lanes (512 bits), texts with a similarity of 0.8 differ in about 78 bits, too many for a pigeonhole
    index that must lose no pair. Instead each lane has its own index with radius m - 1 (a guarantee for pairs that
    close in any lane), whose 5 x 8 partitions of 12 or 13 bits find a pair with similarity 0.8 with a probability of
    0.995; ``reach`` lets 0.998 of these pass. These candidates form groups; within a group all members with the true
    similarity are linked, candidates or not. Null, empty and repeated rows count as in near_duplicates.
    """
    prints = checkpointed(_set_prints(docs, id_col, text_col, words_per_shingle, lanes))
    sets = checkpointed(prints.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("wide").alias("wide"), F.first("size").alias("size")))
    classes = sets.groupBy("wide").agg(F.min("node").alias("node"))
    classes = checkpointed(classes)
    for first, last in ((0, 1), (1, lanes)):  # what the first lane joins gives few edges in the others
        joined = components(links(_by_lane(classes, first, last), m - 1, m, index_only=True, reach=reach))
        classes = checkpointed(classes.join(joined, "node", "left").select("wide", F.coalesce("component", "node").alias("node")))
    groups = sets.where("node is not null").select("key", "node", "size", "wide").join(classes.select("wide", F.col("node").alias("group")), "wide")
    joined = components(_similar(docs, checkpointed(groups.drop("wide")), id_col, text_col, words_per_shingle, similarity, block_bytes))
    named = sets.join(joined, "node", "left").select("key", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "key").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3, radius: int = 2, **options) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, words_per_shingle))
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = checkpointed(classes)
    known = classes.where("node is not null")
    m = options.get("m", PARTITIONS)
    if radius >= m:
        # Probes multiply the rows of each class. Classes that agree in a whole partition are joined
        # first, so that probes link what is still apart and a large group gives few edges.
        near = components(links(known, radius, index_only=True, **options))
        classes = checkpointed(classes.join(near, "node", "left").select("fp", F.coalesce("component", "node").alias("node")))
        known = classes.where("node is not null")
    joined = components(links(known, radius, **options))
    named = classes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group of near copies (rows without an id stay).

    ``options`` are those of near_copies.
    """
    kept = near_copies(docs, id_col, text_col, **options).where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # in a struct no column of ``docs`` has the name of another
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.struct(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]).alias("row"))
    stays = rows.join(kept, F.col("id") == F.col("kept"), "left_semi").unionByName(rows.where(F.col("id").isNull()))
    return stays.select(*[F.col(f"row.{n}").alias(c) for c, n in names.items()])
