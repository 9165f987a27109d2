"""Near-duplicate documents by order min-hash.

A text is a sequence of k-mers of five words, each labelled with how often it occurred
before. A sketch has, for each of several hash functions, the few k-mers with the least
hashes, in the order of the text. Two texts share an entry only if these k-mers are the
same and in the same order, which edits and moved passages make less likely: with a
similarity of 0.8, an entry of six agrees with a probability of about 0.26, and one of 32
entries does in all but one of 10,000 cases.

Texts that share an entry are candidates. Their k-mer sequences are aligned in a band as
wide as the threshold allows; a pair is a link if the matched k-mers are at least 0.8 of
all k-mers of both, matched ones counted once.

Equal texts are one node from the start. Among the nodes that share an entry, one is the
hub with which the others are compared; the hub is the one with the most candidates,
which in a group of edited copies is the text they were made from. Those that don't match
it choose a new hub among themselves, until hubs match few or ``rounds`` have passed. Most
entries are of one component then; of the others all pairs of nodes in different components
are compared that weren't, if their sizes allow for 0.8. Where an entry has many nodes, these
pairs are found by the rarest k-mers of its texts: two that match in 0.8 of all share one of the
rarest fifth, and have enough k-mers behind it. Where that are many texts, k-mers are counted
in cells first, so that only the rarest fifth is listed. So a group of copies isn't paired with
itself, nor are texts that share a passage and little else, and no link between texts that share an
entry is lost. Classes are the connected components of the links.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import WORDS, fresh, text_or_empty, written

K = 5
ENTRIES = 32
LENGTH = 6
THRESHOLD = 0.8
ROUNDS = 6
#: Another round follows if more than one of so many of a round's pairs are alike.
WORTH = 10
#: Nodes of an entry of several components up to which all its pairs are compared.
FEW = 16
#: K-mers of larger entries up to which all are listed; more are counted in cells first.
LISTED = 100_000
#: Links in a file of those that are written again and again.
LINKS = 20_000
#: Cells are counted in blocks of 2 ** BLOCK_BITS; there are at most 2 ** MOST_BITS, a byte each.
BLOCK_BITS, MOST_BITS = 16, 24

# Multipliers and shifts of a well-known 64-bit mixing function.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    """n odd numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)
    return _mix(steps * _GOLDEN) | np.uint64(1)


_POSITIONS = _constants(K, 1)
_FUNCTIONS = _constants(4096, 2)
_ORDER = _constants(64, 3)


class Hasher:
    """K-mers of texts; remembers words' hashes."""

    def __init__(self, remembered: int = 100_000):
        import xxhash

        self.hash = xxhash.xxh3_64_intdigest
        self.known: dict[str, int] = {}
        self.remembered = remembered

    def kmers(self, text: str) -> np.ndarray:
        """Hashes of the runs of K words; of fewer words, one of them all."""
        words = WORDS.findall(text)
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = self.hash(word.encode("utf-8", "surrogatepass"))
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - K + 1)
        total = np.zeros(n, np.uint64)
        for i, factor in enumerate(_POSITIONS[: len(words)]):
            total += hashes[i : i + n] * factor
        return _mix(total + np.uint64(min(len(words), K)))


def labelled(kmers: np.ndarray) -> np.ndarray:
    """K-mers that differ if they are equal: by how often one occurred before."""
    order = np.argsort(kmers, kind="stable")
    same = kmers[order][1:] == kmers[order][:-1]
    if not same.any():
        return kmers
    starts = np.concatenate(([0], np.flatnonzero(~same) + 1))
    sizes = np.diff(np.concatenate((starts, [len(kmers)])))
    occurrence = np.empty(len(kmers), np.uint64)
    occurrence[order] = np.arange(len(kmers)) - np.repeat(starts, sizes)
    return np.where(occurrence > 0, _mix(kmers + occurrence * _GOLDEN), kmers)


def lengths_of(n: int, length: int, threshold: float) -> list[int]:
    """Numbers of k-mers in an entry for a text of n k-mers.

    Short texts have shorter entries, else those that differ in one k-mer would share
    none; texts of similar length have one number in common.
    """
    shorten = lambda m: int(min(max(m // 3, 1), length))
    low, high = int(np.ceil(n * threshold)), int(n / threshold)
    return list(range(shorten(low), shorten(high) + 1))


def sketch(
    kmers: np.ndarray,
    entries: int = ENTRIES,
    length: int = LENGTH,
    threshold: float = THRESHOLD,
) -> np.ndarray:
    """Entries of a text as 64-bit keys; none without k-mers."""
    n = len(kmers)
    if not n:
        return np.zeros(0, np.int64)
    units = labelled(kmers)
    sizes = lengths_of(n, length, threshold)
    keys = []
    step = max(1, 2_000_000 // n)
    for first in range(0, entries, step):
        factors = _FUNCTIONS[first : min(first + step, entries)]
        values = (units[None, :] ^ (factors[:, None] >> np.uint64(7))) * factors[:, None]
        values ^= values >> np.uint64(29)
        most = min(max(sizes), n)
        if most < n:
            least = np.argpartition(values, most - 1, axis=1)[:, :most]
        else:
            least = np.broadcast_to(np.arange(n), (len(factors), n))
        ranks = np.argsort(np.take_along_axis(values, least, 1), axis=1, kind="stable")
        least = np.take_along_axis(least, ranks, 1)
        for size in sizes:
            chosen = np.sort(least[:, : min(size, n)], axis=1)  # the text's order
            total = factors + np.uint64(size)
            for i in range(chosen.shape[1]):
                total = total + units[chosen[:, i]] * _ORDER[i]
            keys.append(_mix(total))
    return np.concatenate(keys).view(np.int64)


def banded_matches(a: list[int], b: list[int], width: int) -> int:
    """Matches of the best alignment of a and b that strays at most ``width``.

    Bit-parallel: a bit for each place of b, a step for each element of a.
    """
    places: dict[int, list[int]] = {}
    for j, value in enumerate(b):
        places.setdefault(value, []).append(j)
    full = (1 << len(b)) - 1
    row = full
    for i, value in enumerate(a):
        at = places.get(value)
        if at is None:
            continue
        matches = 0
        for j in at:
            if abs(i - j) <= width:
                matches |= 1 << j
        if matches:
            taken = row & matches
            row = ((row + taken) | (row - taken)) & full
    return len(b) - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Matched k-mers over all, or 0 if that is below the threshold for sure."""
    total = len(a) + len(b)
    if not total or min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    need = threshold * total / (1 + threshold)
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    differ = np.flatnonzero(a[head:][::-1][: n - head] != b[head:][::-1][: n - head])
    tail = int(differ[0]) if len(differ) else n - head
    inner_a = a[head : len(a) - tail].tolist()
    inner_b = b[head : len(b) - tail].tolist()
    common = head + tail
    if common < need:
        if common + (Counter(inner_a) & Counter(inner_b)).total() < need - 1e-9:
            return 0.0
        common += banded_matches(inner_a, inner_b, int(total - 2 * need) + 1)
    else:
        common += banded_matches(inner_a, inner_b, total)
    found = common / (total - common)
    return found if found >= threshold - 1e-12 else 0.0


def node_of(text: str) -> int:
    """64 bits of a text's digest."""
    digest = hashlib.md5(text.encode("utf-8", "surrogatepass"), usedforsecurity=False)
    return int.from_bytes(digest.digest()[:8], "big", signed=True)


def sketches(documents: DataFrame, entries: int, length: int, threshold: float) -> DataFrame:
    """doc_id, node, size and keys of every row; keys only for a text's first row in a task.

    ``size`` is the number of k-mers.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, keys = [], [], []
            for text in batch.column(1).to_pylist():
                node = node_of(text or "")
                nodes.append(node)
                if node in seen:
                    sizes.append(None)
                    keys.append(None)
                    continue
                if len(seen) < 300_000:
                    seen.add(node)
                kmers = hasher.kmers(text or "")
                sizes.append(len(kmers))
                keys.append(sketch(kmers, entries, length, threshold))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "node", "size", "keys"],
            )

    schema = "doc_id bigint, node bigint, size bigint, keys array<bigint>"
    return documents.select("doc_id", "text").mapInArrow(over, schema)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(hub, node, alike) of pairs of nodes."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def kmers(node: int, text: str) -> np.ndarray:
            if node not in recent:
                recent[node] = hasher.kmers(text)
                if len(recent) > 256:
                    recent.popitem(last=False)
            return recent[node]

        for batch in batches:
            hubs, nodes = batch.column(0), batch.column(1)
            rows = zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True)
            alike = [
                similarity(kmers(h, s), kmers(n, t), threshold) > 0 for h, n, s, t in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [hubs, nodes, pa.array(alike, pa.bool_())], names=["hub", "node", "alike"]
            )

    hub_texts = texts.select(F.col("node").alias("hub"), F.col("text").alias("hub_text"))
    joined = pairs.join(hub_texts, "hub").join(texts, "node")
    return joined.select("hub", "node", "hub_text", "text").mapInArrow(
        over, "hub bigint, node bigint, alike boolean"
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of undirected edges (u, v); the least node names it.

    Alternates two steps, each of which links a node's neighbours to the least of them,
    until nothing changes: the larger neighbours, then the smaller.
    """

    def least(both: DataFrame) -> DataFrame:
        found = both.groupBy("u").agg(F.min("v").alias("m"))
        return found.withColumn("m", F.least("u", "m"))

    def large(pairs: DataFrame) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        linked = both.join(least(both), "u").where("v > u")
        return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(pairs: DataFrame) -> DataFrame:
        down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        linked = down.join(least(down), "u")
        moved = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = linked.select("u", F.col("m").alias("v"))
        return moved.unionByName(own).distinct()

    def mark(pairs: DataFrame):
        sums = [F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count(F.lit(1))]
        return pairs.agg(*sums).first()

    pairs = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    before = mark(pairs)
    while True:
        # each file costs an executor some processes, and links are few: there are never more
        pairs = written(small(large(pairs)).coalesce(1 + before[1] // LINKS), "edges")
        now = mark(pairs)
        if now == before:
            break
        before = now
    own = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def links(found: DataFrame, documents: DataFrame, threshold: float, rounds: int) -> DataFrame:
    """(u, v) of nodes whose texts are alike; a size that isn't known allows for any other."""
    if "size" not in found.columns:
        found = found.withColumn("size", F.lit(None).cast("bigint"))
    entries = found.where("keys IS NOT NULL")
    entries = entries.select("node", "size", F.explode("keys").alias("key"))
    shared = (
        entries.groupBy("key")
        .agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("n"))
        .where("a <> b")
        .select("key", "n")
    )
    active = written(entries.join(shared, "key").distinct(), "candidates")
    degrees = active.groupBy("node").agg(F.sum("n").alias("degree"))
    texts = documents.select(text_or_empty().alias("text"))
    bits = F.conv(F.substring(F.md5(F.encode("text", "UTF-8")), 1, 16), 16, -10)
    texts = texts.select(bits.cast("bigint").alias("node"), "text")
    texts = texts.join(degrees, "node").dropDuplicates(["node"]).select("node", "text")
    texts = written(texts, "texts")
    left = written(active.join(degrees, "node").select("key", "node", "degree"), "round")
    low, high = F.least("hub", "node").alias("low"), F.greatest("hub", "node").alias("high")
    results = []
    for _ in range(rounds):
        hubs = left.groupBy("key").agg(
            F.max(F.struct("degree", "node"))["node"].alias("hub"), F.count("*").alias("n")
        )
        compared = left.join(hubs.where("n > 1").drop("n"), "key").where("node <> hub")
        compared = compared.select("key", "node", "degree", low, high)
        pairs = compared.select("low", "high").distinct()
        if results:
            pairs = pairs.join(_all(results), ["low", "high"], "left_anti")
        pairs = pairs.toDF("hub", "node")
        found = verified(pairs, texts, threshold).select(low, high, "alike")
        results.append(written(found, "verified"))
        n, matched = results[-1].agg(F.count(F.lit(1)), F.count_if("alike")).first()
        if matched * WORTH <= n:
            break  # the pairs that are open are found and compared below
        alike = _all(results).where("alike").select("low", "high")
        left = compared.join(alike, ["low", "high"], "left_anti")
        left = written(left.select("key", "node", "degree"), "round")
    alike = _all(results).where("alike")
    parts = components(alike.select(F.col("low").alias("u"), F.col("high").alias("v")))
    pairs = written(_open_pairs(active, parts, texts, threshold), "open")
    pairs = pairs.join(_all(results), ["low", "high"], "left_anti").toDF("hub", "node")
    found = verified(pairs, texts, threshold).select(low, high, "alike")
    results.append(written(found, "verified"))
    return _all(results).where("alike").select(F.col("low").alias("u"), F.col("high").alias("v"))


def _open_pairs(
    active: DataFrame, parts: DataFrame, texts: DataFrame, threshold: float
) -> DataFrame:
    """(low, high): nodes of different components that share an entry and may be alike.

    Their sizes have to be near enough. In entries of more than ``FEW`` nodes, only those that
    share one of their rarest k-mers, at places that leave enough k-mers behind.
    """
    nodes = active.select("key", "node", "size").join(parts, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    mixed = nodes.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n")
    )
    mixed = mixed.where("a <> b").select("key", (F.col("n") <= FEW).alias("few"))
    nodes = written(nodes.join(mixed, "key"), "mixed")
    large = nodes.where("NOT few").select("node", "component", "size").distinct()
    n_kmers = large.agg(F.sum("size")).first()[0] or 0
    large = large.select("node", "component")
    cells = _cells(large, texts, n_kmers) if n_kmers > LISTED else None
    rare = written(_rare_kmers(large, texts, threshold, cells), "rare")
    few = nodes.where("few").select("key", "node", "component", "size")
    return _across_few(few, threshold).unionByName(_across(rare, threshold)).distinct()


def _with_texts(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    # by node, or the tasks that read the texts would have very different numbers of them
    return nodes.join(texts, "node").select("node", "component", "text").repartition("node")


def _cells(nodes: DataFrame, texts: DataFrame, n_kmers: int) -> np.ndarray:
    """How rare k-mers are, a byte for each cell that their first bits name.

    0 if all k-mers of the cell are of one component, else ten times the binary logarithm
    of their number. Tasks add up what they read, blocks of cells are then added up by
    themselves. About four cells for each k-mer, until there are 2 ** ``MOST_BITS``; k-mers
    that meet in a cell only seem more frequent than they are.
    """
    bits = min(max((4 * n_kmers).bit_length(), BLOCK_BITS), MOST_BITS)
    blocks = np.arange(1 << (bits - BLOCK_BITS), dtype=np.int64)

    def added(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        cells, components = map(np.concatenate, zip(*found, strict=True))
        order = np.argsort(cells, kind="stable")
        cells, components = cells[order], components[order]
        starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        n = np.diff(np.concatenate((starts, [len(cells)])))
        cells = cells[starts]
        columns = [
            cells & ((1 << BLOCK_BITS) - 1),
            n,
            np.minimum.reduceat(components, starts),
            np.maximum.reduceat(components, starts),
        ]
        held = np.unique(cells >> BLOCK_BITS)
        offsets = np.append(np.searchsorted(cells, held << BLOCK_BITS), len(cells))
        offsets = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c, pa.int64())) for c in columns]
        return pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int64()), *lists], names=["block", "cells", "n", "low", "high"]
        )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        found, n = [], 0
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            for component, text in rows:
                cells = labelled(hasher.kmers(text)) >> np.uint64(64 - bits)
                if len(cells):
                    same = np.full(len(cells), component, np.int64)
                    found.append((cells.astype(np.int64), same))
                    n += len(cells)
                if n >= 250_000:
                    yield added(found)
                    found, n = [], 0
        if found:
            yield added(found)

    def block(rows: pa.Table) -> pa.Table:
        cells, n, low, high = (
            np.concatenate([c.flatten().to_numpy() for c in rows.column(name).chunks])
            for name in ("cells", "n", "low", "high")
        )
        size = 1 << BLOCK_BITS
        total = np.bincount(cells, weights=n, minlength=size)
        least = np.full(size, np.iinfo(np.int64).max)
        most = np.full(size, np.iinfo(np.int64).min)
        np.minimum.at(least, cells, low)
        np.maximum.at(most, cells, high)
        several = least < most
        how_rare = np.zeros(size, np.uint8)
        how_rare[several] = np.minimum(10 * np.log2(total[several]), 255).astype(np.uint8)
        return pa.table({"block": rows.column("block")[:1], "how_rare": [how_rare.tobytes()]})

    lists = ", ".join(f"{name} array<bigint>" for name in ("cells", "n", "low", "high"))
    parts = _with_texts(nodes, texts).mapInArrow(over, f"block bigint, {lists}")
    found = parts.groupBy("block").applyInArrow(block, "block bigint, how_rare binary")
    table = np.zeros((len(blocks), 1 << BLOCK_BITS), np.uint8)
    for at, how_rare in found.collect():  # 16 MB at most
        table[at] = np.frombuffer(how_rare, np.uint8)
    return table.reshape(-1)


def _rare_kmers(
    nodes: DataFrame, texts: DataFrame, threshold: float, cells: np.ndarray | None = None
) -> DataFrame:
    """(key, node, component, size, rest): the rarest k-mers of each text that others have.

    Texts are alike if so many k-mers match that at most n - ceil(threshold * n) of one's
    n don't; so of the n - ceil(threshold * n) + 1 that come first in any one order of all
    k-mers, both have at least one in common. Those of a single component come first here, then
    rare ones. ``rest`` is the number of the text's k-mers from this one on in that order.
    If ``cells`` tell how rare k-mers are, the order is theirs and only the first are listed.
    """
    known = None if cells is None else nodes.sparkSession.sparkContext.broadcast(cells)
    bits = 0 if cells is None else len(cells).bit_length() - 1

    def listed(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """K-mers that may be among the first and, if that is known, ``rest``."""
        if known is None:
            return kmers.view(np.int64), None
        n = len(kmers)
        how_rare = known.value[(kmers >> np.uint64(64 - bits)).astype(np.int64)]
        first = n - math.ceil(n * threshold - 1e-9) + 1
        order = np.lexsort((kmers.view(np.int64), how_rare))[:first]
        places = np.flatnonzero(how_rare[order])  # those of one component join nothing
        return kmers[order[places]].view(np.int64), n - places

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
            for node, component, text in rows:
                kmers = labelled(hasher.kmers(text))
                n = len(kmers)
                kmers, rest = listed(kmers)
                for at in range(0, len(kmers), 100_000):
                    part = kmers[at : at + 100_000]
                    same = [np.full(len(part), x, np.int64) for x in (node, component, n)]
                    behind = [None] * len(part) if rest is None else rest[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(x) for x in (part, *same)], pa.array(behind, pa.int64())],
                        names=["key", "node", "component", "size", "rest"],
                    )

    schema = "key bigint, node bigint, component bigint, size bigint, rest bigint"
    kmers = written(_with_texts(nodes, texts).mapInArrow(over, schema), "kmers")
    counts = kmers.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b")
    )
    counts = counts.where("a <> b").select("key", "n")
    ranked = kmers.join(counts, "key")
    if known is not None:
        known.unpersist()
        return ranked.select("key", "node", "component", "size", "rest")
    # k-mers of one component only join nothing: they come first, and only their number matters
    own = Window.partitionBy("node")
    before = F.col("size") - F.count("*").over(own)
    place = before + F.row_number().over(own.orderBy("n", "key"))
    ranked = ranked.withColumn("place", place)
    first = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    ranked = ranked.where(F.col("place") <= first)
    rest = (F.col("size") - F.col("place") + 1).alias("rest")
    return ranked.select("key", "node", "component", "size", rest)


def _across_few(grouped: DataFrame, threshold: float) -> DataFrame:
    """(low, high) of nodes with equal keys, of which each has few, and different components."""
    other = grouped.select(
        "key", F.col("node").alias("high"), F.col("component").alias("b"), F.col("size").alias("m")
    )
    near = F.least("size", "m") >= threshold * F.greatest("size", "m") - 1e-9
    pairs = grouped.withColumnRenamed("node", "low").join(other, "key")
    pairs = pairs.where((F.col("low") < F.col("high")) & (F.col("component") != F.col("b")))
    pairs = pairs.where(F.coalesce(near, F.lit(True)))
    return pairs.select("low", "high").distinct()


def _across(rare: DataFrame, threshold: float) -> DataFrame:
    """(low, high) of nodes with equal keys and different components that may be alike.

    Of two texts with n <= m k-mers, t / (1 + t) * (n + m) have to match at least. The first one
    that both have in the order of rare ones is among ``rare``, and all others come behind
    it in both, so ``rest`` is at least that on either side. For the smaller text that means
    2 t / (1 + t) of its own k-mers: texts that share a passage and not much more
    are no smaller side for this passage, however many there are. The larger one goes to the classes
    of sizes, about a sixteenth wide, that it allows for. Components are paired first, by
    the same bounds, so a large one is never joined with itself.
    """
    t = threshold
    need = t / (1 + t)

    def size_class(size):
        return F.floor(F.log(size) * 16).cast("int")

    few_left = F.col("rest") < 2 * need * F.col("size") - 1e-9
    small = rare.where(~few_left).withColumn("of", size_class(F.col("size")))
    least = F.greatest(F.lit(1), F.ceil(t * F.col("size") - 1e-9))
    most = F.least(F.col("size"), F.floor(F.col("rest") / need - F.col("size") + 1e-9))
    large = rare.where(least <= most)
    classes = F.sequence(size_class(least), size_class(most))
    large = large.withColumn("of", F.explode(classes)).withColumnsRenamed(
        {"node": "other", "component": "b", "size": "m", "rest": "rest_m"}
    )

    def bounded(n, rest_n, m, rest_m):
        total = (F.col(n) + F.col(m)) * need - 1e-9
        return (F.col(rest_n) >= total) & (F.col(rest_m) >= total)

    small_groups = small.groupBy("key", "of", "component").agg(
        F.min("size").alias("n1"), F.max("rest").alias("r1")
    )
    large_groups = large.groupBy("key", "of", "b").agg(
        F.min("m").alias("n2"), F.max("rest_m").alias("r2")
    )
    paired = small_groups.join(large_groups, ["key", "of"])
    paired = paired.where((F.col("component") != F.col("b")) & bounded("n1", "r1", "n2", "r2"))
    paired = paired.select("key", "of", "component", "b")
    pairs = paired.join(small, ["key", "of", "component"]).join(large, ["key", "of", "b"])
    near = (F.col("size") <= F.col("m")) & (F.col("size") >= t * F.col("m") - 1e-9)
    pairs = pairs.where(near & bounded("size", "rest", "m", "rest_m"))
    low, high = F.least("node", "other").alias("low"), F.greatest("node", "other").alias("high")
    return pairs.select(low, high).distinct()


def _all(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def _classes(documents, entries, length, threshold, rounds) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of all rows, and (node, least doc_id, class, its doc_id)."""
    found = written(sketches(documents, entries, length, threshold), "sketches")
    parts = components(links(found, documents, threshold, rounds))
    nodes = found.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    nodes = nodes.join(parts, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    first = nodes.groupBy("component").agg(
        F.min(F.struct(F.col("first_id").isNull(), "first_id", "node")).alias("least")
    )
    nodes = nodes.join(first, "component").select(
        "node",
        "first_id",
        F.col("least.first_id").alias("class_id"),
        F.col("least.node").alias("class_node"),
    )
    return found.select("doc_id", "node"), nodes


def near_duplicates(
    documents: DataFrame,
    entries: int = ENTRIES,
    length: int = LENGTH,
    threshold: float = THRESHOLD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """doc_id and class_id of every document: the least doc_id of its class.

    Whole texts are compared. Equal texts are always of one class, also empty ones; null
    is an empty text. Texts of fewer than five words are alike if their words are equal.
    A null doc_id gets its text's class, and is a class's id only if there is no other.
    A row for each row; an empty table gives none. Extra columns are not read.
    """
    rows, nodes = _classes(documents, entries, length, threshold, rounds)
    return rows.join(nodes, "node").select("doc_id", "class_id")


def keep_one(documents: DataFrame, **options) -> DataFrame:
    """One document of each class, the one whose doc_id names it, columns as they were.

    Of rows with this doc_id and equal texts one stays.
    """
    options = {
        "entries": ENTRIES, "length": LENGTH, "threshold": THRESHOLD, "rounds": ROUNDS,
        **options,
    }
    _, nodes = _classes(documents, **options)
    node, key = fresh(documents, "node"), fresh(documents, "id_key")
    no_id = F.lit(-(2**63))
    kept = nodes.where("node = class_node").select(
        F.col("node").alias(node), F.coalesce("class_id", no_id).alias(key)
    )
    text = F.encode(text_or_empty(), "UTF-8")
    bits = F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("bigint")
    marked = documents.withColumns({node: bits, key: F.coalesce("doc_id", no_id)})
    # by both, so that a text that very many documents share is spread over tasks
    one = marked.join(kept, [node, key], "left_semi").dropDuplicates([node, key])
    return one.select(*documents.columns)
