"""Mixing sources to target weights by a minimum-cost flow.

Documents are counted by membership pattern: the set of sources they belong to. Words
flow from patterns to their sources, whose quotas are the capacities; a pattern can
send its words once at no cost and again at a cost that rises with each repetition, so
nothing is repeated while something unused would do. The flow says how many words of
each pattern the mix takes. All its documents are taken as often as that goes evenly;
for the rest, documents are taken in the order of a seeded hash.

Patterns and sources are what the driver holds: a row each. More than ``MAX_PATTERNS``
are an error, never cut off.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accesslens.llm.common import fresh, n_words, small_table, written

MAX_PATTERNS = 50_000
CLOSING = 64  # documents behind the cut of a pattern that may close the gap
#: A document is large if so many of its size have more words than its pattern has, so a
#: pattern has fewer large ones than this. They are chosen first, as one can be half of
#: what is wanted; small ones then fill what is left.
LARGE = 64

Pattern = tuple[str | None, ...]


# -- targets and flow: on counts by pattern -----------------------------------------


def capped_shares(
    sizes: dict, weights: dict, total: float, most: float = 2.0
) -> dict[object, float]:
    """``total`` by weight, none above ``most`` times its size, the excess reshared."""
    shares = dict.fromkeys(sizes, 0.0)
    open_, rest = set(sizes), float(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        level = rest / weight if weight else 0.0
        full = {s for s in open_ if level * weights[s] >= most * sizes[s]}
        if not full:
            shares.update({s: level * weights[s] for s in open_})
            break
        shares.update({s: most * sizes[s] for s in full})
        rest -= sum(most * sizes[s] for s in full)
        open_ -= full
    return shares


def by_rank(sources: Iterable[str | None], cycle: tuple[int, ...]) -> dict:
    """Weights that repeat over the sources in code point order, null last."""
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}


def min_cost_flow(
    sizes: dict[Pattern, int], quotas: dict, repeats: int = 2
) -> dict[Pattern, int]:
    """Words taken of each pattern, repeats counted.

    Successive shortest paths: each augmentation takes the cheapest way with room from a
    pattern's unused words to a source that wants some, moving earlier flow between
    sources where that helps. Patterns that share no source don't affect each other.
    """
    taken = dict.fromkeys(sizes, 0)
    sent: dict[Pattern, dict] = {p: dict.fromkeys(p, 0) for p in sizes}
    room = {s: int(q) for s, q in quotas.items()}
    of_source: dict = defaultdict(list)
    for pattern in sizes:
        for source in pattern:
            of_source[source].append(pattern)
    for group in _connected(sizes, of_source):
        for level in range(repeats):  # a level costs more than all below: fill them first
            while True:
                path = _path(group, level, sizes, taken, sent, room, of_source)
                if path is None:
                    break
                start, steps = path
                amount = (level + 1) * sizes[start] - taken[start]
                amount = min(amount, room[steps[-1][1]])
                for (_, source), (pattern, _) in zip(steps, steps[1:]):  # noqa: B905
                    amount = min(amount, sent[pattern][source])
                taken[start] += amount
                for i, (pattern, source) in enumerate(steps):
                    sent[pattern][source] += amount
                    if i + 1 < len(steps):
                        sent[steps[i + 1][0]][source] -= amount
                room[steps[-1][1]] -= amount
    return taken


def _connected(sizes: dict, of_source: dict) -> list[list[Pattern]]:
    groups, seen = [], set()
    for first in sizes:
        if first in seen:
            continue
        group, waiting = [], [first]
        seen.add(first)
        while waiting:
            pattern = waiting.pop()
            group.append(pattern)
            for source in pattern:
                for other in of_source[source]:
                    if other not in seen:
                        seen.add(other)
                        waiting.append(other)
        groups.append(group)
    return groups


def _path(group, level, sizes, taken, sent, room, of_source):
    """From a pattern with words left at this level to a source with room.

    The shortest by number of steps; a step back over flow that was sent moves it.
    """
    starts = [p for p in group if taken[p] < (level + 1) * sizes[p]]
    came: dict = {p: None for p in starts}
    waiting = deque(starts)
    while waiting:
        pattern = waiting.popleft()
        for source in pattern:
            if room.get(source, 0) > 0:
                steps = [(pattern, source)]
                while came[pattern] is not None:
                    pattern, via = came[pattern]
                    steps.append((pattern, via))
                return pattern, steps[::-1]
            for other in of_source[source]:
                if other not in came and sent[other].get(source, 0) > 0:
                    came[other] = (pattern, source)
                    waiting.append(other)
    return None


# -- documents -----------------------------------------------------------------------


def _key(seed: int, size: Column) -> Column:
    """Order of documents in the mix: a seeded hash, and what tells equal ones apart."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.struct(F.md5(text.cast("binary")).alias("h"), F.col("doc_id"), size.alias("size"))


def plan(
    documents: DataFrame,
    quotas: Callable[[dict], dict],
    members: Column,
    seed: int = 0,
    repeats: int = 2,
) -> tuple[DataFrame, DataFrame, dict]:
    """Sized documents, and for each pattern what the mix takes of it.

    Returns a stored table (doc_id, members, size, key), a table of a row for each
    pattern (members, copies, most_small, cut, listed), and the quotas. ``quotas`` gets the size of
    each source and returns their targets.
    """
    size = n_words(F.col("text"))
    sized = documents.select("doc_id", members.alias("members"), size.alias("size"))
    sized = written(sized.select("*", _key(seed, F.col("size")).alias("key")), "sized")
    totals = sized.groupBy("members").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
    )
    totals = totals.limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {tuple(r["members"]): r for r in totals}
    sizes = {p: r["words"] for p, r in patterns.items()}
    of_source: dict = defaultdict(int)
    for pattern, words in sizes.items():
        for source in pattern:
            of_source[source] += words
    targets = quotas(dict(of_source))
    flow = min_cost_flow(sizes, {s: round(t) for s, t in targets.items()}, repeats)
    even = {p: flow[p] // sizes[p] if sizes[p] else 0 for p in patterns}
    rest = {p: flow[p] - even[p] * sizes[p] for p in patterns}
    large = _large(sized, {p: sizes[p] // LARGE for p in patterns if rest[p] > 0})
    chosen = {p: _choose(large.get(p, []), sizes[p], rest[p]) for p in patterns}
    # with n documents in about sqrt(n) buckets of the hash, no step sees more than that
    rows = [
        (
            list(p),
            even[p],
            sizes[p] // LARGE,
            rest[p] - sum(key["size"] for key in chosen[p]),
            max(1, int(r["n"] ** 0.5)),
            [key.asDict() for key in chosen[p]],
        )
        for p, r in patterns.items()
    ]
    schema = (
        "members array<string>, copies bigint, most_small bigint, rest bigint, "
        "buckets bigint, chosen array<struct<h:string,doc_id:bigint,size:bigint>>"
    )
    wanted = small_table(documents.sparkSession, rows, schema)
    return sized, _cuts(sized, wanted), targets


def _large(sized: DataFrame, most_small: dict[Pattern, int]) -> dict[Pattern, list]:
    """Keys of the large documents of each pattern, in order; fewer than LARGE each."""
    rows = [(list(p), n) for p, n in most_small.items()]
    known = small_table(sized.sparkSession, rows, "members array<string>, most bigint")
    found = sized.join(F.broadcast(known), "members").where("size > most")
    keys = defaultdict(list)
    for row in found.select("members", "key").collect():
        keys[tuple(row["members"])].append(row["key"])

    def order(key) -> tuple:
        return key["h"], key["doc_id"] or 0, key["size"]

    return {pattern: sorted(found, key=order) for pattern, found in keys.items()}


def _choose(large: list, words: int, rest: int) -> list:
    """Large documents to take: their share in order, so that the small can fill the rest."""
    total = sum(key["size"] for key in large)
    share, taken, sum_taken = total * rest / max(1, words), [], 0
    waiting = list(large)
    while waiting and sum_taken + waiting[0]["size"] / 2 <= share:
        taken.append(waiting.pop(0))
        sum_taken += taken[-1]["size"]
    while sum_taken > rest:
        waiting.insert(0, taken.pop())
        sum_taken -= waiting[0]["size"]
    for key in waiting:
        if rest - sum_taken > words - total and key["size"] <= rest - sum_taken:
            taken.append(key)
            sum_taken += key["size"]
    return taken


def _cuts(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each pattern the last key that is taken once more, and keys behind it.

    In the order of keys, documents are taken while they fit into the rest; of the next
    ones, those that still fit close the gap.
    """
    first = F.conv(F.substring("key.h", 1, 8), 16, 10).cast("bigint")
    bucket = F.floor(first * F.col("buckets") / F.lit(2.0**32)).cast("bigint")
    some = wanted.where("rest > 0").drop("chosen", "copies")  # MAX_PATTERNS rows at most
    rows = sized.join(F.broadcast(some), "members").where("size <= most_small")
    rows = rows.withColumn("bucket", bucket)
    upto = Window.partitionBy("members").orderBy("bucket")
    sums = rows.groupBy("members", "rest", "bucket").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
    )
    sums = sums.select(
        "*",
        (F.sum("words").over(upto) - F.col("words")).alias("before"),
        F.sum("n").over(upto).alias("upto"),
    )
    # the last bucket that starts within the rest, the one before it, as the cut can be at
    # its end, and the next ones for closing
    whole, inside = Window.partitionBy("members"), F.col("before") <= F.col("rest")
    started = F.col("upto") - F.col("n")
    sums = sums.withColumns(
        {
            "cut": F.max(F.when(inside, F.col("upto"))).over(whole),
            "cut_start": F.max(F.when(inside, started)).over(whole),
        }
    )
    near = sums.where(
        (F.col("upto") >= F.col("cut_start")) & (started <= F.col("cut") + CLOSING)
    )
    near = near.select("members", "bucket", "before")
    order = Window.partitionBy("members").orderBy("key")
    inside = rows.join(near, ["members", "bucket"])
    lowest = F.min("before").over(Window.partitionBy("members"))
    inside = inside.withColumn("total", F.sum("size").over(order) + lowest)
    inside = inside.withColumn("fits", F.col("total") <= F.col("rest"))
    behind = inside.withColumn(
        "nth", F.row_number().over(Window.partitionBy("members", "fits").orderBy("key"))
    )
    # what fits is a prefix: its last row, and the first rows behind it
    found = behind.groupBy("members", "rest").agg(
        F.max(F.when(F.col("fits"), F.col("key"))).alias("cut"),
        F.coalesce(F.max(F.when(F.col("fits"), F.col("total"))), F.min("before")).alias("taken"),
        F.array_sort(
            F.collect_list(F.when(~F.col("fits") & (F.col("nth") <= CLOSING), F.col("key")))
        ).alias("next"),
    )
    gap = F.struct(
        (F.col("rest") - F.col("taken")).alias("gap"),
        F.array().cast("array<struct<h:string,doc_id:bigint,size:bigint>>").alias("keys"),
    )
    closed = F.aggregate(
        "next",
        gap,
        lambda state, key: F.when(
            (key["size"] > 0) & (key["size"] <= state["gap"]),
            F.struct(
                (state["gap"] - key["size"]).alias("gap"),
                F.concat(state["keys"], F.array(key)).alias("keys"),
            ),
        ).otherwise(state),
    )
    found = found.select("members", "cut", closed["keys"].alias("closing"))
    found = wanted.drop("rest", "buckets").join(found, "members", "left")
    listed = F.concat("chosen", F.coalesce("closing", F.slice("chosen", 1, 0)))
    found = found.select("members", "copies", "most_small", "cut", listed.alias("listed"))
    return written(found, "cuts")


def _repeats(key: Column, copies: str, most_small: str, cut: str, listed: str) -> Column:
    """How often a document is taken: once more if it is listed, or small and in the cut."""
    inside = (key["size"] <= F.col(most_small)) & (key <= F.col(cut))
    extra = F.coalesce(inside, F.lit(False)) | F.array_contains(listed, key)
    return F.col(copies) + extra.cast("bigint")


CUT = ("copies", "most_small", "cut", "listed")


def source_quotas(cycle: tuple[int, ...], share: float, most: float) -> Callable[[dict], dict]:
    """Targets that share ``share`` of all words by weights in code point order."""

    def quotas(sizes: dict) -> dict:
        total = share * sum(sizes.values())
        return capped_shares(sizes, by_rank(sizes, cycle), total, most)

    return quotas


def mix_report(
    documents: DataFrame,
    cycle: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats and taken of every document.

    A null text has size 0 and is never taken; null is a source of its own. Equal rows
    are taken alike; as no other column is read, extra ones don't matter. An empty table
    gives no rows.
    """
    sized, cuts, targets = plan(
        documents, source_quotas(cycle, share, most), F.array("source"), seed, int(most)
    )
    sizes = sized.groupBy(F.element_at("members", 1).alias("source")).agg(
        F.sum("size").alias("source_size")
    )
    rows = [(s, float(t)) for s, t in targets.items()]
    quotas = small_table(documents.sparkSession, rows, "source string, target double")
    about = sizes.join(quotas, sizes["source"].eqNullSafe(quotas["source"])).select(
        F.array(sizes["source"]).alias("members"), "source_size", "target"
    )
    about = cuts.join(about, "members")  # a row for each pattern, as many as were checked
    mixed = sized.join(F.broadcast(about), "members")
    repeats = _repeats(F.col("key"), *CUT)
    return mixed.select(
        "doc_id",
        F.element_at("members", 1).alias("source"),
        "size",
        "source_size",
        "target",
        repeats.alias("repeats"),
        (F.col("size") * repeats).alias("taken"),
    )


def mix(
    documents: DataFrame,
    quotas: Callable[[dict], dict],
    members: Column | None = None,
    seed: int = 0,
    repeats: int = 2,
) -> DataFrame:
    """The mix: each document as many times as it is taken, columns as they were.

    ``members`` is an array of the sources a document belongs to, ``[source]`` if not
    given. Documents without words are not taken.
    """
    members = F.array("source") if members is None else members
    _, cuts, _ = plan(documents, quotas, members, seed, repeats)
    names = {c: fresh(documents, c) for c in ("members", *CUT)}
    marked = documents.withColumn(names["members"], members)
    cuts = cuts.withColumnsRenamed(names)
    marked = marked.join(F.broadcast(cuts), names["members"])  # MAX_PATTERNS rows at most
    size = F.col(fresh(documents, "size"))
    marked = marked.withColumn(fresh(documents, "size"), n_words(F.col("text")))
    times = _repeats(_key(seed, size), *[names[c] for c in CUT])
    each = F.explode(F.sequence(F.lit(1), F.when(size > 0, times).otherwise(0).cast("int")))
    repeated = fresh(documents, "nth")
    taken = marked.where((size > 0) & (times > 0)).withColumn(repeated, each)
    return taken.select(*documents.columns)
