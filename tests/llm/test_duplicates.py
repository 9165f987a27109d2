"""Near-duplicate documents and lines against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from accesslens.llm import line_neighbourhood, order_minhash
from accesslens.llm.common import WORDS

SCHEMA = "doc_id bigint, text string, node string, kept string, line string"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "n", "k", "l") for i, t in rows], SCHEMA)


def _words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=4)) for _ in range(n)]


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(max(1, len(words)))
        words[at : at + 1] = rng.choice([[], ["new"], ["new", *words[at : at + 1]]])
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    texts = []
    for _ in range(25):
        base = _words(rng, rng.choice([3, 6, 9, 14, 40, 200, 600]))
        texts.append(" ".join(base))
        texts += [" ".join(_edited(rng, base, rng.randrange(1, 9))) for _ in range(6)]
        texts.append("  ".join(base))
    passage = " ".join(_words(rng, 60))
    texts += [passage + " " + " ".join(_words(rng, 90)) for _ in range(10)]
    texts += texts[:20] + ["", "", " ", None, "one", "one", "one two", "x " * 5000]
    rng.shuffle(texts)
    return list(enumerate(texts))


def _lcs(a, b):
    row = np.zeros(len(b) + 1, int)
    for x in a:
        new = np.maximum(row, np.concatenate(([0], row[:-1] + (b == x))))
        row = np.maximum.accumulate(new)
    return int(row[-1])


def _brute_classes(rows, threshold=0.8):
    hasher = order_minhash.Hasher()
    kmers = [hasher.kmers(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, text) in enumerate(rows):
        for j in range(i):
            same = (text or "") == (rows[j][1] or "")
            n = len(kmers[i]) + len(kmers[j])
            if not same and min(len(kmers[i]), len(kmers[j])) >= threshold * n / 2 * 0.8:
                common = _lcs(kmers[i], kmers[j])
                same = n > 0 and common >= threshold * (n - common)
            if same:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {row[0]: rows[find(i)][0] for i, row in enumerate(rows)}


def test_classes_are_those_of_all_pairs(spark, corpus):
    found = order_minhash.near_duplicates(_table(spark, corpus).repartition(6)).collect()
    assert {r.doc_id: r.class_id for r in found} == _brute_classes(corpus)
    assert len(found) == len(corpus)


def test_one_of_each_class_stays(spark, corpus):
    table = _table(spark, [*corpus, *corpus[:30]]).repartition(6)
    kept = order_minhash.keep_one(table)
    assert kept.columns == table.columns
    wanted = Counter(set(_brute_classes(corpus).values()))
    assert Counter(r.doc_id for r in kept.collect()) == wanted


def test_odd_ids_and_empty_tables(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, ""), (5, "z"), (5, "y")]
    table = _table(spark, rows)
    found = Counter(tuple(r) for r in order_minhash.near_duplicates(table).collect())
    assert found == Counter([(None, 4), (4, 4), (None, None), (5, 5), (5, 5)])
    assert order_minhash.keep_one(table).count() == 4
    assert order_minhash.near_duplicates(table.where("false")).count() == 0
    assert order_minhash.keep_one(table.where("false")).count() == 0


def test_a_large_group_of_edited_copies_is_one_class(spark):
    rng = random.Random(8)
    base = _words(rng, 150)
    rows = [(0, " ".join(base))]
    rows += [(i, " ".join(_edited(rng, base, 2))) for i in range(1, 400)]
    rows += [(i, " ".join(_words(rng, 150))) for i in range(400, 450)]
    found = dict(map(tuple, order_minhash.near_duplicates(_table(spark, rows)).collect()))
    assert {found[i] for i in range(400)} == {0}
    assert all(found[i] == i for i in range(400, 450))


@pytest.mark.parametrize("few", [16, 100])
def test_one_entry_of_many_groups(spark, monkeypatch, few):
    """More groups than rounds, and a link between a node that matched a hub and one that didn't."""
    monkeypatch.setattr(order_minhash, "FEW", few, raising=False)
    rng = random.Random(12)
    rows = []
    for _ in range(20):
        words = _words(rng, 100)
        rows += [words, [*words[:-6], *_words(rng, 6)], [*_words(rng, 8), *words[8:]]]
    rows = list(enumerate(map(" ".join, rows)))
    found = [(i, order_minhash.node_of(t), [1]) for i, t in rows]
    found = spark.createDataFrame(found, "doc_id bigint, node bigint, keys array<bigint>")
    edges = order_minhash.links(found, _table(spark, rows), 0.8, order_minhash.ROUNDS)
    parts = dict(map(tuple, order_minhash.components(edges).collect()))
    classes = _brute_classes(rows)
    assert len(set(classes.values())) == 20
    nodes = {i: order_minhash.node_of(t) for i, t in rows}
    assert all(parts.get(nodes[i]) == parts.get(nodes[c], -1) for i, c in classes.items())
    assert len({parts[n] for n in nodes.values()}) == 20


def test_rounds_end_when_hubs_match_few(spark, monkeypatch):
    """Pairs of texts around one passage: hubs match their other only, and no link is lost."""
    rng = random.Random(14)
    rows = []
    for _ in range(40):
        words = _words(rng, 100)
        rows += [words, [*words[:-6], *_words(rng, 6)]]
    rows = list(enumerate(map(" ".join, rows)))
    found = [(i, order_minhash.node_of(t), [1]) for i, t in rows]
    found = spark.createDataFrame(found, "doc_id bigint, node bigint, keys array<bigint>")
    rounds, real = [], order_minhash.written
    monkeypatch.setattr(
        order_minhash, "written", lambda df, purpose, *a, **k: (
            rounds.append(purpose), real(df, purpose, *a, **k))[1],
    )
    edges = order_minhash.links(found, _table(spark, rows), 0.8, order_minhash.ROUNDS)
    expected = {
        tuple(sorted((order_minhash.node_of(rows[i][1]), order_minhash.node_of(rows[i + 1][1]))))
        for i in range(0, 80, 2)
    }
    assert {tuple(sorted(e)) for e in edges.collect()} == expected
    assert rounds.count("verified") == 2  # one round and the open pairs


def test_kmers_come_from_even_tasks(spark, monkeypatch):
    """Also where one task reads all the texts."""
    rng = random.Random(15)
    texts = [" ".join(_words(rng, 60)) for _ in range(400)]
    nodes = [order_minhash.node_of(t) for t in texts]
    table = spark.createDataFrame([(n, n) for n in nodes], "node long, component long")
    stored = spark.createDataFrame(list(zip(nodes, texts, strict=True)), "node long, text string")
    tables, real = {}, order_minhash.written

    def kept(df, purpose, *args, **options):
        tables[purpose] = real(df, purpose, *args, **options)
        return tables[purpose]

    monkeypatch.setattr(order_minhash, "written", kept)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # so little would be one task
    spark.conf.set(merging, False)
    try:
        order_minhash._rare_kmers(table, stored.coalesce(1), 0.8)
    finally:
        spark.conf.unset(merging)
    files = tables["kmers"].groupBy(F.input_file_name().alias("file")).count().collect()
    assert len(files) > 1 and sum(f["count"] for f in files) == 400 * 56
    assert max(f["count"] for f in files) < 2 * 400 * 56 / len(files)


def test_rare_kmers_find_all_pairs_that_are_alike(spark):
    """Texts of a common passage and more or less of their own, of many sizes."""
    rng = random.Random(13)
    passage, texts = _words(rng, 60), []
    for own in [0, 0, 1, 2, 4, 6, 8, 9, 10, 11, 12, 13, 14, 16, 20, 30, 60, 200] * 4:
        words = _edited(rng, passage, rng.choice([0, 1])) + _words(rng, own)
        texts.append(" ".join(words[rng.choice([0, 0, 3]) :]))
    texts = sorted(set(texts))
    hasher = order_minhash.Hasher()
    kmers = [order_minhash.labelled(hasher.kmers(t)) for t in texts]
    nodes = [order_minhash.node_of(t) for t in texts]
    component = [n if i % 3 else nodes[0] for i, n in enumerate(nodes)]  # a large one, and others
    alike = {
        tuple(sorted((nodes[i], nodes[j])))
        for i in range(len(texts)) for j in range(i)
        if component[i] != component[j]
        and order_minhash.similarity(kmers[i], kmers[j], 0.8) > 0
    }
    table = spark.createDataFrame(list(zip(nodes, component, strict=True)), "node long, component long")
    stored = spark.createDataFrame(list(zip(nodes, texts, strict=True)), "node long, text string")
    rare = order_minhash._rare_kmers(table, stored, 0.8)
    found = [tuple(r) for r in order_minhash._across(rare, 0.8).collect()]
    assert len(found) == len(set(found)) and alike <= set(found) and len(alike) > 100
    assert len(found) < 3 * len(alike)


@pytest.mark.parametrize("bits", [16, 6, 1])
def test_counted_cells_lose_no_pair_that_is_alike(spark, monkeypatch, bits):
    """Also where so few cells are counted that most k-mers share theirs."""
    monkeypatch.setattr(order_minhash, "BLOCK_BITS", min(bits, 4), raising=False)
    monkeypatch.setattr(order_minhash, "MOST_BITS", bits, raising=False)
    rng = random.Random(16)
    passage, texts = _words(rng, 60), ["one two", ""]
    for own in [0, 0, 1, 2, 4, 6, 8, 9, 10, 11, 12, 13, 14, 16, 20, 30, 60, 200] * 3:
        words = _edited(rng, passage, rng.choice([0, 1])) + _words(rng, own)
        texts.append(" ".join(words[rng.choice([0, 0, 3]) :]))
    texts = sorted(set(texts))
    hasher = order_minhash.Hasher()
    kmers = [order_minhash.labelled(hasher.kmers(t)) for t in texts]
    nodes = [order_minhash.node_of(t) for t in texts]
    component = [n if i % 3 else nodes[0] for i, n in enumerate(nodes)]
    alike = {
        tuple(sorted((nodes[i], nodes[j])))
        for i in range(len(texts)) for j in range(i)
        if component[i] != component[j]
        and order_minhash.similarity(kmers[i], kmers[j], 0.8) > 0
    }
    table = spark.createDataFrame(list(zip(nodes, component, strict=True)), "node long, component long")
    stored = spark.createDataFrame(list(zip(nodes, texts, strict=True)), "node long, text string")
    cells = order_minhash._cells(table, stored, sum(map(len, kmers)))
    assert len(cells) == 2 ** min(bits, (4 * sum(map(len, kmers))).bit_length())
    rare = order_minhash._rare_kmers(table, stored, 0.8, cells)
    found = [tuple(r) for r in order_minhash._across(rare, 0.8).collect()]
    assert len(found) == len(set(found)) and alike <= set(found) and len(alike) > 30


def test_few_kmers_of_texts_around_a_passage_are_listed(spark, monkeypatch):
    """Those of near copies and of texts that share a passage; classes are whole."""
    monkeypatch.setattr(order_minhash, "LISTED", 0, raising=False)
    rng = random.Random(17)
    passage, base = _words(rng, 40), _words(rng, 100)
    rows = [base[:60] + passage]
    rows += [_edited(rng, rows[0], 2) for _ in range(60)]
    for _ in range(60):
        words = _words(rng, 60) + passage
        rows += [words, [*words[:50], *_words(rng, 6), *words[56:]]]
    rows = list(enumerate(map(" ".join, rows)))
    size = len(order_minhash.Hasher().kmers(rows[0][1]))
    found = [(i, order_minhash.node_of(t), [1], size) for i, t in rows]
    found = spark.createDataFrame(found, "doc_id long, node long, keys array<long>, size long")
    listed, real = [], order_minhash.written

    def kept(df, purpose, *args, **options):
        table = real(df, purpose, *args, **options)
        if purpose == "kmers":
            listed.append(table.count())
        return table

    monkeypatch.setattr(order_minhash, "written", kept)
    edges = order_minhash.links(found, _table(spark, rows), 0.8, order_minhash.ROUNDS)
    parts = dict(map(tuple, order_minhash.components(edges).collect()))
    classes = _brute_classes(rows)
    nodes = {i: order_minhash.node_of(t) for i, t in rows}
    assert len(set(classes.values())) == 61
    assert all(parts.get(nodes[i]) == parts.get(nodes[c], -1) for i, c in classes.items())
    assert len({parts[n] for n in nodes.values()}) == 61
    assert len(listed) == 1 and listed[0] < size * len(rows) / 4


def test_order_counts():
    rng = random.Random(9)
    words = _words(rng, 400)
    hasher = order_minhash.Hasher()
    turned = hasher.kmers(" ".join(words[200:] + words[:200]))
    plain = hasher.kmers(" ".join(words))
    assert order_minhash.similarity(plain, turned, 0.8) == 0.0
    assert order_minhash.similarity(plain, plain, 0.8) == 1.0
    agree = order_minhash.sketch(plain) == order_minhash.sketch(turned)
    assert agree.mean() < 0.3


def test_banded_matches_against_the_full_table():
    rng = random.Random(10)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(30))]
        b = [rng.randrange(6) for _ in range(rng.randrange(30))]
        full = _lcs(a, np.array(b, int)) if b else 0
        assert order_minhash.banded_matches(a, b, 30) == full
        assert order_minhash.banded_matches(a, b, 2) <= full


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (7, 7)]
    random.Random(1).shuffle(edges)
    table = spark.createDataFrame(edges, "u bigint, v bigint")
    found = dict(map(tuple, order_minhash.components(table).collect()))
    assert {found[i] for i in range(61)} == {0}
    assert {found[i] for i in (100, 200, 300)} == {100}


def test_links_are_written_to_few_files(spark, monkeypatch):
    files, write = [], order_minhash.written

    def written(df, purpose):
        table = write(df, purpose)
        files.append((table.count(), len(table.inputFiles())))
        return table

    monkeypatch.setattr(order_minhash, "written", written)
    monkeypatch.setattr(order_minhash, "LINKS", 100)
    table = spark.range(400).selectExpr("id - id % 5 AS u", "id AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        found = dict(map(tuple, order_minhash.components(table).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {i: i - i % 5 for i in range(400)}
    assert files[0][0] == 320 and files[0][1] > 4
    assert all(n <= 320 and parts <= 4 for n, parts in files[1:]) and len(files) > 1


# -- lines -------------------------------------------------------------------------------


def _near(a, b):
    """Whether one word inserted, deleted or replaced turns a into b."""
    if max(len(a), len(b)) < 5:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute_lines(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, result = [], {}
    for i in order:
        kept = []
        for line in (rows[i][1] or "").split("\n"):
            words = WORDS.findall(line)
            if not words:
                kept.append(line)
                continue
            if not any(words == w or _near(words, w) for w in seen):
                kept.append(line)
            seen.append(words)
        result[rows[i][0]] = "\n".join(kept)
    return result


def test_lines_against_all_pairs(spark):
    rng = random.Random(11)
    bases = [_words(rng, rng.choice([1, 3, 4, 5, 6, 9, 30])) for _ in range(40)]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randrange(9)):
            words = rng.choice(bases)
            words = words if rng.random() < 0.4 else _edited(rng, words, rng.choice([1, 1, 2]))
            lines.append(rng.choice([" ", "  ", " \t"]).join(words) + rng.choice(["", " ", "\r"]))
        rows.append((i * 3 - 100, "\n".join(lines + [""] * rng.randrange(2))))
    rows += [(None, "nothing of this has an id"), (10**12, None), (10**12 + 1, "long " * 30_000)]
    table = _table(spark, rows).repartition(7)
    found = line_neighbourhood.deduplicate_lines(table)
    assert found.columns == table.columns
    assert {r.doc_id: r.text for r in found.collect()} == _brute_lines(rows)


def test_lines_of_odd_tables(spark):
    same = [(3, "an equal line of words\nshort"), (3, "an equal line of words\nshort")]
    table = _table(spark, [*same, (3, "another text with this id"), (None, None), (9, "")])
    found = line_neighbourhood.deduplicate_lines(table, counts=True).collect()
    assert Counter((r.doc_id, r.text, r.n_removed) for r in found) == Counter(
        [(3, "an equal line of words\nshort", 0)] * 2
        + [(3, "another text with this id", 0), (None, "", 0), (9, "", 0)]
    )
    assert line_neighbourhood.deduplicate_lines(table.where("false")).count() == 0


def test_many_texts_without_an_id_or_with_one_id(spark):
    """Each is a document of its own; none takes another's lines."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).cast("bigint").alias("doc_id"),
        F.format_string("line number %d of a text without an id\nand another, %1$d", "id").alias("text"),
        F.lit("x").alias("n_lines"), F.lit(None).alias("tie"),
    )
    found = line_neighbourhood.deduplicate_lines(rows, counts=True)
    assert found.columns == [*rows.columns, "_n_lines", "n_removed"]
    figures = found.agg(
        F.count("text"), F.min("n_removed"), F.max("_n_lines"), F.sum(F.size(F.split("text", "\n")))
    ).first()
    assert figures[:3] == (60_000, 0, 2)
    lines = found.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    assert lines.count() == lines.distinct().count()
    assert found.where("n_removed > 2 OR n_removed < 0").isEmpty()


def test_short_lines_are_compared_for_equality(spark):
    rows = [(1, "Menu\n\nA text\nMenu"), (2, "menu\nMenu\n \nx"), (3, "x\nA text\n\nx y\nx")]
    found = line_neighbourhood.deduplicate_lines(_table(spark, rows)).collect()
    assert {r.doc_id: r.text for r in found} == _brute_lines(rows) == {
        1: "Menu\n\nA text", 2: "menu\n \nx", 3: "\nx y"
    }
    found = line_neighbourhood.deduplicate_lines(_table(spark, rows), min_chars=5).collect()
    assert {r.doc_id: r.text for r in found}[3] == "x\n\nx y\nx"


def test_one_line_everywhere(spark):
    rows = [(i, f"the same line in all of them\nown line number {i} of text {i * 7}") for i in range(2000)]
    found = line_neighbourhood.deduplicate_lines(_table(spark, rows)).collect()
    assert sum("the same line" in r.text for r in found) == 1
    assert len(found) == 2000


def test_query_equals_its_sql(spark, duck, sf_dir):
    from accesslens.llm.oracle import ORACLE
    from accesslens.llm.queries import QUERIES

    name = "op10_line_neighbourhood"
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLE[name])
    columns = sorted(c[0] for c in expected.description)
    wanted = Counter(expected.df()[columns].itertuples(index=False, name=None))
    assert Counter(map(tuple, result.select(*columns).collect())) == wanted
