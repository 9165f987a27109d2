"""Spelling variants against brute force."""

from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from accesslens.llm import queries, spelling_groups


def counted(rows, every=97):
    """Words as the contract has them, letter by letter."""
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % every == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                counts[run] += 1
                run = ""
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def grouped(words):
    """word: (form, root, n, n_near, form_n), by every way to change one letter."""
    near = defaultdict(set)
    buckets = defaultdict(list)
    for word in words:
        for i in range(len(word)):
            buckets[word[:i] + "?" + word[i + 1 :]].append(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for bucket in buckets.values():
        for word in bucket:
            near[word].update(w for w in bucket if w != word)
    forms = {}
    for word in words:
        best = min(near[word], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * words[word]:
            forms[word] = best
    found = {}
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        found[word] = (form, root, n, len(near[word]), words.get(form))
    return found


def rows_of(result):
    rows = result.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def frame(spark, rows):
    """Documents with further columns named like the operator's own."""
    table = spark.createDataFrame([*rows], "doc_id bigint, text string")
    return table.withColumns({"word": F.lit("x"), "n": F.lit(1), "node": F.lit(None)})


CASES = {
    "chains": [(1, "woord " * 3), (2, "wword " * 7 + "words " * 14), (3, "sword " * 30)],
    "rows": [(1, "Maison maison MAISON"), (1, "Maison maison MAISON"), (1, "maisón " * 4)],
    "letters": [(None, "naïve naive Naïve naïves NAÏVE × a÷b÷c÷d÷ef " * 3), (None, None)],
    "repeats": [(9, "aaaaa aaaaaa aaaaaaa aabaa baaaa aaaab abab ababa babab " * 4)],
    "ends": [(4, "xabcde abcde abcdex abcd bcde abce acde zbcde abcdz " * 3)],
    "odd": [(5, ""), (6, "$<> 12 _ 中文 ﬁne \U0001d400"), (7, "fine$fines<fine>" * 9)],
    "long": [
        (8, f"{'abc' * 15} {'abc' * 16} {'abc' * 16}d {'abc' * 17} {'abc' * 16}e x{'abc' * 16} " * 3),
        (9, f"{'q' * 47} {'q' * 48} {'q' * 49} {'q' * 50} {'q' * 20}w{'q' * 29} " * 3),
        (10, f"{'z' * 20_000} {'z' * 20_001} {'z' * 9_000}y{'z' * 10_999} " * 3),
    ],
}


@pytest.mark.parametrize("case", CASES)
def test_variants_against_brute_force(spark, case):
    rows = CASES[case]
    found = rows_of(spelling_groups.variant_groups(frame(spark, rows)))
    assert found == grouped(counted(rows))


def test_no_words(spark):
    assert rows_of(spelling_groups.variant_groups(frame(spark, []))) == {}
    assert rows_of(spelling_groups.variant_groups(frame(spark, [(1, "once only")]))) == {}


def test_many_words_of_one_beginning(spark):
    """A third of all words below one node of the trie."""
    letters = "abcdefgh"
    words = [f"pre{a}{b}{c}" for a in letters for b in letters for c in letters]
    words += [f"{a}{b}{c}post" for a in letters for b in letters for c in letters]
    rows = [(i, f"{w} " * 3) for i, w in enumerate(words)]
    found = rows_of(spelling_groups.variant_groups(frame(spark, rows), every=None))
    assert found == grouped({w: 3 for w in words})


def test_query(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert rows_of(queries.op12_spelling_groups(spark, sf_dir)) == grouped(counted(rows))
