"""Alignment of two tokenizers against the plain way over whole texts."""

import hashlib
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from accesslens.llm import queries, token_alignment
from accesslens.llm.common import written
from accesslens.llm.tokens import vocabulary

LETTERS, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary(LETTERS))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary(PIECES))


def tokens_of(text, tokenizers):
    """Ids and bytes of both sides, or None if a side doesn't give the text back."""
    a, b = tokenizers
    if not text:
        return None
    letters = token_alignment.byte_letters()
    found = a.encode(f" {text}", add_special_tokens=False)
    of_a = [bytes(letters[c] for c in token) for token in found.tokens]
    ids_b = b.encode(text)
    of_b = []
    for piece in map(b.id_to_piece, ids_b):
        byte = len(piece) == 6 and piece.startswith("<0x")
        of_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
    whole = f" {text}".encode()
    if b"".join(of_a) != whole or b"".join(of_b) != whole:
        return None
    return found.ids, of_a, ids_b, of_b


def plainly(rows, tokenizers):
    """Report of every row: groups by bytes, links by comparing every two tokens of a group."""
    aligned, counts = [], Counter()
    for doc_id, text in rows:
        tokens = tokens_of(text, tokenizers)
        if tokens is None:
            aligned.append((doc_id, 0, 0, [], []))
            continue
        ids_a, of_a, ids_b, of_b = tokens
        sides = []
        for ids, parts in ((ids_a, of_a), (ids_b, of_b)):
            at, spans = 0, []
            for i, part in zip(ids, parts, strict=True):
                spans.append((at, at + len(part), i))
                at += len(part)
            sides.append(spans)
        common = {end for _, end, _ in sides[0]} & {end for _, end, _ in sides[1]}
        groups, links = [], []
        queues = [list(side) for side in sides]
        for end in sorted(common):
            parts = []
            for queue in queues:
                part = []
                while queue and queue[0][1] <= end:
                    part.append(queue.pop(0))
                parts.append(part)
            groups.append("|".join(",".join(str(i) for *_, i in part) for part in parts))
            links += [
                (a, b)
                for start_a, end_a, a in parts[0]
                for start_b, end_b, b in parts[1]
                if max(start_a, start_b) < min(end_a, end_b)
            ]
        counts.update(links)
        aligned.append((doc_id, len(ids_a), len(ids_b), groups, links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return sorted(
        (
            (
                str(doc_id), n_a, n_b, len(groups), len(links),
                sum(counts[link] == most[link[1]] for link in links),
                sum(counts[link] for link in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, groups, links in aligned
        )
    )


def report(spark, rows, frequent=token_alignment.FREQUENT):
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = table.withColumns({"row": F.lit("x"), "pairs": F.lit(0), "n": F.lit(None)})
    pieces = vocabulary(PIECES)
    stored = written(token_alignment.alignments(table, vocabulary(LETTERS), pieces), "test")
    n_pieces = token_alignment.n_pieces(pieces)
    found = token_alignment.with_link_counts(stored, n_pieces, frequent).collect()
    return sorted(
        (
            str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
            hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "",
        )
        for r in found
    )


TEXTS = [
    "plain words, and more of them.",
    "a\nb\n\nc \n d\r\ne\tf  g   h ",
    " leading",
    "\nleading line",
    "trailing\n",
    " ",
    "\n",
    "don't 'tis it's we'll I'd y'all's",
    "<|endoftext|> <s> </s> <unk> <0x0A> a<s>b",
    "blank piece ▁ inside",
    "x▁y",
    "naïve café ﬁne ｆｕｌｌ 中文字符 한국어 עברית 🙂👍🏽 é",
    "nul \0 and \0x \x1c \x1d x\x1fy",
    "no break  em line　wide",
    "1234567 3.14159 10,000.00 0x7f",
    "x" * 3000,
    ("word " * 40_000).strip(),
    "",
    None,
]


@pytest.mark.parametrize("frequent", [token_alignment.FREQUENT, 40, 0])
def test_alignment_against_the_plain_way(spark, tokenizers, frequent):
    """Also with pairs too many to go to every task."""
    rows = [(i, text) for i, text in enumerate(TEXTS)]
    rows += [(None, "plain words"), (0, TEXTS[0]), (0, "other words, and more")]
    assert report(spark, rows, frequent) == plainly(rows, tokenizers)


def test_nothing(spark):
    assert report(spark, []) == []
    assert report(spark, [(1, None)]) == [("1", 0, 0, 0, 0, 0, 0, "")]


def test_chunks_that_are_not_remembered(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(token_alignment, "HELD", 10)
    monkeypatch.setattr(token_alignment, "TOGETHER", 50)
    import pyarrow as pa

    known = token_alignment.Aligner(vocabulary(LETTERS), vocabulary(PIECES), remembered=3)
    texts = ["one two three four five one", "six seven one two", "one\nsix"]
    for text in texts * 2:
        columns, _, _ = token_alignment.align_texts(pa.array([text]), known)
        expected = plainly([(0, text)], tokenizers)[0]
        assert [c[0].as_py() for c in columns[:4]] == list(expected[1:5])
    assert len(known.known) == 3


def test_chunks_are_aligned_together(tokenizers):
    """Like the plain way, also beside chunks that one side doesn't give back, in few calls."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"{x}{y}{z}é{x}" for x in letters for y in letters for z in letters[:8]]
    words[::89] = [f"{word}▁" for word in words[::89]]
    texts = [" ".join(words[i : i + 60]) for i in range(0, len(words), 60)]
    texts += [words[i] for i in range(0, len(words), 89)]
    known = token_alignment.Aligner(vocabulary(LETTERS), vocabulary(PIECES), remembered=2_000)
    calls = Counter()
    import pyarrow as pa

    rows = pa.array(texts, pa.string())
    sys.setprofile(lambda frame, event, what: calls.update([event]))
    columns, _, _ = token_alignment.align_texts(rows, known)
    sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < 10 * len(set(words))
    for _ in range(2):  # again from what is remembered, and in part anew
        found = list(zip(*[c.to_pylist() for c in columns[:5]], strict=True))
        for (*numbers, groups), text in zip(found, texts, strict=True):
            expected = plainly([("", text)], tokenizers)[0]
            assert tuple(numbers) == expected[1:5]
            digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
            assert digest == expected[7]
        columns, _, _ = token_alignment.align_texts(rows, known)
    assert any(n[0] == 0 for n in found) and any(n[0] > 0 for n in found)
    assert len(known.known) == 2_000


def test_query(spark, sf_dir, tokenizers):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = queries.op13_token_alignment(spark, sf_dir).collect()
    found = sorted(
        (
            str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
            r.groups_sha256,
        )
        for r in found
    )
    assert found == plainly([tuple(r) for r in documents.collect()], tokenizers)
