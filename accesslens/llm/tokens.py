"""Token ids of whole texts, with each distinct chunk of a text encoded once.

The pre-tokenizers of the vocabularies never join what stands on both sides of the
boundaries used here, so the ids of a text are those of its chunks in a row. Chunks
repeat, and looking one up takes a small part of the time of merging its bytes.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache
from itertools import accumulate, chain, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of Unicode's White_Space property.
WHITE = (
    r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)

WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{WHITE}]", c))

#: Ways to cut a text into chunks that can be encoded by themselves.
#: ``spaced``: a blank belongs to the word after it; of longer white space, all but the
#: last character goes together. ``words``: white space is not encoded.
CHUNKS = {
    "spaced": re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"),
    "words": re.compile(rf"[^{WHITE}]+"),
}
#: Before a chunk in front of which there is no blank.
ALONE = "\0"
#: Texts that can't be cut at blanks and line ends alone: with other white space, and, if
#: blanks count, with more than one in a row or one at an end.
PLAIN = r"[\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SINGLE = PLAIN + r"|[ \n]{2}|\A[ \n]|[ \n]\z|\x00"

#: Chunks remembered by a Python worker, in the order met, and the longest of them. The
#: rest is encoded each time.
REMEMBERED = 700_000
LONGEST = 32


def vocabulary(name: str) -> str:
    """Path of a vocabulary that comes with the machine's public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Encodes texts to the bytes of their ids, 2 or 4 bytes each (little-endian)."""

    def __init__(self, path: str, chunks: str, width: int, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if width == 2 and self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary need 4 bytes")
        self.find = CHUNKS[chunks].findall
        self.spaced = chunks == "spaced"
        self.code, self.width = {2: "H", 4: "I"}[width], width
        self.known: dict[str, bytes] = {"": b""}
        self.remembered = remembered
        # a full stop or comma after a letter or digit and before white space
        self.marks = dict(zip(".,", self._ids([".", ","]), strict=True))

    def _ids(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        ids = [encoding.ids for encoding in found]
        flat = array(self.code, chain.from_iterable(ids)).tobytes()
        ends = list(accumulate(len(i) * self.width for i in ids))
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _cut(self, text: str) -> list[str]:
        """Chunks of a text; those that follow a blank stand without it.

        Others have a mark instead, if chunks have blanks at all.
        """
        if not self.spaced:
            return self.find(text)
        return [
            c[1:] if c[0] == " " and c[1:2].strip(ALONE + WHITE_SPACE) else ALONE + c
            for c in self.find(text)
        ]

    def _cut_all(self, texts: pa.Array) -> pa.ListArray:
        """Chunks of texts in which blanks and line ends are all the white space.

        Between words, if blanks count: then each stands singly.
        """
        if not self.spaced:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        marked = pc.binary_join_element_wise(pa.scalar(ALONE), texts, "")
        return pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")

    def _whole(self, chunk: str) -> str:
        if not self.spaced or chunk[0] == "\n":
            return chunk
        return chunk[1:] if chunk[0] == ALONE else f" {chunk}"

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not known, from those of their stems."""
        stems = {
            c: c[:-1] if c[-1] in self.marks and len(c) > 1 and c[-2].isalnum() else c
            for c in chunks
        }
        known = self.known
        new = [s for s in dict.fromkeys(stems.values()) if s not in known]
        found: dict[str, bytes] = {}
        for start in range(0, len(new), 10_000):
            part = new[start : start + 10_000]
            ids = self._ids([self._whole(chunk) for chunk in part])
            found.update(zip(part, ids, strict=True))
        for chunk, stem in stems.items():
            if stem is not chunk:
                ids = found[stem] if stem in found else known[stem]
                found[chunk] = ids + self.marks[chunk[-1]]
        room = max(0, self.remembered - len(known))
        short = (item for item in found.items() if len(item[0]) <= LONGEST)
        known.update(islice(short, room))
        return found

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks."""
        ids = list(map(self.known.get, chunks))
        at, gaps = -1, []
        try:
            while True:
                at = ids.index(None, at + 1)
                gaps.append(at)
        except ValueError:
            pass
        if gaps:
            found = self._encode([chunks[at] for at in gaps])
            for at in gaps:
                ids[at] = found[chunks[at]]
        return ids

    def _joined(self, chunks: pa.ListArray) -> list[bytes]:
        """Ids of each list of chunks: those of the distinct ones, put where they occur."""
        coded = chunks.flatten().dictionary_encode()
        where = coded.indices.to_numpy()
        ids = self._ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
        starts = (np.cumsum(sizes) - sizes).astype(np.int32)
        each = sizes[where]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(starts[where] - (ends - each).astype(np.int32), each)
        take += np.arange(total, dtype=np.int32)
        found = np.frombuffer(b"".join(ids), f"<u{self.width}")[take]
        offsets = chunks.offsets.to_numpy() - chunks.offsets[0].as_py()
        bounds = np.concatenate(([0], ends))[offsets].tolist()
        return [found[a:b].tobytes() for a, b in pairwise(bounds)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, null as none."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, SINGLE if self.spaced else PLAIN)
        odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        found = self._joined(self._cut_all(texts))
        if odd:  # their white space is looked at in detail
            cut = [self._cut(texts[i].as_py()) for i in odd]
            ids = self._joined(pa.array(cut, pa.list_(pa.string())))
            for i, value in zip(odd, ids, strict=True):
                found[i] = value
        return found


@cache
def encoder(
    path: str, chunks: str, width: int, remembered: int = REMEMBERED
) -> ChunkEncoder:
    """One encoder for each Python worker, so that its memory outlives a task."""
    return ChunkEncoder(path, chunks, width, remembered)


#: Bytes of texts whose chunks are found together.
TOGETHER = 12_000_000


def groups(texts: pa.Array, size: int = TOGETHER):
    """Runs of texts of about so many bytes: (index of the first, texts)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        held = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, held + size)))
        yield start, texts[start:end]
        start = end
