"""Hierarchical packing of tokenized documents into sequences of several lengths."""

from __future__ import annotations

import bisect
import functools
import os
import string
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.llm.arrow import map_batches, sliced, struct_of

#: Sequence lengths, the longest first. Each is a power of two, so a full sequence of any tier needs no padding.
TIERS = (2048, 1024, 512, 256)
#: Words whose ids a task remembers, in two halves of as many as a dict of 2**17 places holds; the older half goes when the younger is full.
CACHED_WORDS = 2 * 87_381
#: Documents whose pieces are packed together; what is open then goes on to the next.
BLOCK = 512


@functools.lru_cache(maxsize=1)
def _loaded(path: str, changed: int):
    """The tokenizer of a file, one for all tasks of a process: each that is used and dropped leaves some 6 MB behind."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordCache(dict):
    """Little-endian 32-bit ids of each word. Ids of a text are those of its words: the tokenizer cuts at white space before it merges.

    It also lower-cases, and cuts letters from marks, before it merges. So a word of Latin letters has the ids of its lower-case form, and one
    with marks at its end those of both parts; letters go to the merges at once. All other words take the tokenizer's whole way.
    """

    def __init__(self, path: str):
        self.tokenizer = _loaded(path, os.stat(path).st_mtime_ns)
        self.merges = self.tokenizer.model.tokenize
        # byte-level vocabularies write bytes that don't print as the characters from 256 on
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printed]
        self.letters = {b: 256 + i for i, b in enumerate(others)}
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.found(word)
        if len(self) >= CACHED_WORDS // 2:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def found(self, word: bytes) -> bytes:
        if word.isalpha():  # of ASCII letters alone
            low = word.lower()
            ids = self[low] if low != word else self.merged(word.decode())
        else:
            letters = word.rstrip(_MARKS)
            if _latin(text := letters.decode()):
                if letters != word:
                    ids = self[letters] + self[word[len(letters) :]]
                else:
                    low = text.lower()
                    ids = self[low.encode()] if low != text else self.merged(word.decode("latin-1").translate(self.letters))
            else:
                ids = _packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        return ids

    def merged(self, letters: str) -> bytes:
        return _packed([t.id for t in self.merges(letters)])

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


#: Marks that are one part if they end a word, whatever letters stand before, and the first letter past those whose lower case is one letter's.
_MARKS, _LATIN_END = string.punctuation.encode(), "\u0130"


def _latin(text: str) -> bool:
    return text.isalpha() and max(text) < _LATIN_END


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@dataclass
class Packer:
    """Sequences as lists of pieces. What a block leaves open waits in `tail` for the next."""

    tiers: tuple[int, ...] = TIERS
    tail: list[tuple[object, int, int]] = field(default_factory=list)

    def pack(self, documents: list[tuple[object, int]], final: bool) -> Iterator[list[tuple[object, int, int]]]:
        """`documents`: (handle, ids). Yields sequences of (handle, first id, length); each is as long as a tier, but for those of the final rest."""
        top = self.tiers[0]
        short: list[tuple[int, int, object]] = []  # length, first id, handle: sorted, shorter than the longest tier
        for handle, n in documents:
            for first in range(0, n - n % top, top):
                yield [(handle, first, top)]
            if n % top:
                short.append((n % top, n - n % top, handle))
        short += [(length, first, handle) for handle, first, length in self.tail]
        self.tail = []
        short.sort(key=lambda s: s[0])
        while short:
            length, first, handle = short.pop()  # the longest sets the tier
            tier = next(t for t in reversed(self.tiers) if t >= length)
            sequence, gap = [(handle, first, length)], tier - length
            while gap and short:
                at = bisect.bisect_right(short, gap, key=lambda s: s[0]) - 1
                if at >= 0:  # the longest that fits
                    length, first, handle = short.pop(at)
                    sequence.append((handle, first, length))
                    gap -= length
                else:  # none fits: the shortest is cut, its rest stays
                    length, first, handle = short.pop(0)
                    sequence.append((handle, first, gap))
                    bisect.insort(short, (length - gap, first + gap, handle), key=lambda s: s[0])
                    gap = 0
            if not gap:
                yield sequence
            elif not final:
                self.tail += sequence
            else:
                yield from _powers(sequence)


def _powers(pieces: list[tuple[object, int, int]]) -> Iterator[list[tuple[object, int, int]]]:
    """The last open sequence, cut into sequences whose lengths are powers of two, the longest first."""
    left = sum(length for _, _, length in pieces)
    pieces = pieces[::-1]
    while left:
        size, sequence = 1 << left.bit_length() - 1, []
        left -= size
        while size:
            handle, first, length = pieces.pop()
            taken = min(size, length)
            sequence.append((handle, first, taken))
            if taken < length:
                pieces.append((handle, first + taken, length - taken))
            size -= taken
        yield sequence


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece: `doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`, `tier`, `step_group`.

    A document's ids are those of its words by the tokenizer file `tokenizer`, then `end_id`; a null or empty text has that alone. A task
    packs its own documents in blocks. Ids beyond whole sequences of the longest tier go to the shortest tier that holds
    them. There the longest rest opens a sequence; its gap is filled with the longest shorter rests that fit, and at last by
    cutting one. An open sequence waits for the next block. At the task's end its rest is cut into powers of two, so nothing
    is padded. `step_group` deals sequences out so that each group holds the longest tier's length in tokens: one long
    sequence, or two of half its length, and so on. Sequences are numbered within the task, the task's number in the upper bits. Rows that
    repeat are packed each. Memory holds one block's ids. Nothing is shuffled; an empty table gives no rows.
    """

    schema = to_arrow_schema(struct_of(SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = WordCache(tokenizer), Packer(tiers)
        base = TaskContext.get().partitionId() << 32
        end = end_id.to_bytes(4, "little")
        number = 0
        filled = dict.fromkeys([*tiers, 0], 0)  # ids so far by tier; 0 stands for the rest
        step = {}

        def flush(block: list[tuple[object, bytes]], final: bool) -> pa.RecordBatch:
            nonlocal number
            out: list[list] = [[] for _ in schema]
            for sequence in packer.pack([((doc_id, ids), len(ids) // 4) for doc_id, ids in block], final):
                total = sum(length for _, _, length in sequence)
                tier = total if total in filled else 0
                if filled[tier] % tiers[0] == 0 or tier not in step:
                    step[tier] = base + number
                filled[tier] += total
                offset = 0
                for (doc_id, ids), first, length in sequence:
                    row = (doc_id, first, length, crc32(ids[4 * first : 4 * (first + length)]), len(ids) // 4, base + number, offset, total, step[tier])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    offset += length
                number += 1
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

        block: list[tuple[object, bytes]] = []
        for batch in sliced(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block.append((doc_id, words.ids(text or "") + end))
                if len(block) >= BLOCK:
                    yield flush(block, False)
                    block = []
        yield flush(block, True)

    return map_batches(docs.select("doc_id", "text"), run, struct_of(SCHEMA))


def default_tokenizer() -> str:
    """The public vocabulary that the registered query names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
