import re
from collections import defaultdict
from zlib import crc32

import pytest

from plinth.llm import packing
from plinth.llm.packing import Packer, WordCache, default_tokenizer, pack

tokenizers = pytest.importorskip("tokenizers")


def ids_of(text):
    return [*tokenizers.Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_rebuild_every_document(spark):
    rows = [(i, ("The Thérapie's 12,5% —  don't <|endoftext|> ΑΣ ẍ " * (i % 40)) + f"w{i}\n\tend", "x", i) for i in range(300)]
    rows += [(None, None, "n", 0), (5000, "", "e", 1), (5001, "long " * 30_000, "l", 2), (7, "twice", "t", 3), (7, "twice", "t", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, offset int").repartition(3)
    got = pack(docs, default_tokenizer()).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.doc_id].append(r)
    padding = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= 2048
        padding += 0 if end & (end - 1) == 0 else 2048 - end
    assert padding == 0
    for i, text, *_ in rows:
        ids = ids_of(text)
        pieces = sorted(documents[i], key=lambda r: r.start)
        if i == 7 and text == "twice" or i == 7:
            continue
        end = 0
        for r in pieces:
            assert r.start == end and r.doc_tokens == len(ids)
            assert r.ids_crc32 == crc32(b"".join(x.to_bytes(4, "little") for x in ids[r.start : r.start + r.length]))
            end += r.length
        assert end == len(ids)
    assert sum(r.length for r in documents[7]) == 2 * len(ids_of("twice")) + len(ids_of(rows[7][1]))


def test_tiers_and_empty(spark):
    made = list(Packer().pack([("a", 700), ("b", 200), ("c", 120), ("d", 60), ("e", 3000), ("f", 250)], False))
    assert [sum(n for *_, n in s) for s in made if len(s) == 1] == [2048]
    assert all(sum(n for *_, n in s) in (2048, 1024, 512, 256) for s in made)
    assert pack(spark.createDataFrame([], "doc_id long, text string"), default_tokenizer()).count() == 0


def test_words_with_marks_at_their_end_go_to_the_merges():
    letters = ["word", "Word", "Éclair", "ß", "straße", "µ", "ª", "s", "t", "d", "re", "LL", "the"]
    marks = ["", ".", ",***", "'", "''", "%%%", "<|", "|>", "_", "\\", "!?\"", "'.'", "<|>", "-"]
    words = [w + m for w in letters for m in marks if w or m]
    whole = tokenizers.Tokenizer.from_file(default_tokenizer())
    cache = WordCache(default_tokenizer())
    for m in marks[1:]:
        cache[m.encode()]
    cache.tokenizer = None  # takes much longer for a word than the merges
    assert {w: cache.ids(w) for w in words} == {w: b"".join(i.to_bytes(4, "little") for i in whole.encode(w, add_special_tokens=False).ids) for w in words}
    cache = WordCache(default_tokenizer())
    odd = ["don't", "'s", "'st", "x's.", "<|endoftext|>", "a<|endoftext|>", "<|startoftext|>..", "ΑΣ.", "ΑΣ'", "ẍ,", "é.", "İ.", "e̸", "a1.", "1.", "日本。", "ﬁn.", "²!", "k.5", "﻿.", "a​."]
    assert {w: cache.ids(w) for w in odd} == {w: b"".join(i.to_bytes(4, "little") for i in whole.encode(w, add_special_tokens=False).ids) for w in odd}


def test_tasks_of_a_process_leave_no_memory_behind():
    from plinth.llm.arrow import given_back

    def left():
        words = WordCache(default_tokenizer())
        words.ids(" ".join(f"{i:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(100_000, 140_000)))
        del words
        given_back()
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024

    first = [left(), left()][-1]
    assert [left() for _ in range(4)][-1] < first + 10  # MB; four tokenizers left 24


def test_remembered_words_are_bounded_and_the_latest_stay(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    words = WordCache(default_tokenizer())
    text = " ".join(["The", "a,"] + [f"Wort{i} the" for i in range(200)])
    assert words.ids(text) == WordCache(default_tokenizer()).ids(text)
    assert [int.from_bytes(words.ids(text)[at : at + 4], "little") for at in range(0, len(words.ids(text)), 4)] == ids_of(text)[:-1]
    assert len(words) <= 12 and len(words.older) <= 12
    words.tokenizer = words.merges = None
    assert words.ids("Wort199 the")  # known without the tokenizer
