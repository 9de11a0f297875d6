"""Toxicity scores from a weighted lexicon, matched by Aho-Corasick over folded text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.llm.arrow import map_batches, map_rows, sliced, struct_of
from plinth.session import checkpointed

#: Letters of other scripts and forms that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i",
}
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Words that are toxic without any label, with their weight.
BASE_TERMS = dict.fromkeys((" idiot ", " moron ", " stupid ", " scum ", " loser ", " pathetic ", " worthless ", " disgusting "), 3.0)
#: Phrases in which a term counts for nothing.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "loser bracket", "stupid easy")
#: Lengths of the beginnings of words that may become terms, beside whole words.
PREFIXES = (4, 5, 6)
#: Words by which a text's length grows by 1. Labelled documents, of 4,256 words at most, do not tell 500 from 3000.
LONG = 2000

_TABLE = str.maketrans(HOMOGLYPHS | {chr(c): " " for c in range(128) if not chr(c).isalnum()} | {chr(0xFEE0 + c): chr(c) for c in range(ord("a"), ord("z") + 1)} | dict.fromkeys("«»“”‘’–—…¿¡ 　", " ") | dict.fromkeys("​‌‍­﻿"))
_WRITTEN_FOR = re.compile(r"[0134578@$!](?=[0134578@$!]*[^\W\d_])|(?<=[^\W\d_])[013457](?!\w)")


def fold(text: str) -> str:
    """Lower case, look-alikes and digits as the letters they stand for, one space at least around each word."""
    return f" {_WRITTEN_FOR.sub(lambda m: SUBSTITUTES[m[0]], text.lower()).translate(_TABLE)} "


def terms(folded: str) -> set[str]:
    """Whole words (a space on both sides) and beginnings of words (a space before)."""
    words = set(folded.split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in PREFIXES if len(w) >= n}


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        for term, weight in self.weights.items():
            made.add_word(term, (len(term), weight))
        made.make_automaton()
        return made


def score(text: str, automaton: ahocorasick.Automaton) -> float:
    """1 - exp(-weight / length), 0 without a term. Each word counts its heaviest term; the length is 1 and a further 1 for each LONG words."""
    folded = fold(text)
    if not len(automaton):
        return 0.0
    heaviest: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for at, (length, weight) in automaton.iter(folded):
        start = at - length + 1
        if weight:
            heaviest[start] = max(weight, heaviest.get(start, 0.0))
        else:
            excused.append((start, at))
    total, reach, passed = 0.0, -1, 0
    excused.sort()
    for start, weight in sorted(heaviest.items()):  # both lists once: `reach` is where the phrases that began so far end
        while passed < len(excused) and excused[passed][0] <= start:
            reach, passed = max(reach, excused[passed][1]), passed + 1
        total += weight if start >= reach else 0.0
    return 1 - math.exp(-total / (1 + len(folded.split()) / LONG)) if total else 0.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 2 when divided by 4. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, labels: DataFrame, sample: int = 8000, most: int = 4000, support: int = 3, precision: float = 0.95) -> Lexicon:
    """The lexicon of terms that stand in toxic documents alone, or nearly so.

    It is fitted on at most `sample` labelled rows outside `held_out`, those whose ids hash lowest. Terms are counted by
    document and label, partly in each task, then by aggregation. A term stays if at least `support` toxic documents hold
    it, `precision` of its documents are toxic, and the log-likelihood ratio passes twice the logarithm of the number of terms, which chance
    among so many rarely does. Its weight is the log-odds ratio, at most 6. All of that is worked out where the counts are; the `most` with the highest ratio go to the
    driver, with which it bounds the lexicon and what tasks are sent. A base term goes if less than `precision` of its labelled documents are toxic. Rows without label
    count for nothing; without labels the base terms are all.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")

    schema = to_arrow_schema(struct_of("term string, toxic int, n long"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = counts[int(toxic > 0)]
                own.update(terms(fold(text or "")))
                own[""] += 1
            for toxic, own in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32()), pa.array(list(own.values()), pa.int64())], schema=schema)

    pairs = map_batches(rows, counted, "term string, toxic int, n long").groupBy("term").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).alias("pos"), F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).alias("neg")
    )
    counts = checkpointed(pairs)
    whole = counts.where("term = ''").first()
    all_pos, all_neg = (whole.pos, whole.neg) if whole else (0, 0)
    precise = F.col("pos") >= precision * (F.col("pos") + F.col("neg"))
    untrue = {r.term for r in counts.where(F.col("term").isin(*BASE_TERMS) & ~precise).collect()}
    base = {term: weight for term, weight in BASE_TERMS.items() if term not in untrue}
    if not all_pos:
        return Lexicon(base)
    strong = counts.where((F.col("term") != "") & (F.col("pos") >= support) & precise)
    least = 2 * math.log(max(2, strong.count() * 20))
    share = (F.col("pos") + F.col("neg")) / F.lit(float(all_pos + all_neg))
    part = lambda n, total: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / (F.lit(float(total)) * share))).otherwise(0.0)
    weight = F.log((F.col("pos") + 0.5) / (all_pos + 1)) - F.log((F.col("neg") + 0.5) / (all_neg + 1))
    ranked = strong.select("term", (2 * (part("pos", all_pos) + part("neg", all_neg))).alias("ratio"), weight.alias("weight")).where((F.col("ratio") >= least) & (F.col("weight") > 0))
    return Lexicon(base | {r.term: min(6.0, r.weight) for r in ranked.orderBy(F.desc("ratio"), "term").limit(most).collect()})


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `score` (0 to 1), `predicted` (1 from `threshold` on).

    Only the text enters the score; equal texts score alike. A null or empty text scores 0. Rows that repeat give a row each.
    """

    def make() -> Callable[[list], list]:
        automaton = lexicon.automaton()

        def work(columns: list) -> list:
            ids, held, texts = columns
            scores = [score(t or "", automaton) for t in texts]
            return [ids, held, scores, [int(s >= threshold) for s in scores]]

        return work

    return map_rows(docs.select("doc_id", held_out().alias("held_out"), "text"), make, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with all their columns."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in sliced(batches):
            yield batch.filter(pa.array([score(t or "", automaton) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_batches(docs, run, schema)
