"""License scans by diagonal voting over word bigrams. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.session import checkpointed

#: A word is a run of ASCII digits, lower-case letters and all that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that give a label wherever they stand.
PHRASES = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
#: Notices that give a label where enough of them stands on neighbouring diagonals.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
)
#: Part of a notice's bigrams that a label asks for, and how far apart diagonals may lie that are one.
LEAST, GAP = 0.8, 2
#: Part of a notice's bigrams that another one has from which on their words tell them apart.
ALIKE = 0.5
#: Words that no notice has, and that make another license of one they stand in.
FOREIGN = ("nd",)


def templates(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Every bigram of every template with its position. Its size is that of the two lists, so it may be broadcast."""
    rows = [(label, base, at, len(words) - 1, a, b) for base, listed in ((True, phrases), (False, notices)) for label, text in listed for words in [text.split()] for at, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    one = [F.struct(F.lit(label).alias("label"), F.lit(base).alias("base"), F.lit(at).alias("at"), F.lit(n).alias("n"), F.lit(a).alias("a"), F.lit(b).alias("b")) for label, base, at, n, a, b in rows]
    # each document has one pair of empty words, which keeps it among the hits when it has no others
    none = F.struct(F.lit(None).cast("string").alias("label"), F.lit(False).alias("base"), F.lit(0).alias("at"), F.lit(1).alias("n"), F.lit("").alias("a"), F.lit("").alias("b"))
    table = docs.sparkSession.range(1).select(F.explode(F.array(*one, none)).alias("t")).select("t.*")
    return table.withColumn("gram", F.xxhash64("a", "b"))


def _bigrams(docs: DataFrame) -> DataFrame:
    """`row`, `doc_id`, `n_words`, `pos`, `a`, `b` and their hash `gram`: each word with the one after it, and one pair of empty words a row."""
    words = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("doc_id"), F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(WORD), F.lit(0)).alias("words"))
    pairs = F.expr("concat(array(struct('' as a, '' as b)), zip_with(words, slice(words, 2, greatest(size(words) - 1, 0)), (a, b) -> struct(a, b)))")
    grams = words.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), pairs.alias("pairs")).select("row", "doc_id", "n_words", F.posexplode("pairs").alias("pos", "pair"))
    return grams.select("row", "doc_id", "n_words", (F.col("pos") - 1).alias("pos"), F.col("pair.a").alias("a"), F.col("pair.b").alias("b")).withColumn("gram", F.xxhash64("a", "b"))


def scan_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    All rolling word bigrams join the templates' bigrams by hash, and both words are compared, so a hit is exact. A hit votes for the
    diagonal that is its place less its place in the template. A phrase stands where all its bigrams share one diagonal. For a notice,
    diagonals at most 2 apart are merged, so that a word more or less does no harm, and the label is given from 80 % of
    its bigrams on. `score` is the largest such part over all templates; `base_labels` and `labels` are distinct, sorted
    and comma-joined. Upper-case letters count as lower-case. A null or wordless text has no labels, null first and last words and a
    score of 0. Repeated rows each give a row. The bigrams join before any shuffle; what is shuffled is the hits.
    """
    hits = _bigrams(docs).join(F.broadcast(templates(docs, phrases, notices)), ["gram", "a", "b"])
    votes = hits.groupBy("row", "doc_id", "n_words", "label", "base", "n", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("at"))
    along = Window.partitionBy("row", "label", "base").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.when(F.col("base"), 0).otherwise(GAP), F.lit(True))
    bands = votes.withColumn("apart", apart).withColumn("band", F.sum(F.col("apart").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    spans = bands.groupBy("row", "doc_id", "n_words", "label", "base", "n", "band").agg(
        F.min("diagonal").cast("long").alias("start"), (F.size(F.array_distinct(F.flatten(F.collect_list("at")))) / F.col("n")).alias("part")
    )
    phrase = F.col("label").isNotNull() & F.col("base") & (F.col("part") == 1)
    notice = F.col("label").isNotNull() & ~F.col("base") & (F.col("part") >= LEAST)
    joined = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return (
        spans.groupBy("row", "doc_id", "n_words")
        .agg(
            F.count(F.when(phrase, 1)).alias("n_base"),
            F.min(F.when(phrase, F.col("start"))).alias("first_word"),
            F.max(F.when(phrase, F.col("start"))).alias("last_word"),
            joined(phrase).alias("base_labels"),
            joined(phrase | notice).alias("labels"),
            F.max(F.when(F.col("label").isNull(), 0.0).otherwise(F.col("part"))).alias("score"),
        )
        .drop("row")
    )


def telling(notices=NOTICES) -> dict[str, tuple[list[int], list[str]]]:
    """For each label the places of the words that its notice must keep, and the words that must not stand in it.

    Numbers must be kept; so must the words that a notice like it lacks, and that notice's own words must not stand there.
    """
    words = {label: text.split() for label, text in notices}
    grams = {label: set(zip(w, w[1:], strict=False)) for label, w in words.items()}
    found = {}
    for label, own in words.items():
        like = [set(words[o]) for o in words if o != label and len(grams[label] & grams[o]) >= ALIKE * len(grams[label])]
        kept = [at for at, w in enumerate(own) if w.isdigit() or any(w not in o for o in like)]
        found[label] = (kept, sorted(set().union(FOREIGN, *like) - set(own)))
    return found


def _by_label(values: dict[str, list], kind: str) -> Column:
    pairs = [x for label, listed in values.items() for x in (F.lit(label), F.array(*map(F.lit, listed)).cast(kind))]
    return F.element_at(F.create_map(*pairs), F.col("label")) if pairs else F.array().cast(kind)


def verified_spans(hits: DataFrame, notices=NOTICES) -> DataFrame:
    """Where notices stand: `row`, `label`, `start`, `stop`, `hits`, `part`, of the rows that `verified_licenses` finds.

    From each hit goes the longest chain of hits whose places ascend in the text and in the notice. It keeps within GAP diagonals of its first
    hit, takes no more words than the notice and GAP, holds LEAST of the bigrams and all words to be kept, and none of
    another notice's. Of spans that share over half their words, the one of the notice with the most hits stays.
    """
    rules = telling(notices)
    reach = max((len(text.split()) for _, text in notices), default=0) + GAP
    ahead = lambda *by: Window.partitionBy(*by).orderBy("pos").rangeBetween(0, reach - 1)
    rows = hits.withColumn("marks", F.collect_set(F.when(F.col("mark").isNotNull(), F.struct("pos", "mark"))).over(ahead("row"))).where("not base and label is not null")
    rows = rows.withColumn("rest", F.collect_list(F.struct("pos", "at")).over(ahead("row", "label"))).where(F.size("rest") / F.col("n") >= LEAST)
    rows = rows.withColumns({"kept": _by_label({k: v[0] for k, v in rules.items()}, "array<int>"), "other": _by_label({k: v[1] for k, v in rules.items()}, "array<string>")})
    near = F.expr(f"array_sort(filter(rest, x -> x.pos > pos and x.at > at and x.pos - pos < n + {GAP} and abs(x.pos - x.at - pos + at) <= {GAP}))")
    rows = rows.withColumn("rest", near).where((F.size("rest") + 1) / F.col("n") >= LEAST)
    longest = "array_max(transform(filter(acc, c -> element_at(c, -1).pos < x.pos and element_at(c, -1).at < x.at), c -> struct(size(c) as k, c as c))).c"
    rows = rows.withColumn("chains", F.expr(f"aggregate(rest, array(array(struct(pos as pos, at as at))), (acc, x) -> concat(acc, array(concat({longest}, array(x)))))"))
    right = f"""size(c) / n >= {LEAST} and forall(kept, k -> exists(c, x -> x.at = k or x.at = k - 1))
        and not exists(marks, m -> m.pos <= element_at(c, -1).pos + 1 and array_contains(other, m.mark))"""
    best = F.expr(f"array_max(transform(filter(chains, c -> {right}), c -> struct(size(c) as hits, element_at(c, -1).pos + 2 as stop)))")
    spans = rows.withColumn("best", best).where("best is not null").select("row", "label", F.col("pos").alias("start"), "best.stop", "best.hits", (F.col("best.hits") / F.col("n")).alias("part"))
    beside = F.collect_list(F.struct("label", "start", "stop", "hits", "part")).over(Window.partitionBy("row").orderBy("start").rangeBetween(-reach, reach))
    better = "o.hits > hits or o.hits = hits and (o.part > part or o.part = part and o.label < label)"
    beaten = f"exists(beside, o -> o.label <> label and 2 * (least(o.stop, stop) - greatest(o.start, start)) > stop - start and ({better}))"
    return spans.withColumn("beside", beside).where(f"not {beaten}").drop("beside")


def verified_licenses(docs: DataFrame, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """The columns of `scan_licenses`, but a notice gives its label only where `verified_spans` finds it. `score` is the largest part among
    phrases that stand and verified spans."""
    marks = sorted({w for _, others in telling(notices).values() for w in others})
    found = _bigrams(docs).join(F.broadcast(templates(docs, phrases, notices)), ["gram", "a", "b"], "left").withColumn("mark", F.when(F.col("a").isin(marks), F.col("a")))
    found = checkpointed(found.where("n is not null or mark is not null").select("row", "doc_id", "n_words", "pos", "label", "base", "at", "n", "mark"))
    every = found.where("pos < 0").select("row", "doc_id", "n_words")
    whole = found.where("base and label is not null").groupBy("row", "label", "n", (F.col("pos") - F.col("at")).alias("start")).agg(F.count_distinct("at").alias("hits")).where("hits = n")
    stands = whole.select("row", "label", "start", F.lit(1.0).alias("part"), F.lit(True).alias("base")).union(verified_spans(found, notices).select("row", "label", "start", "part", F.lit(False)))
    joined = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    base = F.col("base")
    known = stands.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start").cast("long"))).alias("first_word"),
        F.max(F.when(base, F.col("start").cast("long"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.lit(True)).alias("labels"),
        F.max("part").alias("score"),
    )
    return every.join(known, "row", "left").drop("row").fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0})
