"""License scans: phrases, and an exact set-similarity join of text blocks with a table of
templates, in built-in functions only.

Words are the runs of letters, digits and characters from U+0080 on, with A-Z lower-cased.

**Phrases.** Places where the words of a phrase stand consecutively.

**Similarity join.** A text's blocks are windows of twice a template's size in words, moved
on by its size, so any passage of that size lies whole in one block. A block matches when it
holds at least ``threshold`` of the template's distinct words, that is ``need`` of them. The
words of all templates are put in one global order, rarest first by their count over all
documents, and the join is filtered as usual for such joins:

- prefix: a match has one of the template's first ``size - need + 1`` words in that order, so the
  words of texts are joined with those of the templates' prefixes, and only blocks around such
  places are candidates;
- length: a block has at least ``need`` distinct words;
- position: a candidate is judged for the first of the template's words that it holds; that word's
  place ``i`` leaves ``size - i`` words that can be shared, which has to reach ``need``.

What is left is verified by the complete overlap; no matching block is lost. Templates are rows of a
table (given as a list, or as a DataFrame with ``label`` and ``text``): the plan does not grow with
them. Their words are the small side of both joins, broadcast by Spark while they are; only the
blocks' verdicts are shuffled, folded by document, and never texts.

Nulls: a NULL text has no words; templates without a label or words take no part. Repeated rows each
give a row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logonlens.llm.common import cut, lower_ascii

# Phrases and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Statements of public licences and the words of whole short ones, with their labels.
TEMPLATES = (
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met redistributions of source code must retain the above copyright notice this "
            "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
            "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
            "materials provided with the distribution this software is provided by the copyright holders and contributors "
            "as is and any express or implied warranties including but not limited to the implied warranties of "
            "merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or "
            "contributors be liable for any direct indirect incidental special exemplary or consequential damages including "
            "but not limited to procurement of substitute goods or services loss of use data or profits or business "
            "interruption however caused and on any theory of liability whether in contract strict liability or tort "
            "including negligence or otherwise arising in any way out of the use of this software even if advised of the "
            "possibility of such damage"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies the software "
            "is provided as is and the author disclaims all warranties with regard to this software including all implied "
            "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
            "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
            "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
            "performance of this software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
            "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the software the "
            "software is provided as is without warranty of any kind express or implied including but not limited to the "
            "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
            "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
            "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
            "in the software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable for any damages arising from the use of this software permission is granted to anyone to use this "
             "software for any purpose including commercial applications and to alter it and redistribute it freely subject "
             "to the following restrictions the origin of this software must not be misrepresented you must not claim that "
             "you wrote the original software if you use this software in a product an acknowledgment in the product "
             "documentation would be appreciated but is not required altered source versions must be plainly marked as such "
             "and must not be misrepresented as being the original software this notice may not be removed or altered from "
             "any source distribution"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)
THRESHOLD = 0.8
NOT_IN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(lowered: Column) -> Column:
    return F.filter(F.split(lowered, NOT_IN_WORDS), lambda w: w != "")


def template_table(docs: DataFrame, templates: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """``t, label, text`` of every template that has a label and words."""
    if not isinstance(templates, DataFrame):
        templates = docs.sparkSession.createDataFrame(list(templates), "label string, text string")
    own = templates.select("label", lower_ascii(F.col("text")).alias("text"))
    return own.distinct().where(F.col("label").isNotNull() & (F.size(words_of(F.col("text"))) > 0)) \
        .withColumn("t", F.sha2(F.concat_ws("/", "label", "text"), 256))


def ordered_templates(words: DataFrame, templates: DataFrame, threshold: float) -> DataFrame:
    """``t, label, size, need, ordered`` (distinct words, rarest first over all of ``words``)."""
    own = templates.select("t", "label", F.size(words_of(F.col("text"))).alias("size"), F.explode(
        F.array_distinct(words_of(F.col("text")))).alias("w"))
    vocabulary = own.select("w").distinct()
    counts = words.select(F.explode("words").alias("w")).join(F.broadcast(vocabulary), "w").groupBy("w") \
        .agg(F.count(F.lit(1)).alias("n"))
    listed = own.join(counts, "w", "left").groupBy("t", "label", "size").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "w"))).alias("by_count"))
    ordered = F.transform("by_count", lambda x: x["w"])
    return listed.select("t", "label", "size", F.ceil(F.lit(threshold) * F.size("by_count") - F.lit(1e-9)).cast("int").alias("need"),
                         ordered.alias("ordered"))


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def phrase_places(words: str, phrase: Sequence[str]) -> Column:
    """Starts (from 0) of the places where the phrase's words stand consecutively."""
    def here(i):
        same = F.lit(True)
        for k, w in enumerate(phrase):
            same = same & (F.get(words, i + k) == w)
        return same

    return F.when(F.size(words) >= len(phrase), F.filter(
        F.sequence(F.lit(0), F.size(words) - len(phrase)), here)).otherwise(F.array().cast("array<int>"))


def matches(texts: DataFrame, ordered: DataFrame, threshold: float, key: Sequence[str]) -> DataFrame:
    """``key..., label, share``: templates that a block of a text (``key``, ``words``) holds enough
    of, with the largest share. ``ordered``: a written table of :func:`ordered_templates`."""
    prefix = ordered.select("*", F.posexplode(F.slice("ordered", F.lit(1), F.size("ordered") - F.col("need") + 1)).alias("place", "w"))
    hits = texts.select(*key, "words", F.posexplode("words").alias("i", "w")).join(prefix, "w")
    # the block that starts before the hit, and the one before that
    block = F.floor(F.col("i") / F.col("size")).cast("int") * F.col("size")
    blocks = hits.withColumn("start", F.explode(F.when(block > 0, F.array(block, block - F.col("size"))).otherwise(F.array(block))))
    blocks = blocks.select(*key, "label", "need", "place", "ordered", F.array_distinct(
        F.slice("words", F.col("start") + 1, 2 * F.col("size"))).alias("block"))
    possible = (F.size("block") >= F.col("need")) & (F.size("ordered") - F.col("place") >= F.col("need")) \
        & ~F.arrays_overlap(F.slice("ordered", F.lit(1), F.col("place")), "block")
    share = F.size(F.array_intersect("ordered", "block")) / F.size("ordered")
    return blocks.where(possible).select(*key, "label", share.alias("share")).where(F.col("share") >= threshold - 1e-9) \
        .groupBy(*key, "label").agg(F.max("share").alias("share"))


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 phrases: Sequence[tuple[str, str]] = PHRASES,
                 templates: Sequence[tuple[str, str]] | DataFrame = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``df``: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``. ``score`` is the largest containment of a template whose
    label is given (1 where a phrase stands, 0 where nothing is found)."""
    lowered = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(lowered).alias("text_hash"),
                     words_of(lowered).alias("words"))
    ordered = cut(ordered_templates(docs, template_table(docs, templates), threshold), "license-templates")
    key = ["doc_id", "text_hash"]
    best = matches(docs, ordered, threshold, key).groupBy(*key).agg(
        F.collect_set("label").alias("near"), F.max("share").alias("share"))
    best = best.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "near", "share")

    # a phrase stands only where its last word does
    worth = F.arrays_overlap("words", _strings(sorted({p.split()[-1] for p, _ in phrases})))
    found = docs.select(*key, F.size("words").cast("long").alias("n_words"), F.when(worth, F.col("words")).alias("words"))
    places = F.array(*[phrase_places("words", p.split()) for p, _ in phrases])
    found = found.withColumn("places", F.when(F.col("words").isNotNull(), places)).drop("words")
    base = F.filter(F.array(*[F.when(F.size(F.get("places", k)) > 0, F.lit(label))
                              for k, (_, label) in enumerate(phrases)]), lambda x: x.isNotNull())
    found = found.withColumn("base", F.array_distinct(F.coalesce(base, F.array().cast("array<string>")))) \
        .withColumn("starts", F.flatten("places")).drop("places")
    found = found.join(best, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    labels = F.array_union("base", F.coalesce("near", F.array().cast("array<string>")))
    return found.select(
        "doc_id", "n_words", F.coalesce(F.size("starts"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
