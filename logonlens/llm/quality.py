"""Quality rules and distribution divergence, in built-in functions only.

**Rules.** Word and symbol counts, repeated lines and repeated 8-word windows of each whole
text (a word is a run of other characters than space and \\x09-\\x0D). A text fails with
fewer than ``MIN_WORDS`` words, or when over ``MAX_REPEAT_PERCENT`` of its words lie in
windows that occur more than once in it.

**Divergence.** For every language two references are counted over all its documents: the
shares of character classes, and the shares of its most common short words among all words
(every word counts; those not listed are one class of their own). A text is held against its
language's references by the Jensen-Shannon distance (base 2, 0 to 1). The word distance is
measured in that of a text with none of the listed words, so a text without any common word
is far in every language. Texts below a minimum length are not judged by it, since short
histograms are noise.

A text without ``lang`` is held against the nearest language, the one with the most of its
common words in the text (ties: the smaller name), or where it holds none of any language,
against all documents taken together.

What the rules and histograms need of a text is written once, as a row of small columns, and
the references and the verdicts are made from those. The references are one row per language,
for all languages, written before they are joined: their size is then known, and Spark
broadcasts them while they are small (texts are not shuffled) and else joins by a shuffle on
``lang``. The result can be filtered on any column at no further cost.

Nulls: a NULL text has no words (and fails); a NULL lang see above. Repeated rows each
give a row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logonlens.llm.common import cut

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Character classes by the letter that stands for them in a coded text. Lower-case letters are
# counted apart, all other ASCII characters are one class, all beyond ASCII another.
CODED = {"U": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "D": "0123456789", "S": " \t\n\x0b\f\r", "Y": SYMBOLS, "P": ".,;:!?"}
CODED["O"] = "".join(chr(k) for k in range(128) if not chr(k).islower() and chr(k) not in "".join(CODED.values()))
CLASS_NAMES = ["upper", "lower", "digit", "space", "symbol", "stop", "wide", "other"]
COMMON_WORDS = 32            # common words of a language's reference
COMMON_CHARS = 5             # they have at most so many letters
COMMON_SHARE = 1e-4          # and at least this share of all words, so 10,000 at most compete
# Minimum lengths and largest distances (of words: in that of a text with no common word).
MIN_CHARS_JUDGED = 200
MIN_WORDS_JUDGED = 50
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.90


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _counts(df: DataFrame, keep: list[str]) -> DataFrame:
    """The base counts of every text, and its short words for the common-word histogram.

    Windows (8 words: three doublings) are compared by a 64-bit hash of their words' hashes. Only texts that repeat a
    window are sorted: equal windows then stand side by side, and the words they cover are
    summed over their sorted starts, so the cost is n log n for any text."""
    df = df.withColumn("words", words_of(F.col("text")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != ""))
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("words")

    def joined(hashes: str, step: int) -> Column:
        """Hashes of twice as many words: each with the one ``step`` places on."""
        size = F.greatest(F.lit(0), F.size(hashes) - step)
        return F.zip_with(F.slice(hashes, 1, size), F.slice(hashes, step + 1, size), lambda x, y: F.xxhash64(x, y))

    step = 1
    df = df.withColumn("windows", F.col("hashes"))
    while step < WINDOW:
        df = df.withColumn(f"windows{step}", joined("windows" if step == 1 else f"windows{step // 2}", step))
        step *= 2
    df = df.withColumn("windows", F.col(f"windows{step // 2}"))
    df = df.withColumn("pairs", F.when(
        F.size("windows") > F.size(F.array_distinct("windows")),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("starts", F.sort_array(F.transform(F.filter(
        F.transform("pairs", lambda p, j: F.struct(
            p["i"].alias("i"),
            (F.coalesce(p["h"] == F.get("pairs", j - 1)["h"], F.lit(False))
             | F.coalesce(p["h"] == F.get("pairs", j + 1)["h"], F.lit(False))).alias("twice"))),
        lambda p: p["twice"]), lambda p: p["i"])))
    repeat = F.aggregate(
        F.transform("starts", lambda s, j: F.when(j == 0, F.lit(WINDOW)).otherwise(
            F.least(F.lit(WINDOW), s - F.get("starts", j - 1)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    text = F.col("text")
    return df.select(
        *keep, F.length(text).cast("long").alias("n_chars"), n.cast("long").alias("n_words"),
        (F.length(text) - F.get("own_classes", CLASS_NAMES.index("space"))).cast("long").alias("word_chars"),
        F.get("own_classes", CLASS_NAMES.index("symbol")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeat, F.lit(0)).alias("n_repeat_words"),
        short_words(F.col("words")).alias("short"))


def with_classes(df: DataFrame, name: str) -> DataFrame:
    """Adds the characters of each class of ``text`` (long each, as CLASS_NAMES). Lower-case
    letters are most of a text; what is left without them is recoded, a letter for each class,
    and a class has as many characters as the recoded rest loses with its letter."""
    rest = F.regexp_replace("text", "[a-z]+", "")
    df = df.withColumn("rest", F.translate(rest, "".join(CODED.values()), "".join(k * len(v) for k, v in CODED.items())))
    size = F.length("rest")
    n = {k: size - F.length(F.replace(F.col("rest"), F.lit(k), F.lit(""))) for k in CODED}
    df = df.withColumn("in_classes", F.array(n["U"], F.length("text") - size, n["D"], n["S"], n["Y"], n["P"], n["O"]))
    wide = F.length("text") - F.aggregate("in_classes", F.lit(0), lambda a, x: a + x)
    return df.withColumn(name, F.concat(F.slice("in_classes", 1, 6), F.array(wide), F.slice("in_classes", 7, 1))
                         .cast("array<long>")).drop("rest", "in_classes")


def short_words(words: Column) -> Column:
    """The lower-cased words of few letters between marks, which may be common ones, each
    between two spaces of its own, in one string."""
    bare = F.transform(words, lambda w: F.lower(F.btrim(w, F.lit(".,;:!?|"))))
    short = F.filter(bare, lambda w: F.length(w).between(1, COMMON_CHARS))
    return F.when(F.size(short) > 0, F.concat(F.lit(" "), F.array_join(short, "  "), F.lit(" "))).otherwise(F.lit(""))


def listed(short: Column) -> Column:
    """The words of such a string."""
    return F.split(F.substring(short, 2, 2147483647), " (?: |$)")


def references(texts: DataFrame) -> DataFrame:
    """``lang, classes, common, shares, no_hit``: one row for each language, from all its texts
    (``texts``: lang, own_classes, n_words, short), and one with a NULL lang from all texts.
    ``classes`` and ``shares`` are shares; ``shares`` has one more entry than ``common``: all
    other words. ``no_hit`` is the distance of a text that has only those."""
    k = len(CLASS_NAMES)
    by_lang = texts.groupBy("lang").agg(*[F.sum(F.get("own_classes", i)).alias(f"c{i}") for i in range(k)],
                                        F.sum("n_words").alias("total"))
    counted = texts.where(F.col("short") != "").select("lang", F.explode(listed(F.col("short"))).alias("word")) \
        .where("word != ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("c"))
    # the languages, and all texts together from their sums
    sums = by_lang.where("lang IS NOT NULL").unionByName(by_lang.agg(
        F.lit(None).cast("string").alias("lang"), *[F.sum(c).alias(c) for c in by_lang.columns if c != "lang"]))
    counted = counted.where("lang IS NOT NULL").unionByName(counted.groupBy("word").agg(F.sum("c").alias("c"))
                                                            .withColumn("lang", F.lit(None).cast("string")))
    totals = sums.select(F.col("lang").alias("l"), "total")
    # at least COMMON_SHARE of a language's words each: 1 / COMMON_SHARE rows at most
    best = counted.join(totals, F.col("lang").eqNullSafe(F.col("l"))).where(F.col("c") >= COMMON_SHARE * F.col("total")) \
        .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("c"), "word"))) \
        .where(F.col("r") <= COMMON_WORDS)
    common = best.groupBy(F.col("lang").alias("l")).agg(
        F.sort_array(F.collect_list(F.struct("r", "word", "c"))).alias("list"))
    out = sums.join(common, F.col("lang").eqNullSafe(F.col("l")), "left").where("total IS NOT NULL")
    in_list = F.transform("list", lambda x: x["c"].cast("double"))
    out = out.withColumn("length", sum(F.col(f"c{i}") for i in range(k))).withColumn("words", F.coalesce(F.array_append(
        in_list, F.col("total") - F.aggregate(in_list, F.lit(0.0), lambda a, x: a + x)), F.array(F.col("total").cast("double"))))
    out = out.select(
        "lang", F.array(*[F.col(f"c{i}") / F.nullif("length", F.lit(0)) for i in range(k)]).alias("classes"),
        F.coalesce(F.transform("list", lambda x: x["word"]), F.array().cast("array<string>")).alias("common"),
        F.transform("words", lambda x: x / F.nullif("total", F.lit(0))).alias("shares"))
    none = F.transform("shares", lambda x, i: F.when(i == F.size("common"), F.lit(1)).otherwise(F.lit(0)))
    return out.withColumn("no_hit", js_distance(none, F.lit(1), F.col("shares")))


def js_distance(counts: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of the histogram ``counts`` of ``total`` entries and the shares of
    another one; NULL when either is empty."""
    def part(a, b):
        return F.when(a > 0, a * F.log2(F.lit(2.0) * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(counts, shares, lambda c, r: part(c / total, r) + part(r, c / total))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.when((total > 0) & F.get(shares, 0).isNotNull() & divergence.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), divergence)))


def word_histogram(short: str, common: str, n_words: str) -> Column:
    """How often each word of ``common`` stands in the string ``short``, and all other words.
    A word's count is what the string loses with it, by its length and two spaces."""
    held = F.transform(common, lambda w: ((F.octet_length(short) - F.octet_length(F.replace(
        F.col(short), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.octet_length(w) + 2)).cast("double"))
    return F.array_append(held, F.col(n_words) - F.aggregate(held, F.lit(0.0), lambda a, x: a + x))


def nearest_languages(texts: DataFrame, refs: DataFrame) -> DataFrame:
    """``texts`` without ``lang`` with that of the nearest reference as ``ref_lang`` (NULL: none)."""
    words = refs.where("lang IS NOT NULL").select(F.col("lang").alias("near"), F.explode("common").alias("word"))
    own = texts.where("short != ''").select("short").distinct() \
        .select("short", F.explode(F.array_distinct(listed(F.col("short")))).alias("word"))
    hits = own.join(words, "word").groupBy("short", "near").agg(F.count(F.lit(1)).alias("n"))
    found = hits.groupBy(F.col("short").alias("of")).agg(F.min(F.struct(-F.col("n"), "near"))["near"].alias("ref_lang"))
    return texts.join(found, F.col("short") == F.col("of"), "left").drop("of")


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``df``: its id, the base counts, ``base_failed``, both
    distances (NULL where not judged) and ``kept``; ``keep`` names further columns of ``df``
    to hand on as ``row`` (a struct)."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     F.col(lang_col).alias("lang"), *([F.struct(*keep).alias("row")] if keep else []))
    carried = ["doc_id", *(["row"] if keep else [])]
    texts = cut(_counts(with_classes(docs, "own_classes"), [*carried, "lang", "own_classes"]), "quality-texts")
    refs = cut(references(texts), "quality-references")
    with_ref = texts.where("lang IS NOT NULL").withColumn("ref_lang", F.col("lang")) \
        .unionByName(nearest_languages(texts.where("lang IS NULL"), refs))
    judged = with_ref.join(refs.withColumnRenamed("lang", "l"), F.col("ref_lang").eqNullSafe(F.col("l")), "left")
    judged = judged.withColumn("own_words", F.when(F.col("n_words") >= MIN_WORDS_JUDGED,
                                                   word_histogram("short", "common", "n_words")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = judged.select(
        *carried, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        F.when(F.col("n_chars") >= MIN_CHARS_JUDGED,
               js_distance(F.col("own_classes"), F.col("n_chars"), F.col("classes"))).alias("char_distance"),
        (js_distance(F.col("own_words"), F.col("n_words"), F.col("shares"))
         / F.nullif(F.col("no_hit"), F.lit(0.0))).alias("word_distance"))
    far = (F.coalesce(F.col("char_distance"), F.lit(0.0)) > MAX_CHAR_DISTANCE) \
        | (F.coalesce(F.col("word_distance"), F.lit(0.0)) > MAX_WORD_DISTANCE)
    out = out.withColumn("kept", ~F.col("base_failed") & ~far)
    # a filter on the result stays above the generator instead of repeating the expressions below
    return out.select(F.inline(F.array(F.struct(*out.columns))))
