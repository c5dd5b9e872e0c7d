"""Quality rules by distribution divergence (DataFrame expressions only).

A document is compared with the reference of its language, learned from all documents: the
histogram of character classes, and the histogram of the language's most common words (all other
words fall into one further bin). The distance is Jensen-Shannon (base 2, 0 to 1). Texts shorter
than the minimum lengths are not judged by their histograms, which would be noise.

* Null text has no words; it and every text under ``MIN_WORDS`` words fails the base rules.
* A null language is a language of its own. Repeated rows each get their row. An empty table
  gives an empty result. Result columns replace columns of the same names, others are kept.
* Ties among common words are ordered by the word, so reruns agree.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.plan import with_columns_once
from .common import BLANKS, GAP, WORD, fresh, join_sized, let, settle

MIN_WORDS = 50          # base rule and guard of the word histogram
MIN_CHARS = 200         # guard of the character histogram
N_COMMON = 24           # common words of a language's reference
MAX_CHAR_JSD = 0.3
MAX_WORD_JSD = 0.4
SYMBOLS = "#*$%&|<>"

# Character classes, each mapped to one stand-in; everything else (accented letters and the rest) is "other".
CLASSES = {"a": string.ascii_lowercase, "A": string.ascii_uppercase, "0": string.digits, " ": BLANKS,
           ".": ".,;:!?'\"()-", "#": SYMBOLS}
_PLACE = {k: i for i, k in enumerate(CLASSES)}
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _classes(text: Column) -> Column:
    src = "".join(CLASSES.values())
    dst = "".join(k * len(v) for k, v in CLASSES.items())
    return F.translate(text, src, dst)


def _class_counts(mapped: Column) -> Column:
    """Characters of each class, then of none of them. The first class, most of any text, is taken
    out first, so that the others are looked for in what is left."""
    first, *others = CLASSES

    def without(x, k):
        return F.replace(x, F.lit(k), F.lit(""))

    def gone(x, k):  # stand-ins are one byte each
        return (F.octet_length(x) - F.octet_length(without(x, k))).cast("double")

    def rest_counts(rest):
        n = let(F.array(*[gone(rest, k) for k in others]), lambda c: F.concat(c, F.array(
            F.length(rest).cast("double") - F.aggregate(c, F.lit(0.0), lambda a, x: a + x))))
        return F.concat(F.array((F.octet_length(mapped) - F.octet_length(rest)).cast("double")), n)

    return let(without(mapped, first), rest_counts)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _after(x: Column, k: int) -> Column:
    """An array without its first k items."""
    return F.slice(x, k + 1, F.size(x))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice. Windows are compared by a 64-bit hash
    of their words' hashes (each word is hashed once), sorted with their places: O(n log n) for any
    text; texts without a repeated window stop early."""
    def windows(h):
        pairs = F.zip_with(h, _after(h, 1), lambda a, b: F.xxhash64(a, b))
        return F.slice(F.zip_with(pairs, _after(h, 2), lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.size(h) - 2, F.lit(0)))

    def places(g):
        def doubled(s):
            return F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        cover = let(ordered, lambda s: F.flatten(F.transform(
            doubled(s), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
        return F.size(F.array_distinct(cover))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    found = let(let(hashes, windows), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(places(g)))
    return F.when(F.size(words) < 4, 0).otherwise(found)


def features(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``df`` with word array, class counts and the base features under free names (name -> column)."""
    body, words, mapped, *rest = fresh(df, "q_body", "q_words", "q_mapped", *[f"q_{c}" for c in FEATURES], "q_classes")
    wide = df.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    wide = with_columns_once(wide, {words: F.filter(F.split(body, GAP), lambda w: w != ""), mapped: _classes(F.col(body))})
    count = dict(zip([*FEATURES, "classes"], rest))
    wide = with_columns_once(wide, {
        count["classes"]: _class_counts(F.col(mapped)),
        count["n_words"]: F.size(words).cast("long"),
        count["n_dup_lines"]: _dup_lines(F.col(body)).cast("long"),
        count["n_repeat_words"]: _repeat_words(F.col(words)).cast("long")})
    classes = F.col(count["classes"])
    total = F.aggregate(classes, F.lit(0.0), lambda a, x: a + x)
    wide = (wide.withColumn(count["word_chars"], (total - classes[_PLACE[" "]]).cast("long"))
            .withColumn(count["n_symbols"], classes[_PLACE["#"]].cast("long")))
    return wide.drop(body, mapped), count | {"words": words}


def _share(counts: Column) -> Column:
    return let(counts, lambda c: let(F.aggregate(c, F.lit(0.0), lambda a, x: a + x),
                                     lambda t: F.transform(c, lambda x: x / F.greatest(t, F.lit(1.0)))))


def _jsd(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two share arrays of the same bins."""
    def term(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    parts = F.zip_with(p, q, lambda a, b: (term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)))


def word_references(df: DataFrame, text: str = "text", lang: str = "lang", n_common: int = N_COMMON) -> DataFrame:
    """(lang, ref_words, ref_shares): the commonest words of each language and their shares, the share
    of all other words last; one row a language, over all documents.

    Counts aggregate partially by (language, word), so a hot language or word is no hot task;
    the word ranking is cut before the shuffle (window group limit)."""
    rows = df.select(F.col(lang).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = settle(rows.select("lang", F.explode(F.split("text", GAP)).alias("word")).filter("word <> ''")
                    .groupBy("lang", "word").agg(F.count("*").alias("n")))
    ranked = counts.withColumn("r", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).filter(F.col("r") <= n_common)
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    tops = ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("r", "word", "n"))).alias("top"))
    words = tops.join(total.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l"))).select(
        "lang", F.col("top.word").alias("ref_words"),
        F.transform("top", lambda x: x["n"] / F.col("total")).alias("head"))
    return words.withColumn("ref_shares", F.concat("head", F.array(
        F.lit(1.0) - F.aggregate("head", F.lit(0.0), lambda a, x: a + x)))).drop("head")


def class_references(df: DataFrame, classes: str, lang: str = "lang") -> DataFrame:
    """(lang, ref_classes): shares of the character classes of each language over all documents."""
    k = len(CLASSES) + 1
    chars = df.groupBy(F.col(lang).alias("lang")).agg(*[F.sum(F.get(classes, F.lit(i))).alias(f"c{i}") for i in range(k)])
    return chars.select("lang", _share(F.array(*[f"c{i}" for i in range(k)])).alias("ref_classes"))


def _word_bins(words: Column, common: Column) -> Column:
    """Occurrences of each common word: the common words among ``words`` stand between two blanks of
    their own in one string, from which each is taken out with its blanks."""
    some = F.filter(words, lambda w: F.array_contains(common, w))
    spaced = F.concat(F.lit(" "), F.array_join(some, "  "), F.lit(" "))
    return let(spaced, lambda s: F.transform(common, lambda w: (
        (F.octet_length(s) - F.octet_length(F.replace(s, F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
        / (F.octet_length(w) + 2)).cast("double")))


def quality(df: DataFrame, text: str = "text", lang: str = "lang", min_words: int = MIN_WORDS,
            max_char_jsd: float = MAX_CHAR_JSD, max_word_jsd: float = MAX_WORD_JSD, keep_text: bool = True) -> DataFrame:
    """``df`` with FEATURES, char_jsd, word_jsd (null where the guard holds), base_failed, kept.

    Texts are read twice: for the common words of each language, and for the features. The features
    are settled, so that the class references and the verdict read numbers only."""
    wide, at = features(df, text)
    if not keep_text:
        wide = wide.drop(text)
    cl, cw, cs, lc, cc = fresh(wide, "q_lang", "q_ref_words", "q_ref_shares", "q_lang_c", "q_ref_classes")
    refs = settle(word_references(df, text, lang)).select(
        F.col("lang").alias(cl), F.col("ref_words").alias(cw), F.col("ref_shares").alias(cs))
    wide = join_sized(wide, refs, F.col(lang).eqNullSafe(F.col(cl)), row_bytes=2048)
    n = F.col(at["n_words"])
    bins = let(_word_bins(F.col(at["words"]), F.col(cw)), lambda c: F.concat(c, F.array(
        n.cast("double") - F.aggregate(c, F.lit(0.0), lambda a, x: a + x))))
    jw, jc = fresh(wide, "q_word_jsd", "q_char_jsd")
    wide = with_columns_once(wide, {jw: F.when((n >= min_words) & F.col(cs).isNotNull(), _jsd(_share(bins), F.col(cs)))})
    wide = settle(wide.drop(at["words"], cl, cw, cs))
    refs = settle(class_references(wide, at["classes"], lang)).select(F.col("lang").alias(lc), F.col("ref_classes").alias(cc))
    wide = join_sized(wide, refs, F.col(lang).eqNullSafe(F.col(lc)), row_bytes=256)
    chars = F.aggregate(at["classes"], F.lit(0.0), lambda a, x: a + x)
    wide = with_columns_once(wide, {jc: F.when(chars >= MIN_CHARS, _jsd(_share(F.col(at["classes"])), F.col(cc)))})
    failed = (n < min_words) | (100 * F.col(at["n_repeat_words"]) > 50 * n)
    near = (F.coalesce(F.col(jc), F.lit(0.0)) <= max_char_jsd) & (F.coalesce(F.col(jw), F.lit(0.0)) <= max_word_jsd)
    made = [*FEATURES, "char_jsd", "word_jsd", "base_failed", "kept"]
    return wide.select(*[f"`{c}`" for c in df.columns if c.lower() not in made and c in wide.columns],
                       *[F.col(at[c]).alias(c) for c in FEATURES], F.col(jc).alias("char_jsd"),
                       F.col(jw).alias("word_jsd"), failed.alias("base_failed"), (~failed & near).alias("kept"))
