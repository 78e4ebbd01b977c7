"""Quality rules by distribution divergence (DataFrame functions only).

A document's histogram of character classes and of its language's most common
words is held against the language's own reference histograms (over all
documents) by Jensen-Shannon distance.  The limits are fixed or taken from the
distances of all documents.  Short documents, and languages with too
little text, are not judged by a histogram that says little: see the minimum
lengths of ``Rules``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.llm.common import fresh, let, materialise, small, text_of, words_of

# Character classes, as the regular expressions that match a run of each; what
# is left after all of them is the last class.
SPACE_RUN, SYMBOLS = "[ \\t-\\r]+", "[#*$%&|<>]+"
CHAR_CLASSES = ("[a-z]+", SPACE_RUN, "[A-Z]+", "[.,;:!?'\"()-]+", "[0-9]+", SYMBOLS, "[\\x00-\\x7F]+")
WINDOW = 5
# A run of what is neither a lower-case letter nor beyond ASCII.
NO_LETTERS = "[\\x00-`{-\\x7F]+"


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.

    min_words, max_repeat_percent: the base rules.
    common_words: words a language's reference has, besides "any other".
    max_char_distance, max_word_distance: Jensen-Shannon distances (0 to 1).
    min_chars, min_letters_words: a document with fewer is not judged by the distance.
    min_reference_words: a language with fewer words in the corpus has no reference.
    spread: if not None, the limits are also taken from the distances of all documents
    of the language that are about as long (words, to a power of two): the third
    quartile and so many quartile distances, of ``least_spread`` at least.  Groups of
    fewer than min_documents take the language's limit, or else the fixed one.
    """
    min_words: int = 10
    max_repeat_percent: int = 20
    common_words: int = 24
    max_char_distance: float = 0.3
    max_word_distance: float = 0.5
    min_chars: int = 200
    min_letters_words: int = 60
    min_reference_words: int = 1000
    spread: float | None = None
    least_spread: float = 0.01
    min_documents: int = 20


# Far-out fences: the limits of a verdict unless a caller says otherwise.
FENCES = Rules(spread=3.0)
# Distances are counted in bins, so that quartiles need no sort and no sketch.
BINS = 4096


def line_repeats(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found at least twice.

    Windows are 64-bit hashes.  Only a text that has fewer distinct windows
    than windows pays for the sort that finds which ones.
    """
    def hashes(w: Column) -> Column:
        return F.when(F.size(w) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        found = let(ordered, lambda s: F.sort_array(F.transform(F.filter(
            s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("until"))
        return F.aggregate(found, start, lambda a, i: F.struct(
            (a["n"] + WINDOW - F.greatest(a["until"] - i, F.lit(0))).alias("n"), (i + WINDOW).alias("until")))["n"]

    return let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))


def char_classes(text: Column) -> Column:
    """Counts of the character classes.  Each run is removed in turn, so later
    expressions see ever shorter texts."""
    def count(rest: Column, k: int, done: list[Column]) -> Column:
        if k == len(CHAR_CLASSES):
            return F.array(*done, F.length(rest))
        left = F.regexp_replace(rest, F.lit(CHAR_CLASSES[k]), F.lit(""))
        return let(left, lambda x: count(x, k + 1, [*done, F.length(rest) - F.length(x)]))
    return let(text, lambda t: count(t, 0, []))


def letter_words(text: Column) -> Column:
    """Lower-case runs of letters: a-z and all that is not ASCII."""
    return F.filter(F.split(F.lower(text), NO_LETTERS), lambda w: w != "")


def spaced_letter_words(text: Column) -> Column:
    """``letter_words`` in one string, a space before and one after each."""
    inner = F.trim(F.regexp_replace(F.lower(text), F.lit(NO_LETTERS), F.lit("  ")))
    return let(inner, lambda x: F.when(x == "", F.lit("")).otherwise(F.concat(F.lit(" "), x, F.lit(" "))))


def _spaced_words(spaced: Column) -> Column:
    """Words of such a string: half of its spaces."""
    return ((F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("int")


def language_references(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per language (null is one too): ref_lang, ref_chars (shares of
    the character classes), ref_words (the most common words, ties by the word),
    ref_shares (their shares, then that of all other words), ref_total."""
    base = docs.select(F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    n = len(CHAR_CLASSES) + 1
    chars = base.select("lang", char_classes(F.col("text")).alias("c")).groupBy("lang").agg(
        *[F.sum(F.col("c")[k]).cast("double").alias(f"c{k}") for k in range(n)])
    total = sum((F.col(f"c{k}") for k in range(1, n)), F.col("c0"))
    chars = chars.select("lang", F.transform(F.array(*[F.col(f"c{k}") for k in range(n)]),
                                             lambda x: x / F.greatest(total, F.lit(1.0))).alias("ref_chars"))
    counts = (base.select("lang", F.explode(letter_words(F.col("text"))).alias("word"))
              .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    counts = materialise(counts, "quality-words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("ref_total"))
    top = (counts.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word")))
           .filter(F.col("rank") <= rules.common_words)
           .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top")))
    totals, top = totals.withColumnRenamed("lang", "lang_t"), top.withColumnRenamed("lang", "lang_w")
    joined = (chars.join(totals, F.col("lang").eqNullSafe(F.col("lang_t")), "left")
              .join(top, F.col("lang").eqNullSafe(F.col("lang_w")), "left"))
    shares = F.transform("top", lambda x: x["n"] / F.col("ref_total"))
    other = F.lit(1.0) - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return joined.select(F.col("lang").alias("ref_lang"), "ref_chars",
                         F.coalesce(F.transform("top", lambda x: x["word"]), F.array().cast("array<string>")).alias("ref_words"),
                         F.coalesce(F.concat(shares, F.array(F.greatest(other, F.lit(0.0)))), F.array(F.lit(1.0))).alias("ref_shares"),
                         F.coalesce("ref_total", F.lit(0)).alias("ref_total"))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two arrays of shares."""
    def part(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    each = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _band() -> Column:
    """Words to a power of two: the binary digits of their number, less one."""
    return F.length(F.bin(F.greatest(F.col("n_words"), F.lit(1)))) - 1


def distance_limits(judged: DataFrame, rules: Rules) -> DataFrame:
    """lang, band (-1: the whole language), char_limit, word_limit (null where too few
    documents have the distance) from the distances of ``judged``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_distance").alias("x")) for kind in ("char", "word")]))
    bins = judged.select(F.col("lang").cast("string").alias("lang"), _band().alias("band"), pairs.alias("p")).filter("p.x is not null")
    bins = materialise(bins.groupBy("lang", "band", F.col("p.kind").alias("kind"), F.floor(F.col("p.x") * BINS).cast("int").alias("bin"))
                       .agg(F.count(F.lit(1)).alias("n")), "quality-distances")
    whole = bins.groupBy("lang", F.lit(-1).alias("band"), "kind", "bin").agg(F.sum("n").alias("n"))
    group = W.partitionBy("lang", "band", "kind")
    ranked = bins.unionByName(whole).withColumn("total", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("bin")))
    quartiles = ranked.filter(F.col("total") >= rules.min_documents).groupBy("lang", "band", "kind").agg(
        *[(F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.col("bin"))) / BINS).alias(f"q{k}") for k in (1, 3)])
    limit = F.col("q3") + F.lit(1 / BINS) + rules.spread * F.greatest(F.col("q3") - F.col("q1"), F.lit(rules.least_spread))
    return quartiles.groupBy("lang", "band").agg(
        *[F.max(F.when(F.col("kind") == kind, limit)).alias(f"{kind}_limit") for kind in ("char", "word")])


def _limited(judged: DataFrame, rules: Rules) -> tuple[DataFrame, Column, Column]:
    """``judged`` with its limits joined, and these."""
    limits = materialise(distance_limits(judged, rules), "quality-limits")
    found = {"char": [F.lit(rules.max_char_distance)], "word": [F.lit(rules.max_word_distance)]}
    for own in (False, True):
        names = fresh(judged, "limit_lang", "limit_band", "char_limit", "word_limit")
        some = small(limits.filter(F.col("band") >= 0 if own else F.col("band") < 0).toDF(*names))
        same = F.col("lang").cast("string").eqNullSafe(F.col(names[0]))
        judged = judged.join(some, same & (_band() == F.col(names[1])) if own else same, "left")
        for kind, name in zip(found, names[2:]):
            found[kind].insert(0, F.col(name))
    return judged, *(F.least(F.coalesce(*found[kind]), found[kind][-1]) for kind in ("char", "word"))


def quality(docs: DataFrame, rules: Rules = FENCES, references: DataFrame | None = None,
            carried: list[str] | None = None) -> DataFrame:
    """Add the base counts, base_failed, char_distance, word_distance (null where
    a guard holds) and ``kept``; the columns of ``docs`` stay as they are.

    Null text: none (0 words, fails the base rules).  Null language: a language
    of its own.  Repeated rows are judged one by one.  Existing columns with the
    names of results are replaced.  An empty table gives an empty result.
    ``carried``: the columns of ``docs`` that the result has (all of them).
    """
    refs = references if references is not None else language_references(docs, rules)
    refs = small(materialise(refs, "quality-refs"))
    names = ["ref_lang", "ref_chars", "ref_words", "ref_shares", "ref_total", "text_words", "text_classes", "text_length"]
    lang, chars_of, words_ref, shares_of, total_of, in_words, classes, size = own = fresh(docs, *names)
    refs = refs.select(*[F.col(a).alias(b) for a, b in zip(names[:5], own)])
    text = text_of()
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "char_distance", "word_distance", "kept"]
    out = docs.drop(*new)
    columns = [c for c in carried or out.columns if c not in new]
    out = out.join(refs, F.col("lang").cast("string").eqNullSafe(F.col(lang)), "left")
    of_words = let(words_of(text), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")))
    out = out.withColumns({in_words: of_words, classes: char_classes(text), size: F.length(text)})
    out = out.withColumns({
        "n_words": F.col(in_words)["n"].cast("long"),
        "word_chars": (F.col(size) - F.col(classes)[CHAR_CLASSES.index(SPACE_RUN)]).cast("long"),
        "n_symbols": F.col(classes)[CHAR_CLASSES.index(SYMBOLS)].cast("long"),
        "n_dup_lines": line_repeats(text).cast("long"),
        "n_repeat_words": F.col(in_words)["repeat"].cast("long")})
    failed = ((F.col("n_words") < rules.min_words)
              | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent))
    referred = F.coalesce(F.col(total_of), F.lit(0)) >= rules.min_reference_words

    def shares(counts: Column, total: Column) -> Column:
        return F.transform(counts, lambda c: c / total)

    chars = F.when(referred & (F.col(size) >= rules.min_chars),
                   js_distance(shares(F.col(classes), F.col(size)), F.col(chars_of)))

    def word_distance(spaced: Column) -> Column:
        # take out one reference word after another; what is left is "any other"
        total = _spaced_words(spaced)
        start = F.struct(spaced.alias("rest"), F.array().cast("array<int>").alias("counts"))
        counts = F.aggregate(words_ref, start, lambda a, r: let(
            F.replace(a["rest"], F.concat(F.lit(" "), r, F.lit(" ")), F.lit("")), lambda rest: F.struct(
                rest.alias("rest"), F.concat(a["counts"], F.array(
                    ((F.octet_length(a["rest"]) - F.octet_length(rest)) / (F.octet_length(r) + 2)).cast("int"))).alias("counts"))),
            lambda a: F.concat(a["counts"], F.array(_spaced_words(a["rest"]))))
        return let(total, lambda n: F.when(n >= rules.min_letters_words, js_distance(shares(counts, n), F.col(shares_of))))

    out = (out.withColumn("base_failed", failed).withColumn("char_distance", chars)
           .withColumn("word_distance", F.when(referred, let(spaced_letter_words(text), word_distance))))
    char_limit, word_limit = F.lit(rules.max_char_distance), F.lit(rules.max_word_distance)
    if rules.spread is not None:
        judged = [*columns, *(["lang"] if "lang" not in columns else []), *new[:-1]]
        out, char_limit, word_limit = _limited(materialise(out.select(*judged), "quality-judged"), rules)
    off = (F.coalesce(F.col("char_distance") > char_limit, F.lit(False))
           | F.coalesce(F.col("word_distance") > word_limit, F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~off).select(*columns, *new)
