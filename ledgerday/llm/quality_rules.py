"""Quality rules over whole texts, with DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated five-word windows;
the divergence rule compares a document's histogram of character classes and of
common words with its language's reference by Jensen-Shannon distance.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerday.llm.common import shared_table

WINDOW = 5
BLANKS = " \t\n\x0b\f\r"
BLANK = r"[ \t-\r]"

# The commonest words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "ist", "im", "dem", "nicht", "ein"],
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au"],
}

#: Character classes by the pattern whose runs are cut out to count them; the rest is symbols, blanks and others.
CHAR_CLASSES = {
    "lower": r"\p{Ll}+",
    "upper": r"\p{Lu}+",
}
N_CLASSES = len(CHAR_CLASSES) + 3

#: A document with fewer words is not judged by its histograms: they are too coarse.
MIN_WORDS = 50
MIN_COMMON = 30
#: Distances (0 to 1) from which a document counts as unlike its language.
MAX_CHAR_DISTANCE = 0.16
MAX_WORD_DISTANCE = 0.30
#: Proportions are summed as whole millionths, so that sums don't depend on their order.
UNIT = 1_000_000


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK + "+")
    )


def _window_hashes(words: Column) -> Column:
    """A 64-bit hash of each five-word window, in order."""
    n = F.size(words)
    shifted = [F.slice(words, F.lit(k + 1), F.greatest(n - k, F.lit(0))).alias(f"w{k}") for k in range(WINDOW)]
    windows = F.slice(F.arrays_zip(*shifted), F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))
    return F.transform(windows, lambda w: F.xxhash64(w))


def _in_order(hashes: Column) -> Column:
    """The windows by hash then place; null unless one occurs twice."""
    placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(placed))


def _repeated_words(order: Column) -> Column:
    """Words in windows found twice or more: the union of the marked windows' spans.

    ``order`` must be a stored column: the lambda looks at its neighbours.
    """
    twice = F.filter(order, lambda x, j: (x["h"] == F.get(order, j - 1)["h"]) | (x["h"] == F.get(order, j + 1)["h"]))
    # Each marked window adds the words up to the next one, five at most.
    return F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).cast("int").alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("long").alias("n"), i.cast("int").alias("last")
        ),
        lambda acc: acc["n"],
    )


def _shares(counts: list[Column], total: Column) -> list[Column]:
    return [F.when(total > 0, F.round(c.cast("long") * UNIT / total)).otherwise(0).cast("long") for c in counts]


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The base counts and both histograms of every row, from its whole text.

    ``chars`` has the share (in millionths) of each character class, ``common``
    that of each of the language's common words among the words, then of all
    other words; a language without a list has an empty ``common``.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    # Each step stores what the next ones read more than once, and drops the rest early.
    texts = docs.select(
        F.col(id_col).alias("id"), F.lower(F.col(lang_col)).alias("lang"), whole.alias("text"), _words(whole).alias("words"),
        F.filter(F.split(whole, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0).alias("lines"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    n_chars, word_chars = F.length("text"), F.length(F.array_join("words", "")).cast("long")
    counts = texts.select(
        "id", "lang", "n_symbols",
        n_chars.alias("n_chars"), word_chars.alias("word_chars"), F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        *(F.length(F.regexp_replace("text", p, "")).alias(f"no_{k}") for k, p in CHAR_CLASSES.items()),
        _window_hashes(F.col("words")).alias("hashes"),
        _common_words(F.lower("text"), F.col("lang")).alias("hits"),
    )
    n_words = F.greatest("n_words", F.lit(1))
    classes = [F.col("n_chars") - F.col(f"no_{k}") for k in CHAR_CLASSES]
    classes += [F.col("n_symbols"), F.col("n_chars") - F.col("word_chars")]
    hits, held = F.size("hits"), F.col("hits")
    shares = reduce(
        lambda otherwise, k: F.when(
            F.col("lang") == k,
            F.array(
                *(F.round((hits - F.size(F.array_remove(held, F.lit(w)))).cast("long") * UNIT / n_words).cast("long") for w in COMMON_WORDS[k]),
                F.round((F.col("n_words") - hits) * UNIT / n_words).cast("long"),
            ),
        ).otherwise(otherwise),
        COMMON_WORDS, F.array().cast("array<bigint>"),
    )
    shaped = counts.select(
        "id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.array(*_shares([*classes, F.col("n_chars") - reduce(add, classes)], F.col("n_chars"))).alias("chars"),
        shares.alias("common"), _in_order(F.col("hashes")).alias("order"),
    )
    repeated = F.coalesce(_repeated_words(F.col("order")), F.lit(0)).cast("long")
    return shaped.withColumn("n_repeat_words", repeated).drop("order")


def _common_words(lower: Column, lang: Column) -> Column:
    """The words that are on the language's list, in order."""
    none = F.array().cast("array<string>")
    return reduce(
        lambda otherwise, k: F.when(lang == k, F.filter(_words(lower), lambda w: w.isin(COMMON_WORDS[k]))).otherwise(otherwise),
        COMMON_WORDS, none,
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def language_references(measured: DataFrame) -> DataFrame:
    """Per language, the summed shares of all its documents that pass the base rules and
    are long enough; each counts alike, whatever its length.  One row per language."""
    bins = [F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)]
    n_common = len(COMMON_WORDS["en"]) + 1
    bins += [F.sum(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(n_common)]
    sums = measured.where(~base_failed() & (F.col("n_words") >= MIN_WORDS)).groupBy("lang").agg(*bins)
    return sums.select(
        "lang",
        F.array(*(f"c{i}" for i in range(N_CLASSES))).alias("ref_chars"),
        F.array(*(F.coalesce(f"w{i}", F.lit(0)) for i in range(n_common))).alias("ref_common"),
    )


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the base-2 Jensen-Shannon divergence of two histograms (0 to 1);
    0 where either is empty."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def half(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    sp, sq = total(p), total(q)
    terms = F.zip_with(
        p, q,
        lambda a, b: half(a / sp, (a / sp + b / sq) / 2) + half(b / sq, (a / sp + b / sq) / 2),
    )
    return F.when((sp > 0) & (sq > 0), F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0)))).otherwise(0.0)


def with_distances(measured: DataFrame, references: DataFrame) -> DataFrame:
    """``measured`` with ``char_distance``, ``word_distance`` and ``words_judged``."""
    total = F.aggregate("ref_common", F.lit(0).cast("long"), lambda a, b: a + b)
    expected = (total - F.element_at("ref_common", -1)) / F.greatest(total, F.lit(1))
    rows = measured.alias("m").join(references.alias("r"), F.col("m.lang").eqNullSafe(F.col("r.lang")), "left")
    return rows.select(
        "m.*",
        F.coalesce(js_distance(F.col("chars"), F.col("ref_chars")), F.lit(0.0)).alias("char_distance"),
        F.when(F.size("common") > 0, F.coalesce(js_distance(F.col("common"), F.col("ref_common")), F.lit(0.0)))
        .otherwise(0.0).alias("word_distance"),
        F.coalesce(F.col("n_words") * expected >= MIN_COMMON, F.lit(False)).alias("words_judged"),
    )


def unlike() -> Column:
    """Over the length guards, and too far from the language's reference."""
    return (F.col("n_words") >= MIN_WORDS) & (
        (F.col("char_distance") > MAX_CHAR_DISTANCE) | (F.col("words_judged") & (F.col("word_distance") > MAX_WORD_DISTANCE))
    )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, ``char_distance``, ``word_distance``, ``base_failed`` and ``kept`` of every row.

    Words are ``[^\\x20\\x09-\\x0D]+``.  A row fails the base rules with fewer
    than 10 words, or if over 20 % of its words lie in five-word windows found
    twice in it.  Else it is kept unless a histogram is too far from its
    language's reference: character classes from ``MIN_WORDS`` words on, common
    words if besides the reference expects ``MIN_COMMON`` of them.  References
    cover all rows of the language, and are refitted once without the unlike ones.

    Every text is scanned once; counts and histograms are stored, and the small
    references (a row a language, combined map-side) are joined to them.

    Null or empty text: no words, not kept.  Null language: a language of its
    own, judged by characters only, like those without a word list.  Repeated
    rows and ids: each is judged.  Empty table: no rows.  Other columns are
    ignored.
    """
    measured = shared_table(measure(docs, id_col, text_col, lang_col), "measured")
    first = with_distances(measured, language_references(measured))
    # Refitted without the documents that are unlike the first references.
    references = language_references(first.where(~unlike()))
    rows = with_distances(measured, references)
    return rows.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & ~unlike()).alias("kept"),
        *(F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")),
    )
