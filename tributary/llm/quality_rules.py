"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Counts. A word is a run of characters other than space and U+0009 to U+000D. word_chars counts code points in words,
n_symbols the characters of SYMBOLS, n_dup_lines the lines (split at \\n, with a word) equal to an earlier line,
n_repeat_words the words inside 5-word windows found twice or more in the text, first occurrence included.

Defined results. A null, empty or blank text has no words; base_failed is true and kept false. Windows are compared
by a 64-bit hash of their words. A ratio without a denominator counts as 0. The stop words are English, German, French and
Spanish: with the default table, texts in other languages mostly fall to stop_word_ratio; pass a table without it for them. Rows are judged one by one: repeated rows
get equal results, no rows give no rows, there is no exchange and no state, so a lost task is simply run again. A text of megabytes, or one
word of that size, is one row as any other. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import SPACE_CLASS, WORD, let

SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = "the of and to in is that it was for as with be by on are this he from or at " \
    "der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an " \
    "le la les et des en un une du que est dans pour qui par sur au pas plus ce il " \
    "el los las y una del se por con su para al lo como más pero sus no".split()
WINDOW = 5
#: (ratio, least, most): a text is kept if each ratio lies within its bounds.
THRESHOLDS = [
    ("mean_word_chars", 2.0, 16.0),
    ("symbol_ratio", None, 0.4),
    ("stop_word_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
]


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur twice or more. Texts whose windows all differ, most of them, skip the sort."""

    def windows(h: Column) -> Column:
        starts = F.slice(h, 1, F.greatest(F.size(h) - WINDOW + 1, F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        found = F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
        return F.sort_array(F.filter(found, lambda x: x.isNotNull()))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), x - F.coalesce(F.get(p, k - 1), F.lit(-WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(let(placed, repeated), covered))

    return let(let(F.transform(words, lambda x: F.xxhash64(x)), windows), count)


def counts(text: Column) -> Column:
    """A struct of the counts of one text."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    stops = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.size(F.split(text, f"[{SYMBOLS}]")) - 1).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("line"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.rtrim(x, F.lit(".,;:?")).isin(stops))).cast("long").alias("n_stop_words"),
        )

    return let(words, of)


def verdict(ratios: dict[str, Column], thresholds: list[tuple] = THRESHOLDS) -> Column:
    """The threshold table as one condition."""
    kept = F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            kept = kept & (ratios[name] >= least)
        if most is not None:
            kept = kept & (ratios[name] <= most)
    return kept


def quality_rules(docs: DataFrame, thresholds: list[tuple] = THRESHOLDS) -> DataFrame:
    """One row per document: its counts, base_failed, kept."""
    c = docs.select("doc_id", counts(F.col("text")).alias("c")).select("doc_id", "c.*").select("*", "line.*").drop("line")
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    ratios = {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_ratio": share("n_symbols", "n_words"),
        "stop_word_ratio": share("n_stop_words", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
    }
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return c.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(ratios, thresholds)).alias("kept"), "n_lines", "n_stop_words",
    )
