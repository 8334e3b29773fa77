"""Secret scan: candidates by pattern, false positives removed by a random forest.

Method. CANDIDATE finds candidates in the whole text with Spark's own regular expressions: whatever is assigned to, or quoted
after, a key word, of any length and characters; whatever has a provider's format; and runs of LEAST or more characters that
hold a digit, a symbol or an inner capital. A run that holds one of the first two gives way to it. Each candidate becomes a row of features: length,
shares of character kinds, transitions between kinds, distinct characters, the share that dictionary words cover, whether it is
a path or address, and how many of the words before it are in the dictionary. The dictionary holds the DICTIONARY_WORDS most
frequent words of all documents. A random forest, trained on labelled findings, scores every candidate; those under the cut
are false positives. Everything runs as DataFrame and MLlib operations.

Labelled findings. A table of findings (candidate, before, after, secret 0/1) may be given; the forest then sees SHAPE and CONTEXT.
If none is, findings are labelled by their context alone: a candidate after a key word, or of a provider's format, counts
as a secret; a candidate with neither, and the ordinary word before a candidate, do not. The forest then sees SHAPE only, which
the rule doesn't use, so it cannot learn the rule back: it learns what key words are followed by, and what else texts hold. At most
MAX_FIT_ROWS of either class, by hash, are used.

Defined results. Candidates do not overlap within a text. Position is the 1-based number of the candidate in its text. The
characters U+0001 and U+0002 count as blanks. A part of a web token of more than 4,000 characters has no format; such a token is a candidate as a run. Null and empty texts have no candidate. The result has one row per
candidate, repeated rows of documents included. With findings of one class only, that class's share is the score of all; so it is without findings. A text of
many megabytes, or one word of that size, is one row as any other. Only doc_id and text are read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.shared import let, saved

LEAST = 16
MAX_FIT_ROWS = 4000
TREES, DEPTH, SEED = 20, 6, 11
CUT = 0.5
DICTIONARY_WORDS = 2000
#: Letters of a dictionary word; shorter ones would cover random strings, too.
WORD_LETTERS = (4, 16)
#: Characters before a candidate that are kept, and words of them that count as its neighbours.
CONTEXT_CHARS, NEIGHBOURS = 120, 3
#: Provider formats, fixed by their issuers.
FORMATS = [
    r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36}", r"sk_live_[A-Za-z0-9]{24}", r"xox[abp]-[A-Za-z0-9-]{10,48}", r"AIza[A-Za-z0-9_-]{35}",
    r"eyJ(?<!eyJ[A-Za-z0-9_-]{0,40}eyJ)[A-Za-z0-9_-]{10,4000}+\.[A-Za-z0-9_-]{10,4000}+\.[A-Za-z0-9_-]{10,}", r"-----BEGIN (?:[A-Z0-9]{1,20} ){0,4}PRIVATE KEY(?: BLOCK)?-----",
]
ANY_FORMAT = "|".join(FORMATS)
KEY_WORDS = ["key", "token", "secret", "passw", "pwd", "credential", "auth", "bearer"]
#: A run of name characters that holds a key word. It is tried at its first character only, and never given back, so that a word of megabytes is read once.
KEY_WORD = rf"(?<![\w.\-])(?>[\w.\-]*?(?:{'|'.join(KEY_WORDS)}))[\w.\-]*+"
#: What stands before a value: a key word with a sign of assignment, or with a quote right after it.
PREFIX = rf"(?i:{KEY_WORD}[\"'`]?\s{{0,3}}(?:[:=]{{1,2}}>?)\s{{0,3}}(?:(?:bearer|basic)\s{{1,3}})?[\"'`]?|{KEY_WORD}\s{{1,3}}[\"'`]|\bbearer\s{{1,3}})"
#: A value: up to the closing quote, else up to a blank or quote, without a full stop or bracket at its end.
VALUE = r"""(?<=")[^"\n]+(?=")|(?<=')[^'\n]+(?=')|(?<=`)[^`\n]+(?=`)|[^\s"'`]*[^\s"'`.,;)\]}]"""
#: Printable ASCII but quotes, brackets, commas and the like.
RUN_CLASS = r"[!#$%&*+\-./0-9:=?@A-Z^_a-z~\\]"
RUN = rf"(?<!{RUN_CLASS})(?={RUN_CLASS}*(?:[0-9!#$%&*+=?@^_~\\]|[A-Za-z][A-Z]))(?!{RUN_CLASS}*(?:{ANY_FORMAT}|(?i:{KEY_WORD})[:=]{RUN_CLASS})){RUN_CLASS}{{{LEAST},}}"
CANDIDATE = f"({PREFIX})({VALUE})|({ANY_FORMAT})|({RUN})"
SHAPE = ["length", "upper", "lower", "digit", "other", "transitions", "distinct", "dictionary", "hexadecimal", "path", "neighbours"]
CONTEXT = ["format", "key_word", "quoted"]
_OPEN, _CLOSE = "\x01", "\x02"


def may_hold_any(text: Column) -> Column:
    """Whether a text has a key word, a run of LEAST characters, or the beginning of a format that may be shorter or hold blanks. All other texts have no candidate."""
    lowered = F.lower(text)
    short = [*KEY_WORDS, "xox", "-----begin"]
    return reduce(or_, [F.contains(lowered, F.lit(w)) for w in short]) | text.rlike(f"{RUN_CLASS}{{{LEAST}}}")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, position, before, candidate, after. Each candidate is put between two marks, and the text is cut at these."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _OPEN + _CLOSE, "  ")
    docs = docs.filter(may_hold_any(F.col("text").cast("string")))
    marked = F.regexp_replace(text, CANDIDATE, f"$1{_OPEN}$2$3$4{_CLOSE}")  # groups that didn't take part are empty

    def each(parts: Column) -> Column:
        found = F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.struct(
            F.right(F.get(parts, i - 1), F.lit(CONTEXT_CHARS)).alias("before"), x.alias("candidate"), F.left(F.get(parts, i + 1), F.lit(1)).alias("after"),
        )))
        return F.filter(found, lambda x: x.isNotNull())

    found = docs.select(F.col("doc_id").alias("doc_id"), F.posexplode(let(F.split(marked, f"[{_OPEN}{_CLOSE}]"), each)).alias("at", "found"))
    return found.select("doc_id", (F.col("at") + 1).alias("position"), "found.*")


def dictionary(docs: DataFrame, most: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of all documents, in lower case, the longest first. Words are summed up in each task before the exchange."""
    words = docs.select(F.explode(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+")).alias("w")).filter(F.length("w").between(*WORD_LETTERS))
    top = words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(most).collect()
    return sorted((r["w"] for r in top), key=lambda w: (-len(w), w))


def _count(of: Column, pattern: str) -> Column:
    return F.regexp_count(of, F.lit(pattern)).cast("double")


def _covered(candidate: Column, words: Column) -> Column:
    """Characters that words cover; the longest words first, without overlaps."""
    found = lambda c: F.filter(words, lambda w: F.contains(c, w))
    rest = let(F.lower(candidate), lambda c: F.aggregate(found(c), c, lambda a, w: F.replace(a, w, F.lit(_OPEN))))
    return F.length(candidate) - F.length(F.replace(rest, F.lit(_OPEN), F.lit("")))


def features(found: DataFrame, words: list[str]) -> DataFrame:
    """`found` with the columns SHAPE and CONTEXT."""
    known = F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")
    c, before = F.col("candidate"), F.coalesce(F.col("before"), F.lit(""))
    n = F.greatest(F.length(c), F.lit(1)).cast("double")
    kinds = F.translate(F.translate(F.translate(c, "abcdefghijklmnopqrstuvwxyz", "a" * 26), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26), "0123456789", "9" * 10)
    own = F.regexp_replace(before, f"{PREFIX}$", "")
    near = F.slice(F.reverse(F.filter(F.split(F.lower(own), r"[^\p{L}]+"), lambda w: w != "")), 1, NEIGHBOURS)
    return found.withColumns({
        "length": n, "upper": _count(c, "[A-Z]") / n, "lower": _count(c, "[a-z]") / n, "digit": _count(c, "[0-9]") / n,
        "other": _count(c, "[^A-Za-z0-9]") / n, "transitions": _count(kinds, "(?=aA|a9|Aa|A9|9a|9A)") / n,
        "distinct": F.size(F.array_distinct(F.split(c, ""))).cast("double") / n,
        "dictionary": _covered(c, known) / n,
        "hexadecimal": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "path": (c.rlike(r"(?i)^(\.{0,2}/|[a-z]+/[a-z]+/)|://|@[\w.-]+\.[a-z]{2}|\.(com|org|net|html?|js|py|png|jpg)\b") | before.rlike(r"(://|@|www\.)\S*$")).cast("double"),
        "neighbours": let(near, lambda w: F.size(F.filter(w, lambda x: F.array_contains(known, x)))).cast("double"),
        "format": c.rlike(f"^({ANY_FORMAT})$").cast("double"), "key_word": before.rlike(f"{PREFIX}$").cast("double"),
        "quoted": (before.rlike("[\"'`]$") & F.col("after").isin("'", '"', "`")).cast("double"),
    })


def ordinary(found: DataFrame) -> DataFrame:
    """before, candidate, after of the word that stands before each candidate (and its prefix): what is no secret, in its place."""
    own = F.rtrim(F.regexp_replace(F.coalesce("before", F.lit("")), f"{PREFIX}$", ""))
    words = found.select(own.alias("own"), F.regexp_extract(own, r"(\S+)$", 1).alias("candidate"))
    return words.filter("candidate <> ''").select(F.expr("left(own, length(own) - length(candidate))").alias("before"), "candidate", F.lit(" ").alias("after"))


def labelled(found: DataFrame) -> DataFrame:
    """`found` (with features) with secret 0/1, by context alone."""
    return found.withColumn("secret", ((F.col("key_word") == 1) | (F.col("format") == 1)).cast("int"))


def _sampled(findings: DataFrame, max_rows: int) -> DataFrame:
    by_hash = [F.xxhash64("candidate", "before"), F.col("candidate"), F.col("before")]
    sides = [findings.filter(F.col("secret") == v).orderBy(*by_hash).limit(max_rows) for v in (0, 1)]
    return sides[0].unionByName(sides[1])


def findings_of(found: DataFrame, words: list[str], max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """Findings labelled by context: of `found` (with features), and as many ordinary words again."""
    plain = ordinary(found.orderBy(F.xxhash64("before", "candidate"), "before", "candidate").limit(max_rows)).withColumn("secret", F.lit(0))
    columns = [*SHAPE, "secret", "candidate", "before"]
    return _sampled(labelled(found), max_rows).select(columns).unionByName(features(plain, words).filter("key_word = 0 AND format = 0").select(columns))


def fitted(findings: DataFrame, columns: list[str]) -> tuple[Model | None, float]:
    """A forest fitted on findings (columns, secret), and the share of secrets."""
    n = {r["secret"]: r["count"] for r in findings.groupBy("secret").count().collect()}
    share = (n.get(1, 0) + 1) / (sum(n.values()) + 2)
    if len(n) < 2:
        return None, share
    forest = RandomForestClassifier(labelCol="secret", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(_assembled(findings.withColumn("secret", F.col("secret").cast("double")), columns)), share


def _assembled(found: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep").transform(found)


def scored(found: DataFrame, model: Model | None, share: float, columns: list[str]) -> DataFrame:
    """`found` (with features) with score."""
    if model is None:
        return found.withColumn("score", F.lit(share))
    return model.transform(_assembled(found, columns)).withColumn("score", F.get(vector_to_array("probability"), 1))


def scan(docs: DataFrame, findings: DataFrame | None = None, cut: float = CUT) -> DataFrame:
    """One row per candidate: doc_id, position, candidate, score, is_secret."""
    words = dictionary(docs)
    found = saved(features(candidates(docs), words))
    columns = SHAPE if findings is None else SHAPE + CONTEXT
    known = findings_of(found, words) if findings is None else _sampled(features(findings.filter(F.col("secret").isin(0, 1)), words), MAX_FIT_ROWS)
    model, share = fitted(saved(known), columns)
    return scored(found, model, share, columns).select("doc_id", "position", "candidate", F.round("score", 6).alias("score"), (F.col("score") >= cut).alias("is_secret"))


def held_out_quality(docs: DataFrame, cut: float = CUT) -> dict[str, float]:
    """Precision and recall over held-out findings (a fifth of the candidates, by their hash), labelled by context."""
    words = dictionary(docs)
    found = saved(features(candidates(docs), words))
    known = saved(findings_of(found, words))
    held = F.pmod(F.xxhash64("candidate"), F.lit(5)) == 0
    model, share = fitted(known.filter(~held), SHAPE)
    marks = scored(labelled(found).filter(held), model, share, SHAPE).select("secret", (F.col("score") >= cut).cast("int").alias("flag"))
    n = {(r["secret"], r["flag"]): r["count"] for r in marks.groupBy("secret", "flag").count().collect()}
    hit = n.get((1, 1), 0)
    return {"precision": hit / max(1, hit + n.get((0, 1), 0)), "recall": hit / max(1, hit + n.get((1, 0), 0)), "candidates": sum(n.values())}
