"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are known key formats, values of 8 or more characters assigned to names such as
``password`` (by ``=`` or ``:``, quoted or not), and unbroken tokens of 16 or more. The forest judges each by its length, character classes and transitions between
them, dictionary coverage, whether it is part of a path, and the neighbouring words.

It learns from labelled findings, at most ``SAMPLE_ROWS`` of them (those with the smallest hash).
Findings that somebody has judged can be given; else findings are labelled by rule where a rule
is safe: known formats and assigned random values are secrets; words, paths and values named as
examples or digests are none. All others are left to the forest.

Everything is DataFrame functions and Spark's own forest.

Defined results: a null or empty text has no findings; without labelled findings of both kinds
every candidate keeps the score 1; repeated rows give their findings again; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm import common
from ledgerloom.llm.spans import let, spans

SAMPLE_ROWS = 20_000
TREES, DEPTH = 30, 6
ACCEPT = 0.5
LEAST_CHARACTERS = 16

NAMES = "password|passwd|pwd|secret|token|api_?key|access_?key|auth|bearer|credential|private_?key"
_TOKEN = "[A-Za-z0-9+/_.=-]"
# A name, perhaps quoted, and its sign; then a value of 8 or more non-space characters. An unquoted value
# ends before a separator that another name follows. Groups repeat a bounded number of times, as Java recurses.
_SIGN = rf"(?i:{NAMES})\w{{0,12}}\\?[\"']?\s{{0,4}}[=:]\s{{0,4}}"
_PLAIN = r"(?![\"'])(?=\S{8})[^\s,;&]*+(?:[,;&](?!\w[\w.-]{0,30}\\?[\"']?[=:])[^\s,;&]*+){0,200}+"
_ASSIGNED = rf"{_SIGN}(?!\\?[\"']?-----BEGIN )(?:\\?\"[^\s\"]{{8,}}+|\\?'[^\s']{{8,}}+|{_PLAIN})"
# One pattern for all candidates: key blocks, assigned values, and unbroken runs of token characters.
CANDIDATE = (rf"-----BEGIN [A-Z ]{{0,20}}PRIVATE KEY-----|(?<!{_TOKEN})(?:{_TOKEN}{{0,200}}?{_ASSIGNED}"
             rf"|{_TOKEN}{{{LEAST_CHARACTERS},}}+)")
# What is cut off a match: name and sign, or any other ``name=`` that leaves a long token; marks that end a sentence.
_NAMED_PREFIX = rf"^{_TOKEN}*?{_SIGN}\\?[\"']?"
_OTHER_PREFIX = rf"^{_TOKEN}*=(?=[^=].{{{LEAST_CHARACTERS - 1}}})"
_TRAILING = r"[.,;:!?)\]}>\"'\\]+$"
# Fixed formats of well-known keys.
KNOWN = (r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{20,}"
         r"|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
         r"|-----BEGIN .*)$")
DIGESTS = "sha|sha1|sha256|md5|commit|checksum|digest|hash|uuid|guid|etag|revision"
PLACEHOLDERS = "example|sample|dummy|test|fake|placeholder|changeme|xxxx|your"
# Common letter groups of the four languages, as the dictionary that coverage is measured by.
DICTIONARY = ("tion|the|ing|and|that|ent|ion|her|for|have|with|this|ver|are|not|ung|sch|ein|ich|der|die|und|keit|heit|lich"
              "|que|ment|les|des|eur|eau|elle|aux|ais|oir|cion|ado|mente|est|con|por|los|las|res|ous|ter|ate|ere|man|ist")

FEATURES = ["length", "digits", "upper", "lower", "marks", "transitions", "distinct", "vowels", "coverage", "hexadecimal",
            "named", "assigned", "quoted", "path", "digest", "placeholder", "known"]


def _share(value: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{characters}]", "")) / F.greatest(F.length(value), F.lit(1))


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def split_assignment(x: Column) -> Column:
    """Value and text before and after of a match: cut behind its name and sign, and before trailing marks."""
    named = F.regexp_extract(x["value"], _NAMED_PREFIX, 0)
    cuts = F.struct(F.when(named != "", named).otherwise(F.regexp_extract(x["value"], _OTHER_PREFIX, 0)).alias("head"),
                    F.regexp_extract(x["value"], _TRAILING, 0).alias("tail"))

    def cut(c: Column) -> Column:
        head, tail = F.length(c["head"]), F.length(c["tail"])
        return F.struct(
            (x["start"] + head).alias("start"), (x["end"] - tail).alias("end"),
            F.substr(x["value"], head + 1, F.greatest(F.length(x["value"]) - head - tail, F.lit(0))).alias("value"),
            F.concat(x["before"], c["head"]).alias("before"), F.concat(c["tail"], x["after"]).alias("after"))

    return let(cuts, cut)


def features(x: Column) -> Column:
    """The forest's inputs for one candidate (start, end, value, before, after)."""
    value, before, after = x["value"], F.lower(x["before"]), F.lower(x["after"])
    low = F.lower(value)
    around = F.concat(before, F.lit(" "), after)
    return F.struct(*[c.cast("double").alias(n) for n, c in zip(FEATURES, [
        F.least(F.length(value), F.lit(400)), _share(value, "0-9"), _share(value, "A-Z"), _share(value, "a-z"),
        _share(value, "+/_.=\\-"),
        F.regexp_count(value, F.lit("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]")) / F.length(value),
        F.size(F.array_distinct(F.split(F.left(value, F.lit(400)), ""))) / F.least(F.length(value), F.lit(400)),
        _share(low, "aeiouy"),
        1 - F.length(F.regexp_replace(low, f"(?:{DICTIONARY})", "")) / F.length(value),
        _flag(low.rlike("^[0-9a-f]+$")),
        _flag(before.rlike(rf"(?:{NAMES})[a-z0-9_]{{0,12}}[\"']?\s*(?:=|:|is)?\s*[\"']?$")),
        _flag(before.rlike(r"[=:]\s*[\"']?$")), _flag(before.rlike("[\"']$")),
        _flag(before.rlike(r"(?:://|/|\\)$") | value.rlike(r"/[A-Za-z0-9_.-]{1,15}/|\.(?:com|org|html?|png|jpg|py|java|txt)$|^www\.")),
        _flag(around.rlike(rf"\b(?:{DIGESTS})\b")), _flag(around.rlike(rf"(?:{PLACEHOLDERS})") | low.rlike(PLACEHOLDERS)),
        _flag(value.rlike(KNOWN)),
    ])])


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate: doc_id, start, end, and its features."""
    whole = F.coalesce(F.col("text"), F.lit(""))

    def rate(x: Column) -> Column:
        return let(split_assignment(x), lambda y: F.struct(
            y["start"].alias("start"), y["end"].alias("end"), features(y).alias("f")))

    found = docs.select("doc_id", F.explode(F.filter(
        F.transform(spans(whole, CANDIDATE), rate),
        lambda x: x["f"]["length"] >= F.when(x["f"]["named"] > 0, 8).otherwise(LEAST_CHARACTERS))).alias("x"))
    return found.select("doc_id", "x.start", "x.end", "x.f.*")


def labelled_by_rule(found: DataFrame) -> DataFrame:
    """The candidates for which a rule is safe, with ``label``."""
    random = (F.col("coverage") < 0.4) & (F.col("distinct") > 0.15) & (F.col("digits") > 0.1)
    secret = (F.col("placeholder") == 0) & ((F.col("known") > 0) | ((F.col("named") > 0) & random))
    word = (F.col("digits") == 0) & (F.col("marks") < 0.1) & (F.col("upper") < 0.2) & (F.col("named") == 0)
    none = (F.col("known") == 0) & (word | (F.col("path") > 0) | (F.col("digest") > 0) | (F.col("placeholder") > 0))
    return found.withColumn("label", F.when(secret, 1.0).when(none, 0.0)).where(F.col("label").isNotNull())


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS):
    """A forest from at most ``sample_rows`` labelled findings, or None without both kinds."""
    picked = labelled.select(*FEATURES, "label").orderBy(F.xxhash64(*FEATURES, "label"), *FEATURES).limit(sample_rows)
    picked = common.staged(picked, "secret-sample")
    if picked.select("label").distinct().count() < 2:
        return None
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(picked.coalesce(1))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, labelCol="label",
                                  featuresCol="features").fit(inputs.select("features", "label"))


def findings(docs: DataFrame, labelled: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every candidate with its score: doc_id, start, end, score, is_secret.

    ``labelled``: judged findings, with the columns of ``candidates`` and ``label`` (0 or 1).
    """
    common.configure(docs.sparkSession)
    found = common.staged(candidates(docs.select("doc_id", "text")), "secrets")
    model = train(labelled_by_rule(found) if labelled is None else labelled, sample_rows)
    if model is None:
        rated = found.withColumn("score", F.lit(1.0))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        rated = model.transform(assembled).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return rated.select("doc_id", "start", "end", "score", (F.col("score") >= ACCEPT).alias("is_secret"))
