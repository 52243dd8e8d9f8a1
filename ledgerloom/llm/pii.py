"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Patterns find candidate spans. Five labelers vote for, against or not at all on each: the exact
format, a gazetteer (domains, card issuers, address ranges, area codes), the words before it,
its edges and its variety. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is and how likely each pattern is personal data; a logistic regression
learns these probabilities from the votes, kind and length, and rates every candidate.

Candidates of the base patterns that pass their checks are spans whatever the classifier says.
It decides on the others: disguised addresses, numbers without country code, shorter card
numbers and long-form addresses.

All steps are DataFrame functions; the driver sees counts of vote patterns only, whose number
is fixed by the labelers. Found values are not kept, only places.

Defined results: a null or empty text has no spans; repeated rows are rated one by one; spans
that overlap a base span are left out, and of overlapping others the first stays; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm import common
from ledgerloom.llm.spans import first_behind, let, spans

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.5
LABELERS = ("format", "gazetteer", "context", "edges", "variety")
EM_ROUNDS = 50

# The base patterns. Where a match can begin is fixed by a look behind (or the end of the match
# before), and runs do not backtrack, so that no text takes time beyond its length.
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further candidates, in the kind of the base pattern.
MORE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[({{](?:at|AT)[\])}}] ?[A-Za-z0-9-]++"
             r"(?: ?(?:\.|[\[({](?:dot|DOT)[\])}]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Gazetteers and context words (fixed lists).
DOMAINS = "com org net edu gov int info biz io co uk de fr es it eu us ca example test"
CUES = {
    "email": "mail e-mail email contact write to reach from sender",
    "ip": "ip host server address addr client node from",
    "card": "card visa mastercard amex credit debit payment pay account karte carte tarjeta",
    "phone": "phone tel telephone call mobile cell fax contact telefon téléphone teléfono",
}
COUNTER_CUES = "version v isbn issn doi order invoice page section chapter figure table serial sku id"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substr(value, F.length(value) - i, F.lit(1))) - 48
        doubled = F.when(i % 2 == 1, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)
        return total + doubled

    return F.aggregate(F.sequence(F.lit(0), F.length(value) - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The check that a base match must pass."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        return let(digits(value), lambda d: F.length(d).between(16, 19) & luhn(d))
    return F.length(digits(value)).between(8, 15)


def _any(words: str) -> str:
    return "|".join(words.split())


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, base: Column, value: Column, before: Column, after: Column, from_base: bool) -> dict[str, Column]:
    known = {
        "email": value.rlike(rf"(?i)(?:\.|[\])}}] ?)(?:{_any(DOMAINS)})$"),
        "ip": value.rlike(r"^0*(?:[1-9]|[1-9][0-9]|1[013-9][0-9]|12[0-689]|2[01][0-9]|22[0-3])\.|:"),
        "card": value.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"),
        "phone": value.rlike(r"^(?:\+[1-9]|\(?[2-9])"),
    }[kind]
    words = F.lower(before)
    cue = words.rlike(rf"(?:^|[^a-zà-ÿ])(?:{_any(CUES[kind])})[^a-z0-9]{{0,12}}$")
    counter = words.rlike(rf"(?:^|[^a-zà-ÿ])(?:{_any(COUNTER_CUES)})[^a-z0-9]{{0,4}}$")
    joined = before.rlike(r"[A-Za-z0-9_/=#]$") | after.rlike("^[A-Za-z0-9_/=#]")
    characters = F.size(F.array_distinct(F.split(F.lower(F.regexp_replace(value, "[^A-Za-z0-9]", "")), "")))
    return {
        "format": F.when(base, 1).otherwise(-1 if from_base else 0),
        "gazetteer": _vote(known, ~known), "context": _vote(cue, counter),
        "edges": _vote(~joined, joined), "variety": _vote(characters >= 4, characters < 3),
    }


def _candidates(text: Column, kind: str, pattern: str, from_base: bool) -> Column:
    """Structs of place, base flag, votes and length class for all matches of one pattern."""
    def rate(x: Column) -> Column:
        def with_base(base: Column) -> Column:
            votes = _votes(kind, base, x["value"], x["before"], x["after"], from_base)
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                base.alias("base"), *[v.cast("int").alias(name) for name, v in votes.items()],
                F.least(F.floor((x["end"] - x["start"]) / 6), F.lit(5)).cast("int").alias("length"))

        return let(passes(kind, x["value"]) if from_base else F.lit(False), with_base)

    return F.transform(spans(text, pattern), rate)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without texts, with the array ``_candidates`` of all pattern matches."""
    whole = F.coalesce(F.col(text), F.lit(""))
    nothing = F.filter(_candidates(F.lit(""), "email", BASE["email"], True), lambda x: F.lit(False))

    def guarded(kind: str, pattern: str, from_base: bool) -> Column:
        needed = {"email": F.contains(whole, F.lit("@")) if from_base else whole.rlike(r"[\[({](?:at|AT)[\])}]"),
                  "phone": F.contains(whole, F.lit("+")) if from_base else whole.rlike("[0-9]{3}[ .-][0-9]{4}")}
        found = _candidates(whole, kind, pattern, from_base)
        return F.when(needed.get(kind, whole.rlike("[0-9]")), found).otherwise(nothing)

    arrays = [guarded(k, p, True) for k, p in BASE.items()] + [guarded(k, p, False) for k, p in MORE.items()]
    return docs.withColumn("_candidates", F.concat(*arrays)).drop(text)


# ------------------------------------------------------------------ labelers

def estimate(patterns: list[tuple[int, tuple[int, ...], float]]) -> dict[tuple[int, tuple[int, ...]], float]:
    """Probability of each vote pattern (kind, votes) by expectation-maximisation.

    Votes are taken as independent given the truth. The counts of votes for and against start it.
    """
    shares = {}
    for kind, votes, _ in patterns:
        shares[kind, votes] = 1 / (1 + math.exp(-float(sum(votes))))
    for _ in range(EM_ROUNDS):
        prior = {}
        table = [[{-1: 1.0, 0: 1.0, 1: 1.0} for _ in LABELERS] for _ in (0, 1)]
        for kind, votes, n in patterns:
            p = shares[kind, votes]
            yes, all_ = prior.get(kind, (1.0, 2.0))
            prior[kind] = yes + n * p, all_ + n
            for j, vote in enumerate(votes):
                table[1][j][vote] += n * p
                table[0][j][vote] += n * (1 - p)
        rates = [[{v: c / sum(votes.values()) for v, c in votes.items()} for votes in side] for side in table]
        for kind, votes, _ in patterns:
            odds = math.log(prior[kind][0] / (prior[kind][1] - prior[kind][0]))
            odds += sum(math.log(rates[1][j][v] / rates[0][j][v]) for j, v in enumerate(votes))
            shares[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return shares


def _inputs(x: Column | None = None) -> list[Column]:
    """Inputs of the span classifier, from a candidate struct or from columns of that name."""
    field = (lambda name: x[name]) if x is not None else F.col
    return ([(field("kind") == k).cast("double") for k in range(len(KINDS))]
            + [field(name).cast("double") for name in LABELERS] + [field("length").cast("double")])


def train(rated: DataFrame) -> list[float]:
    """Intercept and coefficients of the span classifier, from all candidates' vote patterns.

    The patterns are counted by Spark; their number is bounded by kinds, votes and length classes.
    """
    counted = rated.select(F.explode("_candidates").alias("c")).select("c.*").groupBy(
        "kind", *LABELERS, "length").agg(F.count("*").alias("n")).orderBy("kind", *LABELERS, "length")
    rows = counted.collect()
    if not rows:
        return []
    merged: dict = {}
    for r in rows:
        key = r.kind, tuple(r[name] for name in LABELERS)
        merged[key] = merged.get(key, 0.0) + r.n
    shares = estimate([(k, v, n) for (k, v), n in sorted(merged.items())])
    soft = []
    for r in rows:
        p = min(max(shares[r.kind, tuple(r[name] for name in LABELERS)], 0.001), 0.999)
        soft += [(*r[:-1], 1.0, r.n * p), (*r[:-1], 0.0, r.n * (1 - p))]
    spark = rated.sparkSession
    schema = ", ".join(f"{name} int" for name in ("kind", *LABELERS, "length")) + ", label double, weight double"
    frame = spark.createDataFrame(soft, schema).coalesce(1)
    names = [f"x{i}" for i in range(len(KINDS) + len(LABELERS) + 1)]
    inputs = VectorAssembler(inputCols=names, outputCol="features").transform(
        frame.select("label", "weight", *[c.alias(n) for c, n in zip(_inputs(), names)]))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50).fit(inputs)
    return [float(model.intercept), *map(float, model.coefficients)]


def _probability(x: Column, model: list[float]) -> Column:
    odds = reduce(lambda a, b: a + b, [F.lit(w) * c for w, c in zip(model[1:], _inputs(x))], F.lit(model[0]))
    return 1 / (1 + F.exp(-odds))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without texts, with ``base`` and ``added``: arrays of (kind, start, end), in order."""
    common.configure(docs.sparkSession)
    rated = common.staged(candidates(docs, text), "pii")
    model = train(rated)
    place = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
    base = F.transform(F.filter("_candidates", lambda x: x["base"]), place)
    accepted = (lambda x: ~x["base"] & (_probability(x, model) >= ACCEPT)) if model else (lambda x: F.lit(False))
    # the matches of one pattern are in order and do not overlap: a lane
    sourced = lambda x: F.struct(*(x[c].alias(c) for c in ("kind", "start", "end")), (x["format"] == 0).alias("further"))
    rated = rated.withColumn("base", base).withColumn(
        "_more", F.array_sort(F.transform(F.filter("_candidates", accepted), sourced)))
    lanes = {(kind, further): f"_lane{kind}{further:d}" for kind in range(len(KINDS)) for further in (False, True)}
    rated = rated.withColumns({f"_base{kind}": F.filter("base", lambda x: x["kind"] == kind) for kind in range(len(KINDS))})
    rated = rated.withColumns({name: F.filter("_more", lambda x: (x["kind"] == kind) & (x["further"] == further))
                               for (kind, further), name in lanes.items()})

    def meets(lane: str, x: Column) -> Column:
        return F.coalesce(first_behind(F.col(lane), x["start"])["start"] < x["end"], F.lit(False))

    def meets_earlier(lane: str, x: Column) -> Column:
        """Is there a span in the other lane of the kind that meets x and comes before it?"""
        return F.coalesce(let(first_behind(F.col(lane), x["start"]),
                              lambda y: (y["start"] < x["end"]) & (y < x)), F.lit(False))

    def is_free(x: Column) -> Column:
        taken = [meets(f"_base{kind}", x) for kind in range(len(KINDS))]
        taken += [(x["kind"] > kind) & meets(name, x) for (kind, _), name in lanes.items()]
        taken += [(x["kind"] == kind) & (x["further"] != further) & meets_earlier(name, x)
                  for (kind, further), name in lanes.items()]
        return ~reduce(lambda a, b: a | b, taken)

    free = F.transform(F.filter("_more", is_free), place)
    return rated.withColumn("added", free).drop(
        "_candidates", "_more", *lanes.values(), *(f"_base{kind}" for kind in range(len(KINDS))))


def joined(found: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """Counts and a digest of the base spans, and all spans, for every document."""
    found = with_spans(docs.select("doc_id", "text"))
    counts = [_count(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
