"""Personal data: fixed patterns, and further spans from weak supervision.

The base kinds (email, ip, card, phone) are found by pattern alone and always
kept. Further candidates (``secret``, ``id`` and phone numbers without a country
code) come from looser patterns. Labelers vote on each candidate, yes (1), no
(-1) or no opinion (0):

* shape: the match looks like a real one (checksum, length, mix of characters),
* gazetteer: the words before it are in a list of telling or of harmless words,
* context: what stands right before and after it,
* spread: its characters are varied, not one repeated.

Expectation-maximisation over the counted vote patterns estimates how often each
labeler is right, and a logistic classifier on votes and kind is then trained on
the posteriors. A candidate it gives at least ``ACCEPT`` becomes a span. The
counted patterns are at most kinds x 3^4 rows whatever the corpus size, so only
that table reaches the driver; finding and scoring spans are column expressions.

Edge cases: NULL and empty texts have no spans; positions count code points;
repeated rows give repeated rows; an empty table gives an empty result; other
columns pass through ``mask`` untouched; ``find_spans`` adds ``_base`` and ``_spans`` to those it is given.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.llm.common import let, whole_text

# The base patterns. Possessive repeats and the look-behind give the same
# matches without backtracking, so long runs stay linear and need no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+\-]))[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9\-]+[0-9]",
}
LOOSE = {
    "secret": r"(?i)(?<![\p{L}0-9_])(?:AKIA[A-Z0-9]{12,}|(?:password|passwd|pwd|secret|token|api[_\-]?key)[\x20]?[=:][\x20]?[\"']?[^\s,;#\"']{4,})",
    "id": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "phone": r"(?<![0-9+.\-])\(?[0-9]{3}\)?[\x20.\-][0-9]{3}[\x20.\-][0-9]{4}(?![0-9.\-])",
}
# A cheap test without which a pattern cannot match.
NEEDS = {
    "email": "@", "phone": "+",
}
KINDS = ("email", "ip", "card", "phone", "secret", "id")
TELLING = "call|phone|tel|fax|mobile|mail|email|contact|ssn|card|visa|password|login|secret|token|key|ip|address"
HARMLESS = "isbn|version|doi|order|page|section|fig|table|chapter|invoice|issue|vol"
LABELERS = ("shape", "gazetteer", "context", "spread")
SPAN = "array<struct<start:int,rank:int,kind:string,stop:int,base:boolean,shape:int,gazetteer:int,context:int,spread:int>>"
EM_ROUNDS = 30
FIT_ROUNDS = 300
ACCEPT = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the checksum; every second one from the right counts double."""
    doubled = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: _luhn_term(
        F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int"), i % 2 == 0
    ))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _luhn_term(digit: Column, second: Column) -> Column:
    return F.when(second, F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)).otherwise(digit)


def _at_most_255(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(F.lit(False))


def _passes(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _at_most_255)
    if kind == "card":
        return let(digits, lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _matches(text: Column, pattern: str) -> Column:
    """All matches with start, end and neighbouring text: the gaps between them give the positions."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(gaps, lambda g: let(found, lambda f: _walk(g, f)))


def _walk(gaps: Column, found: Column) -> Column:
    none = F.array().cast("array<struct<start:int,stop:int,text:string,before:string,after:string>>")

    # No helper lambda here: its result, with all that was found so far, would be copied for each match.
    def step(state: Column, i: Column) -> Column:
        begin = state["at"] + F.length(F.get(gaps, i))
        end = begin + F.length(F.get(found, i))
        return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(
            begin.alias("start"), end.alias("stop"), F.get(found, i).alias("text"),
            F.right(F.get(gaps, i), F.lit(30)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
        )).alias("out"))

    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    walked = F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(found) - 1, F.lit(0))), start, step)["out"]
    return F.when(F.size(found) > 0, walked).otherwise(none)


def _spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    def votes(m: Column) -> Column:
        match, digits = m["text"], _digits(m["text"])
        ok = _passes(kind, match)
        secret = F.rlike(match, F.lit("[0-9]")) & F.rlike(match, F.lit("[A-Za-z]")) & (F.length(match) >= 12)
        shape = _vote(secret, F.length(match) < 10) if kind == "secret" else _vote(
            ok if base else (F.length(digits) == 10) | F.lit(kind == "id"), F.rlike(digits, F.lit("^0+$"))
        )
        before = F.lower(F.concat(m["before"], match if kind == "secret" else F.lit("")))
        gazetteer = _vote(
            F.rlike(before, F.lit(rf"(?:^|[^\p{{L}}])(?:{TELLING})[^\p{{L}}]")),
            F.rlike(before, F.lit(rf"(?:^|[^\p{{L}}])(?:{HARMLESS})[^\p{{L}}]*$")),
        )
        context = _vote(
            F.rlike(m["before"], F.lit(r"(?:^|[\s:=(<\"'])$")) & F.rlike(m["after"], F.lit(r"^(?:$|[\s.,;:)>\"'])")),
            F.rlike(m["before"], F.lit(r"[\p{L}0-9_/]$")) | F.rlike(m["after"], F.lit(r"^[\p{L}0-9_/]")),
        )
        kinds_of_char = F.size(F.array_distinct(F.split(F.left(match, F.lit(40)), "")))
        spread = _vote(kinds_of_char >= 5, kinds_of_char <= 3)
        return F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
            m["stop"].alias("stop"), F.lit(base).alias("base"), shape.alias("shape"), gazetteer.alias("gazetteer"),
            context.alias("context"), spread.alias("spread"),
        )

    found = _matches(text, pattern)
    if base:
        found = F.filter(found, lambda m: _passes(kind, m["text"]))
    spans = F.transform(found, votes).cast(SPAN)
    possible = F.contains(text, F.lit(NEEDS[kind])) if base and kind in NEEDS else F.rlike(text, F.lit(pattern))
    return F.when(possible, spans).otherwise(F.array().cast(SPAN))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base``, the base spans, and ``_more``, the candidates for further ones."""
    text = whole_text()
    base = F.concat(*[_spans(text, kind, pattern, True) for kind, pattern in PATTERNS.items()])
    loose = F.concat(*[_spans(text, kind, pattern, False) for kind, pattern in LOOSE.items()])
    found = docs.withColumn("_base", F.array_sort(base)).withColumn("_loose", loose)
    fresh = F.filter("_loose", lambda c: ~F.exists("_base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    return found.withColumn("_more", fresh).drop("_loose")


@dataclass(frozen=True)
class SpanModel:
    """Coefficients of the span classifier: one per kind and one per labeler, and the labelers' reliabilities."""

    kinds: dict[str, float]
    votes: tuple[float, ...]
    reliability: tuple[float, ...]

    def probability(self, span: Column) -> Column:
        by_kind = reduce(lambda a, k: a.when(span["kind"] == k, self.kinds[k]), KINDS[1:], F.when(span["kind"] == KINDS[0], self.kinds[KINDS[0]]))
        total = reduce(lambda a, b: a + b, [span[name] * F.lit(c) for name, c in zip(LABELERS, self.votes, strict=True)])
        return 1 / (1 + F.exp(-(by_kind + total)))


def vote_patterns(found: DataFrame) -> DataFrame:
    """How often each combination of kind and votes occurs; at most kinds x 3^4 rows."""
    spans = found.select(F.explode(F.concat("_base", "_more")).alias("s"))
    return spans.groupBy("s.kind", *[f"s.{name}" for name in LABELERS]).agg(F.count("*").alias("n"))


def fit(found: DataFrame) -> SpanModel:
    """Estimate reliabilities by expectation-maximisation, then train the classifier on the posteriors."""
    counted = [(r["kind"], tuple(r[name] for name in LABELERS), r["n"]) for r in vote_patterns(found).collect()]
    right = [0.75] * len(LABELERS)
    prior = dict.fromkeys(KINDS, 0.5)
    posterior: dict[tuple, float] = {}
    for _ in range(EM_ROUNDS):
        hits, cast = [1.5] * len(LABELERS), [2.0] * len(LABELERS)
        yes, seen = dict.fromkeys(KINDS, 1.0), dict.fromkeys(KINDS, 2.0)
        for kind, votes, n in counted:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right, strict=True))
            p = posterior[kind, votes] = 1 / (1 + math.exp(-odds))
            yes[kind], seen[kind] = yes[kind] + n * p, seen[kind] + n
            for k, v in enumerate(votes):
                if v:
                    hits[k], cast[k] = hits[k] + n * (p if v > 0 else 1 - p), cast[k] + n
        right = [min(max(h / c, 0.55), 0.95) for h, c in zip(hits, cast, strict=True)]
        prior = {k: min(max(yes[k] / seen[k], 0.2), 0.95) for k in KINDS}
    return _logistic(counted, posterior, right)


def _logistic(counted: list[tuple], posterior: dict[tuple, float], right: list[float]) -> SpanModel:
    kinds, votes = dict.fromkeys(KINDS, 0.0), [0.0] * len(LABELERS)
    total = sum(n for *_, n in counted) or 1
    for _ in range(FIT_ROUNDS):
        by_kind, by_vote = dict.fromkeys(KINDS, 0.0), [0.0] * len(LABELERS)
        for kind, v, n in counted:
            p = 1 / (1 + math.exp(-(kinds[kind] + sum(a * b for a, b in zip(v, votes, strict=True)))))
            error = (posterior[kind, v] - p) * n / total
            by_kind[kind] += error
            by_vote = [g + error * x for g, x in zip(by_vote, v, strict=True)]
        kinds = {k: kinds[k] + 2 * by_kind[k] for k in KINDS}
        votes = [w + 2 * g for w, g in zip(votes, by_vote, strict=True)]
    return SpanModel(kinds, tuple(votes), tuple(right))


def find_spans(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: base spans, and these with the accepted candidates, in order."""
    found = candidates(docs)
    model = model or fit(found)
    accepted = F.filter("_more", lambda s: model.probability(s) >= ACCEPT)
    return found.withColumn("_spans", F.array_sort(F.concat("_base", accepted))).drop("_more")


def count_of(kind: str) -> Column:
    """How many base spans are of this kind."""
    return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")


def listed(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def mask(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, and ``n_chars`` counted anew.

    Overlapping spans become one, named after the first.
    """
    # The columns of the document travel in one struct, so none of them can clash with those made here.
    found = find_spans(docs.select("text", F.struct(*docs.columns).alias("_doc")), model)
    text = whole_text()
    empty = F.array().cast("array<struct<start:int,stop:int,kind:string>>")

    def merge(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"), last["kind"].alias("kind")
        )))
        own = F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        return F.when((F.size(done) > 0) & (s["start"] < last["stop"]), longer).otherwise(F.array_append(done, own))

    merged = found.withColumn("_spans", F.aggregate("_spans", empty, merge))
    pieces = F.transform("_spans", lambda s, i: F.concat(
        F.substr(text, F.coalesce(F.get("_spans", i - 1)["stop"], F.lit(0)) + 1,
                 s["start"] - F.coalesce(F.get("_spans", i - 1)["stop"], F.lit(0))),
        F.lit("["), F.upper(s["kind"]), F.lit("]"),
    ))
    rest = F.substr(text, F.try_element_at("_spans", F.lit(-1))["stop"] + 1, F.length(text))
    masked = F.when(F.size("_spans") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("text"))
    out = merged.select("_doc", masked.alias("_masked"), (F.size("_spans") > 0).alias("_changed"))
    columns = {c: F.col("_doc")[c] for c in docs.columns}
    columns["text"] = F.col("_masked")
    if "n_chars" in columns:
        count = F.length("_masked").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("_changed"), count).otherwise(columns["n_chars"])
    return out.select(*[value.alias(name) for name, value in columns.items()])
