"""Personal data by weak supervision.

``base_spans`` finds e-mail addresses, IP addresses, card and phone numbers by pattern and check digit. Beyond them, every token
with a digit or an @ is a candidate on which labelers vote private, not private or nothing: patterns (shape of
keys, hexadecimal strings, plain numbers), a gazetteer (prefixes of issued keys) and context (words before it). Expectation
maximisation over the counts of vote patterns estimates how reliable each labeler is, and its posteriors train the
final classifier, a logistic regression on votes and shape. Accepted candidates are added as spans of kind ``secret``.

Everything that touches text is built-in SQL functions. The driver sees the counts of distinct patterns: at most
3 ** labelers times ``SHAPES`` rows, whatever the corpus, and does plain arithmetic on them. All candidates of the
corpus are counted; there is no sample.

Positions are code points; a match is found with ``regexp_extract_all`` and placed with ``split`` on the same pattern. The
patterns are possessive and anchored at the start of a run, so the time is linear in the text for any text.

Defined results: a NULL text counts as empty and has no spans; a text of any length is searched whole; repeated rows get the
same spans; an empty table gives an empty result; other columns are ignored whatever their names.

Out of reach: secrets with blanks in them (numbers in groups), names and postal addresses; candidates are single tokens.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeflow.llm.common import let, staged

#: Base kinds in order. Each pattern matches the same text as its plain form (in comments).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
CARD = r"[0-9](?:[\x20-]?[0-9])++"  # [0-9]([\x20-]?[0-9])+
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
ADDED = "secret"

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Tokens that may be private: at least six of these characters, one a digit or @, or sixteen capitals in a row.
_TOKEN = "A-Za-z0-9_.@+/-"
CANDIDATE = rf"(?<![{_TOKEN}])(?=[A-Za-z_.+/-]*+[0-9@]|[A-Z]{{16}})[{_TOKEN}]{{6,}}+"
CONTEXT_CHARS = 32


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value, before) of all matches of ``pattern``; ``before`` ends the text in front."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")

    def placed(found: Column) -> Column:
        def walk(between: Column) -> Column:
            def step(acc: Column, i: Column) -> Column:
                gap, value = F.get(between, i), F.get(found, i)
                start = acc["at"] + F.length(gap)
                end = start + F.length(value)
                one = F.struct(start.alias("start"), end.alias("end"), value.alias("value"), F.right(gap, F.lit(CONTEXT_CHARS)).alias("before"))
                return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

            first = F.struct(F.lit(0).alias("at"), empty.alias("out"))
            return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda acc: acc["out"])

        return F.when(F.size(found) == 0, empty).otherwise(let(F.split(text, pattern, -1), walk))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def total(backwards: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            d = F.substring(backwards, i, F.lit(1)).cast("int")
            double = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return acc + F.when(i % 2 == 0, double).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add)

    return let(F.reverse(digits), total) % 10 == 0


def _valid_card(value: Column) -> Column:
    return let(_digits(value), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(F.lit(False)))


_VALID: dict[str, tuple[str, str, Callable[[Column], Column]]] = {
    "email": (EMAIL, "@", lambda v: F.lit(True)),
    "ip": (IP, "[0-9]", lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": (CARD, "[0-9]", _valid_card),
    "phone": (PHONE, r"\+[0-9]", lambda v: F.length(_digits(v)).between(9, 15)),
}


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end) of the base kinds, by start, then kind. ``text`` must not be NULL."""

    def of(number: int, kind: str) -> Column:
        pattern, needs, valid = _VALID[kind]
        found = F.filter(matches(text, pattern), lambda m: valid(m["value"]))
        spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))
        return F.when(text.rlike(needs), spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))

    return F.array_sort(F.concat(*(of(k, kind) for k, kind in enumerate(KINDS))))


# --- labelers ---------------------------------------------------------------------------------------------------------


def _votes(when: Column, vote: int) -> Column:
    return F.when(when, F.lit(vote)).otherwise(F.lit(0))


#: name: vote (1 private, -1 not, 0 nothing) on a candidate's value, the text before it and whether a base span covers it.
LABELERS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "base pattern": lambda v, b, base: _votes(base, 1),
    "key shape": lambda v, b, base: _votes(v.rlike(r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]{16,}$"), 1),
    "hexadecimal": lambda v, b, base: _votes(v.rlike(r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$"), 1),
    "long and mixed": lambda v, b, base: F.when(v.rlike(r"^(?=(?:[^0-9]*+[0-9]){3})(?=(?:[^A-Za-z]*+[A-Za-z]){3})[A-Za-z0-9_+/-]{14,}$"), F.lit(1)).otherwise(
        _votes(F.length(v) < 12, -1)
    ),
    "number or date": lambda v, b, base: _votes(v.rlike(r"^[0-9]{1,8}(?:[-/.][0-9]{1,8}){0,3}\.?$"), -1),
    "known prefix": lambda v, b, base: _votes(v.rlike(r"^(?:AKIA|ASIA|ghp_|gho_|glpat-|sk-|pk_|rk_|xox[abp]-|AIza|eyJ)"), 1),
    "word with a number": lambda v, b, base: _votes(v.rlike(r"^(?:[A-Za-z]+[-_.]?[0-9]{1,4}|[0-9]{1,4}[-_.]?[A-Za-z]+)\.?$"), -1),
    "secret named before": lambda v, b, base: _votes(
        b.rlike(r"(?i)(?:passw(?:or)?d|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|auth|bearer|credential|iban|ssn|passport)[^\p{L}\p{N}]{0,4}$"), 1
    ),
    "count named before": lambda v, b, base: _votes(
        b.rlike(r"(?i)(?<![\p{L}])(?:version|license|licence|page|chapter|section|figure|table|volume|vol|no|nr|year)[^\p{L}\p{N}]{0,3}$"), -1
    ),
}
#: Upper ends of buckets of length and percent of digits.
LENGTHS = (8, 12, 16, 24, 40)
DIGITS = (10, 30, 60, 99)
SHAPES = (len(LENGTHS) + 1) * (len(DIGITS) + 1)


def _bucket(value: Column, ends: Sequence[int]) -> Column:
    out = F.lit(len(ends))
    for k in reversed(range(len(ends))):
        out = F.when(value <= ends[k], F.lit(k)).otherwise(out)
    return out


def candidate_spans(text: Column, base: Column) -> Column:
    """Array of (start, end, covered, pattern): ``pattern`` holds all votes, then the buckets of the shape."""

    def of(m: Column) -> Column:
        covered = F.exists(base, lambda s: (s["start"] < m["end"]) & (m["start"] < s["end"]))

        def judged(c: Column) -> Column:
            votes = [vote(m["value"], m["before"], c) for vote in LABELERS.values()]
            share = F.length(_digits(m["value"])) * 100 / F.length(m["value"])
            pattern = F.array(*votes, _bucket(F.length(m["value"]), LENGTHS), _bucket(share, DIGITS))
            return F.struct(m["start"].alias("start"), m["end"].alias("end"), c.alias("covered"), pattern.alias("pattern"))

        return let(covered, judged)

    empty = F.array().cast("array<struct<start:int,end:int,covered:boolean,pattern:array<int>>>")
    return F.when(text.rlike("[0-9@]|[A-Z]{16}"), F.transform(matches(text, CANDIDATE), of)).otherwise(empty)


# --- fitting, on counts of patterns ---------------------------------------------------------------------------------------

Pattern = tuple[int, ...]


def fit_reliabilities(counts: dict[Pattern, int], rounds: int = 60, smooth: float = 0.5) -> dict[Pattern, float]:
    """Posterior that a candidate with these votes is private, by expectation maximisation.

    Labelers vote independently given the class; each has its own chances of the three votes in either class.
    Starts from the balance of votes.
    """
    posterior = {p: 1 / (1 + math.exp(-2.0 * sum(p))) for p in counts}
    n = len(next(iter(counts), ()))
    for _ in range(rounds):
        mass = [smooth, smooth]
        chance = [[{-1: smooth, 0: smooth, 1: smooth} for _ in range(n)] for _ in range(2)]
        for p, c in counts.items():
            for y, w in ((1, posterior[p] * c), (0, (1 - posterior[p]) * c)):
                mass[y] += w
                for j, v in enumerate(p):
                    chance[y][j][v] += w
        for p in counts:
            logs = [math.log(mass[y]) + sum(math.log(chance[y][j][v] / sum(chance[y][j].values())) for j, v in enumerate(p)) for y in (0, 1)]
            posterior[p] = 1 / (1 + math.exp(max(-700.0, min(700.0, logs[0] - logs[1]))))
    return posterior


def _names(pattern: Pattern) -> list[tuple[int, int]]:
    """Features of a pattern: (place, value) pairs; a vote of 0 says nothing."""
    n = len(LABELERS)
    return [(j, v) for j, v in enumerate(pattern) if j >= n or v]


def fit_classifier(soft: dict[Pattern, tuple[float, float]], rounds: int = 400, rate: float = 0.5, decay: float = 1e-3) -> dict[tuple[int, int], float]:
    """Logistic regression on (place, value) features. ``soft``: pattern to (weight, share of private)."""
    total = sum(w for w, _ in soft.values()) or 1.0
    weight: dict[tuple[int, int], float] = {(-1, 0): -2.0}
    for p in soft:
        weight |= {name: 0.0 for name in _names(p)} | {(-1, 0): weight[(-1, 0)]}
    speed = dict.fromkeys(weight, 1e-8)
    for _ in range(rounds):
        slope = {k: decay * w for k, w in weight.items()}
        for p, (n, share) in soft.items():
            names = [(-1, 0), *_names(p)]
            z = sum(weight[k] for k in names)
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - share) * n / total
            for k in names:
                slope[k] += error
        for k, g in slope.items():
            speed[k] += g * g
            weight[k] -= rate * g / math.sqrt(speed[k])
    return weight


#: A candidate is added from this probability on.
ACCEPT = 0.9


def _accepted(pattern: Column, weight: dict[tuple[int, int], float]) -> Column:
    score = F.lit(weight[(-1, 0)])
    places: dict[int, list[tuple[int, float]]] = {}
    for (j, v), w in weight.items():
        if j >= 0:
            places.setdefault(j, []).append((v, w))
    for j, options in places.items():
        term = F.lit(0.0)
        for v, w in options:
            term = F.when(F.get(pattern, F.lit(j)) == v, F.lit(w)).otherwise(term)
        score = score + term
    return score >= math.log(ACCEPT / (1 - ACCEPT))


def _text_of(spans: Column, names: Sequence[str]) -> Column:
    kinds = F.array(*map(F.lit, names))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def find_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, base and added spans (start, kind number, end) as arrays ``base`` and ``spans``."""

    def searched(t: Column) -> Column:
        return let(base_spans(t), lambda b: F.struct(b.alias("base"), candidate_spans(t, b).alias("candidates")))

    found = docs.select(F.col(key).alias(key), let(F.coalesce(F.col(text), F.lit("")), searched).alias("__f"))
    found = staged(found.select(F.col(key).alias("key"), "__f.base", "__f.candidates"), "pii-spans")
    # At most 3 ** len(LABELERS) * SHAPES rows reach the driver.
    patterns = found.select(F.explode("candidates.pattern").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[Pattern, int] = {tuple(r["p"]): r["n"] for r in patterns}
    n = len(LABELERS)
    votes: dict[Pattern, int] = {}
    for p, c in counts.items():
        votes[p[:n]] = votes.get(p[:n], 0) + c
    private = fit_reliabilities(votes)
    # A frequent pattern weighs more, but does not drown a rare one.
    weight = fit_classifier({p: (1 + math.log(c), private[p[:n]]) for p, c in counts.items()})
    added = F.transform(
        F.filter("candidates", lambda c: ~c["covered"] & _accepted(c["pattern"], weight)),
        lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), c["end"].alias("end")),
    )
    return found.select(F.col("key").alias(key), "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_table(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and span lists as text: ``key``, n_<kind>, base_sha256, spans, n_added (spans beyond the base kinds)."""
    counted = [_count_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        key,
        *counted,
        F.sha2(_text_of(F.col("base"), KINDS), 256).alias("base_sha256"),
        _text_of(F.col("spans"), (*KINDS, ADDED)).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


def _count_kind(number: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long")


def mask(docs: DataFrame, found: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``masked``: the text with each span replaced by its kind in angle brackets (``key`` unique)."""
    names = F.array(*(F.lit(f"<{k}>") for k in (*KINDS, ADDED)))
    spans = found.select(F.col(key).alias("__key"), F.col("spans").alias("__spans"))
    joined = docs.join(spans, docs[key] == spans["__key"], "left")
    body = F.coalesce(F.col(text), F.lit(""))

    def step(acc: Column, s: Column) -> Column:
        new = F.concat(acc["out"], F.substring(body, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        fits = s["start"] >= acc["at"]
        return F.struct(F.when(fits, s["end"]).otherwise(acc["at"]).alias("at"), F.when(fits, new).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    spans_or_none = F.coalesce("__spans", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    masked = F.aggregate(spans_or_none, start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    return joined.withColumn("masked", masked).drop("__key", "__spans")
