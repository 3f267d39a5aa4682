"""Quality rules: a threshold table compiled into one projection (no user functions).

Every metric of a document is a ratio of two counts of the whole text. ``RULES`` lists the bounds;
``quality_columns`` compiles counts and verdict into Spark expressions, so the operator is a narrow
projection: no shuffle, no Python, one pass over the text.

The stop-word rule judges texts whose ``lang`` column names a language with a list (English, French, German, Spanish); texts in other
languages, of unknown language or in a table without that column pass it.

Defined results: a NULL text counts as empty; an empty text has no words and fails the base rule;
a text of any length is judged whole; repeated rows are judged alike; an empty table gives an empty
result; columns of the input that share a name with a metric are dropped by ``judge`` (the metric wins) and
kept unchanged by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeflow.llm.common import SPACE, let, words

#: Base rule: fewer words than this, or a larger share of words in repeated windows, fails.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"

#: Languages that ``STOP_WORDS`` covers.
LANGUAGES = ("en", "fr", "de", "es")

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from or an not have he his they we you "
    "de la le et les des en un du une que est pour qui dans par pas au sur avec ce il se plus "
    "der die und den von zu das mit sich auf für ist im dem nicht ein als eine es auch "
    "el y los del las por con no su para al lo como más pero"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``, judged on texts of at least ``from_words`` words.

    ``listed_only``: judged only on texts whose language is one of ``LANGUAGES``.
    """

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    listed_only: bool = False

    def passes(self, count: dict[str, Column], listed: Column) -> Column:
        top, base = count[self.numerator], count[self.denominator]
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (top >= F.lit(self.low) * base)
        if self.high is not None:
            ok = ok & (top <= F.lit(self.high) * base)
        if self.listed_only:
            ok = ok | ~listed
        return (count["n_words"] < F.lit(self.from_words)) | ok


#: The threshold table.
RULES = (
    Rule("mean word length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols per word", "n_symbols", "n_words", high=0.1),
    Rule("exclamation marks per word", "n_exclamations", "n_words", high=0.3),
    Rule("capitals per word character", "n_capitals", "word_chars", high=0.5),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.03, from_words=50, listed_only=True),
    Rule("repeated lines per line", "n_dup_lines", "n_lines", high=0.5),
    Rule("lines that begin with a bullet", "n_bullet_lines", "n_lines", high=0.9),
    Rule("lines that end in an ellipsis", "n_ellipsis_lines", "n_lines", high=0.5),
)


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).cast("long")


def _repeat_words(w: Column) -> Column:
    """Words covered by windows of five words that occur twice or more in the list ``w``.

    Windows are 64-bit hashes. Only a text with a repeated one sorts (hash, position) pairs, marks equal
    neighbours and sums the covered words in order of position: n log n for any text.
    """
    size = REPEAT_WINDOW

    def covered(grams: Column) -> Column:
        pairs = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(
                s, lambda x, j: x["h"].eqNullSafe(F.get(s, j - 1)["h"]) | x["h"].eqNullSafe(F.get(s, j + 1)["h"])
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            let(pairs, places),
            start,
            lambda acc, p: F.struct((p + size).alias("end"), (acc["n"] + p + size - F.greatest(p, acc["end"])).alias("n")),
            lambda acc: acc["n"],
        )

    def of_grams(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(covered(grams))

    grams = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
    return F.when(F.size(w) < size, F.lit(0).cast("long")).otherwise(let(grams, of_grams))


def _line_counts(text: Column) -> Column:
    def of(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(f"^{SPACE}*[-*•]"))).cast("long").alias("n_bullet_lines"),
            F.size(F.filter(lines, lambda x: x.rlike(rf"(\.\.\.|…){SPACE}*$"))).cast("long").alias("n_ellipsis_lines"),
        )

    return let(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), of)


def _word_counts(w: Column) -> Column:
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )


COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_exclamations", "n_capitals",
    "n_lines", "n_bullet_lines", "n_ellipsis_lines",
)


def quality_struct(text: Column, rules: tuple[Rule, ...] = RULES, listed: Column | None = None) -> Column:
    """All counts, ``base_failed`` and ``kept`` of a text as one struct. ``listed``: its language has a list of stop words (none: no)."""
    listed = F.lit(False) if listed is None else F.coalesce(listed, F.lit(False))

    def of_text(t: Column) -> Column:
        counted = F.struct(
            let(words(t), _word_counts).alias("w"),
            _line_counts(t).alias("l"),
            F.length(F.regexp_replace(t, f"{SPACE}+", "")).cast("long").alias("word_chars"),
            _count(t, SYMBOLS).alias("n_symbols"),
            _count(t, "!").alias("n_exclamations"),
            _count(t, r"\p{Lu}").alias("n_capitals"),
        )
        return let(counted, verdict)

    def verdict(c: Column) -> Column:
        count = {n: c["w"][n] for n in ("n_words", "n_repeat_words", "n_stop_words")}
        count |= {n: c["l"][n] for n in ("n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines")}
        count |= {n: c[n] for n in ("word_chars", "n_symbols", "n_exclamations", "n_capitals")}
        failed = (count["n_words"] < MIN_WORDS) | (
            count["n_repeat_words"] * 100 > count["n_words"] * MAX_REPEAT_PERCENT
        )
        kept = ~failed
        for rule in rules:
            kept = kept & rule.passes(count, listed)
        return F.struct(*(count[n].alias(n) for n in COUNTS), failed.alias("base_failed"), kept.alias("kept"))

    return let(F.coalesce(text, F.lit("")), of_text)


def _listed(docs: DataFrame, lang: str) -> Column | None:
    return F.col(lang).isin(*LANGUAGES) if lang in docs.columns else None


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``."""
    made = {*COUNTS, "base_failed", "kept"}
    rest = [c for c in docs.columns if c.lower() not in made]
    return docs.select(*rest, quality_struct(F.col(text), rules, _listed(docs, lang)).alias("__q")).select(*rest, "__q.*")


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, columns unchanged."""
    return docs.where(quality_struct(F.col(text), rules, _listed(docs, lang))["kept"])
