"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

``labelled`` makes a small labelled table of URLs from lists of words, ``read_labelled`` reads one; ``train`` fits spark.ml's logistic regression on the
n-grams of host and path, hashed to ``FEATURES`` slots; ``judge`` applies rules and model. All of it is JVM-side: SQL
functions and spark.ml, no Python code on the rows, no shuffle.

Defined results: a NULL url, or one without ``://``, has an empty host and path, fits no rule and is judged by the
model on no features; texts of any length are judged whole; repeated rows are judged alike; an empty table
gives an empty result; other columns are carried (one called host, path, rule or verdict is replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = 1 << 18
NGRAMS = (3, 4, 5)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

#: The labelled table: hosts and paths made of words that a filter of unwanted pages blocks, and of ordinary ones.
BLOCKED_WORDS = (
    "casino poker slots jackpot bets betting gamble lottery roulette pills pharmacy viagra cialis adult porn xxx sex "
    "escort webcam nude cheap discount replica loans payday credit winner prize free-money ads banner track tracker "
    "tracking clickbait popup spam farm malware crack keygen warez torrent hack phish"
).split()
ALLOWED_WORDS = (
    "news wiki library university school college museum science history research journal physics chemistry biology "
    "garden kitchen recipes travel weather sports football music cinema theatre books novels poetry photo camera "
    "health doctor hospital city council government law court finance economy market software developer docs manual "
    "guide tutorial forum community project archive radio local village river mountain ocean forest house family "
    "children language english french german spanish maths education teacher student engine railway airport "
    "table stable possible people vegetable cable bible building reading writing learning training printing wedding "
    "fishing sailing station nation action edition kitchenware theory earth health thread thunder other another"
).split()


def labelled(spark: SparkSession, blocked: list[str] = BLOCKED_WORDS, allowed: list[str] = ALLOWED_WORDS) -> DataFrame:
    """(url, label): each word alone in a host, joined with one of its kind and an ordinary one, and in a path. Label 1: block."""
    rows = []
    for label, words in ((1.0, blocked), (0.0, allowed)):
        for k, w in enumerate(words):
            other, plain = words[(k + 1) % len(words)], allowed[(7 * k + 3) % len(allowed)]
            zone, under = ("com", "net", "org")[k % 3], ("www.", "", "blog.", "m.")
            rows.append((f"http://{under[k % 4]}{w}.example.{zone}/", label))
            rows.append((f"https://{under[(k + 1) % 4]}{w}-{other}.example.{zone}/en/{k}", label))
            rows.append((f"http://{under[(k + 2) % 4]}{plain}-{w}.example.{zone}/", label))
            rows.append((f"http://{under[(k + 3) % 4]}{plain}.example.net/{w}/{k}.html", label))
    column = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows))
    return spark.range(1).select(F.inline(column))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits, else NULL. A rule fits its host and all subdomains."""
    longest = sorted(rules, key=lambda r: -len(r.text))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in longest]
    return F.coalesce(F.lit(None).cast("string"), *(F.when(ok, F.lit(value(r))) for ok, r in zip(fits, longest)))


def _grams(text: Column, mark: str) -> Column:
    """Character n-grams; what stands between words is one bar, so a word looks alike wherever it stands."""
    framed = F.concat(F.lit("|"), F.regexp_replace(text, "[^\\p{L}\\p{N}]+", "|"), F.lit("|"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(framed) - (n - 1))
        grams = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(n))))
        return F.when(F.length(framed) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of_length, NGRAMS))


def features(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host, path and ``__grams``; the word after the last dot and digits carry no content."""
    out = urls.withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    name = F.regexp_replace(F.col("host"), r"\.[^.]*$", "")
    words = F.regexp_replace(F.lower(F.col("path")), "[0-9]+", "0")
    return out.withColumn("__grams", F.concat(_grams(name, "h"), _grams(words, "p")))


def train(table: DataFrame, url: str = "url", label: str = "label", reg: float = 0.01, cut: float = 0.65) -> PipelineModel:
    """Fit on a small table (url, label): hundreds to some 100,000 rows. Above probability ``cut`` the model blocks."""
    hashing = HashingTF(inputCol="__grams", outputCol="__features", numFeatures=FEATURES, binary=True)
    made = hashing.transform(features(table, url)).select(F.col(label).cast("double").alias("__label"), "__features").coalesce(1)
    model = LogisticRegression(
        featuresCol="__features", labelCol="__label", predictionCol="__blocked", rawPredictionCol="__raw", probabilityCol="__probability", maxIter=60, regParam=reg, threshold=cut
    ).fit(made)
    return PipelineModel([hashing, model])


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """A labelled table (url, label; 1: block) from a Parquet file or a CSV file with a header."""
    rows = spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("header", "true").csv(path)
    return rows.select(F.col("url").cast("string"), F.col("label").cast("double"))


def held_out(table: DataFrame, group: Column, folds: int = 5) -> tuple[float, float]:
    """Precision and recall of blocking on rows left out of training: each fold holds the groups of one hash remainder."""
    part, hits, blocked, bad = F.pmod(F.xxhash64(group), F.lit(folds)), 0, 0, 0
    for k in range(folds):
        seen = judge(table.where(part == k), train(table.where(part != k)), rules=()).select("label", (F.col("verdict") == "block").alias("b"))
        r = seen.agg(F.count_if(F.col("b") & (F.col("label") == 1)), F.count_if("b"), F.count_if(F.col("label") == 1)).head()
        hits, blocked, bad = hits + r[0], blocked + r[1], bad + r[2]
    return hits / max(1, blocked), hits / max(1, bad)


def judge(urls: DataFrame, model: PipelineModel, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule and verdict (the rule's, else the model's)."""
    made = ("host", "path", "rule", "verdict")
    carried = [c for c in urls.columns if c.lower() not in made]
    row = F.struct(*(F.col(f"`{c}`") for c in carried)).alias("__row")  # whatever the columns are called
    scored = model.transform(features(urls.select(row, F.col(url).alias("__url")), "__url"))
    host, path = F.col("host"), F.col("path")
    scored = scored.withColumn("rule", rule_column(host, path, rules, lambda r: r.text))
    by_rule = rule_column(host, path, rules, lambda r: r.verdict)
    by_model = F.when(F.col("__blocked") == 1.0, "block").otherwise("allow")
    scored = scored.withColumn("verdict", F.coalesce(by_rule, by_model))
    return scored.select("__row.*", *made)
