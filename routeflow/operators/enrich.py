"""Text enrichment: prompt construction, classification and one-sentence summaries.

Providers come in two kinds:

* **Column providers** build the output as a Spark expression (deterministic stand-ins, no Python
  in the hot path): ``RuleClassifier``, ``TemplateSummarizer``.
* **Batch providers** take a pandas Series of prompts and return a Series of outputs (e.g. a model
  client). Each distinct prompt is scored once, row count is kept, NULL prompts give NULL. Answers are stored when the result is built.
  Where few prompts serve many rows they are *de-duplicated and joined back*: distinct prompts -> ``mapInPandas`` in Arrow batches -> left
  join on a digest of the prompt, a broadcast of few answers, so that no row moves. Otherwise rows are *scored in place*: dealt by their
  prompt and sorted, so that equal ones meet in one task, and stored with their answers. Rows move once, and neither prompts, digests nor
  answers are shuffled. Prompts that many rows share are left out of that and joined back.

With a **memo**, a layer table of prompt digests and answers, only prompts that no earlier run has an answer for are scored. A prompt
whose scoring fails is kept there with its error, gives NULL, and is tried again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow import fixed_values as FV
from routeflow.functions import columns as C
from routeflow.schemas import ENRICHED_COLUMNS
from routeflow.session import shared_root, staged
from routeflow.sources import ledger
from routeflow.sources.tables import COMPRESSION, new_load_id, read_layer, read_slices, stage_slice

ENRICH_BASE_COLUMNS = tuple(c for c in ENRICHED_COLUMNS if c not in ("route_classification", "route_summary", "enriched_at"))
NUMERIC_PLACEHOLDERS = ("distance_km", "seats")


# --- prompts --------------------------------------------------------------------------------


def prompt(template: Sequence[str], numeric: Sequence[str] = NUMERIC_PLACEHOLDERS) -> Column:
    """Prompt text from a template; numbers rendered without float noise; NULL if any part is NULL."""
    names = [p[1:-1] for p in template if p.startswith("{") and p.endswith("}")]
    cols = {n: (C.number_text(n) if n in numeric else F.col(n)) for n in names}
    return C.template(template, cols)


def prompt_present(template: Sequence[str], numeric: Sequence[str] = NUMERIC_PLACEHOLDERS) -> Column:
    """TRUE exactly when ``prompt(template)`` is not NULL, without building the string."""
    names = [p[1:-1] for p in template if p.startswith("{") and p.endswith("}")]
    return C.all_of(
        F.col(n).try_cast(T.DecimalType(38, 6)).isNotNull() if n in numeric else F.col(n).isNotNull() for n in names
    )


def classify_prompt() -> Column:
    return prompt(FV.CLASSIFY_PROMPT_TEMPLATE)


def summary_prompt() -> Column:
    return prompt(FV.SUMMARY_PROMPT_TEMPLATE)


# --- providers ------------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleClassifier:
    """Label from the curated flag and distance (our rule; thresholds reuse the category bounds).

    not international and < 1500 -> DOMESTIC_SHORT; not international -> DOMESTIC_LONG;
    international and < 4000 -> INTERNATIONAL_REGIONAL; otherwise INTERNATIONAL_LONG_HAUL.
    """

    flag: str = "is_international"
    distance: str = "distance_km"
    labels: Sequence[str] = FV.ROUTE_LABELS

    def column(self, df: DataFrame) -> Column:
        short, regional = FV.DISTANCE_CATEGORIES[0][0], FV.DISTANCE_CATEGORIES[1][0]
        dom_short, dom_long, intl_regional, intl_long = self.labels
        intl, dist = F.col(self.flag), F.col(self.distance)
        return (
            F.when(~intl & (dist < short), F.lit(dom_short))
            .when(~intl, F.lit(dom_long))
            .when(dist < regional, F.lit(intl_regional))
            .otherwise(F.lit(intl_long))
        )


@dataclass(frozen=True)
class TemplateSummarizer:
    """Deterministic one-sentence summary built from the row (our wording)."""

    def column(self, df: DataFrame) -> Column:
        return F.concat(
            F.col("airline_name"), F.lit(" flight "), F.col("flight_number"),
            F.lit(" flies from "), F.col("origin_city"), F.lit(" ("), F.col("origin_country"), F.lit(")"),
            F.lit(" to "), F.col("destination_city"), F.lit(" ("), F.col("destination_country"), F.lit("), "),
            C.number_text("distance_km"), F.lit(" km with "), C.number_text("seats"),
            F.lit(" seats on a "), F.col("aircraft_type"), F.lit("."),
        )


@dataclass(frozen=True)
class KeywordClassifier:
    """The label whose words (split at ``_``) make up the largest share found in the prompt; the first of equals.

    Works for any list of labels; NULL if no word of any label occurs.
    """

    prompt: Column
    labels: Sequence[str]

    def column(self, df: DataFrame) -> Column:
        text = F.lower(self.prompt)
        scores = []
        for label in self.labels:
            words = [w for w in label.lower().split("_") if w]
            found = sum((F.when(text.contains(w), 1).otherwise(0) for w in words), F.lit(0))
            scores.append(found / F.lit(float(max(1, len(words)))))
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        picked = F.coalesce(*(F.when(s == best, F.lit(label)) for s, label in zip(scores, self.labels)))
        return F.when(best > 0, picked)


class BatchProvider:
    """A text function applied to batches of distinct prompts inside executors.

    ``fn`` maps a pandas Series of prompts to a Series of outputs of the same length; it is called with at most
    ``batch_size`` prompts at a time (bounded request size for remote models), and with ``model`` as second argument if that is given.
    A function that workers cannot import must be defined so that it is sent by value (nested, or in a script).

    ``partitions`` is the number of scoring tasks (default: the session's shuffle partitions, not coalesced; where rows are scored in
    place, more if a task would have over ``ROWS_A_TASK`` rows).
    ``field`` names the member to read when the provider answers with a JSON object per prompt
    (e.g. ``{"label": "DOMESTIC_SHORT"}`` read at ``label``) instead of plain text.

    ``memo`` is the path of a memo table. Answers are kept per ``name`` (what ``fn`` is; part of the key), model and prompt.
    """

    def __init__(self, fn: Callable[..., pd.Series], batch_size: int = 512, partitions: int | None = None,
                 field: str | None = None, model: str | None = None, memo: str | None = None, name: str = ""):
        self.fn = fn
        self.batch_size = batch_size
        self.partitions = partitions
        self.field = field
        self.model = model
        self.memo = memo
        self.name = name

    def digest(self, prompt: Column) -> Column:
        return F.sha2(F.to_json(F.array(F.lit(self.name), F.lit(self.model or ""), prompt)), 256)


def keyword_scorer(labels: Sequence[str]) -> Callable[[pd.Series], pd.Series]:
    """A batch function over any texts: the label of which the largest share of words (split at ``_``) occurs in the text.

    The first of equals; None if no word of any label occurs. Nested, so that it travels by value and workers need not import this package.
    """
    parts = [(label, [w for w in label.lower().split("_") if w]) for label in labels]

    def labels_of(texts: pd.Series) -> pd.Series:
        lower = texts.str.lower()
        share = pd.DataFrame({label: sum(lower.str.contains(w, regex=False).astype(int) for w in ws) / max(1, len(ws)) for label, ws in parts})
        return share.idxmax(axis=1).where(share.max(axis=1) > 0, None)

    return labels_of


#: What ``fact_lister`` picks out, by model name: numbers, and capitalised names of one or more words.
FACT_MODELS = {"numbers": r"[0-9]+", "names": r"[A-Z][A-Za-z]*(?: [A-Z][A-Za-z]*)*"}


def fact_lister(separator: str = "; ") -> Callable[[pd.Series, str], pd.Series]:
    """A batch function over any texts: the facts of the kind its model names, in order."""
    models = dict(FACT_MODELS)

    def facts_of(texts: pd.Series, model: str) -> pd.Series:
        return texts.str.findall(models[model]).str.join(separator)

    return facts_of


Provider = RuleClassifier | KeywordClassifier | TemplateSummarizer | BatchProvider


# --- operators ------------------------------------------------------------------------------


#: Rows of a memo table: an answer, or the error of a prompt that has none yet.
MEMO_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in ("digest", "answer", "error")])


def _scorer(provider: BatchProvider) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    fn, size, extra = provider.fn, provider.batch_size, () if provider.model is None else (provider.model,)
    keep_errors = provider.memo is not None

    def answers(prompts: pd.Series) -> pd.Series:
        return pd.Series(fn(prompts, *extra)).astype(object).reset_index(drop=True)

    def one_by_one(prompts: pd.Series) -> tuple[list, list]:
        out, errors = [], []
        for k in range(len(prompts)):
            try:
                out.append(answers(prompts.iloc[k : k + 1].reset_index(drop=True)).iloc[0])
                errors.append(None)
            except Exception as error:  # whatever a provider raises is kept with its prompt
                out.append(None)
                errors.append(f"{type(error).__name__}: {error}")
        return out, errors

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), size):
                part = pdf.iloc[start : start + size].reset_index(drop=True)
                try:
                    out, errors = answers(part["prompt"]), None
                except Exception:
                    if not keep_errors:
                        raise
                    out, errors = one_by_one(part["prompt"])
                yield pd.DataFrame({"digest": part["digest"], "answer": out, "error": errors}, dtype=object)

    return score


def _scored(prompts: DataFrame, provider: BatchProvider) -> DataFrame:
    """(digest, answer, error) of distinct (digest, prompt) rows, by the stated number of tasks.

    Dealt round-robin into a given number, which AQE neither merges nor drops: slow providers are called by that many tasks.
    """
    tasks = provider.partitions or int(prompts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return prompts.repartition(tasks).mapInPandas(_scorer(provider), MEMO_SCHEMA)


def memo_answers(spark, memo: str) -> DataFrame:
    """(digest, answer) of the prompts a memo table has an answer for; the smallest where runs that met have scored one twice."""
    return read_layer(spark, memo, MEMO_SCHEMA).where(F.col("error").isNull()).groupBy("digest").agg(F.min("answer").alias("answer"))


def score_unseen(prompts: DataFrame, provider: BatchProvider) -> int:
    """Score the prompts (digest, prompt) that the memo has no answer for and commit the results to it; returns how many were scored."""
    spark = prompts.sparkSession
    known = read_layer(spark, provider.memo, MEMO_SCHEMA).where(F.col("error").isNull()).select("digest").distinct()
    load_id = new_load_id("memo")
    folder = stage_slice({"rows": _scored(prompts.join(known, "digest", "left_anti"), provider)}, provider.memo, load_id)
    count = read_slices(spark, provider.memo, MEMO_SCHEMA, [folder]).count()
    if count:
        ledger.commit(spark, provider.memo, load_id, folder)
    return count


#: Stored answers of at most this many rows and bytes may be broadcast.
BROADCAST_ANSWERS, BROADCAST_BYTES = 400_000, 32_000_000
#: Rows an answer must serve on average for it.
ROWS_AN_ANSWER = 4


def _few(scored: DataFrame, key: str, output: str, asked: Callable[[], int]) -> bool:
    """Whether the stored answers are small, and few for the rows that ask, by their counted size."""
    size = F.sum(F.octet_length(key) + F.coalesce(F.octet_length(output), F.lit(0)))
    rows, held = scored.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).head()
    return 0 < rows <= BROADCAST_ANSWERS and held <= BROADCAST_BYTES and asked() >= ROWS_AN_ANSWER * rows


def _read(answer: str, provider: BatchProvider) -> Column:
    return F.get_json_object(F.col(answer), f"$.{provider.field}") if provider.field else F.col(answer)


def _joined_back(df: DataFrame, prompt_col: Column, provider: BatchProvider, output: str, asked: Callable[[], int]) -> DataFrame:
    """Rows with a prompt: distinct prompts are scored, and their stored answers joined back."""
    key = "_digest"
    prompts = df.select(prompt_col.alias("prompt")).select(provider.digest(F.col("prompt")).alias("digest"), "prompt")
    distinct = prompts.groupBy("digest").agg(F.first("prompt").alias("prompt"))
    if provider.memo is None:
        scored = staged(_scored(distinct, provider), "answers")
    else:
        score_unseen(distinct, provider)
        scored = memo_answers(df.sparkSession, provider.memo)
    scored = scored.select(F.col("digest").alias(key), _read("answer", provider).alias(output))
    # As many as the rows may be: not to be broadcast on the planner's guess of 20 bytes for any text, but on what was counted.
    scored = scored.hint("broadcast" if _few(scored, key, output, asked) else "merge")
    return df.withColumn(key, provider.digest(prompt_col)).join(scored, key, "left").drop(key)


#: Rows a task scores in place, where the provider states no number of tasks: what it sorts stays in memory.
ROWS_A_TASK = 500_000
#: A prompt of at least this many rows, and one in so many of all, is joined back instead; most prompts that are.
HOT_ROWS, HOT_ONE_IN, HOT_PROMPTS = 1_000, 1_000, 512


def _in_place_scorer(provider: BatchProvider) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    fn, size, extra = provider.fn, provider.batch_size, () if provider.model is None else (provider.model,)

    def answers(prompts: pd.Series) -> list:
        return pd.Series(fn(prompts, *extra)).astype(object).reset_index(drop=True).reindex(range(len(prompts))).tolist()

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        last, found = None, [None]  # the prompt that the batch before ended with, and its answer
        for prompts in batches:
            prompts = prompts.reset_index(drop=True)
            texts = prompts.astype(object)  # whole numbers would be shifted as floating ones
            new = texts.ne(texts.shift())
            new.iloc[:1] = [p != last for p in texts.iloc[:1]]
            asked = prompts[new]
            for start in range(0, len(asked), size):
                found += answers(asked.iloc[start : start + size].reset_index(drop=True))
            out = pd.Series(found, dtype=object).iloc[new.cumsum().to_numpy()].reset_index(drop=True)
            yield out
            for last, answer in zip(texts.iloc[-1:], out.iloc[-1:]):
                found = [answer]

    return score


def _scored_in_place(df: DataFrame, prompt_col: Column, provider: BatchProvider, output: str, asked: int) -> DataFrame:
    """Rows with a prompt: dealt by it, so that equal ones are neighbours in one task, which asks for their answer once; stored."""
    tasks = provider.partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-asked // ROWS_A_TASK))
    ask = F.pandas_udf(_in_place_scorer(provider), T.StringType()).asNondeterministic()  # neither planned twice, nor without the sort
    rows = df.repartition(tasks, prompt_col).sortWithinPartitions(F.xxhash64(prompt_col), prompt_col)
    rows = rows.withColumn(output, ask(prompt_col))
    return staged(rows.withColumn(output, _read(output, provider)), "answered", COMPRESSION)


_STORABLE = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _storable(kind: T.DataType) -> bool:
    """Whether a Parquet file holds such values."""
    if isinstance(kind, T.StructType):
        names = {f.name.lower() for f in kind.fields}
        return 0 < len(names) == len(kind.fields) and all(_storable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _storable(kind.elementType)
    return _storable(kind.keyType) and _storable(kind.valueType) if isinstance(kind, T.MapType) else isinstance(kind, _STORABLE)


def _asking(df: DataFrame, prompt_col: Column) -> tuple[int, int, list[int]]:
    """Rows, about how many different prompts they have, and hashes of the prompts that many of them share (frequent-items summary)."""
    top = F.expr(f"approx_top_k(xxhash64(prompt), {HOT_PROMPTS}, {8 * HOT_PROMPTS})")
    rows, prompts, top = df.select(prompt_col.alias("prompt")).agg(F.count(F.lit(1)), F.approx_count_distinct("prompt"), top).head()
    return rows, prompts, [x["item"] for x in top or [] if x["count"] >= max(HOT_ROWS, rows / HOT_ONE_IN)]


def apply_batch_provider(df: DataFrame, prompt_col: Column, provider: BatchProvider, output: str, present: Column | None = None) -> DataFrame:
    """Score each distinct prompt once in Arrow batches and give every row its answer (row count kept).

    ``present`` is TRUE or FALSE as the prompt is not NULL, where that is known at less cost than the prompt.
    """
    present = prompt_col.isNotNull() if present is None else present
    # Rows without a prompt stay out of the exchange, where they would all meet in one partition.
    out = df.where(~present).withColumn(output, F.lit(None).cast(T.StringType()))
    rows = df.where(present)
    if provider.memo is not None or not _storable(df.schema):
        return out.unionByName(_joined_back(rows, prompt_col, provider, output, rows.count))
    asked, prompts, hot = _asking(rows, prompt_col)
    if prompts <= BROADCAST_ANSWERS and asked >= ROWS_AN_ANSWER * prompts:
        return out.unionByName(_joined_back(rows, prompt_col, provider, output, lambda: asked))
    if hot:
        shared = F.xxhash64(prompt_col).isin(hot)
        common, rows = rows.where(shared), rows.where(~shared)
        out = out.unionByName(_joined_back(common, prompt_col, provider, output, common.count))
    return out.unionByName(_scored_in_place(rows, prompt_col, provider, output, asked))


def classify(
    df: DataFrame,
    prompt_col: Column | None = None,
    provider: Provider | None = None,
    labels: Sequence[str] = FV.ROUTE_LABELS,
    output: str = "route_classification",
) -> DataFrame:
    """Add one label per row; NULL prompt -> NULL label; a label outside ``labels`` -> NULL.

    The default provider is the route rule for the four route labels and ``KeywordClassifier`` for any other list.
    """
    present = prompt_present(FV.CLASSIFY_PROMPT_TEMPLATE) if prompt_col is None else prompt_col.isNotNull()
    prompt_col = classify_prompt() if prompt_col is None else prompt_col
    if provider is None:
        ours = tuple(labels) == tuple(FV.ROUTE_LABELS)
        provider = RuleClassifier() if ours else KeywordClassifier(prompt_col, tuple(labels))
    if isinstance(provider, BatchProvider):
        out = apply_batch_provider(df, prompt_col, provider, output, present)
    else:
        out = df.withColumn(output, F.when(present, provider.column(df)))
    return out.withColumn(output, F.when(F.col(output).isin(*labels), F.col(output)))


def complete(
    df: DataFrame,
    prompt_col: Column | None = None,
    provider: Provider | None = None,
    output: str = "route_summary",
) -> DataFrame:
    """Add one generated text per row; NULL prompt -> NULL text."""
    present = prompt_present(FV.SUMMARY_PROMPT_TEMPLATE) if prompt_col is None else prompt_col.isNotNull()
    prompt_col = summary_prompt() if prompt_col is None else prompt_col
    provider = provider or TemplateSummarizer()
    if isinstance(provider, BatchProvider):
        return apply_batch_provider(df, prompt_col, provider, output, present)
    return df.withColumn(output, F.when(present, provider.column(df)))


def sample(curated: DataFrame, n: int | None = None, ordered: bool = True,
           columns: Sequence[str] = ENRICH_BASE_COLUMNS) -> DataFrame:
    """The rows to enrich: ``n`` rows (all when ``n`` is None).

    ``ordered=True`` takes the first ``n`` by all projected columns as a top-n (per-partition top-n
    then a merge of ``n`` rows per partition, no global sort); ``ordered=False`` takes any ``n`` like
    an unordered LIMIT. The sample is checkpointed to the shared folder right away: the top-n plan
    stays intact whatever is stacked on it later, and every later branch (distinct prompts, join
    back, the table write) sees the same ``n`` rows.
    """
    base = curated.select(*columns)
    if n is None:
        return base
    picked = base.orderBy(*[F.asc_nulls_first(c) for c in columns]).limit(n) if ordered else base.limit(n)
    shared_root(curated.sparkSession)
    return picked.checkpoint(eager=True)


def enrich(
    curated: DataFrame,
    *,
    limit: int | None = None,
    ordered: bool = True,
    classifier: Provider | None = None,
    summarizer: Provider | None = None,
) -> DataFrame:
    """The enriched table: sampled curated rows + classification + summary + ``enriched_at``."""
    rows = sample(curated, limit, ordered)
    rows = classify(rows, provider=classifier)
    rows = complete(rows, provider=summarizer)
    return rows.withColumn("enriched_at", F.current_timestamp()).select(*ENRICHED_COLUMNS)


def write_enriched(enriched: DataFrame, path: str) -> None:
    """``CREATE OR REPLACE TABLE ... AS``: overwrite the enriched table."""
    enriched.write.mode("overwrite").parquet(path)
