"""Item content features: term vectors, the joined item table, assembly and scaling."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.vectors import sparse_vector
from earshot.operators.indexing import number_rows
from earshot.operators.skew import lookup_join

# Vocabulary limits and the inputs of the item vector.
MAX_TERMS = 5000
MIN_ITEMS = 2
FREQUENT = 100
SCALARS = ["loudness_std", "loudness_mean", "duration", "artist_hotttnesss", "artist_familiarity", "year"]


def words(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, word): the lower-case words of whole texts, cut at runs of ASCII white space; punctuation stays."""
    # The outer form is split once; the inner one is split again by a filter Spark derives from it.
    split = F.explode_outer(F.split(F.lower(text), "[\\x09-\\x0D\\x20]+")).alias("word")
    return texts.select(key, split).where(F.col("word") != "")


def term_counts(terms: DataFrame, item: str, term: str) -> DataFrame:
    """(item, term, tf). Counted map-side first, so a hot item or term is small when it moves."""
    return terms.groupBy(item, term).agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, term: str, max_terms: int | None = MAX_TERMS, min_items: int = MIN_ITEMS) -> DataFrame:
    """(term, total, items, term_index): the most used terms found in at least ``min_items`` items.

    With ``max_terms`` None all of them, numbered by a distributed sort.
    ``counts`` is the output of ``term_counts``. Ties go by the term, so the positions are stable.
    """
    by_use = [F.desc("total"), F.asc(term)]
    totals = counts.groupBy(term).agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("items"))
    ordered = totals.where(F.col("items") >= min_items).orderBy(*by_use)
    if max_terms is None:
        return number_rows(ordered, "term_index", f"vocabulary-{term}")
    top = ordered.limit(max_terms)
    position = F.row_number().over(Window.orderBy(*by_use)) - 1  # over the max_terms rows of the limit
    return top.withColumn("term_index", position)


def term_vectors(
    counts: DataFrame, vocab: DataFrame, item: str, term: str, output: str, size: int = MAX_TERMS
) -> DataFrame:
    """(item, output): one sparse count vector per item, empty when it has no vocabulary term.

    At most ``size`` entries meet in one row, because repeated terms were counted before.
    """
    known = lookup_join(counts, vocab.select(term, "term_index"), term, how="left")
    entry = F.when(F.col("term_index").isNotNull(), F.struct("term_index", F.col("tf").cast("double").alias("tf")))
    rows = known.groupBy(item).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return rows.select(item, sparse_vector(F.col("entries.term_index"), F.col("entries.tf"), size).alias(output))


def frequent_terms(terms: DataFrame, term: str, at_least: int = FREQUENT) -> DataFrame:
    """(term, n) used at least so often, most used first."""
    used = terms.groupBy(term).agg(F.count(F.lit(1)).alias("n"))
    return used.where(F.col("n") >= at_least).orderBy(F.desc("n"), term)


def mark_frequent(terms: DataFrame, frequent: DataFrame, term: str) -> DataFrame:
    """Every row, with ``is_frequent``; rows of other terms are kept."""
    known = frequent.select(term, F.lit(True).alias("is_frequent"))
    marked = lookup_join(terms, known, term, how="left")
    return marked.withColumn("is_frequent", F.coalesce("is_frequent", F.lit(False)))


def item_table(item: str, *parts: DataFrame) -> DataFrame:
    """Inner join of per-item tables: only items known to all of them remain."""
    joined, *rest = parts
    for part in rest:
        joined = joined.join(part, item)
    return joined


def input_columns(df: DataFrame, prefix: str = "timbre", fixed: list[str] = SCALARS) -> list[str]:
    """The columns that start with ``prefix``, then the fixed ones."""
    return [c for c in df.columns if c.startswith(prefix)] + fixed


def assemble(df: DataFrame, inputs: list[str], output: str = "raw") -> DataFrame:
    """One vector per row; rows with a null or NaN input are dropped."""
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="skip").transform(df)


def scaled_entries(entries: DataFrame, item: str, n: int) -> DataFrame:
    """Non-zero (item, position, value) of ``n`` vectors, divided by their sample deviation by position.

    An entry that is not there is zero, so nothing is made dense; constant positions become 0 and go.
    """
    m, mean = F.count(F.lit(1)), F.avg("value")
    square = F.var_pop("value") * m + mean * mean * m * (F.lit(n) - m) / F.lit(max(n, 1))
    deviation = F.sqrt(square / F.lit(max(n - 1, 1))).alias("deviation")
    used = entries.groupBy("position").agg(deviation).where("deviation > 0")
    scaled = lookup_join(entries.where("value <> 0"), used, "position")
    return scaled.select(item, "position", (F.col("value") / F.col("deviation")).alias("value"))


def fit_scaler(df: DataFrame, raw: str = "raw", output: str = "features"):
    """Divide by the sample standard deviation without centring; constant columns become 0."""
    return StandardScaler(inputCol=raw, outputCol=output, withStd=True, withMean=False).fit(df)
