"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Targets share the words of all documents by weight; no target exceeds ``max_repeat`` times its
source's words, and what is above is shared again by weight. Targets become whole blocks by
highest quotients target / (2k + 1), so each source's quota is within half a block of its target.
A quota of whole repeats takes every document that often; the rest is apportioned to the source's
shards by the same method, and in each shard the blocks of lowest seeded order are taken. A
document at the end of a shard's quota gives only part of its words.

A source of any size is cut into shards of about ``shard_rows`` documents, so a hot source is more
shards, not a longer task. The driver sees one row per source and per shard, counts only; both
numbers are checked.

Defined results: a null text has no words and takes none; a null source is a source of its own,
last in order; null or repeated document ids are separate rows; sources without words have target
zero; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.words import count_words

BLOCK = 16  # words per block, the unit of quotas
SHARD_ROWS = 20_000
MAX_TABLE = 2_000_000  # sources or shards whose counts the driver apportions
SEED = 17


def weights_by_rank(names: list[str | None], cycle: tuple[int, ...] = (1, 2, 3)) -> dict[str | None, int]:
    """Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3, ..."""
    order = sorted((n for n in names if n is not None)) + [None] * (None in names)
    return {name: cycle[i % len(cycle)] for i, name in enumerate(order)}


def capped_targets(sizes: list[int], weights: list[int], max_repeat: int) -> list[Fraction]:
    """Shares of sum(sizes) by weight, none above max_repeat times its size."""
    targets = [Fraction(0)] * len(sizes)
    open_, left = list(range(len(sizes))), Fraction(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if unit * weights[i] > max_repeat * sizes[i]}
        for i in above or open_:
            targets[i] = Fraction(max_repeat * sizes[i]) if above else unit * weights[i]
        if not above:
            break
        left -= sum(targets[i] for i in above)
        open_ = [i for i in open_ if i not in above]
    return targets


def sainte_lague(claims: list[Fraction] | list[int], seats: int) -> list[int]:
    """Seats by highest quotients claim / (2k + 1), ties to the earlier claim.

    Rounding at the common divisor is off by at most one seat per claim; a heap settles those, so
    the cost does not depend on the number of seats.
    """
    total = sum(claims)
    if not total or seats <= 0:
        return [0] * len(claims)
    given = [int(Fraction(2 * c * seats + total) / (2 * total)) for c in claims]
    missing = seats - sum(given)
    if missing > 0:
        heap = [(-Fraction(c) / (2 * g + 1), i) for i, (c, g) in enumerate(zip(claims, given)) if c]
        heapq.heapify(heap)
        for _ in range(missing):
            i = heap[0][1]
            given[i] += 1
            heapq.heapreplace(heap, (-Fraction(claims[i]) / (2 * given[i] + 1), i))
    elif missing < 0:
        heap = [(Fraction(c) / (2 * g - 1), -i) for i, (c, g) in enumerate(zip(claims, given)) if g]
        heapq.heapify(heap)
        for _ in range(-missing):
            i = -heap[0][1]
            given[i] -= 1
            if given[i]:
                heapq.heapreplace(heap, (Fraction(claims[i]) / (2 * given[i] - 1), -i))
            else:
                heapq.heappop(heap)
    return given


def shard_quotas(sizes: list[int], words: int, block: int) -> list[int]:
    """Words each shard gives: whole blocks by Sainte-Laguë, the rest to the first with room."""
    quotas = [min(s, q * block) for s, q in zip(sizes, sainte_lague(sizes, words // block))]
    left = words - sum(quotas)
    for i, size in enumerate(sizes):
        extra = min(left, size - quotas[i])
        quotas[i] += extra
        left -= extra
    return quotas


def _bounded(df: DataFrame, what: str) -> list:
    rows = df.limit(MAX_TABLE + 1).collect()
    if len(rows) > MAX_TABLE:
        raise ValueError(f"more than {MAX_TABLE} {what}")
    return rows


def mix_sources(
    docs: DataFrame,
    cycle: tuple[int, ...] = (1, 2, 3),
    max_repeat: int = 3,
    block: int = BLOCK,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``, in words, repeats counted.

    ``docs`` has doc_id, source and either ``size`` or text; columns of those result names are
    replaced. It is read three times, so pass a stored table.
    """
    spark = docs.sparkSession
    if "size" not in docs.columns:
        docs = docs.withColumn("size", count_words(F.col("text")))
    docs = docs.drop("source_size", "target", "taken")
    totals = _bounded(docs.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "sources")
    weights = weights_by_rank([r.source for r in totals], cycle)
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in totals]
    targets = capped_targets(sizes, [weights[r.source] for r in totals], max_repeat)
    seats = sainte_lague(targets, round(Fraction(sum(sizes), block)))
    words = [min(q * block, max_repeat * s) for q, s in zip(seats, sizes)]
    table = [
        (r.source, i, -(-r.n // shard_rows), sizes[i], float(targets[i])) for i, r in enumerate(totals)
    ]
    sources = spark.createDataFrame(table, "source string, _source int, _shards int, source_size long, target double")
    draw = F.xxhash64(F.lit(seed), "doc_id")
    placed = (
        docs.join(F.broadcast(sources.withColumnRenamed("source", "_name")), F.col("source").eqNullSafe(F.col("_name")))
        .drop("_name")
        .withColumn("_shard", F.pmod(F.xxhash64(F.lit(-seed), "doc_id", "size"), "_shards").cast("int"))
    )
    counts = placed.groupBy("_source", "_shard").agg(F.sum("size").alias("size"))
    shards: dict[int, list[tuple[int, int]]] = {}
    for r in _bounded(counts, "shards"):
        shards.setdefault(r["_source"], []).append((r["_shard"], r["size"]))
    quotas = []
    for source, own in shards.items():
        own.sort()
        full, rest = divmod(words[source], sizes[source]) if sizes[source] else (0, 0)
        for (shard, _), quota in zip(own, shard_quotas([s for _, s in own], rest, block)):
            quotas.append((source, shard, full, quota))
    quota = spark.createDataFrame(quotas, "_source int, _shard int, _full long, _quota long")
    order = Window.partitionBy("_source", "_shard").orderBy("_draw", "doc_id", "size")
    start = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_quota") - F.col("_start")))
    return (
        placed.withColumn("_draw", draw)
        .withColumn("_start", start)
        .join(F.broadcast(quota), ["_source", "_shard"])
        .withColumn("taken", F.col("size") * F.col("_full") + part)
        .drop("_source", "_shard", "_shards", "_draw", "_start", "_full", "_quota")
    )


def mixed_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document as often as the mix takes it, rounded to whole documents."""
    columns = docs.columns
    mixed = mix_sources(docs, **options).where(F.col("taken") > 0)
    copies = F.floor((F.col("taken") + F.floor(F.col("size") / 2)) / F.col("size")).cast("int")
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).select(*columns)
