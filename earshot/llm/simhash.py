"""SimHash near-duplicates: fingerprints linked within a few bits by BK-trees.

A fingerprint bit is set when it is set in over half of the XXH64 hashes of the text's word
shingles. Equal fingerprints are one node. Two fingerprints within ``radius`` bits agree on at
least one of ``radius + 1`` parts of their bits, so the trees are sharded by (part, value): every
fingerprint enters the tree of each of its parts and is searched there, along the edges within the
radius only. A shard above ``max_shard`` is cut again by the bits its members do not share yet,
as often as needed, so no shard is unbounded and no link is lost.

The shards meet their queries by a shuffle, not by a broadcast: all trees together grow with the
corpus and have no size bound. A shard gives its spanning forest, never its pairs.

Defined results: null and empty texts have fingerprint zero, linked like any other; component_id
is the smallest document id of the component, null if it has none; repeated rows each stay a row;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.bktree import BITS, Forest, Unions
from earshot.llm.components import connected_components
from earshot.llm.words import row_key, utf8
from earshot.session import stored

SHINGLE = 3
SEED = 42
RADIUS = 3
MAX_SHARD = 16_384
BUFFER = 200_000  # fingerprints of whole shards that a task treats together


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.lower().split()
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(seed)), np.uint64, n).astype(">u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8)).reshape(len(part), BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes())


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns with ``fp``, the fingerprint's bits as a signed integer."""
    source = docs.select(*keep, utf8("text").alias("_text"))
    schema = T.StructType([source.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["_text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(found.view(np.int64))], [*keep, "fp"])

    return source.mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def split_mask(mask: int, parts: int) -> list[int]:
    """``mask`` joined with each of ``parts`` runs of the bits it lacks."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(free[a:b]) for a, b in zip(cuts, cuts[1:])]


def shard_keys(fps: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """(fp, mask, value): the shards of every fingerprint, value being its bits under the mask."""
    level, masks, settled = fps.select("fp", F.lit(0).cast("long").alias("mask")), [0], []
    while True:
        finer = {m: split_mask(m, radius + 1) for m in masks}
        table = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in finer[m]]))])
        keyed = level.select("fp", F.explode(table[F.col("mask")]).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        masks = sorted({s for subs in finer.values() for s in subs})
        counts = keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        hot = stored(counts.where(F.col("n") > max_shard).drop("n"), "hot-shards")
        if hot.isEmpty() or any(BITS - m.bit_count() <= radius for m in masks):
            settled.append(keyed)
            break
        settled.append(keyed.join(hot, ["mask", "value"], "left_anti"))
        level = stored(keyed.join(hot, ["mask", "value"], "left_semi").select("fp", "mask"), "hot-fingerprints")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def link_fingerprints(fps: DataFrame, radius: int = RADIUS, max_shard: int = MAX_SHARD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, a spanning forest of the links of each shard."""
    keyed = shard_keys(fps, radius, max_shard).repartition("mask", "value").sortWithinPartitions("mask", "value")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = [np.empty(0, np.int64)] * 3

        def forest(mask: np.ndarray, value: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            group = np.cumsum(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
            shared = np.bincount(group)[group] > 1  # a fingerprint alone in its shard has no link there
            fp, group = fp[shared], group[shared]
            unions = Unions(len(fp))
            if len(fp):
                for a, b in Forest(fp.view(np.uint64), group).within(radius):
                    unions.add(a, b)
            joined = unions.roots != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(fp[joined]), pa.array(fp[unions.roots[joined]])], ["a", "b"])

        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("mask", "value", "fp")]
            left = [np.concatenate(x) for x in zip(left, columns)]
            if len(left[0]) >= BUFFER:
                mask, value, _ = left
                same = (mask == mask[-1]) & (value == value[-1])
                end = len(mask) - int(same.sum())  # the last shard may go on
                if end:
                    yield forest(*(x[:end] for x in left))
                    left = [x[end:] for x in left]
        if len(left[0]):
            yield forest(*left)

    return keyed.select("mask", "value", "fp").mapInArrow(search, "a long, b long")


def near_duplicates(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), radius: int = RADIUS, shingle: int = SHINGLE, max_shard: int = MAX_SHARD
) -> DataFrame:
    """``keep`` columns (doc_id among them) with fp, component_id and group, one row per document.

    ``group`` names the component by its smallest fingerprint and is never null.
    """
    marked = stored(fingerprints(docs, keep, shingle), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = connected_components(link_fingerprints(nodes, radius, max_shard)).withColumnRenamed("node", "fp")
    grouped = nodes.join(found, "fp", "left").withColumn("group", F.coalesce("component", "fp")).drop("component")
    smallest = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    return marked.join(grouped.join(smallest, "group").drop("least"), "fp")


def keep_one(docs: DataFrame, find: Callable[..., DataFrame] = near_duplicates, **options) -> DataFrame:
    """``docs`` with one document per component of ``find``: the smallest id, then the smallest row hash.

    Decisions are taken on narrow rows; the texts are shuffled once, to meet the keys of the
    documents that stay.
    """
    columns = docs.columns
    keyed = docs.select("*", *row_key(columns))
    found = find(keyed, ("doc_id", "_k1", "_k2"), **options)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_k1", "_k2")
    chosen = found.groupBy("group").agg(F.min(order).alias("o")).select("o._k1", "o._k2")
    return keyed.join(chosen, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select(*columns)
