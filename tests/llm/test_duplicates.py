"""Components, BK-trees, SimHash, cap filters and decontamination against brute force."""

import numpy as np
import pytest
import xxhash
from helpers import components, documents
from pyspark.sql import functions as F

from earshot.llm import caps, decontaminate, simhash
from earshot.llm.bktree import Forest, Unions
from earshot.llm.components import connected_components


def test_components(spark):
    draw = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)] + [(500, 501 + i) for i in range(40)]
    edges = spark.createDataFrame(pairs + pairs[:5] + [(None, 3), (9, 9)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    want = components(600, pairs)
    assert got == {i: r for i, r in enumerate(want) if i != r}
    assert connected_components(edges.limit(0)).count() == 0


def test_forest_finds_all_pairs_of_a_group():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(1) << np.uint64(b) for b in range(64)]
    values = np.unique(np.concatenate([base] + [base ^ flips[i] ^ flips[(i * 7) % 60] for i in range(12)]))
    groups = np.sort(draw.integers(0, 5, len(values)))
    got = {(i, j) for a, b in Forest(values, groups).within(3) for i, j in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if groups[i] == groups[j] and int(values[i] ^ values[j]).bit_count() <= 3}
    assert got == want and len(got) > 40
    unions = Unions(len(values))
    for a, b in Forest(values, groups).within(3):
        unions.add(a, b)
    assert unions.roots.tolist() == components(len(values), want)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("max_shard", [2, simhash.MAX_SHARD])
def test_simhash_against_brute_force(spark, data, max_shard):
    """Shards of two fingerprints force every hot shard to be cut again, and lose no link."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    marks = [brute_fingerprint(r.text) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 3]
    want = {r.doc_id: (marks[i], rows[c].doc_id) for i, (r, c) in enumerate(zip(rows, components(len(rows), pairs)))}
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs, max_shard=max_shard).collect()}
    assert got == want


def test_simhash_awkward_rows(spark):
    docs = documents(spark)
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, None), (1, 1), (2, 1), (2, 1), (3, 3), (4, 3), (5, 3), (6, 6), (7, 7), (7, 7)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 7]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_one(documents(spark, [])).count() == 0
    same = documents(spark, [(1, "a b c", "en", "s", 1, "x")] * 5)
    assert simhash.keep_one(same).count() == 1


def _brute_links(x, cosine):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    return [(i, j) for i, j in zip(*np.nonzero(near)) if i != j]


@pytest.mark.parametrize("max_block", [64, caps.MAX_BLOCK])
def test_cap_filters_against_brute_force(spark, max_block):
    """A dense group larger than a block, loose pairs, exact copies; recall at least 0.98, no false link."""
    draw = np.random.default_rng(4)
    centre = draw.normal(size=24)
    x = np.concatenate([draw.normal(size=(300, 24)), centre + 0.05 * draw.normal(size=(150, 24))])
    x = np.concatenate([x, x[:80] + 0.2 * draw.normal(size=(80, 24)), x[:20]]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in caps.near_vectors(frame, max_block=max_block).collect()}
    pairs = _brute_links(x.astype(float), 0.95)
    degree = np.bincount([i for i, _ in pairs], minlength=len(x))
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= degree).all() and found.sum() >= 0.98 * degree.sum()
    want = components(len(x), pairs)
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_cap_filters_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.0, 0.0], [5.0], [3.0], [-1.0], [1e200, 1e200], [1e-200, 1e-200]]
    rows = [(i, v, i) for i, v in enumerate(vectors)] + [(None, [0.0, 1.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long")).collect()}
    alone = {i: (0, i, True) for i in (0, 1, 2, 3, 4, 5, 9, 12)}
    assert got == alone | {6: (2, 6, True), 7: (2, 6, False), 8: (2, 6, False), 10: (1, 10, True), 11: (1, 10, False), 13: (1, 13, True), 14: (1, 13, False), None: (0, None, True)}
    assert caps.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def _brute_contamination(text, items, width=10):
    words = decontaminate.words_of(text)
    hit, names = set(), set()
    for name, item in items:
        own = decontaminate.words_of(item)
        n = min(width, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit.update(range(j, j + n))
                    names.add("null" if name is None else str(name))
    return len(words), len(hit), sorted(names)


def test_decontamination_against_brute_force(spark):
    items = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (None, "x y z"), (2, "other words"), (3, ""), (4, None), (5, "?!")]
    texts = ["ONE-two three, four five six seven eight nine ten eleven twelve one two", "a short Item short item", "x y\u00a0z", "x y z x y z", "", None, "eleven twelve"]
    docs = documents(spark, [(i, t, None, None, None, None) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame([(i, t, "e") for i, t in items], "item_id long, text string, n_hit string")
    got = {r.doc_id: r for r in decontaminate.find_contamination(docs, benchmark).collect()}
    for i, text in enumerate(texts):
        words, hit, names = _brute_contamination(text, items)
        assert (got[i].n_words, got[i].n_hit, got[i].items, got[i].contaminated) == (words, hit, names, hit > 0)
    assert texts[0][got[0].spans[0][0] : got[0].spans[0][1]] == "ONE-two three, four five six seven eight nine ten eleven twelve"
    empty = decontaminate.find_contamination(docs, benchmark.limit(0))
    assert empty.where("contaminated").count() == 0 and empty.count() == len(texts)
    assert decontaminate.find_contamination(docs.limit(0), benchmark).count() == 0


def test_benchmark_blocks_give_the_same(spark, monkeypatch):
    items = [(i, f"word{i} and some more text number {i}") for i in range(30)]
    docs = documents(spark, [(i, " ".join(t for _, t in items[i : i + 3]), None, None, None, None) for i in range(20)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(decontaminate.find_contamination(docs, benchmark).select("doc_id", "n_hit", "items").collect())
    monkeypatch.setattr(decontaminate, "MAX_BLOCK_WORDS", 20)
    assert len(decontaminate.item_blocks(benchmark)) > 5
    assert sorted(decontaminate.find_contamination(docs, benchmark).select("doc_id", "n_hit", "items").collect()) == whole
    assert docs.where(F.col("text").isNull()).count() == 0


def test_every_verified_link_is_counted(spark):
    """Planted pairs just above the limit: whoever is in a component of several has a link."""
    draw = np.random.default_rng(8)
    x = draw.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = draw.normal(size=x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    both = np.concatenate([x, 0.955 * x + np.sqrt(1 - 0.955**2) * off])
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(both)]
    got = caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    linked = [r for r in got if r.component_id != r.vec_id]
    assert all(r.n_links > 0 for r in linked) and len(linked) > 0.9 * 1500
    assert sum(r.n_links for r in got) == 2 * len(linked)
