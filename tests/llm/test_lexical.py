"""Ranked lexical search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import LONG, documents

from earshot.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=lexical.TOP_K):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total = sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counted:
            m = 100 - 50 + (50 * n * len(counted)) // total
            weigh = lambda t: math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1)))
            scored.append((sum(weigh(t) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t]), i))
        best = sorted((s for s in scored if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
        out += [(item, rank, i, s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def ranked(spark, docs, items, **options):
    docs = docs if hasattr(docs, "columns") else spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r)[:4] for r in lexical.rank_documents(docs, items, **options).collect()), key=str)


def corpus(n=1500, seed=2):
    draw = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(800)])
    share = 1 / np.arange(1, 801)
    pick = lambda size: " ".join(draw.choice(vocabulary, size, p=share / share.sum()))
    docs = [(i, pick(int(draw.integers(0, 120)))) for i in range(n)]
    items = [(i, pick(int(draw.integers(1, 40)))) for i in range(12)]
    docs += [(n + i, f"{pick(20)} {items[i % 12][1]} {pick(20)}") for i in range(60)]
    docs += [(n + 100 + i, items[3][1]) for i in range(200)]  # a group of copies, all tied
    return docs, items


SHAPES = [lexical.Shape(), lexical.Shape(leaf=4, cells=20_000), lexical.Shape(entries=500), lexical.Shape(cells=1)]


@pytest.mark.parametrize("shape", SHAPES)
def test_against_brute_force(spark, shape):
    docs, items = corpus()
    assert ranked(spark, docs, items, shape=shape) == brute(docs, items)
    assert ranked(spark, docs, items, k=3, shape=shape) == brute(docs, items, 3)


def test_item_blocks_do_not_change_the_result(spark):
    docs, items = corpus(300)
    assert ranked(spark, docs, items, item_bytes=400) == ranked(spark, docs, items)


def test_no_document_exceeds_the_bound_of_a_node_above_it():
    docs, texts = corpus(600)
    items = lexical.Items([i for i, _ in texts], [t.encode() for _, t in texts])
    counts = [Counter(items.number[t] for t in lexical.split_terms(d.encode()) if t in items.number) for _, d in docs]
    counts = [c for c in counts if c]
    items.weigh(len(counts), np.bincount([t for c in counts for t in c], minlength=len(items.number)))
    terms_ = np.concatenate([np.sort(list(c)) for c in counts])
    gain = np.concatenate([[c[t] * 1000 for t in sorted(c)] for c in counts])
    tree = lexical.BallTree(items, np.array([len(c) for c in counts]), terms_, gain, np.arange(len(counts)), np.zeros(len(counts), bool))
    skipped = 0
    for item in range(len(texts)):
        limits = tree.limits(items, item)
        wanted = np.isin(tree.terms, items.terms[item])
        scores = np.add.reduceat(tree.gain * items.weight[tree.terms] * wanted, tree.ends[:-1])
        for level in range(tree.depth + 1):
            nodes = 1 << level
            bounds = len(counts) * np.arange(nodes + 1) // nodes
            assert (np.maximum.reduceat(scores, bounds[:-1]) <= limits[nodes - 1 : 2 * nodes - 1]).all()
        best = lexical.Best(10, 1)
        visited, leaves = tree.search(items, item, best, np.zeros(len(items.weight), np.int64))
        assert sorted(s for s, _, _ in best.heap) == sorted(scores[scores > 0])[-10:]
        skipped += leaves - visited
    assert skipped > 0.3 * len(texts) * leaves


def test_awkward_rows(spark):
    docs = documents(spark)
    items = [(1, "Quick brown FOX"), (1, "Quick brown FOX"), (2, None), (3, ""), (None, "lorem ipsum"), (4, "Wort naïve 12"), (5, "... --"), (6, LONG)]
    want = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert want and ranked(spark, docs, items) == want
    assert ranked(spark, docs.limit(0), items) == []
    assert ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None), (2, " ")], items) == []
