"""Personal data: base spans against plain patterns, and the judgement of rewritten spans on held-out contexts."""

import hashlib
import re

import numpy as np
import pytest
from helpers import LONG, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.llm import boosting, pii
from earshot.llm.queries import QUERIES

# The contract's patterns as they stand.
PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
            fits = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                12 <= len(digits) <= 19 and sum(doubled) % 10 == 0,
                9 <= len(digits) <= 15,
            )
            if fits[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet="aZé@@..%+-+ ()0123456789", max_size=60))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111-1111 1111", "1.2.3.4", "255.256.1.1.9.8.7.6", "+1 (988) 555-2485", "a.b@c.de", "@", "x", " ", "+", "٣", "0"]), max_size=8))
def test_base_spans_of_real_forms(parts):
    assert pii.base_spans("".join(parts)) == plain("".join(parts))


@pytest.mark.parametrize("unit", ["1", "a", "1.", "a@", "+1", "1 ", "(1", "a@b.", ".", "1-", "@", " at ", "a at b dot "])
def test_long_runs_take_linear_time(unit):
    text = unit * (200_000 // len(unit))
    pii.base_spans(text)
    pii._apart(pii.proposals(text), pii.base_spans(text[:2000]))


def sentences(n=400, seed=4):
    """Base spans of every kind in plain prose, and prose with other numbers."""
    draw = np.random.default_rng(seed)
    words = np.array("the of and house water reads light seven at was over call mail server card to".split())
    digits = lambda k: "".join(map(str, draw.integers(0, 10, k)))
    rows = []
    for i in range(n):
        card = "4" + digits(14)
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        spans = [f"{'abcdefgh'[i % 8]}{digits(2)}@mail{i % 9}.org", f"{draw.integers(1, 255)}.{draw.integers(255)}.{i % 250}.7", card, f"+1 ({digits(3)}) 555-{digits(4)}"]
        clean = [f"{draw.integers(1900, 2100)}-0{i % 9 + 1}-11", f"{digits(8)}", f"{i},{digits(3)},{digits(3)}"]
        for s in spans + clean:
            rows.append(f"{' '.join(draw.choice(words, 6))} {s} {' '.join(draw.choice(words, 6))}")
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.createDataFrame(list(enumerate(sentences())), "doc_id long, text string")
    return docs, pii.fit_model(docs)


def test_boosting_lowers_the_loss_and_learns_an_interaction():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 4))
    y = (x[:, 0] > 0) ^ (x[:, 2] > 0.3)
    grown = [boosting.fit(x[:2000], y[:2000], rounds=r) for r in (1, 5, 20, 60)]
    losses = [boosting.log_loss(trees.scores(x[:2000]), y[:2000]) for trees in grown]
    assert losses == sorted(losses, reverse=True) and boosting.log_loss(grown[-1].scores(x[2000:]), y[2000:]) < 0.15
    same = boosting.fit(np.ones((10, 2)), np.arange(10) % 2 == 0)
    assert np.allclose(same.scores(np.ones((1, 2))), 0, atol=1e-9)


def test_rewritten_spans_are_found_and_clean_texts_left_alone(spark, trained):
    _, model = trained
    held = sentences(60, seed=99)
    rows, planted = [], 0
    for text in held:
        base = pii.base_spans(text)
        if not base:
            rows.append((len(rows), text, 0))
            continue
        (start, kind, end), *_ = base
        for form in pii.variants(text[start:end], kind)[:3]:
            if not pii.base_spans(form):
                rows.append((len(rows), text[:start] + form + text[end:], 1))
                planted += 1
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string, planted int"), model, ("doc_id", "planted", "text")).collect()
    caught = [r for r in found if r.spans]
    assert sum(r.planted for r in caught) >= 0.9 * planted
    assert sum(not r.planted for r in caught) <= 0.02 * len(found)


def test_probabilities_are_calibrated(trained):
    _, model = trained
    for kind, least in enumerate(model.least):
        assert model.trees[kind] is not None and 0.5 <= least <= 1
    p = model.probabilities(3, np.array([pii.features("call ", "(212) 555-0188", " now", 3), pii.features("on ", "2024-05-12", " we", 3)], float))
    assert p[0] > 0.8 and p[1] < 0.2


def test_redaction(spark, trained):
    docs, model = trained
    text = "mail a1@mail3.org or +1 (212) 555-0188 now"
    frame = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.redacted for r in pii.redacted(pii.find_pii(frame, model, ("doc_id", "text"))).collect()}
    assert got == {1: "mail [EMAIL] or [PHONE] now", 2: None}
    overlap = [{"kind": "card", "start": 0, "end": 5}, {"kind": "phone", "start": 3, "end": 8}]
    assert pii.redact("0123456789", overlap) == "[CARD]89"


def test_base_counts_of_the_query(spark, data):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = QUERIES["op11_pii"](spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        names = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(names) <= set(r.spans.split(",")) | {""}
    assert sum(bool(r.spans) for r in rows) > 0


def test_awkward_rows(spark, trained):
    _, model = trained
    rows = documents(spark).withColumn("spans", F.lit("clash")).withColumn("_scanned", F.lit(1))
    got = pii.find_pii(rows, model, ("doc_id", "spans", "source")).collect()
    assert len(got) == 10 and all(r.spans == [] for r in got)
    long = spark.createDataFrame([(1, LONG + " a@b.cc " + LONG)], "doc_id long, text string")
    (row,) = pii.find_pii(long, model).collect()
    assert [tuple(s) for s in row.spans] == [("email", len(LONG) + 1, len(LONG) + 7, True)]
    empty = documents(spark, [])
    nothing = pii.fit_model(empty)
    assert nothing.least == (2.0,) * 4 and pii.find_pii(empty, nothing).count() == 0
    assert pii.find_pii(rows, nothing).count() == 10
    assert pii.fit_model(documents(spark)).trees == (None,) * 4
