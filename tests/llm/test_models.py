"""Language identification, language-model scores, mixing and the pipeline."""

import math
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from helpers import documents
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import attention, langid, lmscore, mixing, simhash
from earshot.llm.queries import ORACLES, QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_language_is_right_on_documents_never_learned_from(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = langid.predict_languages(docs.withColumn("out", langid.held_out()), langid.fit_languages(docs), ("lang", "out", "doc_id")).collect()
    held = [r for r in got if r.out]
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    assert np.mean([r.rejected for r in got]) < 0.02 and all(0 <= r.score <= 1 for r in got)


def test_language_awkward_rows(spark):
    docs = documents(spark)
    got = [(r.doc_id, r.lang_pred) for r in langid.predict_languages(docs, langid.fit_languages(docs)).collect()]
    assert len(got) == 10
    assert {i for i, lang in got if lang == "und"} == {3, 4, 5, 7} and (7, "und") in got
    assert {lang for _, lang in got} <= {"und", "en", "de", "la"}
    none = langid.predict_languages(docs, langid.fit_languages(docs.limit(0)))
    assert {(r.lang_pred, r.score, r.rejected) for r in none.collect()} == {("und", 0.0, True)}
    assert langid.identified(docs.limit(0)).count() == 0
    assert langid.identified(docs).columns == docs.columns


def test_attention_gradients():
    """The slope of the loss along each parameter agrees with finite differences."""
    draw = np.random.default_rng(0)
    unigram = np.full(11, 1 / 11)
    start = {k: v.astype(np.float64) for k, v in attention.start(unigram, dim=4, parts=3, window=6).items()}
    ids, following = draw.integers(0, 11, (2, 5, 6))
    used = draw.random((5, 6)) < 0.8

    def loss(p):
        weights, _ = attention.forward(p, ids)
        likely = (weights * attention.components(start, unigram)[following]).sum(-1)
        return -(np.log(likely) * used).sum() / used.sum()

    trainer = attention.Trainer(start, unigram, rate=0.0)
    trainer.step(ids, following, used)
    for name, (m, _) in trainer.moments.items():
        at = np.unravel_index(np.abs(m).argmax(), m.shape)
        moved = []
        for e in (1e-5, -1e-5):
            p = {k: v.copy() for k, v in start.items()}
            p[name][at] += e
            moved.append(loss(p))
        assert 10 * m[at] == pytest.approx((moved[0] - moved[1]) / 2e-5, rel=1e-3), name


def test_scorer_agrees_with_the_forward_pass_and_sums_to_one():
    unigram = np.random.default_rng(1).dirichlet(np.ones(20))
    p = attention.start(unigram, dim=8, parts=5)
    scorer = attention.Scorer(p, unigram, np.arange(20) < 7)
    ids = np.random.default_rng(2).integers(0, 20, (3, 32))
    weights, _ = attention.forward(p, ids)
    each = []
    for token in range(20):
        log, group = scorer.log10(ids, np.full_like(ids, token), 8)
        each.append(10.0**log)
        assert np.allclose(each[-1], (weights @ attention.components(p, unigram)[token])[:, 8:], rtol=1e-3)
    assert np.allclose(sum(each), 1, atol=1e-4) and np.allclose(sum(each[:7]), 10.0**group, atol=1e-4)


def _base(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    words = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n = sum(counts.values())
    scale = n + 0.1 * (len(counts) + 1)
    return [(i, h, len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 0.1) / scale) for w in ws)) for (i, _), h, ws in zip(rows, held, words)]


def test_scores_against_brute_force(spark, data, monkeypatch):
    """The base is exact, also where words are joined rather than broadcast; training lowers the loss."""
    monkeypatch.setattr(lmscore, "HOT_WORDS", 300)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    got = sorted(lmscore.score_documents(docs, PATH).collect(), key=lambda r: r.doc_id)
    want = sorted(_base([tuple(r) for r in docs.collect()]))
    for r, w in zip(got, want, strict=True):
        assert tuple(r)[:5] == w[:5] and r.base_score == pytest.approx(w[5], rel=1e-9)
        assert -30 * r.n_tokens < r.score < 0


def test_rarer_words_are_also_drawn_by_their_exact_counts(spark, data, monkeypatch):
    monkeypatch.setattr(lmscore, "HOT_WORDS", 300)
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    learned = docs.where(~lmscore.held_out())
    language = lmscore.learn(learned, lmscore.count_words(learned), PATH)
    monkeypatch.setattr(lmscore, "learn", lambda *_: language)
    got = {r.doc_id: r.score for r in lmscore.score_documents(docs, PATH).collect()}
    counts = Counter({r.word and bytes(r.word): r.n for r in lmscore.count_words(learned).collect()})
    scorer = attention.Scorer(language.params, language.unigram, language.begins)
    rare_known = 0
    for doc_id, text in docs.collect():
        words = (text or "").encode().lower().split()
        ids, lengths, hot = language.subwords(words)
        assert hot.tolist() == [language.hot.get(w, 0) for w in words]
        logs = lmscore.score_ids(scorer, [np.append(ids, 0)])[0]
        each = lmscore.word_logs(language, np.append(ids, 0), lengths, np.append(hot, language.hot[None]), logs)
        each += math.log10(sum(language.hot.values()) / language.tokens)
        for i in np.flatnonzero(hot == 0):
            if counts[words[i]]:
                each[i] = math.log10(10.0 ** each[i] + counts[words[i]] / language.tokens)
                rare_known += 1
        assert got[doc_id] == pytest.approx(each.sum(), rel=1e-5)
    assert rare_known > 1000


def test_words_encoded_together_are_encoded_alone():
    words = [w.encode() for w in ("the", "'s", "don't", "a\u00a0b", "\u3000", "<|endoftext|>", "\u00e9t\u00e9", "12,5", "\u0120")]
    use = lmscore.encoder(PATH).tokenizer
    for some in (words, words[:3], words[-2:], []):
        ids, lengths = lmscore._encode(PATH, some)
        alone = [use.encode(" " + w.decode(), add_special_tokens=False).ids for w in some]
        assert ids.tolist() == sum(alone, []) and lengths.tolist() == [len(x) for x in alone]


def test_scores_awkward_rows(spark):
    docs = documents(spark)
    got = sorted(tuple(r)[:5] for r in lmscore.score_documents(docs, PATH).collect() if r.doc_id is not None)
    want = sorted(w[:5] for w in _base([(r.doc_id, r.text) for r in docs.collect()]) if w[0] is not None)
    assert got == want
    assert lmscore.score_documents(docs.limit(0), PATH).count() == 0


def test_windows_score_every_id_once():
    unigram = np.full(lmscore.SUBWORDS, 1 / lmscore.SUBWORDS)
    scorer = attention.Scorer(attention.start(unigram, dim=4, parts=3), unigram, np.arange(lmscore.SUBWORDS) < 5)
    docs = [np.arange(n) % 50 for n in (1, 7, 24, 25, 100)]
    together = lmscore.score_ids(scorer, docs)
    assert [x.shape for x in together] == [(2, len(d)) for d in docs]
    for doc, found in zip(docs, together):
        assert np.allclose(found, lmscore.score_ids(scorer, [doc])[0], atol=1e-5)


def test_targets_and_seats():
    assert mixing.capped_targets([10, 1000, 0], [1, 2, 3], 3) == [30, 980, 0]
    assert sum(mixing.capped_targets([5, 50, 500], [3, 2, 1], 3)) == 555
    assert mixing.sainte_lague([53, 24, 23], 7) == [3, 2, 2]
    claims = [7, 100, 3, 3, 0, 41]
    for seats in (0, 1, 5, 33, 200):
        brute = [0] * len(claims)
        for _ in range(seats):
            i = max(range(len(claims)), key=lambda i: (Fraction(claims[i], 2 * brute[i] + 1), -i))
            brute[i] += 1
        assert mixing.sainte_lague(claims, seats) == brute


@pytest.mark.parametrize("shard_rows", [20, mixing.SHARD_ROWS])
def test_mix_comes_near_its_targets(spark, data, shard_rows):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = mixing.mix_sources(docs, shard_rows=shard_rows).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    again = mixing.mix_sources(docs.repartition(5), shard_rows=shard_rows).select("doc_id", "taken").collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted(map(tuple, again))
    texts = {r.doc_id: r.text for r in docs.collect()}
    sources = sorted({r.source for r in got})
    sizes = {s: sum(len(texts[r.doc_id].encode().split()) for r in got if r.source == s) for s in sources}
    targets = mixing.capped_targets([sizes[s] for s in sources], [1 + i % 3 for i in range(len(sources))], 3)
    for s, target in zip(sources, targets):
        own = [r for r in got if r.source == s]
        assert {(r.source_size, r.target) for r in own} == {(sizes[s], float(target))}
        assert abs(sum(r.taken for r in own) - target) <= mixing.BLOCK
    assert all(0 <= r.taken <= 3 * r.size and r.size == len(texts[r.doc_id].encode().split()) for r in got)


def test_mix_awkward_rows(spark):
    docs = documents(spark).withColumn("target", F.lit("clash"))
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 10 and all(r.taken <= 3 * r["size"] for r in got)
    assert {r.source for r in got if r["size"] == 0} == {"b", None}
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mixed_copies(documents(spark)).columns == documents(spark).columns


def test_pipeline_stages_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data)
        rows = out.collect()
        seen[name] = (docs.collect(), rows)
        if name != "token_ids":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(rows, docs.schema)
    before, after = seen["language"]
    assert set(after) <= set(before) and len(after) >= 0.98 * len(before)
    before, after = seen["near_duplicates"]
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(before)).collect()}
    assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
    before, after = seen["decontaminated"]
    dirty = {r.doc_id for r in QUERIES["op2_decontaminate"](spark, data).where("contaminated").collect()}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == dirty & {r.doc_id for r in before} and dirty
    before, after = seen["mixed"]
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    mixed, ids = seen["token_ids"]
    assert Counter(r.doc_id for r in ids) == Counter(r.doc_id for r in mixed)
    assert sorted(r.start for r in ids)[0] == 0


def test_pipeline_on_an_empty_table(spark, data, tmp_path):
    spark.read.parquet(f"{data}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{data}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, data, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations", "embeddings"):
        db.execute(f"create view {table} as select * from '{data}/{table}.parquet'")
    got = QUERIES[name](spark, data)
    want = db.execute(ORACLES[name]).to_arrow_table().select(got.columns).to_pylist()
    assert sorted(map(str, (r.asDict() for r in got.collect()))) == sorted(map(str, want))
