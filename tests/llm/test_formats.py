"""Chat formatting, token files, URL rules and licences."""

import hashlib
import random
import zlib

import public_tokenizers
import pytest
from helpers import DOCS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.llm import chat, licenses, tokenids, urlfilter
from earshot.llm.template import Template, TemplateError, Text, compile_template, escape, fold, parse, unescape

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.text())
def test_escape_is_reversible_and_hides_control_strings(text):
    assert unescape(escape(text)) == text
    assert "<" not in escape(text) and "#" not in escape(text)


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' + 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}e")) == (Text("abcde"),)


def test_template_language():
    t = compile_template(
        "{% set n = 'N' %}{% for m in messages %}{{ loop.index0 }}{% if loop.first %}^{% elif loop.last %}${% else %}-{% endif %}"
        "{{ m.role | upper }}{% generation %}{{ n + m.text }}{% endgeneration %};{% endfor %}"
    )
    text, spans = t.render([{"role": "a", "text": "x"}, {"role": "b", "text": "y"}, {"role": "c", "text": None}])
    assert text == "0^ANx;1-BNy;2$CN;"
    assert [text[a:b] for a, b in spans] == ["Nx", "Ny", "N"]


@pytest.mark.parametrize("source", ["{{ m.__class__ }}", "{{ x | eval }}", "{% for %}", "{% if 1 %}", "{{ 1 + }}", "{% import os %}"])
def test_template_refuses(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_template_reaches_no_python_attribute():
    with pytest.raises(TemplateError):
        Template("{{ messages.append }}").render([])


TURNS = "conv_id long, turn long, role string, text string, spans string"


@pytest.mark.parametrize("part_chars", [10, 1 << 20])
def test_conversations_are_read_back(spark, part_chars):
    odd = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", odd, None), (-7, 1, "assistant", odd, "x"), (1, 2, "assistant", "b" * 50, "x"), (1, 1, "user", None, "x")]
    rows += [(1, 2, "assistant", "b" * 50, "x"), (None, None, None, None, None), (2, 0, "a<text>#: ", "", "x")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, TURNS), part_chars=part_chars)
    got = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    want = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    parts = formatted.where("conv_id = 1").count()
    assert parts == (1 if part_chars > 1000 else 3)
    assert chat.conversation_digests(chat.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


def _whole(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@settings(deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\u00a0a1'é.\0"), st.characters(codec="utf-8")), max_size=30))
def test_pieces_encode_as_the_whole(text):
    assert tokenids.encoder(PATH).encode([text])[0].tolist() == _whole(text)


def test_documents_of_the_test_tables_encode_as_a_whole(spark, data):
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    assert [x.tolist() for x in tokenids.encoder(PATH).encode(texts)] == [_whole(t) for t in texts]


def test_a_word_is_encoded_once_whatever_marks_follow_it(monkeypatch):
    use, seen = tokenids.PieceEncoder(PATH), []
    inner = use.encode_pieces
    monkeypatch.setattr(use, "encode_pieces", lambda pieces: seen.extend(pieces) or inner(pieces))
    texts = [" Zugabe Zugabe. Zugabe, Zugabe!!", " Zugabe... Zugabe7 Zugabe's Zugabe'"]
    assert [x.tolist() for x in use.encode(texts)] == [_whole(t) for t in texts]
    assert sorted(p for p in seen if "Zug" in p) == [" Zugabe", " Zugabe'", " Zugabe's"]


def test_marks_white_space_and_strange_letters_in_any_order():
    parts = ["a", "B", "the", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!?", "'s", "'", "don't", "\u00e9", "\u00df", "\u00d7", "\u00aa", "42", "\u00b2", "_", "-", "<", "|"]
    parts += ["<|endoftext|>", "\u00a0", "\u3000", "\u65e5\u672c", "\u0301", "\u0250", "\u044f", "\u200b", "\r\n", "\x1c", "\x85", "\\", "^", "@a.b", "\0"]
    draw = random.Random(5)
    use = tokenids.PieceEncoder(PATH, max_kept=500, max_piece=8)  # kept pieces are dropped often
    whole = tokenids.PieceEncoder(PATH).tokenizer.encode
    for k in range(40):
        texts = ["".join(draw.choices(parts[: -1 if k % 4 else None], k=draw.randrange(40))) for _ in range(50)]
        assert [x.tolist() for x in use.encode(texts)] == [whole(t, add_special_tokens=False).ids for t in texts]



@given(st.binary(), st.binary())
def test_checksums_join(a, b):
    assert tokenids.crc_of_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files(spark, tmp_path):
    docs = documents(spark)
    tokenids.write_tokens(docs, str(tmp_path / "t"), PATH, chunk=16)
    rows = tokenids.read_tokens(spark, str(tmp_path / "t"))
    got = sorted(map(tuple, tokenids.document_digests(rows).collect()), key=lambda r: r[1])
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    start, want = 0, []
    for r in sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h)):
        ids = _whole(r.text) + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert got == want
    assert rows.agg(F.max(F.size("ids"))).first()[0] == 16
    assert {r.doc_id for r in tokenids.read_tokens(spark, str(tmp_path / "t"), [6]).collect()} == {6}


def test_empty_token_files(spark, tmp_path):
    tokenids.write_tokens(documents(spark, []), str(tmp_path / "t"), PATH)
    assert tokenids.document_digests(tokenids.read_tokens(spark, str(tmp_path / "t"))).count() == 0


def test_url_rules(spark):
    rule = urlfilter.Rule
    rules = [rule("net", "/", "block"), rule("example.net", "/en/", "allow"), rule("example.net", "/en/x", "block"), rule("org", "/f", "allow"), rule("org", "/f", "block")]
    cases = {
        "http://A.NET/": ("a.net", "/", "net/", "block"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://b.Example.net/en/1?q=/#": ("b.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/en/xy": ("example.net", "/en/xy", "example.net/en/x", "block"),
        "http://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "x://y.org/fr?z": ("y.org", "/fr", "org/f", "block"),
        "no scheme.net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    table = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] + [(0, "http://A.NET/", "h")], "page_id long, url string, host string")
    got = urlfilter.judge_urls(table, rules)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(i, *v) for i, v in enumerate(cases.values())] + [(0, *cases["http://A.NET/"])], key=str)
    assert urlfilter.judge_urls(table.limit(0), rules).count() == 0


def test_license_sequences(spark):
    texts = [
        "Intro.\nLicensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License. More.",
        "Released under the MIT License.\nx\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You may obtain a copy of the License at", "no licence here, licensed to no one", "", None,
    ]
    rows = [(i, t, None, None, None, None) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.licenses, r.unmatched) for r in licenses.find_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {
        0: (["Apache-2.0"], []), 1: (["MIT", "CC-BY-NC-4.0"], []), 2: (["GPL-3.0-or-later"], []),
        3: ([], ["apache_copy"]), 4: ([], []), 5: ([], []), 6: ([], []),
    }
    assert licenses.find_licenses(documents(spark, [])).count() == 0


def test_every_known_sentence_holds_a_hint_and_every_identifier_has_a_rule():
    assert all(any(h in s for h in licenses.HINTS) for s in licenses.SENTENCES)
    assert all(licenses.normalise(s) == s for s in licenses.SENTENCES)
    assert {i for sequence, _ in licenses.RULES for i in sequence} == set(licenses.SENTENCES.values())


def test_license_scan_agrees_with_a_search_for_lines(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.find_licenses(docs).collect():
        for line, name in lines.items():
            assert (name in r.licenses) == (line in texts[r.doc_id].split("\n")) or line in texts[r.doc_id]
