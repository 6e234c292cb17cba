"""Conversations rendered by a compiled template, and read back from the rendered text.

``format_conversations`` sorts the turns of a conversation and renders them as a stream, so a
conversation is never held as a whole: its text comes out as one row, or as several numbered
``part`` rows once it is longer than ``PART_CHARS``. A part ends between two turns.

Defined results: a null text or role is an empty string; turns are ordered by turn (nulls first),
then role, then text, so repeated turns stay in a fixed order and all count; a null conv_id is a
conversation of its own; an empty table gives an empty result; other columns are ignored.

A conversation is one sequence, and its digests are sequential, so its turns pass one task in
order; memory does not grow with their number.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.template import Template, unescape

PART_CHARS = 1 << 20

# Control strings start with < or #, which escaped texts do not contain.
TURNS = (
    "{% for m in messages %}### {{ m.role | escape }}<text>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
TURN = re.compile(r"### ([^<#]*)<text>([^<#]*)</turn>\n")

FORMATTED = "conv_id long, part int, formatted string, spans array<struct<start:long,end:long>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def format_conversations(turns: DataFrame, source: str = TURNS, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, formatted, spans): the rendered text and the spans under the loss mask.

    Spans count characters within their part. A text is cut only between rounds of the
    template's outermost loop; the parts of a conversation joined in order are its text.
    """
    ordered = (
        turns.select("conv_id", "turn", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        done: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids, parts, texts, spans = zip(*done)
            spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
            columns = [pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(texts, pa.string()), pa.array(spans, pa.list_(_SPAN))]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "part", "formatted", "spans"])

        for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
            messages = ({"role": role, "text": text} for _, role, text in rows)
            part, texts, spans, at = 0, [], [], 0
            for text, masked in template.stream(messages):
                if masked is None:
                    if at >= part_chars:
                        done.append((conv, part, "".join(texts), spans))
                        yield flush()
                        part, texts, spans, at, size = part + 1, [], [], 0, 0
                    continue
                texts.append(text)
                if masked and text:
                    spans.append((at, at + len(text)))
                at += len(text)
            if texts or not part:
                done.append((conv, part, "".join(texts), spans))
            size += at
            if size >= part_chars or len(done) >= 4096:
                yield flush()
                size = 0
        if done:
            yield flush()

    return ordered.mapInArrow(render, FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn, from a text that the ``TURNS`` template printed."""
    found, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return found


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of every conversation, read back from its formatted parts.

    ``formatted`` must come straight from ``format_conversations``: the parts of a conversation
    follow each other in one partition.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done))
            done.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [n.split()[0] for n in DIGESTS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for conv, parts in groupby(_rows(batches), key=lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for _, _, text, spans in parts:
                for role, words in read_turns(text):
                    turns.update(f"{role}\n{words}\n".encode())
                    n_turns += 1
                for span in spans:
                    learned = unescape(text[span["start"] : span["end"]])
                    loss.update(learned.encode())
                    loss_chars += len(learned)
                chars += len(text)
            done.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(done) >= 4096:
                yield flush()
        if done:
            yield flush()

    return formatted.mapInArrow(digest, DIGESTS)
