"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are lower-cased (A-Z) and cut into words; a window is ``width`` consecutive words of an item,
or the whole item if it is shorter. Each document is scanned once, word by word, and every
occurrence of every window marks the words it covers; word positions lead back to the characters
of the original text. The automaton walks over word numbers, not characters: words that no
benchmark item holds are number zero, which no window contains.

The benchmark is a stated set with a checked size: its windows are broadcast in blocks of at most
``MAX_BLOCK_WORDS`` words, each block one automaton, all scanned in the same pass over the
documents; beyond ``MAX_WORDS`` it is refused.

Defined results: null and empty texts have no words and no hits; items without words hit nothing;
items that share an id count once; a null item id is named ``null``; repeated documents are
scanned one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WIDTH = 10
MAX_BLOCK_WORDS = 4_000_000
MAX_WORDS = 20_000_000  # of the whole benchmark

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower_ascii(text: str) -> str:
    return text.encode().lower().decode()  # bytes.lower changes A-Z only


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(lower_ascii(text)) if text else []


class Windows:
    """The automaton over one block of benchmark items."""

    def __init__(self, items: list[tuple[str, str]], width: int = WIDTH):
        self.numbers: dict[str, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for i in range(max(len(words) - width, 0) + 1 if words else 0):
                found.setdefault(tuple(words[i : i + width]), set()).add(name)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, names in found.items():
            self.automaton.add_word(window, (len(window), tuple(sorted(names))))
        self.automaton.make_automaton()
        self.empty = not found

    def scan(self, words: list[str]) -> Iterator[tuple[int, int, tuple[str, ...]]]:
        """(first word, word behind the last, item ids) of every occurrence."""
        if self.empty or not words:
            return
        for last, (length, names) in self.automaton.iter(tuple(map(self.numbers.get, words, repeat(0)))):
            yield last + 1 - length, last + 1, names


def scan_text(blocks: list[Windows], text: str | None) -> tuple[int, int, list[str], list[list[int]]]:
    """(words, words hit, ids of the items found, hit spans as [start, end) in characters)."""
    words = words_of(text)
    hit, names = bytearray(len(words)), set()
    for block in blocks:
        for start, end, found in block.scan(words):
            hit[start:end] = b"\x01" * (end - start)
            names.update(found)
    spans: list[list[int]] = []
    if names:
        for i, match in enumerate(WORDS.finditer(lower_ascii(text))):
            if hit[i]:
                if i and hit[i - 1]:
                    spans[-1][1] = match.end()
                else:
                    spans.append([match.start(), match.end()])
    return len(words), sum(hit), sorted(names), spans


_AUTOMATA: dict[int, list[Windows]] = {}


def _windows(items: Broadcast, key: int, width: int) -> list[Windows]:
    """Built once per worker process, not once per task."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = [Windows(block, width) for block in items.value]
    return _AUTOMATA[key]


def item_blocks(benchmark: DataFrame) -> list[list[tuple[str, str]]]:
    """The benchmark in blocks of bounded size, refused beyond its bound."""
    blocks, size, total = [[]], 0, 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        n = len(words_of(row.text))
        total += n
        if total > MAX_WORDS:
            raise ValueError(f"benchmark above {MAX_WORDS} words")
        if size and size + n > MAX_BLOCK_WORDS:
            blocks.append([])
            size = 0
        if n:
            blocks[-1].append(("null" if row.item_id is None else str(row.item_id), row.text))
            size += n
    return blocks


RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
]


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), width: int = WIDTH) -> DataFrame:
    """``keep`` columns with the words, hits, items and hit spans of every document.

    ``items_sha256`` is over the sorted item ids, comma-joined; ``spans`` are character offsets
    into the original text. No shuffle: the documents are scanned where they lie.
    """
    items = docs.sparkSession.sparkContext.broadcast(item_blocks(benchmark))
    key = items._jbroadcast.id()
    names = [f.name for f in RESULT]
    source = docs.select(*keep, docs["text"].alias("_text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _windows(items, key, width)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [scan_text(blocks, t) for t in part["_text"].to_pylist()]
                digests = [hashlib.sha256(",".join(ids).encode()).hexdigest() for _, _, ids, _ in found]
                values = [
                    [n for n, _, _, _ in found],
                    [hit for _, hit, _, _ in found],
                    [len(ids) for _, _, ids, _ in found],
                    digests,
                    [hit > 0 for _, hit, _, _ in found],
                    [ids for _, _, ids, _ in found],
                    [spans for _, _, _, spans in found],
                ]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(
                    [part[c] for c in keep] + [pa.array(v, t) for v, t in zip(values, types)], [*keep, *names]
                )

    return source.mapInArrow(scan, T.StructType([docs.schema[c] for c in keep] + RESULT))
