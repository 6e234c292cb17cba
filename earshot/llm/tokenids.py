"""Token ids of documents in ORC files, in ascending document order.

Documents are range-partitioned and sorted by id, tokenised where they land, and written as ORC:
integer run-length encoding for the ids, a row index, and Bloom filters on ``doc_id``, so files
are read stripe by stripe in parallel and a look-up by id skips stripes. A document is one row per
``CHUNK`` ids, which bounds the size of a row whatever the length of a text.

Tokenising uses the tokenizers library. Its byte-level vocabularies cut a text into pieces before
any merge, always before a blank that stands between two other characters, so equal pieces have
equal ids and are encoded once per worker. GPT-2's pattern also cuts between a letter and a mark or
digit behind it, so a word is encoded once whatever follows it. Arrow cuts the texts and finds the
different pieces; Python only sees these.

Defined results: a null text is empty and has only the end id; null document ids come first;
documents that share an id are ordered by their text's hash; identical rows follow each other;
an empty table gives an empty folder of ids and an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = 0
CHUNK = 4096  # ids per row
ROWS, BYTES = 1024, 4 << 20  # of texts cut together
TOGETHER = 64  # pieces encoded as one text; the library is slower on longer ones
ORC = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": "5000", "orc.stripe.size": str(32 << 20)}
TOKENS = "doc_id long, part int, start long, n_tokens long, chunk int, ids array<int>"

UNSURE = re.compile(r"[ \n]\s|\s[ \n]")
CUT = re.compile(r"(?<=\S) (?=\S)")
ODD = r"[ \n][ \n]|[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"  # such texts are cut in Python
MARKS = "!\"#$%&()*+,-./0123456789:;=?@[\\]^_`{}~"  # no apostrophe, as 's is one piece; none of what special tokens are written with
LETTER_LAST = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]$"


class PieceEncoder:
    """Ids of whole texts, with the ids of short pieces kept."""

    def __init__(self, path: str, max_kept: int = 800_000, max_piece: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        if '"type": "ByteLevel"' not in json.dumps([spec["normalizer"], before]):
            raise ValueError("pieces can only be cut for a byte-level vocabulary")
        special = {c for t in spec["added_tokens"] for c in t["content"]}
        gpt2 = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not spec["normalizer"]
        self.tails = gpt2 and special.isdisjoint(MARKS)
        self.kept: dict[str, bytes] = {"": b""}  # two generations: what the older one still gives moves to the newer
        self.older: dict[str, bytes] = {}
        self.max_kept, self.max_piece = max_kept, max_piece
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.begins = np.zeros(size, bool)  # by id: does it begin with a blank?
        for token, i in self.tokenizer.get_vocab().items():
            self.begins[i] = token.startswith("\u0120")  # how a byte-level vocabulary writes a blank

    def pieces(self, text: str) -> list[str]:
        if "\0" in text:
            return [text]
        line = text.replace("\n", " ")  # printable: no white space but blanks, so no pattern is needed
        if "  " in line if line.isprintable() else UNSURE.search(text):
            return CUT.sub("\0 ", text).split("\0")
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one behind the other, and how many each has.

        Printable pieces of one word behind one blank are encoded together: nothing merges across
        their blanks, and the ids that begin with a blank tell where each starts.
        """
        ids, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in range(0, len(pieces), TOGETHER):
            some = pieces[i : i + TOGETHER]
            text = "".join(some)
            if text.isprintable() and text.count(" ") == [p[:1] for p in some].count(" ") == len(some) and " " not in some:
                found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
                starts = np.flatnonzero(self.begins[found])
                if len(starts) == len(some) and starts[0] == 0:
                    ids.append(found)
                    lengths.append(np.diff(starts, append=len(found)))
                    continue
            each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            ids += [np.array(x, np.int64) for x in each]
            lengths.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(ids), np.concatenate(lengths)

    def cut(self, texts: pa.LargeStringArray) -> pa.ListArray:
        """Pieces of texts without a zero character."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        odd = pc.match_substring_regex(texts, ODD)
        if pc.any(odd).as_py():
            marked = pc.replace_with_mask(marked, odd, pa.array(["\0".join(self.pieces(t)) for t in texts.filter(odd).to_pylist()], texts.type))
        return pc.split_pattern(marked, "\0")

    def look_up(self, different: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces, one behind the other, and how many each has."""
        pieces = different.to_numpy(zero_copy_only=False).tolist()  # some ten times faster than to_pylist
        if len(self.kept) > self.max_kept // 2:
            self.kept, self.older = {"": b""}, self.kept
        raw = list(map(self.kept.get, pieces))
        unseen = [i for i, r in enumerate(raw) if r is None]
        missing, alone = [], []
        for i in unseen:
            raw[i] = self.older.get(p := pieces[i])
            if raw[i] is None:
                (alone if _alone(p) else missing).append(i)
        missing += alone
        ids, lengths = self.encode_pieces([pieces[i] for i in missing])
        new, ends = ids.astype(self.dtype).tobytes(), (np.cumsum(lengths) * self.dtype.itemsize).tolist()
        for i, a, b in zip(missing, [0, *ends], ends):
            raw[i] = new[a:b]
        self.kept.update((pieces[i], raw[i]) for i in unseen if len(pieces[i]) <= self.max_piece)
        return np.frombuffer(b"".join(raw), self.dtype), np.fromiter(map(len, raw), np.int64, len(raw)) // self.dtype.itemsize

    def encode_all(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has."""
        if pc.any(pc.match_substring(texts, "\0")).as_py():
            return self.encode_pieces(texts.to_pylist())
        offsets, which, pieces = _different(self.cut(texts))
        if self.tails:
            parts, each, words = _different(_words_and_tails(pieces))
            ids, lengths = _gather(*self.look_up(words), each)
            lengths = _sums(lengths, parts)
        else:
            ids, lengths = self.look_up(pieces)
        ids, lengths = _gather(ids, lengths, which)
        return ids, _sums(lengths, offsets)

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        ids, lengths = self.encode_all(pa.array(texts, pa.large_string()))
        ends = np.cumsum(lengths)
        return [ids[a:b] for a, b in zip(ends - lengths, ends)]


def _different(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.LargeStringArray]:
    """Where each list begins and ends among all values, the number of each value, and the values by number."""
    offsets = lists.offsets.to_numpy()
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return offsets - offsets[0], values.indices.to_numpy(), values.dictionary


def _words_and_tails(pieces: pa.LargeStringArray) -> pa.LargeListArray:
    """Each piece as it is, or the word it begins with and the marks behind."""
    words = pc.utf8_rtrim(pieces, MARKS)
    bounds = np.frombuffer(pieces.buffers()[1], np.int64)[: len(pieces) + 1]
    ends = bounds[:-1] + pc.binary_length(words).to_numpy()
    two = (ends < bounds[1:]) & pc.match_substring_regex(words, LETTER_LAST).to_numpy(zero_copy_only=False)
    within = np.sort(np.concatenate([bounds, ends[two]]))
    values = pa.LargeStringArray.from_buffers(len(within) - 1, pa.py_buffer(within), pieces.buffers()[2])
    return pa.LargeListArray.from_arrays(pa.array(np.cumsum(np.append(0, 1 + two))), values)


def _gather(ids: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` with these numbers, one behind the other, and their lengths."""
    chosen = lengths[which]
    behind = np.cumsum(chosen)
    begins = (np.cumsum(lengths) - lengths)[which]
    return ids[np.repeat(begins - behind + chosen, chosen) + np.arange(chosen.sum())], chosen


def _sums(lengths: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(lengths)])[offsets])


def _alone(piece: str) -> bool:
    """Pieces that are not a printable word behind a blank come last, so that they share few batches with others."""
    return piece[:1] != " " or not piece.isprintable()


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def tokenize(docs: DataFrame, tokenizer: str, end: int = END, chunk: int = CHUNK) -> DataFrame:
    """Rows of token ids in document order; ``start`` counts from the beginning of the partition."""
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_h", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h")
        .select("doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        use = encoder(tokenizer)
        for batch in batches:
            step = max(1, min(ROWS, BYTES * batch.num_rows // max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                found, lengths = use.encode_all(some["text"].cast(pa.large_string()))
                n = lengths + 1
                ids = np.full(n.sum(), end, np.int32)
                last = np.cumsum(n) - 1
                ids[np.delete(np.arange(len(ids)), last)] = found
                starts = start + last + 1 - n
                rows = -(-n // chunk)
                doc = np.repeat(np.arange(len(n)), rows)
                k = np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)
                offsets = np.append(starts[doc] - start + k * chunk, len(ids)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        some["doc_id"].take(pa.array(doc)),
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(starts[doc]),
                        pa.array(n[doc]),
                        pa.array(k.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                    ],
                    ["doc_id", "part", "start", "n_tokens", "chunk", "ids"],
                )
                start += len(ids)
            pa.default_memory_pool().release_unused()  # a worker's memory counts with its executor's

    return ordered.mapInArrow(encode, TOKENS)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    tokenize(docs, tokenizer, **options).write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """Rows of a token folder; with ``ids``, stripes without them are skipped by their Bloom filters."""
    rows = spark.read.schema(TOKENS).orc(path)
    return rows if ids is None else rows.where(F.col("doc_id").isin(ids))


def _times_x(value: int) -> int:
    return (value >> 1) ^ (0xEDB88320 if value & 1 else 0)


def _product(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial, bits reversed."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = _times_x(b)
    return out


def crc_of_joined(first: int, second: int, second_bytes: int) -> int:
    """crc32(a + b) from crc32(a), crc32(b) and len(b)."""
    shift, power, n = 1 << 31, 1 << 23, second_bytes  # x**0 and x**8
    while n:
        if n & 1:
            shift = _product(shift, power)
        power = _product(power, power)
        n >>= 1
    return _product(shift, first) ^ second


def document_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the rows of a token folder.

    ``start`` counts from the first document of the folder: the totals of the partitions, one
    number per written file, are summed in order. Checksums are taken per chunk where the stripes
    are read and joined per document, so no document has to meet in one task as a whole.
    """
    spark = tokens.sparkSession
    totals = tokens.where("chunk = 0").groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, table = 0, []
    for r in totals:
        table.append((r.part, before))
        before += r.n
    offsets = spark.createDataFrame(table, "part int, before long")

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            keep = [batch[c] for c in ("doc_id", "part", "start", "n_tokens", "chunk")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(np.diff(ends).astype(np.int64)), pa.array(crcs, pa.int64())],
                ["doc_id", "part", "start", "n_tokens", "chunk", "n", "crc"],
            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, chunks = batch["chunks"].offsets.to_numpy(), batch["chunks"].values
            crc, n = (chunks.field(c).to_numpy() for c in ("crc", "n"))
            crcs = crc[ends[:-1]]
            for i in np.flatnonzero(np.diff(ends) > 1):
                for c in range(ends[i] + 1, ends[i + 1]):
                    crcs[i] = crc_of_joined(int(crcs[i]), int(crc[c]), 4 * int(n[c]))
            keep = [batch[c] for c in ("doc_id", "part", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(crcs, pa.int64())], ["doc_id", "part", "start", "n_tokens", "ids_crc32"])

    per_chunk = tokens.mapInArrow(checksum, "doc_id long, part int, start long, n_tokens long, chunk int, n long, crc long")
    chunks = F.array_sort(F.collect_list(F.struct("chunk", "n", "crc"))).alias("chunks")
    per_doc = per_chunk.groupBy("doc_id", "part", "start", "n_tokens").agg(chunks)
    joined = per_doc.mapInArrow(join, "doc_id long, part int, start long, n_tokens long, ids_crc32 long")
    return joined.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
