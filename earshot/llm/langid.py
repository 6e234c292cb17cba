"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its character n-grams, hashed to buckets: n-grams of 3
and 4 bytes of the lower-cased text whose non-letters are blanks, so word ends count. Embeddings
and output layer are trained by stochastic gradient descent in NumPy. Beside the languages they
learn one class of strange text, made from half of the training documents: letters in random order
or drawn at random, and ciphers, whose letters stand for others of the same or of another script and
which look like text of a language never learned. A part of all is kept back to calibrate: a
temperature that makes scores probabilities, and the score below which an answer is rejected, which
strange texts stay below (99 of 100) and, as the first rule, all but ``FALSE_REJECTS`` of right answers exceed.

The classifier is fitted on a stated number of labelled documents (``SAMPLE``), about equally many
of each language, drawn by a hash of the id; their whole texts are used. Prediction reads every
whole text, where it lies.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; if
no labelled document can be learned from, all are; documents without a language or an id are not
learned from; repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.llm.words import id_crc

SAMPLE = 3000
MAX_LANGUAGES = 1000
BUCKETS = 4096
DIM = 16
FALSE_REJECTS = 0.001  # share of right answers that calibration may reject
SURE = 0.1  # score below which an answer is always rejected, if calibration allows
SCRIPTS = (0x430, 0x3B1, 0x5D0, 0x627, 0x905, 0x4E00, 0xAC00)  # first letters of some scripts
UNKNOWN = "und"

_BLANKS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def _script(number: int, n: int) -> list[str]:
    """The first letters of a script, at least as many as asked for and 24."""
    found, at = [], SCRIPTS[number]
    while len(found) < max(24, n):
        found += [chr(at)] * chr(at).isalpha()
        at += 1
    return found


def strange(text: str, seed: int) -> str:
    """The text in a language that nobody speaks: its words keep their places and lengths."""
    draw = np.random.default_rng([seed, 11])
    letters = sorted({c for c in text.lower() if c.isalpha()})
    kind = seed % 4
    if kind == 0:  # the same letters in another order
        chars = np.array(list(text.lower()))
        at = np.flatnonzero([c.isalpha() for c in chars])
        chars[at] = chars[draw.permutation(at)]
        return "".join(chars)
    if kind == 1:  # letters drawn at random
        return "".join([chr(97 + d) if c.isalpha() else c for c, d in zip(text.lower(), draw.integers(0, 26, len(text.lower())))])
    pool = sorted({*letters, *"abcdefghijklmnopqrstuvwxyz"}) if kind == 2 else _script(int(draw.integers(len(SCRIPTS))), len(letters))
    return text.lower().translate({ord(c): pool[i] for c, i in zip(letters, draw.permutation(len(pool)))})


def features(text: str) -> np.ndarray:
    """Share of each bucket among the n-grams of the text."""
    raw = np.frombuffer(b" " + text.lower().encode().translate(_BLANKS) + b" ", np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS)
    for start in range(0, len(raw), 1 << 20):
        a = raw[start : start + (1 << 20) + 3]
        three = a[:-2] | a[1:-1] << 8 | a[2:] << 16
        four = three[:-1] | a[3:] << 24
        for code, blank in ((three, 0x202020), (four, 0x20202020)):
            code = code[: 1 << 20]
            hashed = (code[code != blank] * np.uint32(2654435761)) >> np.uint32(20)
            counts += np.bincount(hashed, minlength=BUCKETS)
    return (counts / max(counts.sum(), 1)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # embeddings times output layer: buckets x languages, and strange text if it was learned
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """Of the languages; what they leave to one is the probability of strange text."""
        return _softmax((rows @ self.weights + self.bias) / self.temperature)[:, : len(self.languages)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: np.ndarray, labels: list[str | None], seed: int = 7, epochs: int = 25, batch: int = 32, rate: float = 30.0) -> Model | None:
    """Fit on four fifths of the rows, calibrate on the rest; a null label is strange text."""
    languages = sorted({x for x in labels if x is not None})
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    number = {x: i for i, x in enumerate(languages)} | {None: len(languages)}
    y = np.array([number[x] for x in labels])
    classes = int(y.max()) + 1
    order = draw.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    embed = draw.normal(0, 1, (rows.shape[1], DIM)).astype(np.float32)
    out = np.zeros((DIM, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    steps, step = epochs * -(-len(fit) // batch), 0
    for _ in range(epochs):
        for at in np.array_split(draw.permutation(fit), -(-len(fit) // batch)):
            x = rows[at]
            hidden = x @ embed
            error = _softmax(hidden @ out + bias)
            error[np.arange(len(at)), y[at]] -= 1
            error /= len(at)
            slope = rate * (1 - step / steps)
            grown = x.T @ (error @ out.T)
            out -= slope * 0.1 * hidden.T @ error
            bias -= slope * 0.1 * error.sum(0)
            embed -= slope * grown
            step += 1
    weights = embed @ out
    held = held if len(held) else fit
    logits = rows[held] @ weights + bias

    doubt = 1 / (len(held) + 2)  # what remains even if all were right

    def loss(t: float) -> float:
        logs = np.log(_softmax(logits / t) + 1e-12)
        return -float(((1 - doubt) * logs[np.arange(len(held)), y[held]] + doubt * logs.mean(1)).mean())

    temperature = min(np.geomspace(0.01, 10, 61), key=loss)
    scores = _softmax(logits / temperature)[:, : len(languages)]
    right = scores.max(1)[scores.argmax(1) == y[held]]
    odd = scores.max(1)[y[held] == len(languages)]
    wanted = max(SURE, float(np.quantile(odd, 0.99, method="higher"))) if len(odd) else 1.5 / len(languages)
    threshold = min(wanted, float(np.quantile(right, FALSE_REJECTS, method="lower"))) if len(right) else 0.0
    return Model(languages, weights, bias, float(temperature), threshold)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(id_crc(doc_id) % 3 == 1, F.lit(False))


def fit_languages(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from documents with a language whose id hash does not hold them out."""
    crc = id_crc("doc_id")
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc % 3 != 1)).select("text", "lang", crc.alias("_crc"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    each = max(sample // len(counts), 20)
    shares = docs.sparkSession.createDataFrame([(k, min(1.0, each / n)) for k, n in counts.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64("_crc"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.join(F.broadcast(shares), "lang").where(draw < F.col("share")).select("lang", "_crc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = [r for r in zip(*(c.to_pylist() for c in batch.columns)) if has_letter(r[2])]
            rows = [(lang, crc, features(t).tobytes()) for lang, crc, t in known]
            rows += [(None, crc, features(strange(t, crc // 6)).tobytes()) for _, crc, t in known if crc % 2]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, ["lang", "crc", "x"])

    found = chosen.mapInArrow(run, "lang string, crc long, x binary").collect()
    found.sort(key=lambda r: (r["lang"] is None, r["lang"] or "", r["crc"], r["x"]))
    rows = np.array([np.frombuffer(r["x"], np.float32) for r in found]) if found else np.empty((0, BUCKETS), np.float32)
    return train(rows, [r["lang"] for r in found])


def predict_languages(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred, score and rejected, for every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col("text").alias("_text"))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part["_text"].to_pylist()
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                lettered = [i for i, t in enumerate(texts) if has_letter(t)] if known else []
                if lettered:
                    p = known.probabilities(np.array([features(texts[i]) for i in lettered]))
                    scores[lettered] = np.clip(p.max(1), 0, 1)
                    for i, k in zip(lettered, p.argmax(1)):
                        names[i] = known.languages[k]
                threshold = known.threshold if known else 0.0
                rejected = [n == UNKNOWN and s == 0 or s < threshold for n, s in zip(names, scores)]
                yield pa.RecordBatch.from_arrays(
                    [*(part[c] for c in keep), pa.array(names), pa.array(scores), pa.array(rejected, pa.bool_())],
                    [*keep, "lang_pred", "score", "rejected"],
                )

    return source.mapInArrow(run, T.StructType([source.schema[c] for c in keep] + added))


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is rejected."""
    columns = docs.columns
    wide = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)], F.col("text"))
    judged = predict_languages(wide, fit_languages(docs), tuple(f"c{i}" for i in range(len(columns))))
    return judged.where(~F.col("rejected")).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)])
