"""Quality of a text by supervised subword embeddings.

A text is the average of learned vectors: of its words, of the character n-grams of each word with its
ends marked, and of neighbouring words, all hashed into ``BUCKETS`` rows. A softmax over the average
gives the label. Vectors start at zero, so what was never seen in training says nothing.

Training takes a bounded sample of labelled texts, dealt to ``PARTS`` parts. Each part runs all epochs
of stochastic gradient descent from the same beginning, and the parts' models are averaged. The
result depends on the sample alone, and the driver sees nothing but the models, a megabyte each.

To score, a row's part in the softmax is one number, so a word seen before costs one look-up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_pass, stored

FOLDS, HELD_FOLD = 4, 2
#: The bounded sample: labelled documents, as expected from their hashes.
SAMPLE_DOCS = 3000
BUCKETS = 1 << 15
WIDTH = 8
GRAMS = (3, 4, 5)
PARTS = 4
EPOCHS = 5
RATE = 2.0
#: Score from which a text counts as good.
GOOD = 0.7
#: A longer stretch without white space is several words.
LONGEST_WORD = 1000
#: Distinct words, and characters of them, that a worker remembers; characters worked on at once.
MEMO_WORDS, MEMO_CHARS = 400_000, 8_000_000
CHUNK_CHARS = 500_000

FOUND = "doc_id long, held_out boolean, score double, predicted int"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id):
    """Whether a document is kept out of training; a null id has the checksum of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


# ------------------------------------------------------------- features

def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _STEP
    return values ^ (values >> np.uint64(29))


def word_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all features of the words, the word that each belongs to, and the words' hashes.

    A word's features are itself and its character n-grams, with one mark at each end.
    """
    text = "".join(f"\x02{word}\x03" for word in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.array([len(word) + 2 for word in words], np.int64)
    end = np.cumsum(length)
    owner = np.repeat(np.arange(len(words)), length)
    # one weighted running sum serves the grams of every length
    found, owners = [], []
    for size in GRAMS:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        gram = np.zeros(n, np.uint64)
        for i in range(size):
            gram = gram * _MIX + codes[i:i + n]
        inside = owner[:n] == owner[size - 1:]
        found.append(mixed(gram[inside] + np.uint64(size)))
        owners.append(owner[:n][inside])
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat((end - length).astype(np.uint64), length)
    whole = mixed(np.add.reduceat(mixed(codes + place * _MIX), end - length)) if len(words) else \
        np.zeros(0, np.uint64)
    found.append(whole)
    owners.append(np.arange(len(words)))
    rows = (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)
    return rows, np.concatenate(owners), whole


def pair_rows(hashes: np.ndarray) -> np.ndarray:
    """Rows of the pairs of neighbouring words, by the difference of their hashes: repeated words
    share one row, whatever the word."""
    pairs = mixed(hashes[:-1] ^ hashes[1:])
    return (pairs % np.uint64(BUCKETS)).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    words = (text or "").split()
    if len(text or "") > LONGEST_WORD and max(map(len, words), default=0) > LONGEST_WORD:
        words = [word[at:at + LONGEST_WORD] for word in words
                 for at in range(0, len(word), LONGEST_WORD)]
    return words


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a text and their shares of its average."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words])
    times, distinct = np.bincount(ids, minlength=len(number)), list(number)
    found, counts, hashes = [], [], np.zeros(len(number), np.uint64)
    for at, upto in chunks(distinct):
        rows, owner, hashes[at:upto] = word_rows(distinct[at:upto])
        found.append(rows)
        counts.append(times[at + owner])
    pairs = pair_rows(hashes[ids])
    used, place = np.unique(np.concatenate([*found, pairs]), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate([*counts, np.ones(len(pairs))]))
    return used.astype(np.int32), (total / total.sum()).astype(np.float32)


def chunks(words: list[str]) -> list[tuple[int, int]]:
    """Borders of runs of words of about ``CHUNK_CHARS`` characters."""
    sums = np.cumsum([len(word) + 2 for word in words]) // CHUNK_CHARS if words else np.zeros(0)
    cuts = [0, *(np.flatnonzero(np.diff(sums)) + 1).tolist(), len(words)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


# ------------------------------------------------------------- training

@dataclass
class Model:
    vectors: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls) -> Model:
        out = np.random.default_rng(13).normal(0, 1, (2, WIDTH)).astype(np.float32)
        return cls(np.zeros((BUCKETS, WIDTH), np.float32), out, np.zeros(2, np.float32))

    def row_scores(self) -> np.ndarray:
        """What a row adds to the log odds of label 1."""
        return (self.vectors @ (self.out[1] - self.out[0])).astype(np.float64)

    def base_score(self) -> float:
        return float(self.bias[1] - self.bias[0])


def descend(model: Model, texts: list[tuple[np.ndarray, np.ndarray, int]], rate: float,
            seed: int) -> Model:
    """One pass of stochastic gradient descent over (rows, shares, label)."""
    order = np.random.default_rng(seed).permutation(len(texts))
    for n, i in enumerate(order.tolist()):
        rows, shares, label = texts[i]
        step = rate * (1 - n / len(order) / 2)
        mean = shares @ model.vectors[rows]
        logits = model.out @ mean + model.bias
        chance = np.exp(logits - logits.max())
        chance /= chance.sum()
        chance[label] -= 1
        back = model.out.T @ chance
        model.out -= step * 0.1 * np.outer(chance, mean)
        model.bias -= step * 0.1 * chance
        # shares are small: a text moves its rows as if each were seen once in every ten features
        model.vectors[rows] -= (step * 10) * shares[:, None] * back
    return model


def sample_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, quality, text`` of the bounded sample.

    Labels of one id count by majority, of its texts the first in order is taken; labels without a
    value, an id or a document say nothing. Ids are picked by their hash.
    """
    known = stored(
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                     & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality")), "labels")
    share = SAMPLE_DOCS / max(known.count(), 1)
    picked = known.where(F.abs(F.xxhash64("doc_id") % 1_000_000) < 1_000_000 * min(share, 1.0))
    return docs.select(F.col("doc_id").cast("long"), "text").join(
        F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the documents' labels, from the training folds only.

    With no labelled document the model says nothing: every score is one half.
    """

    def make():
        def step(columns):
            found = [features(text) for text in columns[2]]
            return [columns[0], columns[1], [rows.tolist() for rows, _ in found],
                    [shares.tolist() for _, shares in found]]

        return step

    texts = arrow_pass(
        sample_texts(docs, labels), "doc_id long, quality int, at array<int>, shares array<float>",
        make).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PARTS)).cast("int"))

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        part = rows.column("part")[0].as_py()
        given = list(zip(
            [np.array(x, np.int64) for x in rows.column("at").to_pylist()],
            [np.array(x, np.float32) for x in rows.column("shares").to_pylist()],
            rows.column("quality").to_pylist()))
        own = Model.fresh()
        for epoch in range(EPOCHS):
            descend(own, given, RATE * (1 - epoch / EPOCHS), epoch * PARTS + part)
        return pa.table({
            "part": pa.array([part], pa.int32()), "vectors": [own.vectors.tobytes()],
            "out": [own.out.tobytes()], "bias": [own.bias.tobytes()]})

    parts = sorted(texts.groupBy("part").applyInArrow(
        learn, "part int, vectors binary, out binary, bias binary").collect())
    if not parts:
        return Model.fresh()

    def mean(name: str, *shape: int) -> np.ndarray:
        return np.mean([np.frombuffer(row[name], np.float32).reshape(shape) for row in parts], axis=0)

    return Model(mean("vectors", -1, WIDTH), mean("out", 2, WIDTH), mean("bias", 2))


# ------------------------------------------------------------- scoring

class Scorer(dict):
    """Numbers of the words met so far; their scores, features and hashes lie in arrays."""

    def __init__(self, row_scores: np.ndarray, base: float):
        super().__init__()
        self.row_scores, self.base = row_scores, base
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.chars = 0
        self.scores, self.sizes = np.zeros(0), np.zeros(0, np.int64)
        self.hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        self.chars += len(word)
        return number

    def learn(self) -> None:
        """Score the words met for the first time."""
        for at, upto in chunks(self.fresh):
            rows, owner, hashes = word_rows(self.fresh[at:upto])
            self.scores = np.append(self.scores, np.bincount(
                owner, weights=self.row_scores[rows], minlength=upto - at))
            self.sizes = np.append(self.sizes, np.bincount(owner, minlength=upto - at))
            self.hashes = np.append(self.hashes, hashes)
        self.fresh = []

    def __call__(self, texts: list[str | None]) -> list[float]:
        if len(self) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self.forget()
        number = self.__getitem__
        numbers = [np.array([*map(number, words_of(text))], np.int64) for text in texts]
        self.learn()
        found = []
        for ids in numbers:
            odds = self.base
            if len(ids):
                total = self.scores[ids].sum() + self.row_scores[pair_rows(self.hashes[ids])].sum()
                odds += total / (self.sizes[ids].sum() + len(ids) - 1)
            found.append(float(1 / (1 + np.exp(-np.clip(odds, -500, 500)))))
        return found


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Null and empty texts get the score of the model's bias. Repeated rows give repeated rows; long
    texts are read whole; extra columns are ignored; an empty table gives an empty table.
    """
    given = docs.sparkSession.sparkContext.broadcast((model.row_scores(), model.base_score()))
    rows = docs.select(F.col("doc_id").cast("long"),
                       held_out(F.col("doc_id")).alias("held_out"), "text")

    def make():
        score = Scorer(*given.value)

        def step(columns):
            scores = score(columns[2])
            return [columns[0], columns[1], scores, [int(s >= GOOD) for s in scores]]

        return step

    return arrow_pass(rows, FOUND, make)
