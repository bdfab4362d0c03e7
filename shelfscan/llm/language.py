"""Language of a text by compression.

Per language, zstandard gets a raw-content dictionary of training text. A text, in blocks of
``BLOCK_BYTES``, is compressed with each dictionary, and the language with the smallest total
wins. The score grows with the margin to the second best; narrow margins are rejected.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_pass

#: The bounded training sample: texts per language, characters of a text, dictionary bytes.
SAMPLE_TEXTS = 200
SAMPLE_CHARS = 1500
DICTIONARY_BYTES = 32 << 10
BLOCK_BYTES = 2 << 10
FOLDS = 5
#: Relative margin at which the score is one half, and the score under which a text is rejected.
HALF_MARGIN = 0.05
MIN_SCORE = 0.05
UNKNOWN = "und"

FOUND = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id):
    """Whether a document is kept out of training: crc32 of its id as text, modulo 5, is 0.

    A null id has the checksum of the empty text.
    """
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def plain(text: str | None) -> bytes:
    """The distinct words of a text, letters in lower case, in order and parted by a blank.

    Repeats are left out: any dictionary codes them equally well. So are signs for numbers that
    stand alone, such as fractions and circled digits, which are no letters.
    """
    if not text:
        return b""
    words = dict.fromkeys(LETTERS.findall(text.lower()))
    return " ".join([w for w in words if w.isalpha() or any(map(str.isalpha, w))]).encode()


def train(docs: DataFrame) -> dict[str, bytes]:
    """A dictionary per language, from a bounded sample in hash order of the training rows."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                      & ~held_out(F.col("doc_id")))
    sample = rows.select(
        "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"),
        F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"))
    first = Window.partitionBy("lang").orderBy("h", "text")
    taken = (sample.withColumn("n", F.row_number().over(first))
             .where(F.col("n") <= SAMPLE_TEXTS).select("lang", "n", "text").collect())
    found: dict[str, bytes] = {}
    for row in sorted(taken):
        found[row.lang] = found.get(row.lang, b"") + plain(row.text) + b" "
    return {lang: data[:DICTIONARY_BYTES] for lang, data in sorted(found.items()) if data.strip()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.languages = sorted(dictionaries)
        self.compressors = []
        # short matches count: languages differ in their endings and small words
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_BTLAZY2, min_match=3, search_log=4, hash_log=14,
            chain_log=15, window_log=17, target_length=16,
            write_content_size=False, write_checksum=False, write_dict_id=False)
        for lang in self.languages:
            data = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=settings)
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=data, compression_params=settings))

    def predict(self, text: str | None) -> tuple[str, float]:
        data = plain(text)
        if not data or not self.languages:
            return UNKNOWN, 0.0
        blocks = [data[at:at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum([len(c.compress(block)) for block in blocks]) for c in self.compressors]
        ranked = sorted(zip(sizes, self.languages))
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        margin = (ranked[1][0] - ranked[0][0]) / ranked[1][0]
        return ranked[0][1], margin / (margin + HALF_MARGIN)


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per row of ``docs``.

    Null texts, texts without letters and texts when nothing was learned get ``und`` and score 0.
    Ties go to the first language by name, with score 0. Repeated rows give repeated rows; extra
    columns are ignored; an empty table gives an empty table.
    """
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)
    rows = docs.select(F.col("doc_id").cast("long"),
                       held_out(F.col("doc_id")).alias("held_out"), "text")

    def make():
        classify = Classifier(model.value).predict

        def step(columns):
            ids, held, texts = columns
            found = [classify(text) for text in texts]
            return [ids, held, [lang for lang, _ in found], [score for _, score in found],
                    [lang == UNKNOWN or score < MIN_SCORE for lang, score in found]]

        return step

    return arrow_pass(rows, FOUND, make)


def accepted(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs`` whose language is told clearly; columns stay as they are."""
    model = docs.sparkSession.sparkContext.broadcast(dictionaries)
    columns = docs.columns
    text_at = columns.index("text")

    def make():
        classify = Classifier(model.value).predict

        def step(values):
            found = [classify(text) for text in values[text_at]]
            keep = [lang != UNKNOWN and score >= MIN_SCORE for lang, score in found]
            return [[v for v, k in zip(column, keep) if k] for column in values]

        return step

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return arrow_pass(docs, schema, make)


def fold_of(doc_id: int | None) -> int:
    """The training fold in plain Python, for tests."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS
