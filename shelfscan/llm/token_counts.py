"""Token counts per document from the piece counts of distinct pre-tokens.

Each task joins the frequencies of a document's pre-tokens with the piece counts of distinct
pre-tokens in memory, batch by batch: no ids are kept and nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

from shelfscan.llm.common import arrow_pass
from shelfscan.llm.tokens import count_memo, encoded_whole, tokenizer

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_texts(path: str, texts: list[str | None]) -> list[int]:
    """Tokens of whole texts, for tokenizers that drop white space.

    A pre-token is a run without white space. Normalizing, splitting further and merging are
    the library's and do not reach across white space. Texts that hold special strings are
    counted whole, by the library's default.
    """
    direct = {i for i, text in enumerate(texts) if text and encoded_whole(path, text)}
    frequencies = [Counter() if text is None or i in direct else Counter(text.split())
                   for i, text in enumerate(texts)]
    pieces = count_memo(path).trim()
    counts = [sum([n * pieces[unit] for unit, n in frequency.items()])
              for frequency in frequencies]
    for i in direct:
        counts[i] = len(tokenizer(path).encode(texts[i], add_special_tokens=False))
    return counts


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``.

    Null text counts as empty; a null ``doc_id`` stays null; repeated rows give repeated rows;
    other columns are ignored; an empty table gives an empty table.
    """

    def make():
        def step(columns):
            ids, texts = columns
            counts = count_texts(path, texts)
            sizes = [len(text.encode()) if text else 0 for text in texts]
            return [ids, sizes, counts, [n > limit for n in counts]]

        return step

    return arrow_pass(docs.select("doc_id", "text"), COUNTS, make)
