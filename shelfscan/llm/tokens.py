"""Tokenizing by the tokenizers library, with a bounded memo of pre-token pieces."""

from __future__ import annotations

from array import array
from functools import cache
from itertools import chain
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pre-tokens in one generation of a memo; two generations are kept.
MEMO_SIZE = 900_000
#: The same for ids, which take more memory than counts.
ID_MEMO_SIZE = 500_000
#: Pre-tokens longer than this are encoded each time.
MEMO_CHARS = 64
#: Unknown pre-tokens that are given to the library at once.
LEARN_UNITS = 5_000

#: A byte-level pre-token never spans two of these units: a word with the blank before it, or
#: white space. Splitting a unit is left to the library.
BYTE_LEVEL_UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Characters that Python takes for white space and the library does not.
DISPUTED_SPACE = "\x1c\x1d\x1e\x1f"
#: Marks the ends of units. Texts that have it are encoded whole.
CUT = "\x1f"
#: White space other than single blanks and one or two line ends between words.
ODD_SPACE = ("[\\t\\x0b\\x0c\\r\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}"
             "\\x{205f}\\x{3000}]|  | \n|\n |\n\n\n|\n\n\\z")
#: A byte-level pre-token of letters, and a unit of one and the signs behind it.
WORD = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
WORD_AND_SIGNS = r"^( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]+)$"


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_padding()
    loaded.no_truncation()
    return loaded


@cache
def special_strings(path: str) -> tuple[str, ...]:
    """Texts with one of these strings are encoded whole: the added tokens, which the library
    looks for in the text as it is, and the disputed white space."""
    added = tokenizer(path).get_added_tokens_decoder().values()
    return tuple(sorted({token.content for token in added} | set(DISPUTED_SPACE)))


def encoded_whole(path: str, text: str) -> bool:
    return any([string in text for string in special_strings(path)])


class Memo(dict):
    """Value of each pre-token, worked out once. Two generations bound the memory: what the
    younger one has not seen when it is full is forgotten later."""

    def __init__(self, work, size: int | None = None):
        super().__init__()
        self.work, self.size = work, size
        self.old: dict = {}

    def __missing__(self, unit: str):
        value = self.old.get(unit)
        if value is None:
            value = self.work(unit)
        if len(unit) <= MEMO_CHARS:
            self[unit] = value
        return value

    def trim(self) -> Memo:
        """Begin a new generation when this one is full."""
        if len(self) > (self.size or MEMO_SIZE):
            self.old = dict(self)
            self.clear()
        return self


@cache
def id_memo(path: str) -> Memo:
    """Lives as long as the Python worker."""
    encode = tokenizer(path).encode
    return Memo(lambda unit: array("I", encode(unit, add_special_tokens=False).ids).tobytes(),
                ID_MEMO_SIZE)


@cache
def token_bytes(path: str) -> np.ndarray:
    """Bytes of text that each id of a byte-level vocabulary stands for."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=False)
    found = np.zeros(max(vocabulary.values()) + 1, np.int64)
    for token, number in vocabulary.items():
        found[number] = len(token)
    return found


@cache
def byte_characters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary; a blank for a line end."""
    shown = np.array([33 <= n < 127 or 161 <= n < 173 or 174 <= n for n in range(256)])
    found = np.where(shown, np.arange(256), 255 + np.cumsum(~shown))
    found[ord("\n")] = ord(" ")
    return found.astype("<u4")


@cache
def word_tokenizer(path: str):
    """The same vocabulary and merges, for pre-tokens that are written in ``byte_characters`` and
    parted by blanks."""
    from tokenizers import Tokenizer

    parts = json.loads(tokenizer(path).to_str())
    parts.update(pre_tokenizer={"type": "WhitespaceSplit"}, post_processor=None, added_tokens=[])
    return Tokenizer.from_str(json.dumps(parts))


def learn(path: str, memo: Memo, units: list[str]) -> None:
    """Put units into the memo, many in one call of the library."""
    units = [unit for unit in units if unit not in memo.old and len(unit) <= MEMO_CHARS]
    words = list(filter(WORD.fullmatch, units))
    learn_words(path, memo, words)
    known = set(words)
    learn_units(path, memo, [unit for unit in units if unit not in known and unit[:1] == " "
                             and len(unit) > 1 and not unit.isspace()])


def learn_words(path: str, memo: Memo, words: list[str]) -> None:
    """Put words, each a pre-token, into the memo."""
    for at in range(0, len(words), LEARN_UNITS):
        part = words[at:at + LEARN_UNITS]
        data = np.frombuffer("\n".join([*part, ""]).encode(), np.uint8)
        written = byte_characters()[data].tobytes().decode("utf-32-le")
        ids = word_tokenizer(path).encode_batch_fast([written], add_special_tokens=False)[0].ids
        _remember(path, memo, part, ids, np.flatnonzero(data == ord("\n")) - np.arange(len(part)))


def learn_units(path: str, memo: Memo, units: list[str]) -> None:
    """Put units that begin with a blank into the memo. Side by side they are pre-tokenized as they
    are alone."""
    for at in range(0, len(units), LEARN_UNITS):
        part = units[at:at + LEARN_UNITS]
        ids = tokenizer(path).encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids
        _remember(path, memo, part, ids, np.cumsum([len(unit.encode()) for unit in part]))


def _remember(path: str, memo: Memo, units: list[str], ids: list[int], ends: np.ndarray) -> None:
    """Cut ids by the bytes that they stand for. If a unit ended inside an id, all would be left to
    the memo to encode by themselves."""
    ids = np.array(ids, np.uint32)
    upto = np.cumsum(token_bytes(path)[ids])
    cuts = np.searchsorted(upto, ends)
    if len(ids) and cuts[-1] < len(upto) and (upto[cuts] == ends).all():
        data, cuts = ids.astype("<u4").tobytes(), ((cuts + 1) * 4).tolist()
        memo.update(zip(units, (data[a:b] for a, b in zip([0, *cuts], cuts))))


def ids_of_units(path: str, units: list[str]) -> list[bytes]:
    memo = id_memo(path)
    found = list(map(memo.get, units))
    fresh = [unit for unit, ids in zip(units, found) if ids is None]
    if fresh:
        learn(path, memo, fresh)
        found = [memo[unit] if ids is None else ids for unit, ids in zip(units, found)]
    return found


@cache
def count_memo(path: str) -> Memo:
    encode = tokenizer(path).encode
    return Memo(lambda unit: len(encode(unit, add_special_tokens=False)))


def encode_ids(path: str, texts: list[str | None]) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit numbers; null gives none.

    For byte-level tokenizers without a normalizer. Equal to encoding each text by the library:
    its pre-tokens lie inside the units, and texts with special strings are encoded whole.
    """
    id_memo(path).trim()
    found = [b""] * len(texts)
    known = [at for at, text in enumerate(texts) if text]
    whole = {at for at in known if encoded_whole(path, texts[at])}
    for at in whole:
        ids = tokenizer(path).encode(texts[at], add_special_tokens=False).ids
        found[at] = array("I", ids).tobytes()
    known = [at for at in known if at not in whole]
    column = pa.array([texts[at] for at in known], pa.large_string())
    odd = pc.match_substring_regex(column, ODD_SPACE)
    for at, ids in zip(np.array(known, np.int64)[_flags(odd)].tolist(),
                       encode_odd(path, column.filter(odd).to_pylist())):
        found[at] = ids
    for at, ids in zip(np.array(known, np.int64)[~_flags(odd)].tolist(),
                       encode_even(path, column.filter(pc.invert(odd)))):
        found[at] = ids
    return found


def _flags(column: pa.BooleanArray) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def encode_odd(path: str, texts: list[str]) -> list[bytes]:
    units = [BYTE_LEVEL_UNIT.findall(text) for text in texts]
    distinct = list(dict.fromkeys(chain.from_iterable(units)))
    ids = dict(zip(distinct, ids_of_units(path, distinct)))
    return [b"".join(map(ids.__getitem__, parts)) for parts in units]


def encode_even(path: str, texts: pa.LargeStringArray) -> list[bytes]:
    """Texts without ``ODD_SPACE``: a unit ends before each blank and on both sides of a line end.

    Different units are parted into words and signs, and what is different among these is looked up
    once for all texts.
    """
    if not len(texts):
        return []
    marked = pc.replace_substring(texts, " ", CUT + " ")
    units = pc.split_pattern(pc.replace_substring(marked, "\n", CUT + "\n" + CUT), CUT)
    coded = units.values.dictionary_encode()
    parts = pc.split_pattern(pc.replace_substring_regex(
        coded.dictionary, WORD_AND_SIGNS, rf"\1{CUT}\2"), CUT)
    known = parts.values.dictionary_encode()
    ids = pa.array(ids_of_units(path, known.dictionary.to_numpy(zero_copy_only=False).tolist()),
                   pa.large_binary())
    of_units = _joined(ids.take(known.indices), parts.offsets)
    return _joined(of_units.take(coded.indices), units.offsets).to_pylist()


def _joined(values: pa.LargeBinaryArray, offsets: pa.Array) -> pa.LargeBinaryArray:
    """Neighbouring values joined, from each offset to the next."""
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64)[offsets.to_numpy()]
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends), data])
