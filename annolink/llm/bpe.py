"""BPE encoding by longest matches and backtracking, and decoding by an offset table.

Encoding of a pre-token, in time linear in its length:

1. An Aho-Corasick automaton over the reversed tokens runs over the reversed pre-token and
   tells, for every place, the longest token that begins there.
2. The tokens are laid down from the left, the longest first. A token may follow another only
   if the merges, run over both texts together, give just these two: the table of compatible
   pairs is filled as pairs occur, by taking both tokens apart along their border in the
   order of the merges. Where no token fits, the last one is taken back for a shorter one,
   and the place is marked, so that it is never tried again.

The one sequence of tokens whose neighbours are all compatible is what the merges give.
Tokens that the merges never reach from their own text are found once and left out.

Ids are held as little-endian unsigned 32-bit integers in one binary value per document.
Decoding lays the texts of all tokens, each with the blank that follows it, end to end; an id
finds its piece by the offsets, for all ids of a batch at once.

The vocabulary file (up to a few MB) is read by the driver and broadcast. Supported are files
with word ends as suffixes, NFC and lower case, one split rule and byte-level characters; others raise
an error. Special strings inside a text are one token each, as the library has it by default.

Cases: a null text is an empty one, with no ids, and null ids decode to an empty text. A long
word without a split costs time in proportion to its length; long texts are taken whole, in
batches bounded by bytes. Bytes that are not UTF-8 count as replacement characters. Repeated
rows and rows without an id are encoded each. An empty table gives an empty result. Further
columns do not matter. An id that the vocabulary lacks has no piece, as in the library.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import shared, texts

# Words whose ids a task remembers, the length up to which it does, and pairs.
WORDS, WORD_LENGTH, PAIRS = 250_000, 64, 300_000
# Bytes of text that are handed on together, and ids decoded at once.
BATCH_BYTES, BATCH_IDS = 4_000_000, 200_000
# The last character of a word is another symbol than the same character inside it.
FINAL = 0x1000


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in plain)}
    return [chr(others.get(b, b)) for b in range(256)]


class Characters(set):
    """Characters met so far that this Python knows; those it does not know, the library may know."""

    _unknown = regex.compile(r"\p{Cn}").match

    def cover(self, text: str) -> bool:
        if not self.issuperset(text):
            self.update(c for c in set(text) - self if unicodedata.category(c) != "Cn" and not self._unknown(c))
        return self.issuperset(text)


@dataclass
class Vocabulary:
    """What a vocabulary file holds. Symbols count from 0: first those no merge makes, then merges."""

    file: str
    rule: str
    special: dict[str, int]
    pieces: dict[int, str]
    symbols: list[str]
    ids: list[int]
    parts: list[tuple[int, int]]
    unreached: set[int]


def _symbol_text(token: str, suffix: str) -> str:
    if token.endswith(suffix) and len(token) > len(suffix):
        return token[: -len(suffix) - 1] + chr(ord(token[-len(suffix) - 1]) + FINAL)
    return token


def _merged(symbols: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """Run the merges as they stand: the earliest first, the leftmost of equal ones first."""
    symbols = list(symbols)
    while len(symbols) > 1:
        made = [pairs.get(p, 1 << 60) for p in zip(symbols, symbols[1:], strict=False)]
        best = min(made)
        if best == 1 << 60:
            break
        at = made.index(best)
        symbols[at : at + 2] = [best]
    return symbols


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as source:
        file = source.read()
    held = json.loads(file)
    model, before = held["model"], held["pre_tokenizer"]
    normal = [n["type"] for n in (held["normalizer"] or {}).get("normalizers", [])]
    splits = [p for p in (before or {}).get("pretokenizers", []) if p["type"] == "Split"]
    suffix = model.get("end_of_word_suffix")
    if model["type"] != "BPE" or not suffix or normal != ["NFC", "Replace", "Lowercase"] or len(splits) != 1 or held["decoder"]:
        raise ValueError("a vocabulary of words with an end suffix, in lower case, is needed")
    names = {i: t for t, i in model["vocab"].items()}
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    made = [a + b for a, b in merges]
    merged = set(made)
    if len(merged) < len(made):
        raise ValueError("two merges make the same token")
    base = [t for t in model["vocab"] if t not in merged]
    number = {t: n for n, t in enumerate([*base, *made])}
    parts = [(n, n) for n in range(len(base))] + [(number[a], number[b]) for a, b in merges]
    pairs = {p: n for n, p in enumerate(parts) if n >= len(base)}
    symbols = [_symbol_text(t, suffix) for t in number]
    single = {s: n for n, s in enumerate(symbols) if len(s) == 1}
    unreached = {n for n, s in enumerate(symbols) if any(c not in single for c in s) or _merged([single[c] for c in s], pairs) != [n]}
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    names |= {i: t for t, i in special.items()}
    ids = [model["vocab"][t] for t in number]
    return Vocabulary(file, splits[0]["pattern"]["Regex"], special, names, symbols, ids, parts, unreached)


class Encoder:
    """The tables of a vocabulary, as a task uses them."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.parts, self.pairs = v.parts, {p: n for n, p in enumerate(v.parts) if p != (n, n)}
        self.length = [len(s) for s in v.symbols]
        self.whole = {s: n for n, s in enumerate(v.symbols) if n not in v.unreached}
        self.automaton = ahocorasick.Automaton()
        for text, n in self.whole.items():
            self.automaton.add_word(text[::-1], n)
        self.automaton.make_automaton()
        # For each token, the longest shorter token that begins it, or -1.
        self.shorter = [-1] * len(v.symbols)
        for text, n in self.whole.items():
            for end in range(len(text) - 1, 0, -1):
                if (head := self.whole.get(text[:end])) is not None:
                    self.shorter[n] = head
                    break
        self.together: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.characters = byte_characters()
        self.ids = [np.uint32(i).astype("<u4").tobytes() for i in v.ids]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges, run over the texts of both tokens, end with just these two."""
        key = left << 32 | right
        answer = self.together.get(key)
        if answer is None:
            if len(self.together) >= PAIRS:
                self.together.clear()
            answer = self.together[key] = self._border_holds(left, right)
        return answer

    def _border_holds(self, left: int, right: int) -> bool:
        # Undo the merges on both sides of the border from the last to the first. A merge over the
        # border that comes before the merge undone last would have been made instead of it; of
        # two equal merges the left one is made first.
        bound = 1 << 60
        while True:
            over = self.pairs.get((left, right))
            if over is not None and over < bound:
                return False
            if left > right:
                # Symbols that no merge makes stay as they are.
                left_done = self.parts[left] == (left, left)
                right_done = self.parts[right] == (right, right)
                if not left_done:
                    bound, left = left, self.parts[left][1]
                elif not right_done:
                    bound, right = right + 1, self.parts[right][0]
                else:
                    return True
            else:
                left_done = self.parts[left] == (left, left)
                right_done = self.parts[right] == (right, right)
                if not right_done:
                    bound, right = right + 1, self.parts[right][0]
                elif not left_done:
                    bound, left = left, self.parts[left][1]
                else:
                    return True

    def tokens(self, text: str) -> list[int]:
        """The tokens of one word, given as its symbols."""
        if (single := self.whole.get(text)) is not None:
            return [single]
        size = len(text)
        longest = [-1] * size
        for end, token in self.automaton.iter(text[::-1]):
            start = size - 1 - end
            if longest[start] < 0 or self.length[token] > self.length[longest[start]]:
                longest[start] = token
        usable = bytearray(b"\1") * (size + 1)
        out: list[int] = []
        place, token = 0, longest[0]
        while place < size:
            while token >= 0:
                end = place + self.length[token]
                if usable[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                place = end
                token = longest[place] if place < size else -1
            else:
                usable[place] = 0
                if not out:
                    raise ValueError("a character that the vocabulary lacks")
                token = out.pop()
                place -= self.length[token]
        return out

    def word(self, word: str) -> bytes:
        """The ids of one pre-token."""
        ids = self.known.get(word)
        if ids is None:
            symbols = "".join(map(self.characters.__getitem__, word.encode()))
            symbols = symbols[:-1] + chr(ord(symbols[-1]) + FINAL)
            ids = b"".join([self.ids[t] for t in self.tokens(symbols)])
            if len(word) <= WORD_LENGTH:
                if len(self.known) >= WORDS:
                    self.known.clear()
                self.known[word] = ids
        return ids

    def splitter(self) -> Callable[[str], list[str]]:
        """text without special strings -> normalised pre-tokens."""
        # The library's white space is the Unicode property, which has no separators of ASCII control.
        found = regex.compile(self.vocabulary.rule.replace(r"\s", r"\p{White_Space}")).findall
        characters, library = Characters(), None

        def split(text: str) -> list[str]:
            nonlocal library
            if text.isascii():
                return found(text.lower())
            if characters.cover(text):
                # One character at a time, as the library does: a last sigma is no other sigma.
                return found(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
            if library is None:
                from tokenizers import Regex, Tokenizer, pre_tokenizers

                whole = Tokenizer.from_str(self.vocabulary.file)
                library = whole.normalizer, pre_tokenizers.Split(Regex(self.vocabulary.rule), "removed", invert=True)
            return [word for word, _ in library[1].pre_tokenize_str(library[0].normalize_str(text))]

        return split


def _slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a binary column holds about ``limit`` bytes; a row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(column)], np.int64)
        block = np.cumsum(lengths) // limit
        starts = np.flatnonzero(np.diff(block, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, 4 bytes each) per row; ``tokenizer`` is the path of its file on the driver."""
    vocabulary = shared(docs.sparkSession, read_vocabulary(tokenizer))
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))

    def task(batches):
        encoder = Encoder(vocabulary())
        split, word = encoder.splitter(), encoder.word
        special = {s: np.uint32(i).astype("<u4").tobytes() for s, i in encoder.vocabulary.special.items()}
        cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None

        def ids_of(text: str) -> bytes:
            if cut is None or not any(s in text for s in special):
                return b"".join(map(word, split(text)))
            return b"".join(special[part] if i % 2 else b"".join(map(word, split(part))) for i, part in enumerate(cut(text)))

        for batch in _slices(batches, 1, BATCH_BYTES):
            ids = [ids_of(value.as_py().decode("utf-8", "replace")) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows.mapInArrow(task, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


class Decoder:
    """The texts of all tokens, each followed by a blank, end to end, and where each begins."""

    def __init__(self, vocabulary: Vocabulary):
        size = max(vocabulary.pieces, default=-1) + 1
        pieces = [f"{vocabulary.pieces[i]} ".encode() if i in vocabulary.pieces else b"" for i in range(size)]
        self.text = np.frombuffer(b"".join(pieces), np.uint8)
        # Ids beyond the last have an empty piece at the end.
        self.offsets = np.zeros(size + 2, np.int64)
        self.offsets[1 : size + 1] = np.cumsum([len(p) for p in pieces])
        self.offsets[size + 1] = self.offsets[size]

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        """Texts of documents, whose ids lie end to end up to ``ends``; blanks only between pieces."""
        places = np.minimum(ids.astype(np.int64), len(self.offsets) - 2)
        starts = self.offsets[places]
        until = np.cumsum(self.offsets[places + 1] - starts)
        bytes_of = []
        for first in range(0, len(ids), BATCH_IDS):
            part = slice(first, first + BATCH_IDS)
            before = until[first - 1] if first else 0
            lengths = np.diff(until[part], prepend=before)
            shift = starts[part] - (until[part] - lengths - before)
            bytes_of.append(self.text[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes())
        joined, start = b"".join(bytes_of), 0
        for end in ends:
            stop = int(until[end - 1]) if end else 0
            yield joined[start : max(start, stop - 1)]
            start = max(start, stop)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """All columns, and ``decoded``: the pieces of the ids joined by one blank, special ones too."""
    vocabulary = shared(encoded.sparkSession, read_vocabulary(tokenizer))
    held = encoded.select(F.struct(*encoded.columns).alias("_row"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("_ids"))

    def task(batches):
        decoder = Decoder(vocabulary())
        for batch in _slices(batches, 1, BATCH_BYTES):
            values = [v.as_py() for v in batch.column(1)]
            ends = np.cumsum([len(v) // 4 for v in values])
            decoded = list(decoder.texts(np.frombuffer(b"".join(values), "<u4"), ends))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["_row", "decoded"])

    row = held.schema["_row"].dataType.simpleString()
    out = held.mapInArrow(task, f"_row {row}, decoded binary")
    return out.select("_row.*", F.col("decoded").cast("string").alias("decoded"))
