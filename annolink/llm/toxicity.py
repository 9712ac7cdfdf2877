"""Toxicity of texts that may be disguised: noisy-channel decoding, then scoring of what was meant.

1. A character language model (trigrams over the letters a to z, one class each for other
   letters, for blanks and for all else) is counted over all documents.
2. Words with look-alike characters, characters inside that are no letters, or letters
   repeated are decoded: each run of a character is an arc set of a lattice (as it is, a letter
   it looks like, left out, one or two of a repeated letter), each arc with the cost of the
   channel, and the Viterbi path under the language model is the word that was meant. Words are
   decoded whole; the cost grows with their runs. A word of letters only with a doubled one may
   also be what it seems, so both readings count. Short tokens that follow each other, whatever
   blanks are between them (a character, also repeated, or two with one that is no letter;
   three characters in all), are decoded together: with the blanks as arcs that may be left
   out, and joined, from each character on, as many runs as the longest beginning takes. Pairs
   of letters set apart ("id io t") are words of their own. Signs among short tokens that look
   like no letter set them apart as blanks do. Other words are what they seem;
   runs of three and more signs at either end of a word are ornament.
3. Beginnings of restored words, of 3 to 8 letters, and whole words are weighed by how often
   documents that have them are labelled, shrunk to the share of all documents. The
   ``MAX_FEATURES`` greatest weights are kept: the size of the model.
4. A document's figures are its greatest word weight, and the number of its distinct words
   above ``STRONG``. A logistic model of both, fitted on labelled rows that were not used for
   the weights, gives the score.

Labels come from rows outside the held-out fold only, from at most ``labelled_rows`` of them
by order of a hash of the id. Scores use the text alone.

The time grows in proportion to the text, whatever it holds: a piece of spaced letters ends after 96
letters and look-alikes (of which a word of 8 letters would have to lose 88).

Cases: very long texts and words are taken whole. Further columns do not matter. A null or empty text has no words and the score of such a text. Labels that are null
are left out; of contradicting ones the larger counts. Without labels of both kinds all
scores are 0. Rows are scored each, also without or with one id. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.llm.common import remainder, shared, texts
from annolink.staging import stage

LABELLED_ROWS = 60_000
MAX_FEATURES = 100_000
STRONG = 2.0
PRIOR_DOCUMENTS = 10
SHORTEST, LONGEST = 3, 8
# Words that a task remembers by their weight, and by their features; readings of spaced letters.
WORDS, REMEMBERED = 300_000, 100_000

# Look-alike characters and the letters they may stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
# Leaving out a separator is cheap; leaving out a look-alike loses a letter.
COST_LOOK, COST_OMIT, COST_LOSE, COST_KEEP, COST_COLLAPSE, COST_DOUBLE = 1.0, 1.0, 12.0, 4.0, 0.5, 1.5
BLANK, HIGH, OTHER = 0, 27, 28
CLASSES = 29
_CLASS_OF_BYTE = np.full(256, OTHER, np.int64)
_CLASS_OF_BYTE[97:123] = np.arange(1, 27)
_CLASS_OF_BYTE[65:91] = np.arange(1, 27)
_CLASS_OF_BYTE[128:] = HIGH
_CLASS_OF_BYTE[[9, 10, 11, 12, 13, 32]] = BLANK

# Quotes, brackets and stops around words.
_OPENING, _CLOSING = "\"'([{", ".,;:!?\"')]}"
_ORNAMENT = re.compile(r"^([^\w\s])\1{2,}|([^\w\s])\2{2,}$|^[\"'(\[{]+|[.,;:!?\"')\]}]+$")
_PLAIN = re.compile(r"^[^\W\d_]*$")
_DOUBLED = re.compile(r"(.)\1(\1?)")
# One character, also repeated, or two of which one is no letter; quotes and stops around it.
_SHORT = re.compile(r"[\"'(\[{]*((\S)\2*|[^\W\d_][\W\d_]|[\W\d_]\S)[.,;:!?\"')\]}]*")
_RUN = re.compile(r"(.)\1*", re.DOTALL)
# Runs of letters and look-alikes that a piece of spaced letters begins with, and ends with at the latest.
PIECE, LAST_PIECE = 24, 96
# Whole words above this length are told by a hash.
SPELLED = 64


def class_of(character: str) -> int:
    code = ord(character)
    if character == " ":
        return BLANK
    return code - 96 if 97 <= code <= 122 else HIGH if character.isalpha() else OTHER


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """CLASSES ** 3 counts of character trigrams over all texts."""

    def task(batches):
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                codes = np.r_[BLANK, BLANK, _CLASS_OF_BYTE[data], BLANK]
                total += np.bincount(codes[:-2] * CLASSES**2 + codes[1:-1] * CLASSES + codes[2:], minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    counts = np.zeros(CLASSES**3)
    rows = docs.select(F.col("text").cast("binary")).where(F.octet_length("text") > 0).mapInArrow(task, "gram long, n long")
    for gram, n in rows.groupBy("gram").agg(F.sum("n")).collect():  # at most CLASSES ** 3 rows
        counts[gram] = n
    return counts


def _letters(tail: tuple | None) -> list[str]:
    found = []
    while tail is not None:
        tail, letters = tail
        found.append(letters)
    return found[::-1]


class Decoder:
    """The most likely word behind a disguised one."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(CLASSES, CLASSES, CLASSES)
        pairs = cube.sum(axis=0)
        single = pairs.sum(axis=0) + 1.0
        single /= single.sum()
        second = (pairs + 5 * single) / (pairs.sum(axis=1, keepdims=True) + 5)
        third = (cube + 5 * second[None]) / (cube.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(third).tolist()
        self.known: dict[tuple, list] = {}
        self.read: dict[str, list[str]] = {}

    @staticmethod
    def arcs(character: str, length: int) -> list[tuple[str, float]]:
        if character.isalpha():
            if length == 1:
                return [(character, 0.0)]
            if length == 2:
                return [(character * 2, 0.0), (character, COST_DOUBLE)]
            return [(character, COST_COLLAPSE), (character * 2, COST_COLLAPSE)]
        if character == " ":
            return [("", COST_OMIT), (" ", 0.0)]
        ways = [("", COST_LOSE if character in LOOKS else COST_OMIT)]
        if character not in LOOKS or character.isdigit():
            ways.append((character * length, COST_KEEP))
        for letter in LOOKS.get(character, ""):
            ways.append((letter, COST_LOOK if length == 1 else COST_LOOK + COST_COLLAPSE))
            if length == 2:
                ways.append((letter * 2, 2 * COST_LOOK))
        return ways

    def ways(self, character: str, length: int) -> list[tuple[str, list[int], float]]:
        """The arcs of a run, with the classes of their letters."""
        known = self.known.get((character, length))
        if known is None:
            known = [(letters, [class_of(c) for c in letters], cost) for letters, cost in self.arcs(character, length)]
            if length <= 3 and len(self.known) < REMEMBERED:
                self.known[character, length] = known
        return known

    def decode(self, word: str) -> str:
        log, said = self.log, []
        # State: score, and the letters since all paths were last the same one, as (all before, last).
        paths: dict[tuple, tuple] = {(BLANK, BLANK): (0.0, None)}
        for run in _RUN.finditer(word):
            ways = self.ways(run[1], run.end() - run.start())
            if len(paths) == len(ways) == 1:
                ((p, q),), ((letters, codes, _),) = paths, ways
                for r in codes:
                    p, q = q, r
                said.append(letters)
                paths = {(p, q): (0.0, None)}
                continue
            following: dict[tuple, tuple] = {}
            for (a, b), (score, tail) in paths.items():
                for letters, codes, cost in ways:
                    p, q, value = a, b, score - cost
                    for r in codes:
                        value += log[p][q][r]
                        p, q = q, r
                    if (p, q) not in following or following[p, q][0] < value:
                        following[p, q] = (value, (tail, letters))
            paths = following
            if len(paths) == 1:
                ((state, (_, tail)),) = paths.items()
                said += _letters(tail)
                paths = {state: (0.0, None)}
        tail = max(((score + log[a][b][BLANK], tail) for (a, b), (score, tail) in paths.items()), key=lambda path: path[0])[1]
        return "".join(said + _letters(tail))

    def restore(self, word: str) -> str:
        """The word that was meant, in lower case, without ornament."""
        return self.readings(word)[-1]

    def readings(self, word: str) -> list[str]:
        """What a word may mean. One with doubled letters may be what it seems, too."""
        bare = word if word.isalpha() else word.lstrip(_OPENING).rstrip(_CLOSING)
        if not bare.isalpha():
            bare = word
            while not bare.isalpha() and bare and (cut := _ORNAMENT.sub("", bare)) != bare:
                bare = cut
            if not _PLAIN.match(bare):
                return [self.decode(bare)]
        doubled = list(_DOUBLED.finditer(bare))
        if any(d[2] for d in doubled):
            return [self.decode(bare)]
        once = [at for d in doubled if self.is_one(bare, at := d.start())]
        if not once:
            return [bare]
        return [bare, "".join(bare[a:b] for a, b in zip([0, *(at + 1 for at in once)], [*once, len(bare)], strict=True))]

    def is_one(self, word: str, at: int) -> bool:
        """Whether the doubled letter at this place is more likely one letter.

        Both paths meet at the next letter, so one doubled letter decides nothing about another: this
        is the Viterbi path of a word of letters without longer runs.
        """
        before = class_of(word[at - 1]) if at else BLANK
        letter = class_of(word[at])
        after = class_of(word[at + 2]) if at + 2 < len(word) else BLANK
        log = self.log
        return log[before][letter][after] - COST_DOUBLE > log[before][letter][letter] + log[letter][letter][after]

    def pieces(self, letters: str) -> list[list[str]]:
        """Readings of joined letters: a disguised word may start at any of them.

        Signs that look like no letter are left out, so a start at one is the next start. Each
        piece has as many runs as it takes for the longest beginning, and ``LAST_PIECE`` at most,
        so the time grows with the number of letters.
        """
        letters = "".join(filter(_tells, letters))
        found, starts = [], [run.start() for run in _RUN.finditer(letters)] + [len(letters)]
        for at, end in enumerate(starts[1:]):
            # A run of three letters and more means the same at any length.
            for start in {starts[at], max(end - 2, starts[at]), end - 1}:
                if len(letters) - start < SHORTEST:
                    continue
                runs = PIECE
                while True:
                    upto = starts[min(at + runs, len(starts) - 1)]
                    readings = self.piece(letters[start:upto])
                    if min(map(len, readings)) > LONGEST or upto == len(letters) or runs >= LAST_PIECE:
                        break
                    runs *= 2
                found.append(readings)
        return found

    def piece(self, letters: str) -> list[str]:
        """Readings of a piece, remembered."""
        readings = self.read.get(letters)
        if readings is None:
            if len(self.read) >= REMEMBERED:
                self.read.clear()
            readings = self.readings(letters)
            if len(letters) <= 2 * LAST_PIECE:
                self.read[letters] = readings
        return readings

    def spaced(self, tokens: list[str]) -> list[list[str]]:
        """Readings of letters set apart: each start, and the words with blanks as they are likely."""
        return self.pieces("".join(tokens)) + [[word] for word in self.decode(" ".join(tokens)).split()]


def _tells(character: str) -> bool:
    """Whether a character may stand for a letter."""
    return character.isalnum() or character in LOOKS


def features(word: str) -> list[str]:
    """Beginnings of a word, and the whole word marked as such."""
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [whole(word)]


def whole(word: str) -> str:
    """The feature of a whole word; a long one is told by its hash, so that all features are short."""
    return "=" + (word if len(word) <= SPELLED else hashlib.md5(word.encode()).hexdigest())


class Weights:
    """The greatest weight of a word's features. Most words begin like no feature: one look tells."""

    def __init__(self, weights: dict[str, float]):
        self.weights, self.starts = weights, {f[:SHORTEST] for f in weights if not f.startswith("=")}

    def of(self, readings: list[str]) -> float:
        most = 0.0
        for word in readings:
            if word[:SHORTEST] in self.starts:
                most = max(most, *(self.weights.get(f, 0.0) for f in features(word)))
            else:
                most = max(most, self.weights.get(whole(word), 0.0))
        return most


def as_short(token: str) -> str:
    """What a token is as a short one, "" if it is none."""
    if len(token) > 2 and token.isalpha() and token.count(token[0]) < len(token):
        return ""
    match = _SHORT.fullmatch(token)
    return match[1] if match else ""


def spaced_runs(tokens: list[str], short: dict[str, str]) -> list[list[str]]:
    """Runs of short tokens, as what ``short`` gives for them."""
    found, run, last = [], [], -1
    # Tokens without a letter or look-alike set others apart, as blanks do.
    telling = {token: part for token, part in short.items() if any(map(_tells, part))}
    for at in [*(i for i, token in enumerate(tokens) if token in short), len(tokens) + 1]:
        if at > last + 1:
            if len(run) > 1 and sum(map(len, run)) >= SHORTEST:
                found.append(run)
            run = []
        if at < len(tokens) and (part := telling.get(tokens[at])) is not None:
            run.append(part)
        last = at
    return found


_USUAL = (0.0, "")


class _Words:
    """Distinct words of a text by their readings, with what is known of a word remembered."""

    def __init__(self, decoder: Decoder, of_word, words: int = REMEMBERED):
        self.decoder, self.of_word, self.words = decoder, of_word, words
        # What was used since the last change, and before it.
        self.known, self.before, self.joined, self.size = {}, {}, {}, 0

    def of(self, data: bytes) -> list:
        text = data.decode("utf-8", "replace").lower()
        if len(self.known) > self.words // 2:
            self.known, self.before = {}, self.known
        if self.size > REMEMBERED:
            self.joined, self.size = {}, 0
        short, known = {}, self.known
        tokens = text.split()
        distinct = set(tokens)
        for word in distinct.difference(known):
            held = self.before.get(word)
            if held is None:
                held = self.of_word(self.decoder.readings(word)), as_short(word)
                # Most words are like this one.
                held = _USUAL if held == _USUAL else held
            known[word] = held
        found = []
        for word in distinct:
            value, part = known[word]
            found.append(value)
            if part:
                short[word] = part
        for run in spaced_runs(tokens, short) if short else ():
            at = " ".join(run)
            values = self.joined.get(at)
            if values is None:
                values = self.joined[at] = [self.of_word(readings) for readings in self.decoder.spaced(run)]
                self.size += len(values)
            found += values
        return found


def _figures(rows: DataFrame, counts, weights: dict[str, float], extra: str, extra_names: list[str]) -> DataFrame:
    """``extra`` columns of the rows (text, ...), greatest weight and number of strong words."""
    held = shared(rows.sparkSession, (counts, weights))

    def task(batches):
        counts, weights = held()
        words = _Words(Decoder(counts), Weights(weights).of, WORDS)
        for batch in batches:
            most, strong = [], []
            for text in batch.column(0):
                values = words.of(text.as_py())
                most.append(max(values, default=0.0))
                strong.append(sum(v > STRONG for v in values))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(most, pa.float64()), pa.array(strong, pa.int64())], [*extra_names, "most", "strong"]
            )

    return rows.mapInArrow(task, f"{extra}, most double, strong long")


def _weights(rows: DataFrame, counts, share: float) -> dict[str, float]:
    """Weights of features of (text, label) rows; at most MAX_FEATURES, the greatest."""
    held = shared(rows.sparkSession, counts)

    def task(batches):
        words, sums = _Words(Decoder(held()), lambda readings: [f for word in readings for f in features(word)]), (Counter(), Counter())

        def out():
            names = list(set(sums[0]) | set(sums[1]))
            columns = [pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in sums)]
            for s in sums:
                s.clear()
            return pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                sums[label].update({f for fs in words.of(text.as_py()) for f in fs})
                if len(sums[0]) + len(sums[1]) > REMEMBERED:
                    yield out()
        yield out()

    found = rows.mapInArrow(task, "feature string, clean long, toxic long").groupBy("feature")
    sums = found.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 0")
    n = F.col("clean") + F.col("toxic")
    p = (F.col("toxic") + PRIOR_DOCUMENTS * share) / (n + PRIOR_DOCUMENTS)
    weight = F.log(p / (1 - p)) - math.log(share / (1 - share))
    top = sums.select("feature", weight.alias("weight")).where("weight > 0.5").orderBy(F.desc("weight"), "feature").limit(MAX_FEATURES)
    table = top.toArrow()
    return dict(zip(table["feature"].to_pylist(), table["weight"].to_pylist(), strict=True))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    design, coef = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    ridge = np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ coef, -30, 30)))
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + ridge
        coef -= np.linalg.solve(curve, design.T @ (p - y) + ridge @ coef)
    return coef


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3, labelled_rows: int = LABELLED_ROWS
) -> DataFrame:
    """doc_id, held_out, score, predicted per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).select(F.col("text").cast("binary"), "doc_id", remainder(F.col("doc_id"), folds).alias("fold"))
    counts = trigram_counts(rows)

    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), folds) != held_out))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("label"))
    # At most labelled_rows rows of two numbers.
    sample = stage(known.orderBy(F.xxhash64("_id"), "_id").limit(labelled_rows).coalesce(1))
    training = rows.join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    # Weights from three quarters, the logistic model from the rest.
    for_weights = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(4)) < 3
    # Of the sample, not of all documents.
    n, toxic = training.where(for_weights).agg(F.count("*"), F.sum("label")).first()
    model = None
    if toxic and toxic < n:
        weights = _weights(training.where(for_weights).select("text", "label"), counts, toxic / n)
        check = _figures(training.where(~for_weights).select("text", "label"), counts, weights, "label int", ["label"]).toArrow()
        most, strong, label = (check[c].to_numpy() for c in ("most", "strong", "label"))
        if 0 < label.sum() < len(label):
            model = _logistic(np.column_stack([most, np.log1p(strong)]), label)
    if model is None:
        weights, model = {}, np.array([0.0, 0.0, -math.inf])
    scored = _figures(rows, counts, weights, f"doc_id {kind}, fold long", ["doc_id", "fold"])
    logit = F.col("most") * F.lit(float(model[0])) + F.log1p("strong") * F.lit(float(model[1])) + F.lit(float(model[2]))
    score = 1 / (1 + F.exp(-logit))
    return scored.select(
        "doc_id",
        (F.col("fold") == held_out).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
