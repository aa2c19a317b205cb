"""SentencePiece encoding and decoding by one Viterbi pass over an Aho-Corasick automaton.

The automaton is built over the pieces of a vocabulary file. One pass over a text follows its
transitions; at each position the output links name every piece that ends there, longest first,
and each is tried as the last step of the best segmentation up to that position. What "best" means
depends on the file:

* ``scores`` (unigram files): the largest sum of scores; of ties, the longest last piece.
* ``merges`` (files trained by merges, such as the default): the segmentation that merging the best pair
  first would give. A sequence is that one if and only if each two neighbours on their own merge to
  themselves, so a step is taken if its piece may follow the last piece of the best segmentation of what
  lies before; exactly one piece per position may. Ids then equal those of the library.

A character that no piece covers is written as its UTF-8 bytes.

A text is first cut where no piece can cross: before a run of spaces that follows something else,
as no piece has a space after another character (checked when the vocabulary is read), and around
characters that are in no piece. Equal units are encoded once per worker, as far as its bounded
store goes.

A space becomes the mark U+2581, one is put in front of a text, and a U+2581 of the text itself is
written as bytes, so ``decode(encode(x)) == x`` for every text.

Defined cases: a null or empty text has no ids and decodes to the empty text; null ids and any other
null columns pass through; repeated rows are encoded alike; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.texts import as_bytes, slices

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Units kept with their ids per worker, and pairs with their verdicts; a full store starts anew.
#: Longer units are not kept.
CACHE_UNITS = 500_000
CACHE_PAIRS = 500_000
CACHE_LENGTH = 48

#: Added to the score of a character that is written as bytes, beside the least score of all.
BYTES_PENALTY = -10.0

_FREE, _UNSET = -1, -2


class Vocabulary(NamedTuple):
    """What a model file holds, as plain values; some megabytes at most, as vocabularies are.

    ``ranks`` (place in the order of merges) and ``splits`` (the two pieces last merged) are by id, for
    pieces that merging can produce.
    """

    name: str
    merges: bool
    pieces: list[tuple[str, int, float]]
    bytes_from: list[int]
    decoded: list[bytes]
    ranks: dict[int, int]
    splits: dict[int, tuple[int, int]]


def merged(text: str, found: dict[str, tuple[int, float]]) -> tuple[list[str], tuple[str, str] | None]:
    """The parts left when the adjacent pair of the best score, leftmost first, is merged until none
    can be, and the pair merged last."""
    parts, last = list(text), None
    while True:
        pairs = [
            (-found[x + y][1], k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in found
        ]
        if not pairs:
            return parts, last
        k = min(pairs)[1]
        last = (parts[k], parts[k + 1])
        parts[k : k + 2] = ["".join(last)]


@lru_cache(maxsize=4)
def vocabulary(model: str = DEFAULT_MODEL) -> Vocabulary:
    """Read a SentencePiece model file on the driver; tasks get its pieces as values.

    A file whose scores are all whole numbers was trained by merges.
    """
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, by_byte, decoded = [], {}, []
    for i in range(read.get_piece_size()):
        piece = read.id_to_piece(i)
        if read.is_byte(i):
            by_byte[int(piece[1:-1], 16)] = i
            decoded.append(bytes([int(piece[1:-1], 16)]))
        elif read.is_control(i) or read.is_unknown(i) or read.is_unused(i):
            decoded.append(b"")
        else:
            pieces.append((piece, i, read.get_score(i)))
            decoded.append(piece.replace(MARK, " ").encode())
    if len(by_byte) != 256:
        raise ValueError("the vocabulary has no pieces for single bytes")
    if any(MARK in piece.lstrip(MARK) or piece.startswith(MARK * 2) and piece.strip(MARK) for piece, _, _ in pieces):
        raise ValueError("a piece has a space after another character, or two in front of one")
    merges = all(score == int(score) for _, _, score in pieces)
    ranks, splits = {}, {}
    if merges:
        runs = [score for piece, _, score in pieces if not piece.strip(MARK)]
        others = [score for piece, _, score in pieces if piece.strip(MARK)]
        if len(set(others)) < len(others) or len(set(runs)) > 1 or max(runs) >= min(others):
            raise ValueError("runs of spaces must be merged last, and other pieces in one order")
        found = {piece: (i, score) for piece, i, score in pieces}
        for rank, (piece, i, _) in enumerate(sorted(pieces, key=lambda x: -x[2])):
            if len(piece) == 1:
                ranks[i] = -1
            elif piece.strip(MARK):
                parts, last = merged(piece, found)
                if len(parts) == 1:
                    ranks[i], splits[i] = rank, (found[last[0]][0], found[last[1]][0])
    return Vocabulary(model, merges, pieces, [by_byte[b] for b in range(256)], decoded, ranks, splits)


class Encoder:
    """Encodes and decodes with one vocabulary; keeps the ids of frequent units."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.bytes_from = vocabulary.bytes_from
        self.decoded = vocabulary.decoded
        self.texts = {i: piece for piece, i, _ in vocabulary.pieces}
        self.found = {piece: i for piece, i, _ in vocabulary.pieces}
        self.automaton = ahocorasick.Automaton()
        least = 0.0
        for piece, i, score in vocabulary.pieces:
            if not vocabulary.merges or i in vocabulary.ranks:
                self.automaton.add_word(piece, (len(piece), i, score))
            least = min(least, score)
        self.automaton.make_automaton()
        self.unknown = least + BYTES_PENALTY
        covered = {c for piece, _, _ in vocabulary.pieces for c in piece}
        apart = re.escape("".join(c for c in map(chr, range(128)) if c not in covered and c != " ") + MARK)
        self.units = re.compile(f"[{apart}]| *[^ {apart}]+| +").findall
        self.cache: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def unit(self, text: str) -> tuple[int, ...]:
        """The ids of one unit. A mark of the text itself must match no piece; U+FFFF stands in for it."""
        if not self.vocabulary.merges:
            return self._by_scores(text, text.replace(MARK, "\uffff").replace(" ", MARK))
        core = text.lstrip(" ")
        spaces = len(text) - len(core)
        if not core:
            return self._spaces(spaces)
        first = " " if spaces else ""
        ids = self._by_merges(first + core, (first + core).replace(MARK, "\uffff").replace(" ", MARK))
        if spaces and self.texts.get(ids[0]) == MARK:
            return self._spaces(spaces) + ids[1:]
        return self._spaces(spaces - 1) + ids if spaces > 1 else ids

    def _spaces(self, count: int) -> tuple[int, ...]:
        """A run of marks: all its merges have one score, so the leftmost pair comes first."""
        done: list[int] = []
        for _ in range(count):
            done.append(1)
            while len(done) > 1 and MARK * (done[-2] + done[-1]) in self.found:
                done[-2:] = [done[-2] + done[-1]]
        return tuple(self.found[MARK * n] for n in done)

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the text of ``a`` and ``b`` gives these two again.

        Their merges are undone, the latest first. Of each two parts that meet on the way, merging
        them must not come before the merge that takes one of them away; of equal merges the one
        further left comes first.
        """
        ranks, splits, texts, found = self.vocabulary.ranks, self.vocabulary.splits, self.texts, self.found
        taken_a = taken_b = 1 << 60
        while True:
            over = found.get(texts[a] + texts[b])
            if over in ranks and ranks[over] < taken_a and ranks[over] <= taken_b:
                return False
            rank_a, rank_b = ranks[a], ranks[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                taken_a, a = rank_a, splits[a][1]
            else:
                taken_b, b = rank_b, splits[b][0]

    def _by_merges(self, text: str, marked: str) -> tuple[int, ...]:
        n = len(text)
        last = [_UNSET] * (n + 1)
        last[0] = _FREE
        pairs = self.pairs
        for end, (length, i, _) in self.automaton.iter(marked):
            end += 1
            if last[end] != _UNSET:
                continue
            before = last[end - length]
            if before >= 0:
                allowed = pairs.get((before, i))
                if allowed is None:
                    if len(pairs) >= CACHE_PAIRS:
                        pairs.clear()
                    allowed = pairs[before, i] = self.may_follow(before, i)
                if not allowed:
                    continue
            last[end] = i
        ids: list[int] = []
        while n:
            i = last[n]
            if i >= 0:
                ids.append(i)
                n -= len(self.texts[i])
            else:  # in no piece: its bytes
                ids.extend(self.bytes_from[b] for b in reversed(text[n - 1].encode()))
                n -= 1
        return tuple(reversed(ids))

    def _by_scores(self, text: str, marked: str) -> tuple[int, ...]:
        n = len(text)
        best = [-np.inf] * (n + 1)
        best[0] = 0.0
        step: list = [None] * (n + 1)
        done = 0

        def by_bytes(upto: int) -> None:
            # Each position can be reached by its character's bytes; later pieces may be better.
            nonlocal done
            while done < upto:
                score = best[done] + self.unknown
                if score > best[done + 1]:
                    best[done + 1], step[done + 1] = score, (1, _FREE)
                done += 1

        for last, (length, i, score) in self.automaton.iter(marked):
            end = last + 1
            by_bytes(end - 1)
            reached = best[end - length] + score
            if reached > best[end]:
                best[end], step[end] = reached, (length, i)
        by_bytes(n)
        ids: list[int] = []
        while n:
            length, i = step[n]
            if i == _FREE:
                ids.extend(self.bytes_from[b] for b in reversed(text[n - 1].encode()))
            else:
                ids.append(i)
            n -= length
        return tuple(reversed(ids))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        cache = self.cache
        units = self.units(" " + text)
        try:
            return list(chain.from_iterable(map(cache.__getitem__, units)))
        except KeyError:
            pass
        found = []
        for unit in units:
            ids = cache.get(unit)
            if ids is None:
                ids = self.unit(unit)
                if len(unit) <= CACHE_LENGTH:
                    if len(cache) >= CACHE_UNITS:
                        cache.clear()
                    cache[unit] = ids
            found.append(ids)
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        text = b"".join(map(self.decoded.__getitem__, ids))
        return text[1:] if text[:1] == b" " else text


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary, as building the automaton takes a while."""
    if vocabulary.name not in _ENCODERS:
        _ENCODERS[vocabulary.name] = Encoder(vocabulary)
    return _ENCODERS[vocabulary.name]


def _tasks(docs: DataFrame, doc: str, value: str, model: str, made: list[tuple[str, str]], make):
    """Rows of ``doc`` and the columns ``made``, by ``make(encoder, batch)``, one row each."""
    narrow = docs.select(doc, value)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(model))
    kind = narrow.schema[doc].dataType
    schema = ", ".join([f"`{doc}` {kind.simpleString()}", *[f"{n} {ddl}" for n, ddl in made]])

    def run(batches):
        encoder = _encoder(sent.value)
        for batch in batches:
            is_text = not pa.types.is_list(batch.column(value).type)
            for part in slices([batch], value) if is_text else [batch]:
                columns = make(encoder, part.column(value))
                yield pa.RecordBatch.from_arrays(
                    [part.column(doc), *columns], names=[doc, *[n for n, _ in made]]
                )

    return narrow.mapInArrow(run, schema)


def _lists(rows: list[list[int]]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encoded(docs: DataFrame, text: str = "text", doc: str = "doc_id", model: str = DEFAULT_MODEL) -> DataFrame:
    """``(doc, n_tokens, ids)``."""

    def make(encoder: Encoder, column: pa.Array):
        ids = _lists([encoder.encode(x.decode()) for x in as_bytes(column)])
        return [pc.list_value_length(ids).cast(pa.int64()), ids]

    made = [("n_tokens", "long"), ("ids", "array<int>")]
    return _tasks(docs, doc, text, model, made, make)


def decoded(tokens: DataFrame, ids: str = "ids", doc: str = "doc_id", model: str = DEFAULT_MODEL) -> DataFrame:
    """``(doc, text)`` from rows with ids; a null list decodes to the empty text."""

    def make(encoder: Encoder, column: pa.Array):
        return [pa.array([encoder.decode(x or []).decode(errors="replace") for x in column.to_pylist()], pa.string())]

    return _tasks(tokens, doc, ids, model, [("text", "string")], make)


def round_trip(docs: DataFrame, text: str = "text", doc: str = "doc_id", model: str = DEFAULT_MODEL) -> DataFrame:
    """``(doc, n_tokens, ids, decoded_sha256, lossless)``: encoded, and decoded again in the same pass."""

    def make(encoder: Encoder, column: pa.Array):
        texts = as_bytes(column)
        rows, back = [], []
        for x in texts:
            ids = encoder.encode(x.decode())
            rows.append(ids)
            back.append(encoder.decode(ids))
        ids = _lists(rows)
        return [
            pc.list_value_length(ids).cast(pa.int64()),
            ids,
            pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
            pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
        ]

    made = [
        ("n_tokens", "long"), ("ids", "array<int>"),
        ("decoded_sha256", "string"), ("lossless", "boolean"),
    ]
    return _tasks(docs, doc, text, model, made, make)
