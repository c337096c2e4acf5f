"""SentencePiece byte-pair encoding and decoding by vectorised merge rounds.

The symbols of all distinct words of a batch stand in one flat numpy array. Each round
finds the best pair of every word (a segmented minimum over pair ranks), merges its
occurrences from the left, and closes the gaps, until no word holds a pair. The ids are
those of the sentencepiece library for models of type BPE with byte fallback, identity
normalisation and a dummy prefix, without sampling.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.common import portions

SPACE = "▁"  # how the model writes a space
NONE = np.int64(1) << 40  # rank of a pair that is no piece
WORDS_KEPT = 150_000  # distinct words a task remembers before it starts anew
SYMBOLS_AT_ONCE = 1 << 18
CHARACTERS_AT_ONCE = 1 << 20


@dataclass
class Model:
    """What encoding needs: piece texts by id and all pairs of symbols that form a piece.

    Symbols are piece ids; a character without a piece gets a number behind them and ends
    up as its bytes.
    """

    pieces: list[str]
    symbol_of: np.ndarray  # by code point
    byte_ids: np.ndarray
    end: int
    pair_keys: np.ndarray
    pair_merged: np.ndarray
    pair_rank: np.ndarray
    hasty: np.ndarray

    def __post_init__(self) -> None:
        self.other = len(self.pieces)
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        self.written = [str(i) for i in range(self.other)]

    def character(self, symbol: int) -> str:
        return chr(symbol - self.other)


def load(path: str) -> Model:
    """Read pieces and scores. Refuses models whose words cannot be merged one by one."""
    source = sentencepiece.SentencePieceProcessor(model_file=path)
    size = source.get_piece_size()
    pieces = [source.id_to_piece(i) for i in range(size)]
    normal = [
        i for i in range(size)
        if not (source.is_control(i) or source.is_unknown(i) or source.is_byte(i) or source.is_unused(i))
    ]
    ids = {pieces[i]: i for i in normal}
    byte_ids = np.array([source.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
    if not all(source.is_byte(int(i)) for i in byte_ids):
        raise ValueError(f"{path} has no byte fallback")
    probe = f"  a 　b{SPACE} "
    if source.decode(source.encode(probe)) != probe.replace(SPACE, " "):
        raise ValueError(f"{path} normalises text")
    if any(SPACE in p.lstrip(SPACE) for p in ids):
        raise ValueError(f"{path} has pieces that go beyond a word")
    scores = np.array([-source.get_score(i) for i in normal])
    rank = {i: int(r) for i, r in zip(normal, np.unique(scores, return_inverse=True)[1])}
    shared = {r for r, n in zip(*np.unique(list(rank.values()), return_counts=True)) if n > 1}

    # a character that occurs in longer pieces only can still be one side of a pair
    symbol_of = np.arange(0x110000, dtype=np.int64) + size
    symbols = {c: size + ord(c) for p in ids for c in p} | ids
    for p, i in ids.items():
        if len(p) == 1:
            symbol_of[ord(p)] = i
    pairs: dict[tuple[int, int], int] = {}
    best_beyond = np.full(size + 0x110000, NONE)
    for p, i in ids.items():
        for cut in range(1, len(p)):
            left, right = symbols.get(p[:cut]), symbols.get(p[cut:])
            if left is not None and right is not None:
                pairs[left, right] = i
                for side in (left, right):
                    best_beyond[side] = min(best_beyond[side], rank[i])
    width = np.int64(1) << 31
    order = sorted(pairs)
    merged = np.array([pairs[p] for p in order], dtype=np.int64)
    # A merged piece may open a pair that is better still; then the next merge in the word
    # must not be taken together with this one.
    hasty = np.array(
        [best_beyond[i] <= rank[i] or rank[i] in shared if i in rank else False for i in range(len(pieces))]
    )
    return Model(
        pieces,
        symbol_of,
        byte_ids,
        source.eos_id(),
        np.array([a * width + b for a, b in order], dtype=np.int64),
        merged,
        np.array([rank[int(m)] for m in merged], dtype=np.int64),
        hasty,
    )


def _look_up(model: Model, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and merged piece of each pair; rank NONE where there is no such piece."""
    key = (left << np.int64(31)) + right
    at = np.minimum(np.searchsorted(model.pair_keys, key), len(model.pair_keys) - 1)
    found = model.pair_keys[at] == key
    return np.where(found, model.pair_rank[at], NONE), model.pair_merged[at]


def merge_words(model: Model, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all words in one array and where each word begins in it (one bound more than words).

    A word is any text that starts where a merge cannot cross. Characters without a piece
    stay as ``model.other`` plus their code point.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    sym = model.symbol_of[points]
    word = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    rank, merged = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
    if len(sym) > 1:
        rank[:-1], merged[:-1] = _look_up(model, sym[:-1], sym[1:])
        rank[:-1][word[:-1] != word[1:]] = NONE
    done_sym, done_word = [sym[:0]], [word[:0]]
    while len(sym):
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(sym)]))
        live = least != NONE
        if not live.all():
            done_sym.append(sym[~live])
            done_word.append(word[~live])
            sym, word, rank, merged, least = sym[live], word[live], rank[live], merged[live], least[live]
            if not len(sym):
                break
        pick = np.flatnonzero(rank == least)
        # of pairs that overlap, every other one from the left
        fresh = np.r_[True, np.diff(pick) != 1]
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(pick)), 0))
        pick = pick[(np.arange(len(pick)) - run) % 2 == 0]
        # of a hasty piece, only the first in the word
        first = np.r_[True, np.diff(word[pick]) != 0]
        pick = pick[first | ~model.hasty[merged[pick]]]
        sym[pick] = merged[pick]
        keep = np.ones(len(sym), dtype=bool)
        keep[pick + 1] = False
        at = pick - np.arange(len(pick))  # where the new symbols are after compaction
        sym, word, rank, merged = sym[keep], word[keep], rank[keep], merged[keep]
        # only pairs beside a new symbol have changed
        beside = np.unique(np.concatenate([at, at[at > 0] - 1]))
        inner = beside[beside < len(sym) - 1]
        rank[beside] = NONE
        rank[inner], merged[inner] = _look_up(model, sym[inner], sym[inner + 1])
        rank[inner[word[inner] != word[inner + 1]]] = NONE
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], np.searchsorted(word[order], np.arange(len(texts) + 1))


def spell(model: Model, symbols: Iterable[int]) -> list[int]:
    """Piece ids of symbols: a character without a piece becomes its bytes."""
    ids: list[int] = []
    for s in symbols:
        if s < model.other:
            ids.append(s)
        else:
            ids.extend(int(model.byte_ids[b]) for b in model.character(s).encode("utf-8"))
    return ids


def decode(model: Model, ids: Iterable[int]) -> str:
    """The text of piece ids: bytes are put together, the dummy prefix is taken off."""
    return _decode_part(model, ids)[1:]


def _decode_part(model: Model, ids: Iterable[int]) -> str:
    out, held = [], bytearray()
    for i in ids:
        b = model.byte_of.get(i)
        if b is not None:
            held.append(b)
            continue
        if held:
            out.append(held.decode("utf-8", "replace"))
            held.clear()
        if i != model.end:
            out.append(model.pieces[i])
    out.append(held.decode("utf-8", "replace"))
    return "".join(out).replace(SPACE, " ")


class Encoder:
    """Encodes texts; remembers the ids of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, str] = {}
        self.other: dict[str, str] = {}  # words whose ids do not decode to the word itself

    def split(self, text: str) -> list[str]:
        """Words with their spaces in front."""
        return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, words: Iterable[str]) -> None:
        """Merge the words that are new, some at a time."""
        new, symbols = [], 0
        for w in set(words).difference(self.known):
            new.append(w)
            symbols += len(w)
            if symbols >= SYMBOLS_AT_ONCE:
                self._store(new)
                new, symbols = [], 0
        if new:
            self._store(new)

    def _store(self, words: list[str]) -> None:
        model = self.model
        symbols, bounds = merge_words(model, words)
        odd = set(np.flatnonzero(np.add.reduceat(symbols >= model.other, bounds[:-1])).tolist())
        symbols, bounds = symbols.tolist(), bounds.tolist()
        written, plain = model.written, model.pieces
        for k, w in enumerate(words):
            ids = symbols[bounds[k] : bounds[k + 1]]
            if k in odd:
                ids = spell(model, ids)
                decoded = _decode_part(model, ids)
            else:
                decoded = "".join([plain[i] for i in ids])
            self.known[w] = " ".join([written[i] for i in ids])
            if decoded.replace(SPACE, " ") != w.replace(SPACE, " "):
                self.other[w] = decoded

    def encode(self, text: str | None) -> tuple[str, str]:
        """Ids with the end id in decimal, joined by a space, and the decoded text."""
        parts = self.split(text or "")
        self.learn(parts)
        return self._join(parts)

    def _join(self, parts: list[str]) -> tuple[str, str]:
        known, other = self.known, self.other
        ids = " ".join([known[w] for w in parts] + [str(self.model.end)])
        decoded = "".join([other.get(w, w) for w in parts] if other else parts)
        return ids, decoded[1:].replace(SPACE, " ")

    def encode_all(self, texts: Sequence[str | None]) -> Iterator[tuple[str, str]]:
        """``encode`` for many texts, some at a time, so that merges run over many words."""
        texts = [t or "" for t in texts]
        for part in portions([len(t) for t in texts], CHARACTERS_AT_ONCE):
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
                self.other.clear()
            split = [self.split(t) for t in texts[part]]
            self.learn(itertools.chain.from_iterable(split))
            yield from map(self._join, split)


def encoding(spark: SparkSession, model_path: str) -> Callable[[Column | str], Column]:
    """A column function: text to (ids, decoded); the ids end with the end id."""
    shared = spark.sparkContext.broadcast(load(model_path))  # the vocabulary: some MB

    @F.pandas_udf("ids array<int>, decoded string")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)  # what it remembers goes with the task
        for texts in batches:
            rows = list(encoder.encode_all(texts))
            ids = [np.array(i.split(), dtype=np.int32) for i, _ in rows]
            yield pd.DataFrame({"ids": ids, "decoded": [d for _, d in rows]})

    return encode


def digests(spark: SparkSession, model_path: str) -> Callable[[Column | str], Column]:
    """A column function: text to (n_tokens, ids_sha256, decoded_sha256), so that ids stay in the task."""
    shared = spark.sparkContext.broadcast(load(model_path))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        for texts in batches:
            rows = [
                (
                    ids.count(" ") + 1,
                    hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest(),
                )
                for ids, decoded in encoder.encode_all(texts)
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest


def encode_documents(docs: DataFrame, model_path: str, text: Column | str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    Null and empty texts are the end id alone. Repeated rows are encoded each; other
    columns are left out, whatever their names.
    """
    text = F.col(text) if isinstance(text, str) else text
    done = docs.select("doc_id", digests(docs.sparkSession, model_path)(text).alias("encoded"))
    return done.select("doc_id", "encoded.*")
