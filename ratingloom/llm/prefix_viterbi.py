"""SentencePiece encoding and decoding by a Viterbi pass that shares prefixes.

Texts are cut into marked words (runs of the space mark and the characters after them); no piece
of the model reaches from a word into the next mark, so words can be encoded on their own. The
distinct words of a slice of rows are sorted, which puts them in the order of a depth-first walk
over their trie, and the forward states of the common prefix with the word before are reused: a
state is made once per trie node, not once per word.

The public model is of the BPE kind. A path of largest summed score through its lattice is not
what such a model means, so the state of a prefix holds the last piece of the one segmentation
that the merge rules give that prefix, and an arc may be taken if the two pieces beside it
survive as neighbours under those rules. Following the arcs back gives the same ids as the
library; words with other marks than one in front are merged directly.

Characters outside the vocabulary become byte pieces. Null and empty texts have no ids. Decoding
gives the text back, except that a literal space mark (U+2581) reads as a space, as in the library
(``round_trip`` is false for those texts). Extra columns are not read; repeated rows repeat.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratingloom.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NORMAL, BYTE = 1, 6
CACHE_WORDS = 100_000
MAX_NEIGHBOURS = 200_000
SCHEMA = "n_words long, n_tokens long, token_ids array<int>, round_trip boolean"


@dataclass
class Vocabulary:
    """Pieces, their order of merging, and how each piece came about."""

    ids: dict[str, int]
    byte_ids: list[int]
    pieces: list[bytes]
    rank: dict[str, float]
    names: list[str]
    parts: dict[str, tuple[str, str] | None] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)
    neighbours: dict[int, bool] = field(default_factory=dict)
    automaton: ahocorasick.Automaton = field(default_factory=ahocorasick.Automaton)

    def merge(self, text: str) -> list[str]:
        """Pieces of ``text`` by the rule itself: the best-scored neighbouring pair first, leftmost on ties.

        Neighbours are linked and the pairs wait in a heap, so that a long word takes n log n steps.
        """
        rank, parts, end = self.rank, list(text), len(text)
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        due = [(r, n, n + 1, parts[n] + parts[n + 1]) for n in range(end - 1) if (r := rank.get(parts[n] + parts[n + 1])) is not None]
        heapify(due)
        while due:
            _, left, right, piece = heappop(due)
            # a pair that was broken up since: one side has grown or gone
            if after[left] != right or parts[left] + parts[right] != piece or not parts[right]:
                continue
            parts[left], parts[right] = piece, ""
            far = after[left] = after[right]
            if far < end:
                before[far] = left
                if (r := rank.get(piece + parts[far])) is not None:
                    heappush(due, (r, left, far, piece + parts[far]))
            if (near := before[left]) >= 0 and (r := rank.get(parts[near] + piece)) is not None:
                heappush(due, (r, near, left, parts[near] + piece))
        return [p for p in parts if p]

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two pieces joined last when ``piece`` is built, None if the rules never build it."""
        parts, rank = list(piece), self.rank
        while len(parts) > 2:
            best, at = None, -1
            for n in range(len(parts) - 1):
                r = rank.get(parts[n] + parts[n + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, n
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1])

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the rules leave two pieces as they are when one follows the other.

        Both pieces are taken apart at the common border, latest merge first; a pair across the
        border that would be merged earlier than what was undone so far breaks them.
        """
        rank, parts = self.rank, self.parts
        a, b = self.names[left], self.names[right]
        due_a, due_b = float("inf"), float("inf")  # when the edge piece is merged into its owner
        answer = True
        while True:
            across = rank.get(a + b)
            # on a tie the leftmost pair goes first: the owner on the left wins, the one on the right loses
            if across is not None and across < due_a and across <= due_b:
                answer = False
                break
            split_a, split_b = parts.get(a), parts.get(b)
            if not split_a and not split_b:
                break
            if (rank[a] if split_a else -1.0) > (rank[b] if split_b else -1.0):
                due_a, a = rank[a], split_a[1]
            else:
                due_b, b = rank[b], split_b[0]
        if len(self.neighbours) > MAX_NEIGHBOURS:
            self.neighbours.clear()
        self.neighbours[left << 16 | right] = answer
        return answer

    def bytes_of(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(model: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file, read once per process."""
    if model in _loaded:
        return _loaded[model]
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(model, "rb") as file:
        proto.ParseFromString(file.read())
    ids, rank = {}, {}
    byte_ids, pieces, names = [0] * 256, [], []
    for n, p in enumerate(proto.pieces):
        pieces.append(b"")
        names.append(p.piece)
        if p.type == BYTE:
            byte_ids[int(p.piece[3:5], 16)] = n
            pieces[n] = bytes([int(p.piece[3:5], 16)])
        elif p.type == NORMAL:
            ids[p.piece] = n
            rank[p.piece] = -p.score
            pieces[n] = p.piece.replace(MARK, " ").encode()
    if len(pieces) > 1 << 16:
        raise ValueError("neighbours are remembered for vocabularies of up to 65,536 pieces")
    out = Vocabulary(ids, byte_ids, pieces, rank, names, sizes=[len(n) for n in names])
    for piece, n in ids.items():
        split = out._last_merge(piece) if len(piece) > 1 else None
        if len(piece) > 1 and (split is None or out.merge(piece) != [piece]):
            continue  # the rules never build it
        out.parts[piece] = split
        out.automaton.add_word(piece, n)
    out.automaton.make_automaton()
    _loaded[model] = out
    return out


class PrefixEncoder:
    """Encodes sorted words, keeping the forward states along the current branch of the trie."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.word = ""
        self.last: list[int] = [-1]  # state of each prefix: the id of its last piece, -1 if that is no piece
        self.nodes = 0  # states made, for tests

    def ids(self, word: str) -> list[int]:
        old, last, vocab = self.word, self.last, self.vocab
        shared, most = 0, min(len(old), len(word))
        while shared < most and old[shared] == word[shared]:
            shared += 1
        del last[shared + 1 :]
        known, sizes, unset = vocab.neighbours, vocab.sizes, len(word) - shared
        self.nodes += unset
        last += [-1] * unset  # characters outside the vocabulary join nothing
        done = shared - 1
        # all pieces that end at each place, the longest first; places of the shared prefix have their state
        for at, piece in vocab.automaton.iter(word):
            if at <= done:
                continue
            before = last[at + 1 - sizes[piece]]
            if before >= 0:
                fits = known.get(before << 16 | piece)
                if fits is None:
                    fits = vocab.stay_apart(before, piece)
                if not fits:
                    continue
            last[at + 1] = piece
            done = at
        self.word = word
        out, end = [], len(word)
        while end:
            piece = last[end]
            if piece >= 0:
                out.append(piece)
                end -= sizes[piece]
            else:
                end -= 1
                out += vocab.bytes_of(word[end])[::-1]
        return out[::-1]


def marked_words(text: str) -> list[str]:
    """The words of a text without the single mark in front; other marks are part of the word.

    The text itself gets a mark in front.
    """
    if not text:
        return []
    if MARK not in text and text[0] != " " and "  " not in text and text[-1] != " ":
        return text.split(" ")
    return [w[1:] if MARK not in w[1:] else w for w in WORD.findall(MARK + text.replace(" ", MARK))]


def encode_words(words: Iterable[str], vocab: Vocabulary) -> dict[str, bytes]:
    """The ids (four bytes each) of distinct words, found in one walk over their trie."""
    encoder = PrefixEncoder(vocab)
    out = {}
    for word in sorted(words):
        if MARK in word:
            ids = [i for p in vocab.merge(word) for i in ([vocab.ids[p]] if p in vocab.ids else vocab.bytes_of(p))]
        else:
            ids = encoder.ids(MARK + word)
        out[word] = array("i", ids).tobytes()
    return out


def decode(ids: Iterable[int], vocab: Vocabulary) -> str:
    """The text of a list of ids, without the mark that encoding puts in front."""
    raw = b"".join(map(vocab.pieces.__getitem__, ids))
    return raw.decode("utf-8", "replace").removeprefix(" ")


_recent: dict[str, list[dict[str, bytes]]] = {}


def _encoder(model: str) -> Callable[[list[str | None]], Iterator[tuple]]:
    """Encodes slices of texts. The words of the last slices are remembered per process: when the
    newer half of the memory is full it becomes the older half, whose words come back on use."""
    vocab = vocabulary(model)
    memory = _recent.setdefault(model, [{}, {}])

    def encode(texts: list[str | None]) -> Iterator[tuple]:
        words = [marked_words(t or "") for t in texts]
        if len(memory[0]) > CACHE_WORDS:
            memory[:] = [{}, memory[0]]
        newer, older = memory
        missing = set(chain.from_iterable(words)) - newer.keys()
        newer.update((w, older[w]) for w in missing & older.keys())
        newer.update(encode_words(missing - older.keys(), vocab))
        for text, own in zip(texts, words):
            ids = np.frombuffer(b"".join(map(newer.__getitem__, own)), np.int32)
            yield len(own), len(ids), ids, decode(ids.tolist(), vocab) == (text or "")

    return encode


def encode_texts(docs: DataFrame, model: str = MODEL, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, word and token counts, the ids, and whether decoding them gives the text back; no shuffle."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    given = docs.select(*[docs[c] for c in keep], docs[text].alias("_text"))
    n_keep = len(keep)
    out = StructType([*given.schema.fields[:-1], *StructType.fromDDL(SCHEMA)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(out)
        encode = _encoder(model)
        for piece in slices(batches, 256):
            rows = list(encode(piece.column(n_keep).to_pylist()))
            offsets = array("i", [0])
            for r in rows:
                offsets.append(offsets[-1] + r[1])
            flat = pa.array(np.concatenate([r[2] for r in rows] or [np.zeros(0, np.int32)]), pa.int32())
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
            made = [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                ids.cast(arrow.field(n_keep + 2).type), pa.array([r[3] for r in rows], pa.bool_()),
            ]
            kept = [piece.column(n).cast(arrow.field(n).type) for n in range(n_keep)]
            yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)

    return given.mapInArrow(run, out)


def decode_ids(encoded: DataFrame, model: str = MODEL, ids: str = "token_ids", out: str = "text") -> DataFrame:
    """The rows with a column ``out`` that holds the text of their ids (null ids: null)."""

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        vocab = vocabulary(model)
        return pd.Series([None if x is None else decode(x, vocab) for x in column], dtype=object)

    return encoded.withColumn(out, texts(F.col(ids)))
