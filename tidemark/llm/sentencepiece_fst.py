"""SentencePiece encoding and decoding (operator 8) as a weighted transducer.

The compiled machine has three layers. The normaliser maps a space to U+2581 and
puts one in front. The piece layer holds every vocabulary piece as a path of its
characters, weighted by its negated score; a character that no piece has is a
path of its UTF-8 byte pieces. The context layer remembers the last piece and lets
another follow only if the pair is stable, that is if merging the pair's characters
by score gives back these two pieces. Encoding composes the machine with a text.
The context layer is what makes the result
that of the merge-trained model (without it the shortest path would be another
segmentation), and it leaves one state alive at each place of the text: the last
piece of the encoding of what stands before. So one path is left, the first arc
admitted at a place is taken, and no costs are compared. Other models (unigram, or
with a text normaliser) are refused.

Pieces never run across the start of a word, so the machine is composed word by
word, and a task remembers the paths of the words it has met lately.
"""

from __future__ import annotations

import hashlib
import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm.common import bounded_batches, released, slices, utf8, without

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
#: Words whose paths a task remembers (twice as many at most), the longest such word, and remembered pairs.
WORDS, WORD_CHARS, PAIRS = 150_000, 48, 400_000


@dataclass
class Vocabulary:
    """What is read of a model: piece -> (id, score), byte -> id, and the text bytes of each id."""

    pieces: dict[str, tuple[int, float]]
    bytes_: list[int]
    text: list[bytes]


def check_supported(content: bytes) -> None:
    """The machine is that of merge-trained models which only mark spaces; any other
    would be encoded otherwise than its library does, so it is refused."""
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(content)
    kind, rules = model.trainer_spec, model.normalizer_spec
    if kind.model_type != kind.BPE:
        raise ValueError("only merge-trained (BPE) models are supported")
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    if rules.precompiled_charsmap or not plain or kind.treat_whitespace_as_suffix:
        raise ValueError("only models without a text normaliser are supported")


def read_model(content: bytes) -> Vocabulary:
    check_supported(content)
    sp = sentencepiece.SentencePieceProcessor(model_proto=content)
    pieces, byte_ids, text = {}, [-1] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            text.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i):
            text.append(b"")
        elif sp.is_unknown(i):
            text.append(" ⁇ ".encode())
        else:
            text.append(piece.replace(SPACE_MARK, " ").encode())
            if not sp.is_unused(i):
                pieces[piece] = (i, sp.get_score(i))
    if -1 in byte_ids:
        raise ValueError("the model has no byte fallback")
    return Vocabulary(pieces, byte_ids, text)


class Transducer:
    """The compiled machine of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # the piece layer, read backwards: what some piece ends with -> its id, or -1 if it is no piece itself
        self.ends: dict[str, int] = {piece[k:]: -1 for piece in vocabulary.pieces for k in range(1, len(piece))}
        self.names = {i: piece for piece, (i, _) in vocabulary.pieces.items()}
        self.order = {p: k for k, p in enumerate(sorted((p for p in vocabulary.pieces if len(p) > 1), key=lambda p: -vocabulary.pieces[p][1]))}
        self.halves: dict[str, tuple[str, str] | None] = {}
        for piece, (k, _) in vocabulary.pieces.items():  # only pieces that are the merge of their characters have arcs
            self.ends[piece] = k if self.split(piece) is not None else -1
        self.stable: dict[int, bool] = {}
        self.paths: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # where a text can be cut: before a run of marks, and round characters that no piece has
        inner = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in vocabulary.pieces)
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in vocabulary.pieces))
        cut = f"[{alone}]|" if alone else ""
        beside = {c for p in vocabulary.pieces for a, b in zip(p, p[1:]) for c in (a, b) if a.isalpha() != b.isalpha()}
        self.signs = "".join(c for c in ".,;:!?|%&$#*" if c not in beside)  # never in one piece with a letter
        self.words = re.compile("(?s).+" if inner else f"{cut}{SPACE_MARK}+[^{SPACE_MARK}{alone}]*|[^{SPACE_MARK}{alone}]+")

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two parts that the last merge of a piece joins; empty ones for a
        single character, None if merging its characters does not give the piece."""
        if piece in self.halves:
            return self.halves[piece]
        parts, order = list(piece), self.order
        while len(parts) > 2:
            best = min(((order[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in order), default=None)
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        found = ("", "") if len(parts) == 1 else (parts[0], parts[1]) if len(parts) == 2 else None
        self.halves[piece] = found
        return found

    def follows(self, last: int, piece: int) -> bool:
        """Whether the context layer has an arc from piece ``last`` to ``piece``:
        taking back the merges of the two, the latest first, no merge across
        their border may come before the one taken back."""
        if len(self.stable) >= PAIRS:
            self.stable.clear()
        key = last << 32 | piece
        x, y, order, limit = self.names[last], self.names[piece], self.order, math.inf
        while True:
            if order.get(x + y, limit) < limit:
                self.stable[key] = False
                return False
            after, before = order.get(x, -1), order.get(y, -1)
            if after > before:
                limit, x = after, self.split(x)[1]
            elif before >= 0:
                limit, y = before + 1, self.split(y)[0]
            else:
                self.stable[key] = True
                return True

    def shortest(self, word: str) -> list[int]:
        """Piece ids on the path of the composition with ``word``."""
        n, end, stable = len(word), self.ends.get, self.stable
        # per place: last piece (-1: start or bytes), place before it; byte fallback, if no arc is found
        last, back = [-1] * (n + 1), list(range(-1, n))
        for i in range(1, n + 1):
            j = i - 1
            piece = end(word[j:i])
            while piece is not None:
                if piece >= 0:
                    before = last[j]
                    if before < 0:
                        last[i], back[i] = piece, j
                        break
                    arc = stable.get(before << 32 | piece)
                    if arc is None:
                        arc = self.follows(before, piece)
                    if arc:  # the one state that is alive here
                        last[i], back[i] = piece, j
                        break
                if not j:
                    break
                j -= 1
                piece = end(word[j:i])
        out, at = [], n
        while at:
            if last[at] >= 0:
                out.append(last[at])
            else:
                out += [self.vocabulary.bytes_[x] for x in reversed(word[back[at] : at].encode())]
            at = back[at]
        out.reverse()
        return out

    def path(self, word: str) -> bytes:
        found = self.paths.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                stem = word.rstrip(self.signs)
                if stem != word and stem[-1:].isalpha():
                    found = self.path(stem) + self.path(word[len(stem) :])
                else:
                    found = array("i", self.shortest(word)).tobytes()
            if len(word) <= WORD_CHARS:
                if len(self.paths) >= WORDS:
                    self.older, self.paths = self.paths, {}
                self.paths[word] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Piece ids of a text; none for the empty text."""
        if not text:
            return np.zeros(0, np.int32)
        return np.frombuffer(b"".join(map(self.path, self.words.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)))), np.int32)

    def decode(self, ids) -> str:
        """The inverse: bytes joined, the front space removed, broken UTF-8 replaced."""
        table = self.vocabulary.text
        out = b"".join([table[i] for i in ids])
        return out[1:].decode(errors="replace") if out[:1] == b" " else out.decode(errors="replace")


_COMPILED: dict[bytes, Transducer] = {}


def compiled(content: bytes) -> Transducer:
    """The machine of a model, compiled once in a worker process; the last model's is kept."""
    key = hashlib.sha256(content).digest()
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = Transducer(read_model(content))
    return _COMPILED[key]


def model_bytes(spark: SparkSession, path: str = DEFAULT_MODEL) -> bytes:
    """A model file through Spark's readers (a bare path is a file of the driver)."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first().content)
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, text: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """All rows and columns of ``docs`` plus ``ids`` (array of int, the piece ids
    of the text) and ``round_trip`` (whether they decode to the text again; false
    only for texts that hold U+2581 itself), which replace columns of those names.
    Null and empty texts have no pieces. Texts of any length are taken whole; repeated
    rows are encoded each; an empty table gives an empty result."""
    docs = without(docs, "ids", "round_trip")
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes(docs.sparkSession, model))  # a model's size is fixed
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = compiled(shared.value)
        for b in batches:
            texts = utf8(b.column(place))
            for lo, hi in slices(texts):
                ids = [machine.encode(t.decode()) for t in texts[lo:hi]]
                same = [machine.decode(x.tolist()).encode() == t for x, t in zip(ids, texts[lo:hi])]
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                pieces = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, pieces, pa.array(same)], names=[*b.schema.names, "ids", "round_trip"])

    return docs.mapInArrow(released(run), StructType([*docs.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("round_trip", BooleanType())]))


def decode(spark: SparkSession, ids: str | Column = "ids", model: str = DEFAULT_MODEL) -> Column:
    """The texts of a column of piece ids; null gives the empty text, ids outside the vocabulary fail."""
    shared = spark.sparkContext.broadcast(model_bytes(spark, model))

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = compiled(shared.value)
        for rows in batches:
            yield pd.Series(["" if x is None else machine.decode(x.tolist()) for x in rows], dtype=object)

    return decoded(ids)
