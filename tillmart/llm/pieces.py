"""SentencePiece encoding and decoding (operator 5).

An Aho-Corasick automaton over the pieces reports, for each position of a text and in one
pass, every piece that ends there (its own and those along the output links). Each report relaxes the best score of its end from that of its start: Viterbi
without a lattice in memory. Ties go to the longer piece.

No piece of a model holds a space mark behind another character, so a best path always
breaks in front of a run of space marks, and the text is cut there first (the model is checked for
it; other models are run over whole texts). Equal segments have equal paths, so a task keeps
those it has met, up to `KEEP` of them and as many older ones; a segment met again stays.

Characters of no piece become byte pieces. The vocabulary file is read by the driver only and
its pieces, as many as the vocabulary has, go to every task; the path is a parameter.

Defined results: a null or empty text has no pieces and decodes to the empty text; each
row is encoded by itself; a U+2581 in a text, the model's space mark, decodes to a space, any
other text to itself. Other columns of the input are kept in `row`.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import astuple, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
KEEP = 100_000
MARK = "▁"  # fixed: how the format writes a space
UNKNOWN_PENALTY = 10.0  # fixed: how far an unknown character scores below the worst piece


@dataclass(frozen=True)
class Vocabulary:
    """Piece texts and scores by id; byte and control pieces apart."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    plain: frozenset[int]  # ids that stand for their text
    bytes_: tuple[int, ...]  # id of each byte value
    idle: frozenset[int] = frozenset()  # plain ids that are on no best path


def load(path: str = MODEL_PATH) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    pieces = tuple(model.id_to_piece(i) for i in ids)
    special = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    number = {p: i for i, p in enumerate(pieces)}
    return Vocabulary(
        pieces,
        tuple(float(model.get_score(i)) for i in ids),
        frozenset(set(ids) - special),
        tuple(number[f"<0x{b:02X}>"] for b in range(256)),
    )


def without_idle(vocabulary: Vocabulary) -> Vocabulary:
    """The vocabulary with those pieces marked that are not the best path of their own text.

    Other pieces then do better wherever such a piece fits, so the encoder need not look for it. Scores
    must be whole numbers, whose sums are exact; for others nothing is marked.
    """
    if not all(vocabulary.scores[i].is_integer() for i in vocabulary.plain):
        return vocabulary
    encoder = Encoder(vocabulary)
    alone = {i: array("i", [i]).tobytes() for i in vocabulary.plain}
    idle = frozenset(i for i, path in alone.items() if encoder.path(vocabulary.pieces[i]) != path)
    return replace(vocabulary, idle=idle)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """`row` (the input row) and `ids`, the pieces of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(without_idle(vocabulary)))
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            parts = [encoder.encode(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(parts)], names=["row", "ids"])

    schema = StructType(
        [rows.schema["row"], StructField("ids", ArrayType(IntegerType(), False), False)]
    )
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """`row` (the input row) and `decoded`, the text of its pieces; null ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(astuple(vocabulary))
    rows = encoded.select(F.struct("*").alias("row"), F.col(ids_col).alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(Vocabulary(*shared.value))
        for batch in batches:
            texts = [decoder.decode(i.values.to_numpy() if i.is_valid else ()) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "decoded"]
            )

    return rows.mapInArrow(
        run, StructType([rows.schema["row"], StructField("decoded", StringType(), False)])
    )


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.bytes = vocabulary.bytes_
        self.automaton = ahocorasick.Automaton()
        plain = [(i, vocabulary.pieces[i], vocabulary.scores[i]) for i in sorted(vocabulary.plain)]
        for number, piece, value in plain:
            if number not in vocabulary.idle:
                self.automaton.add_word(piece, (len(piece), value, number))
        self.automaton.make_automaton()
        self.unknown = min(value for _, _, value in plain) - UNKNOWN_PENALTY
        self.singles = {piece for _, piece, _ in plain if len(piece) == 1}
        alphabet = {c for _, piece, _ in plain for c in piece}
        self.cuts = not any(MARK in piece.lstrip(MARK) for _, piece, _ in plain)
        # A line end that is in no piece cuts every path as well.
        alone = "" if "\n" in alphabet else "\n"
        self.segments = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+|{alone or MARK}")
        self.known = _Paths(self.path, KEEP)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, dtype=np.int32)
        marked = MARK + text.replace(" ", MARK)
        if not self.cuts:
            return np.frombuffer(self.path(marked), dtype=np.int32)
        segments = self.segments.findall(marked)
        return np.frombuffer(b"".join(map(self.known.__getitem__, segments)), dtype=np.int32)

    def path(self, text: str) -> bytes:
        """Ids of the best path through a text, as 32-bit numbers."""
        size = len(text)
        # By the last position; what ends in front of the text is the last entry, at -1.
        best = [float("-inf")] * size
        best.append(0.0)
        back: list[tuple[int, float, int]] = [(0, 0.0, 0)] * size
        strange = [i for i, c in enumerate(text) if c not in self.singles]
        if not strange:
            for end, piece in self.automaton.iter(text):
                length, value, _ = piece
                total = best[end - length] + value
                if total > best[end] or total == best[end] and length > back[end][0]:
                    best[end] = total
                    back[end] = piece
        else:
            # A position whose character is no piece can be left as an unknown one, too.
            at = 0
            strange.append(size)
            unknown = (1, self.unknown, -1)

            def leave(upto: int) -> None:
                nonlocal at
                while strange[at] < upto:
                    place = strange[at]
                    at += 1
                    if best[place - 1] + self.unknown > best[place]:
                        best[place] = best[place - 1] + self.unknown
                        back[place] = unknown

            for end, piece in self.automaton.iter(text):
                leave(end)
                length, value, _ = piece
                total = best[end - length] + value
                if total > best[end] or total == best[end] and length > back[end][0]:
                    best[end] = total
                    back[end] = piece
            leave(size)
        out = array("i")
        place = size - 1
        while place >= 0:
            length, _, number = back[place]
            if number >= 0:
                out.append(number)
            else:
                out.extend([self.bytes[b] for b in reversed(text[place].encode())])
            place -= length
        out.reverse()
        return out.tobytes()


class _Paths(dict):
    """Paths by segment, found at first use: the last `keep` of them, and those before that."""

    def __init__(self, path: Callable[[str], bytes], keep: int):
        super().__init__()
        self.path, self.keep = path, keep
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        found = self.older.get(segment)
        if found is None:
            found = self.path(segment)
        if len(self) >= self.keep:
            self.older = dict(self)
            self.clear()
        self[segment] = found
        return found


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        byte = {number: bytes([value]) for value, number in enumerate(vocabulary.bytes_)}
        self.table = [
            byte.get(i, piece.replace(MARK, " ").encode() if i in vocabulary.plain else b"")
            for i, piece in enumerate(vocabulary.pieces)
        ]

    def decode(self, ids) -> str:
        """The text without the space put in front of it; bytes that are no UTF-8 are replaced."""
        table = self.table
        data = b"".join([table[i] for i in (ids.tolist() if hasattr(ids, "tolist") else ids)])
        return data.decode("utf-8", "replace").removeprefix(" ")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) for p in parts)])
    values = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()),
        pa.array(values, pa.int32()),
        type=pa.list_(pa.field("element", pa.int32(), False)),
    )
