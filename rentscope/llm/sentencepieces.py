"""SentencePiece models on the tokenizers library.

The model's protobuf is parsed here: pieces with scores and types, the normaliser and the
flags of the trainer. From it a tokenizer is rebuilt: unigram scores or, for BPE models, one
merge per way to split a piece, ordered by score; byte fallback; the space marker. Texts are
normalised and marked, cut where no piece can cross, and the distinct cuts of a batch that
the worker has not met yet are encoded together, multithreaded. Words among these are compared
with the sentencepiece library when they are first met, and take its ids where they differ.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer, models, normalizers

from rentscope.llm.common import PartTable, as_text, forget_state, map_batches, pick, worker_state

# Field numbers, piece types and model types of the public model format, and the space marker.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_MODEL_TYPE, _BYTE_FALLBACK, _UNK_ID = 3, 35, 40
_CHARSMAP, _DUMMY_PREFIX, _REMOVE_SPACES, _ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"

#: Parts in a worker's table, its bytes, and the longest part that stays there when it is full.
TABLE_SIZE, TABLE_BYTES, LONGEST_KEPT = 150_000, 40_000_000, 64
#: Cuts encoded by the library in one call.
AT_ONCE = 5_000
#: Threads of a worker's batches, unless ``RAYON_NUM_THREADS`` is set: an executor runs a task per core, and each
#: thread keeps memory of its own; with one per core of the machine a worker grows by half.
THREADS = 2
#: Begins a part that is no single marked word.
BARE = "\0"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = struct.unpack_from("<d", data, at)[0], at + 8
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        else:
            raise ValueError(f"wire type {kind} is not used by such models")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True


def read_model(path: str) -> Model:
    """Pieces, scores, types and flags of a model file; absent flags have the format's defaults."""
    with open(path, "rb") as file:
        data = file.read()
    model = Model([])
    for number, value in fields(data):
        if number == _PIECES:
            piece = dict(fields(value))
            model.pieces.append((piece.get(1, b"").decode("utf-8"), float(piece.get(2, 0.0)), int(piece.get(3, NORMAL))))
        elif number == _TRAINER:
            spec = dict(fields(value))
            model.kind = int(spec.get(_MODEL_TYPE, UNIGRAM))
            model.byte_fallback = bool(spec.get(_BYTE_FALLBACK, 0))
            model.unk_id = int(spec.get(_UNK_ID, 0))
        elif number == _NORMALIZER:
            spec = dict(fields(value))
            model.charsmap = spec.get(_CHARSMAP, b"")
            model.dummy_prefix = bool(spec.get(_DUMMY_PREFIX, 1))
            model.remove_spaces = bool(spec.get(_REMOVE_SPACES, 1))
            model.escape_spaces = bool(spec.get(_ESCAPE_SPACES, 1))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if any(kind in (USER_DEFINED, UNUSED) for _, _, kind in model.pieces):
        raise ValueError("models with user-defined or unused pieces are not supported")
    return model


def rebuild(model: Model) -> Tokenizer:
    """A tokenizer over marked text, without normaliser of its own."""
    unknown = model.pieces[model.unk_id][0]
    if model.kind == UNIGRAM:
        out_of_reach = min(score for _, score, _ in model.pieces) - 1e6
        scored = [(piece, score if kind == NORMAL else out_of_reach) for piece, score, kind in model.pieces]
        return Tokenizer(models.Unigram(scored, model.unk_id, model.byte_fallback))
    vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
    usable = {piece: score for piece, score, kind in model.pieces if kind == NORMAL}
    merges = []
    for piece, _ in sorted(usable.items(), key=lambda x: -x[1]):
        merges += [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in usable and piece[i:] in usable]
    return Tokenizer(models.BPE(vocabulary, merges, unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback))


class Codec:
    """Encodes and decodes whole texts by one model."""

    def __init__(self, path: str):
        self.model = model = read_model(path)
        self.tokenizer = rebuild(model)
        self.library = SentencePieceProcessor(model_file=path)
        self.charsmap = normalizers.Precompiled(model.charsmap) if model.charsmap else None
        self.space = MARK if model.escape_spaces else " "
        normal = [piece for piece, _, kind in model.pieces if kind == NORMAL]
        crossing = any(re.search(f"[^{self.space}]{self.space}", piece) for piece in normal)
        # Cuts before a run of marks are safe where no piece goes on past one; a unigram's best path may then be put together as well.
        self.cut = None if crossing else re.compile(f"{self.space}*[^{self.space}]+|{self.space}+").findall
        # An array of objects: the bytes of many ids are taken in one step.
        self.bytes = np.array([bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(self.space, " ").encode() for p, _, kind in model.pieces], object)
        self.bytes[model.unk_id] = " ⁇ ".encode()
        self.table = PartTable(self._units, TABLE_SIZE, TABLE_BYTES, LONGEST_KEPT)
        self.n_compared = self.n_different = 0

    def normalized(self, text: str) -> str:
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.model.remove_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (" " + text if self.model.dummy_prefix else text).replace(" ", self.space)

    def _reference(self, words: list[str]) -> list[list[int]]:
        """The library's ids of cuts: it puts its own marker in front of a word, so words go in without theirs."""
        return self.library.encode(words, num_threads=1)

    def encode_units(self, units: list[str]) -> dict[str, bytes]:
        """Ids of distinct cuts as 32-bit strings: one multithreaded batch.

        Cuts of one marker and a word are compared with the library, which ends up in the result where it differs.
        """
        out: dict[str, bytes] = {}
        comparable = self.model.dummy_prefix and not self.model.remove_spaces and not self.charsmap
        for at in range(0, len(units), AT_ONCE):  # the library's results are large, so they go part by part
            part = units[at : at + AT_ONCE]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            if comparable:
                compared = [i for i, unit in enumerate(part) if unit[0] == self.space and unit.count(self.space) == 1 and len(unit) > 1]
                for i, expected in zip(compared, self._reference([part[i][1:] for i in compared]), strict=True):
                    if ids[i] != expected:
                        ids[i] = expected
                        self.n_different += 1
                self.n_compared += len(compared)
            out.update((unit, array("i", x).tobytes()) for unit, x in zip(part, ids, strict=True))
        return out

    def _units(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts: a word stands for itself with a mark before it, what follows ``BARE`` for itself alone."""
        units = [p[1:] if p[:1] == BARE else self.space + p for p in parts]
        found = self.encode_units(units)
        return [found[u] for u in units]

    def parts(self, text: str) -> list[str]:
        """A normalised and marked text in parts that encode on their own."""
        text = self.normalized(text)
        if not text:
            return []
        if self.cut and text[0] == self.space and self.space * 2 not in text and text[-1] != self.space and BARE not in text:
            return text[1:].split(self.space)
        return [BARE + unit for unit in (self.cut(text) if self.cut else [text])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as strings of little-endian 32-bit numbers."""
        parts = pa.array(list(map(self.parts, texts)), pa.large_list(pa.large_string()))
        return self.table.ids(parts.flatten(), parts.offsets.to_numpy())

    def decode(self, ids: list[int] | np.ndarray) -> str:
        text = b"".join(self.bytes[np.asarray(ids, np.intp)].tolist()).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def codec(path: str) -> Codec:
    """One codec per worker and task."""
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    return worker_state(f"pieces {path}", lambda: Codec(path))


#: Rows of a batch that are Python objects at one time.
ROWS = 1_000
#: Texts encoded at once, in characters: bounds what a batch holds besides its texts.
CHUNK = 800_000


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def encode(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """Token ids of each whole text: ``doc_id``, the columns to keep, ``n_tokens, ids``.

    One row per input row; null and empty texts have no ids; an empty table gives an empty result.
    """
    docs = pick(docs, "doc_id", "text", *keep)
    kept = ["doc_id", *keep]

    def make() -> Callable:
        pieces = codec(path)

        def step(columns: dict[str, list]) -> dict[str, list]:
            ids = [np.frombuffer(x, "<i4") for chunk in _chunks([as_text(t) for t in columns["text"]]) for x in pieces.encode(chunk)]
            return {k: columns[k] for k in kept} | {"n_tokens": [len(i) for i in ids], "ids": ids}

        step.end = forget_state
        return step

    schema = StructType([*(docs.schema[k] for k in kept), StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType()))])
    return map_batches(docs, make, schema, ROWS)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts from token ids: ``doc_id, text``; null ids give a null text."""
    encoded = pick(encoded, "doc_id", "ids")

    def make() -> Callable:
        pieces = codec(path)
        return lambda columns: {"doc_id": columns["doc_id"], "text": [None if i is None else pieces.decode(i) for i in columns["ids"]]}

    return map_batches(encoded, make, StructType([encoded.schema["doc_id"], StructField("text", StringType())]))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Each text encoded and decoded again, as digests, in one pass.

    Returns ``doc_id, n_chars, n_tokens, ids_sha256`` (little-endian 32-bit ids), ``decoded_sha256``
    and ``round_trip`` (the decoded text is the text). A null text counts as an empty one.
    """
    docs = pick(docs, "doc_id", "text")

    def make() -> Callable:
        pieces = codec(path)

        def row(text: str, ids: bytes) -> tuple:
            decoded = pieces.decode(np.frombuffer(ids, "<i4"))
            return len(text), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), decoded == text

        def step(columns: dict[str, list]) -> dict[str, list]:
            texts = [as_text(t) for t in columns["text"]]
            rows = [row(t, i) for chunk in _chunks(texts) for t, i in zip(chunk, pieces.encode(chunk), strict=True)]
            names = ["n_chars", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
            return {"doc_id": columns["doc_id"]} | {n: [r[k] for r in rows] for k, n in enumerate(names)}

        step.end = forget_state
        return step

    schema = StructType([
        docs.schema["doc_id"], StructField("n_chars", LongType()), StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()), StructField("round_trip", BooleanType()),
    ])
    return map_batches(docs, make, schema, ROWS)
