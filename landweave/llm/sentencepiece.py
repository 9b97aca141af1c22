"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a Viterbi search in one pass.

At each place of a text the automaton's output links give all pieces that end there; each relaxes the best score of that place. Characters
that no piece covers cost ``UNKNOWN`` below the least score and become the pieces of their bytes. The best path has the largest sum of scores;
of equal ones the longest last piece wins, and so on backwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import text as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, UNKNOWN, KEPT = "▁", 10.0, 1 << 18


def load_pieces(model: str = MODEL) -> dict:
    """Ordinary pieces with ids and scores, and the ids of byte pieces, read on the driver (a vocabulary, about 1 MB)."""
    import sentencepiece

    with open(model, "rb") as file:
        model_bytes = file.read()
    processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes)
    pieces, in_bytes = [], [0] * 256
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            in_bytes[int(piece[3:5], 16)] = i
        elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
            pieces.append((piece, i, processor.get_score(i)))
    return {"pieces": pieces, "bytes": in_bytes}


class Kept(dict):
    """Ids of units that were searched before; emptied when full."""

    def __init__(self, search):
        self.search = search

    def __missing__(self, unit: str) -> list[int]:
        ids = self.search(unit)
        if len(self) >= KEPT:
            self.clear()
        if len(unit) <= 64:
            self[unit] = ids
        return ids


class Codec:
    """Encodes and decodes texts. Units between which no piece reaches are searched once and kept."""

    def __init__(self, vocabulary: dict):
        self.find = ahocorasick.Automaton()
        for piece, i, score in vocabulary["pieces"]:
            self.find.add_word(piece, (len(piece), i, score))
        self.find.make_automaton()
        self.in_bytes = vocabulary["bytes"]
        self.unknown = min(score for _, _, score in vocabulary["pieces"]) - UNKNOWN
        self.surface = {i: piece.replace(SPACE, " ").encode() for piece, i, _ in vocabulary["pieces"]} | {i: bytes([b]) for b, i in enumerate(self.in_bytes)}
        # A cut is safe before a space mark after another character and around a new line, unless some piece spans it.
        if any(re.search(rf"[^{SPACE}]{SPACE}|\n", piece) for piece, _, _ in vocabulary["pieces"]):
            raise ValueError("pieces cross units")
        self.units = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.kept = Kept(self.search)

    def search(self, unit: str) -> list[int]:
        n = len(unit)
        best, back = [0.0] + [-1e300] * n, [None] * (n + 1)
        done = 0  # places up to here are final
        for end, (size, i, score) in self.find.iter(unit):
            end += 1
            while done < end - 1:
                done += 1
                if (s := best[done - 1] + self.unknown) > best[done]:
                    best[done], back[done] = s, None
            s = best[end - size] + score
            if s > best[end]:
                best[end], back[end] = s, (size, i)
        while done < n:
            done += 1
            if (s := best[done - 1] + self.unknown) > best[done]:
                best[done], back[done] = s, None
        out, at = [], n
        while at:
            if back[at] is None:
                out.extend(self.in_bytes[b] for b in reversed(unit[at - 1].encode()))
                at -= 1
            else:
                out.append(back[at][1])
                at -= back[at][0]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """The ids of a text. Every space is a mark, and one stands in front; a mark that the text itself has becomes bytes."""
        if not text:
            return []
        out: list[int] = []
        for k, part in enumerate(text.split(SPACE)):
            if k:
                out.extend(self.in_bytes[b] for b in SPACE.encode())
            marked = part.replace(" ", SPACE) if k else SPACE + part.replace(" ", SPACE)
            out.extend(chain.from_iterable(map(self.kept.__getitem__, self.units.findall(marked))))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the mark in front if they start with one. An id that isn't in the vocabulary raises KeyError; bytes that are no UTF-8 raise ValueError."""
        surface = self.surface
        return b"".join(map(surface.__getitem__, ids)).removeprefix(b" ").decode("utf-8")


_CODEC: dict = {}


def codec(shared) -> Codec:
    """One codec a worker process."""
    if shared.key not in _CODEC:
        _CODEC.clear()
        _CODEC[shared.key] = Codec(shared.vocabulary.value)
    return _CODEC[shared.key]


class Shared:
    def __init__(self, spark: SparkSession, model: str):
        self.key, self.vocabulary = model, spark.sparkContext.broadcast(load_pieces(model))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per row: doc_id, ``token_ids``, ``n_tokens`` and ``restored``: whether decoding gives the text back.

    A null or empty text has no tokens. Repeated rows and ids give a row each. Other columns are ignored. Nothing is shuffled; the vocabulary,
    read by the driver from ``model``, is the only thing broadcast. Memory of a task: a slice of texts and the kept units.
    """
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared)
        for batch in T.chunks(batches, 1 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [own.encode(t) for t in texts]
            sizes = np.array([len(x) for x in ids])
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), T.lists(flat, sizes, pa.int32()), pa.array(sizes.astype(np.int64)), pa.array([own.decode(x) == t for x, t in zip(ids, texts, strict=True)])], ["doc_id", "token_ids", "n_tokens", "restored"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, token_ids array<int>, n_tokens long, restored boolean")


def decode(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and ``text`` of rows with doc_id and ``token_ids``; null or empty ids give an empty text."""
    shared = Shared(tokens.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return tokens.selectExpr("cast(doc_id as long) doc_id", "token_ids").mapInArrow(run, "doc_id long, text string")
