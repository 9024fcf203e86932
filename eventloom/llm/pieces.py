"""Encoding into subword pieces that keeps every piece's place in the original bytes, and decoding.

A text is normalised first: at each place the longest prefix that the model's compiled character map knows is
replaced, and for every byte of the result the source offset is recorded. The normalised text is cut where no
piece of the vocabulary reaches across (before white space that follows something else, and around line
ends); each distinct segment is encoded once by the model and kept by the worker. A piece's span in the
normalised text, taken through the record, is its span in the source.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from eventloom.llm.words import Known

SPACE = "▁"
_REPLACEMENT = "�"
NAMES = ["ids", "begins", "ends"]
# Segments that a worker keeps the pieces of: some 60 MB.
MAX_SEGMENTS = 200_000


class CharacterMap:
    """The compiled map: a double-array trie over the sources, whose values point into the replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.replacements = compiled[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``text`` from ``at`` on."""
        units, found = self.units, None
        node = self._below(units[0], 0)
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node = self._below(unit, node)
            if unit >> 8 & 1:  # a source ends here
                found = k + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.replacements[found[1]:self.replacements.index(b"\0", found[1])]

    @staticmethod
    def _below(unit: int, node: int) -> int:
        return node ^ (unit >> 10 << ((unit & 1 << 9) >> 6))


class Encoder:
    """A model file with its own normalisation; spaces stay spaces until the model sees a segment."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = proto.ModelProto.FromString(file.read())
        spec = model.normalizer_spec
        if model.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("only models that mark white space in front of words")
        if any(p.type == proto.ModelProto.SentencePiece.USER_DEFINED for p in model.pieces):
            raise ValueError("no models with pieces that users defined: they escape normalisation")
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = b"", False, False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        # White space is one byte here, wherever it came from.
        self.size = np.array([1 if p.type == proto.ModelProto.SentencePiece.BYTE else len(p.piece.replace(SPACE, " ").encode())
                              for p in model.pieces])
        self.unknown = self.model.unk_id()
        self.falls_back = model.trainer_spec.byte_fallback
        self.cuts = None if any(SPACE in p.piece.lstrip(SPACE) or "\n" in p.piece for p in model.pieces) \
            else re.compile(r" *[^ \n]+| +|\n")
        self.known = Known(self.learn, MAX_SEGMENTS)

    def learn(self, segments: list[str]) -> list[bytes]:
        """For each segment its ids, each with the bytes of its piece."""
        found = self.model.encode(segments, num_threads=1)
        ids = np.fromiter(itertools.chain.from_iterable(found), "<u4")
        if self.falls_back or not (ids == self.unknown).any():
            sizes = self.size[ids]
        else:
            sizes = np.concatenate([self.sizes(x, np.array(own)) for x, own in zip(segments, found, strict=True) if own])
        raw = np.stack([ids, sizes], 1).astype("<u4").tobytes()
        cuts = [0, *itertools.accumulate(8 * len(own) for own in found)]
        return [raw[a:b] for a, b in itertools.pairwise(cuts)]

    def sizes(self, segment: str, ids: np.ndarray) -> np.ndarray:
        """The bytes of each piece. Without fallback an unknown piece takes all characters up to the next known piece."""
        if not (ids == self.unknown).any():
            return self.size[ids]
        spans = self.model.encode(segment, out_type="immutable_proto").pieces
        ends = np.array([len(segment[:p.end].encode()) for p in spans])
        return np.diff(ends, prepend=0)

    def normalised(self, text: str) -> tuple[str, np.ndarray | None]:
        """The text as pieces see it, and for each of its bytes and its end the offset in the source's bytes;
        None for an offset of the prefix alone."""
        if self.map is None and not self.squeeze and SPACE not in text:
            return (" " + text if self.prefix and text else text), None
        raw, out, align, at = text.encode(), bytearray(), [], 0
        marked, after_space = SPACE.encode(), self.squeeze
        while at < len(raw):
            n, new = (self.map.longest(raw, at) if self.map else None) or self._character(raw, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:  # a space that the text marks itself is not squeezed
                after_space = self.squeeze and new.endswith(b" ")
                new = new.replace(marked, b" ")
                out += new
                align += [at] * len(new)
            at += n
        end = len(raw)
        while self.squeeze and out[-1:] == b" ":
            end = align.pop()
            del out[-1]
        if self.prefix and (out or raw and not self.squeeze):
            out[:0], align[:0] = b" ", align[:1] or [0]
        return out.decode(), np.array([*align, end])

    @staticmethod
    def _character(raw: bytes, at: int) -> tuple[int, bytes]:
        lead = raw[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, raw[at:at + n]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each piece begins and ends in the UTF-8 bytes of the text."""
        normal, align = self.normalised(text or "")
        segments = self.cuts.findall(normal) if self.cuts else [normal] if normal else []
        flat = np.frombuffer(b"".join(self.known.of(segments)), "<u4").reshape(-1, 2)
        ends = np.cumsum(flat[:, 1], dtype=np.int64)
        begins = ends - flat[:, 1]
        if align is None:
            shift = int(self.prefix)
            return flat[:, 0], np.maximum(begins - shift, 0), np.maximum(ends - shift, 0)
        return flat[:, 0], align[begins], align[ends]

    def decode(self, ids: list[int]) -> str:
        return self.decoder.decode(ids)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker, which serves many tasks."""
    return Encoder(path)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)))


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Adds ``ids``, ``begins`` and ``ends`` (arrays of int) to each row.

    ``model`` is the path of a sentencepiece model that every executor can open. The ids are the library's for
    the whole text, without begin or end ids. ``begins`` and ``ends`` give each piece's bytes in the source:
    a piece of a replaced character has the span of what was replaced, a fallback byte its own byte, a prefix
    that the model adds no bytes. A null text counts as empty and gives empty arrays. Rows are encoded one by
    one, so ties and repeated rows change nothing; columns named like the new ones are replaced. A text of any
    length is encoded whole; an empty table gives no rows.
    """
    keep = [f for f in docs.schema.fields if f.name.lower() not in NAMES]
    place = next(k for k, f in enumerate(docs.schema.fields) if f.name == text)
    own = [docs.columns.index(f.name) for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in batches:
            made = [coder.encode(t) for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in own), *(_lists([m[k] for m in made]) for k in range(3))],
                                             [*(f.name for f in keep), *NAMES])

    schema = T.StructType(list(keep))
    for name in NAMES:
        schema = schema.add(name, T.ArrayType(T.IntegerType()))
    return docs.mapInArrow(run, schema)


def decoded(ids: str | Column, model: str) -> Column:
    """The text that the library decodes from an array of ids; of a null, the empty text."""

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        coder = encoder(model)
        return pd.Series([coder.decode([] if r is None else r.tolist()) for r in rows], dtype=object)

    return run(ids)
