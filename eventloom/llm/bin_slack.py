"""Packing documents into fixed windows by minimum bin slack.

Each task packs the documents of its partition in buffers of bounded size; nothing is shuffled. A document
longer than a window gives whole windows first. What remains, with all shorter documents, is a multiset of
lengths below the window. For each next sequence the longest remaining length is taken, and a subset-sum
over the remaining lengths, held as the bits of one integer, finds the multiset that fills the window
closest to its capacity; walking the recorded steps back gives how many of each length it takes.

Slack beyond a tolerance is closed by cutting one more piece. The last sequence of a buffer is cut at powers
of two, at which sequences need no padding.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm.words import Known

CAPACITY = 4096
# A buffer is packed once it holds so many tokens. Its memory is four bytes a token.
BUFFER_TOKENS = 1 << 22
# Padding that is left rather than cutting another document: 0.2 % of a window.
MAX_SLACK = 8
# Chunks and words that a worker keeps the tokens of: about 400 MB together at most.
MAX_CHUNKS, MAX_WORDS = 600_000, 1_200_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def fill(lengths: list[int], count: Callable[[int], int], capacity: int) -> dict[int, int]:
    """How many of each of the ascending ``lengths``, of which there are ``count(length)``, add up closest to
    ``capacity`` from below.

    Bit s of an integer says that sum s can be reached. Every length is offered in lots of 1, 2, 4 and so on,
    so that any number of it can be made; the search ends once the capacity itself is reached.
    """
    within = (1 << capacity + 1) - 1
    reach, steps = 1, []
    for k in range(bisect_right(lengths, capacity) - 1, -1, -1):
        length = lengths[k]
        left, lot = min(count(length), capacity // length), 1
        while left and not reach >> capacity:
            n = min(lot, left)
            steps.append((length, n, reach))
            reach |= reach << length * n & within
            left, lot = left - n, lot * 2
        if reach >> capacity:
            break
    taken: dict[int, int] = {}
    at = reach.bit_length() - 1
    for length, n, before in reversed(steps):
        if not before >> at & 1:  # this sum needs the lot
            taken[length] = taken.get(length, 0) + n
            at -= length * n
    return taken


def powers(length: int, capacity: int) -> list[int]:
    """Sequence lengths that hold so many tokens without padding."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    return out + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class _Waiting:
    """Pieces below a window, by length."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.lengths: list[int] = []  # ascending
        self.total = 0

    def put(self, doc: int, start: int, length: int) -> None:
        if length not in self.by_length:
            insort(self.lengths, length)
            self.by_length[length] = []
        self.by_length[length].append((doc, start))
        self.total += length

    def take(self, length: int) -> tuple[int, int, int]:
        doc, start = self.by_length[length].pop()
        if not self.by_length[length]:
            del self.by_length[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.total -= length
        return doc, start, length

    def count(self, length: int) -> int:
        return len(self.by_length[length])


def pack(lengths: list[int], capacity: int = CAPACITY, max_slack: int = MAX_SLACK) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) pieces over documents with these many tokens."""
    out: list[list[tuple[int, int, int]]] = []
    waiting = _Waiting()
    for doc in range(len(lengths) - 1, -1, -1):  # take() then finds documents in their order
        whole = lengths[doc] // capacity * capacity
        out += [[(doc, start, capacity)] for start in range(0, whole, capacity)]
        if lengths[doc] > whole:
            waiting.put(doc, whole, lengths[doc] - whole)
    while waiting.total >= capacity:
        pieces = [waiting.take(waiting.lengths[-1])]
        slack = capacity - pieces[0][2]
        for length, n in fill(waiting.lengths, waiting.count, slack).items():
            pieces += [waiting.take(length) for _ in range(n)]
            slack -= length * n
        while slack > max_slack and waiting.lengths:  # no remaining length fits, so each is longer than the slack
            doc, start, length = waiting.take(waiting.lengths[0])
            pieces.append((doc, start, n := min(length, slack)))
            if n < length:
                waiting.put(doc, start + n, length - n)
            slack -= n
        out.append(pieces)
    rest = [waiting.take(waiting.lengths[-1]) for _ in range(sum(map(len, waiting.by_length.values())))]
    for size in powers(sum(n for _, _, n in rest), capacity):
        pieces = []
        while size:
            doc, start, n = rest.pop()
            pieces.append((doc, start, k := min(n, size)))
            if k < n:
                rest.append((doc, start + k, n - k))
            size -= k
        out.append(pieces)
    return out


# A chunk of letters with no other form than their lower case, then of signs that start no contraction.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
_LETTERS = "".join(chr(c) for c in range(0x180) if _PLAIN.fullmatch(chr(c)) and _PLAIN.fullmatch(chr(c))[1])


class _Filled(Known):
    """Looks only the missing values up again."""

    def of(self, words: list) -> list[bytes]:
        found = list(map(self.values.get, words))
        holes = [k for k, value in enumerate(found) if value is None]
        if holes:
            if len(self.values) > self.max_words:
                self.values = {}
            new = list(dict.fromkeys([words[k] for k in holes]))
            learnt = dict(zip(new, self.learn(new), strict=True))
            self.values.update(learnt)
            for k in holes:
                found[k] = learnt[words[k]]
        return found


class Encoder:
    """Token ids of whole texts as little-endian bytes.

    The vocabulary never joins what white space parts, so a text's ids are those of its chunks between ASCII
    white space, one after the other. A batch of texts is split and its different chunks are found in Arrow; only those are looked
    up, and their ids dealt out by place. A chunk that is a plain word with signs behind it has the ids of the
    lower-case word and of the signs, which many chunks share.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to the tasks
        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[k for w, k in vocabulary.items() if w.endswith("</w>")]] = True
        self.end = np.array([end], "<u4").tobytes()
        # Lower-case words are fewer than chunks and cost most to encode.
        self.chunks, self.words, self.signs = _Filled(self.learn, MAX_CHUNKS), _Filled(self.learn_words, MAX_WORDS), _Filled(self.learn_signs, MAX_CHUNKS)

    def encode(self, text: bytes | None) -> bytes:
        """Of a text in UTF-8."""
        return self.encode_all(pa.array([text], pa.binary()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Of texts in UTF-8, an array of binary values."""
        validity, offsets, data = texts.buffers()
        seen = pc.fill_null(pa.StringArray.from_buffers(len(texts), offsets, data, validity, texts.null_count, texts.offset), "")
        split = pc.ascii_split_whitespace(seen)
        coded = split.flatten().dictionary_encode()
        known, first, second = self.parts(coded.dictionary)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, starts = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        parts = np.empty(2 * len(at), np.int64)
        parts[0::2], parts[1::2] = first[at], second[at]
        each = sizes[parts]
        until = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(starts[parts] - until[:-1], each) + np.arange(until[-1])]
        ends = until[2 * np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])]
        return [ids[a:b].tobytes() + self.end for a, b in itertools.pairwise(ends.tolist())]

    def parts(self, chunks: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The ids of the words, the signs and the other chunks among some different ones, and for each chunk which two of them it is."""
        heads = pc.utf8_rtrim(chunks, characters=_SIGNS)
        plain = pc.match_substring_regex(heads, "^[A-Za-zÀ-ÖØ-öø-ÿ]+$")
        words = pc.utf8_lower(heads.filter(plain)).dictionary_encode()
        signs = pc.utf8_ltrim(chunks.filter(plain), characters=_LETTERS).dictionary_encode()
        others = chunks.filter(pc.invert(plain)).cast(pa.binary()).to_pylist()
        known = [*self.words.of(words.dictionary.to_pylist()), *self.signs.of(signs.dictionary.to_pylist()), *self.chunks.of(others), b""]
        is_plain, n_words, n_signs = plain.to_numpy(zero_copy_only=False), len(words.dictionary), len(signs.dictionary)
        first, second = np.empty(len(chunks), np.int64), np.full(len(chunks), len(known) - 1, np.int64)
        first[is_plain], second[is_plain] = words.indices.to_numpy(), n_words + signs.indices.to_numpy()
        first[~is_plain] = n_words + n_signs + np.arange(len(others))
        return known, first, second

    def one(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """White space leaves empty chunks at the ends of a text, which have no ids."""
        return [self.one(c.decode()) for c in chunks]

    def learn_signs(self, signs: list[str]) -> list[bytes]:
        return [self.one(x) for x in signs]

    def learn_words(self, words: list[str]) -> list[bytes]:
        """Encodes some hundred words as one text; each of them ends with the first token that ends a word."""
        out: list[bytes] = []
        parts = [words[k:k + 200] for k in range(0, len(words), 200)]
        for part, made in zip(parts, self.model.encode_batch_fast([" ".join(part) for part in parts], add_special_tokens=False), strict=True):
            ids = np.array(made.ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part):
                out += [self.one(w) for w in part]
            else:
                raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                out += [raw[a:b] for a, b in itertools.pairwise(cuts)]
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str, end: int) -> Encoder:
    return Encoder(path, end)


@dataclass(frozen=True)
class Packer:
    tokenizer: str
    end_id: int
    capacity: int
    max_slack: int
    buffer_tokens: int
    with_ids: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = encoder(self.tokenizer, self.end_id)
        next_id = TaskContext.get().partitionId() << 40
        docs, ids, held = [], [], 0
        for batch in batches:
            for doc, own in zip(batch.column(0).to_pylist(), words.encode_all(batch.column(1)), strict=True):
                docs.append(doc)
                ids.append(own)
                held += len(own) // 4
                if held >= self.buffer_tokens:
                    made, next_id = self.packed(docs, ids, next_id)
                    yield from made
                    docs, ids, held = [], [], 0
        if docs:
            yield from self.packed(docs, ids, next_id)[0]

    def packed(self, docs: list, ids: list[bytes], next_id: int) -> tuple[list[pa.RecordBatch], int]:
        rows = []
        for pieces in pack([len(x) // 4 for x in ids], self.capacity, self.max_slack):
            at = 0
            for doc, start, n in pieces:
                own = ids[doc][4 * start:4 * (start + n)]
                rows.append((docs[doc], start, n, zlib.crc32(own), len(ids[doc]) // 4, next_id, at, own if self.with_ids else None))
                at += n
            next_id += 1
        names = [c.split()[0] for c in PIECES.split(", ")]
        made = pa.RecordBatch.from_arrays([pa.array(values, pa.binary() if name == "ids" else pa.int64())
                                           for name, values in zip(names, zip(*rows, strict=True), strict=True)], names)
        return [made.slice(k, 10_000) for k in range(0, made.num_rows, 10_000)], next_id


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           max_slack: int = MAX_SLACK, buffer_tokens: int = BUFFER_TOKENS, with_ids: bool = True) -> DataFrame:
    """One row per piece: document, its place in the document's ids and in its sequence, checksum and the ids
    themselves (little-endian, 32 bits each; null unless ``with_ids``).

    ``tokenizer`` is the path of a tokenizer file that every executor can open and that, as word-level BPE
    does, treats each run between white space for itself. Each document is encoded whole and ``end_id``
    appended; a null or empty text has that id only. Rows are packed as they come: repeated rows and ids are
    packed again, a null id stays null. Other columns are ignored; an empty table gives no pieces. Sequence
    ids are unique and hold the partition's number, so a retried task gives the same ones.
    """
    packer = Packer(tokenizer, end_id, capacity, max_slack, buffer_tokens, with_ids)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(packer, PIECES)
