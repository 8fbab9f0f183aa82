"""Byte-level BPE: pre-tokens as arrays, the tokenizers library over the distinct ones, exact decoding."""

from __future__ import annotations

import base64
import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm.arrays import blocks, equal_spans, mix, ragged, span_hashes, sums_by, text_blocks
from holdfast.llm.tables import texts

#: A task is one thread: Spark runs as many as there are cores.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

OTHER, LETTER, NUMBER, SPACE = range(4)
#: Distinct pre-tokens a task remembers; at twice as many slots, more are encoded again.
SLOTS = 1 << 20
#: Most ids, pre-tokens and characters of them a task remembers before it starts afresh.
MEMORY_IDS, MEMORY_ENTRIES, MEMORY_POINTS = 1 << 22, 1 << 20, 1 << 23


@lru_cache(1)
def byte_characters() -> list[str]:
    """The visible character of each byte: itself where printable, else from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(1)
def _classes() -> np.ndarray:
    """Letter, number, space or other of every code point."""
    table = np.zeros(0x110000, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, everything):
            table[points[m.start()] : points[m.end() - 1] + 1] = kind
    return table


@lru_cache(1)
def _codes() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64))


def code_points(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts end to end, and where each text begins (with the end)."""
    first = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(t) for t in docs], out=first[1:])
    return np.frombuffer("".join(docs).encode("utf-32-le"), np.uint32), first


def pre_tokens(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Start of every pre-token of the texts.

    The pattern cuts where the class changes; a blank joins what follows it, white space keeps
    its last character apart from a word behind it, and an apostrophe alone takes a
    contraction's letters.
    """
    n = len(points)
    kind = _classes()[points]
    at_text = np.zeros(n + 1, bool)
    at_text[first] = True
    start = at_text.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    runs = np.flatnonzero(start[:n])
    ends = np.append(runs[1:], n)
    space = (kind[runs] == SPACE) & ~at_text[ends]
    last = ends[space] - 1
    start[last] = True
    start[ends[space][points[last] == 32]] = False
    quote = runs[(kind[runs] == OTHER) & (ends - runs == 1) & (points[runs] == 39) & start[runs] & ~at_text[ends]]
    if len(quote):
        padded = np.append(points, [0, 0, 0])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b)) & ~at_text[np.minimum(quote + 2, n)]
        took = quote[short | pair]
        start[took + 1] = False
        start[took + np.where(short, 2, 3)[short | pair]] = True
    return np.flatnonzero(start[:n])


class Memory:
    """Values of distinct pre-tokens, in a table of fixed size; what it lost is made again.

    A hash finds the slot; the characters kept there decide whether it holds the pre-token.
    ``make`` takes pre-tokens and gives their ids end to end with the number of each.
    """

    def __init__(self, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], slots: int = SLOTS):
        self.make, self.slots = make, slots
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(self.slots, np.uint64)
        self.entry = np.zeros(self.slots, np.int64)
        self.n = self.used = self.spelt = 0
        self.begin, self.length, self.at, self.size = (np.zeros(1 << 16, np.int64) for _ in range(4))
        self.flat, self.points = np.zeros(1 << 18, np.uint32), np.zeros(1 << 18, np.uint32)

    def look_up(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Entry of each span of code points; a span ends where the next begins."""
        cuts = pa.py_buffer(4 * np.append(starts, len(points)))
        spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, cuts, pa.py_buffer(np.ascontiguousarray(points))])
        numbered = spans.dictionary_encode()
        if not len(numbered):
            return np.zeros(0, np.int64)
        _, ends, data = numbered.dictionary.buffers()
        ends = np.frombuffer(ends, np.int64, len(numbered.dictionary) + 1) // 4
        distinct = np.frombuffer(data, np.uint32, ends[-1])
        return self._entries(distinct, ends[:-1], ends[1:])[numbered.indices.to_numpy()]

    def _entries(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.used > MEMORY_IDS or self.n > MEMORY_ENTRIES or self.spelt > MEMORY_POINTS:
            self.clear()
        sizes = ends - starts
        hashes = span_hashes(_codes()[points], starts, ends)
        slot = (hashes % np.uint64(self.slots)).astype(np.int64)
        entry = self.entry[slot]
        held = np.flatnonzero((self.key[slot] == hashes) & (self.size[entry] == sizes))
        same = equal_spans(points, starts[held], self.points, self.at[entry[held]], sizes[held])
        known = np.zeros(len(starts), bool)
        known[held[same]] = True
        lost = np.flatnonzero(~known)
        while len(lost):  # one pre-token of each hash a turn
            new, one, back = np.unique(hashes[lost], return_index=True, return_inverse=True)
            one = lost[one]
            spelling = points[ragged(starts[one], sizes[one])]
            text = spelling.tobytes().decode("utf-32-le")
            cuts = np.concatenate([[0], np.cumsum(sizes[one])]).tolist()
            made, lengths = self.make([text[a:b] for a, b in zip(cuts, cuts[1:])])
            entries = self._store(made, lengths, spelling, sizes[one])
            self.key[slot[one]], self.entry[slot[one]] = new, entries
            like = one[back]
            same = sizes[lost] == sizes[like]
            same[same] = equal_spans(points, starts[lost[same]], points, starts[like[same]], sizes[lost[same]])
            entry[lost[same]] = entries[back[same]]
            lost = lost[~same]
        return entry

    def _store(self, made: np.ndarray, lengths: np.ndarray, spelling: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        entries = self.n + np.arange(len(lengths))
        need = dict.fromkeys(("begin", "length", "at", "size"), self.n + len(lengths))
        for name, n in (need | {"flat": self.used + len(made), "points": self.spelt + len(spelling)}).items():
            held = getattr(self, name)
            if n > len(held):
                setattr(self, name, np.concatenate([held, np.zeros(max(n, len(held)), held.dtype)]))
        self.flat[self.used : self.used + len(made)] = made
        self.points[self.spelt : self.spelt + len(spelling)] = spelling
        self.begin[entries] = self.used + np.cumsum(lengths) - lengths
        self.at[entries] = self.spelt + np.cumsum(sizes) - sizes
        self.length[entries], self.size[entries] = lengths, sizes
        self.n, self.used, self.spelt = self.n + len(lengths), self.used + len(made), self.spelt + len(spelling)
        return entries


class Encoder:
    """Ids of whole texts by a byte-level tokenizer, as the library gives them."""

    def __init__(self, source: str):
        self.whole = Tokenizer.from_str(source)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.memory = Memory(self._make)

    def _make(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lengths = [], []
        for i in range(0, len(tokens), 4096):
            for e in self.whole.encode_batch_fast(tokens[i : i + 4096], add_special_tokens=False):
                own = e.ids
                ids += own
                lengths.append(len(own))
        return np.array(ids, np.uint32), np.array(lengths, np.int64)

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end and the range of each text; texts that hold a special token's string
        go to the library whole."""
        direct = [i for i, t in enumerate(docs) if any(s in t for s in self.special)]
        plain = [*docs]
        for i in direct:
            plain[i] = ""
        points, first = code_points(plain)
        starts = pre_tokens(points, first)
        entry = self.memory.look_up(points, starts)
        lengths = self.memory.length[entry]
        ids = self.memory.flat[ragged(self.memory.begin[entry], lengths)]
        counts = sums_by(np.searchsorted(starts, first), lengths)
        if direct:
            cuts = np.split(ids, np.cumsum(counts)[:-1])
            for i in direct:
                cuts[i] = np.array(self.whole.encode(docs[i], add_special_tokens=False).ids, np.uint32)
            ids, counts = np.concatenate(cuts), np.array([len(c) for c in cuts], np.int64)
        return ids, np.concatenate([[0], np.cumsum(counts)])


@lru_cache(4)
def encoder(source: str) -> Encoder:
    """One encoder a worker process, with what it remembers."""
    return Encoder(source)


def load_ranks(path: str) -> str:
    """A tokenizer of the library from a rank file: pre-tokens come cut, so it maps bytes alone.

    Each token of two bytes or more was made from the two parts that lower ranks leave of it.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    letters = byte_characters()
    name = {token: "".join(letters[b] for b in token) for token in ranks}
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        if len(token) > 1:
            left, right = _parts(token, rank, ranks)
            merges.append([name[left], name[right]])
    steps = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
    model = {"type": "BPE", "vocab": {name[t]: r for t, r in ranks.items()}, "merges": merges}
    return json.dumps({"version": "1.0", "added_tokens": [], "pre_tokenizer": steps, "decoder": steps, "model": model})


def _parts(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        low, at = min((ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if low >= rank:
            raise ValueError(f"no merges lead to the token of rank {rank}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class Decoder:
    """Bytes of ids, from the tokenizer's vocabulary by the byte table read backwards."""

    def __init__(self, source: str):
        tokenizer = Tokenizer.from_str(source)
        back = {c: b for b, c in enumerate(byte_characters())}
        special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
        tokens = [b""] * (1 + max(tokenizer.get_vocab().values(), default=-1))
        for token, i in tokenizer.get_vocab().items():
            tokens[i] = special[i] if i in special else bytes(back[c] for c in token)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of the ids and the byte offset at which each begins. A character may be split
        between ids: bytes are joined before anyone reads them as text."""
        lengths = self.length[ids]
        return self.flat[ragged(self.begin[ids], lengths)].tobytes(), np.cumsum(lengths) - lengths


@lru_cache(4)
def decoder(source: str) -> Decoder:
    return Decoder(source)


def encoded_blocks(batches: Iterator[pa.RecordBatch], source: str):
    """(keys, ids, ranges) for blocks of rows of (key, text)."""
    for batch in batches:
        for lo, hi, data in text_blocks(batch.column(1)):
            ids, ranges = encoder(source).encode([t.decode() for t in data])
            yield batch.column(0).slice(lo, hi - lo), ids, ranges


def encode(docs: DataFrame, source: str) -> DataFrame:
    """Ids of every row (little-endian, 32 bits each). ``source`` is a tokenizer as JSON text.

    Null text: as empty, no ids. Repeated rows stay. Empty table: no rows.
    """
    spread = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, ranges in encoded_blocks(batches, spread.value):
            each = [ids[a:b].astype("<u4").tobytes() for a, b in zip(ranges, ranges[1:])]
            yield pa.record_batch([keys, pa.array(each, pa.binary())], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def _decoded(ids: np.ndarray, source: str) -> tuple[bytes, np.ndarray, int]:
    """Bytes, offsets and how many ids begin inside a character."""
    data, offsets = decoder(source).decode(ids)
    inside = np.frombuffer(data, np.uint8)[offsets] & 0xC0 == 0x80 if data else np.zeros(0)
    return data, offsets, int(inside.sum())


def decode(encoded: DataFrame, source: str) -> DataFrame:
    """Bytes of every row's ids, the byte offset of each id (little-endian, 64 bits) and the
    number of ids that begin inside a character. Null ids give no bytes."""
    spread = encoded.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for lo, hi in blocks(ids, size=lambda x: len(x or b"")):
                data, offsets, inside = zip(*(_decoded(np.frombuffer(x or b"", "<u4"), spread.value) for x in ids[lo:hi]))
                offsets = [x.astype("<i8").tobytes() for x in offsets]
                made = [pa.array(data, pa.binary()), pa.array(offsets, pa.binary()), pa.array(inside, pa.int64())]
                kept = batch.slice(lo, hi - lo)
                yield pa.record_batch([kept.column(0), kept.column(1), *made], names=["doc_id", "ids", "decoded", "offsets", "n_split"])

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids binary, decoded binary, offsets binary, n_split long"
    )


def round_trip(docs: DataFrame, source: str) -> DataFrame:
    """Digests of the ids of every row and of the bytes they decode to; both are made in one
    pass of a task, with the cases of ``encode``."""
    spread = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, ranges in encoded_blocks(batches, spread.value):
            each = [ids[a:b] for a, b in zip(ranges, ranges[1:])]
            data, _, inside = zip(*(_decoded(x, spread.value) for x in each))
            made = [pa.array([x.astype("<u4").tobytes() for x in each], pa.binary()), pa.array(data, pa.binary()), pa.array(inside, pa.int64())]
            yield pa.record_batch([keys, *made], names=["doc_id", "ids", "decoded", "n_split"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, decoded binary, n_split long").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("n_split").alias("n_split_tokens"),
    )


def rank_file(path: str | None = None) -> str:
    """The rank file at ``path`` as a tokenizer."""
    return load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))


def json_file(path: str | None = None) -> str:
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()
