"""Token counts of a piece model: merges by rank, for all pre-tokens of a batch at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from holdfast.llm.arrays import sums_by, text_blocks
from holdfast.llm.bpe import Memory, code_points
from holdfast.llm.tables import texts

LIMIT = 4096
#: A sequence that is not done after so many rounds goes on with a queue of its pairs, so that a
#: merge costs no further pass over it.
ROUNDS = 64
SPACE_MARK = 0x2581
_NO_MERGE = np.iinfo(np.int64).max


@dataclass
class Merges:
    """Symbols and merges of a model. ``pairs`` are sorted keys ``left * n + right``."""

    chars: np.ndarray
    char_symbol: np.ndarray
    cost: np.ndarray
    pairs: np.ndarray
    result: np.ndarray
    rank: np.ndarray
    settles: np.ndarray
    joined: np.ndarray
    dealt: dict[int, tuple[int, int]] = field(default_factory=dict)

    def by_pair(self) -> dict[int, tuple[int, int]]:
        """Rank and result of each pair."""
        if not self.dealt:
            self.dealt.update(zip(self.pairs.tolist(), zip(self.rank.tolist(), self.result.tolist())))
        return self.dealt


@lru_cache(2)
def load(path: str) -> Merges:
    """Merge tables of a BPE model with byte fallback."""
    model = SentencePieceProcessor(model_file=path)
    scores = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            scores[model.id_to_piece(i)] = model.get_score(i)
    if not any(model.is_byte(i) for i in range(model.get_piece_size())):
        raise ValueError("the model has no byte pieces for characters it does not know")
    symbols = sorted(set(scores) | {c for p in scores for c in p})
    number = {p: i for i, p in enumerate(symbols)}
    n = len(symbols)
    order = {s: r for r, s in enumerate(sorted({scores[p] for p in scores}, reverse=True))}
    rows = [
        (number[p[:k]] * n + number[p[k:]], number[p], order[s])
        for p, s in scores.items()
        for k in range(1, len(p))
        if p[:k] in number and p[k:] in number
    ]
    pairs, result, rank = (np.array(x, np.int64) for x in zip(*sorted(rows))) if rows else (np.zeros(0, np.int64),) * 3
    best = np.full(n, _NO_MERGE)
    np.minimum.at(best, pairs // n, rank)
    np.minimum.at(best, pairs % n, rank)
    chars = np.array(sorted({ord(c) for p in symbols for c in p}), np.int64)
    return Merges(
        chars, np.array([number[chr(c)] for c in chars], np.int64),
        np.array([1 if p in scores else len(p.encode()) for p in symbols], np.int64),
        pairs, result, rank, rank < best[result],
        np.unique([ord(a) << 32 | ord(b) for p in scores for a, b in zip(p, p[1:])]),
    )


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)


def _pair(m: Merges, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of each pair's merge, or -1."""
    at, known = _find(m.pairs, left * len(m.cost) + right)
    return np.where(known & (left >= 0) & (right >= 0), at, -1)


def merge(m: Merges, points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Pieces of each sequence ``first[i]:first[i + 1]`` of characters, counted after all merges.

    Each round finds every sequence's lowest rank and applies it: at all places at once where
    no merge made by it can come before it, else at the leftmost. A character the model does
    not know costs its bytes.
    """
    at, known = _find(m.chars, points.astype(np.int64))
    symbol = np.where(known, m.char_symbol[at], -1)
    unknown = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    cost = np.where(known, m.cost[symbol], unknown)
    total = np.zeros(len(first) - 1, np.int64)
    who = np.arange(len(total))
    lengths = np.diff(first)
    for _ in range(ROUNDS):
        if not len(symbol):
            return total
        ends = np.cumsum(lengths)
        pair = np.full(len(symbol), -1)
        pair[:-1] = _pair(m, symbol[:-1], symbol[1:])
        pair[ends - 1] = -1
        rank = np.where(pair >= 0, m.rank[pair], _NO_MERGE)
        lowest = np.minimum.reduceat(rank, ends - lengths)
        hit = np.flatnonzero((rank == np.repeat(lowest, lengths)) & (pair >= 0))
        owner = np.searchsorted(ends, hit, side="right")
        lead = np.ones(len(hit), bool)
        lead[1:] = owner[1:] != owner[:-1]
        # the same merge, not overlapping the one before it
        all_settle = m.settles[pair[hit]] & (pair[hit] == pair[hit[np.maximum.accumulate(np.where(lead, np.arange(len(hit)), 0))]])
        run = np.ones(len(hit), bool)
        run[1:] = hit[1:] - hit[:-1] != 1
        within = np.arange(len(hit)) - np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        taken = hit[lead | (all_settle & (within % 2 == 0))]
        symbol[taken] = m.result[pair[taken]]
        cost[taken] = m.cost[symbol[taken]]
        keep = np.ones(len(symbol), bool)
        keep[taken + 1] = False
        done = lowest == _NO_MERGE
        if done.any():
            total[who[done]] = np.add.reduceat(cost, ends - lengths)[done]
            keep &= ~np.repeat(done, lengths)
        lengths = np.add.reduceat(keep, ends - lengths, dtype=np.int64)
        symbol, cost = symbol[keep], cost[keep]
        who, lengths = who[~done], lengths[~done]
    at = np.concatenate([[0], np.cumsum(lengths)]).tolist()
    for i, lo, hi in zip(who.tolist(), at, at[1:]):
        total[i] = _queued(m, symbol[lo:hi], cost[lo:hi])
    return total


def _queued(m: Merges, symbols: np.ndarray, costs: np.ndarray) -> int:
    """Pieces of one sequence after all its merges: the lowest rank of the queue next, the
    leftmost among equals. Symbols are a linked list, so a merge only touches its neighbours."""
    n, of = len(m.cost), m.by_pair()
    symbol, after, before = symbols.tolist(), [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)]
    def offer(i: int) -> tuple | None:
        j = after[i]
        found = of.get(symbol[i] * n + symbol[j]) if j >= 0 and symbol[i] >= 0 and symbol[j] >= 0 else None
        return (found[0], i, symbol[i], symbol[j]) if found else None

    queue = [x for i in range(len(symbol)) if (x := offer(i))]
    heapify(queue)
    alive = bytearray(b"\1" * len(symbol))
    while queue:
        _, i, left, right = heappop(queue)
        j = after[i]
        if j < 0 or symbol[i] != left or symbol[j] != right or not alive[i]:
            continue  # one of the two has changed since
        symbol[i] = of[left * n + right][1]
        alive[j] = 0
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (x := offer(k)):
                heappush(queue, x)
    last = np.array(symbol)
    return int(np.where(last == symbols, costs, m.cost[last])[np.frombuffer(alive, bool)].sum())


class Counter:
    """Token counts of texts; the pieces of a distinct pre-token are counted once a worker."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        self.merges = load(path)
        self.memory = Memory(self._count)

    def _count(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, first = code_points(tokens)
        return np.zeros(0, np.uint32), merge(self.merges, points, first)

    def counts(self, docs: list[str]) -> np.ndarray:
        normal = [self.model.normalize(t) for t in docs]
        points, first = code_points(normal)
        starts = self._cuts(points, first)
        entry = self.memory.look_up(points, starts)
        return sums_by(np.searchsorted(starts, first), self.memory.length[entry])

    def _cuts(self, points: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Starts of pre-tokens: before a space mark, and between characters that no piece joins."""
        cut = np.zeros(len(points) + 1, bool)
        if len(points) > 1:
            pairs = points[:-1].astype(np.int64) << 32 | points[1:]
            cut[1:-1] = ~_joined(self.merges, points, pairs)
        cut[first] = True
        return np.flatnonzero(cut[: len(points)])


def _joined(m: Merges, points: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    return _find(m.joined, pairs)[1]


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def count(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Bytes and tokens of every row, and whether they exceed ``limit``.

    Null text: as empty, no tokens. Repeated rows stay. Empty table: no rows. ``path`` is a
    model file every worker can open.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data in text_blocks(batch.column(1)):
                n = counter(path).counts([t.decode() for t in data])
                made = [pa.array([len(t) for t in data], pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)]
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), *made], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
