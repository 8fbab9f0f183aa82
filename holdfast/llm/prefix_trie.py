"""Prefix trie of conversations: ternary search trees over ranges of turn sequences, joined at their edges.

A turn is known by the SHA-256 of its role and text, with the text's size behind it; a
conversation is the string of its turns. Equal conversations are counted first, so copies cost a
number. What is left is sorted into ranges, and each range is one tree. Prefixes that reach from
one range into the next have a node in both, and those nodes are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.tables import written

#: Bytes of a turn: digest of role and text, size of the text.
DIGEST, TURN = 32, 40
#: A conversation keeps so many turns of the one it was forked from, at most.
FORK = 5
HEADS = 9
#: Turns of one tree, about.
SHARD_TURNS = 250_000
#: Members that end at one node go into its digest in pieces of so many.
PIECE = 4096
NO_ENDS = hashlib.sha256(b"").digest()


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (``seq``, end to end) of each conversation, in order of turn, nulls first;
    turns of one number are ordered by role and text.

    A conversation is read in order, turn by turn, and only its digests are held.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role_size = F.octet_length(text("role")).cast("string")
    digest = F.unhex(F.sha2(F.concat(role_size, F.lit(":"), text("role"), text("text")), 256))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.concat(digest, F.unhex(F.lpad(F.hex(F.octet_length(text("text")).cast("long")), 16, "0"))).alias("step"),
        F.xxhash64(text("role"), text("text")).alias("tie"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "tie", "step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, parts = None, []
        for batch in batches:
            if not len(batch):
                continue
            ids, steps = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            done_ids, done = [], []
            for a, b in zip(cuts, cuts[1:]):
                if open_id is not None and ids[a] != open_id:
                    done_ids.append(open_id)
                    done.append(b"".join(parts))
                    parts = []
                open_id = ids[a]
                parts += steps[a:b]
            yield _sequences(done_ids, done)
        if open_id is not None:
            yield _sequences([open_id], [b"".join(parts)])

    return ordered.select("conv_id", "step").mapInArrow(run, "conv_id long, seq binary")


def _sequences(ids: list, seqs: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(seqs, pa.binary())], names=["conv_id", "seq"])


def forked(sequences: DataFrame, fork: int = FORK, heads: int = HEADS) -> DataFrame:
    """Each conversation c as a fork: the first h turns of conversation ``c - c % fork`` (all of
    them if fewer, none if there is no such one), then its own after its first h; h is
    ``crc32(c) % heads``, of the decimal number."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int") * TURN
    base = sequences.filter(F.col("conv_id") % fork == 0).select(
        F.col("conv_id").alias("base"), F.substring("seq", 1, TURN * (heads - 1)).alias("start")
    )
    joined = sequences.join(base, F.col("conv_id") - F.col("conv_id") % fork == F.col("base"), "left")
    start = F.coalesce(F.substring(F.col("start"), F.lit(1), head), F.lit(b""))
    own = F.substring(F.col("seq"), head + 1, F.octet_length("seq"))
    return joined.select("conv_id", F.concat(start, own).alias("seq"))


def _pieces(members: DataFrame) -> DataFrame:
    """Comma-joined conv_ids of each key in ascending order, in pieces of at most PIECE."""
    ordered = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            keys, ids = np.array(batch.column(0).to_pylist(), dtype=f"S{DIGEST}"), batch.column(1).to_pylist()
            edge = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            cuts = sorted({0, len(ids), *edge.tolist(), *range(0, len(ids), PIECE)})
            firsts = [ids[a] for a in cuts[:-1]]
            texts = [",".join(map(str, ids[a:b])).encode() for a, b in zip(cuts, cuts[1:])]
            yield pa.record_batch(
                [batch.column(0).take(pa.array(cuts[:-1])), pa.array(firsts, pa.int64()), pa.array(texts, pa.binary())],
                names=["key", "first_id", "ids"],
            )

    return ordered.select("key", "conv_id").mapInArrow(run, "key binary, first_id long, ids binary")


def _end_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending conv_ids of each key. The pieces of a key pass one
    after the other through its digest, so no list of members is ever held."""
    ordered = _pieces(members).repartition("key").sortWithinPartitions("key", "first_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state = None, None
        for batch in batches:
            keys, made = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == open_key:
                    state.update(b",")
                else:
                    if open_key is not None:
                        keys.append(open_key)
                        made.append(state.digest())
                    open_key, state = key, hashlib.sha256()
                state.update(ids)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(made, pa.binary())], names=["end_key", "ends"])
        if open_key is not None:
            yield pa.record_batch([pa.array([open_key], pa.binary()), pa.array([state.digest()], pa.binary())], names=["end_key", "ends"])

    return ordered.select("key", "ids").mapInArrow(run, "end_key binary, ends binary")


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """Each different conversation (``seq``) with its members' number, smallest and digest."""
    members = conversations.select(F.unhex(F.sha2("seq", 256)).alias("key"), "conv_id")
    groups = conversations.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    groups = groups.withColumn("key", F.unhex(F.sha2("seq", 256)))
    return groups.join(_end_digests(members), F.col("key") == F.col("end_key")).select("seq", "n", "low", "ends")


class TernaryTree:
    """Trie whose children hang in binary search trees: lower, equal and higher at each node.

    Node 0 is the root of the trie; ``down`` is the top of a node's children, ``up`` its parent.
    A node is always made after its parent.
    """

    def __init__(self) -> None:
        self.symbol, self.lower, self.higher, self.down, self.up, self.depth = [-1], [0], [0], [0], [-1], [0]

    def _new(self, symbol: int, parent: int) -> int:
        for column, value in (
            (self.symbol, symbol), (self.lower, 0), (self.higher, 0), (self.down, 0), (self.up, parent), (self.depth, self.depth[parent] + 1),
        ):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, symbols: list[int]) -> int:
        """Node of the sequence."""
        symbol, lower, higher, down = self.symbol, self.lower, self.higher, self.down
        at = 0
        for s in symbols:
            child = down[at]
            if not child:
                child = down[at] = self._new(s, at)
            while symbol[child] != s:
                side = lower if s < symbol[child] else higher
                if not side[child]:
                    side[child] = self._new(s, at)
                child = side[child]
            at = child
        return at

    @staticmethod
    def median_order(n: int) -> Iterator[int]:
        """Places of a sorted list, the middle first, then the middles of both halves, ..."""
        ranges = [(0, n)]
        for lo, hi in ranges:
            if lo < hi:
                middle = (lo + hi) // 2
                yield middle
                ranges += [(lo, middle), (middle + 1, hi)]


def build(seqs: list[bytes]) -> tuple[TernaryTree, np.ndarray, np.ndarray]:
    """Tree of sorted distinct sequences, the node each ends at, and the text size of every node.

    Turns are numbered in the order of their bytes, so the sequences of numbers are sorted too.
    """
    sizes = np.array([len(s) // TURN for s in seqs], np.int64)
    steps, code = np.unique(np.frombuffer(b"".join(seqs), f"S{TURN}"), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    code = code.tolist()
    tree, ends = TernaryTree(), np.zeros(len(seqs), np.int64)
    for i in TernaryTree.median_order(len(seqs)):
        ends[i] = tree.insert(code[first[i] : first[i + 1]])
    raw = np.frombuffer(steps.tobytes(), np.uint8).reshape(-1, TURN)
    text_size = np.ascontiguousarray(raw[:, DIGEST:]).view(">i8").ravel().astype(np.int64)
    symbol = np.array(tree.symbol)
    size = np.zeros(len(symbol), np.int64)
    size[1:] = text_size[symbol[1:]]
    return tree, ends, size


def _table(table: pa.Table, shard: int) -> pa.RecordBatch:
    """Nodes of one range of sorted sequences. Those on the way to the first and to the last of
    them may go on in another range: they have a ``slot`` and the key of their prefix. The root
    carries the two sequences."""
    seqs = table["seq"].to_pylist()
    tree, ends, size = build(seqs)
    count = len(tree.symbol)
    up, depth = np.array(tree.up), np.array(tree.depth)
    n, low = np.zeros(count, np.int64), np.full(count, np.iinfo(np.int64).max)
    n[ends], low[ends] = table["n"].to_numpy(), table["low"].to_numpy()
    children = np.bincount(up[1:], minlength=count)
    leaves = (children == 0).astype(np.int64)
    saved = np.zeros(count, np.int64)
    # from the deepest nodes up: a parent's sums are whole once all deeper nodes are added
    by_depth = np.argsort(depth, kind="stable")
    starts = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
    for d in range(int(depth.max()), -1, -1):
        level = by_depth[starts[d] : starts[d + 1]]
        saved[level] += (n[level] - 1) * size[level]
        if d:
            for total in (n, leaves, saved):
                np.add.at(total, up[level], total[level])
            np.minimum.at(low, up[level], low[level])
    slot = np.full(count, -1, np.int32)
    keys: list[bytes | None] = [None] * count
    for seq, node in ((seqs[0], int(ends[0])), (seqs[-1], int(ends[-1]))):
        way = [node]
        while way[-1]:
            way.append(tree.up[way[-1]])
        state = hashlib.sha256()
        for d, at in enumerate(reversed(way)):
            if d:
                state.update(seq[(d - 1) * TURN : d * TURN])
            keys[at] = state.copy().digest()
    edge = np.array([i for i, k in enumerate(keys) if k is not None])
    slot[edge] = np.arange(len(edge))
    own_ends = pa.nulls(count, pa.binary()).to_pylist()
    for node, digest in zip(ends.tolist(), table["ends"].to_pylist()):
        own_ends[node] = digest
    parent = np.maximum(up, 0)
    return pa.record_batch(
        [
            pa.array(np.full(count, shard, np.int32)), pa.array(slot), pa.array(keys, pa.binary()),
            pa.array(np.where(up >= 0, slot[parent], -1), pa.int32()), pa.array(np.where(up >= 0, low[parent], 0)),
            pa.array(low), pa.array(depth.astype(np.int64)), pa.array(n), pa.array(children.astype(np.int64)), pa.array(leaves),
            pa.array(saved), pa.array(own_ends, pa.binary()),
            *(pa.array([seqs[i]] + [None] * (count - 1), pa.binary()) for i in (0, -1)),
        ],
        names=[f.split()[0] for f in _NODES.split(", ")],
    )


_NODES = (
    "shard int, slot int, key binary, parent_slot int, parent_low long, low long, depth long, n long, children long, leaves long, "
    "saved long, ends binary, first binary, last binary"
)


def _shards(sequences: DataFrame, shard_turns: int) -> DataFrame:
    """Nodes of the trees, one tree for each range of the sorted sequences."""
    total = sequences.agg(F.sum(F.octet_length("seq") / TURN + 1)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_turns))
    dealt = sequences.repartitionByRange(shards, "seq").sortWithinPartitions("seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if len(b)]
        if own:
            nodes = _table(pa.Table.from_batches(own), TaskContext.get().partitionId())
            for lo in range(0, len(nodes), 10_000):
                yield nodes.slice(lo, 10_000)

    return written(dealt.mapInArrow(run, _NODES), "trie-nodes")


def _corrections(edges: DataFrame) -> DataFrame:
    """What two neighbouring ranges count twice: for each prefix that their nearest sequences share,
    one child, the text sizes from it on, and a leaf where one sequence begins the other.

    The driver sees the numbers of the ranges that hold rows, as many as there are tasks.
    """
    numbers = sorted(r[0] for r in edges.select("shard").collect())
    pairs = edges.sparkSession.createDataFrame(list(zip(numbers, numbers[1:])), "a int, b int")
    a = edges.select(F.col("shard").alias("a"), "last")
    b = edges.select(F.col("shard").alias("b"), "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for last, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shared = 0
                while shared < min(len(last), len(first)) and last[shared : shared + TURN] == first[shared : shared + TURN]:
                    shared += TURN
                depth = shared // TURN
                state, keys = hashlib.sha256(), []
                for d in range(depth + 1):
                    if d:
                        state.update(last[(d - 1) * TURN : d * TURN])
                    keys.append(state.copy().digest())
                size = [0, *(int.from_bytes(last[d * TURN + DIGEST : (d + 1) * TURN], "big") for d in range(depth))]
                below = np.cumsum(size[::-1])[::-1]
                leaf = -int(len(last) == shared)
                yield pa.record_batch(
                    [
                        pa.array(keys, pa.binary()), pa.array([-1] * depth + [0], pa.int64()),
                        pa.array([leaf] * (depth + 1), pa.int64()), pa.array(below, pa.int64()),
                    ],
                    names=["key", "children", "leaves", "saved"],
                )

    joined = pairs.join(a, "a").join(b, "b").select("last", "first")
    return joined.mapInArrow(run, "key binary, children long, leaves long, saved long")


def _answer(conv_id: Column, parent: Column) -> list[Column]:
    return [
        conv_id.alias("conv_id"), F.col("depth"), parent.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.lower(F.hex(F.coalesce("ends", F.lit(NO_ENDS)))).alias("ends_sha256"),
    ]


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie over conversations (conv_id, ``seq``): its smallest member,
    depth, parent's smallest member, members, children, leaves below, bytes that sharing its
    subtree saves and the digest of the members that end at it.

    Sequences are sorted into ranges; one task builds the tree of a range, of about ``shard_turns``
    turns (or of one longer conversation). Nodes that only one range can hold are final. The others are added up
    by the key of their prefix, with what neighbouring ranges count twice taken off.
    """
    sequences = written(distinct_sequences(conversations), "trie-sequences")
    nodes = _shards(sequences, shard_turns)
    shared = nodes.filter("slot >= 0")
    part = shared.select("key", "low", "depth", "n", "children", "leaves", "saved", "ends")
    taken = _corrections(nodes.filter("depth = 0").select("shard", "first", "last")).select(
        "key", F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("depth"), F.lit(0).cast("long").alias("n"),
        "children", "leaves", "saved", F.lit(None).cast("binary").alias("ends"),
    )
    merged = part.union(taken).groupBy("key").agg(
        F.min("low").alias("low"), F.max("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")), F.max("ends").alias("ends"),
    )
    merged = written(merged, "trie-shared")
    names = shared.select(F.col("shard").alias("s"), F.col("slot").alias("p"), "key").join(
        merged.select(F.col("key").alias("k"), F.col("low").alias("name")), F.col("key") == F.col("k")
    )
    names = written(names.select("s", "p", "key", "name"), "trie-names")
    parents = names.select("s", "p", "name")
    ways = shared.filter("depth > 0").select("key", F.col("shard").alias("s"), F.col("parent_slot").alias("p")).join(parents, ["s", "p"])
    ways = ways.groupBy(F.col("key").alias("k")).agg(F.min("name").alias("parent"))
    top = merged.join(ways, F.col("key") == F.col("k"), "left").select(*_answer(F.col("low"), F.col("parent")))
    own = nodes.filter("slot < 0")
    of_shared = own.filter("parent_slot >= 0").join(
        parents, (F.col("shard") == F.col("s")) & (F.col("parent_slot") == F.col("p"))
    ).select(*_answer(F.col("low"), F.col("name")))
    rest = own.filter("parent_slot < 0").select(*_answer(F.col("low"), F.col("parent_low")))
    return top.union(of_shared).union(rest)


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie over the forked conversations (``turns``, ``forked``, ``trie``).

    Rows without conv_id belong to no conversation and are left out; a null role or text is
    empty, a null turn comes first. Turns with one number, repeated rows among them, are all
    turns, in an order that their role and text fix. A very long conversation is one row of
    40 bytes a turn. Equal conversations are members of the same nodes. Empty table: no rows.
    Other columns do not matter.
    """
    sequences = written(turns(conversations), "turns")
    return trie(written(forked(sequences), "forked"), shard_turns)
