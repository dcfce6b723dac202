"""The prefix trie of conversations: one row per distinct beginning, with what lies below it.

Method: truncation peeling. Conversations, sorted by their sequences of turns, are peeled from the greatest depth down:
those that end at a depth join the nodes that survived from below, equal sequences merge, every node is put out with its
sums, and the last turn is stripped. Nodes are discovered and summed up in the same pass.

Sorted conversations make every subtree a stretch of rows, so a batch of them peels all nodes by itself but those on the paths
of its first and its last conversation. These two paths go on, with the sums so far, as rows of the next round, which
has some thousands of times fewer; the round that fits in one batch ends it. No group is gathered anywhere: a beginning that
a third of all conversations share is two paths per batch, however many batches hold it. Sequences travel as 16 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygalley.llm.exchange import materialize
from skygalley.llm.warc import hot_keys

TURNS = "turns"
# Conversations or paths of one batch, and turns after which a batch is closed early.
BATCH_PATHS = 4096
BATCH_TURNS = 1 << 19
# Every batch but a task's last has so many paths at least, so that each round has far fewer than the one before.
FEWEST_PATHS = 16
DIGEST = 16
ROOT = bytes(DIGEST)

_NUMBERS = ("n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens")
# kind 0: a node; 1: a path for the next round; 2: a stretch of the ids that end at a node
_PEELED = (
    "kind int, path binary, words binary, sums binary, conv_id long, depth int, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, node binary, parent binary, parent_conv_id long, ends string, first_id long, ids string"
)
_TYPES = [
    pa.int32(),
    *[pa.binary()] * 3,
    pa.int64(),
    pa.int32(),
    *[pa.int64()] * 4,
    *[pa.binary()] * 2,
    pa.int64(),
    pa.string(),
    pa.int64(),
    pa.string(),
]
_NAMES = [c.split()[0] for c in _PEELED.split(", ")]
_PARENT, _PARENT_ID = _NAMES.index("parent"), _NAMES.index("parent_conv_id")


# --- conversations --------------------------------------------------------------------------------


def word_count(text: Column) -> Column:
    """Runs of characters outside space and 0x09-0x0D."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(marked, "[^w]", ""))


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes of the SHA-256 of a turn; the length of the role keeps the two apart."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * DIGEST))


def conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per conversation: conv_id, turns (array of turn, digest, words) by turn, null first; of equal ones by digest.

    A null role or text is empty. Rows without conv_id belong to no conversation and are left out. Texts stay behind;
    ``turn_texts`` leads from digests back to them. A conversation's turns, some 30 bytes each, are one value.
    """
    named = rows.where(F.col(conv_id).isNotNull())
    one = F.struct(
        F.col(turn).cast("long").alias("turn"),
        turn_digest(F.col(role), F.col(text)).alias("digest"),
        word_count(F.coalesce(F.col(text), F.lit(""))).alias("words"),
    )
    turns = F.sort_array(F.collect_list(one)).alias(TURNS)
    return named.groupBy(F.col(conv_id).cast("long").alias("conv_id")).agg(turns)


def turn_texts(rows: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """(last_turn, role, text) of every distinct turn, for a join with the nodes."""
    role, text = (F.coalesce(c, F.lit("")) for c in (F.col(role), F.col(text)))
    return rows.select(turn_digest(role, text).alias("last_turn"), role.alias("role"), text.alias("text")).distinct()


# --- peeling --------------------------------------------------------------------------------------


class _Paths:
    """Sorted paths of one batch, with one entry per path and depth (0 to its length) for words and sums."""

    def __init__(self, paths: list[bytes], words: list[np.ndarray], sums: np.ndarray):
        self.paths, self.words, self.sums = paths, words, sums
        self.length = np.array([len(p) // DIGEST for p in paths], np.int64)
        self.offset = np.concatenate(([0], np.cumsum(self.length + 1)))[:-1]
        self.shared = np.array([0, *map(_common, paths, paths[1:])], np.int64)


def _common(a: bytes, b: bytes) -> int:
    """How many turns two paths share at the beginning."""
    if a == b:
        return len(a) // DIGEST
    n = min(len(a), len(b)) // DIGEST
    if not n:
        return 0
    x, y = (np.frombuffer(p, np.uint64, 2 * n).reshape(n, 2) for p in (a, b))
    other = np.flatnonzero((x != y).any(axis=1))
    return int(other[0]) if len(other) else n


def _node_keys(path: bytes) -> list[bytes]:
    """A name for the beginnings of a path, by depth."""
    keys = [ROOT]
    for at in range(0, len(path), DIGEST):
        keys.append(hashlib.sha256(keys[-1] + path[at : at + DIGEST]).digest()[:DIGEST])
    return keys


def _first_sums(conv_ids: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Sums of conversations: one member at every depth, nothing below yet."""
    out = np.zeros((len(_NUMBERS), int((length + 1).sum())), np.int64)
    out[0], out[1] = 1, np.repeat(conv_ids, length + 1)
    return out


def peel(batch: _Paths, conv_ids: np.ndarray | None, alone: bool) -> Iterator[list]:
    """Rows of ``_PEELED``. ``alone``: no other batch has any of these beginnings, so every node is whole.

    ``conv_ids`` are those of conversations in the first round; paths of later rounds have none, and their nodes, which
    several batches share, are put out with their names.
    """
    if not batch.paths:
        return
    last = len(batch.paths) - 1
    ends = {0, last} if conv_ids is not None else set(range(last + 1))
    keys = {i: _node_keys(batch.paths[i]) for i in ends}
    onward = {i: np.zeros((len(_NUMBERS), int(batch.length[i]) + 1), np.int64) for i in (0, last)}
    for sums in onward.values():
        sums[1] = np.iinfo(np.int64).max
    spine = () if alone else (0, last)
    by_length = np.argsort(-batch.length, kind="stable")
    entered, active = 0, np.zeros(0, np.int64)
    # whole nodes one deeper: their first path, their sums (nodes, leaves, saved), and the rows still without a parent
    below, below_sums, below_rows = np.zeros(0, np.int64), np.zeros((3, 0), np.int64), []
    for depth in range(int(batch.length.max()), -1, -1):
        upto = int(np.searchsorted(-batch.length[by_length], -depth, side="right"))
        if upto > entered:
            # those that end here join what survived
            active = np.sort(np.concatenate((active, by_length[entered:upto])))
            entered = upto
        starts = np.flatnonzero(np.concatenate(([True], batch.shared[active[1:]] < depth)))
        first = active[starts]
        at = batch.offset[active] + depth
        n, children, leaves, saved = (np.add.reduceat(batch.sums[k][at], starts) for k in (0, 2, 3, 4))
        least = np.minimum.reduceat(batch.sums[1][at], starts)
        parent = np.searchsorted(first, below, side="right") - 1
        for total, part in zip((children, leaves, saved), below_sums):
            np.add.at(total, parent, part)
        # the first path carries what both share
        carrier = {int(np.searchsorted(first, i, side="right")) - 1: i for i in reversed(spine) if batch.length[i] >= depth}
        for k, row in zip(parent.tolist(), below_rows):
            row[_PARENT] = keys[carrier[k]][depth] if k in carrier else None
            row[_PARENT_ID] = None if k in carrier else int(least[k])
            yield row
        ended = _ended(batch, conv_ids, active, starts, depth)
        for k, i in carrier.items():
            onward[i][:, depth] = n[k], least[k], children[k], leaves[k], saved[k]
            if k in ended:
                yield [2, *[None] * 9, keys[i][depth], None, None, None, *ended[k]]
        whole = np.setdiff1d(np.arange(len(first)), list(carrier))
        leaves[whole] = np.where(children[whole] == 0, 1, leaves[whole])
        saved[whole] += (n[whole] - 1) * np.array([batch.words[i][depth] for i in first[whole]], np.int64)
        below_rows = []
        for k in whole.tolist():
            i = int(first[k])
            ids, name = None, None
            if conv_ids is None:
                name = keys[i][depth]
            else:
                ids = hashlib.sha256(ended[k][1].encode() if k in ended else b"").hexdigest()
            turn = batch.paths[i][max(depth - 1, 0) * DIGEST : depth * DIGEST]
            sums = [int(v[k]) for v in (n, children, leaves, saved)]
            below_rows.append([0, turn, None, None, int(least[k]), depth, *sums, name, None, None, ids, None, None])
        below = first[whole]
        below_sums = np.stack((np.ones(len(whole), np.int64), leaves[whole], saved[whole]))
    yield from below_rows  # the root, if it is whole
    for i in sorted(set(spine)):
        if i == 0 or batch.paths[i] != batch.paths[0]:
            yield [1, batch.paths[i], batch.words[i].astype("<i8").tobytes(), onward[i].tobytes(), *[None] * 12]


def _ended(batch: _Paths, conv_ids: np.ndarray | None, active: np.ndarray, starts: np.ndarray, depth: int) -> dict:
    """By node: (smallest, comma-joined ascending) ids of the conversations that end there."""
    if conv_ids is None:
        return {}
    ended = np.flatnonzero(batch.length[active] == depth)
    node = np.searchsorted(starts, ended, side="right") - 1
    out: dict[int, tuple[int, str]] = {}
    cuts = np.flatnonzero(np.diff(node)) + 1
    for rows in np.split(ended, cuts) if len(ended) else []:
        ids = conv_ids[active[rows]].tolist()
        out[int(np.searchsorted(starts, rows[0], side="right") - 1)] = (ids[0], ",".join(map(str, ids)))
    return out


def _table(rows: Iterator[list]) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) >= 10_000:
            yield _record_batch(held)
            held = []
    if held:
        yield _record_batch(held)


def _record_batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def _round(items: DataFrame, first: bool, n: int, batch_paths: int) -> DataFrame:
    """Peel sorted items; with no more than one batch of them all nodes come out whole."""
    alone = n <= batch_paths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, words, third in _closed(batches, alone, batch_paths):
            word_arrays = [np.frombuffer(w, "<i8") for w in words]
            if first:
                conv_ids = np.array(third, np.int64)
                length = np.array([len(p) // DIGEST for p in paths], np.int64)
                yield from _table(peel(_Paths(paths, word_arrays, _first_sums(conv_ids, length)), conv_ids, alone))
            else:
                sums = np.concatenate([np.frombuffer(s, "<i8").reshape(len(_NUMBERS), -1) for s in third], axis=1)
                yield from _table(peel(_Paths(paths, word_arrays, sums), None, alone))

    tasks = max(1, -(-n // batch_paths))
    order = ["path", items.columns[2]]
    # the same for equal paths: conversations by id, so that the ids that end at a node ascend
    ordered = items.repartitionByRange(tasks, *order) if tasks > 1 else items.coalesce(1)
    return ordered.sortWithinPartitions(*order).mapInArrow(run, _PEELED)


def _closed(batches: Iterator[pa.RecordBatch], alone: bool, batch_paths: int) -> Iterator[tuple[list, list, list]]:
    """Lists of rows: all of them if ``alone``, else closed at a number of rows or turns."""
    held: tuple[list, list, list] = ([], [], [])
    turns = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for values, value in zip(held, row):
                values.append(value)
            turns += len(row[0]) // DIGEST
            if not alone and (len(held[0]) >= batch_paths or turns >= BATCH_TURNS and len(held[0]) >= FEWEST_PATHS):
                yield held
                held, turns = ([], [], []), 0
    if held[0]:
        yield held


def prefix_trie(convs: DataFrame, batch_paths: int = BATCH_PATHS) -> DataFrame:
    """One row per distinct beginning of the conversations (conv_id, turns as from ``conversations``); the root has depth 0.

    conv_id, the smallest conversation that begins so; depth; last_turn (digest; null at the root); parent_conv_id, the
    parent's conv_id (null at the root); n_convs; n_children; n_leaves, nodes without children in the subtree, itself
    included; saved_tokens, the sum over the subtree of (n_convs - 1) times the words of the last turn; ends_sha256, the
    SHA-256 of the ids that end here, ascending, joined by commas.

    Conversations are rows of distinct ids; a null or empty ``turns`` ends at the root. Without conversations there is
    no node, not even a root. Other columns are ignored. ``batch_paths`` bounds a batch, not the result.
    """
    turns = F.coalesce(TURNS, F.array())
    path = F.unhex(F.array_join(F.transform(TURNS, lambda t: F.hex(t["digest"])), ""))
    items = convs.select(
        F.coalesce(path, F.lit(b"")).alias("path"),
        F.concat(F.lit(bytes(8)), _little_endian(turns)).alias("words"),
        F.col("conv_id").cast("long").alias("conv_id"),
    )
    items = materialize(items, "paths")
    n, first, nodes, ends = items.count(), True, None, None
    while n:
        peeled = materialize(_round(items, first, n, batch_paths), "peeled")
        found = peeled.where("kind = 0")
        nodes = found if nodes is None else nodes.unionByName(found)
        if first:
            ends = peeled.where("kind = 2").select("node", "first_id", "ids")
        if n <= batch_paths:
            ends = None if first else ends
            break
        items = peeled.where("kind = 1").select("path", "words", "sums")
        before, n, first = n, items.count(), False
        if 2 * n > before:
            batch_paths *= 2  # batches of a few paths each would never end
    if nodes is None:
        return _finished(items.sparkSession.createDataFrame([], _PEELED), None)
    return _finished(nodes, ends)


def _little_endian(turns: Column) -> Column:
    """Word counts of the turns as 64-bit numbers, low byte first."""
    def one(t: Column) -> Column:
        big = F.hex(t["words"].cast("long"))
        padded = F.lpad(big, 16, "0")
        return F.concat(*[F.substring(padded, at, 2) for at in range(15, 0, -2)])

    return F.coalesce(F.unhex(F.array_join(F.transform(turns, one), "")), F.lit(b""))


def _finished(nodes: DataFrame, ends: DataFrame | None) -> DataFrame:
    """Nodes with the parents and the ends that their own batch could not know."""
    if ends is not None:
        # nodes that several batches shared have a name; they are the parents that were not known
        shared = nodes.where("node is not null").join(_streamed(ends), "node", "left")
        shared = shared.withColumn("ends", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest()))).drop("sha")
        rest = nodes.where("node is null").select(shared.columns)
        shared = materialize(shared, "shared_nodes")
        known = shared.select(F.col("node").alias("of"), F.col("conv_id").alias("found"), "n_children")
        hot = hot_keys(known, "of", "n_children").select(F.col("of").alias("often_of"), F.col("found").alias("often"))
        rows = rest.unionByName(shared)
        open_ = rows.where("parent is not null").join(F.broadcast(hot), F.col("parent") == F.col("often_of"), "left")
        # the children of a parent with very many of them are settled, and no longer meet under its name
        own = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")).cast("binary")
        open_ = open_.withColumn("of", F.when(F.col("often_of").isNull(), F.col("parent")).otherwise(own))
        open_ = open_.join(known.drop("n_children"), "of", "left")
        open_ = open_.withColumn("parent_conv_id", F.coalesce("often", "found")).select(rows.columns)
        nodes = rows.where("parent is null").unionByName(open_)
    return nodes.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > 0, F.col("path")).alias("last_turn"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )


def _streamed(ends: DataFrame) -> DataFrame:
    """SHA-256 over the ids of each node, stretch by stretch in ascending order; no node's ids are held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        done: list[tuple[bytes, str]] = []
        for batch in batches:
            for key, _, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            yield _digests(done)
            done = []
        if node is not None:
            yield _digests([(node, state.hexdigest())])

    # a stretch stands for up to a batch of conversations, so a node with a third of them is few rows
    ordered = ends.repartition("node").sortWithinPartitions("node", "first_id")
    return ordered.mapInArrow(run, "node binary, sha string")


def _digests(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["node", "sha"]
    )
