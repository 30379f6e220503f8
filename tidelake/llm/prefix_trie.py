"""A trie of conversations' prefixes, in balanced parentheses, built shard by shard on Spark."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches, stored

# Turns of distinct conversations that one shard of the trie holds, about.
SHARD_TURNS = 1 << 13
_BLOCK = 64
_ROOT = bytes(16)
_NONE = np.iinfo(np.int64).max

_PATHS = "conv_id bigint, id binary, path array<binary>, sizes array<bigint>"
_OWN = ("n", "least", "saved", "leaves", "children")
_ENTRY = "path array<binary>, sizes array<bigint>, first_depth int, " + ", ".join(f"{name} array<bigint>" for name in _OWN)
_NODE = "id binary, parent_id binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` (``key``: 128 bits of role and text, ``size``: UTF-8 bytes of the text) in order of ``turn``.

    A null turn comes first, equal turns in the order of their keys; null roles and texts are
    empty; repeated rows are turns of their own. Rows without ``conv_id`` belong to no
    conversation and are left out; other columns are ignored. Texts do not travel: a conversation
    gathers 24 bytes and its number of each turn, so one of a hundred million turns would be
    too long for a row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(F.col("turn").alias("turn"), key.alias("key"), F.octet_length(text).cast("bigint").alias("size")).alias("x"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return ordered.select("conv_id", F.transform("x", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def prefix_trie(sequences: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct prefix of ``turns`` (as :func:`turn_sequences` gives them), the empty one included.

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs`` (members),
    ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree, sizes of the last turns that
    need not be stored again for further members) and ``ends_sha256`` (of the members that end
    there, ascending). ``conv_id`` is never null and unique; a conversation without turns ends at
    the root; no conversations give no rows.

    Every prefix has an id that chains its turns' keys, so a conversation is a list of ids, and
    equal lists are one entry. Entries in the order of their lists are the trie in preorder. A
    shard is a run of entries with about ``shard_turns`` turns: its trie is a string of balanced
    parentheses in which closing ones are found through block minima, leaves are counted by the
    rank of "()", and sums over subtrees are differences of cumulative arrays. Nodes off a
    shard's first and last entry are whole and done. Those two entries, its spines, carry what
    hangs on them into the next round, which merges the spines of all shards in the same way; the
    last round has one shard.

    Ids of members that end at one node pass through one task, eight bytes each and none kept,
    since SHA-256 takes its input in order.
    """
    rows = sequences.select("conv_id", F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes"))
    paths = stored(map_batches(rows, _chained, _PATHS), "trie-paths")
    alike = paths.groupBy("id").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"), F.first("sizes").alias("sizes"))
    nothing = F.array(F.lit(0).cast("bigint"))
    entries = stored(alike.select("path", "sizes", F.size("path").alias("first_depth"), F.array("n").alias("n"), F.array("least").alias("least"), *[nothing.alias(name) for name in _OWN[2:]]), "trie-entries")

    rounds = []
    turns = _turns(entries)
    while turns > shard_turns:
        ordered = entries.repartitionByRange("path").sortWithinPartitions("path")
        out = stored(map_batches(ordered, _builder(shard_turns, False), f"{_ENTRY}, {_NODE}"), "trie-round")
        rounds.append(out.where("id IS NOT NULL").select(*_names(_NODE)))
        entries = out.where("id IS NULL").select(*_names(_ENTRY))
        left = _turns(entries)
        # Entries as long as a shard leave whole spines: longer shards hold several of them.
        shard_turns, turns = (4 * shard_turns if 2 * left > turns else shard_turns), left
    last = map_batches(entries.repartition(1).sortWithinPartitions("path"), _builder(shard_turns, True), f"{_ENTRY}, {_NODE}")
    rounds.append(stored(last.select(*_names(_NODE)), "trie-round"))

    merged = rounds[-1]
    for nodes in rounds[1:-1]:
        merged = merged.union(nodes)
    nodes = merged if len(rounds) == 1 else rounds[0].union(merged)
    above = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("above"))
    linked = nodes.join(above, "parent_id", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    ends = map_batches(paths.select("id", "conv_id").repartition("id").sortWithinPartitions("id", "conv_id"), _digested, "id binary, ends_sha256 string")
    digest = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    return linked.join(ends, "id", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _turns(entries: DataFrame) -> int:
    return entries.agg(F.coalesce(F.sum(F.size("path") + 1), F.lit(0)).alias("n")).first()["n"]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of all prefixes of each conversation."""
    md5 = hashlib.md5
    for batch in batches:
        last, flat, ends = [], [], [0]
        for keys in batch.column(1).to_pylist():
            node = _ROOT
            for key in keys:
                node = md5(node + key).digest()
                flat.append(node)
            last.append(node)
            ends.append(len(flat))
        path = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(last, pa.binary()), path, batch.column(2)], _names(_PATHS))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the ids that end at each node, read in order and not kept."""
    node, digest = None, None
    for batch in batches:
        done = []
        ids, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts = [i for i, x in enumerate(ids) if x != (ids[i - 1] if i else node)]
        for begin, end in zip([0, *starts], [*starts, len(ids)], strict=True):
            if begin == end:
                continue
            text = ",".join(map(str, convs[begin:end])).encode()
            if ids[begin] == node:
                digest.update(b"," + text)
            else:
                if digest:
                    done.append((node, digest.hexdigest()))
                node, digest = ids[begin], hashlib.sha256(text)
        yield _digests(done)
    if digest:
        yield _digests([(node, digest.hexdigest())])


def _digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done], pa.string())], ["id", "ends_sha256"])


# ---- parentheses --------------------------------------------------------------------------------


def find_close(opening: np.ndarray) -> np.ndarray:
    """For every opening parenthesis of a balanced string (True: opening) the place of its closing one.

    That is the next place whose excess is one less. It is looked for in the rest of the block,
    then by minima of blocks and of pairs of those, up and down again, then in the block found.
    """
    excess = np.cumsum(np.where(opening, 1, -1))
    opens = np.flatnonzero(opening)
    want = excess[opens] - 1
    found = np.full(len(opens), -1, np.int64)
    _scan(excess, opens + 1, (opens // _BLOCK + 1) * _BLOCK, want, found, np.arange(len(opens)))
    tree = [np.minimum.reduceat(excess, np.arange(0, len(excess), _BLOCK))]
    while len(tree[-1]) > 1:
        level = tree[-1]
        tree.append(np.minimum.reduceat(level, np.arange(0, len(level), 2)))
    far = np.flatnonzero(found < 0)
    node, height = opens[far] // _BLOCK, np.full(len(far), -1)
    for k, level in enumerate(tree):
        climbing = np.flatnonzero(height < 0)
        at = node[climbing]
        right = np.minimum(at + 1, len(level) - 1)
        hit = (at % 2 == 0) & (at + 1 < len(level)) & (level[right] <= want[far[climbing]])
        height[climbing[hit]] = k
        node[climbing[hit]] = at[hit] + 1
        node[climbing[~hit]] = at[~hit] // 2
    for k in range(len(tree) - 2, -1, -1):
        down = np.flatnonzero(height > k)
        left = 2 * node[down]
        node[down] = np.where(tree[k][left] <= want[far[down]], left, left + 1)
    _scan(excess, node * _BLOCK, (node + 1) * _BLOCK, want[far], found, far)
    return found


def _scan(excess: np.ndarray, start: np.ndarray, stop: np.ndarray, want: np.ndarray, found: np.ndarray, which: np.ndarray) -> None:
    """Note the first place from start on and before stop with the wanted excess."""
    stop = np.minimum(stop, len(excess))
    live = np.flatnonzero(start < stop)
    at = start.copy()
    while len(live):
        hit = excess[at[live]] == want[live]
        found[which[live[hit]]] = at[live[hit]]
        live = live[~hit]
        at[live] += 1
        live = live[at[live] < stop[live]]


def range_minima(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of every range, from minima over powers of two; no range is empty."""
    out = np.empty(len(begin), values.dtype)
    power = np.frexp((end - begin).astype(float))[1] - 1
    level = values
    for k in range(int(power.max()) + 1):
        if k:
            level = np.minimum(level[: -(1 << (k - 1))], level[1 << (k - 1) :])
        now = power == k
        out[now] = np.minimum(level[begin[now]], level[end[now] - (1 << k)])
    return out


class _Entry:
    """A list of prefix ids with what is known of its nodes from ``first`` depth on."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, first: int, own: np.ndarray):
        self.ids, self.sizes, self.first, self.own = ids, sizes, first, own


def _entries(batch: pa.RecordBatch) -> Iterator[_Entry]:
    path = batch.column(0)
    flat = path.flatten()
    ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int32)
    ids = np.frombuffer(flat.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint64).reshape(-1, 2) if len(flat) else np.empty((0, 2), np.uint64)
    sizes = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(path.value_lengths().to_numpy(zero_copy_only=False))])
    own = [batch.column(3 + k) for k in range(len(_OWN))]
    values = np.stack([column.flatten().to_numpy(zero_copy_only=False) for column in own], axis=1)
    places = np.concatenate([[0], np.cumsum(own[0].value_lengths().to_numpy(zero_copy_only=False))])
    for i, first in enumerate(batch.column(2).to_pylist()):
        yield _Entry(ids[at[i] : at[i + 1]], sizes[at[i] : at[i + 1]], first, values[places[i] : places[i + 1]])


def _builder(shard_turns: int, whole: bool):
    """Shards of about ``shard_turns`` turns out of entries in order; ``whole``: one, and nothing is left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for batch in batches:
            for entry in _entries(batch):
                if held and not whole and turns >= shard_turns:
                    yield from _shard(held, False)
                    held, turns = [], 0
                held.append(entry)
                turns += len(entry.ids) + 1
        if held:
            yield from _shard(held, whole)

    return run


def _shard(entries: list[_Entry], whole: bool) -> Iterator[pa.RecordBatch]:
    # Entries open the nodes that they do not share with the entry before.
    counts, before = [], np.empty((0, 2), np.uint64)
    ids, sizes, parents, depths = [np.zeros((1, 2), np.uint64)], [np.zeros(1, np.int64)], [np.array([-1])], [np.zeros(1, np.int64)]
    way = np.zeros(1, np.int64)  # the nodes of the present entry, from the root on
    ways, total = [], 1
    for entry in entries:
        n = min(len(before), len(entry.ids))
        differ = np.flatnonzero((before[:n] != entry.ids[:n]).any(axis=1))
        common = int(differ[0]) if len(differ) else n
        fresh = np.arange(total, total + len(entry.ids) - common)
        counts += [len(before) - common, len(fresh)]
        if len(fresh):
            ids.append(entry.ids[common:])
            sizes.append(entry.sizes[common:])
            parents.append(np.concatenate([way[common : common + 1], fresh[:-1]]))
            depths.append(np.arange(common + 1, len(entry.ids) + 1))
            total += len(fresh)
        way = np.concatenate([way[: common + 1], fresh])
        ways.append(way)
        before = entry.ids
    counts.append(len(before))
    runs = np.array([1, *counts, 1])
    kinds = np.ones(len(runs), bool)
    kinds[1::2] = False
    kinds[-1] = False
    opening = np.repeat(kinds, runs)
    ids, sizes, parent, depth = (np.concatenate(x) for x in (ids, sizes, parents, depths))

    own = {name: np.full(total, _NONE) if name == "least" else np.zeros(total, np.int64) for name in _OWN}
    nodes = np.concatenate([w[e.first :] for w, e in zip(ways, entries, strict=True)])
    values = np.concatenate([e.own for e in entries])
    for k, name in enumerate(_OWN):
        (np.minimum if name == "least" else np.add).at(own[name], nodes, values[:, k])

    begin, opens = np.arange(total), np.flatnonzero(opening)
    end = begin + (find_close(opening) - opens + 1) // 2

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[end] - sums[begin]

    n_convs, least = below(own["n"]), range_minima(own["least"], begin, end)
    children = own["children"] + np.bincount(parent[1:], minlength=total)
    pairs = ~opening[opens + 1]  # "()"
    leaves = below(own["leaves"] + (pairs & (own["children"] == 0)))
    open_nodes = np.zeros(total, bool)
    if not whole:
        open_nodes[ways[0]] = open_nodes[ways[-1]] = True
    saved = below(own["saved"] + np.where(open_nodes, 0, (n_convs - 1) * sizes))

    done = np.flatnonzero(~open_nodes)
    above = parent[done]
    hangs = (above >= 0) & open_nodes[above]
    binary = ids.view("V16").reshape(-1)
    columns = [
        pa.array([x.tobytes() for x in binary[done]], pa.binary()),
        pa.array([x.tobytes() if h else None for x, h in zip(binary[above], hangs, strict=True)], pa.binary()),
        pa.array(least[done]), pa.array(depth[done]), pa.array(least[above], mask=hangs | (above < 0)),
        pa.array(n_convs[done]), pa.array(children[done]), pa.array(leaves[done]), pa.array(saved[done]),
    ]
    yield _rows({}, dict(zip(_names(_NODE), columns, strict=True)), len(done))
    if whole:
        return
    # What hangs on the spines goes with them into the next round.
    top = done[hangs]
    for name, value in (("n", n_convs), ("saved", saved), ("leaves", leaves), ("children", np.ones(total, np.int64))):
        np.add.at(own[name], parent[top], value[top])
    np.minimum.at(own["least"], parent[top], least[top])
    shared = int(np.cumprod(ways[0][: len(ways[-1])] == ways[-1][: len(ways[0])]).sum()) if len(entries) > 1 else 0
    spines = [(entries[0], ways[0], 0)]
    if len(entries) > 1 and shared < len(ways[-1]):
        spines.append((entries[-1], ways[-1], shared))
    columns = {
        "path": pa.array([[x.tobytes() for x in binary[w[1:]]] for _, w, _ in spines], pa.list_(pa.binary())),
        "sizes": pa.array([e.sizes.tolist() for e, _, _ in spines], pa.list_(pa.int64())),
        "first_depth": pa.array([first for *_, first in spines], pa.int32()),
        **{name: pa.array([own[name][w[first:]].tolist() for _, w, first in spines], pa.list_(pa.int64())) for name in _OWN},
    }
    yield _rows(columns, {}, len(spines))


_TYPES = {"binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32(), "array<binary>": pa.list_(pa.binary()), "array<bigint>": pa.list_(pa.int64())}


def _rows(entry: dict[str, pa.Array], node: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    """A batch of entries or of nodes; the columns of the other kind are null."""
    given = {**entry, **node}
    kinds = dict(part.split() for part in f"{_ENTRY}, {_NODE}".split(", "))
    return pa.RecordBatch.from_arrays([given.get(name, pa.nulls(n, _TYPES[kind])) for name, kind in kinds.items()], list(kinds))
