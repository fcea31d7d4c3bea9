"""Exact similarity join on word shingles: pairs with Jaccard similarity of 0.75 or more, and their components.

1. Documents of equal sets are one class; only classes go on.
2. A set needs three quarters of its shingles in some other set. Shingles are counted over all sets, by ranges of hashes, and
   sets with too few shared shingles are done.
3. Of the others, the first quarter of each set is indexed, in order of how many sets have a shingle, the fewest first. Two
   similar sets share a shingle there, so sets that stand next to each other in an index list, and fit in size, are chained into
   clusters: similar sets lie in one cluster. A cluster may be larger than needed; no pairs are made for it.
4. Each cluster is joined in memory (`Block`), large ones block against block. The index lists skip by position: blocks of a list
   whose sizes and positions cannot reach the overlap are passed over. The answers of a set that is much like one answered
   before are derived from that one's overlaps: only lists of shingles in which the two differ are read.
5. Links are counted and joined into components; they never leave the task as pairs.

Shingles and sets are told apart by 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm import tokens
from martworks.llm.common import prepare
from martworks.llm.components import connected_components
from martworks.session import written

SHINGLE = 5
# Similarity of SHARE[0] / SHARE[1] or more.
SHARE = (3, 4)
# Shingles that a task gathers before it hands them on, and that one range of hashes holds about.
BUFFER = 1_500_000
RANGE_SHINGLES = 2_000_000
# Shingles of one block of a cluster; two blocks meet in a task.
BLOCK_SHINGLES = 500_000
# A list of ids up to this length is broadcast to find their texts (about 64 MB), a longer one is joined.
MAX_BROADCAST_IDS = 1_000_000
SKIP = 32


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared shingles that sets of sizes a and b need."""
    x, y = SHARE
    return -(-x * (a + b) // (x + y))


def least_own(n: np.ndarray) -> np.ndarray:
    """Shingles of a set of size n that any similar set must have."""
    return -(-SHARE[0] * n // SHARE[1])


def fits(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    return SHARE[1] * small >= SHARE[0] * large


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first row, where each row's shingles begin (and the last end), the shingles, and a key of each row's set."""
    for begin, end, data, offsets in tokens.chunks(column):
        row, found = tokens.shingle_sets(tokens.words(data, offsets, lower=True), SHINGLE)
        ends = np.searchsorted(row, np.arange(end - begin + 1))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens.mixed(found ^ np.uint64(0x5851F42D4C957F2D)))))
        key = tokens.mixed(sums[ends[1:]] - sums[ends[:-1]] + np.diff(ends).astype(np.uint64)).view(np.int64)
        yield begin, ends, found, key


def _key_batches(batches):
    for batch in batches:
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, ends, _, key in _sets(batch.column(1)):
            keys.append(key)
            counts.append(np.diff(ends))
        carried = [i for i in range(batch.num_columns) if i != 1]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in carried), pa.array(np.concatenate(counts)), pa.array(np.concatenate(keys))],
            names=[*(batch.schema.names[i] for i in carried), "n", "node"])


# -- shared shingles


def _range_batches(batches, bits: int):
    """Distinct shingles by range of hashes, each with the set that has it, or marked as shared if several sets here do. The
    sets' own counts of such shingles are rows of negative ranges."""
    keys, ends, shingles, held, seen = [], [], [], 0, set()
    for batch in batches:
        for _, end, found, key in _sets(batch.column(0)):
            for i in np.flatnonzero(np.diff(end)):
                if int(key[i]) not in seen:
                    seen.add(int(key[i]))
                    keys.append(key[i])
                    shingles.append(found[end[i]:end[i + 1]])
                    held += len(shingles[-1])
                    if held > BUFFER or len(keys) > 65_000:
                        yield _ranged(keys, shingles, bits)
                        keys, shingles, held, seen = [], [], 0, set()
    if keys:
        yield _ranged(keys, shingles, bits)


def _ranged(keys: list, shingles: list[np.ndarray], bits: int) -> pa.RecordBatch:
    key = np.array(keys, np.int64)
    owner = np.repeat(np.arange(len(keys), dtype=np.int32), [len(s) for s in shingles])
    found = np.concatenate(shingles)
    order = np.argsort(found, kind="stable")
    found, owner = found[order], owner[order]
    first = np.concatenate(([True], found[1:] != found[:-1]))
    last = np.concatenate((first[1:], [True]))
    shared = ~(first & last)
    own = np.bincount(owner[shared], minlength=len(keys))
    once, alone, owner = found[first], ~shared[first], owner[first].astype(np.int64)
    part = (once >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(once), np.int64)
    low = (once >> np.uint64(32 - bits)).astype(np.uint32)
    cuts = np.searchsorted(part, np.arange((1 << bits) + 1))
    rows = [(-1 - int(key[0] % (1 << bits)), b"", b"", own.astype(np.int64).tobytes(), key.tobytes())]
    for i in np.flatnonzero(np.diff(cuts)):
        # In the order of their owners, shingles need only a count for each owner that has any here, a byte; larger counts are cut.
        here = cuts[i] + np.argsort(owner[cuts[i]:cuts[i + 1]], kind="stable")
        owners, many = np.unique(owner[here], return_counts=True)
        pieces = -(-many // 255)
        counts = np.full(pieces.sum(), 255, np.uint8)
        counts[np.cumsum(pieces) - 1] = many - 255 * (pieces - 1)
        rows.append((int(i), low[here].tobytes(), counts.tobytes(), np.packbits(alone[here]).tobytes(), key[np.repeat(owners, pieces)].tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), *[pa.binary()] * 4))], names=["part", "low", "many", "flags", "keys"])


def _count_shared(table: pa.Table, bits: int) -> pa.Table:
    """How many shingles of each set, known to one task only so far, others have as well, in one range. Sets are many and
    ranges, too, so the counts travel in one row for each bucket of sets."""
    keys = [np.frombuffer(x, np.int64) for x in table["keys"].to_pylist()]
    if table["part"][0].as_py() < 0:
        own = [np.frombuffer(x, np.int64) for x in table["flags"].to_pylist()]
        return _bucketed(np.concatenate(keys), np.concatenate(own), bits)
    low = [np.frombuffer(x, np.uint32) for x in table["low"].to_pylist()]
    alone = np.concatenate([
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(s)).astype(bool) for x, s in zip(table["flags"].to_pylist(), low)])
    owner = np.concatenate([np.repeat(k, np.frombuffer(x, np.uint8)) for k, x in zip(keys, table["many"].to_pylist())])
    low = np.concatenate(low)
    order = np.lexsort((owner, low))
    low, alone, owner = low[order], alone[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    last = np.append(first[1:], len(low)) - 1
    # Shared: marked so by a task, or with several sets. The same set comes from several tasks where texts are repeated.
    shared = ~np.logical_and.reduceat(alone, first) | (owner[first] != owner[last])
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])))
    counted = owner[np.repeat(shared, last - first + 1) & alone & new]
    return _bucketed(*np.unique(counted, return_counts=True), bits)


def _bucketed(node: np.ndarray, shared: np.ndarray, bits: int) -> pa.Table:
    bucket = node & ((1 << bits) - 1)
    order = np.argsort(bucket, kind="stable")
    node, shared, bucket = node[order], shared[order].astype(np.int64), bucket[order]
    cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    rows = [(int(i), node[cuts[i]:cuts[i + 1]].tobytes(), shared[cuts[i]:cuts[i + 1]].tobytes()) for i in np.flatnonzero(np.diff(cuts))]
    columns = zip(*rows) if rows else ([], [], [])
    return pa.table([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "nodes", "counts"])


def _sum_shared(table: pa.Table) -> pa.Table:
    """(node, shared) of all ranges, for one bucket of sets."""
    node, shared = (np.concatenate([np.frombuffer(x, np.int64) for x in table[name].to_pylist()]) for name in ("nodes", "counts"))
    distinct, place = np.unique(node, return_inverse=True)
    return pa.table({"node": pa.array(distinct), "shared": pa.array(np.bincount(place, shared, len(distinct)).astype(np.int64))})


# -- clusters


def _shingle_batches(batches):
    """All shingles of each set: (shingle, size, node)."""
    for batch in batches:
        node = batch.column(0).to_numpy()
        for begin, ends, found, _ in _sets(batch.column(1)):
            n = np.diff(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (found.view(np.int64), np.repeat(n, n), np.repeat(node[begin:begin + len(n)], n))],
                names=["shingle", "n", "node"])


def _chain_batches(batches):
    """Links (a, b) between neighbours of the sorted index lists whose sizes fit; and, with a shingle, the first and the last entry of the
    task, as a list may go on in other tasks."""
    last = first = None
    for batch in batches:
        shingle, n, node = (batch.column(i).to_numpy() for i in range(3))
        if not len(shingle):
            continue
        if last is not None:
            shingle, n, node = (np.concatenate(([x], y)) for x, y in zip(last, (shingle, n, node)))
        first = first or (shingle[0], n[0], node[0])
        last = (shingle[-1], n[-1], node[-1])
        linked = (shingle[1:] == shingle[:-1]) & (node[1:] != node[:-1]) & fits(n[:-1], n[1:])
        a, b = np.maximum(node[1:], node[:-1])[linked], np.minimum(node[1:], node[:-1])[linked]
        pairs = np.unique(np.stack((a, b), axis=1), axis=0)
        yield _chained(pairs[:, 0], pairs[:, 1], pa.nulls(len(pairs), pa.int64()))
    if first:
        shingle, n, node = (np.array(x, np.int64) for x in zip(first, last))
        yield _chained(n, node, pa.array(shingle))


def _chained(a: np.ndarray, b: np.ndarray, shingle: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), shingle], names=["a", "b", "shingle"])


def _edge_links(edges: pa.Table) -> pa.Table:
    """Links between the entries where tasks meet: neighbours among the first and last entries of all tasks, two of each."""
    n, node, shingle = (edges[name].to_numpy() for name in ("a", "b", "shingle"))
    order = np.lexsort((node, n, shingle))
    n, node, shingle = n[order], node[order], shingle[order]
    linked = (shingle[1:] == shingle[:-1]) & (node[1:] != node[:-1]) & fits(n[:-1], n[1:])
    return pa.table({"a": np.maximum(node[1:], node[:-1])[linked], "b": np.minimum(node[1:], node[:-1])[linked]})


# -- the join of one cluster, or of two blocks of it


class Block:
    """An index over sets: for each shingle the sets that have it, by size, with the shingle's place in each."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.vocabulary, number = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True)
        self.ends = np.concatenate(([0], np.cumsum(self.sizes)))
        self.numbers = [number[self.ends[i]:self.ends[i + 1]] for i in range(len(sets))]
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        place = np.arange(len(number)) - self.ends[owner]
        order = np.lexsort((self.sizes[owner], number))
        self.owner, self.place = owner[order], place[order]
        self.starts = np.searchsorted(number[order], np.arange(len(self.vocabulary) + 1))
        self.rest = self.sizes[self.owner] - self.place  # shingles from the place on: bounds what is still shared

    def lookup(self, shingles: np.ndarray) -> np.ndarray:
        """Numbers of the shingles that the index knows."""
        place = np.minimum(np.searchsorted(self.vocabulary, shingles), max(len(self.vocabulary) - 1, 0))
        return place[self.vocabulary[place] == shingles] if len(self.vocabulary) else place[:0]

    def has_candidate(self, shingles: np.ndarray, itself: int) -> bool:
        """Whether a set other than `itself` in the lists of the first shingles could be similar. Lists are read in blocks of `SKIP` entries; a block
        is skipped if neither its sizes nor its places let an entry reach the overlap."""
        n = len(shingles)
        for place, shingle in enumerate(shingles[:n - int(least_own(np.int64(n))) + 1]):
            known = self.lookup(shingles[place:place + 1])
            if not len(known):
                continue
            begin, end = self.starts[known[0]], self.starts[known[0] + 1]
            for at in range(begin, end, SKIP):
                upto = min(at + SKIP, end)
                low, high = self.sizes[self.owner[at]], self.sizes[self.owner[upto - 1]]
                if high < n and not fits(high, n) or low > n and not fits(n, low):
                    continue
                sizes, rest = self.sizes[self.owner[at:upto]], self.rest[at:upto]
                if rest.max() < least_overlap(low, n):
                    continue
                able = np.minimum(rest, n - place) >= least_overlap(sizes, n)
                if (able & (self.owner[at:upto] != itself)).any():
                    return True
        return False

    def _add(self, overlap: np.ndarray, numbers: np.ndarray, sign: int) -> None:
        begin, many = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        overlap += sign * np.bincount(self.owner[at], minlength=len(overlap))

    def overlaps(self, sets: list[np.ndarray], indexed: bool) -> Iterator[tuple[int, np.ndarray | None]]:
        """For each set (the index's own sets in their order, if `indexed`) its overlaps with all sets of the index, None if none can be similar. A set's overlaps are derived from
        the last answered one's where reading the lists in which they differ is less work than reading its own."""
        known_numbers, known_overlap = None, None
        for i, shingles in enumerate(sets):
            numbers = self.lookup(shingles)
            own = (self.starts[numbers + 1] - self.starts[numbers]).sum()
            if known_numbers is not None:
                more = np.setdiff1d(numbers, known_numbers, assume_unique=True)
                less = np.setdiff1d(known_numbers, numbers, assume_unique=True)
                changed = np.concatenate((more, less))
                if (self.starts[changed + 1] - self.starts[changed]).sum() < own:
                    known_overlap = known_overlap.copy()
                    self._add(known_overlap, more, 1)
                    self._add(known_overlap, less, -1)
                    known_numbers = numbers
                    yield i, known_overlap
                    continue
            if not self.has_candidate(shingles, i if indexed else -1):
                yield i, None
                continue
            known_numbers, known_overlap = numbers, np.zeros(len(self.sizes), np.int64)
            self._add(known_overlap, numbers, 1)
            yield i, known_overlap


def join_block(
    nodes: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], side: np.ndarray, across: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """Links and component of each set among those of a task. If `across`, `side` tells two blocks apart, 0 and 1, and only
    links between them count. A link counts as often as the partner has copies; a component is named by its least node."""
    order = np.lexsort((nodes, [len(s) for s in sets]))
    asking = order[side[order] == 0] if across else order
    indexed = order[side[order] == 1] if across else order
    block, sizes = Block([sets[i] for i in indexed]), np.array([len(s) for s in sets], np.int64)
    links, parent = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    for i, overlap in block.overlaps([sets[i] for i in asking], not across):
        if overlap is None:
            continue
        me = asking[i]
        partners = indexed[overlap >= least_overlap(block.sizes, sizes[me])]
        partners = partners[partners != me]
        if not len(partners):
            continue
        links[me] += copies[partners].sum()
        if across:
            links[partners] += copies[me]
        roots = {_root(parent, me), *(_root(parent, p) for p in np.unique(parent[partners]))}
        top = min(roots, key=lambda r: nodes[r])
        parent[list(roots)] = top
        parent[partners] = top
        parent[me] = top
    return links, nodes[[_root(parent, i) for i in range(len(nodes))]]


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _join_group(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    nodes, copies, side = (table[name].to_numpy() for name in ("node", "copies", "side"))
    sets = []
    for _, ends, found, _ in _sets(table["text"].combine_chunks()):
        sets += [found[ends[i]:ends[i + 1]] for i in range(len(ends) - 1)]
    across = table["i"][0].as_py() != table["j"][0].as_py()
    links, component = join_block(nodes, copies, sets, side, across)
    blocks = table["blocks"]
    return pa.table({"node": nodes, "links": links, "component": component, "blocks": blocks})


# -- the whole join


def similar(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id and n_links.

    A set has the distinct runs of five words, A-Z in lower case; a text of fewer words its whole sequence as one. A null text or
    one without words has an empty set, linked with nothing. `component_id` is the smallest doc_id reachable by links, its
    own included; `n_links` counts the linked rows other than itself, equal texts among them. Rows of one doc_id are rows like
    others. A row without doc_id takes part; its component is named by the ids of others, null if there is none."""
    return _joined_rows(docs, []).select("doc_id", "n_shingles", "component_id", "n_links")


def groups(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Like `similar`, with the columns `carry` of `docs` beside doc_id, and `group`, which tells components apart also where rows of one
    doc_id have different texts; null for empty sets. For callers that judge rows, not ids."""
    return _joined_rows(docs, carry).select("doc_id", *carry, "component_id", "group")


def _joined_rows(docs: DataFrame, carry: list[str]) -> DataFrame:
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    kinds = "".join(f"{name} {kind}, " for name, kind in rows.dtypes if name in carry)
    keys = written(rows.mapInArrow(_key_batches, f"doc_id long, {kinds}n long, node long"), "set-keys")
    classes = written(keys.filter("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")), "set-classes", at_most=keys.count())
    sets = _possible_sets(rows.select("doc_id", "text"), classes)
    clusters = _clusters(sets)
    joined = _joined(sets, clusters)
    whole = classes.join(joined, "node", "left").select(
        "node", "rep", "copies", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    names = whole.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = whole.join(names, "component").select(
        F.col("node").alias("class"), "component_id", F.col("component").alias("group"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"))
    found = keys.join(named, (keys["node"] == named["class"]) & (keys["n"] > 0), "left")
    own = F.col("n") == 0
    return found.select(
        "doc_id", *carry, F.col("n").alias("n_shingles"), "group",
        F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(own, 0).otherwise(F.col("n_links")).alias("n_links"))


def _possible_sets(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, copies, n, text) of the classes with enough shared shingles to be similar to another."""
    total, count = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    bits = max(0, int(total // RANGE_SHINGLES).bit_length())
    ranged = rows.filter(F.col("text").isNotNull()).select("text").mapInArrow(
        lambda batches: _range_batches(batches, bits), "part long, low binary, many binary, flags binary, keys binary")
    counted = ranged.groupBy("part").applyInArrow(
        lambda table: _count_shared(table, bits), "bucket long, nodes binary, counts binary")
    shared = counted.groupBy("bucket").applyInArrow(_sum_shared, "node long, shared long")
    enough = F.col("shared") * SHARE[1] >= F.col("n") * SHARE[0]
    possible = written(classes.join(shared, "node").filter(enough).select("node", "rep", "copies", "n"), "set-possible", at_most=count)
    wanted = possible.select(F.col("rep").alias("doc"), "node", "copies", "n")
    if possible.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("doc")))
    # Of rows that share an id only those with the class's set stand for it, and of equal rows one.
    checked = texts.mapInArrow(_same_sets, "node long, copies long, n long, text string")
    return written(checked.groupBy("node").agg(*(F.max(c).alias(c) for c in ("copies", "n", "text"))), "set-texts")


def _same_sets(batches):
    for batch in batches:
        node, text = batch.column("node"), batch.column("text")
        keys = np.concatenate([np.zeros(0, np.int64), *(key for _, _, _, key in _sets(text))])
        same = pa.array(keys == node.to_numpy())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).filter(same) for c in ("node", "copies", "n", "text")], names=["node", "copies", "n", "text"])


def _clusters(sets: DataFrame) -> DataFrame:
    rows = sets.select("node", "text").mapInArrow(_shingle_batches, "shingle long, n long, node long")
    many = rows.groupBy(F.col("shingle").alias("counted")).agg(F.count(F.lit(1)).alias("many")).filter("many > 1")
    common = rows.join(many, F.col("shingle") == F.col("counted")).select("node", "n", "many", "shingle")
    by_set = common.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("many", "shingle"))).alias("shared"))
    # The first quarter of all a set's shingles: those that no other set has come first, and lead nowhere.
    quarter = F.col("n") - F.ceil(F.col("n") * SHARE[0] / SHARE[1]) + 1
    reach = (quarter - (F.col("n") - F.size("shared"))).cast("int")
    first = F.explode(F.slice("shared", F.lit(1), reach)["shingle"])
    indexed = by_set.filter(reach > 0).select(first.alias("shingle"), "n", "node")
    # Cut by range, as one shingle may be in very many sets: a list goes on in the next task.
    lists = written(indexed, "set-lists").repartitionByRange("shingle", "n", "node").sortWithinPartitions("shingle", "n", "node")
    chains = written(lists.select("shingle", "n", "node").mapInArrow(_chain_batches, "a long, b long, shingle long"), "set-chains")
    edges = _edge_links(chains.filter("shingle IS NOT NULL").toArrow())  # four numbers per task
    links = chains.filter("shingle IS NULL").select("a", "b").unionByName(
        sets.sparkSession.createDataFrame(edges.to_pandas(), "a long, b long")).distinct()
    # A cluster has sets only.
    found = connected_components(links).withColumnRenamed("component", "cluster")
    return written(found, "set-clusters", at_most=sets.count())


def _joined(sets: DataFrame, clusters: DataFrame) -> DataFrame:
    """(node, component, links) of all sets in clusters."""
    sized = clusters.join(sets.select("node", "n"), "node").groupBy("cluster").agg(F.sum("n").alias("size"))
    blocks = sized.select("cluster", F.ceil(F.col("size") / BLOCK_SHINGLES).alias("blocks"))
    placed = clusters.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    meetings = placed.select("node", "cluster", "blocks", "block", others).select(
        "node", "cluster", "blocks", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).cast("long").alias("side"))
    full = meetings.join(sets.select("node", "copies", "text"), "node").select(
        "cluster", "i", "j", "side", "node", "copies", "text", "blocks")
    found = written(full.groupBy("cluster", "i", "j").applyInArrow(
        _join_group, "node long, links long, component long, blocks long"), "set-links")
    whole = found.filter("blocks = 1").select("node", "component", "links")
    split = found.filter("blocks > 1")
    if split.isEmpty():
        return whole
    counted = split.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(split.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return whole.unionByName(counted.join(parts, "node").select("node", "component", "links"))
