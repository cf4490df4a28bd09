"""Operator 10: documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

1. One pass takes each text's set (64-bit shingle hashes), its digest, and a count of all
   shingles in a table of fixed size. Equal sets become one class, named by its smallest id.
2. That table orders all shingles: rarely counted ones first. Two sets that may be linked share
   one among the first 20 % of each in this order (prefix filter, exact). The documents behind
   one such shingle form a group. The first shingle that two sets share stands at a place in
   each, and their overlap can't exceed what is left from there on: with its size and the place
   of the shingle a set tells the largest partner that it may have, and groups are cut where no
   smaller set reaches a larger one. So texts that have a template in common and too much of
   their own meet nobody, however many they are. Other pairs are ruled out by size and by the
   distance of parity bitmaps, which never exceeds the sets' difference. What is left joins
   documents to blocks, by a spanning forest of each group and never by all its pairs.
3. Each block's sets meet in a prefix tree, ordered by how many of them have a shingle. All
   sets walk it together, level by level: a branch holds the overlap with all documents below
   it, and ends when even the remaining lengths can't reach the bound, or when all that is below
   it was joined before. A block above TILE_SHINGLES is not one task's: all its sets meet a few
   pilots, and those that this joins to the largest component are settled. The others and the
   settled ones are cut into tiles; every two tiles meet but for two of settled sets.
4. The links' components, again without collecting them, give each document its answer.

Cases. Null and empty texts have no set and are linked with nothing. Fewer than five words are
one shingle. Rows that share a ``doc_id`` are one node, also if their texts differ; rows without
an id are linked with nothing and have no component. Ids are whole numbers. An empty table gives
an empty result. Other columns, whatever their names, are passed on by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import joins, scratch
from .components import components
from .shingles import mixed, shingle_set

#: Cells of the table that counts shingles; its size is fixed, whatever the corpus.
CELLS = 1 << 18
SLICES = 16
#: Tasks that add up the counts of all tasks.
SUMS = 16
#: Shingles of a block, or of one side of it, that one task compares, on average.
TILE_SHINGLES = 400_000
#: Groups above this skip the bitmaps and join their documents in a row.
GROUP_PAIRS = 4096
#: Shingles that are put in one tree, from as many blocks as it takes.
TREE_SHINGLES = 200_000
#: Sets of a large block that walk its tree first, sets that walk together, and states of theirs.
PILOTS, WALKERS, STATES = 16, 4096, 1_000_000
SIGNATURE_WORDS = (8, 64)


def required(a, b):
    """The overlap at which sets of these sizes are linked: 100 * o >= 80 * (a + b - o)."""
    return -(-4 * (a + b) // 9)


def sets_of(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n and digest of each row, written, and the table of counts."""

    def run(batches):
        counts, schema = np.zeros(CELLS, dtype=np.int64), pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())])
        for batch in batches:
            ids, sizes, digests = batch.column("doc_id").to_pylist(), [], []
            for text in batch.column("text"):
                own = shingle_set(text.as_py())
                sizes.append(len(own))
                digests.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                counts += np.bincount(cells(own), minlength=CELLS) if len(own) > CELLS // 8 else 0
                if len(own) <= CELLS // 8:
                    np.add.at(counts, cells(own), 1)
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=schema)
        parts = [p.tobytes() for p in np.split(counts, SLICES)]
        none = [None] * SLICES
        yield pa.RecordBatch.from_arrays([pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.binary()), pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    both = scratch.save(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, digest binary, slice int, counts binary"), "sets")

    def summed(batches):
        """The counts of a task's rows, added up as they come."""
        total = np.zeros((SLICES, CELLS // SLICES), dtype=np.int64)
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                total[k] += np.frombuffer(part.as_buffer(), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], names=["slice", "counts"])

    parts = both.filter("slice is not null").select("slice", "counts")
    some = parts.mapInArrow(summed, "slice int, counts binary")  # as many rows as this has tasks
    whole = some.repartition(SUMS).mapInArrow(summed, "slice int, counts binary").repartition(1).mapInArrow(summed, "slice int, counts binary")
    table = np.zeros(CELLS, dtype=np.int64)
    for row in whole.collect():  # SLICES rows, CELLS numbers in all
        table[row["slice"] * (CELLS // SLICES) : (row["slice"] + 1) * (CELLS // SLICES)] = np.frombuffer(row["counts"], dtype=np.int64)
    return both.filter("slice is null").select("doc_id", "n", "digest"), table


def cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def classes_of(sets: DataFrame) -> DataFrame:
    """digest, rep (smallest id) and rows of each set that is not empty; rows without id aside."""
    return sets.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))


def signature(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each bit; two bits a token, within limits.

    The bitmaps of two sets differ in no more bits than the sets do in tokens, also after the
    longer bitmap was folded to the length of the other.
    """
    words = min(SIGNATURE_WORDS[1], max(SIGNATURE_WORDS[0], 1 << int(np.ceil(np.log2(max(1, len(tokens) / 32))))))
    at = np.bincount((mixed(tokens) & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(at.astype(np.uint8)).tobytes()


def prefixes(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """doc_id, n, prefix (the first shingles in the global order) and sig of each row; written."""
    counts = docs.sparkSession.sparkContext.broadcast(table)  # CELLS numbers

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("sig", pa.binary())])
        for batch in batches:
            ids, sizes, firsts, sigs = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                own = shingle_set(text.as_py())
                if not len(own):
                    continue
                n = len(own)
                size = n - (4 * n + 4) // 5 + 1
                rarest = own[np.argsort(counts.value[cells(own)], kind="stable")[:size]]
                ids.append(doc_id)
                sizes.append(n)
                firsts.append(rarest.view(np.int64))
                sigs.append(signature(own))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], schema=schema)

    return scratch.save(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, prefix array<long>, sig binary"), "prefixes")


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def partnered(sizes: np.ndarray, reaches: np.ndarray) -> np.ndarray:
    """Which of these sets have another within their reach that they are within the reach of; by rising size."""
    before = np.concatenate([[-1], np.maximum.accumulate(reaches)])
    second = np.concatenate([[-1], np.maximum.accumulate(np.minimum(reaches, before[:-1]))])
    until = np.searchsorted(sizes, reaches, side="right")
    return np.where(reaches >= sizes, second[until], before[until]) >= sizes  # a set in its own reach is not its partner


def groups_of(firsts: DataFrame) -> DataFrame:
    """key, doc_id, star of every distinct group of documents that share a prefix shingle.

    A group is cut where the sizes rise beyond the reach of all smaller sets, and sets without a
    partner in it are left out. Groups with the same documents have the same key and are kept
    once. A very large group is passed on in pieces, in the order of sizes. All pieces have the
    group's first document and are a ``star``: only if each of its documents is joined to the
    first do documents of two pieces meet.
    """

    def run(batches):
        schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("star", pa.bool_())])
        seen: set[bytes] = set()
        keys, ids, stars = [], [], []

        def piece(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], star: bool):
            docs, sizes, reaches = (np.concatenate(p) for p in zip(*parts, strict=True))
            docs = np.unique(docs if star else docs[partnered(sizes, reaches)])
            if len(docs) < 2:
                return
            key = hashlib.md5(docs.tobytes() + (b"*" if star else b"")).digest()
            if key not in seen:
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                keys.append(pa.array([key] * len(docs), pa.binary()))
                ids.append(pa.array(docs))
                stars.append(pa.array(np.full(len(docs), star)))

        def record():
            return pa.RecordBatch.from_arrays([pa.concat_arrays(keys), pa.concat_arrays(ids), pa.concat_arrays(stars)], schema=schema)

        token, far, held, size, cut = None, -1, [], 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, docs, packed = (batch.column(c).to_numpy() for c in ("token", "doc_id", "packed"))
            sizes, reaches = packed >> 32, packed & 0xFFFFFFFF
            # each shingle's numbers lie above those of the one before it
            above = np.cumsum(np.concatenate([[0], tokens[1:] != tokens[:-1]])) << 40
            ahead = np.maximum.accumulate(np.concatenate([[far if tokens[0] == token else -1], above + reaches]))
            begins = above + sizes > ahead[:-1]
            token, far = tokens[-1], int(ahead[-1] - above[-1])
            cuts = np.concatenate([np.flatnonzero(begins), [len(tokens)]])
            if cuts[0] > 0:
                cuts = np.concatenate([[0], cuts])
            # alone in this batch and neither its first nor last: no group
            wide = np.flatnonzero((np.diff(cuts) > 1) | (np.arange(len(cuts) - 1) == 0) | (np.arange(len(cuts) - 1) == len(cuts) - 2))
            for k in wide.tolist():
                a, b = cuts[k], cuts[k + 1]
                if begins[a]:
                    if size > 1:
                        piece(held, cut)
                    held, size, cut = [], 0, False
                held.append((docs[a:b], sizes[a:b], reaches[a:b]))
                size += b - a
                if size > 4 * GROUP_PAIRS:  # pass on what is here; its first document links it with the rest
                    piece(held, True)
                    held, size, cut = [tuple(x[:1] for x in held[0])], 1, True
            if sum(map(len, ids)) > 50_000:
                yield record()
                keys, ids, stars = [], [], []
        if size > 1:
            piece(held, cut)
        if ids:
            yield record()

    # the largest set that may be linked, if this is the first shingle of both: n - at >= required(n, most)
    most = F.floor(9 * (F.col("n") - F.col("at")) / 4).cast("long") - F.col("n")
    rows = firsts.select("doc_id", "n", F.posexplode("prefix").alias("at", "token")).select("doc_id", "token", (F.shiftleft("n", 32) + most).alias("packed"))
    return rows.repartition("token").sortWithinPartitions("token", "packed", "doc_id").mapInArrow(run, "key binary, doc_id long, star boolean").distinct()


class Forest:
    """Union and find over the numbers below ``n``."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether this joined two trees."""
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def close_pairs(sizes: np.ndarray, sigs: list[bytes]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that size and bitmaps do not rule out; by rising size."""
    n, forest, out = len(sizes), Forest(len(sizes)), []
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    bits = [np.frombuffer(sigs[k], dtype=np.uint64) for k in order.tolist()]
    least = min(map(len, bits))
    same = len(set(map(len, bits))) == 1
    short = np.array([np.bitwise_xor.reduce(b.reshape(-1, least), axis=0) for b in bits])
    for a in range(n - 1):
        end = int(np.searchsorted(sizes, sizes[a] * 5 // 4, side="right"))
        if end <= a + 1:
            continue
        other = np.arange(a + 1, end)
        apart = np.bitwise_count(short[a] ^ short[a + 1 : end]).sum(axis=1, dtype=np.int64)
        other = other[apart <= sizes[a] + sizes[a + 1 : end] - 2 * required(sizes[a], sizes[a + 1 : end])]
        for b in other.tolist():
            if not same:  # again with all bits that both have
                x, y = bits[a], bits[b]
                m = min(len(x), len(y))
                gap = int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, m), axis=0) ^ np.bitwise_xor.reduce(y.reshape(-1, m), axis=0)).sum())
                if gap > sizes[a] + sizes[b] - 2 * required(int(sizes[a]), int(sizes[b])):
                    continue
            if forest.join(a, b):
                out.append((int(order[a]), int(order[b])))
    return out


def candidate_edges(groups: DataFrame, firsts: DataFrame) -> DataFrame:
    """a, b: edges that join all documents of a group which may be linked."""

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        left, right = [], []
        for rows in _runs(batches, "key"):
            docs = rows.column("doc_id").to_numpy()
            if len(docs) > GROUP_PAIRS or rows.column("star")[0].as_py():
                pairs = [(0, k) for k in range(1, len(docs))]
            else:
                pairs = close_pairs(rows.column("n").to_numpy(), rows.column("sig").to_pylist())
            left += [docs[a] for a, _ in pairs]
            right += [docs[b] for _, b in pairs]
            if len(left) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)
                left, right = [], []
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    known = groups.groupBy("doc_id").agg(F.count("*").alias("rows")).join(firsts.select("doc_id", "n", "sig"), "doc_id")
    met = joins.weighted_join(groups, known, ["doc_id"], "rows", "inner")
    return met.select("key", "doc_id", "star", "n", "sig").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


class Runs:
    """Rows that are known to be joined in a row, and the forest they are joined in."""

    def __init__(self, n: int) -> None:
        self.forest, self.last = Forest(n), list(range(n))
        self.joined: list[tuple[int, int]] = []

    def join(self, row: int, low: int, high: int) -> None:
        """Join ``row`` with all rows from ``low`` to ``high``; rows joined before cost nothing."""
        last = self.last
        while low < high:
            if self.forest.join(row, low):
                self.joined.append((row, low))
            while last[low] != low:
                last[low] = last[last[low]]
                low = last[low]
            if low + 1 < high:
                last[low] = low + 1
            low += 1

    def labels(self) -> np.ndarray:
        return np.array([self.forest.root(k) for k in range(len(self.last))], dtype=np.int64)


def shareable(block: np.ndarray, side: np.ndarray, owner: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Which shingles of the sets another set of their block, or of the other side of it, has."""
    width = int(token.max(initial=0)) + 1

    def often(group: np.ndarray) -> np.ndarray:
        return (lambda found: found[2][found[1]])(np.unique(group[owner] * width + token, return_inverse=True, return_counts=True))

    everywhere = often(block)
    return np.where(side[owner] == 0, everywhere > 1, everywhere > often(block * 3 + side))


def tree_links(blocks: np.ndarray, sets: list[np.ndarray], sides: np.ndarray) -> list[tuple[int, int]]:
    """A forest that joins the sets of a block as their links do, found by one prefix tree.

    ``sides`` is 0 for all sets that meet each other, or 1 and 2 for sets that meet only those
    of the other side. Shingles that no partner has are left out, and with them all sets that
    keep less than four of five. The others become rows of ranks and are sorted; a node of the
    tree is then a run of rows that agree so far. A state is a node, a set that walks the tree,
    and their overlap so far; at most STATES are held at once. A few pilots of each large block
    walk first: where they have joined all rows of a node with a set, that set needn't go.
    """
    _, block = np.unique(np.asarray(blocks), return_inverse=True)
    side, full = np.asarray(sides), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), full)
    values, token = np.unique(np.concatenate(sets), return_inverse=True)
    shared = shareable(block, side, owner, token)
    alive = 5 * np.bincount(owner[shared], minlength=len(sets)) >= 4 * full
    used = shared & alive[owner]
    owner, token = owner[used], token[used]
    rank = np.empty(len(values), dtype=np.int64)
    rank[np.argsort(-np.bincount(token, minlength=len(values)), kind="stable")] = np.arange(len(values))
    ranks = rank[token]
    ranks = ranks[np.lexsort((ranks, owner))]
    size = np.bincount(owner, minlength=len(sets))
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    # big-endian bytes compare as the rows of ranks do, and a row comes before its extensions
    named = sorted((int(block[k]), ranks[start[k] : start[k] + size[k]].astype(">u4").tobytes(), int(side[k]), int(full[k]), k) for k in np.flatnonzero(alive).tolist())
    if not named:
        return []
    rows = np.array([n[4] for n in named])
    # equal rows stand together, by side and then by full size
    equal_to = np.cumsum([True, *(x[:2] != y[:2] for x, y in zip(named[1:], named[:-1], strict=True))])
    size, start, block, side, full = size[rows], start[rows], block[rows], side[rows], full[rows]
    width, count = len(values) + 1, len(rows)
    keys = np.concatenate([ranks[start[place] : start[place] + size[place]] + width * place for place in range(count)])
    key_start = np.concatenate([[0], np.cumsum(size)])
    runs = Runs(count)

    def bounds(kind, of: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        return kind.reduceat(np.append(of, 0), np.stack([lows, highs], axis=1).ravel())[::2]

    def end(row: int, at: int, overlap: int) -> None:
        """Join ``row`` with the rows that equal row ``at`` and are of the other side and small enough."""
        low, high = at, int(np.searchsorted(equal_to, equal_to[at], side="right"))
        if side[row]:
            middle = low + int(np.searchsorted(side[low:high], 2))
            low, high = (middle, high) if side[row] == 1 else (low, middle)
        most = 9 * overlap // 4 - int(full[row])
        runs.join(row, low, low + int(np.searchsorted(full[low:high], most, side="right")))

    def walk(walkers: np.ndarray, pilots: bool) -> None:
        """Have ``walkers`` go down the tree, past all rows (pilots) or those that come later."""
        label = runs.labels()
        last = np.flatnonzero(np.concatenate([label[1:] != label[:-1], [True]]))
        until = last[np.searchsorted(last, np.arange(count))] + 1  # the end of each row's run of one label
        low = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        stack = [(walkers, np.searchsorted(low, walkers, side="right") - 1, np.zeros(len(walkers), dtype=np.int64), low, np.append(low[1:], count), 0)]
        while stack:
            walker, node, overlap, low, high, depth = stack.pop()
            # rows that have a shingle at this depth, cut into the children of the nodes
            place = np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low) + np.arange((high - low).sum())
            parent = np.repeat(np.arange(len(low)), high - low)
            live = size[place] > depth
            place, parent = place[live], parent[live]
            if not len(place):
                continue
            here = ranks[start[place] + depth]
            first = np.flatnonzero(np.concatenate([[True], (here[1:] != here[:-1]) | (parent[1:] != parent[:-1])]))
            low_next, high_next = place[first], place[np.append(first[1:], len(place)) - 1] + 1
            shingle, parent = here[first], parent[first]
            child_from = np.searchsorted(parent, np.arange(len(low)), side="left")
            fan = (np.searchsorted(parent, np.arange(len(low)), side="right") - child_from)[node]
            if fan.sum() > STATES and len(walker) > 1:
                half = len(walker) // 2
                for part in (slice(half, None), slice(half)):
                    kept, again = np.unique(node[part], return_inverse=True)
                    stack.append((walker[part], again, overlap[part], low[kept], high[kept], depth))
                continue
            least, most, shortest = bounds(np.minimum, full, low_next, high_next), bounds(np.maximum, size, low_next, high_next), bounds(np.minimum, size, low_next, high_next)
            again = np.repeat(np.arange(len(node)), fan)
            child = np.repeat(child_from[node] - np.concatenate([[0], np.cumsum(fan)[:-1]]), fan) + np.arange(len(again))
            walker, overlap = walker[again], overlap[again]
            useful = (label[low_next[child]] != label[walker]) | (until[low_next[child]] < high_next[child])
            if not pilots:  # each pair once: the row that walks comes first
                useful &= high_next[child] - 1 > walker
            child, walker, overlap = child[useful], walker[useful], overlap[useful]
            wanted = walker * width + shingle[child]
            found = np.searchsorted(keys, wanted, side="right")
            overlap = overlap + (keys[np.maximum(found, 1) - 1] == wanted)
            left = size[walker] - (found - key_start[walker])
            best = overlap + np.minimum(most[child] - depth - 1, left)
            going = 9 * best >= 4 * (full[walker] + least[child])
            child, walker, overlap = child[going], walker[going], overlap[going]
            # rows that end at this node come first in it
            for k in np.flatnonzero(shortest[child] == depth + 1).tolist():
                end(int(walker[k]), int(low_next[child[k]]), int(overlap[k]))
            kept, node = np.unique(child, return_inverse=True)
            if len(kept):
                stack.append((walker, node, overlap, low_next[kept], high_next[kept], depth + 1))

    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    large = [np.linspace(a, b - 1, PILOTS, dtype=np.int64) for a, b in zip(first, np.append(first[1:], count), strict=True) if b - a > 4 * PILOTS]
    if large:
        walk(np.concatenate(large), True)
    for k in range(0, count, WALKERS):
        walk(np.arange(k, min(count, k + WALKERS)), False)
    return [(int(rows[a]), int(rows[b])) for a, b in runs.joined]


def links(docs: DataFrame, seats: DataFrame) -> DataFrame:
    """a, b: a spanning forest of the links inside each tile and between two tiles that meet.

    ``seats``: doc_id, block, tile of the document, low and high, the tiles that its tile meets.
    """

    def sets(batches):
        seat = ["doc_id", "block", "tile", "low", "high"]
        schema = pa.schema([*((c, pa.int64()) for c in seat), ("n", pa.int64()), ("tokens", pa.binary())])
        for batch in batches:
            own = [shingle_set(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in seat), pa.array([len(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())], schema=schema)

    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        held, total = [], 0

        def flush():
            numbers = np.concatenate([np.full(len(t), k) for k, t in enumerate(held)])
            ids = np.concatenate([t.column("doc_id").to_numpy() for t in held])
            side = np.concatenate([t.column("side").to_numpy() for t in held])
            tokens = [np.frombuffer(x, dtype=np.uint64) for t in held for x in t.column("tokens").to_pylist()]
            pairs = tree_links(numbers, tokens, side)
            return pa.RecordBatch.from_arrays([pa.array([ids[a] for a, _ in pairs], pa.int64()), pa.array([ids[b] for _, b in pairs], pa.int64())], schema=schema)

        for rows in _runs(batches, "task"):
            held.append(rows)
            total += sum(rows.column("n").to_pylist())
            if total > TREE_SHINGLES:
                yield flush()
                held, total = [], 0
        if held:
            yield flush()

    rows = docs.select("doc_id", "text").join(_few(seats), "doc_id").mapInArrow(sets, "doc_id long, block long, tile long, low long, high long, n long, tokens binary")
    # a document of tile t goes to the task of every pair of tiles that has t
    rows = rows.withColumn("other", F.explode(F.sequence("low", "high")))
    side = F.when(F.col("tile") == F.col("other"), 0).when(F.col("tile") < F.col("other"), 1).otherwise(2).cast("long")
    task = F.concat_ws("/", "block", F.least("tile", "other"), F.greatest("tile", "other"))
    rows = rows.select("doc_id", "n", "tokens", side.alias("side"), task.alias("task"))
    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _few(df: DataFrame) -> DataFrame:
    """``df``, which is written and narrow, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(joins.BROADCAST_ROWS + 1).count() <= joins.BROADCAST_ROWS else df


def block_links(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """a, b: what joins the documents of each block as their links do. ``blocks``: doc_id, block, size, weight."""
    tiles = F.ceil(F.col("weight") / TILE_SHINGLES).cast("long")
    tile = F.pmod(F.xxhash64("doc_id"), F.col("tiles"))
    zero = F.lit(0).cast("long")
    held = blocks.withColumn("tiles", tiles)
    small = held.filter("tiles <= 1").select("doc_id", "block", zero.alias("tile"), zero.alias("low"), zero.alias("high"))
    large = held.filter("tiles > 1")
    if not large.limit(1).count():
        return links(docs, scratch.save(small, "seats"))
    # every set is in a tile of its own number, and the pilots, some PILOTS a block, meet each tile
    pilot = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("size")) < PILOTS
    first = large.select("doc_id", "block", (tile + 1).alias("tile"), zero.alias("low"), zero.alias("high"))
    pilots = large.filter(pilot).select("doc_id", "block", zero.alias("tile"), (zero + 1).alias("low"), F.col("tiles").alias("high"))
    near = scratch.save(links(docs, scratch.save(first.unionByName(pilots), "seats")), "pilot_links")
    found = components(near)
    label = F.coalesce("root", "doc_id")
    named = scratch.save(large.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(*large.columns, label.alias("label")), "labels")
    most = named.groupBy("block", "label").agg(F.count("*").alias("rows"), F.first("size").alias("size"), F.first("tiles").alias("tiles"))
    most = most.groupBy("block").agg(F.max_by("label", F.struct("rows", "label")).alias("main"), F.max("rows").alias("settled"), F.first("size").alias("size"), F.first("tiles").alias("all"))
    share = F.col("settled") / F.col("size")
    most = most.select("block", "main", "size", F.ceil(F.col("all") * (1 - share)).cast("long").alias("loose"), F.ceil(F.col("all") * share).cast("long").alias("rest"))
    # loose sets meet all tiles, settled ones the tiles of loose sets
    met = joins.weighted_join(named.select("doc_id", "block", "label"), scratch.save(most, "mains"), ["block"], "size", "inner").filter("loose > 0")
    settled = F.col("label") == F.col("main")
    number = F.when(settled, F.col("loose") + F.pmod(F.xxhash64("doc_id"), F.col("rest"))).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("loose")))
    last = F.when(settled, F.col("loose") - 1).otherwise(F.col("loose") + F.col("rest") - 1)
    seats = small.unionByName(met.select("doc_id", "block", number.alias("tile"), zero.alias("low"), last.alias("high")))
    return links(docs, scratch.save(seats, "seats")).unionByName(near)


def joined(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    scratch.bound_batches(docs.sparkSession)
    sets, table = sets_of(docs)
    classes = scratch.save(classes_of(sets), "classes")
    some = sets.filter("digest is not null and doc_id is not null")
    named = joins.weighted_join(some, classes.filter("rows > 1"), ["digest"], "rows")
    copy = F.coalesce(F.col("doc_id") != F.col("rep"), F.lit(False))
    ids = named.groupBy("doc_id").agg(F.min(copy).alias("copy"), (F.min("digest") != F.max("digest")).alias("several"))
    ids = scratch.save(ids.filter("copy or several"), "copies")
    copies, several = ids.filter("copy").select("doc_id"), ids.filter("several").select("doc_id")
    known = docs.select("doc_id", "text").filter("doc_id is not null")
    single = joins.keyed_filter(known, copies, ["doc_id"], "left_anti")
    firsts = prefixes(single, table)
    groups = scratch.save(groups_of(firsts), "groups")
    blocks = scratch.save(components(candidate_edges(groups, firsts)), "blocks")
    whole = blocks.select(F.col("node").alias("doc_id"), F.col("root").alias("block"))
    whole = whole.unionByName(blocks.select(F.col("root").alias("doc_id"), F.col("root").alias("block")).distinct())
    sizes = firsts.groupBy("doc_id").agg(F.sum("n").alias("n"))
    weights = whole.join(sizes, "doc_id").groupBy("block").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    sized = joins.weighted_join(whole, weights, ["block"], "size", "inner")
    edges = block_links(single, scratch.save(sized, "block_sizes"))
    if several.limit(1).count():  # the sets of one id are one node
        own = joins.keyed_filter(some, several, ["doc_id"], "left_semi").join(classes, "digest")
        edges = edges.unionByName(own.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = components(edges)
    linked = classes.join(found.select(F.col("node").alias("rep"), F.col("root").alias("component")), "rep", "left")
    named = scratch.save(linked.filter("rows > 1 or component is not null").select("digest", "rows", F.coalesce("component", "rep").alias("component")), "named")
    for passed in (found, blocks, groups, firsts):
        scratch.drop(passed)
    some = joins.weighted_join(some, named, ["digest"], "rows")
    rest = sets.filter("digest is null or doc_id is null").withColumn("component", F.lit(None).cast("long"))
    both = some.drop("rows").unionByName(rest)
    return both.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Rows without an id are in no component and stay; rows that repeat the id of the one that
    stays stay with it.
    """
    found = scratch.save(joined(docs.select("doc_id", "text")).filter("component_id <> doc_id").select("doc_id").distinct(), "near_copies")
    return joins.keyed_filter(docs, found, ["doc_id"], "left_anti").select(*docs.columns)
