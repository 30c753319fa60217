"""N-gram Jaccard join by PartEnum signatures.

Two sets of sizes a and b with Jaccard similarity of at least p/q differ in at most
(a + b)(q - p)/(q + p) elements. Sizes are cut into bands, each so narrow that linked sets lie in one
band or in neighbours; every set takes part in the instance of its band and in the next one, whose
bound k on the differences is fixed by the band. In an instance the feature domain is cut into n1
groups of n2 cells by the features' hashes. Any set of k differences leaves a group in which at most
k2 cells differ, so the two sets agree on some n2 - k2 cells of it: a signature is the content of such
a subset of cells. Linked sets share at least one.

A signature of an empty projection says nothing, so it is emitted only by sets that have such in more
than one group: one group more than needed makes up for the others.

All links are found, and no list of pairs is made:

* equal sets collapse to one node first;
* the sets that share a signature are one group; groups of the same members count once;
* in each group, sets whose numbers of features by parts of the domain allow a link are connected, by a
  spanning forest: what is connected with a set needs no comparison with the rest of its tree;
* the connected sets, few and alike, are compared by their features in the same way.

A group of more sets than one task should hold is dealt to blocks. Its sets first meet one set, the hub. Those
that are near it are connected by that, so copies of one text in any number are done; only the far ones go to
all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import keep_buckets, map_batches, other_buckets, rows_of, written
from .components import components


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``n`` words, linked at a Jaccard similarity of ``num``/``den`` or more."""

    n: int = 5
    num: int = 80
    den: int = 100

    def differences(self, size: int) -> int:
        """Most elements in which linked sets of at most ``size`` elements differ."""
        return 2 * size * (self.den - self.num) // (self.den + self.num)

    def bands(self, most: int) -> np.ndarray:
        """First sizes of the bands up to a band that holds ``most``, and of the one after."""
        low = [1]
        while low[-1] <= most:
            low.append(low[-1] * self.den // self.num + 1)
        return np.array(low + [low[-1] * self.den // self.num + 1], dtype=np.int64)


@dataclass(frozen=True)
class Scheme:
    """``groups`` of ``cells``, of which a signature leaves out ``out``; ``spare`` groups more than the bound needs."""

    groups: int
    cells: int
    out: int
    spare: int


def scheme(k: int, sim: Similarity) -> Scheme:
    """How signatures are made for at most ``k`` differences: (groups - spare) * (out + 1) > k.

    More cells of fewer groups make a signature's content larger, so that fewer sets share it by
    chance, and signatures more numerous. Small sets are given many, for they have few features;
    for large sets the number of signatures is 0.6 to 0.8 per feature and instance at most.
    """
    if k <= 6:
        return Scheme(1, k + 3, k, 0)
    if k <= 20:
        return Scheme(k // 3 + 2, 4, 2, 1)
    groups = k // 2 + 1
    spare = 1 + groups // 12
    return Scheme(groups + spare, 3 if 6 * sim.num >= 5 * sim.den else 2, 1, spare)


def signatures(features: np.ndarray, sim: Similarity, bands: np.ndarray) -> np.ndarray:
    """Signatures of one set of sorted, well mixed 64-bit features."""
    n = len(features)
    if not n:
        return features
    mine = int(np.searchsorted(bands, n, side="right")) - 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(W.mix(features), dtype=np.uint64, out=total[1:])
    high = features >> np.uint64(32)
    out = []
    for band in (mine, mine + 1):
        k = sim.differences(int(bands[band + 1]) - 1)
        if k == 0:  # only equal sets are this close, and those are one node
            continue
        how = scheme(k, sim)
        n1, n2 = how.groups, how.cells
        cells = n1 * n2
        # a cell is a range of hashes, so it is a run of the sorted features
        edge = np.searchsorted((high * np.uint64(cells)) >> np.uint64(32), np.arange(cells + 1, dtype=np.uint64))
        content = np.diff(total[edge]).reshape(n1, n2)
        held = np.diff(edge).reshape(n1, n2)
        subsets = list(combinations(range(n2), n2 - how.out))
        empty = np.stack([held[:, s].sum(axis=1) == 0 for s in subsets], axis=1)
        # a set with empty signatures in no more groups than are to spare needs none of them
        few = how.spare and empty.any(axis=1).sum() <= how.spare
        use = ~empty if few else np.ones_like(empty)
        for j, subset in enumerate(subsets):
            where = np.arange(n1, dtype=np.uint64) * np.uint64(comb(n2, how.out)) + np.uint64(j)
            tag = W.mix(where + np.uint64(band << 40))
            out.append(W.mix(content[:, subset].sum(axis=1, dtype=np.uint64) + tag)[use[:, j]])
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def shingle_sets(batch: pa.RecordBatch, text: str, n: int) -> Iterator[tuple[int, np.ndarray]]:
    for row, _, _, h in W.each_text(rows_of(batch, text)):
        yield row, np.unique(W.ngrams(h, n))


def digest(features: np.ndarray) -> int:
    """64-bit digest of a set, as a signed long."""
    if not len(features):
        return 0
    total = W.mix(features + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(W.mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


#: Fewest and most parts of the feature domain in which a set's features are counted, as powers of two. Between
#: them there are as many parts as hold eight features or fewer each on average, so that the counts of long sets,
#: too, tell apart what overlaps by half.
CELL_BITS = (8, 13)


def counted(features: np.ndarray) -> bytes:
    """The packed numbers of a set's features in parts of the domain."""
    bits = int(np.clip((len(features) // 8).bit_length(), *CELL_BITS))
    return packed(np.bincount((features >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits))


def set_digests(docs: DataFrame, id_col: str, text_col: str, sim: Similarity) -> DataFrame:
    """(id, th, n_shingles, digest, cells) of every row; th is the hash of the text, cells the packed
    numbers of the set's features in parts of the domain."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for _, x in shingle_sets(batch, "text", sim.n):
            found.append((len(x), digest(x), counted(x)))
        count, digests, cells = zip(*found)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(count, pa.int64()), pa.array(digests, pa.int64()),
             pa.array(cells, pa.binary())], names=["id", "th", "n_shingles", "digest", "cells"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, th long, n_shingles long, digest long, cells binary")


#: Signatures that a task gathers before it sends them on.
FLUSH = 1 << 19


def signature_rows(docs: DataFrame, text_col: str, sim: Similarity) -> DataFrame:
    """(sig, digest, more) of the distinct sets, combined before the shuffle.

    The sets that share a signature among those a task has gathered are one row: the smallest digest, and the
    others' in a row as longs. However many documents share a signature, it has one row for each time a task
    sends what it has gathered.
    """
    def flush(sig: np.ndarray, digests: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((digests, sig))
        sig, digests = sig[order], digests[order]
        first = np.concatenate([[True], sig[1:] != sig[:-1]])
        head = np.flatnonzero(first)
        edge = np.concatenate([[0], np.cumsum(8 * (np.diff(np.append(head, len(sig))) - 1))]).astype(np.int32)
        more = pa.BinaryArray.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(edge), pa.py_buffer(digests[~first].tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(sig[head].view(np.int64)), pa.array(digests[head]), more], names=["sig", "digest", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = sim.bands(1 << 16), set()
        sigs, owner, size = [], [], 0
        for batch in batches:
            step = max(1, min(batch.num_rows, int(batch.num_rows * (2 << 20) / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, step):
                for _, x in shingle_sets(batch.slice(at, step), "text", sim.n):
                    d = digest(x)
                    if not len(x) or d in seen:
                        continue
                    if len(seen) >= 1 << 17:  # the memory of what was sent only saves repeats
                        seen.clear()
                    seen.add(d)
                    if len(x) >= bands[-2]:
                        bands = sim.bands(2 * len(x))
                    s = signatures(x, sim, bands)
                    sigs.append(s)
                    owner.append(np.full(len(s), d, dtype=np.int64))
                    size += len(s)
                    if size >= FLUSH:
                        yield flush(np.concatenate(sigs), np.concatenate(owner))
                        sigs, owner, size = [], [], 0
        if size:
            yield flush(np.concatenate(sigs), np.concatenate(owner))

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "sig long, digest long, more binary")


#: Sets of one signature, or sets of a cluster that share no hub, that one task compares at a time.
GROUP = 4096


def signature_groups(rows: DataFrame) -> DataFrame:
    """(gid, chunk, digest): the groups of two sets or more that share a signature, each group of members once.

    ``chunk`` is -1; a signature of more than GROUP sets has a gid of its own and its sets in chunks from 0.
    """
    def emit(run: np.ndarray, member: np.ndarray, sig: np.ndarray) -> pa.RecordBatch | None:
        """Rows of whole groups; ``run`` numbers the groups of ``member``, ``sig`` has each group's signature."""
        order = np.lexsort((member, run))
        run, member = run[order], member[order]
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (member[1:] != member[:-1])])
        run, member = run[new], member[new]
        head = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        size = np.diff(np.append(head, len(run)))
        # a digest of the members, whatever the signature
        total = np.add.reduceat(W.mix(member.view(np.uint64) + np.uint64(0x2F0B4A27)), head)
        gid = np.where(size > GROUP, W.mix(sig[run[head]].view(np.uint64)), W.mix(total + size.astype(np.uint64))).view(np.int64)
        at = np.arange(len(run)) - np.repeat(head, size)
        chunk = np.where(np.repeat(size, size) > GROUP, at // GROUP, -1)
        keep = np.repeat(size, size) > 1
        if not keep.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(gid, size)[keep]), pa.array(chunk[keep], pa.int32()), pa.array(member[keep])],
                                          names=["gid", "chunk", "digest"])

    def members(sig: np.ndarray, digests: np.ndarray, more: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The rows' signatures and digests, a row for each set."""
        edge = np.frombuffer(more.buffers()[1], dtype=np.int32)[more.offset:more.offset + len(more) + 1]
        extra = np.frombuffer(more.buffers()[2], dtype=np.int64)[edge[0] // 8:edge[-1] // 8] if edge[-1] > edge[0] else digests[:0]
        return np.concatenate([sig, np.repeat(sig, np.diff(edge) // 8)]), np.concatenate([digests, extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_sig, held = np.empty(0, np.int64), np.empty(0, np.int64)  # the sets of the last signature, which may go on
        sent = 0  # chunks of it that went out already

        def chunks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, held_sig, sent
            while len(held) > (0 if last and sent else 4 * GROUP):
                part, held = np.unique(held[:GROUP]), held[GROUP:]
                held_sig = held_sig[:len(held)]
                gid = np.full(len(part), W.mix(last_sig.view(np.uint64)).view(np.int64)[0])
                yield pa.RecordBatch.from_arrays([pa.array(gid), pa.array(np.full(len(part), sent), pa.int32()), pa.array(part)], names=["gid", "chunk", "digest"])
                sent += 1

        last_sig = np.empty(1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, member = members(batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2))
            end = batch.column(0)[batch.num_rows - 1].as_py()
            if len(held) and (held_sig[0] != sig[0]) and sent:
                yield from chunks(True)
            sig, member = np.concatenate([held_sig, sig]), np.concatenate([held, member])
            going = sig == end
            done = ~going
            if sent and (sig[done] == last_sig[0]).any():  # the long signature ends in this batch
                own = sig == last_sig[0]
                rest_sig, rest = sig[~own], member[~own]
                held_sig, held = sig[own], member[own]
                yield from chunks(True)
                sig, member, sent = rest_sig, rest, 0
                going = sig == end
                done = ~going
            if last_sig[0] != end:
                sent = 0
            if done.any():
                found, number = np.unique(sig[done], return_inverse=True)
                many = np.bincount(number) > 1
                use = many[number]
                if use.any():
                    out = emit(number[use], member[done][use], found)
                    if out is not None:
                        yield out
            held_sig, held, last_sig = sig[going], member[going], np.array([end], dtype=np.int64)
            yield from chunks(False)
        if len(held):
            if sent:
                yield from chunks(True)
            elif len(held) > 1:
                out = emit(np.zeros(len(held), dtype=np.int64), held, held_sig[:1])
                if out is not None:
                    yield out

    return (rows.repartition("sig").sortWithinPartitions("sig").mapInArrow(run, "gid long, chunk int, digest long")
            .dropDuplicates(["gid", "chunk", "digest"]))


def packed(counts: np.ndarray) -> bytes:
    """Counts two to a byte, cut off at 15; of the most parts there are, as bytes where they hold eight or more on average."""
    if len(counts) == 1 << CELL_BITS[1] and counts.sum() >= 8 * len(counts):
        return np.minimum(counts, 255).astype(np.uint8).tobytes()
    low = np.minimum(counts, 15).astype(np.uint8)
    return (low[0::2] | (low[1::2] << 4)).tobytes()


#: Pairs whose counts in 256 parts a task has in memory at a time; fewer where there are more parts.
PAIRS = 1 << 13


class Counts:
    """The counts of sets in parts of the domain, by the number of parts.

    Two sets are compared in the parts of the one that has fewer: the other's are added up. Counts that either set has
    cut off are cut off in both, so the differences of counts add up to no more than the sets differ by.
    """

    def __init__(self, cells: list[bytes]) -> None:
        most = 1 << CELL_BITS[1]
        length = np.array([len(c) for c in cells], dtype=np.int64)
        self.whole = length == most  # a byte for each part
        self.width = np.where(self.whole, most, 2 * length)
        self.at: dict[int, np.ndarray] = {}
        self.held: dict[int, np.ndarray] = {}  # all sets of so many parts or more
        finer = 0
        for width in sorted(set(self.width.tolist()), reverse=True):
            rows = np.flatnonzero(self.width >= width)
            self.at[width] = np.zeros(len(cells), dtype=np.int64)
            self.at[width][rows] = np.arange(len(rows))
            out = np.empty((len(rows), width), dtype=np.uint8)
            if finer:
                above = self.width >= finer
                sums = np.minimum(self.held[finer], 15)
                while sums.shape[1] > width:
                    sums = np.minimum(sums[:, 0::2] + sums[:, 1::2], 15)
                out[self.at[width][above]] = sums
            for use, wide in ((self.width == width) & ~self.whole, False), ((self.width == width) & self.whole, True):
                if use.any():
                    own = np.frombuffer(b"".join(cells[k] for k in np.flatnonzero(use)), dtype=np.uint8).reshape(use.sum(), -1)
                    if wide:
                        out[self.at[width][use]] = own
                    else:
                        out[self.at[width][use], 0::2] = own & 15
                        out[self.at[width][use], 1::2] = own >> 4
            self.held[width] = out
            finer = width

    def coarse(self) -> np.ndarray:
        """Counts in an eighth of the parts that all sets have."""
        if not self.held:
            return np.zeros((0, 1), dtype=np.int16)
        least = min(self.held)
        return np.minimum(self.held[least], 15).reshape(len(self.width), -1, 8).sum(axis=2, dtype=np.int16)

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How much the sets ``x`` and ``y``, pair by pair, differ in their counts."""
        out = np.zeros(len(x), dtype=np.int32)
        shared = np.minimum(self.width[x], self.width[y])
        for width in np.unique(shared).tolist():
            pairs, at, held = np.flatnonzero(shared == width), self.at[width], self.held[width]
            step = max(1, (PAIRS << CELL_BITS[0]) // width)
            for lo in range(0, len(pairs), step):
                use = pairs[lo:lo + step]
                a, b = held[at[x[use]]], held[at[y[use]]]
                cut = ~(self.whole[x[use]] & self.whole[y[use]])
                if width == 1 << CELL_BITS[1]:
                    a[cut], b[cut] = np.minimum(a[cut], 15), np.minimum(b[cut], 15)
                    out[use] = np.abs(a.astype(np.int16) - b).sum(axis=1, dtype=np.int32)
                else:  # at most 15 each, so 16 of them add up in a byte: eight bytes at a time
                    d = np.abs(a.view(np.int8) - b.view(np.int8)).view(np.uint64)
                    out[use] = d.reshape(len(d), 16, -1).sum(axis=1).view(np.uint8).sum(axis=1, dtype=np.int32)
        return out


def near_pairs(start: np.ndarray, far: np.ndarray, bipartite: np.ndarray, n: np.ndarray, cells: list[bytes], sim: Similarity) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose counts allow a link, inside the groups that begin at ``start``.

    In a bipartite group only pairs of a far and another set are looked at.
    """
    size = np.diff(np.append(start, len(n)))
    left_in = np.repeat(start + size, size) - np.arange(len(n))  # rows of the group from this one on
    counts = Counts(cells)
    coarse = counts.coarse()
    root, forest = np.arange(len(n)), []
    most = n * (sim.den - sim.num)
    group_of = np.repeat(np.arange(len(start)), size)
    for o in range(1, int(size.max(initial=0))):
        a = np.flatnonzero(left_in > o)
        b = a + o
        use = (root[a] != root[b]) & (~bipartite[a] | (far[a] != far[b]))
        use &= np.minimum(n[a], n[b]) * sim.den >= np.maximum(n[a], n[b]) * sim.num
        a, b = a[use], b[use]
        for at in range(0, len(a), PAIRS):
            x, y = a[at:at + PAIRS], b[at:at + PAIRS]
            bound = most[x] + most[y]
            fits = np.abs(coarse[x] - coarse[y]).sum(axis=1, dtype=np.int32) * (sim.den + sim.num) <= bound
            x, y, bound = x[fits], y[fits], bound[fits]
            fits = counts.apart(x, y).astype(np.int64) * (sim.den + sim.num) <= bound
            for i, j in zip(x[fits].tolist(), y[fits].tolist()):
                if root[i] != root[j]:
                    lo = start[group_of[i]]
                    part = root[lo:lo + size[group_of[i]]]
                    part[part == root[j]] = root[i]
                    forest.append((i, j))
    return forest


_NODE = "struct<digest:long,n:long>"


def _nodes(digests: pa.Array, n: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays([digests, n], names=["digest", "n"])


def _dealt(rows: DataFrame, key: str, chunks: str, share: Column, *columns: str) -> DataFrame:
    """The sets of long groups to the pairs (c, j) of a chunk and a block of far sets: the chunk's own, and the far ones.

    ``rows`` has a key, a digest, its ``chunk``, the group's number of ``chunks``, and ``away`` for far sets;
    ``share`` is the part of a block that a far set fills.
    """
    blocks = rows.where("away").groupBy(key).agg(F.ceil(F.sum(share)).cast("int").alias("blocks"))
    rows = rows.join(blocks, key)
    block = F.pmod(F.xxhash64("digest", F.lit(7)), F.col("blocks")).cast("int")
    own = rows.select(key, *columns, F.col("chunk").alias("c"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(False).alias("far"))
    to_all = rows.where("away").select(key, *columns, F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)).alias("c"), block.alias("j"), F.lit(True).alias("far"))
    return own.union(to_all)


def candidate_pairs(groups: DataFrame, nodes: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): edges that connect all sets which share a signature and may be similar by their counts.

    The counts of two sets in the parts of the domain differ by no more in all than the sets do, so sets whose
    counts differ by more than the similarity allows are not linked.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(rows: pa.Table) -> pa.RecordBatch:
            gid, c, j = (rows[k].to_numpy() for k in ("gid", "c", "j"))
            start = np.flatnonzero(np.concatenate([[True], (gid[1:] != gid[:-1]) | (c[1:] != c[:-1]) | (j[1:] != j[:-1])]))
            far = rows["far"].to_numpy(zero_copy_only=False) if rows.num_rows else np.empty(0, bool)
            forest = near_pairs(start, far, j >= 0, rows["n"].to_numpy(), rows["cells"].to_pylist(), sim)
            node = _nodes(rows["digest"].combine_chunks(), rows["n"].combine_chunks())
            a, b = (pa.array([x[k] for x in forest], pa.int64()) for k in (0, 1))
            return pa.RecordBatch.from_arrays([node.take(a), node.take(b)], names=["a", "b"])

        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if not rows.num_rows:
                continue
            last = [rows[k][rows.num_rows - 1].as_py() for k in ("gid", "c", "j")]
            going = np.all([rows[k].to_numpy() == v for k, v in zip(("gid", "c", "j"), last)], axis=0)
            cut = int(np.argmax(going))  # the last group may go on in the next batch
            if cut:
                yield found(rows.slice(0, cut).combine_chunks())
            held = rows.slice(cut)
        if held is not None and held.num_rows > 1:
            yield found(held.combine_chunks())

    placed = groups.join(nodes.select("digest", "n", "cells"), "digest")
    columns = ["gid", "digest", "n", "cells"]
    dealt = placed.where("chunk < 0").select(*columns, F.lit(0).alias("c"), F.lit(-1).alias("j"), F.lit(False).alias("far"))
    near = None
    if not groups.where("chunk >= 0").isEmpty():
        near, long_rows = _near_hubs(written(placed.where("chunk >= 0"), "long"), sim)
        dealt = dealt.union(_dealt(long_rows, "gid", "chunks", F.lit(1.0) / GROUP, "digest", "n", "cells").select(*columns, "c", "j", "far"))
    order = ["gid", "c", "j"]
    edges = dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, f"a {_NODE}, b {_NODE}")
    return edges if near is None else edges.union(near)


def _near_hubs(rows: DataFrame, sim: Similarity) -> tuple[DataFrame, DataFrame]:
    """Edges of the sets of long groups that are near their group's hub, and the rows with ``chunks`` and ``away``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hub = batch.column("n").to_numpy(), batch.column("hub")
            both = Counts(batch.column("cells").to_pylist() + hub.field("cells").to_pylist())
            apart = both.apart(np.arange(len(n)), np.arange(len(n)) + len(n)).astype(np.int64)
            away = apart * (sim.den + sim.num) > (n + hub.field("n").to_numpy()) * (sim.den - sim.num)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in ("gid", "chunk", "chunks", "digest", "n", "cells")], _nodes(hub.field("digest"), hub.field("n")),
                 pa.array(away)], names=["gid", "chunk", "chunks", "digest", "n", "cells", "hub", "away"])

    hubs = rows.groupBy("gid").agg(F.min(F.struct("digest", "n", "cells")).alias("hub"), (F.max("chunk") + 1).alias("chunks"))
    kind = f"gid long, chunk int, chunks int, digest long, n long, cells binary, hub {_NODE}, away boolean"
    judged = written(rows.join(hubs, "gid").mapInArrow(run, kind), "judged")
    return judged.where("not away").select(F.struct("digest", "n").alias("a"), F.col("hub").alias("b")), judged


def feature_sets(docs: DataFrame, id_col: str, text_col: str, nodes: DataFrame, n: int) -> DataFrame:
    """``nodes`` (digest, n, id, ...) with their ``features``; only rows of their ids are shuffled."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [x for _, x in shingle_sets(batch, "text", n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([digest(x) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64()),
             pa.array([x.tobytes() for x in found], pa.binary())], names=["digest", "n", "features"])

    key = F.struct(F.col(id_col).alias("id"))  # in a struct a null id equals another
    wanted = nodes.select(F.struct("id").alias("key")).distinct()
    rows = keep_buckets(docs.select(key.alias("key"), F.col(text_col).alias("text")), F.col("key"), wanted, F.col("key"))
    sets = map_batches(rows.join(wanted, "key", "left_semi").select("text"), run, "digest long, n long, features binary")
    # an id that repeats with other texts gives other sets too, and repeated rows the same one again
    return nodes.join(sets, ["digest", "n"]).groupBy(*nodes.columns).agg(F.first("features").alias("features"))


def _block_pairs(sets: DataFrame, *columns: str) -> DataFrame:
    """Each row of ``sets`` (digest, n, blocks, ...) to the pairs (i, j) of blocks that its block is in."""
    own = F.pmod(F.xxhash64("digest", "n"), F.col("blocks")).cast("int")
    return (sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*columns, "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))


#: Sets, and features of sets, that a block of a cluster holds on average at most.
BLOCK_SETS, BLOCK_FEATURES = 1024, 1 << 19


def compare(sizes: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
            copies: np.ndarray, sim: Similarity) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Numbers of links of each set, and a spanning forest of them, between the sets ``left`` and
    ``right`` (boolean); sets that are both meet each other once."""
    vocab, flat = np.unique(np.concatenate(sets), return_inverse=True)
    cut = np.concatenate([[0], np.cumsum(sizes)])
    links, forest, root = np.zeros(len(sets), dtype=np.int64), [], np.arange(len(sets))
    mark = np.zeros(len(vocab), dtype=np.int32)
    for i in np.flatnonzero(left):
        own = flat[cut[i]:cut[i + 1]]
        mark[own] = 1
        both = np.add.reduceat(mark[flat], cut[:-1])
        mark[own] = 0
        hit = right & (sim.den * both >= sim.num * (sizes + sizes[i] - both))
        hit &= ~left | (np.arange(len(sets)) > i)  # two of the same side meet once
        for j in np.flatnonzero(hit):
            links[i] += copies[j]
            links[j] += copies[i]
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                forest.append((int(i), int(j)))
    return links, forest


def compare_blocks(sets: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b, links): forest edges a-b, and numbers of links of a with b null.

    ``sets`` has (cluster, blocks, digest, n, copies, features). Each row goes to the pairs of blocks
    that its block is in; a pair of blocks is one group.
    """
    dealt = _block_pairs(sets, "cluster", "digest", "n", "copies", "features")

    def run(group: pa.Table) -> pa.Table:
        sizes, own = group["n"].to_numpy(), group["own"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group["features"]]
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = own == i, own == j
        links, forest = compare(sizes, sets, left, right, group["copies"].to_numpy(), sim)
        node = pa.StructArray.from_arrays([group["digest"].combine_chunks(), group["n"].combine_chunks()], names=["digest", "n"])
        at = np.flatnonzero(links)
        a = pa.array([*at.tolist(), *[x for x, _ in forest]], pa.int64())
        b = pa.array([*[None] * len(at), *[x for _, x in forest]], pa.int64())
        count = pa.array([*links[at].tolist(), *[None] * len(forest)], pa.int64())
        return pa.Table.from_arrays([node.take(a), node.take(b), count], names=["a", "b", "links"])

    node = "struct<digest:long,n:long>"
    return dealt.groupBy("cluster", "i", "j").applyInArrow(run, f"a {node}, b {node}, links long")


def link_forest(sizes: np.ndarray, sets: list[np.ndarray], far: np.ndarray, sim: Similarity) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets; where some are ``far``, of the links of those.

    The first set meets all, then each set that is not yet in its tree: sets of one tree need not meet.
    """
    vocab, flat = np.unique(np.concatenate(sets), return_inverse=True)
    cut = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    mark, root, forest = np.zeros(len(vocab), dtype=np.int32), np.arange(len(sets)), []
    some = bool(far.any())
    for i in np.flatnonzero(far) if some else range(len(sets)):
        if not some and i and root[i] == root[0]:
            continue
        own = flat[cut[i]:cut[i] + sizes[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[flat], cut)
        mark[own] = 0
        for j in np.flatnonzero(sim.den * both >= sim.num * (sizes + sizes[i] - both)):
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                forest.append((int(i), int(j)))
    return forest


def link_edges(sets: DataFrame, sim: Similarity) -> DataFrame:
    """(a, b): edges that connect all linked sets of each cluster; ``sets`` has (cluster, blocks, digest, n, features).

    A cluster of one block is one task's. In a longer one all sets meet the hub first, block by block; those
    that are not linked with it then meet the sets of all blocks.
    """
    def run(group: pa.Table) -> pa.Table:
        far = group["far"].to_numpy(zero_copy_only=False)
        forest = link_forest(group["n"].to_numpy(), [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group["features"]], far, sim)
        node = _nodes(group["digest"].combine_chunks(), group["n"].combine_chunks())
        a, b = (pa.array([x[k] for x in forest], pa.int64()) for k in (0, 1))
        return pa.Table.from_arrays([node.take(a), node.take(b)], names=["a", "b"])

    def meet_hub(group: pa.Table) -> pa.Table:
        features = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group["features"]]
        k = int(np.argmax(group["is_hub"].to_numpy(zero_copy_only=False)))
        n = group["n"].to_numpy()
        both = np.array([len(np.intersect1d(features[k], x, assume_unique=True)) for x in features])
        linked = sim.den * both >= sim.num * (n + n[k] - both)
        return pa.Table.from_arrays([group["cluster"], group["chunk"], group["chunks"], group["digest"], group["n"], group["features"],
                                     pa.array(~linked)], names=["cluster", "chunk", "chunks", "digest", "n", "features", "away"])

    columns = ["cluster", "digest", "n", "features"]
    edges = f"a {_NODE}, b {_NODE}"
    short = sets.where("blocks = 1").select(*columns, F.lit(False).alias("far")).groupBy("cluster").applyInArrow(run, edges)
    if sets.select("blocks").where("blocks > 1").isEmpty():
        return short
    chunk = F.pmod(F.xxhash64("digest", "n"), F.col("blocks")).cast("int")
    rows = written(sets.where("blocks > 1").select(*columns, chunk.alias("chunk"), F.col("blocks").alias("chunks")), "long")
    hubs = rows.groupBy("cluster").agg(F.min(F.struct("digest", "n")).alias("hub"))
    hub_rows = (rows.join(hubs, "cluster").where((F.col("digest") == F.col("hub.digest")) & (F.col("n") == F.col("hub.n")))
                .select(*columns, F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "chunks", F.lit(True).alias("is_hub")))
    kind = f"cluster {rows.schema['cluster'].dataType.simpleString()}, chunk int, chunks int, digest long, n long, features binary, away boolean"
    judged = written(rows.withColumn("is_hub", F.lit(False)).unionByName(hub_rows).groupBy("cluster", "chunk").applyInArrow(meet_hub, kind), "judged")
    near = judged.where("not away").join(hubs, "cluster").select(F.struct("digest", "n").alias("a"), F.col("hub").alias("b"))
    share = F.greatest(F.lit(1.0) / BLOCK_SETS, F.col("n") / BLOCK_FEATURES)
    rest = _dealt(judged, "cluster", "chunks", share, "digest", "n", "features").groupBy("cluster", "c", "j").applyInArrow(run, edges)
    return short.union(near).union(rest)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 sim: Similarity = Similarity(), count_links: bool = True) -> DataFrame:
    """(id, n_shingles, n_links, component): one row for each row of ``docs``.

    The component is the smallest id reachable by links, the row's own included; ``n_links`` counts
    the other rows that a row is linked with, equal ones among them. The count needs every two linked sets
    compared, in the tasks; with ``count_links=False`` the column is left out, and sets of one tree do not meet.

    A null or empty text, or one without words, has no shingles and is linked with nothing, not with
    another empty one either. A text of fewer words than a shingle is one shingle of its whole
    sequence. Rows that repeat an id come back as often as they came. A row whose id is null gets
    the smallest id it is linked with (null if it has none). An empty table gives an empty table.
    """
    found = grouped(docs, id_col, text_col, sim, count_links)
    return found.select("id", "n_shingles", *(["n_links"] if count_links else []),
                        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))


def grouped(docs: DataFrame, id_col: str, text_col: str, sim: Similarity, count_links: bool = False) -> DataFrame:
    """(id, th, n_shingles, n_links, part, component) of each row; part names its group, null without words."""
    base = written(set_digests(docs, id_col, text_col, sim), "sets")
    nodes = written(base.where("n_shingles > 0").groupBy("digest", F.col("n_shingles").alias("n"))
                    .agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.max("cells").alias("cells")), "nodes")

    node = F.struct("digest", "n")
    groups = written(signature_groups(signature_rows(docs, text_col, sim)), "groups")
    clusters = components(candidate_pairs(groups, nodes, sim), "a", "b").select(F.col("node.*"), F.col("component").alias("cluster"))
    wanted = nodes.select("digest", "n", "id", "copies").join(clusters, ["digest", "n"])
    size = wanted.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("total") / BLOCK_FEATURES)).cast("int")
    wanted = written(wanted.join(size.select("cluster", blocks.alias("blocks")), "cluster")
                     .select("cluster", "blocks", "digest", "n", "id", "copies"), "clusters")
    sets = feature_sets(docs, id_col, text_col, wanted, sim.n)
    if count_links:
        found = written(compare_blocks(sets, sim), "compared")
        edges = found.where("b is not null")
        links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    else:
        edges = link_edges(written(sets, "features"), sim)
    parts = components(edges, "a", "b")

    placed = nodes.withColumn("node", node).join(parts, "node", "left")
    if count_links:
        placed = placed.join(links, "node", "left").withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    else:
        placed = placed.withColumn("n_links", F.lit(None).cast("long"))
    placed = placed.select("node", "id", F.coalesce("component", "node").alias("part"), "n_links")
    least = placed.groupBy("part").agg(F.min("id").alias("component"))
    placed = placed.join(least, "part").select("node", "part", "component", "n_links")
    own = F.when(F.col("n_shingles") > 0, F.struct("digest", F.col("n_shingles").alias("n")))
    return (base.withColumn("node", own).join(placed, "node", "left")
            .select("id", "th", "n_shingles", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "part", "component"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     sim: Similarity = Similarity()) -> DataFrame:
    """One row of ``docs`` for each group of linked ones: that of the smallest id, null last, all columns as they are.

    Rows without words are in no group and stay. Of rows that repeat id and text any one stays.
    """
    found = grouped(docs, id_col, text_col, sim).where("part is not null")
    rank = F.struct(F.col("id").isNull().alias("no"), "id", "th")
    found = written(found.groupBy("part", "id", "th").agg(F.count("*").alias("times")), "groups")
    least = found.groupBy("part").agg(F.min(rank).alias("least"))
    acts = written(found.join(least, "part").select(F.struct("id", "th").alias("key"), "times", (rank != F.col("least")).alias("gone"))
                   .where("gone or times > 1"), "acts")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"))
    same = other_buckets(docs, key, acts, F.col("key"))
    rows = (keep_buckets(docs, key, acts, F.col("key")).select(F.struct("*").alias("row"), key.alias("key"))
            .join(acts, "key", "left").where("not coalesce(gone, false)"))
    lone = rows.where("times is null").select("row.*")
    one = rows.where("times is not null").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
    return same.union(lone).union(one)
