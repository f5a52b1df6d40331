"""A window network over hashed words, trained on every window of a corpus by minibatches.

Units.  Every word is hashed to one of `units` ids, whose number grows with the corpus (`units_for`) and has no upper
bound; no dictionary is kept.  Ids follow from the words alone, so they are the same on every machine.

Network.  The vectors of `window` neighbours on each side, each weighted by a vector of its position, and a constant
are summed; a Huffman tree over the units turns the sum into the probability of the middle word.  The probabilities of
all units sum to one.  Each inner node starts from the corpus' counts, so training starts from the word frequencies.
The heaviest TOP inner nodes, which make up most of every path, are handled as one matrix, the others one by one.

Training.  The documents are dealt to as many tasks as the session has cores, in `rounds` slices by a hash of the text.
In each round every task trains its own copy on all windows of its part of the slice; the copies are averaged, each
row by how often its task met it, in tasks of the cluster.  So each window is trained on once, and what the driver
holds is one model.  The average depends a little on how many tasks there are.
"""

from __future__ import annotations

import dataclasses
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

DIM, BATCH, BLOCK, TOP = 16, 2048, 4096, 64
LONG, SLICE = 64, 1 << 20  # bytes


def units_for(n_bytes: int) -> int:
    """The number of units for a corpus of so many bytes: it grows as a corpus' words do, a power below 1."""
    return max(256, int(n_bytes**0.65 / 8))


_ROOT, _STEP, _LAST = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))


def hash_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words in bytes that go on for at least 8 more: eight bytes at a time for all words at once, by
    crc32 one by one for the few above LONG bytes."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = lengths.astype(np.uint64) * _ROOT
    live = np.flatnonzero(lengths <= LONG)
    for done in range(0, LONG, 8):
        live = live[lengths[live] > done]
        if not len(live):
            break
        beyond = np.maximum(8 - (lengths[live] - done), 0).astype(np.uint64) * np.uint64(8)
        mixed = (out[live] ^ (eights[starts[live] + done] << beyond)) * _STEP
        out[live] = mixed ^ (mixed >> np.uint64(32))
    for k in np.flatnonzero(lengths > LONG):
        out[k] ^= np.uint64(zlib.crc32(data[starts[k] : starts[k] + lengths[k]]))
    out *= _LAST
    return out ^ (out >> np.uint64(29))


class Encoder:
    """Texts to unit ids, with `window` boundaries (the id `units`) before, between and after them."""

    def __init__(self, units: int, window: int) -> None:
        self.units, self.window = units, window

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, in order, and how many each text has.  Words end at ASCII white space."""
        texts = texts.fill_null("").cast(pa.large_string())
        _, offsets, held = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        n = int(bounds[-1] - bounds[0])
        data = np.zeros(n + 8, np.uint8)
        if n:
            data[:n] = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        inside = (data[:n] != 32) & (data[:n] - 9 > 4)  # unsigned: bytes below 9 wrap round
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = bounds[(bounds > 0) & (bounds < n)]
        first[cuts], last[cuts - 1] = inside[cuts], inside[cuts - 1]
        starts = np.flatnonzero(first)
        hashes = hash_words(data, starts, np.flatnonzero(last) + 1 - starts)
        return (hashes % np.uint64(self.units)).astype(np.int32), np.diff(np.searchsorted(starts, bounds))

    def words(self, text: str | None) -> np.ndarray:
        return self.encode(pa.array([text], pa.string()))[0]

    def sequence(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.joined(np.concatenate([np.empty(0, np.int32), *texts]), np.array([len(ids) for ids in texts], np.int64))

    def joined(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sequence of the texts that have words, from what `encode` gives."""
        counts = counts[counts > 0]
        out = np.full(len(ids) + self.window * (len(counts) + 1), self.units, np.int32)
        out[np.arange(len(ids)) + self.window * np.repeat(np.arange(1, len(counts) + 1), counts)] = ids
        return out


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in order, in slices of about SLICE bytes, so that memory follows the longest text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // SLICE)) + 1).tolist(), len(ends)]
    for begin, end in itertools.pairwise(cuts):
        yield texts.slice(begin, end - begin)


class Tree:
    """A Huffman tree over the units: for each unit the inner nodes on its path, from the leaf upwards, and the side
    taken.  Inner nodes are numbered from the heaviest, so those below `top` are the upper part of every path."""

    def __init__(self, counts: np.ndarray) -> None:
        n = len(counts)
        order = np.argsort(counts, kind="stable")
        weight = [int(x) + 1 for x in counts[order]]
        parent, right = np.zeros(2 * n - 1, np.int32), np.zeros(2 * n - 1, bool)
        odds = np.zeros(n - 1, np.float32)
        leaf, inner = 0, n
        for new in range(n, 2 * n - 1):
            pair = []
            for _ in range(2):
                if leaf < n and (inner >= new or weight[leaf] <= weight[inner]):
                    pair.append(leaf)
                    leaf += 1
                else:
                    pair.append(inner)
                    inner += 1
            a, b = pair
            parent[a] = parent[b] = new
            right[b] = True
            weight.append(weight[a] + weight[b])
            odds[new - n] = np.log(weight[b] / weight[a])
        self.odds = odds[::-1].copy()  # weights rise with the number of a node: the root is the last
        self.top = min(TOP, n - 1)
        root = 2 * n - 2
        leaves = np.empty(n, np.int64)
        leaves[order] = np.arange(n)
        self.depth = np.zeros(n, np.int32)
        at, live = leaves.copy(), np.arange(n)
        while len(live):
            at[live] = parent[at[live]]
            self.depth[live] += 1
            live = live[at[live] != root]
        self.start = np.cumsum(self.depth, dtype=np.int64) - self.depth
        self.nodes, self.sign = np.empty(self.depth.sum(), np.int32), np.empty(self.depth.sum(), np.int8)
        at, to, live = leaves, self.start.copy(), np.arange(n)
        while len(live):
            self.nodes[to[live]] = root - parent[at[live]]
            self.sign[to[live]] = 2 * right[at[live]] - 1
            at[live] = parent[at[live]]
            to[live] += 1
            live = live[at[live] != root]
        self.low = np.add.reduceat(self.nodes >= self.top, self.start).astype(np.int16)  # nodes of the path below the top

    def upper(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the upper parts of the units' paths: which of the units, the nodes, the signs."""
        low, depth = self.low[units], self.depth[units]
        which = np.repeat(np.arange(len(units)), depth - low)
        at = np.arange(len(which)) + np.repeat(self.start[units] + depth - np.cumsum(depth - low), depth - low)
        return which, self.nodes.take(at), self.sign.take(at)


def _softplus(x: np.ndarray) -> np.ndarray:
    """log(1 + exp(x)) as doubles, for which log is much faster than log1p."""
    return np.log(1 + np.exp(np.minimum(x, 80)).astype(np.float64))


def _summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the sums of their values, and how often each occurs."""
    keys = np.sort(rows.astype(np.int64) << 32 | np.arange(len(rows)))  # faster than argsort
    rows, order = keys >> 32, keys & 0xFFFFFFFF
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    sums = np.add.reduceat(values.take(order, axis=0).view(np.complex64), starts, axis=0).view(np.float32)  # two floats at once
    return rows[starts], sums, np.diff(np.append(starts, len(rows)))


@dataclasses.dataclass
class Network:
    """table: vectors of the units and the boundary, then those of the inner nodes; squares: their summed gradients."""

    window: int
    tree: Tree
    table: np.ndarray
    squares: np.ndarray
    place: np.ndarray  # a vector for each position, then the constant
    place_squares: np.ndarray

    @property
    def units(self) -> int:
        return len(self.tree.depth)

    @classmethod
    def fresh(cls, counts: np.ndarray, window: int, seed: int = 5) -> Network:
        n = len(counts)
        table = np.zeros((2 * n, DIM), np.float32)
        table[: n + 1] = np.random.default_rng(seed).normal(0, 0.3, (n + 1, DIM))
        place = np.full((2 * window + 1, DIM), 1 / np.sqrt(2 * window), np.float32)
        return cls(window, Tree(counts), table, np.full(2 * n, 1e-3, np.float32), place, np.full(2 * window + 1, 1e-3, np.float32))

    def _sums(self, seq: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
        """The vectors of the sequence, the shifts of the neighbours, and the sum for each place."""
        w = self.window
        n = len(seq) - 2 * w
        e = self.table.take(seq, axis=0)
        shifts = [s for s in range(2 * w + 1) if s != w]
        h = np.repeat(self.place[-1:], n, axis=0)
        for p, s in enumerate(shifts):
            h += self.place[p] * e[s : s + n]
        return e, shifts, h

    def _words(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places with a word, from the longest lower part of a path to the shortest, the words, and how many of
        them have a first, second, ... node there: on every level these are the first places."""
        middle = seq[self.window : len(seq) - self.window]
        real = np.flatnonzero(middle < self.units)
        low = self.tree.low[middle[real]]
        real = real[np.argsort(-low, kind="stable")]
        return real, middle[real], len(real) - np.cumsum(np.bincount(low))[:-1]

    def _lower_level(self, at: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of these steps of paths, with the sums of their places: the rows, the signs, the vectors, the scores."""
        nodes, sign = self.tree.nodes.take(at), self.tree.sign.take(at)
        rows = nodes + (self.units + 1)
        outs = self.table.take(rows, axis=0)
        return rows, sign, outs, sign * (np.einsum("ij,ij->i", own, outs) + self.tree.odds.take(nodes))

    def _upper_levels(self, words: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the upper parts of the paths: which of the words, the nodes, the signs, the scores."""
        which, nodes, sign = self.tree.upper(words)
        z = (own @ self.upper.T).ravel().take(which * self.tree.top + nodes)
        return which, nodes, sign, sign * (z + self.tree.odds.take(nodes))

    @property
    def upper(self) -> np.ndarray:
        """The vectors of the upper inner nodes."""
        return self.table[self.units + 1 : self.units + 1 + self.tree.top]

    def _minibatches(self, seq: np.ndarray) -> Iterator[np.ndarray]:
        """The sequence in even parts of about BATCH places, with their neighbours."""
        w = self.window
        n = len(seq) - 2 * w
        parts = max(1, round(n / BATCH))
        for k in range(parts if n > 0 else 0):
            yield seq[k * n // parts : (k + 1) * n // parts + 2 * w]

    def log_probabilities(self, seq: np.ndarray) -> np.ndarray:
        """For each word of the sequence, in order."""
        out = [np.empty(0)]
        for piece in self._minibatches(seq):
            real, words, levels = self._words(piece)
            h = self._sums(piece)[2]
            own, first = h.take(real, axis=0), self.tree.start[words]
            losses = np.zeros(len(h))
            which, _, _, z = self._upper_levels(words, own)
            lost = np.bincount(which, _softplus(-z), len(real))
            for k, m in enumerate(levels):
                lost[:m] += _softplus(-self._lower_level(first[:m] + k, own[:m])[3])
            losses[real] = lost
            out.append(-losses[np.sort(real)])
        return np.concatenate(out)

    def train(self, seq: np.ndarray, touched: np.ndarray, rate: float = 0.1) -> None:
        """One step for each minibatch; touched: counts the uses of each row."""
        for piece in self._minibatches(seq):
            real, words, levels = self._words(piece)
            if not len(real):
                continue
            e, shifts, h = self._sums(piece)
            n, upper, first_node = len(h), self.upper, self.units + 1
            own, first = h.take(real, axis=0), self.tree.start[words]
            which, top, sign, z = self._upper_levels(words, own)
            pull = np.zeros((len(real), len(upper)), np.float32)
            pull.ravel()[which * len(upper) + top] = sign / (1 + np.exp(np.clip(z, -30, 30)))
            d_own = pull @ upper
            # rows that are met, and what each use adds: the lower nodes level by level, then the neighbours
            used = int(levels.sum())
            rows, d = np.empty(used + len(piece), np.int32), np.empty((used + len(piece), DIM), np.float32)
            begin = 0
            for k, m in enumerate(levels):
                rows[begin : begin + m], sign, outs, z = self._lower_level(first[:m] + k, own[:m])
                g = (sign / (1 + np.exp(np.clip(z, -30, 30))))[:, None]
                np.multiply(g, own[:m], out=d[begin : begin + m])
                outs *= g
                d_own[:m] += outs
                begin += m
            dh = np.zeros((n, DIM), np.float32)
            dh[real] = d_own
            rows[used:], de, dplace = piece, d[used:], np.empty_like(self.place)
            de[:] = 0
            for p, s in enumerate(shifts):
                de[s : s + n] += self.place[p] * dh
                dplace[p] = np.einsum("ij,ij->j", dh, e[s : s + n])
            dplace[-1] = dh.sum(axis=0)
            above = slice(first_node, first_node + len(upper)), pull.T @ own, np.bincount(top, minlength=len(upper))
            for rows, d, times in (above, _summed(rows, d)):
                self.squares[rows] += np.einsum("ij,ij->i", d, d) / DIM
                self.table[rows] += rate * d / np.sqrt(self.squares[rows])[:, None]
                touched[rows] += times
            self.place_squares += np.einsum("ij,ij->i", dplace, dplace) / DIM
            self.place += rate / 4 * dplace / np.sqrt(self.place_squares)[:, None]


def _encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The documents of a task as `Encoder.encode` gives them, joined until a minibatch is full."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch["text"]):
            held.append(encoder.encode(part))
            size += len(held[-1][0])
            if size >= BATCH:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def unit_counts(docs: DataFrame, units: int) -> np.ndarray:
    """How often each unit occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(units, np.int64)
        for ids, _ in _encoded(batches, Encoder(units, 1)):
            counts += np.bincount(ids, minlength=units)
        at = np.flatnonzero(counts)
        for low in range(0, len(at), 100_000):
            part = at[low : low + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[part])], ["unit", "n"])

    rows = docs.mapInArrow(run, "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(units, np.int64)
    counts[rows["unit"].to_numpy()] = rows["n"].to_numpy()
    return counts


def _train_round(docs: DataFrame, network: Network) -> None:
    """Train copies of the network on the documents, and put their average in its place."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        own = dataclasses.replace(given, table=given.table.copy(), squares=given.squares.copy(), place=given.place.copy(), place_squares=given.place_squares.copy())
        touched = np.zeros(len(own.table), np.float32)
        encoder = Encoder(own.units, own.window)
        for ids, counts in _encoded(batches, encoder):
            own.train(encoder.joined(ids, counts), touched)
        if not touched.any():
            return
        for k, low in enumerate(range(0, len(touched), BLOCK)):
            cut = slice(low, low + BLOCK)
            times = touched[cut, None]
            made = np.concatenate([own.table[cut] * times, (own.squares[cut] - given.squares[cut])[:, None], times], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([made.astype(np.float32).tobytes()], pa.binary())], ["block", "sums"])
        made = np.concatenate([own.place, (own.place_squares - given.place_squares)[:, None], np.ones((len(own.place), 1), np.float32)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array([made.astype(np.float32).tobytes()], pa.binary())], ["block", "sums"])

    def merge(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in group["sums"])
        return pa.table({"block": group["block"][:1], "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    kind = "block long, sums binary"
    for row in docs.mapInArrow(run, kind).groupBy("block").applyInArrow(merge, kind).toLocalIterator():
        sums = np.frombuffer(row["sums"], np.float32).reshape(-1, DIM + 2)
        met = np.flatnonzero(sums[:, -1])
        table, squares = (network.place, network.place_squares) if row["block"] < 0 else (network.table, network.squares)
        at = met + max(row["block"], 0) * BLOCK
        table[at] = sums[met, :DIM] / sums[met, -1:]
        squares[at] += sums[met, DIM]
    shared.destroy()


def fit_network(docs: DataFrame, window: int = 4, rounds: int = 4, units: int | None = None, text_col: str = "text") -> Network:
    """The network of the documents; units: as many as the size of the texts asks for, unless given."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"))
    if units is None:
        units = units_for(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    # one copy of the model for each core, however many splits the input has
    dealt = texts.coalesce(docs.sparkSession.sparkContext.defaultParallelism)
    network = Network.fresh(unit_counts(dealt, units), window)
    for k in range(rounds):
        _train_round(dealt.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == k), network)
    return network
