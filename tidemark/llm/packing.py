"""Best-fit packing of tokenised documents after a dominance reduction.

Plan.  Documents are tokenised once, in Arrow batches, into a narrow table of pieces.  What the packing decides on is
the histogram of piece lengths: at most `capacity` numbers, whatever the corpus.  On it the driver runs

1. the reduction of Martello and Toth: a small set of lengths that dominates every other set with the same largest
   piece is fixed for good, with its multiplicity;
2. best-fit decreasing on what is left, again with multiplicities.

The result is a list of patterns, each used for a run of sequences.  Every piece then gets its rank among the pieces
of its length, which gives its sequence and offset.  Ranks come from salted groups of about `group` pieces, whatever
the size of the corpus.  The salt comes from a number that each piece gets from its task when it is written, not from
its content, so that neither a length that a third of all pieces share nor rows with one id, or none, meet in one task.

Cases.  A null text counts as empty; an empty document is its end token alone.  Documents longer than the capacity
are cut so that only their first piece is shorter.  Rows with null ids are packed like others; rows that repeat an id
are packed once each.  Texts of any length are encoded whole.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, staged
from .tokens import encoder

#: A pattern: (length, copies) runs, longest first.
Pattern = tuple[tuple[int, int], ...]


def _runs(sizes: list[int]) -> Pattern:
    return tuple(sorted(Counter(sizes).items(), reverse=True))


def _sums_between(sizes: list[int], low: int, high: int) -> bool:
    """Whether pieces of these sizes, as many as wanted, can sum to more than low and at most high."""
    reach, mask = 1, (1 << (high + 1)) - 1
    for s in sizes:
        if s <= high:
            step = s
            while step <= high:  # doubling: any number of copies
                reach |= (reach << step) & mask
                step *= 2
    return reach >> (low + 1) != 0


def _dominating(hist: Counter, big: int, capacity: int) -> list[int] | None:
    """Lengths that together dominate every feasible set that holds a piece of length big, or None."""
    rest = Counter({s: n for s, n in hist.items() if n})
    rest[big] -= 1
    room = capacity - big
    fitting = sorted(s for s, n in rest.items() if n > 0 and s <= room)
    if not fitting:
        return [big]
    best = fitting[-1]
    if best == room or not _sums_between(fitting, best, room):
        return [big, best]  # whatever else would go beside big, best alone replaces it
    smallest = [s for s in fitting[:3] for _ in range(min(3, rest[s]))][:3]
    if len(smallest) < 3 or sum(smallest) > room:  # two more at the most
        rest[best] -= 1
        second = [s for s in fitting if rest[s] > 0 and s <= room - best]
        if second:
            above = [s for s in fitting if s > second[-1] for _ in range(min(2, rest[s] + (s == best)))][:2]
            if len(above) < 2 or sum(above) > room:  # no pair is larger in both places
                return [big, best, second[-1]]
    return None


def reduce_by_dominance(hist: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """Fix dominating sets until none is found; the patterns with their numbers, and the lengths that remain."""
    left, fixed, changed = Counter(hist), [], True
    while changed:
        changed = False
        for big in sorted((s for s, n in left.items() if n), reverse=True):
            while left[big] > 0 and (chosen := _dominating(left, big, capacity)):
                need = Counter(chosen)
                times = min(left[s] // k for s, k in need.items())
                for s, k in need.items():
                    left[s] -= k * times
                fixed.append((_runs(chosen), times))
                changed = True
    return fixed, {s: n for s, n in left.items() if n}


def best_fit_decreasing(hist: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Longest first, each piece into the fullest open sequence that takes it; equal sequences are handled together."""
    opened: dict[int, Counter] = defaultdict(Counter)
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, times: int) -> None:
        if room not in opened or not opened[room]:
            if room not in rooms:
                bisect.insort(rooms, room)
        opened[room][pattern] += times

    for size in sorted((s for s, n in hist.items() if n), reverse=True):
        n = hist[size]
        while n:
            k = bisect.bisect_left(rooms, size)
            if k == len(rooms):
                each = capacity // size
                full, last = divmod(n, each)
                if full:
                    put(capacity - each * size, ((size, each),), full)
                if last:
                    put(capacity - last * size, ((size, last),), 1)
                break
            room = rooms[k]
            pattern, times = next(iter(opened[room].items()))
            each = room // size
            full = min(times, n // each)
            used, copies = (full, each) if full else (1, n)
            opened[room][pattern] -= used
            if not opened[room][pattern]:
                del opened[room][pattern]
            if not opened[room]:
                rooms.pop(k)
            put(room - copies * size, (*pattern, (size, copies)), used)
            n -= used * copies
    return [(pattern, times) for room in opened.values() for pattern, times in room.items()]


def plan_packing(hist: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    if any(s < 1 or s > capacity for s in hist):
        raise ValueError("lengths must be between 1 and the capacity")
    fixed, rest = reduce_by_dominance(hist, capacity)
    return fixed + best_fit_decreasing(rest, capacity)


def lower_bound(hist: dict[int, int], capacity: int) -> int:
    """Martello and Toth's L2 on the histogram: no packing uses fewer sequences."""
    total = sum(s * n for s, n in hist.items())
    best = -(-total // capacity)
    for k in {0, *(s for s in hist if s <= capacity // 2)}:
        large = sum(n for s, n in hist.items() if s > capacity - k)
        middle = {s: n for s, n in hist.items() if capacity // 2 < s <= capacity - k}
        small = sum(s * n for s, n in hist.items() if k <= s <= capacity // 2)
        spare = sum((capacity - s) * n for s, n in middle.items())
        best = max(best, large + sum(middle.values()) + max(0, -(-(small - spare) // capacity)))
    return best


def _segments(patterns: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, copies a sequence, first sequence, offset), ascending: where the ranks of it go."""
    given: Counter = Counter()
    rows: dict[int, list] = defaultdict(list)
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for size, copies in pattern:
            rows[size].append((given[size], copies, sequence, offset))
            given[size] += copies * times
            offset += size * copies
        sequence += times
    return {s: np.array(r, dtype=np.int64) for s, r in rows.items()}


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, deal (a number that spreads the rows) and, if asked for, ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, deal long" + ", ids array<int>" * with_ids

    def each() -> Callable:
        encode = encoder(tokenizer_path)
        task = TaskContext.get().partitionId()
        numbers = itertools.count()

        def cut(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {c: [] for c in (id_col, "piece", "start", "length", "ids_crc32", "deal", "ids")}
            for key, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = np.array([*(encode(text) if text else ()), end_id], dtype="<u4")
                head = len(ids) % capacity or capacity
                for piece, end in enumerate(range(head, len(ids) + 1, capacity)):
                    start = end - capacity if piece else 0
                    part = ids[start:end]
                    for c, x in zip(out, (key, piece, start, end - start, zlib.crc32(part.tobytes()), task << 40 | next(numbers), part.astype(np.int32) if with_ids else None), strict=True):
                        out[c].append(x)
            return out

        return cut

    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), each, schema)


def pack_pieces(pieces: DataFrame, capacity: int, group: int = 20_000) -> DataFrame:
    """Add sequence_id and offset to a table of token_pieces (a written one: it is read three times)."""
    hist = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    segments = _segments(plan_packing(hist, capacity))
    salts = [(int(s), -(-n // group)) for s, n in hist.items()] or [(0, 1)]
    plan = pieces.sparkSession.createDataFrame(salts, "len long, salts long")
    # at most `capacity` rows: broadcast by a proven bound
    salted = pieces.join(F.broadcast(plan), F.col("length") == F.col("len")).withColumn("salt", F.pmod(F.xxhash64("deal"), F.col("salts"))).drop("len", "salts")
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").count().select("length", "salt", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))

    columns = [c for c in pieces.columns if c != "deal"]
    order = Window.partitionBy("length", "salt").orderBy("deal")
    ranked = salted.withColumn("nth", F.row_number().over(order).cast("long") - 1).join(before, ["length", "salt"])
    ranked = ranked.select(*columns, (F.col("before") + F.col("nth")).alias("rank"))
    schema = T.StructType([*[f for f in pieces.schema.fields if f.name != "deal"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def each() -> Callable:
        def place(batch: pa.RecordBatch) -> dict:
            sizes, ranks = (batch[c].to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in set(sizes.tolist()):
                at = np.flatnonzero(sizes == size)
                table, rank = segments[size], ranks[at]
                row = table[np.searchsorted(table[:, 0], rank, side="right") - 1]
                rank = rank - row[:, 0]
                sequence[at] = row[:, 2] + rank // row[:, 1]
                offset[at] = row[:, 3] + rank % row[:, 1] * size
            return {c: batch[c] for c in columns} | {"sequence_id": sequence, "offset": offset}

        return place

    return map_arrow(ranked, each, schema, 10_000)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack: id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    pieces = staged(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids), "packing-pieces")
    return pack_pieces(pieces, capacity)
