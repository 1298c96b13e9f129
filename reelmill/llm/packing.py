"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

Documents become pieces of at most `capacity` tokens. Pieces are dealt by hash into blocks of a bounded size; each
block is packed by several islands. An island evolves a population of packings: crossover injects whole well-filled
bins of one parent into the other, removes the pieces that would be there twice, and puts displaced pieces where
they fit best. After each round the best packings of an island migrate to its neighbour; the best of all islands is
the block's result. Islands are tasks of their own; what passes between rounds is one small row for each packing.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.shared import bounded_batches, stored

CAPACITY = 2048
#: Pieces in a block, on average; islands to a block; rounds with migration after each; packings to an island; children to a round.
BLOCK, ISLANDS, ROUNDS, POPULATION, CHILDREN = 4000, 2, 2, 4, 6

_LONG_RUN = re.compile(r"\s{20000}")
#: Islands, or blocks, to a task; tasks at most.
TASK_ISLANDS, MAX_TASKS = 8, 100_000


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The ids are those of the tokenizer file. Its ranks in the other library's form give the same ones several times
    as fast; a text that could hold a special token, or has a run of white space so long that the other library's
    pattern gives up, is left to the tokenizer itself.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(name))
        ranks_of = public_tokenizers.path(name.replace(".json", ".tiktoken"))
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_of, "rb"))}
        self.part = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if "<|" in text or _LONG_RUN.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.part.encode_to_numpy(text).astype("<u4", copy=False).tobytes()


@lru_cache(2)
def _encoder(name: str) -> Encoder:
    """One to a worker, for all its tasks."""
    return Encoder(name)


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(_id, piece, start, length, ids_crc32): a text's ids and end_id, cut only if longer than capacity; the first piece takes what is left over."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                row, out = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    ids = encoder.encode(text or "") + end
                    n = len(ids) // 4
                    start, number = 0, 0
                    while start < n:
                        length = capacity if start or n % capacity == 0 else n % capacity
                        row.append(k)
                        out.append((number, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
                        start, number = start + length, number + 1
                cols = list(zip(*out, strict=True)) or [(), (), (), ()]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row, pa.int32())), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(scan, f"_id {kind}, piece int, start long, length long, ids_crc32 long")


# A packing is a list of bins; a bin is a list of places in sizes.


def best_fit(sizes: np.ndarray, order: list[int], capacity: int, bins: list[list[int]] | None = None) -> list[list[int]]:
    """Puts each piece in the fullest bin that still takes it; a new one if none does."""
    bins = bins if bins is not None else []
    room = sorted((capacity - sum(int(sizes[i]) for i in b), k) for k, b in enumerate(bins))
    for i in order:
        size = int(sizes[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(i)
        else:
            left, k = capacity, len(bins)
            bins.append([i])
        if left > size:
            insort(room, (left - size, k))
    return bins


def fitness(sizes: np.ndarray, bins: list[list[int]], capacity: int) -> tuple[int, float]:
    """Fewer bins, then fuller ones: squares reward full bins beside empty ones."""
    return -len(bins), sum((sum(int(sizes[i]) for i in b) / capacity) ** 2 for b in bins)


def crossover(sizes: np.ndarray, one: list[list[int]], two: list[list[int]], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Some of two's fullest bins go into one whole; bins of one that hold the same pieces go, and what they held besides is fitted in anew."""
    fill = np.array([sum(int(sizes[i]) for i in b) for b in two])
    good = np.argsort(-(fill + rng.random(len(fill))), kind="stable")[: max(1, len(two) // 2)]
    chosen = [two[k] for k in good if rng.random() < 0.5] or [two[good[0]]]
    there = {i for b in chosen for i in b}
    kept, loose = [list(b) for b in chosen], []
    for b in one:
        if there.isdisjoint(b):
            kept.append(list(b))
        else:
            loose += [i for i in b if i not in there]
    least = sorted(range(len(chosen), len(kept)), key=lambda k: sum(int(sizes[i]) for i in kept[k]))[: max(1, len(kept) // 50)]
    loose += [i for k in least if k < len(kept) for i in kept[k]]
    drop = set(least)
    kept = [b for k, b in enumerate(kept) if k not in drop]
    loose.sort(key=lambda i: -int(sizes[i]))
    return best_fit(sizes, loose, capacity, kept)


def evolve(sizes: np.ndarray, population: list[list[list[int]]], capacity: int, children: int, rng: np.random.Generator) -> list[list[list[int]]]:
    """Steady state: each child takes the place of the worst packing if it is better."""
    least = -(-int(sizes.sum()) // capacity)
    population = sorted(population, key=lambda p: fitness(sizes, p, capacity), reverse=True)
    for _ in range(children):
        if len(population[0]) <= least or len(population) < 2:
            break
        a, b = rng.choice(len(population), 2, replace=False)
        child = crossover(sizes, population[a], population[b], capacity, rng)
        if fitness(sizes, child, capacity) > fitness(sizes, population[-1], capacity):
            population[-1] = child
            population.sort(key=lambda p: fitness(sizes, p, capacity), reverse=True)
    return population


def first_population(sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> list[list[list[int]]]:
    """Best fit of falling sizes, and of slightly shuffled ones."""
    orders = [np.argsort(-sizes, kind="stable")]
    orders += [np.argsort(-sizes * rng.uniform(1 - spread, 1 + spread, len(sizes)), kind="stable") for spread in (0.02, 0.1, 0.3)[: POPULATION - 1]]
    return [best_fit(sizes, [int(i) for i in order], capacity) for order in orders]


def _labels(bins: list[list[int]], n: int) -> bytes:
    out = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out.tobytes()


def _bins(labels: bytes) -> list[list[int]]:
    of = np.frombuffer(labels, np.int32)
    order = np.argsort(of, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)]


_STATE = "_block long, _island int, _sizes binary, _labels binary"


def _island_round(capacity: int, last: bool):
    """One island's round: rows are its packings, or a single row without labels before the first."""

    def step(table: pa.Table) -> pa.Table:
        block, island = table["_block"][0].as_py(), table["_island"][0].as_py()
        sizes = np.frombuffer(table["_sizes"][0].as_py(), np.int32)
        labels = sorted({x for x in table["_labels"].to_pylist() if x is not None})
        rng = np.random.default_rng([block & 0x7FFFFFFF, island, len(labels)])
        population = [_bins(x) for x in labels] or first_population(sizes, capacity, rng)
        population = evolve(sizes, population, capacity, CHILDREN, rng)
        goes = [(island, p) for p in population[: 1 if last else POPULATION]]
        if not last and ISLANDS > 1:
            goes.append(((island + 1) % ISLANDS, population[0]))
        n = len(goes)
        return pa.table({
            "_block": pa.array([block] * n, pa.int64()), "_island": pa.array([k for k, _ in goes], pa.int32()),
            "_sizes": pa.array([sizes.tobytes()] * n, pa.binary()), "_labels": pa.array([_labels(p, len(sizes)) for _, p in goes], pa.binary()),
        })

    return step


def _best(capacity: int):
    def best(table: pa.Table) -> pa.Table:
        sizes = np.frombuffer(table["_sizes"][0].as_py(), np.int32)
        labels = max(sorted(table["_labels"].to_pylist()), key=lambda x: fitness(sizes, _bins(x), capacity))
        return pa.table({"_block": table["_block"].slice(0, 1), "_labels": pa.array([labels], pa.binary())})

    return best


_KEYS = ["_id", "piece", "start", "length", "ids_crc32"]


def _place(table: pa.Table) -> pa.Table:
    """Pieces of a block and the labels of its packing (in the row with no piece): bin and offset of each."""
    table = table.sort_by([("_rank", "ascending")])
    labels = np.frombuffer(next(x for x in table["_labels"].to_pylist() if x is not None), np.int32)
    own = table.slice(1)
    length = own["length"].to_numpy()
    order = np.argsort(labels, kind="stable")
    ends = np.cumsum(length[order])
    new = np.ones(len(order), bool)
    new[1:] = labels[order][1:] != labels[order][:-1]
    base = np.maximum.accumulate(np.where(new, ends - length[order], 0))
    offset = np.empty(len(order), np.int64)
    offset[order] = ends - length[order] - base
    block = own["_block"].to_numpy()
    return pa.table({c: own[c] for c in _KEYS} | {"sequence_id": pa.array(block * (1 << 24) + labels), "offset": pa.array(offset)})


def _gathered(table: pa.Table) -> pa.Table:
    sizes = table.sort_by([("_rank", "ascending")])["length"].to_numpy().astype(np.int32).tobytes()
    return pa.table({"_block": table["_block"].slice(0, 1), "_sizes": pa.array([sizes], pa.binary())})


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end_id: int = 0, block: int = BLOCK
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Every document gives at least one piece: null and empty texts are end_id alone, a text longer than capacity is cut
    into whole sequences after a first piece of what is left over. Texts of any length and of white space alone are
    encoded whole. Repeated rows are packed each for itself, null ids
    stay null, an empty table gives no rows, other columns of docs are ignored.
    """
    bounded_batches(docs.sparkSession)
    made = stored(pieces(docs, id_col, text_col, tokenizer, capacity, end_id), "pieces")
    kind = made.schema["_id"].dataType.simpleString()
    full = made.where(F.col("length") == capacity)
    open_ = made.where(F.col("length") < capacity)
    blocks = max(1, -(-open_.count() // block))
    dealt = open_.withColumn("_block", F.pmod(F.xxhash64("_id", "piece", F.monotonically_increasing_id()), F.lit(blocks)))
    dealt = stored(dealt.withColumn("_rank", F.row_number().over(_by_block())), "dealt")
    sized = dealt.select("_block", "_rank", "length").groupBy("_block").applyInArrow(_gathered, "_block long, _sizes binary")
    islands = F.explode(F.array(*(F.lit(k) for k in range(ISLANDS))))
    state = sized.select("_block", islands.alias("_island"), "_sizes", F.lit(None).cast("binary").alias("_labels"))
    # The rows are few and small, but each is seconds of work, so their number of tasks is given and not left to sizes.
    tasks = max(1, min(MAX_TASKS, -(-blocks * ISLANDS // TASK_ISLANDS)))
    for k in range(ROUNDS):
        state = stored(state.repartition(tasks, "_block", "_island").groupBy("_block", "_island").applyInArrow(_island_round(capacity, k == ROUNDS - 1), _STATE), "islands")
    best = state.repartition(tasks, "_block").groupBy("_block").applyInArrow(_best(capacity), "_block long, _labels binary")
    head = best.select(*(F.lit(None).cast(made.schema[c].dataType).alias(c) for c in _KEYS), "_block", F.lit(0).alias("_rank"), "_labels")
    both = dealt.select(*_KEYS, "_block", "_rank", F.lit(None).cast("binary").alias("_labels")).unionByName(head)
    placed = both.groupBy("_block").applyInArrow(_place, f"_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    alone = full.select(*_KEYS, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone).withColumnRenamed("_id", id_col)


def _by_block():
    from pyspark.sql import Window

    return Window.partitionBy("_block").orderBy("_id", "piece", "ids_crc32", "start")
