"""MinHash near-dedup: a multi-index Hamming join over b-bit signatures, then exact links on whole shingle sets.

A text's signature holds 16 bits of its least shingle hash under each of FUNCTIONS hash functions. The signature is
split into CHUNKS chunks; each chunk gives one key for every place of it that may differ. By pigeonhole two
signatures that differ in fewer than 2 * CHUNKS places share a key, so no such pair is missed; a pair at a
similarity of 0.8 shares none with a probability of 2e-6, at 0.85 of 2e-8.

Texts with one shingle set are one class. Links are then confirmed on the full sets in two steps:

1. Rounds. Each class follows the most frequent of its keys that still has classes of several components; the classes
   that follow one key are dealt by hash into blocks of a bounded size and compared there. Found links are contracted
   to components before the next round, which deals anew, so a group of near copies of any size becomes one component
   after a few rounds, each of which reads every set once: work in proportion to the group.
2. The rest. Only keys that still have classes of several components count. Their classes are sorted into tiles by
   component; a class visits, block by block, the tiles that it shares such a key with and that are not its own
   component's, the classes of small components those of large ones. So every pair that shares a key is either in
   one component by then or compared.

Within blocks pairs inside one component are skipped, and only the links that join two components leave a block.
Neither a bucket nor a group of copies is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.llm._sets import MAX_TEXTS, Sets, chunk_keys
from reelmill.llm._words import Words, columns, slices
from reelmill.operators.graph import connected_components
from reelmill.shared import BROADCAST_BYTES, bounded_batches, looked_up, small, stored

FUNCTIONS, CHUNKS = 50, 10
#: Rounds of blocks before the rest is compared; what they leave apart costs visits, never links.
ROUNDS = 2
#: A block or tile has about so many shingles, and so many classes, at most.
TILE_SHINGLES, TILE_CLASSES = 150_000, 256
#: Classes of other tiles visit so many of their shingles, about, at a time.
VISITOR_SHINGLES = 300_000
_NO_ID = -(1 << 63)


def _scan_signatures(rows: DataFrame, k: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts = columns(batch, "_d", "_t", "_text")
            for at, to in slices(texts, max_rows=MAX_TEXTS):
                sets = Sets(Words(texts.slice(at, to - at), lower=True), k)
                signature = np.ascontiguousarray(sets.signatures(FUNCTIONS))
                out = [ids.slice(at, to - at), hashes.slice(at, to - at), pa.array(sets.sizes().astype(np.int64))]
                out += [pa.array(sets.identity(s).view(np.int64)) for s in (1, 2)]
                out.append(pa.array([x.tobytes() for x in signature], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=["_d", "_t", "_n", "_i1", "_i2", "_sig"])

    return rows.mapInArrow(scan, "_d long, _t long, _n long, _i1 long, _i2 long, _sig binary")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, signatures = columns(batch, "_k", "_sig")
        if not len(ids):
            continue
        sig = np.frombuffer(b"".join(signatures.to_pylist()), np.uint16).reshape(len(ids), FUNCTIONS)
        yield pa.RecordBatch.from_arrays([pa.array(chunk_keys(sig, CHUNKS).view(np.int64).ravel()), pa.array(np.repeat(ids.to_numpy(), FUNCTIONS))], names=["_key", "_k"])


def _scan_sets(rows: DataFrame, k: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = columns(batch, "_k", "_text")
            for at, to in slices(texts, max_rows=MAX_TEXTS):
                sets = Sets(Words(texts.slice(at, to - at), lower=True), k)
                held = [sets.values[a:b].tobytes() for a, b in zip(sets.first[:-1], sets.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(at, to - at), pa.array(held, pa.binary())], names=["_k", "_set"])

    return rows.mapInArrow(scan, "_k long, _set binary")


def _links(sets: list[np.ndarray], group: np.ndarray, guest: np.ndarray, hosts_too: bool, percent: int) -> list[tuple[int, int]]:
    """Links of a forest that joins what is similar: hosts with guests, and with each other if hosts_too.

    group has the components that the sets are known to lie in; no pair inside one is compared.
    """
    size = np.array([len(s) for s in sets])
    flat, at = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.cumsum(size) - size
    group, has, out = group.copy(), np.zeros(len(flat), bool), []
    for i in np.flatnonzero(~guest):
        met = guest | (np.arange(len(sets)) > i) if hosts_too else guest
        others = np.flatnonzero(met & (group != group[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        if not len(others):
            continue
        mine = at[first[i] : first[i] + size[i]]
        has[mine] = True
        of = np.repeat(np.arange(len(others)), size[others])
        places = np.repeat(first[others] - (np.cumsum(size[others]) - size[others]), size[others]) + np.arange(len(of))
        common = np.bincount(of, has[at[places]], len(others)).astype(np.int64)
        has[mine] = False
        for j in others[100 * common >= percent * (size[i] + size[others] - common)]:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                out.append((int(i), int(j)))
    return out


def _compare(percent: int):
    """Of a block's classes (_k, _c, _guest, _set; _part is 0 in the block whose hosts also meet each other) the links."""

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, guest = table["_k"].to_numpy(), table["_guest"].to_numpy(zero_copy_only=False)
        sets = [np.frombuffer(x, np.uint64) for x in table["_set"].to_pylist()]
        group = np.unique(table["_c"].to_numpy(), return_inverse=True)[1]
        found = _links(sets, group, guest, table["_part"][0].as_py() == 0, percent)
        return pa.table({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

    return compare


def _parts(rows: DataFrame, of: str, out: str) -> DataFrame:
    """Adds the block or tile that a class is dealt to, by hash, among as many as those of one `of` need."""
    sizes = rows.groupBy(of).agg(F.greatest(F.ceil(F.sum("_n") / TILE_SHINGLES), F.ceil(F.count("*") / TILE_CLASSES)).alias("_parts"))
    return looked_up(rows, sizes, of, "sizes").withColumn(out, F.xxhash64(of, F.pmod(F.xxhash64("_k", of), "_parts"))).drop("_parts")


class _Linking:
    """Links between classes, confirmed step by step; components of what has been found so far."""

    def __init__(self, near: DataFrame, held: DataFrame, percent: int, broadcast_bytes: int):
        self.near, self.held, self.percent, self.broadcast_bytes = near, held, percent, broadcast_bytes
        self.found: list[DataFrame] = []
        self.components: DataFrame | None = None

    def contract(self, links: DataFrame) -> None:
        self.found.append(stored(links, "links"))
        every = self.found[0]
        for more in self.found[1:]:
            every = every.unionByName(more)
        self.components = stored(connected_components(every).select(F.col("node").alias("_k"), F.col("component").alias("_c")), "components")

    def open(self) -> DataFrame:
        """(_key, _size, _k, _n, _c): what the keys that classes of several components share still bring together."""
        if self.components is None:  # each class is one
            return self.near.withColumn("_c", F.col("_k"))
        rows = self.near.drop("_size").join(small(self.components, self.broadcast_bytes), "_k", "left").withColumn("_c", F.coalesce("_c", "_k"))
        mixed = rows.groupBy("_key").agg(F.count("*").alias("_size"), F.min("_c").alias("_lo"), F.max("_c").alias("_hi")).where("_lo < _hi").select("_key", "_size")
        return stored(looked_up(rows, mixed, "_key", "mixed", broadcast_bytes=self.broadcast_bytes), "open")

    def _favourites(self, rows: DataFrame, salt: int) -> DataFrame:
        """(_k, _n, _c, _of): each class with the most frequent of its keys."""
        return rows.groupBy("_k", "_n", "_c").agg(F.max_by("_key", F.struct("_size", F.xxhash64("_key", F.lit(salt)))).alias("_of"))

    def _compared(self, blocks: DataFrame, by: list[str]) -> DataFrame:
        return blocks.join(self.held, "_k").groupBy(*by).applyInArrow(_compare(self.percent), "a long, b long")

    def round(self, rows: DataFrame, salt: int) -> None:
        blocks = _parts(self._favourites(rows, salt), "_of", "_at").withColumn("_guest", F.lit(False)).withColumn("_part", F.lit(0))
        self.contract(self._compared(blocks.select("_k", "_c", "_at", "_part", "_guest"), ["_at"]))

    def rest(self, rows: DataFrame) -> None:
        own = stored(self._favourites(rows, -1), "favourites")
        large = own.groupBy("_c").agg(F.count("*").alias("_weight"))
        own = looked_up(own, large, "_c", "weights", broadcast_bytes=self.broadcast_bytes)
        own = own.withColumn("_of", F.when(F.col("_weight") > 1, F.xxhash64("_c", F.lit(1))).otherwise(F.col("_of")))
        tiles = stored(_parts(own, "_of", "_tile").withColumn("_pure", F.when(F.col("_weight") > 1, F.col("_c"))), "tiles")
        # A tile's place in the order of visits: large components first, so that few classes travel.
        ranked = F.struct("_weight", "_tile", "_pure")
        placed = rows.select("_key", "_k").join(small(tiles, self.broadcast_bytes), "_k")
        of_key = placed.groupBy("_key").agg(F.collect_set(ranked).alias("_tiles")).where("size(_tiles) > 1")
        of_class = looked_up(rows.select("_key", "_k"), of_key, "_key", "tiles_of_key", broadcast_bytes=self.broadcast_bytes)
        of_class = of_class.groupBy("_k").agg(F.array_distinct(F.flatten(F.collect_set("_tiles"))).alias("_tiles"))
        higher = "filter(_tiles, t -> (t._weight > _weight or t._weight = _weight and t._tile > _tile) and (t._pure is null or t._pure <> _c))"
        visits = of_class.join(small(tiles, self.broadcast_bytes), "_k").select("_k", "_n", "_c", F.explode(F.expr(f"transform({higher}, t -> t._tile)")).alias("_at"))
        visits = stored(visits, "visits")
        parts = stored(visits.groupBy("_at").agg(F.ceil(F.sum("_n") / VISITOR_SHINGLES).alias("_parts")), "parts")
        parts = small(parts, self.broadcast_bytes)
        guests = visits.join(parts, "_at").select("_k", "_c", "_at", F.pmod(F.xxhash64("_k"), "_parts").alias("_part"), F.lit(True).alias("_guest"))
        # Tiles of several components also compare their own; those of one only wait for guests.
        hosts = tiles.join(parts.withColumnRenamed("_at", "_tile"), "_tile", "left").where("_pure is null or _parts is not null")
        hosts = hosts.select("_k", "_c", F.col("_tile").alias("_at"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_parts", F.lit(1)) - 1)).alias("_part"), F.lit(False).alias("_guest"))
        self.contract(self._compared(hosts.unionByName(guests), ["_at", "_part"]))


def _class_components(classes: DataFrame, rows: DataFrame, k: int, percent: int, broadcast_bytes: int) -> DataFrame | None:
    """(_k, _c): the component of each class that has links; none if no two classes share a key."""
    keys = classes.select("_k", "_sig").mapInArrow(_keys, "_key long, _k long")
    shared = keys.groupBy("_key").agg(F.count("*").alias("_size")).where("_size > 1")
    near = keys.join(small(stored(shared, "keys"), broadcast_bytes), "_key")
    near = stored(near.join(classes.select("_k", "_n"), "_k"), "near")
    members = stored(near.select("_k").distinct().join(classes.select("_k", "_d", "_t"), "_k"), "members")
    n = members.count()
    if not n:
        return None
    held = stored(_scan_sets(rows.join(small(members, broadcast_bytes), ["_d", "_t"]).select("_k", "_text"), k), "sets")
    if held.count() > n:  # rows that repeat id and text
        held = stored(held.groupBy("_k").agg(F.any_value("_set").alias("_set")), "sets")
    linking = _Linking(near, held, percent, broadcast_bytes)
    for salt in range(ROUNDS):
        rows = linking.open()
        if rows.isEmpty():
            return linking.components
        linking.round(rows, salt)
    rows = linking.open()
    if not rows.isEmpty():
        linking.rest(rows)
    return linking.components


def _rows(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("_d"), F.xxhash64(text).alias("_t"), text.alias("_text"), *more)


def _decided(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, broadcast_bytes: int) -> DataFrame:
    """(_d, _t, _n, _c) of every row: its key, its shingles and the smallest id that links reach."""
    bounded_batches(docs.sparkSession)
    rows = _rows(docs, id_col, text_col)
    scanned = stored(_scan_signatures(rows, k), "signatures")
    same = ["_n", "_i1", "_i2"]
    classes = scanned.where("_n > 0").groupBy(*same).agg(F.min_by(F.struct("_d", "_t", "_sig"), F.struct("_d", "_t")).alias("_s"))
    classes = stored(classes.select(*same, "_s.*", F.monotonically_increasing_id().alias("_k")), "classes")
    found = _class_components(classes, rows, k, percent, broadcast_bytes)
    of_class = classes.select(*same, "_k", "_d")
    if found is None:
        of_class = of_class.select(*same, F.col("_d").alias("_c"))
    else:
        of_class = stored(of_class.join(small(found, broadcast_bytes), "_k", "left").withColumn("_c", F.coalesce("_c", "_k")), "of_class")
        least = of_class.groupBy("_c").agg(F.min("_d").alias("_least"))
        of_class = looked_up(of_class, least, "_c", "least", broadcast_bytes=broadcast_bytes).select(*same, F.col("_least").alias("_c"))
    return looked_up(scanned.drop("_sig"), of_class, same, "class_ids", "left", broadcast_bytes).select("_d", "_t", "_n", F.coalesce("_c", "_d").alias("_c"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (the smallest id that links reach), kept (id is that one).

    Ids are whole numbers (others are cast to long). Texts are lower-cased (A-Z), words are runs without ASCII white
    space, shingles are k words; a text with fewer words has its whole sequence as its one shingle. Texts are linked
    if 100 * intersection >= percent * union. Null and empty texts have no shingles, are linked with nothing and are
    kept; a null id is smaller than any other and stays null; rows that repeat id and text share one component, and
    different texts under one id are texts of their own. An empty table gives no rows. Other columns of docs are
    ignored.
    """
    kind = docs.schema[id_col].dataType
    out = _decided(docs, id_col, text_col, k, percent, broadcast_bytes)
    shown = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).cast(kind)
    return out.select(shown("_d").alias(id_col), F.col("_n").alias("n_shingles"), shown("_c").alias("component_id"), (F.col("_d") == F.col("_c")).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of docs that stay, whole: one of each group. Rows that repeat id and text stay or go together; other texts under one id are decided each for itself."""
    gone = _decided(docs, id_col, text_col, k, percent, broadcast_bytes).where("_d <> _c").select("_d", "_t").distinct()
    rows = _rows(docs, id_col, text_col, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")).drop("_text")
    return rows.join(small(stored(gone, "gone"), broadcast_bytes), ["_d", "_t"], "left_anti").select("_row.*")
