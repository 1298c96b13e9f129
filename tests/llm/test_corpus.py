import os
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import islice

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmill.llm import mixing, packing, quality
from tests.llm.helpers import AWKWARD, corpus, table
from tests.llm.test_dedup import line_rows, near_rows

ROWS = corpus() + AWKWARD
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).cache()


# -- mixing ---------------------------------------------------------------------------------------------------------


def exact(weights):
    total = sum(map(Fraction, weights))
    return [Fraction(w) / total for w in weights]


def earliest_deadline_first(weights, slots):
    """Slot by slot over all released blocks, with fractions."""
    share, placed, out = exact(weights), [0] * len(weights), []
    for slot in range(slots):
        ready = [(-(-(placed[s] + 1) // w), s) for s, w in enumerate(share) if placed[s] // w <= slot]
        s = min(ready)[1]
        out.append((s, placed[s]))
        placed[s] += 1
    return out


WEIGHTS = [[1.0], [0.5, 0.3, 0.2], [1.0 + k % 7 for k in range(60)], [0.9999] + [1e-6] * 100, [0.33336, 0.33333, 0.3333], [1e12, 3.7, 1e-9], [0.1] * 10]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_schedule_stays_within_one_block_of_the_weights(weights):
    share, slots = exact(weights), 30_000
    blocks = [slots + 1] * len(weights)
    placed = [0] * len(weights)
    for slot, (s, i, release, deadline, at) in enumerate(islice(mixing.schedule(weights, blocks), slots)):
        assert at == slot and i == placed[s] and release == i // share[s] and deadline == -(-(i + 1) // share[s])
        assert release <= slot < deadline
        placed[s] += 1
        if slot % 97 == 0:
            assert all(abs(n - w * (slot + 1)) < 1 for n, w in zip(placed, share))


@pytest.mark.parametrize("weights", WEIGHTS)
def test_schedule_is_earliest_deadline_first(weights):
    got = [x[:2] for x in islice(mixing.schedule(weights, [10**6] * len(weights)), 400)]
    assert got == earliest_deadline_first(weights, 400)


def test_schedule_ends_when_every_source_is_whole():
    got = [x[:2] for x in mixing.schedule([3.0, 1.0], [5, 4])]
    assert got == earliest_deadline_first([3.0, 1.0], len(got)) and got[-1] == (1, 3) and (0, 4) in got
    assert list(mixing.schedule([], [])) == []
    for bad in (0.0, -1.0, float("inf"), float("nan")):
        with pytest.raises(ValueError, match="positive"):
            mixing.whole_weights([1.0, bad])


def mixture_by_hand(rows, weights, block_chars, alpha=None, repeat=True):
    """rows: (id, size, source); all as plain loops over one list."""
    names = sorted({s for _, _, s in rows})
    block, blocks = {}, {}
    for s in names:
        sofar = 0
        for i, size, _ in sorted(r for r in rows if r[2] == s):
            block[i] = sofar // block_chars
            sofar += size
            blocks[s] = block[i] + 1
    w = [weights[s] if weights else float(blocks[s]) ** alpha for s in names]
    out, done, slots = set(), set(), 1
    while len(done) < len(names):
        order = earliest_deadline_first(w, slots)
        done = {s for s, k in order if k >= blocks[names[s]] - 1}
        slots += 1
    for slot, (s, k) in enumerate(order):
        epoch, b = divmod(k, blocks[names[s]])
        if repeat or not epoch:
            out |= {(i, names[s], epoch, b, slot) for i, _, t in rows if t == names[s] and block[i] == b}
    return out


@pytest.mark.parametrize(("weights", "broadcast"), [({"big": 1, "small": 1}, 10**6), ({"big": 0.25, "small": 0.75}, 0), (None, 10**6)])
def test_mixture_by_hand(spark, monkeypatch, weights, broadcast):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 7)
    rows = [(i * i * 1009, "x" * (1 + i % 13), "big" if i % 3 else "small") for i in range(90)]  # ids far apart
    got = mixing.mix(table(spark, rows), weights=weights, block_chars=20, broadcast_bytes=broadcast).collect()
    assert {r["doc_id"] for r in got if r["epoch"] == 0} == {r[0] for r in rows}
    want = mixture_by_hand([(i, len(t), s) for i, t, s in rows], weights, 20, mixing.ALPHA)
    assert {(r["doc_id"], r["source"], r["epoch"], r["block"], r["slot"]) for r in got} == want and len(got) == len(want)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    assert sorted(r["place"] for r in got if r["slot"] == 0) == list(range(sum(r["slot"] == 0 for r in got)))


def test_mixture_of_very_many_sources(spark):
    rows = [(i, "word " * (1 + i % 9), f"host{i % 6000}") for i in range(9000)]
    got = mixing.mix(table(spark, rows), block_chars=30).collect()
    assert {r["doc_id"] for r in got if r["epoch"] == 0} == set(range(9000)) and len({r["source"] for r in got}) == 6000
    with pytest.raises(ValueError, match="no weight"):
        mixing.mix(table(spark, rows[:3]), weights={"host0": 1})


def test_mixture_leaves_nothing_out(docs):
    got = mixing.mix(docs).collect()
    assert Counter(r["doc_id"] for r in got if r["epoch"] == 0) == Counter(i for i, _ in ROWS)
    once = mixing.mix(docs, repeat=False).collect()
    assert len(once) == len(ROWS) and {r["epoch"] for r in once} == {0}
    assert mixing.mix(docs.limit(0)).count() == 0
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns and {r["doc_id"] for r in whole.collect()} == {i for i, _ in ROWS}


def test_mixture_of_null_ids_and_sources(spark):
    rows = spark.createDataFrame([(None, "a", None), (1, None, "s"), (2, "b", None)], "doc_id long, text string, source string")
    got = mixing.mix(rows).collect()
    assert {(r["doc_id"], r["source"]) for r in got} == {(None, None), (1, "s"), (2, None)}


def test_mixture_of_one_row_very_often(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 50)
    rows = table(spark, [(7, "the same text", "s")]).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(1000)))).drop("k")
    got = mixing.mix(rows.unionByName(table(spark, [(1, "x" * 100, "t")])), block_chars=130).collect()
    assert Counter(r["block"] for r in got if r["source"] == "s" and r["epoch"] == 0) == {k: 10 for k in range(100)}


# -- packing --------------------------------------------------------------------------------------------------------


def test_ids_are_the_tokenizer_files():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t for _, t in ROWS if t] + ["a\t b", "a\t\n b", "x  y", "<|endoftext|> a", " lead", "trail  ", "a\x1c b", "日本 語", "a\x85 b", "I'll don't", "12 34 a1b", "½ ²​", ""]
    encoder = packing.Encoder("byte_bpe_50k.json")
    for t in texts:
        assert encoder.encode(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + "\t" * 1_500_000 + "b", "\n" * 1_200_000, "x" * 400_000, " \n" * 600_000 + "end", "a\u3000" + "\u3000" * 300_000])
def test_ids_of_very_long_runs(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.Encoder("byte_bpe_50k.json").encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("block", [8, 4000])
def test_packing_is_an_exact_round_trip(docs, block):
    capacity = 64
    got = packing.pack(docs, capacity=capacity, block=block).collect()
    encoder = packing.Encoder("byte_bpe_50k.json")
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for i, text in ROWS:
        ids = encoder.encode(text or "") + b"\0\0\0\0"
        own = {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[i]}
        assert sum(x[2] for x in own) == len(ids) // 4 and len(pieces[i]) == len(own) * sum(j == i for j, _ in ROWS)
        for k, (piece, start, length, crc) in enumerate(sorted(own)):
            assert piece == k and crc == zlib.crc32(ids[4 * start : 4 * (start + length)])
            assert length == capacity or piece == 0
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in got) // capacity)
    assert len(sequences) <= least * 1.1 + len(got) / block + 2


def test_packing_of_nothing(docs):
    assert packing.pack(docs.limit(0)).count() == 0


def packed(sizes, bins, capacity):
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= capacity for b in bins)


def test_crossover_keeps_every_piece_once_and_evolution_never_loses():
    rng = np.random.default_rng(4)
    for n in (1, 2, 50, 400):
        sizes = rng.integers(1, 100, n).astype(np.int32)
        population = packing.first_population(sizes, 100, rng)
        for p in population:
            packed(sizes, p, 100)
        packed(sizes, packing.crossover(sizes, population[0], population[-1], 100, rng), 100)
        best = packing.evolve(sizes, population, 100, 20, rng)[0]
        packed(sizes, best, 100)
        assert len(best) <= min(map(len, population))
        assert [sorted(b) for b in packing._bins(packing._labels(best, n))] == [sorted(b) for b in best]


def test_evolution_finds_what_best_fit_misses():
    sizes = np.array([50, 30, 20, 50, 30, 20, 45, 35, 20, 44, 36, 20, 60, 25, 15, 55, 27, 18] * 3, np.int32)
    rng = np.random.default_rng(9)
    first = packing.first_population(sizes, 100, rng)
    assert len(packing.evolve(sizes, first, 100, 400, rng)[0]) <= len(first[0])


# -- pipeline -------------------------------------------------------------------------------------------------------


def stages(spark, docs, folder, tmp_path):
    """(name, rows before, rows after) of each stage, its output written and read again."""
    import corpus_pipeline

    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(path := os.fspath(tmp_path / f"stage{k}"))
        out = spark.read.parquet(path)
        if k < 4:
            assert out.columns == docs.columns
        yield name, docs, out
        docs = out


def hold_against_brute_force(spark, docs, folder, tmp_path):
    """Each stage against loops over its own input that share no code with it; the classifier against its own scores."""
    key = lambda r: (r["doc_id"] if r["doc_id"] is not None else -(2**63), r["text"] or "")
    encoder = packing.Encoder("byte_bpe_50k.json")
    for name, before, after in stages(spark, docs, folder, tmp_path):
        old, new = ([r.asDict() for r in df.collect()] for df in (before, after))
        if name == "quality classifier":
            scores = quality.quality_scores(before, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").select("doc_id").collect()
            assert sorted(map(key, ({**r, "text": ""} for r in new))) == sorted(key({"doc_id": r[0], "text": ""}) for r in scores)
            assert all(r in old for r in new)
        elif name == "line dedup":
            want = [(i, n, text, r) for (i, n, gone, text), r in zip(line_rows([(*key(r)[:1], r["text"]) for r in sorted(old, key=key)], 4, 40), sorted(old, key=key), strict=True) if gone < n or not n]
            assert sorted((key(r)[0], r["text"] or "") for r in new) == sorted((i, text) for i, _, text, _ in want)
            assert all(r["n_chars"] == len(r["text"] or "") for r in new if r not in old)
        elif name == "MinHash near-dedup":
            kept = near_rows([(key(r)[0], r["text"]) for r in old], 5, 80)
            gone = {i for i, _, _, keep in kept if not keep}
            assert sorted(map(key, new)) == sorted(key(r) for r in old if key(r)[0] not in gone or r["doc_id"] is None)
        elif name.startswith("mixing"):
            ids = [(i, max(1, len(r["text"] or "")), r["source"] or mixing.NO_SOURCE) for i, r in enumerate(sorted(old, key=key))]
            placed = Counter(i for i, *_ in mixture_by_hand(ids, None, mixing.BLOCK_CHARS, mixing.ALPHA)) if ids else {}
            by_row = Counter()
            for i, r in enumerate(sorted(old, key=key)):
                by_row[key(r)] += placed[i]
            assert Counter(map(key, new)) == by_row
        else:
            tokens = Counter()
            for r in old:
                tokens[r["doc_id"]] += len(encoder.encode(r["text"] or "")) // 4 + 1
            got = Counter()
            for r in new:
                got[r["doc_id"]] += r["length"]
            used = Counter()
            for r in new:
                used[r["sequence_id"]] += r["length"]
            assert got == tokens and max(used.values(), default=0) <= packing.CAPACITY


def test_each_stage_on_the_smallest_tables(spark, tmp_path):
    hold_against_brute_force(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, tmp_path)


def test_each_stage_on_awkward_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the operators might use."""
    rows = table(spark, ROWS + [(2001, "two words"), (2001, "two words")]).withColumns({"_score": F.lit(7.0), "_row": F.lit("r"), "_k": F.lit(1), "_d": F.col("_d")})
    labels = spark.createDataFrame([(i, int(len(t or "") > 100)) for i, t in ROWS if i < 1000] + [(1001, None), (1002, 0)], "doc_id long, quality int")
    rows.write.parquet(os.fspath(tmp_path / "documents.parquet"))
    labels.write.parquet(os.fspath(tmp_path / "labels.parquet"))
    hold_against_brute_force(spark, spark.read.parquet(os.fspath(tmp_path / "documents.parquet")), os.fspath(tmp_path), tmp_path)
    assert spark.read.parquet(os.fspath(tmp_path / "stage0")).select("_score").distinct().collect()[0][0] == 7.0


def test_stages_on_empty_tables(spark, tmp_path):
    table(spark, ROWS).limit(0).write.parquet(os.fspath(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(os.fspath(tmp_path / "labels.parquet"))
    for name, _, after in stages(spark, spark.read.parquet(os.fspath(tmp_path / "documents.parquet")), os.fspath(tmp_path), tmp_path):
        assert after.count() == 0, name


def test_run_gives_pieces(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, SF).count() > 50 and len(corpus_pipeline.STAGES) == 5
