"""The series operators against sequential loops."""

import random

import pytest
from pyspark.sql import functions as F

from reelmill.operators import sampling, selection, sequences


def frames(seed, items=12):
    rng = random.Random(seed)
    out = []
    for v in range(items):
        step, t = rng.choice([1 / 10, 1 / 23.976, 1 / 25, 1 / 30, 1 / 60]), 0.0
        for i in range(rng.randrange(40, 120)):
            out.append((f"v{v}", i, t + rng.uniform(-0.2, 0.2) * step * (v % 2)))
            t += step
    return out


@pytest.mark.parametrize("fps", [7.5, 15.0, 29.0])
def test_rate_sample_is_the_loop(spark, fps):
    rows = frames(1)
    want, state = [], {}
    for v, i, t in rows:
        due, n = state.get(v, (0.0, 0))
        if t + 1e-9 >= due:
            want.append((v, i, n))
            while due <= t + 1e-9:
                due += 1 / fps
            state[v] = (due, n + 1)
    got = sampling.rate_sample(spark.createDataFrame(rows, "v string, i int, t double"), "v", "i", "t", 1 / fps)
    assert sorted((r["v"], r["i"], r["candidate_id"]) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize("use", [True, False])
def test_timestamp_repair_is_the_loop(spark, use):
    rng = random.Random(2)
    rows, want = [], []
    for v in range(8):
        fps, last = rng.choice([0.0, 10.0, 23.976, 60.0]), None
        for i in range(30):
            c = rng.choice([i / (fps or 30), -1.0, 0.0, 0.4, i / (fps or 30) + 0.01])
            rows.append((f"v{v}", i, fps, c))
            t = i / (fps or 30)
            if use and c >= 0 and (last is None or c > last):
                t = c
            want.append((f"v{v}", i, round(t, 9)))
            last = t
    got = sampling.repaired_timestamps(spark.createDataFrame(rows, "v string, i long, fps double, c double"), "v", "i", "fps", "c", use)
    assert sorted((r["v"], r["i"], round(r["timestamp"], 9)) for r in got.collect()) == sorted(want)


def test_fold_select_is_the_loop(spark):
    rng = random.Random(3)
    rows = [(f"v{v}", b, c, (b + rng.random()) * 0.5, round(rng.random(), 3), round(rng.random(), 3)) for v in range(10) for c, b in enumerate(sorted(rng.randrange(12) for _ in range(40)))]
    want = []
    for v in {r[0] for r in rows}:
        last, own = None, [r for r in rows if r[0] == v]
        for b in sorted({r[1] for r in own}):
            best = None
            for _, _, c, t, q, look in (r for r in own if r[1] == b):
                m = 0.0 if last is None else abs(look - last)
                s = 0.65 * q + 0.25 * min(m / 0.2, 1) + 0.1 * max(0, 1 - abs(t - (b + 0.5) * 0.5) / 0.25)
                if best is None or s > best[1]:
                    best = (c, s, m, look)
            want.append((v, b, best[0], round(best[1], 8), round(best[2], 8)))
            last = best[3]
    df = spark.createDataFrame(rows, "v string, bin long, c long, t double, q double, look double")
    got = selection.fold_select(df, "v", "bin", "c", "t", "q", "look", 0.5).collect()
    assert sorted((r["v"], r["bin"], r["c"], round(r["score"], 8), round(r["motion"], 8)) for r in got) == sorted(want)


@pytest.mark.parametrize("repairs", [0, 1, 2])
def test_gap_repair_is_the_loop(spark, repairs):
    rng = random.Random(4)
    rows, want = [], []
    for v in range(10):
        valid = sorted(rng.sample(range(1, 30), 12))
        rows += [(f"v{v}", b, b * 10, float(b)) for b in valid]
        last, run = None, 0
        for b in range(valid[-1] + 1):
            if b in valid:
                last, run = b, 0
                want.append((f"v{v}", b, "valid", float(b), b * 10))
            elif last is not None and run < repairs:
                run += 1
                want.append((f"v{v}", b, "repair", float(last), last * 10))
            else:
                run += 1
                want.append((f"v{v}", b, "missing", None, -1))
    df = spark.createDataFrame(rows, "v string, bin long, frame int, q double")
    got = selection.repair_gaps(df, "v", "bin", 0.5, repairs, ["q", "frame"], "frame").collect()
    assert sorted((r["v"], r["bin"], r["state"], r["q"], r["frame"]) for r in got) == sorted(want)
    assert all(r["bin_start"] == r["bin"] * 0.5 for r in got)


def test_sliding_windows_and_acceptance_are_the_loop(spark):
    rng = random.Random(5)
    rows = [(f"v{v}", b, rng.choice(["valid", "valid", "valid", "repair", "missing"]), rng.random(), rng.random() / 5, rng.choice([None, 0.5, 0.995, 1.0])) for v in range(6) for b in range(3 + 7 * v)]
    want = []
    for v in range(6):
        own = [r for r in rows if r[0] == f"v{v}"]
        for a in range(0, len(own) - 5, 2):
            w = own[a : a + 6]
            known = [r for r in w if r[5] is not None]
            q, m = sum(r[3] for r in w) / 6, sum(r[4] for r in known) / len(known) if known else 0
            dup, mis, rep = sum(r[5] >= 0.995 for r in known) / max(1, len(known)), sum(r[2] == "missing" for r in w) / 6, sum(r[2] == "repair" for r in w) / 6
            want.append((f"v{v}", a, a + 5, *(round(x, 8) for x in (q, m, dup, mis, rep, 0.6 * q + 0.25 * min(m / 0.2, 1) - 0.1 * dup - 0.05 * rep))))
    df = spark.createDataFrame(rows, "v string, bin long, state string, q double, m double, ssim double")
    windows = sequences.sliding_windows(df, "v", "bin", "state", "q", "m", "ssim", 6, 2)
    names = ["v", "start_bin", "end_bin", "avg_quality", "avg_motion", "duplicate_ratio", "missing_ratio", "repair_ratio", "window_score"]
    flat = lambda d: sorted(tuple(round(r[c], 8) if isinstance(r[c], float) else r[c] for c in names) for r in d.collect())
    assert flat(windows) == sorted(want)
    limits = sequences.WindowLimits(max_missing=0.34, max_repair=0.34, max_duplicate=0.5, min_motion=0.05)
    assert flat(sequences.accepted(windows, limits)) == sorted(w for w in want if w[6] <= 0.34 and w[7] <= 0.34 and w[5] <= 0.5 and w[4] >= 0.05)


@pytest.mark.parametrize(("n", "m"), [(61, 7), (115, 7), (5, 6), (6, 6), (7, 6), (40, 3)])
def test_stratified_top1_is_the_loop(spark, n, m):
    rng = random.Random(n)
    rows = [("k", i, rng.choice([0.1, 0.5, 0.5, 0.9, float("nan")])) for i in range(n)]
    step = n / m
    chunks = [rows[int(i * step) : int((i + 1) * step)] for i in range(m)] if n > m else [[r] for r in rows]
    want = [max(c, key=lambda r: (r[2] == r[2], r[2] if r[2] == r[2] else 0, -r[1]))[1] for c in chunks]
    got = sequences.stratified_top1(spark.createDataFrame(rows, "k string, i int, s double"), ["k"], ["i"], "s", m)
    assert sorted(r["i"] for r in got.collect()) == want


def test_quality_case_of_equal_pixels():
    import numpy as np

    from reelmill.operators.vision import QualityLimits, quality_score, ssim, statistics

    flat = np.full((32, 32, 3), 128, np.uint8)
    assert quality_score(flat, 0.9, QualityLimits(enforced=False))[1] is True and quality_score(flat, 0.9, QualityLimits(enforced=True))[1] is False
    assert statistics(flat)[0] == 0 and ssim(flat, flat) == pytest.approx(1)


def test_streams_give_what_batches_give(spark, tmp_path):
    from reelmill.streaming.series import rate_sample_stream, windowed_quality

    rows = frames(6, 4)
    df = spark.createDataFrame(rows, "v string, i long, t double")
    df.where("i < 30").coalesce(1).write.parquet(str(tmp_path / "in"))
    df.where("i >= 30").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = rate_sample_stream(stream, "v", "i", "t", 0.1).writeStream.format("memory").queryName("sampled").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = sampling.rate_sample(df, "v", "i", "t", 0.1)
    assert sorted(map(tuple, spark.table("sampled").select("v", "i", "candidate_id").collect())) == sorted(map(tuple, want.select("v", "i", "candidate_id").collect()))
    batch = df.withColumn("ts", F.timestamp_seconds("t"))
    got = windowed_quality(batch, "v", "ts", "t", "1 second", "500 milliseconds", "10 seconds")
    assert got.agg(F.sum("n")).first()[0] == 2 * len(rows)
