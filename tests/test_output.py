import dataclasses
import json
import os
import zipfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelmill import shared
from reelmill.operators import export, vision
from reelmill.plans import builders, output, run
from reelmill.plans.config import RunConfig
from reelmill.sources import manifests
from reelmill.sources.listing import list_files

CONFIG = RunConfig(({"id": "a", "adapter": "layout", "root": "x"},), "out", seq_len=4, window_hop=2)


def test_only_the_sequence_folder_is_cleared(tmp_path):
    config = dataclasses.replace(CONFIG, output_dir=str(tmp_path / "output"))
    os.makedirs(tmp_path / "output/sequences")
    (tmp_path / "output/sequences/old.png").touch()
    (tmp_path / "output/keep.log").touch()
    output.reset_sequences(config)
    assert os.listdir(tmp_path / "output/sequences") == [] and (tmp_path / "output/keep.log").exists()
    for wrong in (".", "..", "../other"):
        with pytest.raises(ValueError):
            output.reset_sequences(dataclasses.replace(config, sequence_dir=wrong))


def test_pictures_of_sequences(spark, tmp_path):
    image = lambda k: bytearray(vision.encode_png(np.full((4, 4), k, np.uint8)))
    rows = [(d, "v", b, b * 2, b / 7.5, 0.5, 0.1, 0.9, image(b + 100 * (d == "b"))) for d in "ab" for b in (0, 1, 3, 4)]
    frames = spark.createDataFrame(rows, "dataset_id string, video_id string, bin long, frame_index long, timestamp double, quality double, motion double, ssim double, image binary")
    paths = lambda s: json.dumps([f"{s}/frame_{k:02d}.png" for k in range(4)])
    made = spark.createDataFrame([("s", "a", "v", paths("s"), 1), ("t", "b", "v", paths("t"), 0)], "sequence_id string, dataset_id string, video_id string, frame_paths string, start_bin int")
    got = output.write_images(output.sequence_images(made, frames, CONFIG), str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [("s", 4), ("t", 4)]
    assert [(tmp_path / f"s/frame_{k:02d}.png").read_bytes() == bytes(image(b)) for k, b in enumerate((1, 1, 3, 4))] == [True] * 4
    assert [(tmp_path / f"t/frame_{k:02d}.png").read_bytes() == bytes(image(100 + b)) for k, b in enumerate((0, 1, 1, 3))] == [True] * 4
    with pytest.raises(Exception, match="no image"):
        output.write_images(output.sequence_images(made.withColumn("start_bin", F.lit(3)), frames, CONFIG), str(tmp_path)).collect()


def test_json_lists_are_pythons(spark):
    names = [[], ["a/b.png"], ['quo"te', "back\\slash", "tab\there"], ["Été.png", "日本", "😀 x", "\x7f"]]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n array<string>").select(export.json_list(F.col("n"))).collect()]
    assert got == [json.dumps(n) for n in names]
    again = spark.createDataFrame([(json.dumps(n),) for n in names], "p string").select(export.rewrite_paths("p", ".jpg")).collect()
    assert [json.loads(r[0]) for r in again] == [[os.path.splitext(x)[0] + ".jpg" for x in n] for n in names]


def test_manifests_survive_their_csv(spark, tmp_path):
    rows = spark.createDataFrame([("s", json.dumps(['a"b', "Été, x\n"]), None, ""), ("t", "[]", 2, "line\nbreak")], "sequence_id string, frame_paths string, label int, split string")
    output.write_csv(rows, str(tmp_path / "m.csv"))
    got = {r["sequence_id"]: r for r in manifests.read_sequences(spark, str(tmp_path / "m.csv")).collect()}
    assert json.loads(got["s"]["frame_paths"]) == ['a"b', "Été, x\n"] and got["t"]["label"] == 2 and got["t"]["split"] == "line\nbreak"
    videos = spark.createDataFrame([("d", "v", "train"), ("d", "w", "val")], "dataset_id string, video_id string, split string")
    output.write_split_manifest(videos, str(tmp_path / "s.csv"))
    output.write_split_manifest(videos.where("video_id = 'w'").withColumn("split", F.lit("test")), str(tmp_path / "s.csv"))
    assert [(r["video_id"], r["split"]) for r in manifests.read_csv(spark, str(tmp_path / "s.csv")).collect()] == [("v", "train"), ("w", "test")]
    output.write_split_manifest(videos.limit(1), str(tmp_path / "s.csv"), keep=False)
    assert manifests.read_csv(spark, str(tmp_path / "s.csv")).count() == 1


def test_archives_hold_their_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("d", f"g{k % 3}", f"s{k}", json.dumps([f"s{k}/frame_00.png"])) for k in range(6)], "dataset_id string, group_id string, sequence_id string, frame_paths string")
    plan = spark.createDataFrame([("d", "g0", 0, "train", 10), ("d", "g1", 0, "train", 5), ("d", "g2", 1, "val", 7)], "dataset_id string, group_id string, part long, split string, bytes long")
    told = export.manifest_files(rows, plan, ["dataset_id", "group_id"], rows.columns)
    pictures = rows.join(plan, ["dataset_id", "group_id"]).select("part", F.concat(F.lit("sequences/"), F.col("sequence_id"), F.lit("/frame_00.png")).alias("name"), F.lit(b"x").alias("content"))
    export.write_archives(told.unionByName(pictures), str(tmp_path)).collect()
    with zipfile.ZipFile(tmp_path / "part000.zip") as z:
        table = pd.read_csv(z.open("manifests/sequence_manifest.csv"))
        assert sorted(table["sequence_id"]) == ["s0", "s1", "s3", "s4"] and len(z.namelist()) == 6
        assert json.loads(z.read("manifests/shard_info.json")) == {"part": 1, "total_parts": 2, "split": "train", "group_count": 2, "sequence_count": 4, "source_bytes": 15}
    for wrong in ({"quality": 0}, {"workers": 0}, {"sequences_per_video": 0}):
        with pytest.raises(ValueError, match="must be"):
            export.check_arguments(str(tmp_path / "new.zip"), **wrong)
    with pytest.raises(FileExistsError):
        export.check_arguments(str(tmp_path / "part000.zip"))
    export.check_arguments(str(tmp_path / "new.zip"))


def test_similarity_of_many_is_that_of_each():
    rng = np.random.default_rng(4)
    a, b = rng.uniform(0, 255, (2, 20, 11, 11))
    b[3], a[4] = a[3], 128.0
    assert np.allclose(vision.ssim_of_many(a, b), [vision.ssim(x, y) for x, y in zip(a, b)], atol=1e-9)


def test_identity_manifest(spark):
    files = [("Real/id0_0000.mp4", "Real", 0), ("Real/id1_0000.mp4", "Real", 0), ("Real/id2_0000.mp4", "Real", 0), ("Fake/id0_id1_0000.mp4", "Fake", 1), ("Fake/id2_id3_0000.mp4", "Fake", 1), ("Real/id9_0001.mp4", "Real", 0)]
    files = spark.createDataFrame([(*f, "fake" if f[2] else "real", "swap" if f[2] else "none") for f in files], "path string, folder string, label int, class_name string, gen_method string")
    test = spark.createDataFrame([("Real/id9_0001.mp4",)], "path string")
    rows = builders.identity_manifest(files, test, 0.5).collect()
    assert tuple(rows[0].asDict()) == builders.COLUMNS and rows == sorted(rows, key=lambda r: (r["split"], r["label"], r["path"]))
    by = {r["path"]: r for r in rows}
    assert by["Real/id0_0000.mp4"]["split"] == by["Real/id1_0000.mp4"]["split"] == by["Fake/id0_id1_0000.mp4"]["split"] != by["Fake/id2_id3_0000.mp4"]["split"]
    assert by["Real/id9_0001.mp4"]["split"] == "test" and by["Real/id9_0001.mp4"]["group_id"] == "official-test/real/id9_0001"
    assert {r["split"] for r in rows} == {"train", "val", "test"} and by["Fake/id2_id3_0000.mp4"]["group_id"] == "identity-component/id2-id3"


def test_paired_manifest(spark):
    meta = spark.createDataFrame([("original/000.mp4", 640, 480), ("Deepfakes/000_003.mp4", 640, 480), ("Other/1.mp4", 1, 1)], "`File Path` string, Width int, Height int")
    splits = spark.createDataFrame([("000", "train"), ("003", "train")], "id string, split string")
    rows = builders.paired_manifest(meta, splits, ("original", "deepfakes"), expected_rows=2).collect()
    assert [(r["path"], r["label"], r["group_id"], r["class_name"], r["resolution"], r["compression"]) for r in rows] == [("original/000.mp4", 0, "000", "real", "640x480", "c23"), ("Deepfakes/000_003.mp4", 1, "000", "fake", "640x480", "c23")]
    with pytest.raises(FileNotFoundError, match="missing videos"):
        builders.paired_manifest(meta, splits, ("original",), files=spark.createDataFrame([("x",)], "path string"))


def filtered(image, kinds):
    """A PNG whose rows are filtered as named, by the words of its specification."""
    import struct
    import zlib

    h, w, c = image.shape
    rows = []
    for y in range(h):
        k, line = kinds[y % len(kinds)], []
        for x in range(w):
            for ch in range(c):
                a = int(image[y, x - 1, ch]) if x else 0
                b = int(image[y - 1, x, ch]) if y else 0
                d = int(image[y - 1, x - 1, ch]) if x and y else 0
                paeth = min((a, b, d), key=lambda v: (abs(a + b - d - v), (a, b, d).index(v)))
                line.append((int(image[y, x, ch]) - (0, a, b, (a + b) // 2, paeth)[k]) % 256)
        rows.append(bytes([k, *line]))
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    data = zlib.compress(b"".join(rows))
    head = struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", data[:20]) + chunk(b"IDAT", data[20:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_pngs_are_read_whatever_their_filters(channels, tmp_path):
    rng = np.random.default_rng(channels)
    image = rng.integers(0, 256, (11, 7, channels), dtype=np.uint8)
    image[4:8] //= 16
    want = image[..., 0] if channels == 1 else image
    assert (vision.decode_png(filtered(image, [0, 1, 2, 3, 4])) == want).all()
    if channels in (1, 3):
        (tmp_path / "a.png").write_bytes(vision.encode_png(want))
        assert (output.read_picture(str(tmp_path / "a.png")) == want).all()
    for bad in (b"", b"\x89PNG\r\n\x1a\n", b"JFIF"):
        with pytest.raises(ValueError):
            vision.decode_png(bad)


def test_batches_of_pictures():
    load = output.normalised_pictures(4, lambda p: np.full((6, 8, 4), int(p), np.uint8))
    batch = load(["7", "9"])
    assert batch.shape == (2, 4, 4, 3) and batch.dtype == np.float32 and batch[1].min() == batch[1].max() == 9


def test_csv_plan_catalog_and_release(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v int")
    output.write_csv(rows.orderBy("k"), str(tmp_path / "m.csv"))
    output.write_csv(rows.orderBy("k"), str(tmp_path / "m.csv"))
    assert (tmp_path / "m.csv").read_text() == "k,v\na,1\nb,2\n" and not (tmp_path / "m.csv.tmp").exists()
    made = []
    build = lambda: made.append(1) or rows
    assert output.plan_or_build(spark, str(tmp_path / "plan"), build).count() == output.plan_or_build(spark, str(tmp_path / "plan"), build).count() == 2
    assert made == [1]
    assert output.release_flaws(str(tmp_path / "s.json"), 3) == ["there is no summary"]
    run.write_json({"valid_videos": 2, "failed_videos": [{}]}, str(tmp_path / "s.json"))
    assert output.release_flaws(str(tmp_path / "s.json"), 2, os.getpid()) == ["the run has not ended"]
    assert output.release_flaws(str(tmp_path / "s.json"), 3) == ["2 videos, not 3", "1 videos failed"]
    shards = spark.createDataFrame([(0, "train", 5), (0, "train", 6), (1, "val", 7)], "part long, split string, bytes long")
    assert output.shard_plan(shards, 10)["shards"][0] == {"part": 0, "split": "train", "groups": 2, "bytes": 11}


def test_batches_cover_every_row_in_seeded_orders(spark):
    rows = spark.createDataFrame([([f"p{k}"], float(k)) for k in range(11)], "paths array<string>, label float")
    first, again, other = (list(output.training_batches(rows, 4, len, 42, e)) for e in (0, 0, 1))
    flat = lambda b: [x for _, y in b for x in y]
    assert [len(y) for _, y in first] == [4, 4, 3] and flat(first) == flat(again) != flat(other) and sorted(flat(other)) == [float(k) for k in range(11)]


def test_stored_tables_go_when_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "_written", [])
    monkeypatch.setattr(shared, "shared_dir", lambda _: f"file://{tmp_path}")
    assert shared.stored(spark.range(3).toDF("id"), "t").count() == 3 and os.listdir(tmp_path)
    shared.stored(spark.range(2).toDF("id"), "u"), shared.stored(spark.range(1).toDF("id"), "v")
    shared.release(spark, but=1, since=1)
    assert sorted(x[0] for x in os.listdir(tmp_path)) == ["t", "v"] and shared.written() == 2
    shared.release(spark)
    assert os.listdir(tmp_path) == [] and list_files(spark, str(tmp_path)).count() == 0


def test_tables_are_measured_in_bytes(spark):
    rows = spark.createDataFrame([(1, "abc", [1, 2], (3, "x")), (None, None, None, None)], "a long, b string, c array<long>, d struct<e: long, f: string>")
    assert 100 < shared.row_bytes(rows) < 300 and shared.row_bytes(rows.limit(0)) == 0
    long_ = spark.range(10).select(F.array_repeat(F.lit(1), 10_000).alias("x"))
    assert shared.row_bytes(long_) > 800_000
    plan = lambda limit: rows.join(shared.small(rows.select("a"), limit), "a")._jdf.queryExecution().toString()
    assert "ResolvedHint (strategy=broadcast)" in plan(10**6) or "broadcast" in plan(10**6).lower()
    assert "broadcast" not in plan(0).split("== Physical")[0].lower()


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    def session(master, **conf):
        return type("S", (), {"conf": Conf(conf), "sparkContext": type("C", (), {"master": master})})

    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_dir(session("spark://somewhere:7077"))
    assert shared.shared_dir(session("spark://somewhere:7077", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


def test_every_failed_video_is_listed(spark):
    frames = spark.range(2500).selectExpr("'d' AS dataset_id", "lpad(id, 5, '0') AS video_id", "IF(id % 2 = 0, 'broken', NULL) AS error")
    got = run.failures(frames)
    assert [r["video_id"] for r in got] == [f"{i:05}" for i in range(0, 2500, 2)] and {r["error"] for r in got} == {"broken"}
