import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmill.operators import export, graph, identity, manifest, sequences, splits, validate, vision
from reelmill.plans import config as settings
from reelmill.plans import run as runs
from reelmill.sources import lists, listing, manifests


def touch(root, *names):
    for n in names:
        os.makedirs(os.path.dirname(f"{root}/{n}"), exist_ok=True)
        with open(f"{root}/{n}", "wb") as f:
            f.write(b"x" * 7)


PATHS = ["raw/targets/270x480/th/contains_target.mp4", "c40/simswap_224/1080x1920/th/contains_target.MP4", "clips/c23/deeplivecam/360x640/th-bb/a.mp4", "raw/targets/540x960/mp4/th-ob/a.avi", "raw/unknown/1x1/th/a.mp4", "raw/targets/a.mp4", "raw/targets/1x1/th/notes.txt"]


def test_layout_of_a_folder(spark, tmp_path):
    touch(tmp_path, *PATHS)
    good, bad = listing.discover_layout(spark, str(tmp_path), "clips")
    rows = {r["video_id"]: r for r in good.collect()}
    assert set(rows) == set(PATHS[:4]) and {r["path"] for r in bad.collect()} == set(PATHS[4:6])
    assert rows[PATHS[0]]["group_id"] == rows[PATHS[1]]["group_id"] == "clips:th/contains_target"
    assert [rows[p]["label"] for p in PATHS[:4]] == [0, 1, 1, 0] and rows[PATHS[3]]["media_type"] == "mp4" and rows[PATHS[2]]["compression"] == "c23"
    with pytest.raises(ValueError, match="unknown layout"):
        listing.discover_layout(spark, str(tmp_path), "clips", strict=True)


def csv(tmp_path, text):
    p = tmp_path / "m.csv"
    p.write_text(text)
    return str(p)


def test_manifest_rows(spark, tmp_path):
    touch(tmp_path, "clip.mp4")
    good, bad = manifests.discover_manifest(spark, csv(tmp_path, "path,label,group_id,split\nclip.mp4,1,000,Test\nno.mp4,0, A ,\n"), "custom", str(tmp_path), listing.list_files(spark, str(tmp_path)))
    (row,) = good.collect()
    assert (row["group_id"], row["split"], row["split_locked"], row["video_id"], row["video_name"]) == ("custom:000", "test", True, "clip.mp4", "clip")
    assert [r["path"] for r in bad.collect()] == [f"{tmp_path}/no.mp4"]
    for flaw in ("a.mp4,2,g,", "a.mp4,0.5,g,", "a.mp4,1, ,", "a.mp4,1,g,dev", "a.mp4,,g,"):
        with pytest.raises(ValueError):
            manifests.discover_manifest(spark, csv(tmp_path, f"path,label,group_id,split\n{flaw}\n"), "custom")
    with pytest.raises(ValueError, match="columns missing"):
        manifests.manifest_errors(spark.createDataFrame([("a",)], "path string"))


def test_sources_together(spark, tmp_path):
    touch(tmp_path, *PATHS[:4])
    sources = [{"id": "ZClips", "adapter": "layout", "root": str(tmp_path)}, {"id": "own", "adapter": "manifest", "csv": csv(tmp_path, "path,label,group_id,split\nb.mp4,1,g,val\n")}]
    videos, _ = manifests.discover(spark, sources)
    assert [r["dataset_id"] for r in videos.collect()] == ["own", "zclips", "zclips", "zclips", "zclips"]
    assert manifests.discover(spark, sources, ["ZClips"])[0].count() == 4
    with pytest.raises(ValueError, match="unknown datasets"):
        manifests.discover(spark, sources, ["other"])
    sources[1]["csv"] = csv(tmp_path, "path,label,group_id,split\nb.mp4,1,g,val\nc.mp4,1,h,\n")
    with pytest.raises(ValueError, match="mix"):
        manifests.discover(spark, sources)


def test_balanced_split_of_twenty(spark):
    rows = spark.createDataFrame([("clips", f"g{k}") for k in range(20)], "d string, g string")
    n = {r["split"]: r["count"] for r in splits.balanced_hash_split(rows, "d", "g").groupBy("split").count().collect()}
    assert n == {"train": 14, "val": 3, "test": 3}


def test_apportioning_by_hand(spark):
    rows = spark.range(0, 200).select(F.col("id").alias("n"))
    for ratios in ((0.7, 0.15, 0.15), (0.72, 0.14, 0.14), (0.5, 0.25, 0.25), (1.0, 0.0, 0.0)):
        for r in rows.select("n", *(c.alias(f"c{k}") for k, c in enumerate(splits.apportioned(F.col("n"), ratios)))).collect():
            whole = [int(r["n"] * x) for x in ratios]
            order = sorted(range(3), key=lambda k: (-(r["n"] * ratios[k] - whole[k]), k))
            for k in order[: r["n"] - sum(whole)]:
                whole[k] += 1
            assert [r["c0"], r["c1"], r["c2"]] == whole


def test_lists_and_canonical_splits(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1 a/x.mp4\n\n 0   b/y.mp4 \n")
    assert [tuple(r) for r in lists.read_test_list(spark, str(tmp_path / "t.txt")).orderBy("path").collect()] == [(1, "a/x.mp4"), (0, "b/y.mp4")]
    for flaw in ("1 a b\n", "2 a\n", "1 a\n0 a\n", "x a\n"):
        (tmp_path / "t.txt").write_text(flaw)
        with pytest.raises(ValueError):
            lists.read_test_list(spark, str(tmp_path / "t.txt"))
    for name, pairs in {"train": [["000", "003"], ["010", "011"]], "val": [["020", "021"]]}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(pairs))
    found = lists.read_canonical_splits(spark, {n: str(tmp_path / f"{n}.json") for n in ("train", "val")}, 6)
    meta = lambda *files: spark.createDataFrame([(f, 640, 480) for f in files], "`File Path` string, Width int, Height int")
    got = lists.canonical_manifest(meta("Deepfakes/000_003.mp4", "original/020.mp4", "other/1.mp4"), found, ("deepfakes", "original"))
    assert [(r["gen_method"], r["resolution"], r["split"]) for r in got.collect()] == [("deepfakes", "640x480", "train"), ("original", "640x480", "val")]
    for wrong in ("original/999.mp4", "Deepfakes/000_020.mp4"):
        with pytest.raises(ValueError):
            lists.canonical_manifest(meta(wrong), found, ("deepfakes", "original"))
    with pytest.raises(ValueError, match="not 5"):
        lists.read_canonical_splits(spark, {n: str(tmp_path / f"{n}.json") for n in ("train", "val")}, 5)


@pytest.mark.parametrize("alone", [0, 10**4])
def test_components_of_a_random_graph(spark, alone):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (190, 2))] + [(k, k + 1) for k in range(400, 520)] + [(7, 7)]
    group = list(range(600))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        group[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), one_task_edges=alone).collect()}
    want = {v: find(v) for a, b in edges if a != b for v in (a, b)}
    assert got == want


def test_identity_groups(spark):
    rows = spark.createDataFrame(
        [("F/id0_id1_0000.mp4", 1, "train"), ("F/id1_id2_0001.mp4", 1, "train"), ("F/id5_id6_0000.mp4", 1, ""), ("R/id0_0000.mp4", 0, ""), ("R/id9_0001.mp4", 0, ""), ("Y/00001.mp4", 0, ""), ("F/id9_id0_0000.mp4", 1, "test")],
        "path string, label int, split string",
    )
    from reelmill.functions.paths import tokens

    rows = rows.withColumn("tokens", tokens(F.col("path")))
    found = graph.named_components(*graph.identity_edges(rows, "tokens", "label", "split"))
    got = {r["path"]: r["group_id"] for r in graph.group_ids(rows, found, "tokens", "path", "split").collect()}
    assert got["F/id0_id1_0000.mp4"] == got["R/id0_0000.mp4"] == "identity-component/id0-id1-id2"
    assert got["R/id9_0001.mp4"] == "identity-component/id9" and got["Y/00001.mp4"] == "y/00001" and got["F/id9_id0_0000.mp4"] == "official-test/f/id9_id0_0000"


def test_sequence_ids_are_uuids(spark):
    import uuid

    got = spark.range(50).select("id", identity.sequence_id(F.col("id"), F.lit(None), identity.fixed9(F.col("id") / 1024.0)).alias("u"))
    assert all(r["u"] == str(uuid.uuid5(uuid.NAMESPACE_URL, f"{r['id']}||{r['id'] / 1024:.9f}")) for r in got.collect())


def test_upsert_and_conforming(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, "x"), ("b", 4, "y"), ("c", 5, None)], "k string, v int, w string")
    assert [tuple(r) for r in manifest.upsert(old, new, ["k"], ["v"], ["k"]).collect()] == [("a", 1, None), ("b", 4, "y"), ("c", 5, None)]


def test_rules_name_every_flaw(spark):
    good = ("s", "clips", "v", "clips:g", 0, "train", '["s/frame_00.png"]', 1, "abc")
    names = "sequence_id string, dataset_id string, video_id string, group_id string, label int, split string, frame_paths string, seq_len int, pipeline_fingerprint string"
    files = spark.createDataFrame([("s/frame_00.png",)], "path string")
    assert validate.require_valid(spark.createDataFrame([good], names), files, False)["sequences"] == 1
    flaws = {
        "duplicate_sequence": [good, good], "several_fingerprints": [good, ("t", *good[1:8], "old")], "bad_label": [good, ("t", *good[1:4], None, *good[5:])], "bad_split": [(*good[:5], "dev", *good[6:])],
        "leaking_group": [good, ("t", *good[1:5], "val", *good[6:])], "bad_paths": [(*good[:6], '["../x.png"]', *good[7:])], "missing_file": [(*good[:6], '["s/no.png"]', *good[7:])], "empty": [],
    }
    for rule, rows in flaws.items():
        with pytest.raises(ValueError, match=rule):
            validate.require_valid(spark.createDataFrame(rows, names), files, False)


def test_archives(spark, tmp_path):
    rows = spark.createDataFrame([(k % 2, f"f{k}.txt", bytearray(b"x" * k)) for k in range(6)], "part long, name string, content binary")
    done = export.write_archives(rows, str(tmp_path)).collect()
    assert sorted((r["part"], r["files"]) for r in done) == [(0, 3), (1, 3)]
    with zipfile.ZipFile(tmp_path / "part001.zip") as z:
        assert z.namelist() == ["f1.txt", "f3.txt", "f5.txt"] and z.read("f5.txt") == b"xxxxx"
    assert (tmp_path / "part000.zip.sha256").read_text().split()[0] == identity.file_sha256(str(tmp_path / "part000.zip"))


def test_config_checks_and_fingerprint(tmp_path):
    good = settings.RunConfig(({"id": "a", "adapter": "layout", "root": "x"},), "out")
    good.check()
    import dataclasses

    other = lambda **k: dataclasses.replace(good, **k)
    for k in ({"ratios": (0.5, 0.5, 0.5)}, {"sequence_dir": ".."}, {"sequence_dir": "."}, {"model_fps": 20.0}, {"output_format": "gif"}, {"seq_len": 0}, {"sources": ()}):
        with pytest.raises(ValueError):
            other(**k).check()
    assert good.fingerprint() == other(output_dir="b", jpeg_quality=3, output_format="PNG").fingerprint() != other(seed=1).fingerprint()
    (tmp_path / "c.yaml").write_text("sources: [{id: a, adapter: layout, root: videos}]\noutput_dir: out\nlimits: {max_repair: 0.2}\n")
    loaded = settings.load(str(tmp_path / "c.yaml"))
    assert loaded.sources[0]["root"] == str(tmp_path / "videos") and loaded.limits.max_repair == 0.2


def decode(path):
    """A stand-in for a decoder: 30 frames a second of a moving pattern; broken files raise."""
    if "broken" in path:
        raise OSError("cannot open")
    rng = np.random.default_rng(len(path))
    return 30.0, ((rng.integers(0, 255, (64, 64, 3), dtype=np.uint8), i / 30.0, i) for i in range(150))


def detector():
    return lambda image: [(0.1, 0.1, 0.5, 0.5, 0.9)]


def test_from_videos_to_a_manifest(spark, tmp_path):
    touch(tmp_path, "raw/targets/1x1/th/a.mp4", "raw/targets/1x1/th/b.mp4", "c23/deeplivecam/1x1/th/broken.mp4")
    config = settings.RunConfig(({"id": "clips", "adapter": "layout", "root": str(tmp_path)},), str(tmp_path / "out"), seq_len=8, window_hop=4, image_size=16, max_sequences_per_video=3)
    made, told = runs.preprocess(spark, config, decode, detector)
    rows = made.collect()
    assert told["failed_videos"] == [{"dataset_id": "clips", "video_id": "c23/deeplivecam/1x1/th/broken.mp4", "error": "OSError: cannot open"}]
    assert {r["video_id"] for r in rows} == {"raw/targets/1x1/th/a.mp4", "raw/targets/1x1/th/b.mp4"} and len(rows) == 6
    assert all(len(json.loads(r["frame_paths"])) == 8 and r["pipeline_fingerprint"] == config.fingerprint() for r in rows)
    again, _ = runs.preprocess(spark, config, lambda p: 1 / 0, detector, existing=made.where("video_id like '%a.mp4'"))
    assert again.count() == 3
    import dataclasses

    with pytest.raises(ValueError, match="other settings"):
        runs.preprocess(spark, dataclasses.replace(config, seed=1), decode, detector, existing=made)
    with pytest.raises(RuntimeError, match="failed"):
        runs.preprocess(spark, dataclasses.replace(config, fail_on_video_error=True), decode, detector)


def decode_tail(path):
    """Faces (bright pictures) in the first 2.2 of 4 seconds only, frames numbered from 100 on; "x" has none at all."""
    bright = 0 if path.endswith("x.mp4") else 66
    rng = np.random.default_rng(len(path))
    return 30.0, ((rng.integers(100, 255, (64, 64, 3), dtype=np.uint8) if i < bright else np.zeros((64, 64, 3), np.uint8), i / 30.0, 100 + i) for i in range(120))


def detector_bright():
    return lambda image: [(0.1, 0.1, 0.5, 0.5, 0.9)] if image.max() > 50 else []


def test_sources_that_share_a_video_and_a_tail_without_faces(spark, tmp_path):
    import uuid

    touch(tmp_path, "one/raw/targets/1x1/th/a.mp4", "two/raw/targets/1x1/th/a.mp4", "two/raw/targets/1x1/th/x.mp4")
    sources = tuple({"id": n, "adapter": "layout", "root": str(tmp_path / n)} for n in ("one", "two"))
    limits = sequences.WindowLimits(max_missing=1.0, max_repair=1.0, max_duplicate=1.0, min_motion=0.0)
    config = settings.RunConfig(sources, str(tmp_path / "out"), seq_len=4, window_hop=2, image_size=16, max_sequences_per_video=50, max_repairs=1, limits=limits)
    videos, _ = manifests.discover(spark, list(sources))
    frames = vision.chosen_frames(videos, decode_tail, detector_bright, config.video_settings()).cache()
    bins = runs.gapless(frames, config).collect()
    for v, valid in ((("one", "a"), 17), (("two", "a"), 17), (("two", "x"), 0)):  # 30 bins in 4 seconds
        own = sorted((r["bin"], r["state"]) for r in bins if (r["dataset_id"], r["video_id"][-5]) == v)
        assert own == [(b, "valid" if b < valid else "repair" if valid and b == valid else "missing") for b in range(30)]
    made = runs.sequence_rows(runs.build_sequences(frames, config), videos.withColumn("split", F.lit("train")), config).collect()
    assert {(r["dataset_id"], r["video_id"][-5]): len([x for x in made if (x["dataset_id"], x["video_id"]) == (r["dataset_id"], r["video_id"])]) for r in made} == {("one", "a"): 14, ("two", "a"): 14, ("two", "x"): 14}
    at = {(r["dataset_id"], r["video_id"], r["bin"]): r for r in bins}
    for r in made:
        first, last = (at[r["dataset_id"], r["video_id"], r[c]] for c in ("start_bin", "end_bin"))
        assert (r["start_time"], r["end_time"], r["start_frame"], r["end_frame"]) == (first["timestamp"], last["timestamp"], first["frame_index"], last["frame_index"])
        assert r["start_frame"] == -1 or r["start_frame"] >= 100
        parts = [r["dataset_id"], r["video_id"], first["frame_index"], last["frame_index"], 4, 7.5, 16, f"{first['timestamp']:.9f}", f"{last['timestamp']:.9f}", config.fingerprint()]
        assert r["sequence_id"] == str(uuid.uuid5(uuid.NAMESPACE_URL, "|".join(map(str, parts))))
    assert len({r["sequence_id"] for r in made}) == len(made)
    with pytest.raises(ValueError, match="unsupported detector"):
        vision.detector_named("other")
    import dataclasses

    with pytest.raises(ValueError, match="unsupported detector"):
        dataclasses.replace(config, detector="other").check()


def test_steps_and_the_command_line(spark, tmp_path, capsys):
    from reelmill.__main__ import main

    touch(tmp_path, "in/raw/targets/1x1/th/a.mp4", "in/raw/targets/1x1/th/b.mp4", "in/raw/targets/1x1/th/broken.mp4")
    (tmp_path / "c.yaml").write_text("sources: [{id: clips, adapter: layout, root: in}]\noutput_dir: out\nseq_len: 8\nwindow_hop: 4\nimage_size: 16\nmax_sequences_per_video: 2\n")
    os.makedirs(tmp_path / "out")
    common = [str(tmp_path / "c.yaml"), "--decoder", "tests.test_sources:decode", "--detector", "tests.test_sources:detector"]
    assert main(["run", *common, "--steps", "2"]) == 0
    told = json.loads((tmp_path / "out/summary.json").read_text())
    assert told["sequences"] == 4 and [f["video_id"] for f in told["failed_videos"]] == ["raw/targets/1x1/th/broken.mp4"]
    assert main(["run", *common, "--steps", "2"]) == 0 and runs.saved_manifest(spark, str(tmp_path / "out/manifest")).count() == 4
    assert main(["validate", str(tmp_path / "c.yaml")]) == 0
    table = manifests.read_sequences(spark, str(tmp_path / "out/manifests/sequence_manifest.csv")).collect()
    assert len(table) == 4 and all((tmp_path / "out/sequences" / p).exists() for r in table for p in json.loads(r["frame_paths"]))
    assert manifests.read_csv(spark, str(tmp_path / "out/manifests/split_manifest.csv")).count() == 3
    assert main(["check", str(tmp_path / "c.yaml"), "--allow-partial"]) == 0
    with pytest.raises(ValueError, match="missing_split"):
        main(["check", str(tmp_path / "c.yaml")])
    os.remove(tmp_path / "out/sequences" / json.loads(table[0]["frame_paths"])[0])
    with pytest.raises(ValueError, match="missing_file"):
        main(["check", str(tmp_path / "c.yaml"), "--allow-partial"])
    for wrong in (["--overwrite", "--resume"], ["--resume", "--no-resume"]):
        with pytest.raises(SystemExit):
            main(["run", *common, *wrong])
    with pytest.raises(SystemExit):
        main(["run", *common, "--overwrite", "--dataset", "clips"])


def test_png_and_resize():
    import struct
    import zlib

    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    png = vision.encode_png(image)
    assert struct.unpack(">II", png[16:24]) == (4, 4)
    raw = zlib.decompress(png[41 : 41 + struct.unpack(">I", png[33:37])[0]])
    assert np.frombuffer(raw, np.uint8).reshape(4, 13)[:, 1:].tobytes() == image.tobytes()
    assert (vision.resize(image, 4) == image).all() and vision.resize(image, 9).shape == (9, 9, 3)
    assert vision.crop(image, [], 4)[2] is True
