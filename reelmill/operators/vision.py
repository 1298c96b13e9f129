"""Pictures: choosing and cropping detections, quality, structural similarity, and what runs one video.

Decoders, detectors and codecs are arguments; nothing here needs an image library.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelmill.operators.selection import CENTER_WEIGHT, FULL_MOTION, MOTION_WEIGHT, QUALITY_WEIGHT

# -- records --------------------------------------------------------------------------------------------------------


def pick_detection(detections: Column, largest: bool = True) -> Column:
    """The detection (xmin, ymin, w, h, score) with the largest area or the highest score; the first of equal ones."""
    worth = (lambda d: d["w"] * d["h"]) if largest else (lambda d: d["score"])
    best = F.array_max(F.transform(detections, worth))
    return F.get(F.filter(detections, lambda d: worth(d) == best), F.lit(0))


def crop_geometry(rows: DataFrame, box: str, width: str, height: str, margin: float = 1.3, min_ratio: float = 0.02, min_side: int = 10) -> DataFrame:
    """Adds x1, y1, x2, y2, missing_face_flag, hard_invalid: a square around the box, cut off at the frame.

    Box numbers are shares of the frame and are cut to whole pixels toward zero. A box under min_ratio of the frame
    makes the record invalid but still gives a crop; a crop of min_side or less counts as no face.
    """
    at = lambda f, size: (F.col(f"{box}.{f}") * F.col(size)).cast("int")
    rows = rows.withColumns({"_x": at("xmin", width), "_y": at("ymin", height), "_w": at("w", width), "_h": at("h", height)})
    rows = rows.withColumn("_half", F.expr(f"cast(greatest(_w, _h) * cast({float(margin)} AS double) AS int) div 2"))
    rows = rows.withColumns({"_cx": F.expr("_x + cast(floor(_w / 2D) AS int)"), "_cy": F.expr("_y + cast(floor(_h / 2D) AS int)")})
    clamp = lambda c, size: F.greatest(F.lit(0), F.least(c, F.col(size))).cast("int")
    rows = rows.withColumns(
        {
            "x1": clamp(F.col("_cx") - F.col("_half"), width),
            "y1": clamp(F.col("_cy") - F.col("_half"), height),
            "x2": clamp(F.col("_cx") + F.col("_half"), width),
            "y2": clamp(F.col("_cy") + F.col("_half"), height),
        }
    )
    small = F.greatest(F.col(f"{box}.w"), F.lit(0.0)) * F.greatest(F.col(f"{box}.h"), F.lit(0.0)) < min_ratio
    none = F.col(box).isNull() | (F.col("x2") - F.col("x1") <= min_side) | (F.col("y2") - F.col("y1") <= min_side)
    rows = rows.withColumn("missing_face_flag", F.coalesce(none, F.lit(True)))
    return rows.withColumn("hard_invalid", F.col("missing_face_flag") | F.coalesce(small, F.lit(False))).drop("_x", "_y", "_w", "_h", "_half", "_cx", "_cy")


@dataclass(frozen=True)
class QualityLimits:
    enforced: bool = False
    min_blur: float = 60.0
    min_brightness: float = 35.0
    max_brightness: float = 225.0
    min_contrast: float = 10.0


def quality_column(blur: Column, mean: Column, std: Column, confidence: Column, limits: QualityLimits = QualityLimits()) -> Column:
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    bright = F.lit(1.0) - F.abs(mean - F.lit(127.5)) / F.lit(127.5)
    return unit(F.lit(0.3) * unit(blur / F.lit(2 * limits.min_blur)) + F.lit(0.2) * bright + F.lit(0.2) * unit(std / F.lit(2 * limits.min_contrast)) + F.lit(0.3) * confidence)


def within_limits(blur: Column, mean: Column, std: Column, limits: QualityLimits) -> Column:
    if not limits.enforced:
        return F.lit(True)
    return (blur >= limits.min_blur) & mean.between(limits.min_brightness, limits.max_brightness) & (std >= limits.min_contrast)


def pixel_rows(images: DataFrame, key: str, pixels: str, width: int) -> DataFrame:
    """(key, y, x, p) of a flat array of gray pixels."""
    out = images.select(key, F.posexplode(pixels).alias("_at", "p"))
    return out.select(key, F.expr(f"cast(_at div {width} AS int)").alias("y"), F.expr(f"cast(_at % {width} AS int)").alias("x"), F.col("p").cast("double").alias("p"))


def picture_statistics(images: DataFrame, key: str, pixels: str, width: int, height: int) -> DataFrame:
    """(key, blur, brightness, contrast) of small gray pictures held in arrays; borders are mirrored at the edge pixel.

    Blur is the variance of the Laplacian. One pass over the arrays, without exploding or joining them.
    """
    n = width * height
    at = lambda y, x: f"element_at({pixels}, cast(({y}) * {width} + ({x}) + 1 AS int))"
    mirrored = lambda v, size: f"CASE WHEN {v} < 0 THEN -({v}) WHEN {v} >= {size} THEN 2 * {size} - 2 - ({v}) ELSE {v} END"
    y, x = f"(i div {width})", f"(i % {width})"
    around = " + ".join(at(mirrored(f"({y} + {dy})", height), mirrored(f"({x} + {dx})", width)) for dy, dx in ((-1, 0), (1, 0), (0, -1), (0, 1)))
    lap = F.expr(f"transform(sequence(0, {n - 1}), i -> cast({around} - 4 * {at(y, x)} AS double))")
    total = lambda c: F.expr(f"aggregate({c}, 0D, (a, v) -> a + v)")
    spread = lambda c, m: F.expr(f"aggregate({c}, 0D, (a, v) -> a + (v - {m}) * (v - {m}))") / n
    rows = images.select(key, F.col(pixels).alias(pixels), lap.alias("_lap")).withColumns({"_lm": total("_lap") / n, "brightness": total(pixels) / n})
    return rows.select(key, spread("_lap", "_lm").alias("blur"), "brightness", F.sqrt(spread(pixels, "brightness")).alias("contrast"))


def motion_against_previous(images: DataFrame, item: str, order: str, pixels: str, side: int) -> DataFrame:
    """(item, order, ssim, motion) of small square gray pictures against the one before; both null for the first."""
    before = F.lag(pixels).over(Window.partitionBy(item).orderBy(order))

    @F.pandas_udf("double")
    def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        both = (a.notna() & b.notna()).to_numpy()
        out = np.full(len(a), np.nan)
        if both.any():
            out[both] = ssim_of_many(*(np.stack(x[both].to_list()).reshape(-1, side, side) for x in (a, b)))
        return pd.Series(out)

    rows = images.withColumn("_before", before).withColumn("ssim", F.nanvl(similarity(F.col(pixels), F.col("_before")), F.lit(None).cast("double")))
    return rows.select(item, order, "ssim", F.greatest(F.lit(0.0), 1 - F.col("ssim")).alias("motion"))


# -- arrays ---------------------------------------------------------------------------------------------------------


def gray(image: np.ndarray) -> np.ndarray:
    """Luma of an RGB picture; a gray one as it is."""
    return np.asarray(image, float) if image.ndim == 2 else image[..., :3].astype(float) @ np.array([0.299, 0.587, 0.114])


def statistics(image: np.ndarray) -> tuple[float, float, float]:
    """Blur (variance of the Laplacian, borders mirrored at the edge pixel), brightness, contrast."""
    g = gray(image)
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g
    return float(lap.var()), float(g.mean()), float(g.std())


def quality_score(image: np.ndarray, confidence: float, limits: QualityLimits = QualityLimits()) -> tuple[float, bool]:
    """The score, and whether the picture is inside the limits (always, if they are not enforced)."""
    blur, mean, std = statistics(image)
    parts = 0.3 * min(blur / (2 * limits.min_blur), 1) + 0.2 * (1 - abs(mean - 127.5) / 127.5) + 0.2 * min(std / (2 * limits.min_contrast), 1) + 0.3 * confidence
    inside = blur >= limits.min_blur and limits.min_brightness <= mean <= limits.max_brightness and std >= limits.min_contrast
    return float(np.clip(parts, 0, 1)), inside or not limits.enforced


def ssim(a: np.ndarray, b: np.ndarray, window: int = 7, data_range: float = 255.0) -> float:
    """Mean structural similarity: uniform windows that lie inside the picture, sample covariances, K1 0.01, K2 0.03."""
    a, b = gray(np.asarray(a, float)), gray(np.asarray(b, float))
    view = lambda z: np.lib.stride_tricks.sliding_window_view(z, (window, window)).reshape(-1, window * window)
    x, y = view(a), view(b)
    n = window * window
    mx, my = x.mean(1), y.mean(1)
    vx, vy = x.var(1, ddof=1), y.var(1, ddof=1)
    cov = ((x - mx[:, None]) * (y - my[:, None])).sum(1) / (n - 1)
    c1, c2 = (0.01 * data_range) ** 2, (0.03 * data_range) ** 2
    return float((((2 * mx * my + c1) * (2 * cov + c2)) / ((mx**2 + my**2 + c1) * (vx + vy + c2))).mean())


def ssim_of_many(a: np.ndarray, b: np.ndarray, window: int = 7, data_range: float = 255.0) -> np.ndarray:
    """ssim() of each gray picture of a with the one of b at its place; sums over windows come from running sums."""

    def means(z: np.ndarray) -> np.ndarray:
        total = np.zeros((len(z), z.shape[1] + 1, z.shape[2] + 1))
        total[:, 1:, 1:] = z.cumsum(1).cumsum(2)
        return (total[:, window:, window:] - total[:, :-window, window:] - total[:, window:, :-window] + total[:, :-window, :-window]) / window**2

    # Around one value for each picture, as differences of large squares lose digits.
    shift = a.mean((1, 2), keepdims=True)
    x, y = np.asarray(a, float) - shift, np.asarray(b, float) - shift
    mx, my = means(x), means(y)
    scale = window**2 / (window**2 - 1)
    vx, vy, cov = (means(x * x) - mx * mx) * scale, (means(y * y) - my * my) * scale, (means(x * y) - mx * my) * scale
    mx, my = mx + shift, my + shift
    c1, c2 = (0.01 * data_range) ** 2, (0.03 * data_range) ** 2
    return (((2 * mx * my + c1) * (2 * cov + c2)) / ((mx**2 + my**2 + c1) * (vx + vy + c2))).mean((1, 2))


def resize(image: np.ndarray, size: int) -> np.ndarray:
    """Bilinear, with pixel centers aligned."""
    h, w = image.shape[:2]
    spot = lambda n: np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
    y, x = spot(h), spot(w)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    if image.ndim == 3:
        fy, fx = fy[..., None], fx[..., None]
    z = image.astype(float)
    top, low = z[y0][:, x0] * (1 - fx) + z[y0][:, x1] * fx, z[y1][:, x0] * (1 - fx) + z[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def encode_png(image: np.ndarray, level: int = 3) -> bytes:
    """An 8-bit gray or RGB picture as PNG."""
    image = np.ascontiguousarray(image, np.uint8)
    h, w = image.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), image.reshape(h, -1)], 1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 0 if image.ndim == 2 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, level)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """The pixels of an 8-bit PNG, gray, RGB or either with alpha, without interlacing."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, packed, head = 8, [], None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        at += size + 12
    if head is None or head[2] != 8 or head[3] not in (0, 2, 4, 6) or head[6]:
        raise ValueError(f"not supported: {head}")
    w, h, channels = head[0], head[1], {0: 1, 2: 3, 4: 2, 6: 4}[head[3]]
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h + 1, w + 1, channels), np.uint8)  # a row above and a pixel to the left, both zero
    for y in range(h):
        line, here, above = rows[y, 1:].reshape(w, channels), out[y + 1], out[y]
        match rows[y, 0]:
            case 0:
                here[1:] = line
            case 1:
                here[1:] = np.cumsum(line, 0, dtype=np.uint8)
            case 2:
                here[1:] = line + above[1:]
            case 3:
                for x in range(w):
                    here[x + 1] = (line[x].astype(int) + (here[x].astype(int) + above[x + 1]) // 2) & 255
            case 4:
                for x in range(w):
                    left, up, corner = here[x].astype(int), above[x + 1].astype(int), above[x].astype(int)
                    far = np.abs(np.stack([up - corner, left - corner, left + up - 2 * corner]))
                    guess = np.where((far[0] <= far[1]) & (far[0] <= far[2]), left, np.where(far[1] <= far[2], up, corner))
                    here[x + 1] = (line[x] + guess) & 255
            case kind:
                raise ValueError(f"filter {kind}")
    image = out[1:, 1:]
    return image[..., 0] if channels == 1 else image


# -- one video ------------------------------------------------------------------------------------------------------

Frame = tuple[np.ndarray, float, int]  # picture, container time, index
Detection = tuple[float, float, float, float, float]


def crop(image: np.ndarray, boxes: list[Detection], size: int, margin: float = 1.3, largest: bool = True, min_ratio: float = 0.02) -> tuple[np.ndarray | None, float, bool]:
    """The resized square around the chosen box, its confidence, and whether the record is invalid."""
    if not boxes:
        return None, 0.0, True
    x, y, w, h, score = max(boxes, key=(lambda d: d[2] * d[3]) if largest else (lambda d: d[4]))
    high, wide = image.shape[:2]
    px, py, pw, ph = int(x * wide), int(y * high), int(w * wide), int(h * high)
    half = int(max(pw, ph) * margin) // 2
    cx, cy = px + pw // 2, py + ph // 2
    x1, x2, y1, y2 = max(0, cx - half), min(wide, cx + half), max(0, cy - half), min(high, cy + half)
    if x2 - x1 <= 10 or y2 - y1 <= 10:
        return None, score, True
    return resize(image[y1:y2, x1:x2], size), score, max(0.0, w) * max(0.0, h) < min_ratio


@dataclass(frozen=True)
class VideoSettings:
    candidate_fps: float = 15.0
    model_fps: float = 7.5
    image_size: int = 300
    use_timestamps: bool = True
    margin: float = 1.3
    min_face_ratio: float = 0.02
    largest: bool = True
    quality: QualityLimits = QualityLimits()


#: Makes a detector, by the name that settings give it.
DETECTORS: dict[str, Callable[[], Callable[[np.ndarray], list[Detection]]]] = {}


def mediapipe_detector(model: int = 0, least_score: float = 0.5):
    """Faces by that library, where it is installed."""
    from mediapipe import solutions

    class Detector:
        def __init__(self):
            self.own = solutions.face_detection.FaceDetection(model_selection=model, min_detection_confidence=least_score)

        def __call__(self, image: np.ndarray) -> list[Detection]:
            boxes = [(d.location_data.relative_bounding_box, float(d.score[0])) for d in self.own.process(image).detections or []]
            return [(b.xmin, b.ymin, b.width, b.height, score) for b, score in boxes]

        def close(self) -> None:
            self.own.close()

    return Detector()


DETECTORS["mediapipe"] = mediapipe_detector


def detector_named(name: str):
    if name not in DETECTORS:
        raise ValueError(f"unsupported detector: {name}")
    return DETECTORS[name]


CHOSEN = "dataset_id string, video_id string, bin long, frame_index long, timestamp double, quality double, motion double, ssim double, score double, image binary"


def chosen_frames(videos: DataFrame, decode: Callable[[str], tuple[float, Iterator[Frame]]], detector: Callable[[], Callable[[np.ndarray], list[Detection]]], settings: VideoSettings = VideoSettings(), workers: int | None = None) -> DataFrame:
    """(dataset_id, video_id, error, ...): the best frame of each time bin of each video, one video at a time in each task.

    Frames are decoded, put at their times, sampled, cropped and scored as they come; only the best of the open bin
    and the last chosen picture are held. If a video's last bin has candidates but no frame that can be chosen, a row
    without a frame stands for it, so the bins after the last chosen one are known. A video that fails gives one row
    with its error and nothing else. One detector is made for each task; workers is the number of tasks.
    """
    bin_s, step = 1.0 / settings.model_fps, 1.0 / settings.candidate_fps

    def one(path: str, detect) -> Iterator[tuple]:
        fps, frames = decode(path)
        fps = fps if fps and fps > 0 else 30.0
        at, taken, end = None, -1, -1
        best, last = None, None
        for image, container, index in frames:
            t = index / fps
            if settings.use_timestamps and container is not None and container >= 0 and (at is None or container > at):
                t = container
            at = t
            if (bucket := int((t + 1e-9) // step)) <= taken:
                continue
            taken = bucket
            k = int(t / bin_s)
            end = max(end, k)
            face, confidence, invalid = crop(image, detect(image), settings.image_size, settings.margin, settings.largest, settings.min_face_ratio)
            if face is None or invalid:
                continue
            quality, inside = quality_score(face, confidence, settings.quality)
            if not inside:
                continue
            if best and best[0] < k:
                yield best
                last, best = best[-1], None
            like = None if last is None else ssim(face, last)
            motion = 0.0 if like is None else max(0.0, 1 - like)
            score = QUALITY_WEIGHT * quality + MOTION_WEIGHT * min(motion / FULL_MOTION, 1) + CENTER_WEIGHT * max(0.0, 1 - abs(t - (k + 0.5) * bin_s) / (bin_s / 2))
            if best is None or score > best[6]:
                best = (k, index, t, quality, motion, like, score, face)
        if best:
            yield best
        if end > (best[0] if best else -1):
            yield end, *[None] * 7

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = detector()
        try:
            for batch in batches:
                for source, video, path in zip(batch["dataset_id"], batch["video_id"], batch["path"], strict=True):
                    try:
                        rows = [(source, video, *r[:-1], None if r[-1] is None else encode_png(r[-1]), None) for r in one(path, detect)]
                    except Exception as e:  # the other videos go on; the caller decides what a failure means
                        rows = [(source, video, *[None] * 8, f"{type(e).__name__}: {e}")]
                    if rows:
                        yield pd.DataFrame(rows, columns=[f.split()[0] for f in CHOSEN.split(", ")] + ["error"]).astype({"bin": "Int64", "frame_index": "Int64"})
        finally:
            getattr(detect, "close", lambda: None)()

    videos = videos.select("dataset_id", "video_id", "path")
    return (videos.repartition(workers) if workers else videos).mapInPandas(run, CHOSEN + ", error string")
