"""Settings of a run, checked before anything starts."""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, field

from reelmill.operators.identity import fingerprint
from reelmill.operators.sequences import WindowLimits
from reelmill.operators.vision import DETECTORS, QualityLimits, VideoSettings

FORMATS = ("png", "jpg", "jpeg")


@dataclass(frozen=True)
class RunConfig:
    sources: tuple[dict, ...]
    output_dir: str
    sequence_dir: str = "sequences"
    seed: int = 42
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)
    strategy: str = "balanced_hash"
    group_by: str = "background_and_video_name"
    candidate_fps: float = 15.0
    model_fps: float = 7.5
    seq_len: int = 24
    window_hop: int = 6
    image_size: int = 300
    max_sequences_per_video: int = 6
    max_repairs: int = 1
    detector: str = "mediapipe"
    select_largest_face: bool = True
    face_margin: float = 1.3
    min_face_ratio: float = 0.02
    output_format: str = "png"
    jpeg_quality: int = 95
    use_timestamp_sampling: bool = True
    fail_on_video_error: bool = False
    limits: WindowLimits = field(default_factory=WindowLimits)
    quality: QualityLimits = field(default_factory=QualityLimits)

    def check(self) -> RunConfig:
        """Raises with every flaw in one message."""
        flaws = []
        ids = [str(s.get("id", "")) for s in self.sources]
        flaws += ["no sources"] * (not ids) + ["repeated source ids"] * (len({i.lower() for i in ids}) < len(ids))
        flaws += [f"source id {i!r}" for i in ids if not i.strip() or any(c in i for c in "/\\:")]
        flaws += [f"adapter {s.get('adapter')!r}" for s in self.sources if s.get("adapter") not in ("layout", "manifest")]
        flaws += [f"source {s.get('id')} lacks csv" for s in self.sources if s.get("adapter") == "manifest" and not s.get("csv")]
        flaws += [f"{n} must be positive" for n in ("candidate_fps", "model_fps", "seq_len", "window_hop", "image_size", "max_sequences_per_video") if not getattr(self, n) > 0]
        flaws += ["model_fps is over candidate_fps"] * (self.model_fps > self.candidate_fps)
        flaws += ["ratios must be three, not negative, with the sum 1"] * (len(self.ratios) != 3 or min(self.ratios) < 0 or abs(sum(self.ratios) - 1) > 1e-9)
        flaws += [f"format {self.output_format!r}"] * (self.output_format.lower() not in FORMATS)
        flaws += [f"unsupported detector {self.detector!r}"] * (self.detector not in DETECTORS)
        flaws += ["jpeg_quality must be 1 to 100"] * (not 1 <= self.jpeg_quality <= 100)
        flaws += [f"strategy {self.strategy!r}"] * (self.strategy != "balanced_hash") + [f"group_by {self.group_by!r}"] * (self.group_by != "background_and_video_name")
        flaws += ["sequence_dir must be inside output_dir"] * (not self.inside())
        if flaws:
            raise ValueError("; ".join(flaws))
        return self

    def inside(self) -> bool:
        """sequence_dir is a folder strictly below output_dir, so clearing it can't clear anything else."""
        top = os.path.normpath(os.path.abspath(self.output_dir))
        own = os.path.normpath(os.path.join(top, self.sequence_dir))
        return own != top and own.startswith(top + os.sep)

    def fingerprint(self) -> str:
        """Names what the sequences mean: settings that change them, and none that don't (paths, sources)."""
        kept = asdict(self)
        for name in ("sources", "output_dir", "sequence_dir", "fail_on_video_error"):
            kept.pop(name)
        kept["output_format"] = {"jpeg": "jpg"}.get(self.output_format.lower(), self.output_format.lower())
        if kept["output_format"] != "jpg":
            kept.pop("jpeg_quality")
        return fingerprint(kept)

    def video_settings(self) -> VideoSettings:
        return VideoSettings(self.candidate_fps, self.model_fps, self.image_size, self.use_timestamp_sampling, self.face_margin, self.min_face_ratio, self.select_largest_face, self.quality)


def load(path: str) -> RunConfig:
    """A YAML file with the fields of RunConfig; relative paths start at the file."""
    import yaml

    with open(path) as f:
        raw = yaml.safe_load(f) or {}
    base = os.path.dirname(os.path.abspath(path))
    unknown = set(raw) - set(RunConfig.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    at = lambda p: p if os.path.isabs(p) else os.path.normpath(os.path.join(base, p))
    raw["sources"] = tuple({k: at(v) if k in ("root", "csv") else v for k, v in s.items()} for s in raw.get("sources", ()))
    raw["output_dir"] = at(raw.get("output_dir", "output"))
    for name, kind in (("limits", WindowLimits), ("quality", QualityLimits)):
        if name in raw:
            raw[name] = kind(**raw[name])
    if "ratios" in raw:
        raw["ratios"] = tuple(raw["ratios"])
    return RunConfig(**raw).check()
