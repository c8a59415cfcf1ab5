"""Settings of a run, with their defaults and checks."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, fields, replace

#: Keys of sections that would clash, keys that mean something else, settings that are paths, and modes.
RENAMED = {("resume", "enabled"): "resume_enabled", ("speaker_rules", "enabled"): "rules_enabled"}
ELSEWHERE = {("diarizer", "batch_size")}
PATHS = ("audio_dir", "out_dir", "manifest_path", "transcripts_dir", "meta_asr_dir", "meta_diar_dir")
MODES = ("full_asr_then_align", "diar_cut_then_asr")


@dataclass(frozen=True)
class Config:
    """Thresholds in seconds or shares; tokens and other secrets have no place here, so they never reach a journal."""

    mode: str = MODES[0]
    chunk_batch_size: int = 8
    max_sec: float = 22.0
    overlap_sec: float = 1.0
    segment_max_sec: float = 22.0
    rules_enabled: bool = True
    third_spk_max_share: float = 0.10
    equal_share_eps: float = 0.05
    max_speakers_allowed: int = 3
    max_snap_sec: float = 0.8
    island_max_words: int = 2
    island_max_sec: float = 1.0
    pause_new_turn_sec: float = 0.6
    resume_enabled: bool = True
    retry_failed: bool = False
    skip_if_outputs_exist: bool = True
    audio_dir: str = "."
    out_dir: str = "out"
    manifest_path: str | None = None
    glob: str = "*.mp3"
    transcripts_dir: str = "transcripts"
    meta_asr_dir: str = "meta_asr"
    meta_diar_dir: str = "meta_diar"
    num_instances: int = 1
    item_files: bool = False

    def json(self) -> str:
        """All settings, for a journal; there is no secret among them."""
        return json.dumps(asdict(self), ensure_ascii=False, sort_keys=True)

    @classmethod
    def of(cls, given: dict) -> Config:
        """From a dict, flat or in sections; unknown keys are ignored. batch_size of asr is an old name of chunk_batch_size."""
        flat = {k: v for k, v in given.items() if not isinstance(v, dict)}
        for section, own in given.items():
            if isinstance(own, dict):
                flat.update({RENAMED.get((section, k), k): v for k, v in own.items() if (section, k) not in ELSEWHERE})
        given = flat
        given = {"chunk_batch_size": given["batch_size"], **given} if "batch_size" in given else given
        out = cls(**{f.name: given[f.name] for f in fields(cls) if f.name in given})
        if out.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        for name in ("chunk_batch_size", "num_instances", "max_speakers_allowed"):
            if getattr(out, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if not 0 <= out.overlap_sec < min(out.max_sec, out.segment_max_sec):
            raise ValueError("overlap_sec must be at least 0 and below max_sec and segment_max_sec")
        return out

    @classmethod
    def load(cls, path: str) -> Config:
        """From a YAML or JSON file; its relative paths start at its folder."""
        with open(path, encoding="utf-8") as f:
            if path.endswith(".json"):
                given = json.load(f)
            else:
                import yaml  # only needed for YAML files

                given = yaml.safe_load(f)
        out, folder = cls.of(given or {}), os.path.dirname(os.path.abspath(path))
        places = {k: os.path.join(folder, os.path.expanduser(v)) for k in PATHS if (v := getattr(out, k)) and v.strip()}
        return replace(out, **places)
