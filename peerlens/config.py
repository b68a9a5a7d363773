"""Settings: defaults, reading from YAML, and rewriting single values in place."""

from __future__ import annotations

import dataclasses
import re
from dataclasses import dataclass, field
from pathlib import Path


# The defaults of all settings.


@dataclass(frozen=True)
class Dedup:
    near_dup_hamming: int = 8


@dataclass(frozen=True)
class Consensus:
    method: str = "median"
    trim_fraction: float = 0.2
    min_peers_for_median: int = 3


@dataclass(frozen=True)
class Gate:
    z_thresh: float = 2.5
    mad_floor: float = 0.01
    p_thresh: float = 0.3
    prior_outlier_rate: float = 0.05
    min_subgroup_size: int = 3
    p_abs: float = 0.5
    folder_review_floor: float = 0.45


@dataclass(frozen=True)
class Policy:
    duplicate_suspicion: float = 0.3
    unreadable_suspicion: float = 0.5
    cross_outlet_duplicate_suspicion: float = 0.9


@dataclass(frozen=True)
class Geometry:
    enabled: bool = True
    max_side: int = 640
    n_features: int = 2000
    ratio: float = 0.75
    ransac_thresh: float = 5.0
    peers: int = 3
    typical_peers: int = 2
    calib_pairs: int = 300


@dataclass(frozen=True)
class Tags:
    template: str = "a photo of {}"
    min_conf: float = 0.5
    scene_prompts: dict = field(default_factory=dict)
    brand_prompts: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Words:
    enabled: bool = True
    langs: tuple[str, ...] = ("bn", "en")
    peers: int = 5
    min_conf: float = 0.3


@dataclass(frozen=True)
class Harness:
    seeds: tuple[int, ...] = (0, 1, 2)
    inject_fraction: float = 0.5
    injections_per_folder: int = 1
    modes: tuple[str, ...] = ("easy", "hard")
    select_mode: str = "easy"
    z_grid: tuple[float, ...] = (2.5, 3.0, 3.5)
    beta: float = 0.5


@dataclass(frozen=True)
class Output:
    json: str = "results.json"
    csv: str = "results.csv"
    html: str = "report.html"


@dataclass(frozen=True)
class Config:
    seed: int = 0
    cache_dir: str = "cache"
    embedder: str = "dinov2"
    models: dict = field(default_factory=dict)
    image_size: tuple[int, ...] = (294, 224)
    batch_size: int = 16
    dedup: Dedup = field(default_factory=Dedup)
    consensus: Consensus = field(default_factory=Consensus)
    gate: Gate = field(default_factory=Gate)
    policy: Policy = field(default_factory=Policy)
    geometry: Geometry = field(default_factory=Geometry)
    tags: Tags = field(default_factory=Tags)
    ocr: Words = field(default_factory=Words)
    harness: Harness = field(default_factory=Harness)
    output: Output = field(default_factory=Output)

    @staticmethod
    def load(path: str) -> Config:
        """Settings of a YAML file over the defaults; unknown keys are an error."""
        import yaml

        return _merged(Config(), yaml.safe_load(Path(path).read_text()) or {})


def _merged(base, values: dict):
    known = {f.name for f in dataclasses.fields(base)}
    if unknown := set(values) - known:
        raise KeyError(f"unknown settings: {', '.join(sorted(unknown))}")
    new = {}
    for key, value in values.items():
        old = getattr(base, key)
        if dataclasses.is_dataclass(old):
            value = _merged(old, value)
        elif isinstance(old, tuple):
            value = tuple(value)
        new[key] = value
    return dataclasses.replace(base, **new)


def set_values(path: str, values: dict[str, object]) -> None:
    """Rewrite the first ``key:`` line of each key, with its indent and trailing comment kept; KeyError if absent."""
    lines = Path(path).read_text().split("\n")
    for key, value in values.items():
        form = re.compile(rf"(\s*{re.escape(key)}:[ \t]*)([^#]*?)([ \t]*(?:#.*)?)$")
        for i, line in enumerate(lines):
            if m := form.match(line):
                lines[i] = f"{m[1]}{value}{m[3]}"
                break
        else:
            raise KeyError(key)
    Path(path).write_text("\n".join(lines))
