"""Thresholds and limits of the matcher, from defaults or JSON."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class MatchConfig:
    certain_score: float = 92.0
    certain_gap: float = 8.0
    probable_score: float = 72.0
    probable_gap: float = 3.0
    max_candidates_per_block: int = 250
    max_total_candidates: int = 700
    fts_candidates: int = 300
    top_k: int = 5
    min_name_score_probable: float = 62.0
    min_name_score_certain: float = 86.0
    automatic_requires_strong_evidence: bool = True

    def __post_init__(self) -> None:
        if not 0 <= self.probable_score <= self.certain_score <= 100:
            raise ValueError("scores must satisfy 0 <= probable <= certain <= 100")
        if self.certain_gap < 0 or self.probable_gap < 0:
            raise ValueError("gaps must not be negative")
        if min(self.max_candidates_per_block, self.max_total_candidates, self.fts_candidates, self.top_k) < 1:
            raise ValueError("limits must be at least 1")

    @classmethod
    def from_json(cls, path: str | None) -> MatchConfig:
        if not path:
            return cls()
        values = json.loads(Path(path).read_text(encoding="utf-8"))
        unknown = sorted(set(values) - {f.name for f in fields(cls)})
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**values)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=2)
