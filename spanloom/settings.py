"""Settings of workers, with a lens's own batch size and poll time over the common ones."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

LENSES = ("performance", "cost", "safety", "quality", "reconciler")
_CAST = {"int": int, "float": float, "str": str, "bool": lambda text: str(text).strip().lower() in ("1", "true", "yes", "on")}


@dataclass(frozen=True)
class Settings:
    """Names in the environment are PREFIX and the field's in capitals, with the lens's behind those that a lens may have of its own."""

    batch: int = 5000
    poll_sec: float = 2.0
    toggle_ttl: float = 300.0
    partition_index: int = 0
    partition_count: int = 1
    partition_slots: int = 16
    injection_threshold: float = 0.50
    harmful_threshold: float = 0.83
    max_tokens: int = 512
    model_batch: int = 32
    models_root: str = "./models"
    semantic: bool = True
    semantic_sample: float = 1.0
    premise_chars: int = 2000
    sentences: int = 10
    sentence_chars: int = 3
    chunk_used: float = 0.5
    batch_by_lens: Mapping[str, int] = field(default_factory=dict)
    poll_by_lens: Mapping[str, float] = field(default_factory=dict)

    @classmethod
    def of(cls, given: Mapping[str, str] | None = None, prefix: str = "SPANLOOM_") -> Settings:
        """From a mapping of names to texts, the environment if there is none; other names are ignored, blank values count as missing."""
        known = {key.upper(): value for key, value in (os.environ if given is None else given).items() if str(value).strip()}
        found = {one.name: _CAST[one.type](known[prefix + one.name.upper()]) for one in fields(cls) if one.type in _CAST and prefix + one.name.upper() in known}
        own = lambda name, cast: {lens: cast(known[key]) for lens in LENSES if (key := f"{prefix}{name}_{lens.upper()}") in known}
        return cls(**found, batch_by_lens=own("BATCH", int), poll_by_lens=own("POLL_SEC", float))

    def batch_for(self, lens: str) -> int:
        return self.batch_by_lens.get(lens, self.batch)

    def poll_for(self, lens: str) -> float:
        return self.poll_by_lens.get(lens, self.poll_sec)

    def trigger_for(self, lens: str) -> str:
        """poll_for as the time of a stream's trigger (streaming.runner.start's every)."""
        return f"{int(self.poll_for(lens) * 1000)} milliseconds"

    def model_path(self, name: str) -> str:
        """A model's folder: as given if absolute, or below models_root."""
        return name if os.path.isabs(name) else os.path.join(self.models_root, name)
