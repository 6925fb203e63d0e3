"""Settings as nested dictionaries with lookup by path, and the defaults of the retrieval plan."""

from __future__ import annotations

from typing import Any

DEFAULTS: dict[str, Any] = {
    "chunking": {"child_size": 128, "parent_size": 256, "min_text_chars": 100},
    "retrieval": {"dense_top_k": 600, "rrf_k": 30, "alpha": 0.03, "mmr_lambda": 0.8, "mmr_top_k": 20, "final_top_k": 3},
    "bm25": {"k1": 1.5, "b": 0.75},
}


class Config:
    def __init__(self, values: dict[str, Any] | None = None):
        self.values = values if values is not None else DEFAULTS

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls(yaml.safe_load(f) or {})

    def get(self, *keys: str, default: Any = None) -> Any:
        at: Any = self.values
        for key in keys:
            if not isinstance(at, dict) or key not in at:
                return default
            at = at[key]
        return at
