"""Configuration and variable dictionaries from YAML."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from pathlib import Path
from typing import Any

# Built-in defaults under any configuration file.
DEFAULTS: dict[str, Any] = {"pipeline": {"write_mode": "replace", "top_reasons": 3}, "tables": {"results": "anomaly_results", "details": "anomaly_reason_details"}, "logging": {"level": "INFO"}}
CONFIG_VARIABLE, CONFIG_NAME = "COHORTLOOM_CONFIG", "config/pipeline_config.yaml"


def deep_merge(base: Mapping[str, Any], over: Mapping[str, Any]) -> dict[str, Any]:
    """``over`` on ``base``; mappings are merged, anything else replaced."""
    out = dict(base)
    for key, value in over.items():
        out[key] = deep_merge(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else value
    return out


def load_mapping(path: str | Path) -> dict[str, Any]:
    import yaml

    found = yaml.safe_load(Path(path).read_text("utf-8-sig")) or {}
    if not isinstance(found, dict):
        raise ValueError(f"{path} is no mapping")
    return found


def config_path(explicit: str | None = None, folders: list[Path] | None = None) -> Path | None:
    """The explicit file (which must exist), else that of the environment, else the first in the folders and their parents."""
    if explicit:
        if not Path(explicit).is_file():
            raise ValueError(f"no configuration at {explicit}")
        return Path(explicit)
    named = os.environ.get(CONFIG_VARIABLE)
    if named and Path(named).is_file() and "pipeline" in load_mapping(named):
        return Path(named)
    for folder in folders or [Path.cwd()]:
        for place in (folder, *folder.parents):
            if (path := place / CONFIG_NAME).is_file():
                return path
    return None


def load_config(explicit: str | None = None) -> dict[str, Any]:
    path = config_path(explicit)
    return deep_merge(DEFAULTS, load_mapping(path)) if path else deep_merge(DEFAULTS, {})


def first_non_empty(*values: Any) -> Any:
    return next((v for v in values if v is not None and str(v).strip() != ""), None)


def optional_limit(text: str | None) -> int | None:
    """A number of rows; None for all of the ways to say no limit."""
    bare = (text or "").strip().lower()
    return None if bare in ("", "all", "-", "none", "null", "0") else int(bare)


def non_negative(value: Any, default: int = 0) -> int:
    try:
        return max(0, int(str(value).strip()))
    except ValueError:
        return default


@dataclass(frozen=True)
class Dictionary:
    """Variables by name: labels, formulas and their inputs, directions, and which features are used."""

    raw: dict[str, dict[str, Any]] = field(default_factory=dict)
    generated: dict[str, dict[str, Any]] = field(default_factory=dict)
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    direct: tuple[str, ...] = ()

    def about(self, name: str) -> dict[str, Any]:
        return self.generated.get(name.lower()) or self.raw.get(name.lower()) or {}

    def formulas(self) -> dict[str, str]:
        """Formulas of the features in use, in their order."""
        return {n: str(m["formula"]) for n, m in self.generated.items() if m.get("formula") and n not in self.exclude}

    def inputs(self) -> list[str]:
        return list(dict.fromkeys(str(x).lower() for m in self.generated.values() for x in m.get("inputs", [])))

    def labels(self) -> dict[str, str]:
        return {n: str(m["label"]) for n, m in (self.raw | self.generated).items() if m.get("label")}

    def directions(self) -> dict[str, str]:
        return {n: str(m["risk_direction"]).strip().upper() for n, m in (self.raw | self.generated).items() if m.get("risk_direction")}

    def category(self, name: str) -> str | None:
        """The configured category; by the name's parts there is one in ``functions.text.variable_category``."""
        return self.about(name).get("category")

    def source_columns(self, name: str, formula: str | None, known: set[str]) -> list[str]:
        """The inputs that are configured, else the formula's names among the known columns and the dictionary's."""
        if inputs := self.about(name).get("inputs"):
            return [str(x) for x in inputs]
        names = known | set(self.raw) | set(self.generated)
        return [x for x in dict.fromkeys(re.findall(r"[a-z_]\w*", str(formula or "").lower())) if x in names]


@lru_cache(maxsize=8)
def load_dictionary(path: str) -> Dictionary:
    """A dictionary file: raw groups with defaults for their variables, generated features, and the final policy. A missing file is an empty dictionary."""
    if not Path(path).is_file():
        return Dictionary()
    source = load_mapping(path)
    raw: dict[str, dict[str, Any]] = {}
    section = source.get("raw_variables") or {}
    default_source = section.get("default_source") or {}
    for group, body in (section.get("groups") or {}).items():
        shared = {"group": group, "category": body.get("category"), "source": deep_merge(default_source, body.get("source") or {})}
        for name, about in (body.get("variables") or {}).items():
            raw[str(name).strip().lower()] = deep_merge(shared, about or {})
    generated = {str(n).strip().lower(): dict(m or {}) for n, m in ((source.get("generated_variables") or {}).get("variables") or {}).items()}
    policy = source.get("final_llm_features") or {}
    include, exclude = (tuple(str(x).strip().lower() for x in policy.get(k) or []) for k in ("include", "exclude"))
    return Dictionary(raw, generated, include, exclude, tuple(n for n in include if n not in generated))
