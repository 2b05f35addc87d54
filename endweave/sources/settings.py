"""Project settings: plain KEY=value files checked against a schema, without any shell syntax."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields
from typing import get_type_hints


class SettingsError(ValueError):
    """What is wrong with a settings file, and on which line."""


@dataclass(frozen=True)
class Settings:
    """Parameters of the analyses. Field names in capitals are the keys of a settings file."""

    project_id: str
    condition_order: str = ""
    design: str = "auto"
    subject_column: str = "subject"
    window: int = 30
    rounds: int = 2
    threshold_cpm: float = 30.0
    mask_run: int = 6
    mask_window: int = 10
    mask_least: int = 7
    rescue_width: int = 20
    extension: int = 6000
    tss_buffer: int = 2000
    min_site_count: int = 5
    fdr: float = 0.05
    min_delta: float = 0.1
    crosswalk_tolerance: int = 24
    run_usage: bool = True
    run_enrichment: bool = True

    def __post_init__(self):
        checks = {
            "window": self.window == 30,
            "rounds": self.rounds == 2,
            "threshold_cpm": self.threshold_cpm > 0,
            "mask_least": 0 < self.mask_least <= self.mask_window,
            "extension": self.extension >= 0,
            "tss_buffer": self.tss_buffer >= 0,
            "fdr": 0 < self.fdr <= 1,
            "min_delta": 0 <= self.min_delta <= 1,
            "design": self.design in ("auto", "none", "required"),
            "project_id": bool(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", self.project_id)),
        }
        if bad := [name for name, fine in checks.items() if not fine]:
            raise SettingsError(f"value out of range: {', '.join(bad)}")


_LINE = re.compile(r"""\s*(?P<key>[A-Z][A-Z0-9_]*)\s*=\s*(?:"(?P<double>[^"]*)"|'(?P<single>[^']*)'|(?P<bare>[^\s"'#]*))\s*(?:\#.*)?""")
_SHELL = re.compile(r"[`;<>]|\$[({]|&&|\|\|")
_TRUTH = {"true": True, "false": False}


def parse_settings(text: str) -> Settings:
    """Rejects unknown and repeated keys, shell syntax, and values of another type than the field's."""
    kinds = get_type_hints(Settings)
    values: dict[str, object] = {}
    for number, line in enumerate(text.lstrip("﻿").splitlines(), start=1):
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if _SHELL.search(line):
            raise SettingsError(f"line {number}: shell syntax")
        found = _LINE.fullmatch(line)
        if not found:
            raise SettingsError(f"line {number}: not KEY=value")
        name = found["key"].lower()
        if name not in kinds:
            raise SettingsError(f"line {number}: unknown key {found['key']}")
        if name in values:
            raise SettingsError(f"line {number}: repeated key {found['key']}")
        raw = next((found[g] for g in ("double", "single", "bare") if found[g] is not None), "")
        try:
            values[name] = _TRUTH[raw.lower()] if kinds[name] is bool else kinds[name](raw)
        except (KeyError, ValueError) as error:
            raise SettingsError(f"line {number}: {found['key']} is no {kinds[name].__name__}") from error
    required = [f.name.upper() for f in fields(Settings) if f.name == "project_id" and f.name not in values]
    if required:
        raise SettingsError(f"missing: {', '.join(required)}")
    return Settings(**values)
