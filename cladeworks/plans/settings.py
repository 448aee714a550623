"""Run parameters: typed defaults, presets as overlays, and checks."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Settings:
    mode: str = "standard"
    mash_threshold: float = 0.03
    max_cluster_size: int = 100
    merge_singletons: bool = False
    sketch_size: int = 10_000
    kmer: int = 21
    min_copies: int = 1
    min_file_size: str = "45k"
    recombination: str = "none"
    graft: bool = True
    graft_mode: str = "keep"
    seed: int = 42
    use_global_reference: bool = False
    target_total: int = 0
    min_per_country: int = 1
    max_per_country: int = 1 << 30
    drop_unmatched: bool = True


MODES, RECOMBINATION, GRAFTS = ("standard", "scalable", "recombination_aware"), ("none", "gubbins", "clonalframeml", "both"), ("keep", "zero")
PRESETS = {"bp": {"mash_threshold": 0.028, "max_cluster_size": 50, "merge_singletons": True, "sketch_size": 50_000}}


def settings(preset: str | None = None, **given) -> Settings:
    """Defaults, then a preset, then what is given; a false or zero value counts as given."""
    known = {f.name: f.type for f in fields(Settings)}
    if unknown := set(given) - set(known):
        raise ValueError(f"unknown parameters: {', '.join(sorted(unknown))}")
    for name, value in given.items():
        kinds = {"int": (int,), "float": (int, float), "bool": (bool,), "str": (str,)}[known[name]]
        if not isinstance(value, kinds) or isinstance(value, bool) and known[name] != "bool":
            raise ValueError(f"{name} is of type {known[name]}, {value!r} is not")
    if preset and preset not in PRESETS:
        raise ValueError(f"presets are {', '.join(PRESETS)}")
    out = replace(Settings(), **(PRESETS[preset] if preset else {}) | given)
    for name, allowed in (("mode", MODES), ("recombination", RECOMBINATION), ("graft_mode", GRAFTS)):
        if getattr(out, name) not in allowed:
            raise ValueError(f"{name} is one of {', '.join(allowed)}")
    if out.mash_threshold < 0 or min(out.max_cluster_size, out.sketch_size, out.kmer, out.min_copies) < 1:
        raise ValueError("thresholds are not negative, sizes at least 1")
    return out


def from_file(path: str, preset: str | None = None, **given) -> Settings:
    """Settings of a JSON file (a parameter for each name), which what is given overrides."""
    with open(path, encoding="utf-8") as f:
        return settings(preset, **json.load(f) | given)


def from_arguments(arguments: list[str]) -> Settings:
    """Settings of a command line: --name value or --name=value, --preset, and --flag alone for true."""
    kinds = {f.name: f.type for f in fields(Settings)} | {"preset": "str"}
    given, left = {}, list(arguments)
    while left:
        name, has_value, value = left.pop(0).partition("=")
        name = name.removeprefix("--").replace("-", "_")
        if name not in kinds:
            raise ValueError(f"unknown parameters: {name}")
        if not has_value:
            value = left.pop(0) if left and not left[0].startswith("--") else "true"
        if kinds[name] == "bool":
            if value not in ("true", "false"):
                raise ValueError(f"{name} is true or false")
            given[name] = value == "true"
        else:
            try:
                given[name] = {"int": int, "float": float, "str": str}[kinds[name]](value)
            except ValueError:
                raise ValueError(f"{name} is of type {kinds[name]}, {value!r} is not") from None
    return settings(given.pop("preset", None), **given)


def help_text() -> str:
    return "\n".join(f"--{f.name} [{f.type}] (default: {f.default!r})" for f in fields(Settings))


def changed(s: Settings) -> dict:
    """The parameters that differ from their defaults."""
    return {f.name: getattr(s, f.name) for f in fields(Settings) if getattr(s, f.name) != f.default}
