"""Settings with environment overrides, an optional KEY=VALUE file, and path helpers."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path


def load_env_file(path: str | os.PathLike, environ: dict | None = None) -> dict:
    """Adds KEY=VALUE lines of a file to the environment; what is set already wins."""
    environ = os.environ if environ is None else environ
    file = Path(path)
    if file.is_file():
        for line in file.read_text(encoding="utf-8").splitlines():
            name, equals, value = line.strip().partition("=")
            if equals and name and not name.startswith("#"):
                environ.setdefault(name.strip(), value.strip().strip("\"'"))
    return environ


def env_int(name: str, default: int, environ: dict | None = None) -> int:
    """An integer setting; one that can't be read counts as unset."""
    try:
        return int((os.environ if environ is None else environ).get(name, "").strip() or default)
    except ValueError:
        return default


def resolve(raw: str, root: str | os.PathLike = ".") -> Path:
    """An absolute path as it is; a relative one below the working directory if it is there, else below ``root``."""
    path = Path(raw).expanduser()
    if path.is_absolute():
        return path
    here = Path.cwd() / path
    return here if here.exists() else Path(root).resolve() / path


@dataclass(frozen=True)
class Settings:
    years: tuple[int, ...] = (2021, 2022, 2023, 2024, 2025)
    rows_per_part: int = 1_000_000
    attach_country: bool = True
    max_abstract_chars: int | None = None
    fallback_to_title: bool = False
    dim: int = 1024
    candidates: int = 50
    limit: int = 10
    keyword_limit: int = 5
    ef: int = 64
    rescore: bool = False
    oversampling: float = 2.0
    #: A side of a join is broadcast up to so many rows; a larger one is shuffled.
    broadcast_rows: int = 2_000_000
    text_field: str = "abstract"

    @classmethod
    def from_env(cls, environ: dict | None = None) -> Settings:
        """Defaults overridden by variables of the fields' names in capitals."""
        environ = os.environ if environ is None else environ
        read = {}
        for f in fields(cls):
            raw = environ.get(f.name.upper())
            if raw is None:
                continue
            if f.name == "years":
                read[f.name] = tuple(int(y) for y in raw.split(","))
            elif isinstance(f.default, bool):
                read[f.name] = raw not in ("0", "false", "False")
            elif isinstance(f.default, int) or f.default is None:
                read[f.name] = env_int(f.name.upper(), f.default, environ)
            else:
                read[f.name] = type(f.default)(raw)
        return cls(**read)


@dataclass(frozen=True)
class Workspace:
    """Paths that follow from a root; plain strings, so that any store's URI works."""

    root: str
    paths: dict[str, str] = field(init=False, default_factory=dict)

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def records(self) -> str:
        return self.at("records")

    @property
    def collection(self) -> str:
        return self.at("collection")

    @property
    def checkpoints(self) -> str:
        return self.at("checkpoints")

    @property
    def logs(self) -> str:
        return self.at("logs")


def part_label(year: int, part: int) -> str:
    return f"{year}/part_{part:04d}.jsonl"


def human_bytes(n: float) -> str:
    """A size with a binary unit."""
    for unit in ("B", "KiB", "MiB", "GiB"):
        if abs(n) < 1024:
            return f"{n:.1f} {unit}" if unit != "B" else f"{int(n)} B"
        n /= 1024
    return f"{n:.1f} TiB"
