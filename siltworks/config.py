"""Pipeline configuration: strict YAML onto dataclasses."""

from __future__ import annotations

import dataclasses
import functools
import types
import typing
from dataclasses import dataclass, field
from typing import Any

import yaml

from .functions.text import MASKERS
from .sources.readers import Mapping, Source


class ConfigError(ValueError):
    """A missing or invalid configuration."""


#: Names of the sections below are the file format (fixed values).


@dataclass(frozen=True)
class Model:
    adapter: str
    tokenizer: str | None = None  # a tokenizer file, for adapters that read one
    revision: str | None = None  # its SHA-256, if it is to be pinned


@dataclass(frozen=True)
class Ingest:
    sources: list[Source]


@dataclass(frozen=True)
class Clean:
    min_chars: int = 20
    max_chars: int = 32_000
    pii: list[str] = field(default_factory=lambda: ["email", "phone"])


@dataclass(frozen=True)
class Judge:
    model: str = ""
    threshold: float = 0.7
    max_concurrency: int = 4
    max_retries: int = 3


@dataclass(frozen=True)
class Tokenize:
    max_seq_len: int | None = None
    eval_fraction: float = 0.1


@dataclass(frozen=True)
class Train:
    method: str = "qlora"
    hyperparameters: dict[str, Any] = field(default_factory=dict)
    mlflow_experiment: str = "siltworks"


@dataclass(frozen=True)
class Smoke:
    num_prompts: int = 8
    max_new_tokens: int = 256


@dataclass(frozen=True)
class Pipeline:
    model: Model
    ingest: Ingest
    clean: Clean = field(default_factory=Clean)
    judge: Judge = field(default_factory=Judge)
    tokenize: Tokenize = field(default_factory=Tokenize)
    train: Train = field(default_factory=Train)
    smoke: Smoke = field(default_factory=Smoke)


_hints = functools.cache(typing.get_type_hints)


def _build(kind: Any, value: Any, at: str) -> Any:
    """``value`` as ``kind``; unknown keys and wrong types are errors."""
    if dataclasses.is_dataclass(kind):
        if not isinstance(value, dict):
            raise ConfigError(f"{at or 'config'}: expected a mapping")
        hints = _hints(kind)
        if unknown := sorted(set(value) - set(hints)):
            raise ConfigError(f"{at or 'config'}: unknown keys {unknown}")
        made = {k: _build(hints[k], v, f"{at}.{k}".lstrip(".")) for k, v in value.items()}
        try:
            return kind(**made)
        except TypeError as e:
            raise ConfigError(f"{at or 'config'}: {e}") from e
    origin, args = typing.get_origin(kind), typing.get_args(kind)
    if origin is types.UnionType:
        return None if value is None and type(None) in args else _build(next(a for a in args if a is not type(None)), value, at)
    if origin is list:
        if not isinstance(value, list):
            raise ConfigError(f"{at}: expected a list")
        return [_build(args[0], v, f"{at}[{i}]") for i, v in enumerate(value)]
    if origin is dict or kind is dict:
        if not isinstance(value, dict):
            raise ConfigError(f"{at}: expected a mapping")
        return dict(value)
    if kind is float and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    if not isinstance(value, kind) or kind is not bool and isinstance(value, bool):
        raise ConfigError(f"{at}: expected {kind.__name__}, got {value!r}")
    return value


def parse(raw: dict[str, Any]) -> Pipeline:
    config = _build(Pipeline, raw, "")
    checks = {
        "clean.min_chars": config.clean.min_chars >= 0, "clean.max_chars": config.clean.max_chars >= 0, "clean.pii": set(config.clean.pii) <= set(MASKERS),
        "judge.threshold": 0 <= config.judge.threshold <= 1, "judge.max_concurrency": config.judge.max_concurrency > 0, "judge.max_retries": config.judge.max_retries >= 0,
        "tokenize.eval_fraction": 0 <= config.tokenize.eval_fraction <= 1, "train.method": config.train.method in ("qlora", "full"),
        "smoke.num_prompts": config.smoke.num_prompts > 0, "smoke.max_new_tokens": config.smoke.max_new_tokens > 0,
    }
    if bad := [k for k, ok in checks.items() if not ok]:
        raise ConfigError(f"invalid values: {bad}")
    return config


def load(path: str) -> Pipeline:
    try:
        with open(path, encoding="utf-8") as f:
            raw = yaml.safe_load(f) or {}
    except (OSError, yaml.YAMLError) as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    return parse(raw)


def merge_hyperparameters(defaults: dict[str, Any], overrides: dict[str, Any]) -> dict[str, Any]:
    if unknown := sorted(set(overrides) - set(defaults)):
        raise ConfigError(f"unknown hyperparameters {unknown}")
    return defaults | overrides


__all__ = ["ConfigError", "Mapping", "Pipeline", "load", "merge_hyperparameters", "parse"]
