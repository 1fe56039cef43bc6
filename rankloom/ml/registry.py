"""Named scorer and learner factories."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from rankloom.ml import learners

_FACTORIES: dict[str, Callable] = {
    "linear": learners.fit_linear,
    "fm": learners.fit_fm,
    "mlp": learners.fit_mlp,
}


def names() -> list[str]:
    return sorted(_FACTORIES)


def register(name: str, factory: Callable) -> Callable:
    """Add a factory; a name that is taken raises."""
    if name in _FACTORIES:
        raise ValueError(f"model name {name!r} is taken")
    _FACTORIES[name] = factory
    return factory


def load_file(path: str) -> list[str]:
    """Register every entry of ``MODELS`` (name -> factory) of a Python file."""
    spec = importlib.util.spec_from_file_location("rankloom_external_models", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    for name, factory in module.MODELS.items():
        register(name, factory)
    return sorted(module.MODELS)


def build(name: str, external: str | None = None) -> Callable:
    if name not in _FACTORIES and external:
        load_file(external)
    if name not in _FACTORIES:
        raise KeyError(f"unknown model {name!r}; known: {names()}")
    return _FACTORIES[name]
