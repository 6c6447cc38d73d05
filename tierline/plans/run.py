"""Run the stages of a flow one after the other."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import Any


def run(stages: Iterable[Callable[[], Any]]) -> list[Any]:
    """Result of each stage, in order; a stage that raises ends the run."""
    return [stage() for stage in stages]
