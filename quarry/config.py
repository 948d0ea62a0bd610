"""Explicit run parameters shared by every model.

Models are pure functions of their input DataFrames plus a ``RunContext``;
nothing reads the wall clock inside a model unless the context says so.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Namespaces:
    """Database names per layer. A custom name is used verbatim (trimmed)."""

    raw: str = "raw"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    @staticmethod
    def route(custom: str | None, default: str) -> str:
        """Custom schema name if given (trimmed), else the default one."""
        return default.strip() if custom is None else custom.strip()

    @classmethod
    def routed(cls, default: str | None = None, **custom: str | None) -> "Namespaces":
        """Layer databases from optional custom names.

        A layer with a custom name uses it verbatim (trimmed); a layer
        without one uses ``default`` when given, else its own name."""
        base = cls()
        names = {}
        for layer in ("raw", "bronze", "silver", "gold"):
            fallback = default if default is not None else getattr(base, layer)
            names[layer] = cls.route(custom.get(layer), fallback)
        return cls(**names)


@dataclass(frozen=True)
class Thresholds:
    """Magnitude cut-offs; defaults as the marts define them."""

    weekly_significant: float = 3.0
    ranking_significant: float = 4.0


@dataclass(frozen=True)
class RunContext:
    """One id and one build timestamp per run.

    ``loaded_at`` of ``None`` means the query's ``current_timestamp()``
    (fixed per query by Spark); tests and oracle checks pass a literal.
    """

    run_id: str | None = field(default_factory=lambda: str(uuid.uuid4()))
    loaded_at: dt.datetime | None = None
    thresholds: Thresholds = field(default_factory=Thresholds)


# Fixed values used by queries() / oracle_sql() so both sides agree.
FIXED_RUN_ID = "run-00000000"
FIXED_LOADED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
FIXED_CONTEXT = RunContext(run_id=FIXED_RUN_ID, loaded_at=FIXED_LOADED_AT)
