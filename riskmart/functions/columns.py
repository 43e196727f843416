"""Column names of raw files."""

from __future__ import annotations

from collections.abc import Iterable

from riskmart.schema import RENAME_MAP


def staged_names(header: Iterable[str]) -> dict[str, str]:
    """Raw header name -> staged name, for one header: renamed where listed, else snake case."""
    plain = {raw: raw.lower().translate({ord("-"): "_"}) for raw in header}
    return plain | {raw: name for raw, name in RENAME_MAP.items() if raw in plain}
