"""Phase 1: does the table have the expected columns?"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tablecheck.functions.columns import quoted


@dataclass(frozen=True)
class StructureResult:
    """``df`` carries the expected names in the expected order, if ``ok``."""

    ok: bool
    message: str | None = None
    df: DataFrame | None = None


def check_structure(
    df: DataFrame,
    expected: Sequence[str],
    has_header: bool,
    row_count: int | None = None,
) -> StructureResult:
    """Check emptiness, number and names of columns, then name them as expected.

    With a header, columns are matched by name ignoring case, in any order; without one, by position.
    Only schema data is used, apart from the emptiness test where ``row_count`` is not known.
    """
    if (df.isEmpty() if row_count is None else row_count == 0):
        return StructureResult(False, "the table is empty (0 rows)")

    found = df.columns
    if len(found) != len(expected):
        return StructureResult(
            False, f"wrong number of columns: expected {len(expected)}, found {len(found)}"
        )

    problem = _repeated("expected", expected)
    if has_header:
        problem = problem or _name_problem(found, expected)
    if problem:
        return StructureResult(False, problem)

    if not has_header:
        return StructureResult(True, df=df.toDF(*expected))
    by_name = {name.lower(): name for name in found}
    aligned = df.select(*[quoted(by_name[name.lower()]).alias(name) for name in expected])
    return StructureResult(True, df=aligned)


def _name_problem(found: Sequence[str], expected: Sequence[str]) -> str | None:
    have = {name.lower() for name in found}
    want = {name.lower() for name in expected}
    parts = [
        f"{label}: {', '.join(sorted(names))}"
        for label, names in (("missing", want - have), ("extra", have - want))
        if names
    ]
    return ". ".join(parts) or _repeated("found", found)


def _repeated(side: str, names: Sequence[str]) -> str | None:
    twice = sorted(name for name, n in Counter(map(str.lower, names)).items() if n > 1)
    return f"{side} names occur more than once: {', '.join(twice)}" if twice else None
