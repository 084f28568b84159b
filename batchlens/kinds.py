"""Feature kinds: every column is either numeric or categorical, and the kind drives its metrics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

NUMERIC = "numeric"
CATEGORICAL = "categorical"

# The kinds of the 16 columns of the vehicle-insurance policy table.
INSURANCE_KINDS: dict[str, str] = {
    "SEX": CATEGORICAL,
    "INSR_BEGIN": CATEGORICAL,
    "INSR_END": CATEGORICAL,
    "EFFECTIVE_YR": CATEGORICAL,
    "INSR_TYPE": CATEGORICAL,
    "INSURED_VALUE": NUMERIC,
    "PREMIUM": NUMERIC,
    "OBJECT_ID": NUMERIC,
    "PROD_YEAR": NUMERIC,
    "SEATS_NUM": NUMERIC,
    "CARRYING_CAPACITY": NUMERIC,
    "TYPE_VEHICLE": CATEGORICAL,
    "CCM_TON": NUMERIC,
    "MAKE": CATEGORICAL,
    "USAGE": CATEGORICAL,
    "CLAIM_PAID": NUMERIC,
}


def kind_of(column: str, kinds: Mapping[str, str]) -> str:
    """The declared kind of a column; ValueError when it has none or an unknown one."""
    kind = kinds.get(column)
    if kind not in (NUMERIC, CATEGORICAL):
        raise ValueError(f"no feature kind declared for column {column!r}")
    return kind


def resolve(columns: Iterable[str], kinds: Mapping[str, str], unknown: str = "error") -> dict[str, str]:
    """Kinds in column order. A column without a kind is an error, is skipped, or counts as numeric."""
    if unknown not in ("error", "skip", NUMERIC):
        raise ValueError(f"unknown must be 'error', 'skip' or 'numeric', not {unknown!r}")
    out = {}
    for column in columns:
        if column in kinds or unknown == "error":
            out[column] = kind_of(column, kinds)
        elif unknown == NUMERIC:
            out[column] = NUMERIC
    return out


def of_kind(kinds: Mapping[str, str], kind: str) -> list[str]:
    """The columns of one kind, in order."""
    return [column for column, k in kinds.items() if k == kind]
