"""Additive designs: variables, model matrices, rank, and how a contrast is to be paired."""

from __future__ import annotations

import re

import numpy as np


def variables(formula: str) -> list[str]:
    """The terms of ``~ a + b``; interactions and functions are refused."""
    body = formula.strip()
    if not body.startswith("~"):
        raise ValueError("a design begins with ~")
    terms = [t.strip() for t in body[1:].split("+")]
    if bad := [t for t in terms if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_.]*", t)]:
        raise ValueError(f"not an additive term: {bad[0]}")
    if len(set(terms)) < len(terms):
        raise ValueError("a term occurs twice")
    return terms


def model_matrix(samples: list[dict], terms: list[str]) -> np.ndarray:
    """Treatment coding: an intercept, and a column for each level but the first of each term."""
    columns = [np.ones(len(samples))]
    for term in terms:
        levels = sorted({str(s[term]) for s in samples})
        columns += [np.array([float(str(s[term]) == level) for s in samples]) for level in levels[1:]]
    return np.stack(columns, axis=1)


def full_rank(samples: list[dict], formula: str, tolerance: float = 1e-10) -> bool:
    matrix = model_matrix(samples, variables(formula))
    return int(np.linalg.matrix_rank(matrix, tol=tolerance)) == matrix.shape[1]


def resolved(mode: str, pairing: str, pairs: int, subject: str = "subject") -> tuple[str, bool]:
    """(design, paired) of a contrast. ``auto`` pairs what is complete; ``required`` refuses the rest."""
    if mode == "required" and pairing != "complete":
        raise ValueError(f"pairing is required but {pairing}")
    paired = mode != "none" and pairing == "complete" and pairs >= 2
    return (f"~ {subject} + condition" if paired else "~ condition"), paired
