"""Argument checks shared by the operators (raise ValueError early, on the driver)."""

from __future__ import annotations

import re

_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def identifier(name: object, what: str) -> str:
    """``name`` if it is a plain SQL identifier, else ValueError."""
    if not isinstance(name, str) or not _IDENT.fullmatch(name):
        raise ValueError(f"{what} must be an identifier, got {name!r}")
    return name


def string(value: object, what: str) -> str:
    """``value`` if it is a str, else ValueError."""
    if not isinstance(value, str):
        raise ValueError(f"{what} must be a str, got {type(value).__name__}")
    return value


def factor(k: object) -> int | float:
    """``k`` if it is an int or float (not a bool), else ValueError."""
    if isinstance(k, bool) or not isinstance(k, (int, float)):
        raise ValueError(f"factor must be a number, got {k!r}")
    return k


def natural(n: object, what: str) -> int:
    """``n`` if it is a non-negative int (not a bool), else ValueError."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 0:
        raise ValueError(f"{what} must be a non-negative int, got {n!r}")
    return n
