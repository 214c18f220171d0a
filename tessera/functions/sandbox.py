"""Checks on Python text before anyone might run it; running it is not offered."""

from __future__ import annotations

import ast

#: Modules that a snippet may import.
ALLOWED = frozenset(("math", "numpy", "scipy", "statistics", "collections", "itertools", "datetime", "json", "csv", "re", "fractions", "decimal"))
FORBIDDEN_CALLS = frozenset(("eval", "exec", "open", "compile", "__import__", "input"))


def problem(code: str) -> str | None:
    """What forbids the code, or None."""
    try:
        tree = ast.parse(code)
    except SyntaxError as e:
        return f"syntax error: {e.msg}"
    for node in ast.walk(tree):
        names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
        for name in names:
            if name.split(".")[0] not in ALLOWED:
                return f"import not allowed: {name}"
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id in FORBIDDEN_CALLS:
            return f"call not allowed: {node.func.id}"
    return None
