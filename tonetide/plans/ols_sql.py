"""Least squares as DuckDB SQL for the oracles, by sequential orthogonalisation of the rows.

Independent of :mod:`tonetide.plans.ols`: features are residualised row by row on the features before
them with slopes from the training rows, and the label is predicted from the residuals. A feature
whose residuals vanish on the training rows has the slope 0.
"""

from __future__ import annotations


def ols_ctes(source: str, features: list[str], label: str, train: str, by: list[str], centre: list[str] | None = None,
             prefix: str = "ls") -> tuple[str, str]:
    """(CTEs, name of the last one): ``source`` with a column ``prediction``.

    ``by``: the groups that have a model each. ``centre``: groups with an intercept each (default: ``by``).
    """
    centre = by if centre is None else centre
    over = lambda cols: f"OVER (PARTITION BY {', '.join(cols)})" if cols else "OVER ()"
    names = [f"x{i}" for i in range(len(features))] + ["y"]
    mean = lambda c: f"avg(CASE WHEN {train} AND \"{label}\" IS NOT NULL THEN {c} END) {over(centre)}"
    cols = ", ".join(f'"{c}" - {mean(chr(34) + c + chr(34))} AS {n}' for c, n in zip([*features, label], names))
    ctes = [f"{prefix}c AS (SELECT *, {train} AS __t, {mean(chr(34) + label + chr(34))} AS __my, {cols} FROM {source})"]
    last = f"{prefix}c"
    for i in range(len(features)):
        rest = names[i + 1:]
        dot = lambda a, b: f"sum(CASE WHEN __t AND y IS NOT NULL THEN {a} * {b} END) {over(by)}"
        x = f"x{i}"
        first = f"sum(CASE WHEN __t AND y IS NOT NULL THEN raw{i} * raw{i} END) {over(by)}"
        if i == 0:
            ctes.append(f"{prefix}r AS (SELECT *, " + ", ".join(f"x{j} AS raw{j}" for j in range(len(features))) + f" FROM {last})")
            last = f"{prefix}r"
        slope = lambda c: f"CASE WHEN {dot(x, x)} > 1e-12 * {first} THEN {dot(x, c)} / {dot(x, x)} ELSE 0 END"
        slopes = ", ".join(f"{slope(c)} AS s{i}_{c}" for c in rest)
        ctes.append(f"{prefix}s{i} AS (SELECT *, {slopes} FROM {last})")
        reduced = ", ".join(f"{c} - s{i}_{c} * {x} AS {c}" for c in rest)
        ctes.append(f"{prefix}e{i} AS (SELECT * EXCLUDE ({', '.join(rest)}), {reduced} FROM {prefix}s{i})")
        last = f"{prefix}e{i}"
    fitted = " + ".join(["__my", *[f"s{i}_y * x{i}" for i in range(len(features))]])
    ctes.append(f"{prefix} AS (SELECT *, {fitted} AS prediction FROM {last})")
    return ",\n".join(ctes), prefix
