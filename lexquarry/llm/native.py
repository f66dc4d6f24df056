"""SQL text for matches with positions, and for the trees of fitted forests.

Everything here becomes Catalyst expressions: no Python runs on the executors.
"""

from __future__ import annotations

import re

BLOCK = 256


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: str, pattern: str, needs: str = "true") -> str:
    """SQL for all leftmost non-overlapping matches in order, as array<struct<s, e, t, b, a>>.

    ``s`` and ``e`` are code points (end exclusive), ``t`` the match, ``b`` and ``a`` up to 32 and 16
    characters before and after it, at most to the next match. Split and extraction give the
    text between and in the matches; sums of their lengths are the offsets, block by block, so
    that many matches in one text stay cheap. The pattern mustn't match the empty string. ``needs`` is
    a cheap SQL condition without which the pattern can't match; such texts aren't scanned.
    """
    length = "cast(length(x.p[i]) + length(x.m[i]) as bigint)"
    before = f"if(k = 0, 0L, aggregate(sequence(0, greatest(k * {BLOCK} - 1, 0)), 0L, (n, i) -> n + {length}))"
    one = "named_struct('s', acc.at + length(x.p[i]), 'e', acc.at + length(x.p[i]) + length(x.m[i]), 't', x.m[i], 'b', right(x.p[i], 32), 'a', left(x.p[i + 1], 16))"
    empty = "cast(array() as array<struct<s: bigint, e: bigint, t: string, b: string, a: string>>)"
    block = (
        f"aggregate(sequence(k * {BLOCK}, least(k * {BLOCK} + {BLOCK - 1}, size(x.m) - 1)), named_struct('at', {before}, 'out', {empty}), "
        f"(acc, i) -> named_struct('at', acc.at + {length}, 'out', concat(acc.out, array({one}))), acc -> acc.out)"
    )
    whole = f"if(size(x.m) = 0, {empty}, flatten(transform(sequence(0, (size(x.m) - 1) div {BLOCK}), k -> {block})))"
    found = f"array(named_struct('p', split({text}, {literal(pattern)}, -1), 'm', regexp_extract_all({text}, {literal(pattern)}, 0)))"
    scan = f"transform({found}, x -> {whole})[0]"
    return scan if needs == "true" else f"if({needs}, {scan}, {empty})"


def tree_sql(lines: list[str], features: str) -> str:
    """Nested CASE of one tree as MLlib prints it; ``features`` is SQL for the array of features."""

    def node(at: int) -> tuple[str, int]:
        line = lines[at].strip()
        if line.startswith("Predict:"):
            return f"{float(line.split(':')[1])}D", at + 1
        test = re.fullmatch(r"If \(feature (\d+) (<=|>|in|not in) (.+)\)", line)
        if not test or test[2] not in ("<=", ">"):
            raise ValueError(f"unread tree line {line!r}")
        yes, at = node(at + 1)
        if not lines[at].strip().startswith("Else"):
            raise ValueError(f"unread tree line {lines[at]!r}")
        no, at = node(at + 1)
        return f"if({features}[{test[1]}] {test[2]} {float(test[3])}D, {yes}, {no})", at

    return node(0)[0]


def forest_sql(model, features: str) -> str:
    """Weighted sum of the trees of a fitted MLlib ensemble."""
    terms = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        lines = [x for x in tree.toDebugString.split("\n")[1:] if x.strip()]
        terms.append(f"{float(weight)}D * {tree_sql(lines, features)}")
    return "(" + " + ".join(terms) + ")"


def features_sql(formulas: list[str], **names: str) -> str:
    """The array of features, formulas filled in with the SQL of a candidate's parts."""
    return "array(" + ", ".join(f"cast({f.format(**names)} as double)" for f in formulas) + ")"
