"""Many markers in one pass over a text: a prefix tree as a pattern, whose longest match at each place says which markers begin there.

All markers that begin at one place are prefixes of the longest of them, so that one match per place stands for all; the best rule of a match is the best among the marker and the markers that it begins with. The
work per character is bounded by the breadth of the tree at each step and does not grow with the number of markers.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from kbweave.functions.text import empty_if_null, let

#: From so many markers on the tree is used instead of one search per marker.
MANY = 200


def tree_pattern(markers: set[str]) -> str:
    """A pattern that matches the longest of the markers at a place."""
    root: dict = {}
    for m in markers:
        node = root
        for c in m:
            node = node.setdefault(c, {})
        node[""] = {}

    def shown(node: dict) -> str:
        leaves = sorted(c for c, below in node.items() if c and set(below) == {""})
        parts = [re.escape(c) + shown(below) for c, below in sorted(node.items()) if c and c not in leaves]
        if leaves:
            parts.append(re.escape(leaves[0]) if len(leaves) == 1 else "[" + "".join(map(re.escape, leaves)) + "]")
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"
        return f"(?:{body})?" if "" in node else body

    return shown(root)


def best_rules(rules: tuple[tuple[str, tuple[str, ...]], ...]) -> dict[str, int]:
    """The place of the first rule that holds where a marker is the longest match."""
    own: dict[str, int] = {}
    for k, (_, markers) in enumerate(rules):
        for m in markers:
            own.setdefault(m, k)
    return {m: min(own[m[:n]] for n in range(1, len(m) + 1) if m[:n] in own) for m in own}


def first_rule_of_many(text: Column, rules: tuple[tuple[str, tuple[str, ...]], ...], default: str) -> Column:
    """The name of the first rule one of whose markers is in the lower-cased text, as a chain of searches gives it. An empty marker is in every text."""
    always = next((k for k, (_, markers) in enumerate(rules) if "" in markers), len(rules))
    kept = tuple((name, tuple(m for m in markers if m)) for name, markers in rules[:always])
    place = best_rules(kept)
    names = F.array(*[F.lit(name) for name, _ in rules], F.lit(default))
    if not place:
        return F.get(names, F.lit(always))
    found = F.array_distinct(F.regexp_extract_all(F.lower(empty_if_null(text)), F.lit(f"(?=({tree_pattern(set(place))}))"), F.lit(1)))
    ranks = F.create_map(*[F.lit(x) for pair in sorted(place.items()) for x in pair])
    first = let(found, lambda f: F.array_min(F.transform(f, lambda m: F.element_at(ranks, m))))
    return F.get(names, F.coalesce(first, F.lit(always)))
