"""Rules for names, and quoting. They run on the driver, over names only."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence

from loanloom.specs import BUILDING_SUFFIXES


def quote(name: str) -> str:
    """`name` as an identifier that Spark takes literally, dots included."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """`value` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def needs_fallback(name: str) -> bool:
    """Names with capitals of any script, if they have several parts or no small letter."""
    has_capitals = name != name.lower()
    return has_capitals and ("_" in name or name == name.upper())


def fallback(name: str) -> str:
    lowered = name.lower()
    return f"building_{lowered}" if name.upper().endswith(BUILDING_SUFFIXES) else lowered


def silver_names(columns: Sequence[str], renames: Mapping[str, str]) -> list[str]:
    """The new name of every column, in order: dictionary first, then fallback."""
    new = [renames.get(c) or (fallback(c) if needs_fallback(c) else c) for c in columns]
    require_distinct(new)
    return new


def require_distinct(names: Iterable[str]) -> None:
    """Spark resolves names without regard to case, so they must differ beyond it."""
    twice = sorted(n for n, k in Counter(n.lower() for n in names).items() if k > 1)
    if twice:
        raise ValueError(f"several columns would be named: {', '.join(twice)}")


#: What a feature name cannot hold; underscores take the place of each such character.
_not_in_names = re.compile(r"[\W_]")


def type_part(value: str) -> str:
    """A category as part of a feature name."""
    return _not_in_names.sub("_", value).lower()


def status_part(status: str) -> str:
    """A status as part of a feature name; it reads like a category."""
    return type_part(status)


def share_name(count_name: str) -> str:
    return count_name.replace("_count", "_share")
