"""Members of parsed JSON values by dotted path."""

from __future__ import annotations


def json_path(value, path: str):
    """A member by dotted path; list elements by number, a name over a list maps it."""
    for name in path.split(".") if path else ():
        if isinstance(value, list) and not name.isdigit():
            value = _of_each(value, name)
        elif isinstance(value, list):
            value = value[int(name)] if int(name) < len(value) else None
        else:
            value = value.get(name) if isinstance(value, dict) else None
    return value


def _of_each(values: list, name: str) -> list:
    """The member of each element, in lists of lists at their own places, however deep."""
    out: list = []
    left = [(values, out)]
    while left:
        own, to = left.pop()
        for x in own:
            if isinstance(x, list):
                to.append([])
                left.append((x, to[-1]))
            else:
                to.append(x.get(name) if isinstance(x, dict) else None)
    return out
