"""What a scan of a binary layout is to read: files by name, rows by number, chosen before any byte is read.

The choice is made when the scan is built, through reader options.  Spark can hand filters to a
Python source, but keeps them in an object that all scans of one DataFrame share (4.1: after
``df.filter("record_no = 7").count()`` a ``df.count()`` counts one row), so that is not used;
filters on the DataFrame still apply, after the read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable


def options(paths: Iterable[str] | None, numbers: Iterable[int] | None) -> dict[str, str]:
    """Reader options for files of these paths and rows of these numbers (a ``range`` or any integers)."""
    out = {}
    if paths is not None:
        out["only_paths"] = json.dumps([paths] if isinstance(paths, str) else list(paths))
    if isinstance(numbers, range) and numbers.step == 1:
        out["only_range"] = json.dumps([numbers.start, numbers.stop])
    elif numbers is not None:
        out["only_numbers"] = json.dumps(sorted({int(n) for n in numbers}))
    return out


class Selection:
    """The files and row numbers that reader options ask for; all of them without such options."""

    def __init__(self, opts):
        own = {k: json.loads(v) for k in ("only_paths", "only_range", "only_numbers") if (v := opts.get(k)) is not None}
        self.paths = set(own["only_paths"]) if "only_paths" in own else None
        self.least, self.end = own.get("only_range", (0, None))
        self.some = own.get("only_numbers")

    def has_path(self, path: str) -> bool:
        return self.paths is None or path in self.paths

    def runs(self, count: int, first: int = 0) -> list[tuple[int, int]]:
        """The chosen numbers from ``first`` on below ``count``, as [from, to) runs."""
        least, end = max(self.least, first), count if self.end is None else min(self.end, count)
        if self.some is None:
            return [(least, end)] if least < end else []
        out: list[tuple[int, int]] = []
        for n in self.some:
            if least <= n < end:
                if out and out[-1][1] == n:
                    out[-1] = (out[-1][0], n + 1)
                else:
                    out.append((n, n + 1))
        return out
