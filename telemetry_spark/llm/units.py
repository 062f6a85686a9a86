"""Values of units, remembered within bounds: what stands between ASCII white space is encoded
alike alone and inside a text by vocabularies that drop white space and never match across it."""

from __future__ import annotations

import re
from collections.abc import Callable

WORDS = re.compile(r"[^ \t-\r]+")


class Units:
    """unit -> value; ``encode(list of units)`` gives the values of new ones.  At most about
    ``limit`` units are remembered, none longer than ``longest``."""

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 400_000, longest: int = 64):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.known: dict[str, object] = {}

    def values_of(self, units: list[str]) -> list:
        new = list(set(units).difference(self.known))
        long: dict[str, object] = {}
        if new:
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
                new = list(set(units))
            for unit, value in zip(new, self.encode(new)):
                (self.known if len(unit) <= self.longest else long)[unit] = value
        if long:
            return [long[u] if u in long else self.known[u] for u in units]
        return list(map(self.known.__getitem__, units))
