"""Builds each plan once per set of feeds, and sets of feeds with some replaced."""

from __future__ import annotations

from functools import wraps
from inspect import signature


def plan(fn):
    """Remembers the DataFrame a plan function built, when the feeds offer a `plans` dictionary.

    Only the lazy plan is kept, no data; a plain dictionary of feeds works as well, without remembering.
    """

    shape = signature(fn)

    @wraps(fn)
    def build(t, *args, **kwargs):
        known = getattr(t, "plans", None)
        if known is None:
            return fn(t, *args, **kwargs)
        call = shape.bind(t, *args, **kwargs)
        call.apply_defaults()
        key = (fn.__module__, fn.__name__, call.args[1:])
        if key not in known:
            known[key] = fn(t, *args, **kwargs)
        return known[key]

    return build


class Replaced:
    """Feeds of which some are replaced by tables of the same columns; plans over them are remembered apart."""

    def __init__(self, feeds, replace):
        """replace: from a feed's name to a function of the feed, for the feeds that change."""
        self._feeds, self._replace, self._held, self.plans = feeds, replace, {}, {}

    def __getitem__(self, name: str):
        if name not in self._held:
            df = self._feeds[name]
            self._held[name] = self._replace[name](df) if name in self._replace else df
        return self._held[name]

    def __getattr__(self, name: str):
        return getattr(self._feeds, name)
