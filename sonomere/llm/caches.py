"""Worker caches of bounded size."""

import sys
from collections.abc import Callable


class TwoGenerations(dict):
    """``cache[key]`` is ``make(key)``, kept while used often.

    When the young generation is full it becomes the old one; keys found there move up again.
    Keys longer than ``longest`` are never kept, so ``2 * entries * longest`` bounds the memory.
    """

    def __init__(self, make: Callable, entries: int = 1 << 16, longest: int = 64):
        super().__init__()
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value

    def unknown(self, keys: set) -> set:
        """The keys that neither generation has; those of the old one move up."""
        missing = keys - self.keys()
        older = {key: self.old[key] for key in missing & self.old.keys()}
        for key, value in older.items():
            self.put(key, value)
        return missing - older.keys()


def kept_by_worker(name: str, make: Callable):
    """``make()``, once per Python worker and name. It lives as long as the worker, over all its
    tasks, in a module of the worker's own: functions that come with a task are made anew for each.
    """
    kept = vars(sys.modules.setdefault("_sonomere_worker", type(sys)("_sonomere_worker")))
    if name not in kept:
        kept[name] = make()
    return kept[name]
