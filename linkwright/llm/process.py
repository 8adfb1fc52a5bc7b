"""Things that a Python worker makes once and keeps from task to task, as long as tasks ask for them."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable
from time import monotonic
from types import ModuleType
from typing import Any

_PLACE = "_linkwright_process"

#: Seconds after which a thing that no task has asked for makes room for others.
IDLE_SECONDS = 20.0


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave for ``key`` when this process first asked.

    Functions sent to tasks by value get fresh globals in every task, so the store is a module of its own. A worker
    goes from one operator to the next, so whatever has not been asked for lately is dropped.
    """
    place = sys.modules.setdefault(_PLACE, ModuleType(_PLACE))
    store = place.__dict__.setdefault("store", {})
    now = monotonic()
    found = store[key] = (store[key][0] if key in store else make(), now)
    if now - place.__dict__.setdefault("swept", now) > 1:
        place.swept = now
        for other in [k for k, (_, asked) in store.items() if now - asked > IDLE_SECONDS]:
            del store[other]
    return found[0]
