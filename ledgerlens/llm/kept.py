"""What a Python worker loads once and keeps for all its tasks."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

_PLACE = "ledgerlens_kept"


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """What `make` gave when this process first asked for the key.

    Functions of this package travel to the workers by value, so their globals
    begin anew with every task; a module that only the worker knows does not.
    """
    store = vars(sys.modules.setdefault(_PLACE, ModuleType(_PLACE)))
    if key not in store:
        store[key] = make()
    return store[key]
