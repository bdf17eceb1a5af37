"""What a Python worker process keeps from one task to the next."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

_HOLDER = "marginfold_worker_state"


def kept(name: str, make: Callable[[], object]):
    """The object of that name in this process, made on first use.

    Functions travel to workers with their code, so a module's own globals do not outlast a task.
    """
    holder = sys.modules.setdefault(_HOLDER, types.ModuleType(_HOLDER))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)
