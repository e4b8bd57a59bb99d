"""Objects that a Python worker keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")


def worker_state(name: str, make: Callable[[], T], version: object = None) -> T:
    """The object called ``name``, made once per worker, and again for another ``version``.

    The package's functions travel by value, so their own globals are new in every task;
    a module of the worker process is not.
    """
    holder = sys.modules.setdefault("_corpus_mt_worker", types.ModuleType("_corpus_mt_worker")).__dict__
    if name not in holder or holder[name][0] != version:
        holder[name] = (version, make())
    return holder[name][1]
