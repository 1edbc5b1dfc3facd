"""Key search in JSON of unknown depth: the one lookup that column expressions cannot state.

A VARIANT keeps the fields of an object in the order of their names, and the search goes by the order in the text,
so it runs on the text itself. Texts that are no JSON, or are nested deeper than the reader goes, give null.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The search travels with the job: Python workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Texts of a batch that are Python objects at one time.
ROWS = 200


def _first_values(page: object, keys: list[str]) -> dict[str, object]:
    """The value each key is found with, in one walk in document order.

    An object that has a key answers for all below it, be the value null or not; the first
    answer that is not null counts.
    """
    found: dict[str, object] = {}
    pending = [(page, frozenset(keys))]
    while pending and len(found) < len(keys):
        node, sought = pending.pop()
        if isinstance(node, dict):
            here = {k for k in sought if k in node}
            for k in here:
                if node[k] is not None:
                    found.setdefault(k, node[k])
            sought, children = sought - here, list(node.values())
        else:
            children = node if isinstance(node, list) else []
        if sought:
            pending.extend((child, sought) for child in reversed(children) if isinstance(child, (dict, list)))
    return found


def _find_in_text(text: str | None, keys: list[str], only: type) -> str | None:
    try:
        values = _first_values(json.loads(text), keys) if text else {}
    except (ValueError, RecursionError):
        # No JSON, or nested deeper than the reader goes.
        return None
    usable = next((values[k] for k in keys if values.get(k)), values.get(keys[-1]))
    try:
        return None if usable is None or not isinstance(usable, only) else json.dumps(usable, separators=(",", ":"), ensure_ascii=False)
    except RecursionError:
        return None


def deep_find(*keys: str, only: type = object) -> Callable[[Column], Column]:
    """Column function: JSON text of the first key whose value is neither null, empty nor 0.

    If none qualifies, the outcome of the last key is returned, as with a chain of ``or``; an outcome of another type
    than ``only`` is null. Texts that name none of the keys are not parsed.
    """
    wanted = list(keys)

    @F.arrow_udf("string")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Spark bounds a batch in bytes, so what comes and what is found are held once each, and few texts beside them.
        for texts in batches:
            parts = [texts.slice(at, ROWS) for at in range(0, len(texts), ROWS)]
            found = [pa.array([_find_in_text(t, wanted, only) for t in part.to_pylist()], pa.string()) for part in parts]
            yield pa.concat_arrays(found) if found else pa.array([], pa.string())
            del texts, parts, found
            pa.default_memory_pool().release_unused()

    # A key may be written with escapes, so a backslash also asks for a look.
    named = "|".join([r"\\", *(re.escape(k) for k in wanted)])
    # Said to be nondeterministic, so that conditions on the outcome are checked on it and do not search again.
    once = find.asNondeterministic()
    return lambda text: once(F.when(text.rlike(named), text))
