"""Row counts and key checks collected while a mart is written, without a pass of their own.

A builder marks its driving relation with ``watched``; ``publish`` watches what
it writes.  Both become observed metrics of the write itself.  Outside a
``Watch`` the marks do nothing.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

_active = threading.local()


class Watch:
    """Metrics of one write: ``with Watch() as w: ...build, write...``, then ``w.metrics()``."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def __enter__(self) -> Watch:
        self._outer = getattr(_active, "watch", None)
        _active.watch = self
        return self

    def __exit__(self, *_) -> None:
        _active.watch = self._outer

    def observe(self, df: DataFrame, point: str, keys: Sequence[str] = ()) -> DataFrame:
        if point in self._seen:
            raise ValueError(f"{point} is watched twice")
        self._seen[point] = Observation()
        nulls = [F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys]
        return df.observe(self._seen[point], F.count(F.lit(1)).alias("rows"), *nulls)

    def metrics(self) -> dict[str, dict[str, int]]:
        """``{point: {"rows": n, "null_<key>": n}}`` after the write; blocks until it has ended."""
        out = {}
        for point, seen in self._seen.items():
            try:
                out[point] = {k: int(v or 0) for k, v in seen.get.items()}
            except Py4JJavaError:  # the optimiser knew the relation to be empty and took it out of the plan
                out[point] = {"rows": 0}
        return out


def watched(df: DataFrame, point: str = "driving") -> DataFrame:
    """``df``, counted under the name ``point`` if a ``Watch`` is open."""
    watch = getattr(_active, "watch", None)
    return df if watch is None else watch.observe(df, point)
