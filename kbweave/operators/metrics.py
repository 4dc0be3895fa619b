"""Metrics in passing: counters that are gathered by the job that writes the rows, and the wall time of stages."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kbweave.operators.cdc import counters


@dataclass
class StageTimes:
    """Seconds by stage, in the order in which the stages ended; a stage that runs again adds to its time, a failed one counts too."""

    seconds: dict[str, float] = field(default_factory=dict)
    clock: Callable[[], float] = time.perf_counter

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = self.clock()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + self.clock() - began

    def column(self) -> Column:
        """map<string,double> for a run's finish event."""
        pairs = [x for k, v in self.seconds.items() for x in (F.lit(k), F.lit(float(v)))]
        return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")


def written_with_counters(rows: DataFrame, write: Callable[[DataFrame], DataFrame], size: Column) -> tuple[DataFrame, DataFrame]:
    """(what `write` gives, one row of run counters): the counters are observed in the pass that writes, so that nothing is read for them.

    rows(change_status, success, ...) hold the run's versions and its deletions, whose success is null. `write` must run the job.
    """
    seen = Observation()
    done = write(rows.observe(seen, *counters(size)))
    found = seen.get
    schema = ", ".join(f"{k} long" for k in found)
    return done, rows.sparkSession.createDataFrame([tuple(found.values())], schema)
