"""Single-flight runs and an interval schedule on the driver."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from datetime import datetime, timedelta


class RunManager:
    """At most one run at a time; a second start is refused."""

    def __init__(self, job: Callable[[], object]):
        self.job = job
        self.lock = threading.Lock()
        self.last: dict[str, object] = {"status": "idle"}

    def start(self, wait: bool = False) -> bool:
        if not self.lock.acquire(blocking=False):
            return False
        thread = threading.Thread(target=self._run, daemon=True)
        thread.start()
        if wait:
            thread.join()
        return True

    def _run(self) -> None:
        began = time.time()
        try:
            self.last = {"status": "running", "started": began}
            self.last = {"status": "completed", "result": self.job(), "duration_ms": int(1000 * (time.time() - began))}
        except Exception as e:
            self.last = {"status": "failed", "error": f"{type(e).__name__}: {e}", "duration_ms": int(1000 * (time.time() - began))}
        finally:
            self.lock.release()


#: The fields of a cron line with their bounds.
CRON_FIELDS = (("minute", 0, 59), ("hour", 0, 23), ("day", 1, 31), ("month", 1, 12), ("weekday", 0, 7))
NAMES = {n: k for names, first in (("jan feb mar apr may jun jul aug sep oct nov dec", 1), ("sun mon tue wed thu fri sat", 0)) for k, n in enumerate(names.split(), first)}


class Cron:
    """Times of a five-part cron line (minute hour day month weekday): lists, ranges, steps and names; day and weekday are alternatives where both are given."""

    def __init__(self, line: str):
        parts = line.split()
        if len(parts) != 5:
            raise ValueError("cron needs five parts: minute hour day month weekday")
        self.allowed = [self._values(p.lower(), *f) for p, f in zip(parts, CRON_FIELDS, strict=True)]
        if 7 in self.allowed[4]:
            self.allowed[4].add(0)
        self.either = not parts[2].startswith("*") and not parts[4].startswith("*")

    @staticmethod
    def _values(part: str, name: str, low: int, high: int) -> set[int]:
        out: set[int] = set()
        for piece in part.split(","):
            span, _, step = piece.partition("/")
            first, dash, last = span.partition("-")
            number = lambda x: NAMES[x] if x in NAMES else int(x)
            a, b = (low, high) if span == "*" else (number(first), number(last) if dash else high if step else number(first))
            if not low <= a <= b <= high or (step and int(step) < 1):
                raise ValueError(f"{name} out of range: {piece}")
            out |= set(range(a, b + 1, int(step or 1)))
        return out

    def matches(self, at: datetime) -> bool:
        minute, hour, day, month, weekday = self.allowed
        on_day, on_weekday = at.day in day, at.isoweekday() % 7 in weekday
        return at.minute in minute and at.hour in hour and at.month in month and ((on_day or on_weekday) if self.either else (on_day and on_weekday))

    def after(self, at: datetime) -> datetime:
        """The first matching minute after a time."""
        at = at.replace(second=0, microsecond=0) + timedelta(minutes=1)
        end = at + timedelta(days=366 * 8)
        while at < end:
            if self.matches(at):
                return at
            whole_day = at.month in self.allowed[3] and any(self.matches(at.replace(hour=h, minute=m)) for h in self.allowed[1] for m in self.allowed[0])
            at = at + timedelta(minutes=1) if whole_day and at.hour * 60 + at.minute < 1439 else at.replace(hour=0, minute=0) + timedelta(days=1)
        raise ValueError("no such time")


class Scheduler:
    """Starts the manager's job every `seconds` (5 at least) or at the times of a cron line; ticks that meet a running job are skipped and counted."""

    def __init__(self, manager: RunManager, seconds: float | None = None, cron: str | None = None):
        if (seconds is None) == (cron is None):
            raise ValueError("give either an interval or a cron line")
        if seconds is not None and seconds < 5:
            raise ValueError("interval must be at least 5 seconds")
        self.manager, self.seconds, self.cron = manager, seconds, Cron(cron) if cron is not None else None
        self.stopped = threading.Event()
        self.skipped = 0

    def wait(self) -> float:
        """Seconds until the next start."""
        if self.cron is None:
            return self.seconds
        now = datetime.now()
        return (self.cron.after(now) - now).total_seconds()

    def start(self) -> None:
        threading.Thread(target=self._loop, daemon=True).start()

    def _loop(self) -> None:
        while not self.stopped.wait(self.wait()):
            self.skipped += not self.manager.start()

    def stop(self) -> None:
        self.stopped.set()
