"""Two-stage retention of dated rows: archive at one age, delete at a later one, repeated safely after a crash at any point.

Before anything changes, the run's dates are committed with the table as a record of what is to be done. Its steps are to archive what
is due, to move the marker, and to delete; each is a commit that counts once, and the record says which was the last. A run that finds an
unfinished record ends that one first, with its dates, so rows are deleted only after they are in the archive, and archived twice is
archived once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .tables import insert_absent
from .versioned import VersionedTable

STEPS = ("planned", "archived", "marked", "deleted")


class Stopped(Exception):
    """Raised after a step on request, as a crash would end the run there."""


class Retention:
    """rows and archive are tables with the same schema, whose leading key is a date."""

    def __init__(self, rows: VersionedTable, archive: VersionedTable, archive_days: int = 20, keep_days: int = 30, start: str = "0001-01-01"):
        self.rows, self.archive, self.archive_days, self.keep_days, self.start = rows, archive, archive_days, keep_days, start

    def record(self) -> dict:
        """What was begun last: number, marker before it, both dates and the last step taken."""
        return self.rows.version().properties.get("retention", {"number": 0, "marker": self.start, "step": "deleted"})

    def marker(self) -> str:
        """The date up to which rows are archived."""
        return self.rows.version().properties.get("marker", self.start)

    def run(self, today: dt.date, stop_after: str | None = None) -> dict:
        """End an unfinished run, then archive and delete as of today; returns the record."""
        if self.record()["step"] != "deleted":
            self._finish(None)
        before = self.record()
        day = lambda n: (today - dt.timedelta(days=n)).isoformat()
        plan = {"number": before["number"] + 1, "marker": self.marker(), "archive_to": day(self.archive_days), "delete_to": day(self.keep_days), "step": "planned"}
        self.rows.set({"retention": plan})
        self._stop("planned", stop_after)
        self._finish(stop_after)
        return self.record()

    def _finish(self, stop_after: str | None) -> None:
        plan = self.record()
        date = F.col(self.rows.lead.name)
        left = STEPS[STEPS.index(plan["step"]) + 1 :]
        for step in left:
            done = {"retention": {**plan, "step": step}}
            if step == "archived":
                due = (date > F.lit(plan["marker"]).cast("date")) & (date <= F.lit(plan["archive_to"]).cast("date"))
                rows = self.rows.read().where(due | (date <= F.lit(plan["delete_to"]).cast("date")))
                self.archive.upsert(rows, lambda old, new: insert_absent(old, new, self.archive.keys), once=("retention", plan["number"]))
                self.rows.set(done)
            elif step == "marked":
                self.rows.set({**done, "marker": max(plan["archive_to"], plan["marker"])})
            else:
                self.rows.delete_up_to(dt.date.fromisoformat(plan["delete_to"]), done)
            self._stop(step, stop_after)

    @staticmethod
    def _stop(step: str, stop_after: str | None) -> None:
        if step == stop_after:
            raise Stopped(step)
