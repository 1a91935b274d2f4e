"""Write, audit, publish: a day is served only when no blocking control fails."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from vigia.calendar import DailyCutoff
from vigia.durable import stored
from vigia.plans.controls import failures, quality_controls
from vigia.plans.snapshot import daily_snapshot
from vigia.sources.snapshots import SnapshotStore
from vigia.sources.star import StarTables


@dataclass(frozen=True)
class PublishResult:
    """What happened to a day: published or not, why, what to warn of, and the day readers are served.

    If ``served`` is earlier than the day itself, readers see its date as a notice.
    """

    controls: DataFrame
    published: bool
    failed: list[str]
    warnings: list[str]
    served: date | None


def write_audit_publish(star: StarTables, cutoff: DailyCutoff, store: SnapshotStore) -> PublishResult:
    """Stage the day, run the controls on what was staged, publish it or keep the last good day."""
    store.stage(daily_snapshot(star.clientes, star.casos, star.facturacion, star.prevencion, cutoff), cutoff.day)
    return audit_and_publish(star, cutoff, store)


def audit_and_publish(star: StarTables, cutoff: DailyCutoff, store: SnapshotStore) -> PublishResult:
    """The audit and the gate for a day that is already staged."""
    staged = store.staged()
    # Twelve rows that three readers share; they must not be computed again with other times.
    controls = stored(
        quality_controls(staged, store.published(), star.casos, star.clientes, cutoff), "controles")
    store.append_history(controls)
    failed, warnings = failures(controls)
    if not failed:
        store.publish(staged, cutoff.day)
    return PublishResult(controls, not failed, failed, warnings, store.served_day())
