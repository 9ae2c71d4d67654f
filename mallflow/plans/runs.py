"""Names of the parts that a day's mergeable tables are made of.

Every batch adds one run of level 0. When :data:`FAN_IN` runs of a level follow each other, they are merged into one of the next level,
so a day of n batches is read from at most ``FAN_IN * log(n)`` runs, and each row is merged ``log(n)`` times. Runs that are live before a
batch are noted with the batch, before it writes anything: a batch that is run again finds the same runs and replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

FAN_IN = 8


@dataclass(frozen=True)
class Merge:
    """Runs, and the run that takes their place."""

    runs: tuple[str, ...]
    into: str


def own_run(batch_id: int) -> str:
    return f"0-{batch_id}"


def merged_run(batch_id: int) -> str:
    """The name of a run that holds all of the day up to a batch; above every level that runs are merged to."""
    return f"99-{batch_id}"


def _level(run: str) -> int:
    return int(run.split("-")[0])


def compacted(live: Sequence[str], fan_in: int = FAN_IN) -> tuple[list[str], list[Merge]]:
    """The live runs, oldest first, after merging, and the merges in the order they are to be made."""
    runs, merges = list(live), []
    while len(runs) >= fan_in and len({_level(run) for run in runs[-fan_in:]}) == 1:
        old = runs[-fan_in:]
        into = f"{_level(old[-1]) + 1}-{old[-1].split('-')[1]}"
        runs[-fan_in:] = [into]
        merges.append(Merge(tuple(old), into))
    return runs, merges
