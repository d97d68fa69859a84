"""Stages of a snapshot run, each reading and writing tables."""

from rosterlake.plans.bronze import build_bronze
from rosterlake.plans.changes import report_changes
from rosterlake.plans.gold import publish_gold
from rosterlake.plans.manifest import write_manifest
from rosterlake.plans.silver import build_silver
from rosterlake.plans.snapshot import run_snapshot

__all__ = [
    "build_bronze",
    "build_silver",
    "publish_gold",
    "report_changes",
    "run_snapshot",
    "write_manifest",
]
