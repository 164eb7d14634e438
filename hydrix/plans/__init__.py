"""Compositions of operators: silver, gold, gates, raw profile, end-to-end run."""

from hydrix.plans.explore import distributions, profile_summary, raw_profile
from hydrix.plans.gate_states import GateRun, gate_partitions
from hydrix.plans.gates import gold_gate, silver_checks, silver_gate, silver_gate_at, source_silver_checks
from hydrix.plans.gold import GoldSpec, build_gold, category_is, gold_aggregate, split_gold, status_is
from hydrix.plans.incremental import compact_states, merge_batch, publish_gold, rerun_window
from hydrix.plans.medallion import cleaning_report, read_bronze, run_medallion, write_gold, write_silver
from hydrix.plans.silver import SilverSpec, build_silver, clean, reject_rules, window_counts

__all__ = [name for name in dir() if not name.startswith("_")]
