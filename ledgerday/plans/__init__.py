"""Composite jobs."""

from ledgerday.plans.daily_run import DailyRun, daily_run, run_folder, run_window, write_daily_run

__all__ = ["DailyRun", "daily_run", "run_folder", "run_window", "write_daily_run"]
