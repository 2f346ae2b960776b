from bourse.plans.job import build_silver, run, run_gold

__all__ = ["build_silver", "run", "run_gold"]
