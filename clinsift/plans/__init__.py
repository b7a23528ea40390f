from clinsift.plans import corrections, reviews
from clinsift.plans.rules import RULES, run_rule
from clinsift.plans.run import prepare, run_all

__all__ = ["RULES", "corrections", "prepare", "reviews", "run_all", "run_rule"]
