"""Write PLANS.md: formatted physical plans of headline queries at sf0.1.

Usage: python scripts/dump_plans.py [sf_dir]
"""
import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from restock.plans import catalog  # noqa: E402
from restock.session import get_session  # noqa: E402

NAMES = ["rolling_features", "greedy_plan", "feasible_sources", "plan_audit",
         "trend_weekly_forecast", "transport_costs", "execution_summary"]


def summary(text: str) -> str:
    keep = [ln for ln in text.splitlines() if ln.startswith(("(", "PushedFilters", "ReadSchema"))
            or re.match(r"^[ :+\-*]*(\w+)", ln) and not ln.startswith(("Input", "Output",
                                                                         "Arguments", "Keys",
                                                                         "Functions", "Aggregate",
                                                                         "Results", "Condition",
                                                                         "Join", "Left", "Right",
                                                                         "Location", "Batched"))]
    return "\n".join(keep)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    out = ["# Physical plans (sf0.1, local[8])", "",
           "Generated by `scripts/dump_plans.py`: the operator tree, and for every scan the "
           "columns read (`ReadSchema`) and the filters pushed into it (`PushedFilters`). "
           "Plan queries start from the written daily aggregate (and the plan where it is read twice), "
           "so their scans are of those Parquet tables.", ""]
    for name in NAMES:
        buf = io.StringIO()
        df = catalog.QUERIES[name](spark, sf_dir)
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        out += [f"## {name}", "", "```", summary(buf.getvalue()).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
