"""Write PLANS.md: the physical plan tree of every query of the incident analytics.

    python tools/plan_report.py [sf_dir]

Each query is executed first, so that adaptive plans are final; of
``explain("formatted")`` the tree that ran is kept (the per-node details and the
first draft are left out to keep the file short). Steps that a query has run
before, up to a checkpoint, are not in its last plan.
"""

from __future__ import annotations

import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from geoincident.operators.joins import executed_plan_text, plan_text  # noqa: E402
from geoincident.plans import catalog  # noqa: E402
from geoincident.session import build_session  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]")
    out = ["# Physical plans", "",
           f"Final adaptive plans of every query of the incident analytics on `{sf}` (`local[8]`),",
           "operator tree of `explain(\"formatted\")`. Generated by `tools/plan_report.py`.", ""]
    for name, fn in catalog.queries().items():
        df = fn(spark, sf)
        executed_plan_text(df)
        tree = plan_text(df, "formatted").split("\n\n")[0].replace("== Physical Plan ==\n", "")
        tree = tree.split("+- == Final Plan ==\n")[-1].split("+- == Initial Plan ==")[0]
        out += [f"## {name}", "", "```", tree.rstrip(), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
