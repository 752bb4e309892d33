"""Write the physical plan Catalyst picks for every registered query, and for
the silver and gold jobs, as markdown: ``python -m tests.dump_plans [sf_dir]``."""

from __future__ import annotations

import re
import sys

from tests.plans import plan


def condense(text: str, width: int = 150) -> str:
    out = []
    for line in text.splitlines():
        if line.startswith("== ") or not line.strip():
            continue
        line = re.sub(r"#\d+L?", "", line)              # expression ids
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        out.append(line if len(line) <= width else line[: width - 3] + "...")
    return "\n".join(out)


def main(argv: list[str]) -> None:
    from strata.plans import jobs
    from strata.plans.catalog import PAGE_SIZE, QUERIES, RUN_DATE
    from strata.plans.layers import to_gold, to_silver
    from strata.plans.shapes import events_as_user_records, table
    from strata.session import local_session, scratch_path
    from strata.sources.landing import land_pages
    from strata.sources.schemas import BRONZE, SILVER
    from strata.sources.tables import read_table

    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session(8)
    print(f"# Physical plans ({sf}, local[8])\n")
    print("Generated by `python -m tests.dump_plans`; expression ids are stripped, long lines cut.")
    print("These are the plans as planned: at run time AQE may still coalesce shuffle")
    print("partitions or turn a sort-merge join into a broadcast from measured sizes.\n")
    sections = [(name, q(spark, sf)) for name, q in QUERIES.items()]

    layout = jobs.Layout.under(scratch_path(spark, "plans"))
    land_pages(events_as_user_records(table(spark, sf, "events"), PAGE_SIZE), layout.landing, RUN_DATE)
    jobs.run(spark, layout, RUN_DATE)
    sections.append(("silver job: to_silver(bronze of one date)",
                     to_silver(read_table(spark, layout.bronze, BRONZE, RUN_DATE), RUN_DATE)))
    sections.append(("gold job: to_gold(silver of one date)",
                     to_gold(read_table(spark, layout.silver, SILVER, RUN_DATE), RUN_DATE)))
    for name, df in sections:
        print(f"## {name}\n\n```\n{condense(plan(df, 'simple'))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
