"""Summarise physical plans of the headline jobs -> PLANS.md.

Usage: python -m checks.plans [sf_dir]. Counts shuffles, join strategies and
aggregate kinds in the final adaptive plans and lists the Parquet read schemas.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from bench import HEADLINE  # noqa: E402


def main(argv):
    from landlens.plans.queries import QUERIES
    from landlens.plans.inputs import Layers
    from landlens.session import local_session

    Layers.pin = lambda self, df: df  # the whole job in one plan, none of it behind a stage table
    d = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = ["# Physical plans of the headline jobs", "",
           f"Final adaptive plans after one run on `{d}` (`python -m checks.plans`). Nested-loop and Cartesian",
           "joins: none. `ReadSchema` shows the columns each scan reads. Pinning is off here, so that every join of",
           "a job is counted (products used by several branches count once a branch; in a run they are stage tables).", "",
           "| job | exchanges | sort-merge joins | broadcast hash joins | shuffled hash joins | hash aggs | sort aggs |",
           "| --- | --- | --- | --- | --- | --- | --- |"]
    schemas = {}
    for name in HEADLINE:
        df = QUERIES[name](spark, d)
        df.write.format("noop").mode("overwrite").save()
        p = df._jdf.queryExecution().executedPlan().toString()
        row = [p.count("Exchange hashpartitioning") + p.count("Exchange SinglePartition") + p.count("Exchange rangepartitioning"),
               p.count("SortMergeJoin"), p.count("BroadcastHashJoin"), p.count("ShuffledHashJoin"),
               p.count("HashAggregate"), p.count("SortAggregate")]
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name
        out.append(f"| {name} | " + " | ".join(str(x) for x in row) + " |")
        for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*?Location: [^\n]*?/(\w+)\.parquet[^\n]*?ReadSchema: (struct<[^>]*>)", p):
            schemas[m.group(2)] = m.group(3)
    out += ["", "## Parquet read schemas (column pruning)", ""]
    out += [f"* `{t}`: `{s}`" for t, s in sorted(schemas.items())]
    open("PLANS.md", "w").write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1:])
