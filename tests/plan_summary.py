"""Print exchanges / joins / window limits of the final (AQE) plan per query as markdown.

    python tests/plan_summary.py [sf_dir] [key ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOIN = re.compile(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[(.*?)\], \[.*?\], (\w+)")
NODES = re.compile(r"(Exchange \w+(?:\([^)]*\))?|BroadcastExchange|WindowGroupLimit|ArrowEvalPython|BatchEvalPython|"
                   r"HashAggregate|ObjectHashAggregate|SortAggregate|Generate \w+|Expand|FileScan \w+)")


def summary(df) -> list[str]:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.splitlines():
        j = JOIN.search(line)
        if j:
            out.append(f"{j.group(1)} {j.group(3)} on [{re.sub(r'#[0-9]+L?', '', j.group(2))}]")
            continue
        m = NODES.search(line)
        if m:
            node = re.sub(r"#\d+L?", "", m.group(1))
            node = re.sub(r", \d+\)$", ")", node)
            out.append(node)
    return out


if __name__ == "__main__":
    from murmur.plans.catalog import QUERIES
    from murmur.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or sorted(QUERIES)
    spark = get_session("local[8]", 8)
    print(f"# Final physical plans ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Operators of interest, top (output) to bottom (scans).  Broadcasts were chosen by AQE")
    print("from measured sizes.\n")
    for k in keys:
        nodes = summary(QUERIES[k](spark, sf))
        n_ex = sum(1 for n in nodes if n.startswith("Exchange hashpartitioning") or n.startswith("Exchange rangepartitioning")
                   or n.startswith("Exchange RoundRobin") or n.startswith("Exchange SinglePartition"))
        print(f"## {k}\n\nshuffle exchanges: {n_ex}\n")
        print("```\n" + "\n".join(nodes) + "\n```\n", flush=True)
