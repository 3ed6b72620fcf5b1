"""Rows that each plan node put out, from a Spark event log.

usage: python tools/plan_rows.py <event log> [node pattern]

``node_rows`` gives one entry per node and execution that ran: the job description that was set
when the execution began, the node, its description (with the files of a scan) and the rows.
"""

from __future__ import annotations

import json
import os
import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass


@dataclass(frozen=True)
class NodeRows:
    job: str
    node: str
    detail: str
    rows: int


def _nodes(plan: dict) -> Iterator[tuple[int, str, str]]:
    for m in plan["metrics"]:
        if m["name"] == "number of output rows":
            yield m["accumulatorId"], plan["nodeName"], f"{plan['simpleString']} {plan.get('metadata', {}).get('Location', '')}"
    for child in plan["children"]:
        yield from _nodes(child)


def node_rows(log: str) -> list[NodeRows]:
    """``log``: an event log file, or a folder of them (rolled ones too)."""
    found = [os.path.join(d, f) for d, _, names in os.walk(log) for f in names if not f.startswith((".", "appstatus"))]
    paths = sorted(found, key=lambda p: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", p)]) or [log]
    jobs: dict[tuple[str, int], str] = {}
    nodes: dict[int, tuple[str, str, str]] = {}
    rows: dict[int, int] = defaultdict(int)
    for path in paths:
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                if "sparkPlanInfo" in e:
                    job = jobs.setdefault((os.path.dirname(path), e["executionId"]), e.get("description") or "")
                    for number, node, detail in _nodes(e["sparkPlanInfo"]):
                        nodes[number] = (job, node, detail)
                elif e["Event"] == "SparkListenerTaskEnd" and e["Task End Reason"]["Reason"] == "Success":
                    for a in e["Task Info"].get("Accumulables", []):
                        if str(a.get("Update")).isdigit():
                            rows[a["ID"]] += int(a["Update"])
    return [NodeRows(*nodes[n], rows[n]) for n in nodes if rows[n]]


def main() -> None:
    pattern = sys.argv[2] if len(sys.argv) > 2 else "Scan|Join"
    for r in sorted(node_rows(sys.argv[1]), key=lambda r: -r.rows):
        if re.search(pattern, r.node):
            print(f"{r.rows:>12}  {r.job[:40]:40}  {r.node:30}  {r.detail[:160]}")


if __name__ == "__main__":
    main()
