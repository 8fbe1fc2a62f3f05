"""Print the executed (final adaptive) plan of a DataFrame with per-node SQL metrics.

Usage: run the DataFrame's action first, then ``show(df)``.
"""

from __future__ import annotations


def _children(node):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if name.endswith("QueryStageExec"):
        return [node.plan()]
    if name == "ReusedExchangeExec":
        return [node.child()]
    ch = node.children()
    return [ch.apply(i) for i in range(ch.size())]


def show(df) -> None:
    root = df._jdf.queryExecution().executedPlan()

    def walk(node, depth):
        it = node.metrics().iterator()
        parts = []
        while it.hasNext():
            kv = it.next()
            k, v = kv._1(), kv._2().value()
            if v and ("rows" in k or "time" in k.lower() or "size" in k.lower()):
                parts.append(f"{k}={v}")
        print("  " * depth + node.nodeName() + ("  [" + ", ".join(parts) + "]" if parts else ""))
        for c in _children(node):
            walk(c, depth + 1)
    walk(root, 0)
