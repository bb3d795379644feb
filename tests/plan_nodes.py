"""The operators that ran, read from the final plan of a collected frame."""


def ran(df, subqueries=False):
    """``(name, text)`` of every node of the plan that ran; what is reused stands once."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        out.append((name, node.simpleString(100_000)))
        if name == "ReusedExchange":
            return None
        for part in ("children", "subqueries") if subqueries else ("children",):
            found = getattr(node, part)()
            for i in range(found.size()):
                walk(found.apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return out
