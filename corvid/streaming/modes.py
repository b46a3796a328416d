"""Output modes of streaming plans (STR-22): the kind of a plan, and the modes it allows."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Legal output modes per kind of streaming plan. For keyed state the query's mode must be the
# function's own; Spark checks this for ``applyInPandasWithState`` and not for
# ``transformWithState``, where rows meant as changes would be read as final ones.
OUTPUT_MODES = {
    "stateless": {"append", "update"},
    "deduplicate": {"append", "update"},
    "aggregate": {"complete", "update"},
    "windowed_watermark": {"append", "update", "complete"},
    "sorted_aggregate": {"complete"},
    "sorted": set(),
    "limit": {"append"},
    "limited_aggregate": {"complete"},
    "stream_join": {"append"},
    "chained": {"append"},
    "state_append": {"append"},
    "state_update": {"update"},
}

_DEDUPLICATE = {"Deduplicate", "DeduplicateWithinWatermark"}
_LIMIT = {"GlobalLimit", "LocalLimit"}
_WATERMARK = "spark.watermarkDelayMs"


def check_output_mode(kind: str, mode: str) -> None:
    """Fail early with the rule instead of at ``start()``."""
    allowed = OUTPUT_MODES.get(kind)
    if allowed is None:
        raise ValueError(f"unknown plan kind {kind!r}; one of {sorted(OUTPUT_MODES)}")
    if mode not in allowed:
        raise ValueError(f"output mode {mode!r} is not allowed for a {kind} query; use one of {sorted(allowed)}")


def _streaming_nodes(plan) -> list:
    """(class name, node) of every node of the analysed plan that reads a stream, from the top."""
    if not plan.isStreaming():
        return []
    children = plan.children()
    below = [n for i in range(children.size()) for n in _streaming_nodes(children.apply(i))]
    return [(plan.getClass().getSimpleName(), plan), *below]


def _on_event_time(aggregate) -> bool:
    """Whether a grouping key carries a watermark, so that groups can be closed."""
    keys = aggregate.groupingExpressions()
    for i in range(keys.size()):
        columns = keys.apply(i).references().toSeq()
        if any(columns.apply(j).metadata().contains(_WATERMARK) for j in range(columns.size())):
            return True
    return False


def _joins_streams(node) -> bool:
    children = node.children()
    return all(children.apply(i).isStreaming() for i in range(children.size()))


def plan_kind(df: DataFrame) -> str:
    """The kind of ``df``'s analysed plan, a key of ``OUTPUT_MODES``."""
    if not df.isStreaming:
        raise ValueError("not a streaming plan")
    nodes = _streaming_nodes(df._jdf.queryExecution().analyzed())
    aggregates = [node for name, node in nodes if name == "Aggregate"]
    joins = [node for name, node in nodes if name == "Join" and _joins_streams(node)]
    states = [node for name, node in nodes if name.startswith(("FlatMapGroups", "TransformWithState"))]
    repeats = [node for name, node in nodes if name in _DEDUPLICATE]
    sorts = any(name == "Sort" for name, _ in nodes)
    limits = any(name in _LIMIT for name, _ in nodes)
    if len(aggregates) + len(joins) + len(states) + len(repeats) > 1:
        return "chained"
    if joins:
        return "stream_join"
    if states:
        return "state_" + states[0].outputMode().toString().lower()
    if aggregates:
        if limits:
            return "limited_aggregate"
        if sorts:
            return "sorted_aggregate"
        return "windowed_watermark" if _on_event_time(aggregates[0]) else "aggregate"
    if sorts:
        return "sorted"
    if limits:
        return "limit"
    return "deduplicate" if repeats else "stateless"
