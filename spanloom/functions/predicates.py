"""Which spans a metric applies to, as Columns, and what the catalog knows of each test."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Span types under their scope, deepest last; the rest are components.
_SCOPE_OF = {"solution": "solution", "workflow": "workflow", "agent": "agent"}
_UPWARD = ("component", "agent", "workflow", "endpoint", "solution")


@dataclass(frozen=True)
class Predicate:
    """types: span types that pass (empty: all). scopes: overrides what follows from them. test: overrides the type test."""

    name: str
    types: tuple[str, ...] = ()
    scopes: tuple[str, ...] = ()
    test: Callable[[], Column] | None = None

    def column(self) -> Column:
        if self.test is not None:
            return self.test()
        return F.lit(True) if not self.types else F.coalesce(F.col("span_type").isin(*self.types), F.lit(False))

    def applicable_scopes(self) -> tuple[str, ...]:
        """From the deepest scope of its span types up to the solution; all for no types."""
        if self.scopes:
            return self.scopes
        if not self.types:
            return _UPWARD
        deepest = min(_UPWARD.index(_SCOPE_OF.get(kind, "component")) for kind in self.types)
        return _UPWARD[deepest:]


def _levels() -> Column:
    return F.col("scope").isin("solution", "endpoint", "workflow", "agent") | F.col("span_type").isin("solution", "workflow", "agent")


# The tests and the span types that pass them.
ALL = {
    p.name: p
    for p in (
        Predicate("any_span"),
        Predicate("llm_call", ("model_call",)),
        Predicate("queued_op", ("agent", "workflow")),
        Predicate("orchestrated", ("workflow",)),
        Predicate("retryable", ("model_call", "tool_call", "retrieval", "embedding", "validation", "agent")),
        Predicate("rate_limited", ("model_call", "tool_call")),
        Predicate("batch_op", ("validation", "skill_exec")),
        Predicate("levels", ("solution", "workflow", "agent"), ("agent", "workflow", "endpoint", "solution"), _levels),
        Predicate("sol_wf", ("solution", "workflow")),
        Predicate("billable", ("model_call", "embedding", "tool_call", "retrieval")),
        Predicate("cost_embedding", ("embedding",)),
        Predicate("cost_tool", ("tool_call",)),
        Predicate("cost_kb", ("retrieval",)),
        Predicate("solution_only", ("solution",)),
        Predicate("retrieval_op", ("retrieval",)),
        Predicate("tool_op", ("tool_call",)),
        Predicate("validated_op", ("validation",)),
        Predicate("data_op", ("validation", "skill_exec")),
        Predicate("output_bearing", ("model_call", "tool_call", "validation")),
        Predicate("schema_checked", ("model_call", "validation")),
    )
}
