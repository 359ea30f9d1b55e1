"""Plan inspection: the physical plan as text and the join operators it uses."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")


def plan_string(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints (``simple``, ``extended``, ``codegen``, ``cost``, ``formatted``).

    Under AQE this is the initial plan; after an action on the same DataFrame
    the adaptive plan shows its final form.
    """
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def join_operators(df: DataFrame) -> list[str]:
    """Physical join operators of the plan, outermost first (e.g. ``['SortMergeJoin Inner']``)."""
    tree = plan_string(df, "formatted").split("\n\n")[0]
    pat = "|".join(_JOINS)
    return [m.group(0).strip() for m in re.finditer(rf"({pat})( \w+)?", tree)]
