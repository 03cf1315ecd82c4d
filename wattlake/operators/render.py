"""Small result frames as text: reports of a few rows, rendered on the driver. The limit on rows is the feature of a report."""

from __future__ import annotations

import json
import textwrap

from pyspark.sql import DataFrame


def _cell(v: object) -> str:
    text = "" if v is None else f"{v:.2f}" if isinstance(v, float) else str(v)
    return text.replace("|", "\\|").replace("\n", " ")


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """The first ``most`` rows as a Markdown table; bars and line breaks in cells are escaped."""
    rows = [[_cell(v) for v in r] for r in df.limit(most).collect()]
    return "\n".join(["| " + " | ".join(r) + " |" for r in [df.columns, ["---"] * len(df.columns), *rows]])


def json_report(parts: dict[str, DataFrame], most: int = 1000) -> str:
    """Several frames as one JSON object of lists."""
    return json.dumps({k: [json.loads(x) for x in d.limit(most).toJSON().collect()] for k, d in parts.items()}, ensure_ascii=False)


def wrapped(text: str, width: int) -> list[str]:
    """Lines of at most ``width`` characters, words whole unless they alone are longer."""
    return textwrap.wrap(text, width) or [""]


def page_ranges(ranges: list[tuple[int, int]]) -> str:
    return ", ".join(str(a) if a == b else f"{a}-{b}" for a, b in ranges)
