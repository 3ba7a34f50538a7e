"""Markdown reports from the aggregate frames.

Only finished aggregates reach the driver: rows per source, label and split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from presswork.schemas import SPLITS


def markdown_table(headers: Sequence[str], rows: Sequence[Sequence[object]]) -> str:
    body = [list(headers), ["---"] * len(headers), *[list(r) for r in rows]]
    return "\n".join("| " + " | ".join(str(cell) for cell in row) + " |" for row in body)


def percent(value: float) -> str:
    return f"{value:.0%}"


def _whole(n: float) -> str:
    return str(int(n)) if n == int(n) else str(n)


def data_card(stats: DataFrame, crosstab: DataFrame, generated_on: str = "") -> str:
    """Data card of a split dataset."""
    metrics: dict[str, list[tuple[str | None, float]]] = {}
    for row in stats.collect():
        metrics.setdefault(row["metric"], []).append((row["value"], row["n"]))

    def listed(metric: str) -> list[tuple[str | None, str]]:
        entries = sorted(metrics.get(metric, []), key=lambda e: str(e[0]))
        return [(value, _whole(n)) for value, n in entries]

    def single(metric: str, key: str | None = None) -> str:
        return dict(listed(metric)).get(key, "0")

    cells = {(r["split"], None if r["is_total"] else r["source"]): r["n"] for r in crosstab.collect()}
    sources = [value for value, _ in listed("by_source")]
    split_rows = [
        [split, *[cells.get((split, s), 0) for s in sources], cells.get((split, None), 0)]
        for split in SPLITS
    ]
    languages = ", ".join(f"{value} ({n})" for value, n in listed("by_language"))
    sizes = " / ".join(single("content_length", m) for m in ("min", "median", "mean", "max"))
    dated = f" ({generated_on})" if generated_on else ""
    return "\n\n".join(
        [
            f"# Data card{dated}",
            "This file is generated from the dataset; edits are lost on the next run.",
            "\n".join(
                [
                    f"- Records: {single('total')}",
                    f"- Languages: {languages}",
                    f"- Contents that occur more than once: {single('duplicate_content_groups')}",
                    f"- With image: {single('has_image', 'true')}",
                    f"- Text only: {single('has_image', 'false')}",
                    f"- Content length, min / median / mean / max characters: {sizes}",
                ]
            ),
            "## Sources",
            markdown_table(["Source", "Records"], listed("by_source")),
            "## Labels",
            markdown_table(["Label", "Records"], listed("by_label")),
            "A `null` label marks a nuanced verdict; the original wording is in `label_detail`.",
            "## Splits",
            markdown_table(["Split", *sources, "Total"], split_rows),
            "Splits are deterministic for a seed, stratified by source and label, and keep equal "
            "contents together.",
        ]
    )


def kpi_report(kpis: dict[str, DataFrame]) -> str:
    """Indicator report of a run."""
    rejection = [
        [r["source"], r["raw"], r["valid"], r["rejected"], percent(r["rate"])]
        for r in kpis["rejection"].orderBy("source").collect()
    ]
    labels = [
        f"{r['value']} {_whole(r['n'])}"
        for r in kpis["stats"].where("metric = 'by_label'").orderBy("value").collect()
    ]
    coverage = kpis["image_coverage"].first()
    sizes = {r["split"]: r["n"] for r in kpis["split_sizes"].collect()}
    return "\n\n".join(
        [
            "# Indicator report",
            "## Volume and rejection by source",
            markdown_table(["Source", "Raw", "Valid", "Rejected", "Rejection"], rejection),
            "## Dataset",
            "\n".join(
                [
                    f"- Records: {coverage['total']}",
                    f"- Labels: {', '.join(labels)}",
                    f"- Image coverage: {percent(coverage['coverage'])} "
                    f"({coverage['with_image']}/{coverage['total']})",
                    "- Splits: " + ", ".join(f"{s} {sizes.get(s, 0)}" for s in SPLITS),
                    f"- Contents in more than one split: {kpis['leakage'].first()['leakage']}",
                ]
            ),
        ]
    )
