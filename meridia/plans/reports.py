"""Text reports built from result tables of a few rows: ``(line_no, text)`` tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row

RULE = "=" * 60


def as_lines(df: DataFrame, lines: Sequence[str]) -> DataFrame:
    """A report as a table, on the session of ``df``."""
    rows = [(i, text) for i, text in enumerate(lines)]
    return df.sparkSession.createDataFrame(rows, "line_no int, text string")


def plain_table(df: DataFrame, columns: Sequence[str], order: str | None = None) -> list[str]:
    """Aligned text of a result table."""
    rows = (df.orderBy(order) if order else df).select(*columns).collect()
    cells = [[c for c in columns]] + [["-" if v is None else str(v) for v in r] for r in rows]
    widths = [max(len(r[i]) for r in cells) for i in range(len(columns))]
    return ["  ".join(v.rjust(w) for v, w in zip(r, widths)) for r in cells]


def _report_block(rows: Sequence[Row]) -> list[str]:
    """Per-class scores at two places, in the usual fixed-width layout."""
    width = max(len("weighted avg"), *(len(r["entry"]) for r in rows))
    out = [" " * width + "  precision    recall  f1-score   support", ""]
    for r in sorted((r for r in rows if r["line"] == 0), key=lambda r: r["entry"]):
        out.append(f"{r['entry']:>{width}} {r['precision']:>10.2f}{r['recall']:>10.2f}{r['f1']:>10.2f}{r['support']:>10}")
    out.append("")
    for r in sorted((r for r in rows if r["line"] > 0), key=lambda r: r["line"]):
        if r["entry"] == "accuracy":
            out.append(f"{'accuracy':>{width}} {'':>10}{'':>10}{r['f1']:>10.2f}{r['support']:>10}")
        else:
            out.append(
                f"{r['entry']:>{width}} {r['precision']:>10.2f}{r['recall']:>10.2f}{r['f1']:>10.2f}{r['support']:>10}"
            )
    return out


def class_reports(report: DataFrame, headings: Mapping[str, Sequence[str]]) -> DataFrame:
    """One block per model: its heading lines, then precision, recall, F1 and support per class."""
    rows = report.collect()
    lines: list[str] = []
    for model, notes in headings.items():
        mine = [r for r in rows if r["model"] == model]
        lines += [RULE, model, *notes, RULE, *_report_block(mine), ""]
    return as_lines(report, lines)


def paired_scores_section(tests: DataFrame, reference: str) -> list[str]:
    """The signed-rank tests of one model against all others, and how many of them it wins."""
    won = sorted(r["model"] for r in tests.where("significant = 1").select("model").collect())
    said = f"{reference} scores higher than {', '.join(won)}." if won else f"{reference} beats no other model for sure."
    shown = ["model", "pairs", "used", "statistic", "p_value", "significant"]
    return [*plain_table(tests, shown, "model"), f"Fold scores of {reference} against each model, one-sided.", said]


def error_rates_section(test: DataFrame, first: str, second: str) -> list[str]:
    """The paired comparison of two models' errors on the same rows."""
    winner = {"first": first, "second": second}.get(test.first()["verdict"])
    said = f"{winner} makes fewer errors." if winner else "Their error rates can't be told apart."
    return [*plain_table(test, test.columns), f"{first} (first) and {second} (second) on the same rows.", said]


def preparation_report(nulls: DataFrame, balance: DataFrame, shape: Sequence[tuple[str, int]]) -> DataFrame:
    """What the preparation did: table sizes, missing values, class balance."""
    lines = ["# Preparation report", "", "## Tables"]
    lines += [f"- {name}: {rows} rows" for name, rows in shape]
    lines += ["", "## Missing values", "```text"]
    lines += plain_table(nulls, ["column_name", "null_count", "null_share"], "column_name")
    label = next(c for c in balance.columns if c not in ("stage", "row_count", "share"))
    lines += ["```", "", "## Class balance", "```text"]
    lines += plain_table(balance, ["stage", label, "row_count", "share"], "stage")
    return as_lines(nulls, [*lines, "```"])


def study_report(
    results: DataFrame,
    facts: Sequence[str],
    best: Row,
    sections: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Configuration, all model results, the best model, then any further sections."""
    shown = [c for c in results.columns if c not in ("place", "best_params", "row_count")]
    lines = ["# Study report", "", "## Configuration", *[f"- {f}" for f in facts], "", "## Results", "```text"]
    lines += plain_table(results, shown, "place")
    lines += ["```", "", "## Best model", f"**{best['model']}**"]
    lines += [f"- {m}: {best[m]}" for m in shown if m != "model"]
    lines += [f"- parameters: `{best['best_params']}`"]
    for title, body in sections.items():
        lines += ["", f"## {title}", "```text", *body, "```"]
    return as_lines(results, lines)
