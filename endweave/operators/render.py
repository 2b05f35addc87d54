"""Reports from small tables: Markdown and HTML, as text."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame


def rows_of(df: DataFrame, limit: int) -> tuple[list[str], list[list[str]]]:
    """Column names and the first rows as text; a report shows extracts, not tables."""
    shown = df.limit(limit).collect()
    return df.columns, [["NA" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r] for r in shown]


def markdown(title: str, tables: dict[str, DataFrame], limit: int = 100) -> str:
    parts = [f"# {title}"]
    for name, df in tables.items():
        names, rows = rows_of(df, limit)
        cell = lambda v: v.replace("|", "\\|")
        parts.append(f"## {name}\n\n| " + " | ".join(names) + " |\n|" + "---|" * len(names) + "\n" + "\n".join("| " + " | ".join(map(cell, r)) + " |" for r in rows))
    return "\n\n".join(parts) + "\n"


def page(title: str, tables: dict[str, DataFrame], limit: int = 100) -> str:
    """A self-contained page with a filter over the rows of all its tables."""
    body = []
    for name, df in tables.items():
        names, rows = rows_of(df, limit)
        head = "".join(f"<th>{html.escape(n)}</th>" for n in names)
        lines = "".join("<tr>" + "".join(f"<td>{html.escape(v)}</td>" for v in r) + "</tr>" for r in rows)
        body.append(f"<section><h2>{html.escape(name)}</h2><table><thead><tr>{head}</tr></thead><tbody>{lines}</tbody></table></section>")
    script = "f.oninput=()=>{for(const r of document.querySelectorAll('tbody tr'))r.hidden=!r.textContent.includes(f.value)}"
    return (
        f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"
        f'<input id=f placeholder="filter rows">{"".join(body)}<script>{script}</script>'
    )


def igv_session(paths: list[str], genome: str | None = None) -> str:
    """A genome browser's session that loads the files, in the order given."""
    load = "\n".join(f'    <Resource path="{html.escape(p)}"/>' for p in paths)
    chosen = f' genome="{html.escape(genome)}"' if genome else ""
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<Session{chosen} version="8">\n  <Resources>\n{load}\n  </Resources>\n</Session>\n'
