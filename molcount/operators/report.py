"""Results as one HTML page with a bar chart, from small result tables on the driver."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame


def bars(values: list[tuple[str, float]], width: int = 480, step: int = 24) -> str:
    """An SVG bar chart of named values."""
    most = max((v for _, v in values), default=0) or 1
    rows = []
    for i, (name, v) in enumerate(values):
        y = i * step
        rows.append(f'<text x="0" y="{y + 15}" font-size="12">{html.escape(name)}</text><rect x="160" y="{y + 4}" width="{(width - 240) * v / most:.1f}" height="{step - 8}" fill="#4477aa"/><text x="{165 + (width - 240) * v / most:.1f}" y="{y + 15}" font-size="12">{v:.4g}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{step * len(values) + 4}">{"".join(rows)}</svg>'


COLOURS = ("#4477aa", "#ee6677", "#228833", "#ccbb44", "#66ccee", "#aa3377", "#bbbbbb", "#000000", "#997700", "#004488")


def curves(rows: list[tuple[int, int, int]], width: int = 640, height: int = 400) -> str:
    """An SVG line chart of (series, x, y), a line for each series; both axes begin at 0."""
    left, foot = 70, 40
    far, most = max((x for _, x, _ in rows), default=1) or 1, max((y for *_, y in rows), default=1) or 1
    at = lambda x, y: f"{left + (width - left - 120) * x / far:.1f},{(height - foot) * (1 - y / most) + 10:.1f}"
    out = [f'<polyline points="{at(0, most)} {at(0, 0)} {at(far, 0)}" fill="none" stroke="#333"/>', f'<text x="4" y="16" font-size="12">{most}</text><text x="4" y="{height - foot + 10}" font-size="12">0</text><text x="{width / 2:.0f}" y="{height - 6}" font-size="12">share of the reads, in {far} parts</text>']
    for i, name in enumerate(dict.fromkeys(r[0] for r in rows)):
        colour = COLOURS[i % len(COLOURS)]
        out.append(f'<polyline points="{" ".join(at(x, y) for s, x, y in rows if s == name)}" fill="none" stroke="{colour}" stroke-width="2"/><text x="{width - 110}" y="{20 + 16 * i}" font-size="12" fill="{colour}">families of {html.escape(str(name))} or more</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}">{"".join(out)}</svg>'


def page(title: str, tracked: DataFrame, most: int = 1000) -> str:
    """Tracked mutations (name, contig, position, ref, alt, coverage, alt_reads, vaf) as a table and a chart; a report lists ``most`` rows."""
    rows = tracked.orderBy("contig", "position", "name").limit(most).collect()
    cells = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
    head = "".join(f"<th>{html.escape(c)}</th>" for c in tracked.columns)
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{bars([(r['name'], r['vaf']) for r in rows])}<table><tr>{head}</tr>{cells}</table></body></html>"
