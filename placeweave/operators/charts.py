"""SVG charts: communities, the pair funnel and the flow of merchants, transactions and pairs."""

from __future__ import annotations

import math
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.text import display_units, safe_file_name
from .report import funnel

INK, MEMBER, ANCHOR, LOSS = "#333333", "#5b8db8", "#d1793b", "#c9c9c9"


def clipped(text: str, units: int) -> str:
    """At most so many units wide, with … where something is cut."""
    if display_units(text) <= units:
        return text
    out = ""
    for ch in text:
        if display_units(out + ch) > units - 1:
            break
        out += ch
    return out + "…"


def community_svg(community: str, members: list[tuple[str, bool]]) -> str:
    """Members on circles around the middle; anchors as diamonds, first."""
    members = sorted(members, key=lambda m: (not m[1], m[0]))
    parts, side, done, ring = [], 0.0, 0, 1
    while done < len(members):
        room = max(6, ring * 10)
        for k, (name, anchor) in enumerate(members[done : done + room]):
            angle = 2 * math.pi * k / min(room, len(members) - done) - math.pi / 2
            x, y = 90 * ring * math.cos(angle), 90 * ring * math.sin(angle)
            shape = f'<path d="M{x:.1f} {y - 9:.1f}l9 9l-9 9l-9 -9z" fill="{ANCHOR}"/>' if anchor else f'<circle cx="{x:.1f}" cy="{y:.1f}" r="7" fill="{MEMBER}"/>'
            parts.append(f'{shape}<text x="{x:.1f}" y="{y + 20:.1f}" font-size="9" text-anchor="middle" fill="{INK}">{escape(clipped(name, 16))}</text>')
        done += room
        side = 90 * ring + 60
        ring += 1
    title = f'<text x="0" y="4" font-size="13" text-anchor="middle" fill="{INK}">{escape(clipped(community, 20))}</text>'
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="{-side:.0f} {-side:.0f} {2 * side:.0f} {2 * side:.0f}">{title}{"".join(parts)}</svg>'


def community_charts(merchants: DataFrame) -> DataFrame:
    """community_id, file, svg: a chart for each community (merchant_id, community_id, is_anchor_candidate)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        c = str(pdf["community_id"].iloc[0])
        svg = community_svg(c, list(zip(pdf["merchant_id"].astype(str), pdf["is_anchor_candidate"].astype(str).isin(["1", "True"]), strict=True)))
        return pd.DataFrame({"community_id": [c], "file": [f"community_{safe_file_name(c)}.svg"], "svg": [svg]})

    cols = merchants.selectExpr("cast(community_id as string) community_id", "merchant_id", "is_anchor_candidate")
    return cols.groupBy("community_id").applyInPandas(run, "community_id string, file string, svg string")


def funnel_svg(panels: list[tuple[str, list[tuple[str, int]]]]) -> str:
    """One column of bars a panel, each bar as wide as its share of the first."""
    out = []
    for p, (title, counts) in enumerate(panels):
        steps = funnel(counts)
        top = max(steps[0]["count"], 1)
        x = 40 + 320 * p
        out.append(f'<text x="{x + 130}" y="24" font-size="14" text-anchor="middle" fill="{INK}">{escape(title)}</text>')
        for k, s in enumerate(steps):
            w = max(2.0, 260 * s["count"] / top)
            y = 44 + 56 * k
            out.append(f'<rect x="{x + 130 - w / 2:.1f}" y="{y}" width="{w:.1f}" height="34" fill="{MEMBER}"/><text x="{x + 130}" y="{y + 48}" font-size="10" text-anchor="middle" fill="{INK}">{escape(s["step"])}: {s["count"]:,} ({s["retention_pct"]:g} %)</text>')
    height = 80 + 56 * max((len(c) for _, c in panels), default=0)
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {40 + 320 * len(panels)} {height}">{"".join(out)}</svg>'


def flow_svg(flows: list[tuple[str, list[tuple[str, int]]]]) -> str:
    """Each row a chain of nested counts; what is lost at a step leaves downwards."""
    out = []
    for row, (title, counts) in enumerate(flows):
        steps = funnel(counts)
        top, y0 = max(steps[0]["count"], 1), 40 + 180 * row
        out.append(f'<text x="10" y="{y0 - 12}" font-size="13" fill="{INK}">{escape(title)}</text>')
        for k, s in enumerate(steps):
            h, x = max(2.0, 100 * s["count"] / top), 10 + 190 * k
            out.append(f'<rect x="{x}" y="{y0}" width="16" height="{h:.1f}" fill="{ANCHOR}"/><text x="{x}" y="{y0 + 122}" font-size="10" fill="{INK}">{escape(s["step"])} {s["count"]:,}</text>')
            if k + 1 < len(steps):
                n = max(1.0, 100 * steps[k + 1]["count"] / top)
                out.append(f'<path d="M{x + 16} {y0}H{x + 190}V{y0 + n:.1f}H{x + 16}z" fill="{MEMBER}" opacity="0.5"/>')
                if h - n > 1:
                    out.append(f'<path d="M{x + 16} {y0 + n:.1f}h60v{h - n:.1f}h-60z" fill="{LOSS}" opacity="0.7"/>')
    width = 40 + 190 * max((len(c) for _, c in flows), default=1)
    return f'<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 {width} {40 + 180 * len(flows)}">{"".join(out)}</svg>'
