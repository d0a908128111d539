"""The QC table as text or a self-contained HTML page; sections are a few hundred rows at most."""

from __future__ import annotations

import html
import json
import re
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import figures


def _sections(qc: DataFrame) -> list[tuple[tuple[str, str], list]]:
    rows = qc.orderBy("step", "section", "ord").collect()
    return [(k, list(g)) for k, g in groupby(rows, key=lambda r: (r["step"], r["section"]))]


def as_text(qc: DataFrame) -> str:
    blocks = ["\n".join([f"# {step}: {section}", *(f"{r['key']}\t{r['value']}" for r in rows)]) for (step, section), rows in _sections(qc)]
    return "\n\n".join(blocks) + "\n"


def _bar(rows: list) -> str:
    """Numeric values of a section as horizontal bars."""
    pairs = [(r["key"], float(r["value"])) for r in rows if (r["value"] or "").replace(".", "", 1).isdigit()]
    top = max((v for _, v in pairs), default=0)
    if not top:
        return ""
    lines = [f'<text x="0" y="{18 * i + 13}">{html.escape(k)}</text><rect x="160" y="{18 * i + 3}" width="{300 * v / top:.1f}" height="12"/>' for i, (k, v) in enumerate(pairs)]
    return f'<svg width="480" height="{18 * len(pairs)}" font-size="12">{"".join(lines)}</svg>'


def as_html(qc: DataFrame, title: str = "Quality control") -> str:
    body = []
    for (step, section), rows in _sections(qc):
        cells = "".join(f"<tr><td>{html.escape(r['key'])}</td><td>{html.escape(r['value'] or '')}</td></tr>" for r in rows)
        body.append(f"<h2>{html.escape(step)}: {html.escape(section)}</h2><table>{cells}</table>{_bar(rows)}")
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{''.join(body)}"


def environment(spark) -> list[tuple[str, str]]:
    import platform

    return [("spark", spark.version), ("python", platform.python_version()), ("master", spark.sparkContext.master)]


def as_json(qc: DataFrame) -> str:
    """All sections as one JSON object: step, section, and keys with their values."""
    out: dict = {}
    for (step, section), rows in _sections(qc):
        out.setdefault(step, {})[section] = {r["key"]: r["value"] for r in rows}
    return json.dumps(out, indent=1)


def load_svg(spark: SparkSession, path: str) -> str:
    """A figure's file from its ``<svg`` on, to be put into a page."""
    body = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    at = body.find("<svg")
    if at < 0:
        raise ValueError(f"{path} holds no figure")
    return body[at:]


def load_chromosome_svgs(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(name, figure) of a folder's ``name.svg`` files, numbered chromosomes first and in order, then the others by name."""
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter="*.svg").select(F.col("_metadata.file_name").alias("n"), "value").collect()
    found = [(r["n"].removesuffix(".svg"), r["value"][max(0, r["value"].find("<svg")) :]) for r in rows]

    def place(name: str):
        number = re.fullmatch(r"(?:chr)?(\d+)", name)
        return (0, int(number[1]), name) if number else (1, 0, name)

    return sorted(found, key=lambda x: place(x[0]))


def _rows(df: DataFrame) -> str:
    """A small table as HTML; shares as per cent."""

    def cell(name, v):
        if v is None:
            return "NA"
        return f"{100 * v:.2f} %" if name in ("ratio", "share") else html.escape(str(v))

    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns if c != "ord")
    rows = "".join("<tr>" + "".join(f"<td>{cell(c, r[c])}</td>" for c in df.columns if c != "ord") + "</tr>" for r in df.collect())
    return f"<table><tr>{head}</tr>{rows}</table>"


def whole_report(run, chromosomes: list[str], durations: DataFrame | None = None, maps: list[tuple[str, str]] = (), title: str = "Quality control") -> str:
    """One self-contained page of a run: funnel, trimming, alignment, noise, contacts and spans, with figures, then all sections as they are."""
    t = run.tables
    pairs = lambda df, k, v: [(str(r[k]), float(r[v] or 0)) for r in df.collect()]
    parts = [("Read funnel", _rows(t["funnel"].orderBy("ord")) + figures.bars(pairs(t["funnel"].orderBy("ord"), "step", "count"), "reads and contacts by step"))]
    lengths = t["lengths"].withColumn("label", F.concat_ws(" ", F.lit("tag"), "pet", F.lit(":"), "length"))
    parts.append(("Trimming", figures.bars(pairs(lengths.orderBy("pet", "length").limit(14), "label", "count"), "lengths of tags") + _rows(t["scores"].limit(40))))
    rounds = "".join(f"<p>{html.escape(end)}: " + "; ".join(f"round {i + 1}: " + ", ".join(f"{html.escape(c)} {n}" for c, n in sorted(x.items())) for i, x in enumerate(now)) + "</p>" for end, now in sorted(run.rounds.items()))
    parts.append(("Alignment", _rows(t["alignment"]) + rounds))
    parts.append(("Noise", figures.pie(pairs(t["types"].orderBy("type"), "type", "count"), "classes of contacts") + _rows(t["cells"].orderBy("strand1", "strand2", "side1", "side2"))))
    parts.append(("Contacts", figures.pie(pairs(t["long_short"].orderBy("part"), "part", "count"), "within and across chromosomes") + figures.heat_map(t["chromosomes"], chromosomes, "contacts between chromosomes")))
    parts.append(("Spans", figures.scatter(t["spans"], "x", "y", "contacts by span (log10)")))
    if maps:
        parts.append(("Maps", "".join(f"<h3>{html.escape(n)}</h3>{svg}" for n, svg in maps)))
    if durations is not None:
        parts.append(("Times", _rows(durations)))
    body = "".join(f"<section><h2>{html.escape(n)}</h2>{x}</section>" for n, x in parts)
    listed = re.sub(r"^.*?</h1>", "", as_html(run.qc), flags=re.S)
    system = "".join(f"<tr><td>{html.escape(k)}</td><td>{html.escape(v)}</td></tr>" for k, v in environment(run.qc.sparkSession))
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{body}<section><h2>All counters</h2>{listed}</section><section><h2>Environment</h2><table>{system}</table></section>"
