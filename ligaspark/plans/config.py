"""Typed configuration of a run, from INI text; values are Python literals and never evaluated."""

from __future__ import annotations

import ast
import configparser
import os
import re
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession


@dataclass
class Config:
    """What a whole run needs. Required fields have no default that works."""

    fastq: str = ""
    sites: str = ""
    aligner: str = ""
    restriction_site: str = "T^TAA"
    chromosomes: str = "hg19"
    linker_a: str = ""
    linker_b: str = ""
    linkers: list = field(default_factory=list)
    mismatch: float = 0.3
    adapter: str = "auto"
    mismatch_adapter: float = 0.3
    adapter_reads: int = 1000
    adapter_start: int = 70
    adapter_threshold: float = 0.75
    shortest: int = 10
    longest: int = 22
    cut_len: int = 20
    mapq: int = 20
    iterations: int = 7
    threshold_span: int = -1
    long_range: int = 5000
    dedup: str = "etag"
    resolutions: list = field(default_factory=lambda: [2_500_000, 1_000_000, 500_000, 250_000, 100_000, 50_000, 25_000, 10_000, 5_000])
    balance: bool = False
    hic: bool = False
    report: str = "html"


def parse_ini(text: str) -> dict[str, dict[str, object]]:
    """Sections of typed values; what is no literal stays text, an empty value is None, and `` ;`` or `` #`` begins a comment."""
    parser = configparser.ConfigParser(interpolation=None, inline_comment_prefixes=(";", "#"))
    parser.optionxform = str
    parser.read_string(text)
    out: dict[str, dict[str, object]] = {}
    for section in parser.sections():
        out[section] = {}
        for key, value in parser.items(section):
            try:
                out[section][key] = ast.literal_eval(value) if value else None
            except (ValueError, SyntaxError):
                out[section][key] = value
    return out


def load(text: str) -> Config:
    """All sections' fields that a run knows; unknown ones are an error, as is a value of the wrong kind."""
    known = {f.name: f for f in fields(Config)}
    cfg = Config()
    for section, values in parse_ini(text).items():
        for key, value in values.items():
            if key not in known:
                raise ValueError(f"[{section}] {key} is no setting")
            now = getattr(cfg, key)
            if value is not None and not isinstance(value, type(now)) and not (isinstance(now, float) and isinstance(value, int)) and not (isinstance(now, list) and isinstance(value, tuple)):
                raise ValueError(f"[{section}] {key} = {value!r}: a {type(now).__name__} is wanted")
            if value is not None:
                setattr(cfg, key, list(value) if isinstance(value, tuple) else value)
    return cfg


def required(cfg: Config, *names: str) -> None:
    if missing := [n for n in names if not getattr(cfg, n)]:
        raise ValueError("not set: " + ", ".join(missing))


def sample_id(path: str) -> str:
    """File name without folders and the suffixes of FASTQ files."""
    return re.sub(r"\.(fq|fastq)(\.gz)?$", "", os.path.basename(path))


def find_samples(spark: SparkSession, pattern: str) -> dict[str, str]:
    """{sample: path} of the FASTQ files that a glob matches, in any store."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(path) or []
    paths = sorted(str(f.getPath().toString()) for f in found)
    return {sample_id(p): p for p in paths if re.search(r"\.(fq|fastq)(\.gz)?$", p)}
