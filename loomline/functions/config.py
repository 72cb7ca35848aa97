"""Settings: one YAML file for jobs and one for a domain, compiled to Columns. Paths: argument, environment, then the defaults here."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default domain.
MEDICAL_KEYWORDS = ("patient", "diagnosis", "treatment", "symptom", "medication", "dosage", "contraindication", "hypertension", "aspirin", "clinical", "guideline", "adverse", "efficacy")
EXAMPLE_LABELS = {"input": ("input", "case", "presentation", "patient history"), "structured": ("protocol", "treatment plan", "clinical plan"), "output": ("output", "result", "outcome")}
DATA_PREP = {"chunk_size": 800, "chunk_overlap": 150, "val_ratio": 0.15, "seed": 42}


def quoted(text: str) -> str:
    """text as a literal in a regular expression of both Java and RE2."""
    return re.sub(r"([^A-Za-z0-9_\s])", r"\\\1", text)


@dataclass(frozen=True)
class Domain:
    keywords: tuple[str, ...] = MEDICAL_KEYWORDS
    keyword_regex: str | None = None
    min_matches: int = 2
    function_pattern: str | None = None
    non_function_suffixes: tuple[str, ...] = ()
    labels: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(EXAMPLE_LABELS))
    alias_question: str = "What is {alias}?"
    domain_label: str = ""

    def structured(self, text: Column) -> Column:
        """Whether the text holds enough domain keywords."""
        if self.keyword_regex:
            pattern = "(?iu)" + self.keyword_regex
        elif self.keywords:
            pattern = r"(?iuU)\b(?:" + "|".join(map(quoted, self.keywords)) + r")\b"
        else:
            return F.lit(False)
        return F.coalesce(F.regexp_count(text, F.lit(pattern)) >= self.min_matches, F.lit(False))

    def named(self, text: Column) -> Column:
        """The first match of function_pattern's group that is long enough and ends in no excluded suffix, or null."""
        if not self.function_pattern:
            return F.lit(None).cast("string")
        found = F.regexp_extract_all(text, F.lit("(?i)" + self.function_pattern), F.lit(1))
        bad = "(?i)(?:" + "|".join(map(quoted, self.non_function_suffixes)) + ")$" if self.non_function_suffixes else None
        return F.try_element_at(F.filter(found, lambda x: (F.length(x) > 2) & (~x.rlike(bad) if bad else F.lit(True))), F.lit(1))

    def label_regex(self, kind: str) -> str:
        fallback = {"input": "input", "structured": "protocol", "output": "output"}[kind]
        inner = "|".join(re.sub(r" ", r"\\s+", quoted(x)) for x in (self.labels.get(kind) or (fallback,)))
        return r"^\s*(?:" + inner + r")\s*:?\s*$"


def load_yaml(path: str | Path) -> dict[str, Any]:
    import yaml

    data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}
    return data if isinstance(data, dict) else {}


def load_config(path: str | Path | None = None) -> dict[str, Any]:
    path = path or os.environ.get("LOOMLINE_CONFIG")
    given = load_yaml(path) if path else {}
    return {**given, "data_prep": {**DATA_PREP, **(given.get("data_prep") or {})}}


def section(config: dict[str, Any], name: str) -> dict[str, Any]:
    found = config.get(name)
    return found if isinstance(found, dict) else {}


def merged(config: dict[str, Any], **given: Any) -> dict[str, Any]:
    """Arguments that are given win over the file."""
    return {**config, **{k: v for k, v in given.items() if v is not None}}


def load_domain(path: str | Path | None = None) -> Domain:
    path = path or os.environ.get("LOOMLINE_DOMAIN_CONFIG")
    if not path:
        return Domain()
    data = load_yaml(path)
    ext, pat = section(data, "extraction"), section(data, "yaml_patterns")
    return Domain(
        tuple(map(str, ext.get("content_keywords") or ())), ext.get("content_keyword_regex"), int(ext.get("min_keyword_matches", 2)), ext.get("function_pattern"), tuple(map(str, ext.get("non_function_suffixes") or ())),
        {k: tuple(map(str, v or ())) for k, v in section(ext, "example_section_labels").items()}, str(pat.get("alias_question", "What is {alias}?")), str(pat.get("domain_label", "")),
    )
