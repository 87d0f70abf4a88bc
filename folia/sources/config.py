"""Settings from a KEY=VALUE file or the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path


class PipelineError(Exception):
    """An error of a named step, shown as ``[step] message``."""

    def __init__(self, message: str, step: str | None = None, details: dict | None = None):
        super().__init__(message)
        self.message, self.step, self.details = message, step, details or {}

    def __str__(self) -> str:
        return f"[{self.step}] {self.message}" if self.step else self.message


class LayoutParsingError(PipelineError):
    pass


class TextExtractionError(PipelineError):
    pass


class VLMProcessingError(PipelineError):
    pass


class HierarchyParsingError(PipelineError):
    pass


class SectionExportError(PipelineError):
    pass


class ConfigError(PipelineError):
    pass


def read_env_file(path: str | Path) -> dict[str, str]:
    """KEY=VALUE lines; blank lines and ``#`` comments are left out, quotes around a value are dropped."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8-sig").splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            key, value = (x.strip() for x in line.split("=", 1))
            if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
                value = value[1:-1]
            out[key] = value
    return out


@dataclass
class Config:
    """Settings of the document pipeline; ``KEYS`` are their names in a file or the environment."""

    input_path: str = "work.pdf"
    output_path: str = "output"
    max_workers: int = 5
    use_vlm: bool = True
    vlm_api_base: str = "http://localhost:8888/v1"
    vlm_api_key: str = "optional-api-key-here"
    vlm_batch_size: int = 10
    log_level: str = "INFO"
    log_format: str = "%(asctime)s - %(name)s - %(levelname)s - %(message)s"
    doc_type: str = "insurance"
    hierarchy_file: str = "document_hierarchy.json"
    references_file: str = "document_hierarchy_references.json"
    export_dir: str = "neo4j_export"
    vlm_prompts: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path | None = None) -> Config:
        """From the environment, whose place the values of a file take where there is one."""
        values = {**os.environ, **(read_env_file(path) if path and Path(path).is_file() else {})}
        made = cls()
        for name, keys in KEYS.items():
            key = next((k for k in keys if k in values), None)
            if key is None:
                continue
            kind = type(getattr(made, name))
            try:
                value = values[key].strip().lower() in ("1", "true", "yes") if kind is bool else kind(values[key])
            except ValueError as e:
                raise ConfigError(f"{key}: {e}", "config") from e
            setattr(made, name, value)
        return made


#: The names of each setting, the first of them counts.
KEYS = {
    "input_path": ["INPUT_PATH"],
    "output_path": ["OUT_DIR", "OUTPUT_PATH"],
    "max_workers": ["MAX_WORKERS"],
    "use_vlm": ["ENABLE_VLM_PROCESSING", "USE_VLM"],
    "vlm_api_base": ["VLM_API_BASE"],
    "vlm_api_key": ["VLM_API_KEY"],
    "vlm_batch_size": ["VLM_BATCH_SIZE"],
    "log_level": ["LOG_LEVEL"],
    "log_format": ["LOG_FORMAT"],
    "doc_type": ["DOC_TYPE"],
    "hierarchy_file": ["OUTPUT_HIERARCHY_FILE"],
    "references_file": ["OUTPUT_REFERENCES_FILE"],
    "export_dir": ["OUTPUT_NEO4J_EXPORT_DIR"],
}


def parse_steps(text: str) -> set[int]:
    """Numbers and inclusive ranges, comma-separated: ``3-5,6``."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        lo, _, hi = part.partition("-")
        out |= set(range(int(lo), int(hi or lo) + 1))
    return out
