"""Settings from the environment, and the log."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, fields
from typing import get_type_hints


def as_bool(text: str) -> bool:
    return text.strip().lower() in ("1", "true", "yes", "y", "on")


@dataclass(frozen=True)
class Settings:
    """Each field is read from FOLIANT_ and its name in capitals."""

    embedding_model: str = "hash"
    embedding_dimensions: int = 64
    embedding_batch_size: int = 64
    metadata_sample_pages: int = 20
    auto_metadata: bool = True
    chunk_max_tokens: int = 750
    chunk_overlap_tokens: int = 120
    reindex_existing: bool = False
    export_json: bool = False
    json_output_dir: str = "exports"
    log_level: str = "INFO"
    log_page_text: bool = False
    log_page_text_max_chars: int = 12_000
    ocr_sample_pages: int = 25

    @classmethod
    def load(cls, env: dict[str, str] | None = None) -> Settings:
        """A value that can't be read is an error that names it; blank ones count as missing."""
        env = dict(os.environ if env is None else env)
        kinds, held = get_type_hints(cls), {}
        for f in fields(cls):
            raw = env.get(f"FOLIANT_{f.name.upper()}", "").strip()
            if raw:
                try:
                    held[f.name] = as_bool(raw) if kinds[f.name] is bool else kinds[f.name](raw)
                except ValueError:
                    raise ValueError(f"FOLIANT_{f.name.upper()} must be a {kinds[f.name].__name__}") from None
        return cls(**held)

    def check_embedder(self, name: str, dimensions: int) -> None:
        """An embedder must be the one that the vectors are made for."""
        if (name, dimensions) != (self.embedding_model, self.embedding_dimensions):
            raise ValueError(f"the vectors are of {self.embedding_model} with {self.embedding_dimensions} dimensions, not of {name} with {dimensions}")


def configure_logging(level: str = "INFO") -> None:
    logging.basicConfig(level=level.upper(), format="%(asctime)s %(levelname)s %(name)s %(message)s", force=True)


def log_pages(pages, limit: int, most_chars: int = 12_000, log: logging.Logger | None = None) -> None:
    """Log the first pages by book and number, each cut at most_chars, with its structure where it has one."""
    log = log or logging.getLogger("foliant.pages")
    for r in pages.orderBy("document_id", "page_number").limit(limit).toLocalIterator():
        row = r.asDict()
        at = " / ".join(str(v) for k in ("chapter_title", "section_title") if (v := row.get(k)))
        text = row.get("raw_text") or ""
        log.info("%s page %s%s: %s%s", r.document_id, r.page_number, f" ({at})" if at else "", text[:most_chars], f" [{len(text) - most_chars} more]" if len(text) > most_chars else "")
