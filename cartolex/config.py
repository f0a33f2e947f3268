"""Settings of the engine; every operator takes what it needs from here or as an argument."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class EngineConfig:
    """Sizes are in tokens of about four characters; ``as_of_year`` stands in for years that texts lack (0: this year)."""

    chunk_size: int = 512
    chunk_overlap: int = 50
    lines_per_page: int = 50
    as_of_year: int = 0
    pdf_dir: str = "downloaded_pdfs"
    embed_scope: str = "all"
    canonical: str = "reference"
    embedding_dim: int = 1536
    embedding_batch: int = 500
    max_concurrent: int = 10

    def __post_init__(self) -> None:
        if self.chunk_overlap < 1 or self.chunk_size < 1:
            raise ValueError("chunk size and overlap must be 1 or more")
        if self.embed_scope not in ("all", "root") or self.canonical not in ("reference", "strict"):
            raise ValueError("unknown embed_scope or canonical mode")

    @classmethod
    def from_env(cls, prefix: str = "CARTOLEX_") -> EngineConfig:
        """Defaults, overridden by environment variables such as CARTOLEX_CHUNK_SIZE."""
        given = {f.name: os.environ[prefix + f.name.upper()] for f in fields(cls) if prefix + f.name.upper() in os.environ}
        return cls(**{k: int(v) if isinstance(getattr(cls, k), int) else v for k, v in given.items()})
