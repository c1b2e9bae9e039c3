"""Settings. Environment variables are read when a configuration is made, not when the module is imported."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path


def _env(name: str, default, cast=str):
    return field(default_factory=lambda: cast(os.environ.get(name, default)))


def load_dotenv(path: str | Path) -> dict[str, str]:
    """KEY=VALUE lines of a file into the environment; comments and blanks are skipped, quotes stripped, what is set stays."""
    found: dict[str, str] = {}
    p = Path(path)
    for line in p.read_text(encoding="utf-8").splitlines() if p.exists() else ():
        key, eq, value = line.strip().partition("=")
        if eq and not key.startswith("#"):
            found[key.strip()] = value.strip().strip("\"'")
    for k, v in found.items():
        os.environ.setdefault(k, v)
    return found


@dataclass(frozen=True)
class ChunkConfig:
    size: int = _env("CHUNK_SIZE", 512, int)
    overlap: int = _env("CHUNK_OVERLAP", 100, int)
    #: Shorter chunks are dropped, in characters; 0 keeps all.
    min_chunk: int = 80


@dataclass(frozen=True)
class EmbeddingConfig:
    backend: str = _env("EMBED_BACKEND", "tfidf")
    model_name: str = _env("EMBED_MODEL", "")
    dim: int = _env("EMBED_DIM", 1024, int)
    max_features: int = 200_000
    #: Components of the latent space, `dim` if None.
    components: int | None = None
    query_instruction: str = _env("EMBED_QUERY_INSTRUCTION", "")
    normalize: bool = True
    batch_size: int = 32
    #: Options of a plugged-in backend (key, address, device ...).
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class CrawlConfig:
    delay: float = _env("CRAWL_DELAY", 1.0, float)
    timeout: int = _env("CRAWL_TIMEOUT", 25, int)
    max_retries: int = 2
    #: Pages of a site in one run; 0 is no cap.
    max_pages: int = _env("CRAWL_MAX_PAGES", 15, int)
    user_agent: str = "loomtext/1.0 (+https://example.org/loomtext)"
    accept_language: str = "zh-CN,zh;q=0.9,en;q=0.8"
    respect_robots: bool = True


@dataclass(frozen=True)
class Config:
    warehouse: str = _env("LOOMTEXT_WAREHOUSE", "warehouse")
    chunk: ChunkConfig = field(default_factory=ChunkConfig)
    embedding: EmbeddingConfig = field(default_factory=EmbeddingConfig)
    crawl: CrawlConfig = field(default_factory=CrawlConfig)
    #: Documents whose cleaned text is shorter are skipped, in characters.
    min_text: int = 120
