"""Typed settings of each stage, checked when they are made."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class CrawlConfig:
    max_depth: int = 2
    max_pages: int = 50_000
    min_chars: int = 100
    min_lines: int = 2
    language: str = "en"
    patterns: tuple[str, ...] = ()
    domains: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.max_depth < 0 or self.max_pages < 1 or self.min_chars < 0 or self.min_lines < 0:
            raise ValueError("depth, pages, characters and lines must not be negative")


@dataclass(frozen=True)
class PdfConfig:
    skip_front: int = 0
    skip_back: int = 0
    skip_ranges: tuple[tuple[int, int], ...] = ()
    fix_headings: bool = True
    fix_code: bool = True
    title_cutoff: float = 0.92

    def __post_init__(self) -> None:
        if self.skip_front < 0 or self.skip_back < 0 or not 0 < self.title_cutoff <= 1:
            raise ValueError("pages to skip must not be negative, the cutoff is a share")


@dataclass(frozen=True)
class CleanConfig:
    structure: bool = True
    heading: bool = True
    link: bool = True
    code: bool = True
    table: bool = True
    list: bool = True
    regex: bool = True
    min_section_chars: int = 30


@dataclass(frozen=True)
class ChunkConfig:
    max_tokens: int = 500
    table_limit: int = 490
    balanced_below: int = 900
    extract_components: bool = True

    def __post_init__(self) -> None:
        if not 0 < self.table_limit <= self.balanced_below or self.max_tokens < 1:
            raise ValueError("limits must be positive and in order")


@dataclass(frozen=True)
class SummaryConfig:
    backend: str = "stub"
    min_tokens: int = 50
    small_below: int = 150
    prefix_path: bool = True
    prefix_page: bool = True
    prefix_chunk: bool = False
    page_summaries: bool = False
    code_summaries: bool = False
    attempts: int = 4


@dataclass(frozen=True)
class EvalConfig:
    percentile: float = 0.20
    trim: float = 0.10
    consistency: bool = False

    def __post_init__(self) -> None:
        if not 0 <= self.percentile <= 1 or not 0 <= self.trim <= 1:
            raise ValueError("percentile and trim are shares")


@dataclass(frozen=True)
class EmbedConfig:
    dim: int = 64
    batch: int = 64
    normalize: bool = True
    compression: str = "zstd"
    fail_on_dim: bool = True


@dataclass(frozen=True)
class RunMetadata:
    id: str
    parser: str = "crawlweb"
    url: str = ""
    base_dir: str = "."
    title: str = ""
    author: str = ""
    category: str = ""
    description: str = ""
    date: str = ""
    tags: str = ""
    pages: str = ""

    def __post_init__(self) -> None:
        if self.parser not in ("crawlweb", "crawlgit", "crawlpdf"):
            raise ValueError(f"no parser {self.parser!r}")
        if self.parser == "crawlpdf" and "://" in self.url:
            raise ValueError("a PDF is read from a path")


@dataclass(frozen=True)
class Settings:
    crawl: CrawlConfig = CrawlConfig()
    pdf: PdfConfig = PdfConfig()
    clean: CleanConfig = CleanConfig()
    chunk: ChunkConfig = ChunkConfig()
    summary: SummaryConfig = SummaryConfig()
    evaluation: EvalConfig = EvalConfig()
    embed: EmbedConfig = EmbedConfig()

    def flat(self) -> dict[str, object]:
        return {f"{f.name}.{k}": v for f in fields(self) for k, v in asdict(getattr(self, f.name)).items()}
