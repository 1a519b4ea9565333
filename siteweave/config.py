"""Engine options. Values, ranges and environment names match the crawl pipeline they configure."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

#: Option -> (least, greatest).
RANGES = {
    "max_depth": (0, 100),
    "max_seeds_in_flight": (1, 500),
    "max_pages_global": (1, 500),
    "max_pages_per_seed": (1, 10_000),
    "max_pages_per_host": (1, 100),
    "listing_max_chunks": (1, 100),
    "listing_chunk_sleep_ms": (0, 120_000),
    "listing_max_total_tokens": (1, None),
    "llm_max_retries": (0, 20),
    "llm_retry_base_ms": (50, 60_000),
}


#: Text options that are stripped.
STRIPPED = ("api_key_gemini", "llm_api_key", "llm_provider", "llm_api_base", "llm_extra_headers_json")


@dataclass(frozen=True)
class PipelineConfig:
    seed_urls: str = ""
    llm_provider: str = ""
    llm_api_key: str = ""
    api_key_gemini: str = ""
    llm_model_listing: str = "openai/gpt-4o-mini"
    llm_model_job_detail: str = "openai/gpt-4o-mini"
    llm_api_base: str = ""
    llm_extra_headers_json: str = ""
    max_depth: int = 2
    max_seeds_in_flight: int = 2
    max_pages_global: int = 10
    max_pages_per_seed: int = 50
    max_pages_per_host: int = 5
    output_dir: str = "outputs"
    listing_max_chunks: int = 8
    listing_chunk_sleep_ms: int = 200
    listing_max_total_tokens: int = 500_000
    listing_cache_dir: str = ""
    llm_max_retries: int = 4
    llm_retry_base_ms: int = 500
    max_urls_on_level: int = 10_000
    chunk_size: int = 100_000
    chunk_overlap: int = 1_000
    lossy_tail: bool = True
    max_detail_urls: int = 10
    include_external: bool = True
    max_pages_per_seed_cap: int | None = None
    dedupe_key: str = "normalized"

    def __post_init__(self):
        for name in STRIPPED:
            object.__setattr__(self, name, getattr(self, name).strip())
        for name, (low, high) in RANGES.items():
            value = getattr(self, name)
            if value < low or (high is not None and value > high):
                raise ValueError(f"{name}={value} is outside {low}..{high if high is not None else ''}")
        if self.dedupe_key not in ("normalized", "raw"):
            raise ValueError("dedupe_key is 'normalized' or 'raw'")

    @property
    def seeds(self) -> list[str]:
        """Comma-separated seeds, trimmed, without empty ones."""
        return [s.strip() for s in self.seed_urls.split(",") if s.strip()]

    @property
    def api_key(self) -> str:
        """The model key, or else the fallback key, both stripped."""
        return self.llm_api_key or self.api_key_gemini

    def check_models(self) -> None:
        """A key and both model names are needed before any model call."""
        if not self.api_key:
            raise ValueError("no model key is configured")
        if not self.llm_model_listing.strip() or not self.llm_model_job_detail.strip():
            raise ValueError("both model names are needed")

    @classmethod
    def from_env(cls, environ: dict[str, str] | None = None, dotenv: str | Path | None = None) -> PipelineConfig:
        """Options from upper-case environment names; a .env file (the repository's, else the working folder's) fills gaps."""
        values = {**_read_dotenv(dotenv), **(os.environ if environ is None else environ)}
        known = {f.name: f for f in fields(cls)}
        chosen = {}
        for name, f in known.items():
            raw = values.get(name.upper())
            if raw is None:
                continue
            kind = type(f.default)
            chosen[name] = raw if kind is str else raw.lower() in ("1", "true", "yes", "on") if kind is bool else int(raw)
        return cls(**chosen)

    def with_(self, **changes) -> PipelineConfig:
        return replace(self, **changes)


def _read_dotenv(path: str | Path | None) -> dict[str, str]:
    for candidate in [path] if path else [Path(__file__).resolve().parent.parent / ".env", Path.cwd() / ".env"]:
        if candidate and Path(candidate).is_file():
            lines = (line.strip() for line in Path(candidate).read_text().splitlines())
            pairs = (line.partition("=") for line in lines if line and not line.startswith("#"))
            return {k.strip(): v.strip().strip("\"'") for k, _, v in pairs}
    return {}


def parse_headers(raw: str) -> dict[str, str] | None:
    """Extra request headers from a JSON object; empty text is none, another JSON value an error."""
    if not raw or not raw.strip():
        return None
    value = json.loads(raw)
    if not isinstance(value, dict):
        raise ValueError("extra headers must be a JSON object")
    return {str(k): str(v) for k, v in value.items()}


@dataclass(frozen=True)
class Settings:
    """Worker settings: where results go and which queue folders a stream watches."""

    output_dir: str = "outputs"
    job_details_path: str = ""
    queue_dir: str = ""

    @property
    def details_path(self) -> str:
        return self.job_details_path if self.job_details_path.strip() else f"{self.output_dir.rstrip('/')}/job_details.jsonl"

    @classmethod
    def from_env(cls, environ: dict[str, str] | None = None, dotenv: str | Path | None = None) -> Settings:
        """Settings from upper-case environment names; a .env file fills gaps."""
        values = {**_read_dotenv(dotenv), **(os.environ if environ is None else environ)}
        return cls(**{f.name: values[f.name.upper()] for f in fields(cls) if f.name.upper() in values})


@dataclass(frozen=True)
class HeuristicConfig:
    """Word lists and limits of the listing score. The defaults are fixed values of the rule set."""

    # Fixed values, in the rule set's order.
    title_words: tuple[str, ...] = (
        "career", "job", "vacancy", "Career Opportunities", "opening", "opportunity", "position", "listing",
        "search jobs", "find jobs", "job openings", "job listings", "job vacancies", "employment opportunities",
    )
    single_job_words: tuple[str, ...] = ("apply now", "submit application", "job description")
    general_words: tuple[str, ...] = ("filter", "sort by", "results", "found", "jobs found")
    url_paths: tuple[str, ...] = ("/jobs", "/careers", "/vacancies", "/openings", "/search", "/job-listings", "/positions", "/employment")
    pager_classes: tuple[str, ...] = ("pagination", "pager", "page-numbers", "page-list", "paging", "pagination-container", "paginator")
    weak_pager_classes: tuple[str, ...] = ("page", "paging", "pager")
    pager_words: tuple[str, ...] = ("next", "previous", "last", "first", "page")
    pager_symbols: tuple[str, ...] = ("»", "«", "›", "‹", ">", "<")
    form_words: tuple[str, ...] = ("search jobs", "find jobs", "filter jobs")
    input_names: tuple[str, ...] = ("keyword", "query", "q", "search", "location", "city", "state", "zipcode", "postal", "country", "category", "department", "jobid")
    title_fragments: tuple[str, ...] = (
        "analyst", "specialist", "engineer", "manager", "technician", "coordinator", "junior", "assistant", "associate", "advocate", "director",
        "designer", "consultant", "surgeon", "nurse", "therapist", "radiology", "psychiatrist", "support worker", "councellor", "technologist", "scientist",
    )
    min_words: int = 2
    max_words: int = 99
    max_links: int = 500
    threshold: float = 3.0
    url_part: str = "path"


#: A vocabulary that the synthetic pages do contain (the default one hits none of them).
FIXTURE_VOCABULARY = HeuristicConfig(
    title_words=("the",), single_job_words=("thing",), general_words=("ou",), url_paths=("/en/",), pager_words=("la",), pager_symbols=(), title_fragments=("th", "en"), min_words=1
)


@dataclass(frozen=True)
class RetryPolicy:
    retries: int = 4
    base_ms: int = 500
    jitter_ms: int = 250
    extra: dict = field(default_factory=dict)

    def delay_seconds(self, attempt: int, jitter: float) -> float:
        """base * 2^attempt plus a jitter share in [0, 1) of a quarter second."""
        return self.base_ms * 2**attempt / 1000 + jitter * self.jitter_ms / 1000
