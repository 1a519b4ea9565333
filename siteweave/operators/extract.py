"""Model calls as an operator: the plug-in protocol, retry and repair rounds, token budgets and usage.

The default model is deterministic and offline, so a task that runs again gives the same rows. Answers are keyed by
prompt hash; put a cache table in front (see ``cache``) where calls cost money.
"""

from __future__ import annotations

import json
import random
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

from ..config import PipelineConfig, RetryPolicy, parse_headers
from ..functions.html import Document
from ..functions.text import DETAIL_TASK, LISTING_TASK, repair_prompt
from ..functions.validate import DETAILS_STRUCT, LISTING_STRUCT, validator_for


@dataclass(frozen=True)
class Usage:
    input_tokens: int | None = None
    output_tokens: int | None = None
    total_tokens: int | None = None


class Session:
    """A conversation: turns in order, copied on reading."""

    def __init__(self):
        self._turns: list[dict[str, str]] = []

    def say(self, role: str, content: str) -> None:
        self._turns.append({"role": role, "content": content})

    @property
    def messages(self) -> list[dict[str, str]]:
        return [dict(t) for t in self._turns]

    def reset(self) -> None:
        self._turns.clear()


class RateLimited(Exception):
    pass


def is_rate_limit_error(error: BaseException) -> bool:
    text = str(error).lower()
    return isinstance(error, RateLimited) or "429" in text or "resource exhausted" in text or ("rate" in text and "limit" in text)


class Model(Protocol):
    """What a model plug-in offers: one completion of a message list, as JSON text and usage."""

    def complete(self, messages: list[dict[str, str]]) -> tuple[str, Usage]: ...


def usage_of(raw: dict | None) -> Usage:
    """Usage from a provider's counts; all null where it reports none."""
    raw = raw or {}
    return Usage(raw.get("prompt_tokens"), raw.get("completion_tokens"), raw.get("total_tokens"))


@dataclass
class Outcome:
    value: dict | None = None
    attempts: int = 0
    error_kind: str | None = None
    error: str | None = None
    usage: Usage = field(default_factory=Usage)
    all_calls_tokens: int = 0


def invoke(model: Model, system: str, prompt: str, validator: str, policy: RetryPolicy = RetryPolicy(), sleep: Callable[[float], None] = time.sleep) -> Outcome:
    """Up to retries + 1 rounds. A rate-limited call waits and repeats, ``retries`` times a round; another transport error ends it;
    an unusable answer is sent back with its error. The usage is the last call's; all calls' tokens are summed besides."""
    session, out = Session(), Outcome()
    session.say("system", system)
    session.say("user", prompt)
    for attempt in range(policy.retries + 1):
        out.attempts = attempt + 1
        text = None
        for wait in range(policy.retries + 1):
            try:
                text, out.usage = model.complete(session.messages)
                break
            except Exception as e:
                if not is_rate_limit_error(e) or wait == policy.retries:
                    out.error_kind, out.error = "transport", str(e)
                    return out
                sleep(policy.delay_seconds(wait, random.random()))
        out.all_calls_tokens += out.usage.total_tokens or 0
        text = text or "{}"
        value, out.error_kind, out.error = validator_for(validator).validate_json(text)
        if value is not None:
            out.value = value
            return out
        session.say("assistant", text)
        session.say("user", repair_prompt(out.error, attempt))
    return out


class OfflineListingModel:
    """Deterministic stand-in: anchors of the chunk that look like positions, and a next link if there is one."""

    pattern = r"(?i)/(jobs?|careers?|positions?|vacanc\w+)/"

    def complete(self, messages: list[dict[str, str]]) -> tuple[str, Usage]:
        chunk = messages[1]["content"].removeprefix(LISTING_TASK)
        document = Document(chunk)
        anchors = [(n, "".join(document.texts(n))) for n in document.nodes if n.tag == "a" and n.attrs.get("href")]
        jobs = [{"href": n.attrs["href"], "text": t, "selector": f'a[href="{n.attrs["href"]}"]'} for n, t in anchors if re.search(self.pattern, n.attrs["href"])]
        after = next(({"href": n.attrs["href"], "text": t, "selector": f'a[href="{n.attrs["href"]}"]'} for n, t in anchors if t.lower() in ("next", "»", "›")), None)
        answer = {
            "is_job_listing": len(jobs) >= 2, "score": float(min(10, 2 * len(jobs))), "has_pagination": after is not None, "next_page_element": after,
            "parent_container_selector": "*" if jobs else "", "child_job_link_selector": "a[href]" if jobs else "", "individual_job_links": jobs,
        }
        return json.dumps(answer), Usage(len(chunk) // 4, 64, len(chunk) // 4 + 64)


class OfflineDetailsModel:
    """Deterministic stand-in: the first heading or line as title, labelled lines as fields."""

    def complete(self, messages: list[dict[str, str]]) -> tuple[str, Usage]:
        page = messages[1]["content"].removeprefix(DETAIL_TASK)
        lines = [x.strip("#- ").strip() for x in page.splitlines() if x.strip()]
        labelled = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}
        answer = {"jobtitle": lines[0] if lines else "", "location": labelled.get("location", ""), "required_skills": labelled.get("skills", ""), "compensation": labelled.get("compensation", ""), "salary": labelled.get("salary"), "benefits": labelled.get("benefits", "")}
        return json.dumps(answer, ensure_ascii=False), Usage(len(page) // 4, 32, len(page) // 4 + 32)


#: How answers are sampled.
TEMPERATURE, TOP_P = 0.1, 0.3


def _post(url: str, headers: dict[str, str], body: dict) -> dict:
    from urllib.request import Request, urlopen

    request = Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers}, method="POST")
    with urlopen(request, timeout=300) as answer:  # noqa: S310
        return json.load(answer)


@dataclass(frozen=True)
class CompletionModel:
    """A chat-completion endpoint behind the protocol: one call per completion, JSON mode, no retries of its own.

    ``send`` takes (url, headers, body) and returns the endpoint's JSON; the default posts it.
    """

    name: str
    key: str
    base: str = "https://api.openai.com/v1"
    headers: tuple[tuple[str, str], ...] = ()
    send: Callable[[str, dict[str, str], dict], dict] = _post

    @classmethod
    def of(cls, config: PipelineConfig, name: str, send: Callable = _post) -> CompletionModel:
        """The model of this name with the configured key, address and extra headers; a missing key or name is an error."""
        config.check_models()
        extra = tuple((parse_headers(config.llm_extra_headers_json) or {}).items())
        return cls(name, config.api_key, config.llm_api_base.strip() or cls.base, extra, send)

    def complete(self, messages: list[dict[str, str]]) -> tuple[str, Usage]:
        body = {"model": self.name.rpartition("/")[2], "messages": messages, "response_format": {"type": "json_object"}, "temperature": TEMPERATURE, "top_p": TOP_P}
        answer = self.send(f"{self.base.rstrip('/')}/chat/completions", {"Authorization": f"Bearer {self.key}", **dict(self.headers)}, body)
        return answer["choices"][0]["message"].get("content") or "{}", usage_of(answer.get("usage"))


LISTING_SYSTEM, DETAILS_SYSTEM = "You read markup of career pages and answer in JSON.", "You read job descriptions and answer in JSON."


def listing_responses(chunks: DataFrame, model: Callable[[], Model] = OfflineListingModel, policy: RetryPolicy = RetryPolicy(), budget: int = 500_000, pause_ms: int = 0, key: str = "page_key") -> DataFrame:
    """(key, chunk_idx, response, error_kind, attempts, all_calls_tokens): answers to (key, chunk_idx, prompt) within each page's token budget.

    A page's chunks are called in order until its answers have used the budget, so the calls of a page are one group
    (at most the chunk cap); pages run in parallel.
    """

    def run(pages: pd.DataFrame) -> pd.DataFrame:
        lm, used, rows = model(), 0, []
        for i, row in enumerate(pages.sort_values("chunk_idx").itertuples(index=False)):
            if used >= budget:
                break
            if i and pause_ms:
                time.sleep(pause_ms / 1000)
            out = invoke(lm, LISTING_SYSTEM, row.prompt, "listing", policy)
            if out.value is not None:
                out.value["total_token_count"] = out.usage.total_tokens or 0
                used += out.value["total_token_count"]
            rows.append((getattr(row, key), row.chunk_idx, json.dumps(out.value) if out.value is not None else None, out.error_kind, out.attempts, out.all_calls_tokens))
        return pd.DataFrame(rows, columns=[key, "chunk_idx", "response", "error_kind", "attempts", "all_calls_tokens"])

    kind = chunks.schema[key].dataType.simpleString()
    called = chunks.select(key, "chunk_idx", "prompt").groupBy(key).applyInPandas(run, f"{key} {kind}, chunk_idx int, response string, error_kind string, attempts int, all_calls_tokens long")
    return called.selectExpr(key, "chunk_idx", f"from_json(response, '{LISTING_STRUCT}') AS r", "error_kind", "attempts", "all_calls_tokens").select(key, "chunk_idx", "r.*", "error_kind", "attempts", "all_calls_tokens")


def extract_details(pages: DataFrame, model: Callable[[], Model] = OfflineDetailsModel, policy: RetryPolicy = RetryPolicy(), key: str = "job_url") -> DataFrame:
    """Details of each (key, prompt) row; rows without a usable answer have a null ``details`` and an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lm = model()
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                out = invoke(lm, DETAILS_SYSTEM, row.prompt, "details", policy)
                if out.value is not None:
                    out.value["total_token_count"] = out.usage.total_tokens
                rows.append((getattr(row, key), json.dumps(out.value) if out.value is not None else None, out.error_kind, out.error, out.all_calls_tokens))
            yield pd.DataFrame(rows, columns=[key, "answer", "error_kind", "error", "all_calls_tokens"])

    kind = pages.schema[key].dataType.simpleString()
    called = pages.select(key, "prompt").mapInPandas(run, f"{key} {kind}, answer string, error_kind string, error string, all_calls_tokens long")
    return called.selectExpr(key, f"from_json(answer, '{DETAILS_STRUCT}') AS details", "error_kind", "error", "all_calls_tokens")
