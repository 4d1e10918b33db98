"""Model calls in a batch: a backend protocol, retries and pacing, and document-level refinement."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Backend(Protocol):
    """Anything that answers a prompt with a JSON object of a schema."""

    def generate(self, prompt: str, schema: dict[str, Any], temperature: float = 0.2, max_tokens: int | None = None) -> dict[str, Any]: ...


class RateLimited(Exception):
    """A refused call; ``retry_after`` in seconds if the service said so."""

    def __init__(self, retry_after: float | None = None) -> None:
        super().__init__("rate limited")
        self.retry_after = retry_after


class NotJson(ValueError):
    """The first stage failed: an answer that isn't JSON."""


class OffSchema(ValueError):
    """The second stage failed: JSON that breaks the schema."""


class HttpBackend:
    """Chat-completion services that answer with JSON of a schema.

    ``think`` switches a model's reasoning on or off where the service knows such a switch; ``extra`` is added to every request's
    body. ``calls``, ``tokens_in``, ``tokens_out`` and ``seconds`` count what was asked and used.
    """

    def __init__(self, base_url: str, model: str, api_key: str = "", timeout: float = 300.0, think: bool | None = None, extra: dict[str, Any] | None = None) -> None:
        self.base_url, self.model, self.api_key, self.timeout = base_url.rstrip("/"), model, api_key, timeout
        self.extra = ({} if think is None else {"chat_template_kwargs": {"enable_thinking": think}}) | (extra or {})
        self.calls = self.tokens_in = self.tokens_out = 0
        self.seconds = 0.0

    def generate(self, prompt: str, schema: dict[str, Any], temperature: float = 0.2, max_tokens: int | None = None) -> dict[str, Any]:
        import urllib.error
        import urllib.request

        body: dict[str, Any] = {"model": self.model, "temperature": temperature, "messages": [{"role": "user", "content": prompt}], "response_format": {"type": "json_schema", "json_schema": {"name": "answer", "schema": schema}}} | self.extra
        if max_tokens:
            body["max_tokens"] = max_tokens
        request = urllib.request.Request(f"{self.base_url}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.api_key}"} if self.api_key else {}))
        began = time.monotonic()
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as r:
                said = json.load(r)
            text, used = said["choices"][0]["message"]["content"], said.get("usage") or {}
            self.tokens_in += used.get("prompt_tokens") or 0
            self.tokens_out += used.get("completion_tokens") or 0
        except urllib.error.HTTPError as e:
            if e.code == 429:
                after = e.headers.get("Retry-After", "")
                raise RateLimited(float(after) if after.replace(".", "", 1).isdigit() else None) from None
            raise ValueError(f"service answered {e.code}") from None
        finally:
            self.calls += 1
            self.seconds += time.monotonic() - began
        try:
            return json.loads(text)
        except json.JSONDecodeError as e:
            raise NotJson(f"no JSON: {e}") from None


def delay(attempt: int, retry_after: float | None = None, base: float = 2.0, most: float = 2480.0) -> float:
    """Seconds to wait after the ``attempt``-th refusal (from 1)."""
    return retry_after if retry_after is not None else min(base * 2 ** (attempt - 1), most)


def closed(schema: dict[str, Any]) -> dict[str, Any]:
    """The schema with ``additionalProperties: false`` on every object."""
    if isinstance(schema, dict):
        out = {k: closed(v) for k, v in schema.items()}
        return out | {"additionalProperties": False} if out.get("type") == "object" else out
    return [closed(v) for v in schema] if isinstance(schema, list) else schema


def violations(answer: Any, schema: dict[str, Any], at: str = "$") -> list[str]:
    """Where an answer breaks the schema: types, required and unknown properties, enumerations."""
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "integer": int, "number": (int, float)}
    kind = schema.get("type")
    if kind and (not isinstance(answer, kinds[kind]) or kind in ("integer", "number") and isinstance(answer, bool)):
        return [f"{at}: not {kind}"]
    if "enum" in schema and answer not in schema["enum"]:
        return [f"{at}: {answer!r} isn't allowed"]
    out = []
    if kind == "object":
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", known) if k not in answer]
        out += [f"{at}.{k}: unknown" for k in answer if k not in known]
        for k, v in known.items():
            out += violations(answer[k], v, f"{at}.{k}") if k in answer else []
    elif kind == "array" and "items" in schema:
        for i, x in enumerate(answer):
            out += violations(x, schema["items"], f"{at}[{i}]")
    return out


def call(backend: Backend, prompt: str, schema: dict[str, Any], retries: int = 3, wait: Callable[[float], None] = time.sleep, **options: Any) -> dict[str, Any]:
    """One answer that fits the schema, or ValueError. Refused calls are repeated after their delay."""
    for attempt in range(1, retries + 2):
        try:
            answer = backend.generate(prompt, closed(schema), **options)
            break
        except RateLimited as e:
            if attempt > retries:
                raise
            wait(delay(attempt, e.retry_after))
    wrong = violations(answer, closed(schema))
    if wrong:
        raise OffSchema("; ".join(wrong))
    return answer


def answers(prompts: DataFrame, make_backend: Callable[[], Backend], schema: dict[str, Any], per_minute: float | None = None, budget: int | None = None, **options: Any) -> DataFrame:
    """``key, answer, error`` for (key, prompt) rows; answers are JSON text.

    ``per_minute`` is shared evenly by the partitions; ``budget`` takes the first rows by key. A backend is made once a task.
    """
    if budget is not None:
        prompts = prompts.orderBy("key").limit(budget)
    parts = max(1, prompts.sparkSession.sparkContext.defaultParallelism)
    kind = prompts.schema["key"].dataType.simpleString()

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend, gap, last = make_backend(), 60.0 * parts / per_minute if per_minute else 0.0, 0.0
        for b in it:
            rows = []
            for key, prompt in zip(b["key"], b["prompt"]):
                rest = last + gap - time.monotonic()
                if gap and rest > 0:
                    time.sleep(rest)
                try:
                    rows.append((key, json.dumps(call(backend, prompt, schema, **options), sort_keys=True), None))
                except (ValueError, RateLimited) as e:
                    rows.append((key, None, str(e)))
                finally:
                    last = time.monotonic()
            yield pd.DataFrame(rows, columns=["key", "answer", "error"])

    return prompts.select("key", "prompt").repartition(parts, "key").mapInPandas(batches, f"key {kind}, answer string, error string")


def refine_turns(turns: DataFrame, make_backend: Callable[[], Backend], context: int = 5, schema: dict[str, Any] | None = None) -> DataFrame:
    """``doc_uuid, item_id, text``: each turn rewritten in order, with the last rewritten ones as context.

    Documents run in parallel, turns of one document in sequence, as each answer feeds the next prompt. Turns whose
    answer fails keep their place unrefined and don't enter the context.
    """
    schema = schema or {"type": "object", "properties": {"text": {"type": "string"}}}

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        backend, doc, past = make_backend(), None, []
        for b in it:  # sorted by document and place: only the last answers are held
            rows = []
            for d, item, text in zip(b["doc_uuid"], b["item_id"], b["text"]):
                if d != doc:
                    doc, past = d, []
                prompt = "\n".join([*past, "---", text]) if past else text
                try:
                    answer = call(backend, prompt, schema)["text"]
                except (ValueError, RateLimited):
                    continue
                past = [*past, answer][-context:] if context else []
                rows.append((d, item, answer))
            yield pd.DataFrame(rows, columns=["doc_uuid", "item_id", "text"])

    spread = turns.where("text <> ''").repartition("doc_uuid").sortWithinPartitions("doc_uuid", "item_pos", "item_id")
    return spread.select("doc_uuid", "item_id", "text").mapInPandas(batches, "doc_uuid string, item_id string, text string")
