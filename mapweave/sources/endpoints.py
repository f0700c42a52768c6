"""Embedding and chat endpoints over HTTP, with a transport that can be replaced.

A transport is a callable (method, url, headers, body, seconds) -> (status, body); bodies are JSON values. Rate limits,
server errors, time-outs and transport errors are Transient, so that with_retries() tries again; other statuses aren't.
Credentials come from the environment of the process that makes the call.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable
from typing import Any

from mapweave.operators.adjudicate import Transient

Transport = Callable[[str, str, dict[str, str], Any, float], tuple[int, Any]]
EMBED_SECONDS, CHAT_SECONDS, CHAT_TOKENS = 600.0, 120.0, 8192


def over_http(method: str, url: str, headers: dict[str, str], body: Any, seconds: float) -> tuple[int, Any]:
    """The transport of the standard library."""
    data = None if body is None else json.dumps(body).encode()
    request = urllib.request.Request(url, data, {"content-type": "application/json", **headers}, method=method)
    try:
        with urllib.request.urlopen(request, timeout=seconds) as answer:
            return answer.status, json.loads(answer.read() or b"null")
    except urllib.error.HTTPError as error:
        return error.code, error.read().decode(errors="replace")[:500]
    except (urllib.error.URLError, TimeoutError, ConnectionError) as error:
        raise Transient(str(error)) from error


def called(transport: Transport, method: str, url: str, headers: dict[str, str], body: Any, seconds: float) -> Any:
    """The answer's body; what may pass is Transient, anything else an error."""
    status, answer = transport(method, url, headers, body, seconds)
    if status == 429 or status >= 500:
        raise Transient(f"HTTP {status}: {answer}")
    if status >= 400:
        raise ValueError(f"HTTP {status}: {answer}")
    return answer


class embedder:
    """texts -> vectors by POST /api/embed; healthy() asks GET /api/tags."""

    def __init__(self, url: str, model: str, transport: Transport = over_http) -> None:
        self.url, self.model, self.transport = url.rstrip("/"), model, transport

    def healthy(self) -> bool:
        try:
            called(self.transport, "GET", f"{self.url}/api/tags", {}, None, 10.0)
        except (Transient, ValueError):
            return False
        return True

    def __call__(self, texts: list[str]) -> list[list[float]]:
        answer = called(self.transport, "POST", f"{self.url}/api/embed", {}, {"model": self.model, "input": texts}, EMBED_SECONDS)
        if len(answer["embeddings"]) != len(texts):
            raise ValueError(f"{len(texts)} texts, {len(answer['embeddings'])} vectors")
        return answer["embeddings"]


def _key(name: str) -> str:
    found = os.environ.get(name)
    if not found:
        raise ValueError(f"{name} isn't set")
    return found


def _messages(prompt: str, model: str) -> dict:
    return {"model": model, "max_tokens": CHAT_TOKENS, "temperature": 0, "messages": [{"role": "user", "content": prompt}]}


def _anthropic(transport: Transport, prompt: str, model: str) -> str:
    headers = {"x-api-key": _key("ANTHROPIC_API_KEY"), "anthropic-version": "2023-06-01"}
    answer = called(transport, "POST", "https://api.anthropic.com/v1/messages", headers, _messages(prompt, model), CHAT_SECONDS)
    return "".join(x.get("text", "") for x in answer.get("content", []) if x.get("type") == "text")


def _openai(transport: Transport, prompt: str, model: str) -> str:
    base = os.environ.get("OPENAI_BASE_URL", "https://api.openai.com/v1").rstrip("/")
    answer = called(transport, "POST", f"{base}/chat/completions", {"authorization": f"Bearer {_key('OPENAI_API_KEY')}"}, _messages(prompt, model), CHAT_SECONDS)
    return answer["choices"][0]["message"]["content"]


#: Providers of chat endpoints by name.
PROVIDERS: dict[str, Callable[[Transport, str, str], str]] = {"anthropic": _anthropic, "openai": _openai}


def chat(provider: str, model: str | None, transport: Transport = over_http) -> Callable[[str], str]:
    """prompt -> reply."""
    if not model:
        raise ValueError("a provider needs a model")
    ask = PROVIDERS[provider]
    return lambda prompt: ask(transport, prompt, model)


def no_judge() -> Callable[[str], str]:
    raise ValueError("name a judge by --judge module:function, or a --provider and --model")
