"""Remote reviewers as callables that the workers call. Each takes its address, model and key as parameters; none is contacted before it is
asked."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from .models import provider_name

Send = Callable[[str, dict, dict], dict]


def post(url: str, body: dict, headers: dict, timeout: float = 60) -> dict:
    """The JSON answer to a JSON request."""
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=timeout) as r:
        return json.load(r)


@dataclass(frozen=True)
class Chat:
    """A service that answers lists of messages with choices."""

    url: str
    model: str
    key: str
    most_tokens: int = 4096
    send: Send = post

    def __call__(self, prompt: str) -> str:
        system = getattr(prompt, "system", "")
        messages = [{"role": "system", "content": system}] * bool(system) + [{"role": "user", "content": str(prompt)}]
        body = {"model": self.model, "max_tokens": self.most_tokens, "messages": messages}
        return self.send(self.url, body, {"Authorization": f"Bearer {self.key}"})["choices"][0]["message"]["content"]


@dataclass(frozen=True)
class Messages:
    """A service that answers lists of messages with blocks of content."""

    url: str
    model: str
    key: str
    version: str
    most_tokens: int = 2048
    send: Send = post

    def __call__(self, prompt: str) -> str:
        system = getattr(prompt, "system", "")
        body = {"model": self.model, "max_tokens": self.most_tokens, "messages": [{"role": "user", "content": str(prompt)}]} | ({"system": system} if system else {})
        blocks = self.send(self.url, body, {"x-api-key": self.key, "anthropic-version": self.version})["content"]
        return "".join(b.get("text", "") for b in blocks)


@dataclass(frozen=True)
class Local:
    """A service on one's own machines that answers a prompt."""

    url: str
    model: str
    send: Send = post

    def __call__(self, prompt: str) -> str:
        system = getattr(prompt, "system", "")
        return self.send(self.url, {"model": self.model, "prompt": str(prompt), "stream": False} | ({"system": system} if system else {}), {})["response"]


@dataclass(frozen=True)
class Fixed:
    """Always the same answer, for tests and dry runs."""

    answer: str

    def __call__(self, prompt: str) -> str:
        return self.answer


# Public addresses of the services, and the models asked by default.
ADDRESS = {"deepseek": "https://api.deepseek.com/chat/completions", "claude": "https://api.anthropic.com/v1/messages", "ollama": "http://localhost:11434/api/generate"}
MODEL = {"deepseek": "deepseek-chat", "claude": "claude-3-5-sonnet-latest", "ollama": "qwen2.5"}
VERSION = "2023-06-01"


def from_settings(env: Mapping[str, str], send: Send = post) -> Callable[[str], str] | None:
    """The reviewer the settings ask for, with REVIEW_URL and REVIEW_MODEL in the place of the defaults if they are set; None if they ask for
    none."""
    name = provider_name(env)
    if name not in ADDRESS:
        return None
    url, model = env.get("REVIEW_URL") or ADDRESS[name], env.get("REVIEW_MODEL") or MODEL[name]
    if name == "deepseek":
        return Chat(url, model, env["DEEPSEEK_API_KEY"], send=send)
    if name == "claude":
        return Messages(url, model, env["ANTHROPIC_API_KEY"], VERSION, send=send)
    return Local(url, model, send=send)
