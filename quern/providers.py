"""Model calls behind one interface: an offline stub, rate limits, retries and usage.

A provider is any object with `call(role, messages, **options) -> Reply`.  Real services are adapters that a user
registers; nothing here opens a connection.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPLY = "text string, prompt_tokens int, completion_tokens int, model string, latency_ms double, success boolean, error string"
ROLES = ("generation", "judge")
# What errors of a service that is busy say, in lower case.
BUSY = ("429", "resource_exhausted", "too many")


@dataclass
class Reply:
    """What came back; failures are told by `success`, never raised."""

    text: str = ""
    prompt_tokens: int = 0
    completion_tokens: int = 0
    model: str = ""
    latency_ms: float = 0.0
    success: bool = True
    error: str | None = None


class RateLimiter:
    """At most `per_minute` calls in any 60 seconds and at least 60 / per_minute seconds between two.

    A task has its own limiter: give it the whole rate divided by the number of tasks at a time.
    """

    def __init__(self, per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.per_minute, self.clock, self.sleep = per_minute, clock, sleep
        self.calls: deque[float] = deque()

    def acquire(self) -> None:
        now = self.clock()
        while self.calls and now - self.calls[0] >= 60:
            self.calls.popleft()
        wait = 0.0
        if len(self.calls) >= self.per_minute:
            wait = 60 - (now - self.calls[0])
        if self.calls:
            wait = max(wait, 60 / self.per_minute - (now - self.calls[-1]))
        if wait > 0:
            self.sleep(wait)
        self.calls.append(self.clock())


def retried(call: Callable[[], Reply], retries: int = 5, delay: float = 8.0, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = lambda: random.uniform(0.5, 1.5)) -> Reply:
    """The first reply of up to retries + 1 tries: delay * 2 ** try between them, at least 10 s after a 429, with
    jitter; the last failure comes back as a reply without success."""
    error = ""
    for n in range(retries + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001
            error = str(e)
            if n < retries:
                wait = delay * 2**n
                sleep((max(wait, 10.0) if any(x in error.lower() for x in BUSY) else wait) * jitter())
    return Reply(success=False, error=error)


@dataclass
class Stub:
    """A deterministic stand-in: replies depend only on the prompt.

    `answers` maps a pattern found in the last message to the reply, or to a function of the message.
    """

    model: str = "stub-1"
    answers: list[tuple[str, str | Callable[[str], str]]] = field(default_factory=list)

    def call(self, role: str, messages: list[dict], **options) -> Reply:
        if role not in ROLES:
            raise ValueError(f"unknown role {role!r}")
        prompt = "\n\n".join(m["content"] for m in messages)
        last = messages[-1]["content"] if messages else ""
        text = next((a(last) if callable(a) else a for p, a in self.answers if re.search(p, last)), None)
        if text is None:
            text = json.dumps({"digest": hashlib.md5(prompt.encode()).hexdigest()})
        return Reply(text, int(len(prompt) / 3.5), int(len(text) / 3.5), self.model, 0.0, True, None)


class Adapter:
    """A service behind the provider's interface: a limiter and retries around `send`, which a kind of service defines.

    `client` is the service's own client, made on first use in the task unless given; so adapters can be sent to tasks
    before any connection exists.
    """

    def __init__(self, settings: dict, client: object | None = None, sleep: Callable[[float], None] = time.sleep) -> None:
        self.settings, self._client, self.sleep = settings, client, sleep
        self.model = settings.get("model", "")
        self.limiter = RateLimiter(settings.get("requests_per_minute", 60), sleep=sleep)

    def connect(self) -> object:
        raise NotImplementedError

    def send(self, messages: list[dict], temperature: float, max_tokens: int, json_mode: bool) -> Reply:
        raise NotImplementedError

    @property
    def client(self) -> object:
        if self._client is None:
            self._client = self.connect()
        return self._client

    def call(self, role: str, messages: list[dict], temperature: float = 0.7, max_tokens: int = 4096, json_mode: bool = False) -> Reply:
        def once() -> Reply:
            self.limiter.acquire()
            began = time.monotonic()
            reply = self.send(messages, temperature, max_tokens, json_mode)
            reply.latency_ms, reply.model = (time.monotonic() - began) * 1000, self.model
            return reply

        reply = retried(once, self.settings.get("max_retries", 3), self.settings.get("retry_delay_seconds", 5), self.sleep)
        reply.model = self.model
        return reply


class Gemini(Adapter):
    """Google's Gemini, with a key (mode ai_studio) or through a project (mode vertex_ai); needs the package
    google-genai.  System messages are instructions, the others one text with a blank line between."""

    def connect(self) -> object:
        from google import genai

        mode, key = self.settings.get("mode", "vertex_ai"), self.settings.get("api_key")
        if mode == "ai_studio":
            if not key:
                raise ValueError("mode ai_studio needs an api_key")
            return genai.Client(api_key=key)
        if mode != "vertex_ai":
            raise ValueError(f"unknown mode {mode!r}")
        if key:
            return genai.Client(vertexai=True, api_key=key)
        place = {"project": self.settings.get("project"), "location": self.settings.get("location", "global")}
        return genai.Client(vertexai=True, **{k: v for k, v in place.items() if v})

    def send(self, messages, temperature, max_tokens, json_mode):
        config = {"temperature": temperature, "max_output_tokens": max_tokens}
        if system := [m["content"] for m in messages if m["role"] == "system"]:
            config["system_instruction"] = system
        if json_mode:
            config["response_mime_type"] = "application/json"
        if level := self.settings.get("thinking_level"):
            config["thinking_config"] = {"thinking_level": level}
        got = self.client.models.generate_content(model=self.model, contents="\n\n".join(m["content"] for m in messages if m["role"] != "system"), config=config)
        used = getattr(got, "usage_metadata", None)
        return Reply(got.text or "", getattr(used, "prompt_token_count", 0) or 0, getattr(used, "candidates_token_count", 0) or 0)


class Ollama(Adapter):
    """A local or hosted Ollama service; needs the package ollama.  Thinking gets a larger budget and is taken out of
    the reply."""

    def connect(self) -> object:
        import ollama

        mode, wait = self.settings.get("mode", "local"), self.settings.get("timeout_seconds", 300)
        if mode == "local":
            return ollama.Client(host=self.settings.get("host", "http://localhost:11434"), timeout=wait)
        if mode != "cloud":
            raise ValueError(f"unknown mode {mode!r}")
        if not (key := self.settings.get("api_key")):
            raise ValueError("mode cloud needs an api_key")
        return ollama.Client(host="https://ollama.com", headers={"Authorization": f"Bearer {key}"}, timeout=wait)

    def send(self, messages, temperature, max_tokens, json_mode):
        think = bool(self.settings.get("think", False))
        options = {"temperature": temperature, "num_predict": max(max_tokens + 8192, 16384) if think else max_tokens}
        got = self.client.chat(model=self.model, messages=messages, format="json" if json_mode else None, options=options, think=think)
        text = re.sub(r"<think>.*?</think>\s*", "", (got.get("message") or {}).get("content") or "", flags=re.S)
        return Reply(text, got.get("prompt_eval_count") or 0, got.get("eval_count") or 0)


KINDS = {"gemini": Gemini, "ollama": Ollama}


class Router:
    """One interface over a provider for each role; replies of metered kinds with tokens are added to `usage`."""

    def __init__(self, by_role: dict[str, object], metered: tuple[type, ...] = (Gemini,)) -> None:
        self.by_role, self.metered, self.usage = by_role, metered, []

    @classmethod
    def of(cls, config: dict) -> Router:
        """From settings with the sections generation_llm and judge_llm, each with its provider's kind."""
        found = {role: config.get(f"{role}_llm", {}) for role in ROLES}
        return cls({role: KINDS[s["provider"]](s) for role, s in found.items() if s.get("provider") in KINDS})

    def call(self, role: str, messages: list[dict], **options) -> Reply:
        if role not in self.by_role:
            raise ValueError(f"no provider for role {role!r}; there are {sorted(self.by_role)}")
        reply = self.by_role[role].call(role, messages, **options)
        if reply.success and isinstance(self.by_role[role], self.metered) and reply.prompt_tokens + reply.completion_tokens > 0:
            self.usage.append((reply.model, reply.prompt_tokens, reply.completion_tokens))
        return reply


def mapped(df: DataFrame, prompt: str, provider_of: Callable[[], object], role: str = "judge", system: str | None = None, per_minute: float | None = None, retries: int = 0) -> DataFrame:
    """`df` with `reply` (REPLY), one call for each row with a prompt; a null prompt gives a failed reply.

    The provider is made once a task, so that clients need not be sent; calls of a task run one after the other under
    its limiter, and tasks run side by side.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("reply", T._parse_datatype_string(REPLY))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider, limiter = provider_of(), RateLimiter(per_minute) if per_minute else None
        for b in batches:
            out = []
            for p in b[prompt]:
                if not isinstance(p, str):
                    out.append(vars(Reply(success=False, error="no prompt")))
                    continue
                messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": p}]
                if limiter:
                    limiter.acquire()
                out.append(vars(retried(lambda m=messages: provider.call(role, m), retries)))
            yield b.assign(reply=out)

    return df.mapInPandas(run, schema)


def generate(chunk: dict, ask: Callable[[str, list[str]], Reply], most_iterations: int = 10, stagnation: int = 2, threshold: float = 0.8, stop_on_failure: bool = False) -> tuple[list[dict], int]:
    """(items, iterations) of one chunk: a first call, then follow-ups that see the questions so far.

    A failed follow-up takes an iteration (or stops), an empty one stops; rounds of nothing but repeats stop after
    `stagnation` in a row; the first batch is not compared with itself.
    """
    from quern.functions.replies import items
    from quern.functions.similarity import indel_ratio

    first = ask("initial", [])
    kept = items(first.text) if first.success else []
    still, last = 0, 0
    for n in range(1, most_iterations):
        last = n
        reply = ask("followup", [x["question"] for x in kept])
        if not reply.success:
            if stop_on_failure:
                break
            continue
        new = items(reply.text)
        if not new:
            break
        fresh = []
        for x in new:
            if not any(indel_ratio(str(x["question"]), str(y["question"])) > threshold for y in [*kept, *fresh]):
                fresh.append(x)
        kept += fresh
        still = 0 if fresh else still + 1
        if still >= stagnation:
            break
    return kept, last + 1


GENERATED = "chunk_id string, source_file string, section_hierarchy string, context string, place int, item string, generation_model string, total_iterations int, total_questions int, timestamp string, error string"


def generated(chunks: DataFrame, provider_of: Callable[[], object], prompt_of: Callable[[dict, str, list[str]], str], system: str | None = None, per_minute: float | None = None, retries: int = 0, delay: float = 8.0, skip_failed: bool = True, columns: tuple[str, ...] = (), **settings) -> DataFrame:
    """(GENERATED) one row for each generated item (JSON text) of each chunk; a chunk whose calls all fail gives none.

    Calls of a task go through one limiter, with retries.  A chunk that raises gives one row without an item that
    tells the error, or ends the job where `skip_failed` is off.  `columns` are further ones that prompts need.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider, limiter = provider_of(), RateLimiter(per_minute) if per_minute else None
        for b in batches:
            rows = []
            for chunk in b.to_dict("records"):
                models: list[str] = []

                def ask(kind: str, so_far: list[str], c: dict = chunk) -> Reply:
                    messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": prompt_of(c, kind, so_far)}]

                    def once() -> Reply:
                        if limiter:
                            limiter.acquire()
                        return provider.call("generation", messages)

                    reply = retried(once, retries, delay)
                    models.append(reply.model)
                    return reply

                head = (chunk["chunk_id"], chunk["source_file"], chunk["section_hierarchy"], chunk["chunk_text"])
                try:
                    found, turns = generate(chunk, ask, **settings)
                except Exception as e:  # noqa: BLE001
                    if not skip_failed:
                        raise
                    rows.append((*head, 0, None, None, 0, 0, None, str(e)))
                    continue
                now = datetime.now(timezone.utc).isoformat()
                rows += [(*head, k, json.dumps(x, ensure_ascii=False), next((m for m in models if m), None), turns, len(found), now, None) for k, x in enumerate(found)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in GENERATED.split(", ")]).astype({"place": int, "total_iterations": int, "total_questions": int})

    return chunks.select("chunk_id", "source_file", "section_hierarchy", "chunk_text", *columns).mapInPandas(run, GENERATED)


def hashed_embedding(text: str | None, size: int = 64) -> list[float] | None:
    """A unit vector from hashed words and word pairs; null for null, zeros for a text without words."""
    if text is None:
        return None
    v = np.zeros(size, np.float32)
    words = re.findall(r"[^\W_]+", text.lower())
    for gram in [*words, *map(" ".join, zip(words, words[1:]))]:
        h = int.from_bytes(hashlib.blake2b(gram.encode(), digest_size=8).digest(), "little")
        v[h % size] += 1.0 if h >> 63 else -1.0
    n = float(np.linalg.norm(v))
    return (v / (n or 1.0)).tolist()


def embedded(df: DataFrame, text: str, embed: Callable[[list[str | None]], list[list[float] | None]] | None = None, name: str = "vec") -> DataFrame:
    """`df` with an embedding of the text column, by `embed` over batches or the hashed stand-in."""

    @F.pandas_udf("array<float>")
    def run(s: pd.Series) -> pd.Series:
        texts = [x if isinstance(x, str) else None for x in s]
        return pd.Series(embed(texts) if embed else [hashed_embedding(x) for x in texts], index=s.index, dtype=object)

    return df.withColumn(name, run(F.col(text)))
