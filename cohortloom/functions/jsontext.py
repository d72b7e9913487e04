"""JSON in text: decoding of messages that wrap, fence or surround it, as vectorised Python on the executors."""

from __future__ import annotations

import json
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_FENCE = re.compile(r"^\s*```[a-zA-Z0-9_-]*\s*\n?(.*?)\n?\s*```\s*$", re.DOTALL)
MOST_UNWRAPS = 3


def first_json(text: str) -> Any:
    """The first object or list that a text contains; None without one."""
    decoder = json.JSONDecoder()
    for found in re.finditer(r"[{\[]", text):
        try:
            return decoder.raw_decode(text, found.start())[0]
        except ValueError:
            continue
    return None


def json_like(value: Any) -> Any:
    """An object or list from JSON text, fenced text, JSON within a JSON string, or text around it; None without one."""
    for _ in range(MOST_UNWRAPS + 1):
        if isinstance(value, dict | list):
            return value
        if not isinstance(value, str) or not value.strip():
            return None
        fenced = _FENCE.match(value)
        text = fenced[1] if fenced else value
        try:
            value = json.loads(text)
        except ValueError:
            return first_json(text)
    return value if isinstance(value, dict | list) else None


def message_candidates(message: Any) -> list[str]:
    """Texts of a chat message that may hold the answer: its content, then tool-call arguments."""
    if isinstance(message, str):
        return [message]
    if not isinstance(message, dict):
        return []
    out = []
    content = message.get("content")
    for part in content if isinstance(content, list) else [content]:
        text = part.get("text") or part.get("content") if isinstance(part, dict) else part
        if isinstance(text, str) and text.strip():
            out.append(text)
    extra = message.get("additional_kwargs") or {}
    for call in [*(message.get("tool_calls") or []), *(extra.get("tool_calls") or []), *([{"function": extra["function_call"]}] if extra.get("function_call") else [])]:
        given = call.get("args", call.get("arguments")) if isinstance(call, dict) else None
        if given is None and isinstance(call, dict) and isinstance(call.get("function"), dict):
            given = call["function"].get("arguments")
        if given is not None:
            out.append(given if isinstance(given, str) else json.dumps(given, ensure_ascii=False))
    return out


def repaired(text: Any) -> str | None:
    found = json_like(text)
    if isinstance(found, dict) and isinstance(found.get("parsed"), dict):
        found = found["parsed"]
    elif isinstance(found, dict) and ("content" in found or "tool_calls" in found or "additional_kwargs" in found):
        found = next((x for x in map(json_like, message_candidates(found)) if x is not None), None)
    return None if found is None else json.dumps(found, ensure_ascii=False, separators=(",", ":"))


def repair_json(text: Column) -> Column:
    """Compact JSON of the first object or list of each text, NULL without one."""

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([repaired(x) for x in texts], dtype=object)

    return run(text)


def reason_list(text: Column, schema: str) -> Column:
    """A JSON list of objects as an array of structs; anything else is an empty array."""
    return F.coalesce(F.filter(F.from_json(text, f"array<{schema}>"), lambda x: x.isNotNull()), F.array().cast(f"array<{schema}>"))
