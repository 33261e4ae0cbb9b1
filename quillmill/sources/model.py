"""Requests to a chat model, with a client that callers can replace."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Client = Callable[[str, str], str]

#: Settings of requests for drafts and for checks (fixed values).
DRAFT = {"temperature": 0.3, "timeout": 300}
VERIFY = {"temperature": 0.1, "timeout": 60, "max_tokens": 20}


def http_client(base_url: str, model: str, api_key: str | None = None, temperature: float = 0.3, timeout: float = 300, **options) -> Client:
    """A client of an OpenAI-compatible endpoint."""

    def ask(system: str, user: str) -> str:
        said = {"model": model, "messages": [{"role": "system", "content": system}, {"role": "user", "content": user}], "temperature": temperature, "stream": False, **options}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {api_key}"} if api_key else {})
        request = urllib.request.Request(base_url.rstrip("/") + "/chat/completions", json.dumps(said).encode(), headers, method="POST")
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return json.loads(reply.read())["choices"][0]["message"]["content"]

    return ask


def replies(prompts: DataFrame, client: Client, system: str = "system", user: str = "user") -> DataFrame:
    """``prompts`` with ``reply`` and ``error``: a request that fails does not stop the others."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s, u in zip(b[system], b[user], strict=True):
                try:
                    out.append((client(s, u), None))
                except Exception as e:  # whatever a client raises is reported in its row
                    out.append((None, str(e)))
            yield b.assign(reply=[r for r, _ in out], error=[e for _, e in out])

    return prompts.mapInPandas(run, f"{schema}, reply string, error string")


def draft_fields(answered: DataFrame) -> DataFrame:
    """Replies (JSON, perhaps in a code fence) as annotation fields."""
    from quillmill.functions.text import strip_fence
    from quillmill.sources.files import CHARACTER

    kind = f"struct<world:string,scene:string,emotion:string,plot:string,style:string,characters:array<{CHARACTER}>,pov:string,word_count:int>"
    return answered.withColumn("__d", F.from_json(strip_fence("reply"), kind)).select(*(c for c in answered.columns if c not in ("reply", "system", "user", "error")), "__d.*")


def verdicts(answered: DataFrame) -> DataFrame:
    """Replies as ``present``: true, false or null."""
    from quillmill.functions.text import yes_no

    return answered.withColumn("present", yes_no("reply"))
